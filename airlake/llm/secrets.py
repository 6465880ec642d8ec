"""Secret scans with an incremental blob ledger.

A document is a path; its text is a blob, addressed by its SHA-256. The ledger is a Parquet
table (blob, findings), partitioned by rule_version, of what has been scanned; other versions' files are not read. A scan content-addresses the
given texts, takes the blobs that the ledger does not have for the present rule version, scans one
holder of each, appends the findings, and joins the ledger back to all paths.

Only ids and digests are grouped; a text held by a third of all rows is scanned once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airlake.llm.common import prepare, quoted, scratch

# Patterns are fixed values: the three base kinds, then public formats of credentials.
# (kind, pattern, measured group, least length of that group)
RULES = (
    (
        "assign",
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        1,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    # To the END line of the same kind; else over the headers and base64 lines that follow.
    (
        "private_key",
        r"-----BEGIN ([A-Z ]{0,30}PRIVATE KEY)-----"
        r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1-----"
        r"|(?:(?:\s|\\r|\\n)+[A-Za-z]+(?:-[A-Za-z]+)+:\x20[^\r\n\\]*)*(?:(?:(?:\s|\\r|\\n)+(?=[A-Za-z0-9+/=]*[0-9+/=A-Z])[A-Za-z0-9+/=]{16,})+"
        r"(?:(?:[\r\n]|\\r|\\n)+[A-Za-z0-9+/]+={0,2}(?=[\r\n]|\\r|\\n|\Z))?)?)",
        0,
        1,
    ),
    # From the beginning of a run of its characters only, so that each run is entered once.
    ("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", 0, 1),
    ("host_token", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})", 0, 1),
)
BASE_KINDS = ("assign", "access", "hex")
KINDS = tuple(rule[0] for rule in RULES)
RULE_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]
LEDGER = "blob binary, findings array<struct<kind:int,start:int,end:int>>, rule_version string"

_compiled = [(re.compile(pattern, re.ASCII), group, least) for _, pattern, group, least in RULES]


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    found = []
    for kind, (pattern, group, least) in enumerate(_compiled):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda f: (f[1], f[0]))


_FINDINGS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            [{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(text)]
            for text in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _FINDINGS)], ["blob", "findings"])


def blob(text: Column) -> Column:
    """Content address of a text; null has that of the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger, empty if nothing was scanned yet. Rows of one blob and version are equal."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan_new(docs: DataFrame, ledger: str, text: str = "text", doc_id: str = "doc_id") -> None:
    """Append the findings of the blobs that the ledger lacks for the present rules.

    Give every version of every document as a row: a version that was seen costs its digest only.
    A lost or repeated append does no harm, since equal blobs have equal findings.
    """
    spark = prepare(docs.sparkSession)
    known = read_ledger(spark, ledger).where(F.col("rule_version") == RULE_VERSION).select("blob")
    held = docs.select(F.col(doc_id).cast("long").alias("holder"), blob(F.col(text)).alias("blob"))
    # One holder per unseen blob; rows without an id come under id null and are scanned by it.
    unseen = held.groupBy("blob").agg(F.min("holder").alias("holder")).join(known, "blob", "left_anti")
    texts = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        blob(F.col(text)).alias("content"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # Joined by the holder's id, which no group shares; the digest settles rows with a repeated id.
    chosen = texts.join(unseen, F.col("id").eqNullSafe(F.col("holder"))).where("content = blob").select("blob", "text")
    chosen.mapInArrow(_scan, "blob binary, findings array<struct<kind:int,start:int,end:int>>").select(
        "blob", "findings", F.lit(RULE_VERSION).alias("rule_version")
    ).write.mode("append").partitionBy("rule_version").parquet(ledger)


def scan_secrets(
    docs: DataFrame, ledger: str | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, blob, findings): one row per row of ``docs``, from the ledger after scanning.

    ``ledger`` is a folder that all executors see; a new one below the shared folder if None.
    Findings are (kind, start, end) by start, then kind, with ``KINDS`` naming the kinds.
    Null text is scanned as empty. Rows with a null id are scanned too; repeated rows get equal
    findings. Other columns are not read; an empty table gives no rows.
    """
    ledger = ledger or scratch(docs.sparkSession, "ledger")
    scan_new(docs, ledger, text, doc_id)
    known = read_ledger(docs.sparkSession, ledger).where(F.col("rule_version") == RULE_VERSION)
    # Blobs without findings need no row here; repeated appends of a blob are equal.
    known = known.where(F.size("findings") > 0).dropDuplicates(["blob"]).drop("rule_version")
    paths = docs.select(F.col(doc_id).cast("long").alias("doc_id"), blob(F.col(text)).alias("blob"))
    nothing = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return paths.join(known, "blob", "left").select(
        "doc_id", "blob", F.coalesce("findings", nothing).alias("findings")
    )


def _redacted(text: Column, findings: Column) -> Column:
    """The text with each run of overlapping findings replaced by ``[SECRET]``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, f: Column) -> Column:
        between = F.substring(text, state["at"] + 1, F.greatest(f["start"] - state["at"], F.lit(0)))
        mark = F.when(f["start"] >= state["at"], F.lit("[SECRET]")).otherwise(F.lit(""))
        return F.struct(
            F.concat(state["out"], between, mark).alias("out"), F.greatest(state["at"], f["end"]).alias("at")
        )

    done = F.aggregate(findings, start, step)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def redact_secrets(
    docs: DataFrame, ledger: str | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with every found span replaced by ``[SECRET]``; no row is dropped.

    Overlapping spans are replaced together. Columns are those of ``docs``; null stays null.
    """
    found = scan_secrets(docs, ledger, text, doc_id).where(F.size("findings") > 0).dropDuplicates(["doc_id", "blob"])
    # The documents travel as one struct, so that no column of theirs can clash.
    rows = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"))
    own = F.col("row")[text]
    same = F.col("row")[doc_id].cast("long").eqNullSafe(F.col("doc_id")) & (blob(own) == F.col("blob"))
    clean = F.when(F.col("findings").isNull(), own).otherwise(_redacted(own, F.col("findings")))
    joined = rows.join(found, same, "left")
    return joined.select(*[(clean if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
