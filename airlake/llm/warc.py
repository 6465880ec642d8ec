"""WARC archives through a chunked record table.

A payload travels as rows (record, chunk number, bytes) of at most ``CHUNK_BYTES``, in order inside
one task, so that neither the writer nor the reader holds a whole record in Python. Both carry
incremental digests: a chunk row knows the size and the digests of its record up to its own end, and the
last one those of the payload.

Writing reads the records twice. The first pass streams the chunks into digests; equal payloads
meet in an aggregation by digest and all but one holder become revisits. The second pass streams
the chunks into gzipped archives in the shared folder, one gzip member per record, and returns an index.
Payloads are shuffled only if the revisits are too many for Spark to broadcast. An archive of a lost
or repeated task is in no index, so it is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import urllib.parse
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airlake.llm.common import prepare, scratch, written

CHUNK_BYTES = 1 << 18
# Compressed bytes after which a task begins a new archive.
ARCHIVE_BYTES = 1 << 27
# Payloads below this size are always stored.
REVISIT_BYTES = 1000
LEVEL = 1
EPOCH = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = b"\r\n\r\n"
RECORD = "urn:page:"
# Printable characters that a target address keeps; all others are percent-encoded.
ADDRESS = "!#$%&'()*+,-./:;=?@[]_~"

INDEX = "archive string, offset long, length long, page_id long, record_type string"
CHUNKS = (
    "archive string, page_id long, record_type string, refers_to long, chunk int, data binary, "
    "payload_bytes long, payload_digest string, last boolean"
)
_CHUNKS = pa.schema(
    [
        ("archive", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("chunk", pa.int32()), ("data", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("last", pa.bool_()),
    ]
)


# Chunk rows ---------------------------------------------------------------------------


def chunk_rows(records: DataFrame, payload: Column, *columns: str) -> DataFrame:
    """``columns`` with (chunk, last, data): the payload cut into rows, in order, without a shuffle.

    A null payload is empty; an empty one has a single empty chunk.
    """
    data = F.coalesce(payload.cast("binary"), F.lit("").cast("binary"))
    last = F.greatest(F.ceil(F.octet_length("payload") / CHUNK_BYTES) - 1, F.lit(0)).cast("int")
    parts = records.select(*columns, data.alias("payload")).select(
        *columns, "payload", F.posexplode(F.sequence(F.lit(0), last)).alias("chunk", "number"), last.alias("final")
    )
    piece = F.substring("payload", F.col("chunk") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))
    return parts.select(*columns, "chunk", (F.col("chunk") == F.col("final")).alias("last"), piece.alias("data"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, payload_bytes, sha1, sha256) of each record, from its chunks in order."""
    size, first, second = 0, hashlib.sha1(), hashlib.sha256()
    for batch in batches:
        rows = []
        for page_id, last, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            view = data.as_buffer()
            size += view.size
            first.update(view)
            second.update(view)
            if last:
                rows.append((page_id, size, first.digest(), second.digest()))
                size, first, second = 0, hashlib.sha1(), hashlib.sha256()
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(column, kind)
                for column, kind in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))
            ],
            ["page_id", "payload_bytes", "sha1", "sha256"],
        )


def payload_digests(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, sha1, sha256): one row per record, from its streamed chunks."""
    chunks = chunk_rows(pages, F.col("html"), "page_id").select("page_id", "last", "data")
    return chunks.mapInArrow(_digests, "page_id long, payload_bytes long, sha1 binary, sha256 binary")


def revisits(digests: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, sha256, holder): the records stored under a larger id of the same payload, each once.

    The holder is the largest id. Records without an id revisit it too, unless none has one.
    Rows of equal payload are reduced to one before the shuffle; the holders are written, so that a
    payload that a third of all records share is split by adaptive execution when it is joined back.
    """
    large = digests.where(F.col("payload_bytes") >= least)
    held = large.groupBy("sha256").agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
    holders = written(held.where("n > 1").select("sha256", "holder"), "warc-holders")
    return large.join(holders, "sha256").where(~F.col("page_id").eqNullSafe(F.col("holder"))).select(
        "page_id", "sha256", "holder"
    ).distinct()


# Archives -----------------------------------------------------------------------------


def _storage(path: str):
    """The Arrow file system of a shared folder and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path)
    return fs.FileSystem.from_uri(path)


def _address(page_id: int | None) -> str:
    return f"{RECORD}{'' if page_id is None else page_id}"


def _page(address: str) -> int | None:
    number = address.strip("<>").removeprefix(RECORD)
    return int(number) if number else None


def record_head(page_id, url, holder, is_revisit, size: int, sha1: bytes, date: str) -> bytes:
    """The header lines of a record and the HTTP head that begins its block."""
    target = urllib.parse.quote(url, safe=ADDRESS) if url else _address(page_id)
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <{_address(page_id)}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_address(holder)}>", f"WARC-Payload-Length: {size}"]
    length = len(HTTP_HEAD) + (0 if is_revisit else size)
    return ("\r\n".join([*lines, f"Content-Length: {length}"]) + "\r\n\r\n").encode() + HTTP_HEAD


class _Archive:
    """One archive file being written; offsets are those of its gzip members."""

    def __init__(self, folder: str, name: str):
        self.name = f"{name}-{uuid.uuid4().hex[:12]}.warc.gz"
        storage, base = _storage(folder)
        self.file = storage.open_output_stream(f"{base}/{self.name}", compression=None)
        self.offset = self.start = 0

    def put(self, data) -> None:
        self.offset += len(data)
        self.file.write(data)

    def begin(self) -> None:
        self.start, self.packer = self.offset, zlib.compressobj(LEVEL, zlib.DEFLATED, 31)

    def add(self, data) -> None:
        if packed := self.packer.compress(data):
            self.put(packed)

    def finish(self) -> None:
        self.put(self.packer.flush())


def _write(folder: str, date: str, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        name, archive = f"part-{task.partitionId():05d}-{task.taskAttemptId()}", None
        try:
            for batch in batches:
                rows = []
                page, url, holder, is_revisit, size, sha1, chunk, last = (c.to_pylist() for c in batch.columns[:-1])
                for i, data in enumerate(batch.column(batch.num_columns - 1)):
                    if archive is None:
                        archive = _Archive(folder, name)
                    if chunk[i] == 0:
                        archive.begin()
                        head = record_head(page[i], url[i], holder[i], is_revisit[i], size[i], sha1[i], date)
                        archive.add(head)
                    archive.add(data.as_buffer())
                    if last[i]:
                        archive.add(END)
                        archive.finish()
                        kind = "revisit" if is_revisit[i] else "response"
                        rows.append((archive.name, archive.start, archive.offset - archive.start, page[i], kind))
                        if archive.offset >= limit:
                            archive.file.close()
                            archive = None
                columns = list(zip(*rows)) or [()] * 5
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                    ["archive", "offset", "length", "page_id", "record_type"],
                )
        finally:
            if archive is not None:
                archive.file.close()

    return run


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least: int = REVISIT_BYTES,
    date: str = EPOCH,
    archive_bytes: int = ARCHIVE_BYTES,
) -> tuple[str, DataFrame]:
    """Write one WARC record per row of ``pages`` (page_id, url, html); returns the folder and the index.

    Of payloads of at least ``least`` bytes that are equal, the one with the largest page_id is a
    ``response`` and the others are ``revisit`` records without a payload. The index, written beside
    the archives, has (archive, offset, length, page_id, record_type) per record and names the archives
    that count.

    Null html is an empty payload. A null url is replaced by the record's own address, a null page_id by an
    empty number. Repeated rows are written as often as they come, with equal records; those of the largest id
    are all responses. Other columns are not read; an empty table gives an empty index and no archive.
    """
    spark = prepare(pages.sparkSession)
    folder = folder or scratch(spark, "archives")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    digests = written(payload_digests(pages), "warc-digests")
    again = written(revisits(digests, least), "warc-revisits")
    again = again.select(F.col("page_id").alias("id"), F.col("sha256").alias("content"), "holder")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", "url", payload.alias("html"), F.octet_length(payload).cast("long").alias("size"),
        F.unhex(F.sha1(payload)).alias("sha1"), F.unhex(F.sha2(payload, 256)).alias("sha256"),
    )
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha256") == F.col("content")), "left")
    is_revisit = F.col("content").isNotNull()
    rows = rows.withColumn("is_revisit", is_revisit).withColumn("html", F.when(~is_revisit, F.col("html")))
    head = ["page_id", "url", "holder", "is_revisit", "size", "sha1"]
    chunks = chunk_rows(rows, F.col("html"), *head)
    storage, base = _storage(folder)
    storage.create_dir(base, recursive=True)
    index = chunks.mapInArrow(_write(folder, date, archive_bytes), INDEX)
    index.write.parquet(f"{folder}/index")
    return folder, read_index(spark, folder)


def archive_chunks(
    chunks: DataFrame,
    folder: str | None = None,
    least: int = REVISIT_BYTES,
    date: str = EPOCH,
    archive_bytes: int = ARCHIVE_BYTES,
) -> tuple[str, DataFrame]:
    """The same from a chunked record table, for payloads that do not fit a row: (page_id, url, chunk, last, data).

    Chunks of a record are numbered from 0 and ``last`` marks the final one; ``page_id`` names one record and is not
    null. Chunks meet by record and are streamed in order, so that no task holds a payload, whatever its size.
    Null data is empty.
    """
    spark = prepare(chunks.sparkSession)
    folder = folder or scratch(spark, "archives")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions, "page_id").sortWithinPartitions("page_id", "chunk")

    data = F.coalesce(F.col("data"), F.lit("").cast("binary"))
    chunks = chunks.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("chunk").cast("int").alias("chunk"), "last", data.alias("data"))
    digests = in_order(chunks.select("page_id", "chunk", "last", "data")).select("page_id", "last", "data")
    digests = written(digests.mapInArrow(_digests, "page_id long, payload_bytes long, sha1 binary, sha256 binary"), "warc-digests")
    again = written(revisits(digests, least).select("page_id", "holder"), "warc-revisits")
    heads = digests.join(again, "page_id", "left").select(
        "page_id", "holder", F.col("holder").isNotNull().alias("is_revisit"), F.col("payload_bytes").alias("size"), "sha1"
    )
    rows = chunks.join(written(heads, "warc-heads"), "page_id").where("not is_revisit or chunk = 0").select(
        "page_id", "url", "holder", "is_revisit", "size", "sha1", "chunk",
        (F.col("last") | F.col("is_revisit")).alias("last"),
        F.when(F.col("is_revisit"), F.lit("").cast("binary")).otherwise(F.col("data")).alias("data"),
    )
    storage, base = _storage(folder)
    storage.create_dir(base, recursive=True)
    in_order(rows).mapInArrow(_write(folder, date, archive_bytes), INDEX).write.parquet(f"{folder}/index")
    return folder, read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


# Reading ------------------------------------------------------------------------------


def _headers(file) -> dict[str, str] | None:
    line = file.readline()
    if not line:
        return None
    if line.strip() != VERSION.encode():
        raise ValueError(f"not the beginning of a record: {line[:80]!r}")
    headers = {}
    while line := file.readline().rstrip(b"\r\n"):
        name, _, value = line.decode("utf-8").partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers


def read_records(file, archive: str) -> Iterator[tuple]:
    """Chunk rows of an archive, streamed; digests are carried along and checked at each record's end."""
    while (headers := _headers(file)) is not None:
        left, line = int(headers["content-length"]), b" "
        while left and line.rstrip(b"\r\n"):  # the HTTP head
            line = file.readline()
            left -= len(line)
        known = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
        page, kind = _page(headers["warc-record-id"]), headers["warc-type"]
        if kind == "revisit":
            holder = _page(headers["warc-refers-to"])
            yield archive, page, kind, holder, 0, None, int(headers["warc-payload-length"]), known, True
        else:
            chunk, size, digest = 0, 0, hashlib.sha1()
            while True:
                data = file.read(min(left, CHUNK_BYTES)) if left else b""
                if left and not data:
                    raise ValueError(f"{archive} ends within record {headers['warc-record-id']}")
                left -= len(data)
                size += len(data)
                digest.update(data)
                if not left and digest.hexdigest() != known:
                    raise ValueError(f"{archive}: the payload of {headers['warc-record-id']} is not what was written")
                yield archive, page, kind, None, chunk, data, size, digest.hexdigest(), not left
                chunk += 1
                if not left:
                    break
        if file.read(len(END)) != END:
            raise ValueError(f"{archive}: record {headers['warc-record-id']} has no end")


def _read(folder: str, data: bool) -> Callable:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHUNKS)], schema=_CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, base = _storage(folder)
        for names in batches:
            for archive in names.column(0).to_pylist():
                held, size = [], 0
                with storage.open_input_stream(f"{base}/{archive}", compression=None) as packed:
                    for row in read_records(gzip.GzipFile(fileobj=packed), archive):
                        if not data:
                            if not row[-1]:
                                continue
                            row = (*row[:5], None, *row[6:])
                        held.append(row)
                        size += len(row[5] or b"")
                        if len(held) >= 4096 or size >= 8 * CHUNK_BYTES:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

    return run


def read_chunks(spark: SparkSession, folder: str, data: bool = True) -> DataFrame:
    """The chunked record table of the indexed archives, one task per archive.

    (archive, page_id, record_type, refers_to, chunk, data, payload_bytes, payload_digest, last): size and
    digest (hexadecimal SHA-1) are those of the payload up to the chunk's end. A revisit is one row without data, with the
    size and digest of the payload it stands for. Without ``data`` only the last row of each record is returned; the payloads
    are read and verified all the same.
    """
    prepare(spark)
    archives = read_index(spark, folder).groupBy("archive").agg(F.sum("length").alias("bytes"))
    count = max(1, archives.count())
    names = archives.repartition(count).select("archive")
    return names.mapInArrow(_read(folder, data), CHUNKS)


def archived_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): written, then read back from the archives."""
    folder, _ = write_archives(pages, folder)
    records = read_chunks(pages.sparkSession, folder, data=False)
    return records.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# The records that must come back, in DuckDB; null ids compare as the function says.
WARC_SQL = f"""
with payloads as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as payload_bytes from {{table}}
), held as (
  select *, max(page_id) over (partition by html) as holder from payloads
), typed as (
  select *, payload_bytes >= {REVISIT_BYTES} and page_id is distinct from holder as is_revisit from held
)
select page_id, payload_bytes, sha1(html) as payload_digest,
  case when is_revisit then 'revisit' else 'response' end as record_type,
  case when is_revisit then holder end as refers_to
from typed
"""
