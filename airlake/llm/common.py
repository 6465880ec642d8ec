"""Helpers shared by the operators: session settings, written tables, size-checked lookups."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airlake.session import shared_folder

CHECKOUT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Bytes of text handed to Python at once; rows follow from it, so long texts make small batches.
BATCH_BYTES = 4 * 1024 * 1024
# Rows a lookup table may have to be broadcast; checked by a count before each use.
BROADCAST_ROWS = 10_000
SPACES = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches by bytes, since one text may be thousands of times another.

    Python workers also get this checkout's folder, for a library that is not installed.
    """
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if CHECKOUT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [CHECKOUT, known]))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup_join(df: DataFrame, table: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Join a written lookup table: broadcast if its counted rows are few, else shuffled.

    Beyond the bound Spark joins by shuffle and adaptive execution splits crowded keys.
    """
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    return df.join(table, on, how)


def quoted(name: str) -> str:
    """A column name as it is, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def single_spaced(text: Column) -> Column:
    """The words of a text, joined by one space each; empty for null."""
    collapsed = F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")
    return F.trim(collapsed)


def word_count(spaced: Column) -> Column:
    """Words in a text made by :func:`single_spaced`."""
    # Replacing works on bytes; translating looks every character up in a table.
    spaces = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def id_bucket(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def byte_slices(batch: pa.RecordBatch, column: int, limit: int = BATCH_BYTES // 2) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text each (more only for one long text)."""
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    first, size = 0, 0
    for i, length in enumerate(lengths):
        if i > first and size + (length or 0) > limit:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += length or 0
    if first < len(lengths):
        yield batch.slice(first)
