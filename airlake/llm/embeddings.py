"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised. In each of several tables, Gaussian projections are shifted, cut into steps of
``STEP`` and together name a bucket, per label and length. Projections grow with the counted vectors of the largest
label, so that a bucket keeps about ``BUCKET`` vectors that are near by chance, and tables with the projections, so
that two vectors at the threshold of 0.93 (distance 0.37) share a bucket of at least one table with a probability of
``RECALL``, and closer ones more surely. Bucket mates are compared by exact cosine inside a task. A pair counts in the
first table that it shares, so each link counts once. Equal vectors of a label are one node with a number of copies.

A crowded bucket is cut into blocks and every two blocks are compared. Before that, the vectors of a crowded bucket
that lie within half the threshold's angle of its pivot become a cap: any two of a cap link for certain, so
they are counted by the cap's size and never compared with each other. Groups give sums and spanning edges per vector,
never their pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from airlake.llm.common import prepare, written
from airlake.llm.graph import components
from airlake.llm.wordspace import mix

THRESHOLD = 0.93
STEP = 2.0
# Vectors that share a bucket by chance, and the chance that two at the threshold share one of the tables.
BUCKET = 8
RECALL = 0.993
LEAST_PROJECTIONS = 4
BLOCK = 512
# Groups of up to this size are compared many at a time.
SMALL = 48
# Rows that a task compares at once.
HELD_ROWS = 16_384


def collision(distance: float, step: float = STEP) -> float:
    """Chance that two vectors at a distance fall into the same step of one projection."""
    ratio = step / distance
    inside = math.erf(ratio / math.sqrt(2))
    return inside - math.sqrt(2 / math.pi) / ratio * (1 - math.exp(-ratio * ratio / 2))


def hash_plan(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(tables, projections per table) for ``n`` vectors of one label."""
    far, near = collision(math.sqrt(2)), collision(math.sqrt(2 - 2 * threshold))
    projections = max(LEAST_PROJECTIONS, math.ceil(math.log(max(n, 1) / BUCKET) / -math.log(far)))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - near**projections))
    return tables, projections


@lru_cache(maxsize=8)
def _directions(dimension: int, tables: int, projections: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([5, dimension])
    n = tables * projections
    return rng.standard_normal((dimension, n)), rng.uniform(0, STEP, n)


def _bucket_keys(unit: np.ndarray, plan: tuple[int, int]) -> np.ndarray:
    """One 64-bit bucket name per vector (rows) and table (columns)."""
    tables, projections = plan
    directions, shifts = _directions(unit.shape[1], tables, projections)
    steps = np.floor((unit @ directions + shifts) / STEP).astype(np.int64).view(np.uint64)
    steps = steps.reshape(len(unit), tables, projections)
    h = np.broadcast_to(mix(np.arange(1, tables + 1, dtype=np.uint64)), (len(unit), tables)).copy()
    for k in range(projections):
        h = mix(h ^ steps[:, :, k])
    return h


def _unit(vectors: list) -> np.ndarray:
    """Unit vectors; each is scaled by its largest entry first, so that no square over- or underflows."""
    x = np.array(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vector: list | None) -> bool:
    if not vector or any(v is None for v in vector):
        return False
    x = np.array(vector, np.float64)
    return bool(np.isfinite(x).all() and x.any())


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, node): the node is 64 bits of the digest of label and vector; null if unusable."""
    for batch in batches:
        nodes = []
        for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if label is None or not _usable(vector):
                nodes.append(None)
                continue
            content = label.encode() + b"\0" + (np.array(vector, np.float64) + 0.0).tobytes()
            nodes.append(int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(nodes, pa.int64())], ["vec_id", "label", "vector", "node"]
        )


def _keys(plan: tuple[int, int]):
    """(key, slot, node): each node under its bucket of each table."""
    tables = plan[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pd.DataFrame({"node": batch.column(0).to_numpy(), "label": batch.column(1).to_pylist(), "vector": batch.column(2).to_pylist()})
            rows["size"] = rows["vector"].str.len()
            for (label, size), part in rows.groupby(["label", "size"]):
                content = label.encode() + b"\0" + int(size).to_bytes(8, "little")
                salt = np.uint64(int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little"))
                for first in range(0, len(part), 2048):
                    some = part.iloc[first : first + 2048]
                    keys = mix(_bucket_keys(_unit(some["vector"].tolist()), plan) ^ salt)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys.reshape(-1).view(np.int64)),
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), len(some))),
                            pa.array(np.repeat(some["node"].to_numpy(), tables)),
                        ],
                        ["key", "slot", "node"],
                    )

    return run


def _within_cap(threshold: float):
    """(node, pivot) of the rows whose vector is within half the threshold's angle of the pivot's."""
    least = math.cos(math.acos(threshold) / 2) + 1e-12

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, pivot, *vectors = (c.to_pylist() for c in batch.columns)
            same = [i for i, (a, b) in enumerate(zip(*vectors)) if len(a) == len(b)]
            for size in {len(vectors[0][i]) for i in same}:
                own = [i for i in same if len(vectors[0][i]) == size]
                x, y = (_unit([v[i] for i in own]) for v in vectors)
                near = np.flatnonzero(np.einsum("ij,ij->i", x, y) >= least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node[own[i]] for i in near], pa.int64()), pa.array([pivot[own[i]] for i in near], pa.int64())],
                    ["node", "pivot"],
                )

    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


GROUP = ["key", "low", "high"]


def _compare_groups(threshold: float, plan: tuple[int, int]):
    """Links and spanning edges within each group; rows come sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.to_pandas())
            size += len(held[-1])
            if size >= HELD_ROWS:
                frame = pd.concat(held, ignore_index=True)
                bounds = _bounds(frame)
                yield from _compare_all(frame.iloc[: bounds[-2]], threshold, plan)
                held, size = [frame.iloc[bounds[-2] :]], 0  # the last group may go on
        if held:
            yield from _compare_all(pd.concat(held, ignore_index=True), threshold, plan)

    return run


def _bounds(frame: pd.DataFrame) -> np.ndarray:
    """Where groups begin, and the end."""
    group = frame[GROUP].to_numpy()
    new = np.ones(len(frame), bool)
    new[1:] = (group[1:] != group[:-1]).any(axis=1)
    return np.append(np.flatnonzero(new), len(frame))


def _compare_all(frame: pd.DataFrame, threshold: float, plan: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """All groups of a frame: small ones of equal size and length of vectors at a time, large ones one by one."""
    if not len(frame):
        return
    frame = frame.reset_index(drop=True)
    bounds = _bounds(frame)
    first, count = bounds[:-1], np.diff(bounds)
    lengths = frame["vector"].str.len().to_numpy()
    plain = np.minimum.reduceat(lengths, first) == np.maximum.reduceat(lengths, first)
    small = plain & (count > 1) & (count <= SMALL)
    for length in np.unique(lengths[first[small]]) if small.any() else ():
        for n in np.unique(count[small & (lengths[first] == length)]):
            groups = first[small & (lengths[first] == length) & (count == n)]
            at = groups[:, None] + np.arange(n)
            unit = _unit(frame["vector"].to_numpy()[at.reshape(-1)].tolist())
            cube = unit.reshape(len(groups), n, length)
            g, i, j = np.nonzero(np.triu(cube @ cube.transpose(0, 2, 1) >= threshold, 1))
            yield from _links(frame, unit, at.reshape(-1), g * n + i, g * n + j, plan)
    for k in np.flatnonzero((count > 1) & ~small):
        yield from _compare(frame.iloc[first[k] : first[k] + count[k]], threshold, plan)


def _compare(group: pd.DataFrame, threshold: float, plan: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """One group, of any size."""
    if len(group) < 2:
        return
    lengths = group["vector"].str.len()
    if lengths.nunique() > 1:  # keys of two lengths that are equal by chance
        for _, part in group.groupby(lengths):
            yield from _compare(part, threshold, plan)
        return
    group = group.reset_index(drop=True)
    unit = _unit(group["vector"].tolist())
    i, j = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
    yield from _links(group, unit, np.arange(len(group)), i, j, plan)


def _links(frame, unit, at, i, j, plan) -> Iterator[pa.RecordBatch]:
    """Links and spanning edges of the pairs (i, j) of rows ``at``, as far as this is where they count."""
    low, high, slot, block, label, has_cap, cap, node, copies = (
        frame[c].to_numpy()[at] for c in ("low", "high", "slot", "block", "label", "has_cap", "cap", "node", "copies")
    )
    # Pairs within a block belong to its own group, those of one cap are counted by it.
    own = (low[i] == high[i]) | (block[i] != block[j])
    own &= (label[i] == label[j]) & ~(has_cap[i] & has_cap[j] & (cap[i] == cap[j]))
    i, j = i[own], j[own]
    if not len(i):
        return
    used, which = np.unique(np.concatenate((i, j)), return_inverse=True)
    keys = _bucket_keys(unit[used], plan)
    same = keys[which[: len(i)]] == keys[which[len(i) :]]
    own = same.argmax(axis=1) == slot[i]
    i, j = i[own], j[own]
    if not len(i):
        return
    # A node may be in several groups of the frame: rows are put together by node.
    nodes, which = np.unique(node[np.concatenate((i, j))], return_inverse=True)
    a, b = which[: len(i)], which[len(i) :]
    links = np.bincount(a, copies[j], len(nodes)) + np.bincount(b, copies[i], len(nodes))
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.array(links.astype(np.int64)), pa.array(nodes[_roots(len(nodes), a, b)])],
        ["node", "links", "root"],
    )


def _caps(keys: DataFrame, sizes: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, cap): the pivot whose cap a node of a crowded bucket is in; one per node, the smallest."""
    crowded = sizes.where(F.col("n") > BLOCK).select("key")
    members = keys.join(crowded, "key")
    pivots = members.groupBy("key").agg(F.min("node").alias("pivot"))
    seen = nodes.select(F.col("node").alias("pivot"), F.col("vector").alias("pivot_vector"), F.col("label").alias("pivot_label"))
    near = (
        members.join(written(pivots.join(seen, "pivot"), "pivots"), "key")
        .join(nodes.select("node", "label", "vector"), "node")
        .where("label = pivot_label")
        .select("node", "pivot", "vector", "pivot_vector")
        .mapInArrow(_within_cap(threshold), "node long, pivot long")
    )
    return near.groupBy("node").agg(F.min("pivot").alias("cap"))


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``.

    Rows link when their labels are equal and their cosine is at least ``threshold`` (0.93 or
    more, for the recall stated above). ``component_id`` is the smallest id reachable.

    Null, empty, zero or non-finite vectors, null components and null labels link with
    nothing. Repeated rows are rows that link with each other. Vectors of different length do not
    link. A null id keeps its row, with the smallest id of its component or null. Other columns are
    not read; an empty table gives no rows.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    rows = written(rows.mapInArrow(_nodes, "vec_id long, label string, vector array<double>, node long"), "vectors")
    nodes = written(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("vec_id"),
        ),
        "nodes",
    )
    largest = nodes.groupBy("label", F.size("vector")).count().agg(F.max("count")).first()[0] or 0
    plan = hash_plan(largest, threshold)
    keys = written(
        nodes.select("node", "label", "vector").mapInArrow(_keys(plan), "key long, slot int, node long"), "keys"
    )
    sizes = written(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    caps = written(_caps(keys, sizes, nodes, threshold), "caps")
    counted = nodes.select("node", "label", "vector", "copies").join(caps, "node", "left")
    # Most buckets are one block; only the crowded ones are cut.
    plain = keys.join(sizes.where(F.col("n") <= BLOCK).select("key"), "key").select(
        "key", "slot", "node", *[F.lit(0).cast("long").alias(c) for c in ("block", "low", "high")]
    )
    capped = keys.join(sizes.where(F.col("n") > BLOCK).select("key"), "key").join(caps, "node", "left")
    # Each cap of a bucket, and the rest of it, is cut into blocks that are numbered through.
    blocks = capped.groupBy("key", "cap").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    ordered = F.array_sort(F.collect_list(F.struct("cap", "blocks")))
    start = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["blocks"])
    blocks = blocks.groupBy("key").agg(ordered.alias("parts")).withColumn("all", start)
    place = F.struct(F.lit(False).alias("found"), F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("own"))

    def step(state, part):
        here = part["cap"].eqNullSafe(F.col("cap"))
        return F.struct(
            (state["found"] | here).alias("found"),
            F.when(state["found"] | here, state["first"]).otherwise(state["first"] + part["blocks"]).alias("first"),
            F.when(here, part["blocks"]).otherwise(state["own"]).alias("own"),
        )

    mates = F.col("cap").isNotNull() & (F.col("other") >= F.col("at.first")) & (F.col("other") < F.col("at.first") + F.col("at.own"))
    dealt = (
        capped.join(written(blocks, "blocks"), "key")
        .withColumn("at", F.aggregate("parts", place, step))
        .withColumn("block", F.col("at.first") + F.pmod(F.xxhash64("node"), F.col("at.own")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)))
        .where(~mates)
        .select(
            "key", "slot", "node", "block",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        )
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (
        dealt.union(plain).join(
            counted.select("node", "label", "vector", "copies", F.col("cap").isNotNull().alias("has_cap"), F.coalesce("cap", F.lit(0)).alias("cap")),
            "node",
        )
        .repartition(partitions, *GROUP)
        .sortWithinPartitions(*GROUP)
        .mapInArrow(_compare_groups(threshold, plan), "node long, links long, root long")
    )
    found = written(found, "links")
    # Every two of a cap link: each has all others' copies, and the pivot is its neighbour.
    inside = counted.where("cap is not null").select("node", "cap", "copies")
    totals = inside.groupBy("cap").agg(F.sum("copies").alias("total"))
    inside = inside.join(written(totals, "cap-sizes"), "cap").select(
        "node", (F.col("total") - F.col("copies")).alias("links"), F.col("cap").alias("root")
    )
    found = written(found.union(inside), "all-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.select("node", "root"))
    labelled = nodes.select("node", "vec_id", "copies").join(reached, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    labelled = labelled.join(least, "component").join(links, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return (
        rows.select("vec_id", "node").join(labelled, "node", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
