"""MinHash near-duplicates through an inverted join over signature coordinates.

1. Each distinct shingle set (texts with equal sets are one *node*) gets ``COORDINATES``
   minima. A pair at the similarity threshold agrees on at least ``MATCHES`` of them but for a
   chance of about 1e-5, and less for closer pairs.
2. Nodes are posted under their (coordinate, value) keys. Keys of one node connect nothing and
   nodes with fewer than ``MATCHES`` shared keys are skipped. The others are posted under their
   rarest keys only: two nodes with ``MATCHES`` common keys share one among the
   ``COORDINATES - MATCHES + 1`` rarest of either (keys in one global order). So a passage in
   a third of all texts, whose keys are frequent, is no meeting place.
3. Nodes under one key are first compared with one hub each: a group of thousands of copies
   makes thousands of pairs, not millions. Where a key still holds several components, its list
   is cut into blocks and blocks are compared inside a task: pairs of different components with
   ``MATCHES`` collisions whose sets, as 15-bit marks, may reach the threshold leave it, each from
   the first key that both are posted under. So no link that joins two components is
   lost, and no group is expanded into its pairs.
4. Every pair is confirmed on the full shingle sets before it links.

Sets hold 64-bit shingle hashes; a node is 64 bits of its set's digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from airlake.llm.common import byte_slices, prepare, quoted, single_spaced, written
from airlake.llm.graph import components
from airlake.llm.wordspace import WordSpace, mix

COORDINATES = 96
MATCHES = 59
BLOCK = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_rng = np.random.default_rng(11)
_MULTIPLIERS = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**64, COORDINATES, dtype=np.uint64)


def _shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    space = WordSpace(texts)
    at = space.inside(width)
    hashes, doc = space.windows(width)[at], space.doc[at]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = []
    for i in range(len(texts)):
        if 0 < space.n[i] < width:  # the whole sequence is one shingle; its length is part of it
            words = space.hash[space.first[i] : space.first[i] + space.n[i]]
            whole = np.uint64(space.n[i])
            for w in words:
                whole = mix(np.atleast_1d(whole ^ w))[0]
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
    return sets


def _node(hashes: np.ndarray) -> int | None:
    if not len(hashes):
        return None
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for part in np.array_split(hashes, len(hashes) // 4096 + 1):
        if len(part):
            low = np.minimum(low, (part[:, None] * _MULTIPLIERS + _SHIFTS).min(axis=0))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1):
                sets = _shingle_sets(part.column(1).to_pylist(), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_node(s) for s in sets], pa.int64()),
                        pa.array([_signature(s) if len(s) else None for s in sets], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "n_shingles", "node", "signature"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 0):
                sets = _shingle_sets(part.column(0).to_pylist(), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_node(s) for s in sets], pa.int64()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["node", "shingles"],
                )

    return run


def _postings(nodes: DataFrame) -> DataFrame:
    """(node, weight, keys): the rarest of the keys that a node shares, at most COORDINATES - MATCHES + 1."""
    keys = nodes.select(
        "node",
        F.explode(
            F.transform(
                "signature",
                lambda v, k: F.shiftleft(k.cast("long"), 32).bitwiseOR(v.cast("long").bitwiseAND(0xFFFFFFFF)),
            )
        ).alias("key"),
    )
    shared = keys.groupBy("key").agg(F.count("*").alias("uses")).where("uses > 1")
    ranked = (
        keys.join(shared, "key")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("uses", "key"))).alias("keys"))  # at most COORDINATES
        .where(F.size("keys") >= MATCHES)
    )
    # Unshared keys come first in the order of rarity, so they take places of the prefix.
    prefix = F.transform(F.slice("keys", 1, F.size("keys") - MATCHES + 1), lambda k: k["key"])
    # The middle of a group of copies has the keys that most of the group has.
    weight = F.aggregate("keys", F.lit(0).cast("long"), lambda sum_, k: sum_ + k["uses"])
    return ranked.select("node", weight.alias("weight"), prefix.alias("keys"))


def _near(a: str, b: str, threshold: int):
    """Whether two set sizes allow the threshold (percent) at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def _collisions(a: str, b: str):
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _hub_pairs(postings: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Each node with the weightiest node of every list it is in, if their signatures agree."""
    lists = postings.select("node", "weight", F.explode("keys").alias("key"))
    hub = F.max(F.struct("weight", "node"))["node"]
    hubs = lists.groupBy("key").agg(hub.alias("a"), F.count("*").alias("uses")).where("uses > 1")
    pairs = lists.join(hubs, "key").where("node != a").select("a", F.col("node").alias("b")).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    return (
        pairs.join(right, "b").join(left, "a")
        .where(_near("na", "nb", threshold) & (_collisions("sa", "sb") >= MATCHES))
        .select("a", "b", "na", "nb")
    )


class _Blocks:
    """A column of blocks (lists of structs) as numpy arrays over all rows of the batch."""

    def __init__(self, column: pa.ListArray):
        self.bounds = column.offsets.to_numpy()
        rows = column.values
        self.node, self.component, self.n_shingles = (
            rows.field(name).to_numpy() for name in ("node", "component", "n_shingles")
        )
        signature, posted, marks = (rows.field(name) for name in ("signature", "posted", "marks"))
        self.signature = signature.values.to_numpy()[signature.offsets[0].as_py() :].reshape(-1, COORDINATES)
        self.posted = np.zeros((len(rows), COORDINATES), bool)
        at = posted.offsets.to_numpy()
        own = np.repeat(np.arange(len(rows)), np.diff(at))
        self.posted[own, posted.values.to_numpy()[at[0] : at[-1]]] = True
        self.at, self.values = marks.offsets.to_numpy(), marks.values.to_numpy()
        self.sets: dict[int, frozenset] = {}

    def marks(self, i: int) -> frozenset:
        if i not in self.sets:
            self.sets[i] = frozenset(self.values[self.at[i] : self.at[i + 1]].tolist())
        return self.sets[i]


def _block_collisions(threshold: int):
    """Pairs of two blocks of one list: other component, enough equal coordinates, near enough sets.

    Sets come as 15-bit marks, which give an upper bound and lose no pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[], [], [], []]
            x, y = _Blocks(batch.column(1)), _Blocks(batch.column(2))
            for r, key in enumerate(batch.column(0).to_pylist()):
                xs, ys = slice(*x.bounds[r : r + 2].tolist()), slice(*y.bounds[r : r + 2].tolist())
                nx, ny = x.n_shingles[xs], y.n_shingles[ys]
                sx, sy = x.signature[xs], y.signature[ys]
                px, py = x.posted[xs], y.posted[ys]
                near = np.minimum(nx[:, None], ny) * 100 >= np.maximum(nx[:, None], ny) * threshold
                near &= x.component[xs][:, None] != y.component[ys]
                # A pair is counted under the first key that both are posted under.
                own = key >> 32
                near &= sx[:, None, own] == sy[None, :, own]
                i, j = np.nonzero(near)
                for part in np.array_split(np.arange(len(i)), len(i) // 20_000 + 1):
                    a, b = i[part], j[part]
                    same = sx[a] == sy[b]
                    first = (same & px[a] & py[b]).argmax(axis=1) == own
                    for k in np.flatnonzero(first & (same.sum(axis=1) >= MATCHES)):
                        m, n = xs.start + int(a[k]), ys.start + int(b[k])
                        left, right = x.marks(m), y.marks(n)
                        total = int(x.n_shingles[m] + y.n_shingles[n])
                        spare = min(int(x.n_shingles[m]) - len(left), int(y.n_shingles[n]) - len(right))
                        most = len(left & right) + spare
                        if most * 100 >= (total - most) * threshold:
                            for out, value in zip(
                                found, (x.node[m], y.node[n], x.n_shingles[m], y.n_shingles[n])
                            ):
                                out.append(int(value))
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["a", "b", "na", "nb"])

    return run


def _marks(hashes: str):
    """The low 15 bits of each hash."""
    return F.transform(hashes, lambda h: h.bitwiseAND(0x7FFF).cast("short"))


def _rest_pairs(
    postings: DataFrame, nodes: DataFrame, sets: DataFrame, found: DataFrame, threshold: int
) -> DataFrame:
    """Pairs of different components under one key, after the hub links ``found``."""
    lists = postings.join(found, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), F.explode("keys").alias("key"), "keys"
    )
    mixed = (
        lists.groupBy("key")
        .agg(F.count("*").alias("uses"), F.min("component").alias("c0"), F.max("component").alias("c1"))
        .where("c0 != c1")
        .select("key", F.ceil(F.col("uses") / BLOCK).alias("blocks"))
    )
    dealt = written(
        lists.join(mixed, "key").select(
            "key", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), "node", "component",
            F.transform("keys", lambda k: F.shiftright(k, 32).cast("int")).alias("posted"),
        ),
        "dealt",
    )
    content = (
        dealt.select("node").distinct()
        .join(nodes.select("node", "n_shingles", "signature"), "node")
        .join(sets.select("node", F.array_distinct(_marks("shingles")).alias("marks")).dropDuplicates(["node"]), "node")
    )
    blocks = (
        dealt.join(content, "node")
        .groupBy("key", "block")
        .agg(
            F.collect_list(  # about BLOCK rows
                F.struct("node", "component", "n_shingles", "signature", "posted", "marks")
            ).alias("rows")
        )
    )
    blocks = written(blocks, "blocks")
    x = blocks.select("key", F.col("block").alias("i"), F.col("rows").alias("x"))
    y = blocks.select("key", F.col("block").alias("j"), F.col("rows").alias("y"))
    return (
        x.join(y, "key").where("i <= j").select("key", "x", "y")
        .mapInArrow(_block_collisions(threshold), "a long, b long, na long, nb long")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    common = F.size(F.array_intersect("s", "t")).cast("long")
    return (
        pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("t")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a")
        .where(common * 100 >= (F.col("na") + F.col("nb") - common) * threshold)
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 4, threshold: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs``.

    Words are split at ASCII white space after A-Z are lower-cased; a set has the distinct
    ``width``-word shingles, or the whole sequence if there are fewer words. Sets link when
    intersection * 100 >= union * ``threshold``; ``component_id`` is the smallest id reachable.
    Built for a ``threshold`` of 80 or more (the documented chance of a miss).

    Null or wordless text: no shingles, linked with nothing. A null id keeps its row; it gets
    the smallest id of its component, or null. Repeated rows and texts with equal sets share one
    component. ``kept`` marks rows whose id is their component's; of repeated rows, all. Other
    columns are not read. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        single_spaced(F.translate(F.col(text), UPPER, LOWER)).alias("words"),
    )
    rows = written(
        texts.mapInArrow(
            _signatures(width), "doc_id long, n_shingles long, node long, signature array<int>"
        ),
        "signatures",
    )
    nodes = (
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.min("doc_id").alias("doc_id"),
        )
    )
    nodes = written(nodes, "nodes")
    postings = written(_postings(nodes), "postings")
    posted = postings.select("node").join(nodes, "node")
    wanted = posted.where("doc_id is not null").select("doc_id").distinct()
    sets = written(
        texts.join(wanted, "doc_id").select("words")
        .union(texts.where("doc_id is null").select("words"))
        .mapInArrow(_sets(width), "node long, shingles array<long>").where("node is not null"),
        "sets",
    )
    links = written(_confirmed(_hub_pairs(postings, nodes, threshold), sets, threshold), "links")
    rest = _rest_pairs(postings, nodes, sets, components(links), threshold)
    links = links.union(written(_confirmed(rest, sets, threshold), "links"))
    found = components(links)
    labelled = nodes.select("node", "doc_id").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = labelled.join(least, "component").select("node", "component_id")
    # A row without a node is its own component.
    return (
        rows.drop("signature").join(labels, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group: rows whose id is the smallest of its component.

    Columns are those of ``docs``. Rows without an id stay; repeated rows stay repeated.
    """
    doc_id = options.get("doc_id", "doc_id")
    found = near_duplicates(docs, **options)
    gone = found.where("not kept and doc_id is not null").select(F.col("doc_id").alias("gone")).distinct()
    # The documents travel as one struct, so that no column of theirs can clash.
    rows = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"))
    rest = rows.join(gone, F.col("row")[doc_id].cast("long") == F.col("gone"), "left_anti")
    return rest.select(*[F.col("row")[c].alias(c) for c in docs.columns])
