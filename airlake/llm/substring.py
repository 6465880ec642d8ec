"""Substring dedup with repeated-phrase automata.

Texts with equal word sequences form a class; copies of the smallest id repeat it whole, which
is settled by ids alone. Passages are windows of ``width`` words that occur in several classes:

1. *Anchors.* Of the ``ANCHOR``-word phrases in a window, the one with the least hash is the
   window's anchor, so equal windows have equal anchors. Batches send each distinct anchor with
   at most two classes, whatever the number of its occurrences. Anchors of two or more classes set
   bits in a bitmap of fixed size (``BITS``), which is broadcast. A full bitmap would only
   propose more.
2. *Neighbourhoods.* Around each occurrence of a proposed anchor, the words of its windows are
   one string. Equal strings are merged, with the least id and the least and greatest class.
3. *Automata.* Neighbourhoods are dealt to shards by anchor, so that all occurrences of a window
   meet in one shard. A shard confirms the windows of several classes on their words,
   compiles them (words as integers) into one Aho-Corasick automaton, and streams
   every neighbourhood of all documents through it to locate every occurrence.
4. The found places go back to the documents by the neighbourhood's digest, and each document
   drops the words covered by a window that a smaller id holds.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from airlake.llm.common import byte_slices, prepare, single_spaced, word_count, written
from airlake.llm.wordspace import WordSpace

WIDTH = 13
ANCHOR = 6
BITS = 27
# Buckets of the anchor pass: each owns a slice of the bitmap.
BUCKETS = 256
# Automata per shuffle partition, built one after the other, so that one stays small.
SHARDS = 16
# Distinct neighbourhoods a task gathers before it sends them.
HELD_BYTES = 8 * 1024 * 1024
NO_ID = 2**63 - 1


def _anchors(space: WordSpace, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the anchor position of each, and the hash of every phrase."""
    at = space.inside(width)
    phrases = space.windows(ANCHOR)
    if not len(at):
        return at, at, phrases
    span = np.lib.stride_tricks.sliding_window_view(phrases, width - ANCHOR + 1)
    least = np.concatenate([span[part].argmin(axis=1) for part in np.array_split(at, len(at) // 100_000 + 1)])
    return at, at + least, phrases


def _post_anchors(width: int):
    """(bucket, hashes, classes): the distinct anchors of a batch with their extreme classes.

    An anchor is sent as 40 bits of its hash, 8 of them the bucket; equal bits only propose more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 0):
                space = WordSpace(part.column(0).to_pylist())
                _, anchor, phrases = _anchors(space, width)
                anchor = np.unique(anchor)
                hashes = phrases[anchor] >> np.uint64(24)
                classes = part.column(1).to_numpy(zero_copy_only=False)[space.doc[anchor]]
                order = np.lexsort((classes, hashes))
                hashes, classes = hashes[order], classes[order]
                edge = np.flatnonzero(hashes[1:] != hashes[:-1])
                keep = np.unique(np.concatenate(([0], edge + 1, edge, [len(hashes) - 1]))) if len(hashes) else []
                hashes, classes = hashes[keep], classes[keep]
                bounds = np.searchsorted(hashes >> np.uint64(32), np.arange(BUCKETS + 1, dtype=np.uint64))
                used = np.flatnonzero(np.diff(bounds))
                hashes = hashes.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int64()),
                        pa.array([hashes[bounds[b] : bounds[b + 1]].tobytes() for b in used], pa.binary()),
                        pa.array([classes[bounds[b] : bounds[b + 1]].tobytes() for b in used], pa.binary()),
                    ],
                    ["bucket", "hashes", "classes"],
                )

    return run


def _bits(hashes: np.ndarray) -> np.ndarray:
    """Bit of each hash; buckets own consecutive bits."""
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, bits): one slice of the bitmap per bucket, of anchors held by several classes."""
    rows: dict[int, tuple[list, list]] = {}
    for batch in batches:
        for bucket, hashes, classes in zip(*(c.to_pylist() for c in batch.columns)):
            held = rows.setdefault(bucket, ([], []))
            held[0].append(hashes)
            held[1].append(classes)
    for bucket, (hashes, classes) in rows.items():
        h = np.frombuffer(b"".join(hashes), np.uint32)
        c = np.frombuffer(b"".join(classes), np.int64)
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        repeated = h[1:][(h[1:] == h[:-1]) & (c[1:] != c[:-1])]
        size = 1 << (BITS - 8)
        bits = np.zeros(size, bool)
        bits[repeated >> np.uint32(40 - BITS)] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())],
            ["bucket", "bits"],
        )


def _neighbourhoods(width: int, bitmap, merged: bool):
    """Every proposed anchor occurrence: (doc_id, class, first, digest).

    ``merged``: each distinct neighbourhood instead, (anchor, words, least_id, low, high), so that
    a passage in many documents is sent once per ``HELD_BYTES`` of distinct ones. ``high`` is null
    where it equals ``low``; the anchor is 32 bits of its hash, which only deal rows out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            for part in byte_slices(batch, 0):
                space = WordSpace(part.column(0).to_pylist())
                at, anchor, phrases = _anchors(space, width)
                bit = _bits(phrases[anchor])
                proposed = (bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
                at, anchor = at[proposed], anchor[proposed]
                # Windows of one anchor occurrence follow each other.
                new = np.flatnonzero(np.diff(anchor, prepend=-1)) if len(anchor) else anchor
                first = at[new]
                last = np.append(at[new[1:] - 1], at[-1:]) + width if len(at) else at
                words = [space.text(i, j) for i, j in zip(first, last)]
                doc = space.doc[first]
                ids, classes = part.column(2).take(pa.array(doc)), part.column(1).take(pa.array(doc))
                if not merged:
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids,
                            classes,
                            pa.array((first - space.first[doc]).astype(np.int32)),
                            pa.array([_digest(w) for w in words], pa.binary()),
                        ],
                        ["doc_id", "class", "first", "digest"],
                    )
                    continue
                anchors = (phrases[anchor[new]] >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist()
                for name, text, i, c in zip(anchors, words, ids.to_pylist(), classes.to_pylist()):
                    known = held.get(text)
                    if known is None:
                        held[text] = [name, text, i, c, c]
                        size += len(text)
                    else:
                        if i is not None and (known[2] is None or i < known[2]):
                            known[2] = i
                        known[3], known[4] = min(known[3], c), max(known[4], c)
                if size > HELD_BYTES:
                    yield _merged_rows(held)
                    held, size = {}, 0
        if merged:
            yield _merged_rows(held)

    return run


def _digest(words: str) -> bytes:
    return hashlib.blake2b(words.encode(), digest_size=16).digest()


def _merged_rows(held: dict[str, list]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    rows = [(name, text, i, low, None if low == high else high) for name, text, i, low, high in held.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows) if rows else [[]] * 5, kinds)],
        ["anchor", "words", "least_id", "low", "high"],
    )


def _locate(width: int):
    """Per shard: compile confirmed windows, stream all neighbourhoods, give the owner of each window."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _by_shard(frames):
            yield _locate_shard(frame, width)

    return run


def _by_shard(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole shards out of a stream sorted by shard."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        while len(frame):
            end = int(frame["shard"].searchsorted(frame["shard"].iloc[0], side="right"))
            if held and held[0]["shard"].iloc[0] != frame["shard"].iloc[0]:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(frame.iloc[:end])
            frame = frame.iloc[end:]
    if held:
        yield pd.concat(held, ignore_index=True)


def _locate_shard(frame: pd.DataFrame, width: int) -> pd.DataFrame:
    lists = [words.split(" ") for words in frame["words"]]
    lengths = [len(words) for words in lists]
    # Words stay Python strings: numpy's own would be padded to the longest and lose zero characters at their end.
    numbers: dict[str, int] = defaultdict(count().__next__)
    codes = [numbers[word] for word in chain.from_iterable(lists)]
    ends = np.cumsum(lengths).tolist()
    least, low, high = (frame[c].tolist() for c in ("least_id", "low", "high"))
    held: dict[tuple, list] = {}
    sequences = []
    for i, end in enumerate(ends):
        words = tuple(codes[end - lengths[i] : end])
        sequences.append(words)
        for k in range(len(words) - width + 1):
            window = words[k : k + width]
            known = held.get(window)
            if known is None:
                held[window] = [least[i], low[i], high[i]]
            else:
                known[0] = min(known[0], least[i])
                known[1], known[2] = min(known[1], low[i]), max(known[2], high[i])
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, (owner, first, last) in held.items():
        if first != last:
            automaton.add_word(window, int(owner))
    digests, owners = [], []
    if len(automaton):
        automaton.make_automaton()
        for text, words in zip(frame["words"], sequences):
            found = [-1] * (len(words) - width + 1)
            hit = False
            for end, owner in automaton.iter(words):
                found[end - width + 1] = owner
                hit = True
            if hit:
                digests.append(_digest(text))
                owners.append([None if o == -1 else o for o in found])
    # As objects also when nothing was found, where pandas would take them for numbers.
    return pd.DataFrame({"digest": digests, "owners": owners}, dtype=object)


def _cut(width: int):
    """Drop covered words. Input: doc_id, words, places (start of windows to remove)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.split(" ") if text else []
                covered = np.zeros(len(words) + 1, np.int32)
                np.add.at(covered, places, 1)
                np.add.at(covered, np.array(places) + width, -1)
                keep = np.cumsum(covered)[:-1] == 0
                removed.append(int(len(words) - keep.sum()))
                kept.append(" ".join([words[i] for i in np.flatnonzero(keep)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "class", "n_removed", "kept_text"],
            )

    return run


def repeated_places(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, class, place): starts of windows that also start in a smaller id of another class.

    ``texts`` has doc_id, class (long) and words (single-spaced).
    """
    spark = texts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = (
        texts.select("words", "class")
        .mapInArrow(_post_anchors(width), "bucket long, hashes binary, classes binary")
        .repartition(min(BUCKETS, max(partitions, 8)), "bucket")
        .mapInArrow(_repeated_anchors, "bucket long, bits binary")
        .collect()  # BUCKETS slices of fixed size
    )
    bitmap = bytearray(1 << (BITS - 3))
    for bucket, bits in slices:
        bitmap[bucket * len(bits) : (bucket + 1) * len(bits)] = bits
    shared = spark.sparkContext.broadcast(bytes(bitmap))
    inputs = texts.select("words", "class", "doc_id")
    # Dealt once, by anchor: what is merged by its words afterwards is already in place.
    distinct = (
        inputs.mapInArrow(
            _neighbourhoods(width, shared, merged=True),
            "anchor int, words string, least_id long, low long, high long",
        )
        .repartition(partitions, "anchor")
        .groupBy("anchor", "words")
        .agg(
            # A null id owns nothing: no id is greater than this one.
            F.coalesce(F.min("least_id"), F.lit(NO_ID)).alias("least_id"),
            F.min("low").alias("low"),
            F.max(F.coalesce("high", "low")).alias("high"),
        )
    )
    owners = (
        distinct.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(SHARDS)))
        .sortWithinPartitions("shard")
        .mapInPandas(_locate(width), "digest binary, owners array<long>")
    )
    around = inputs.mapInArrow(
        _neighbourhoods(width, shared, merged=False), "doc_id long, class long, first int, digest binary"
    )
    return (
        around.join(owners, "digest")
        .select("doc_id", "class", "first", F.posexplode("owners").alias("k", "owner"))
        .where("owner < doc_id")
        .select("doc_id", "class", (F.col("first") + F.col("k")).alias("place"))
    )


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text): one row per row of ``docs``.

    Words are split at ASCII white space. A word is removed if a window of ``width`` words that
    covers it also starts in a document with a smaller id; windows are judged on the input.
    ``kept_text`` has the kept words joined by one space, and is null where nothing was
    removed: the text stands as it is.

    Null text: no words. Texts shorter than ``width`` words lose nothing. A null id neither removes
    nor loses words. Repeated rows have equal ids, so they do not remove each other. Other columns
    are not read. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    # The class is 64 bits of the digest of the words.
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), single_spaced(F.col(text)).alias("words")
    ).withColumn("class", F.xxhash64("words"))
    rows = written(
        texts.select(
            "doc_id", "class", word_count(F.col("words")).alias("n_words"), F.sha2("words", 256).alias("whole")
        ),
        "rows",
    )
    first = rows.where("n_words > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    first = first.where("copies > 1").drop("copies")
    places = repeated_places(texts, width).groupBy("doc_id", "class").agg(F.collect_set("place").alias("places"))
    cut = texts.join(places, ["doc_id", "class"]).select("doc_id", "class", "words", "places")
    cut = cut.mapInArrow(_cut(width), "doc_id long, class long, n_removed long, kept_text string")
    cut = cut.dropDuplicates(["doc_id", "class"]).withColumn("cut_sha", F.sha2("kept_text", 256))
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)) & (F.col("n_words") >= width)
    return (
        rows.join(first, "class", "left")
        .join(cut, ["doc_id", "class"], "left")
        .select(
            "doc_id",
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "whole")).alias("kept_sha256"),
            F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        )
    )
