"""LM scoring with a probabilistic suffix tree over words.

Contexts are the last 1 to ``DEPTH`` words before a token (with a mark for the start of the text).
Every context followed by at least ``LEAST`` training tokens is a candidate, so the tree grows
with the corpus. It is retained if the distribution of its next words differs from that of
its shorter context: the marginal likelihood ratio of a Dirichlet prior of weight ``PRIOR`` around the
parent's distribution must exceed 1 / ``ERROR``. The ratio has mean 1 if they are the same, so that
a wrong one is retained with a probability of at most ``ERROR`` however rare the words are.

With n of N tokens, a retained context gives a word (n + PRIOR * parent) / (N + PRIOR); others pass the
parent's probability on. So the log probability of a token is that of the smoothed word counts, plus
for each retained context before it log(PRIOR / (N + PRIOR)), plus for each of these that has the word next
log(1 + n / (PRIOR * parent)). These are sums over the word sequences of a text, and each sequence is
looked up by its hash alone.

Sequences travel as packed arrays in hash buckets, whose number follows the size of the texts. A level's counts go
to the bucket of their suffix (all but the first word), where the parent's probabilities are, and stay there. Since a word
seen once adds the same to every ratio, only what words seen twice and more add goes on to the bucket of the context, where it
is tested. The ``TOP`` most frequent retained contexts are broadcast, and values are worked out from the counts in place; what
follows the others is dealt by context once more. Sequences that make up more than ``FREQUENT_SHARE`` of the tokens (so at
most 1 / ``FREQUENT_SHARE`` per length) are broadcast too, and what hangs on them is dealt by the whole sequence: no
bucket gathers a frequent word. Bitmaps of at most 2 ** ``BITS`` bits keep back sequences without a candidate or retained
context; a full one only sends more. Words and sequences are identified by 64 bits.

A text is scored by the broadcast values of up to ``TOP`` frequent sequences per length; the others meet their values in
buckets, in three passes over the texts, so that the disk holds a part of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from airlake.llm.common import prepare, scratch, written
from airlake.llm.wordspace import mix

FREQUENT_SHARE = 1e-4
# Most words of a context, and least tokens after it.
DEPTH = 3
LEAST = 20
# Weight of the parent's distribution, in observations.
PRIOR = 20.0
# Chance of retaining a context that does not differ from its parent.
ERROR = 1e-3
# Most bits of a bitmap (16 MB), and bits per sequence below that.
BITS = 27
BITS_EACH = 8
END = np.uint64(0xE0F)
START = np.uint64(0x50F)
# Most sequences of a length whose values are broadcast.
TOP = 1 << 18
# Bytes of text per bucket, and least buckets.
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 64
# Distinct words, and sequences, that a task holds before it sends their counts on.
HELD_WORDS = 1_000_000
HELD_GRAMS = 750_000

# Rows of a bucket come in this order of kinds, with up to five packed arrays each.
COUNTS, VALUES, WORDS, SEQUENCES, HEADS = range(5)
PARENTS, GRAMS, WEIGHED, OFTEN, PARTIAL, STATES, SETTLED = range(10, 17)
# Counts by the length of their context.
GRAMS_OF = 200
PACKED = "bucket long, kind int, a binary, b binary, c binary, d binary, e binary"
COLUMNS = "abcde"


def _pack(buckets: np.ndarray | list, kind: int, *columns: list) -> pa.RecordBatch:
    columns = [*columns, *[[None] * len(buckets)] * (len(COLUMNS) - len(columns))]
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int64()), pa.array([kind] * len(buckets), pa.int32())]
        + [pa.array(c, pa.binary()) for c in columns],
        ["bucket", "kind", *COLUMNS],
    )


def _buckets(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _dealt(buckets: int, kind: int, own: np.ndarray, *arrays: np.ndarray) -> pa.RecordBatch:
    """Parallel arrays as one row per bucket."""
    order = np.argsort(own, kind="stable")
    bounds = np.searchsorted(own[order], np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(bounds))
    arrays = [a[order] for a in arrays]
    return _pack(used, kind, *[[a[bounds[b] : bounds[b + 1]].tobytes() for b in used] for a in arrays])


def _dealt_runs(buckets: int, kind: int, own: np.ndarray, lead: np.ndarray, *arrays: np.ndarray) -> pa.RecordBatch:
    """The same, the first array as distinct values and run lengths."""
    order = np.argsort(lead)
    order = order[np.argsort(own[order], kind="stable")]
    own, lead, arrays = own[order], lead[order], [a[order] for a in arrays]
    new = np.ones(len(lead), bool)
    new[1:] = (lead[1:] != lead[:-1]) | (own[1:] != own[:-1])
    starts = np.flatnonzero(new)
    runs = np.diff(np.append(starts, len(lead))).astype(np.uint32)
    lead = lead[starts]
    bounds = np.searchsorted(own, np.arange(buckets + 1))
    heads = np.searchsorted(starts, bounds)
    used = np.flatnonzero(np.diff(bounds))
    return _pack(
        used, kind,
        [lead[heads[b] : heads[b + 1]].tobytes() for b in used], [runs[heads[b] : heads[b + 1]].tobytes() for b in used],
        *[[a[bounds[b] : bounds[b + 1]].tobytes() for b in used] for a in arrays],
    )


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[tuple]]]]:
    """(bucket, rows by kind) out of rows sorted by bucket."""
    bucket, held = None, {}
    for batch in batches:
        for own, kind, *columns in zip(*(c.to_pylist() for c in batch.columns)):
            if own != bucket:
                if held:
                    yield bucket, held
                bucket, held = own, {}
            held.setdefault(kind, []).append(columns)
    if held:
        yield bucket, held


def _column(rows: list[tuple], i: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(row[i] for row in rows), kind)


# Words --------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# The first 0 to 8 bytes of eight, and fixed random numbers.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ROOT, _ODD = np.uint64(0x9AE16A3B2F90404F), np.uint64(0x9E3779B97F4A7C15)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, straight from the bytes: A-Z lower-cased, split at ASCII white space.

    A word's hash is the sum of a mixed number per place and 8 bytes, so regular words do not collide by construction.
    """
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    word = ~_SPACE[raw]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    filled = bounds[1:] > bounds[:-1]
    first, last = bounds[:-1][filled], bounds[1:][filled] - 1
    begins[first], stops[last] = word[first], word[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sizes = ends - starts
    lowered = np.append(_LOWER[raw], np.zeros(8, np.uint8))
    eights = np.ndarray(len(raw) + 1, "<u8", lowered, strides=(1,))  # the 8 bytes from each one on
    sums = mix((eights[starts] & _FIRST[np.minimum(sizes, 8)]) ^ _ROOT) + sizes.astype(np.uint64) * _ODD
    long = np.flatnonzero(sizes > 8)
    if len(long):
        more = (sizes[long] - 1) >> 3
        first = np.cumsum(more) - more
        place = np.arange(more.sum()) - np.repeat(first, more) + 1
        own = np.repeat(long, more)
        part = eights[starts[own] + 8 * place] & _FIRST[np.minimum(sizes[own] - 8 * place, 8)]
        sums[long] += np.add.reduceat(mix(part ^ mix(place.astype(np.uint64) * _ODD)), first)
    hashes = mix(sums)
    return hashes, np.searchsorted(bounds, starts, side="right") - 1


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _rotated(x: np.ndarray, k: int) -> np.ndarray:
    high = x << np.uint64(k)
    x >>= np.uint64(64 - k)
    x |= high
    return x


def _joined(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Hash of a sequence from those of all but its last and all but its first word: Spark's xxhash64."""
    h = np.full(len(prefix), 42, np.uint64)
    for part in (prefix, suffix):
        mixed = _rotated(part * _P2, 31)
        mixed *= _P1
        h += _P5 + np.uint64(8)
        h ^= mixed
        h = _rotated(h, 27)
        h *= _P1
        h += _P4
        for shift, factor in ((33, _P2), (29, _P3), (32, None)):
            h ^= h >> np.uint64(shift)
            if factor is not None:
                h *= factor
    return h


def _sequences(texts: pa.Array, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Text number of every token, and per length the hash of the sequence from each token on.

    Each text has a start before and an end after its words. Sequences may run across texts.
    """
    words, doc = hashed_words(texts)
    n = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n) - n
    edges = np.stack((first, first + n), axis=1).reshape(-1)
    hashes = [np.insert(words, edges, np.tile(np.array([START, END]), len(texts)))]
    for _ in range(longest - 1):
        hashes.append(_joined(hashes[-1][:-1], hashes[-1][1:]))
    return np.repeat(np.arange(len(texts)), n + 2), hashes


def _inside(doc: np.ndarray, size: int) -> np.ndarray:
    """Whether ``size`` tokens from each one on lie in one text."""
    count = max(0, len(doc) - size + 1)
    return doc[:count] == doc[size - 1 : size - 1 + count]


# Counts -------------------------------------------------------------------------------


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(which, np.concatenate(counts), len(distinct)).astype(np.int64)


def _count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for batch in batches:
            words = hashed_words(batch.column(0))[0]
            distinct, n = np.unique(words, return_counts=True)
            keys += [distinct, np.array([END])]
            counts += [n, np.array([batch.num_rows])]
            size += len(distinct)
            if size > HELD_WORDS:
                held = _merge(keys, counts)
                keys, counts, size = [held[0]], [held[1]], len(held[0])
                if size > HELD_WORDS // 2:
                    yield _dealt(buckets, COUNTS, _buckets(held[0], buckets), *held)
                    keys, counts, size = [], [], 0
        if keys:
            held = _merge(keys, counts)
            yield _dealt(buckets, COUNTS, _buckets(held[0], buckets), *held)

    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of summed, sorted counts per bucket."""
    for bucket, rows in _by_bucket(batches):
        keys, n = _merge([_column(rows[COUNTS], 0, np.uint64)], [_column(rows[COUNTS], 1, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([bucket], pa.int64()),
                pa.array([keys.tobytes()], pa.binary()),
                pa.array([n.tobytes()], pa.binary()),
                pa.array([int(n.sum())], pa.int64()),
                pa.array([len(keys)], pa.int64()),
            ],
            ["bucket", "keys", "n", "tokens", "words"],
        )


def _at_least(least: float):
    """(seq, n) of packed keys (first column) and counts (second) that reach a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(*(c.to_pylist() for c in batch.columns)):
                keys, n = np.frombuffer(keys, np.int64), np.frombuffer(n, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys[n >= least]), pa.array(n[n >= least])], ["seq", "n"])

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64))], ["seq"])


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set; a bitmap has a power of two of bytes."""
    bits = len(bitmap).bit_length() + 2
    bit = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _bitmap(packed: DataFrame, least: int = 0) -> np.ndarray:
    """A bit for each hash packed in the first column, or those whose count in the second reaches a number."""
    if least:
        hashes = packed.mapInArrow(_at_least(least), "seq long, n long").select("seq")
        number = hashes.count()
    else:
        hashes = packed.mapInArrow(_keys, "seq long")
        number = (packed.agg(F.sum(F.octet_length(packed.columns[0]))).first()[0] or 0) // 8
    size = min(BITS, max(16, int(number * BITS_EACH).bit_length()))
    bit = F.shiftrightunsigned("seq", 64 - size) + 1
    slices = hashes.groupBy(F.bitmap_bucket_number(bit).alias("slice")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    bitmap = bytearray(1 << (size - 3))
    for row in slices.collect():  # 2 ** BITS bits
        first = (row["slice"] - 1) * len(row["bits"])
        bitmap[first : first + len(row["bits"])] = row["bits"]
    return np.frombuffer(bytes(bitmap), np.uint8)


class Table:
    """Distinct keys in order, with parallel arrays. Keys are hashes, so their first bits tell about where they are."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.columns = keys[order], [c[order] for c in columns]
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        heads = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.first = np.append(np.searchsorted(self.keys, heads), len(keys)).astype(np.int32)
        self.steps = int(np.diff(self.first).max())

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, and which keys are there at all."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        last = len(self.keys) - 1
        at = np.minimum(self.first[keys >> self.shift], last)
        for _ in range(self.steps):
            at += (self.keys[at] < keys) & (at < last)
        return at, self.keys[at] == keys

    def value(self, keys: np.ndarray, column: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """A column's value for each key, 0 for those that are not there, and which are."""
        at, found = self.find(keys)
        return (np.where(found, self.columns[column][at], 0) if len(self.keys) else np.zeros(len(keys))), found


def _count_grams(sizes: list[int], candidates, frequent, buckets: int):
    """Counts of the tokens after contexts of some lengths, dealt by suffix; frequent suffixes of the least length are known.

    A single word is a context if it is in the bitmap; a longer sequence if each two neighbours in it are.
    """

    def flush(size: int, pieces: list[tuple]) -> pa.RecordBatch:
        context, suffix = (np.concatenate(p) for p in zip(*pieces))
        context, suffix, key, n = _distinct(context, suffix, np.ones(len(context), np.int64))
        own = _buckets(np.where(frequent.value.find(suffix)[1], key, suffix) if size == min(sizes) else suffix, buckets)
        return _dealt_runs(buckets, GRAMS_OF + size, own, suffix, context, n.astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, count = candidates.value, {size: [] for size in sizes}, dict.fromkeys(sizes, 0)
        for batch in batches:
            doc, hashes = _sequences(batch.column(0), max(sizes))
            marked = _marked(bits, hashes[0 if sizes == [1] else 1])
            for size in sizes:
                at = np.flatnonzero(_inside(doc, size + 1))
                for k in range(max(1, size - 1)):
                    at = at[marked[at + k]]
                held[size].append((hashes[size - 1][at], hashes[size - 1][at + 1]))
                count[size] += len(at)
                if count[size] > HELD_GRAMS:
                    yield flush(size, held[size])
                    held[size], count[size] = [], 0
        for size in sizes:
            if count[size]:
                yield flush(size, held[size])

    return run


def _distinct(context: np.ndarray, suffix: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(context, suffix, key, n) of the distinct sequences, counts added up."""
    key = _joined(context, suffix)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    first = order[starts]
    return context[first], suffix[first], key[starts], np.add.reduceat(n[order], starts) if len(starts) else n


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series of x + 8, taken back by the product of the 8 steps."""
    y = x + 8
    steps = reduce(lambda a, k: a * (x + k), range(1, 8), x)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(steps)


def _evidence(n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """What each next word adds to the likelihood ratio: a word seen once log(PRIOR), whatever its parent."""
    terms = np.full(len(n), np.log(PRIOR))
    often = n > 1
    n, p = n[often].astype(np.float64), p[often]
    terms[often] = _log_gamma(n + PRIOR * p) - _log_gamma(PRIOR * p) - n * np.log(p)
    return terms


def _differs(total: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    prior = np.array([PRIOR])
    return evidence + _log_gamma(prior) - _log_gamma(total + PRIOR) > -np.log(ERROR)


def _weigh(size: int, frequent, buckets: int, scale: float):
    """Whole counts with their parent's probability, by suffix; those of at least ``LEAST`` among the new sequences; and per
    context what words seen twice and more add to its ratio beyond what as many words seen once would."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value
        for bucket, rows in _by_bucket(batches):
            pieces = rows.get(GRAMS_OF + size)
            if not pieces:
                continue
            table = Table(_column(rows.get(PARENTS, []), 0, np.uint64), _column(rows.get(PARENTS, []), 1, np.float64))
            suffix = np.repeat(_column(pieces, 0, np.uint64), _column(pieces, 1, np.uint32))
            n = _column(pieces, 3, np.uint32).astype(np.int64)
            context, suffix, key, n = _distinct(_column(pieces, 2, np.uint64), suffix, n)
            order = np.argsort(suffix, kind="stable")
            context, suffix, key, n = context[order], suffix[order], key[order], n[order]
            starts = np.flatnonzero(np.append(True, suffix[1:] != suffix[:-1]))
            heads, runs = suffix[starts], np.diff(np.append(starts, len(suffix)))
            p, found = table.value(heads)
            hot_p, is_hot = hot.value(heads)
            p, use = np.where(is_hot, hot_p, p), found | is_hot
            if not use.all():  # their context is none, and only a bit of the bitmap was set
                within = np.repeat(use, runs)
                context, key, n = context[within], key[within], n[within]
                heads, runs, p = heads[use], runs[use], p[use]
            if not len(n):
                continue
            contexts, which = np.unique(context, return_inverse=True)
            yield _pack(
                [bucket], WEIGHED, [heads.tobytes()], [runs.astype(np.uint32).tobytes()], [p.tobytes()],
                [contexts.tobytes()], [np.stack((which, n)).astype(np.uint32).tobytes()],
            )
            often = n >= LEAST
            yield _dealt(buckets, OFTEN, _buckets(key[often], buckets), key[often], n[often])
            twice = n > 1
            more = _evidence(n[twice], np.repeat(p, runs)[twice] * scale) - n[twice] * np.log(PRIOR)
            some = np.flatnonzero(np.bincount(which[twice], minlength=len(contexts)))
            more = np.bincount(which[twice], more, len(contexts))
            yield _dealt(buckets, PARTIAL, _buckets(contexts[some], buckets), contexts[some], more[some])

    return run


def _test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The retained contexts of each bucket with the tokens after them.

    Contexts without a word seen twice are not among them: their ratio is at most 1.
    """
    for bucket, rows in _by_bucket(batches):
        if PARTIAL not in rows:
            continue
        contexts, which = np.unique(_column(rows[PARTIAL], 0, np.uint64), return_inverse=True)
        more = np.bincount(which, _column(rows[PARTIAL], 1, np.float64), len(contexts))
        known = rows.get(OFTEN, [])
        total, _ = Table(_column(known, 0, np.uint64), _column(known, 1, np.int64)).value(contexts)
        retained = (total >= LEAST) & _differs(total, total * np.log(PRIOR) + more)
        yield _pack([bucket], STATES, [contexts[retained].tobytes()], [total[retained].astype(np.int64).tobytes()])


@dataclass
class Counted:
    """The counts of a bucket's sequences: per sequence its key, context, count and parent's probability; the
    tokens after its context if that is retained, else 0."""

    key: np.ndarray
    context: np.ndarray
    suffix: np.ndarray
    n: np.ndarray
    p: np.ndarray
    total: np.ndarray

    @property
    def gain(self) -> np.ndarray:
        return np.log10(1 + self.n / (PRIOR * self.p))


@dataclass
class Known:
    """What of a level the executors need: the ``TOP`` most frequent retained contexts with the tokens after them, a bitmap
    of all if they are more, and the weight of a parent in the counts."""

    top: Table
    bitmap: np.ndarray | None
    scale: float


@dataclass
class Level:
    """Contexts of one length: packed counts of what follows them, and packed retained contexts."""

    size: int
    weighed: DataFrame
    retained: DataFrame
    known: Known


def _counted(level: Known, batch: pa.RecordBatch, retained: bool = False, rest: bool = False) -> Iterator[Counted]:
    """The counts in each packed row; ``retained``: after retained contexts only.

    What follows contexts that may be retained but are not broadcast comes from settled rows instead; ``rest``: just that.
    """
    for _, kind, heads, runs, p, contexts, both in zip(*(c.to_pylist() for c in batch.columns)):
        contexts, (which, n) = np.frombuffer(contexts, np.uint64), np.frombuffer(both, np.uint32).reshape(2, -1)
        if kind == SETTLED:
            contexts, total = contexts.reshape(2, -1)
            total = total.astype(np.int64)
            use = total > 0 if retained else np.ones(len(total), bool)
        else:
            total, found = level.top.value(contexts)
            other = np.zeros(len(contexts), bool)
            if level.bitmap is not None:
                other = ~found & _marked(level.bitmap, contexts)
            use = other if rest else found if retained else ~other
        at = np.flatnonzero(use[which])
        which, n = which[at], n[at].astype(np.int64)
        own = np.repeat(np.arange(len(heads) // 8), np.frombuffer(runs, np.uint32))[at]
        suffix, context = np.frombuffer(heads, np.uint64)[own], contexts[which]
        p = np.frombuffer(p, np.float64)[own] * level.scale
        yield Counted(_joined(context, suffix), context, suffix, n, p, total[which])


def _followed(known, needed, buckets: int):
    """The smoothed probabilities that the next level needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, bits = known.value, needed.value
        for batch in batches:
            for own in _counted(level, batch):
                use = np.flatnonzero(_marked(bits, own.key))
                key, n, p, total = own.key[use], own.n[use], own.p[use], own.total[use]
                smoothed = np.where(total > 0, (n + PRIOR * p) / (total + PRIOR), p)
                yield _dealt(buckets, PARENTS, _buckets(key, buckets), key, smoothed)

    return run


def _chosen(known, wanted):
    """(seq, gain, parent) of the wanted sequences: what they gain, and their smoothed probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, keys = known.value, wanted.value
        for batch in batches:
            for own in _counted(level, batch):
                use = np.flatnonzero((own.n >= LEAST) & keys.find(own.key)[1])
                n, p, total = own.n[use], own.p[use], own.total[use]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own.key[use].view(np.int64)),
                        pa.array(np.where(total > 0, own.gain[use], 0.0)),
                        pa.array(np.where(total > 0, (n + PRIOR * p) / (total + PRIOR), p)),
                    ],
                    ["seq", "gain", "parent"],
                )

    return run


def _gained(known, apart, buckets: int, half: int | None):
    """Values of what follows retained contexts, but for sequences whose values are broadcast; of all keys or one half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, table = known.value, apart.value
        for batch in batches:
            for own in _counted(level, batch, retained=True):
                use = np.arange(len(own.key)) if half is None else np.flatnonzero(_in_half(own.key, half))
                use = use[~table.find(own.key[use])[1]]
                yield _dealt(buckets, VALUES, _buckets(own.key[use], buckets), own.key[use], own.gain[use])

    return run


def _stated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values of retained contexts."""
    for batch in batches:
        bucket, keys, total = (c.to_pylist() for c in batch.columns)
        values = [np.log10(PRIOR / (np.frombuffer(x, np.int64) + PRIOR)).tobytes() for x in total]
        yield _pack(bucket, VALUES, keys, values)


def _in_half(keys: np.ndarray, half: int) -> np.ndarray:
    return keys & np.uint64(1) == np.uint64(half)


def _others(known, buckets: int):
    """Counts after contexts that may be retained but are not broadcast, dealt by context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = known.value
        for batch in batches:
            for own in _counted(level, batch, rest=True):
                yield _dealt_runs(buckets, WEIGHED, _buckets(own.context, buckets), own.context, own.suffix, own.n, own.p)

    return run


def _settle():
    """The same as packed counts that carry the tokens after each context, 0 if it is not retained."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            if not (pieces := rows.get(WEIGHED)):
                continue
            states = rows.get(STATES, [])
            table = Table(_column(states, 0, np.uint64), _column(states, 1, np.int64))
            context = np.repeat(_column(pieces, 0, np.uint64), _column(pieces, 1, np.uint32))
            contexts, which = np.unique(context, return_inverse=True)
            total = table.value(contexts)[0].astype(np.uint64)
            suffix, n, p = _column(pieces, 2, np.uint64), _column(pieces, 3, np.int64), _column(pieces, 4, np.float64)
            yield _pack(
                [bucket], SETTLED, [suffix.tobytes()], [np.ones(len(n), np.uint32).tobytes()], [p.tobytes()],
                [np.stack((contexts, total)).tobytes()], [np.stack((which, n)).astype(np.uint32).tobytes()],
            )

    return run


@dataclass
class SuffixTree:
    """Totals, and what is broadcast: frequent words with their counts and values as contexts, the value of the
    start, values of frequent sequences by length, and a bitmap of the retained contexts."""

    tokens: int
    words: int
    frequent: Table
    start: float
    values: dict[int, Table]
    bitmap: np.ndarray

    @property
    def total(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)  # of the smoothed word counts


class _Scratch:
    """Written tables that are deleted when no one reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = scratch(self.spark, f"tree-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _forget(broadcasts: list) -> None:
    """Remove what was broadcast from executors and driver; nothing reads it any more."""
    for value in broadcasts:
        value.destroy()


def _in_buckets(df: DataFrame, buckets: int) -> DataFrame:
    return df.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")


def _of_kind(df: DataFrame, *kinds: int) -> DataFrame:
    return df.where(F.col("kind").isin(*kinds))


def _parents(counts: DataFrame) -> DataFrame:
    """The smoothed counts of words as packed parents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, keys, n = (c.to_pylist() for c in batch.columns)
            yield _pack(bucket, PARENTS, keys, [(np.frombuffer(x, np.int64) + 0.5).tobytes() for x in n])

    return counts.select("bucket", "keys", "n").mapInArrow(run, PACKED)


def _top(packed: DataFrame, least: float = 1) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the most frequent packed sequences of at least a count, at most ``TOP``; ties are all in or out."""
    rows = packed.mapInArrow(_at_least(least), "seq long, n long")
    steps = rows.groupBy(F.floor(8 * F.log2("n")).alias("step")).count().orderBy(F.desc("step")).collect()
    number, bound = 0, None
    for row in steps:  # 8 for each doubling
        number += row["count"]
        if number > TOP:
            break
        bound = row["step"]
    if bound is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = rows.where(F.floor(8 * F.log2("n")) >= bound).toPandas()
    return found["seq"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)


def _tested(size: int, weighed: DataFrame, known: DataFrame, buckets: int, scale: float, tables: _Scratch) -> Level:
    """A level out of its counts and of packed totals of its contexts."""
    retained = tables.keep(
        _in_buckets(_of_kind(weighed, PARTIAL).union(known), buckets).mapInArrow(_test, PACKED), f"retained{size}"
    )
    number = retained.agg(F.sum(F.octet_length("a"))).first()[0] or 0
    known = Known(Table(*_top(retained.select("a", "b"))), None, scale)
    weighed = _of_kind(weighed, WEIGHED)
    if number // 8 > len(known.top.keys):
        known.bitmap = _bitmap(retained.select("a"))
        shared = weighed.sparkSession.sparkContext.broadcast(Known(known.top, known.bitmap, 1.0))
        others = weighed.mapInArrow(_others(shared, buckets), PACKED)
        settled = tables.keep(_in_buckets(others.union(retained), buckets).mapInArrow(_settle(), PACKED), f"settled{size}")
        weighed = weighed.union(settled)
        _forget([shared])
    return Level(size, weighed, retained, known)


def _of_key(key: np.uint64):
    """The count of one key among packed keys and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(n, np.int64)[np.frombuffer(keys, np.uint64) == key]
                yield pa.RecordBatch.from_arrays([pa.array(own)], ["n"])

    return run


def _among(wanted):
    """(seq, n) of the packed keys and counts that are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(*(c.to_pylist() for c in batch.columns)):
                keys, n = np.frombuffer(keys, np.uint64), np.frombuffer(n, np.int64)
                use = wanted.value.find(keys)[1]
                yield pa.RecordBatch.from_arrays([pa.array(keys[use].view(np.int64)), pa.array(n[use])], ["seq", "n"])

    return run


def _state_values(retained: DataFrame, wanted: Table) -> np.ndarray:
    """The values as contexts of at most some ``TOP`` sequences, in the order of the table; 0 if not retained."""
    shared = retained.sparkSession.sparkContext.broadcast(wanted)
    found = retained.select("a", "b").mapInArrow(_among(shared), "seq long, n long").toPandas()
    _forget([shared])
    keys, total = found["seq"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    return Table(keys, np.log10(PRIOR / (total + PRIOR))).value(wanted.keys)[0]


def fit_suffix_tree(
    texts: DataFrame, buckets: int, tables: _Scratch, depth: int = DEPTH
) -> tuple[SuffixTree, DataFrame, list[Level]]:
    """The tree of the texts in column ``text``, the written word counts, and the levels.

    What reaches the driver is frequent sequences and bitmaps.
    """
    spark = texts.sparkSession
    share = spark.sparkContext.broadcast
    counts = tables.keep(
        _in_buckets(texts.mapInArrow(_count_words(buckets), PACKED), buckets).mapInArrow(
            _sum_counts, "bucket long, keys binary, n binary, tokens long, words long"
        ),
        "counts",
    )
    tokens, distinct = counts.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))
    ).first()
    least = max(FREQUENT_SHARE * tokens, 1)
    top_keys, top_n = _top(counts.select("keys", "n"))
    hot = counts.select("keys", "n").mapInArrow(_at_least(least), "seq long, n long").toPandas()
    keys, n = hot["seq"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64)
    # A text has one start and one end.
    trained = counts.select("keys", "n").mapInArrow(_of_key(END), "n long").agg(F.sum("n")).first()[0] or 0
    frequent = Table(keys, n + 0.5)
    first = np.array([START])
    start = spark.createDataFrame(
        _dealt(buckets, OFTEN, _buckets(first, buckets), first, np.array([trained])).to_pandas().to_numpy(object).tolist(), PACKED
    )
    absent = [F.lit(None).cast("binary").alias(c) for c in "cde"]
    known = counts.select("bucket", F.lit(OFTEN).alias("kind"), F.col("keys").alias("a"), F.col("n").alias("b"), *absent)
    known = known.union(start)
    candidates = share(_bitmap(known.select("a", "b"), LEAST))
    tree = SuffixTree(tokens, distinct, Table(top_keys, top_n), 0.0, {}, np.zeros(0, np.uint8))
    parents, scale, levels, longer = _parents(counts), 1 / tree.total, [], None
    hot = share(frequent)
    grams = texts.mapInArrow(_count_grams([1], candidates, hot, buckets), PACKED)
    used = [candidates]
    for size in range(1, depth + 1):
        weighed = tables.keep(
            _in_buckets(parents.union(grams), buckets).mapInArrow(_weigh(size, hot, buckets, scale), PACKED), f"weighed{size}"
        )
        _forget([*used, hot])
        level = _tested(size, weighed, known, buckets, scale, tables)
        levels.append(level)
        known = _of_kind(weighed, OFTEN)
        often = known.select("a", "b")
        shared = share(level.known)
        # Frequent sequences: their values, and those whose suffixes' counts are dealt apart, with their probability.
        wanted = _top(often, LEAST)
        apart = often.mapInArrow(_at_least(max(least, LEAST)), "seq long, n long").toPandas()["seq"].to_numpy(np.int64).view(np.uint64)
        wanted = share(Table(np.union1d(wanted[0], apart)))
        found = level.weighed.mapInArrow(_chosen(shared, wanted), "seq long, gain double, parent double").toPandas()
        keys = found["seq"].to_numpy(np.int64).view(np.uint64)
        _forget([wanted])
        tree.values[size + 1] = Table(keys, found["gain"].to_numpy(np.float64))
        used = [shared]
        if size < depth:
            among = np.isin(keys, apart)
            hot = share(Table(keys[among], found["parent"].to_numpy(np.float64)[among]))
            if longer is None:
                # All longer contexts in one pass over the texts: they need nothing but the frequent pairs.
                candidates = share(_bitmap(often.select("a")))
                sizes = list(range(2, depth + 1))
                longer = tables.keep(texts.mapInArrow(_count_grams(sizes, candidates, hot, buckets), PACKED), "longer")
                _forget([candidates])
            grams = _of_kind(longer, GRAMS_OF + size + 1)
            needed = share(_bitmap(grams.select("a")))
            if size > 1:
                grams = grams.mapInArrow(_redealt(size + 1, hot, buckets), PACKED)
            parents = level.weighed.mapInArrow(_followed(shared, needed, buckets), PACKED)
            used.append(needed)
            scale = 1.0
    _forget(used)
    if longer is not None:
        tables.drop("longer")
    tree.frequent.columns.append(_state_values(levels[0].retained, tree.frequent))
    tree.start = float(_state_values(levels[0].retained, Table(first))[0])
    for level in levels[1:]:
        tree.values[level.size].columns[0] += _state_values(level.retained, tree.values[level.size])
    tree.bitmap = _bitmap(reduce(DataFrame.union, [level.retained.select("a") for level in levels]))
    return tree, counts, levels


def _redealt(size: int, frequent, buckets: int):
    """Counts whose suffix turned out to be frequent, dealt by the whole sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value
        for batch in batches:
            for _, _, *row in zip(*(c.to_pylist() for c in batch.columns)):
                suffix = np.repeat(np.frombuffer(row[0], np.uint64), np.frombuffer(row[1], np.uint32))
                context, n = np.frombuffer(row[2], np.uint64), np.frombuffer(row[3], np.uint32)
                own = _buckets(np.where(hot.find(suffix)[1], _joined(context, suffix), suffix), buckets)
                yield _dealt_runs(buckets, GRAMS_OF + size, own, suffix, context, n)

    return run


# Scores -------------------------------------------------------------------------------


def _post(tree, buckets: int, lengths: list[int], half: int):
    """Each text's sums over frequent sequences of some lengths, and its others, once each, by bucket; one half of the pairs."""

    def posted(kind: int, hashes: np.ndarray, doc: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        own = _buckets(hashes, buckets)
        # By bucket, text and the first bits of the hash, in one number; sequences that agree in them may come apart.
        place = own * len(ids) + doc
        shift = np.uint64(64 - int(buckets * len(ids)).bit_length())
        order = np.argsort((place.astype(np.uint64) << shift) | (hashes >> (np.uint64(64) - shift)))
        hashes, doc, own = hashes[order], doc[order], own[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        starts = np.flatnonzero(new)
        n = np.diff(np.append(starts, len(hashes))).astype(np.uint32)
        hashes, doc, own = hashes[starts], doc[starts], own[starts]
        bounds = np.searchsorted(own, np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(bounds))
        columns = [], [], [], []
        for b in used:
            part = slice(bounds[b], bounds[b + 1])
            runs = np.flatnonzero(np.diff(doc[part], prepend=-1))
            lengths = np.diff(np.append(runs, bounds[b + 1] - bounds[b])).astype(np.uint32)
            for column, packed in zip(columns, (hashes[part], ids[doc[part][runs]], lengths, n[part])):
                column.append(packed.tobytes())
        return _pack(used, kind, *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tree.value
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            doc, hashes = _sequences(batch.column(0), max(lengths))
            nothing = np.zeros(size)
            n_tokens = n_known = nothing.astype(np.int64)
            logc, context = nothing, nothing.copy()
            if 1 in lengths:
                real = hashes[0] != START
                tokens, own = hashes[0][real], doc[real]
                at, direct = model.frequent.find(tokens)
                count, state = (
                    np.where(direct, c[at] if len(c) else 0, 0) for c in model.frequent.columns
                )
                direct |= tokens == END
                sums = lambda x: np.bincount(own, x, size)
                n_tokens = np.bincount(own, minlength=size).astype(np.int64)
                n_known = sums(count > 0).astype(np.int64)
                logc = sums(np.where(direct, np.log10(count + 0.5), 0.0))
                context += sums(state) + model.start
                yield posted(WORDS, tokens[~direct], own[~direct], ids)
            for length in lengths:
                if length == 1:
                    continue
                # Of use if the context or the whole sequence, as a context, is retained.
                use = _inside(doc, length)
                if length == 2:
                    use &= _in_half(hashes[1][: len(use)], half)
                use &= _marked(model.bitmap, hashes[length - 2][: len(use)]) | _marked(model.bitmap, hashes[length - 1][: len(use)])
                use = np.flatnonzero(use)
                value, direct = model.values[length].value(hashes[length - 1][use])
                context += np.bincount(doc[use], value, size)
                use = use[~direct]
                yield posted(SEQUENCES, hashes[length - 1][use], doc[use], ids)
            copies = np.full(size, int(1 in lengths))
            yield _pack(
                [int(ids[0]) % buckets], HEADS, [ids.tobytes()], [n_tokens.tobytes()], [n_known.tobytes()],
                [np.stack((logc, context)).tobytes()], [copies.tobytes()],
            )

    return run


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n_tokens, n_known, logc, context, copies): the sums of each text over what each bucket has."""
    bucket, pieces, tables = None, {}, {}

    def found(kind: int, keys: np.ndarray) -> np.ndarray:
        if kind not in tables:
            own = pieces.pop(kind, [])
            table, which = np.unique(np.concatenate([k for k, _ in own] or [np.zeros(0, np.uint64)]), return_inverse=True)
            # A sequence has one value as a context and one as a context with its next word.
            tables[kind] = table, np.bincount(which, np.concatenate([v for _, v in own]), len(table)) if own else which
        table, values = tables[kind]
        if not len(table):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, values[at], 0.0)

    for batch in batches:
        for own, kind, a, b, c, d, e in zip(*(column.to_pylist() for column in batch.columns)):
            if own != bucket:
                bucket, pieces, tables = own, {}, {}
            if kind in (COUNTS, VALUES):
                values = np.frombuffer(b, np.int64 if kind == COUNTS else np.float64)
                pieces.setdefault(kind, []).append((np.frombuffer(a, np.uint64), values))
                continue
            if kind == HEADS:
                docs = np.frombuffer(a, np.int64)
                tokens, known = np.frombuffer(b, np.int64), np.frombuffer(c, np.int64)
                logc, context = np.frombuffer(d, np.float64).reshape(2, -1)
                copies = np.frombuffer(e, np.int64)
            else:
                keys, docs = np.frombuffer(a, np.uint64), np.frombuffer(b, np.int64)
                n = np.frombuffer(d, np.uint32).astype(np.int64)
                starts = np.append(0, np.cumsum(np.frombuffer(c, np.uint32))[:-1]).astype(np.int64)
                nothing = np.zeros(len(docs), np.int64)
                tokens = known = copies = nothing
                logc = nothing.astype(np.float64)
                if kind == WORDS:
                    count = found(COUNTS, keys)
                    known = np.add.reduceat(np.where(count > 0, n, 0), starts)
                    logc = np.add.reduceat(n * np.log10(count + 0.5), starts)
                context = np.add.reduceat(n * found(VALUES, keys), starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (docs, tokens, known, logc, context, copies)],
                ["key", "n_tokens", "n_known", "logc", "context", "copies"],
            )


SUMS = "key long, n_tokens long, n_known long, logc double, context double, copies long"


@contextmanager
def _short_shuffles(spark: SparkSession):
    """Files of a shuffle go when its query has been written, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def score_documents(
    docs: DataFrame, train: str, text: str = "text", doc_id: str = "doc_id", depth: int = DEPTH
) -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score): one row per row of ``docs``.

    ``train`` is a boolean SQL expression over ``docs``; rows where it is true are learned from
    (``trained``), and all are scored. A-Z are lower-cased, words split at ASCII white space, and
    each text is closed by an end token. ``base_score`` is the log10 probability under smoothed
    word counts, ``score`` under the suffix tree with contexts of up to ``depth`` words.

    Null text is empty: one end token. Null ids are scored like others. Repeated rows count
    once each in training and get equal scores. Without training rows everything is unknown. Other
    columns are not read; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.expr(train), F.lit(False)).alias("trained"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("doc_id", "text"))
    with _short_shuffles(spark):
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
        tables = _Scratch(spark)
        tree, counts, levels = fit_suffix_tree(texts.where("trained").select("text"), buckets, tables, depth)
        share = spark.sparkContext.broadcast
        shared, known = share(tree), [share(level.known) for level in levels]
        apart = {length: share(table) for length, table in tree.values.items()}
        absent = [F.lit(None).cast("binary").alias(c) for c in "cde"]
        counted = counts.select("bucket", F.lit(COUNTS).alias("kind"), F.col("keys").alias("a"), F.col("n").alias("b"), *absent)
        parts = []
        # Pairs are most of what is sent, triples come next.
        for lengths, half in [([3][: depth - 1], 0), ([2, *range(4, depth + 2)], 0), ([1, 2], 1)]:
            if not lengths:
                continue
            rows = [texts.select("text", "key").mapInArrow(_post(shared, buckets, lengths, half), PACKED)]
            for level, own in zip(levels, known):
                if level.size in lengths:
                    rows.append(level.retained.select("bucket", "a", "b").mapInArrow(_stated, PACKED))
                if level.size + 1 in lengths:
                    gained = _gained(own, apart[level.size + 1], buckets, half if level.size == 1 else None)
                    rows.append(level.weighed.mapInArrow(gained, PACKED))
            if 1 in lengths:
                rows.append(counted)
            sums = _in_buckets(reduce(DataFrame.union, rows), buckets).mapInArrow(_look_up, SUMS)
            sums = sums.groupBy("key").agg(*[F.sum(c).alias(c) for c in sums.columns[1:]])
            parts.append(written(sums, "sums"))
            for name in {"weighed2", "settled2", "retained3"} & set(tables.paths) if lengths == [3] else ():
                tables.drop(name)
        _forget([shared, *known, *apart.values()])
        for name in list(tables.paths):
            tables.drop(name)
    # Equal rows share a key and add up alike; their number is divided out again.
    sums = reduce(DataFrame.union, parts)
    sums = sums.groupBy("key").agg(*[F.sum(c).alias(c) for c in sums.columns[1:]])
    base = F.col("logc") - F.col("n_tokens") * float(np.log10(tree.total))
    scored = sums.select(
        "key",
        (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        (base / F.col("copies")).alias("base_score"),
        ((base + F.col("context")) / F.col("copies")).alias("score"),
    )
    return (
        texts.select("doc_id", "trained", "key")
        .join(scored, "key")
        .select(
            "doc_id", "trained", "n_tokens", "n_known", F.lit(tree.tokens).cast("long").alias("train_tokens"),
            "base_score", "score",
        )
    )
