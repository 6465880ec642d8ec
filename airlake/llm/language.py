"""Language identification with interpolated Kneser-Ney character models.

A bounded sample of labelled texts per language is counted by Spark into character n-grams up
to ``ORDER``. The driver turns the counts (bounded by the sample) into one model: sorted
hash arrays of n-grams, one per order, each with the interpolated Kneser-Ney log-probability of
its last character in every language, and the context weights for n-grams that no
language has. A text gets the language of the lowest cross-entropy per character. A second bounded
sample calibrates: the temperature of the score, and per language the cross-entropy above which a
text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from airlake.llm.common import byte_slices, prepare
from airlake.llm.wordspace import mix

ORDER = 4
DISCOUNT = 0.75
# Texts per language that are learned from, and that calibrate (about; chosen by a hash of the id).
# Whole texts are used.
SAMPLE_DOCS = 1500
CALIBRATION_DOCS = 500
# Rows that calibrate, below which a language rejects nothing.
LEAST_CALIBRATION = 50
# Share of calibration texts of a language that its rejection limit may reject, and the margin above.
REJECTED = 0.002
MARGIN = 1.15
UNKNOWN = "und"


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters and single blanks as code points, and the number per text.

    Runs of anything but letters become one blank; a text starts and ends with one.
    """
    parts, sizes = [], []
    for text in texts:
        raw = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        low = np.where(_letters(raw), raw, np.uint32(32))
        low = np.concatenate(([np.uint32(32)], low, [np.uint32(32)]))
        keep = np.ones(len(low), bool)
        keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
        parts.append(low[keep])
        sizes.append(len(parts[-1]))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.array(sizes, np.int64)


_letter_table: list[np.ndarray] = []


def _letters(codes: np.ndarray) -> np.ndarray:
    if not _letter_table:
        _letter_table.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _letter_table[0][codes]


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each position (positions before order - 1 are junk)."""
    h = np.full(len(codes), order, np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.roll(codes, back).astype(np.uint64)
        h = mix(h ^ shifted)
    return h


def _inside(sizes: np.ndarray, order: int) -> np.ndarray:
    """Positions whose last ``order`` characters lie in one text; the first blank is only context."""
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    offset = np.arange(len(first)) - first
    return offset >= max(order - 1, 1)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, order, gram, n): the n-grams of a batch, summed per language."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in sorted(set(langs)):
            texts = [t for t, own in zip(batch.column(1).to_pylist(), langs) if own == lang]
            codes, sizes = _codes(texts)
            for order in range(1, ORDER + 1):
                at = _inside(sizes, order)
                _, where, n = np.unique(_grams(codes, order)[at], return_index=True, return_counts=True)
                at = np.flatnonzero(at)[where]
                distinct = np.stack([codes[at - back] for back in range(order - 1, -1, -1)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(n), pa.string()),
                        pa.array([order] * len(n), pa.int32()),
                        pa.array(["".join(map(chr, w)) for w in distinct.tolist()], pa.string()),
                        pa.array(n, pa.int64()),
                    ],
                    ["lang", "order", "gram", "n"],
                )


class LanguageModel:
    """Sorted hash arrays per order with log2 probabilities (rows) of each language (columns)."""

    def __init__(self, langs: list[str], counts: dict[int, dict[str, np.ndarray]]):
        """``counts``: order -> n-gram -> occurrences per language."""
        self.langs = langs
        self.temperature, self.limits = 1.0, np.full(len(langs), np.inf)
        self.hashes: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.backoff: list[np.ndarray] = []
        width = len(langs)
        alphabet = len(counts.get(1, {})) + 1
        floor = np.full(width, 1.0 / alphabet)
        lower: dict[str, np.ndarray] = {}
        for order in range(1, ORDER + 1):
            grams = counts.get(order, {})
            # Below the highest order Kneser-Ney counts the different characters seen before.
            uses = {g: c.astype(float) for g, c in grams.items()}
            if order < ORDER:
                uses = {}
                for longer, c in counts.get(order + 1, {}).items():
                    uses.setdefault(longer[1:], np.zeros(width))
                    uses[longer[1:]] += c > 0
                # What starts a text has nothing before it; its own count stands in.
                for g, c in grams.items():
                    if g not in uses:
                        uses[g] = (c > 0).astype(float)
            total: dict[str, np.ndarray] = {}
            kinds: dict[str, np.ndarray] = {}
            for g, c in uses.items():
                total[g[:-1]] = total.get(g[:-1], 0) + c
                kinds[g[:-1]] = kinds.get(g[:-1], 0) + (c > 0)
            weight = {
                ctx: np.where(t > 0, DISCOUNT * kinds[ctx] / np.maximum(t, 1), 1.0) for ctx, t in total.items()
            }
            prob = {}
            for g, c in uses.items():
                ctx = g[:-1]
                below = lower.get(g[1:], floor) if order > 1 else floor
                seen = np.where(total[ctx] > 0, np.maximum(c - DISCOUNT, 0) / np.maximum(total[ctx], 1), 0.0)
                prob[g] = seen + weight[ctx] * below
            self._store(prob, weight)
            lower = prob
        self.floor = np.log2(floor).astype(np.float32)

    def _store(self, prob: dict[str, np.ndarray], weight: dict[str, np.ndarray]) -> None:
        for table, hashes, values in ((prob, self.hashes, self.logp), (weight, self.contexts, self.backoff)):
            keys = np.array([self._hash(k) for k in table], np.uint64)
            order = np.argsort(keys)
            hashes.append(keys[order])
            rows = np.array(list(table.values()), float).reshape(len(keys), len(self.langs))[order]
            values.append(np.log2(rows).astype(np.float32))

    @staticmethod
    def _hash(gram: str) -> int:
        if not gram:
            return 0
        return int(_grams(np.array([ord(c) for c in gram], np.uint32), len(gram))[-1])

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def _logp(self, window: np.ndarray) -> np.ndarray:
        """log2 probabilities of the last characters of distinct windows of one length."""
        order = window.shape[1]
        if order == 0:
            return np.zeros((0, len(self.langs)), np.float32)
        h = np.full(len(window), order, np.uint64)
        for column in window.T:
            h = mix(h ^ column.astype(np.uint64))
        at, hit = self._find(self.hashes[order - 1], h)
        out = np.empty((len(window), len(self.langs)), np.float32)
        out[hit] = self.logp[order - 1][at[hit]]
        rest = window[~hit]
        if len(rest):
            below = self._logp(rest[:, 1:]) if order > 1 else np.tile(self.floor, (len(rest), 1))
            ctx = np.full(len(rest), order - 1, np.uint64)
            for column in rest[:, :-1].T:
                ctx = mix(ctx ^ column.astype(np.uint64))
            if order == 1:
                ctx[:] = 0
            at, known = self._find(self.contexts[order - 1], ctx)
            below[known] += self.backoff[order - 1][at[known]]
            out[~hit] = below
        return out

    def cross_entropies(self, texts: list[str]) -> np.ndarray:
        """Bits per character of each text (rows) in each language; nan without letters."""
        codes, sizes = _codes(texts)
        total = np.zeros((len(texts), len(self.langs)))
        scored = np.zeros(len(texts))
        doc = np.repeat(np.arange(len(texts)), sizes)
        offset = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for order in range(2, ORDER + 1):
            at = np.flatnonzero((offset == order - 1) if order < ORDER else (offset >= ORDER - 1))
            if not len(at):
                continue
            # Each distinct window is looked up once, however often it occurs.
            keys = np.zeros(len(at), np.uint64)
            for back in range(order - 1, -1, -1):
                keys = mix(keys ^ codes[at - back].astype(np.uint64))
            _, where, which = np.unique(keys, return_index=True, return_inverse=True)
            windows = np.stack([codes[at[where] - back] for back in range(order - 1, -1, -1)], axis=1)
            logp = self._logp(windows)
            for lang in range(len(self.langs)):
                total[:, lang] += np.bincount(doc[at], logp[which, lang], len(texts))
            scored += np.bincount(doc[at], minlength=len(texts))
        has_letters = np.bincount(doc[codes != 32], minlength=len(texts)) > 0
        entropy = -total / np.maximum(scored, 1)[:, None]
        entropy[~has_letters] = np.nan
        return entropy

    def calibrate(self, entropies: np.ndarray, langs: np.ndarray) -> None:
        """Temperature by likelihood over a grid; rejection limits by a high quantile and a margin."""
        fit = np.isfinite(entropies).all(axis=1)
        entropies, langs = entropies[fit], langs[fit]
        if not len(langs):
            return
        own = np.arange(len(langs)), langs
        losses = []
        grid = [0.5, 1, 2, 4, 8, 16, 32]
        for t in grid:
            z = -t * entropies
            z -= z.max(axis=1, keepdims=True)
            losses.append(-(z[own] - np.log(np.exp(z).sum(axis=1))).mean())
        self.temperature = grid[int(np.argmin(losses))]
        for lang in range(len(self.langs)):
            values = entropies[langs == lang, lang]
            if len(values) >= LEAST_CALIBRATION:
                self.limits[lang] = np.quantile(values, 1 - REJECTED) * MARGIN

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and acceptance of each text."""
        if not self.langs:
            none = np.zeros(len(texts))
            return [UNKNOWN] * len(texts), none, none + np.nan, none > 0
        entropy = self.cross_entropies(texts)
        known = np.isfinite(entropy).all(axis=1)
        safe = np.where(known[:, None], entropy, 0.0)
        best = safe.argmin(axis=1)
        z = np.exp(-self.temperature * (safe - safe.min(axis=1, keepdims=True)))
        score = np.where(known, 1 / z.sum(axis=1), 0.0)
        low = safe.min(axis=1)
        accepted = known & (low <= self.limits[best])
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)], score, low, accepted


def _samples(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole texts that are learned from, and others that calibrate, by one hash of the id.

    A language that could not give ``LEAST_CALIBRATION`` rows of a quarter of its own is learned from whole.
    """
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {r["lang"]: r["n"] for r in sizes.collect()}  # one row per language
    part = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1_000_003)) / 1_000_003.0
    learn, hold = F.lit(False), F.lit(False)
    for lang, n in sizes.items():
        held = min(CALIBRATION_DOCS / n, 0.25) if n * 0.25 >= LEAST_CALIBRATION else 0.0
        own = F.col("lang") == lang
        learn = learn | (own & (part < min(SAMPLE_DOCS / n, 1 - held)))
        hold = hold | (own & (part >= 1 - held))
    return docs.where(learn).select("lang", "text"), docs.where(hold).select("lang", "text")


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> LanguageModel:
    """The model of a table of labelled texts, from bounded samples (``SAMPLE_DOCS`` per language).

    Rows with a null language, text or id teach nothing. No row both teaches and calibrates. What reaches the driver is bounded by the sample.
    """
    prepare(docs.sparkSession)
    labelled = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).where("doc_id is not null and lang is not null and text is not null")
    learned, held = _samples(labelled)
    counted = (
        learned.mapInArrow(_count_grams, "lang string, order int, gram string, n long")
        .groupBy("order", "gram", "lang")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(counted["lang"].unique())
    place = {name: i for i, name in enumerate(langs)}
    counts: dict[int, dict[str, np.ndarray]] = {order: {} for order in range(1, ORDER + 1)}
    for order, gram, name, n in counted.itertuples(index=False):
        row = counts[order].setdefault(gram, np.zeros(len(langs)))
        row[place[name]] = n
    model = LanguageModel(langs, counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            entropies = shared.value.cross_entropies(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(entropies), pa.list_(pa.float64()))], ["lang", "entropies"]
            )

    held = held.mapInArrow(score, "lang string, entropies array<double>").toPandas()
    held = held[held["lang"].isin(langs)]
    if len(held):
        model.calibrate(np.stack(held["entropies"].to_list()), held["lang"].map(place).to_numpy())
    return model


def predict_languages(docs: DataFrame, model: LanguageModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, accepted): one row per row of ``docs``, no shuffle.

    ``lang_pred`` is ``und``, with score 0 and not accepted, where the text is null or has no
    letter. Otherwise it is the best language, and ``accepted`` says whether the cross-entropy is
    within what texts of that language have. Only the text is used. Null ids, repeated rows and
    other columns change nothing; an empty table gives no rows; a model without languages
    answers ``und``.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, 1 << 20):
                langs, score, entropy, accepted = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(langs), pa.array(score), pa.array(entropy), pa.array(accepted)],
                    ["doc_id", "lang_pred", "score", "cross_entropy", "accepted"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, lang_pred string, score double, cross_entropy double, accepted boolean"
    )


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose language is accepted, all columns kept; decided row by row."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, at, 1 << 20):
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(shared.value.predict(texts)[3]))

    return docs.mapInArrow(run, docs.schema)


def learnable(doc_id: Column, lang: Column) -> Column:
    """Rows that the registered query learns from: crc32 of the id modulo 5 is not 0, labelled."""
    return lang.isNotNull() & (F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0)
