"""BPE encoding and decoding with a contiguous rank array per word.

A word's symbols start as its characters. Two parallel arrays hold the part boundaries and the
rank of each adjacent pair; the smallest rank is found by a scan (the leftmost among equals),
its inner boundary is deleted and the two neighbouring ranks are refreshed. For the short words
of real text that beats any heap. Words beyond ``SCAN_PARTS`` parts take a heap over linked
parts instead, with the same merges, so no text is quadratic.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from airlake.llm.common import prepare

SCAN_PARTS = 200
# Words a worker remembers; the memory is emptied when full, which changes no result.
CACHE_WORDS = 200_000
NO_PAIR = 1 << 60

_loaded: dict[str, WordBpe] = {}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = [""] * 256, 0x100
    for b in range(256):
        if b in printable:
            table[b] = chr(b)
        else:
            table[b], extra = chr(extra), extra + 1
    return table


class WordBpe:
    """Vocabulary, ranks and pre-tokenization of a ``word_bpe`` style tokenizer file.

    Read from the file: vocabulary, merges, word-end suffix, split pattern and special tokens. Its
    normalization (composed form, lower case, white space dropped) is what is implemented.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.pieces = [""] * size
        for piece, number in [*self.vocab.items(), *self.special.items()]:
            self.pieces[number] = piece
        # (left id, right id) -> (rank, merged id)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs[self.vocab[left], self.vocab[right]] = (rank, self.vocab[left + right])
        splitter = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(splitter)
        self.cuts = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        table = byte_characters()
        self.single = [self.vocab[c] for c in table]
        self.final = [self.vocab[c + self.suffix] for c in table]
        self.cache: dict[str, bytes] = {}

    def word_ids(self, word: str) -> list[int]:
        """Ids of one normalized word."""
        raw = word.encode("utf-8")
        ids = [self.single[b] for b in raw[:-1]]
        ids.append(self.final[raw[-1]])
        return self._scan(ids) if len(ids) <= SCAN_PARTS else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        get = self.pairs.get
        none = (NO_PAIR, -1)
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low is none:
                break
            i = ranks.index(low)
            ids[i] = low[1]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (found := get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the parts has changed since
            ids[i], ids[j] = merged, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return [x for x in ids if x >= 0]

    def _remember(self, word: str) -> bytes:
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        packed = np.array(self.word_ids(word), "<u4").tobytes()
        if len(word) < 64:
            self.cache[word] = packed
        return packed

    def _plain(self, text: str) -> list[bytes]:
        # Lower case is per character: a capital sigma has no special form at a word's end.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        cache, remember = self.cache, self._remember
        return [cache.get(w) or remember(w) for w in self.words.findall(text)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.cuts:
            return b"".join(self._plain(text))
        packed, first = [], 0
        for cut in self.cuts.finditer(text):
            packed += self._plain(text[first : cut.start()])
            packed.append(array("I", [self.special[cut[0]]]).tobytes())
            first = cut.end()
        packed += self._plain(text[first:] if first else text)
        return b"".join(packed)

    def decode(self, packed: bytes) -> str:
        """The pieces of the ids joined by a space, special ones included; word ends stay marked."""
        pieces = self.pieces
        return " ".join([pieces[i] for i in np.frombuffer(packed, "<u4").tolist()])


def tokenizer(path: str) -> WordBpe:
    """The tokenizer of a file, loaded once per worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _codec(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                packed = [bpe.encode(t) for t in texts[at : at + 500]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 500),
                        pa.array([len(p) // 4 for p in packed], pa.int64()),
                        pa.array(packed, pa.binary()),
                        pa.array([bpe.decode(p) for p in packed], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return run


def encode_decode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): one row per row of ``docs``, no shuffle.

    ``ids`` is binary, four little-endian bytes per token; ``decoded`` the text of decoding them.
    ``path`` names the tokenizer file, which executors must be able to read. Special strings in a text
    become their tokens; none are added. Null text counts as empty: no tokens. Null ids,
    repeated rows and other columns change nothing; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_codec(path), "doc_id long, n_tokens long, ids binary, decoded string")
