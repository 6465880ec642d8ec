"""Token counts: batch encoding in an Arrow function that returns lengths only.

Texts are cut at places that no token crosses, so a long text never makes a batch much larger than the
others. Most of the pieces between such places are words that come again and again: a worker remembers the length
of short ones in a bounded memory, and only those that it does not know go to the library, in batches of about
equal bytes. The lengths of a text's pieces are added up.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from airlake.llm.common import prepare

BATCH_BYTES = 1 << 18
PART_CHARS = 1 << 16
# Pieces that a worker remembers, and their longest; the memory is emptied when full, which changes no result.
HELD_PIECES = 400_000
HELD_CHARS = 48
# A space or line feed with no white space on either side: the pattern of byte-level BPE always begins a piece
# there, whatever the script.
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)")

_loaded: dict[str, object] = {}


def split_text(text: str, size: int = PART_CHARS) -> list[str]:
    """Parts of at least ``size`` characters whose tokens together are those of the text.

    A stretch without a safe boundary stays whole.
    """
    parts, first = [], 0
    while len(text) - first > size and (at := _BOUNDARY.search(text, first + max(size, 1))):
        parts.append(text[first : at.start()])
        first = at.start()
    return [*parts, text[first:]]


def cut_words(text: str) -> list[str]:
    """The text cut at every safe boundary."""
    return _BOUNDARY.split(text)


def _is_word(piece: str) -> bool:
    """One word, with the space before it if it has one: what stands alone between safe boundaries."""
    word = piece[1:] if piece[:1] == " " else piece
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


class JsonCounter:
    """Lengths from a ``tokenizers`` file.

    Texts are cut if the file's pre-tokenization is byte-level without an added space, nothing normalizes
    the text, and no special token takes white space; else they stay whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        before = data["pre_tokenizer"] or {}
        self.cuts = (
            data["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in data["added_tokens"])
        )
        self.held: dict[str, int] = {}
        # A line feed between words is a piece of its own.
        self.line_feed = self.lengths(["a\nb"])[0] - self.lengths(["a", "b"])[0] - self.lengths(["a", "b"])[1]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def split(self, text: str) -> list[str]:
        return split_text(text) if self.cuts else [text]

    def count(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            return _batched(self, texts)
        counts, open_texts, unknown = [0] * len(texts), [], {}
        get = self.held.get
        for i, text in enumerate(texts):
            # Each space stays with the word after it; line feeds are counted apart.
            pieces = text.replace(" ", "\n ").split("\n")
            known = list(map(get, pieces))
            if None not in known:
                counts[i] = sum(known) + text.count("\n") * self.line_feed
                continue
            feeds = text.count("\n")
            if not all(_is_word(p) for p, n in zip(pieces, known) if n is None):
                pieces, feeds = cut_words(text), 0  # white space that is not one character between words
                known = list(map(get, pieces))
            counts[i] = sum(n for n in known if n is not None) + feeds * self.line_feed
            missing = [p for p, n in zip(pieces, known) if n is None]
            unknown.update(dict.fromkeys(missing))
            open_texts.append((i, missing))
        if unknown:
            pieces = list(unknown)
            found = dict(zip(pieces, _batched(self, pieces)))
            for i, missing in open_texts:
                counts[i] += sum(map(found.__getitem__, missing))
            if len(self.held) + len(found) > HELD_PIECES:
                self.held.clear()
            self.held.update((p, n) for p, n in found.items() if len(p) <= HELD_CHARS and _is_word(p))
        return counts


class PieceCounter:
    """Lengths from a ``sentencepiece`` file. Its white space is part of pieces: texts stay whole."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def split(self, text: str) -> list[str]:
        return [text]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.processor.encode(texts, num_threads=1)]

    def count(self, texts: list[str]) -> list[int]:
        return _batched(self, texts)


def counter(path: str):
    """The counter of a tokenizer file, loaded once per worker."""
    if path not in _loaded:
        _loaded[path] = PieceCounter(path) if path.endswith(".model") else JsonCounter(path)
    return _loaded[path]


def _batched(tool, texts: list[str]) -> list[int]:
    """Lengths from the library, in batches of about equal bytes."""
    counts, held, owners, size = [0] * len(texts), [], [], 0

    def flush():
        for owner, length in zip(owners, tool.lengths(held)):
            counts[owner] += length

    for i, text in enumerate(texts):
        for part in tool.split(text):
            more = len(part) if part.isascii() else len(part.encode())
            if held and size + more > BATCH_BYTES:
                flush()
                held, owners, size = [], [], 0
            held.append(part)
            owners.append(i)
            size += more
    if held:
        flush()
    return counts


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.cast(pc.binary_length(texts), pa.int64()),
                    pa.array(counter(path).count(texts.to_pylist()), pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): one row per row of ``docs``, no shuffle.

    ``path`` is a tokenizer file that executors can read: byte-level ``.json`` or ``.model``.
    No special tokens are added; special strings inside texts are what the library makes of
    them by default. Null text counts as empty. Null ids, repeated rows and other columns
    change nothing; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = rows.mapInArrow(_count(path), "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
