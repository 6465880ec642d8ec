"""Quality rules with risk-controlled thresholds.

Each rule is a score of a text, higher being worse, on a grid of ``STEPS`` steps. Labelled
good documents that pass the base rules are the holdout. In each stratum (language) all rules share one
cutoff: steps become severities, by how rare they are among the good texts of the other
strata and, beyond all of these, by how far beyond, and a document is as severe as its worst rule. Severities
are tested from the highest down: "rejecting from here on loses more than ``RISK`` of good documents" must
be refuted by the exact binomial tail at level ``ERROR / strata`` (the order is fixed without the
stratum's own holdout, and testing stops at the first failure, so that only the strata need a correction).
So with probability ``1 - ERROR`` at most ``RISK`` of good documents are rejected in any
stratum. Equal texts are one label of their stratum, since copies say nothing new. Only strata with enough labels
for any cutoff (:func:`least_labels`) are tested and counted; the others reject nothing. A stratum beside which the
others have fewer than ``LEAST_REFERENCE`` good texts takes a half of its own holdout for the severities, by a hash
of the text, and the other half for the test.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from airlake.llm.common import lookup_join, prepare, written

RISK = 0.02
ERROR = 0.05
STEPS = 400
# Good texts of other strata, below which a stratum's severities come from a half of its own.
LEAST_REFERENCE = 150
RULES = ("symbols", "marks", "dup_lines", "repeats", "one_word")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_MARK = re.compile(r"[^\w\s]")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(text: str) -> tuple[dict[str, int], dict[str, float]]:
    """Base counts and rule scores (0 to 1) of one text."""
    words = _WORD.findall(text)
    n = len(words)
    chars = sum(map(len, words))
    seen, lines, dup = set(), 0, 0
    for line in text.split("\n"):
        if _WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    triples = list(zip(words, words[1:], words[2:]))
    uses = Counter(triples)
    repeated, until = 0, 0
    if len(uses) < len(triples):
        for i, triple in enumerate(triples):
            if uses[triple] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    symbols = len(_SYMBOL.findall(text))
    base = dict(zip(BASE, (n, chars, symbols, dup, repeated)))
    if not n:
        return base, dict.fromkeys(RULES, 0.0)
    scores = {
        "symbols": symbols / chars,
        "marks": len(_MARK.findall(text)) / chars,
        "dup_lines": dup / lines if lines else 0.0,
        "repeats": repeated / n,
        "one_word": max(Counter(words).values()) / n,
    }
    return base, scores


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measures(t) for t in batch.column(3).to_pylist()]
        # Steps of the grid; a score beyond the last step counts as the last.
        steps = [[min(STEPS, int(s[r] * STEPS)) for r in RULES] for _, s in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2)]
            + [pa.array([b[name] for b, _ in rows], pa.int64()) for name in BASE]
            + [pa.array(steps, pa.list_(pa.int32()))],
            ["doc_id", "stratum", "content", *BASE, "steps"],
        )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial variable, summed in logarithms."""
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def least_labels(strata: int, risk: float = RISK, error: float = ERROR) -> int:
    """Good labels, none of them rejected, that a stratum needs for a cutoff."""
    return math.ceil(math.log(error / strata) / math.log1p(-risk))


def tested_strata(sizes: list[int], risk: float, error: float) -> int:
    """How many of the strata, by falling number of good labels, can be tested together."""
    sizes = sorted(sizes, reverse=True)
    return max((m for m, n in enumerate(sizes, 1) if n >= least_labels(m, risk, error)), default=0)


def _select(level: float, risk: float, steps: int = STEPS):
    """The strictest cutoff of one (stratum, rule): documents with step >= cutoff are rejected."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(frame["step"], frame["good"]))
        n, rejected, cutoff = int(frame["good"].sum()), 0, steps + 1
        for step in range(steps, 0, -1):
            rejected += int(counts.get(step, 0))
            if rejected > n * risk or binomial_tail(rejected, n, risk) > level:
                break
            cutoff = step
        return pd.DataFrame(
            {"stratum": [frame["stratum"].iloc[0]], "rule": [frame["rule"].iloc[0]], "cutoff": [cutoff]}
        )

    return run


def severities(reference: np.ndarray) -> np.ndarray:
    """Severity (0 to 2 * STEPS) of each rule (rows) and step, from the reference's documents at each.

    Up to the highest step in the reference, the share of its documents below; beyond, the distance.
    """
    steps, out = np.arange(STEPS + 1), []
    for counts in reference:
        n = counts.sum()
        top = np.flatnonzero(counts).max(initial=0)
        below = (np.cumsum(counts) - counts) * STEPS // max(n, 1)
        beyond = STEPS + np.ceil(STEPS * (steps - top) / max(STEPS - top, 1))
        out.append(np.where(steps <= top, below, beyond))
    return np.array(out, np.int64)


def _severities(totals: np.ndarray):
    """Of one stratum: from the totals of all strata without its own texts, or from its own half."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros((len(RULES), STEPS + 1), np.int64)
        own[frame["rule"], frame["step"]] = frame["good"]
        table = severities(own if frame["alone"].iloc[0] else totals - own)
        return pd.DataFrame({"stratum": [frame["stratum"].iloc[0]], "severities": [table.tolist()]})

    return run


def _rule_cutoffs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first step of each rule with the severity of the cutoff; beyond the grid if there is none."""
    for frame in frames:
        cutoffs = []
        for table, cutoff in zip(frame["severities"], frame["cutoff"]):
            reached = np.array([list(rule) for rule in table]) >= cutoff
            cutoffs.append(np.where(reached.any(axis=1), reached.argmax(axis=1), STEPS + 1).tolist())
        yield pd.DataFrame({"stratum": frame["stratum"], "cutoffs": cutoffs})


def risk_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, cutoffs): a cutoff per rule for every stratum that has enough good labels.

    ``measured`` as made here; ``labels`` has doc_id and quality (1 is good; null labels are none).
    What reaches the driver is label numbers of strata and the grid's totals.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    # Copies of a text have its measures; they are one label, reduced before the shuffle.
    held = written(
        measured.where("not base_failed")
        .join(good, "doc_id")
        .groupBy("stratum", "content")
        .agg(F.min("steps").alias("steps"))
        .withColumn("half", F.pmod(F.xxhash64("content"), F.lit(2)) == 1),
        "holdout",
    )
    all_good = held.count()
    shares = held.groupBy(F.col("stratum").alias("__stratum")).agg(
        (F.lit(all_good) - F.count("*") < LEAST_REFERENCE).alias("alone")
    )
    held = lookup_join(held, written(shares, "shares"), F.col("stratum") == F.col("__stratum")).drop("__stratum")
    holdout = held.where("not alone or not half")
    steps = held.select("stratum", "alone", "half", F.posexplode("steps").alias("rule", "step"))
    counts = written(
        steps.groupBy("stratum", "alone", "rule", "step").agg(
            F.count("*").alias("all"), F.count_if("half").alias("halved")
        ),
        "grid",
    )
    totals = np.zeros((len(RULES), STEPS + 1), np.int64)
    for row in counts.groupBy("rule", "step").agg(F.sum("all").alias("good")).collect():
        totals[row["rule"], row["step"]] = row["good"]
    own = counts.select("stratum", "alone", "rule", "step", F.when(F.col("alone"), F.col("halved")).otherwise(F.col("all")).alias("good"))
    tables = own.groupBy("stratum").applyInPandas(_severities(totals), "stratum string, severities array<array<int>>")
    tables = written(tables, "severities")
    sizes = written(holdout.groupBy("stratum").agg(F.count("*").alias("n")), "sizes")
    enough = sizes.where(F.col("n") >= least_labels(1, risk, error)).select("n").collect()
    tested = tested_strata([row["n"] for row in enough], risk, error)
    sizes = sizes.where(F.col("n") >= least_labels(max(tested, 1), risk, error)).select(F.col("stratum").alias("__stratum"))
    chosen = lookup_join(holdout, sizes, F.col("stratum") == F.col("__stratum"), "left_semi")
    of_rule = F.zip_with("__severities", "steps", lambda table, step: F.get(table, step))
    looked = tables.select(F.col("stratum").alias("__stratum"), F.col("severities").alias("__severities"))
    cutoffs = (
        lookup_join(chosen, looked, F.col("stratum") == F.col("__stratum"))
        .groupBy("stratum", F.lit(0).alias("rule"), F.array_max(of_rule).alias("step"))
        .agg(F.count("*").alias("good"))
        .groupBy("stratum", "rule")
        .applyInPandas(_select(error / max(tested, 1), risk, 2 * STEPS), "stratum string, rule int, cutoff int")
    )
    return tables.join(cutoffs, "stratum").select("stratum", "severities", "cutoff").mapInPandas(
        _rule_cutoffs, "stratum string, cutoffs array<int>"
    )


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    risk: float = RISK,
    error: float = ERROR,
    text: str = "text",
    doc_id: str = "doc_id",
    stratum: str = "lang",
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rules).

    One row per row of ``docs``. A text with under 50 words, or more than half of its words in
    repeated 3-word windows, fails the base rules; others are rejected by the rules whose
    cutoff in their stratum they reach (``failed_rules``).

    Null text: no words, so it fails. A null stratum is a stratum of its own; a null id has no label;
    repeated rows and copies of a text are judged alike and are one label (64 bits of the text's hash); a
    document with several labels is good if any says so. Without labels nothing but the base rules rejects. Other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(stratum)), F.lit("null")).alias("stratum"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("content"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    schema = "doc_id long, stratum string, content long, " + ", ".join(f"{b} long" for b in BASE) + ", steps array<int>"
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = written(rows.mapInArrow(_measure, schema).withColumn("base_failed", failed), "measures")
    cutoffs = written(risk_cutoffs(measured, labels, risk, error), "cutoffs")
    cutoffs = cutoffs.select(F.col("stratum").alias("__stratum"), "cutoffs")
    judged = lookup_join(measured, cutoffs, F.col("stratum") == F.col("__stratum"), "left")
    names = F.array(*[F.lit(r) for r in RULES])
    reached = F.zip_with(
        F.zip_with("steps", "cutoffs", lambda step, cutoff: step >= cutoff), names,
        lambda hit, name: F.when(hit, name),
    )
    rules = F.coalesce(F.array_compact(reached), F.array().cast("array<string>"))
    return judged.withColumn("failed_rules", rules).select(
        "doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules"
    )
