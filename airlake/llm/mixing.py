"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Each source's repetition rate is its target share of the output divided by what it has. A
document's count is the Poisson quantile of a uniform number taken from a hash of its id, so
that counts repeat on every run and machine. A rate above ``MAX_RATE`` is a sum of draws of that rate, each
with its own hash, and one of the rest, since a sum of Poisson numbers is one. Documents are exploded by their count and ordered by
a hash of id and copy, which is a global shuffle with balanced ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from airlake.llm.common import lookup_join, prepare, quoted, written

TEMPERATURE = 0.5
# Highest rate of one draw; a source that needs more gets several.
MAX_RATE = 20.0


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_table(rate: Column) -> Column:
    """Cumulative probabilities P(X <= 0), P(X <= 1), ... of a Poisson variable.

    Long enough that the rest is below 1e-16 for every rate up to ``MAX_RATE``.
    """
    zero = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))
    ks = F.sequence(F.lit(1), F.lit(int(MAX_RATE * 5) + 20))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(
            p.alias("p"), F.concat(state["cdf"], F.array(F.element_at(state["cdf"], -1) + p)).alias("cdf")
        )

    return F.aggregate(ks, zero, step)["cdf"]


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None, scale: float, text: str, source: str) -> DataFrame:
    """(source, draws, full, cdf): ``draws`` of ``MAX_RATE`` (table ``full``), and the table of the rest of the rate.

    Without ``weights`` a source's weight is the square root of its size. Weights are of
    the sources named; a source without a weight has rate 0.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.length(text), F.lit(0))).cast("double").alias("chars"), F.count("*").alias("n_docs")
    )
    if weights is None:
        weight = F.pow("chars", F.lit(TEMPERATURE))
    else:
        pairs = [F.when(F.col("source") == name, F.lit(float(w))) for name, w in weights.items()]
        weight = F.coalesce(*pairs, F.lit(0.0))
    sizes = written(sizes.withColumn("weight", weight), "sizes")
    weights_sum, all_chars = sizes.agg(F.sum("weight"), F.sum("chars")).first()
    # A source without characters repeats as it is.
    rate = F.lit(1.0)
    if weights_sum:
        share = F.col("weight") / F.lit(weights_sum) * F.lit(all_chars) * F.lit(scale)
        rate = F.when(F.col("chars") > 0, share / F.col("chars")).otherwise(rate)
    elif all_chars:  # no source with characters has a weight
        rate = F.when(F.col("chars") > 0, F.lit(0.0)).otherwise(rate)
    # The rest is above 0 and at most MAX_RATE, so that rates up to it take one draw.
    draws = F.greatest(F.ceil(F.col("rate") / MAX_RATE) - 1, F.lit(0)).cast("int")
    rates = sizes.select("source", rate.alias("rate")).withColumn("draws", draws)
    full = F.when(F.col("draws") > 0, poisson_table(F.lit(MAX_RATE)))
    rest = poisson_table(F.col("rate") - F.col("draws") * MAX_RATE)
    return written(rates.select("source", "draws", full.alias("full"), rest.alias("cdf")), "rates")


def replicated(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    scale: float = 1.0,
    seed: str = "mix",
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """(row, copy, shuffle_key): each row of ``docs`` as a struct, once per copy, in the order of ``shuffle_key``.

    The struct keeps columns of any name apart from those of the operator.
    """
    prepare(docs.sparkSession)
    rates = repetition_rates(docs, weights, scale, text, source).withColumnRenamed("source", "rate_of")
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"), F.col(source).alias("source"), key.alias("key"))

    def drawn(cdf: Column, u: Column) -> Column:
        return F.size(F.filter(cdf, lambda c: c <= u))

    further = F.aggregate(
        F.sequence(F.lit(1), F.col("draws")),
        F.lit(0),
        lambda n, k: n + drawn(F.col("full"), uniform(F.concat(F.lit("draw "), k.cast("string"), F.lit(":"), F.col("key")))),
    )
    rows = lookup_join(rows.withColumn("u", uniform(F.col("key"))), rates, F.col("source").eqNullSafe(F.col("rate_of")))
    count = drawn(F.col("cdf"), F.col("u")) + F.when(F.col("draws") > 0, further).otherwise(0)
    copies = rows.withColumn("n", count).where("n > 0").select(
        "row", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")
    )
    spread = F.md5(F.concat("key", F.lit(":"), F.col("copy").cast("string")).cast("binary"))
    return copies.select("row", "copy", spread.alias("shuffle_key")).orderBy("shuffle_key")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, scale: float = 1.0, **names) -> DataFrame:
    """``docs`` replicated to the target weights, with ``copy`` (1, 2, ...) and ``shuffle_key``.

    Rows come in the global order of ``shuffle_key``. ``scale`` is the size of the output in
    characters relative to the input; shares are met in expectation. ``names`` are those of :func:`replicated`. A null
    source is a source of its own; a null id hashes like an empty one. Null texts count no characters. Repeated
    rows repeat alike. Input columns named ``copy`` or ``shuffle_key`` are replaced; :func:`replicate` keeps
    them. An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    mixed = replicated(docs, weights, scale, **names)
    return mixed.select(*[F.col("row")[c].alias(c) for c in kept], "copy", "shuffle_key")


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, scale: float = 1.0, **names) -> DataFrame:
    """The rows of :func:`mix_sources` with the columns of ``docs`` alone, whatever they are called."""
    mixed = replicated(docs, weights, scale, **names)
    return mixed.select(*[F.col("row")[c].alias(c) for c in docs.columns])


# The same in DuckDB: default weights, the seed "mix" and a scale of 1.
MIX_SQL = f"""
with sizes as (
  select source, sum(coalesce(length(text), 0))::double as chars
  from {{table}} group by source
), totals as (
  select sum(sqrt(chars)) as weights, sum(chars) as all_chars from sizes
), rates as (
  select source, case when weights > 0 and chars > 0 then sqrt(chars) / weights * all_chars / chars else 1.0 end as rate
  from sizes, totals
), parts as (
  select source, greatest(ceil(rate / {MAX_RATE}) - 1, 0)::int as draws,
    rate - greatest(ceil(rate / {MAX_RATE}) - 1, 0) * {MAX_RATE} as rest
  from rates
), means as (
  select distinct rest as mean from parts union select {MAX_RATE}
), steps as (
  select mean, k, sum(exp(-mean) * pow(mean, k) / gamma(k + 1)) over (partition by mean order by k) as c
  from means, range(0, {int(MAX_RATE * 5) + 21}) as r(k)
), cdf as (
  select mean, list(c order by k) as cdf from steps group by mean
), keyed as (
  select d as row, 'mix:' || coalesce(d.doc_id::varchar, '') as key, draws, own.cdf as own, whole.cdf as whole
  from {{table}} d join parts on parts.source is not distinct from d.source
    join cdf own on own.mean = parts.rest join cdf whole on whole.mean = {MAX_RATE}
), counted as (
  select row, key, list_sum(list_transform(range(0, draws + 1), lambda k: len(list_filter(
    case when k = 0 then own else whole end,
    lambda c: c <= ('0x' || substr(md5(case when k = 0 then key else 'draw ' || k || ':' || key end), 1, 13))::bigint
      / 4503599627370496.0))))::int as n
  from keyed
), copies as (
  select row, key, unnest(range(1, n + 1))::int as copy from counted
)
select row.*, copy, md5(key || ':' || copy::varchar) as shuffle_key from copies
"""
