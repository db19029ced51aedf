"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate: its target share of the corpus'
characters over its present one. Every document draws its number of copies by
inverting the Poisson distribution of that rate at a uniform number hashed
from its id, so a draw depends on nothing but the document, the seed and the
rate. Copies are exploded, then dealt out and ordered by a second hash.

Defined results: a row without doc_id draws from a hash of its text; rows that
share a doc_id draw the same count; a null source is a source of its own; null
text counts 0 characters and a source without characters gets the rate
``scale``; a source missing from given weights has the weight 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_name

BROADCAST_ENTRIES = 500_000  # distribution entries (8 bytes each) up to which the rates are broadcast


def source_rates(docs: DataFrame, weights: dict[str, float] | None, temperature: float, scale: float) -> DataFrame:
    """``source_, rate, chars`` per source. Without weights a source's weight is chars ** temperature."""
    sizes = cut(docs.groupBy(docs["source"].cast("string").alias("source_")).agg(
        F.sum(F.coalesce(F.length(docs["text"]), F.lit(0))).cast("double").alias("chars")))
    if weights is None:
        weight = F.pow("chars", F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source_") == name, F.lit(float(value))).otherwise(weight)
    weight = F.when(F.col("chars") > 0, weight).otherwise(F.lit(0.0))
    total = sizes.agg(F.sum("chars").alias("chars"), F.sum(weight).alias("weight")).first()  # one row
    if not total["weight"]:
        return sizes.select("source_", F.lit(float(scale)).alias("rate"), "chars")
    rate = F.when(F.col("chars") > 0, scale * weight / total["weight"] * total["chars"] / F.col("chars"))
    return sizes.select("source_", rate.otherwise(F.lit(float(scale))).alias("rate"), "chars")


def poisson_steps(rates: DataFrame) -> DataFrame:
    """``source_, steps``: the distribution function at 0, 1, 2, ... until its tail is below 1e-12 or so."""
    most = F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 20).cast("int")
    by = Window.partitionBy("source_").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    logs = F.sum(F.when(F.col("k") > 0, F.log("k")).otherwise(F.lit(0.0))).over(by)
    rows = rates.where("rate > 0").select("source_", "rate", F.explode(F.sequence(F.lit(0), most)).alias("k")).withColumn(
        "p", F.exp(F.col("k") * F.log("rate") - F.col("rate") - logs)).withColumn("cdf", F.sum("p").over(by))
    return rows.groupBy("source_").agg(F.sort_array(F.collect_list("cdf")).alias("steps"))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("double")
    return bits / F.lit(float(1 << 52))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5,
                scale: float = 1.0, seed: int = 11) -> DataFrame:
    """The rows of ``docs``, each as often as drawn, in random order; ``copy_no_`` numbers the copies from 1.

    Where ``docs`` has that column, more underscores follow in the new one's name.
    """
    numbered = free_name(docs, "copy_no_")
    steps = cut(poisson_steps(source_rates(docs, weights, temperature, scale)))
    entries = steps.agg(F.sum(F.size("steps"))).first()[0] or 0  # one row
    if entries <= BROADCAST_ENTRIES:
        steps = F.broadcast(steps)
    key = F.coalesce(docs["doc_id"].cast("string"), F.md5(F.coalesce(docs["text"].cast("string"), F.lit(""))))
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row_"), key.alias("key_"),
                         docs["source"].cast("string").alias("from_"))
    drawn = packed.join(steps, F.col("from_").eqNullSafe(F.col("source_"))).withColumn("u_", uniform(F.col("key_"), seed))
    drawn = drawn.withColumn("copies_", F.size(F.filter("steps", lambda c: c <= F.col("u_")))).where("copies_ > 0").select(
        "row_", "key_", F.explode(F.sequence(F.lit(1), F.col("copies_"))).alias("copy_no_"))
    shuffled = drawn.withColumn("place_", F.xxhash64(F.lit(seed), "key_", "copy_no_")).repartition(
        "place_").sortWithinPartitions("place_")
    return shuffled.select("row_.*", F.col("copy_no_").alias(numbered))


ORACLE = """
WITH sizes AS (SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS chars FROM documents GROUP BY source),
total AS (SELECT sum(chars) AS chars, sum(sqrt(chars)) AS weight FROM sizes),
rates AS (SELECT source, CASE WHEN sizes.chars > 0
  THEN sqrt(sizes.chars) / total.weight * total.chars / sizes.chars ELSE 1.0 END AS rate FROM sizes, total),
ks AS (SELECT source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::INT + 1)) AS k FROM rates),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM (SELECT source, k, exp(k * ln(rate) - rate - sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END)
    OVER (PARTITION BY source ORDER BY k)) AS p FROM ks)),
draws AS (SELECT *, (('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT)::DOUBLE
  / 4503599627370496.0 AS u FROM documents),
counts AS (SELECT d.doc_id, d.u, count(*) FILTER (WHERE s.cdf <= d.u) AS copies
  FROM draws d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source GROUP BY d.doc_id, d.u)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, unnest(range(1, c.copies + 1))::INT AS copy_no
FROM documents d JOIN counts c ON c.doc_id = d.doc_id WHERE c.copies > 0
"""
