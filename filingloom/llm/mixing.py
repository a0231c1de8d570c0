"""Mixing sources to target weights by Poisson replication, in built-in expressions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import documents, free_name

MAX_RATE = 64.0  # a larger mean is drawn as the sum of several draws
MAX_BROADCAST_SOURCES = 5_000  # a source's thresholds take less than 2 KB
_TAIL = 160  # beyond this count a draw with mean MAX_RATE has a probability under 1e-20


def _hash(seed: int, *parts: Column) -> Column:
    """52 bits of a hash, as a whole number; the same in any engine that has md5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def _thresholds(rate: Column) -> Column:
    """The distribution function of a Poisson variable at 0, 1, 2 ..., scaled to 2**52, up to where it no longer grows."""
    step = lambda acc, k: F.struct(
        (acc["p"] * rate / k).alias("p"), (acc["c"] + acc["p"] * rate / k).alias("c"), F.array_append(acc["all"], acc["c"] + acc["p"] * rate / k).alias("all"))
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))
    far = F.least(F.lit(_TAIL), F.ceil(rate * 2 + 40).cast("int"))
    return F.aggregate(F.sequence(F.lit(1), far), start, step, lambda acc: F.transform(acc["all"], lambda c: F.floor(c * F.lit(float(2**52))).cast("bigint")))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None, default_weight: float, budget: float | None,
                 source_col: str, text_col: str) -> DataFrame:
    """Per source the mean number of copies of its documents that brings its share of characters to its weight."""
    weight = F.lit(default_weight)
    if weights:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        weight = F.coalesce(F.try_element_at(table, F.col("src")), weight)
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("src")).agg(F.sum(F.coalesce(F.length(text_col), F.lit(0))).cast("double").alias("size"))
    sizes = sizes.withColumn("w", F.when(F.col("size") > 0, weight).otherwise(0.0))
    totals = sizes.agg(F.sum("w").alias("all_w"), F.sum("size").alias("all_size")).first()
    all_w, total = totals.all_w or 1.0, budget if budget is not None else totals.all_size or 0.0
    rate = F.when(F.col("size") > 0, F.col("w") * F.lit(total) / F.lit(all_w) / F.col("size")).otherwise(1.0)
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_RATE)).cast("int")
    return sizes.select("src", rate.alias("rate")).withColumn("draws", draws).withColumn("thresholds", _thresholds(F.col("rate") / F.col("draws")))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, default_weight: float = 1.0, budget: float | None = None, seed: int = 17,
                source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str, str]:
    """Each document as often as a Poisson draw says, in one global random order; returns the frame, and the names of the
    columns with the copy's number (from 0) and the sort key.

    A source's mean is the same for all its documents: weight / sum of weights * budget / characters of the source.
    budget: characters to bring out in the mean; by default as many as come in. The draw inverts the distribution
    function at a hash of seed and document id, so a task that runs again draws the same. A mean above MAX_RATE is
    drawn as a sum of equal parts. A null source is a source of its own. A source without any characters keeps its
    documents once in the mean. Rows with equal or null ids draw alike; their copies are numbered each for itself.
    Documents with no draw go, as the method has it. Columns of the input are kept whatever their names.

    The rates table has a row per source; it is broadcast if there are at most MAX_BROADCAST_SOURCES, else joined by a
    shuffle in which adaptive execution splits a hot source. Sorting by the key deals rows evenly, whatever the source.
    """
    rates = source_rates(docs, weights, default_weight, budget, source_col, text_col)
    small = rates.select("src").limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES
    copy, key, rate = (free_name(docs, n) for n in ("copy", "shuffle_key", "mix_rate"))
    row = docs.select(F.struct("*").alias("d"))
    rates = rates.select(F.struct("*").alias("r"))
    joined = row.join(F.broadcast(rates) if small else rates, F.col(f"d.{source_col}").cast("string").eqNullSafe(F.col("r.src")))
    doc_id = F.col(f"d.{id_col}")
    draws = F.transform(F.sequence(F.lit(1), F.col("r.draws")), lambda i: F.struct(_hash(seed, doc_id, i).alias("u")))
    number = F.aggregate(draws, F.lit(0), lambda n, x: n + F.size(F.filter(F.col("r.thresholds"), lambda c: c <= x["u"])))
    copies = joined.select("d", number.alias("n")).filter("n > 0").select("d", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias(copy))
    out = copies.select("d.*", copy, _hash(seed + 1, F.col(f"d.{id_col}"), F.col(copy)).alias(key))
    return out.orderBy(key, id_col, copy), copy, key


# Target weights of the registered query; sources that are not named get a weight of 1.
WEIGHTS = {f"src{i}": 1.0 + i % 4 for i in range(20)}


def op9_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated to the target weights and in random order."""
    return mix_sources(documents(spark, sf_dir), WEIGHTS)[0]


def _sql() -> str:
    weights = ", ".join(f"('{s}', {w})" for s, w in WEIGHTS.items())
    return f"""
WITH RECURSIVE target(src, w) AS (VALUES {weights}),
sizes AS (SELECT source AS src, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source),
weighted AS (SELECT s.src, s.size, CASE WHEN s.size > 0 THEN coalesce(CAST(t.w AS DOUBLE), 1.0) ELSE 0.0 END AS w
             FROM sizes s LEFT JOIN target t ON s.src = t.src),
totals AS (SELECT sum(w) AS all_w, sum(size) AS all_size FROM weighted),
rates AS (SELECT src, CASE WHEN size > 0 THEN w * all_size / all_w / size ELSE 1.0 END AS rate FROM weighted, totals),
parts AS (SELECT src, rate, CAST(greatest(1, ceil(rate / {MAX_RATE})) AS INTEGER) AS draws FROM rates),
cdf(src, lam, k, p, c) AS (
    SELECT src, rate / draws, 0, exp(-rate / draws), exp(-rate / draws) FROM parts
    UNION ALL
    SELECT src, lam, k + 1, p * lam / (k + 1), c + p * lam / (k + 1) FROM cdf WHERE k < least({_TAIL}, ceil(lam * 2 + 40))),
steps AS (SELECT src, list(CAST(floor(c * 4503599627370496.0) AS BIGINT)) AS thresholds FROM cdf GROUP BY src),
drawn AS (SELECT d.*, list_sum(list_transform(range(1, draws + 1), lambda i: len(list_filter(thresholds, lambda c: c <=
            CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || i), 1, 13) AS BIGINT))))) AS n
          FROM documents d JOIN parts USING (src) JOIN steps USING (src))
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       CAST('0x' || substr(md5('18|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || copy), 1, 13) AS BIGINT) AS shuffle_key
FROM (SELECT doc_id, text, lang, source, n_chars, unnest(range(0, CAST(n AS BIGINT))) AS copy FROM drawn)
""".replace("FROM documents d JOIN parts USING (src) JOIN steps USING (src))", "FROM documents d JOIN parts ON d.source IS NOT DISTINCT FROM parts.src JOIN steps ON parts.src IS NOT DISTINCT FROM steps.src)")


OP9_SQL = _sql()
