"""Mixing sources to target weights, all in native DataFrame operations.

Sizes are words (runs of ``[^\\x20\\x09-\\x0D]``). Tokens are aggregated per
source, target sizes give each source a repetition rate (target / size, three at
most), and a document is emitted ``floor(rate)`` times plus one Bernoulli copy
whose probability is the rate's fraction. The draw is seeded by a hash of the
doc_id: the same document always gets the same number. Each source uses, of
``DRAWS`` independent draws, the one whose realised total is nearest its target
(ties: the lowest), so that sources of a few long documents come near it too.

Sources weigh 1, 2, 3, 1, 2, 3, ... by code point of their names, null last, and
share 100 % of all words by weight; a target stops at ``MAX_RATE`` times its
source's size and the excess is shared by weight among the rest until none is
above. With sources sorted by cap / weight the sources that stop are a prefix,
which prefix sums find without iterating.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cxpulse.llm.common import materialise, table

DRAWS = 32
MAX_RATE = 3
WORD = r"[^\x20\x09-\x0D]+"
_EPS_RATE = 1e-12


def words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def draws(doc_id: Column) -> Column:
    """``DRAWS`` numbers in [0, 1) from SHA-256 digests of the id (null: 'null')."""
    key = F.coalesce(doc_id.cast("string"), F.lit("null"))
    text = F.concat(*[F.sha2(F.concat(F.lit(f"mix{k}:"), key), 256) for k in range(DRAWS // 8)])
    return F.transform(F.sequence(F.lit(0), F.lit(DRAWS - 1)),
                       lambda j: F.conv(F.substring(text, j * 8 + 1, F.lit(8)), 16, 10).cast("double") / F.lit(4294967296.0))


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target (words), rate from rows (source, size).

    One row per source goes through one task's windows: names of sources, not
    documents (a million sources are some tens of MB).
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.select("source", "source_size", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double").alias("w"))
    per = per.withColumn("cap", (F.col("source_size") * MAX_RATE).cast("double"))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(every)
    per = per.withColumns({"total": total, "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "w_after": F.sum("w").over(after)})
    per = per.withColumn("stops", F.expr("w * (total - cap_before) > cap * w_after"))
    per = per.withColumns({"cap_stopped": F.coalesce(F.sum(F.expr("IF(stops, cap, 0D)")).over(every), F.lit(0.0)),
                           "w_open": F.coalesce(F.sum(F.expr("IF(stops, 0D, w)")).over(every), F.lit(0.0))})
    return per.select(
        "source", "source_size",
        F.expr("IF(stops, cap, w * (total - cap_stopped) / w_open)").alias("target"),
    ).withColumn("rate", F.expr(f"CASE WHEN source_size = 0 THEN 1D ELSE least(target / source_size, {MAX_RATE}D) END"))


def plan(sizes: DataFrame) -> DataFrame:
    """Per source: source_size, target, rate and the draw in use, from rows
    (doc_id, source, size)."""
    targets = materialise(source_targets(sizes), "mix-targets")
    on = F.col("source").eqNullSafe(F.col("t_source"))
    named = targets.withColumnRenamed("source", "t_source")
    drawn = sizes.join(named, on).select("source", "size", "target", "rate", draws(F.col("doc_id")).alias("u"))
    taken = [F.sum(F.col("size") * copies(F.col("rate"), F.col("u")[j])).alias(f"s{j}") for j in range(DRAWS)]
    sums = drawn.groupBy("source").agg(*taken).select(F.col("source").alias("s_source"), F.array(*[f"s{j}" for j in range(DRAWS)]).alias("sums"))
    picked = targets.join(sums, F.col("source").eqNullSafe(F.col("s_source")))
    best = F.array_min(F.transform("sums", lambda s, j: F.struct(F.abs(s - F.col("target")).alias("d"), j.alias("j"))))
    return picked.select("source", "source_size", "target", "rate", best["j"].alias("draw"))


def copies(rate: Column, u: Column) -> Column:
    """floor(rate), and one more with probability equal to the fraction."""
    whole = F.floor(rate + F.lit(_EPS_RATE))
    return (whole + F.when(u < rate - whole, 1).otherwise(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"))


def decisions(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, copies, taken.

    Null or empty texts have size 0; rows that repeat a doc_id draw alike; a
    source without words has target 0 and keeps its rows once. An empty table
    gives an empty result; columns besides doc_id, source and text are ignored.
    """
    sizes = materialise(sized(docs), "mix-sizes")
    named = materialise(plan(sizes), "mix-plan").withColumnRenamed("source", "t_source")
    joined = sizes.join(named, F.col("source").eqNullSafe(F.col("t_source")))
    n = copies(F.col("rate"), F.element_at(draws(F.col("doc_id")), (F.col("draw") + 1).cast("int")))
    return joined.select("doc_id", "source", "size", "source_size", "target", n.alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it is taken, with the
    columns of ``docs``, whatever their names."""
    sizes = materialise(sized(docs), "mix-sizes")
    named = materialise(plan(sizes), "mix-plan").select(F.col("source").alias("t_source"), "rate", "draw")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("own_id"), F.col("source").cast("string").alias("own_source"))
    joined = rows.join(named, F.col("own_source").eqNullSafe(F.col("t_source")))
    n = copies(F.col("rate"), F.element_at(draws(F.col("own_id")), (F.col("draw") + 1).cast("int")))
    emitted = joined.select("row", n.alias("copies")).filter("copies > 0")
    return emitted.select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    return decisions(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_U = "\n    ".join(f"UNION ALL SELECT {j} AS j" for j in range(1, DRAWS))
SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w, (source_size * {MAX_RATE})::DOUBLE AS cap FROM p),
q AS (
  SELECT *, sum(source_size::DOUBLE) OVER () AS total,
    coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_after FROM r),
s AS (SELECT *, w * (total - cap_before) > cap * w_after AS stops FROM q),
t AS (SELECT *, coalesce(sum(CASE WHEN stops THEN cap END) OVER (), 0) AS cap_stopped, coalesce(sum(CASE WHEN NOT stops THEN w END) OVER (), 0) AS w_open FROM s),
g AS (
  SELECT source, source_size, CASE WHEN stops THEN cap ELSE w * (total - cap_stopped) / w_open END AS target,
    CASE WHEN source_size = 0 THEN 1.0 ELSE least((CASE WHEN stops THEN cap ELSE w * (total - cap_stopped) / w_open END) / source_size, {MAX_RATE}) END::DOUBLE AS rate FROM t),
j AS (SELECT 0 AS j
    {_U}),
u AS (
  SELECT d.doc_id, d.source, d.size, g.source_size, g.target, g.rate, j.j,
    ('0x' || substr(sha256('mix' || (j.j // 8) || ':' || coalesce(d.doc_id::VARCHAR, 'null')), (j.j % 8) * 8 + 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source CROSS JOIN j),
c AS (SELECT *, floor(rate + {_EPS_RATE})::BIGINT + CASE WHEN u < rate - floor(rate + {_EPS_RATE}) THEN 1 ELSE 0 END AS copies FROM u),
b AS (
  SELECT source, j, row_number() OVER (PARTITION BY source ORDER BY abs(sum(size * copies) - any_value(target)), j) AS k FROM c GROUP BY source, j)
SELECT c.doc_id, c.size, c.source_size, c.target, (c.size * c.copies)::BIGINT AS taken
FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source AND c.j = b.j AND b.k = 1
"""
