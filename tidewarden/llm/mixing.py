"""Mixing sources to target weights by capped water-filling.

A source's share of the budget is proportional to its weight but stops at ``max_epochs`` times its size; what it can't
take is shared again among the others until none is above. Every document is then repeated a whole number of times, and
documents in seeded hash order are repeated once more until the source's fractional rest is met to within half a document.

Scale: only (source, hash digit) sums are windowed, 4,096 rows a source; the seeded order inside the one digit where a
source's rest ends is found by a second and third level of the same kind. No source is sorted or gathered as a whole, so
a hot source costs no more than its share of the scan. The water level is one double: each round is one aggregate.

Defined results: null texts have size zero; a null source is a source of its own, last in order; documents of size zero
take nothing; repeated rows share a hash and are cut by size only in whole rows; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table, word_count

SEED = "mix-1"
#: Hexadecimal digits of the seeded hash that each level of the cut looks at.
LEVELS = ((1, 3), (4, 3))
WEIGHTS = (1, 2, 3)


def source_table(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(no_source, source_key, source_size, weight): one row per source, weights dealt in code-point order, null last."""
    per = sizes.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("no_source", "source_key")) - 1  # one row per source, not per document
    pick = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    return per.withColumn("weight", pick)


def water_level(per_source: DataFrame, budget: float | None = None, max_epochs: float = 3.0) -> float:
    """The level L at which sum(min(max_epochs * size, L * weight)) is the budget, by clamping and resharing."""
    level = -1.0
    while True:
        full = F.col("source_size") * max_epochs <= F.lit(level) * F.col("weight")
        row = per_source.agg(
            F.sum("source_size").cast("double").alias("total"),
            F.sum(F.when(full, F.col("source_size") * max_epochs).otherwise(0.0)).alias("clamped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if row.total is None:
            return 0.0
        if not row.open:
            return level
        new = ((row.total if budget is None else budget) - row.clamped) / row.open
        if new <= level:
            return level
        level = new


def _cut(rows: DataFrame, keys: list[str], want: Column) -> DataFrame:
    """Mark rows (``extra``) in seeded hash order until their sizes, summed by keys, come nearest to ``want``."""
    left, done = rows.withColumn("_want", want), None
    for start, n in LEVELS:
        digit = F.substring("seeded", start, n)
        sums = left.groupBy(*keys, digit.alias("_d")).agg(F.sum("size").alias("_s"), F.first("_want").alias("_want"))
        w = Window.partitionBy(*keys).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("_upto", F.sum("_s").over(w)).select(*keys, "_d", "_s", "_upto")
        joined = left.withColumn("_d", digit).join(sums, [*keys, "_d"])
        part = joined.withColumn("_in", F.when(F.col("_upto") <= F.col("_want"), 1).when(F.col("_upto") - F.col("_s") >= F.col("_want"), -1).otherwise(0))
        settled = part.where("_in != 0").withColumn("extra", F.col("_in") == 1).drop("_d", "_s", "_upto", "_in", "_want")
        done = settled if done is None else done.unionByName(settled)
        left = part.where("_in = 0").withColumn("_want", F.col("_want") - (F.col("_upto") - F.col("_s"))).drop("_d", "_s", "_upto", "_in")
    w = Window.partitionBy(*keys).orderBy("seeded", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    last = left.withColumn("_upto", F.sum("size").over(w))
    last = last.withColumn("extra", F.col("_upto") - F.col("size") / 2 <= F.col("_want")).drop("_upto", "_want")
    return done.unionByName(last)


def _decided(docs: DataFrame, weights: tuple[int, ...], budget: float | None, max_epochs: float, seed: str) -> DataFrame:
    """One row per document, without its text: source, sizes, target, whole epochs, and whether one more."""
    sizes = materialise(_sized(docs, seed).select("doc_id", "source_key", "no_source", "size", "seeded"), "mix-sizes")
    per = materialise(source_table(sizes, weights), "mix-sources")
    level = water_level(per, budget, max_epochs)
    cap = F.col("source_size") * max_epochs
    target = F.least(cap, F.lit(level) * F.col("weight"))
    per = per.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(target))
    rows = sizes.join(per, ["no_source", "source_key"])  # small enough tables are broadcast by their written size; else AQE splits hot sources
    rows = rows.withColumn("whole", F.floor(F.when(F.col("source_size") == 0, 0.0).otherwise(F.try_divide("target", "source_size"))))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    out = _cut(rows, ["no_source", "source_key"], rest)
    return out.withColumn("extra", F.col("extra") & (F.col("whole") < max_epochs))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    hashed = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return docs.select(
        "doc_id", F.coalesce(F.col("source"), F.lit("")).alias("source_key"), F.col("source").isNull().cast("int").alias("no_source"),
        word_count(F.col("text")).alias("size"), hashed.alias("seeded"), F.struct("*").alias("row"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float | None = None, max_epochs: float = 3.0, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs): epochs is how often the mix repeats the document."""
    out = _decided(docs, weights, budget, max_epochs, seed)
    source = F.when(F.col("no_source") == 0, F.col("source_key"))
    epochs = (F.col("whole") + F.col("extra").cast("int")).cast("long")
    return out.select("doc_id", source.alias("source"), "size", "source_size", "target", epochs.alias("epochs"))


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float | None = None, max_epochs: float = 3.0, seed: str = SEED) -> DataFrame:
    """The mix itself: the input's rows, all columns as they came, each as often as the mix takes it.

    A source's fraction ends at one place of its seeded order, so that the decision joins by source, and texts aren't
    shuffled; repeated rows of the last document are taken alike.
    """
    at = F.struct("seeded", "doc_id", "size")
    ends = _decided(docs, weights, budget, max_epochs, seed).groupBy("no_source", "source_key")
    ends = materialise(ends.agg(F.first("whole").alias("whole"), F.max(F.when(F.col("extra"), at)).alias("end")), "mix-ends")
    rows = _sized(docs, seed).join(ends, ["no_source", "source_key"])
    times = F.col("whole") + F.coalesce(at <= F.col("end"), F.lit(False)).cast("int")
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
         sum(source_size) OVER ()::DOUBLE AS total,
         sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - 3.0::DOUBLE * source_size AS before_cap,
         sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS open_weight
  FROM s),
lv AS (SELECT max((total - before_cap) / open_weight) AS level FROM o WHERE cap > (total - before_cap) / open_weight * weight),
t AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0 ELSE least(cap, coalesce(level, cap) * weight) END AS target FROM o, lv),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS whole FROM t),
c AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2.0::DOUBLE <= e.target - e.whole * e.source_size AS extra
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN extra AND whole < 3 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""
