"""The wide report: per second and series the best observation, then one row a second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import flags, series


def rounded(df: DataFrame) -> DataFrame:
    """Adds t_round (whole seconds, halves to even) and dt, the distance to it in seconds."""
    df = df.withColumn("t_round", series.round_second(F.col("t")))
    return df.withColumn("dt", F.abs(F.col("t") - F.col("t_round")) / F.lit(1_000_000.0))


def best_per_second(df: DataFrame, key: str = "datastream_id") -> DataFrame:
    """One row for each (key, second): best flag, then nearest to the second, then smallest id. Missing flags are 9."""
    df = rounded(df).withColumn("qc_flag", F.coalesce("qc_flag", F.lit(flags.MISSING)))
    w = Window.partitionBy(key, "t_round").orderBy("qc_flag", "dt", "iot_id")
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def coordinates(df: DataFrame) -> DataFrame:
    """(t_round, longitude, latitude): those of the row nearest to each second that has both."""
    at = F.struct("dt", "iot_id")
    both = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    best = F.min_by(F.struct("longitude", "latitude"), F.when(both, at)).alias("p")
    return rounded(df).groupBy("t_round").agg(best).select("t_round", "p.longitude", "p.latitude")


def pivoted(best: DataFrame, ids: list[int], key: str = "datastream_id") -> DataFrame:
    """t_round, and <id>__result and <id>__flag for each of the stated ids: one shuffle, no join per series."""
    wide = best.groupBy("t_round").pivot(key, ids).agg(F.first("result", ignorenulls=True).alias("result"), F.first("qc_flag", ignorenulls=True).alias("flag"))
    return wide.select("t_round", *[F.col(f"{i}_{c}").alias(f"{i}__{c}") for i in ids for c in ("result", "flag")])


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("__flag")]


def report(df: DataFrame, ids: list[int]) -> DataFrame:
    wide = pivoted(best_per_second(df), ids)
    return wide.join(coordinates(df), "t_round", "left").where(F.coalesce(*[F.col(f"{i}__result").cast("double") for i in ids]).isNotNull())


def long_form(wide: DataFrame, ids: list[int]) -> DataFrame:
    """The inverse of the pivot for results: (t_round, datastream_id, result), without missing ones."""
    out = wide.unpivot(["t_round"], [F.col(f"{i}__result").alias(str(i)) for i in ids], "datastream_id", "result")
    return out.where("result IS NOT NULL").withColumn("datastream_id", F.col("datastream_id").cast("long"))


def flag_counts(df: DataFrame, column: str = "qc_flag") -> DataFrame:
    """(qc_flag, n), missing flags included."""
    return df.groupBy(F.col(column).alias("qc_flag")).agg(F.count(F.lit(1)).alias("n"))


def flag_counts_json(df: DataFrame, column: str = "qc_flag") -> DataFrame:
    """One row: the counts by flag name as a JSON object, in order of the flags."""
    counts = flag_counts(df, column).withColumn("name", F.coalesce(flags.name_of(F.col("qc_flag")), F.lit("null")))
    pairs = F.array_sort(F.collect_list(F.struct(F.coalesce("qc_flag", F.lit(99)).alias("rank"), "name", "n")))  # ten rows
    return counts.agg(F.to_json(F.map_from_arrays(F.transform(pairs, lambda p: p["name"]), F.transform(pairs, lambda p: p["n"]))).alias("counts"))


def single_value(column: str, what: str = "value") -> Column:
    """Aggregate: the one value that isn't null; null if there is none; an error if there are several."""
    c = F.col(column)
    return F.when(F.count_distinct(c) > 1, F.raise_error(F.lit(f"more than one {what}")).cast("string")).otherwise(F.first(c, ignorenulls=True).cast("string"))


def nearest_index(df: DataFrame, index: str, value: str, target: float) -> DataFrame:
    """One row: the index whose value is nearest to the target, the first of equals."""
    return df.agg(F.min_by(index, F.struct(F.abs(F.col(value) - F.lit(target)), F.col(index))).alias("idx"))


def from_responses(responses: DataFrame, ids: list[int]) -> DataFrame:
    """The report of nested responses."""
    from ..sources.entities import flatten

    return report(flatten(responses), ids)
