"""Sub-sampling and promotion of raw observations: first row a time bucket, semi-joined entities, inserts, updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.durations import to_micros
from .joins import insert_absent, update_from

#: Columns of a result that holds one of several types.
TYPED = ("result_number", "result_boolean", "result_json", "result_string")


def bucket(width: str = "10min", t: str = "t") -> Column:
    w = to_micros(width)
    return F.floor(F.col(t) / F.lit(w)) * F.lit(w)


def first_per_bucket(df: DataFrame, width: str = "10min", key: str = "datastream_id", value: str = "result") -> DataFrame:
    """(key, bucket, iot_id): the earliest row with a value in each time bucket of each series; null where none has one."""
    first = F.min_by("iot_id", F.when(F.col(value).isNotNull(), F.struct("t", "iot_id")))
    return df.groupBy(key, bucket(width).cast("long").alias("bucket")).agg(first.alias("iot_id"))


def subsample(df: DataFrame, start: int, stop: int, width: str = "10min", key: str = "datastream_id") -> DataFrame:
    """The observations that first_per_bucket picks among those with start <= t <= stop."""
    inside = df.where(F.col("t").between(start, stop))
    picked = first_per_bucket(inside, width, key).where("iot_id IS NOT NULL").select("iot_id")
    return inside.join(picked, "iot_id", "left_semi")


def referred(entities: DataFrame, observations: DataFrame, key: str = "feature_id") -> DataFrame:
    """The entities that the observations refer to."""
    return entities.join(observations.select(key), key, "left_semi")


def typed_result(kind: str = "result_type") -> Column:
    """The result as text, from the column that its type names."""
    n, b, j, s = (F.col(c) for c in TYPED)
    return F.when(F.col(kind) == 0, n.cast("string")).when(F.col(kind) == 1, b.cast("string")).when(F.col(kind) == 2, j).otherwise(s)


def promote(raw: DataFrame, production: DataFrame, start: int, stop: int, width: str = "10min", key: str = "datastream_id") -> DataFrame:
    """Production with the sub-sampled raw rows that it lacks."""
    return insert_absent(production, subsample(raw, start, stop, width, key), ["iot_id"], ["t"])


def refresh(production: DataFrame, raw: DataFrame, columns: list[str]) -> DataFrame:
    """Production with the raw values of the stated columns."""
    return update_from(production, raw, ["iot_id"], columns)


def locations_between(locations: DataFrame, links: DataFrame, history: DataFrame, start: int, stop: int) -> DataFrame:
    """The locations that a history entry of the time span links to, once for each such link.

    A left join chain whose filter on the last table makes it an inner one, and written as such.
    """
    h = history.where(F.col("t").between(start, stop)).select(F.col("id").alias("hist_location_id"))
    l = links.join(h, "hist_location_id").select(F.col("location_id").alias("id"))
    return locations.join(l, "id")
