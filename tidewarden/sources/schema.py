"""Schemas of observations and of the nested entity form, and the adapter from event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OBSERVATION = T.StructType([
    T.StructField("iot_id", T.LongType()), T.StructField("thing_id", T.LongType()), T.StructField("datastream_id", T.LongType()),
    T.StructField("t", T.LongType()), T.StructField("result", T.DoubleType()), T.StructField("qc_flag", T.IntegerType()),
    T.StructField("feature_id", T.LongType()), T.StructField("feature_qc_flag", T.IntegerType()),
    T.StructField("observation_type", T.StringType()), T.StructField("units", T.StringType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()), T.StructField("region", T.StringType()),
])

_foi = T.StructType([T.StructField("@iot.id", T.LongType()), T.StructField("feature", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))]))])
_obs = T.StructType([
    T.StructField("@iot.id", T.LongType()), T.StructField("result", T.DoubleType()), T.StructField("phenomenonTime", T.StringType()),
    T.StructField("resultQuality", T.StringType()), T.StructField("FeatureOfInterest", _foi),
])
_named = T.StructType([T.StructField("@iot.id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("description", T.StringType())])
DATASTREAM = T.StructType([
    T.StructField("@iot.id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("unitOfMeasurement", T.StructType([T.StructField("name", T.StringType())])), T.StructField("ObservedProperty", _named),
    T.StructField("Sensor", _named), T.StructField("properties", T.MapType(T.StringType(), T.StringType())), T.StructField("Observations", T.ArrayType(_obs)),
])
#: A response: one Thing with its series.
RESPONSE = T.StructType([T.StructField("Datastreams", T.ArrayType(DATASTREAM))])

#: The adapter's series of a thing: event type -> number.
STREAMS = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


def from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations from the events table: a user is a thing, an event type of a user is one of its series.

    Coordinates are arithmetic in the event's number and its property k; NaN results become null.
    """
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = F.lit(0)
    for name, n in STREAMS.items():
        stream = F.when(F.col("event_type") == name, n).otherwise(stream)
    k = F.get_json_object("props", "$.k").cast("long")
    value = F.col("value").cast("double")
    return e.select(
        F.col("event_id").alias("iot_id"), F.col("user_id").alias("thing_id"), (F.col("user_id") * 10 + stream).alias("datastream_id"), stream.cast("long").alias("stream"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.when(F.isnan(value), None).otherwise(value).alias("result"), F.lit(0).alias("qc_flag"),
        (F.col("event_id") % 1000).alias("feature_id"), F.lit(0).alias("feature_qc_flag"), F.col("event_type").alias("observation_type"), k.alias("k"),
        (F.lit(2.0) + k * 0.02).alias("longitude"), (F.lit(50.5) + (F.col("event_id") % 97) * 0.02).alias("latitude"),
    )


def region_name() -> Column:
    """A region for each row of the adapter, in some rows missing."""
    return F.when(F.col("k") % 10 == 0, F.lit(None).cast("string")).when(F.col("k") % 10 < 4, F.lit("MAINLAND EUROPE")).otherwise(F.lit("NORTH SEA"))
