"""Nested entity responses: the query text that asks for them, and their flat form."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import flags
from .schema import RESPONSE


def ids_filter(ids: list[int]) -> str:
    return " or ".join(f"@iot.id eq {i}" for i in ids)


def time_filter(start: str, end: str) -> str:
    """Strict on both sides; start and end are ISO texts."""
    return f"phenomenonTime gt {start} and phenomenonTime lt {end}"


@dataclass
class Entity:
    """One level of a nested query: options are written in a fixed order and only if set."""

    name: str
    id: int | None = None
    filter: str = ""
    top: int | None = None
    skip: int | None = None
    count: bool | None = None
    expand: list[Entity] = field(default_factory=list)
    select: list[str] = field(default_factory=list)

    def options(self) -> list[str]:
        out = [f"$filter={self.filter}"] if self.filter else []
        out += [f"$top={self.top}"] if self.top is not None else []
        out += [f"$skip={self.skip}"] if self.skip is not None else []
        out += [f"$count={str(self.count).lower()}"] if self.count is not None else []
        out += ["$expand=" + ",".join(map(str, self.expand))] if self.expand else []
        return out + (["$select=" + ",".join(self.select)] if self.select else [])

    def __str__(self) -> str:
        return f"{self.name}({';'.join(o)})" if (o := self.options()) else self.name

    def url(self, base: str = "") -> str:
        parts = [o for o in self.options() if not o.startswith("$select")]
        parts = [o for o in self.options() if o.startswith("$select")] + parts
        where = f"({self.id})" if self.id is not None else ""
        return f"{base.rstrip('/')}/{self.name}{where}" + (f"?{'&'.join(parts)}" if parts else "")


def observations_query(thing: int, n: int | None = None, skip: int | None = None, top: int | None = None, where: str = "", streams: str = "") -> Entity:
    """The series of a thing with their observations, each with its place, property and sensor."""
    place = Entity("FeatureOfInterest", select=["feature/coordinates", "@iot.id"])
    obs = Entity("Observations", filter=where, top=top, count=False, expand=[place], select=["@iot.id", "result", "phenomenonTime", "resultQuality"])
    prop = Entity("ObservedProperty", select=["@iot.id", "name"])
    sensor = Entity("Sensor", select=["name", "@iot.id", "description"])
    series = Entity("Datastreams", filter=streams, top=n, skip=skip, expand=[obs, prop, sensor], select=["@iot.id", "name", "description", "unitOfMeasurement/name", "Observations"])
    return Entity("Things", id=thing, expand=[series], select=["Datastreams"])


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses, one JSON document a file."""
    return spark.read.schema(RESPONSE).option("multiLine", True).json(path)


def flatten(responses: DataFrame) -> DataFrame:
    """One row per observation, with its series' metadata."""
    d = responses.select(F.explode("Datastreams").alias("d"))
    o = d.select("d", F.explode("d.Observations").alias("o"))
    at = F.col("o")["FeatureOfInterest"]
    return o.select(
        F.col("o")["@iot.id"].alias("iot_id"), F.col("d")["@iot.id"].alias("datastream_id"), F.unix_micros(F.to_timestamp(F.col("o")["phenomenonTime"])).alias("t"),
        F.col("o")["result"].alias("result"), F.coalesce(flags.code_of(F.col("o")["resultQuality"]), F.col("o")["resultQuality"].try_cast("int")).alias("qc_flag"), at["@iot.id"].alias("feature_id"),
        at["feature"]["coordinates"][0].alias("longitude"), at["feature"]["coordinates"][1].alias("latitude"), F.col("d")["ObservedProperty"]["name"].alias("observation_type"),
        F.col("d")["unitOfMeasurement"]["name"].alias("units"), F.col("d")["name"].alias("name"), F.col("d")["Sensor"]["name"].alias("sensor"), F.col("d")["description"].alias("description"),
    )


def summary(responses: DataFrame) -> DataFrame:
    """One row per series: metadata, properties as columns of their own where wanted, and the number of observations."""
    d = responses.select(F.explode("Datastreams").alias("d"))
    return d.select(
        F.col("d")["@iot.id"].alias("datastream_id"), F.col("d")["name"].alias("name"), F.col("d")["ObservedProperty"]["name"].alias("name_observed_property"),
        F.col("d")["unitOfMeasurement"]["name"].alias("unit"), F.col("d")["properties"]["InstrDataItemID"].alias("instrument_item"),
        F.coalesce(F.size("d.Observations"), F.lit(0)).cast("long").alias("n_observations"),
    )


def expanded(df: DataFrame, column: str, suffix: str = "") -> DataFrame:
    """A nested column as columns of its own, in its place: a structure by its fields, a map by its keys.

    Names that the table has already get the suffix (by default an underscore and the column's name); a name that is taken
    even then is an error. The keys of a map are asked of the data: there are as many as a table has columns.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        names = kind.fieldNames()
    else:
        names = [r.k for r in df.select(F.explode(F.map_keys(column)).alias("k")).distinct().orderBy("k").collect()]
    taken, out = [c for c in df.columns if c != column], []
    for c in df.columns:
        if c != column:
            out.append(F.col(f"`{c}`"))
            continue
        for n in names:
            new = n if n not in taken else n + (suffix or f"_{column}")
            if new in taken:
                raise ValueError(f"column {new!r} is there already")
            taken.append(new)
            out.append(F.col(column)[n].alias(new))
    return df.select(*out)


def yaml_template(series: DataFrame) -> DataFrame:
    """One row: a settings template with an entry for each series, in order of id. series: a summary, one row a sensor."""
    text = F.format_string("  %s: # name: %s, type: %s, unit: %s, instrdataid: %s\n    range:\n      -\n      -\n", "datastream_id", "name", "name_observed_property", "unit", "instrument_item")
    ordered = F.array_sort(F.collect_list(F.struct("datastream_id", text.alias("text"))))
    return series.agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("template"))
