"""Polygons from shapefiles, read as binary files, and elevation grids from tables of points."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POLYGONS = (5, 15, 25)  # fixed values: polygon, with z, with m


def rings(data: bytes) -> Iterator[tuple[int, list[tuple[float, float]]]]:
    """(record number, ring) of each ring of the polygons of a main shape file."""
    at = 100
    while at + 8 <= len(data):
        number, words = struct.unpack(">ii", data[at : at + 8])
        body = at + 8
        at = body + 2 * words
        (kind,) = struct.unpack("<i", data[body : body + 4])
        if kind not in POLYGONS:
            continue
        parts, points = struct.unpack("<ii", data[body + 36 : body + 44])
        first = [*struct.unpack(f"<{parts}i", data[body + 44 : body + 44 + 4 * parts]), points]
        xy = struct.unpack(f"<{2 * points}d", data[body + 44 + 4 * parts : body + 44 + 4 * parts + 16 * points])
        for a, b in zip(first, first[1:]):
            yield number, list(zip(xy[2 * a : 2 * b : 2], xy[2 * a + 1 : 2 * b : 2]))


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, data in zip(batch["path"], batch["content"]):
            rows = [(f"{path.rsplit('/', 1)[-1]}#{n}", *a, *b) for n, ring in rings(data) for a, b in zip(ring, ring[1:])]
            yield pd.DataFrame(rows, columns=["region", "x1", "y1", "x2", "y2"])


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(region, edges): a row per polygon; holes are rings like others, as the even-odd rule wants them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(path)
    e = files.select("path", "content").mapInPandas(_edges, "region string, x1 double, y1 double, x2 double, y2 double")
    return e.groupBy("region").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))


def grid_of(points: DataFrame, step: float, value: str = "elevation") -> DataFrame:
    """(cell_i, cell_j, value): the mean of the points (longitude, latitude, value) of each cell."""
    i, j = F.floor(F.col("longitude") / step), F.floor(F.col("latitude") / step)
    return points.groupBy(i.alias("cell_i"), j.alias("cell_j")).agg(F.avg(value).alias(value))


def read_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A table of a relational database, such as regions or raw observations; filters are pushed down to it."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options).load()
