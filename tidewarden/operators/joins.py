"""Joins beyond equality: nearest in time, points in polygons and grids, and key-wise inserts and updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.durations import to_micros
from ..storage import materialise


def nearest_in_time(left: DataFrame, right: DataFrame, keys: list[str], tolerance: str | int | Column, take: list[str], t: str = "t", row: str = "iot_id") -> DataFrame:
    """Each left row with the nearest right row of its keys within the tolerance (inclusive), as struct ``near`` or null.

    Ties go to the earlier right row, then to the smaller id. Both sides are filed by time bucket, so that the join is an
    equality on (keys, bucket) whose groups hold a few tolerances of one series: no series is gathered, and a hot series
    is spread over its buckets. A tolerance in microseconds may be a column that both sides have and the keys fix.
    """
    tol = tolerance if isinstance(tolerance, Column) else F.lit(max(1, to_micros(tolerance)))
    bucket = F.floor(F.col(t) / tol)
    l = left.withColumn("_b", bucket).withColumn("_tol", tol).withColumn("_row", F.monotonically_increasing_id())
    r = right.select(*keys, F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("_b"), F.struct(F.col(t).alias("t"), F.col(row).alias("id"), *[F.col(c) for c in take]).alias("_r"))
    gap = F.abs(F.col(t) - F.col("_r.t"))
    best = F.min(F.when(gap <= F.col("_tol"), F.struct(gap.alias("gap"), F.col("_r").alias("r"))))
    pairs = l.join(r, [*keys, "_b"], "left").groupBy(*[F.col(c) for c in left.columns], "_row").agg(best.alias("_best"))
    return pairs.select(*left.columns, F.col("_best.r").alias("near"))


#: Where a cell's reference point lies, as parts of its width and height: away from coordinates that data like to take.
REFERENCE = (0.41421356237, 0.73205080757)


def _cells_of(polygons: DataFrame, cell: float, name: str) -> DataFrame:
    """(_i, _j, _near: array of (name, odd, edges)): of each cell, the polygons that pass or cover it.

    odd: whether the cell's reference point is inside; edges: those that may meet the cell. An edge is filed row by row of
    cells, under the cells between its ends there, so that a border of very many edges is spread over its cells. Polygons
    are read twice here, and edges that a shuffle gathered come in another order each time: they are told apart by sorted edges.
    """
    one = polygons.select(F.col(name).alias("name"), F.sort_array("edges").alias("edges"))
    one = one.withColumn("_p", F.xxhash64("edges")).dropDuplicates(["name", "_p"])
    e = one.select("name", "_p", F.explode("edges").alias("e")).select("name", "_p", *[F.col(f"e.{c}").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    e = e.withColumn("_j", F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell))))
    bottom = F.col("_j") * F.lit(cell)

    def x_at(y: Column) -> Column:
        return F.col("x1") + F.try_divide((y - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1"))

    ends = [F.coalesce(x_at(F.greatest(low, bottom)), "x1"), F.coalesce(x_at(F.least(high, bottom + cell)), "x2")]
    hair = 1e-9 * cell  # an edge along a cell's side is filed on both sides
    e = e.withColumns({"_a": F.floor(F.least(*ends) / cell - hair), "_b": F.floor(F.greatest(*ends) / cell + hair)})
    passing = e.select("name", "_p", "_j", F.explode(F.sequence("_a", "_b")).alias("_i"), F.struct("x1", "y1", "x2", "y2").alias("edge"))
    passing = passing.groupBy("name", "_p", "_i", "_j").agg(F.collect_list("edge").alias("edges"))
    y = bottom + REFERENCE[1] * cell
    cut = F.when((F.col("y1") > y) != (F.col("y2") > y), x_at(y))
    lines = e.groupBy("name", "_p", "_j").agg(F.collect_list(cut).alias("cuts"), F.min("_a").alias("_from"), F.max("_b").alias("_to"))
    covered = lines.select("name", "_p", "_j", "cuts", F.explode(F.sequence("_from", "_to")).alias("_i"))
    odd = F.size(F.filter("cuts", lambda x: x > (F.col("_i") + REFERENCE[0]) * cell)) % 2 == 1
    both = covered.select("name", "_p", "_i", "_j", odd.alias("odd")).join(passing, ["name", "_p", "_i", "_j"], "left").where("odd OR edges IS NOT NULL")
    return both.groupBy("_i", "_j").agg(F.collect_list(F.struct("name", "odd", "edges")).alias("_near"))


def _inside(near: Column, lon: Column, lat: Column, x0: Column, y0: Column) -> Column:
    """Whether (lon, lat) is inside, by the borders on the way there from the cell's reference point, first north or south."""

    def crossed(e: Column) -> Column:
        at_x = e["y1"] + F.try_divide((x0 - e["x1"]) * (e["y2"] - e["y1"]), e["x2"] - e["x1"])
        at_y = e["x1"] + F.try_divide((lat - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
        first = ((e["x1"] > x0) != (e["x2"] > x0)) & ((at_x > y0) != (at_x > lat))
        then = ((e["y1"] > lat) != (e["y2"] > lat)) & ((at_y > x0) != (at_y > lon))
        return F.coalesce(first, F.lit(False)) != F.coalesce(then, F.lit(False))

    n = F.coalesce(F.size(F.filter(near["edges"], crossed)), F.lit(0))
    return near["odd"] != (n % 2 == 1)


def in_polygons(points: DataFrame, polygons: DataFrame, cell: float = 1.0, name: str = "region") -> DataFrame:
    """Each point with the smallest name of the polygons (name, edges) that hold it, or null.

    A point meets the polygons of its own cell, and of their edges those that pass that cell, in one equality join that
    neither multiplies points nor groups them. The cells are written first, so that their bytes are known and Spark
    broadcasts them by its own byte bound only.
    """
    filed = materialise(_cells_of(polygons, cell, name), "cells")
    p = points.withColumn("_i", F.floor(F.col("longitude") / cell)).withColumn("_j", F.floor(F.col("latitude") / cell))
    x0, y0 = (F.col("_i") + REFERENCE[0]) * cell, (F.col("_j") + REFERENCE[1]) * cell
    hold = F.filter("_near", lambda x: _inside(x, F.col("longitude"), F.col("latitude"), x0, y0))
    found = F.array_min(F.transform(hold, lambda x: x["name"]))
    return p.join(filed, ["_i", "_j"], "left").withColumn(name, found).drop("_i", "_j", "_near")


def on_grid(points: DataFrame, grid: DataFrame, step: float, value: str = "elevation") -> DataFrame:
    """Each point with the value of its cell (cell_i, cell_j), or null."""
    p = points.withColumn("cell_i", F.floor(F.col("longitude") / step)).withColumn("cell_j", F.floor(F.col("latitude") / step))
    return p.join(grid.select("cell_i", "cell_j", value), ["cell_i", "cell_j"], "left").drop("cell_i", "cell_j")


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The target and, once each, the source rows whose keys it lacks; of several, the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = source.join(target.select(*keys), keys, "left_anti").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return target.unionByName(new.select(target.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The target with the source's values where it has the keys (source keys are unique)."""
    s = source.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    j = target.join(s, keys, "left")
    return j.select(*[(F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) if c in columns else F.col(c)).alias(c) for c in target.columns])


def combine_max(target: DataFrame, flags_: DataFrame, key: str = "iot_id", column: str = "qc_flag") -> DataFrame:
    """The target with the worse of its flag and the other table's flag of the same key."""
    other = flags_.groupBy(key).agg(F.max(column).alias("_flag"))
    return target.join(other, key, "left").withColumn(column, F.greatest(F.coalesce(F.col(column), F.lit(0)), F.coalesce(F.col("_flag"), F.lit(0)))).drop("_flag")


