"""The whole quality control of a table of observations, as one plan.

The table is evaluated once up to the stabilisation and once up to the dependent rules, where it is written into the shared
folder; all rules together read it from there. Order: stabilisation and what depends on it, place checks, range, gradient, z-score, dependent rules. Windows are
partitioned by series or by thing, bounds are a small joined table, and nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flags
from ..functions.durations import to_micros
from ..operators import checks, dependent, joins
from .settings import Settings


@dataclass
class Places:
    """Reference tables: regions and land (region, edges), elevations (cell_i, cell_j, elevation) of cells of grid_step."""

    regions: DataFrame | None = None
    land: DataFrame | None = None
    grid: DataFrame | None = None
    grid_step: float = 0.25
    max_elevation: float = 0.0


def bounds_table(df: DataFrame, settings: Settings, key: str) -> DataFrame:
    rows = [(i, *[float(x) if x is not None else None for c in ("range", "gradient", "zscore") for x in b.get(c, (None, None))]) for i, b in settings.bounds.items()]
    cols = [f"qc_{c}_{s} double" for c in ("range", "gradient", "zscore") for s in ("min", "max")]
    return df.sparkSession.createDataFrame(rows, f"{key} long, {', '.join(cols)}")


def run(df: DataFrame, settings: Settings, key: str = "datastream_id", series: list[str] | None = None, thing: str = "thing_id", within: list[str] | None = None, apply_kinematics: bool = False, gradient_on: str = "gradient", places: Places | None = None, keep_history: bool = False) -> DataFrame:
    """df: observations (see OBSERVATION). key: what bounds and rules are stated for; series: keys of one time series
    (default: key); within: keys that rules match inside of, such as the thing; places: reference tables of place checks;
    keep_history: add ``history``, the checks that flagged the row, in order."""
    places = places or Places()
    series, within = series or [key], within or []
    if settings.reset_flags:
        df = df.withColumns({"qc_flag": F.lit(flags.NO_QC), "feature_qc_flag": F.lit(flags.NO_QC)})
    if keep_history:
        df = checks.with_history(df)
    if any(r.stabilisation and r.range for r in settings.rules):
        df = checks.raised(df, "Stabilisation", lambda d: dependent.stabilised(d, settings.rules, key, within))
    if places.regions is not None:
        df = joins.in_polygons(df.drop("region"), places.regions)
    if "region" in df.columns:
        df = checks.Check("Region nan", checks.region_missing, flags.PROBABLY_GOOD).execute(df)
        df = checks.Check("Region mainland", checks.region_on_land).execute(df)
    if places.land is not None:
        df = joins.in_polygons(df, places.land.withColumnRenamed("region", "land"), name="land")
        merge = flags.take_new if settings.take_new_feature_flags else flags.merge
        df = checks.Check("Land", lambda: F.col("land").isNotNull(), merge=merge).execute(df, "feature_qc_flag")
        df = df.withColumn("qc_flag", flags.merge("qc_flag", "feature_qc_flag"))
    if places.grid is not None:
        on_land = F.col("land").isNotNull() if "land" in df.columns else F.lit(True)  # with polygons, depth judges the land rows
        df = joins.on_grid(df, places.grid, places.grid_step)
        df = checks.Check("Depth", lambda: F.when(on_land, F.col("elevation") > places.max_elevation)).execute(df)
    if settings.max_speed and settings.location_window:
        df = checks.with_spatial_outlier(df, settings.max_speed, settings.location_window, thing)
        df = checks.Check("Spatial outlier", lambda: F.col("spatial_outlier"), on_nan=flags.PROBABLY_GOOD).execute(df, "feature_qc_flag")
        df = df.withColumn("qc_flag", flags.merge("qc_flag", "feature_qc_flag"))
        if apply_kinematics:
            df = checks.with_kinematics(df, thing, leave_out=F.col("spatial_outlier"))
            df = checks.Check("Velocity", lambda: checks.exceeds("velocity", settings.max_speed)).execute(df)
            df = checks.Check("Acceleration", lambda: checks.exceeds("acceleration", settings.max_acceleration or 1e12)).execute(df)
    df = checks.with_bounds(df, bounds_table(df, settings, key), key)
    df = checks.with_defaults(df, settings.defaults)
    good = {"on_false": flags.PROBABLY_GOOD}
    df = checks.Check("Range", lambda: checks.out_of_range("result", "qc_range_min", "qc_range_max"), **good).execute(df)
    df = checks.with_gradient(df, *series)
    df = checks.Check("Gradient", lambda: checks.out_of_range(gradient_on, "qc_gradient_min", "qc_gradient_max"), **good).execute(df)
    if settings.zscore_window:
        df = checks.with_zscore(df, settings.zscore_window, *series, eligible=F.col("qc_flag") <= flags.PROBABLY_GOOD)
        df = checks.Check("Z-score", lambda: checks.out_of_range("zscore", "qc_zscore_min", "qc_zscore_max"), **good).execute(df)
    return checks.raised(df, "Dependent", lambda d: dependent.apply_rules(d, settings.rules, key, within)) if settings.rules else df


#: Rows of a series are taken to be no further apart, so that a run's first row has its neighbour for the gradient.
NEIGHBOUR = "50min"


def needed_before(settings: Settings, neighbour: str = NEIGHBOUR) -> int:
    """Microseconds before a window that a run must read so that its rows come out as in a run over everything.

    A row's own windows look back by the longest of them, the z-score's rows and gradients by a neighbour more; a dependent
    row looks at an independent one within the tolerance, layer after layer; stabilisation at the time up and the downtime
    before it. A gap between rows longer than ``neighbour``, or an outage that began before all this, is not seen.
    """
    windows = [to_micros(x) for x in (settings.zscore_window, settings.location_window) if x]
    stable = [to_micros(r.stabilisation) + to_micros(r.max_downtime or 0) for r in settings.rules if r.stabilisation]
    chain = sum(max(to_micros(r.tolerance) for r in layer) for layer in dependent.layers(settings.rules))
    return max([0, *windows, *stable]) + chain + to_micros(neighbour)
