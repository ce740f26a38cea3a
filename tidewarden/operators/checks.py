"""Quality checks: each makes a three-valued boolean or a flag column from declarative expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flags, series
from ..functions.durations import to_micros


@dataclass(frozen=True)
class Check:
    """A named check: a boolean column, the flags of its three outcomes, and how they enter a flag column."""

    label: str
    condition: Callable[[], Column]
    on_true: int = flags.BAD
    on_false: int = flags.NO_QC
    on_nan: int = flags.NO_QC
    merge: Callable[..., Column] = flags.merge

    def flag(self) -> Column:
        return flags.from_bool(self.condition(), self.on_true, self.on_false, self.on_nan)

    def execute(self, df: DataFrame, column: str = "qc_flag") -> DataFrame:
        return df.withColumns({column: self.merge(column, self.flag())} | recorded(df, self.label, self.flag()))


def recorded(df: DataFrame, label: str, flag: Column) -> dict[str, Column]:
    """The column ``history`` with one more step where the flag is set; nothing for tables that don't keep one."""
    if "history" not in df.columns:
        return {}
    step = F.array(F.struct(F.lit(label).alias("label"), flag.cast("int").alias("flag")))
    return {"history": F.when(flag != flags.NO_QC, F.concat("history", step)).otherwise(F.col("history"))}


def with_history(df: DataFrame) -> DataFrame:
    """df with an empty ``history``, to which every check adds its flag."""
    return df.withColumn("history", F.array().cast("array<struct<label:string,flag:int>>"))


def raised(df: DataFrame, label: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The changed table; where its flag rose, the history has a step for it."""
    if "history" not in df.columns:
        return change(df)
    out = change(df.withColumn("_before", F.coalesce("qc_flag", F.lit(flags.NO_QC))))
    return out.withColumns(recorded(out, label, F.when(F.col("qc_flag") > F.col("_before"), F.col("qc_flag")).otherwise(F.lit(flags.NO_QC)))).drop("_before")


def history_rows(df: DataFrame, key: str = "iot_id") -> DataFrame:
    """(key, step, label, flag) of the column ``history``."""
    return df.select(key, F.posexplode("history").alias("step", "s")).select(key, "step", "s.label", "s.flag")


def history(df: DataFrame, checks: list[Check], key: str = "iot_id") -> DataFrame:
    """(key, step, label, flag): one row for each check that flagged a row, in the order of the checks."""
    steps = [F.struct(F.lit(i).alias("step"), F.lit(c.label).alias("label"), c.flag().alias("flag")) for i, c in enumerate(checks)]
    long = df.select(key, F.explode(F.filter(F.array(*steps), lambda s: s["flag"] != flags.NO_QC)).alias("s"))
    return long.select(key, "s.step", "s.label", "s.flag")


def out_of_range(value: str | Column, low: str | Column, high: str | Column) -> Column:
    """True outside [low, high]; missing where there is no bound or no value."""
    v, lo, hi = (F.col(x) if isinstance(x, str) else x for x in (value, low, high))
    bounded = lo.isNotNull() | hi.isNotNull()
    return F.when(bounded & v.isNotNull() & ~F.isnan(v), F.coalesce(v < lo, F.lit(False)) | F.coalesce(v > hi, F.lit(False)))


def with_bounds(df: DataFrame, bounds: DataFrame, key: str = "datastream_id") -> DataFrame:
    """Left join of the per-series bounds; a series with two rows of bounds is an error, not a longer table."""
    unique = bounds.groupBy(key).agg(*[F.first(c).alias(c) for c in bounds.columns if c != key], F.count(F.lit(1)).alias("_n"))
    ok = F.assert_true(F.col("_n") == 1, F.lit("bounds are not unique"))
    return df.join(unique.where(ok.isNull()).drop("_n"), key, "left")


def with_defaults(df: DataFrame, defaults: dict[str, tuple[float, float]]) -> DataFrame:
    """Fill missing bounds qc_<check>_min and _max by global ones."""
    for check, (lo, hi) in defaults.items():
        for side, x in (("min", lo), ("max", hi)):
            c = f"qc_{check}_{side}"
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit(float(x))) if c in df.columns else F.lit(float(x)))
    return df


def with_gradient(df: DataFrame, *keys: str, value: str = "result") -> DataFrame:
    return df.withColumn("gradient", series.gradient(F.col(value), series.ordered(*keys)))


def with_zscore(df: DataFrame, width: str | int, *keys: str, kind: str = "mean_std", value: str = "result", eligible: Column | None = None) -> DataFrame:
    """Adds ``zscore`` over the trailing time window; rows that aren't eligible get none and don't count in it.

    kind: ``mean_std``, or ``modified`` (median and median absolute deviation). The second needs the values themselves: a
    row holds its window's values while it is scored, so that a task needs rows x values of a window at once, 8 bytes each.
    """
    ok = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    v = F.when(ok, F.col(value))
    w = series.trailing(width, *keys)
    if kind == "mean_std":
        z = F.try_divide(v - F.avg(v).over(w), F.stddev_samp(v).over(w))
        return df.withColumn("zscore", z)
    df = df.withColumn("_seen", F.sort_array(F.collect_list(v).over(w)))
    df = df.withColumn("_med", F.when(ok, _median(F.col("_seen"))))
    df = df.withColumn("_mad", _median(F.sort_array(F.transform("_seen", lambda x: F.abs(x - F.col("_med"))))))
    return df.withColumn("zscore", F.try_divide(F.lit(0.6745) * (v - F.col("_med")), F.col("_mad"))).drop("_seen", "_med", "_mad")


def _median(a: Column) -> Column:
    n = F.size(a)
    return F.when(n > 0, (F.get(a, F.floor((n - 1) / 2).cast("int")) + F.get(a, F.floor(n / 2).cast("int"))) / 2)


def with_spatial_outlier(df: DataFrame, max_speed: float, width: str | int, *keys: str) -> DataFrame:
    """Adds ``spatial_outlier``: the point is further from the centred rolling median position than the speed allows.

    The distance allowed is the speed times the time that the rows in the window span.
    """
    from ..functions.geo import haversine

    w = series.centred(width, *keys)
    df = df.withColumns({
        "_lon": F.percentile("longitude", F.lit(0.5)).over(w), "_lat": F.percentile("latitude", F.lit(0.5)).over(w),
        "_span": series.seconds(F.max("t").over(w) - F.min("t").over(w)),
    })
    far = haversine(F.col("longitude"), F.col("latitude"), F.col("_lon"), F.col("_lat")) > F.lit(max_speed) * F.col("_span")
    return df.withColumn("spatial_outlier", far).drop("_lon", "_lat", "_span")


def with_kinematics(df: DataFrame, *keys: str, leave_out: Column | None = None) -> DataFrame:
    """Adds dt (s), velocity (m/s) and acceleration (m/s2) to the next row; the last rows repeat what came before.

    Rows where leave_out is true get none and are passed over, as if they weren't there.
    """
    from ..functions.geo import haversine

    if leave_out is not None:
        df = with_kinematics(df.withColumn("_out", F.coalesce(leave_out, F.lit(False))), *keys, "_out")
        return df.withColumns({c: F.when(~F.col("_out"), F.col(c)) for c in ("dt", "velocity", "acceleration")}).drop("_out")
    w, run = series.ordered(*keys), series.running(*keys)
    to_next = haversine(F.col("longitude"), F.col("latitude"), F.lead("longitude").over(w), F.lead("latitude").over(w))
    df = df.withColumn("dt", series.seconds(F.lead("t").over(w) - F.col("t")))
    df = df.withColumn("velocity", series.filled(F.try_divide(to_next, F.col("dt")), run))
    step = F.try_divide(F.lead("velocity").over(w) - F.col("velocity"), F.col("dt"))
    return df.withColumn("acceleration", series.filled(step, run))


def exceeds(value: str, limit: float) -> Column:
    return F.abs(F.col(value)) > F.lit(float(limit))


def region_missing(region: str = "region") -> Column:
    return F.col(region).isNull() | (F.lower(region) == "nan")


def region_on_land(region: str = "region") -> Column:
    return F.coalesce(F.upper(region).contains("MAINLAND"), F.lit(False))


def with_stabilisation(df: DataFrame, *keys: str, low: str = "low", high: str = "high", allowed: str = "max_downtime", needed: str = "dt_stabilization") -> DataFrame:
    """The stabilisation state of each series; limits are strict, durations are microseconds.

    within_limits, dt, elapsed, time_down, time_up_since, block_id, block_downtime, and stabilisation_flag: BAD until the
    series has been up for long enough. The first row counts as a start, so that any series begins with BAD rows.
    """
    w, run = series.ordered(*keys), series.running(*keys)
    first = F.row_number().over(w) == 1
    df = df.withColumn("within_limits", F.coalesce((F.col("result") > F.col(low)) & (F.col("result") < F.col(high)), F.lit(False)))
    df = df.withColumn("dt", F.coalesce(F.col("t") - F.lag("t").over(w), F.lit(0)))
    df = df.withColumn("elapsed", F.col("t") - F.first("t").over(run))
    up = F.when(first, F.lit(0)).when(F.col("within_limits"), F.col("elapsed"))
    df = df.withColumn("time_down", F.col("elapsed") - series.filled(up, run))
    down = F.when(first, F.lit(0)).when(F.col("time_down") > F.col(allowed), F.col("elapsed"))
    df = df.withColumn("time_up_since", F.col("elapsed") - series.filled(down, run))
    df = df.withColumn("block_id", series.changes(F.col("within_limits"), w, run))
    from pyspark.sql import Window

    longest = F.max("time_down").over(Window.partitionBy(*keys, "block_id"))
    df = df.withColumn("block_downtime", F.when(~F.col("within_limits"), longest).otherwise(F.lit(0)))
    return df.withColumn("stabilisation_flag", F.when(F.col("time_up_since") < F.col(needed), F.lit(flags.BAD)).otherwise(F.lit(flags.NO_QC)))


def lookback(*needed: str | int) -> int:
    """Microseconds before a window that the checks must see: the longest of the durations."""
    return max((to_micros(x) for x in needed), default=0)
