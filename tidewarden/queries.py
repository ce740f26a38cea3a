"""Registered queries over the events table as observations, each with the same query in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import flags, geo
from .functions.durations import to_micros
from .operators import checks, dependent, joins, report, transfer
from .plans import pipeline
from .plans.settings import Settings
from .sources import entities, sinks
from .sources.schema import RESPONSE, STREAMS, from_events, region_name
from .streaming import incremental

DAY = 86_400_000_000
HOUR = 3_600_000_000
START = 1_704_067_200_000_000  # 2024-01-01
WINDOW = "3d"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

OBS = """obs AS (
  SELECT event_id AS iot_id, user_id AS thing_id,
         CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'view' THEN 5 ELSE 0 END::BIGINT AS stream,
         user_id * 10 + CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'view' THEN 5 ELSE 0 END AS datastream_id,
         epoch_us(ts) AS t, value AS result, event_type AS observation_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_id % 1000 AS feature_id,
         2.0::DOUBLE + CAST(json_extract_string(props, '$.k') AS BIGINT) * 0.02::DOUBLE AS longitude, 50.5::DOUBLE + (event_id % 97) * 0.02::DOUBLE AS latitude
  FROM events)"""


def query(sql: str | None = None):
    """Register the function's query under its name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = f"WITH {OBS} {sql}" if "obs" in sql else sql
        return f

    return register


def _bounds(spark: SparkSession) -> DataFrame:
    """Bounds by stream; 4 has a lower bound only and 5 none."""
    rows = [(1, 5.0, 120.0), (2, 1.0, 100.0), (3, 2.5, None), (4, 10.0, None)]
    return spark.createDataFrame(rows, "stream long, qc_range_min double, qc_range_max double")


BOUNDS = "bounds(stream, lo, hi) AS (VALUES (1, 5.0::DOUBLE, 120.0::DOUBLE), (2, 1.0, 100.0), (3, 2.5, NULL), (4, 10.0, NULL))"
RANGE_FLAG = "CASE WHEN lo IS NULL AND hi IS NULL THEN 0 WHEN coalesce(result < lo, false) OR coalesce(result > hi, false) THEN 4 ELSE 2 END"


def _ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = checks.with_bounds(from_events(spark, sf_dir), _bounds(spark), "stream")
    return checks.Check("Range", lambda: checks.out_of_range("result", "qc_range_min", "qc_range_max"), on_false=flags.PROBABLY_GOOD).execute(df)


# range checks and flags


@query(f", {BOUNDS} SELECT iot_id, {RANGE_FLAG} AS qc_flag FROM obs LEFT JOIN bounds USING (stream)")
def range_flags(spark, sf_dir):
    return _ranged(spark, sf_dir).select("iot_id", "qc_flag")


@query(f", {BOUNDS} SELECT {RANGE_FLAG} AS qc_flag, count(*) AS n FROM obs LEFT JOIN bounds USING (stream) GROUP BY 1")
def range_flag_counts(spark, sf_dir):
    return report.flag_counts(_ranged(spark, sf_dir))


@query(f", {BOUNDS} SELECT iot_id, CASE WHEN result < coalesce(lo, 1.5) OR result > coalesce(hi, 90.0) THEN 4 ELSE 2 END AS qc_flag FROM obs LEFT JOIN bounds USING (stream)")
def global_default_bounds(spark, sf_dir):
    df = checks.with_bounds(from_events(spark, sf_dir), _bounds(spark), "stream")
    df = checks.with_defaults(df, {"range": (1.5, 90.0)})
    return checks.Check("Range", lambda: checks.out_of_range("result", "qc_range_min", "qc_range_max"), on_false=flags.PROBABLY_GOOD).execute(df).select("iot_id", "qc_flag")


@query(
    f""", {BOUNDS}, f AS (SELECT {RANGE_FLAG} AS q FROM obs LEFT JOIN bounds USING (stream)), c AS (SELECT q, count(*) AS n FROM f GROUP BY q)
SELECT '{{' || string_agg('"' || CASE q WHEN 0 THEN 'NO_QUALITY_CONTROL' WHEN 2 THEN 'PROBABLY_GOOD' WHEN 4 THEN 'BAD' END || '":' || n, ',' ORDER BY q) || '}}' AS counts FROM c"""
)
def flag_counts_json(spark, sf_dir):
    return report.flag_counts_json(_ranged(spark, sf_dir))


@query(
    f""", {BOUNDS}, r AS (SELECT feature_id, max({RANGE_FLAG}) AS f FROM obs LEFT JOIN bounds USING (stream) GROUP BY 1)
SELECT '{{"id":"' || feature_id || '","method":"patch","url":"FeaturesOfInterest(' || feature_id || ')","body":{{"properties":{{"resultQuality":"' ||
  CASE f WHEN 0 THEN 'NO_QUALITY_CONTROL' WHEN 2 THEN 'PROBABLY_GOOD' WHEN 4 THEN 'BAD' END || '"}}}}}}' AS value FROM r"""
)
def feature_patches(spark, sf_dir):
    return sinks.feature_patches(_ranged(spark, sf_dir).withColumn("feature_qc_flag", F.col("qc_flag")))


@query(
    f""", {BOUNDS}, r AS (SELECT iot_id, {RANGE_FLAG} AS f FROM obs LEFT JOIN bounds USING (stream))
SELECT '{{"id":"' || iot_id || '","method":"patch","url":"Observations(' || iot_id || ')","body":{{"resultQuality":"BAD"}}}}' AS value FROM r WHERE f = 4"""
)
def flag_patches(spark, sf_dir):
    after = _ranged(spark, sf_dir)
    return sinks.patches(sinks.changed(from_events(spark, sf_dir), after).where(F.col("qc_flag") == flags.BAD))


@query(
    f""", {BOUNDS}, r AS (SELECT *, {RANGE_FLAG} AS f FROM obs LEFT JOIN bounds USING (stream))
SELECT iot_id, 0 AS step, 'Range' AS label, f AS flag FROM r WHERE f != 0 UNION ALL SELECT iot_id, 1, 'Region nan', 2 FROM obs WHERE k % 10 = 0"""
)
def flag_history(spark, sf_dir):
    df = checks.with_bounds(from_events(spark, sf_dir), _bounds(spark), "stream").withColumn("region", region_name())
    steps = [
        checks.Check("Range", lambda: checks.out_of_range("result", "qc_range_min", "qc_range_max"), on_false=flags.PROBABLY_GOOD),
        checks.Check("Region nan", checks.region_missing, flags.PROBABLY_GOOD),
    ]
    return checks.history(df, steps)


# windows over series

GRADIENT = """, w AS (
  SELECT *, (t - lag(t) OVER s) / 1e6 AS hs, (lead(t) OVER s - t) / 1e6 AS hd, lag(result) OVER s AS b, lead(result) OVER s AS a
  FROM obs WINDOW s AS (PARTITION BY datastream_id ORDER BY t, iot_id)),
g AS (SELECT *, CASE WHEN hs IS NULL THEN (a - result) / nullif(hd, 0) WHEN hd IS NULL THEN (result - b) / nullif(hs, 0)
  ELSE (hs * hs * a + (hd * hd - hs * hs) * result - hd * hd * b) / nullif(hs * hd * (hd + hs), 0) END AS gradient FROM w)"""


@query(GRADIENT + " SELECT iot_id, round(gradient, 9) + 0.0 AS gradient FROM g")
def gradient(spark, sf_dir):
    df = checks.with_gradient(from_events(spark, sf_dir), "datastream_id")
    return df.select("iot_id", (F.round("gradient", 9) + 0.0).alias("gradient"))


@query(GRADIENT + " SELECT iot_id, CASE WHEN gradient IS NULL THEN 0 WHEN gradient < -0.0005 OR gradient > 0.0005 THEN 4 ELSE 2 END AS qc_flag FROM g")
def gradient_flags(spark, sf_dir):
    df = checks.with_gradient(from_events(spark, sf_dir), "datastream_id")
    return checks.Check("Gradient", lambda: checks.out_of_range("gradient", F.lit(-0.0005), F.lit(0.0005)), on_false=flags.PROBABLY_GOOD).execute(df).select("iot_id", "qc_flag")


@query(" SELECT iot_id, CASE WHEN result < 2.0 OR result > 80.0 THEN 4 ELSE 2 END AS qc_flag FROM obs")
def gradient_limits_on_result(spark, sf_dir):
    """The gradient's limits applied to the result itself, which the whole plan does with ``gradient_on="result"``."""
    df = from_events(spark, sf_dir)
    return pipeline.run(df, Settings(defaults={"gradient": (2.0, 80.0)}), "stream", ["datastream_id"], gradient_on="result").select("iot_id", "qc_flag")


FRAME = f"(PARTITION BY datastream_id ORDER BY t RANGE BETWEEN {3 * DAY - 1} PRECEDING AND CURRENT ROW)"


@query(f", z AS (SELECT iot_id, (result - avg(result) OVER f) / nullif(stddev_samp(result) OVER f, 0) AS z FROM obs WINDOW f AS {FRAME}) SELECT iot_id, round(z, 6) + 0.0 AS zscore FROM z")
def zscore_mean_std(spark, sf_dir):
    df = checks.with_zscore(from_events(spark, sf_dir), WINDOW, "datastream_id")
    return df.select("iot_id", (F.round("zscore", 6) + 0.0).alias("zscore"))


@query(
    f""", l AS (SELECT iot_id, result, list(result) OVER {FRAME} AS seen FROM obs), m AS (SELECT *, list_median(seen) AS med FROM l),
d AS (SELECT *, list_median(list_transform(seen, lambda x: abs(x - med))) AS mad FROM m)
SELECT iot_id, round(0.6745 * (result - med) / nullif(mad, 0), 6) + 0.0 AS zscore FROM d"""
)
def zscore_modified(spark, sf_dir):
    df = checks.with_zscore(from_events(spark, sf_dir), WINDOW, "datastream_id", kind="modified")
    return df.select("iot_id", (F.round("zscore", 6) + 0.0).alias("zscore"))


@query(
    f""", {BOUNDS}, r AS (SELECT *, {RANGE_FLAG} AS q FROM obs LEFT JOIN bounds USING (stream)), e AS (SELECT * FROM r WHERE q <= 2),
z AS (SELECT iot_id, (result - avg(result) OVER f) / nullif(stddev_samp(result) OVER f, 0) AS z FROM e WINDOW f AS {FRAME})
SELECT r.iot_id, greatest(q, CASE WHEN z IS NULL THEN 0 WHEN z < -1.2 OR z > 1.2 THEN 4 ELSE 2 END) AS qc_flag FROM r LEFT JOIN z USING (iot_id)"""
)
def zscore_flags(spark, sf_dir):
    df = checks.with_zscore(_ranged(spark, sf_dir), WINDOW, "datastream_id", eligible=F.col("qc_flag") <= flags.PROBABLY_GOOD)
    return checks.Check("Z-score", lambda: checks.out_of_range("zscore", F.lit(-1.2), F.lit(1.2)), on_false=flags.PROBABLY_GOOD).execute(df).select("iot_id", "qc_flag")


STATE = f""", s1 AS (SELECT *, result > 20 AND result < 200 AS ok, coalesce(t - lag(t) OVER w, 0) AS dt, t - first_value(t) OVER w AS el, row_number() OVER w AS rn,
  lag(result > 20 AND result < 200) OVER w AS pok FROM obs WINDOW w AS (PARTITION BY thing_id ORDER BY t, iot_id)),
s2 AS (SELECT *, el - last_value(CASE WHEN rn = 1 THEN 0 WHEN ok THEN el END IGNORE NULLS) OVER u AS down, CAST(sum(CASE WHEN pok IS NULL OR pok != ok THEN 1 ELSE 0 END) OVER u AS BIGINT) AS block_id
  FROM s1 WINDOW u AS (PARTITION BY thing_id ORDER BY t, iot_id ROWS UNBOUNDED PRECEDING)),
s3 AS (SELECT *, el - last_value(CASE WHEN rn = 1 THEN 0 WHEN down > {12 * HOUR} THEN el END IGNORE NULLS) OVER u AS up,
  CASE WHEN ok THEN 0 ELSE max(down) OVER (PARTITION BY thing_id, block_id) END AS block_downtime
  FROM s2 WINDOW u AS (PARTITION BY thing_id ORDER BY t, iot_id ROWS UNBOUNDED PRECEDING))"""


def _state(spark, sf_dir):
    df = from_events(spark, sf_dir).withColumns({"low": F.lit(20.0), "high": F.lit(200.0), "max_downtime": F.lit(12 * HOUR), "dt_stabilization": F.lit(DAY)})
    return checks.with_stabilisation(df, "thing_id")


@query(STATE + " SELECT iot_id, ok AS within_limits, dt, down AS time_down, up AS time_up_since, block_id FROM s3")
def stabilisation_state(spark, sf_dir):
    return _state(spark, sf_dir).select("iot_id", "within_limits", "dt", "time_down", "time_up_since", "block_id")


@query(STATE + f" SELECT iot_id, CASE WHEN up < {DAY} THEN 4 ELSE 0 END AS qc_flag FROM s3")
def stabilisation_flags(spark, sf_dir):
    return _state(spark, sf_dir).select("iot_id", F.col("stabilisation_flag").alias("qc_flag"))


@query(STATE + " SELECT thing_id, block_id, count(*) AS n, max(block_downtime) AS downtime FROM s3 WHERE NOT ok GROUP BY 1, 2")
def downtime_blocks(spark, sf_dir):
    df = _state(spark, sf_dir).where("NOT within_limits")
    return df.groupBy("thing_id", "block_id").agg(F.count(F.lit(1)).alias("n"), F.max("block_downtime").alias("downtime"))


# dependent quantities

RULE = dependent.Rule(1, (5, 3), "6h", range=(5.0, 100.0))
NEAR = f""", {BOUNDS}, r AS (SELECT *, {RANGE_FLAG} AS q FROM obs LEFT JOIN bounds USING (stream)),
dep AS (SELECT * FROM r WHERE stream IN (3, 5)), ind AS (SELECT * FROM r WHERE stream = 1),
p AS (SELECT dep.iot_id, ind.q AS iq, ind.result AS ir, row_number() OVER (PARTITION BY dep.iot_id ORDER BY abs(dep.t - ind.t), ind.t, ind.iot_id) AS rn
  FROM dep JOIN ind ON dep.thing_id = ind.thing_id AND abs(dep.t - ind.t) <= {6 * HOUR}),
n AS (SELECT dep.iot_id, dep.q, p.iq, p.ir, p.iot_id IS NULL AS missing FROM dep LEFT JOIN p ON p.iot_id = dep.iot_id AND p.rn = 1)"""


@query(NEAR + " SELECT iot_id, CASE WHEN missing THEN 4 WHEN iq <= 1 THEN 0 ELSE iq END AS qc_flag FROM n")
def dependent_base(spark, sf_dir):
    return dependent.base(_ranged(spark, sf_dir), RULE, "stream", ["thing_id"])


@query(NEAR + " SELECT iot_id, CASE WHEN missing THEN 0 WHEN iq <= 1 THEN 0 ELSE iq END AS qc_flag FROM n")
def dependent_base_keep(spark, sf_dir):
    rule = dependent.Rule(1, (5, 3), "6h", flag_when_missing=None)
    return dependent.base(_ranged(spark, sf_dir), rule, "stream", ["thing_id"])


@query(NEAR + " SELECT iot_id, CASE WHEN ir < 5 OR ir > 100 THEN 4 ELSE 0 END AS qc_flag FROM n")
def dependent_secondary(spark, sf_dir):
    return dependent.secondary(_ranged(spark, sf_dir), RULE, "stream", ["thing_id"])


@query(
    NEAR
    + """ SELECT r.iot_id, greatest(r.q, coalesce(CASE WHEN n.missing THEN 4 WHEN iq <= 1 THEN 0 ELSE iq END, 0), coalesce(CASE WHEN ir < 5 OR ir > 100 THEN 4 END, 0)) AS qc_flag
FROM r LEFT JOIN n USING (iot_id)"""
)
def dependent_rules(spark, sf_dir):
    return dependent.apply_rules(_ranged(spark, sf_dir), [RULE], "stream", ["thing_id"]).select("iot_id", "qc_flag")


def _near_sql(name: str, rule: dependent.Rule, source: str, flag: str = "q") -> str:
    """CTE ``name`` (iot_id, iq, ir, missing): the rule's dependent rows and what stands nearest."""
    dep, tol = ", ".join(map(str, rule.dependent)), to_micros(rule.tolerance)
    return f"""{name}p AS (SELECT d.iot_id, i.{flag} AS iq, i.result AS ir, row_number() OVER (PARTITION BY d.iot_id ORDER BY abs(d.t - i.t), i.t, i.iot_id) AS rn
  FROM {source} d JOIN {source} i ON d.thing_id = i.thing_id AND abs(d.t - i.t) <= {tol} WHERE d.stream IN ({dep}) AND i.stream = {rule.independent}),
{name} AS (SELECT d.iot_id, iq, ir, p.iot_id IS NULL AS missing FROM {source} d LEFT JOIN {name}p p ON p.iot_id = d.iot_id AND p.rn = 1 WHERE d.stream IN ({dep}))"""


def _flag_sql(rule: dependent.Rule) -> str:
    """The rule's flag of a row of ``_near_sql``."""
    range_ = f"WHEN ir < {rule.range[0]} OR ir > {rule.range[1]} THEN 4" if rule.range else ""
    return f"CASE WHEN missing THEN {rule.flag_when_missing or 0} {range_} WHEN iq <= 1 THEN 0 ELSE iq END"


CHAIN = [dependent.Rule(1, (2,), "6h", range=(5.0, 100.0)), dependent.Rule(2, (3,), "4h", flag_when_missing=None), dependent.Rule(3, (4, 5), "8h", range=(2.0, 150.0), flag_when_missing=flags.PROBABLY_BAD)]


def _chain_sql() -> str:
    out, at = f", {BOUNDS}, r0 AS (SELECT *, {RANGE_FLAG} AS q FROM obs LEFT JOIN bounds USING (stream))", "r0"
    for i, rule in enumerate(CHAIN):
        out += f", {_near_sql(f'n{i}', rule, at)}, r{i + 1} AS (SELECT {at}.* REPLACE (greatest(q, coalesce({_flag_sql(rule)}, 0)) AS q) FROM {at} LEFT JOIN n{i} USING (iot_id))"
        at = f"r{i + 1}"
    return out + f" SELECT iot_id, q AS qc_flag FROM {at}"


@query(_chain_sql())
def rule_chain(spark, sf_dir):
    """Three layers: each rule reads what the one before it has written."""
    return dependent.apply_rules(_ranged(spark, sf_dir), CHAIN, "stream", ["thing_id"]).select("iot_id", "qc_flag")


STABLE = [
    dependent.Rule(1, (2,), "6h", (20.0, 200.0), "1d", "12h"),
    dependent.Rule(3, (4,), "9h", (15.0, 220.0), "12h", "6h"),
    dependent.Rule(1, (5,), "6h", (30.0, 180.0), "2d", "12h"),
]


def _stable_sql() -> str:
    out = ""
    for i, r in enumerate(STABLE):
        ok, run = f"(result > {r.range[0]} AND result < {r.range[1]})", "PARTITION BY thing_id ORDER BY t, iot_id"
        out += f""", a{i} AS (SELECT *, {ok} AS ok, t - first_value(t) OVER w AS el, row_number() OVER w AS rn FROM obs WHERE stream = {r.independent} WINDOW w AS ({run})),
b{i} AS (SELECT *, el - last_value(CASE WHEN rn = 1 THEN 0 WHEN ok THEN el END IGNORE NULLS) OVER u AS down FROM a{i} WINDOW u AS ({run} ROWS UNBOUNDED PRECEDING)),
c{i} AS (SELECT *, el - last_value(CASE WHEN rn = 1 THEN 0 WHEN down > {to_micros(r.max_downtime)} THEN el END IGNORE NULLS) OVER u AS up FROM b{i} WINDOW u AS ({run} ROWS UNBOUNDED PRECEDING)),
s{i} AS (SELECT iot_id, CASE WHEN up < {to_micros(r.stabilisation)} THEN 4 ELSE 0 END AS f FROM c{i})"""
    seen = {0: "s0.f", 1: "s1.f", 2: "greatest(s0.f, s2.f)"}
    out += ", o AS (SELECT obs.*, " + ", ".join(f"coalesce({e}, 0) AS q{i}" for i, e in seen.items()) + " FROM obs " + " ".join(f"LEFT JOIN s{i} ON s{i}.iot_id = obs.iot_id" for i in seen) + ")"
    quiet = [dependent.Rule(r.independent, r.dependent, r.tolerance, flag_when_missing=None) for r in STABLE]
    out += "".join(f", {_near_sql(f'n{i}', r, 'o', f'q{i}')}, m{i} AS (SELECT iot_id, {_flag_sql(r)} AS f FROM n{i})" for i, r in enumerate(quiet))
    return out + " SELECT o.iot_id, greatest(q0, q1, q2, coalesce(m0.f, 0), coalesce(m1.f, 0), coalesce(m2.f, 0)) AS qc_flag FROM o " + " ".join(f"LEFT JOIN m{i} ON m{i}.iot_id = o.iot_id" for i in seen)


@query(_stable_sql())
def stabilised_dependents(spark, sf_dir):
    """Stabilisation of two independent series, one of them by two rules, and what depends on them."""
    return dependent.stabilised(from_events(spark, sf_dir), STABLE, "stream", ["thing_id"]).select("iot_id", "qc_flag")


# trajectories and places

HAV = "2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin((radians({y2}) - radians({y1})) / 2), 2) + cos(radians({y1})) * cos(radians({y2})) * pow(sin(radians({x2} - {x1}) / 2), 2))))"
STEP = f""", j AS (SELECT *, lead(longitude) OVER w AS x2, lead(latitude) OVER w AS y2, (lead(t) OVER w - t) / 1e6 AS dt FROM obs WINDOW w AS (PARTITION BY thing_id ORDER BY t, iot_id)),
v0 AS (SELECT *, {HAV.format(x1="longitude", y1="latitude", x2="x2", y2="y2")} / nullif(dt, 0) AS v FROM j),
v AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY thing_id ORDER BY t, iot_id ROWS UNBOUNDED PRECEDING) AS velocity FROM v0),
a0 AS (SELECT *, (lead(velocity) OVER (PARTITION BY thing_id ORDER BY t, iot_id) - velocity) / nullif(dt, 0) AS a FROM v),
a AS (SELECT *, last_value(a IGNORE NULLS) OVER (PARTITION BY thing_id ORDER BY t, iot_id ROWS UNBOUNDED PRECEDING) AS acceleration FROM a0)"""


@query(
    f""", m AS (SELECT *, quantile_cont(longitude, 0.5) OVER c AS x2, quantile_cont(latitude, 0.5) OVER c AS y2, (max(t) OVER c - min(t) OVER c) / 1e6 AS span
  FROM obs WINDOW c AS (PARTITION BY thing_id ORDER BY t RANGE BETWEEN {36 * HOUR} PRECEDING AND {36 * HOUR} FOLLOWING))
SELECT iot_id, {HAV.format(x1="longitude", y1="latitude", x2="x2", y2="y2")} > 0.8 * span AS spatial_outlier FROM m"""
)
def spatial_outlier(spark, sf_dir):
    return checks.with_spatial_outlier(from_events(spark, sf_dir), 0.8, "3d", "thing_id").select("iot_id", "spatial_outlier")


@query(STEP + " SELECT iot_id, round(velocity, 6) + 0.0 AS velocity, coalesce(velocity > 20, false) AS too_fast FROM v")
def velocity(spark, sf_dir):
    df = checks.with_kinematics(from_events(spark, sf_dir), "thing_id")
    return df.select("iot_id", (F.round("velocity", 6) + 0.0).alias("velocity"), F.coalesce(checks.exceeds("velocity", 20.0), F.lit(False)).alias("too_fast"))


@query(STEP + " SELECT iot_id, round(acceleration, 6) + 0.0 AS acceleration FROM a")
def acceleration(spark, sf_dir):
    return checks.with_kinematics(from_events(spark, sf_dir), "thing_id").select("iot_id", (F.round("acceleration", 6) + 0.0).alias("acceleration"))


@query(
    f""", m AS (SELECT *, quantile_cont(longitude, 0.5) OVER c AS mx, quantile_cont(latitude, 0.5) OVER c AS my, (max(t) OVER c - min(t) OVER c) / 1e6 AS span
  FROM obs WINDOW c AS (PARTITION BY thing_id ORDER BY t RANGE BETWEEN {36 * HOUR} PRECEDING AND {36 * HOUR} FOLLOWING)),
k AS (SELECT * FROM m WHERE NOT {HAV.format(x1="longitude", y1="latitude", x2="mx", y2="my")} > 0.8 * span)"""
    + STEP.replace("FROM obs", "FROM k")
    + " SELECT o.iot_id, round(velocity, 6) + 0.0 AS velocity, round(acceleration, 6) + 0.0 AS acceleration FROM obs o LEFT JOIN a USING (iot_id)"
)
def kinematics_without_outliers(spark, sf_dir):
    df = checks.with_spatial_outlier(from_events(spark, sf_dir), 0.8, "3d", "thing_id")
    df = checks.with_kinematics(df, "thing_id", leave_out=F.col("spatial_outlier"))
    return df.select("iot_id", (F.round("velocity", 6) + 0.0).alias("velocity"), (F.round("acceleration", 6) + 0.0).alias("acceleration"))


#: Invented land masses as rings of corners.
LAND = {"A": [(2.15, 50.61), (3.05, 50.73), (2.85, 51.55), (2.25, 51.35)], "B": [(3.11, 50.91), (3.91, 51.01), (3.53, 51.39), (3.71, 52.17), (3.07, 51.87)]}


def _edges() -> list[tuple[str, float, float, float, float]]:
    return [(name, *ring[i], *ring[(i + 1) % len(ring)]) for name, ring in LAND.items() for i in range(len(ring))]


def _land(spark: SparkSession) -> DataFrame:
    e = spark.createDataFrame(_edges(), "region string, x1 double, y1 double, x2 double, y2 double")
    return e.groupBy("region").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))


EDGES = "edges(region, x1, y1, x2, y2) AS (VALUES " + ", ".join(f"('{e[0]}', {', '.join(f'{x}::DOUBLE' for x in e[1:])})" for e in _edges()) + ")"


@query(
    f""", {EDGES}, c AS (SELECT iot_id, region FROM obs, edges WHERE (y1 > latitude) != (y2 > latitude) AND longitude < x1 + (latitude - y1) * (x2 - x1) / (y2 - y1)
  GROUP BY iot_id, region HAVING count(*) % 2 = 1)
SELECT o.iot_id, min(c.region) AS region, CASE WHEN min(c.region) IS NULL THEN 0 ELSE 4 END AS feature_qc_flag FROM obs o LEFT JOIN c USING (iot_id) GROUP BY 1"""
)
def polygon_land(spark, sf_dir):
    df = joins.in_polygons(from_events(spark, sf_dir).select("iot_id", "longitude", "latitude", "feature_qc_flag"), _land(spark))
    return checks.Check("Land", lambda: F.col("region").isNotNull()).execute(df, "feature_qc_flag").select("iot_id", "region", "feature_qc_flag")


#: A border of very many edges: a circle whose radius swings with the angle.
CORNERS = 100_000
ANGLE = f"(2 * pi() * ({{i}}) / {CORNERS})"
BORDER_X = "(2.9 + (0.7 + 0.2 * sin(31 * {a}) + 0.02 * sin(997 * {a})) * cos({a}))"
BORDER_Y = "(51.4 + (0.7 + 0.2 * sin(31 * {a}) + 0.02 * sin(997 * {a})) * sin({a}))"


def _border_sql(i: str, x: str, y: str) -> str:
    a = ANGLE.format(i=i)
    return f"{BORDER_X.format(a=a)} AS {x}, {BORDER_Y.format(a=a)} AS {y}"


@query(
    f""", e AS MATERIALIZED (SELECT {_border_sql("i", "x1", "y1")}, {_border_sql(f"(i + 1) % {CORNERS}", "x2", "y2")} FROM range(0, {CORNERS}) r(i)),
c AS (SELECT iot_id FROM obs JOIN e ON latitude >= least(y1, y2) AND latitude < greatest(y1, y2) WHERE longitude < x1 + (latitude - y1) * (x2 - x1) / (y2 - y1) GROUP BY iot_id HAVING count(*) % 2 = 1)
SELECT iot_id, CASE WHEN iot_id IN (SELECT iot_id FROM c) THEN 'swing' END AS region FROM obs"""
)
def polygon_many_edges(spark, sf_dir):
    here, there = ANGLE.format(i="id"), ANGLE.format(i=f"(id + 1) % {CORNERS}")
    corners = {"x1": BORDER_X.format(a=here), "y1": BORDER_Y.format(a=here), "x2": BORDER_X.format(a=there), "y2": BORDER_Y.format(a=there)}
    e = spark.range(CORNERS).select(F.lit("swing").alias("region"), *[F.expr(f"CAST({x} AS DOUBLE)").alias(c) for c, x in corners.items()])
    border = e.groupBy("region").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    return joins.in_polygons(from_events(spark, sf_dir).select("iot_id", "longitude", "latitude"), border, 0.05).select("iot_id", "region")


def _grid(spark: SparkSession) -> DataFrame:
    """Invented elevations of cells of a quarter degree; some cells have none."""
    g = spark.range(0, 24 * 24).select((F.col("id") % 24).alias("cell_i"), (F.floor(F.col("id") / 24) + 196).alias("cell_j"))
    return g.withColumn("elevation", ((F.col("cell_i") * 7 + F.col("cell_j") * 13) % 41 - 25).cast("double")).where((F.col("cell_i") + F.col("cell_j")) % 11 != 0)


@query(
    """, g AS (SELECT i AS cell_i, j AS cell_j, CAST((i * 7 + j * 13) % 41 - 25 AS DOUBLE) AS elevation FROM range(0, 24) a(i), range(196, 220) b(j) WHERE (i + j) % 11 != 0)
SELECT o.iot_id, elevation, CASE WHEN elevation > 0 THEN 4 ELSE 0 END AS qc_flag
FROM obs o LEFT JOIN g ON floor(longitude / 0.25) = cell_i AND floor(latitude / 0.25) = cell_j"""
)
def grid_depth(spark, sf_dir):
    df = joins.on_grid(from_events(spark, sf_dir), _grid(spark), 0.25)
    return checks.Check("Depth", lambda: F.col("elevation") > 0.0).execute(df).select("iot_id", "elevation", "qc_flag")


@query(" SELECT iot_id, CASE WHEN k % 10 = 0 THEN 2 ELSE 0 END AS qc_flag FROM obs")
def region_null(spark, sf_dir):
    df = from_events(spark, sf_dir).withColumn("region", region_name())
    return checks.Check("Region nan", checks.region_missing, flags.PROBABLY_GOOD).execute(df).select("iot_id", "qc_flag")


@query(" SELECT iot_id, CASE WHEN k % 10 BETWEEN 1 AND 3 THEN 4 ELSE 0 END AS qc_flag FROM obs")
def region_land(spark, sf_dir):
    df = from_events(spark, sf_dir).withColumn("region", region_name())
    return checks.Check("Region mainland", checks.region_on_land).execute(df).select("iot_id", "qc_flag")


@query(
    f" SELECT iot_id, round({HAV.format(x1='longitude', y1='latitude', x2='2.75::DOUBLE', y2='51.05::DOUBLE')}, 3) AS metres FROM obs"
)
def distance_to_point(spark, sf_dir):
    df = from_events(spark, sf_dir)
    return df.select("iot_id", F.round(geo.haversine(F.col("longitude"), F.col("latitude"), F.lit(2.75), F.lit(51.05)), 3).alias("metres"))


# reports

BEST = f""", {BOUNDS}, r AS (SELECT *, {RANGE_FLAG} AS q, t // 60000000 * 1000000 + t % 1000000 AS tt FROM obs LEFT JOIN bounds USING (stream)),
s AS (SELECT *, CAST(round_even(tt / 1e6, 0) AS BIGINT) * 1000000 AS t_round FROM r),
d AS (SELECT *, abs(tt - t_round) / 1e6 AS dt FROM s),
b AS (SELECT *, row_number() OVER (PARTITION BY stream, t_round ORDER BY q, dt, iot_id) AS rn FROM d)"""


def _minutes(spark, sf_dir):
    """Flagged observations on a clock of minutes for seconds, so that several meet in one."""
    return _ranged(spark, sf_dir).withColumn("t", (F.floor(F.col("t") / 60_000_000) * 1_000_000 + F.col("t") % 1_000_000).cast("long"))


@query(BEST + " SELECT stream, t_round, iot_id, q AS qc_flag, round(dt, 6) AS dt FROM b WHERE rn = 1")
def best_flag_per_second(spark, sf_dir):
    return report.best_per_second(_minutes(spark, sf_dir), "stream").select("stream", "t_round", "iot_id", "qc_flag", F.round("dt", 6).alias("dt"))


@query(BEST + " SELECT t_round, " + ", ".join(f'max(CASE WHEN stream = {i} THEN result END) AS "{i}__result", CAST(max(CASE WHEN stream = {i} THEN q END) AS DOUBLE) AS "{i}__flag"' for i in (1, 2, 3, 4, 5)) + " FROM b WHERE rn = 1 GROUP BY 1")
def report_pivot(spark, sf_dir):
    wide = report.pivoted(report.best_per_second(_minutes(spark, sf_dir), "stream"), list(STREAMS.values()), "stream")
    return wide.withColumns({c: F.col(c).cast("double") for c in report.flag_columns(wide)})


@query(BEST + " SELECT t_round, arg_min(longitude, (dt, iot_id)) AS longitude, arg_min(latitude, (dt, iot_id)) AS latitude FROM d GROUP BY 1")
def coords_first(spark, sf_dir):
    return report.coordinates(_minutes(spark, sf_dir))


@query(
    BEST
    + """, p AS (SELECT t_round, max(CASE WHEN stream = 1 THEN result END) AS "1__result", CAST(max(CASE WHEN stream = 1 THEN q END) AS DOUBLE) AS "1__flag",
  max(CASE WHEN stream = 2 THEN result END) AS "2__result", CAST(max(CASE WHEN stream = 2 THEN q END) AS DOUBLE) AS "2__flag" FROM b WHERE rn = 1 GROUP BY 1),
c AS (SELECT t_round, arg_min(longitude, (dt, iot_id)) AS longitude, arg_min(latitude, (dt, iot_id)) AS latitude FROM d GROUP BY 1)
SELECT p.*, longitude, latitude FROM p LEFT JOIN c USING (t_round) WHERE coalesce("1__result", "2__result") IS NOT NULL"""
)
def wide_report(spark, sf_dir):
    df = _minutes(spark, sf_dir)
    wide = report.report(df.withColumn("datastream_id", F.col("stream")), [1, 2])
    return wide.withColumns({c: F.col(c).cast("double") for c in report.flag_columns(wide)})


@query(BEST + " SELECT t_round, CAST(stream AS BIGINT) AS datastream_id, result FROM b WHERE rn = 1 AND result IS NOT NULL")
def report_long(spark, sf_dir):
    ids = list(STREAMS.values())
    return report.long_form(report.pivoted(report.best_per_second(_minutes(spark, sf_dir), "stream"), ids, "stream"), ids)


@query(" SELECT iot_id, CAST(round_even(t / 1e6, 0) AS BIGINT) * 1000000 AS t_round, round(abs(t - CAST(round_even(t / 1e6, 0) AS BIGINT) * 1000000) / 1e6, 6) AS dt FROM obs")
def time_rounding(spark, sf_dir):
    return report.rounded(from_events(spark, sf_dir)).select("iot_id", "t_round", F.round("dt", 6).alias("dt"))


# transfer


@query(f" SELECT datastream_id, t // {HOUR * 24} * {HOUR * 24} AS bucket, arg_min(iot_id, (t, iot_id)) FILTER (WHERE result IS NOT NULL) AS iot_id FROM obs GROUP BY 1, 2")
def subsample_buckets(spark, sf_dir):
    return transfer.first_per_bucket(from_events(spark, sf_dir), "1d")


@query(
    """, p AS (SELECT arg_min(iot_id, (t, iot_id)) FILTER (WHERE result IS NOT NULL) AS iot_id FROM obs GROUP BY datastream_id, t // 600000000)
SELECT iot_id, datastream_id, t, result FROM obs SEMI JOIN p USING (iot_id)"""
)
def subsample_10min(spark, sf_dir):
    return transfer.subsample(from_events(spark, sf_dir), 0, 1 << 62).select("iot_id", "datastream_id", "t", "result")


def _old(spark, sf_dir) -> DataFrame:
    """A production table: what has an even id, with results doubled."""
    return from_events(spark, sf_dir).where("iot_id % 2 = 0").select("iot_id", "datastream_id", "t", (F.col("result") * 2).alias("result"))


@query(
    f""", o AS (SELECT iot_id, datastream_id, t, result * 2 AS result FROM obs WHERE iot_id % 2 = 0),
p AS (SELECT arg_min(iot_id, (t, iot_id)) AS iot_id FROM obs WHERE t BETWEEN {START + 5 * DAY} AND {START + 20 * DAY} AND result IS NOT NULL GROUP BY datastream_id, t // 600000000)
SELECT * FROM o UNION ALL SELECT iot_id, datastream_id, t, result FROM obs SEMI JOIN p USING (iot_id) WHERE iot_id NOT IN (SELECT iot_id FROM o)"""
)
def insert_absent(spark, sf_dir):
    raw = from_events(spark, sf_dir).select("iot_id", "datastream_id", "t", "result")
    return transfer.promote(raw, _old(spark, sf_dir), START + 5 * DAY, START + 20 * DAY)


@query(
    """ SELECT o.iot_id, o.datastream_id, o.t, CASE WHEN n.iot_id IS NULL THEN o.result * 2 ELSE n.result END AS result
FROM obs o LEFT JOIN (SELECT * FROM obs WHERE iot_id % 3 = 0) n USING (iot_id) WHERE o.iot_id % 2 = 0"""
)
def update_from(spark, sf_dir):
    return transfer.refresh(_old(spark, sf_dir), from_events(spark, sf_dir).where("iot_id % 3 = 0"), ["result"])


@query(" SELECT DISTINCT feature_id FROM obs WHERE result > 150")
def semi_join_features(spark, sf_dir):
    obs = from_events(spark, sf_dir)
    return transfer.referred(obs.select("feature_id").distinct(), obs.where("result > 150"))


@query(
    f""", l AS (SELECT DISTINCT feature_id AS id, 'place ' || feature_id AS name FROM obs)
SELECT l.id, l.name FROM l LEFT JOIN obs link ON link.feature_id = l.id LEFT JOIN obs hist ON hist.iot_id = link.iot_id WHERE hist.t BETWEEN {START + DAY} AND {START + 2 * DAY}"""
)
def linked_locations(spark, sf_dir):
    obs = from_events(spark, sf_dir)
    places = obs.select(F.col("feature_id").alias("id")).distinct().withColumn("name", F.format_string("place %d", "id"))
    links = obs.select(F.col("feature_id").alias("location_id"), F.col("iot_id").alias("hist_location_id"))
    return transfer.locations_between(places, links, obs.select(F.col("iot_id").alias("id"), "t"), START + DAY, START + 2 * DAY)


@query(" SELECT iot_id, CASE k % 4 WHEN 0 THEN CAST(iot_id AS VARCHAR) WHEN 1 THEN CASE WHEN result > 50 THEN 'true' ELSE 'false' END WHEN 2 THEN '{\"k\": ' || k || '}' ELSE observation_type END AS result FROM obs")
def typed_results(spark, sf_dir):
    df = from_events(spark, sf_dir).withColumns({
        "result_type": F.col("k") % 4, "result_number": F.col("iot_id"), "result_boolean": F.col("result") > 50,
        "result_json": F.format_string('{"k": %d}', "k"), "result_string": F.col("observation_type"),
    })
    return df.select("iot_id", transfer.typed_result().alias("result"))


# filters, sets, aggregates


@query(f" SELECT iot_id FROM obs WHERE t > {START + DAY} AND t < {START + 3 * DAY}")
def time_filter_strict(spark, sf_dir):
    return from_events(spark, sf_dir).where((F.col("t") > START + DAY) & (F.col("t") < START + 3 * DAY)).select("iot_id")


@query(f" SELECT iot_id FROM obs WHERE t BETWEEN {START + DAY} AND {START + 3 * DAY}")
def between_filter(spark, sf_dir):
    return from_events(spark, sf_dir).where(F.col("t").between(START + DAY, START + 3 * DAY)).select("iot_id")


@query(" SELECT iot_id, datastream_id FROM obs WHERE datastream_id IN (11, 25, 31, 72)")
def id_filter(spark, sf_dir):
    return from_events(spark, sf_dir).where(F.col("datastream_id").isin(11, 25, 31, 72)).select("iot_id", "datastream_id")


@query(f" SELECT iot_id, t FROM obs WHERE stream = 1 AND t > {START + 4 * DAY} AND t <= {START + 5 * DAY} UNION ALL SELECT iot_id, t FROM obs WHERE t > {START + 5 * DAY} AND t < {START + 6 * DAY}")
def union_windows(spark, sf_dir):
    df = from_events(spark, sf_dir)
    before = df.where((F.col("stream") == 1) & (F.col("t") > START + 4 * DAY) & (F.col("t") <= START + 5 * DAY))
    return before.unionByName(df.where((F.col("t") > START + 5 * DAY) & (F.col("t") < START + 6 * DAY))).select("iot_id", "t")


@query(" SELECT DISTINCT datastream_id FROM obs WHERE result > 100")
def distinct_streams(spark, sf_dir):
    return from_events(spark, sf_dir).where("result > 100").select("datastream_id").distinct()


@query(" SELECT DISTINCT thing_id FROM obs WHERE stream = 1 AND result > 120 AND thing_id NOT IN (SELECT thing_id FROM obs WHERE stream = 2 AND result > 120)")
def id_difference(spark, sf_dir):
    df = from_events(spark, sf_dir).where("result > 120")
    return df.where("stream = 1").select("thing_id").distinct().join(df.where("stream = 2").select("thing_id"), "thing_id", "left_anti")


@query(" SELECT arg_min(iot_id, (abs(result - 42.4), iot_id)) AS idx FROM obs")
def nearest_index(spark, sf_dir):
    return report.nearest_index(from_events(spark, sf_dir), "iot_id", "result", 42.4)


@query(" SELECT datastream_id, max(observation_type) AS observation_type, count(*) AS n, min(t) AS first_t, max(t) AS last_t FROM obs GROUP BY 1")
def stream_summary(spark, sf_dir):
    g = from_events(spark, sf_dir).groupBy("datastream_id")
    return g.agg(report.single_value("observation_type", "type").alias("observation_type"), F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


@query(" SELECT thing_id, bool_or(result > 200) AS any_high, CAST(count_if(result > 100) AS BIGINT) AS n_high, max(abs(result - 50)) AS largest FROM obs GROUP BY 1")
def boolean_aggregates(spark, sf_dir):
    r = F.col("result")
    return from_events(spark, sf_dir).groupBy("thing_id").agg(F.bool_or(r > 200).alias("any_high"), F.count_if(r > 100).alias("n_high"), F.max(F.abs(r - 50)).alias("largest"))


@query(" SELECT iot_id, t FROM obs ORDER BY t DESC, iot_id LIMIT 10 OFFSET 5")
def latest_page(spark, sf_dir):
    return from_events(spark, sf_dir).select("iot_id", "t").orderBy(F.desc("t"), "iot_id").offset(5).limit(10)


@query(" SELECT thing_id, string_agg(observation_type, '' ORDER BY t, iot_id) AS types FROM obs GROUP BY 1")
def string_concatenation(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("t", "iot_id", "observation_type")))
    return from_events(spark, sf_dir).groupBy("thing_id").agg(F.array_join(F.transform(rows, lambda x: x["observation_type"]), "").alias("types"))


@query(" SELECT thing_id, iot_id, result FROM (SELECT *, row_number() OVER (PARTITION BY thing_id ORDER BY t, iot_id) AS n FROM obs) WHERE n = 1")
def first_per_group(spark, sf_dir):
    w = Window.partitionBy("thing_id").orderBy("t", "iot_id")
    return from_events(spark, sf_dir).withColumn("n", F.row_number().over(w)).where("n = 1").select("thing_id", "iot_id", "result")


@query(" SELECT iot_id, strftime(make_timestamp(t), '%Y%m%d') AS day, observation_type || '(' || iot_id || ')' AS url FROM obs")
def formatted_fields(spark, sf_dir):
    day = F.date_format(F.timestamp_micros("t"), "yyyyMMdd")
    return from_events(spark, sf_dir).select("iot_id", day.alias("day"), F.format_string("%s(%s)", "observation_type", F.col("iot_id").cast("string")).alias("url"))


# nested responses


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations as nested responses, one a thing, as they would come over the wire."""
    o = from_events(spark, sf_dir)
    place = F.struct(F.col("feature_id").alias("@iot.id"), F.struct(F.array("longitude", "latitude").alias("coordinates")).alias("feature"))
    quality = F.when(F.col("k") % 7 == 0, "BAD").when(F.col("k") % 7 == 1, "2").otherwise("NO_QUALITY_CONTROL")
    one = F.struct(F.col("iot_id").alias("@iot.id"), "result", F.date_format(F.timestamp_micros("t"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("phenomenonTime"), quality.alias("resultQuality"), place.alias("FeatureOfInterest"))
    series = o.groupBy("thing_id", "datastream_id", "observation_type").agg(F.collect_list(one).alias("Observations"))
    named = F.struct(F.col("datastream_id").alias("@iot.id"), F.col("observation_type").alias("name"))
    data = F.struct(F.col("datastream_id").alias("@iot.id"), F.col("observation_type").alias("name"), F.create_map(F.lit("InstrDataItemID"), F.format_string("i%d", "datastream_id")).alias("properties"), named.alias("ObservedProperty"), "Observations")
    things = series.groupBy("thing_id").agg(F.collect_list(data).alias("Datastreams"))
    return things.select(F.from_json(F.to_json(F.struct("Datastreams")), RESPONSE).alias("r")).select("r.*")


@query(
    """ SELECT iot_id, datastream_id, t, result, CASE k % 7 WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 0 END AS qc_flag, feature_id, longitude, latitude, observation_type FROM obs"""
)
def flattened_responses(spark, sf_dir):
    return entities.flatten(_responses(spark, sf_dir)).select("iot_id", "datastream_id", "t", "result", "qc_flag", "feature_id", "longitude", "latitude", "observation_type")


@query(" SELECT datastream_id, max(observation_type) AS name, max(observation_type) AS name_observed_property, CAST(NULL AS VARCHAR) AS unit, 'i' || datastream_id AS instrument_item, count(*) AS n_observations FROM obs GROUP BY datastream_id")
def series_summary(spark, sf_dir):
    return entities.summary(_responses(spark, sf_dir))


@query(" SELECT DISTINCT datastream_id AS id, observation_type AS name, 'i' || datastream_id AS \"InstrDataItemID\", datastream_id AS \"@iot.id\", observation_type AS \"name_ObservedProperty\" FROM obs")
def expanded_properties(spark, sf_dir):
    d = _responses(spark, sf_dir).select(F.explode("Datastreams").alias("d"))
    d = d.select(F.col("d")["@iot.id"].alias("id"), F.col("d")["name"].alias("name"), F.col("d")["properties"].alias("properties"), F.struct(F.col("d")["ObservedProperty"]["@iot.id"].alias("@iot.id"), F.col("d")["ObservedProperty"]["name"].alias("name")).alias("ObservedProperty"))
    return entities.expanded(entities.expanded(d, "properties"), "ObservedProperty")


# incremental windows and the whole plan


@query(
    f""", w AS (SELECT n, {START} + n * {DAY} - {6 * HOUR} AS a, {START} + (n + 1) * {DAY} AS b FROM range(0, 30) r(n))
SELECT n, count(*) AS n_rows, min(t) AS first_t FROM w JOIN obs ON t > a AND t < b GROUP BY n"""
)
def overlap_windows(spark, sf_dir):
    df = incremental.in_windows(from_events(spark, sf_dir), START, START + 30 * DAY, "1d", "6h")
    return df.groupBy("n").agg(F.count(F.lit(1)).alias("n_rows"), F.min("t").alias("first_t"))


@query(f"SELECT n, {START} + n * {DAY} - {HOUR} AS window_start, {START} + (n + 1) * {DAY} AS window_stop FROM range(0, 8) r(n)")
def backfill_windows(spark, sf_dir):
    return incremental.intervals(spark, START, START + 7 * DAY + HOUR, "1d", "1h")


SETTINGS = Settings(
    bounds={1: {"range": (5.0, 120.0), "gradient": (-0.01, 0.01)}, 2: {"range": (1.0, 100.0)}, 3: {"zscore": (-1.5, 1.5)}},
    defaults={"range": (0.5, 300.0), "zscore": (-2.5, 2.5)}, rules=[RULE], zscore_window=WINDOW, location_window="3d", max_speed=0.8,
)


@query(
    f""", b(stream, lo, hi, gl, gh, zl, zh) AS (VALUES (1, 5.0::DOUBLE, 120.0::DOUBLE, -0.01::DOUBLE, 0.01::DOUBLE, -2.5::DOUBLE, 2.5::DOUBLE), (2, 1.0, 100.0, NULL, NULL, -2.5, 2.5),
  (3, 0.5, 300.0, NULL, NULL, -1.5, 1.5), (4, 0.5, 300.0, NULL, NULL, -2.5, 2.5), (5, 0.5, 300.0, NULL, NULL, -2.5, 2.5)),
m AS (SELECT *, quantile_cont(longitude, 0.5) OVER c AS x2, quantile_cont(latitude, 0.5) OVER c AS y2, (max(t) OVER c - min(t) OVER c) / 1e6 AS span
  FROM obs WINDOW c AS (PARTITION BY thing_id ORDER BY t RANGE BETWEEN {36 * HOUR} PRECEDING AND {36 * HOUR} FOLLOWING)),
q1 AS (SELECT *, greatest(CASE WHEN k % 10 = 0 THEN 2 WHEN k % 10 < 4 THEN 4 ELSE 0 END, CASE WHEN {HAV.format(x1="longitude", y1="latitude", x2="x2", y2="y2")} > 0.8 * span THEN 4 ELSE 0 END) AS f1 FROM m),
q2 AS (SELECT q1.*, gl, gh, zl, zh, greatest(f1, CASE WHEN result < lo OR result > hi THEN 4 ELSE 2 END) AS f2 FROM q1 JOIN b USING (stream)),
w AS (SELECT *, (t - lag(t) OVER s) / 1e6 AS hs, (lead(t) OVER s - t) / 1e6 AS hd, lag(result) OVER s AS pr, lead(result) OVER s AS nx FROM q2 WINDOW s AS (PARTITION BY datastream_id ORDER BY t, iot_id)),
g AS (SELECT *, CASE WHEN hs IS NULL THEN (nx - result) / nullif(hd, 0) WHEN hd IS NULL THEN (result - pr) / nullif(hs, 0)
  ELSE (hs * hs * nx + (hd * hd - hs * hs) * result - hd * hd * pr) / nullif(hs * hd * (hd + hs), 0) END AS gradient FROM w),
q3 AS (SELECT *, greatest(f2, CASE WHEN gl IS NULL OR gradient IS NULL THEN 0 WHEN gradient < gl OR gradient > gh THEN 4 ELSE 2 END) AS f3 FROM g),
z AS (SELECT iot_id, (result - avg(result) OVER f) / nullif(stddev_samp(result) OVER f, 0) AS z FROM q3 WHERE f3 <= 2 WINDOW f AS {FRAME}),
q4 AS (SELECT q3.*, greatest(f3, CASE WHEN z IS NULL THEN 0 WHEN z < zl OR z > zh THEN 4 ELSE 2 END) AS f4 FROM q3 LEFT JOIN z USING (iot_id)),
dep AS (SELECT * FROM q4 WHERE stream IN (3, 5)), ind AS (SELECT * FROM q4 WHERE stream = 1),
p AS (SELECT dep.iot_id, ind.f4 AS iq, ind.result AS ir, row_number() OVER (PARTITION BY dep.iot_id ORDER BY abs(dep.t - ind.t), ind.t, ind.iot_id) AS rn
  FROM dep JOIN ind ON dep.thing_id = ind.thing_id AND abs(dep.t - ind.t) <= {6 * HOUR}),
n AS (SELECT dep.iot_id, p.iq, p.ir, p.iot_id IS NULL AS missing FROM dep LEFT JOIN p ON p.iot_id = dep.iot_id AND p.rn = 1)
SELECT q4.iot_id, greatest(f4, coalesce(CASE WHEN n.missing THEN 4 WHEN iq <= 1 THEN 0 ELSE iq END, 0), coalesce(CASE WHEN ir < 5 OR ir > 100 THEN 4 END, 0)) AS qc_flag
FROM q4 LEFT JOIN n USING (iot_id)"""
)
def full_pipeline_flags(spark, sf_dir):
    df = from_events(spark, sf_dir).withColumn("region", region_name())
    return pipeline.run(df, SETTINGS, "stream", ["datastream_id"], "thing_id", ["thing_id"]).select("iot_id", "qc_flag")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the flags of the whole plan."""
    return report.flag_counts(full_pipeline_flags(spark, sf_dir)).orderBy("qc_flag")


