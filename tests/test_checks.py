"""Checks on small series: clause by clause."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewarden.functions import flags
from tidewarden.operators import checks, dependent, joins

S = 1_000_000
COLS = "iot_id long, datastream_id long, thing_id long, t long, result double, longitude double, latitude double, qc_flag int, region string"


HALF = 6


def table(spark, at=None, without=()):
    """Two series of HALF rows each, at equal times; values and a slow track drawn with a seed."""
    rng, rows = np.random.default_rng(11), []
    for i in range(2 * HALF):
        d, k = divmod(i, HALF)
        rows.append(dict(iot_id=i, datastream_id=d, thing_id=0, t=k * 4 * S, result=float(rng.uniform(1, 9)), longitude=-30 + rng.normal(0, 1e-4), latitude=12 + rng.normal(0, 1e-4), qc_flag=0, region=None))
    for (i, c), v in (at or {}).items():
        rows[i][c] = v
    rows = [r for i, r in enumerate(rows) if i not in without]
    names = [c.split()[0] for c in COLS.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], COLS)


def metres(lon1, lat1, lon2, lat2):
    """Great-circle distance by the angle between two unit vectors."""
    u, v = ([np.cos(np.radians(y)) * np.cos(np.radians(x)), np.cos(np.radians(y)) * np.sin(np.radians(x)), np.sin(np.radians(y))] for x, y in ((lon1, lat1), (lon2, lat2)))
    return 6371008.8 * np.arctan2(np.linalg.norm(np.cross(u, v)), np.dot(u, v))


def by_id(df, *cols):
    return {r[0]: r[1] if len(cols) == 1 else tuple(r[1:]) for r in df.select("iot_id", *cols).collect()}


def test_flag_lattice(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    got = [r.f for r in df.select(flags.from_bool(F.col("b"), flags.BAD, flags.GOOD, flags.PROBABLY_GOOD).alias("f")).collect()]
    assert got == [flags.BAD, flags.GOOD, flags.PROBABLY_GOOD]
    one = spark.range(1).select(flags.merge(F.lit(None).cast("int"), F.lit(flags.GOOD)).alias("a"), flags.merge(F.lit(flags.PROBABLY_BAD), F.lit(flags.GOOD)).alias("b"), flags.merge(F.lit(None).cast("int")).alias("c")).first()
    assert tuple(one) == (flags.GOOD, flags.PROBABLY_BAD, flags.NO_QC)
    names = spark.createDataFrame([(k,) for k in flags.NAMES], "f int").select("f", flags.code_of(flags.name_of(F.col("f"))).alias("g")).collect()
    assert all(r.f == r.g for r in names)


def test_range_is_inclusive_and_three_valued(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (0.9, 1.0, 2.0), (2.1, 1.0, 2.0), (5.0, None, None), (0.5, 1.0, None), (None, 1.0, 2.0), (float("nan"), 1.0, 2.0)], "v double, lo double, hi double")
    assert [r.b for r in df.select(checks.out_of_range("v", "lo", "hi").alias("b")).collect()] == [False, True, True, None, True, None, None]


def test_bounds_must_be_unique(spark):
    df = spark.createDataFrame([(1, 1.0)], "datastream_id long, result double")
    b = spark.createDataFrame([(1, 0.0), (1, 2.0)], "datastream_id long, qc_range_min double")
    with pytest.raises(Exception, match="not unique"):
        checks.with_bounds(df, b).collect()


@pytest.mark.parametrize("seed", range(3))
def test_gradient_equals_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    t, f = np.cumsum(rng.integers(1, 50, 30)) * 100_000, rng.normal(size=30)
    df = spark.createDataFrame([(i, 1, int(a), float(b)) for i, (a, b) in enumerate(zip(t, f))], "iot_id long, datastream_id long, t long, result double")
    got = by_id(checks.with_gradient(df, "datastream_id"), "gradient")
    assert np.allclose([got[i] for i in range(30)], np.gradient(f, t / 1e6))


def test_gradient_of_single_rows_and_equal_times(spark):
    df = spark.createDataFrame([(0, 1, 0, 1.0), (1, 2, 0, 1.0), (2, 2, 0, 2.0)], "iot_id long, datastream_id long, t long, result double")
    assert set(by_id(checks.with_gradient(df, "datastream_id"), "gradient").values()) == {None}


def test_zscore(spark):
    df = spark.createDataFrame([(i, 1, i * 60 * S, float(v)) for i, v in enumerate([1, 2, 1, 2, 1, 2, 50])], "iot_id long, datastream_id long, t long, result double")
    got = by_id(checks.with_zscore(df, "60min", "datastream_id"), "zscore")
    seen = np.array([1, 2, 1, 2, 1, 2, 50.0])
    assert got[0] is None and np.isclose(got[6], (50 - seen.mean()) / seen.std(ddof=1))
    modified = by_id(checks.with_zscore(df, "60min", "datastream_id", kind="modified"), "zscore")
    assert np.isclose(modified[6], 0.6745 * (50 - 2) / 1)
    some = by_id(checks.with_zscore(df, "60min", "datastream_id", eligible=F.col("result") < 40), "zscore")
    assert some[6] is None and np.isclose(some[5], (2 - 1.5) / np.std([1, 2, 1, 2, 1, 2], ddof=1))


def drawn_track(seed, n=18):
    """(iot_id, thing_id, t, longitude, latitude): a slow walk with a few far jumps and uneven steps of time."""
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.integers(3, 60, n)) * S
    lon, lat = -7.5 + np.cumsum(rng.normal(0, 2e-4, n)), 43.2 + np.cumsum(rng.normal(0, 2e-4, n))
    far = rng.choice(n, 3, replace=False)
    lon[far] += rng.choice([-0.9, 0.7], 3)
    return [(i, 0, int(a), float(x), float(y)) for i, (a, x, y) in enumerate(zip(t, lon, lat))]


TRACK = "iot_id long, thing_id long, t long, longitude double, latitude double"


@pytest.mark.parametrize("seed", range(4))
def test_spatial_outlier_equals_brute_force(spark, seed):
    rows, half, speed = drawn_track(seed), 120 * S, 40.0
    want = set()
    for i, _, t, x, y in rows:
        near = [r for r in rows if abs(r[2] - t) <= half]
        span = (max(r[2] for r in near) - min(r[2] for r in near)) / S
        if metres(x, y, np.median([r[3] for r in near]), np.median([r[4] for r in near])) > speed * span:
            want.add(i)
    got = by_id(checks.with_spatial_outlier(spark.createDataFrame(rows, TRACK), speed, "4min", "thing_id"), "spatial_outlier")
    assert want and {i for i, x in got.items() if x} == want


def moved(rows):
    """Velocity and acceleration to the next row, the last ones repeated."""
    v = [metres(*a[3:], *b[3:]) / ((b[2] - a[2]) / S) for a, b in zip(rows, rows[1:])]
    v = np.array([*v, v[-1]])
    a = [(v[i + 1] - v[i]) / ((rows[i + 1][2] - rows[i][2]) / S) for i in range(len(rows) - 1)]
    return v, np.array([*a, a[-1]])


@pytest.mark.parametrize("seed", range(3))
def test_kinematics_equal_brute_force(spark, seed):
    rows = drawn_track(seed)
    v, a = moved(rows)
    df = checks.with_kinematics(spark.createDataFrame(rows, TRACK), "thing_id")
    got = by_id(df, "velocity", "acceleration")
    assert np.allclose([got[i] for i in range(len(rows))], np.stack([v, a], 1), rtol=1e-6, atol=1e-9)
    limit = float(np.median(v))
    assert {i for i, x in by_id(df.withColumn("b", checks.exceeds("velocity", limit)), "b").items() if x} == set(np.nonzero(v > limit)[0])
    limit = float(np.median(np.abs(a)))
    assert {i for i, x in by_id(df.withColumn("b", checks.exceeds("acceleration", limit)), "b").items() if x} == set(np.nonzero(np.abs(a) > limit)[0])


def test_kinematics_pass_over_rows(spark):
    rows = drawn_track(7)
    out = {2, 9, len(rows) - 1}
    kept = [r for r in rows if r[0] not in out]
    v, a = moved(kept)
    got = by_id(checks.with_kinematics(spark.createDataFrame(rows, TRACK), "thing_id", leave_out=F.col("iot_id").isin(*out)), "velocity", "acceleration")
    assert all(got[i] == (None, None) for i in out)
    assert np.allclose([got[r[0]] for r in kept], np.stack([v, a], 1), rtol=1e-6, atol=1e-9)


def up_and_down(rows, low, high, allowed, needed):
    """iot_id -> BAD or NO_QC, by walking over the rows (iot_id, t, result) of one series."""
    out, since, last_up = {}, None, None
    for i, t, x in sorted(rows, key=lambda r: (r[1], r[0])):
        first = since is None
        if first or low < x < high:
            last_up = t
        if first or t - last_up > allowed:
            since = t
        out[i] = flags.BAD if t - since < needed else flags.NO_QC
    return out


@pytest.mark.parametrize("seed", range(3))
def test_stabilisation_equals_a_walk(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, int(t), float(x)) for i, (t, x) in enumerate(zip(np.cumsum(rng.integers(1, 9, 60)) * 60 * S, rng.uniform(0, 10, 60)))]
    low, high, allowed, needed = 1.5, 8.0, 11 * 60 * S, 47 * 60 * S
    df = spark.createDataFrame([(i, 1, t, x, low, high, allowed, needed) for i, t, x in rows], "iot_id long, datastream_id long, t long, result double, low double, high double, max_downtime long, dt_stabilization long")
    got = by_id(checks.with_stabilisation(df, "datastream_id"), "stabilisation_flag", "within_limits", "block_id")
    assert {i: g[0] for i, g in got.items()} == up_and_down(rows, low, high, allowed, needed)
    inside = [low < x < high for _, _, x in rows]
    assert [got[i][1] for i in range(60)] == inside
    assert [got[i][2] for i in range(60)] == (1 + np.cumsum([False, *(a != b for a, b in zip(inside, inside[1:]))])).tolist()


RULE = dependent.Rule(0, (1,), "0.5s", range=(0.0, 10.0))


def test_dependent_takes_a_bad_flag(spark):
    df = table(spark, {(i, "qc_flag"): flags.BAD for i in (1, 4)})
    got = by_id(joins.combine_max(df, dependent.base(df, RULE)), "qc_flag")
    assert {k for k, f in got.items() if f == flags.BAD} == {1, 4, HALF + 1, HALF + 4}


def test_good_flags_are_not_copied(spark):
    df = table(spark, {(2, "qc_flag"): flags.GOOD, (5, "qc_flag"): flags.PROBABLY_BAD})
    got = by_id(dependent.base(df, RULE), "qc_flag")
    assert got[HALF + 2] == flags.NO_QC and got[HALF + 5] == flags.PROBABLY_BAD


@pytest.mark.parametrize("missing,expected", [(flags.BAD, {HALF + 3}), (flags.PROBABLY_BAD, {HALF + 3}), (None, set())])
def test_dependent_without_independent(spark, missing, expected):
    rule = dependent.Rule(0, (1,), "0.5s", flag_when_missing=missing)
    for df in (table(spark, without=(3,)), table(spark, {(3, "t"): 9_000 * S})):
        got = by_id(joins.combine_max(df, dependent.base(df, rule)), "qc_flag")
        assert {k for k, f in got.items() if f} == expected and all(got[k] == missing for k in expected)


def test_independent_without_dependent(spark):
    df = table(spark, {(2, "qc_flag"): flags.BAD}, without=(HALF + 2,))
    got = by_id(joins.combine_max(df, dependent.base(df, RULE)), "qc_flag")
    assert {k for k, f in got.items() if f} == {2}


def test_secondary(spark):
    df = table(spark, {(4, "result"): 41.5, (0, "result"): 0.0, (5, "result"): 10.0}, without=(1,))
    got = by_id(joins.combine_max(df, dependent.secondary(df, RULE)), "qc_flag")
    assert {k for k, f in got.items() if f} == {HALF + 4}  # the bounds are inside; a missing independent says nothing


def test_rules_see_earlier_rules(spark):
    rows = [(i, i, 0, 0, 1.0, 0.0, 0.0, flags.BAD if i == 0 else 0, None) for i in range(3)]
    df = spark.createDataFrame(rows, COLS)
    rules = [dependent.Rule(0, (1,)), dependent.Rule(1, (2,))]
    assert len(dependent.layers(rules)) == 2
    assert by_id(dependent.apply_rules(df, rules), "qc_flag") == {0: 4, 1: 4, 2: 4}
    assert by_id(dependent.apply_rules(df, rules[::-1]), "qc_flag") == {0: 4, 1: 4, 2: 0}
    assert dependent.Rule.ids("7,8, 9") == (7, 8, 9) and dependent.Rule.ids(7) == (7,)


#: Ten rules over fourteen series: independent, dependent, range, stabilisation. Some independent series depend on others.
TEN = [
    (1, (2, 3), (2.0, 8.0), None), (4, (5, 6, 7), (1.0, 9.0), "20s"), (8, (9, 10), (1.0, 9.0), "30s"), (11, (2, 3, 12, 13), (3.0, 9.5), None), (14, (12, 13), (0.5, 9.0), None),
    (14, (2,), (0.5, 8.5), "45s"), (5, (7,), (1.0, 9.0), None), (6, (7,), (2.0, 9.0), None), (9, (10,), (1.0, 8.0), None), (12, (13,), (0.0, 7.0), None),
]


def ten_rules():
    return [dependent.Rule(i, d, "2s", r, s, "8s" if s else None, flags.PROBABLY_BAD) for i, d, r, s in TEN]


def observations(seed=3, n=40):
    """(iot_id, datastream_id, thing_id, t, result, qc_flag) of fourteen series of two things."""
    rng, rows = np.random.default_rng(seed), []
    for thing in (1, 2):
        for d in range(1, 15):
            for t in np.cumsum(rng.integers(1, 6, n)):
                rows.append((len(rows), d, thing, int(t) * S, float(rng.uniform(0, 10)), int(rng.choice([0, 0, 1, 2, 4]))))
    return rows


def walked(rows, rules):
    """The flags after stabilisation and all rules, rule after rule and row after row."""
    state = {r[0]: r[5] for r in rows}
    of = lambda thing, d: [r for r in rows if r[1] == d and r[2] == thing]

    def apply(rule, secondary):
        new = {}
        for thing in (1, 2):
            independent = of(thing, rule.independent)
            for r in (x for d in rule.dependent for x in of(thing, d)):
                near = min(((abs(q[3] - r[3]), q[3], q[0], q) for q in independent if abs(q[3] - r[3]) <= 2 * S), default=None)
                f = (rule.flag_when_missing or 0) if near is None else state[near[2]] if state[near[2]] > flags.GOOD else 0
                if secondary and near and not rule.range[0] <= near[3][4] <= rule.range[1]:
                    f = flags.BAD
                new[r[0]] = max(f, new.get(r[0], 0))
        for i, f in new.items():
            state[i] = max(state[i], f)

    for rule in rules:
        if rule.stabilisation:
            for thing in (1, 2):
                for i, f in up_and_down([(r[0], r[3], r[4]) for r in of(thing, rule.independent)], *rule.range, 8 * S, int(rule.stabilisation[:-1]) * S).items():
                    state[i] = max(state[i], f)
            apply(dependent.Rule(rule.independent, rule.dependent, flag_when_missing=None), False)
    for rule in rules:
        apply(rule, True)
    return state


def test_ten_rules_equal_a_walk(spark):
    rows, rules = observations(), ten_rules()
    df = spark.createDataFrame(rows, "iot_id long, datastream_id long, thing_id long, t long, result double, qc_flag int")
    out = dependent.apply_rules(dependent.stabilised(df, rules, within=["thing_id"]), rules, within=["thing_id"])
    assert by_id(out, "qc_flag") == walked(rows, rules)


def test_plans_grow_with_layers_at_most(spark):
    """However many rules a layer has, its plan reads the table as often."""

    def scans(n):
        df = spark.createDataFrame(observations(n=2), "iot_id long, datastream_id long, thing_id long, t long, result double, qc_flag int")
        rules = [dependent.Rule(1, (2 + i % 12,), "2s", (1.0, 5.0), "9s", "3s") for i in range(n)]
        out = dependent.apply_rules(dependent.stabilised(df, rules), rules)
        return str(out._jdf.queryExecution().executedPlan()).count("Scan")

    assert scans(1) == scans(12) <= 6  # the table and its state, each twice, and the rules


def test_nearest_in_time_equals_pandas(spark):
    import pandas as pd

    rng = np.random.default_rng(5)
    left = pd.DataFrame({"iot_id": range(300), "k": rng.integers(0, 3, 300), "t": rng.integers(0, 10**7, 300)})
    right = pd.DataFrame({"iot_id": range(500), "k": rng.integers(0, 3, 500), "t": rng.integers(0, 10**7, 500)})
    got = {r.iot_id: r.near and r.near.t for r in joins.nearest_in_time(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "10ms", []).collect()}
    best = {}
    for r in left.itertuples():
        near = right[(right.k == r.k) & ((right.t - r.t).abs() <= 10_000)]
        best[r.iot_id] = None if near.empty else min((abs(t - r.t), t) for t in near.t)[1]
    assert got == best


def test_regions(spark):
    df = spark.createDataFrame([(0, "GULF"), (1, "Mainland"), (2, "the mainland, north"), (3, None), (4, "nan")], "iot_id long, region string")
    assert by_id(df.withColumn("b", checks.region_missing()), "b") == {0: False, 1: False, 2: False, 3: True, 4: True}
    assert by_id(df.withColumn("b", checks.region_on_land()), "b") == {0: False, 1: True, 2: True, 3: False, 4: False}


@pytest.mark.parametrize("cell", [0.3, 1.0, 25.0])
def test_polygons_equal_ray_casting(spark, cell):
    """Rings with holes, shared names and corners on the sides of cells; points on a grid."""
    rng = np.random.default_rng(2)

    def ring(x, y, size, n):
        a, r = np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(0.4, 1, n) * size
        return [(float(x + q * np.cos(p)), float(y + q * np.sin(p))) for p, q in zip(a, r)]

    shapes = [("b", [ring(1, 1, 3, 40), ring(1, 1, 0.4, 9)]), ("a", [ring(3, 2, 2, 25)]), ("a", [[(-1.0, -1.0), (2.0, -1.0), (2.0, 2.0), (-1.0, 2.0)]]), ("c", [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]])]
    rows = [(name, [(*r[i], *r[(i + 1) % len(r)]) for r in rings for i in range(len(r))]) for name, rings in shapes]
    polygons = spark.createDataFrame(rows, "region string, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-3, 6, (400, 2)))] + [(1000 + i, None, 1.0) for i in range(2)]

    def holds(edges, x, y):
        return sum((b > y) != (d > y) and x < a + (y - b) * (c - a) / (d - b) for a, b, c, d in edges) % 2 == 1

    want = {i: None if x is None else min((name for name, e in rows if holds(e, x, y)), default=None) for i, x, y in points}
    df = spark.createDataFrame(points, "iot_id long, longitude double, latitude double")
    assert by_id(joins.in_polygons(df, polygons, cell), "region") == want
    assert joins.in_polygons(df, polygons.limit(0)).where("region IS NOT NULL").count() == 0


def test_polygons_with_edges_in_any_order(spark):
    """Edges come in another order each time that they are read, as collect_list after a shuffle gives them."""
    corners = [(0.0, 0.0), (3.5, 0.5), (4.0, 4.0), (2.0, 2.5), (0.5, 3.5)]
    edges = [("a", *corners[i], *corners[(i + 1) % 5]) for i in range(5)]
    edge = "struct<x1:double,y1:double,x2:double,y2:double>"
    mixed = F.udf(lambda e: random.sample(e, len(e)), f"array<{edge}>").asNondeterministic()
    rings = spark.createDataFrame(edges, "region string, x1 double, y1 double, x2 double, y2 double").groupBy("region").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("e"))
    df = spark.range(400).select(F.col("id").alias("iot_id"), (F.col("id") % 20 * 0.23 - 0.11).alias("longitude"), (F.floor(F.col("id") / 20) * 0.23 - 0.11).alias("latitude"))
    want = by_id(joins.in_polygons(df, rings.select("region", F.col("e").alias("edges"))), "region")
    assert sum(x is not None for x in want.values()) > 100
    for _ in range(3):
        assert by_id(joins.in_polygons(df, rings.select("region", mixed("e").alias("edges"))), "region") == want


def test_empty_tables(spark):
    df = table(spark).limit(0)
    assert checks.with_gradient(df, "datastream_id").count() == 0
    assert dependent.apply_rules(df, [RULE]).count() == 0
    assert checks.with_kinematics(df, "thing_id").count() == 0
