"""The command line and the place checks of the whole plan."""

import json

from pyspark.sql import functions as F

from tidewarden.functions import flags
from tidewarden.operators import report
from tidewarden.plans import pipeline, run
from tidewarden.plans.settings import Settings
from tidewarden.sources import entities

S = 1_000_000
BASE = 1_704_067_200 * S
TEXT = """
time: {format: "%Y-%m-%d %H:%M:%S", start: "2024-01-01 00:00:10", end: "2024-01-01 00:01:00"}
data_api: {dry_run: DRY, filter: {Datastreams: {ids: [1, 2]}}}
QC: [{id: 1, range: [0, 50]}]
QC_dependent: [{independent: 1, dependent: 2, dt_tolerance: 0.5s, dt_stabilization: 5s, max_allowed_downtime: 1s, QC: {range: [-1, 100]}}]
"""


def test_command_line(spark, tmp_path):
    rows = [(100 * d + i, 7, d, BASE + i * S, float(i), i % 3) for d in (1, 2, 3) for i in range(80)]
    spark.createDataFrame(rows, "iot_id long, thing_id long, datastream_id long, t long, result double, feature_id long").write.parquet(str(tmp_path / "in"))
    for dry in ("true", "false"):
        (tmp_path / "s.yaml").write_text(TEXT.replace("DRY", dry))
        assert run.main([str(tmp_path / "s.yaml"), "--observations", str(tmp_path / "in"), "--out", str(tmp_path / dry)], spark) == 0
    assert not (tmp_path / "true").exists()
    got = {int(p["id"]): p["body"]["resultQuality"] for p in (json.loads(r.value) for r in spark.read.text(str(tmp_path / "false/observations")).collect())}
    inside = range(11, 60)  # strict on both sides
    want = {100 + i: "BAD" if i > 50 or i <= 10 else "PROBABLY_GOOD" for i in inside} | {200 + i: "BAD" if i > 50 else "PROBABLY_GOOD" for i in inside}
    assert got == want
    assert run.main([str(tmp_path / "s.yaml"), "--observations", str(tmp_path / "in"), "--out", str(tmp_path / "r"), "reset.observation_flags=true", "reset.exit=true"], spark) == 0
    assert spark.read.text(str(tmp_path / "r/reset_observations")).count() == 98 and not (tmp_path / "r/observations").exists()  # the rows of the range
    steps = {x["iot_id"]: [s["label"] for s in x["steps"]] for x in (json.loads(r.value) for r in spark.read.text(str(tmp_path / "false/history")).collect())}
    assert set(steps) == {*(100 + i for i in inside), *(200 + i for i in range(51, 60))} | {200 + i for i in inside} and steps[155] == ["Range"]


def test_reset_keeps_flags(spark, tmp_path):
    """A row that was BAD and is found BAD again is BAD in the end; rows outside the run are left alone."""
    rows = [(100 * d + i, 7, d, BASE + i * S, float(i), i % 3, flags.BAD if i > 40 else flags.GOOD) for d in (1, 2, 3) for i in range(80)]
    spark.createDataFrame(rows, "iot_id long, thing_id long, datastream_id long, t long, result double, feature_id long, qc_flag int").write.parquet(str(tmp_path / "in"))
    (tmp_path / "s.yaml").write_text(TEXT.replace("DRY", "false").replace("QC_dependent", "#"))
    assert run.main([str(tmp_path / "s.yaml"), "--observations", str(tmp_path / "in"), "--out", str(tmp_path / "o"), "reset.observation_flags=true"], spark) == 0
    store = {r[0]: flags.NAMES[r[6]] for r in rows}
    for name in ("reset_observations", "observations"):
        for r in spark.read.text(str(tmp_path / "o" / name)).collect():
            p = json.loads(r.value)
            store[int(p["id"])] = p["body"]["resultQuality"]
    for i, _, d, t, x, _, before in rows:
        inside = d in (1, 2) and 10 < (t - BASE) // S < 60
        assert store[i] == (flags.NAMES[before] if not inside else ("BAD" if x > 50 else "PROBABLY_GOOD") if d == 1 else "NO_QUALITY_CONTROL")


def test_nothing_to_do(spark, tmp_path):
    spark.createDataFrame([], "iot_id long, thing_id long, datastream_id long, t long, result double, feature_id long").write.parquet(str(tmp_path / "in"))
    (tmp_path / "s.yaml").write_text(TEXT.replace("DRY", "false"))
    assert run.main([str(tmp_path / "s.yaml"), "--observations", str(tmp_path / "in"), "--out", str(tmp_path / "o")], spark) == 0
    assert not (tmp_path / "o").exists()


def test_places_from_settings(spark, tmp_path):
    square(spark, "MAINLAND", 0, 0, 2).write.parquet(str(tmp_path / "regions"))
    spark.createDataFrame([(5.1, 5.1, 7.0), (5.2, 5.2, 3.0)], "longitude double, latitude double, elevation double").write.parquet(str(tmp_path / "grid"))
    rows = [(0, 1, 1, BASE, 1.0, 1.0, 1.0), (1, 1, 1, BASE + S, 1.0, 5.15, 5.15), (2, 1, 1, BASE + 2 * S, 1.0, 9.0, 9.0)]
    spark.createDataFrame(rows, "iot_id long, thing_id long, datastream_id long, t long, result double, longitude double, latitude double").write.parquet(str(tmp_path / "in"))
    (tmp_path / "s.yaml").write_text(f"data_api: {{dry_run: false}}\nplaces: {{regions: {tmp_path}/regions, grid: {tmp_path}/grid, grid_step: 0.5}}\n")
    assert run.main([str(tmp_path / "s.yaml"), "--observations", str(tmp_path / "in"), "--out", str(tmp_path / "o")], spark) == 0
    got = {x["iot_id"]: [s["label"] for s in x["steps"]] for x in (json.loads(r.value) for r in spark.read.text(str(tmp_path / "o/history")).collect())}
    assert got == {0: ["Region mainland"], 1: ["Region nan", "Depth"], 2: ["Region nan"]}


def square(spark, name, x, y, size):
    c = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
    e = [(name, *map(float, c[i]), *map(float, c[(i + 1) % 4])) for i in range(4)]
    return spark.createDataFrame(e, "region string, x1 double, y1 double, x2 double, y2 double").groupBy("region").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))


def test_places(spark):
    pts = [(0, 0.5, 0.5), (1, 1.5, 0.5), (2, 2.6, 0.6), (3, 2.2, 0.6), (4, 8.0, 8.0)]
    df = spark.createDataFrame([(i, 1, 1, i * 3600 * S, 1.0, x, y, 0, 0) for i, x, y in pts], "iot_id long, thing_id long, datastream_id long, t long, result double, longitude double, latitude double, qc_flag int, feature_qc_flag int")
    regions = square(spark, "NORTH SEA", 0, 0, 1).union(square(spark, "MAINLAND EUROPE", 1, 0, 1)).union(square(spark, "NORTH SEA 2", 2, 0, 1))
    grid = spark.createDataFrame([(10, 2, 5.0), (8, 2, -5.0), (32, 32, 9.0)], "cell_i long, cell_j long, elevation double")
    out = {r.iot_id: r for r in pipeline.run(df, Settings(), places=pipeline.Places(regions, None, grid)).collect()}
    assert [out[i].region for i in range(5)] == ["NORTH SEA", "MAINLAND EUROPE", "NORTH SEA 2", "NORTH SEA 2", None]
    assert [out[i].qc_flag for i in range(5)] == [0, flags.BAD, flags.BAD, 0, flags.BAD]
    land = pipeline.Places(None, square(spark, "x", 2.5, 0.5, 0.5), grid)
    out = {r.iot_id: r for r in pipeline.run(df, Settings(), places=land).collect()}
    assert [out[i].qc_flag for i in range(5)] == [0, 0, flags.BAD, 0, 0] and out[2].feature_qc_flag == flags.BAD  # depth judges land rows only


def test_report_of_responses(spark, tmp_path):
    from tests.test_sources_plans import RESPONSES

    (tmp_path / "r.json").write_text(json.dumps(RESPONSES))
    [r] = report.from_responses(entities.read_responses(spark, str(tmp_path)), [7, 8]).collect()
    assert r["7__result"] == 2.5 and r["7__flag"] == flags.BAD and r["8__result"] is None and r.longitude == 3.0
