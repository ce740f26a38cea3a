"""Sources, sinks, settings, the whole plan, reports and incremental runs."""

import json

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidewarden.functions import durations, flags
from tidewarden.operators import dependent, report
from tidewarden.plans import pipeline, settings
from tidewarden.queries import SETTINGS
from tidewarden.sources import entities, sinks
from tidewarden.sources.schema import RESPONSE, from_events, region_name
from tidewarden.streaming import incremental

S = 1_000_000


@pytest.mark.parametrize("text,micros", [("0.5s", 500_000), ("20min", 1_200 * S), ("1h 30min", 5_400 * S), ("10 minutes", 600 * S), ("3d", 3 * 86_400 * S), (2, 2 * S), ("250ms", 250_000)])
def test_durations(text, micros):
    assert durations.to_micros(text) == micros


def test_wrong_durations():
    for text in ("", "5 parsecs", "min", "5min!"):
        with pytest.raises(ValueError):
            durations.to_micros(text)


def test_query_text():
    assert entities.ids_filter([12, 340, 5]) == "@iot.id eq 12 or @iot.id eq 340 or @iot.id eq 5"
    assert entities.time_filter("2022-05-01T06:00:00Z", "2022-05-02T06:00:00Z") == "phenomenonTime gt 2022-05-01T06:00:00Z and phenomenonTime lt 2022-05-02T06:00:00Z"
    url = entities.observations_query(1, where="result lt 17.25", streams=entities.ids_filter([7])).url()
    assert url == (
        "/Things(1)?$select=Datastreams&$expand=Datastreams($filter=@iot.id eq 7;$expand=Observations($filter=result lt 17.25;$count=false;"
        "$expand=FeatureOfInterest($select=feature/coordinates,@iot.id);$select=@iot.id,result,phenomenonTime,resultQuality),"
        "ObservedProperty($select=@iot.id,name),Sensor($select=name,@iot.id,description);$select=@iot.id,name,description,unitOfMeasurement/name,Observations)"
    )
    assert "$top=5;$skip=2" in entities.observations_query(1, n=5, skip=2).url()


RESPONSES = {
    "Datastreams": [
        {
            "@iot.id": 7, "name": "salinity", "description": "d", "unitOfMeasurement": {"name": "PSU"}, "ObservedProperty": {"@iot.id": 1, "name": "salinity"}, "Sensor": {"name": "s", "@iot.id": 2},
            "properties": {"InstrDataItemID": "99"},
            "Observations": [
                {"@iot.id": 1, "result": 2.5, "phenomenonTime": "2023-01-02T00:00:00.500Z", "resultQuality": "BAD", "FeatureOfInterest": {"@iot.id": 3, "feature": {"coordinates": [3.0, 51.0]}}},
                {"@iot.id": 2, "result": None, "phenomenonTime": "2023-01-02T00:00:01Z", "resultQuality": "1", "FeatureOfInterest": None},
            ],
        },
        {"@iot.id": 8, "name": "empty", "Observations": []},
    ]
}


def test_nested_responses(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps(RESPONSES))
    r = entities.read_responses(spark, str(tmp_path))
    assert r.schema == RESPONSE
    flat = {x.iot_id: x for x in entities.flatten(r).collect()}
    assert flat[1].longitude == 3.0 and flat[1].qc_flag == flags.BAD and flat[1].t % S == 500_000 and flat[1].units == "PSU"
    assert flat[2].result is None and flat[2].longitude is None and flat[2].qc_flag == flags.GOOD
    s = entities.summary(r)
    assert {x.datastream_id: (x.n_observations, x.instrument_item) for x in s.collect()} == {7: (2, "99"), 8: (0, None)}
    assert "  7: # name: salinity, type: salinity, unit: PSU, instrdataid: 99\n    range:\n" in entities.yaml_template(s).first().template


def test_expanded_columns(spark):
    df = spark.createDataFrame([(1, "a", {"name": "x", "k": "1"}), (2, "b", {"z": "2"}), (3, "c", None)], "id long, name string, properties map<string,string>")
    out = entities.expanded(df, "properties")
    assert out.columns == ["id", "name", "k", "name_properties", "z"] and [tuple(r) for r in out.orderBy("id").collect()] == [(1, "a", "1", "x", None), (2, "b", None, None, "2"), (3, "c", None, None, None)]
    with pytest.raises(ValueError):
        entities.expanded(df.withColumn("name_properties", F.lit(1)), "properties")


def test_batches_are_posted(spark):
    """Patches reach the server in batches, with a second try after a failure."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen, fail = [], [True]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            if fail:
                fail.pop()
                self.send_error(503)
                return
            seen.append((self.path, self.headers["Authorization"], body["requests"]))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"{}")

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        df = spark.createDataFrame([(i, flags.BAD) for i in range(25)], "iot_id long, qc_flag int").coalesce(1)
        post = sinks.http_batch(f"http://127.0.0.1:{server.server_port}/$batch", "u", "p", wait=0.01)
        sinks.send(sinks.patches(df), post, batch=10, dry_run=True)
        assert not seen
        sinks.send(sinks.patches(df), post, batch=10)
    finally:
        server.shutdown()
    assert [len(x[2]) for x in seen] == [10, 10, 5] and {x[0] for x in seen} == {"/$batch"} and all(x[1].startswith("Basic ") for x in seen)
    assert sorted(int(r["id"]) for x in seen for r in x[2]) == list(range(25))


def test_look_back_is_enough(spark):
    """A run over a window and its look-back gives the flags of a run over everything."""
    import numpy as np

    rng = np.random.default_rng(4)
    rows = [(i, 1, 1 + i % 3, int(t) * S, float(x)) for i, (t, x) in enumerate(zip(np.cumsum(rng.integers(20, 400, 600)), rng.normal(10, 3, 600)))]
    df = spark.createDataFrame(rows, "iot_id long, thing_id long, datastream_id long, t long, result double").withColumns({"qc_flag": F.lit(0), "feature_qc_flag": F.lit(0)})
    rules = [dependent.Rule(1, (2,), "5min", (4.0, 16.0), "30min", "10min", None), dependent.Rule(2, (3,), "5min", (3.0, 17.0), flag_when_missing=None)]
    s = settings.Settings(defaults={"range": (2.0, 18.0), "gradient": (-0.02, 0.02), "zscore": (-2.0, 2.0)}, rules=rules, zscore_window="1h")
    start = rows[400][3]
    whole = {r.iot_id: r.qc_flag for r in pipeline.run(df, s).where(F.col("t") > start).collect()}
    part = {r.iot_id: r.qc_flag for r in pipeline.run(df.where(F.col("t") > start - pipeline.needed_before(s)), s).where(F.col("t") > start).collect()}
    assert len(part) == 199 and part == whole


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, flags.BAD, 5, 4), (2, flags.GOOD, 5, 0), (3, 0, None, 0)], "iot_id long, qc_flag int, feature_id long, feature_qc_flag int")
    sinks.write_lines(sinks.patches(df), str(tmp_path / "a"), dry_run=True)
    assert not (tmp_path / "a").exists()
    sinks.write_lines(sinks.patches(df), str(tmp_path / "a"))
    got = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "a")).collect()]
    assert {"id": "1", "method": "patch", "url": "Observations(1)", "body": {"resultQuality": "BAD"}} in got and len(got) == 3
    assert [json.loads(r.value)["url"] for r in sinks.feature_patches(df).collect()] == ["FeaturesOfInterest(5)"]
    before = df.withColumn("qc_flag", F.lit(0))
    assert {r.iot_id for r in sinks.changed(before, df).collect()} == {1, 2}
    sinks.write_csv(df, str(tmp_path / "c"))
    assert sinks.read_csv(spark, str(tmp_path / "c"), df.schema).count() == 3
    assert sinks.combine({"n": 3, "deep": {"x": {"y": [1]}, "only": 0}}, {"n": 4, "deep": {"x": {"y": [2]}}, "new": "z"}) == {"n": 7, "deep": {"x": {"y": [1, 2]}, "only": 0}, "new": "z"}


def test_settings(tmp_path):
    text = """
time: {format: "%Y-%m-%d", start: "2024-01-01", end: "2024-02-01", date: {format: "%Y%m%d"}}
data_api: {base_url: "https://host/v1.1/", dry_run: false, things: {id: 1}, filter: {phenomenonTime: {format: "${time.format}", range: ["${time.start}", "${time.end}"]}}}
hydra: {run: {dir: "out/${date:${time.start},${time.format},${time.date.format}}"}}
location: {time_window: 10min, max_dx_dt: 6.89}
QC_dependent:
  - {independent: 1, dependent: "2,3", dt_tolerance: 0.5s, dt_stabilization: 20min, max_allowed_downtime: 15min, QC: {range: [0.2, 10.0]}}
QC: [{id: 2, range: [0, 1]}, {id: 2, range: [0, 2], gradient: [-1, 1]}]
QC_global: {zscore: {time_window: 60min, range: [-3.5, 3.5]}, range: {range: [-100, 100]}}
"""
    f = tmp_path / "a.yaml"
    f.write_text(text)
    s = settings.load(str(f), ["location.max_dx_dt=5"])
    assert s.bounds == {2: {"range": (0.0, 2.0), "gradient": (-1.0, 1.0)}} and s.max_speed == 5 and not s.dry_run and s.zscore_window == "60min"
    assert s.rules[0].dependent == (2, 3) and s.defaults["range"] == (-100.0, 100.0)
    assert pipeline.needed_before(s) == (3_600 + 3_000) * S + 500_000 and pipeline.needed_before(settings.Settings()) == 3_000 * S
    import yaml

    tree = settings.resolve(yaml.safe_load(text))
    assert tree["hydra"]["run"]["dir"] == "out/20240101" and tree["data_api"]["filter"]["phenomenonTime"]["range"] == ["2024-01-01", "2024-02-01"]
    assert settings.main(["--file", str(f)]) == 0
    (tmp_path / "b.yaml").write_text("QC: [{id: x, range: [1]}]\nwhat: 1\nlocation: {time_window: 5 parsecs}\n")
    assert len(settings.validate(yaml.safe_load((tmp_path / "b.yaml").read_text()))) == 4
    assert settings.main(["--folder", str(tmp_path)]) == 1
    assert settings.reformat_date("2019-11-30 23:59") == "20191130"


def test_report_round_trip(spark):
    rows = [(1, 1, 499_999, 1.0, 4), (2, 1, 400_000, 2.0, 0), (3, 1, 1_500_000, 3.0, 0), (4, 2, 2_500_000, 4.0, None), (5, 2, 100_000, 5.0, 0)]
    df = spark.createDataFrame(rows, "iot_id long, datastream_id long, t long, result double, qc_flag int")
    assert {r.iot_id: r.t_round for r in report.rounded(df).collect()} == {1: 0, 2: 0, 3: 2 * S, 4: 2 * S, 5: 0}  # halves to even
    best = report.best_per_second(df)
    assert {r.iot_id for r in best.collect()} == {2, 3, 4, 5}
    wide = report.pivoted(best, [1, 2])
    assert report.flag_columns(wide) == ["1__flag", "2__flag"]
    assert {(r.t_round, r.datastream_id, r.result) for r in report.long_form(wide, [1, 2]).collect()} == {(0, 1, 2.0), (2 * S, 1, 3.0), (2 * S, 2, 4.0), (0, 2, 5.0)}
    assert {r.t_round: r["2__flag"] for r in wide.collect()}[2 * S] == flags.MISSING


def test_single_value(spark):
    df = spark.createDataFrame([(None,), (8.0,), (8.0,)], "v double")
    assert df.agg(report.single_value("v").alias("x")).first().x == "8.0"
    assert df.where("v IS NULL").agg(report.single_value("v").alias("x")).first().x is None
    with pytest.raises(Exception, match="more than one"):
        spark.createDataFrame([(1.0,), (2.0,)], "v double").agg(report.single_value("v")).collect()


@pytest.mark.parametrize("seed", range(3))
def test_nearest_index(spark, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    values, target = rng.integers(0, 12, 30) / 4, float(rng.uniform(0, 3))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double")
    assert report.nearest_index(df, "i", "v", target).first().idx == int(np.argmin(np.abs(values - target)))  # the first of equals


def test_backfill_windows(spark):
    seen = []
    assert incremental.backfill(spark, 0, 25 * S, "10s", "2s", lambda a, b: seen.append((a, b))) == 3
    assert seen == [(-2 * S, 10 * S), (8 * S, 20 * S), (18 * S, 30 * S)]


def test_stream_equals_batch(spark, tmp_path):
    """Micro-batches with look-back give the flags of one run over everything that came before."""
    df = from_events(spark, SF).withColumn("region", region_name())
    cut = df.approxQuantile("t", [0.5], 0.0)[0]
    for n, part in enumerate((df.where(F.col("t") <= cut), df.where(F.col("t") > cut))):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    (tmp_path / "stream").mkdir()
    plan = lambda x: pipeline.run(x, SETTINGS, "stream", ["datastream_id"], "thing_id", ["thing_id"])
    out = {}
    for n in (0, 1):
        [f] = (tmp_path / f"in/{n}").glob("*.parquet")
        f.rename(tmp_path / f"stream/{n}.parquet")
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "stream"))
        q = incremental.on_stream(stream, lambda: df.where(F.col("t") <= cut), plan, lambda rows, b: out.update({r.iot_id: r.qc_flag for r in rows.collect()}), 1 << 50, str(tmp_path / "check"))
        q.awaitTermination(120)
    whole = {r.iot_id: r.qc_flag for r in plan(df).collect()}
    late = [i for i in whole if i in {r.iot_id for r in df.where(F.col("t") > cut).collect()}]
    assert set(out) == set(whole) and [out[i] for i in late] == [whole[i] for i in late]
