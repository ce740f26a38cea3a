"""HTTP pages, shape files, the transfer log, and the joins of a promotion."""

import json
import struct
import threading
from datetime import datetime
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

from pyspark.sql import functions as F

from tidewarden.operators import joins, transfer
from tidewarden.sources import http, shapes
from tidewarden.streaming import schedule

ROWS = [{"@iot.id": i, "result": i / 2 if i % 5 else None, "phenomenonTime": f"2024-01-01T00:00:{i:02d}Z", "resultQuality": "1", "Datastream": {"@iot.id": i % 3}} for i in range(25)]


class Handler(BaseHTTPRequestHandler):
    failed = set()

    def do_GET(self):
        q = parse_qs(urlparse(self.path).query)
        top, skip = int(q["$top"][0]), int(q["$skip"][0])
        if skip and self.path not in Handler.failed:  # each page fails once
            Handler.failed.add(self.path)
            self.send_error(503)
            return
        rows = [r for r in ROWS if "$filter" not in q or r["@iot.id"] >= 5]
        body = json.dumps({"@iot.count": len(rows), "value": rows[skip : skip + top]}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *a):
        pass


def test_http_source(spark):
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        http.register(spark)
        read = spark.read.format("sensor_observations").option("url", f"http://127.0.0.1:{server.server_port}/v1.1").option("top", "10")
        got = {r.iot_id: r for r in read.load().collect()}
        assert set(got) == set(range(25)) and got[5].result is None and got[7].result == 3.5 and got[7].datastream_id == 1
        assert read.option("filter", "@iot.id ge 5").load().count() == 20
    finally:
        server.shutdown()


def test_shape_files(spark, tmp_path):
    outer, hole = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)], [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]
    points = outer + hole
    body = struct.pack("<i4d", 5, 0, 0, 4, 4) + struct.pack("<ii2i", 2, len(points), 0, len(outer)) + b"".join(struct.pack("<2d", *p) for p in points)
    (tmp_path / "land.shp").write_bytes(bytes(100) + struct.pack(">ii", 1, len(body) // 2) + body)
    land = shapes.read_polygons(spark, str(tmp_path))
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 9.0, 9.0), (4, 3.5, 2.0)], "iot_id long, longitude double, latitude double")
    got = {r.iot_id: r.region for r in joins.in_polygons(pts, land).collect()}
    assert got == {1: "land.shp#1", 2: None, 3: None, 4: "land.shp#1"}
    grid = shapes.grid_of(pts.withColumn("elevation", F.col("iot_id").cast("double")), 4.0)
    assert {(r.cell_i, r.cell_j): r.elevation for r in grid.collect()} == {(0, 0): 7 / 3, (2, 2): 3.0}


def test_transfer_log(spark, tmp_path):
    log = ["2024-03-01 10:00:00 start", "2024-03-01 10:05:00 QC data from 2024-03-01 09:50:00 to 2024-03-01 10:00:00.", "2024-03-01 10:15:00 QC data from 2024-03-01 10:00:00 to 2024-03-01 10:10:00.", "2024-03-01 10:25:00 QC broken line"]
    (tmp_path / "log.txt").write_text("\n".join(log))
    lines = schedule.numbered(spark.read.text(str(tmp_path / "log.txt")))
    assert [r.value for r in schedule.last_matches(lines, "QC ", 2).collect()] == log[:1:-1]
    [r] = schedule.due(lines, datetime(2024, 3, 1, 10, 5)).collect()
    assert (r.window_start, r.window_stop, r.transfer_from) == (datetime(2024, 3, 1, 9, 10), datetime(2024, 3, 1, 10, 10), datetime(2024, 3, 1, 10, 0))
    own = spark.createDataFrame([(1, "[2024-03-01 09:00:00] - Start QC script."), (2, "other")], "line int, value string")
    assert schedule.previous_run(own).first().previous == datetime(2024, 3, 1, 9)


def test_promotion(spark):
    cols = "iot_id long, datastream_id long, t long, result double"
    raw = spark.createDataFrame([(1, 1, 5, None), (2, 1, 6, 2.0), (3, 1, 7, 3.0), (4, 1, 600_000_001, 4.0), (5, 2, 1, 5.0), (6, 2, 2, None)], cols)
    assert {r.iot_id for r in transfer.subsample(raw, 0, 10**9).collect()} == {2, 4, 5}
    assert {r.iot_id for r in transfer.subsample(raw, 0, 10).collect()} == {2, 5}
    old = spark.createDataFrame([(2, 1, 6, 9.0)], cols)
    assert {(r.iot_id, r.result) for r in transfer.promote(raw, old, 0, 10**9).collect()} == {(2, 9.0), (4, 4.0), (5, 5.0)}
    assert [r.result for r in transfer.refresh(old, raw, ["result"]).collect()] == [2.0]
    places, links = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string"), spark.createDataFrame([(1, 7), (2, 8), (1, 9)], "location_id long, hist_location_id long")
    hist = spark.createDataFrame([(7, 5), (8, 50), (9, 6)], "id long, t long")
    assert [r.name for r in transfer.locations_between(places, links, hist, 0, 10).collect()] == ["a", "a"]
    typed = spark.createDataFrame([(0, 1.5, None, None, None), (1, None, True, None, None), (2, None, None, "{}", None), (3, None, None, None, "x")], "result_type int, result_number double, result_boolean boolean, result_json string, result_string string")
    assert [r.x for r in typed.select(transfer.typed_result().alias("x")).collect()] == ["1.5", "true", "{}", "x"]
