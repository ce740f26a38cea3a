"""Command line: check a table of observations, write patches, counts and history, and send the patches.

    python -m tidewarden.plans.run settings.yaml --observations in --out out [--send] [time.start=... other.setting=...]

``--observations`` is a Parquet table of observations, or a folder of landed nested responses with ``--responses``. The time
range of the settings is read with the look-back that the checks need; flags of the look-back aren't written. ``places`` in
the settings names the reference tables of the place checks: polygons as Parquet (region, edges) or a folder of shape files,
elevations as Parquet points. A reset blanks the flags of the rows of the range and ids, and what the checks then find is
compared with the blanks. The plan is evaluated once and written into the shared folder. With ``data_api.dry_run`` (the
default) counts are reported and nothing is written or sent.
"""

from __future__ import annotations

import argparse
import logging
import sys
import time
from contextlib import contextmanager
from datetime import UTC, datetime
from glob import glob

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions import flags
from ..operators import checks, report
from ..sources import entities, shapes, sinks
from . import pipeline, settings

log = logging.getLogger("tidewarden")


@contextmanager
def phase(name: str):
    """Log how long a phase takes."""
    began = time.perf_counter()
    try:
        yield
    finally:
        log.info("%s: %.1f s", name, time.perf_counter() - began)


def micros(text: str, form: str) -> int:
    return int(datetime.strptime(text, form).replace(tzinfo=UTC).timestamp() * 1_000_000)


def time_range(tree: dict) -> tuple[int | None, int | None]:
    t = settings.resolve(tree).get("time") or {}
    form = t.get("format", "%Y-%m-%d %H:%M:%S")
    return tuple(micros(str(t[k]), form) if t.get(k) else None for k in ("start", "end"))


def chosen(df: DataFrame, tree: dict, before: int = 0) -> DataFrame:
    """The rows of the settings' time range and ids; ``before`` microseconds more at its start."""
    start, end = time_range(tree)
    ids = (((tree.get("data_api") or {}).get("filter") or {}).get("Datastreams") or {}).get("ids")
    if ids:
        df = df.where(F.col("datastream_id").isin(*[int(i) for i in ids]))
    if start is not None:
        df = df.where(F.col("t") > start - before)
    return df if end is None else df.where(F.col("t") < end)


def places_of(spark: SparkSession, tree: dict) -> pipeline.Places | None:
    """The reference tables that the settings name."""
    p = tree.get("places") or {}
    if not p:
        return None

    def polygons(path: str | None) -> DataFrame | None:
        if not path:
            return None
        return shapes.read_polygons(spark, path) if path.endswith(".shp") or glob(f"{path}/*.shp") else spark.read.parquet(path)

    step = float(p.get("grid_step", 0.25))
    grid = shapes.grid_of(spark.read.parquet(p["grid"]), step) if p.get("grid") else None
    return pipeline.Places(polygons(p.get("regions")), polygons(p.get("land")), grid, step, float(p.get("max_elevation", 0.0)))


def checked(df: DataFrame, tree: dict, places: pipeline.Places | None = None, blank: tuple[str, ...] = ()) -> DataFrame:
    """The observations of the settings' time range and ids, with their flags, those before, and their history.

    blank: flag columns that have been reset in the store, so that checks and comparison begin with blank ones.
    """
    s = settings.Settings.of(tree)
    df = chosen(df, tree, pipeline.needed_before(s))
    for c, kind in (("qc_flag", "int"), ("feature_qc_flag", "int"), ("thing_id", "long"), ("feature_id", "long")):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(flags.NO_QC if c.endswith("flag") else None).cast(kind))
    df = df.withColumns({c: F.lit(flags.NO_QC) for c in blank})
    out = pipeline.run(df.withColumn("qc_flag_before", F.col("qc_flag")), s, places=places, keep_history=True)
    return chosen(out, tree)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    import yaml

    parser = argparse.ArgumentParser(description="Quality control of observations")
    parser.add_argument("settings")
    parser.add_argument("changes", nargs="*", help="a.b=value")
    parser.add_argument("--observations", required=True)
    parser.add_argument("--responses", action="store_true")
    parser.add_argument("--out", required=True)
    parser.add_argument("--send", action="store_true", help="post the patches to data_api.base_url too")
    a = parser.parse_intermixed_args(args)
    logging.basicConfig(level=logging.INFO, format="[%(asctime)s] %(message)s")
    with open(a.settings) as f:
        tree = settings.override(yaml.safe_load(f) or {}, a.changes)
    spark = spark or SparkSession.builder.appName("tidewarden").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    df = entities.flatten(entities.read_responses(spark, a.observations)) if a.responses else spark.read.parquet(a.observations)
    reset, api = tree.get("reset") or {}, settings.resolve(tree).get("data_api") or {}
    dry, auth = bool(api.get("dry_run", True)), api.get("auth") or {}
    post = sinks.http_batch(f"{str(api.get('base_url', '')).rstrip('/')}/$batch", auth.get("username"), auth.get("passphrase"))

    def deliver(lines: DataFrame, name: str) -> None:
        sinks.write_lines(lines, f"{a.out}/{name}", dry)
        if a.send:
            sinks.send(lines if dry else spark.read.text(f"{a.out}/{name}"), post, dry_run=dry)

    if reset.get("observation_flags") or reset.get("feature_flags"):
        with phase("reset"):
            blank = chosen(df, tree).withColumn("qc_flag", F.lit(flags.NO_QC)).withColumn("feature_qc_flag", F.lit(flags.NO_QC))
            if reset.get("observation_flags"):
                deliver(sinks.patches(blank), "reset_observations")
            if reset.get("feature_flags"):
                deliver(sinks.feature_patches(blank), "reset_features")
        if reset.get("exit"):
            return 0
    with phase("total"):
        gone = tuple(c for c, k in (("qc_flag", "observation_flags"), ("feature_qc_flag", "feature_flags")) if reset.get(k))
        out = storage.materialise(checked(df, tree, places_of(spark, tree), gone), "checked")
        if out.isEmpty():
            log.warning("no observations in the range: nothing to do")
            return 0
        with phase("counts"):
            for r in report.flag_counts(out).orderBy("qc_flag").collect():  # at most seven rows
                log.info("%s: %d", flags.NAMES.get(r.qc_flag, r.qc_flag), r.n)
        with phase("patches"):
            deliver(sinks.patches(out.where(~F.col("qc_flag").eqNullSafe(F.col("qc_flag_before")))), "observations")
            deliver(sinks.feature_patches(out), "features")
            sinks.write_lines(sinks.history_json(checks.history_rows(out)), f"{a.out}/history", dry)
    return 0


if __name__ == "__main__":
    sys.exit(main())
