"""Sinks: flag patches, reports and histories. Every writer takes ``dry_run`` and then leaves the store alone."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions import flags

log = logging.getLogger(__name__)


def patches(df: DataFrame, key: str = "iot_id", flag: str = "qc_flag", entity: str = "Observations") -> DataFrame:
    """One JSON patch per row: id, method, url and body with the flag's name."""
    body = F.struct(flags.name_of(F.col(flag)).alias("resultQuality"))
    patch = F.struct(F.col(key).cast("string").alias("id"), F.lit("patch").alias("method"), F.format_string(f"{entity}(%s)", F.col(key).cast("string")).alias("url"), body.alias("body"))
    return df.select(F.to_json(patch).alias("value"))


def feature_patches(df: DataFrame) -> DataFrame:
    """Patches of features: the worst flag of each feature."""
    per = df.where("feature_id IS NOT NULL").groupBy("feature_id").agg(F.max("feature_qc_flag").alias("feature_qc_flag"))
    body = F.struct(F.struct(flags.name_of(F.col("feature_qc_flag")).alias("resultQuality")).alias("properties"))
    patch = F.struct(F.col("feature_id").cast("string").alias("id"), F.lit("patch").alias("method"), F.format_string("FeaturesOfInterest(%s)", F.col("feature_id").cast("string")).alias("url"), body.alias("body"))
    return per.select(F.to_json(patch).alias("value"))


def changed(before: DataFrame, after: DataFrame, key: str = "iot_id", flag: str = "qc_flag") -> DataFrame:
    """The rows whose flag isn't what it was."""
    old = before.select(key, F.col(flag).alias("_old"))
    return after.join(old, key).where(~F.col(flag).eqNullSafe(F.col("_old"))).drop("_old")


def write_lines(lines: DataFrame, path: str, dry_run: bool = False) -> None:
    if dry_run:
        log.info("dry run: nothing written to %s", path)
    else:
        lines.write.mode("overwrite").text(path)


def http_batch(url: str, user: str | None = None, passphrase: str | None = None, tries: int = 3, wait: float = 0.5) -> Callable[[list[str]], None]:
    """A function that posts patches as one JSON batch request to ``url``, and again after failures, waiting longer each time."""

    def post(held: list[str]) -> None:
        import base64
        import time
        from urllib.error import URLError
        from urllib.request import Request, urlopen

        body = ('{"requests":[' + ",".join(held) + "]}").encode()
        head = {"Content-Type": "application/json"}
        if user and passphrase:
            head["Authorization"] = "Basic " + base64.b64encode(f"{user}:{passphrase}".encode()).decode()
        for i in range(tries):
            try:
                with urlopen(Request(url, body, head, method="POST"), timeout=300) as r:
                    r.read()
                return
            except (URLError, TimeoutError):
                if i + 1 == tries:
                    raise
                time.sleep(wait * 2**i)

    return post


def send(lines: DataFrame, post: Callable[[list[str]], None], batch: int = 1000, dry_run: bool = False) -> None:
    """Post the patches in batches from the executors. ``post`` must take repeats: tasks can run again."""
    if dry_run:
        log.info("dry run: nothing sent")
        return

    def each(rows: Iterator[Row]) -> None:
        held: list[str] = []
        for r in rows:
            held.append(r.value)
            if len(held) == batch:
                post(held)
                held = []
        if held:
            post(held)

    lines.foreachPartition(each)


def write_csv(df: DataFrame, path: str, dry_run: bool = False) -> None:
    if not dry_run:
        df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def combine(a: dict, b: dict) -> dict:
    """Both dictionaries; values of common keys are added, dictionaries combined in turn."""
    out = dict(a)
    for k, v in b.items():
        out[k] = combine(out[k], v) if k in out and isinstance(v, dict) else out[k] + v if k in out else v
    return out


def history_json(history: DataFrame) -> DataFrame:
    """One JSON object a row: the id and its steps in order."""
    steps = F.array_sort(F.collect_list(F.struct("step", "label", "flag")))
    return history.groupBy("iot_id").agg(steps.alias("steps")).select(F.to_json(F.struct("iot_id", "steps")).alias("value"))


