"""Incremental quality control: windows that overlap, in batches or on a stream.

Checks look back in time, so a batch reads again what lies before it; flags merge upwards, so that runs can repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.durations import to_micros


def intervals(spark: SparkSession, start: int, stop: int, width: str | int, overlap: str | int = 0) -> DataFrame:
    """(n, window_start, window_stop): windows of width + overlap microseconds, one every width; the last may run over."""
    w, o = to_micros(width), to_micros(overlap)
    n = max(0, -(-(stop - start) // w))
    return spark.range(n).select(F.col("id").alias("n"), (F.lit(start) + F.col("id") * w - o).alias("window_start"), (F.lit(start) + (F.col("id") + 1) * w).alias("window_stop"))


def in_windows(df: DataFrame, start: int, stop: int, width: str | int, overlap: str | int = 0, t: str = "t") -> DataFrame:
    """Each row once for every window that holds it (start excluded, stop excluded), as column ``n``: no join."""
    w, o = to_micros(width), to_micros(overlap)
    last = F.floor((F.col(t) - F.lit(start) + F.lit(o) - 1) / F.lit(w))
    first = F.floor((F.col(t) - F.lit(start)) / F.lit(w))
    top = max(0, -(-(stop - start) // w)) - 1
    n = F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.lit(top)))
    ok = (F.greatest(first, F.lit(0)) <= F.least(last, F.lit(top)))
    return df.where(ok).withColumn("n", F.explode(n)).where((F.col(t) > F.lit(start) + F.col("n") * w - o) & (F.col(t) < F.lit(start) + (F.col("n") + 1) * w))


def on_stream(stream: DataFrame, history: Callable[[], DataFrame], plan: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], look_back: int, checkpoint: str, available_now: bool = True):
    """Start a query: each micro-batch is checked with the history of its look-back, and its own rows go to the sink.

    sink takes (rows, batch id) and replaces rows of equal iot_id: batches can come again.
    """

    def each(batch: DataFrame, number: int) -> None:
        edge = batch.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
        if edge.lo is None:
            return
        before = history().where(F.col("t").between(edge.lo - look_back, edge.hi)).join(batch.select("iot_id"), "iot_id", "left_anti")
        rows = before.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)), allowMissingColumns=True)
        sink(plan(rows).where("_new").drop("_new"), number)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def backfill(spark: SparkSession, start: int, stop: int, width: str, overlap: str, run: Callable[[int, int], None]) -> int:
    """Run window after window; returns how many. One pass over the whole range gives the same flags where memory allows."""
    n = 0
    for r in intervals(spark, start, stop, width, overlap).orderBy("n").toLocalIterator():
        run(r.window_start, r.window_stop)
        n += 1
    return n
