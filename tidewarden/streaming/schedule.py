"""Runs triggered by a transfer log: one for each line, newer than the last run, that says up to when data are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.durations import to_micros

#: Fixed formats of the log's lines.
STAMP = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
WRITTEN = rf"^\[?({STAMP})\]?.*"
UNTIL = rf".*QC .* to ({STAMP})\."
SINCE = rf".*QC.* from ({STAMP}).*to.*"
STARTED = "Start QC script."


def last_matches(lines: DataFrame, text: str, n: int, order: str = "line") -> DataFrame:
    """The last n lines (order, value) that hold the text."""
    return lines.where(F.contains("value", F.lit(text))).orderBy(F.desc(order)).limit(n)


def _time(pattern: str):
    return F.try_to_timestamp(F.nullif(F.regexp_extract("value", pattern, 1), F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss"))


def due(lines: DataFrame, previous, width: str = "10 minutes", overlap: str = "50 minutes", n: int = 10) -> DataFrame:
    """(written, window_start, window_stop, transfer_from): the runs that the log asks for, newer than ``previous``.

    A window reaches back from the time that data are there by width and overlap.
    """
    found = last_matches(lines, "QC ", n).select(_time(WRITTEN).alias("written"), _time(UNTIL).alias("window_stop"), _time(SINCE).alias("transfer_from"))
    back = F.make_dt_interval(secs=F.lit((to_micros(width) + to_micros(overlap)) / 1e6))
    new = found.where((F.col("written") > F.lit(previous)) & F.col("window_stop").isNotNull())
    return new.select("written", (F.col("window_stop") - back).alias("window_start"), "window_stop", "transfer_from")


def previous_run(lines: DataFrame, message: str = STARTED) -> DataFrame:
    """One row: when the last line with the message was written."""
    return lines.where(F.contains("value", F.lit(message))).agg(F.max_by(_time(WRITTEN), "line").alias("previous"))


def numbered(lines: DataFrame) -> DataFrame:
    """Lines of one text file with their number, for logs that aren't numbered."""
    w = Window.partitionBy(F.input_file_name()).orderBy(F.monotonically_increasing_id())
    return lines.select(F.row_number().over(w).alias("line"), "value")
