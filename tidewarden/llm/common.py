"""Helpers shared by the training-data operators: table access, shared storage, word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import local_path, materialise, new_path, shared_dir

__all__ = ["local_path", "materialise", "new_path", "shared_dir", "table", "slots", "words", "word_count", "crc_bucket"]

#: A word is a run of characters other than the six ASCII blanks.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slots(spark: SparkSession) -> int:
    """Number of shuffle partitions that the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """Array of a text's words; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RE))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def crc_bucket(key: Column, n: int) -> Column:
    """crc32 of the key as text, mod n; null keys count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n
