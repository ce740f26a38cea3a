"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a fresh local one in local mode, and an error on a cluster."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: it must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidewarden-")
        sc.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
        _written.append((spark, found))
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder; what is there goes when the session ends."""
    path = f"{shared_dir(spark)}/tidewarden/{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: cuts lineage, survives lost executors, gives real sizes."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str | None:
    """The POSIX path of a file: URI or plain path; None for other stores."""
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a folder of any store."""
    if path := local_path(uri):
        shutil.rmtree(path, ignore_errors=True)
    elif spark.sparkContext._jsc is not None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _clean() -> None:
    for spark, uri in _written:
        try:
            remove(spark, uri)
        except Exception:  # the session may have ended first; a remote store keeps its files then
            continue
