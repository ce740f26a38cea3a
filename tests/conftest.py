import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent.parent}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows_of(pdf):
    """Rows as comparable text, columns in order of name."""

    def text(x):
        if x is None or x != x:
            return "~"
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        if isinstance(x, float):
            return f"{x + 0.0:.9g}"
        return str(x)

    cols = sorted(pdf.columns)
    return cols, sorted(tuple(text(float(v) if isinstance(v, (int,)) and not isinstance(v, bool) else v.item() if hasattr(v, "item") else v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False))


def same(pdf, other):
    a, b = rows_of(pdf), rows_of(other)
    assert a[0] == b[0]
    assert len(a[1]) == len(b[1])
    norm = lambda rows: [tuple(f"{float(v):.9g}" if v.replace(".", "").replace("-", "").replace("e", "").replace("+", "").isdigit() else v for v in r) for r in rows]
    assert sorted(norm(a[1])) == sorted(norm(b[1]))
