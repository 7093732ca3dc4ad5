import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="spark-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.local.dir", f"{home}/local")
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        .config("spark.checkpoint.dir", f"file://{home}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def same_rows():
    """Compare a Spark frame with a DuckDB query: columns by name, rows in any order, doubles to nine places."""

    def plain(value):
        if value is None or value != value:
            return "null"
        return f"{value:.9g}" if isinstance(value, float) else str(value)

    def check(df, con, sql):
        names = sorted(df.columns)
        got = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
        result = con.execute(sql)
        columns = [c[0] for c in result.description]
        assert sorted(columns) == names
        want = sorted(tuple(plain(r[columns.index(n)]) for n in names) for r in result.fetchall())
        assert got == want

    return check
