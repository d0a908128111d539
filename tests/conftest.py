import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from smallest import DATA, TABLES  # noqa: E402

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    work = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC",
        "spark.sql.warehouse.dir": str(work / "warehouse"), "spark.checkpoint.dir": str(work / "shared"), "spark.ui.showConsoleProgress": "false",
    }
    s = SparkSession.builder.config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def same_rows(spark, duck):
    """Asserts that a query and its SQL give the same columns and rows."""

    def check(run, sql):
        df = run(spark, DATA)
        names = sorted(df.columns)
        got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
        rows = duck.execute(sql)
        theirs = [d[0] for d in rows.description]
        assert sorted(theirs) == names
        at = [theirs.index(n) for n in names]
        want = sorted((tuple(r[i] for i in at) for r in rows.fetchall()), key=repr)
        assert [tuple(map(_plain, r)) for r in got] == [tuple(map(_plain, r)) for r in want]
        return len(got)

    return check


def _plain(v):
    return tuple(map(_plain, v)) if isinstance(v, (list, tuple)) else v
