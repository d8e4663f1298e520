import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def same_rows(df, con, sql):
    """Asserts that a DataFrame and a DuckDB query give the same rows, columns by name."""
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(names)
    order, other = ([cols.index(n) for n in sorted(names)] for cols in (df.columns, names))
    assert sorted(str(tuple(r[i] for i in order)) for r in got) == sorted(str(tuple(r[i] for i in other)) for r in want)
