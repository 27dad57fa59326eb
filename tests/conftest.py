import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


@pytest.fixture(scope="session")
def same_as_sql(duck):
    def check(df, sql):
        columns = sorted(df.columns)
        names = ", ".join(f'"{c}"' for c in columns)
        want = duck.sql(f"SELECT {names} FROM ({sql})").fetchall()
        assert sorted(duck.sql(sql).columns) == columns
        key = lambda r: tuple((x is None, str(x)) for x in r)
        got = [tuple(map(plain, r)) for r in df.select(*columns).collect()]
        assert sorted(got, key=key) == sorted((tuple(map(plain, r)) for r in want), key=key)

    return check
