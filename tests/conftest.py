import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from roadloom.session import ship

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield ship(session)


@pytest.fixture(scope="session")
def compare():
    """Runs a query and its SQL on the smallest tables and compares the rows."""
    import math

    import duckdb

    sf = "/root/testdata/sf0.001"
    tables = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

    def plain(v):
        if isinstance(v, float):
            return round(v, 5) if math.isfinite(v) else str(v)
        return v

    def run(spark, make, sql):
        df = make(spark, sf)
        columns = sorted(df.columns)
        ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
        con = duckdb.connect()
        for t in tables:
            con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
        rel = con.sql(sql)
        assert sorted(rel.columns) == columns
        order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
        theirs = sorted((tuple(plain(row[i]) for i in order) for row in rel.fetchall()), key=str)
        assert ours == theirs

    return run
