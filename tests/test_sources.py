"""Sources and sinks that need a database, a catalogue or many files."""

import pytest

from lodestride.sources import readers, writers


@pytest.fixture(scope="module")
def database(spark):
    """A database in memory, of the engine that comes with Spark."""
    url = "jdbc:derby:memory:events;create=true"
    rows = [(i if i % 17 else None, f"2024-01-{1 + i % 20:02d}", i * 1.5) for i in range(300)]
    df = spark.createDataFrame(rows, "user_id long, day string, x double").selectExpr("user_id AS USER_ID", "CAST(day AS DATE) AS DAY_OF", "x AS X")
    df.write.format("jdbc").options(url=url, dbtable="EVENTS", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    return url, df


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_parallel_scan_reads_each_row_once(spark, database):
    url, df = database
    got = readers.read_jdbc(spark, url, "EVENTS", "USER_ID", "2024-01-03", "2024-01-09", "DAY_OF", hash_sql="{key}", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert got.rdd.getNumPartitions() == readers.JDBC_PARTITIONS
    want = df.where("DAY_OF BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'")
    assert rows_of(got) == rows_of(want) and any(r["USER_ID"] is None for r in got.collect())


def test_query_runs_at_the_source(spark, database):
    url, df = database
    got = readers.read_query(spark, "jdbc", "SELECT DAY_OF, COUNT(*) AS N FROM EVENTS WHERE X > 30 GROUP BY DAY_OF", url=url, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    want = df.where("X > 30").groupBy("DAY_OF").count()
    assert rows_of(got) == rows_of(want)


def test_table_of_the_catalogue(spark):
    spark.range(7).selectExpr("id AS user_id", "id * 2 AS x").write.mode("overwrite").saveAsTable("source_table")
    assert rows_of(readers.read_table(spark, "source_table")) == [(i, i * 2) for i in range(7)]
    spark.sql("DROP TABLE source_table")


def test_test_split_has_whole_users_of_the_last_buckets(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id % 500 AS user_id", "id AS x")
    writers.write_test_split(rows, str(tmp_path / "t"), ratio=0.1, files=8)
    got = spark.read.parquet(str(tmp_path / "t"))
    bucket = {r["user_id"]: r["b"] for r in rows.selectExpr("user_id", "pmod(abs(hash(user_id)) + 42, 100) AS b").distinct().collect()}
    want = [(u, x) for u, x in map(tuple, rows.collect()) if bucket[u] >= 90]
    assert rows_of(got) == sorted(want, key=str) and 0.05 < len(want) / 2000 < 0.15
    assert len([f for f in (tmp_path / "t").iterdir() if f.suffix == ".parquet"]) == 8
