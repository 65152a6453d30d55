"""Skew: one event_id holding a third of all Bronze rows, spread over many
tasks, and one date holding a third of all Silver rows. Results must equal the
DuckDB evaluation of the same SQL on the same data."""

import duckdb
from pyspark.sql import functions as F

from strata.operators import gold, silver
from strata.plans import oracle as O
from strata.plans.fixtures import bronze_fixture
from strata.session import local_path, scratch_path


def test_hot_event_id_and_hot_date(spark, sf_small):
    b = bronze_fixture(spark, sf_small)
    n = b.count()
    hot = (
        b.limit(n // 2)
        .withColumn("event_id", F.lit(" HOT "))
        .withColumn("event_date_parsed", F.lit("2024-01-01").cast("date"))
    )
    skewed = b.unionByName(hot).repartition(12)
    path = scratch_path(spark, "test-skew")
    skewed.write.parquet(path)
    src = spark.read.parquet(path)

    s = silver.silver_events(src)
    got_silver = sorted(tuple(r) for r in s.select("event_id", "offset", "partition").collect())
    got_daily = sorted(tuple(r) for r in gold.daily_sales(s).select("event_date", "total_events", "unique_sessions").collect())

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    src_sql = f"SELECT * FROM read_parquet('{local_path(path)}/*.parquet')"
    want_silver = sorted(con.sql(O.silver_over(src_sql, 'SELECT event_id, "offset", "partition" FROM silver')).fetchall())
    daily_sql = "SELECT event_date, COUNT(*), COUNT(DISTINCT session_id) FROM silver GROUP BY 1"
    want_daily = sorted(tuple(r) for r in con.sql(O.silver_over(src_sql, daily_sql)).fetchall())
    assert got_silver == want_silver
    assert got_daily == want_daily
    assert sum(1 for r in got_silver if r[0] == "HOT") == 1
