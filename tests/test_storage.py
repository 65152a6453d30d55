"""Storage layout: rebalanced partitioned writes and compaction."""

import glob

import uuid
import pytest
from pyspark.sql import functions as F

from strata.plans.fixtures import bronze_fixture
from strata.schema import BRONZE_SCHEMA
from strata.session import local_path, scratch_path
from strata.sources import files, sinks


def files_per_partition(path):
    counts = {}
    for f in glob.glob(f"{local_path(path)}/*/*.parquet"):
        part = f.rsplit("/", 2)[-2]
        counts[part] = counts.get(part, 0) + 1
    return counts


def test_compaction_reduces_files_and_keeps_rows(spark, sf_small):
    b = sinks.with_month_partition(bronze_fixture(spark, sf_small))
    small = scratch_path(spark, "t-small")
    for p in range(4):
        b.filter(F.col("partition") == p).repartition(3).write.mode("append").partitionBy("event_month").parquet(small)
    before = files_per_partition(small)
    dst = sinks.compact(spark, small, scratch_path(spark, "t-compact"), BRONZE_SCHEMA, partition_col="event_month")
    after = files_per_partition(dst)
    assert set(before) == set(after)
    assert max(before.values()) > 4 and max(after.values()) <= 2
    got = files.read_bronze_parquet(spark, dst, nan_to_null=False)
    assert got.count() == b.count()
    assert got.exceptAll(b.drop("event_month")).count() == 0


def test_bronze_directory_missing_or_empty(spark):
    import pytest

    from pyspark.errors import AnalysisException

    from strata.plans import batch_job

    with pytest.raises(AnalysisException):
        files.read_bronze_parquet(spark, scratch_path(spark, "t-missing")).count()
    empty = scratch_path(spark, "t-empty")
    spark.createDataFrame([], BRONZE_SCHEMA).write.parquet(empty)
    with pytest.raises(RuntimeError, match="is empty"):
        batch_job.load_bronze(spark, empty, scratch_path(spark, "t-wh"))


def test_publish_replaces_the_schema(spark):
    base, table = scratch_path(spark, "test-publish"), f"pub_{uuid.uuid4().hex[:8]}"
    sinks.publish(spark.createDataFrame([(1,)], "a int"), table, base)
    sinks.publish(spark.createDataFrame([(2, "x")], "a int, b string"), table, base)
    assert [tuple(r) for r in spark.table(table).collect()] == [(2, "x")]
    _, n = sinks.publish(spark.createDataFrame([("y", "p"), ("z", "q")], "a string, day string"), table, base, partition_by=["day"])
    sinks.assert_reconciled(spark, table, n)
    assert sorted(map(tuple, spark.table(table).collect())) == [("y", "p"), ("z", "q")]
    _, n = sinks.publish(spark.createDataFrame([("w", "r")], "a string, day string"), table, base, partition_by=["day"])
    assert n == 1 and [tuple(r) for r in spark.table(table).collect()] == [("w", "r")]
    assert len(sinks.versions(spark, table)) == 4
    assert len(sinks.drop_old_versions(spark, table)) == 3
    assert [tuple(r) for r in spark.table(table).collect()] == [("w", "r")]
    assert len(glob.glob(f"{local_path(base)}/{table}/v-*")) == 1
    sinks.drop_published(spark, table)
    assert not spark.catalog.tableExists(table) and not [t for t in spark.catalog.listTables() if t.name.startswith(table)]


def test_a_reader_never_meets_a_missing_or_empty_table(spark):
    """A loop of reads beside publishes of changing schema and partitioning sees whole versions only."""
    import threading

    base, table = scratch_path(spark, "test-publish"), f"pub_{uuid.uuid4().hex[:8]}"
    frames = [(spark.range(n).selectExpr("id AS a", f"'{n}' AS b", *extra), by) for n, extra, by in (
        (10, [], []), (20, ["id % 3 AS day"], ["day"]), (30, ["id % 3 AS day"], ["day"]), (40, ["id AS c"], []), (50, [], []))]
    sinks.publish(frames[0][0], table, base)
    seen, errors, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(spark.table(table).groupBy("b").count().first()))
            except Exception as exc:  # noqa: BLE001
                errors.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for df, by in frames[1:]:
            assert sinks.publish(df, table, base, partition_by=by)[1] == df.count()
    finally:
        stop.set()
        reader.join()
    assert not errors and seen <= {(str(n), n) for n in (10, 20, 30, 40, 50)} and len(seen) > 1
    assert spark.table(table).count() == 50
    sinks.drop_published(spark, table)


def test_a_created_table_becomes_a_view_only_when_it_must(spark):
    from pyspark.sql.types import StructType

    base, table = scratch_path(spark, "test-publish"), f"pub_{uuid.uuid4().hex[:8]}"
    sinks.create_table(spark, table, StructType.fromDDL("a int"), location=f"{base}/{table}/initial")
    sinks.publish(spark.createDataFrame([(1,)], "a int"), table, base)
    assert spark.catalog.getTable(table).tableType != "VIEW"
    sinks.publish(spark.createDataFrame([("x",)], "a string"), table, base)
    assert spark.catalog.getTable(table).tableType == "VIEW" and [tuple(r) for r in spark.table(table).collect()] == [("x",)]
    sinks.drop_published(spark, table)


def test_compaction_chooses_and_swaps(spark):
    """Only the partitions with too many files move; a second run rewrites nothing."""
    base, table = scratch_path(spark, "test-compact"), f"months_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([(i, ["a", "b", None][i % 3]) for i in range(60)], "v int, m string").coalesce(1).write.partitionBy("m").parquet(f"{base}/first")
    spark.sql(f"CREATE TABLE {table} (v INT, m STRING) USING parquet PARTITIONED BY (m) LOCATION '{base}/first'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    for i in range(3):
        spark.createDataFrame([(100 + i, "a"), (200 + i, None)], "v int, m string").coalesce(1).write.insertInto(table)
    want = sorted(map(str, spark.table(table).collect()))
    before = {r["value"]: r["files"] for r in sinks.partition_files(spark, table, "m").collect()}
    assert before == {"a": 4, "b": 1, None: 4}
    assert set(sinks.compact_table(spark, table, "m", base)) == {"a", None}
    assert {r["value"]: r["files"] for r in sinks.partition_files(spark, table, "m").collect()} == {"a": 1, "b": 1, None: 1}
    assert sorted(map(str, spark.table(table).collect())) == want
    assert sinks.compact_table(spark, table, "m", base) == []
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_overwrite_mode_is_set_per_write(spark, session_mode):
    path = scratch_path(spark, "test-overwrite")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        both = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
        sinks.write_partitioned(both, path, "day")
        sinks.write_partitioned(both.where("day = 'a'"), path, "day")
        assert spark.read.parquet(path).count() == 1
        sinks.write_partitioned(both.where("day = 'b'"), path, "day", overwrite="dynamic")
        assert spark.read.parquet(path).count() == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_compaction_of_a_partition_range(spark):
    src, dst = scratch_path(spark, "test-range"), scratch_path(spark, "test-range-out")
    rows = spark.createDataFrame([(i, f"2024-0{1 + i % 4}") for i in range(40)], "v int, month string")
    sinks.write_partitioned(rows, src, "month")
    sinks.compact(spark, src, dst, rows.schema, "month", low="2024-02", high="2024-03")
    assert sorted({r["month"] for r in spark.read.parquet(dst).collect()}) == ["2024-02", "2024-03"]


def test_cluster_without_shared_folder_is_an_error(monkeypatch):
    from strata import session

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self): return None
        def getConf(self): return {}

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
