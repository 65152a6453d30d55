"""Stored layers: one copy per snapshot, found again, replaced when a source changes."""

import shutil

import pytest

from strata.plans import catalog, fixtures
from strata.session import local_path, scratch_path
from strata.sources import fs, layers, sinks


def copies(spark, name):
    root = layers.layers_root(spark)
    homes = [f"{root}/{h}" for h in fs.names(spark, root) if h.rsplit("-", 1)[0] == name]
    return sorted(f"{h}/{s}/{c}" for h in homes for s in fs.names(spark, h) for c in fs.names(spark, f"{h}/{s}"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def source(spark):
    path = scratch_path(spark, "t-source")
    spark.range(10).selectExpr("id", "id % 3 AS k", "CAST(id AS STRING) AS name").repartition(2).write.parquet(path)
    return path


def layer(spark, source, *columns, **kw):
    return layers.stored(spark, lambda: spark.read.parquet(source).select(*columns), "t-layer", [source], **kw)


@pytest.fixture(autouse=True)
def no_copies(spark):
    layers.drop(spark, "t-layer")


def test_the_second_dashboard_query_writes_nothing(spark, sf_small, monkeypatch):
    layers.drop(spark)
    written = []
    real = sinks.stage
    monkeypatch.setattr(sinks, "stage", lambda df, path: written.append(path) or real(df, path))
    first = {k: rows(catalog.QUERIES[k](spark, sf_small)) for k in ("dash_segment_sales",)}
    assert len(written) == 1
    for key in ("dash_segment_sales", "dash_geo_sales", "top_customers", "gold_customer_activity"):
        first.setdefault(key, rows(catalog.QUERIES[key](spark, sf_small)))
        assert rows(catalog.QUERIES[key](spark, sf_small)) == first[key]
    assert len(written) == 1
    layers.drop(spark)
    assert rows(catalog.QUERIES["dash_geo_sales"](spark, sf_small)) == first["dash_geo_sales"]


def test_fixture_names_every_table_it_reads(spark, sf_small):
    read = {f.rsplit("/", 1)[1] for f in fixtures.bronze_fixture(spark, sf_small).inputFiles()}
    assert read == {f"{t}.parquet" for t in fixtures.SOURCE_TABLES}


def test_a_wide_copy_serves_narrow_requests(spark, source):
    layer(spark, source, "id")
    assert rows(layer(spark, source, "k", "id")) == sorted(((i % 3, i) for i in range(10)), key=str)
    assert len(copies(spark, "t-layer")) == 2
    assert layer(spark, source, "k").columns == ["k"] and len(copies(spark, "t-layer")) == 2


def test_a_changed_source_gives_a_new_copy_and_drops_the_old(spark, source):
    layer(spark, source, "id", keep_seconds=0)
    (before,) = copies(spark, "t-layer")
    spark.range(10, 12).selectExpr("id", "id % 3 AS k", "CAST(id AS STRING) AS name").write.mode("append").parquet(source)
    assert layer(spark, source, "id", keep_seconds=0).count() == 12
    (after,) = copies(spark, "t-layer")
    assert before != after


def test_old_copies_are_kept_for_their_readers(spark, source):
    lazy = layer(spark, source, "id")
    spark.range(10, 12).selectExpr("id", "id % 3 AS k", "CAST(id AS STRING) AS name").write.mode("append").parquet(source)
    assert layer(spark, source, "id").count() == 12
    assert lazy.count() == 10 and len(copies(spark, "t-layer")) == 2


def test_an_unfinished_copy_is_not_read(spark, source):
    layer(spark, source, "id")
    (copy,) = copies(spark, "t-layer")
    fs.delete(spark, f"{copy}/{layers.MARK}")
    shutil.copyfile(*[f"{local_path(copy)}/{n}" for n in (fs.names(spark, copy)[0], "part-doubled.parquet")])
    assert layer(spark, source, "id").count() == 10
    assert len(copies(spark, "t-layer")) == 2


def test_changed_rules_and_settings_do_not_find_old_copies(spark, source):
    layer(spark, source, "id", rules="1")
    layer(spark, source, "id", rules="2")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        layer(spark, source, "id", rules="2")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(copies(spark, "t-layer")) == 3


def test_a_source_that_changes_during_the_write_is_read_again(spark, source):
    built = []

    def build():
        df = spark.read.parquet(source).select("id")
        if not built:
            spark.range(10, 12).selectExpr("id", "id % 3 AS k", "CAST(id AS STRING) AS name").write.mode("append").parquet(source)
        built.append(df)
        return df

    assert layers.stored(spark, build, "t-layer", [source]).count() == 12
    assert len(built) == 2 and len(copies(spark, "t-layer")) == 1


def test_an_empty_source_folder_is_a_snapshot(spark, source):
    empty = scratch_path(spark, "t-empty")
    spark.range(0).selectExpr("id").write.parquet(empty)
    assert layers.stored(spark, lambda: spark.read.parquet(empty), "t-layer", [empty]).count() == 0
    assert layers.snapshot(spark, [empty]) == layers.snapshot(spark, [empty]) != layers.snapshot(spark, [source])
