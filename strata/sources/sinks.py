"""Table and file sinks: DDL, atomic publish (version + view), full refresh,
partitioned Bronze writes, compaction and load reconciliation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.packing import with_packed_texts
from strata.schema import ddl
from strata.session import DROP_SHUFFLES, settings
from strata.sources import fs

#: Codec of stored copies and layers that are written once and read back by a job.
COMPACT_CODEC = "zstd"


def create_table_sql(name: str, schema: StructType, fmt: str = "parquet", location: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS from a StructType; reserved names quoted."""
    loc = f"\nLOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {ddl(schema)}\n) USING {fmt}{loc}"


def create_table(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet", location: str | None = None) -> None:
    spark.sql(create_table_sql(name, schema, fmt, location))


def write_partitioned(df: DataFrame, path: str, partition_col: str = "event_date_parsed", mode: str = "overwrite",
                      max_records_per_file: int | None = None, overwrite: str = "static") -> None:
    """Partitioned Parquet write that avoids both small files and skew.

    `overwrite` says what mode "overwrite" replaces, whatever the session says:
    "static" the whole directory, "dynamic" only the partitions written.

    `REBALANCE(col)` clusters rows of one partition value into few tasks (one
    file per value per task instead of one per value per input split), and AQE
    splits an oversized value (a hot date) into several tasks instead of
    funnelling it through one. Texts cross that shuffle packed.
    """
    dealt = with_packed_texts(df, lambda rows: rows.hint("rebalance", partition_col), keep=(partition_col,))
    w = dealt.write.mode(mode).option("partitionOverwriteMode", overwrite).option("compression", COMPACT_CODEC).partitionBy(partition_col)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    with settings(df.sparkSession, DROP_SHUFFLES):
        w.parquet(path)


def with_month_partition(df: DataFrame, date_col: str = "event_date_parsed", name: str = "event_month") -> DataFrame:
    """A coarser partition column ('yyyy-MM'): ~30x fewer directories than a
    daily layout, for sources whose events spread over many days."""
    return df.withColumn(name, F.date_format(F.col(date_col), "yyyy-MM"))


def _layout(fields, partition_cols: list[str]) -> list[tuple[str, str]]:
    """Column names and types as a table partitioned by `partition_cols` shows them (partition columns last)."""
    named = [(f.name, f.dataType.simpleString()) for f in fields]
    return [x for x in named if x[0] not in partition_cols] + [x for c in partition_cols for x in named if x[0] == c]


def publish(df: DataFrame, table: str, base_path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> tuple[str, int]:
    """Create-or-replace a table atomically and count what was written.

    The data is written to a fresh version folder first; only after the write
    committed do readers see it, by one catalog operation, so they never meet a
    missing, truncated or half-loaded table and a rerun replaces rather than
    duplicates. Returns the version path and the number of rows written (an
    `Observation` taken during the write, no second pass over the data).

    The name is a view over a table of the version, `<name>__<version>`, and the
    operation is the view's replacement, whatever changed in schema or
    partitioning. A plain table under the name (made by `create_table`) keeps its
    kind while the schema stays and there are no partitions: its location is set.
    Otherwise it is renamed out of the way once, and the view takes its name.
    `partition_by` lays the files out by column values, so later reads are pruned
    by them. Old versions stay until `drop_old_versions`.
    """
    partition_by = list(partition_by or [])
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:12]
    version = f"{base_path.rstrip('/')}/{table}/v-{tag}"
    obs = Observation(f"publish_{table}_{uuid.uuid4().hex[:6]}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        counted = counted.hint("rebalance", *partition_by)
    write = counted.write.format(fmt).mode("errorifexists").partitionBy(*partition_by)
    if fmt == "parquet":
        write = write.option("compression", COMPACT_CODEC)
    with settings(spark, DROP_SHUFFLES):
        write.save(version)
    wanted = _layout(df.schema.fields, partition_by)
    plain = spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW"
    if plain and not partition_by and not any(c.isPartition for c in spark.catalog.listColumns(table)) and _layout(spark.table(table).schema.fields, []) == wanted:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.sql(f"REFRESH TABLE {table}")
        return version, int(obs.get["rows"])
    columns = ", ".join(f"`{n}` {t}" for n, t in wanted)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table}__{tag} ({columns}) USING {fmt}{parts} LOCATION '{version}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}__{tag} SYNC PARTITIONS")
    if plain:
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__before_{tag}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {table}__{tag}")
    return version, int(obs.get["rows"])


def versions(spark: SparkSession, table: str) -> list[str]:
    """The version tables of a published name, the one that readers see last."""
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{table}__".lower()) or t.name.startswith(f"{table}__")]
    now = spark.sql(f"SHOW CREATE TABLE {table}").first()[0] if spark.catalog.getTable(table).tableType == "VIEW" else ""
    return sorted(names, key=lambda n: n.rsplit("__", 1)[1] in now)


def drop_old_versions(spark: SparkSession, table: str) -> list[str]:
    """Retention: drop every version but the one that readers see, table and files.
    To run when no reader uses an older one any more; the names dropped."""
    old = versions(spark, table)[:-1]
    for name in old:
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
        spark.sql(f"DROP TABLE {name}")
        fs.delete(spark, place)
    return old


def drop_published(spark: SparkSession, table: str) -> None:
    """The view and all its versions; their files stay."""
    names = versions(spark, table)
    spark.sql(f"DROP {'VIEW' if spark.catalog.getTable(table).tableType == 'VIEW' else 'TABLE'} {table}")
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def reconcile(spark: SparkSession, table: str, loaded_rows: int) -> DataFrame:
    """V8: loaded rows vs rows now in the table (one row; `matches` false = error)."""
    return (
        spark.table(table)
        .agg(F.count(F.lit(1)).alias("table_rows"))
        .select(F.lit(loaded_rows).cast("bigint").alias("loaded_rows"), "table_rows")
        .withColumn("matches", F.col("loaded_rows") == F.col("table_rows"))
    )


def assert_reconciled(spark: SparkSession, table: str, loaded_rows: int) -> None:
    row = reconcile(spark, table, loaded_rows).first()
    if not row["matches"]:
        raise RuntimeError(f"{table}: loaded {row['loaded_rows']} rows but the table holds {row['table_rows']}")


def assert_not_empty(df: DataFrame, what: str) -> None:
    """V7: stop before a layer is built from an empty input."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty")


def assert_bounded(silver_rows: int, bronze_rows: int) -> None:
    """V9: Silver can only lose rows."""
    if silver_rows > bronze_rows:
        raise RuntimeError(f"Silver has more rows ({silver_rows}) than Bronze ({bronze_rows})")


def compact(spark: SparkSession, src: str, dst: str, schema: StructType, partition_col: str = "event_date_parsed",
            max_records_per_file: int = 1_000_000, low: str | None = None, high: str | None = None) -> str:
    """Rewrite a many-small-files partitioned directory into few files per
    partition at a new location (the caller then switches readers to `dst`).
    With `low` and `high` only partitions in that range (inclusive) are read and
    rewritten, so a scheduled run touches the newest ones, not the whole table."""
    df = spark.read.schema(schema).parquet(src)
    if low is not None:
        df = df.where(F.col(partition_col) >= low)
    if high is not None:
        df = df.where(F.col(partition_col) <= high)
    write_partitioned(df, dst, partition_col, mode="errorifexists", max_records_per_file=max_records_per_file)
    return dst


def partition_files(spark: SparkSession, table: str, partition_col: str) -> DataFrame:
    """(partition value, files, bytes) of a partitioned table, wherever its partitions lie."""
    each = spark.table(table).select(F.col(partition_col).alias("value"), "_metadata.file_path", "_metadata.file_size").distinct()
    return each.groupBy("value").agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))


def compact_table(spark: SparkSession, table: str, partition_col: str, base_path: str, target_bytes: int = 256 << 20) -> list:
    """Compaction that chooses and swaps. Partitions with at least twice the files
    that their bytes need at `target_bytes` each are rewritten together to a new
    folder, then each is pointed at its new place by one catalog operation; readers
    see a partition before or after. The partition values rewritten; with nothing
    to gain nothing is rewritten. Old files stay, for readers that still use them.

    The rows of a partition are dealt by their old place to as many tasks as it needs
    files, each of which writes one file of it. It never has more than it needs, so the
    next run leaves it alone unless new files came.
    """
    need = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")
    found = partition_files(spark, table, partition_col).withColumn("need", need).where(F.col("files") >= 2 * F.col("need"))
    needs = {r["value"]: r["need"] for r in found.select("value", "need").collect()}
    chosen = list(needs)
    if not chosen:
        return []
    place = f"{base_path.rstrip('/')}/{table}/c-{uuid.uuid4().hex[:12]}"
    rows = spark.table(table).where(F.col(partition_col).isin([v for v in chosen if v is not None]) | (F.col(partition_col).isNull() if None in chosen else F.lit(False)))
    several = {v: n for v, n in needs.items() if n > 1}
    files = F.lit(1)
    if several:
        by_value = F.create_map(*[F.lit(x) for v, n in several.items() if v is not None for x in (v, n)]) if set(several) - {None} else None
        files = F.when(F.col(partition_col).isNull(), F.lit(several.get(None, 1)))
        files = files.otherwise(F.lit(1) if by_value is None else F.coalesce(F.try_element_at(by_value, F.col(partition_col)), F.lit(1)))
    dealt = rows.withColumn("_file", F.pmod(F.xxhash64("_metadata.file_path", "_metadata.row_index"), files))
    dealt = with_packed_texts(dealt, lambda r: r.repartition(sum(needs.values()), F.col(partition_col), F.col("_file")), keep=(partition_col,)).drop("_file")
    with settings(spark, DROP_SHUFFLES):
        dealt.write.mode("errorifexists").option("compression", COMPACT_CODEC).partitionBy(partition_col).parquet(place)
    for v in chosen:
        spec = "null" if v is None else f"'{v}'"
        folder = "__HIVE_DEFAULT_PARTITION__" if v is None else v
        spark.sql(f"ALTER TABLE {table} PARTITION (`{partition_col}`={spec}) SET LOCATION '{place}/{partition_col}={folder}'")
    spark.sql(f"REFRESH TABLE {table}")
    return chosen


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    For plans that fan one layer out into several branches: every branch
    reads the stored columns it needs instead of recomputing the layer (exchange
    reuse cannot help, since each branch prunes different columns), and the
    stored copy cuts the lineage, so a lost executor never replays the layer.
    """
    with settings(df.sparkSession, DROP_SHUFFLES):
        df.write.mode("errorifexists").parquet(path, compression=COMPACT_CODEC)
    return df.sparkSession.read.parquet(path)


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """Overwrite Parquet at any Hadoop path (file:, s3a:, …) and read it back."""
    with settings(df.sparkSession, DROP_SHUFFLES):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
