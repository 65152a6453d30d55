"""The batch medallion job: Bronze Parquet → Bronze table → Silver → Gold.

Each layer is published atomically (new version folder, then the table is
pointed at it) and read back from storage by the next layer, so Silver is
computed once and the four Gold aggregations each scan only the Silver columns
they need. Runtime guards: non-empty inputs, loaded rows = table rows, and
Silver ≤ Bronze.

    python -m strata.plans.batch_job --bronze-path DIR --warehouse DIR [--verify]
"""

from __future__ import annotations

import argparse
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from strata.operators import gold, report, silver
from strata.sources import files, sinks

DEFAULT_NAMES = {
    "bronze": "bronze_events",
    "silver": "silver_events",
    **{name: name for name in gold.GOLD_TABLES},
}


def load_bronze(spark: SparkSession, bronze_path: str, warehouse: str, table: str = DEFAULT_NAMES["bronze"]) -> int:
    """Bronze Parquet directory → Bronze table (full refresh, reconciled)."""
    df = files.read_bronze_parquet(spark, bronze_path)  # a missing directory raises
    sinks.assert_not_empty(df, f"Bronze directory {bronze_path}")
    _, loaded = sinks.publish(df, table, warehouse)
    sinks.assert_reconciled(spark, table, loaded)
    return loaded


def build_silver(spark: SparkSession, warehouse: str, bronze_table: str = DEFAULT_NAMES["bronze"],
                 table: str = DEFAULT_NAMES["silver"]) -> int:
    bronze = spark.table(bronze_table)
    sinks.assert_not_empty(bronze, f"Bronze table {bronze_table}")
    _, rows = sinks.publish(silver.silver_events(bronze), table, warehouse)
    bronze_rows = spark.table(bronze_table).count()
    sinks.assert_bounded(rows, bronze_rows)
    return rows


def build_gold(spark: SparkSession, warehouse: str, silver_table: str = DEFAULT_NAMES["silver"],
               names: dict[str, str] | None = None, parallel_jobs: int = 4, **vocabulary) -> dict[str, int]:
    """The four Gold tables from the stored Silver table.

    They are independent, so their jobs are submitted concurrently (one
    thread each): the scheduler interleaves their stages and the cluster is
    not left idle during one job's final, narrow stages.
    """
    names = names or {}
    src: DataFrame = spark.table(silver_table)
    sinks.assert_not_empty(src, f"Silver table {silver_table}")

    def build(key: str) -> tuple[str, int]:
        fn = gold.GOLD_TABLES[key]
        out = fn(src, **vocabulary) if key == "gold_conversion_metrics" else fn(src)
        return key, sinks.publish(out, names.get(key, key), warehouse)[1]

    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        return dict(pool.map(build, gold.GOLD_TABLES))


def run(spark: SparkSession, bronze_path: str, warehouse: str) -> dict[str, int]:
    counts = {"bronze": load_bronze(spark, bronze_path, warehouse)}
    counts["silver"] = build_silver(spark, warehouse)
    counts.update(build_gold(spark, warehouse))
    return counts


def verify(spark: SparkSession, names: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The verification reports over the published tables: rows per table,
    rows vs distinct event ids per layer, events per type, and a sample."""
    n = {**DEFAULT_NAMES, **(names or {})}
    bronze, silver_t = spark.table(n["bronze"]), spark.table(n["silver"])
    return {
        "layer_counts": report.layer_counts({key: spark.table(name) for key, name in n.items()}),
        "uniqueness": report.uniqueness({"bronze": bronze, "silver": silver_t}),
        "bronze_event_types": report.event_type_counts(bronze),
        "silver_event_types": report.event_type_counts(silver_t),
        "silver_sample": report.sample_rows(silver_t),
    }


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--bronze-path")
    ap.add_argument("--warehouse", help="shared folder for table versions")
    ap.add_argument("--verify", action="store_true", help="print the verification reports of the tables")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.bronze_path:
        print(json.dumps(run(spark, args.bronze_path, args.warehouse)))
    if args.verify:
        for name, df in verify(spark).items():
            print(name)
            df.show(50, truncate=False)


if __name__ == "__main__":
    main()
