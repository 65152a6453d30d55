"""Bronze-shaped event rows derived from the driver's star-schema tables.

lineitem ⋈ orders ⋈ customer ⋈ part ⋈ nation ⋈ region, one event per lineitem,
with dirt planted on purpose (NULL/blank ids, bad times, negative numbers,
out-of-range discounts, duplicates) so every Silver rule is exercised.

The column expressions are plain SQL valid in both Spark and DuckDB, so the
oracle builds the very same input rows.

Join plan: orders ⋈ customer is joined
first (orders is a quarter of lineitem), then lineitem joins it on orderkey and
part on partkey, and nation ⋈ region last, so that their names ride along in no
shuffle. nation/region are fixed-size by the TPC-H specification (25 and
5 rows); they and customer are left to the planner, which broadcasts a
side only when its measured size is under `spark.sql.autoBroadcastJoinThreshold`
(checked again at run time by AQE) and otherwise sort-merges on the key.
lineitem's joins with orders and part are pinned to shuffled hash joins: all three
grow with the data, so both keys are shuffled at any real scale, and lineitem is the
streamed, key-partitioned side. A task holds its share of the orders or parts in a
hash table and sorts neither them nor the wide fact rows, whose sort would be the
largest in the job. Left to size estimates, a small lineitem is broadcast instead and
every later operator runs in as many tasks as the other side has input splits (one,
for a one-row-group file).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bronze import add_event_times
from strata.schema import BRONZE_COLUMNS, BRONZE_SCHEMA, EVENT_COLUMNS
from strata.session import DROP_SHUFFLES, settings

# (column, SQL expression over the joined tables). Fixed values of the test
# fixture; identical text runs in Spark and DuckDB.
F1_COLUMNS: list[tuple[str, str]] = [
    ("kafka_key", "cast(o_custkey as string)"),
    ("topic", "'ecommerce-events'"),
    ("partition", "cast(mod(l_suppkey, 4) as int)"),
    ("offset", "l_partkey"),
    ("kafka_timestamp", "cast(l_shipdate as timestamp)"),
    (
        "event_id",
        "case when mod(l_partkey, 89) = 0 then null when mod(l_partkey, 97) = 0 then '  ' "
        "else concat(' ', cast(l_orderkey as string), '-', cast(l_linenumber as string), ' ') end",
    ),
    ("user_id", "concat('user_', lpad(cast(o_custkey as string), 6, '0'))"),
    ("session_id", "concat('s-', cast(l_orderkey as string))"),
    (
        "event_type",
        "case mod(l_linenumber + l_partkey, 7) when 0 then ' View' when 1 then 'product_view' "
        "when 2 then 'SEARCH' when 3 then 'add_to_cart ' when 4 then 'remove_from_cart' "
        "when 5 then 'Purchase' else 'payment_failed' end",
    ),
    (
        "timestamp",
        "case when mod(l_partkey, 53) = 0 then 'not-a-time' else replace(cast(l_shipdate as string), ' ', 'T') end",
    ),
    ("event_date", "case when mod(l_partkey, 59) = 0 then null else substr(cast(l_shipdate as string), 1, 10) end"),
    ("device", "case mod(l_suppkey, 3) when 0 then ' Mobile' when 1 then 'desktop' else 'TABLET' end"),
    ("traffic_source", "case mod(l_suppkey, 4) when 0 then 'organic' when 1 then 'Email ' when 2 then 'social' else 'direct' end"),
    ("customer_name", "concat(c_name, ' ')"),
    ("segment", "c_mktsegment"),
    ("country", "n_name"),
    ("market", "r_name"),
    ("region", "concat(' R', cast(mod(n_nationkey, 4) as string))"),
    ("product_id", "concat('P-', cast(l_partkey as string))"),
    ("category", "p_type"),
    ("sub_category", "p_brand"),
    ("product_name", "p_name"),
    ("product_price", "case when mod(p_partkey, 50) = 0 then -p_retailprice else p_retailprice end"),
    ("quantity", "cast(l_quantity as int) - 5"),
    ("discount_percent", "cast(cast(l_discount as decimal(4,2)) * 1500 - 20 as double)"),
    ("sales", "cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as double)"),
    ("ship_mode", "case l_linestatus when 'O' then 'Same Day ' else 'First Class' end"),
    ("order_priority", "substr(o_orderpriority, 3)"),
    ("removed_quantity", "case when l_returnflag = 'R' then l_linenumber - 2 end"),
    ("search_query", "case when mod(l_linenumber + l_partkey, 7) = 2 then concat(' ', p_name) end"),
]

LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
]


#: The tables that the star join reads.
SOURCE_TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


@dataclass(frozen=True)
class InParts:
    """A way to deal the joined rows for which `where` holds into `n` parts without a
    shuffle of their own: the one on the part key gets a multiple of `n` partitions."""

    n: int
    where: Column | None = None

    def by_part_key(self, rows: DataFrame) -> DataFrame:
        each = -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // self.n)
        return (rows if self.where is None else rows.where(self.where)).repartition(each * self.n, "l_partkey")


Dealt = Callable[[DataFrame], DataFrame] | InParts | None


def joined_sources(spark: SparkSession, sf_dir: str, dealt: Dealt = None) -> DataFrame:
    """The star join feeding the fixture, pruned to the columns it uses. `dealt`
    repartitions the rows before nation and region, of a few rows each, join them."""
    t = lambda name: read_table(spark, sf_dir, name)
    geo = t("nation").select("n_nationkey", "n_name", "n_regionkey").join(
        t("region").select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    cust = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    orders = (
        t("orders")
        .select("o_orderkey", "o_custkey", "o_orderpriority")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .hint("shuffle_hash")
    )
    part = t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice").hint("shuffle_hash")
    rows = t("lineitem").select(*LINEITEM_COLS).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if isinstance(dealt, InParts):
        rows = dealt.by_part_key(rows)
    rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if isinstance(dealt, InParts):
        rows = rows.coalesce(dealt.n)
    elif dealt is not None:
        rows = dealt(rows)
    return rows.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))


def event_rows(spark: SparkSession, sf_dir: str, dealt: Dealt = None) -> DataFrame:
    """Kafka metadata + the 25 event fields, as the producer would send them."""
    cols = [F.expr(expr).alias(name) for name, expr in F1_COLUMNS]
    typed = {f.name: f.dataType for f in BRONZE_SCHEMA.fields}
    return joined_sources(spark, sf_dir, dealt).select(*cols).select(
        *[F.col(f"`{name}`").cast(typed[name]).alias(name) for name, _ in F1_COLUMNS]
    )


def source_column(name: str) -> Column:
    """An event column as an expression over the joined tables, typed as in Bronze."""
    typed = {f.name: f.dataType for f in BRONZE_SCHEMA.fields}
    return F.expr(dict(F1_COLUMNS)[name]).cast(typed[name])


def in_ranges(n: int, *order: str | Column, where: Column | None = None) -> Callable[[DataFrame], DataFrame]:
    """A `dealt`: the joined rows for which `where` holds, in `n` ranges of `order`. The
    narrow source rows are shuffled; event fields and JSON are made after it."""

    def dealt(rows: DataFrame) -> DataFrame:
        kept = rows if where is None else rows.where(where)
        return kept.repartitionByRange(n, *[source_column(c) if isinstance(c, str) else c for c in order])

    return dealt


def slices(spark: SparkSession, sf_dir: str, n: int, time: Column, where: Column | None = None) -> list[Column]:
    """`n` conditions that part the source rows (of those for which `where` holds) into
    slices of about equal size by `time`, a timestamp made of line item columns; rows without one come first."""
    rows = read_table(spark, sf_dir, "lineitem")
    at = F.unix_micros(time)
    cuts = (rows if where is None else rows.where(where)).agg(F.percentile_approx(at, [i / n for i in range(1, n)])).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    kept = []
    for low, high in zip(edges, edges[1:]):
        inside = F.lit(True) if low is None else at >= low
        inside = inside if high is None else inside & (at < high)
        kept.append(F.coalesce(inside, F.lit(low is None)))
    return [c if where is None else c & where for c in kept]


def bronze_fixture(spark: SparkSession, sf_dir: str, dealt: Dealt = None) -> DataFrame:
    """the 32 Bronze columns (event times parsed tolerantly)."""
    return add_event_times(event_rows(spark, sf_dir, dealt)).select(*BRONZE_COLUMNS)


def kafka_fixture(spark: SparkSession, sf_dir: str, dealt: Dealt = None) -> DataFrame:
    """Kafka-shaped rows, key = user_id, value = compact JSON of the event."""
    ev = event_rows(spark, sf_dir, dealt)
    return ev.select(
        F.col("user_id").cast("binary").alias("key"),
        json_value().cast("binary").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("kafka_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


# ---------------------------------------------------------------- oracle side

_DUCK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}


def _quote(name: str) -> str:
    return f'"{name}"'


def event_rows_sql() -> str:
    """DuckDB SELECT producing the same rows as `event_rows`."""
    typed = {f.name: _DUCK_TYPES[f.dataType.simpleString()] for f in BRONZE_SCHEMA.fields}
    cols = ",\n  ".join(f"CAST({expr} AS {typed[name]}) AS {_quote(name)}" for name, expr in F1_COLUMNS)
    return (
        f"SELECT\n  {cols}\nFROM lineitem\n"
        "JOIN orders ON l_orderkey = o_orderkey\n"
        "JOIN customer ON o_custkey = c_custkey\n"
        "JOIN nation ON c_nationkey = n_nationkey\n"
        "JOIN region ON n_regionkey = r_regionkey\n"
        "JOIN part ON l_partkey = p_partkey"
    )


def bronze_sql() -> str:
    """DuckDB SELECT producing the same rows as `bronze_fixture`."""
    cols = ", ".join(_quote(c) for c in BRONZE_COLUMNS[:-2])
    return (
        f"SELECT {cols},\n"
        '  TRY_CAST("timestamp" AS TIMESTAMP) AS event_timestamp,\n'
        "  TRY_CAST(event_date AS DATE) AS event_date_parsed\n"
        f"FROM ({event_rows_sql()}) ev"
    )


# ------------------------------------------------ raw-record fixture variants


def json_value(columns: list[str] = EVENT_COLUMNS, keep_nulls: bool = False):
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), opts)


def validation_lines(spark: SparkSession, sf_dir: str, dealt: Dealt = None) -> DataFrame:
    """F4 at table scale: one raw line per event, with every kind of bad line planted."""
    off = F.col("offset")
    # The record as a column of its own, made once per row and not once per branch that shows it.
    shown_without_nulls = [off % d == 0 for d in (67, 61, 59, 53, 43, 29)]
    json_text = F.when((off % 2 == 0) & ~reduce(or_, shown_without_nulls), json_value(keep_nulls=True)).otherwise(json_value())
    record = F.col("_record")
    no_ids = [c for c in EVENT_COLUMNS if c not in ("event_id", "user_id")]
    line = (
        F.when(off % 211 == 0, F.lit(None).cast("string"))
        .when(off % 83 == 0, F.lit("   "))
        .when(off % 79 == 0, F.concat(F.lit("{bad "), F.col("session_id")))
        .when(off % 73 == 0, F.lit("[1]"))
        .when(off % 71 == 0, json_value(no_ids))
        .when(off % 67 == 0, F.concat(record, record))
        .when(off % 61 == 0, F.concat(record, F.lit(" "), record))
        .when(off % 59 == 0, F.concat(record, F.lit("}")))
        .when(off % 53 == 0, F.concat(record, F.lit(" x}")))
        .when(off % 47 == 0, F.concat(F.lit("{'event_id': '"), F.col("session_id"), F.lit("'}")))
        .when(off % 43 == 0, F.concat(record, F.lit(","), record))
        .when(off % 41 == 0, F.lit("NaN"))
        .when(off % 37 == 0, F.lit("{} {}"))
        .when(off % 31 == 0, F.lit("null"))
        .when(off % 29 == 0, F.concat(F.lit("\x1c\x85"), record, F.lit("\x0b")))
        .when(off % 23 == 0, F.concat(F.lit('{"event_id":"\\u001c","user_id":"u","session_id":"s","event_type":"t","timestamp":"'), F.col("timestamp"), F.lit('","product_id":"p"}')))
        .when(off % 19 == 0, F.lit('{"event_id":"a","event_id":"b","user_id":"u","session_id":"s","event_type":"t","timestamp":"x","product_id":"p"}'))
        .otherwise(record)
    )
    return event_rows(spark, sf_dir, dealt).withColumn("_record", json_text).select("offset", "partition", line.alias("json_line"))


VALIDATION_EXPECTED_SQL = f"""
SELECT "offset", "partition",
  CASE WHEN "offset" % 211 = 0 THEN 'Input is not a string'
       WHEN "offset" % 83 = 0 THEN 'Empty line'
       WHEN "offset" % 79 = 0 THEN 'Invalid JSON'
       WHEN "offset" % 73 = 0 THEN 'JSON record is not an object'
       WHEN "offset" % 71 = 0 THEN 'Missing required fields: event_id, user_id'
       WHEN "offset" % 67 = 0 OR "offset" % 61 = 0 OR "offset" % 59 = 0 OR "offset" % 53 = 0 OR "offset" % 47 = 0 OR "offset" % 43 = 0 THEN 'Invalid JSON'
       WHEN "offset" % 41 = 0 THEN 'JSON record is not an object'
       WHEN "offset" % 37 = 0 THEN 'Invalid JSON'
       WHEN "offset" % 31 = 0 THEN 'JSON record is not an object'
       WHEN "offset" % 29 = 0 AND event_id IS NULL THEN 'Missing required fields: event_id'
       WHEN "offset" % 29 = 0 AND TRIM(event_id) = '' THEN 'Required field ''event_id'' is empty'
       WHEN "offset" % 29 = 0 THEN ''
       WHEN "offset" % 23 = 0 THEN 'Required field ''event_id'' is empty'
       WHEN "offset" % 19 = 0 THEN ''
       WHEN event_id IS NULL AND "offset" % 2 = 0 THEN 'Required field ''event_id'' is null'
       WHEN event_id IS NULL THEN 'Missing required fields: event_id'
       WHEN TRIM(event_id) = '' THEN 'Required field ''event_id'' is empty'
       ELSE '' END AS reason
FROM ({event_rows_sql()}) ev
"""


def write_validation_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """F4 as a log per Kafka partition under `partition=<n>`: compressed text files that
    follow each other by name, in the order of the offsets (a null line as a blank one);
    every 13th offset is followed by a blank line. A task writes a range of offsets, so a
    log of any size is in no single task."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = F.coalesce("json_line", F.lit(""))
    line = F.when(F.col("offset") % 13 == 0, F.concat(line, F.lit("\n \t"))).otherwise(line)
    rows = validation_lines(spark, sf_dir, in_ranges(n, "partition", "offset")).select("partition", "offset", line.alias("value"))
    log = rows.sortWithinPartitions("partition", "offset").select("partition", "value").write
    with settings(spark, DROP_SHUFFLES):
        log.partitionBy("partition").text(path, compression="gzip")


QUARANTINE_EXPECTED_SQL = f"""
SELECT * FROM (SELECT "partition", reason, row_number() OVER w + coalesce(sum(CASE WHEN "offset" % 13 = 0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY "partition" ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line_number
  FROM ({VALIDATION_EXPECTED_SQL}) v WINDOW w AS (PARTITION BY "partition" ORDER BY "offset")) n
WHERE reason NOT IN ('', 'Empty line', 'Input is not a string')
"""


def kafka_with_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with a non-JSON payload planted in some records."""
    k = kafka_fixture(spark, sf_dir)
    return k.withColumn(
        "value", F.when(F.col("offset") % 101 == 0, F.lit("not json").cast("binary")).otherwise(F.col("value"))
    )


def kafka_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with a bare NaN price planted in some records (accepted by the JSON parser)."""
    k = kafka_fixture(spark, sf_dir)
    nan_value = F.regexp_replace(F.col("value").cast("string"), r'"product_price":[-0-9.Ee]+', '"product_price":NaN')
    return k.withColumn("value", F.when(F.col("offset") % 31 == 0, nan_value.cast("binary")).otherwise(F.col("value")))


# --------------------------------------------------- F7: the events stream

# (column, SQL over `events`), valid in Spark and DuckDB: one shop event per
# row of the driver's `events` table.
F7_COLUMNS: list[tuple[str, str]] = [
    ("event_id", "cast(event_id as string)"),
    ("user_id", "concat('user_', lpad(cast(user_id as string), 6, '0'))"),
    ("session_id", "concat('s-', cast(user_id as string), '-', cast(cast(ts as date) as string))"),
    ("event_type", "event_type"),
    ("event_date", "cast(cast(ts as date) as string)"),
    ("product_id", "concat('P-', json_extract_string_k)"),
    ("product_price", "value"),
    ("quantity", "cast(1 + event_id % 5 as int)"),
    ("sales", "value"),
]


def events_kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records of the events table: key = user_id, offset =
    event_id, Kafka partition = user_id mod 4, value = compact JSON with the
    ISO event time."""
    ev = read_table(spark, sf_dir, "events").withColumn("json_extract_string_k", F.get_json_object("props", "$.k"))
    fields = [F.expr(expr).alias(name) for name, expr in F7_COLUMNS]
    iso_ts = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return ev.select(
        F.expr("concat('user_', lpad(cast(user_id as string), 6, '0'))").cast("binary").alias("key"),
        F.to_json(F.struct(*fields, iso_ts.alias("timestamp"))).cast("binary").alias("value"),
        F.lit("ecommerce-events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def events_bronze_sql() -> str:
    """DuckDB rows the Bronze stream must produce from `events_kafka` (typed
    columns only)."""
    k = "json_extract_string(props, '$.k')"
    cols = ",\n  ".join(f"{expr.replace('json_extract_string_k', k)} AS {name}" for name, expr in F7_COLUMNS)
    return (
        f"SELECT CAST(user_id % 4 AS INTEGER) AS \"partition\", event_id AS \"offset\",\n  {cols},\n"
        "  CAST(ts AS TIMESTAMP) AS event_timestamp, CAST(ts AS DATE) AS event_date_parsed\nFROM events"
    )


# ------------------------------------------------- extreme amounts in Bronze

#: (column, divisor of the offset, planted value). Powers of two: sums of one of
#: them are exact in any order, so both engines must agree to the last bit.
EXTREME_AMOUNTS = [("sales", 401, 2.0**60), ("sales", 397, 2.0**1000), ("product_price", 389, 2.0**124), ("product_price", 383, float("inf")), ("sales", 379, float("inf"))]


def bronze_with_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze with amounts far outside the exact range planted in some rows."""
    b = bronze_fixture(spark, sf_dir)
    for column, divisor, value in EXTREME_AMOUNTS:
        b = b.withColumn(column, F.when(F.col("offset") % divisor == 0, F.lit(value)).otherwise(F.col(column)))
    return b


def bronze_with_extremes_sql() -> str:
    out = {"sales": "sales", "product_price": "product_price"}
    for column, divisor, value in EXTREME_AMOUNTS:
        shown = "CAST('Infinity' AS DOUBLE)" if value == float("inf") else f"CAST({value!r} AS DOUBLE)"
        out[column] = f'CASE WHEN "offset" % {divisor} = 0 THEN {shown} ELSE {out[column]} END'
    return f"SELECT * REPLACE ({', '.join(f'{x} AS {c}' for c, x in out.items())}) FROM ({bronze_sql()}) plain"


# ------------------------------------------------ F8: event-specific payload

#: (field, SQL over `events`), valid in Spark and DuckDB: values by event type as
#: a producer sends them; other types lack the field.
PAYLOAD_RULES: list[tuple[str, str]] = [
    ("page", "CASE WHEN event_type = 'view' THEN concat('page_', cast(event_id % 6 as string)) END"),
    ("duration_seconds", "CASE WHEN event_type = 'view' THEN cast(5 + event_id % 896 as double) END"),
    ("view_duration_seconds", "CASE WHEN event_type IN ('view', 'click') THEN cast(5 + event_id % 596 as double) END"),
    ("cart_quantity", "CASE WHEN event_type = 'add_to_cart' OR event_id % 3 = 0 THEN cast(1 + event_id % 5 as int) END"),
    ("order_id", "CASE WHEN event_type = 'purchase' THEN concat('ORD-', cast(100000 + event_id % 900000 as string)) END"),
    ("payment_method", "CASE WHEN event_type = 'purchase' AND event_id % 7 <> 0 THEN 'paypal' END"),
    ("purchase_status", "CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 7 = 0 THEN 'failed' ELSE 'completed' END END"),
    ("failure_reason", "CASE WHEN event_type = 'purchase' AND event_id % 7 = 0 THEN 'card_declined' END"),
]


def events_with_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as raw JSON with its payload fields (absent where NULL)."""
    fields = F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type", *[F.expr(sql).alias(name) for name, sql in PAYLOAD_RULES])
    return read_table(spark, sf_dir, "events").select("event_id", F.to_json(fields).alias("raw"))
