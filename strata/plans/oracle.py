"""Independent DuckDB SQL for the driver's differential check.

Written from the layer rules, not generated from the Spark plans. Money is made
exact on the DuckDB side with DECIMAL / integer arithmetic so both engines
agree to the last bit: DuckDB rounds doubles in binary, Spark on the printed
value, and DuckDB's AVG and decimal division return DOUBLE.
"""

from __future__ import annotations

from strata.plans.fixtures import bronze_sql
from strata.schema import LOWER_TRIM_COLUMNS, SILVER_COLUMNS, SILVER_REQUIRED, TRIM_COLUMNS


#: Amounts below this are exact decimals, others plain doubles.
EXACT_LIMIT = 1e9


def inside(x: str) -> str:
    return f"abs(COALESCE({x}, 0)) < {EXACT_LIMIT!r}"


def round2(x: str) -> str:
    """Spark's ROUND(double, 2) for inputs with at most 4 decimals, or beyond the exact range."""
    return f"IF({inside(x)}, CAST(ROUND(TRY_CAST({x} AS DECIMAL(18,4)), 2) AS DOUBLE), {x})"


def wide_sum(x: str) -> str:
    """The double sum of the amounts beyond the exact range, NULL without any."""
    return f"SUM(CAST({x} AS DOUBLE)) FILTER (NOT ({inside(x)}))"


def money_sum(x: str) -> str:
    exact = f"CAST(SUM(IF({inside(x)}, TRY_CAST(COALESCE({x}, 0) AS DECIMAL(18,2)), 0)) AS DOUBLE)"
    return f"COALESCE({exact} + {wide_sum(x)}, {exact})"


def int_sum(x: str) -> str:
    return f"CAST(SUM(COALESCE({x}, 0)) AS BIGINT)"


def avg6(x: str) -> str:
    """AVG(COALESCE(x,0)) rounded HALF_UP to 6 places, exactly (integer cents); a
    plain double mean where an amount is beyond the exact range."""
    s = f"SUM(IF({inside(x)}, TRY_CAST(ROUND(COALESCE({x}, 0) * 100) AS BIGINT), 0))"
    n = "COUNT(*)"
    exact = (
        f"CAST(CASE WHEN {s} >= 0 THEN ({s} * 20000 + {n}) // (2 * {n}) "
        f"ELSE -((-{s} * 20000 + {n}) // (2 * {n})) END AS DOUBLE) / 1000000"
    )
    return f"IF({wide_sum(x)} IS NULL, {exact}, {money_sum(x)} / {n})"


def pct(n: str, d: str) -> str:
    """ROUND(CASE WHEN d = 0 THEN 0 ELSE n * 100.0 / d END, 2), exactly, for n, d >= 0."""
    return f"CAST(CASE WHEN {d} = 0 THEN 0 ELSE ({n} * 20000 + {d}) // (2 * {d}) END AS DOUBLE) / 100"


#: Rows with the same event id: the latest event time stays, then the highest offset, then the highest partition.
LATEST = (
    "{t: event_timestamp, o: COALESCE(\"offset\", CAST(-9223372036854775808 AS BIGINT)), "
    "p: COALESCE(\"partition\", CAST(-2147483648 AS INTEGER))}"
)
RESOLVED_DATE = "COALESCE(event_date_parsed, TRY_CAST(event_date AS DATE), CAST(event_timestamp AS DATE))"


def quoted(c: str) -> str:
    return f'"{c}"'


def keep_rule() -> str:
    """Every required id has a visible character, and the event time is known."""
    return " AND ".join([f"LENGTH(TRIM(COALESCE({c}, ''))) > 0" for c in SILVER_REQUIRED] + ["event_timestamp IS NOT NULL"])


def standard_columns() -> dict[str, str]:
    """The standardised expression of every column that the rules touch."""
    out = {c: f"TRIM({quoted(c)})" for c in TRIM_COLUMNS}
    out |= {c: f"LOWER(TRIM({quoted(c)}))" for c in LOWER_TRIM_COLUMNS}
    out |= {c: round2(c) for c in ("product_price", "discount_percent", "sales")}
    out |= {c: f"CAST({c} AS INTEGER)" for c in ("quantity", "removed_quantity")}
    out["event_date"] = RESOLVED_DATE
    return out


def at_least(x: str, low: str) -> str:
    """GREATEST that keeps NULL."""
    return f"IF({x} IS NULL, NULL, GREATEST({x}, {low}))"


def clamped_columns(given: dict[str, str]) -> dict[str, str]:
    """The bounds, over given expressions of the four bounded columns."""
    return {
        "product_price": f"IF({given['product_price']} >= 0, {given['product_price']}, NULL)",
        "quantity": at_least(given["quantity"], "0"),
        "removed_quantity": at_least(given["removed_quantity"], "0"),
        "discount_percent": f"IF({given['discount_percent']} IS NULL, NULL, LEAST(GREATEST({given['discount_percent']}, 0), 100))",
    }


def discount(price: str, quantity: str, percent: str) -> str:
    """round(price * quantity * percent / 100, 2) in exact decimals, NULL as 0; the double product for a price beyond the range."""
    exact = (f"CAST(ROUND(TRY_CAST(COALESCE({price}, 0) AS DECIMAL(18,2)) * COALESCE({quantity}, 0) "
             f"* CAST(COALESCE({percent}, 0) AS DECIMAL(5,2)) * 0.01, 2) AS DOUBLE)")
    wide = f"{price} * CAST(COALESCE({quantity}, 0) AS DOUBLE) * CAST(COALESCE({percent}, 0) AS DOUBLE) / CAST(100 AS DOUBLE)"
    return f"IF({inside(price)}, {exact}, {wide})"


def silver_rows() -> str:
    """One row per event id out of `bronze`, in three steps: bounded columns, the
    latest row of each id as a struct, derived columns."""
    standard = standard_columns()
    bounded = standard | clamped_columns(standard)
    own = [c for c in SILVER_COLUMNS if c not in ("net_quantity", "discount_amount")]
    fields = ", ".join(f"{quoted(c)} := {bounded.get(c, quoted(c))}" for c in own)
    derived = {
        "net_quantity": "GREATEST(r.quantity - COALESCE(r.removed_quantity, 0), 0)",
        "discount_amount": discount("r.product_price", "r.quantity", "r.discount_percent"),
    }
    shown = ", ".join(f"{derived.get(c, 'r.' + quoted(c))} AS {quoted(c)}" for c in SILVER_COLUMNS)
    return (f"SELECT {shown} FROM (SELECT arg_max(struct_pack({fields}), {LATEST}) AS r "
            f"FROM bronze WHERE {keep_rule()} GROUP BY TRIM(event_id))")


def with_bronze(select: str) -> str:
    return f"WITH bronze AS (\n{bronze_sql()}\n)\n{select}"


def silver_over(bronze_select: str, select: str) -> str:
    """`select` over the Silver rules applied to any Bronze-shaped SELECT."""
    return f"WITH bronze AS (\n{bronze_select}\n),\nsilver AS (\n{silver_rows()}\n)\n{select}"


def with_silver(select: str) -> str:
    return silver_over(bronze_sql(), select)


SILVER = with_silver("SELECT * FROM silver")


def counted(**columns: str) -> list[str]:
    """COUNT(DISTINCT column) AS name for each name=column."""
    return [f"COUNT(DISTINCT {c}) AS {name}" for name, c in columns.items()]


def totals(*columns: str) -> list[str]:
    """Exact sums under total_<column>: money for amounts, BIGINT for quantities."""
    return [f"{(int_sum if 'quantity' in c else money_sum)(c)} AS total_{c}" for c in columns]


def grouped(key: list[str], measures: list[str]) -> str:
    """Measures per key over `silver`; rows without the first key column are no group."""
    keys = ", ".join(key)
    return f"SELECT {keys}, {', '.join(measures)} FROM silver WHERE {key[0]} IS NOT NULL GROUP BY {keys}"


EVENTS = "COUNT(*) AS total_events"
QUANTITIES = ("quantity", "removed_quantity", "net_quantity")

DAILY_SALES_SELECT = grouped(
    ["event_date"],
    [EVENTS, *counted(unique_customers="user_id", unique_sessions="session_id", unique_products="product_id"),
     *totals("sales", *QUANTITIES, "discount_amount"),
     f"{avg6('sales')} AS average_event_sales", f"{avg6('discount_percent')} AS average_discount_percent"],
)

PRODUCT_SELECT = grouped(
    ["product_id", "product_name", "category", "sub_category"],
    [EVENTS, *counted(unique_customers="user_id", unique_sessions="session_id"), *totals(*QUANTITIES, "sales", "discount_amount"),
     f"{avg6('product_price')} AS average_product_price", f"{avg6('discount_percent')} AS average_discount_percent"],
)

CUSTOMER_SELECT = grouped(
    ["user_id"],
    [*(f"MAX({c}) AS {c}" for c in ("customer_name", "segment", "country", "market", "region")),
     EVENTS, *counted(total_sessions="session_id", unique_products_viewed="product_id"), *totals(*QUANTITIES, "sales", "discount_amount"),
     "MIN(event_timestamp) AS first_activity", "MAX(event_timestamp) AS last_activity"],
)

#: Event types that count as a stage of the funnel.
FUNNEL = {
    "view": ("view",), "add_to_cart": ("add_to_cart",), "remove_from_cart": ("remove_from_cart",),
    "purchase": ("purchase", "order", "checkout", "complete_purchase"),
}


def session_flags_select(**vocabulary: tuple[str, ...]) -> str:
    """1 or 0 per session and stage."""
    stages = FUNNEL | vocabulary
    return grouped(["session_id"], [f"CAST(bool_or(list_contains({list(types)}, event_type)) AS INTEGER) AS has_{stage}" for stage, types in stages.items()])


def conversion_select(**vocabulary: tuple[str, ...]) -> str:
    """One row: sessions per stage and the rates between stages."""
    rates = {"view": ("view", "total"), "add_to_cart": ("add_to_cart", "view"), "cart_to_purchase": ("purchase", "add_to_cart"), "overall_conversion": ("purchase", "total")}
    n = ", ".join(f"COUNT(*) FILTER (has_{stage} = 1) AS {stage}_sessions" for stage in FUNNEL)
    shown = ", ".join(f"{pct(up + '_sessions', down + '_sessions')} AS {name}_rate_percent" for name, (up, down) in rates.items())
    return f"SELECT *, {shown} FROM (SELECT COUNT(*) AS total_sessions, {n} FROM ({session_flags_select(**vocabulary)}))"


def sales_check_select() -> str:
    """Recorded against recomputed sales, exact decimals inside the range and doubles beyond it."""
    keep = "(100 - CAST(discount_percent AS DECIMAL(5,2))) * 0.01"
    known = " AND ".join(f"{c} IS NOT NULL" for c in ("product_price", "quantity", "discount_percent", "sales"))
    rows = (
        f"SELECT {known} AS ok, {inside('product_price')} AND {inside('sales')} AS exact, sales, "
        f"IF(exact, ROUND(TRY_CAST(product_price AS DECIMAL(18,2)) * quantity * ({keep}), 2), NULL) AS re, "
        "IF(exact, TRY_CAST(sales AS DECIMAL(18,2)), NULL) AS rec, "
        "product_price * CAST(quantity AS DOUBLE) * ((CAST(100 AS DOUBLE) - discount_percent) * CAST(0.01 AS DOUBLE)) AS wide, "
        "IF(exact, re = rec, wide = sales) AS same FROM silver"
    )

    def total(x: str, y: str) -> str:
        part = f"CAST(SUM({x}) FILTER (ok AND exact) AS DOUBLE)"
        return f"COALESCE(COALESCE({part}, 0) + SUM({y}) FILTER (ok AND NOT exact), {part})"

    return (f"SELECT COUNT(*) AS rows_total, COUNT(*) FILTER (ok) AS rows_checked, COUNT(*) FILTER (ok AND same) AS rows_matching, "
            f"COUNT(*) FILTER (ok AND NOT same) AS rows_mismatching, {total('rec', 'sales')} AS recorded_sales, {total('re', 'wide')} AS recomputed_sales FROM ({rows})")
