"""Column-expression helpers shared by the layers (all JVM-side, no UDFs)."""

from strata.functions.columns import (
    BLANKS,
    in_exact_range,
    is_blank,
    lower_trim,
    money_round,
    money_sum,
    money_avg,
    to_cents,
    nan_to_null,
    not_blank,
    pct,
    strip_ws,
)

__all__ = [
    "BLANKS",
    "in_exact_range",
    "is_blank",
    "lower_trim",
    "money_round",
    "money_sum",
    "money_avg",
    "to_cents",
    "nan_to_null",
    "not_blank",
    "pct",
    "strip_ws",
]
