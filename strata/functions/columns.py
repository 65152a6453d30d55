"""Column expressions used by every layer.

All helpers return `Column` objects built from `pyspark.sql.functions`, so they
stay inside whole-stage codegen; none of them triggers an action.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money is stored as DOUBLE (as in the reference tables) but summed as exact
# integer cents, so totals do not depend on the order rows arrive in.


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_trim(c: Column | str) -> Column:
    return F.lower(F.trim(_c(c)))


#: White space as Python's `str.strip` sees it: Unicode White_Space and the four separators U+001C to U+001F.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip_ws(c: Column | str) -> Column:
    """Strip every white-space character from both ends, like `str.strip`. Most text
    has none there and is passed as it is after a look at its first and last character;
    for a JSON object that look needs no count of the characters between them."""
    c, blanks = _c(c), F.lit(BLANKS)
    braced = F.startswith(c, F.lit("{")) & F.endswith(c, F.lit("}"))
    edge = F.contains(blanks, F.substring(c, 1, 1)) | F.contains(blanks, F.substring(c, -1, 1))
    return F.when(braced, c).when(edge, F.btrim(c, blanks)).otherwise(c)


def is_blank(c: Column | str) -> Column:
    """True for empty text and text of white space alone."""
    return F.btrim(_c(c), F.lit(BLANKS)) == F.lit("")


def not_blank(c: Column | str) -> Column:
    c = _c(c)
    return c.isNotNull() & (F.trim(c) != F.lit(""))


def nan_to_null(c: Column | str) -> Column:
    """NaN → NULL for a DOUBLE column (`from_json` accepts bare NaN)."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def money_round(c: Column | str) -> Column:
    """ROUND(CAST(x AS DOUBLE), 2) with Spark's HALF_UP on the printed double."""
    return F.round(_c(c).cast("double"), 2)


#: Amounts below this size (in currency units) are computed exactly, as cents in a
#: long; their double has its two decimals. Larger, infinite or NaN amounts are
#: computed in DOUBLE.
EXACT_LIMIT = 1e9


def in_exact_range(c: Column | str) -> Column:
    """True for amounts of the exact range; NULL counts as 0."""
    return F.coalesce(F.abs(_c(c).cast("double")) < F.lit(EXACT_LIMIT), F.lit(True))


def to_cents(c: Column | str) -> Column:
    """A 2-decimal DOUBLE amount as exact integer cents; NULL and amounts outside
    the exact range give 0."""
    x = _c(c).cast("double")
    inside = F.when(F.abs(x) < F.lit(EXACT_LIMIT), x)
    return F.coalesce(F.round(inside * 100).cast("bigint"), F.lit(0).cast("bigint"))


def _cent() -> Column:
    return F.lit(0.01).cast(DecimalType(3, 2))


def _exact_total(c: Column | str) -> Column:
    """The exact amounts' total as DECIMAL; NULL where cents leave the long range."""
    return F.try_sum(to_cents(c)).cast(DecimalType(38, 0)) * _cent()


def _wide_total(c: Column | str) -> Column:
    """The DOUBLE sum of the amounts outside the exact range, NULL without any."""
    return F.sum(F.when(~in_exact_range(c), _c(c).cast("double")))


def money_sum(c: Column | str) -> Column:
    """SUM(COALESCE(x, 0)) as DOUBLE, exact for amounts of the exact range.

    Summed as integer cents: a long aggregation buffer stays on the fast
    fixed-width path (a wide DECIMAL buffer would do BigDecimal arithmetic per
    row) and is exact whatever the row order. The one decimal step happens once
    per group. Amounts outside the range are added as a second, DOUBLE sum; if
    the cents of a group overflow, the whole sum is a DOUBLE sum.
    """
    exact, wide = _exact_total(c).cast("double"), _wide_total(c)
    plain = F.sum(F.coalesce(_c(c).cast("double"), F.lit(0.0)))
    return F.when(F.count(F.lit(1)) == 0, F.lit(None).cast("double")).when(exact.isNull(), plain).when(wide.isNull(), exact).otherwise(exact + wide)


def money_avg(c: Column | str) -> Column:
    """AVG(COALESCE(x, 0)) rounded HALF_UP to 6 places as DOUBLE, exact for amounts
    of the exact range.

    NULLs count as 0, so the mean is over every row of the group.
    """
    n = F.count(F.lit(1))
    exact = (_exact_total(c) / n.cast(DecimalType(20, 0))).cast("double")
    return F.when(exact.isNotNull() & _wide_total(c).isNull(), exact).otherwise(money_sum(c) / n)


def pct(n: Column | str, d: Column | str) -> Column:
    """ROUND(CASE WHEN d = 0 THEN 0 ELSE n * 100.0 / d END, 2) as DOUBLE.

    d = 0 gives 0.00; a NULL d (empty input) gives NULL.
    """
    n, d = _c(n), _c(d)
    ratio = F.when(d == 0, F.lit(0).cast("decimal(38,15)")).otherwise(
        n.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)") / d.cast("decimal(20,0)")
    )
    return F.round(ratio, 2).cast("double")
