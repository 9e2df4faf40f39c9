"""Numeric column helpers: tolerant parsing, exact sums, half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Wide enough for any sum of money; what does not fit (1e30 and more, or not finite) counts as absent, see ``unfit``.
EXACT = "decimal(38,8)"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def num_text(c: str | Column) -> Column:
    """Text of a number without the blanks around it."""
    return F.trim(as_col(c).cast("string"))


def text_value(c: str | Column) -> Column:
    """The number that a trimmed text is, else null; names its text twice."""
    text = as_col(c)
    # The JVM also accepts "12d" and "12f" as numbers; the extracts never mean that.
    return F.when(~F.lower(F.right(text, F.lit(1))).isin("d", "f", "n"), text.try_cast("double"))


def num(c: str | Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    return bind(num_text(c), text_value)


# Currency signs, separators and blanks that surround amounts.
_AROUND_MONEY = "₹$€,% \t\n\r\f\v\u00a0"


def money_text(c: str | Column) -> Column:
    """Text of an amount without currency signs, separators and blanks."""
    return num_text(F.translate(as_col(c).cast("string"), _AROUND_MONEY, ""))


def money(c: str | Column) -> Column:
    """Currency text such as '₹10,422.42' or '0.00%' to double."""
    return bind(money_text(c), text_value)


def exact_sum(c: str | Column) -> Column:
    """Sum of money, null when there is nothing to add.

    Adding decimals gives the same answer whatever order the tasks finish in,
    so a retried task never moves a total by a rounding error.
    """
    return F.try_sum(as_col(c).try_cast(EXACT)).cast("double")


def unfit(c: str | Column) -> Column:
    """How many values are there but too large for an exact sum."""
    return F.count(F.when(as_col(c).isNotNull() & as_col(c).try_cast(EXACT).isNull(), F.lit(1)))


def money_sum(c: str | Column) -> Column:
    """Sum of money, 0 when there is nothing to add."""
    if isinstance(c, str):
        return F.expr(f"coalesce(cast(try_sum(try_cast({c} as {EXACT})) as double), 0.0D)")
    return F.coalesce(exact_sum(c), F.lit(0.0))


def unit_sum(c: str | Column) -> Column:
    """Sum of units, 0 when there is nothing to add."""
    if isinstance(c, str):
        return F.expr(f"coalesce(sum({c}), 0.0D)")
    return F.coalesce(F.sum(as_col(c)), F.lit(0.0))


def sum_if(condition: Column, c: str | Column) -> Column:
    return unit_sum(F.when(condition, as_col(c)))


def money_if(condition: Column, c: str | Column) -> Column:
    return money_sum(F.when(condition, as_col(c)))


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """Round on the scaled double, ties to even; never yields a negative zero."""
    scale = float(10**digits)
    return F.rint(as_col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, null when b is 0 or null."""
    return F.try_divide(as_col(a).cast("double"), F.nullif(as_col(b).cast("double"), F.lit(0.0)))


def percent(a: str | Column, b: str | Column, digits: int = 1) -> Column:
    return round_half_even(ratio(a, b) * F.lit(100.0), digits)


def fmt_sql(n: str) -> str:
    """SQL for a number as reading text: no decimals from 10 up, else one; a dash for null."""
    return f"coalesce(format_number({n}, if(abs({n}) >= 10, 0, 1)), '—')"


def fmt(n: str) -> Column:
    return F.expr(fmt_sql(n))
