"""Native column expressions shared by the operators.

Everything here returns a Catalyst expression; nothing runs Python per row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

MONEY = "decimal(10,2)"
TOTAL = "decimal(20,2)"


def moment(value: datetime) -> Column:
    """A zone-free timestamp literal, so that comparisons fold and reach the scan."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_start(value: datetime) -> Column:
    return moment(value.replace(hour=0, minute=0, second=0, microsecond=0))


def plus_days(ts: Column, days: int | Column) -> Column:
    days = F.lit(days) if isinstance(days, int) else days
    return ts + F.make_dt_interval(days)


def plus_months(ts: Column, months: int | Column) -> Column:
    """Add months; the last day of a month stays the last day of a month."""
    months = F.lit(months) if isinstance(months, int) else months
    moved = ts + F.make_ym_interval(F.lit(0), months)
    at_month_end = F.to_date(ts) == F.last_day(ts)
    to_month_end = F.datediff(F.last_day(moved), F.to_date(moved))
    return F.when(at_month_end, moved + F.make_dt_interval(to_month_end)).otherwise(moved)


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down (also below zero)."""
    gap = later - earlier
    days = F.extract(F.lit("DAY"), gap)
    short = (gap < F.make_dt_interval(days)).cast("int")
    return (days - short).cast("long")


def ceil_days(later: Column, earlier: Column) -> Column:
    return -floor_days(earlier, later)


def strict_greatest(*cols: Column) -> Column:
    """Greatest value, NULL as soon as one argument is NULL."""
    return F.when(_any_null(cols), F.lit(None)).otherwise(F.greatest(*cols))


def strict_least(*cols: Column) -> Column:
    return F.when(_any_null(cols), F.lit(None)).otherwise(F.least(*cols))


def _any_null(cols: tuple[Column, ...]) -> Column:
    test = F.lit(False)
    for col in cols:
        test = test | col.isNull()
    return test


def joined_text(*parts: Column | str) -> Column:
    """Concatenate, reading NULL as the empty text."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(*cols)


def number_text(value: Column) -> Column:
    """Print a number in its shortest form: 5.00 -> 5, 0.50 -> .5, -0.5 -> -.5."""
    text = value.cast("string")
    trimmed = F.when(
        text.contains("."), F.regexp_replace(text, r"\.?0+$", "")
    ).otherwise(text)
    return F.regexp_replace(trimmed, r"^(-?)0\.", "$1.")


def cents(amount: Column) -> Column:
    """Money as a whole number of cents."""
    return (amount * 100).cast("decimal(28,0)")


def half_up_ratio(num: Column, den: Column, scale: int) -> Column:
    """``round(num / den, scale)`` for whole numbers, exact, ties away from zero.

    Works on integers throughout: a decimal quotient would be rounded twice.
    NULL when either side is NULL; a zero divisor raises, as division does.
    """
    n = num.cast("decimal(28,0)") * F.lit(10**scale)
    d = den.cast("decimal(28,0)")
    twice = (F.abs(n) * 2 + F.abs(d)).cast("decimal(38,0)")
    whole = F.call_function("div", twice, (F.abs(d) * 2).cast("decimal(38,0)"))
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    step = F.lit(10**scale).cast("decimal(10,0)")
    return ((whole * sign).cast("decimal(28,0)") / step).cast(f"decimal(28,{scale})")


def live_at(as_of: datetime, start: str = "valid_from", end: str = "valid_to") -> Column:
    """Rows whose validity span holds ``as_of``, both ends included."""
    now = moment(as_of)
    return (F.col(start) <= now) & (F.col(end) >= now)
