from datetime import datetime
from decimal import Decimal
from fractions import Fraction

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from perkwell.functions import columns as c


def one(spark, *exprs):
    return tuple(spark.range(1).select(*exprs).first())


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_null_rules_of_greatest_and_least(spark):
    null = F.lit(None).cast("int")
    assert one(spark, c.strict_greatest(F.lit(1), null), c.strict_least(F.lit(1), null)) == (None, None)
    assert one(spark, c.strict_greatest(F.lit(1), F.lit(2)), c.strict_least(F.lit(1), F.lit(2))) == (2, 1)


def test_plus_months_keeps_month_ends_and_time(spark):
    got = one(
        spark, c.plus_months(ts("2025-02-28 10:00:00"), 1), c.plus_months(ts("2024-01-31 00:00:00"), 1),
        c.plus_months(ts("2025-01-15 08:30:00"), -3), c.plus_months(ts("2024-02-28 00:00:00"), 12),
        c.plus_months(ts("2024-02-29 00:00:00"), 12), c.plus_months(ts("2025-01-30 00:00:00"), 1),
    )
    assert got == (
        datetime(2025, 3, 31, 10), datetime(2024, 2, 29), datetime(2024, 10, 15, 8, 30), datetime(2025, 2, 28),
        datetime(2025, 2, 28), datetime(2025, 2, 28),
    )


def test_days_round_down_and_up_on_both_sides_of_zero(spark):
    a, b = ts("2025-03-09 12:00:00"), ts("2025-03-10 00:00:00")
    assert one(spark, c.floor_days(b, a), c.floor_days(a, b), c.ceil_days(b, a), c.ceil_days(a, b)) == (0, -1, 1, 0)
    assert one(spark, c.floor_days(b, b), c.ceil_days(b, b)) == (0, 0)


def test_number_text(spark):
    def show(text, kind):
        return c.number_text(F.lit(text).cast(kind))

    assert one(
        spark, show("5.00", "decimal(5,2)"), show("0.50", "decimal(5,2)"), show("-0.25", "decimal(5,2)"),
        show("100", "long"), show("12.30", "decimal(5,2)"), show("0.00", "decimal(5,2)"), show(None, "long"),
    ) == ("5", ".5", "-.25", "100", "12.3", "0", None)


def test_joined_text_reads_null_as_empty(spark):
    assert one(spark, c.joined_text("a", F.lit(None).cast("string"), F.lit(3))) == ("a3",)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_half_up_ratio_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long").select(
        "n", "d", c.half_up_ratio(F.col("n"), F.col("d"), 2).alias("r")
    )
    for n, d, r in df.collect():
        scaled = abs(Fraction(n * 100, d))
        whole = int(scaled + Fraction(1, 2))
        assert r == Decimal(whole if n >= 0 else -whole) / 100
