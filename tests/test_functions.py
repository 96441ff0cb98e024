"""Column functions on the rows where their rules differ from the obvious."""

from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from subscope.functions import clean, dates, flags, ratios


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_keys_and_codes(table):
    df = table("s string", ("  A b ",), ("   ",), ("",), (None,), ("\tx",))
    assert column(df, clean.text("s")) == ["A b", "", "", None, "\tx"]
    assert column(df, clean.code("s")) == ["a b", "", "", None, "\tx"]
    assert column(df, clean.key("s")) == ["A b", None, None, None, "\tx"]
    assert column(df, clean.code_or("s", "unknown")) == ["a b", "", "", "unknown", "\tx"]


def test_business_key_skips_nulls_and_is_blank_without_parts(table):
    df = table("a string, b string", ("x ", "y"), ("x", None), (None, None))
    assert column(df, clean.business_key("a", "b")) == ["x|y", "x", ""]


def test_surrogate_and_entity_key(table):
    df = table("id string, m date", ("p1", date(2024, 3, 1)), (None, date(2024, 3, 1)))
    expected = hashlib.md5(b"crmp1").hexdigest()
    assert column(df, clean.surrogate_key("crm", F.col("id"))) == [expected, None]
    assert column(df, clean.entity_key("id", "m")) == ["p1-2024-03-01", None]


def test_money_and_whole(table):
    df = table("d double, s string", (12.345678, " 12 "), (None, "x"))
    assert column(df, clean.money("d")) == [Decimal("12.3457"), None]
    assert column(df, clean.whole("s")) == [12, None]


def test_status_flags_keep_null(table):
    df = table("s string", (" Paid",), ("failed",), (None,), ("",))
    assert column(df, flags.status_flag("s", "paid")) == [True, False, None, False]
    assert column(df, flags.status_flag("s", "paid", "failed")) == [True, True, None, False]
    assert column(df, flags.status_flag("s", "paid", "failed", negate=True)) == [
        False, False, None, True,
    ]


def test_ilike_is_whole_value_unless_wildcards(table):
    df = table("s string", (" YES ",), ("yes!",), ("x FnF y",), (None,))
    assert column(df, flags.ilike_flag("s", "yes")) == [True, False, False, None]
    assert column(df, flags.ilike_flag("s", "%fnf%")) == [False, False, True, None]


@pytest.mark.parametrize("a, b, both", [
    (True, True, True), (True, None, False), (None, None, False), (False, True, False),
])
def test_all_flags_never_null(table, a, b, both):
    df = table("a boolean, b boolean", (a, b))
    assert column(df, flags.all_flags("a", "b")) == [both]


def test_indicator_over_limit_and_differs(table):
    df = table("u int, l int", (5, 4), (4, 4), (1, 0), (1, None), (None, None))
    assert column(df, flags.over_limit_flag("u", "l")) == [True, False, False, None, None]
    assert column(df, flags.differs("u", "l")) == [True, False, True, True, False]
    assert column(df, flags.indicator(F.col("u") > 4)) == [1, 0, 0, 0, 0]


def test_segment_takes_the_first_true_branch(table):
    df = table("a boolean, b boolean", (True, True), (None, True), (None, None))
    got = column(df, flags.segment([(F.col("a"), "a"), (F.col("b"), "b")], "none"))
    assert got == ["a", "b", "none"]


def test_month_series_bounds(table):
    df = table(
        "a date, b date",
        (date(2024, 1, 31), date(2024, 3, 1)), (date(2024, 2, 1), date(2024, 2, 29)),
        (date(2024, 3, 1), date(2024, 2, 1)), (None, date(2024, 2, 1)),
    )
    got = column(df, F.size(F.coalesce(dates.month_series(F.col("a"), F.col("b")), F.array())))
    assert got == [3, 1, 0, 0]
    assert df.select(F.explode(dates.month_series(F.col("a"), F.col("b")))).count() == 4


@pytest.mark.parametrize("year, month, expired", [
    (2024, 4, True), (2024, 5, False), (2024, 6, False), (2023, 12, True), (2024, 13, None),
    (2020, 0, None), (None, 5, False), (2020, None, False),
])
def test_card_expiry_around_the_current_month(table, year, month, expired):
    df = table("y int, m int", (year, month))
    as_of = F.lit(date(2024, 5, 20))
    assert column(df, dates.expired_before("y", "m", as_of)) == [expired]


def test_calendar_columns_and_hierarchy(table):
    df = table("d date", (date(2024, 3, 31),), (date(2024, 4, 1),))
    cols = dates.calendar_columns(F.col("d"))
    assert column(df, cols["day_of_week"]) == [0, 1]
    assert column(df, cols["is_weekend"]) == [True, False]
    assert column(df, cols["year_quarter"]) == ["2024-Q1", "2024-Q2"]
    levels = dates.hierarchy_columns(F.col("d"))
    assert column(df, levels["quarter"]) == ["Qtr 1", "Qtr 2"]
    assert column(df, levels["quarter_no"]) == [1, 2]
    assert column(df, levels["month"]) == ["March", "April"]


def test_whole_days_counts_boundaries(table):
    df = table("a timestamp, b timestamp",
               (datetime(2024, 1, 1, 23), datetime(2024, 1, 2, 1)),
               (datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 23)))
    assert column(df, dates.whole_days("a", "b")) == [1, 0]


def test_rates_round_half_up_and_guard_zero(table):
    df = table("a bigint, b bigint", (1, 32), (1, 3), (1, 0), (0, 5))
    assert column(df, ratios.rate("a", "b")) == [
        Decimal("0.0313"), Decimal("0.3333"), None, Decimal("0.0000"),
    ]
    assert column(df, ratios.ratio_or_zero("a", "b"))[2] == 0.0
    assert column(df, ratios.utilization("a", F.col("b") - 5))[3] is None


def test_plain_casts_still_raise(table):
    """ANSI stays on: only the guarded functions swallow bad input."""
    with pytest.raises(PySparkException):
        table("s string", ("x",)).select(F.col("s").cast("int")).collect()
