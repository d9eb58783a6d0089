from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import columns, weeks
from shelfcast.params import Params


def values(spark, schema, rows, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


def test_markets(spark):
    rows = [("Pan-EU",), ("DE",), ("GB",), ("North America",), ("US",), (None,)]
    market = F.col("m")
    assert values(spark, "m string", rows, columns.normalize_market(market)) == [
        "EU", "EU", "UK", "US", "US", None,
    ]
    assert values(spark, "m string", rows, columns.normalize_market(market, columns.PAN_EU)) == [
        "EU", "DE", "GB", "North America", "US", None,
    ]


@pytest.mark.parametrize(
    "blank, expected",
    [
        ("trim", ["LUS", "sUS", "sUS", "sUS", None]),
        ("empty", ["LUS", "sUS", "sUS", "  US", None]),
        ("null", ["LUS", "sUS", "US", "  US", None]),
    ],
)
def test_refs(spark, blank, expected):
    rows = [("L", "US"), (None, "US"), ("", "US"), ("  ", "US"), ("L", None)]
    ref = columns.ref_of(columns.item_of(F.col("l"), F.lit("s"), blank), F.col("m"))
    assert values(spark, "l string, m string", rows, ref) == expected


def test_refs_come_apart_again(spark):
    rows = [("L1", "US"), ("", "EU"), ("L2", "")]
    ref, chars = columns.ref_of(F.col("i"), F.col("m")), F.length("m")
    parts = F.struct(columns.ref_item(ref, chars), columns.ref_market(ref, chars))
    assert [tuple(r) for r in values(spark, "i string, m string", rows, parts)] == rows


def test_stock_without_listing_is_kept_under_its_market(spark):
    rows = [("L",), (None,), (" ",)]
    ref = columns.ref_of(columns.stock_item(F.col("l")), F.lit("EU"))
    assert values(spark, "l string", rows, ref) == ["LEU", "EU", "EU"]


def test_numbers(spark):
    rows = [("1.5",), ("x",), (None,)]
    assert values(spark, "t string", rows, columns.clean_numeric(F.col("t"), -1)) == [1.5, -1.0, -1.0]
    rows = [(6.0, 3.0), (1.0, 0.0), (1.0, None)]
    divided = columns.safe_divide(F.col("a"), F.col("b"), 9)
    assert values(spark, "a double, b double", rows, divided) == [2.0, 9.0, 9.0]
    rows = [(1234567.5,), (2.5,), (-1000.0,)]
    assert values(spark, "a double", rows, columns.format_number(F.col("a"))) == ["1,234,568", "2", "-1,000"]
    rows = [(-1.0,), (2.0,), (None,)]
    assert values(spark, "a double", rows, columns.floor_at_zero(F.col("a"))) == [0.0, 2.0, None]


def test_german_dates(spark):
    rows = [("05.01.2000",), ("5.1.2000",), ("31.2.2000",), ("2000-01-05",), ("",), ("05.01.2000 10:00",), ("5.1.20",), (None,)]
    assert values(spark, "t string", rows, columns.german_date(F.col("t"))) == [
        date(2000, 1, 5), date(2000, 1, 5), None, None, None, None, None, None,
    ]


@pytest.mark.parametrize(
    "weight, height, length, width, tier",
    [
        (0.45, 5.08, 33.02, 27.94, "Standard"),
        (0.46, 5.08, 33.02, 27.94, "Standard"),
        (9.07, 20.0, 45.72, 30.0, "Standard"),
        (9.08, 20.0, 45.72, 30.0, "Oversize"),
        (1.0, 20.0, 45.73, 30.0, "Oversize"),
        (1.0, 45.0, 45.0, 98.0, "Oversize"),
        (None, 1.0, 1.0, 1.0, "Oversize"),
        (0.1, None, 10.0, 10.0, "Oversize"),
        (70.0, 1.0, 1.0, 1.0, "Oversize"),
    ],
)
def test_size_tier(spark, weight, height, length, width, tier):
    got = columns.size_tier(*[F.col(c) for c in "whld"])
    schema = "w double, h double, l double, d double"
    assert values(spark, schema, [(weight, height, length, width)], got) == [tier]


def test_received(spark):
    rows = [(None, 5, 9), ("x", 5, 9), ("x", -1, 9), ("x", None, 9), ("x", 0, 9)]
    got = columns.received_quantity(F.col("s"), F.col("r"), F.col("m"))
    assert values(spark, "s string, r int, m int", rows, got) == [0, 5, 9, 9, 0]


def test_required_columns(spark):
    df = spark.range(1)
    assert columns.missing_columns(df, ["id", "x"]) == ["x"]
    with pytest.raises(ValueError, match="t: missing columns"):
        columns.check_columns(df, ["id", "x"], "t")
    assert columns.check_columns(df, ["id"]) is df


def test_labels_match_the_iso_calendar(spark):
    days = [date(1998, 12, 20) + timedelta(days=n) for n in range(0, 12000)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", weeks.week_label(F.col("d")).alias("label"), weeks.monday(F.col("d")).alias("monday")
    )
    for row in rows.collect():
        year, week, weekday = row.d.isocalendar()
        assert row.label == f"CW{week:02d}-{year}"
        assert row.monday == row.d - timedelta(days=weekday - 1)


def test_week_distance(spark):
    rows = [("CW50-1998", "CW02-1999"), ("CW02-1999", "CW50-1998"), ("", "CW02-1999"), (None, "CW01-1999")]
    distance = weeks.week_distance(F.col("a"), F.col("b"))
    assert values(spark, "a string, b string", rows, distance) == [4, -4, 0, 0]
    after = weeks.is_week_after(F.col("a"), F.col("b"))
    assert values(spark, "a string, b string", rows, after) == [False, True, False, False]
    pair = [(date(1998, 12, 28), date(1999, 1, 4))]
    assert values(spark, "a date, b date", pair, weeks.weeks_between(F.col("a"), F.col("b"))) == [1]


@pytest.mark.parametrize(
    "as_of",
    [date(1998, 3, 2), date(2026, 1, 1), date(2021, 1, 1), date(2023, 12, 31), date(2020, 12, 30)],
)
@pytest.mark.parametrize("drop", [True, False])
def test_calendar_steps_through_the_weeks(spark, as_of, drop):
    expected, day = [], as_of
    while day < date(as_of.year + 2, 12, 31):
        year, week, _ = day.isocalendar()
        if week != 53 or not drop:
            expected.append((len(expected), date.fromisocalendar(year, week, 1), f"CW{week:02d}-{year}"))
        day += timedelta(days=7)
    got = weeks.week_calendar(spark, Params(as_of, drop_week_53=drop)).orderBy("week_idx").collect()
    assert [(r.week_idx, r.week_start, r.label) for r in got] == expected
    assert 104 <= len(got) <= 157
    assert Params(as_of, horizon=5).labels == [
        r.label for r in weeks.week_calendar(spark, Params(as_of)).orderBy("week_idx").limit(5).collect()
    ]


def test_plan_window():
    params = Params(date(2024, 1, 31))
    assert (params.plan_from, params.plan_to) == (date(2023, 11, 1), date(2025, 12, 31))
    assert params.year == 2024


@pytest.mark.parametrize("bad", [{"missing_stock": "x"}, {"inbound_fallback": "x"}])
def test_unknown_parameters_fail(bad):
    with pytest.raises(ValueError):
        Params(date(2024, 1, 1), **bad)


def test_month_shares_are_days(spark):
    months = [date(y, m, 1) for y in (1998, 1999, 2000, 2024) for m in range(1, 13)]
    df = spark.createDataFrame([(m,) for m in months], "m date")
    got = {(r.m, r.week_start): r.share for r in weeks.month_weeks(df, "m").collect()}
    expected = {}
    for month in months:
        following = date(month.year + month.month // 12, month.month % 12 + 1, 1)
        n_days = (following - month).days
        for n in range(n_days):
            day = month + timedelta(days=n)
            key = (month, day - timedelta(days=day.weekday()))
            expected[key] = expected.get(key, 0) + 1
        for key in [k for k in expected if k[0] == month]:
            expected[key] = expected[key] / n_days
    assert got == expected


def test_week_quantities_round_half_to_even(spark):
    rows = [(2.5,), (3.5,), (0.5,), (-2.5,), (2.51,)]
    assert values(spark, "q double", rows, weeks.week_quantity(F.col("q"), F.lit(1.0))) == [
        2.0, 4.0, 0.0, -2.0, 3.0,
    ]
