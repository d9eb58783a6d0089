"""ISO weeks as columns: Mondays, labels such as CW07-2026, and the spread of a month over its weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.params import Params


def monday(day: Column) -> Column:
    return F.trunc(day, "week")


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def week_label(day: Column) -> Column:
    week = F.lpad(iso_week(day).cast("string"), 2, "0")
    return F.concat(F.lit("CW"), week, F.lit("-"), iso_year(day).cast("string"))


def label_week(label: Column) -> Column:
    return F.substring(label, 3, 2).try_cast("int")


def label_year(label: Column) -> Column:
    return F.right(label, F.lit(4)).try_cast("int")


def week_distance(first: Column, second: Column) -> Column:
    """Weeks from one label to another, counting 52 weeks to the year; 0 when either is unreadable."""
    years = label_year(second) - label_year(first)
    weeks = label_week(second) - label_week(first)
    return F.coalesce(years * 52 + weeks, F.lit(0))


def is_week_after(first: Column, second: Column) -> Column:
    return week_distance(second, first) > 0


def weeks_between(first_monday: Column, second_monday: Column) -> Column:
    """True number of weeks between two Mondays, with 53-week years counted in full."""
    return (F.datediff(second_monday, first_monday) / 7).cast("int")


def week_calendar(spark: SparkSession, params: Params) -> DataFrame:
    """One row per planning week. At most 157 rows: weekly steps through less than three years."""
    steps = F.sequence(F.lit(params.as_of), F.lit(params.calendar_end), F.expr("INTERVAL 7 DAYS"))
    if params.drop_week_53:
        steps = F.filter(steps, lambda day: iso_week(day) != 53)
    day = F.col("day")
    return (
        spark.range(1)
        .select(F.posexplode(steps).alias("week_idx", "day"))
        .select(
            "week_idx",
            monday(day).alias("week_start"),
            iso_year(day).alias("iso_year"),
            iso_week(day).alias("iso_week"),
            week_label(day).alias("label"),
        )
    )


def month_weeks(df: DataFrame, day: str) -> DataFrame:
    """Repeat each row for every ISO week its month touches, with the share of the month's days.

    Pure date arithmetic on the row itself, so it needs neither a join nor a shuffle.
    """
    first, last = F.trunc(F.col(day), "month"), F.last_day(F.col(day))
    week = F.col("week_start")
    days = F.datediff(F.least(F.date_add(week, 6), last), F.greatest(week, first)) + 1
    weeks = F.sequence(monday(first), last, F.expr("INTERVAL 7 DAYS"))
    return df.withColumn("week_start", F.explode(weeks)).withColumn(
        "share", days / F.dayofmonth(last)
    )


def week_quantity(quantity: Column, share: Column) -> Column:
    """A week's part of a monthly quantity, rounded half to even to whole units."""
    return F.bround(quantity.cast("double") * share, 0)
