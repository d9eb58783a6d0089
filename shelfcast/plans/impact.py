"""What a shortage costs: lost revenue, days of cover, demand ahead, and totals of a run."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.columns import ref_item, ref_market
from shelfcast.functions.weeks import week_label
from shelfcast.params import Params
from shelfcast.plans.waterfall import with_oos_marks

# Column endings of the weekly layout.
MEASURES = {
    "demand": "demand",
    "inbound": "inbound",
    "po_signed": "open_po_signed",
    "po_unsigned": "open_po_unsigned",
    "inventory_start": "inventory_start",
    "inventory_end": "inventory_end",
    "sales_missed": "sales_missed_w",
}

# Weeks of demand ahead that the recommendations look at.
DEMAND_WEEKS = [7, 10, 14, 18]


def target_weeks(params: Params) -> Column:
    """Weeks of the target year, from the current one on if that year is running.

    Whether a week 53 counts is the calendar's decision.
    """
    first = params.as_of.isocalendar().week if params.as_of.year == params.year else 1
    return (F.col("iso_year") == params.year) & F.col("iso_week").between(first, 53)


def ref_summary(weeks: DataFrame, params: Params, measures: Iterable[str] = ()) -> DataFrame:
    """One row per ref out of its planning weeks, with a column per planned week for each of `measures`.

    The weeks arrive by ref, so neither the windows nor the totals shuffle them again. A ref has at
    most `horizon` weeks, so gathering them is bounded. Marked weeks may lack empty ones, but with `measures`
    all must be there.
    """
    missed, demand = F.col("sales_missed"), F.col("demand")
    marked = weeks if "onset" in weeks.columns else with_oos_marks(weeks)
    week = F.struct("week_idx", "iso_year", "iso_week", missed.alias("missed"), *measures)
    # The week number of the final week out of stock counts, whatever its year.
    from_final = F.filter(
        "_weeks",
        lambda w: (w.iso_year == params.year) & w.iso_week.between(F.weekofyear("oos_final"), 53),
    )
    cells = [
        F.coalesce(F.get("_weeks", F.lit(i))[name], F.lit(0.0)).alias(f"{label}_{MEASURES[name]}")
        for i, label in enumerate(params.labels if measures else [])
        for name in measures
    ]
    totals = (
        marked.groupBy("ref", "market_chars")
        .agg(
            F.min("missing_from").alias("oos_first"),
            F.max("onset").alias("oos_last_onset"),
            F.sum(demand).alias("total_demand"),
            F.coalesce(F.sum(missed), F.lit(0.0)).alias("total_missed"),
            _sum_where(target_weeks(params), missed).alias("missed_target_year"),
            *[
                _sum_where(F.col("week_idx") < n, demand).alias(f"demand_{n}w")
                for n in DEMAND_WEEKS
            ],
            F.sort_array(F.collect_list(week)).alias("_weeks"),
        )
        .withColumn("oos_final", F.coalesce("oos_last_onset", "oos_first"))
    )
    add = lambda total, w: total + F.coalesce(w.missed, F.lit(0.0))
    names = [name for name in totals.columns if name not in ("_weeks", "market_chars")]
    return totals.select(
        *names,
        F.coalesce(F.aggregate(from_final, F.lit(0.0), add), F.lit(0.0)).alias("missed_from_oos"),
        ref_item(F.col("ref"), F.col("market_chars")).alias("item"),
        ref_market(F.col("ref"), F.col("market_chars")).alias("market"),
        *cells,
    )


def _sum_where(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def days_of_cover(first: Column, horizon_end: Column, params: Params) -> Column:
    """Whole days from the moment of planning to the Monday stock runs out; the last week if never.

    The moment lies inside the planning day, so the next midnight is less than a whole day away.
    """
    return F.greatest(F.datediff(F.coalesce(first, horizon_end), F.lit(params.as_of)) - 1, F.lit(0))


def revenue_impact(summary: DataFrame, prices: DataFrame, params: Params) -> DataFrame:
    """Lost revenue of the target year per ref, all of it and from the final week out of stock."""
    horizon_end = F.lit(params.horizon_end).cast("date")
    price = F.coalesce("final_sales_price", F.lit(0.0))
    return (
        summary.join(prices, "ref", "left")
        .withColumn("final_sales_price", price)
        .withColumn("horizon_end", horizon_end)
        .withColumn("revenue_miss", F.col("missed_target_year") * F.col("final_sales_price"))
        .withColumn("revenue_miss_oos", F.col("missed_from_oos") * F.col("final_sales_price"))
        .withColumn(
            "days_of_cover", days_of_cover(F.col("oos_first"), F.col("horizon_end"), params)
        )
    )


def oos_labels(df: DataFrame) -> DataFrame:
    """Weeks out of stock as labels; a ref that never runs out carries the last calendar week."""
    first = F.coalesce("oos_first", "horizon_end")
    return df.withColumns(
        {
            "oos_week_first": week_label(first),
            "oos_week_last_onset": week_label(F.col("oos_last_onset")),
            "oos_week_final": week_label(F.coalesce("oos_last_onset", first)),
        }
    )


def run_totals() -> list[Column]:
    """Totals over per-ref results: refs planned, share of demand covered in percent, refs out of stock."""
    demand, missed = F.sum("total_demand"), F.sum("total_missed")
    covered = F.bround((demand - missed) / demand * 100, 2)
    return [
        F.count(F.lit(1)).alias("n_refs"),
        demand.alias("total_demand"),
        missed.alias("total_missed"),
        F.when(demand > 0, covered).otherwise(F.lit(100.0)).alias("demand_coverage"),
        F.count("oos_first").alias("oos_count"),
    ]


def run_summary(summary: DataFrame) -> DataFrame:
    """One row with the totals of a run."""
    return summary.agg(*run_totals())
