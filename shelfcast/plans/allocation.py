"""The whole plan: from source tables to one row per ref with its shortages and recommendations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from shelfcast.params import Params
from shelfcast.plans import flows
from shelfcast.plans.extracts import Sources
from shelfcast.plans.impact import oos_labels, ref_summary, revenue_impact, run_summary
from shelfcast.plans.orders import PLANNED_LINE, Keep, staged
from shelfcast.plans.recommend import item_attributes, lead_times, recommendations
from shelfcast.plans.waterfall import by_ref, filled_weeks, filled_weeks_of, flow_rows, waterfall_of, weekly_flow

ALLOCATION = [
    "ref", "item", "market", "oos_week_first", "oos_week_last_onset", "oos_week_final",
    "horizon_end", "final_sales_price", "revenue_miss", "revenue_miss_oos", "days_of_cover",
    "demand_7w", "demand_10w", "demand_14w", "demand_18w", "to_check", "to_check_value", "expedite",
    "pull_forward", "production_days", "route_days", "buffer_days", "total_leadtime", "sku",
    "final_vendor", "shipping_region", "size_tier", "active",
]


def allocation_of(
    summary: DataFrame, sources: Sources, params: Params, also: Iterable[str] = ()
) -> DataFrame:
    """Per-ref results from per-ref totals, and the columns of the totals named in `also`.

    Prices, stock on its way and the active flag are unique per ref and join on it; product and
    vendor are joined per item, after the weeks are gone.
    """
    refs = revenue_impact(summary, flows.price_per_ref(sources, params), params)
    refs = refs.join(flows.active_flag(sources, params), "ref", "left")
    if "pipeline_stock" in sources:
        refs = refs.join(sources["pipeline_stock"].drop("market"), "ref", "left")
    refs = recommendations(oos_labels(refs), params.carton_default)
    refs = refs.join(item_attributes(sources, params), "item", "left")
    routes = sources["route_leadtime"] if "route_leadtime" in sources else None
    buffers = sources["port_buffer"] if "port_buffer" in sources else None
    return lead_times(refs, params, routes, buffers).select(*ALLOCATION, *[f"`{name}`" for name in also])


def allocation(
    sources: Sources, params: Params, keep: Keep | None = None, keep_rows: Keep | None = None
) -> DataFrame:
    """The allocation as one lazy plan; with `keep`, as two, parted at the written weekly flows.

    The driver holds what a plan broadcasts, and all its stages, until that plan ends: with little memory
    it carries the two plans where it does not carry the one. With `keep_rows` too, what is added up to the
    weekly flows is written by plans of its own, so that the disk holds the shuffle files of one at a time.
    """
    if keep is None:
        return allocation_of(ref_summary(filled_weeks(sources, params), params), sources, params)
    weekly = keep(weekly_flow(flow_rows(sources, params, keep_rows), params), "weekly_flow")
    return allocation_of(ref_summary(filled_weeks_of(by_ref(weekly), params), params), sources, params)


def staged_allocation(sources: Sources, params: Params, keep: Keep) -> DataFrame:
    """The allocation from written newest orders and weekly flows, each read back by what follows.

    Of an order line it keeps what the flows look at, which is half of its columns.
    """
    sources = staged(sources, params, keep, PLANNED_LINE, keep)
    weekly = keep(weekly_flow(flow_rows(sources, params), params), "weekly_flow")
    return allocation_of(ref_summary(filled_weeks_of(by_ref(weekly), params), params), sources, params)


def plan_allocation(
    sources: Sources, params: Params, weekly: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All results of a run, lazily.

    Each result computes the weekly flows anew unless they are given, e.g. read back from a table.
    """
    if weekly is None:
        weekly = weekly_flow(flow_rows(sources, params), params)
    summary = ref_summary(filled_weeks_of(weekly, params), params)
    return {
        "allocation": allocation_of(summary, sources, params),
        "sales_missed": waterfall_of(weekly, params),
        "run_summary": run_summary(summary),
    }
