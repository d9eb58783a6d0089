"""Weekly flows per ref: demand, opening stock, purchase orders and inbound shipments.

Each `*_contributions` function returns plain rows (ref, market_chars, week_start, quantity) that are
not yet added up: the waterfall adds all flows up at once, so that they are shuffled once. The number
of characters of the market is enough to tell item and market of a ref apart again; unlike their
texts, it can be aggregated by hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.columns import (
    PAN_EU,
    col_or,
    item_of,
    normalize_market,
    ref_of,
    stock_item,
)
from shelfcast.functions.weeks import monday, month_weeks, week_calendar, week_label, week_quantity
from shelfcast.operators.joins import lookup_buffer, lookup_route
from shelfcast.operators.latest import latest_row
from shelfcast.session import spread_partitions
from shelfcast.params import Params
from shelfcast.plans import extracts
from shelfcast.plans.extracts import Sources
from shelfcast.sources import dimensions

CONTRIBUTION = ["ref", "market_chars", "week_start", "quantity"]

# Where a purchase order line does not say, and days added to a shipment's dates.
DEFAULT_REGION, DEFAULT_MARKET, DEFAULT_WH_TYPE = "CN", "US", "3PL"
PICKUP_DAYS = 12
UNDATED_DAYS = 55
OVERDUE_DAYS = 7


def add_up(contributions: DataFrame) -> DataFrame:
    """Total per ref and week; rows without a ref or a week cannot be planned."""
    return (
        contributions.filter("ref IS NOT NULL AND week_start IS NOT NULL")
        .groupBy("ref", "week_start")
        .agg(F.sum("quantity").alias("quantity"))
    )


def spread_months(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Weeks of monthly quantities. What falls on one date is added up before it is rounded.

    A row becomes five or six in its task, so the totals are dealt to many partitions first;
    those that the totals arrive in are joined to fewer by their size before they grow.
    """
    totals = monthly.groupBy(*keys, "date").agg(F.sum("quantity").alias("quantity"))
    totals = totals.repartition(spread_partitions(totals), *keys)
    return month_weeks(totals, "date").withColumn(
        "quantity", week_quantity(F.col("quantity"), F.col("share"))
    )


def demand_contributions(sources: Sources, params: Params) -> DataFrame:
    item = item_of(F.col("listing_id"), F.col("sku"), "empty")
    # The plan's own totals per sku are left out: one sum per ref and date covers them.
    plan = extracts.valid_plan(sources, params).select(
        ref_of(item, F.col("market")).alias("ref"), F.length("market").alias("market_chars"),
        "date", "quantity",
    )
    return spread_months(plan, ["ref", "market_chars"]).select(*CONTRIBUTION)


def weekly_demand(sources: Sources, params: Params) -> DataFrame:
    """Demand per ref and planning week."""
    demand = add_up(demand_contributions(sources, params))
    calendar = week_calendar(demand.sparkSession, params).select("week_idx", "week_start", "label")
    # The calendar has at most 157 rows.
    return demand.join(F.broadcast(calendar), "week_start").select(
        "ref", "week_idx", "week_start", "label", F.col("quantity").alias("demand")
    )


def opening_contributions(sources: Sources, params: Params) -> DataFrame:
    """Stock that can be sold, by ref and what the stock totals tell apart besides."""
    item = stock_item(F.col("listing_id"))
    market = normalize_market(F.col("market"), params.market_map(PAN_EU))
    total = F.col("total_inventory")
    if params.double_deduct:
        for location in ("in_walmart", "in_to_osc_l3m", "in_fm", "units_in_d2amz"):
            total = total - F.coalesce(location, F.lit(0))
    stock = extracts.stock_totals(sources, params).select(
        ref_of(item, market).alias("ref"), item.alias("item"), market.alias("market"),
        total.alias("total_inventory"),
    )
    return stock.filter("ref IS NOT NULL")


def opening_stock(sources: Sources, params: Params) -> DataFrame:
    """Stock per ref that can be sold."""
    return (
        opening_contributions(sources, params)
        .groupBy("ref", "item", "market")
        .agg(F.sum("total_inventory").alias("total_inventory"))
    )


def _master_listing(sources: Sources, params: Params) -> DataFrame:
    """Listing of each sku in the product master."""
    if params.fan_out_master:
        return dedupe_master(sources, params).select("sku", F.col("listing_id").alias("master_listing"))
    newest = extracts.latest_products(sources)
    return newest.groupBy("sku").agg(F.min("listing_id").alias("master_listing"))


def vendor_regions(sources: Sources, params: Params) -> DataFrame:
    """Shipping region of each vendor by its country."""
    regions = dimensions.table("country_region", sources)
    return extracts.vendor_latest(sources, params).join(
        regions.select(F.col("country").alias("shipping_country"), F.col("region").alias("shipping_region")),
        "shipping_country",
        "left",
    )


# What the flows need of an open PO line; the report has four times as many columns.
OPEN_ORDER = [
    "document_number", "line_id", "sku", "listing_id", "market", "vendor", "wh_type", "crd", "leftover_quantity",
]


def open_po_with_origin(sources: Sources, params: Params) -> DataFrame:
    """Open PO lines with the stage text of the status feed and the vendor's shipping region."""
    lines = sources["open_orders"] if "open_orders" in sources else extracts.open_orders(sources, params)
    if "current_status" not in lines.columns:
        status = extracts.newest_status(sources, params)
        lines = lines.select(*OPEN_ORDER).join(status, ["document_number", "line_id"], "left")
    regions = vendor_regions(sources, params).select(
        F.col("vendor_id").alias("vendor"), "shipping_region"
    )
    return lines.select(*OPEN_ORDER, "current_status").join(regions, "vendor", "left")


def po_expected_dates(
    lines: DataFrame, params: Params, routes: DataFrame | None = None,
    buffers: DataFrame | None = None, strict: bool = False,
) -> DataFrame:
    """Adds route and buffer days and the expected delivery of open PO lines.

    Goods not ready yet, or ready at an unknown date, leave on `as_of`. With `strict`, unknown
    dates stay unknown, and an unknown region, market or warehouse type takes the default days.
    """
    spark = lines.sparkSession
    routes = dimensions.route_leadtime(spark, params.po_routes) if routes is None else routes
    if buffers is None:
        known = dimensions.PO_BUFFERS if params.po_routes == "po" else None
        buffers = dimensions.port_buffer(spark, known)
    region, market, wh_type = F.col("shipping_region"), F.col("market"), F.col("wh_type")
    ready = F.greatest(F.col("crd"), F.lit(params.as_of))
    if strict:
        ready = F.when(F.col("crd").isNotNull(), ready)
    else:
        region = F.coalesce(region, F.lit(DEFAULT_REGION))
        market = F.coalesce(market, F.lit(DEFAULT_MARKET))
        wh_type = F.coalesce(wh_type, F.lit(DEFAULT_WH_TYPE))
    dated = lookup_route(lines, routes, region, market, params.po_route_default)
    dated = lookup_buffer(dated, buffers, wh_type, market, F.lit(params.po_buffer_default))
    delivery = F.date_add(ready, F.col("route_days") + F.col("buffer_days"))
    return dated.withColumn("expected_delivery_date", delivery).withColumn(
        "cw", week_label(F.col("expected_delivery_date"))
    )


def classified_po_lines(
    sources: Sources, params: Params, strict: bool = False, every: bool = False
) -> DataFrame:
    """Open PO lines in a signed or unsigned stage, with ref and expected delivery.

    With `every`, lines in other stages stay, once each and without a class.
    """
    lines = open_po_with_origin(sources, params)
    stages = dimensions.table("stage_class", sources)
    in_stage = F.col("current_status") == F.col("stage")
    lines = lines.join(stages, in_stage, "left" if every else "inner").drop("stage")
    listings = _master_listing(sources, params).withColumnRenamed("sku", "master_sku")
    listed = (F.col("sku") == F.col("master_sku")) & F.col("klass").isNotNull()
    lines = lines.join(listings, listed, "left").drop("master_sku")
    item = F.coalesce("listing_id", "master_listing", "sku")
    lines = lines.withColumn("ref", ref_of(item, F.col("market")))
    routes = sources["route_leadtime"] if "route_leadtime" in sources else None
    buffers = sources["port_buffer"] if "port_buffer" in sources else None
    return po_expected_dates(lines, params, routes, buffers, strict)


def po_contributions(sources: Sources, params: Params, every: bool = False) -> DataFrame:
    """PO rows with their class; with `every`, also those without one, which have no ref."""
    lines = classified_po_lines(sources, params, every=every)
    ref = F.when(F.col("klass").isNotNull(), F.col("ref"))
    return lines.select(
        ref.alias("ref"), F.length("market").alias("market_chars"),
        monday(F.col("expected_delivery_date")).alias("week_start"),
        F.col("leftover_quantity").cast("double").alias("quantity"), "klass",
    )


def po_flow(sources: Sources, params: Params, klass: str) -> DataFrame:
    """Signed or unsigned PO units per ref and week of expected delivery."""
    return add_up(po_contributions(sources, params).filter(F.col("klass") == klass))


def inbound_expected_dates(
    lines: DataFrame, params: Params, routes: DataFrame | None = None
) -> DataFrame:
    """Adds route and buffer days and the final expected delivery of inbound lines.

    The first known date counts: expected delivery, arrival, pick-up, cargo ready. What should have
    arrived by `as_of` is expected a week later.
    """
    if routes is None:
        routes = dimensions.route_leadtime(lines.sparkSession, params.inbound_routes)
    origin = col_or(lines, "shipping_region", None).cast("string")
    departure = col_or(lines, "shipping_region", DEFAULT_REGION)
    dated = lookup_route(lines, routes, departure, F.col("market"), params.inbound_route_default)
    buffer = F.when(F.col("market") == origin, F.lit(0)).otherwise(
        dimensions.market_buffer(F.col("market"))
    )
    dated = dated.withColumn("buffer_days", buffer)
    undated = F.date_add(F.lit(params.as_of), UNDATED_DAYS)
    known = [F.col("expected_delivery_date")]
    if params.inbound_fallback == "row":
        route, days = F.col("route_days"), F.col("buffer_days")
        known += [
            F.date_add("actual_arrival_date", days),
            F.date_add("movement_date", days + route),
            F.date_add("final_crd", days + route + PICKUP_DAYS),
        ]
    expected = F.coalesce(*known, undated)
    overdue = F.date_add(F.lit(params.as_of), OVERDUE_DAYS)
    final = F.when(expected <= F.lit(params.as_of), overdue).otherwise(expected)
    return dated.withColumn("expected_delivery_date_final", final).withColumn("cw", week_label(final))


def inbound_contributions(sources: Sources, params: Params) -> DataFrame:
    routes = sources["route_leadtime"] if "route_leadtime" in sources else None
    lines = inbound_expected_dates(extracts.inbound_lines(sources, params), params, routes)
    item = item_of(F.col("listing_id"), F.col("sku"), "trim")
    return lines.select(
        ref_of(item, F.col("market")).alias("ref"), F.length("market").alias("market_chars"),
        monday(F.col("expected_delivery_date_final")).alias("week_start"),
        F.col("quantity").cast("double").alias("quantity"),
    )


def inbound_flow(sources: Sources, params: Params) -> DataFrame:
    """Inbound units per ref and week of expected delivery."""
    return add_up(inbound_contributions(sources, params))


def dedupe_master(sources: Sources, params: Params) -> DataFrame:
    """Product master with one row per sku, listing and size tier, and the id it is listed under."""
    master = extracts.product_master_latest(sources, params)
    rest = [c for c in master.columns if c not in ("sku", "listing_id", "size_tier")]
    kept = latest_row(
        master, ["sku", "listing_id", "size_tier"], [F.asc_nulls_last(column) for column in rest]
    )
    return kept.withColumn("item", item_of(F.col("listing_id"), F.col("sku"), "empty"))


def dedupe_vendor(sources: Sources, params: Params) -> DataFrame:
    """One row per vendor of the raw vendor table, which may hold a vendor in several snapshots."""
    vendors = sources["vendor_master"]
    rest = [F.asc_nulls_last(column) for column in vendors.columns if column != "vendor_id"]
    return latest_row(vendors, ["vendor_id"], rest)


def active_flag(sources: Sources, params: Params) -> DataFrame:
    """Refs of active products, marked Yes."""
    market = normalize_market(F.col("marketplace"), params.market_map(PAN_EU))
    refs = extracts.active_products(sources, params).select(
        ref_of(F.col("listing_id"), market).alias("ref")
    )
    return refs.filter("ref IS NOT NULL").distinct().withColumn("active", F.lit("Yes"))


def price_per_ref(sources: Sources, params: Params) -> DataFrame:
    """One price per ref: the newest, then the largest."""
    prices = extracts.dated_target_price(sources, params).filter("ref IS NOT NULL")
    order = [F.desc_nulls_last("date"), F.desc_nulls_last("final_sales_price")]
    return latest_row(prices, ["ref"], order).drop("date")
