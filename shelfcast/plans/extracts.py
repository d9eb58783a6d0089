"""The ten source queries: the state of each source that planning starts from.

Each takes the source tables by name and the run parameters, and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.columns import (
    MARKET_MAP,
    PAN_EU,
    PLAN_MARKETS,
    german_date,
    item_of,
    normalize_market,
    received_quantity,
    ref_of,
    size_tier,
    units,
)
from shelfcast.operators.joins import join_null_safe, value_counts, value_pieces
from shelfcast.operators.latest import global_latest, latest_row, latest_snapshot
from shelfcast.params import Params

Sources = Mapping[str, DataFrame]

# States and classes that take a row out of planning, or keep it in.
CLOSED_STATES = ["Closed", "Legacy Closed", "Fully Billed", "Rejected by Supervisor"]
INTERNAL_VENDORS = "Intercompany"
VALID_PLAN = "Validated_plan"
MAKERS = ["Manufacturers", "Manufacturers / LP"]


def vendor_choice(sources: Sources, params: Params) -> DataFrame:
    """Vendor per sku: the preferred one, else the first mapped one, else that of the last order."""
    mapped = latest_row(
        sources["sku_vendor_map"],
        ["sku"],
        [F.asc_nulls_last("vendor"), F.asc_nulls_last("preferred_vendor")],
    )
    if "last_orders" in sources:
        orders = sources["last_orders"]
    else:
        orders = sources["po_lines"].filter(F.col("vendor_category") != INTERNAL_VENDORS)
        orders = orders.select("sku", "ordered_at", "document_number", "line_id", F.col("vendor").alias("po_vendor"))
    ordered = latest_row(
        orders,
        ["sku"],
        [
            F.desc_nulls_first("ordered_at"),
            F.asc_nulls_last("document_number"),
            F.asc_nulls_last("line_id"),
            F.asc_nulls_last("po_vendor"),
        ],
    )
    vendor = F.coalesce(F.nullif("preferred_vendor", F.lit("")), "vendor", "po_vendor")
    return mapped.join(ordered.select("sku", "po_vendor"), "sku", "left").select(
        "sku", vendor.alias("final_vendor")
    )


def sku_vendor(sources: Sources, params: Params) -> DataFrame:
    """Vendor and newest listing per sku."""
    master = latest_row(
        sources["product_master"].select("sku", "listing_id", "snapshot_date"),
        ["sku"],
        [F.desc_nulls_first("snapshot_date"), F.asc_nulls_last("listing_id")],
    )
    return (
        vendor_choice(sources, params)
        .join(master.select("sku", "listing_id"), "sku", "left")
        .select("sku", "listing_id", "final_vendor")
    )


def valid_plan(sources: Sources, params: Params) -> DataFrame:
    """Rows of the newest validated plan, from two months back to the end of next year."""
    valid = sources["sales_plan"].filter(F.col("review_cycle_version") == VALID_PLAN)
    return (
        global_latest(valid, valid)
        .filter((F.col("sku") != "") & F.col("date").between(params.plan_from, params.plan_to))
        .withColumn("market", normalize_market(F.col("market"), params.market_map(PLAN_MARKETS)))
        .select("market", "sku", "listing_id", "date", "quantity")
    )


def demand_plan(sources: Sources, params: Params) -> DataFrame:
    """Monthly plan by market, sku and listing."""
    return (
        valid_plan(sources, params)
        .groupBy("market", "sku", "listing_id", "date")
        .agg(F.sum("quantity").alias("quantity"))
    )


def active_products(sources: Sources, params: Params) -> DataFrame:
    return (
        sources["product_catalog"]
        .filter("go_forward = 1")
        .select("listing_id", "country_code", "brand_name", "sku", "marketplace", "portfolio_cluster")
        .distinct()
    )


def _plannable_po_lines(sources: Sources) -> DataFrame:
    """Latest snapshot of each document, without closed, internal, B2B and web shop lines."""
    memo = F.coalesce("memo", F.lit("A"))
    if "order_lines" in sources:
        lines = sources["order_lines"].filter("of_document")
    else:
        lines = latest_snapshot(sources["po_lines"], ["document_number"])
    return lines.filter(
        ~F.col("final_status").isin(CLOSED_STATES)
        & (F.col("vendor_category") != INTERNAL_VENDORS)
        & ~memo.contains("B2B")
        & ~memo.contains("SHOPIFY")
    )


def newest_shipments(sources: Sources) -> DataFrame:
    """Latest snapshot of each shipment's header."""
    if "newest_shipments" in sources:
        return sources["newest_shipments"]
    return latest_snapshot(sources["shipment_headers"], ["shipment_number"])


def inbound_lines(sources: Sources, params: Params) -> DataFrame:
    """Shipment lines still to arrive for purchase order lines."""
    site = F.substring(F.split_part("deliver_to_location", F.lit("_"), F.lit(2)), 1, 2)
    on_shipments = F.coalesce(F.col("quantity_on_shipments").cast("long"), F.lit(0))
    orders = (
        _plannable_po_lines(sources)
        .filter("quantity > 0")
        .withColumn("order_market", F.coalesce("market_alt", site))
        .withColumn("leftover", F.col("quantity") - on_shipments)
        .select(
            "document_number", "line_id", "batch_id", "po_line_key", "brand", "order_market",
            "vendor", "memo", "final_status", "ordered_at", "confirmed_crd", "sku", "listing_id",
            "deliver_to_location", "transport_mode", "transport_type", "quantity", "qty_received",
            "quantity_on_shipments", "leftover",
        )
        .distinct()
        .withColumnRenamed("quantity", "ordered")
    )
    headers = newest_shipments(sources)
    lines = (
        sources["shipment_lines"]
        .filter("quantity_expected > 0")
        .withColumnsRenamed({"po": "document_number", "vendor": "line_vendor"})
    )
    market = normalize_market(F.coalesce("market_place", "order_market"), params.market_map(MARKET_MAP))
    received = received_quantity(
        F.col("substatus"), F.col("quantity_received"), F.col("quantity_remaining_to_be_received")
    )
    remaining = F.col("quantity_remaining_to_be_received") - received
    open_units = F.greatest(F.coalesce(remaining, F.col("leftover")), F.lit(0))
    amazon = F.col("receiving_warehouse_type").contains("Amazon")
    return (
        orders.join(lines, ["document_number", "sku", "po_line_key"])
        .join(headers, "shipment_number")
        .select(
            ref_of(F.col("sku"), market).alias("ref"),
            F.col("document_number").alias("po_number"),
            F.col("line_id").alias("po_line_id"),
            F.col("shipment_number").alias("inb_number"),
            "batch_id",
            german_date(F.col("date_created")).alias("date_created"),
            F.col("po_line_key").alias("po_key"),
            F.col("brand").alias("brand_name"),
            market.alias("market"),
            F.col("vendor").alias("vendor_name"),
            F.coalesce("memo", F.lit("")).alias("memo"),
            F.col("transport_mode").alias("shipment_method"),
            F.when(amazon, "AMZ").otherwise("3PL").alias("receiving_warehouse_type"),
            "receiving_location",
            "status",
            F.col("substatus").alias("sub_status"),
            F.col("cargo_ready_date").alias("final_crd"),
            F.col("actual_cargo_pick_up_date").alias("movement_date"),
            "expected_delivery_date",
            "actual_arrival_date",
            "sku",
            "listing_id",
            "quantity_expected",
            F.coalesce(received, F.lit(0)).alias("quantity_received"),
            open_units.alias("quantity"),
        )
    )


STOCK_KEYS = ["listing_id", "market", "brand_name"]

# Columns of the stock report that hold the largest figure of the group.
STOCK_LOCATIONS = [
    "in_fm", "in_to_w2w", "in_nn3pl", "in_n3pl", "in_lm", "in_amz", "units_in_d2amz", "in_wq",
    "in_rsd_fc_proc", "in_rsvd_cust_ord", "in_walmart", "in_bol", "in_meli", "in_to_osc_l3m",
    "units_open_pos_raw",
]


def _latest_stock(sources: Sources) -> DataFrame:
    """Rows of the newest snapshot of the whole table; a rank by date within it is always 1."""
    stock = sources["stock_snapshots"]
    return (
        global_latest(stock, stock)
        .withColumn("listing_id", F.coalesce("listing_id", "sku"))
        .withColumn("total_inventory", F.coalesce("total_inventory", F.lit(0)))
        .filter("total_inventory + units_open_pos_raw > 0 AND sku IS NOT NULL")
    )


def stock_totals(sources: Sources, params: Params) -> DataFrame:
    """Stock by listing, raw market and brand, net of stock that cannot be sold.

    A location without any figure in the group leaves the net stock unknown.
    """
    total = F.sum("total_inventory")
    reachable = total - F.max("in_walmart") - F.max("in_to_osc_l3m")
    return (
        _latest_stock(sources)
        .groupBy(*STOCK_KEYS)
        .agg(
            *[F.max(name).alias(name) for name in STOCK_LOCATIONS],
            reachable.alias("total_e2e_inventory"),
            (reachable - F.max("in_fm") - F.max("units_in_d2amz")).alias("total_inventory"),
        )
    )


def stock_position(sources: Sources, params: Params) -> DataFrame:
    """Stock totals under their planning market; `stock_members` has the skus behind each."""
    market = normalize_market(F.col("market"), params.market_map(PAN_EU))
    return stock_totals(sources, params).withColumn("market", market)


def stock_members(sources: Sources, params: Params) -> DataFrame:
    """The skus behind each stock total as rows, with their number of stock rows."""
    return value_counts(_latest_stock(sources), STOCK_KEYS, "sku")


def stock_sku_list(sources: Sources, params: Params) -> DataFrame:
    """The ordered sku list behind each stock total, in pieces of text."""
    return value_pieces(_latest_stock(sources), STOCK_KEYS, "sku", "sku_list")


def latest_products(sources: Sources) -> DataFrame:
    """Newest snapshot of each product without a successor."""
    products = sources["product_master"].filter(F.coalesce("successor_sku", F.lit("")) == "")
    return latest_snapshot(products, ["sku"])


def product_master_latest(sources: Sources, params: Params) -> DataFrame:
    """Newest attributes of products without a successor; several rows where a snapshot has them."""
    tier = size_tier(*[F.col(name) for name in ("ship_weight", "dim_h_cm", "dim_l_cm", "dim_w_cm")])
    # ship_weight is left out only after the distinct: rows that differ in it alone are both kept.
    return (
        latest_products(sources)
        .select(
            "sku",
            "listing_id",
            F.coalesce("lead_time_production_days", F.lit(params.production_default)).alias(
                "lead_time_production_days"
            ),
            "units_per_carton",
            "preferred_vendor",
            "carton_weight_kg",
            "carton_volume",
            tier.alias("size_tier"),
            "dim_h_cm",
            "dim_l_cm",
            "dim_w_cm",
            "ship_weight",
        )
        .distinct()
        .drop("ship_weight")
    )


def with_shipped_units(orders: DataFrame, sources: Sources, params: Params) -> DataFrame:
    """Adds `shipped`, the units expected on shipments of each purchase order line; NULL for none."""
    keys = ["document_number", "sku", "po_line_key"]
    lines = sources["shipment_lines"].withColumnRenamed("po", "document_number")
    if params.raw_join:
        headers = sources["shipment_headers"].select("shipment_number")
        shipped = lines.join(headers, "shipment_number").select(*keys, F.col("quantity_expected").alias("shipped"))
    else:
        # A shipment with a header has a newest one. Lines that expect nothing add nothing, and stay behind.
        headers = sources.get("newest_shipments", sources["shipment_headers"]).select("shipment_number")
        expecting = lines.filter("quantity_expected <> 0")
        shipped = expecting.join(headers, "shipment_number", "left_semi").groupBy(*keys)
        shipped = shipped.agg(F.sum("quantity_expected").alias("shipped"))
    return orders.join(shipped, keys, "left")


def newest_status(sources: Sources, params: Params) -> DataFrame:
    """One stage text per purchase order line of the status feed."""
    order = [F.asc_nulls_last("current_status")]
    status = latest_row(po_status(sources, params), ["document_number", "line_id"], order)
    return status.select("document_number", "line_id", "current_status")


def open_orders(sources: Sources, params: Params) -> DataFrame:
    """Purchase order lines with `leftover_quantity` not yet received or on a shipment, and all their columns."""
    if "order_lines" in sources:
        lines = sources["order_lines"]
    else:
        lines = latest_snapshot(sources["po_lines"], ["document_number", "line_id"])
    lines = lines.filter(
        ~F.col("final_status").isin(CLOSED_STATES)
        & (F.col("quantity") > 0)
        & (F.col("vendor_category") != INTERNAL_VENDORS)
        & F.expr("production_status <> 'Shipped' OR production_status IS NULL")
    )
    if "shipped" not in lines.columns:
        lines = with_shipped_units(lines, sources, params)
    received, on_shipment = units(F.col("qty_received")), units(F.col("quantity_on_shipments"))
    covered = F.greatest(received, on_shipment, F.coalesce("shipped", F.lit(0)))
    return lines.withColumns(
        {
            "market": normalize_market(F.col("market"), params.market_map(PAN_EU)),
            "received": received,
            "on_shipment": on_shipment,
            "leftover_quantity": F.col("quantity") - covered,
            "crd": F.col("confirmed_crd").try_cast("date"),
        }
    ).filter("leftover_quantity > 0")


def open_po_lines(sources: Sources, params: Params) -> DataFrame:
    """Purchase order lines with units not yet received or on a shipment."""
    market = F.col("market")
    return (
        open_orders(sources, params)
        .select(
            ref_of(item_of(F.col("listing_id"), F.col("sku"), "null"), market).alias("ref"),
            "id",
            "document_number",
            "line_id",
            "sku",
            "listing_id",
            F.col("brand").alias("brand_name"),
            "market",
            "prd_reconfirmation",
            F.col("vendor").alias("vendor_name"),
            F.coalesce("memo", F.lit("")).alias("memo"),
            "final_status",
            F.col("ordered_at").try_cast("date").alias("order_date"),
            german_date(F.col("first_prd")).alias("first_prd"),
            F.col("prd").try_cast("date").alias("prd"),
            F.col("planned_prd").try_cast("date").alias("planned_prd"),
            german_date(F.col("accepted_prd")).alias("accepted_prd"),
            "prd_status",
            german_date(F.col("expected_po_arrival_date")).alias("expected_po_arrival_date"),
            german_date(F.col("planned_pickup_date")).alias("planned_pickup_date"),
            "prd_change_reason",
            "crd",
            "item_rate",
            "item_rate_eur",
            "transport_mode",
            "deliver_to_location",
            "subsidiary",
            "production_status",
            german_date(F.col("quality_control_date")).alias("quality_control_date"),
            "quality_control_status",
            "supplier_payment_terms",
            "incoterms",
            "batch_id",
            "wh_type",
            "im_sign_off",
            "sm_sign_off",
            "anti_po",
            "quantity",
            F.col("received").alias("quantity_received"),
            F.col("on_shipment").alias("quantity_on_shipment"),
            "leftover_quantity",
        )
    )


def po_status(sources: Sources, params: Params) -> DataFrame:
    return sources["po_status"]


def average_prices(sources: Sources, params: Params) -> DataFrame:
    """Largest 30-day average price by listing and market."""
    return (
        sources["avg_price_l30"]
        .filter("gross_asp_l30 > 0")
        .groupBy("listing_id", "marketplace")
        .agg(F.max("gross_asp_l30").alias("gross_asp_l30"))
    )


PRICE_KEYS = ["listing_id", "marketplace"]


def average_price_channels(sources: Sources, params: Params) -> DataFrame:
    """Average prices with the sales channels that report one, a row for each with its number of rows."""
    prices = sources["avg_price_l30"].filter("gross_asp_l30 > 0")
    channels = value_counts(prices, PRICE_KEYS, "sales_channel")
    return join_null_safe(channels, average_prices(sources, params), PRICE_KEYS, "left")


def sales_channel_list(sources: Sources, params: Params) -> DataFrame:
    """The ordered list of sales channels behind each average price, in pieces of text."""
    prices = sources["avg_price_l30"].filter("gross_asp_l30 > 0")
    return value_pieces(prices, PRICE_KEYS, "sales_channel", "sales_channel_list")


def dated_target_price(sources: Sources, params: Params) -> DataFrame:
    """Newest benchmark price by listing and raw market, or the average price where it is 0."""
    benchmark = latest_row(
        sources["price_benchmarks"].filter(F.col("asp_benchmark").isNotNull()),
        ["listing_id", "market_reporting"],
        [F.desc_nulls_first("date"), F.desc_nulls_last("asp_benchmark")],
    )
    averages = average_prices(sources, params).withColumnRenamed("marketplace", "market_reporting")
    price = F.when(F.col("asp_benchmark") == 0, F.col("gross_asp_l30")).otherwise(F.col("asp_benchmark"))
    market = normalize_market(F.col("market_reporting"), params.market_map(PAN_EU))
    return benchmark.join(averages, ["listing_id", "market_reporting"], "left").select(
        ref_of(F.col("listing_id"), market).alias("ref"), price.alias("final_sales_price"), "date"
    )


def target_price(sources: Sources, params: Params) -> DataFrame:
    return dated_target_price(sources, params).drop("date")


def vendor_latest(sources: Sources, params: Params) -> DataFrame:
    """Newest row of each manufacturer."""
    newest = latest_row(
        sources["vendor_master"].filter(F.col("supplier_category").isin(MAKERS)),
        ["vendor_id"],
        [
            F.desc_nulls_first("snapshot_date"),
            *[F.asc_nulls_last(c) for c in ("vendor_name", "port_of_departure", "country")],
        ],
    )
    return newest.select(
        "vendor_id",
        "vendor_name",
        F.col("port_of_departure").alias("pol"),
        "supplier_manager",
        "category_manager",
        F.col("country").alias("shipping_country"),
    )


EXTRACTS: dict[str, Callable[[Sources, Params], DataFrame]] = {
    builder.__name__: builder
    for builder in (
        sku_vendor, target_price, demand_plan, product_master_latest, active_products, vendor_latest,
        open_po_lines, po_status, inbound_lines, stock_position,
    )
}

# Order of each report's rows when it is written for reading.
REPORT_ORDER: dict[str, list[Column | str]] = {
    "sku_vendor": ["sku"],
    "demand_plan": ["sku", "market", "quantity"],
    "inbound_lines": ["brand_name", "expected_delivery_date"],
    "open_po_lines": ["brand_name", "order_date"],
}


def extract(name: str, sources: Sources, params: Params) -> DataFrame:
    if name not in EXTRACTS:
        raise KeyError(f"unknown query {name!r}; known: {', '.join(EXTRACTS)}")
    return EXTRACTS[name](sources, params)


def report(name: str, sources: Sources, params: Params) -> DataFrame:
    """A source query in reading order, NULLs last."""
    order = [F.asc_nulls_last(column) for column in REPORT_ORDER.get(name, [])]
    result = extract(name, sources, params)
    return result.orderBy(*order) if order else result
