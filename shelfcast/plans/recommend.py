"""Transfer, expedite and production recommendations, and lead times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.columns import col_or, item_of
from shelfcast.operators.joins import lookup_buffer, lookup_route
from shelfcast.operators.latest import latest_row
from shelfcast.params import Params
from shelfcast.plans import extracts, flows
from shelfcast.plans.extracts import Sources
from shelfcast.sources import dimensions

# Recommendation texts, the markets they look at, and days added to each lead time.
CHECK_TRANSFER = "TO to be checked/created"
EXPEDITE = "Expedite pick up goods from vendor"
PULL_FORWARD = "Prepone PRD to produce faster"
TEN_WEEK_MARKETS = ["US", "CA"]
SEVEN_WEEK_MARKETS = ["EU", "UK"]
AMAZON_MARKETS = ["US", "UK", "EU", "CA"]
SAFETY_DAYS = 30


def recommendations(df: DataFrame, carton_default: int = 1) -> DataFrame:
    """Adds the recommendations to refs with market, demand ahead, price and stock on its way.

    A missing stock column or figure counts as 0, a missing carton size as `carton_default`.
    """

    def stock(name: str, default: float = 0) -> Column:
        return F.coalesce(col_or(df, name, default), F.lit(default))

    pipeline = stock("fulfillable_7d") + stock("at_amz_21d") + stock("on_the_way_to_amz_35d")
    local, on_the_way = stock("local_market_49d"), stock("otw_35p_98d")
    market = F.col("market")
    short = (market.isin(TEN_WEEK_MARKETS) & (pipeline < F.col("demand_10w"))) | (
        market.isin(SEVEN_WEEK_MARKETS) & (pipeline < F.col("demand_7w"))
    )
    transfer = short & (local > stock("units_per_carton", carton_default))
    late = on_the_way < F.col("demand_14w")
    expedite = late & (stock("manufacturing_28_126d") > F.col("demand_18w"))
    sooner = late & (stock("manufacturing_56p_168d") > on_the_way)
    movable = F.least(F.col("demand_10w") - pipeline, local)
    value = F.greatest(movable * F.col("final_sales_price"), F.lit(0.0))
    return df.withColumns(
        {
            "to_check": F.when(transfer, CHECK_TRANSFER).otherwise(""),
            "expedite": F.when(expedite, EXPEDITE).otherwise(""),
            "pull_forward": F.when(sooner, PULL_FORWARD).otherwise(""),
            "to_check_value": F.when(transfer, value).otherwise(F.lit(0.0)),
        }
    )


def item_attributes(sources: Sources, params: Params) -> DataFrame:
    """One row per item: the product behind it, its vendor and the vendor's shipping region."""
    products = extracts.product_master_latest(sources, params)
    products = products.withColumn("item", item_of(F.col("listing_id"), F.col("sku"), "empty"))
    rest = [c for c in products.columns if c not in ("item", "sku", "listing_id", "size_tier")]
    order = [F.asc_nulls_last(column) for column in ("sku", "size_tier", *rest)]
    master = latest_row(products, ["item"], order).select(
        "item", "sku", "lead_time_production_days", "size_tier"
    )
    vendors = extracts.vendor_choice(sources, params)
    regions = flows.vendor_regions(sources, params).select(
        F.col("vendor_id").alias("final_vendor"), "shipping_region"
    )
    return master.join(vendors, "sku", "left").join(regions, "final_vendor", "left")


def lead_times(
    df: DataFrame, params: Params, routes: DataFrame | None = None, buffers: DataFrame | None = None
) -> DataFrame:
    """Adds production, route and buffer days and the total lead time to refs."""
    spark = df.sparkSession
    routes = dimensions.route_leadtime(spark, params.lead_time_routes) if routes is None else routes
    buffers = dimensions.port_buffer(spark) if buffers is None else buffers
    market = F.col("market")
    region = col_or(df, "shipping_region", None).cast("string")
    wh_type = F.when(market.isin(AMAZON_MARKETS), F.lit("AMZ")).otherwise(F.lit("3PL"))
    production = F.coalesce(
        col_or(df, "lead_time_production_days", None).cast("int"), F.lit(params.production_default)
    )
    dated = lookup_route(df, routes, region, market, params.route_default)
    if params.lead_time_buffers == "market":
        none = F.coalesce(market == region, F.lit(False))
        dated = dated.withColumn("buffer_days", F.when(none, 0).otherwise(dimensions.market_buffer(market)))
    else:
        dated = lookup_buffer(dated, buffers, wh_type, market, dimensions.market_buffer(market))
    total = F.col("production_days") + F.col("route_days") + F.col("buffer_days")
    return dated.withColumn("production_days", production).withColumn(
        "total_leadtime", total + params.processing_days + SAFETY_DAYS
    )
