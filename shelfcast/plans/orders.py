"""Purchase orders and shipments in their newest state, brought about once for all that read them.

Orders, inbound shipments and the choice of vendors each look for the newest rows of the same history.
`staged` finds them with one aggregation of the order history, rolled up from line to document, and one
read of the rows it names, writes both, and puts them beside the sources; the source queries then read
these small tables in place of the history.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from shelfcast.operators.joins import join_null_safe
from shelfcast.operators.latest import latest_snapshot
from shelfcast.params import Params
from shelfcast.plans import extracts
from shelfcast.plans.extracts import CLOSED_STATES, INTERNAL_VENDORS, Sources

Keep = Callable[[DataFrame, str], DataFrame]


def order_index(sources: Sources) -> DataFrame:
    """What planning asks of the whole order history: a row per document, line, sku and vendor.

    `undated` and `newest` tell the newest snapshot, `external` and `last` the last date ordered from a
    vendor that is not internal. Rows are combined before the shuffle, however many snapshots there are.
    """
    external = F.col("vendor_category") != INTERNAL_VENDORS
    ordered = F.struct(F.col("ordered_at").isNull().alias("unknown"), F.col("ordered_at"))
    return (
        sources["po_lines"]
        .groupBy("document_number", "line_id", "sku", "vendor")
        .agg(
            F.max(F.col("snapshot_date").isNull()).alias("undated"),
            F.max("snapshot_date").alias("newest"),
            F.max(F.coalesce(external, F.lit(False))).alias("external"),
            F.max(F.when(external, ordered)).alias("last"),
        )
    )


def last_orders(index: DataFrame) -> DataFrame:
    """Orders from vendors that are not internal, as the choice of vendors looks at them."""
    return index.filter("external").select(
        "sku", F.col("last.ordered_at").alias("ordered_at"), "document_number", "line_id",
        F.col("vendor").alias("po_vendor"),
    )


def newest_dates(index: DataFrame) -> DataFrame:
    """Newest snapshot of each line (NULL where one is undated), and whether it is its document's too."""
    newest = [F.max("undated").alias("undated"), F.max("newest").alias("newest")]
    lines = index.groupBy("document_number", "line_id").agg(*newest)
    documents = lines.groupBy("document_number").agg(*newest)
    date = F.when(~F.col("undated"), F.col("newest"))
    documents = documents.select("document_number", date.alias("document_date"))
    lines = lines.select("document_number", "line_id", date.alias("snapshot_date"))
    return join_null_safe(lines, documents, ["document_number"], "inner").select(
        "document_number", "line_id", "snapshot_date",
        F.col("snapshot_date").eqNullSafe(F.col("document_date")).alias("of_document"),
    )


# What the weekly flows look at of a PO line; the report of open lines has twice as many columns.
PLANNED_LINE = [
    "document_number", "line_id", "po_line_key", "batch_id", "sku", "listing_id", "brand", "vendor", "vendor_category",
    "market", "market_alt", "deliver_to_location", "memo", "final_status", "production_status", "ordered_at",
    "confirmed_crd", "quantity", "qty_received", "quantity_on_shipments", "wh_type", "transport_mode", "transport_type",
    "snapshot_date",
]


def order_lines(
    sources: Sources, index: DataFrame, params: Params, columns: list[str] | None = None, keep: Keep | None = None
) -> DataFrame:
    """Newest rows of every PO line that can still be planned, with units on shipments and stage text.

    With `keep`, the newest rows are written before units and text are joined to them.
    """
    lines = sources["po_lines"] if columns is None else sources["po_lines"].select(*columns)
    open_lines = lines.filter(
        ~F.col("final_status").isin(CLOSED_STATES)
        & (F.col("quantity") > 0)
        & (F.col("vendor_category") != INTERNAL_VENDORS)
    )
    keys = ["document_number", "line_id", "snapshot_date"]
    lines = join_null_safe(open_lines, newest_dates(index), keys, "inner")
    if keep is not None:
        lines = keep(lines, "newest_lines")
    if not params.raw_join:
        lines = extracts.with_shipped_units(lines, sources, params)
    return lines.join(extracts.newest_status(sources, params), ["document_number", "line_id"], "left")


def staged(
    sources: Sources, params: Params, keep: Keep, columns: list[str] | None = None, keep_lines: Keep | None = None
) -> Sources:
    """The sources with newest orders and shipments beside them; `keep` writes a table and reads it back.

    With `columns`, order lines have no others but units on shipments, stage text and `of_document`; with
    `keep_lines`, they are written in two steps.
    """
    index = keep(order_index(sources), "order_index")
    shipments = keep(latest_snapshot(sources["shipment_headers"], ["shipment_number"]), "newest_shipments")
    tables = {"newest_shipments": shipments, "last_orders": last_orders(index)}
    lines = order_lines(ChainMap(tables, sources), index, params, columns, keep_lines)
    return ChainMap({**tables, "order_lines": keep(lines, "order_lines")}, sources)
