"""Source tables derived from the star schema of the test data.

Every source is a projection of one given table, so a query over it costs about what it would over a
real table of that size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.session import spread_partitions
from shelfcast.sources.dimensions import SIGNED_STAGES, UNSIGNED_STAGES

AS_OF = date(1998, 3, 2)

# Raw market label of a zone 0 to 4, as each kind of source writes it.
PLAN_LABELS = ["DE", "US", "UK", "Pan-EU", "US"]
STOCK_LABELS = ["EU", "US", "UK", "Pan-EU", "US"]
SHIP_LABELS = ["DE", "US", "GB", "Pan-EU", "North America"]
SITES = ["EUR", "USA", "GBR", "EUR", "USA"]

# Country of nation 0 to 24.
COUNTRIES = [
    "China", "India", "United States", "Germany", "Viet Nam", "China", "Mexico", "Japan", "Poland",
    "China", "Hong Kong", "United Kingdom", "Brazil", "Canada", "China", "Australia", "Italy",
    "Singapore", "Atlantis", "Pakistan", "China", "Colombia", "Malaysia", "Spain", "India",
]

LISTING = """CASE {key} % 10 WHEN 0 THEN NULL WHEN 1 THEN ''
    WHEN 3 THEN concat('L', {key} - 1) ELSE concat('L', {key}) END"""


def _pick(labels: list[str], index: str) -> str:
    items = ", ".join(f"'{label}'" for label in labels)
    return f"element_at(array({items}), cast({index} AS int) + 1)"


def _listing(key: str) -> str:
    return LISTING.format(key=key)


def _day(text: str, days: int) -> str:
    return f"date_add({text}, {days})"


def _german(text: str, days: int, pattern: str = "dd.MM.yyyy") -> str:
    return f"date_format(date_add({text}, {days}), '{pattern}')"


class TestdataSources(Mapping):
    """Source tables by name, built when first asked for."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: date = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._built: dict[str, DataFrame] = {}
        self._given: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self)
        return self._built[name]

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self):
        return len(BUILDERS)

    def given(self, table: str) -> DataFrame:
        if table not in self._given:
            self._given[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self._given[table]

    def ago(self, days: int) -> str:
        return f"DATE'{self.as_of - timedelta(days=days)}'"


def sales_plan(s: TestdataSources) -> DataFrame:
    return s.given("lineitem").selectExpr(
        _pick(PLAN_LABELS, "l_orderkey % 5") + " AS market",
        "CASE WHEN l_partkey % 97 = 0 THEN '' ELSE cast(l_partkey AS string) END AS sku",
        _listing("l_partkey") + " AS listing_id",
        "trunc(l_shipdate, 'MM') AS date",
        f"""CASE WHEN l_linenumber = 7 THEN {s.ago(1)} WHEN l_returnflag = 'A' THEN {s.ago(35)}
            ELSE {s.ago(7)} END AS snapshot_date""",
        "CASE WHEN l_linenumber = 7 THEN 'Draft_plan' ELSE 'Validated_plan' END AS review_cycle_version",
        "l_quantity AS quantity",
    )


def event_plan(s: TestdataSources) -> DataFrame:
    """Monthly quantities with cents, for rounding: one row per event."""
    return s.given("events").selectExpr(
        "cast(user_id AS string) AS ref",
        "trunc(ts, 'MM') AS date",
        "cast(value AS decimal(18, 2)) AS quantity",
    )


def _parts(s: TestdataSources) -> DataFrame:
    """Parts dealt to many tasks: they fill few bytes of a file, and each becomes up to twelve rows."""
    return s.given("part").repartition("p_partkey")


def product_master(s: TestdataSources) -> DataFrame:
    part = _parts(s).selectExpr(
        "*",
        "explode(sequence(0, p_size % 3)) AS age",
    ).selectExpr("*", "explode(CASE WHEN p_partkey % 11 = 0 THEN array(0, 1, 1) ELSE array(0) END) AS copy")
    return part.selectExpr(
        "cast(p_partkey AS string) AS sku",
        _listing("p_partkey") + " AS listing_id",
        "CASE WHEN p_size % 7 = 0 THEN NULL ELSE 20 + p_size + age END AS lead_time_production_days",
        "1 + p_size % 12 + copy AS units_per_carton",
        "p_size * 0.5D AS carton_weight_kg",
        "p_size * 2.0D AS carton_volume",
        "CASE WHEN p_size % 17 = 0 THEN NULL ELSE p_size * 0.225D END AS ship_weight",
        "CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('V', p_partkey % 100) END AS preferred_vendor",
        "CASE WHEN p_size = 13 THEN NULL ELSE p_size % 20 + 0.08D END AS dim_h_cm",
        "p_size * 1.27D AS dim_l_cm",
        "p_partkey % 30 + 1.0D AS dim_w_cm",
        "CASE p_partkey % 9 WHEN 0 THEN NULL WHEN 8 THEN 'next' ELSE '' END AS successor_sku",
        f"date_sub({s.ago(1)}, 7 * age) AS snapshot_date",
    )


def sku_vendor_map(s: TestdataSources) -> DataFrame:
    return s.given("lineitem").selectExpr(
        "cast(l_partkey AS string) AS sku",
        "CASE WHEN (l_partkey + l_suppkey) % 17 = 0 THEN NULL ELSE concat('V', l_suppkey) END AS vendor",
        """CASE (l_partkey + l_suppkey) % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('V', l_partkey % 50)
            ELSE '' END AS preferred_vendor""",
    )


def _ordered(s: TestdataSources) -> DataFrame:
    """All lines as purchase order lines; `past` ones were settled long ago."""
    return s.given("lineitem").selectExpr(
        f"l_linestatus = 'F' OR l_shipdate < {s.ago(60)} AS past",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "cast(l_shipdate AS date) AS day", "l_suppkey % 5 AS zone",
        "concat('PO', l_orderkey) AS document_number",
        "cast(l_linenumber AS string) AS line_id",
        "concat('PO', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS po_line_key",
    )


def po_lines(s: TestdataSources) -> DataFrame:
    lines = _ordered(s).selectExpr(
        "*", "explode(CASE WHEN l_orderkey % 5 = 0 THEN array(1) ELSE array(0, 1) END) AS age"
    )
    return lines.selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "document_number",
        "line_id",
        "po_line_key",
        "concat('BT', l_orderkey % 50) AS batch_id",
        "cast(l_partkey AS string) AS sku",
        f"CASE WHEN l_partkey % 10 = 5 THEN NULL ELSE {_listing('l_partkey')} END AS listing_id",
        "concat('Brand#', l_partkey % 25) AS brand",
        "concat('V', l_suppkey) AS vendor",
        """CASE WHEN l_suppkey % 13 = 0 THEN 'Intercompany' WHEN l_suppkey % 29 = 0 THEN NULL
            ELSE 'Manufacturers' END AS vendor_category""",
        _pick(STOCK_LABELS, "zone") + " AS market",
        f"CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE {_pick(SHIP_LABELS, 'zone')} END AS market_alt",
        f"""CASE WHEN l_partkey % 31 = 0 THEN 'MAIN'
            ELSE concat('WH_', {_pick(SITES, 'zone')}, '_1') END AS deliver_to_location""",
        """CASE l_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'a B2B order' WHEN 2 THEN 'SHOPIFY drop'
            ELSE 'regular' END AS memo""",
        """CASE WHEN past THEN 'Closed' ELSE CASE l_orderkey % 12 WHEN 0 THEN 'Closed' WHEN 1 THEN 'Legacy Closed' WHEN 2 THEN 'Fully Billed'
            WHEN 3 THEN 'Rejected by Supervisor' WHEN 4 THEN NULL ELSE 'Pending Receipt' END END AS final_status""",
        "CASE l_linenumber WHEN 1 THEN 'Shipped' WHEN 2 THEN NULL ELSE 'In Production' END AS production_status",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'On time' ELSE 'Late' END AS prd_status",
        "CASE WHEN l_orderkey % 3 = 0 THEN 'Yes' END AS prd_reconfirmation",
        "CASE WHEN l_linenumber % 2 = 1 THEN 'Material' END AS prd_change_reason",
        f"CASE WHEN l_partkey % 37 = 0 THEN 'n/a' ELSE cast({_day('day', -60)} AS string) END AS ordered_at",
        f"cast({_day('day', -20)} AS string) AS prd",
        f"CASE WHEN l_linenumber = 4 THEN '?' ELSE cast({_day('day', -25)} AS string) END AS planned_prd",
        """CASE WHEN l_partkey % 41 = 0 THEN 'TBD' WHEN l_partkey % 7 = 3 THEN NULL
            ELSE cast(day AS string) END AS confirmed_crd""",
        f"CASE WHEN l_linenumber = 3 THEN {_german('day', -40, 'd.M.yyyy')} ELSE {_german('day', -40)} END AS first_prd",
        f"{_german('day', -35)} AS accepted_prd",
        f"{_german('day', 45)} AS expected_po_arrival_date",
        f"CASE WHEN l_linenumber = 6 THEN '' ELSE {_german('day', 3)} END AS planned_pickup_date",
        f"CASE WHEN l_linenumber = 5 THEN NULL ELSE {_german('day', -5)} END AS quality_control_date",
        "cast(l_quantity AS bigint) + age AS quantity",
        """CASE l_returnflag WHEN 'R' THEN NULL WHEN 'A' THEN cast(cast(l_quantity AS bigint) div 4 AS string)
            ELSE '0' END AS qty_received""",
        """CASE WHEN l_linenumber = 3 THEN NULL
            ELSE cast(cast(l_quantity AS bigint) div 5 AS string) END AS quantity_on_shipments""",
        "l_extendedprice AS item_rate",
        "l_extendedprice * 0.5D AS item_rate_eur",
        "CASE l_linenumber % 3 WHEN 0 THEN 'AMZ' WHEN 1 THEN '3PL' END AS wh_type",
        "CASE WHEN l_orderkey % 2 = 0 THEN 'Sea' ELSE 'Air' END AS transport_mode",
        "CASE WHEN l_orderkey % 2 = 0 THEN 'FCL' ELSE 'LCL' END AS transport_type",
        "CASE WHEN l_suppkey % 2 = 0 THEN 'FOB' ELSE 'EXW' END AS incoterms",
        "'30/70' AS supplier_payment_terms",
        "CASE WHEN l_linenumber = 5 THEN NULL ELSE 'Passed' END AS quality_control_status",
        "concat('SUB', zone) AS subsidiary",
        "CASE WHEN l_linenumber > 3 THEN 'Yes' ELSE 'No' END AS im_sign_off",
        "CASE WHEN l_linenumber > 4 THEN 'Yes' ELSE 'No' END AS sm_sign_off",
        "CASE WHEN l_linenumber = 7 THEN 'T' ELSE 'F' END AS anti_po",
        f"date_sub({s.ago(1)}, 7 * age) AS snapshot_date",
    )


def po_status(s: TestdataSources) -> DataFrame:
    stages = [*SIGNED_STAGES, *UNSIGNED_STAGES, "Z. Cancelled"]
    # Dealt by line before the repeated rows go, so that what asks for a line's stage shuffles them no more.
    lines = _ordered(s).select("document_number", "line_id", "l_orderkey", "l_linenumber")
    lines = lines.repartition(spread_partitions(lines), "document_number", "line_id").distinct()
    step = "(l_orderkey + l_linenumber) % 27"
    return lines.selectExpr(
        "document_number",
        "line_id",
        f"CASE WHEN {step} < 26 THEN {_pick(stages, f'least({step}, 25)')} END AS current_status",
    )


def shipment_lines(s: TestdataSources) -> DataFrame:
    # Some lines are on a second shipment, of which there is no header. Nothing is expected of returned
    # lines and of past ones.
    lines = _ordered(s).selectExpr(
        "*",
        "past OR l_returnflag = 'R' AS settled",
        "explode(CASE WHEN (l_orderkey div 4) % 11 = 0 THEN array('INB', 'LOST') ELSE array('INB') END) AS kind",
    )
    return lines.selectExpr(
        "concat(kind, l_orderkey div 4) AS shipment_number",
        "po_line_key",
        "document_number AS po",
        "cast(l_partkey AS string) AS sku",
        "concat('V', l_suppkey) AS vendor",
        "concat('RL', zone) AS receiving_location",
        """CASE WHEN settled THEN 0 WHEN l_linenumber = 5 THEN 0 WHEN l_linenumber = 6 THEN NULL
            ELSE cast(l_quantity AS bigint) div 3 END AS quantity_expected""",
        "CASE WHEN l_linenumber = 2 THEN NULL ELSE cast(l_quantity AS bigint) END AS quantity_remaining_to_be_received",
        """CASE l_linenumber WHEN 5 THEN -1 WHEN 3 THEN -1 WHEN 7 THEN NULL
            ELSE cast(l_quantity AS bigint) div 6 END AS quantity_received""",
    )


def shipment_headers(s: TestdataSources) -> DataFrame:
    ships = (
        _ordered(s)
        .withColumn("num", F.expr("l_orderkey div 4"))
        .groupBy("num")
        .agg(F.max("day").alias("day"), F.min("zone").alias("zone"))
        .selectExpr(
            "*",
            "explode(CASE WHEN num % 7 = 0 THEN array(1) WHEN num % 19 = 0 THEN array(0, 0) ELSE array(0, 1) END) AS age",
        )
    )
    return ships.selectExpr(
        "concat('INB', num) AS shipment_number",
        "concat('EXT', num) AS external_document_number",
        f"CASE WHEN num % 4 = 0 THEN NULL ELSE {_pick(SHIP_LABELS, 'zone')} END AS market_place",
        "CASE num % 3 WHEN 0 THEN 'US Amazon FC' WHEN 1 THEN '3PL hub' END AS receiving_warehouse_type",
        "concat('FBA', num) AS fba_id",
        "CASE WHEN age = 0 THEN 'inTransit' ELSE 'toBeShipped' END AS status",
        "CASE WHEN num % 6 = 0 THEN NULL ELSE 'Booked' END AS substatus",
        "CASE WHEN num % 25 = 0 THEN NULL ELSE date_sub(day, 10) END AS cargo_ready_date",
        "date_add(day, 5) AS expected_shipping_date",
        "date_add(day, 25) AS expected_arrival_date",
        "CASE WHEN num % 5 = 0 THEN NULL ELSE date_add(day, 30) END AS expected_delivery_date",
        "CASE WHEN num % 3 = 0 THEN date_add(day, 2) END AS actual_cargo_pick_up_date",
        "CASE WHEN num % 3 = 0 THEN date_add(day, 6) END AS actual_shipping_date",
        "CASE WHEN num % 2 = 0 THEN date_add(day, 20) END AS actual_arrival_date",
        "cast(NULL AS date) AS actual_delivery_date",
        f"""CASE WHEN num % 13 = 0 THEN NULL WHEN num % 2 = 0 THEN {_german('day', -15, 'd.M.yyyy')}
            ELSE {_german('day', -15)} END AS date_created""",
        f"date_sub({s.ago(1)}, 7 * age) AS snapshot_date",
    )


def stock_snapshots(s: TestdataSources) -> DataFrame:
    # Lines still open are stock of an older snapshot.
    lines = s.given("lineitem")
    part = "CASE WHEN cast(round(l_tax * 100) AS int) = {n} THEN floor(l_quantity / 4) ELSE 0.0D END"
    location = "CASE WHEN cast(round(l_discount * 100) AS int) = {n} THEN l_quantity ELSE 0.0D END"
    return lines.selectExpr(
        f"""CASE WHEN l_linestatus <> 'F' OR l_shipdate >= {s.ago(0)} THEN {s.ago(15)}
            WHEN l_linenumber = 7 THEN {s.ago(8)} ELSE {s.ago(1)} END AS snapshot_date""",
        _listing("l_partkey") + " AS listing_id",
        "CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE cast(l_partkey AS string) END AS sku",
        _pick(STOCK_LABELS, "l_suppkey % 5") + " AS market",
        "concat('Brand#', l_partkey % 25) AS brand_name",
        f"cast({part.format(n=1)} AS double) AS in_fm",
        f"{location.format(n=0)} AS in_to_w2w",
        f"{location.format(n=1)} AS in_nn3pl",
        f"{location.format(n=2)} AS in_n3pl",
        f"{location.format(n=3)} AS in_lm",
        f"{location.format(n=4)} AS in_amz",
        f"{location.format(n=5)} AS in_wq",
        f"{location.format(n=6)} AS in_rsvd_cust_ord",
        f"{location.format(n=7)} AS in_rsd_fc_proc",
        f"cast({part.format(n=2)} AS double) AS in_walmart",
        f"{location.format(n=8)} AS in_bol",
        f"{location.format(n=9)} AS in_meli",
        f"cast(CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE {part.format(n=3)} END AS double) AS in_to_osc_l3m",
        f"cast({part.format(n=4)} AS double) AS units_in_d2amz",
        "CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE l_quantity END AS total_inventory",
        """CASE l_linenumber WHEN 6 THEN NULL WHEN 5 THEN -l_quantity
            ELSE floor(l_quantity / 2) END AS units_open_pos_raw""",
    )


def avg_price_l30(s: TestdataSources) -> DataFrame:
    return s.given("lineitem").selectExpr(
        _listing("l_partkey") + " AS listing_id",
        "CASE l_linenumber % 3 WHEN 0 THEN 'Amazon' WHEN 1 THEN 'Shopify' ELSE 'Walmart' END AS sales_channel",
        _pick(STOCK_LABELS, "l_suppkey % 5") + " AS marketplace",
        """CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 5 THEN 0.0D
            ELSE l_extendedprice / l_quantity END AS gross_asp_l30""",
    )


def price_benchmarks(s: TestdataSources) -> DataFrame:
    rows = _parts(s).selectExpr(
        "*",
        "explode(array('US', 'UK', 'EU', 'Pan-EU')) AS market",
    ).selectExpr("*", "explode(CASE WHEN p_partkey % 6 = 2 THEN array(0, 0, 1) ELSE array(0, 1) END) AS age")
    return rows.selectExpr(
        _listing("p_partkey") + " AS listing_id",
        "market AS market_reporting",
        """CASE WHEN p_partkey % 6 = 0 AND age = 0 THEN NULL WHEN p_partkey % 6 = 1 THEN 0.0D
            ELSE p_retailprice + length(market) + age END AS asp_benchmark""",
        f"date_sub({s.ago(1)}, 7 * age + CASE WHEN market = 'Pan-EU' THEN p_size % 3 ELSE 1 END) AS date",
    )


def product_catalog(s: TestdataSources) -> DataFrame:
    rows = _parts(s).selectExpr(
        "*",
        "explode(CASE p_partkey % 3 WHEN 0 THEN array('US', 'Pan-EU', 'EU') WHEN 1 THEN array('US', 'US', 'UK') ELSE array('Pan-EU') END) AS market",
    )
    return rows.selectExpr(
        _listing("p_partkey") + " AS listing_id",
        "substring(market, 1, 2) AS country_code",
        "p_brand AS brand_name",
        "cast(p_partkey AS string) AS sku",
        "market AS marketplace",
        "p_type AS portfolio_cluster",
        "CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END AS go_forward",
    )


def vendor_master(s: TestdataSources) -> DataFrame:
    rows = s.given("supplier").selectExpr(
        "*", "explode(CASE WHEN s_suppkey % 5 = 0 THEN array(1) ELSE array(0, 1) END) AS age"
    )
    return rows.selectExpr(
        "concat('V', s_suppkey) AS vendor_id",
        "s_name AS vendor_name",
        "concat('NATION_', s_nationkey, ' port') AS port_of_departure",
        "concat('SM', s_suppkey % 7) AS supplier_manager",
        "concat('CM', s_suppkey % 3 + age) AS category_manager",
        _pick(COUNTRIES, "s_nationkey") + " AS country",
        """CASE s_suppkey % 5 WHEN 1 THEN 'Manufacturers / LP' WHEN 2 THEN 'Agency'
            ELSE 'Manufacturers' END AS supplier_category""",
        f"date_sub({s.ago(1)}, 7 * age) AS snapshot_date",
    )


def pipeline_stock(s: TestdataSources) -> DataFrame:
    """Units on their way to each ref by how soon they arrive; lines still open count none."""
    lines = s.given("lineitem").selectExpr(
        f"coalesce(nullif({_listing('l_partkey')}, ''), cast(l_partkey AS string)) AS item",
        f"replace({_pick(STOCK_LABELS, 'l_suppkey % 5')}, 'Pan-EU', 'EU') AS market",
        "l_linenumber", "l_partkey", "CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0D END AS l_quantity",
    )

    def line(number: int, name: str):
        return F.sum(F.when(F.col("l_linenumber") == number, F.col("l_quantity")).otherwise(0.0)).alias(name)

    return (
        lines.groupBy(F.concat("item", "market").alias("ref"), "market")
        .agg(
            line(1, "fulfillable_7d"),
            line(2, "at_amz_21d"),
            line(3, "on_the_way_to_amz_35d"),
            line(4, "local_market_49d"),
            line(5, "otw_35p_98d"),
            line(6, "manufacturing_28_126d"),
            line(7, "manufacturing_56p_168d"),
            F.max(F.expr("cast(1 + l_partkey % 12 AS int)")).alias("units_per_carton"),
        )
    )


BUILDERS: dict[str, Callable[[TestdataSources], DataFrame]] = {
    builder.__name__: builder
    for builder in (
        sales_plan, event_plan, product_master, sku_vendor_map, po_lines, po_status, shipment_lines,
        shipment_headers, stock_snapshots, avg_price_l30, price_benchmarks, product_catalog,
        vendor_master, pipeline_stock,
    )
}
