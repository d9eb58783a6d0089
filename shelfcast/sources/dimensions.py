"""Small fixed tables: routes, buffers, regions, stages; and readers for the files that replace them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

# Transport days by departure and arrival region.
ROUTE_DAYS = {
    "CN": {"US": 39, "EU": 42, "UK": 34, "Asia": 23, "MX": 39, "CO": 39, "BR": 39, "CA": 39,
           "AU": 23, "Other": 40, "CN": 6, "JP": 10},
    "IN": {"US": 45, "EU": 33, "UK": 26, "CA": 45, "MX": 45, "IN": 2, "AU": 20},
    "EU": {"US": 40, "MX": 40, "CO": 40, "BR": 40, "CA": 40, "UK": 20, "Other": 45, "EU": 7},
    "UK": {"US": 36, "CA": 36, "UK": 2, "CO": 39, "EU": 7},
    "US": {"UK": 52, "EU": 20, "MX": 15, "CO": 15, "BR": 15, "CA": 15, "AU": 40, "US": 6},
    "MX": {"US": 15, "CA": 15, "EU": 40, "BR": 15, "UK": 52, "CO": 30, "MX": 2},
    "CO": {"US": 15, "CO": 2},
    "BR": {"US": 15, "EU": 40, "UK": 52, "BR": 2},
    "CA": {"MX": 15, "CA": 2, "US": 10, "CO": 20, "BR": 20},
    "AU": {"AU": 6},
    "JP": {"US": 39},
    "Other": {"Other": 7},
}

# The routes known to the arrival forecast of purchase orders and of shipments.
PO_ROUTES = {"CN": ["US", "EU", "UK"], "IN": ["US", "EU", "UK"], "EU": ["US"], "UK": ["US"],
             "US": ["UK", "EU"]}
INBOUND_ROUTES = {"CN": ["US", "EU", "UK"], "IN": ["US", "EU", "UK"]}

# The transport days of the older lead time map, which disagrees with the route table.
LEGACY_ROUTE_DAYS = {
    "CN": {"US": 39, "EU": 42, "UK": 34, "Asia": 23, "MX": 39, "CO": 39, "BR": 39, "CA": 39,
           "CN": 39, "JP": 20},
    "IN": {"US": 45, "EU": 33, "UK": 26, "MX": 40, "CO": 15, "BR": 15, "JP": 15, "CA": 45},
    "EU": {"US": 40, "MX": 40, "CO": 39, "BR": 40, "CA": 40, "JP": 10, "UK": 40, "AU": 7, "EU": 7},
    "UK": {"US": 36, "CA": 15, "JP": 15, "AU": 2},
    "US": {"UK": 52, "EU": 20, "MX": 45, "CO": 15, "BR": 40, "CA": 7, "CN": 39, "US": 7},
    "MX": {"CN": 20, "UK": 15, "BR": 15, "MX": 15, "CA": 40, "CO": 15, "US": 40, "AU": 7},
    "CO": {"MX": 7, "EU": 39, "BR": 39, "US": 15, "CA": 39, "JP": 2},
    "BR": {"MX": 15, "CO": 15, "EU": 15, "IN": 15, "BR": 15, "CA": 15, "US": 15, "JP": 15},
    "CA": {"MX": 40, "EU": 40, "UK": 15, "US": 2, "CA": 2, "BR": 40},
    "AU": {"Other": 15, "CN": 15},
    "Other": {"AU": 15},
}

# Days from the port to the sales channel.
BUFFER_DAYS = {
    "3PL": {"US": 39, "CO": 39, "MX": 39, "BR": 39, "EU": 40, "CA": 39, "UK": 39, "Other": 39},
    "AMZ": {"US": 25, "EU": 26, "UK": 22, "CA": 25},
}

# The port buffers known to the arrival forecast of purchase orders.
PO_BUFFERS = {"3PL": ["US", "EU", "UK"], "AMZ": ["US", "EU", "UK"]}

# Days from the port where the warehouse type is not known; other markets take 39.
MARKET_BUFFER_DAYS = {"US": 39, "CO": 39, "MX": 39, "CA": 39, "UK": 39, "BR": 36, "EU": 40,
                      "Other": 39}
BUFFER_DEFAULT = 39

# Countries of each shipping region.
REGION_COUNTRIES = {
    "CN": ["China", "Hong Kong", "Singapore", "Nepal", "Tunisia", "Viet Nam",
           "Taiwan (Province of China)", "Eswatini", "Philippines", "Gabon", "Malaysia", "Pakistan",
           "Thailand", "Indonesia", "United Arab Emirates", "Sri Lanka", "Korea (the Republic of)"],
    "EU": ["Poland", "Germany", "Ukraine", "Italy", "Czechia", "Türkiye", "Austria", "Netherlands",
           "Ireland", "Luxembourg", "Switzerland", "Spain", "France", "Sweden", "Portugal",
           "Denmark", "Israel", "Romania", "Georgia", "Bulgaria", "Lithuania", "Hungary",
           "Belgium", "Finland", "Kosovo", "Estonia", "Slovenia", "Slovakia", "Greece", "Latvia",
           "Malta"],
    "UK": ["United Kingdom"],
    "US": ["United States"],
    "AU": ["Australia"],
    "CA": ["Canada"],
    "IN": ["India"],
    "BR": ["Argentina", "Brazil"],
    "JP": ["Japan"],
    "MX": ["Mexico"],
    "CO": ["Colombia"],
}

# Asian countries.
ASIA_COUNTRIES = ["China", "Hong Kong", "Malaysia", "Taiwan (Province of China)", "Viet Nam",
                  "Korea (the Republic of)", "Singapore", "Japan"]

# Stages of a purchase order line past, and before, the sign-off.
SIGNED_STAGES = [
    "12. Ready for Batching Pending",
    "13. Batch Creation Pending",
    "14. SM Sign-Off Pending",
    "15. CI Approval Pending",
    "16. CI Payment Pending",
    "17. QC Schedule Pending",
    "18. FFW Booking Missing",
    "19. Supplier Pickup Date Pending",
    "20. Pre Pickup Check",
    "21. FOB Pickup Pending",
    "22. Non FOB Pickup Pending",
    "23. INB Creation Pending",
]
UNSIGNED_STAGES = [
    "01. PO Approval Pending",
    "02. Supplier Confirmation Pending",
    "03. PI Upload Pending",
    "04. PI Approval Pending",
    "05. PI Payment Pending",
    "06. Packaging Pending",
    "07. Transperancy Label Pending",
    "08. PRD Pending",
    "09. Under Production",
    "10. PRD Confirmation Pending",
    "11. IM Sign-Off Pending",
    "A. Anti PO Line",
    "B. Compliance Blocked",
]


def _values(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """Inline table; its size is known to the optimizer, which then broadcasts it by itself."""
    text = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in row) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({', '.join(columns)})")


def _routes(spark: SparkSession, days: dict, known: dict | None = None) -> DataFrame:
    rows = [
        (departure, arrival, n, departure + arrival)
        for departure, arrivals in days.items()
        for arrival, n in arrivals.items()
        if known is None or arrival in known.get(departure, [])
    ]
    return _values(spark, rows, ["departure", "arrival", "days", "id_route"])


def route_leadtime(spark: SparkSession, routes: str = "all") -> DataFrame:
    """Transport days: "all" routes, those known for "po" or "inbound", or the "legacy" map."""
    if routes == "legacy":
        return _routes(spark, LEGACY_ROUTE_DAYS)
    return _routes(spark, ROUTE_DAYS, {"all": None, "po": PO_ROUTES, "inbound": INBOUND_ROUTES}[routes])


def port_buffer(spark: SparkSession, known: dict | None = None) -> DataFrame:
    rows = [
        (wh_type, location, n)
        for wh_type, locations in BUFFER_DAYS.items()
        for location, n in locations.items()
        if known is None or location in known.get(wh_type, [])
    ]
    return _values(spark, rows, ["wh_type", "location", "days"])


def market_buffer(market: Column) -> Column:
    """Buffer days of a market whose warehouse type is not in the buffer table."""
    cases = F
    for name, days in MARKET_BUFFER_DAYS.items():
        cases = cases.when(market == name, F.lit(days))
    return cases.otherwise(F.lit(BUFFER_DEFAULT))


def country_region(spark: SparkSession) -> DataFrame:
    rows = [(country, region) for region, names in REGION_COUNTRIES.items() for country in names]
    return _values(spark, rows, ["country", "region"])


def asia_country(spark: SparkSession) -> DataFrame:
    return _values(spark, [(country,) for country in ASIA_COUNTRIES], ["country"])


def stage_class(spark: SparkSession) -> DataFrame:
    rows = [(s, "signed") for s in SIGNED_STAGES] + [(s, "unsigned") for s in UNSIGNED_STAGES]
    return _values(spark, rows, ["stage", "klass"])


def table(name: str, sources: Mapping[str, DataFrame]) -> DataFrame:
    """A dimension given among the sources, else the built-in one."""
    if name in sources:
        return sources[name]
    spark = next(iter(sources.values())).sparkSession
    return {
        "route_leadtime": route_leadtime,
        "port_buffer": port_buffer,
        "country_region": country_region,
        "asia_country": asia_country,
        "stage_class": stage_class,
    }[name](spark)


def read_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header: cells read as text and trimmed, empty ones kept, then cast to the schema."""
    target = T.StructType.fromDDL(schema)
    text = ", ".join(f"`{field.name}` string" for field in target)
    table = spark.read.schema(text).options(header=True, enforceSchema=True).csv(path)
    cells = {f.name: F.coalesce(F.trim(f.name), F.lit("")) for f in target}
    return table.select(*[cells[f.name].cast(f.dataType).alias(f.name) for f in target])


def read_route_leadtime(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, "departure string, arrival string, days int, id_route string")


def read_port_buffer(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, "wh_type string, location string, days int")


def read_country_region(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, "country string, region string")


def read_asia_country(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, "country string")


# Dimension files that replace a built-in table, by its name.
READERS = {
    "route_leadtime": read_route_leadtime,
    "port_buffer": read_port_buffer,
    "country_region": read_country_region,
    "asia_country": read_asia_country,
}


def read_rules(spark: SparkSession, path: str) -> tuple[DataFrame, Row]:
    """Stage classes, and one row of market names and thresholds, out of a JSON rules document."""
    rules = spark.read.schema(
        "marketplace_mappings map<string,string>, signed_stages array<string>, unsigned_stages array<string>, "
        "po_splitting struct<default_lead_time_days:int,po_processing_time:int>, "
        "inventory_thresholds struct<min_units_per_carton:int>"
    ).json(path, multiLine=True)
    stages = rules.select(F.explode("signed_stages").alias("stage"), F.lit("signed").alias("klass"))
    stages = stages.unionByName(
        rules.select(F.explode("unsigned_stages").alias("stage"), F.lit("unsigned").alias("klass"))
    )
    return stages, rules.select("marketplace_mappings", "po_splitting.*", "inventory_thresholds.*").first()
