from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, connect
from shelfcast.plans import extracts
from shelfcast.sources import layout, readers
from shelfcast.sources.schemas import SCHEMAS
from shelfcast.sources.testdata import TestdataSources

SF_DIR = "/root/testdata/sf0.001"

# The quick ones, and those that between them use every operator; checks/compare.py runs all.
COMPARED = [
    "sku_vendor", "demand_plan", "active_flag", "inbound_lines", "stock_position", "master_dedupe",
    "open_po_lines", "average_price_channels", "price_per_ref", "vendor_latest", "week_calendar",
    "weekly_demand", "weekly_demand_events", "po_expected_dates_strict", "inbound_expected_dates",
    "oos_weeks_null_stock", "week_distance", "audited_join", "wide_weekly", "allocation", "allocation_legacy",
    "po_expected_dates_po_routes", "revenue_impact_week_53", "sales_channel_list", "stock_sku_list",
    "required_columns", "vendor_dedupe", "left_out", "waterfall_six_decimals",
]


def test_testdata_sources_have_the_source_schemas(spark):
    sources = TestdataSources(spark, SF_DIR)
    assert set(SCHEMAS) <= set(sources)
    for name in SCHEMAS:
        given, wanted = sources[name], readers.conform(sources[name], name)
        assert given.select(*wanted.columns).dtypes == wanted.dtypes


def test_sources_round_trip_and_missing_ones_fail(spark, source, tmp_path):
    source("po_status", {"document_number": "D"}).write.parquet(str(tmp_path / "po_status"))
    tables = readers.load_sources(spark, str(tmp_path), ["po_status"])
    assert tables["po_status"].columns == ["document_number", "line_id", "current_status"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.load_sources(spark, str(tmp_path), ["sales_plan"])
    with pytest.raises(ValueError, match="missing columns"):
        readers.conform(tables["po_status"], "sales_plan")


def test_jdbc_credentials_come_from_the_environment():
    environ = {"SHELFCAST_JDBC_URL": "u", "SHELFCAST_JDBC_USER": "n", "SHELFCAST_JDBC_PASSWORD": "p"}
    options = readers.jdbc_options(environ)
    assert options == {"url": "u", "user": "n", "password": "p", "fetchsize": "10000"}
    with pytest.raises(KeyError):
        readers.jdbc_options({})


def test_every_planning_query_has_sql():
    corpus = {"pipeline", *entry.corpus.queries()} if entry.corpus else set()
    assert set(entry.queries()) - corpus == set(entry.oracle_sql()) - corpus


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, con, name):
    problem, ours, theirs, *_ = compare(spark, con, name, SF_DIR)
    assert problem is None and ours == theirs > 0


def rows_of(df):
    return sorted(map(repr, df.collect()))


def scans_of(df):
    """(files read, folders read, columns read) of each parquet scan of an executed plan, subqueries too."""
    plan = df._jdf.queryExecution().executedPlan()
    out = []

    def visit(node):
        if node.nodeName().startswith("Scan parquet"):
            metrics = node.metrics()
            values = [metrics.apply(name).value() for name in ("numFiles", "numPartitions")]
            out.append((*values, node.requiredSchema().size()))
        for part in ("children", "innerChildren", "subqueries"):
            found = getattr(node, part)()
            for i in range(found.size()):
                visit(found.apply(i))
        if node.nodeName() in ("AdaptiveSparkPlan", "ResultQueryStage", "ShuffleQueryStage"):
            visit(node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan())

    visit(plan)
    return out


def test_demand_plan_opens_no_file_of_an_older_snapshot(spark, source, params, tmp_path):
    days = [date(1998, 1, day) for day in range(1, 21)]
    rows = [
        {"market": "US", "sku": f"s{n % 7}", "listing_id": "L", "date": date(1998, 4, 1), "snapshot_date": day, "quantity": 1.0 + n,
         "review_cycle_version": version}
        for day in days for version in ("Validated_plan", "Draft_plan") for n in range(9)
    ]
    late = [row | {"snapshot_date": date(1998, 2, 1)} for row in rows if row["review_cycle_version"] == "Draft_plan"][:9]
    table = source("sales_plan", *rows, *late)
    layout.lay_out({"sales_plan": table}, str(tmp_path), ["sales_plan"])
    laid_out = readers.load_sources(spark, str(tmp_path), ["sales_plan"])
    got = extracts.demand_plan(laid_out, params)
    assert rows_of(got) == rows_of(extracts.demand_plan({"sales_plan": table}, params)) and got.count() == 7
    got.collect()
    scans = scans_of(got)
    # The rows come from one folder; the newest date from the names of folders, without a column.
    assert sorted({folders for _, folders, columns in scans if columns}) == [1]
    assert {columns for _, folders, columns in scans if folders > 1} == {0}


def test_a_snapshot_is_added_and_replaced_alone(spark, source, tmp_path):
    def stock(day, sku, n):
        return source("stock_snapshots", *[{"snapshot_date": date(1998, 1, day), "sku": sku} for _ in range(n)])

    for day, sku, n in ((1, "a", 3), (2, "b", 2), (2, "c", 4), (None, "d", 1)):
        table = stock(day or 3, sku, n)
        layout.write_snapshots(table if day else table.withColumn("snapshot_date", F.lit(None).cast("date")), str(tmp_path), "stock_snapshots")
    found = readers.load_sources(spark, str(tmp_path), ["stock_snapshots"])["stock_snapshots"]
    assert sorted((r["sku"], r["count"]) for r in found.groupBy("sku").count().collect()) == [("a", 3), ("c", 4), ("d", 1)]
    assert found.filter("snapshot_date IS NULL").count() == 1


def test_key_ranges_are_balanced_over_skewed_keys(spark):
    # Most keys lie in a thousandth of their range.
    keys = spark.range(20_000).selectExpr("CASE WHEN id % 10 > 0 THEN id % 1000 ELSE id * 1000 END AS k", "id")
    keys = keys.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, -1L AS id"))
    ranges = readers.key_ranges(keys, "k", 8)
    counts = [keys.filter(condition).count() for condition in ranges]
    assert len(ranges) == 8 and sum(counts) == 20_001
    assert max(counts) < 1.3 * 20_001 / 8
    width = keys.agg(F.max("k")).first()[0] / 8  # ranges of equal width leave nearly all rows to the first
    assert keys.filter(F.col("k") <= width).count() > 0.9 * 20_000


def test_key_ranges_of_one_hot_key_dates_and_nothing(spark):
    hot = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE 500 END AS k")
    counts = [hot.filter(condition).count() for condition in readers.key_ranges(hot, "k", 10)]
    assert sum(counts) == 1000 and max(counts) < 700 + 100
    days = spark.range(100).selectExpr("date_add(DATE'1998-01-01', CAST(id AS INT)) AS k")
    ranges = readers.key_ranges(days, "k", 4)
    counts = [days.filter(condition).count() for condition in ranges]
    assert sum(counts) == 100 and max(counts) <= 27 and "k <= '1998-01-2" in ranges[0]
    empty = hot.filter("k < 0")
    assert readers.key_ranges(empty, "k", 4) == ["1 = 1"] == readers.key_ranges(days, "k", 1)


def test_a_warehouse_document_must_name_every_source(spark, tmp_path):
    path = tmp_path / "tables.json"
    path.write_text('{"po_status": {"table": "erp.po_status"}}')
    with pytest.raises(ValueError, match="no table for po_lines"):
        readers.load_warehouse(spark, str(path), ["po_status", "po_lines"], {"url": "jdbc:none:"})


def test_decimals_of_a_source_stay_decimals(spark):
    table = spark.sql("SELECT 'l' AS listing_id, 'c' AS sales_channel, 'US' AS marketplace, CAST(1.5 AS DECIMAL(12, 4)) AS gross_asp_l30")
    assert dict(readers.conform(table, "avg_price_l30").dtypes)["gross_asp_l30"] == "decimal(12,4)"
    whole = table.withColumn("gross_asp_l30", F.lit(2))
    assert dict(readers.conform(whole, "avg_price_l30").dtypes)["gross_asp_l30"] == "double"
