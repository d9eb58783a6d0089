import random
import re
import time
from dataclasses import replace
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfcast import sinks
from shelfcast.params import Params
from shelfcast.plans import extracts, flows
from shelfcast.plans.allocation import ALLOCATION, allocation, plan_allocation, staged_allocation
from shelfcast.plans.impact import days_of_cover, oos_labels, ref_summary, revenue_impact, run_summary
from shelfcast.plans.orders import PLANNED_LINE, staged
from shelfcast.plans.recommend import lead_times, recommendations
from shelfcast.plans.waterfall import (
    FLOWS, dense_weeks, filled_weeks, filled_weeks_of, flow_rows, left_out, left_out_of, oos_weeks, run_waterfall, waterfall_of, weekly_flow, with_dates,
    with_oos_marks,
)
from shelfcast.sources.testdata import TestdataSources

AS_OF = date(1998, 3, 2)
FLOW_SCHEMA = (
    "ref string, market_chars int, week_start date, demand double, inbound double, "
    "po_signed double, po_unsigned double, opening double"
)


def week(n):
    return AS_OF + timedelta(days=7 * n)


def flow(ref, n, demand=None, inbound=None, signed=None, unsigned=None):
    return (ref, 0, week(n), demand, inbound, signed, unsigned, None)


def stock(ref, quantity):
    return (ref, 0, None, None, None, None, None, quantity)


def weeks_of(spark, rows, params):
    contributions = spark.createDataFrame(rows, FLOW_SCHEMA)
    dense = dense_weeks(weekly_flow(contributions, params), params)
    return with_dates(run_waterfall(dense, params), params)


# Source queries -------------------------------------------------------------------------------


def po(**changes):
    return {
        "document_number": "D", "line_id": "1", "po_line_key": "K", "sku": "s", "listing_id": "L",
        "vendor": "V", "vendor_category": "Manufacturers", "market": "US", "final_status": "Open",
        "quantity": 100, "qty_received": "10", "quantity_on_shipments": "20", "confirmed_crd": "1998-04-01",
        "wh_type": "AMZ", "snapshot_date": date(1998, 3, 1), **changes,
    }


def shipment_line(**changes):
    return {
        "shipment_number": "S", "po_line_key": "K", "po": "D", "sku": "s", "quantity_expected": 30,
        "quantity_remaining_to_be_received": 30, "quantity_received": 5, **changes,
    }


def header(**changes):
    return {"shipment_number": "S", "substatus": "Booked", "snapshot_date": date(1998, 3, 1), **changes}


def test_vendor_choice(source, sources, params):
    tables = sources(
        sku_vendor_map=source(
            "sku_vendor_map",
            {"sku": "a", "vendor": "V2", "preferred_vendor": ""},
            {"sku": "a", "vendor": "V1", "preferred_vendor": ""},
            {"sku": "b", "vendor": "V1", "preferred_vendor": "P"},
            {"sku": "c", "vendor": None, "preferred_vendor": ""},
            {"sku": "d", "vendor": None, "preferred_vendor": None},
        ),
        po_lines=source(
            "po_lines",
            po(sku="c", vendor="OLD", ordered_at="1998-01-01"),
            po(sku="c", vendor="NEW", ordered_at="1998-02-01"),
            po(sku="c", vendor="IN", ordered_at="1998-03-01", vendor_category="Intercompany"),
        ),
    )
    got = {r.sku: r.final_vendor for r in extracts.sku_vendor(tables, params).collect()}
    assert got == {"a": "V1", "b": "P", "c": "NEW", "d": None}


@pytest.mark.parametrize(
    "changes, kept",
    [
        ({}, True),
        ({"final_status": "Closed"}, False),
        ({"final_status": None}, False),
        ({"vendor_category": "Intercompany"}, False),
        ({"vendor_category": None}, False),
        ({"production_status": "Shipped"}, False),
        ({"quantity": 0}, False),
        ({"qty_received": "100"}, False),
        ({"qty_received": "99"}, True),
    ],
)
def test_open_po_filters(source, sources, params, changes, kept):
    tables = sources(po_lines=source("po_lines", po(**changes)))
    assert (extracts.open_po_lines(tables, params).count() == 1) == kept


def test_open_po_leftover_counts_shipped_units_once(source, sources, params):
    tables = sources(
        po_lines=source("po_lines", po(), po(snapshot_date=date(1998, 2, 1), quantity=7)),
        shipment_lines=source("shipment_lines", shipment_line(), shipment_line(quantity_expected=40)),
        shipment_headers=source("shipment_headers", header(), header(snapshot_date=date(1998, 2, 1))),
    )
    once = extracts.open_po_lines(tables, params).collect()
    assert [r.leftover_quantity for r in once] == [30]
    raw = extracts.open_po_lines(tables, replace(params, raw_join=True)).collect()
    assert sorted(r.leftover_quantity for r in raw) == [60, 60, 70, 70]


def test_bad_quantities_raise_as_in_the_warehouse(source, sources, params):
    tables = sources(po_lines=source("po_lines", po(qty_received="many")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        extracts.open_po_lines(tables, params).collect()


@pytest.mark.parametrize(
    "line, head, order, quantity",
    [
        ({}, {}, {}, 25),
        ({}, {"substatus": None}, {}, 30),
        ({"quantity_received": -1}, {}, {}, 0),
        ({"quantity_remaining_to_be_received": None}, {}, {}, 80),
        ({}, {}, {"memo": "B2B"}, None),
        ({}, {}, {"memo": "to SHOPIFY"}, None),
        ({"quantity_expected": 0}, {}, {}, None),
        ({"sku": "other"}, {}, {}, None),
    ],
)
def test_inbound_quantity(source, sources, params, line, head, order, quantity):
    tables = sources(
        po_lines=source("po_lines", po(**order)),
        shipment_lines=source("shipment_lines", shipment_line(**line)),
        shipment_headers=source("shipment_headers", header(**head)),
    )
    got = [r.quantity for r in extracts.inbound_lines(tables, params).collect()]
    assert got == ([] if quantity is None else [quantity])


def test_inbound_market_comes_from_the_delivery_site_last(source, sources, params):
    lines = source("shipment_lines", shipment_line())
    cases = [
        ({"market_place": "DE"}, {"market_alt": "US"}, "EU"),
        ({}, {"market_alt": "North America"}, "US"),
        ({}, {"deliver_to_location": "WH_GBR_1"}, "UK"),
        ({}, {"deliver_to_location": "MAIN"}, ""),
    ]
    for head, order, market in cases:
        tables = sources(
            po_lines=source("po_lines", po(**order)), shipment_lines=lines,
            shipment_headers=source("shipment_headers", header(**head)),
        )
        assert [r.market for r in extracts.inbound_lines(tables, params).collect()] == [market]


def stock_row(**changes):
    zero = dict.fromkeys(extracts.STOCK_LOCATIONS, 0.0)
    return {
        **zero, "snapshot_date": date(1998, 3, 1), "listing_id": "L", "sku": "s", "market": "EU",
        "brand_name": "B", "total_inventory": 10.0, **changes,
    }


def test_stock_is_net_of_locations_and_summed_per_ref(source, sources, params):
    rows = source(
        "stock_snapshots",
        stock_row(in_walmart=1.0, in_to_osc_l3m=2.0, in_fm=3.0, units_in_d2amz=1.0),
        stock_row(sku="t", market="Pan-EU", total_inventory=5.0),
        stock_row(listing_id="", total_inventory=4.0),
        stock_row(snapshot_date=date(1998, 2, 1), total_inventory=99.0),
        stock_row(sku="u", listing_id="N", in_fm=None),
        stock_row(sku="v", listing_id="Z", total_inventory=None),
    )
    got = {r.ref: r.total_inventory for r in flows.opening_stock(sources(stock_snapshots=rows), params).collect()}
    assert got == {"LEU": 8.0, "EU": 4.0, "NEU": None}
    twice = flows.opening_stock(sources(stock_snapshots=rows), replace(params, double_deduct=True))
    assert {r.ref: r.total_inventory for r in twice.collect()}["LEU"] == 1.0


def test_price_is_the_newest_benchmark_or_the_average(source, sources, params):
    bench = lambda l, m, p, d: {"listing_id": l, "market_reporting": m, "asp_benchmark": p, "date": date(1998, 1, d)}
    tables = sources(
        price_benchmarks=source(
            "price_benchmarks", bench("A", "US", 5.0, 1), bench("A", "US", 6.0, 2), bench("A", "US", None, 3),
            bench("B", "US", 0.0, 1), bench("C", "EU", 1.0, 2), bench("C", "Pan-EU", 2.0, 2), bench("D", "US", 0.0, 1),
        ),
        avg_price_l30=source(
            "avg_price_l30",
            *[{"listing_id": "B", "sales_channel": c, "marketplace": "US", "gross_asp_l30": p} for c, p in [("x", 3.0), ("y", 4.0), ("z", None)]],
        ),
    )
    assert extracts.target_price(tables, params).count() == 5
    got = {r.ref: r.final_sales_price for r in flows.price_per_ref(tables, params).collect()}
    assert got == {"AUS": 6.0, "BUS": 4.0, "CEU": 2.0, "DUS": None}
    channels = extracts.average_price_channels(tables, params).collect()
    assert sorted((r.gross_asp_l30, r.sales_channel, r.n) for r in channels) == [(4.0, "x", 1), (4.0, "y", 1)]
    texts = extracts.sales_channel_list(tables, params).collect()
    assert sorted((r.sales_channel, r.piece, r.sales_channel_list) for r in texts) == [("x", 0, "x"), ("y", 0, "y")]


def test_unknown_query_fails(sources, params):
    with pytest.raises(KeyError, match="unknown query 'x'"):
        extracts.extract("x", sources(), params)
    assert len(extracts.EXTRACTS) == 10


def test_report_order(source, sources, params):
    tables = sources(po_lines=source("po_lines", po(brand="b"), po(line_id="2", brand=None), po(line_id="3", brand="a")))
    got = [r.brand_name for r in extracts.report("open_po_lines", tables, params).collect()]
    assert got == ["a", "b", None]


# Flows ----------------------------------------------------------------------------------------


def plan_row(**changes):
    return {
        "market": "US", "sku": "s", "listing_id": "L", "date": date(1998, 4, 1), "quantity": 30.0,
        "snapshot_date": date(1998, 3, 1), "review_cycle_version": "Validated_plan", **changes,
    }


def test_demand_adds_up_before_rounding_and_drops_week_53(source, sources, params):
    tables = sources(
        sales_plan=source(
            "sales_plan", plan_row(quantity=15.0), plan_row(sku="t", quantity=15.0),
            plan_row(date=date(1998, 12, 1), quantity=31.0), plan_row(sku="", quantity=99.0),
            plan_row(snapshot_date=date(1998, 2, 1), quantity=99.0),
            plan_row(review_cycle_version="Draft_plan", snapshot_date=date(1998, 3, 2), quantity=99.0),
            plan_row(date=date(2000, 1, 1), quantity=99.0), plan_row(date=date(1997, 12, 1), quantity=99.0),
        )
    )
    got = {r.label: r.demand for r in flows.weekly_demand(tables, params).collect()}
    assert got["CW14-1998"] == 5.0 and got["CW15-1998"] == 7.0 and got["CW18-1998"] == 4.0
    assert sum(got.values()) == 30 + 27 and "CW53-1998" not in got
    kept = flows.weekly_demand(tables, replace(params, drop_week_53=False)).collect()
    assert {r.label: r.demand for r in kept}["CW53-1998"] == 4.0


def po_line(spark, **changes):
    row = {"shipping_region": "CN", "market": "US", "wh_type": "AMZ", "crd": date(1998, 4, 1), **changes}
    schema = "shipping_region string, market string, wh_type string, crd date"
    return spark.createDataFrame([tuple(row.values())], schema)


@pytest.mark.parametrize(
    "changes, strict, route, buffer, start",
    [
        ({}, False, 39, 25, date(1998, 4, 1)),
        ({"crd": None}, False, 39, 25, AS_OF),
        ({"crd": None}, True, 39, 25, None),
        ({"crd": date(1998, 1, 1)}, False, 39, 25, AS_OF),
        ({"crd": AS_OF}, True, 39, 25, AS_OF),
        ({"shipping_region": None, "market": "EU"}, False, 42, 26, date(1998, 4, 1)),
        ({"shipping_region": None, "market": "EU"}, True, 39, 26, date(1998, 4, 1)),
        ({"market": "JP"}, False, 10, 39, date(1998, 4, 1)),
        ({"wh_type": None}, False, 39, 39, date(1998, 4, 1)),
    ],
)
def test_po_expected_dates(spark, params, changes, strict, route, buffer, start):
    row = flows.po_expected_dates(po_line(spark, **changes), params, strict=strict).collect()[0]
    assert (row.route_days, row.buffer_days) == (route, buffer)
    assert row.expected_delivery_date == (start and start + timedelta(days=route + buffer))


def test_narrow_route_sets(spark, params):
    line = po_line(spark, market="JP")
    narrow = replace(params, po_routes="po", inbound_routes="inbound", lead_time_routes="legacy")
    assert flows.po_expected_dates(line, narrow).collect()[0].route_days == 39
    dates = line.select("market", *[F.lit(None).cast("date").alias(c) for c in (
        "expected_delivery_date", "actual_arrival_date", "movement_date", "final_crd")])
    assert flows.inbound_expected_dates(dates, narrow).collect()[0].route_days == 45
    assert flows.inbound_expected_dates(dates, params).collect()[0].route_days == 10
    lead = line.selectExpr("'CN' AS shipping_region", "'MX' AS market", "10 AS lead_time_production_days")
    mexico = lead.withColumn("shipping_region", F.lit("MX"))
    assert lead_times(mexico, narrow).collect()[0].route_days == 15
    assert lead_times(mexico, params).collect()[0].route_days == 2


@pytest.mark.parametrize(
    "dates, row_mode, column_mode",
    [
        ((date(1998, 5, 1), None, None, None), date(1998, 5, 1), date(1998, 5, 1)),
        ((AS_OF, None, None, None), AS_OF + timedelta(7), AS_OF + timedelta(7)),
        ((AS_OF + timedelta(1), None, None, None), AS_OF + timedelta(1), AS_OF + timedelta(1)),
        ((None, date(1998, 4, 1), None, None), date(1998, 4, 1) + timedelta(39), AS_OF + timedelta(55)),
        ((None, None, date(1998, 4, 1), None), date(1998, 4, 1) + timedelta(78), AS_OF + timedelta(55)),
        ((None, None, None, date(1998, 4, 1)), date(1998, 4, 1) + timedelta(90), AS_OF + timedelta(55)),
        ((None, date(1997, 1, 1), None, None), AS_OF + timedelta(7), AS_OF + timedelta(55)),
        ((None, None, None, None), AS_OF + timedelta(55), AS_OF + timedelta(55)),
    ],
)
def test_inbound_expected_dates(spark, params, dates, row_mode, column_mode):
    schema = "expected_delivery_date date, actual_arrival_date date, movement_date date, final_crd date"
    lines = spark.createDataFrame([dates], schema).withColumn("market", F.lit("US"))
    for mode, expected in (("row", row_mode), ("column", column_mode)):
        got = flows.inbound_expected_dates(lines, replace(params, inbound_fallback=mode)).collect()[0]
        assert got.expected_delivery_date_final == expected
    own = flows.inbound_expected_dates(lines.withColumn("shipping_region", F.lit("US")), params)
    assert (own.collect()[0].buffer_days, own.collect()[0].route_days) == (0, 6)


def test_po_classes_and_listing(source, sources, params):
    stages = ["23. INB Creation Pending", "A. Anti PO Line", "Z. Cancelled", None]
    lines = [po(line_id=str(i), po_line_key=str(i), listing_id=None) for i in range(4)]
    master = [{"sku": "s", "listing_id": l, "units_per_carton": 1, "snapshot_date": AS_OF} for l in ("M2", "M1", None)]
    tables = sources(
        po_lines=source("po_lines", *lines),
        po_status=source("po_status", *[
            {"document_number": "D", "line_id": str(i), "current_status": s} for i, s in enumerate(stages)]),
        product_master=source("product_master", *master),
    )
    got = flows.po_contributions(tables, params).collect()
    assert sorted((r.klass, r.ref, r.quantity) for r in got) == [("signed", "M1US", 80.0), ("unsigned", "M1US", 80.0)]
    assert [r.quantity for r in flows.po_flow(tables, params, "signed").collect()] == [80.0]
    assert flows.po_contributions(tables, replace(params, fan_out_master=True)).count() == 6


def test_active_refs(source, sources, params):
    row = lambda l, m, g=1: {"listing_id": l, "marketplace": m, "go_forward": g}
    tables = sources(product_catalog=source(
        "product_catalog", row("L", "Pan-EU"), row("L", "EU"), row("L", "US", 0), row(None, "US"), row("M", "US")))
    assert sorted((r.ref, r.active) for r in flows.active_flag(tables, params).collect()) == [("LEU", "Yes"), ("MUS", "Yes")]


# Waterfall ------------------------------------------------------------------------------------


def test_worked_example(spark, params):
    rows = [
        stock("a", 10.0), flow("a", 0, 4.0), flow("a", 1, 4.0, unsigned=3.0), flow("a", 2, 9.0, 1.0),
        flow("a", 3, 5.0, signed=2.0),
    ]
    weeks = weeks_of(spark, rows, params)
    got = [(r.inventory_start, r.inventory_end, r.sales_missed) for r in weeks.orderBy("week_idx").limit(4).collect()]
    assert got == [(10, 6, 0), (6, 5, 0), (5, 0, 3), (0, 0, 3)]
    assert weeks.count() == 104
    oos = oos_weeks(weeks).collect()[0]
    assert (oos.oos_first, oos.oos_last_onset, oos.oos_final) == (week(2), week(2), week(2))


def step(opening, flows_by_week, horizon):
    """The recurrence, week by week."""
    start, result = opening, []
    for t in range(horizon):
        demand, inbound, signed, unsigned = flows_by_week.get(t, (0, 0, 0, 0))
        supply = inbound if t == 0 else inbound + signed + unsigned
        end = max(start + supply - demand, 0)
        result.append((start, end, max(demand - start - signed - inbound, 0)))
        start = end
    return result


@pytest.mark.parametrize("unit", [1.0, 0.25, 0.1])
def test_running_windows_equal_the_recurrence(spark, params, unit):
    rng = random.Random(7)
    rows, expected = [], {}
    for n in range(60):
        ref, opening = f"r{n}", rng.randint(-30, 120)
        rows += [stock(ref, opening * unit)] if n % 5 else []
        by_week = {}
        for t in rng.sample(range(104), rng.randint(0, 104)):
            quantities = [rng.choice([0, rng.randint(0, 40)]) for _ in range(4)]
            by_week[t] = quantities
            rows.append(flow(ref, t, *[q * unit for q in quantities]))
        if n % 5 == 0:
            opening = 0
        if n % 5 or by_week:
            expected[ref] = step(opening, by_week, 43)
    got = {}
    for r in weeks_of(spark, rows, replace(params, horizon=43)).collect():
        got[(r.ref, r.week_idx)] = (r.inventory_start, r.inventory_end, r.sales_missed)
    assert len(got) == 43 * len(expected)
    for ref, steps in expected.items():
        for t, figures in enumerate(steps):
            assert got[(ref, t)] == pytest.approx([f * unit for f in figures], abs=1e-9)
            assert [g == 0 for g in got[(ref, t)]] == [f == 0 for f in figures]


def test_refs_without_stock_or_weeks(spark, params):
    rows = [flow("a", 0, 5.0), stock("b", 3.0), flow("c", 500, 5.0), stock("d", None)]
    zero = {r.ref: r for r in oos_weeks(weeks_of(spark, rows, params)).collect()}
    assert {ref: r.oos_first for ref, r in zero.items()} == {"a": week(0), "b": None, "c": None, "d": None}
    weeks = weeks_of(spark, rows, replace(params, missing_stock="null"))
    first = {r.ref: (r.inventory_start, r.inventory_end, r.sales_missed) for r in weeks.filter("week_idx = 50").collect()}
    assert first == {"a": (None, None, None), "b": (3.0, 3.0, 0.0), "c": (None, None, None), "d": (None, None, None)}


def test_stopping_and_setting_in_again(spark, params):
    rows = [flow("a", 1, 5.0), flow("a", 2, 5.0), flow("a", 4, 5.0), flow("a", 6, 1.0)]
    oos = oos_weeks(weeks_of(spark, rows, params)).collect()[0]
    assert (oos.oos_first, oos.oos_last_onset, oos.oos_final) == (week(1), week(4), week(4))


def test_one_ref_with_most_rows_is_added_up_before_it_is_gathered(spark, params):
    params = replace(params, drop_week_53=False)
    rows = spark.range(50000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('r', id % 100) END AS ref", "id",
    ).selectExpr(
        "ref", "0 AS market_chars", f"date_add(DATE'{AS_OF}', cast(7 * (id % 104) AS int)) AS week_start",
        "1.0D AS demand", "0.0D AS inbound", "0.0D AS po_signed", "0.0D AS po_unsigned", "0.0D AS opening",
    )
    weekly = weekly_flow(rows, params)
    assert weekly.groupBy("ref").count().agg(F.max("count")).collect()[0][0] <= 104
    total = run_waterfall(dense_weeks(weekly, params), params).agg(F.sum("demand"), F.sum("sales_missed"))
    assert tuple(total.collect()[0]) == (50000.0, 50000.0)


# Impact and recommendations -------------------------------------------------------------------


def test_revenue_cover_and_totals(spark, params):
    rows = [
        flow("a", 0, 4.0), flow("a", 1, 6.0), stock("a", 5.0), flow("a", 60, 7.0), stock("b", 9.0), flow("b", 0, 3.0),
    ]
    weeks = weeks_of(spark, rows, params)
    prices = spark.createDataFrame([("a", 2.0)], "ref string, final_sales_price double")
    summary = ref_summary(weeks, params)
    got = {r.ref: r for r in oos_labels(revenue_impact(summary, prices, params)).collect()}
    a, b = got["a"], got["b"]
    assert (a.revenue_miss, a.demand_7w, a.oos_last_onset) == (10.0, 10.0, week(60))
    # The last onset lies in the next year, but its week number, 17, cuts the target year's weeks.
    assert a.revenue_miss_oos == 0.0
    assert a.days_of_cover == 6 and b.days_of_cover == (date(2000, 12, 25) - AS_OF).days - 1
    assert (b.revenue_miss, b.final_sales_price, b.oos_week_first) == (0.0, 0.0, "CW52-2000")
    totals = run_summary(summary).collect()[0]
    assert totals.asDict() == {
        "n_refs": 2, "total_demand": 20.0, "total_missed": 12.0, "demand_coverage": 40.0, "oos_count": 1,
    }


def test_target_year_other_than_the_running_one(spark):
    params = Params(AS_OF, target_year=1999)
    rows = [flow("a", 0, 4.0), flow("a", 60, 7.0)]
    row = ref_summary(weeks_of(spark, rows, params), params).collect()[0]
    assert (row.missed_target_year, row.total_missed) == (7.0, 11.0)


def test_no_demand_counts_as_covered(spark, params):
    summary = ref_summary(weeks_of(spark, [stock("a", 5.0)], params), params)
    assert run_summary(summary).collect()[0].demand_coverage == 100.0


def test_cover_counts_whole_days(spark, params):
    for first, expected in [(AS_OF, 0), (AS_OF + timedelta(1), 0), (AS_OF + timedelta(7), 6), (date(1998, 2, 1), 0)]:
        cover = days_of_cover(F.lit(first), F.lit(date(2000, 12, 25)), params)
        assert spark.range(1).select(cover).collect()[0][0] == expected


REC = {
    "market": "US", "demand_7w": 10.0, "demand_10w": 20.0, "demand_14w": 30.0, "demand_18w": 40.0, "final_sales_price": 2.0,
    "fulfillable_7d": 5.0, "at_amz_21d": 5.0, "on_the_way_to_amz_35d": 5.0, "local_market_49d": 3.0, "units_per_carton": 2,
    "otw_35p_98d": 29.0, "manufacturing_28_126d": 41.0, "manufacturing_56p_168d": 29.0,
}


@pytest.mark.parametrize(
    "changes, transfer, value, expedite, sooner",
    [
        ({}, True, 6.0, True, False),
        ({"local_market_49d": 9.0}, True, 10.0, True, False),
        ({"local_market_49d": 2.0}, False, 0.0, True, False),
        ({"market": "CA"}, True, 6.0, True, False),
        ({"market": "EU"}, False, 0.0, True, False),
        ({"market": "UK", "demand_7w": 16.0}, True, 6.0, True, False),
        ({"market": "JP"}, False, 0.0, True, False),
        ({"otw_35p_98d": 30.0}, True, 6.0, False, False),
        ({"manufacturing_28_126d": 40.0}, True, 6.0, False, False),
        ({"manufacturing_56p_168d": 30.0}, True, 6.0, True, True),
        ({"units_per_carton": None}, True, 6.0, True, False),
        ({"fulfillable_7d": None, "local_market_49d": 100.0}, True, 20.0, True, False),
    ],
)
def test_recommendations(spark, changes, transfer, value, expedite, sooner):
    row = {**REC, **changes}
    schema = ", ".join(
        f"{k} {'string' if k == 'market' else 'int' if k == 'units_per_carton' else 'double'}" for k in row
    )
    got = recommendations(spark.createDataFrame([tuple(row.values())], schema)).collect()[0]
    assert (got.to_check != "", got.to_check_value, got.expedite != "", got.pull_forward != "") == (
        transfer, value, expedite, sooner,
    )


def test_recommendations_without_stock_columns(spark):
    names = ["market", "demand_7w", "demand_10w", "demand_14w", "demand_18w", "final_sales_price"]
    df = spark.createDataFrame([tuple(REC[n] for n in names)], names)
    got = recommendations(df).collect()[0]
    assert (got.to_check, got.to_check_value, got.expedite, got.pull_forward) == ("", 0.0, "", "")


@pytest.mark.parametrize(
    "region, market, days, expected",
    [("CN", "US", 30, (30, 39, 25)), (None, "EU", None, (45, 45, 26)), ("CN", "BR", 1, (1, 39, 39)), ("XX", "JP", 1, (1, 45, 39))],
)
def test_lead_times(spark, params, region, market, days, expected):
    df = spark.createDataFrame([(region, market, days)], "shipping_region string, market string, lead_time_production_days int")
    row = lead_times(df, params).collect()[0]
    assert (row.production_days, row.route_days, row.buffer_days) == expected
    assert row.total_leadtime == sum(expected) + 45


# Whole plan and sinks -------------------------------------------------------------------------


def test_empty_sources_give_empty_results(sources, params):
    tables = sources()
    for name in extracts.EXTRACTS:
        assert extracts.extract(name, tables, params).count() == 0
    assert allocation(tables, params).count() == 0
    row = plan_allocation(tables, params)["run_summary"].collect()[0]
    assert (row.n_refs, row.demand_coverage, row.oos_count) == (0, 100.0, 0)


def test_plan_has_no_pairwise_joins_nor_python(source, sources, params):
    tables = sources(sales_plan=source("sales_plan", plan_row()))
    plan = allocation(tables, params)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in plan
    weeks = with_dates(run_waterfall(dense_weeks(weekly_flow(
        plan_rows(tables), params), params), params), params)
    summary = ref_summary(weeks, params)._jdf.queryExecution().executedPlan().toString()
    # One shuffle adds up per week, one brings the weeks of a ref together; nothing after that.
    assert summary.count("Exchange hashpartitioning") == 2


def plan_rows(tables):
    rows = tables["sales_plan"].selectExpr("sku AS ref", "0 AS market_chars", "date AS week_start", "quantity AS demand")
    return rows.selectExpr("*", *[f"cast(NULL AS double) AS {n}" for n in (*FLOWS[1:], "opening")])


def test_wide_layout(spark, params):
    rows = [flow("a", 0, 4.0), flow("b", 1, 6.0), stock("b", 2.0)]
    params = replace(params, horizon=3)
    weeks = weeks_of(spark, rows, params)
    one = sinks.wide_weekly(weeks, params, ["sales_missed"])
    assert one.columns == ["ref", "CW10-1998_sales_missed_w", "CW11-1998_sales_missed_w", "CW12-1998_sales_missed_w"]
    assert sorted(tuple(r) for r in one.collect()) == [("a", 4.0, 0.0, 0.0), ("b", 0.0, 4.0, 0.0)]
    two = sinks.wide_weekly(weeks, params, ["demand", "inventory_start"])
    assert two.columns[1:3] == ["CW10-1998_demand", "CW10-1998_inventory_start"]
    gaps = sinks.wide_weekly(weeks.filter("ref <> 'a' OR week_idx = 0"), params, ["demand", "po_signed"])
    assert [r["CW12-1998_demand"] for r in gaps.collect()] == [0.0, 0.0]


def test_written_results(spark, params, tmp_path):
    weeks = weeks_of(spark, [flow("a", 0, 4.0)], params)
    stage = sinks.write_stage(weeks, str(tmp_path), "weeks", AS_OF)
    assert stage.count() == 104 and (tmp_path / "run_date=1998-03-02/debug/weeks").is_dir()
    sinks.write_debug({"weeks": weeks}, str(tmp_path / "again"), AS_OF)
    summary = run_summary(ref_summary(stage, params))
    path = sinks.write_result(summary, str(tmp_path), datetime(2024, 1, 2, 3, 4, 5), ["n_refs"])
    assert path.endswith("inventory_allocation_20240102_030405")
    back = spark.read.option("header", True).csv(path)
    assert back.columns == summary.columns and back.collect()[0].n_refs == "1"


def test_allocation_columns(source, sources, params):
    tables = sources(sales_plan=source("sales_plan", plan_row()))
    got = allocation(tables, params)
    assert got.columns == ALLOCATION
    row = got.collect()[0]
    assert (row.ref, row.market, row.oos_week_first, row.total_leadtime) == ("LUS", "US", "CW14-1998", 45 + 45 + 25 + 45)
    given = {**tables, "route_leadtime": tables["po_status"].sparkSession.sql(
        "SELECT 'CN' AS departure, 'US' AS arrival, 1 AS days")}
    assert allocation(given, params).count() == 1


def test_whole_run_from_tables_to_files(spark, source, sources, tmp_path, capsys):
    from shelfcast.__main__ import main

    tables = sources(sales_plan=source("sales_plan", plan_row()))
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / "in" / name))
    main(["--sources", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--as-of", AS_OF.isoformat()])
    assert capsys.readouterr().out == "refs planned: 1; demand covered: 0.0%; out of stock: 1\n"
    result = next((tmp_path / "out").glob("inventory_allocation_*"))
    rows = spark.read.option("header", True).csv(str(result)).collect()
    assert [(r.ref, r["CW14-1998_sales_missed_w"], r["CW20-1998_sales_missed_w"]) for r in rows] == [("LUS", "5.0", "0.0")]
    stages = {path.name for path in (tmp_path / "out" / "run_date=1998-03-02" / "debug").iterdir()}
    assert stages == {
        "order_index", "newest_shipments", "order_lines", "weekly_flow", "sales_missed", "per_ref", "left_out", "run_summary",
    }
    totals = spark.read.parquet(str(tmp_path / "out" / "run_date=1998-03-02" / "debug" / "run_summary")).collect()
    assert [row.asDict() for row in totals] == [
        {"n_refs": 1, "total_demand": 30.0, "total_missed": 30.0, "demand_coverage": 0.0, "oos_count": 1}
    ]


def test_run_takes_routes_and_rules_from_files(spark, source, sources, tmp_path, capsys):
    from shelfcast.__main__ import main

    tables = sources(sales_plan=source("sales_plan", plan_row()))
    for name, table in tables.items():
        if name != "pipeline_stock":
            table.write.parquet(str(tmp_path / "in" / name))
    (tmp_path / "dims").mkdir()
    (tmp_path / "dims" / "port_buffer.csv").write_text("wh_type,location,days\nAMZ,GB2,3\n")
    rules = tmp_path / "rules.json"
    rules.write_text('{"marketplace_mappings": {"US": "GB2"}, "signed_stages": ["s"], "unsigned_stages": ["u"],'
                     ' "po_splitting": {"po_processing_time": 1, "default_lead_time_days": 2}}')
    main(["--sources", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--as-of", AS_OF.isoformat(),
          "--without", "pipeline_stock", "--dimensions", str(tmp_path / "dims"), "--rules", str(rules), "--debug"])
    capsys.readouterr()
    row = spark.read.option("header", True).csv(str(next((tmp_path / "out").glob("inventory_allocation_*")))).collect()[0]
    # Production 2, route 45, buffer of an unknown market 39, processing 1, safety 30.
    assert (row.ref, row.market, row.total_leadtime) == ("LGB2", "GB2", str(2 + 45 + 39 + 1 + 30))
    stages = {path.name for path in (tmp_path / "out" / "run_date=1998-03-02" / "debug").iterdir()}
    assert set(extracts.EXTRACTS) <= stages


def test_summary_of_written_weeks_needs_no_window(spark, params, tmp_path):
    weeks = weeks_of(spark, [flow("a", 0, 4.0), flow("b", 60, 6.0), stock("b", 2.0)], params)
    written = sinks.write_stage(with_oos_marks(weeks), str(tmp_path), "weeks", AS_OF, by="ref")
    summary = ref_summary(written, params, ["sales_missed"])
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    plain = ref_summary(weeks, params)
    assert sorted(summary.select(plain.columns).collect()) == sorted(plain.collect())
    wide = sinks.wide_weekly(weeks, params, ["sales_missed"])
    assert sorted(summary.select([f"`{c}`" for c in wide.columns]).collect()) == sorted(wide.collect())


def test_registered_reports_are_not_sorted(source, sources, params):
    tables = sources(sales_plan=source("sales_plan", plan_row()))
    for name in extracts.REPORT_ORDER:
        plan = extracts.extract(name, tables, params)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan


def test_weeks_of_written_flows_need_no_shuffle(spark, params, tmp_path):
    rows = [flow("a", 0, 4.0), flow("b", 60, 6.0), stock("b", 2.0), stock("c", 1.0)]
    weekly = weekly_flow(spark.createDataFrame(rows, FLOW_SCHEMA), params)
    written = sinks.write_stage(weekly, str(tmp_path), "weekly_flow", AS_OF, by="ref", spread=True)
    summary = ref_summary(waterfall_of(written, params), params)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange hashpartitioning" not in plan
    plain = ref_summary(weeks_of(spark, rows, params), params)
    assert sorted(summary.collect()) == sorted(plain.collect())
    # A second run of the day takes the place of the first.
    again = sinks.write_stage(weekly.filter("ref = 'a'"), str(tmp_path), "weekly_flow", AS_OF, by="ref", spread=True)
    assert [r.ref for r in again.select("ref").distinct().collect()] == ["a"]


def test_quantities_add_up_exactly(spark, params):
    rows = [flow("a", 0, 0.1), flow("a", 0, 0.2), flow("a", 1, 0.000001), stock("a", 0.3)]
    weeks = {r.week_idx: r for r in weeks_of(spark, rows, params).collect()}
    assert (weeks[0].demand, weeks[0].inventory_end, weeks[0].sales_missed) == (0.3, 0.0, 0.0)
    assert (weeks[1].demand, weeks[1].sales_missed) == (0.000001, 0.000001)
    # What has more decimals than are kept is rounded, and does not fail the run.
    assert weeks_of(spark, [flow("a", 0, 0.0000004)], params).agg(F.sum("demand")).collect()[0][0] == 0.0


def test_decimals_of_a_source_are_all_kept(spark, params):
    names = [*FLOWS, "opening"]
    exact = spark.createDataFrame([flow("a", 0, 1.0), flow("a", 0, 1.0), stock("a", 1.0)], FLOW_SCHEMA)
    tiny = {n: (F.col(n).cast("decimal(10,9)") * F.lit("0.000000001").cast("decimal(10,9)")).cast("decimal(18,9)") for n in names}
    weekly = weekly_flow(exact.withColumns(tiny), params)
    assert weekly.schema["demand"].dataType.scale == 9
    first = waterfall_of(weekly, params).filter("week_idx = 0").collect()[0]
    assert (first.demand, first.inventory_start, first.sales_missed) == (2e-9, 1e-9, 1e-9)


def test_units_left_out_by_reason(source, sources, params):
    tables = sources(sales_plan=source("sales_plan", plan_row(), plan_row(date=date(1998, 12, 1), quantity=310.0)))
    rows = {r.reason: r.demand for r in left_out(tables, params).collect()}
    # Of the 31 days of December 1998 the last four are in week 53, which the calendar leaves out.
    assert rows == {"outside the planned weeks": 40.0}
    assert left_out(tables, replace(params, drop_week_53=False)).count() == 0


def test_orders_in_stages_of_no_class_are_left_out(source, sources, params):
    status = [{"document_number": "D", "line_id": line, "current_status": text} for line, text in (("1", "odd"), ("2", None))]
    lines = [po(line_id=line, po_line_key=line) for line in "123"]
    master = [{"sku": "s", "listing_id": x, "snapshot_date": date(1998, 3, 1)} for x in ("M1", "M2")]
    tables = sources(po_lines=source("po_lines", *lines), po_status=source("po_status", *status), product_master=source("product_master", *master))
    for fan_out in (False, True):  # a line without a class counts once, whatever listings its sku has
        settings = replace(params, fan_out_master=fan_out)
        weekly = weekly_flow(flow_rows(tables, settings), settings)
        assert [(r.reason, r.po_other, r.demand) for r in left_out_of(weekly).collect()] == [("stage of no class", 240.0, 0.0)]
        assert waterfall_of(weekly, settings).count() == 0


def order_tables(source, sources):
    """Orders and shipments of several snapshots, undated ones, ties, internal vendors and unknown keys among them."""
    rng, days = random.Random(3), [date(1998, 2, 1), date(1998, 2, 8), date(1998, 2, 15)]
    documents = ["D1", "D2", "D3", None]
    lines = [
        po(
            document_number=documents[n % 4], line_id=rng.choice(["1", "2", None]), sku=rng.choice(["s", "t", "u"]),
            po_line_key=rng.choice(["K", "J"]), snapshot_date=rng.choice([*days, None] if n % 4 == 2 else days), vendor=rng.choice(["V", "W", None]),
            vendor_category=rng.choice(["Manufacturers", "Manufacturers", "Intercompany", None]),
            final_status=rng.choice(["Open", "Open", "Closed", None]), memo=rng.choice([None, "a B2B order"]),
            ordered_at=rng.choice(["1998-01-01", "1998-01-02", "n/a", None]), quantity=rng.choice([100, 0, 200]),
        )
        for n in range(240)
    ]
    shipped = [shipment_line(shipment_number=rng.choice("STU"), po=rng.choice(["D1", "D2"]), po_line_key=rng.choice("KJ"), sku=rng.choice("st")) for _ in range(60)]
    headers = [{"shipment_number": rng.choice("STV"), "market_place": "US", "snapshot_date": rng.choice(days)} for _ in range(12)]
    status = [{"document_number": "D1", "line_id": rng.choice("12"), "current_status": f"stage {n}"} for n in range(4)]
    mapped = [{"sku": sku} for sku in "stu"]
    return sources(
        po_lines=source("po_lines", *lines), shipment_lines=source("shipment_lines", *shipped), po_status=source("po_status", *status),
        shipment_headers=source("shipment_headers", *headers), sku_vendor_map=source("sku_vendor_map", *mapped),
    )


@pytest.mark.parametrize("raw_join", [False, True])
def test_newest_orders_written_once_say_what_the_history_says(source, sources, params, raw_join):
    params = replace(params, raw_join=raw_join)
    tables = order_tables(source, sources)
    kept = {}

    def keep(df, name):
        kept[name] = sinks.keep_shared(df, name)
        return kept[name]

    once = staged(tables, params, keep)
    assert set(kept) == {"order_index", "newest_shipments", "order_lines"}
    for build in (extracts.open_po_lines, extracts.inbound_lines, extracts.vendor_choice, flows.open_po_with_origin):
        plain, again = build(tables, params), build(once, params)
        assert plain.count() > 0 and plain.columns == again.columns
        assert sorted(map(repr, again.collect())) == sorted(map(repr, plain.collect())), build.__name__
        assert "po_lines" not in again._jdf.queryExecution().optimizedPlan().toString()


def test_allocation_reads_each_source_at_most_once_or_twice(spark, params):
    tables = TestdataSources(spark, "/root/testdata/sf0.001")
    plan = allocation(staged(tables, params, sinks.keep_shared), params)._jdf.queryExecution().executedPlan()
    # Subqueries are printed with every filter that uses them; a scan's columns tell it apart.
    scans = {line.split("FileScan")[1].split("]")[0] for line in plan.toString().splitlines() if "lineitem.parquet" in line}
    assert len(scans) <= 8
    once = staged_allocation(tables, params, sinks.keep_shared)
    assert once._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") <= 3


def test_reports_are_written_in_order_file_by_file(spark, source, sources, params, tmp_path):
    rng = random.Random(5)
    plans = [plan_row(sku=f"s{rng.randrange(50):02}", market=rng.choice(["US", "UK"]), quantity=float(rng.randrange(90))) for _ in range(400)]
    tables = sources(sales_plan=source("sales_plan", *plans))
    sinks.write_debug({"demand_plan": extracts.report("demand_plan", tables, params).repartitionByRange(4, "sku", "market", "quantity")
                       .sortWithinPartitions("sku", "market", "quantity")}, str(tmp_path), AS_OF)
    sinks.write_debug({"plain": extracts.report("demand_plan", tables, params)}, str(tmp_path), AS_OF)
    for name in ("demand_plan", "plain"):
        files = sorted((tmp_path / f"run_date={AS_OF}" / "debug" / name).glob("part-*.parquet"))
        rows = [tuple(r[c] for c in ("sku", "market", "quantity")) for f in files for r in pq.read_table(f).to_pylist()]
        assert rows == sorted(rows) and len(rows) > 50


def test_narrow_buffers_belong_to_the_narrow_routes(spark, params):
    lines = spark.sql("SELECT 'CN' AS shipping_region, 'CA' AS market, 'AMZ' AS wh_type, DATE'1998-03-02' AS crd")
    days = [flows.po_expected_dates(lines, replace(params, po_routes=r)).collect()[0].buffer_days for r in ("all", "po")]
    assert days == [25, 39]


def test_lead_time_buffer_by_market(spark, params):
    refs = spark.createDataFrame([("UK", "UK"), ("BR", "CN"), ("US", None)], "market string, shipping_region string")
    got = lead_times(refs, replace(params, lead_time_buffers="market")).collect()
    assert {r.market: r.buffer_days for r in got} == {"UK": 0, "BR": 36, "US": 39}


def test_vendor_rows_that_repeat_are_removed(source, sources, params):
    rows = [{"vendor_id": v, "vendor_name": n} for v, n in (("V1", "b"), ("V1", "a"), ("V2", None), ("V2", "c"))]
    got = flows.dedupe_vendor(sources(vendor_master=source("vendor_master", *rows)), params).collect()
    assert sorted((r.vendor_id, r.vendor_name) for r in got) == [("V1", "a"), ("V2", "c")]


@pytest.mark.parametrize("missing_stock", ["zero", "null"])
def test_windows_see_filled_weeks_alone(spark, params, missing_stock):
    params = replace(params, missing_stock=missing_stock)
    rng = random.Random(11)
    rows = [stock("short", -3.0), stock("idle", 2.0), flow("late", 103, 9.0), flow("outside", 500, 1.0)]
    for n in range(40):
        rows += [stock(f"r{n}", float(rng.randint(-5, 30)))] if n % 4 else []
        rows += [flow(f"r{n}", t, *[float(rng.randint(0, 9)) for _ in range(4)]) for t in rng.sample(range(104), rng.randint(1, 30))]
    weekly = weekly_flow(spark.createDataFrame(rows, FLOW_SCHEMA), params)
    weeks, filled = waterfall_of(weekly, params), filled_weeks_of(weekly, params)
    refs = weekly.select("ref").distinct().count()
    assert dense_weeks(weekly, params).count() <= len(rows) + refs and weeks.count() == 104 * refs
    marked = with_oos_marks(weeks)  # by a window over all weeks
    assert sorted(map(repr, waterfall_of(weekly, params, marked=True).select(marked.columns).collect())) == sorted(map(repr, marked.collect()))
    assert sorted(map(repr, ref_summary(filled, params).collect())) == sorted(map(repr, ref_summary(marked, params).collect()))
    assert sorted(map(repr, oos_weeks(filled).collect())) == sorted(map(repr, oos_weeks(weeks).collect()))
    wide = [sinks.wide_weekly(kind, params, ["sales_missed"]).collect() for kind in (filled, weeks)]
    assert sorted(map(repr, wide[0])) == sorted(map(repr, wide[1]))


def test_lines_that_expect_nothing_stay_out_of_the_shuffle(source, sources, params):
    units = [30, 0, None, 5]
    lines = [shipment_line(quantity_expected=n, po_line_key=key) for n, key in zip(units, "KKKL", strict=True)]
    tables = sources(
        po_lines=source("po_lines", po(), po(line_id="2", po_line_key="M")),
        shipment_lines=source("shipment_lines", *lines), shipment_headers=source("shipment_headers", header()),
    )
    orders = extracts.open_orders(tables, params)
    assert sorted((r.line_id, r.shipped, r.leftover_quantity) for r in orders.fillna(0, ["shipped"]).collect()) == [("1", 30, 70), ("2", 0, 80)]
    assert "NOT (quantity_expected" in orders._jdf.queryExecution().analyzed().toString()


def test_weeks_grow_over_all_shuffle_partitions(spark, source, sources, params):
    monthly = source("sales_plan", plan_row()).selectExpr("sku AS ref", "date", "quantity")
    for rows in (flows.spread_months(monthly, ["ref"]), filled_weeks(sources(), params)):
        assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()


def test_allocation_in_two_plans(source, sources, params):
    tables, kept = sources(sales_plan=source("sales_plan", plan_row())), []

    def keep(df, name):
        kept.append(name)
        return sinks.keep_shared(df, name)

    once, twice = allocation(tables, params), allocation(tables, params, keep)
    assert kept == ["weekly_flow"] and "sales_plan" not in twice._jdf.queryExecution().optimizedPlan().toString()
    assert once.count() > 0 and sorted(map(repr, twice.collect())) == sorted(map(repr, once.collect()))


def test_parts_are_dealt_out_before_they_become_many_rows(spark):
    tables = TestdataSources(spark, "/root/testdata/sf0.001")
    for name in ("price_benchmarks", "product_master", "product_catalog"):
        plan = tables[name]._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate") < plan.index("REPARTITION_BY_COL"), name


def test_weeks_of_a_ref_are_gathered_in_no_list(spark, params):
    rows = [stock("idle", 2.0), flow("late", 40, 9.0), flow("late", 5, 1.0), flow("first", 0, 4.0), flow("outside", 500, 1.0)]
    dense = dense_weeks(weekly_flow(spark.createDataFrame(rows, FLOW_SCHEMA), params), params)
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "collect_list" not in plan
    got = sorted((r.ref, r.week_idx, r.opening // 10**6, r.demand // 10**6) for r in dense.collect())
    assert got == [("first", 0, 0, 4), ("idle", 0, 2, 0), ("late", 0, 0, 0), ("late", 5, 0, 1), ("late", 40, 0, 9), ("outside", 0, 0, 0)]


def test_stage_of_an_order_line_is_shuffled_once(spark, params):
    tables = TestdataSources(spark, "/root/testdata/sf0.001")
    status = extracts.newest_status(tables, params)
    assert status._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    keys = tables.given("lineitem").select("l_orderkey", "l_linenumber").distinct().count()
    assert tables["po_status"].count() == status.count() == keys


def test_sorted_and_growing_rows_are_dealt_to_many_tasks(spark, source, sources, params):
    monthly = source("sales_plan", plan_row()).selectExpr("sku AS ref", "date", "quantity")
    tables = TestdataSources(spark, "/root/testdata/sf0.001")
    for rows in (flows.spread_months(monthly, ["ref"]), filled_weeks(sources(), params), tables["po_status"]):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        dealt = [int(n) for n in re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", plan)]
        assert dealt and min(dealt) >= 192, plan


def test_one_sort_serves_all_windows_of_the_filled_weeks(spark, params):
    weekly = weekly_flow(spark.createDataFrame([stock("idle", 2.0), flow("late", 5, 1.0)], FLOW_SCHEMA), params)
    dense = dense_weeks(weekly, params)
    assert dense._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    weeks = with_dates(run_waterfall(dense, params), params)
    assert weeks.filter("week_idx = 5").select("ref", "inventory_end").orderBy("ref").collect() == [("idle", 2.0), ("late", 0.0)]


def test_allocation_writes_the_rows_of_its_flows_by_plans_of_their_own(source, sources, params):
    tables, kept = sources(sales_plan=source("sales_plan", plan_row())), []

    def keep(df, name):
        kept.append(name)
        return sinks.keep_shared(df, name)

    once, apart = allocation(tables, params), allocation(tables, params, keep, keep)
    assert kept == ["open_orders", "order_rows", "inbound_rows", "weekly_flow"]
    assert once.count() > 0 and sorted(map(repr, apart.collect())) == sorted(map(repr, once.collect()))


def test_staged_allocation_keeps_the_columns_of_order_lines_that_it_looks_at(spark, params):
    tables, kept = TestdataSources(spark, "/root/testdata/sf0.001"), {}

    def keep(df, name):
        kept[name] = df.columns
        return sinks.keep_shared(df, name)

    staged_allocation(tables, params, keep)
    more = {"of_document", "shipped", "current_status"}
    assert set(kept["order_lines"]) == set(kept["newest_lines"]) | more == {*PLANNED_LINE} | more
    assert len(PLANNED_LINE) < len(tables["po_lines"].columns) * 0.6


def test_kept_tables_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles().iterator()
        names = set()
        while found.hasNext():
            names.add(found.next().getName())
        return {name for name in names if name.startswith("shuffle_")}

    before = files()
    kept = sinks.keep_shared(spark.range(1000).repartition(7, "id"), "rows")
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert kept.count() == 1000
