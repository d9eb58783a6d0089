from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.columns import MARKET_MAP
from shelfcast.operators import joins
from shelfcast.operators.latest import global_latest, latest_row, latest_snapshot
from shelfcast.sources import dimensions


def test_latest_snapshot_keeps_ties_and_puts_undated_rows_first(spark):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 8)
    rows = [("a", d1, 1), ("a", d2, 2), ("a", d2, 3), ("b", d1, 4), ("c", None, 5), ("c", d2, 6), (None, d1, 7), (None, d2, 8)]
    df = spark.createDataFrame(rows, "k string, snapshot_date date, v int")
    assert sorted(r.v for r in latest_snapshot(df, ["k"]).collect()) == [2, 3, 4, 5, 8]
    assert latest_snapshot(df, ["k"]).columns == df.columns


def test_latest_snapshot_equals_a_rank_when_one_key_holds_most_rows(spark):
    df = spark.range(20000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 0 ELSE id % 50 END AS k", "id",
        "date_add(DATE'2024-01-01', cast(id % 7 AS int)) AS snapshot_date",
    )
    ranked = df.selectExpr("*", "dense_rank() OVER (PARTITION BY k ORDER BY snapshot_date DESC) AS r")
    expected = {r.id for r in ranked.filter("r = 1").collect()}
    got = [r.id for r in latest_snapshot(df, ["k"]).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_latest_row_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id")
    latest = latest_row(df, ["k"], [F.desc_nulls_first("id")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r.k, r.id) for r in latest.collect()) == [(0, 999), (1, 997), (2, 998)]


def test_global_latest(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 1), (date(2024, 1, 2), 2)], "snapshot_date date, v int")
    assert [r.v for r in global_latest(df, df).collect()] == [2]
    assert global_latest(df.limit(0), df.limit(0)).count() == 0


def test_audit_counts_fan_out(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    joined, audit = joins.audited_join(left, right, ["k"])
    assert joined.count() == 4
    assert audit.collect()[0].asDict() == {"left_rows": 3, "result_rows": 4, "repeated_keys": 1}


def test_audit_joins_no_rows(spark):
    left = spark.createDataFrame([(1,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    for how, rows in (("left", 2), ("inner", 1)):
        audit = joins.audited_join(left, right, ["k"], how)[1]
        assert audit.collect()[0].result_rows == rows == left.join(right, ["k"], how).count()
    # A key that repeats 20,000 times on both sides would make 400 million rows.
    hot = spark.range(20_000).selectExpr("1 AS k", "id")
    assert joins.audited_join(hot, hot, ["k"])[1].collect()[0].result_rows == 400_000_000
    empty = left.limit(0)
    assert joins.audited_join(empty, right, ["k"])[1].collect()[0].asDict() == {
        "left_rows": 0, "result_rows": 0, "repeated_keys": 0}
    with pytest.raises(ValueError, match="how"):
        joins.audited_join(left, right, ["k"], "full")


def whole_lists(pieces):
    out = {}
    for row in sorted(pieces.collect(), key=lambda r: (r.v, r.piece)):
        out.setdefault(row.k, []).append(row.l)
    return {k: ", ".join(texts) for k, texts in out.items()}


def test_lists_are_ordered_and_keep_repeats(spark):
    rows = [("a", "y"), ("a", "x"), ("a", "y"), ("a", None), (None, "z"), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    assert whole_lists(joins.value_pieces(df, ["k"], "v", "l")) == {"a": "x, y, y", None: "z"}


def test_long_lists_come_out_whole_in_bounded_pieces(spark):
    df = spark.range(25_000).selectExpr("'a' AS k", "CASE WHEN id < 20000 THEN 'Amazon' ELSE concat('s', id) END AS v")
    pieces = joins.value_pieces(df, ["k"], "v", "l")
    values = ["Amazon"] * 20_000 + [f"s{i}" for i in range(20_000, 25_000)]
    assert whole_lists(pieces) == {"a": ", ".join(values)}
    assert max(len(row.l) for row in pieces.collect()) == 8 * joins.PIECE_VALUES - 2


def test_route_lookup(spark):
    df = spark.createDataFrame([("CN", "US"), ("CN", "XX"), (None, "US")], "d string, a string")
    routes = dimensions.route_leadtime(spark)
    got = joins.lookup_route(df, routes, F.col("d"), F.col("a"), 45)
    assert [(r.d, r.a, r.route_days) for r in got.collect()] == [("CN", "US", 39), ("CN", "XX", 45), (None, "US", 45)]


def test_buffer_lookup(spark):
    df = spark.createDataFrame([("3PL", "US"), ("AMZ", "UK"), ("AMZ", "BR"), (None, "EU"), ("AMZ", "JP")], "w string, m string")
    market = F.col("m")
    got = joins.lookup_buffer(df, dimensions.port_buffer(spark), F.col("w"), market, dimensions.market_buffer(market))
    assert [r.buffer_days for r in got.collect()] == [39, 22, 36, 40, 39]


def test_dimension_sizes(spark):
    sizes = {
        "all": 61, "po": 10, "inbound": 6, "legacy": 70,
    }
    assert {name: dimensions.route_leadtime(spark, name).count() for name in sizes} == sizes
    assert dimensions.port_buffer(spark).count() == 12
    assert dimensions.port_buffer(spark, dimensions.PO_BUFFERS).count() == 6
    assert dimensions.asia_country(spark).count() == 8
    regions = {r.country: r.region for r in dimensions.country_region(spark).collect()}
    assert len(regions) == 58 and regions["China"] == "CN" and regions["Türkiye"] == "EU"
    classes = [r.klass for r in dimensions.stage_class(spark).collect()]
    assert (classes.count("signed"), classes.count("unsigned")) == (12, 13)


def test_dimension_files(spark, tmp_path):
    path = tmp_path / "routes.csv"
    path.write_text("from,to,days,id\n CN , US ,39,CNUS\nNA,,7,\n")
    got = [tuple(r) for r in dimensions.read_route_leadtime(spark, str(path)).collect()]
    assert got == [("CN", "US", 39, "CNUS"), ("NA", "", 7, "")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        dimensions.read_asia_country(spark, str(tmp_path / "none.csv")).count()


def test_rules_document(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(
        '{"marketplace_mappings": {"DE": "EU", "GB": "UK"},\n "signed_stages": ["s1", "s2"],\n "unsigned_stages": ["u1"],'
        ' "po_splitting": {"po_processing_time": 9}}'
    )
    stages, rules = dimensions.read_rules(spark, str(path))
    assert sorted((r.stage, r.klass) for r in stages.collect()) == [("s1", "signed"), ("s2", "signed"), ("u1", "unsigned")]
    assert rules.marketplace_mappings.items() <= MARKET_MAP.items()
    assert (rules.po_processing_time, rules.min_units_per_carton) == (9, None)
