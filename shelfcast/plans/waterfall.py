"""Stock waterfall per ref over the planning weeks, and the weeks in which stock runs out."""

from __future__ import annotations

from collections import ChainMap
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfcast.functions.columns import col_or, floor_at_zero
from shelfcast.functions.weeks import week_calendar
from shelfcast.params import Params
from shelfcast.plans import extracts, flows
from shelfcast.plans.extracts import Sources
from shelfcast.plans.orders import Keep
from shelfcast.session import spread_partitions

FLOWS = ["demand", "inbound", "po_signed", "po_unsigned"]
MEASURES = [*FLOWS, "opening", "po_other"]


def left_out(sources: Sources, params: Params) -> DataFrame:
    """Units of each flow that the plan leaves out, by reason; a row for every reason."""
    return left_out_of(weekly_flow(flow_rows(sources, params), params))


def left_out_of(weekly: DataFrame) -> DataFrame:
    """What weekly flows say of units that are left out, by reason; reads no source again."""
    rows = weekly.filter("reason IS NOT NULL").groupBy("reason")
    rows = rows.agg(*[F.sum(name).cast("double").alias(name) for name in MEASURES])
    return rows.filter(F.coalesce(*MEASURES).isNotNull()).na.fill(0.0)


def flow_rows(sources: Sources, params: Params, keep: Keep | None = None) -> DataFrame:
    """Rows of all flows and of the opening stock, one measure filled in each.

    Rows without a ref are not planned; orders in a stage of no class are among them. With `keep`, open orders,
    the rows of orders and those of shipments are written one after another, and read back.
    """
    if keep is None:
        keep = lambda df, name: df
    elif "order_lines" not in sources:
        lines = extracts.open_orders(sources, params).select(*flows.OPEN_ORDER)
        sources = ChainMap({"open_orders": keep(lines, "open_orders")}, sources)
    orders = keep(flows.po_contributions(sources, params, every=True), "order_rows")
    inbound = keep(flows.inbound_contributions(sources, params), "inbound_rows")
    by_class = {"po_signed": F.col("klass") == "signed", "po_unsigned": F.col("klass") == "unsigned",
                "po_other": F.col("klass").isNull()}
    keys = ["ref", "market_chars", "week_start"]
    stock = flows.opening_contributions(sources, params).select(
        "ref", F.length("market").alias("market_chars"), F.lit(None).cast("date").alias("week_start"),
        F.col("total_inventory").alias("opening"),
    )
    parts = [
        flows.demand_contributions(sources, params).select(*keys, F.col("quantity").alias("demand")),
        inbound.select(*keys, F.col("quantity").alias("inbound")),
        orders.select(*keys, *[F.when(own, F.col("quantity")).alias(name) for name, own in by_class.items()]),
        stock,
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def kept_decimals(contributions: DataFrame, params: Params) -> int:
    """Decimals that the plan keeps: those of the DECIMAL columns, and the parameter's for others."""
    kinds = [field.dataType for field in contributions.schema if field.name in MEASURES]
    return max([params.quantity_decimals, *(kind.scale for kind in kinds if isinstance(kind, T.DecimalType))])


def _whole(value: Column, kind: T.DataType, decimals: int) -> Column:
    """The quantity as a whole number of the smallest unit kept, which sums exactly."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.round(value * 10.0**decimals).cast("long")
    return (value * 10**decimals).cast("long")


def weekly_flow(contributions: DataFrame, params: Params) -> DataFrame:
    """Flows added up per ref and planning week, as exact decimals.

    A ref keeps a row without a week for its opening stock, and one for what lies outside the calendar,
    so that every ref of any flow is planned. What is left out is kept by reason; rows without a ref
    are one row for each reason.
    """
    calendar = week_calendar(contributions.sparkSession, params)
    planned = calendar.filter(F.col("week_idx") < params.horizon).select("week_idx", "week_start")
    other = col_or(contributions, "po_other", None).cast("double")
    reason = (
        F.when(F.col("ref").isNull(), F.when(other.isNotNull(), "stage of no class").otherwise("no ref"))
        .when(F.col("opening").isNotNull() | F.col("week_idx").isNotNull(), None)
        .when(F.col("week_start").isNull(), "no week")
        .otherwise("outside the planned weeks")
    )
    decimals = kept_decimals(contributions, params)
    unit = F.lit(Decimal(1).scaleb(-decimals)).cast(f"decimal({decimals + 1},{decimals})")
    kinds = {field.name: field.dataType for field in contributions.schema} | {"po_other": T.DoubleType()}
    rows = contributions.withColumn("po_other", other)
    sums = {
        name: (F.sum(_whole(F.col(name), kinds[name], decimals)).cast("decimal(19,0)") * unit).cast(f"decimal(19,{decimals})")
        for name in MEASURES
    }
    # The calendar has at most 157 rows. Adding up per week first keeps what reaches a ref small.
    rows = rows.join(F.broadcast(planned), "week_start", "left")
    week = F.when(F.col("ref").isNotNull(), F.col("week_idx"))
    rows = rows.withColumns({"reason": reason, "week_idx": week})
    return rows.groupBy("ref", "week_idx", "reason").agg(
        F.min("market_chars").alias("market_chars"), *[total.alias(name) for name, total in sums.items()]
    )


def dense_weeks(weekly: DataFrame, params: Params) -> DataFrame:
    """The planning weeks of every ref, quantities as whole numbers of the smallest unit kept.

    Empty weeks are not rows: a row stands for its week and for the empty ones up to the ref's next row.
    The first week always is a row: where a ref has none, its first row brings one along. The rows stay on
    the partition of their ref, where the windows of the waterfall then run without another shuffle, and
    nothing of a ref is gathered in a list. Totals of a ref take the order of its weeks too, so that one sort
    serves all windows here.
    """
    unit = 10 ** weekly.schema["demand"].dataType.scale
    whole = lambda value: (value * unit).cast("long")
    in_order = Window.partitionBy("ref").orderBy(F.asc_nulls_last("week_idx"))
    ref = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opening = whole(F.sum("opening").over(ref))
    if params.missing_stock == "zero":
        opening = F.coalesce(opening, F.lit(0).cast("long"))
    own, week = F.col("own"), F.col("week_idx")
    is_first = F.row_number().over(in_order) == 1
    lacks_first = is_first & F.coalesce(week != 0, F.lit(True))
    rows = F.array(F.when(lacks_first, F.lit(False)), F.when(week < params.horizon, F.lit(True)))
    return (
        weekly.filter("ref IS NOT NULL")
        .withColumns({"market_chars": F.min("market_chars").over(ref), "opening": opening, "rows": rows})
        .withColumn("own", F.explode(F.array_compact("rows")))
        .select(
            "ref", "market_chars", "opening", F.when(own, week).otherwise(0).alias("week_idx"),
            *[whole(F.when(own, F.coalesce(n, F.lit(0))).otherwise(0)).alias(n) for n in FLOWS],
        )
    )


def run_weeks(dense: DataFrame, params: Params) -> DataFrame:
    """Start, end and lost sales of every row of `dense_weeks`, and where the empty weeks after it end.

    Stock ends a week at start + supply - demand, but never below zero. The running total of all
    net flows gives the same once the deepest shortfall so far is added back, which turns the
    week-by-week recurrence into running windows over one sort. An empty week changes nothing, so the
    windows pass over it.

    Purchase orders do not add to the stock of the first week, and unsigned ones never cover lost
    sales of the week they arrive in.

    `sets_in` marks lost sales that set in anew: after a week without any, against a demand above one unit.
    """
    week = Window.partitionBy("ref").orderBy("week_idx")
    so_far = week.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    orders = F.when(F.col("week_idx") > 0, F.col("po_signed") + F.col("po_unsigned")).otherwise(0)
    running = F.col("opening") + F.sum(F.col("inbound") + orders - F.col("demand")).over(so_far)
    shortfall = F.least(F.min("running").over(so_far), F.lit(0))
    start = F.lag("ending").over(week)
    start = F.when(F.col("week_idx") == 0, F.col("opening")).otherwise(start)
    missed = floor_at_zero(
        F.col("demand") - F.col("starting") - F.col("po_signed") - F.col("inbound")
    )
    # Nothing is lost in an empty week but the first, which is a row.
    before = F.when(F.lag("week_idx").over(week) < F.col("week_idx") - 1, 0).otherwise(F.lag("missed").over(week))
    unit = float(10**params.quantity_decimals)
    return (
        dense.withColumn("running", running)
        .withColumn("ending", F.col("running") - F.when(F.col("running").isNotNull(), shortfall))
        .withColumn("starting", start)
        .withColumn("missed", missed)
        .select(
            "ref", "market_chars", "week_idx",
            *[(F.col(name) / unit).alias(name) for name in FLOWS],
            (F.col("starting") / unit).alias("inventory_start"),
            (F.col("ending") / unit).alias("inventory_end"),
            (F.col("missed") / unit).alias("sales_missed"),
            F.lead("week_idx", 1, params.horizon).over(week).alias("until"),
            ((before == 0) & (F.col("missed") > 0) & (F.col("demand") / unit > 1)).alias("sets_in"),
        )
    )


def every_week(runs: DataFrame) -> DataFrame:
    """Rows of `run_weeks` with the empty weeks after each, in which stock stays as it ended."""
    own = F.col("week_idx") == F.col("run_from")
    nothing = F.when(F.col("inventory_end").isNotNull(), F.lit(0.0))
    weeks = F.sequence("week_idx", F.col("until") - 1)
    return runs.withColumn("run_from", F.col("week_idx")).withColumn("week_idx", F.explode(weeks)).select(
        "ref", "market_chars", "week_idx",
        *[F.when(own, F.col(name)).otherwise(0.0).alias(name) for name in FLOWS],
        F.when(own, F.col("inventory_start")).otherwise(F.col("inventory_end")).alias("inventory_start"),
        "inventory_end",
        F.when(own, F.col("sales_missed")).otherwise(nothing).alias("sales_missed"),
        (own & F.col("sets_in")).alias("sets_in"),
    )


def run_waterfall(dense: DataFrame, params: Params) -> DataFrame:
    """Start, end and lost sales of every ref and week."""
    return every_week(run_weeks(dense, params)).drop("sets_in")


def with_dates(weeks: DataFrame, params: Params) -> DataFrame:
    calendar = week_calendar(weeks.sparkSession, params)
    # The calendar has at most 157 rows.
    return weeks.join(F.broadcast(calendar), "week_idx")


def _runs_of(weekly: DataFrame, params: Params) -> DataFrame:
    kept = replace(params, quantity_decimals=weekly.schema["demand"].dataType.scale)
    return run_weeks(dense_weeks(weekly, kept), kept)


def waterfall_of(weekly: DataFrame, params: Params, marked: bool = False) -> DataFrame:
    """The planning weeks of every ref, out of its weekly flows; with `marked`, as `with_oos_marks` has them."""
    weeks = with_dates(every_week(_runs_of(weekly, params)), params)
    return with_oos_marks(weeks) if marked else weeks.drop("sets_in")


def filled_weeks_of(weekly: DataFrame, params: Params) -> DataFrame:
    """The marked weeks of every ref without its empty ones, which add nothing to totals and lost sales."""
    return with_oos_marks(with_dates(_runs_of(weekly, params).drop("until"), params))


def by_ref(weekly: DataFrame) -> DataFrame:
    """Weekly flows on the partition of their ref, over many partitions: a ref's weeks are sorted and grow there."""
    return weekly.filter("ref IS NOT NULL").repartition(spread_partitions(weekly), "ref")


def waterfall(sources: Sources, params: Params) -> DataFrame:
    return waterfall_of(by_ref(weekly_flow(flow_rows(sources, params), params)), params)


def filled_weeks(sources: Sources, params: Params) -> DataFrame:
    return filled_weeks_of(by_ref(weekly_flow(flow_rows(sources, params), params)), params)


def with_oos_marks(weeks: DataFrame) -> DataFrame:
    """Adds `missing_from`, the week if it has lost sales, and `onset`, the week if they set in anew.

    Lost sales set in anew after a week without any, against a demand above one unit. Where the rows do
    not say so themselves, all planning weeks of a ref must be there.
    """
    missed, sets_in = F.col("sales_missed"), F.col("sets_in")
    if "sets_in" not in weeks.columns:
        before = F.lag(missed).over(Window.partitionBy("ref").orderBy("week_idx"))
        sets_in = (before == 0) & (missed > 0) & (F.col("demand") > 1)
    return weeks.withColumns(
        {
            "missing_from": F.when(missed > 0, F.col("week_start")),
            "onset": F.when(sets_in, F.col("week_start")),
        }
    ).drop("sets_in")


def oos_weeks(weeks: DataFrame) -> DataFrame:
    """Per ref the first week out of stock, the last onset, and the one that counts, as Mondays."""
    marked = weeks if "onset" in weeks.columns else with_oos_marks(weeks)
    return (
        marked.groupBy("ref")
        .agg(F.min("missing_from").alias("oos_first"), F.max("onset").alias("oos_last_onset"))
        .withColumn("oos_final", F.coalesce("oos_last_onset", "oos_first"))
    )
