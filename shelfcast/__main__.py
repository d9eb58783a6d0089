"""A whole run as a job: python -m shelfcast --sources DIR --out DIR --as-of DATE."""

from __future__ import annotations

import argparse
import os
from datetime import date, datetime

from pyspark.sql import Observation, Row, SparkSession

from shelfcast.params import Params
from shelfcast.plans.allocation import allocation_of
from shelfcast.plans.extracts import EXTRACTS, Sources, report
from shelfcast.plans.impact import MEASURES, ref_summary, run_totals
from shelfcast.plans.orders import staged
from shelfcast.plans.waterfall import flow_rows, left_out_of, waterfall_of, weekly_flow
from shelfcast.session import with_settings
from shelfcast.sinks import write_debug, write_result, write_stage
from shelfcast.sources.dimensions import READERS, read_rules
from shelfcast.sources.readers import load_sources, load_warehouse
from shelfcast.sources.schemas import OPTIONAL, SCHEMAS

RUN_TOTALS = "n_refs bigint, total_demand double, total_missed double, demand_coverage double, oos_count bigint"


def run(sources: Sources, params: Params, out: str, run_at: datetime, debug: bool = False) -> Row:
    """Writes the weekly flows, the weeks and the result, and returns the run's totals.

    Each stage goes on from the table of the one before, so that nothing is computed twice and losing
    executors later does not read the sources again. Weekly flows, weeks and per-ref results are bucketed
    by ref: rows are brought to their ref once, and neither windows nor totals shuffle them again. The
    windows run once; the result and its column per week come out of one aggregation of the weeks. What is
    left out is part of the weekly flows, and the totals are observed while the per-ref results are
    written. A lost executor cannot count there twice: writing is the stage that the totals are taken in.
    """
    day = params.as_of
    sources = staged(sources, params, lambda df, name: write_stage(df, out, name, day))
    weekly = weekly_flow(flow_rows(sources, params), params)
    weekly = write_stage(weekly, out, "weekly_flow", day, by="ref", spread=True)
    weeks = waterfall_of(weekly, params, marked=True)
    weeks = write_stage(weeks, out, "sales_missed", day, by="ref")
    totals = Observation("run_totals")
    summary = ref_summary(weeks, params, ["sales_missed"]).observe(totals, *run_totals())
    summary = write_stage(summary, out, "per_ref", day, by="ref")
    cells = [f"{label}_{MEASURES['sales_missed']}" for label in params.labels]
    write_result(allocation_of(summary, sources, params, cells), out, run_at, ["ref"])
    write_stage(left_out_of(weekly), out, "left_out", day)
    if debug:
        write_debug({name: report(name, sources, params) for name in EXTRACTS}, out, day)
    row = Row(**totals.get)
    write_stage(summary.sparkSession.createDataFrame([row], RUN_TOTALS), out, "run_summary", day)
    return row


def with_rules(params: dict, sources: dict, spark: SparkSession, path: str) -> None:
    """Puts what a rules document says into the parameters and the sources."""
    stages, rules = read_rules(spark, path)
    sources["stage_class"] = stages
    named = {"production_default": rules.default_lead_time_days, "processing_days": rules.po_processing_time,
             "carton_default": rules.min_units_per_carton}
    params |= {name: value for name, value in named.items() if value is not None}
    params["markets"] = tuple(sorted((rules.marketplace_mappings or {}).items()))


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfcast", description=__doc__)
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--sources", help="folder of parquet source tables")
    where.add_argument("--warehouse", help="JSON document that names a warehouse table for each source, read over JDBC")
    parser.add_argument("--out", required=True, help="folder that all executors can write to")
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--target-year", type=int)
    parser.add_argument("--dimensions", help="folder of CSV files, e.g. route_leadtime.csv, in place of built-in tables")
    parser.add_argument("--rules", help="JSON document of stages, market names and thresholds")
    parser.add_argument("--without", nargs="*", default=[], choices=OPTIONAL, help="sources this run does not have")
    parser.add_argument("--keep-week-53", action="store_true")
    parser.add_argument("--missing-stock", choices=["zero", "null"], default="zero")
    parser.add_argument("--po-routes", choices=["all", "po"], default="all")
    parser.add_argument("--inbound-routes", choices=["all", "inbound"], default="all")
    parser.add_argument("--lead-time-routes", choices=["all", "legacy"], default="all")
    parser.add_argument("--lead-time-buffers", choices=["table", "market"], default="table")
    parser.add_argument("--inbound-fallback", choices=["row", "column"], default="row")
    parser.add_argument("--double-deduct", action="store_true", help="take location stock off the opening stock twice")
    parser.add_argument("--raw-join", action="store_true", help="join PO lines to every shipment header snapshot")
    parser.add_argument("--fan-out-master", action="store_true", help="repeat PO lines for every master row of their sku")
    parser.add_argument("--debug", action="store_true", help="also write every source query")
    given = parser.parse_args(args)
    spark = with_settings(SparkSession.builder.appName("shelfcast")).getOrCreate()
    names = [name for name in SCHEMAS if name not in given.without]
    if given.warehouse:
        sources = load_warehouse(spark, given.warehouse, names)
    else:
        sources = load_sources(spark, given.sources, names)
    changes = {}
    if given.dimensions:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for name, read in READERS.items():
            path = os.path.join(given.dimensions, f"{name}.csv")
            file = hadoop(path)
            if file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file):
                sources[name] = read(spark, path)
    if given.rules:
        with_rules(changes, sources, spark, given.rules)
    params = Params(
        given.as_of,
        target_year=given.target_year,
        drop_week_53=not given.keep_week_53,
        missing_stock=given.missing_stock,
        po_routes=given.po_routes,
        inbound_routes=given.inbound_routes,
        lead_time_routes=given.lead_time_routes,
        lead_time_buffers=given.lead_time_buffers,
        inbound_fallback=given.inbound_fallback,
        double_deduct=given.double_deduct,
        raw_join=given.raw_join,
        fan_out_master=given.fan_out_master,
        **changes,
    )
    totals = run(sources, params, given.out, datetime.now(), given.debug)
    print(
        f"refs planned: {totals.n_refs:,}; demand covered: {totals.demand_coverage}%; "
        f"out of stock: {totals.oos_count:,}"
    )


if __name__ == "__main__":
    main()
