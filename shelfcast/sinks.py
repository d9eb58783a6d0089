"""Results as tables and files, and the layout with one column per week."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.params import Params
from shelfcast.plans.impact import MEASURES

def wide_weekly(weeks: DataFrame, params: Params, measures: list[str]) -> DataFrame:
    """One row per ref, a column `CWww-YYYY_<measure>` per planned week; cells without a row hold 0.

    The labels are known from the parameters, so no job looks for them, and rows that lie by ref
    already are not shuffled again.
    """
    labels = params.labels
    cells = [F.coalesce(F.sum(name), F.lit(0.0)).alias(MEASURES[name]) for name in measures]
    if len(measures) == 1:
        wide = weeks.groupBy("ref").pivot("label", labels).agg(*cells)
        renamed = {label: f"{label}_{MEASURES[measures[0]]}" for label in labels}
        return wide.withColumnsRenamed(renamed).na.fill(0.0)
    return weeks.groupBy("ref").pivot("label", labels).agg(*cells).na.fill(0.0)


def write_stage(
    df: DataFrame, base: str, stage: str, run_date: date, by: str | None = None, spread: bool = False
) -> DataFrame:
    """Writes an intermediate table under the run's folder and reads it back.

    With `by`, it is bucketed by that column, as many buckets as shuffle partitions, so that windows and
    totals per key read it without a shuffle. `spread` first brings the rows of a key together; leave it
    out where they lie together already.
    """
    path = f"{base}/run_date={run_date.isoformat()}/debug/{stage}"
    if by is None:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(buckets, by) if spread else df
    # Bucketing is known to the catalog alone; the table's files stay in the run's folder.
    table = f"shelfcast_{stage}_{uuid.uuid4().hex}"
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, by).sortBy(by).saveAsTable(table, format="parquet")
    return spark.table(table)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; on one machine a temporary one where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Tables written inside delete their shuffle files when they stand, and not when the driver collects its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def keep_shared(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the folder that all executors share and reads it back; its shuffle files go."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_debug(stages: Mapping[str, DataFrame], base: str, run_date: date) -> None:
    for stage, df in stages.items():
        write_stage(df, base, stage, run_date)


def write_result(
    df: DataFrame, base: str, run_at: datetime, order: list[Column | str] | None = None
) -> str:
    """Writes the result as CSV with a header under a folder named after the run's time."""
    path = f"{base}/inventory_allocation_{run_at:%Y%m%d_%H%M%S}"
    ordered = df.orderBy(*order) if order else df
    ordered.write.mode("errorifexists").option("header", True).csv(path)
    return path
