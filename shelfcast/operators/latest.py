"""Latest state of snapshot tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.operators.joins import join_null_safe


def latest_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order, which must not leave ties.

    The rank filter is planned as a group limit in front of the shuffle, so a key sends at most
    one row per input partition however many rows it has.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_snapshot(df: DataFrame, keys: list[str], order: str = "snapshot_date") -> DataFrame:
    """All rows of the newest snapshot per key; an undated snapshot counts as newest.

    A rank over the key would sort all rows of a key in one task. The newest date is instead
    aggregated, combining before the shuffle, and joined back, so that a key with very many rows
    is split like any other skewed join.
    """
    undated = F.max(F.col(order).isNull())
    newest = df.groupBy(*keys).agg(F.when(~undated, F.max(order)).alias(order))
    return join_null_safe(df, newest, [*keys, order], "inner").select(*df.columns)


def newest_date(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """One row with the newest date of the whole table."""
    return df.agg(F.max(column).alias(column))


def global_latest(df: DataFrame, dates: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows dated as the newest row of `dates`; a scalar subquery, so the date prunes the scan."""
    return df.filter(F.col(column) == newest_date(dates, column).scalar())
