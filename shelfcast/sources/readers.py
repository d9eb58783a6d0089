"""Source tables as DataFrames: from parquet, or from a warehouse over JDBC."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from decimal import Decimal
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfcast.functions.columns import check_columns
from shelfcast.sources.schemas import SCHEMAS

# Fixed value: rows fetched per round trip.
FETCH_ROWS = 10_000


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns a source must have, in their types; fails when one is missing.

    Figures that come as DECIMAL stay exact: they are not made doubles.
    """
    schema = T.StructType.fromDDL(SCHEMAS[name])
    check_columns(df, schema.names, name)

    def typed(field: T.StructField) -> Column:
        exact = isinstance(field.dataType, T.DoubleType) and isinstance(df.schema[field.name].dataType, T.DecimalType)
        return F.col(field.name) if exact else F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*map(typed, schema))


def empty_source(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(SCHEMAS[name]))


def load_sources(
    spark: SparkSession, root: str, names: Iterable[str] = tuple(SCHEMAS)
) -> dict[str, DataFrame]:
    """Named source tables under one folder of parquet tables; a missing table fails."""
    return {name: conform(spark.read.parquet(f"{root}/{name}"), name) for name in names}


def jdbc_options(environ=os.environ) -> dict[str, str]:
    """Connection options; address and credentials come from the environment only."""
    return {
        "url": environ["SHELFCAST_JDBC_URL"],
        "user": environ["SHELFCAST_JDBC_USER"],
        "password": environ["SHELFCAST_JDBC_PASSWORD"],
        "fetchsize": str(FETCH_ROWS),
    }


def key_ranges(keys: DataFrame, column: str, partitions: int) -> list[str]:
    """Conditions that cut a table into about equally many rows by ranges of `column`.

    Cuts are quantiles of the keys, so that skewed keys do not leave most rows to one range, as ranges of
    equal width do. Every row meets exactly one condition; NULL keys are in the first range. A value
    that holds more than a share of all rows is a range of its own, which its key alone cannot cut.
    """
    if partitions < 2:
        return ["1 = 1"]
    shares = [n / partitions for n in range(1, partitions)]
    # An error of a tenth of a share; the sketch is bounded, and one is merged for each partition.
    cuts = keys.agg(F.percentile_approx(column, shares, 10 * partitions).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    if not cuts:
        return ["1 = 1"]
    text = [str(cut) if isinstance(cut, (int, float, Decimal)) else f"'{cut}'" for cut in cuts]
    between = [f"{column} > {low} AND {column} <= {high}" for low, high in pairwise(text)]
    return [f"{column} <= {text[0]} OR {column} IS NULL", *between, f"{column} > {text[-1]}"]


def jdbc_source(
    spark: SparkSession,
    name: str,
    table: str,
    options: dict[str, str] | None = None,
    partition_column: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A warehouse table, read by balanced ranges of `partition_column` so that executors share the scan.

    The keys are read first, alone, to find the ranges.
    """
    options = options or jdbc_options()
    if not partition_column:
        return conform(spark.read.format("jdbc").options(**options).option("dbtable", table).load(), name)
    keys = spark.read.format("jdbc").options(**options).option("query", f"SELECT {partition_column} FROM {table}").load()
    ranges = key_ranges(keys, partition_column, partitions)
    rest = {key: value for key, value in options.items() if key != "url"}
    return conform(spark.read.jdbc(options["url"], table, predicates=ranges, properties=rest), name)


def load_warehouse(
    spark: SparkSession, path: str, names: Iterable[str] = tuple(SCHEMAS), options: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Sources out of a warehouse, as a JSON document names them.

    For each source it has `table`, and for large ones `partition_column` (a number, date or time) and
    `partitions`. A source that is not named fails.
    """
    text = "\n".join(row.value for row in spark.read.text(path, wholetext=True).collect())
    tables = json.loads(text)
    missing = sorted(set(names) - set(tables))
    if missing:
        raise ValueError(f"{path}: no table for {', '.join(missing)}")
    return {name: jdbc_source(spark, name, options=options, **tables[name]) for name in names}
