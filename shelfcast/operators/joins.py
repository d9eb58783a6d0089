"""Joins with an audit, lookups with defaults, and the values of a group as rows and as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Values in one piece of a list's text, at most.
PIECE_VALUES = 1_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; keeps the left keys."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    matches = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, matches), how)
    return joined.drop(*[f"_right_{key}" for key in keys])


def audited_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left"
) -> tuple[DataFrame, DataFrame]:
    """The join, and one lazy row: left rows, result rows, and right keys that repeat.

    The audit counts the rows of each key on either side and multiplies the counts; it never joins rows.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how: {how!r}")
    lefts = left.groupBy(*keys).agg(F.count("*").alias("_lefts"))
    rights = right.groupBy(*keys).agg(F.count("*").alias("_rights"))
    matches = F.coalesce("_rights", F.lit(1 if how == "left" else 0))
    audit = lefts.join(rights, keys, "left").agg(
        F.coalesce(F.sum("_lefts"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(F.col("_lefts") * matches), F.lit(0)).alias("result_rows"),
    )
    repeated = rights.filter("_rights > 1").agg(F.count("*")).scalar()
    return left.join(right, keys, how), audit.withColumn("repeated_keys", repeated)


def lookup_route(
    df: DataFrame, routes: DataFrame, departure: Column, arrival: Column, default: int
) -> DataFrame:
    """Adds `route_days`; an unknown route takes the default."""
    table = routes.select(
        F.col("departure").alias("_departure"),
        F.col("arrival").alias("_arrival"),
        F.col("days").alias("_days"),
    )
    return (
        df.withColumns({"_departure": departure, "_arrival": arrival})
        .join(table, ["_departure", "_arrival"], "left")
        .withColumn("route_days", F.coalesce("_days", F.lit(default)))
        .drop("_departure", "_arrival", "_days")
    )


def lookup_buffer(
    df: DataFrame, buffers: DataFrame, wh_type: Column, market: Column, default: Column
) -> DataFrame:
    """Adds `buffer_days` by warehouse type and market; an unknown pair takes the default."""
    table = buffers.select(
        F.col("wh_type").alias("_wh_type"),
        F.col("location").alias("_location"),
        F.col("days").alias("_days"),
    )
    return (
        df.withColumns({"_wh_type": wh_type, "_location": market})
        .join(table, ["_wh_type", "_location"], "left")
        .withColumn("buffer_days", F.coalesce(F.col("_days"), default))
        .drop("_wh_type", "_location", "_days")
    )


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """How often each value occurs in its group: the whole content of the group's list, as rows."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def value_pieces(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The ordered list of each group's values as pieces of text: (keys, value, piece, text).

    In the order of `value` and `piece` the texts make up the whole list, repeats included. Values are
    counted first, and a piece holds a bounded number of repeats of one value, so nothing of a group
    is gathered, however long its list.
    """
    counts = value_counts(df, keys, value)
    pieces = F.sequence(F.lit(0), ((F.col("n") - 1) / PIECE_VALUES).cast("int"))
    repeats = F.least(F.lit(PIECE_VALUES), F.col("n") - F.col("piece") * PIECE_VALUES).cast("int")
    return counts.withColumn("piece", F.explode(pieces)).select(
        *keys, value, "piece", F.array_join(F.array_repeat(value, repeats), ", ").alias(name)
    )
