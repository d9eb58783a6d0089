"""Shards along a Hilbert curve through several metadata dimensions.

Texts count by their place among all distinct values, in whole. Each dimension is cut into cells of near equal row counts, the cells of a row give its place on the
curve, and equal runs of the curve become shards. Neighbours on the curve have near values in all
dimensions, so the files of a shard cover a small range of each and can be skipped by any of them.
The law is `rows`: shards differ by one row at most.

A null is the last cell of its dimension; a null text counts as empty. Rows that tie on the curve
follow by check sum, size and id, so equal texts with equal metadata stand together. An empty table
gives an empty result; rows that repeat each take a slot. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.llm.common import documents, ranked, stored

SHARDS, BITS = 40, 5


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates below 2**bits.

    Coordinates are turned into the curve's transposed index from the highest bit down (exchange or
    invert the lower bits of the first axis), Gray-decoded, and interleaved.
    """
    x = [np.asarray(cell, np.int64).copy() for cell in cells]
    for bit in range(bits - 1, 0, -1):
        high, low = np.int64(1) << bit, (np.int64(1) << bit) - 1
        for axis in range(len(x)):
            is_set = (x[axis] & high) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        high = np.int64(1) << bit
        flip ^= np.where((x[-1] & high) != 0, high - 1, 0)
    x = [axis ^ flip for axis in x]
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            out = out << 1 | (axis >> bit & 1)
    return out


def with_code(rows: DataFrame, text: str) -> DataFrame:
    """Adds `_<text>`: the place of the whole value among all distinct ones, in their order; null for a null."""
    values = ranked(rows.select(text).filter(F.col(text).isNotNull()).distinct(), [F.col(text)])
    values = values.select(F.col(text).alias("_value"), F.col("rank").alias(f"_{text}"))
    return rows.join(values, F.col(text) == F.col("_value"), "left").drop("_value")


def cells(rows: DataFrame, names: list[str], bits: int) -> list[Column]:
    """Cell of each numeric dimension by quantiles over all rows; a null is in the last."""
    last = (1 << bits) - 1
    shares = F.array(*[F.lit(i / (last + 1)) for i in range(1, last + 1)])
    found = rows.agg(*[F.percentile_approx(name, shares, 10_000).alias(name) for name in names]).first()
    out = []
    for name in names:
        cuts = sorted(set(found[name] or []))
        below = F.expr(f"size(filter(array({', '.join(map(str, cuts))}), cut -> cut < {name}))")
        place = F.floor(below * last / len(cuts)) if cuts else F.lit(0)
        out.append(F.when(F.col(name).isNull(), last).otherwise(place).cast("long"))
    return out


def on_curve(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32 and `curve`: the place of source, language and size on the curve."""

    @F.pandas_udf("bigint")
    def curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([a.to_numpy(), b.to_numpy(), c.to_numpy()], bits))

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "source",
        "lang",
    )
    # Written once: texts are read in one scan.
    rows = stored(with_code(with_code(stored(rows), "source"), "lang"))
    found = cells(rows, ["_source", "_lang", "size"], bits)
    return rows.select("doc_id", "size", "text_crc32", curve(*found).alias("curve"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard and slot: equal runs of the curve, counted from 0."""
    places = on_curve(docs)
    ordered = ranked(places, [F.col(c).asc_nulls_last() for c in ("curve", "text_crc32", "size", "doc_id")])
    total = max(1, places.count())
    shard = F.expr(f"rank * {shards} div {total}")
    # The first rank of a shard is the least with rank * shards >= shard * total.
    slot = F.col("rank") - F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return ordered.withColumn("shard", shard).withColumn("slot", slot).drop("rank")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """One folder per shard, sorted along the curve; ids must be unique."""
    places = sharded(docs, shards).select("doc_id", "shard", "slot")
    rows = docs.join(places, "doc_id").repartition(shards, "shard").sortWithinPartitions("shard", "slot")
    rows.drop("slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
