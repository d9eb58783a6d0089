"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words by weight. A source that would pass its cap (its size times the most
repetitions) is held there, and the excess goes to the others by weight, until none is above. What a
source gives is then whole repetitions of all its documents, and one more of documents drawn by a
seeded hash until the rest of its target is reached.

The draw needs no sort of a source: words are added up in bins of the hash, before the shuffle, and
documents are taken in the hash's order as far as they fit. What is then left of a target is filled by
later documents that are small enough, in further passes of the same kind, until none fits: what is
taken is what one walk in the hash's order takes that passes over each document that no longer fits.

A null source is a source of its
own, last in order; a null or empty text has size 0 and is never taken; a source without words has
target 0. An empty table gives an empty result. Rows of one id are told apart by their text, also rows
without an id; rows of a source that are equal in both fit, or are passed over, as a whole. Extra columns
are left out by `mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfcast.llm.common import WORD, documents, ranked, settled, stored

# Weights by a source's place in order, repeating; words of the mix per word of the input; most repetitions.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
SEED, BINS = "mix-1", 4096


def words(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str) -> Column:
    """A number of 60 bits for each document, the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def water_filled(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """(source, source_size, target) from one row per source.

    Every round is one sum over the sources; the driver holds two numbers of each.
    """
    ordered = ranked(sizes, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = settled(
        ordered.select("source", "source_size", weight.cast("double").alias("weight"), (most * F.col("source_size")).alias("cap"))
    )
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:
        held = F.lit(False) if level is None else F.col("weight") * level > F.col("cap")
        used, free = table.agg(
            F.coalesce(F.sum(F.when(held, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~held, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not free:
            level = level or 0.0
            break
        higher = (budget - used) / free
        if level is not None and higher <= level:
            break
        level = higher
    target = F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def same(name: str, other: str) -> Column:
    return F.col(name).eqNullSafe(F.col(other))


def drawn(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """Rows that fit into what is `left` to their source, taken in order of their draw; the others go.

    A source is spread over its bins, in the join as in the window; it has at most BINS sums.
    """
    small = rows.join(quotas.withColumnRenamed("source", "_source"), same("source", "_source")).drop("_source")
    small = small.filter("size > 0 AND size <= left")
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bin")) - F.col("words")
    sums = small.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    sums = sums.select(F.col("source").alias("_source"), F.col("bin").alias("_bin"), before.alias("before"))
    within = Window.partitionBy("source", "bin").orderBy("draw", F.asc_nulls_last("doc_id"), "mark").rowsBetween(Window.unboundedPreceding, 0)
    placed = small.join(sums, same("source", "_source") & (F.col("bin") == F.col("_bin")))
    reached = placed.withColumn("reached", F.col("before") + F.sum("size").over(within))
    return reached.filter("reached <= left").select(*rows.columns)


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, and `times` each document is taken; `mark` tells texts apart."""
    mark = F.coalesce(F.xxhash64("text"), F.lit(0))
    rows = docs.select("doc_id", "source", words().alias("size"), draw(seed).alias("draw"), mark.alias("mark"))
    rows = stored(rows.withColumn("bin", F.col("draw") % BINS))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_filled(sizes, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = stored(targets.withColumn("whole", whole))
    quotas = targets.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("left"))
    key = ["source", "doc_id", "mark"]
    left = rows.groupBy(*key, "draw", "bin").agg(F.sum("size").alias("size")).filter("size > 0")
    once = None
    while True:
        found = stored(drawn(left, quotas))
        if found.isEmpty():
            break
        once = found.select(*key) if once is None else once.union(found.select(*key))
        used = found.groupBy(F.col("source").alias("_source")).agg(F.sum("size").alias("used"))
        quotas = quotas.join(used, same("source", "_source"), "left").select(
            "source", (F.col("left") - F.coalesce("used", F.lit(0))).alias("left")
        )
        quotas = stored(quotas.filter("left >= 1"))
        # Only what is small enough can still fit, and what was drawn is gone.
        taken = found.select(*[F.col(name).alias(f"_{name}") for name in key])
        left = left.join(taken, same("source", "_source") & same("doc_id", "_doc_id") & same("mark", "_mark"), "left_anti")
        room = quotas.select(F.col("source").alias("_source"), "left")
        left = stored(left.join(room, same("source", "_source") & (F.col("size") <= F.col("left"))).select(*key, "draw", "bin", "size"))
    out = rows.join(targets.withColumnRenamed("source", "_source"), same("source", "_source")).drop("_source")
    if once is None:
        out = out.withColumn("more", F.lit(None).cast("int"))
    else:
        once = once.select(*[F.col(name).alias(f"_{name}") for name in key], F.lit(1).alias("more"))
        out = out.join(once, same("source", "_source") & same("doc_id", "_doc_id") & same("mark", "_mark"), "left")
    times = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("more", F.lit(0))).otherwise(0)
    return out.select("doc_id", "source", "size", "source_size", "target", times.cast("long").alias("times"), "mark")


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with their columns, each as often as it is taken."""
    times = mixed(docs, **options).filter("times > 0").groupBy(
        F.col("source").alias("_source"), F.col("doc_id").alias("_doc_id"), F.col("mark").alias("_mark")
    )
    times = times.agg(F.max("times").cast("int").alias("_times"))
    alike = same("source", "_source") & same("doc_id", "_doc_id") & (F.xxhash64("text") == F.col("_mark"))
    taken = docs.join(times, alike)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(documents(spark, sf_dir))
    return found.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )
