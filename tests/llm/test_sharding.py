import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import sharding
from shelfcast.llm.common import ranked


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3)])
def test_the_curve_visits_every_cell_once_by_steps_of_one(dimensions, bits):
    cells = np.indices([1 << bits] * dimensions).reshape(dimensions, -1)
    index = sharding.hilbert_index(list(cells), bits)
    assert sorted(index) == list(range(len(index)))
    path = cells[:, np.argsort(index)].T
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def table(docs, clashing, n=507):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "é" * rng.randrange(50), "same text", "word " * rng.randrange(400)])
        rows.append((text, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", None, "hot", "hot", "hot"])))
    return rows, clashing(docs(*rows))


@pytest.mark.parametrize("n", [507, 13])
def test_shards_differ_by_one_row_at_most(docs, clashing, n):
    rows, df = table(docs, clashing, n)
    got = sharding.sharded(df).collect()
    assert {r.doc_id for r in got} == set(range(n))
    by_shard = {}
    for r in got:
        data = (rows[r.doc_id][0] or "").encode()
        assert (r["size"], r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        by_shard.setdefault(r.shard, []).append(r.slot)
    counts = [len(by_shard.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1 and set(by_shard) <= set(range(40))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    again = sharding.sharded(df.repartition(5)).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in again} == {r.doc_id: (r.shard, r.slot) for r in got}


def test_files_cover_a_small_range_of_each_dimension(spark, docs, clashing, tmp_path):
    rng = random.Random(5)
    rows = [("w" * rng.randrange(10, 5000), rng.choice(["de", "en", "es", "fr"]), f"src{rng.randrange(10):02}") for _ in range(2000)]
    sharding.write_shards(docs(*rows), str(tmp_path / "out"), 16)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 2000
    ranges = back.groupBy("shard").agg(*[F.countDistinct(c).alias(c) for c in ("lang", "source")], F.max("n_chars").alias("top"), F.min("n_chars").alias("low"))
    spread = ranges.agg(F.avg("lang"), F.avg("source"), F.avg(F.col("top") - F.col("low"))).first()
    assert spread[0] < 3.5 and spread[1] < 8 and spread[2] < 4000


def test_long_values_with_one_beginning_are_told_apart(docs):
    rows = [("w " * 20, "en", f"https://commoncrawl.example/{i % 10}") for i in range(400)]
    places = {(r.curve, rows[r.doc_id][2]) for r in sharding.on_curve(docs(*rows)).collect()}
    assert len({curve for curve, _ in places}) == len(places) == 10


def brute(rows, shards):
    """Shard and slot of each row: cells by the distinct values' places, then equal runs of the sorted rows."""
    last, columns = 31, []
    for values in zip(*[(source, lang, len((text or "").encode()) + 16) for text, lang, source in rows]):
        if isinstance(values[0], int):
            codes = list(values)
        else:
            ranks = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}))}
            codes = [ranks.get(v) for v in values]
        known = sorted(c for c in codes if c is not None)
        cuts = sorted({known[max(0, -(-len(known) * i // 32) - 1)] for i in range(1, 32)})
        columns.append([last if c is None else sum(cut < c for cut in cuts) * last // len(cuts) for c in codes])
    curve = sharding.hilbert_index([np.array(c) for c in columns], 5)
    key = lambda i: (curve[i], zlib.crc32((rows[i][0] or "").encode()), len((rows[i][0] or "").encode()), i)
    order = sorted(range(len(rows)), key=key)
    out, slots = {}, {}
    for rank, i in enumerate(order):
        shard = rank * shards // len(rows)
        out[i] = shard, slots.get(shard, 0)
        slots[shard] = slots.get(shard, 0) + 1
    return out


def test_shards_equal_brute_force(docs, clashing):
    rows, df = table(docs, clashing)
    rows = [(text, lang or "en", source or "s0") for text, lang, source in rows]
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.sharded(docs(*rows), 7).collect()}
    assert got == brute(rows, 7)


def test_empty_table_and_ranks(spark, docs):
    assert sharding.sharded(docs().limit(0)).collect() == []
    df = spark.range(0, 1000, 1, 7).withColumn("x", (F.col("id") * 7919) % 1000)
    got = ranked(df, [F.col("x").desc()]).collect()
    assert all(r["rank"] == 999 - r.x for r in got)
