import tracemalloc

import numpy as np
import pytest

from shelfcast.llm import common, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows):
    ids = [i for i, _, _ in rows]
    good = [
        v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]
    component = dict(zip(ids, ids))
    degree = dict.fromkeys(ids, 0)
    links = []
    for a, (i, v, k) in enumerate(rows):
        for b, (j, w, m) in enumerate(rows):
            if a != b and good[a] and good[b] and k == m and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    degree[i] += 1
                    links.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(component[i], component[j])
            changed |= component[i] != low or component[j] != low
            component[i] = component[j] = low
    return {i: (degree[i], component[i], component[i] == i) for i in ids}


def rows_of(seed, groups=12, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=size)
        for noise in (0, 0, 0.05, 0.05, 0.1, 0.1, 0.3):
            rows.append((len(rows) * 3 + 1, (centre + noise * rng.normal(size=size)).tolist(), int(rng.integers(2))))
    first = rows[0][1]
    odd = [None, [], [0.0] * size, [None, *first[1:]], [float("nan"), *first[1:]], [float("inf"), *first[1:]], first[:8], [x * 1e30 for x in first]]
    rows += [(10_000 + i, v, 1) for i, v in enumerate(odd)] + [(20_000, first, None)]
    return rows


@pytest.mark.parametrize("chunk", [vectors.CHUNK, 4])
def test_links_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    rows = rows_of(chunk)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_links", "2 AS rep", "'x' AS digest", "0 AS copies")
    got = vectors.near_vectors(table).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(rows)


def test_many_copies_count_each_other(spark):
    rows = spark.range(500).selectExpr("id AS vec_id", "array(1f, 2f, 3f) AS embedding", "1 AS label")
    got = vectors.near_vectors(rows)
    assert got.filter("n_links = 499 AND component_id = 0").count() == 500
    assert got.filter("kept").count() == 1


def test_empty_and_unusable_tables(spark):
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    got = vectors.near_vectors(spark.createDataFrame([(3, None, 1)], SCHEMA)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got] == [(3, 0, 3, True)]


def test_probes_reach_every_list_within_the_radius():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(400, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = vectors.Index(16, 0.2, vectors._fitted(points, 30, 1), np.zeros((2, 1, 8)))
    lists = vectors._nearest(points, index.centres)
    probed = set(zip(*index.probes(points, lists)))
    near = points[:, None] - points[None]
    for a, b in np.argwhere(np.linalg.norm(near, axis=2) <= 0.2):
        assert lists[a] == lists[b] or (a, lists[b]) in probed or (b, lists[a]) in probed


def test_memory_of_probes_does_not_grow_with_lists_times_lists_times_components():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(3000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = vectors.Index(64, 0.2, points[:700], np.zeros((8, 1, 8)))
    tracemalloc.start()
    lists = vectors._nearest(points, index.centres)
    index.probes(points, lists)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 700 x 700 distances are 4 MB, and 700 x 700 x 64 differences 251 MB.
    assert peak < 16_000_000


def sent(spark, monkeypatch, points, chunk, label=1):
    """Rows that go to blocks, and the number of blocks, for vectors of one label in one table."""
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    rows = [(i, 1, label, len(v), v.tolist()) for i, v in enumerate(points)]
    reps = spark.createDataFrame(rows, "rep bigint, copies bigint, label bigint, size int, embedding array<double>")
    index = vectors.fit(reps, 0.98)
    layout = vectors.blocks(reps, index)
    count = sum(block.parts for row in layout.collect() for block in row.blocks)
    return vectors.placed(reps, layout, index).collect(), count, len(index.centres)


def test_a_vector_is_sent_once_to_a_block_however_many_lists_it_probes(spark, monkeypatch):
    points = np.random.default_rng(3).normal(size=(400, 16))
    rows, count, lists = sent(spark, monkeypatch, points, 1000)
    assert lists == 20 and count == 1
    assert sorted(row.rep for row in rows) == list(range(400)) and all(row.own for row in rows)
    rows, count, _ = sent(spark, monkeypatch, points, 100)
    places = [(row.rep, row.block) for row in rows]
    assert 4 <= count <= 8 and len(places) == len(set(places)) <= 400 * count
    assert sum(row.own for row in rows) == 400


def test_a_list_larger_than_a_block_is_compared_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=16) + 0.02 * rng.normal(size=(60, 16)), rng.normal(size=(40, 16))])
    rows, count, _ = sent(spark, monkeypatch, points, 8)
    members = [sum(row.own for row in rows if row.block == block) for block in range(count)]
    assert count > 10 and max(members) < 20
    table = [(i, v.tolist(), 1) for i, v in enumerate(points)]
    got = vectors.near_vectors(spark.createDataFrame(table, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(table)


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    with common.shuffles_freed(spark):
        assert spark.conf.get(setting) == "true"
        common.stored(spark.range(1000).repartition(7))
    assert spark.conf.get(setting) == before
