import time

import numpy as np
import pytest

from shelfcast.llm import near
from shelfcast.llm.common import components, forest


def smallest_reachable(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingled(text, size):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < size:
        return {(tuple(words), "short")}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(texts, size):
    sets = [shingled(text, size) for text in texts]
    links = [
        (i, j)
        for i, a in enumerate(sets)
        for j in range(i)
        if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j])
    ]
    root = smallest_reachable(range(len(sets)), links)
    return {i: (len(a), root[i], root[i] == i) for i, a in enumerate(sets)}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_all_pairs(docs, clashing, corpus, size):
    got = near.near_duplicates(clashing(docs(*corpus)), size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(corpus, size)


def test_nodes_that_branch_and_tiles_lose_nothing(docs, corpus, monkeypatch):
    monkeypatch.setattr(near, "NODE", 4)
    monkeypatch.setattr(near, "CHUNK", 5)
    monkeypatch.setattr(near, "SET_BYTES", 2_000)
    got = near.near_duplicates(docs(*corpus), 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(corpus, 2)


def test_one_document_of_each_group_stays(docs, clashing, corpus):
    table = clashing(docs(*corpus))
    got = near.without_copies(table)
    assert got.columns == table.columns
    kept = {i for i, row in brute(corpus, 5).items() if row[2]}
    assert sorted(r.doc_id for r in got.collect()) == sorted(kept)


def test_rows_without_an_id_or_with_the_same_one(docs):
    got = near.near_duplicates(docs("a b c", "a b c", "a b c", ids=[None, 4, 4]), 2).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in got) == [(False, 4, True), (False, 4, True), (True, 4, False)]


def test_one_row_of_equal_ids_and_of_null_ids_stays(docs):
    ids = [4, 4, None, 7, 7, 2, None, None, None, None, 9]
    texts = ["a b c", "a b c", "a b c", "x y z", "q r s", "a b c d", "n n n", "n n n", "", None, ""]
    kept = near.without_copies(docs(*texts, ids=ids), 2).collect()
    assert sorted((row.doc_id or -1, row.text or "") for row in kept) == [
        (-1, ""), (-1, ""), (-1, "n n n"), (2, "a b c d"), (4, "a b c"), (7, "q r s"), (7, "x y z"), (9, "")
    ]


@pytest.mark.parametrize("top", [50, 80, 95, 100])
def test_similar_connects_what_all_pairs_connect(top):
    rng = np.random.default_rng(top)
    base = [rng.choice(400, rng.integers(1, 60), replace=False).astype(np.uint64) for _ in range(25)]
    sets = list(base)
    for own in base * 6:  # with some exchanged, and some left out
        changed = np.where(rng.random(len(own)) < 0.15, rng.integers(0, 400, len(own)).astype(np.uint64), own)
        sets.append(np.unique(changed[rng.random(len(own)) < 0.95]) if len(own) > 3 else own)
    sets = [np.unique(own) for own in sets if len(own)]
    pairs = [
        (i, j)
        for i, a in enumerate(sets)
        for j in range(i)
        if 100 * len(np.intersect1d(a, sets[j])) >= top * len(np.union1d(a, sets[j]))
    ]
    links = near.similar(sets, top)
    assert set(map(tuple, map(sorted, links))) <= set(map(tuple, map(sorted, pairs)))
    assert len(links) < len(sets)
    assert smallest_reachable(range(len(sets)), links) == smallest_reachable(range(len(sets)), pairs)


def test_ten_thousand_unlike_sets_take_seconds():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 40, 200).astype(np.uint64)) for _ in range(10_000)]
    started = time.process_time()
    assert near.similar(sets, 80) == []
    assert near.similar([np.append(own, np.uint64(1 << 41)) for own in sets[:5000]], 80) == []
    assert time.process_time() - started < 30


def test_near_copies_without_an_id_are_linked(docs):
    long = " ".join(f"w{i}" for i in range(60))
    got = near.near_duplicates(docs(long, long + " x", long + " y", "p q r", "p q r", ids=[None, 8, None, None, 8]), 2).collect()
    assert sorted((row.doc_id or -1, row.n_shingles, row.component_id, row.kept) for row in got) == [
        (-1, 2, 8, False), (-1, 59, 8, False), (-1, 60, 8, False), (8, 2, 8, True), (8, 60, 8, True)
    ]


def test_empty_table(docs):
    assert near.near_duplicates(docs().limit(0)).collect() == []
    assert near.without_copies(docs().limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(1000 - i, 1001 - i) for i in range(30)] + [(5000, 6000 + i) for i in range(50)]
    links += [(7, 7), (2, 1), (1, 2)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    ids = {i for link in links for i in link}
    assert {r.id: r.component_id for r in got} == smallest_reachable(ids, links)


def test_forest_connects_what_all_pairs_connect():
    rng = np.random.default_rng(3)
    alike = rng.random((60, 60)) < 0.02
    alike |= alike.T
    links = forest(60, lambda row, others: alike[row, others])
    assert smallest_reachable(range(60), links) == smallest_reachable(range(60), np.argwhere(alike).tolist())
    assert len(links) < 60


def test_similar_sets_whose_sketches_agree_little_are_linked(docs):
    # 32 of 40 shingles are shared, but fewer than 39 of the 64 values of the sketches.
    shared = " ".join(f"11590w{k}" for k in range(32))
    texts = [" ".join([shared, *(f"11590{own}{k}" for k in range(4))]) for own in "ab"]
    sketches = [near.minwise(near.shingles(text, 1)) for text in texts]
    assert (sketches[0] == sketches[1]).sum() < 39
    assert [r.component_id for r in near.near_duplicates(docs(*texts), 1).collect()] == [0, 0]


def test_less_similar_sets_are_linked_where_less_is_asked(docs):
    rng = np.random.default_rng(8)
    texts = []
    for i in range(60):  # subsets of two thirds of the words, and sets of equal size
        words = [f"{i}w{k}" for k in range(60)]
        texts += [" ".join(words), " ".join(rng.permutation(words)[:40])] if i % 2 else [" ".join(words[:48]), " ".join(words[12:])]
    for top in (60, 80):
        got = near.near_duplicates(docs(*texts), 1, top).collect()
        assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 if top == 60 else i for i in range(120)}


def test_trees_and_sketches_follow_the_similarity():
    assert (near.least_alike(80), near.trees_for(80), near.trees_for(95)) == (0.5, 12, 12)
    assert near.least_alike(60) < 0.3 and near.trees_for(60) > 40 and near.least_alike(100) == 1
