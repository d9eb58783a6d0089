import hashlib
import random

import pytest

from shelfcast.llm import mixing


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by giving out the budget again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held, budget = set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in held]
        left = budget - sum(most * sizes[s] for s in held)
        target = {s: weight[s] * left / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target | {s: most * sizes[s] for s in held}
        held |= over


def table(docs, clashing):
    rng = random.Random(4)
    names = ["b", "a", None, "é", "c", "B", "empty", "hot"]
    rows = []
    for _ in range(900):
        name = rng.choice([*names, *["hot"] * 4])
        count = 0 if name == "empty" else rng.choice([0, 1, 5, 30, 200])
        rows.append((rng.choice([" ".join(["w"] * count), " \n\t".join(["w"] * count)]) if count else rng.choice([None, "", "  "]), "en", name))
    return rows, clashing(docs(*rows))


def test_targets_and_taken_words(docs, clashing):
    rows, df = table(docs, clashing)
    sizes = {}
    for text, _, name in rows:
        sizes[name] = sizes.get(name, 0) + len((text or "").split())
    target = filled(sizes)
    taken = dict.fromkeys(sizes, 0)
    got = mixing.mixed(df).collect()
    assert len(got) == len(rows)
    for row in got:
        text, _, name = rows[row.doc_id]
        assert row.size == len((text or "").split()) and row.source_size == sizes[name]
        assert row.target == pytest.approx(target[name])
        assert 0 <= row.times <= 2
        taken[name] += row.size * row.times
    for name in sizes:
        assert taken[name] <= target[name] + 1e-6
        assert taken[name] >= target[name] - 2
    again = mixing.mixed(df.repartition(3)).collect()
    assert {r.doc_id: r.times for r in again} == {r.doc_id: r.times for r in got}
    other = mixing.mixed(df, seed="other").collect()
    assert {r.doc_id: r.times for r in other} != {r.doc_id: r.times for r in got}


def test_documents_come_as_often_as_they_are_taken(docs, clashing):
    rows, df = table(docs, clashing)
    times = {r.doc_id: r.times for r in mixing.mixed(df).collect()}
    got = mixing.repeated(df)
    assert got.columns == df.columns
    counts = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in times.items() if n}


def test_a_target_is_filled_until_nothing_fits(docs):
    """Long documents drawn first leave room that only the short ones behind them fill."""
    sizes = [10, 995, 10, 985, 10, 975, *[10] * 80, 300, 200, 50, 7, 3, 2]
    rows = [(" ".join(["w"] * n), "en", "s") for n in sizes]
    got = mixing.mixed(docs(*rows), share=0.3).collect()
    order = sorted(got, key=lambda r: (draw_of(r.doc_id) % mixing.BINS, draw_of(r.doc_id), r.doc_id))
    left = got[0].target
    for row in order:  # one walk in the order of the draw
        fits = row.size <= left
        assert row.times == fits
        left -= row.size * fits
    assert all(row.size > left for row in got if not row.times)


def draw_of(doc_id):
    return int(hashlib.md5(f"{mixing.SEED}:{doc_id}".encode()).hexdigest()[:15], 16)


def test_rows_of_one_id_are_told_apart_by_their_text(docs):
    same = mixing.mixed(docs("a b c d e", "a b c d e", "a b c d e", ids=[4, 4, 4]), share=0.5).collect()
    assert sum(r.size * r.times for r in same) == 0  # 15 words do not fit into 7.5
    apart = mixing.mixed(docs("a b c d e", "f g h i j", "k l m n o", "p q r s t", ids=[4, 4, None, None]), share=0.6).collect()
    assert sorted(r.times for r in apart) == [0, 0, 1, 1]
    table = docs("a b", "c d", "c d", "e f", None, ids=[4, 4, None, None, None])
    got = mixing.repeated(table, share=2.0).collect()
    assert sorted((r.doc_id or -1, r.text) for r in got) == sorted([(4, "a b"), (4, "c d"), (-1, "c d"), (-1, "e f")] * 2)


def test_small_tables(docs):
    assert mixing.mixed(docs().limit(0)).collect() == []
    got = mixing.mixed(docs(None, "")).collect()
    assert [(r.size, r.source_size, r.target, r.times) for r in got] == [(0, 0, 0.0, 0)] * 2
    one = mixing.mixed(docs(("a b c d", "en", "s"), ("a b", "en", "s"))).collect()
    assert sum(r.size * r.times for r in one) in (8, 9) and one[0].target == 9.0
    same = mixing.mixed(docs("a b", "a b", "a b", ids=[1, 1, None]))
    assert same.count() == 3
