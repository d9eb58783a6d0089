import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    """Every prefix as a tuple of turns, and all sums by walking over all pairs of prefixes."""
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, key(role, text), role or "", text or ""))
    turns = {conv: [(role, text) for *_, role, text in sorted(own)] for conv, own in given.items()}
    whole = {}
    for conv, own in turns.items():
        head = zlib.crc32(str(conv).encode()) % 9
        whole[conv] = tuple(turns.get(conv - int(math.fmod(conv, 5)), [])[:head] + own[head:])
    members = defaultdict(list)
    for conv in sorted(whole):
        for depth in range(len(whole[conv]) + 1):
            members[whole[conv][:depth]].append(conv)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    out = set()
    for path, own in members.items():
        under = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in own if len(whole[c]) == len(path))
        out.add((
            own[0], len(path), members[path[:-1]][0] if path else None, len(own), len(children[path]),
            sum(not children[p] for p in under), sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in under if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def key(role, text):
    return hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def chats(seed=1, count=120, longest=12):
    rng, rows = random.Random(seed), []
    for conv in rng.sample(range(2 * count), count):
        for turn in range(rng.randrange(longest)):
            rows.append((conv, turn, rng.choice(["user", "bot"]), rng.choice(["a", "bé", "", "日本", "long " * 20])))
    rng.shuffle(rows)
    return rows


def found(df):
    rows = [tuple(row) for row in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force(table):
    rows = chats()
    assert found(trie.prefix_trie(table(rows))) == brute(rows)


def test_segments_and_shards_do_not_change_the_trie(table, monkeypatch):
    rows = chats(2, 30, 30)
    rows += [(conv, turn, "user", "same") for conv in (1000, 1003) for turn in range(100)]
    monkeypatch.setattr(trie, "SEGMENT", 4)
    monkeypatch.setattr(trie, "SHARD", 10)
    monkeypatch.setattr(trie, "SHARD_SEGMENTS", 3)
    assert found(trie.prefix_trie(table(rows))) == brute(rows)


def test_hot_conversations(table, monkeypatch):
    """One conversation many times, and ids whose texts do not sort as numbers do."""
    monkeypatch.setattr(trie, "SHARD", 1024)
    monkeypatch.setattr(trie, "SHARD_SEGMENTS", 7)
    rows = [(conv, turn, "user", f"t{turn}") for conv in [*range(0, 1500, 5), *range(-12, 0)] for turn in range(3)]
    rows += chats(3, 10)
    assert found(trie.prefix_trie(table(rows))) == brute(rows)


def test_nulls_ties_and_repeated_rows(table):
    rows = [
        (None, 1, "user", "x"), (0, None, None, None), (0, 2, "user", "b"), (0, 2, "user", "a"), (0, 2, "user", "a"),
        (1, 1, "", ""), (7, None, "user", None), (7, None, "user", ""), (2, 5, "user", "a" * 100_000), (3, -1, "u", "ser"),
        (3, -2, "us", "er"),
    ]
    extra = {name: F.lit("x") for name in ("a", "b", "n", "pos", "key", "segment", "rank", "depth", "weight", "first", "head")}
    assert found(trie.prefix_trie(table(rows).withColumns(extra))) == brute(rows)


def test_conversations_without_turns_end_at_the_root(table):
    # The base of 4 is absent, and its own turn is part of the head that is left out.
    rows = [(conv, 0, "user", "x") for conv in (4, 6, 9)]
    got = found(trie.prefix_trie(table(rows)))
    assert got == brute(rows)
    assert any(row[1] == 0 and row[7] != hashlib.sha256(b"").hexdigest() for row in got)


def test_empty_table(table):
    out = trie.prefix_trie(table([]))
    assert out.count() == 0 and out.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
