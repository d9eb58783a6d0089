import hashlib
import random

import numpy as np
import pytest

from shelfcast.llm import repeats


def brute(texts):
    seen, out = set(), {}
    for i, text in enumerate(texts):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - repeats.LENGTH + 1):
            passage = data[at : at + repeats.LENGTH]
            if passage in seen:
                gone[at : at + repeats.LENGTH] = b"\1" * repeats.LENGTH
            seen.add(passage)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(bytes(gone).replace(b"\0", b" ").split())
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()}


def passages():
    rng = random.Random(5)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "é"]) + str(rng.randrange(300))
    line = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(rng.randrange(0, 90))) for _ in range(80)]
    texts += [texts[3], texts[3], texts[5][:120], line, line[:99], line[:100], line + line, None, "", "z" * 5000, "zy" * 400]
    texts += [f"{word()} {line} {word()}" for _ in range(60)]
    texts += [line[rng.randrange(60) :] + texts[i][: rng.randrange(200)] for i in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [repeats.BLOCK_BYTES, 2_000])
def test_removal_equals_all_passages(docs, clashing, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    texts = passages()
    assert found(repeats.without_repeats(clashing(docs(*texts)))) == brute(texts)


def test_frequent_leads_are_compared_across_buckets(docs, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2_000)
    rng = random.Random(9)
    line = "this one very common line of eighty bytes stands in front of almost every text: "
    texts = [line + " ".join(str(rng.randrange(10**9)) for _ in range(4)) for _ in range(300)]
    texts += [text[: 90 + i] for i, text in enumerate(texts[:60])]
    table = docs(*texts)
    total = sum(map(len, texts))
    splitters = repeats.sampled_splitters(table, total // 2_000 + 1)
    assert len(np.unique(splitters)) < len(splitters)
    assert found(repeats.without_repeats(table)) == brute(texts)


def test_empty_table_and_missing_ids(docs):
    assert repeats.without_repeats(docs().limit(0)).collect() == []
    text = "".join(chr(97 + i * 7 % 26) for i in range(50)) + "".join(chr(97 + i * 11 % 26) for i in range(60))
    got = repeats.without_repeats(docs(text, text, ids=[None, 5])).collect()
    assert {r.doc_id: r.n_removed for r in got} == {5: 0, None: 110}


def test_order_of_words_is_that_of_bytes():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (500, 21)).astype(np.uint8)
    order = repeats.multikey_order(repeats._words(rows))
    assert [rows[i].tobytes() for i in order] == sorted(row.tobytes() for row in rows)


def test_equal_passages_share_an_anchor():
    rng = np.random.default_rng(4)
    passage = rng.integers(97, 100, repeats.LENGTH).astype(np.uint8)
    places = []
    for seed in range(5):
        around = np.random.default_rng(seed).integers(97, 123, 400).astype(np.uint8)
        around[150 : 150 + repeats.LENGTH] = passage
        at, hashes = repeats.anchors(around, np.array([0, 400]))
        inside = (at >= 150) & (at + repeats.GRAM <= 150 + repeats.LENGTH)
        places.append(set(zip(at[inside] - 150, hashes[inside])))
    assert set.intersection(*places)
