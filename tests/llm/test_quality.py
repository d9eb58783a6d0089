import random
from collections import Counter

import numpy as np

from shelfcast.llm import quality


def brute(text):
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, marked, seen, again = Counter(windows), set(), set(), 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            marked |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if line.encode().split():
            again += line in seen
            seen.add(line)
    chars = sum(c not in " \t\n\x0b\x0c\r" for c in text)
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), again, len(marked))


def test_counts_equal_counting_by_hand(docs, clashing, corpus):
    rng = random.Random(6)
    texts = [*corpus, "a b c a b c", "a a a a", "x\nx\n\n \nx", " a b\x1cc #|é\r\nq", "$ % &"]
    texts += ["".join(rng.choice("ab \n|é") for _ in range(rng.randrange(80))) for _ in range(300)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality.statistics(clashing(docs(*texts))).collect()}
    assert got == {i: brute(text) for i, text in enumerate(texts)}


def labelled(spark, docs, n=600):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(n):
        words = [f"word{rng.randrange(5000)}" for _ in range(rng.randrange(55, 120))]
        poor = i % 4 == 0
        if poor:
            words = [w + rng.choice(["$$$", "|", "###"]) for w in words] if i % 8 else [w.upper() + "!!" for w in words]
        texts.append(" ".join(words))
        labels.append((i, 0 if poor else 1, 0))
    return docs(*texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), texts


def test_rules_find_poor_texts_and_keep_the_others(spark, docs, clashing):
    df, labels, _ = labelled(spark, docs)
    rules = quality.learn(df, labels)
    assert rules and all(isinstance(term.limit, float) for rule in rules for term in rule)
    got = quality.judged(df, labels).collect()
    wrong = [r.doc_id for r in got if r.kept != (r.doc_id % 4 != 0)]
    assert len(wrong) <= 6 and all(i % 4 == 0 for i in wrong)
    table = clashing(df)
    kept = quality.good_documents(table, labels)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}


def test_the_verdict_is_one_ordered_conditional(spark):
    rules = [(quality.Term("symbols", True, 0.5),), (quality.Term("marks", True, 0.2), quality.Term("words", False, 9.0))]
    text = str(quality.accepts(rules))
    assert text.count("THEN false") == 2 and text.index("n_symbols") < text.index("n_marks")
    assert "true" in str(quality.accepts([])).lower()


def test_base_rule_and_texts_without_words(spark, docs):
    short, long = "a b c", " ".join(f"w{i}" for i in range(50))
    half = " ".join(["x y z"] * 10 + [f"w{i}" for i in range(30)])
    more = " ".join(["x y z"] * 11 + [f"w{i}" for i in range(30)])
    labels = spark.createDataFrame([(1, None, None), (None, 0, 0), (99, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judged(docs(short, long, half, more, None, ""), labels).collect()}
    assert got == {0: (True, False), 1: (False, True), 2: (False, True), 3: (True, False), 4: (True, False), 5: (True, False)}


def test_empty_tables(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.judged(docs().limit(0), labels).collect() == []
    assert quality.good_documents(docs().limit(0), labels).collect() == []


def test_noise_teaches_nothing():
    rng = np.random.default_rng(0)
    table = {"a": rng.random(900), "b": rng.random(900)}
    poor = rng.random(900) < 0.3
    assert quality.learned(table, poor, np.arange(900) % 3 == 0) == []
