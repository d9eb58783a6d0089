import math
from collections import Counter

from shelfcast.llm import scoring


def brute(texts):
    words = [(text or "").encode().split() for text in texts]
    grams = [[Counter(zip(*[w[k:] for k in range(n + 1)])) for n in range(3)] for w in words]
    total = [sum((own[n] for own in grams), Counter()) for n in range(3)]
    size, out = sum(map(len, words)), {}
    for i, own in enumerate(words):
        rest, score = max(size - len(own), 1), 0.0
        count = lambda gram, i=i: total[len(gram) - 1][gram] - grams[i][len(gram) - 1][gram]
        for at, word in enumerate(own):
            factor = 1.0
            for n in range(min(2, at), -1, -1):
                gram = tuple(own[at - n : at + 1])
                if n == 0:
                    share = count(gram) / rest if count(gram) else 0.4 / rest
                    score += math.log(factor * share)
                elif count(gram):
                    score += math.log(factor * count(gram) / count(gram[:-1]))
                    break
                else:
                    factor *= 0.4
        out[i] = (len(own), score)
    return out


def check(got, texts):
    want = brute(texts)
    assert len(got) == len(texts)
    for row in got:
        assert row.n_words == want[row.doc_id][0]
        assert math.isclose(row.log_score, want[row.doc_id][1], rel_tol=1e-9, abs_tol=1e-9)


def test_scores_equal_counting_by_hand(docs, clashing, corpus):
    check(scoring.scored(clashing(docs(*corpus))).collect(), corpus)


def test_many_blocks(docs, corpus, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 3_000)
    check(scoring.scored(docs(*corpus)).collect(), corpus)


def test_edges(docs):
    assert scoring.scored(docs().limit(0)).collect() == []
    check(scoring.scored(docs("only one")).collect(), ["only one"])
    check(scoring.scored(docs(None, "", "a", "a a a a")).collect(), [None, "", "a", "a a a a"])
