import random
import zlib

from shelfcast.llm import language

SYLLABLES = {"en": "th er on an re he in ed", "fr": "eau que ou é è ai vi", "de": "sch ein ich ä ö ver ung", "xx": "ka ko ku ki ke"}


def text_of(rng, lang, words):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def rows():
    rng = random.Random(0)
    out = []
    for _ in range(500):
        lang = rng.choice(["en"] * 6 + ["fr", "de", "xx"])
        out.append((text_of(rng, lang, rng.randrange(4, 60)), lang, "s"))
    out += [(text_of(rng, "fr", 5000), None, "s"), (None, "en", "s"), ("", "de", "s"), ("123 !? 45", "en", "s"), ("___", None, "s")]
    return out


def test_held_out_accuracy(docs, clashing):
    given = rows()
    df = clashing(docs(*given))
    held = {r.doc_id for r in df.filter(language.held_out()).collect()}
    assert held == {i for i in range(len(given)) if zlib.crc32(str(i).encode()) % 4 == 2}
    classifier = language.learn(df.filter(~language.held_out()))
    assert classifier.languages == ["de", "en", "fr", "xx"]
    got = {r.doc_id: r for r in language.predicted(df, classifier).collect()}
    assert len(got) == len(given) and all(0 <= r.score <= 1 for r in got.values())
    judged = [i for i in held if i < 500]
    assert sum(got[i].lang_pred == given[i][1] for i in judged) >= 0.98 * len(judged)
    assert got[500].lang_pred == "fr"
    assert [got[i].lang_pred for i in (501, 502, 503, 504)] == ["und"] * 4


def test_fitting_is_the_same_in_every_run(docs):
    df = docs(*rows())
    one, two = language.learn(df), language.learn(df.repartition(5))
    texts = [text for text, _, _ in rows()[:50]]
    assert abs(one.scores(texts) - two.scores(texts)).max() < 1e-4


def test_nothing_to_learn_from(docs):
    assert language.learn(docs(("a", None, "s"), (None, "en", "s"))) is None
    got = language.predicted(docs("hello", None), None).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert language.predicted(docs().limit(0), None).collect() == []


def test_one_language(docs):
    classifier = language.learn(docs(("hello there", "en", "s")))
    assert language.predicted(docs("hello there"), classifier).first().lang_pred == "en"
