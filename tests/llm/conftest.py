import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside, as columns of the table.
CLASHES = "size draw bin times target component_id kept digest rep n_words spans block shard rank source_size".split()


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (text, lang, source); ids count from 0 unless given."""

    def build(*texts, ids=None):
        rows = []
        for i, row in enumerate(texts):
            text, lang, source = row if isinstance(row, tuple) else (row, "en", "a")
            rows.append((i if ids is None else ids[i], text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture
def clashing():
    """The table with columns of names that operators use, and without them."""
    return lambda df: df.withColumns({name: F.lit("x") for name in CLASHES})


def prose(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def mutated(rng, text, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies of all kinds, blank ones, and very long ones."""
    rng = random.Random(7)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(60)]
    shared = prose(rng, 60)
    texts = [*base, *base[:10], None, "", " \n\t", "one", "one", "ONE", shared]
    texts += [mutated(rng, base[i], share) for i in range(40) for share in (0.02, 0.05, 0.1)]
    texts += [f"{prose(rng, 5)} {shared} {prose(rng, 5)}" for _ in range(30)]
    texts += [prose(rng, 6000, 5000), "a" * 20_000, "é" * 3_000, "ab " * 4_000, "日本語 テキスト。" * 50]
    rng.shuffle(texts)
    return texts
