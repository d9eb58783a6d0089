import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shelfcast.llm.pieces import default_model


@pytest.fixture
def sf_dir(spark, docs, tmp_path):
    rng = random.Random(11)
    good = [" ".join(f"word{rng.randrange(3000)}" for _ in range(rng.randrange(60, 200))) for _ in range(120)]
    poor = [" ".join(f"w{rng.randrange(3000)}$$$" for _ in range(80)) for _ in range(60)]
    texts = [*good, *poor, good[0], good[1] + " tail", "too short", None, ""]
    texts[5] += " password=abcdefgh12345"
    rows = [(text, "en", rng.choice(["a", "b", "c"])) for text in texts]
    docs(*rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(120)] + [(i, 0, 0) for i in range(120, 180)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_every_stage_takes_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        docs = seen[name] = spark.createDataFrame(out.collect(), out.schema)
    ids = {name: [r.doc_id for r in df.collect()] for name, df in seen.items()}
    assert set(ids["quality rules"]) == {*range(120), 180, 181}
    assert set(ids["near-duplicates"]) == set(range(120))
    texts = {r.doc_id: r.text for r in seen["secret scan"].collect()}
    assert texts[5].endswith(" [assign]") and "password" not in "".join(texts.values())
    words = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert 0.9 * 1.5 * words(seen["secret scan"]) <= words(seen["mixture"]) <= 1.5 * words(seen["secret scan"]) + 1


def test_whole_run(spark, sf_dir):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    got = corpus_pipeline.run(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert got and all(0 <= r.doc_id < 120 for r in got)
    for row in got:
        if row.doc_id != 5:
            assert row.ids == library.encode(texts[row.doc_id], add_eos=True) and row.n_tokens == len(row.ids)


def test_every_operator_is_registered_once():
    names = [name for name in entry.queries() if name.startswith("op")]
    numbers = sorted(int(name[2:].split("_")[0]) for name in names if name[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(corpus_pipeline.__dict__) >= {"STAGES", "ORACLE_SQL", "run"}
