import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import tokenfiles

FILE = tokenfiles.default_tokenizer()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def texts():
    rng = random.Random(5)
    signs = list(" ab\n\tIt's'RE<|>éÉß½²µΣςжЖ日😀́İ  \x0b\x0c\r\x1c019.,!'") + ["'ll", "<|endoftext|>", "the ", "hello "]
    out = ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(1200)]
    return [*out, None, "", " ", "a" * 20_000, "!" * 3_000, "日本語 " * 300, "It's THE end<|endoftext|>of it", "É É ﬁ"]


def expected(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_files_hold_what_the_library_gives(docs, clashing, library, tmp_path):
    given = texts()
    manifest = tokenfiles.write_token_files(clashing(docs(*given)), FILE, f"file://{tmp_path}/ids")
    rows = sorted(tokenfiles.digests(docs().sparkSession, f"file://{tmp_path}/ids").collect())
    place = 0
    for row, text in zip(rows, given, strict=True):
        ids = expected(library, text)
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (place, len(ids), crc), text
        place += len(ids)
    assert [row.doc_id for row in rows] == list(range(len(given)))
    assert sum(part["tokens"] for part in manifest["parts"]) == place

    files = tokenfiles.TokenFiles(str(tmp_path / "ids"))
    assert len(files) == len(given) and isinstance(files[3][1], np.ndarray)
    for index in (0, 1, 700, len(given) - 1):
        assert files[index][0] == index and files[index][1].tolist() == expected(library, given[index])
    with pytest.raises(IndexError):
        files[len(given)]
    # Flat: all ids of all parts, in order, and nothing else.
    flat = np.concatenate([np.fromfile(tmp_path / "ids" / f"{part['name']}.ids", "<u2") for part in manifest["parts"]])
    assert flat.tolist() == [i for text in given for i in expected(library, text)]


def test_long_texts_are_cut_at_blanks(docs, library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "CUT", 7)
    encoder = tokenfiles.Encoder(open(FILE, "rb").read(), "H")
    for text in texts():
        ids = np.frombuffer(b"".join(encoder.encode(text or "")), "<u2").tolist()
        assert ids == expected(library, text)[:-1], text


def test_kept_chunks_are_bounded(library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "KEPT", 5)
    encoder = tokenfiles.Encoder(open(FILE, "rb").read(), "H")
    for text in texts()[:300]:
        assert np.frombuffer(b"".join(encoder.encode(text or "")), "<u2").tolist() == expected(library, text)[:-1]
    assert len(encoder.chunks) <= 5 and len(encoder.words) <= 5


def test_null_and_repeated_ids_come_in_order(docs, library, tmp_path):
    table = docs("b", "one", "two", "one", None, "z", ids=[4, None, 4, 4, None, -7])
    tokenfiles.write_token_files(table, FILE, str(tmp_path / "ids"))
    rows = tokenfiles.token_rows(table.sparkSession, str(tmp_path / "ids")).sort("start").collect()
    assert [row.doc_id for row in rows] == [None, None, -7, 4, 4, 4]
    assert [row.start for row in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(6)]
    want = sorted(map(str, (expected(library, text) for text in ("b", "one", "two", "one", None, "z"))))
    assert sorted(str(list(row.ids)) for row in rows) == want


def test_an_empty_table_gives_no_rows(docs, tmp_path):
    manifest = tokenfiles.write_token_files(docs(), FILE, str(tmp_path / "ids"))
    assert manifest["parts"] == []
    assert tokenfiles.digests(docs().sparkSession, str(tmp_path / "ids")).count() == 0
    assert len(tokenfiles.TokenFiles(str(tmp_path / "ids"))) == 0


def test_other_tokenizers_are_used_as_they_are(docs, tmp_path):
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    other, given = Tokenizer.from_file(path), ["It's  a\n\ntext", " b", None, "é " * 50]
    tokenfiles.write_token_files(docs(*given), path, str(tmp_path / "ids"), end_id=70_000)
    rows = tokenfiles.token_rows(docs().sparkSession, str(tmp_path / "ids")).sort("doc_id").collect()
    assert [list(row.ids) for row in rows] == [[*other.encode(t or "", add_special_tokens=False).ids, 70_000] for t in given]


def test_the_query_equals_the_library(spark, library, tmp_path):
    rows = [(i, text) for i, text in enumerate(texts()[:200])]
    spark.createDataFrame(rows, "doc_id bigint, text string").sort(F.desc("doc_id")).write.parquet(f"{tmp_path}/documents.parquet")
    found = tokenfiles.op13_token_files(spark, str(tmp_path)).sort("doc_id").collect()
    place = 0
    for row, (i, text) in zip(found, rows, strict=True):
        ids = expected(library, text)
        assert tuple(row) == (i, place, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        place += len(ids)
