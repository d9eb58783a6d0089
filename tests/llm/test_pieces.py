import hashlib
import random
import struct

import pytest
import sentencepiece

from shelfcast.llm import pieces

MODEL = pieces.default_model()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    rng = random.Random(2)
    signs = list(" ab\n▁éЖ日😀thei  nsT.,<>0x1\t ​")
    out = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(1500)]
    return [*out, None, "", " ", "  a  b ", "<s></s><unk><0x0A>", "\x00", "a" * 30_000, " " * 5_000, "日本語" * 300, "ab" * 60]


def test_ids_and_decoded_texts_equal_the_library(docs, clashing, library):
    given = texts()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = pieces.digests(clashing(docs(*given)), MODEL).collect()
    assert len(rows) == len(given)
    for row in rows:
        ids = library.encode(given[row.doc_id] or "", add_eos=True)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert row.decoded_sha256 == sha(library.decode(ids))
    spans = {row.doc_id: list(zip(row.starts, row.ends, strict=True)) for row in pieces.encoded(docs(*given), MODEL).collect()}
    for row in rows:
        packed = b"".join(struct.pack("<qq", *span) for span in spans[row.doc_id])
        assert row.spans_sha256 == hashlib.sha256(packed).hexdigest()


def test_spans_equal_those_of_the_library(docs, library):
    """The library's own byte offsets, for pieces that are no single bytes of a character."""
    given = [text for text in texts() if text]
    for row in pieces.encoded(docs(*given), MODEL).collect():
        text = given[row.doc_id]
        want = [(p.id, p.begin, p.end) for p in library.encode_as_proto(text).pieces]
        got = list(zip(row.ids, row.starts, row.ends, strict=True))[:-1]
        assert [i for i, *_ in got] == [i for i, *_ in want]
        for (i, start, end), (_, begin, stop) in zip(got, want, strict=True):
            if not library.is_byte(i):
                assert (start, end) == (begin, stop)


def test_spans_cover_the_source(docs, library):
    given = texts()
    for row in pieces.encoded(docs(*given), MODEL).collect():
        data, at = (given[row.doc_id] or "").encode(), 0
        for piece, start, end in list(zip(row.ids, row.starts, row.ends, strict=True))[:-1]:
            assert start <= at <= end or start == at
            at = max(at, end)
            name = library.id_to_piece(piece)
            if not name.startswith("<0x"):
                surface = data[start:end].decode().replace(" ", "▁")
                assert name in (surface, "▁" + surface)
        assert at == len(data) and row.starts[-1] == row.ends[-1] == len(data)


def test_long_and_short_chunks_merge_alike(monkeypatch):
    model = pieces.Model.of(open(MODEL, "rb").read())
    rng = random.Random(8)
    for _ in range(300):
        chunk = "▁" + "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 90)))
        assert pieces.merged(chunk, model.costs) == pieces._merged_long(chunk, model.costs)


def test_a_character_map_takes_the_longest_prefix_and_keeps_places():
    """A map by hand: "A" becomes "a", "ABC" becomes "x", and a character may become nothing."""
    model = pieces.Model.of(open(MODEL, "rb").read())

    class Map:
        known = {b"A": b"a", b"ABC": b"x", "é".encode(): b"e\xcc\x81", b"\t": b" ", b"#": b""}

        def longest(self, data, at):
            found = [k for k in self.known if data.startswith(k, at)]
            return (len(max(found, key=len)), self.known[max(found, key=len)]) if found else None

    model.map, model.squeeze = Map(), True
    assert pieces.normalized("AABC é\t\t#b ", model) == ("▁ax▁e\u0301▁b", [0, 0, 1, 4, 5, 5, 7, 10, 12])


def test_compiled_maps_are_read_as_double_arrays():
    """One prefix, "a" -> "bc", compiled by hand: root, node of "a", and the leaf that holds its value."""
    units = [0] * 512
    root_offset = 256
    units[0] = root_offset << 10
    node = root_offset ^ ord("a")
    units[node] = ord("a") | 1 << 8 | (1 << 10)
    units[node ^ 1] = 0x80000000 | 0
    blob = struct.pack("<I", len(units) * 4) + struct.pack(f"<{len(units)}I", *units) + b"bc\0"
    found = pieces.CharacterMap.of(blob)
    assert found.longest(b"ab", 0) == (1, b"bc") and found.longest(b"b", 0) is None
    assert pieces.CharacterMap.of(b"") is None


def test_empty_table(docs):
    assert pieces.digests(docs().limit(0), MODEL).collect() == []
    assert pieces.tokens(docs("a", None), MODEL).count() == 2
