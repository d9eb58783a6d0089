"""SentencePiece encoding that keeps the place of every piece in the bytes of the source.

Normalising looks for the longest prefix in the model's compiled character map and notes, for each
byte it writes, which source bytes it came from. BPE merging then runs on the marked text, chunk by
chunk: no piece of the vocabulary has a word mark after another character, so no merge can cross
the start of a word. Chunks recur, so each worker keeps what it has found for the short ones, up
to a fixed number.

A null text counts as empty. An empty text has no piece but the end id. Rows that repeat are
encoded each; extra columns are left out.
"""

from __future__ import annotations

import heapq
import re
import struct
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.common import documents, per_text

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# Kept chunks per worker, and the longest text of a kept one: bounds memory, not results.
KEPT, KEPT_CHARS = 400_000, 40
# Chunks above this many characters merge by a heap; the result is the same.
LONG, NEVER = 100, float("inf")
# Kinds of pieces in a model file.
NORMAL, USER, BYTE = 1, 4, 6


@dataclass
class CharacterMap:
    """The compiled map of a model: a double-array trie of UTF-8 prefixes and their replacements."""

    units: tuple[int, ...]
    targets: bytes

    @staticmethod
    def of(blob: bytes) -> CharacterMap | None:
        if not blob:
            return None
        size = struct.unpack_from("<I", blob)[0]
        return CharacterMap(struct.unpack_from(f"<{size // 4}I", blob, 4), blob[4 + size :])

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix at `at`, and what replaces it."""
        units, node, found = self.units, 0, None
        node ^= self._offset(units[0])
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(units) or units[node] & 0x800000FF != data[end]:
                break
            leaf = units[node] >> 8 & 1
            node ^= self._offset(units[node])
            if leaf:
                first = units[node] & 0x7FFFFFFF
                found = end + 1 - at, self.targets[first : self.targets.index(0, first)]
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)


@dataclass
class Model:
    """What encoding needs of a model file."""

    ranks: dict[str, int]
    costs: dict[str, float]
    bytes_first: int
    end: int
    prefix: bool
    squeeze: bool
    mark: bool
    map: CharacterMap | None

    @staticmethod
    def of(blob: bytes) -> Model:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        kinds = [piece.type for piece in proto.pieces]
        if proto.trainer_spec.model_type != 2 or USER in kinds or BYTE not in kinds:
            raise ValueError("only BPE models with byte fallback and without own symbols are known")
        ranks = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in ranks):
            raise ValueError("a piece reaches over the start of a word")
        # Better scores merge first.
        costs = {piece: -proto.pieces[i].score for piece, i in ranks.items()}
        spec = proto.normalizer_spec
        return Model(
            ranks,
            costs,
            kinds.index(BYTE),
            proto.trainer_spec.eos_id,
            spec.add_dummy_prefix,
            spec.remove_extra_whitespaces,
            spec.escape_whitespaces,
            CharacterMap.of(spec.precompiled_charsmap),
        )


def normalized(text: str, model: Model) -> tuple[str, list[int] | None]:
    """The marked text, and for each of its characters the source byte where it begins.

    The places are None where every character stands for itself, so that they follow from the text.
    """
    if not text:
        return "", None
    space = MARK if model.mark else " "
    if model.map is None and not model.squeeze:
        return (space if model.prefix else "") + text.replace(" ", space), None
    data, out, places, at = text.encode(), [], [], 0
    while at < len(data):
        found = model.map.longest(data, at) if model.map else None
        if found is None:
            length = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
            found = length, data[at : at + length]
        for char in found[1].decode():
            if not (char == " " and model.squeeze and (not out or out[-1] == " ")):
                out.append(char)
                places.append(at)
        at += found[0]
    while model.squeeze and out and out[-1] == " ":
        out.pop()
        places.pop()
    if not out:
        return "", []
    if model.prefix:
        out.insert(0, " ")
        places.insert(0, places[0])
    return "".join(out).replace(" ", space), [*places, len(data)]


def merged(chunk: str, costs: dict[str, float]) -> list[str]:
    """The chunk's symbols after all merges: lowest cost first, then leftmost."""
    if len(chunk) > LONG:
        return _merged_long(chunk, costs)
    symbols = list(chunk)
    pairs = [costs.get(a + b, NEVER) for a, b in pairwise(symbols)]
    while pairs:
        least = min(pairs)
        if least == NEVER:
            break
        at = pairs.index(least)
        joined = symbols[at] = symbols[at] + symbols.pop(at + 1)
        pairs.pop(at)
        if at:
            pairs[at - 1] = costs.get(symbols[at - 1] + joined, NEVER)
        if at < len(pairs):
            pairs[at] = costs.get(joined + symbols[at + 1], NEVER)
    return symbols


def _merged_long(chunk: str, costs: dict[str, float]) -> list[str]:
    """The same with a heap, for texts without blanks: n log n instead of a scan for every merge."""
    symbols: list[str | None] = list(chunk)
    last = len(symbols)
    before, after = list(range(-1, last - 1)), list(range(1, last + 1))
    heap: list[tuple[float, int, str]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < last:
            pair = symbols[left] + symbols[right]
            if pair in costs:
                heapq.heappush(heap, (costs[pair], left, pair))

    for i in range(last):
        offer(i)
    while heap:
        _, left, pair = heapq.heappop(heap)
        right = after[left] if symbols[left] is not None else last
        if right >= last or symbols[left] + symbols[right] != pair:
            continue
        symbols[left], symbols[right] = pair, None
        after[left] = after[right]
        if after[right] < last:
            before[after[right]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [symbol for symbol in symbols if symbol is not None]


class Encoder:
    """Encodes the texts of one task; keeps what it found for short chunks."""

    def __init__(self, model: Model):
        self.model = model
        self.kept: dict[str, tuple[int, ...]] = {}
        # Characters each id begins, and those its span covers: a byte covers its whole character.
        lead = [int(not 0x80 <= byte < 0xC0) for byte in range(256)]
        first = model.bytes_first
        size = max(max(model.ranks.values(), default=0), first + 255, model.end) + 1
        self.begins = np.zeros(size, np.int64)
        for piece, i in model.ranks.items():
            self.begins[i] = len(piece)
        self.covers = self.begins.copy()
        self.covers[first : first + 256] = 1
        self.begins[first : first + 256] = lead

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        ranks, first, ids = self.model.ranks, self.model.bytes_first, []
        for symbol in merged(chunk, self.model.costs):
            if symbol in ranks:
                ids.append(ranks[symbol])
            else:
                ids += [first + byte for byte in symbol.encode()]
        if len(chunk) <= KEPT_CHARS:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            self.kept[chunk] = tuple(ids)
        return tuple(ids)

    def ids(self, marked: str) -> list[int]:
        """Ids of a normalised text, without the end id."""
        kept, out = self.kept, []
        for chunk in CHUNK.findall(marked):
            out += kept.get(chunk) or self._chunk(chunk)
        return out

    def pieces(self, text: str) -> tuple[list[int], np.ndarray]:
        """Ids with the end id, and the source bytes [start, end) of each as rows."""
        marked, places = normalized(text, self.model)
        ids = self.ids(marked)
        if places is None:  # every character stands for itself; the mark in front has no source
            places = _byte_places(text, self.model.prefix and bool(text))
        else:
            places = np.array(places or [0], np.int64)
        index = np.array(ids, np.int64)
        begun = np.cumsum(self.begins[index])
        spans = np.empty((len(ids) + 1, 2), np.int64)
        spans[:-1, 0] = places[begun - self.covers[index]]
        spans[:-1, 1] = places[begun]
        spans[-1] = places[-1] if places[-1] or not text else len(text.encode())
        return [*ids, self.model.end], spans


def _byte_places(text: str, prefixed: bool) -> np.ndarray:
    """The byte where each character begins, and the end; twice 0 in front where a mark has been put there."""
    if text.isascii():
        places = np.arange(len(text) + 1)
    else:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        places = np.concatenate([[0], np.cumsum(width)])
    return np.concatenate([[0], places]) if prefixed else places


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, and the source bytes [starts, ends) of each id; the end id stands at the text's end."""
    model = Model.of(open(model_path, "rb").read())

    def rows_of(batches):
        encoder = Encoder(model)
        for batch in batches:
            found = [encoder.pieces(text or "") for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "ids": [ids for ids, _ in found],
                "starts": [spans[:, 0].astype(np.int32) for _, spans in found],
                "ends": [spans[:, 1].astype(np.int32) for _, spans in found],
            }

    schema = "doc_id bigint, ids array<int>, starts array<int>, ends array<int>"
    return per_text(docs, ["doc_id", "text"], rows_of, schema)


def tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, source, lang, n_tokens and ids of each text, for training."""
    model = Model.of(open(model_path, "rb").read())

    def rows_of(batches):
        encoder = Encoder(model)
        for batch in batches:
            ids = [[*encoder.ids(normalized(text or "", model)[0]), model.end] for text in batch.pop("text")]
            yield batch | {"n_tokens": list(map(len, ids)), "ids": ids}

    schema = "doc_id bigint, source string, lang string, n_tokens bigint, ids array<int>"
    return per_text(docs, ["doc_id", "source", "lang", "text"], rows_of, schema)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Number and digest of the ids of each text, the digest of the text decoded from them, and of their spans.

    `spans_sha256` is of start and end of every id as little-endian 64-bit numbers.
    """
    blob = open(model_path, "rb").read()
    model = Model.of(blob)

    def rows_of(batches):
        import hashlib

        import sentencepiece

        encoder = Encoder(model)
        decoder = sentencepiece.SentencePieceProcessor(model_proto=blob)
        written = list(map(str, range(len(encoder.covers))))
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            out = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "spans_sha256": []}
            for text in batch["text"]:
                ids, spans = encoder.pieces(text or "")
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha(" ".join(map(written.__getitem__, ids))))
                out["decoded_sha256"].append(sha(decoder.decode(ids)))
                out["spans_sha256"].append(hashlib.sha256(spans.astype("<i8").tobytes()).hexdigest())
            yield out

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string"
    return per_text(docs, ["doc_id", "text"], rows_of, schema)


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), default_model())
