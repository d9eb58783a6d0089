"""Token ids of documents as flat binary files that can be memory-mapped.

A folder holds, for every part, `<part>.ids` (all ids one after another, unsigned, 16 bits where the
vocabulary allows, else 32, little-endian), `<part>.offsets` (64-bit, where each document's ids begin in
the part, and their end), and `<part>.docs` (64-bit document ids; those of the first `nulls` documents of
the part are null). `manifest.json` lists the parts in order with how many documents and ids stand before
each: prefix sums over the parts, so an id's place in the whole corpus is its place in its part plus one number.

Documents are range-partitioned by id and every partition writes its own part, a batch in memory at a
time. A part's name is new for each attempt of a task, and the manifest, written last, names only those
of attempts that succeeded; files of failed ones are never read.

Documents stand in ascending order of their id, null first; documents of one id by a hash of their text.
A null text counts as empty and has the end id alone. Rows that repeat are written each. An empty table
gives a manifest without parts or with empty ones, and no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import documents, shared_folder

END_ID = 2
# Texts are cut at blanks after so many characters while they are encoded; documents that are read at once.
CUT, READ = 1 << 20, 4096
# Chunks and words that a worker keeps the ids of, at most, and the longest kept one: bounds memory, not results.
KEPT, KEPT_CHARS = 700_000, 64

# The steps of a tokenizer file under which chunks between blanks are encoded alone.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters for which the steps above are plain: no composition, letters and digits told apart by range.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
PLAIN_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte which has none of its own in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {byte: chr(256 + n) for n, byte in enumerate(b for b in range(256) if b not in own)}


class _Kept(dict):
    """What was found for short keys, up to a number."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, key: str) -> bytes:
        found = self.find(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
            self[key] = found
        return found


class Encoder:
    """Ids of texts, exactly as the library gives them for the whole text, as bytes.

    Where the file's steps are those known above, nothing joins what blanks part, so the library encodes
    the chunks between blanks, and of plain chunks the words, and each is encoded once. Other files are
    encoded text by text.
    """

    def __init__(self, blob: bytes, kind: str):
        from tokenizers import Tokenizer

        self.kind = kind
        self.library = Tokenizer.from_str(blob.decode())
        self.model = self.library.model
        spec = json.loads(blob)
        # Marks of added tokens, which are looked for before words are told apart.
        self.added = [token["content"] for token in spec.get("added_tokens") or []]
        self.signs = _byte_signs()
        self.words = _Kept(self._word)
        self.chunks = _Kept(self._chunk)
        self.by_chunk = _known_steps(spec)

    def _bytes(self, ids) -> bytes:
        out = array(self.kind, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _word(self, word: str) -> bytes:
        signs = word if word.isascii() else word.encode().decode("latin1").translate(self.signs)
        return self._bytes([token.id for token in self.model.tokenize(signs)])

    def _chunk(self, chunk: str) -> bytes:
        if not PLAIN.fullmatch(chunk) or any(token in chunk for token in self.added):
            return self._bytes(self.library.encode(chunk, add_special_tokens=False).ids)
        return b"".join([self.words[word] for word in PLAIN_WORDS.findall(chunk.lower())])

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids in pieces."""
        if not self.by_chunk:
            yield self._bytes(self.library.encode(text, add_special_tokens=False).ids)
            return
        chunks, at = self.chunks, 0
        while at < len(text):
            end = text.find(" ", at + CUT) if len(text) > CUT else -1
            end = len(text) if end < 0 else end
            part = text[at:end].replace("\n", " ").replace("\t", " ").replace("\r", " ")
            yield b"".join([chunks[chunk] for chunk in part.split(" ") if chunk])
            at = end


def _encoder(blob: bytes, kind: str) -> Encoder:
    """The encoder of this process: tasks that follow each other in a worker go on with what it keeps."""
    held = vars(sys).setdefault("_token_file_encoders", {})
    key = hashlib.sha256(blob).digest(), kind
    if key not in held:
        held.clear()
        held[key] = Encoder(blob, kind)
    return held[key]


def _known_steps(spec: dict) -> bool:
    normalizer, before, model = (spec.get(part) or {} for part in ("normalizer", "pre_tokenizer", "model"))
    steps = normalizer.get("normalizers") or []
    blanks = [step for step in steps if step["type"] == "Replace"]
    cuts = before.get("pretokenizers") or []
    tokens = spec.get("added_tokens") or []
    return (
        [step["type"] for step in steps] == NORMALIZERS
        and all(step["pattern"] == {"Regex": r"\s+"} and step["content"] == " " for step in blanks)
        and [cut["type"] for cut in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["pattern"], cuts[0]["behavior"], cuts[0]["invert"]) == ({"Regex": WORDS}, "Removed", True)
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]) for t in tokens)
        and not spec.get("truncation")
    )


def _opened(folder: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    path = re.sub("^file:/*", "/", folder)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> dict:
    """Writes the ids of all documents, each with the end id behind them; gives the manifest.

    `tokenizer` is a file of the tokenizers library, read by the driver; `folder` is one that all executors
    share, new or empty.
    """
    from tokenizers import Tokenizer

    blob = open(tokenizer, "rb").read()
    size = max(Tokenizer.from_str(blob.decode()).get_vocab_size(), end_id + 1)
    kind = "H" if size <= 1 << 16 else "I"
    system, path = _opened(folder)
    system.create_dir(path, recursive=True)

    def write(batches):
        system, path = _opened(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        encoder = _encoder(blob, kind)
        end = encoder._bytes([end_id])
        width, tokens, count, nulls = len(end), 0, 0, 0
        with (
            system.open_output_stream(f"{path}/{name}.ids") as ids,
            system.open_output_stream(f"{path}/{name}.offsets") as offsets,
            system.open_output_stream(f"{path}/{name}.docs") as names,
        ):
            for batch in batches:
                places = array("Q")
                for text in batch.column(1):
                    places.append(tokens)
                    for part in encoder.encode(text.as_py() or ""):
                        ids.write(part)
                        tokens += len(part) // width
                    ids.write(end)
                    tokens += 1
                offsets.write(np.asarray(places, "<u8").tobytes())
                names.write(batch.column(0).fill_null(0).to_numpy().astype("<i8").tobytes())
                count, nulls = count + batch.num_rows, nulls + batch.column(0).null_count
            offsets.write(np.asarray([tokens], "<u8").tobytes())
        part = TaskContext.get().partitionId(), name, count, nulls, tokens
        yield pa.RecordBatch.from_pylist([dict(zip(["part", "name", "documents", "nulls", "tokens"], part, strict=True))])

    order = [F.asc_nulls_first("doc_id"), F.col("tie")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    parts = rows.mapInArrow(write, "part bigint, name string, documents bigint, nulls bigint, tokens bigint").collect()
    parts = sorted((row.asDict() for row in parts if row["documents"]), key=lambda row: row["part"])
    for name in ("documents", "tokens"):
        for part, before in zip(parts, accumulate((part[name] for part in parts), initial=0)):
            part[f"{name}_before"] = before
    manifest = {"ids": {"H": "<u2", "I": "<u4"}[kind], "end_id": end_id, "parts": parts}
    with system.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


class TokenFiles:
    """The documents of a folder by their number; local files are mapped, others read in ranges."""

    def __init__(self, folder: str):
        self.system, self.path = _opened(folder)
        with self.system.open_input_file(f"{self.path}/manifest.json") as file:
            self.manifest = json.loads(file.read())
        self.parts = self.manifest["parts"]
        self.firsts = [part["documents_before"] for part in self.parts]
        self.maps: dict[str, np.ndarray | object] = {}

    def __len__(self) -> int:
        return self.firsts[-1] + self.parts[-1]["documents"] if self.parts else 0

    def _values(self, part: dict, what: str, kind: str, start: int, end: int) -> np.ndarray:
        name = f"{self.path}/{part['name']}.{what}"
        if start == end:
            return np.empty(0, kind)
        if name not in self.maps:
            local = self.system.type_name == "local"
            self.maps[name] = np.memmap(name, kind, "r") if local else self.system.open_input_file(name)
        file = self.maps[name]
        if isinstance(file, np.ndarray):
            return file[start:end]
        width = np.dtype(kind).itemsize
        return np.frombuffer(file.read_at((end - start) * width, start * width), kind)

    def slice(self, number: int, first: int, last: int) -> tuple[list[int | None], np.ndarray, list[np.ndarray]]:
        """Ids, places in the corpus and token ids of documents [first, last) of a part."""
        part = self.parts[number]
        offsets = self._values(part, "offsets", "<u8", first, last + 1).astype(np.int64)
        ids = self._values(part, "ids", self.manifest["ids"], int(offsets[0]), int(offsets[-1]))
        names = self._values(part, "docs", "<i8", first, last).tolist()
        names[: max(0, part["nulls"] - first)] = [None] * min(len(names), max(0, part["nulls"] - first))
        cuts = offsets - offsets[0]
        return names, offsets[:-1] + part["tokens_before"], [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def __getitem__(self, index: int) -> tuple[int | None, np.ndarray]:
        """Id and token ids of the document of that number in the corpus."""
        if not 0 <= index < len(self):
            raise IndexError(index)
        number = int(np.searchsorted(self.firsts, index, "right")) - 1
        at = index - self.firsts[number]
        names, _, ids = self.slice(number, at, at + 1)
        return names[0], ids[0]


def read_token_files(spark: SparkSession, folder: str, columns: Callable[[list[np.ndarray]], dict], schema: str) -> DataFrame:
    """doc_id, start, n_tokens and what `columns` makes of the token ids of a number of documents; a task a part."""
    files = TokenFiles(folder)
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches):
        files = TokenFiles(folder)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                count = files.parts[number]["documents"]
                for first in range(0, count, READ):
                    doc_ids, starts, ids = files.slice(number, first, min(first + READ, count))
                    made = columns(ids)
                    out = [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(list(map(len, ids)), pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        [*out, *(made[name] for name in names)], ["doc_id", "start", "n_tokens", *names]
                    )

    parts = spark.range(0, len(files.parts), 1, max(1, len(files.parts)))
    return parts.mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, {schema}")


def token_rows(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of every document in the files."""
    return read_token_files(
        spark, folder, lambda ids: {"ids": pa.array([own.astype(np.int32) for own in ids], pa.list_(pa.int32()))}, "ids array<int>"
    )


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, and the checksum of the ids as unsigned 32-bit numbers."""
    return read_token_files(
        spark,
        folder,
        lambda ids: {"ids_crc32": pa.array([zlib.crc32(own.astype("<u4").tobytes()) for own in ids], pa.int64())},
        "ids_crc32 bigint",
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}.tokens"
    write_token_files(documents(spark, sf_dir), default_tokenizer(), folder)
    return digests(spark, folder)
