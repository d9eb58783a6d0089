"""Language identification by string kernels.

The kernel of two texts is the cosine of their n-grams' presence, blended over lengths of one to four
bytes. Landmarks from a bounded sample give Nyström features, a ridge regression of one language
against the rest is solved on them, and both are folded into one matrix, so that a batch of texts is
scored by two matrix products: presence times landmarks, then times weights.

A text that is null or has no letter is `und` with score 0. An empty table, or one without a usable
label, gives `und` for all. Rows that repeat are predicted alike; extra columns are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfcast.llm.common import documents, per_text

# Texts learned from, at most: for each language, and in all. They are first by a hash of their id.
PER_LANGUAGE, SAMPLE = 400, 4_000
LANDMARKS, RIDGE = 160, 1e-3
# n-grams are told apart by this many bits of a hash; the most telling ones become columns.
BITS, COLUMNS, LENGTHS = 18, 4096, (1, 2, 3, 4)
LETTER = re.compile(r"[^\W\d_]")


def grams(text: str) -> np.ndarray:
    """Hashes of all n-grams of the text's bytes, with repeats."""
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    out, code = [], data
    for n in LENGTHS:
        if n > 1:
            code = (code[:-1] << np.uint32(8)) | data[n - 1 :]
        mixed = (code ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(13)
        out.append((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS))
        if len(code) < 2:
            break
    return np.concatenate(out)


@dataclass
class Classifier:
    languages: list[str]
    columns: np.ndarray  # column of an n-gram's hash, or -1
    landmarks: np.ndarray  # columns x landmarks, each of length 1
    weights: np.ndarray  # landmarks x languages

    def presence(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.landmarks)), np.float32)
        for row, text in enumerate(texts):
            found = self.columns[grams(text)]
            out[row, found[found >= 0]] = 1
        return _unit(out)

    def scores(self, texts: list[str]) -> np.ndarray:
        """One score for each text and language, near 1 where it is that language, else near -1."""
        return (self.presence(texts) @ self.landmarks) @ self.weights


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.square(rows).sum(1, keepdims=True))
    return rows / np.maximum(length, 1)


def fitted(found: list[list[int]], langs: list[str]) -> Classifier:
    """From the n-grams of each text and its language, in a fixed order."""
    languages = sorted(set(langs))
    seen = np.zeros(1 << BITS)
    for row in found:
        seen[row] += 1
    share = seen / len(found)
    telling = np.sort(np.argsort(-share * (1 - share), kind="stable")[:COLUMNS])
    columns = np.full(1 << BITS, -1, np.int32)
    columns[telling] = np.arange(len(telling))
    rows = np.zeros((len(found), len(telling)), np.float32)
    for i, row in enumerate(found):
        at = columns[row]
        rows[i, at[at >= 0]] = 1
    rows = _unit(rows).astype(np.float64)
    # Landmarks take turns by language, so that rare ones have some.
    turns = [langs[:i].count(lang) for i, lang in enumerate(langs)]
    order = sorted(range(len(langs)), key=lambda i: (turns[i], i))
    marks = rows[order[:LANDMARKS]]
    values, vectors = np.linalg.eigh(marks @ marks.T)
    good = values > 1e-8
    root = vectors[:, good] / np.sqrt(values[good])
    mapped = rows @ marks.T @ root
    targets = np.where(np.array(langs)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Each language weighs the same, whatever its share of the sample.
    weight = np.array([1 / langs.count(lang) for lang in langs])[:, None]
    weight *= len(langs) / weight.sum()
    left = mapped.T @ (weight * mapped) + RIDGE * len(langs) * np.eye(mapped.shape[1])
    solved = np.linalg.solve(left, mapped.T @ (weight * targets))
    return Classifier(languages, columns, marks.T.astype(np.float32), (root @ solved).astype(np.float32))


def learn(docs: DataFrame) -> Classifier | None:
    """Fits on at most SAMPLE whole texts with a known language and a letter."""
    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text")
    known = known.withColumn("_turn", F.xxhash64("doc_id"))
    chosen = known.select("doc_id", "lang", "_turn")
    # In parts of each language first, so that a frequent one does not meet in one task.
    for keys in (["lang", F.pmod("_turn", F.lit(64))], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("_turn", "doc_id")
        chosen = chosen.withColumn("_at", F.row_number().over(first)).filter(F.col("_at") <= PER_LANGUAGE)
    chosen = chosen.orderBy("_at", "_turn", "doc_id").limit(SAMPLE)
    texts = known.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")

    def rows_of(batches):
        for batch in batches:
            usable = [bool(LETTER.search(text)) for text in batch["text"]]
            yield {
                "doc_id": [i for i, ok in zip(batch["doc_id"], usable, strict=True) if ok],
                "grams": [np.unique(grams(t)).astype(np.int32) for t, ok in zip(batch["text"], usable, strict=True) if ok],
            }

    found = per_text(texts, ["doc_id", "text"], rows_of, "doc_id bigint, grams array<int>")
    rows = found.join(F.broadcast(chosen.select("doc_id", "lang", "_turn")), "doc_id").collect()
    rows.sort(key=lambda row: (row["_turn"], row["doc_id"], row["lang"]))
    return fitted([row["grams"] for row in rows], [row["lang"] for row in rows]) if rows else None


def predicted(docs: DataFrame, classifier: Classifier | None) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""

    def rows_of(batches):
        for batch in batches:
            langs, scores = [], []
            for at in range(0, len(batch["text"]), 256):
                texts = batch["text"][at : at + 256]
                usable = [i for i, text in enumerate(texts) if text and LETTER.search(text)]
                part, sure = ["und"] * len(texts), [0.0] * len(texts)
                if classifier and usable:
                    table = classifier.scores([texts[i] for i in usable])
                    for i, row in zip(usable, table, strict=True):
                        best = int(row.argmax())
                        part[i], sure[i] = classifier.languages[best], min(1.0, max(0.0, (float(row[best]) + 1) / 2))
                langs += part
                scores += sure
            yield {"doc_id": batch["doc_id"], "lang_pred": langs, "score": scores}

    return per_text(docs, ["doc_id", "text"], rows_of, "doc_id bigint, lang_pred string, score double")


def held_out():
    """Fixed rule: a quarter of the documents, by the check sum of their id, teaches nothing."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    classifier = learn(docs.filter(~held_out()))
    return predicted(docs, classifier).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
