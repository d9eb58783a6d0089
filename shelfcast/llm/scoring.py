"""Stupid-backoff scores of documents against all other documents.

The score of a word is the share of its context's occurrences that it follows, in the longest context
that it follows at all; each step to a shorter context costs a factor of BACKOFF. Occurrences in the
document itself do not count, so a text is never its own model.

Documents are dealt to blocks, and n-grams are exploded there and counted for each block. The count
tables are partitioned by ranges of the n-grams' hashes: a block sends its distinct n-grams with their
counts to each range, packed in one row, the counts of equal n-grams are added there, and the sums go
back to the blocks, where they meet the n-grams of each document and the logarithms are summed. An
n-gram is in a range at most once for each block, however frequent it is.

Words are `[^\\x20\\x09-\\x0D]+` of the whole text, as they are written. A null or empty text has no words
and score 0. Rows that repeat are scored each, against the others. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import arrow_table, documents, in_blocks, packed, runs, unpacked
from shelfcast.llm.mixing import words

ORDER, BACKOFF = 3, 0.4
# Bits of an n-gram's hash, and bytes of text in a block.
KEY_BITS, BLOCK_BYTES = 56, 8_000_000


def _spread(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Block:
    """The n-grams of one block's texts, in order of the texts."""

    def __init__(self, table: pa.Table, order: int):
        import xxhash

        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids = table.column("doc_id")
        texts = pc.fill_null(table.column("text"), "").to_pylist()
        split = [text.encode().split() for text in texts]
        self.sizes = np.array([len(one) for one in split], np.int64)
        self.doc = np.repeat(np.arange(len(split)), self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.doc)) - first[self.doc]
        single = np.fromiter(
            (xxhash.xxh3_64_intdigest(word) for one in split for word in one), np.uint64, len(self.doc)
        )
        # grams[n][i]: hash of the n+1 words that end at word i; only where the text has as many before.
        self.ends, hashes, last = [], [], single
        for n in range(order):
            if n:
                last = np.concatenate([single[:1] * np.uint64(0), _spread(last[:-1] + np.uint64(n)) + single[1:]])
            at = np.flatnonzero(self.place >= n)
            self.ends.append(at)
            hashes.append(_spread(last[at] + np.uint64(n)) >> np.uint64(64 - KEY_BITS))
        self.keys, self.key_of, self.times = np.unique(
            np.concatenate(hashes), return_inverse=True, return_counts=True
        )

    def ranges(self, count: int) -> np.ndarray:
        """Range of each key, of so many equal ranges of keys."""
        width = np.uint64(-(-(1 << KEY_BITS) // count))
        return (self.keys // width).astype(np.int64)

    def others(self, totals: np.ndarray) -> list[np.ndarray]:
        """For each length and word, how often its n-gram occurs in other documents; 0 where it has none."""
        out, start = [], 0
        for at in self.ends:
            key = self.key_of[start : start + len(at)].astype(np.int64)
            start += len(at)
            _, own_of, own = np.unique(self.doc[at] * len(self.keys) + key, return_inverse=True, return_counts=True)
            counts = np.zeros(len(self.doc), np.int64)
            counts[at] = totals[key] - own[own_of]
            out.append(counts)
        return out


def sent_counts(blocks: DataFrame, ranges: int, order: int) -> DataFrame:
    """(range, block, counts): the distinct n-grams of a block in each range, with their counts."""

    def counts_of(key, table):
        block = Block(table, order)
        rows = [
            (at, key[0].as_py(), packed(np.diff(block.keys[part], prepend=np.uint64(0)), block.times[part].astype(np.uint32)))
            for at, part in runs(block.ranges(ranges))
        ]
        return arrow_table(rows, [("range", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])

    return blocks.groupBy("block").applyInArrow(counts_of, "range int, block int, counts binary")


def totals(sent: DataFrame) -> DataFrame:
    """(block, range, totals): for each n-gram that a block has sent, its count in all blocks."""

    def totals_of(table):
        sets = [unpacked(blob, (np.uint64, 1), (np.uint32, 1)) for blob in table.column("counts").to_pylist()]
        keys = [np.cumsum(steps) for steps, _ in sets]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate([times for _, times in sets])).astype(np.int64)
        ends = np.cumsum([len(one) for one in keys])
        rows = [
            (block, at, packed(total[place[end - len(one) : end]]))
            for block, at, one, end in zip(
                table.column("block").to_pylist(), table.column("range").to_pylist(), keys, ends, strict=True
            )
        ]
        return arrow_table(rows, [("block", pa.int32()), ("range", pa.int32()), ("totals", pa.binary())])

    return sent.groupBy("range").applyInArrow(totals_of, "block int, range int, totals binary")


def log_scores(counts: list[np.ndarray], place: np.ndarray, rest: np.ndarray, backoff: float) -> np.ndarray:
    """Logarithm of each word's score; counts by length, and `rest` words in other documents."""
    unknown = counts[0] == 0
    score = np.where(unknown, backoff, 1.0) * np.maximum(counts[0], 1) / np.maximum(rest, 1)
    for n in range(1, len(counts)):
        follows = counts[n] > 0
        context = np.concatenate([counts[n - 1][:1], counts[n - 1][:-1]])
        longer = np.where(follows, counts[n] / np.maximum(context, 1), backoff * score)
        score = np.where(place >= n, longer, score)
    return np.log(score)


def scored(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_words, and the sum of the logarithms of its words' scores."""
    corpus, size = docs.agg(F.sum(words()), F.sum(F.octet_length("text"))).first()
    corpus, ranges = corpus or 0, (size or 0) // BLOCK_BYTES + 1
    blocks = in_blocks(docs, ranges)
    replies = totals(sent_counts(blocks, ranges, order))

    def rows_of(texts, replies):
        block = Block(texts, order)
        told = dict(zip(replies.column("range").to_pylist(), replies.column("totals").to_pylist(), strict=True))
        known = np.zeros(len(block.keys), np.int64)
        for at, part in runs(block.ranges(ranges)):
            known[part] = unpacked(told[at], (np.int64, 1))[0]
        logs = log_scores(block.others(known), block.place, corpus - block.sizes[block.doc], backoff)
        return pa.table(
            {
                "doc_id": block.ids,
                "n_words": block.sizes,
                "log_score": np.bincount(block.doc, logs, len(block.sizes)).astype(float),
            }
        )

    grouped = blocks.groupBy("block").cogroup(replies.groupBy("block"))
    return grouped.applyInArrow(rows_of, "doc_id bigint, n_words bigint, log_score double")


def op4_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(documents(spark, sf_dir))
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).otherwise(F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round(mean, 4).alias("mean_log_score")
    )
