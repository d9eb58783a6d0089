"""Removal of repeated passages with a sparse suffix array over all documents.

A byte goes if a passage of LENGTH bytes that covers it also starts earlier: in a document with a
smaller id, or earlier in the same one. Every passage holds an anchor: the place in it where the hash
of the next GRAM bytes is smallest. Equal passages hold equal anchors at the same distance, so it is
enough to sort the suffixes that begin at anchors.

1. Documents are dealt to blocks by a hash of their id. Blocks send the fingerprints of their anchors'
   grams, each once, to ranges of fingerprints, and are told which occur elsewhere.
2. Suffixes of anchors whose gram recurs, with the bytes to their left, are range-partitioned by their
   leading bytes at splitters sampled from the corpus. Of equal ones a block sends the first; the
   others are repeats already.
3. Each bucket sorts its suffixes to the right, and their left sides backwards, by multikey quicksort
   on words of eight bytes. For each distance of a passage's start from its anchor, passages are equal
   where both sides are equal to the depth needed; all but the first repeat.
4. A leading gram so frequent that several splitters fall on it has its rows spread over the buckets
   between them. What is first in such a bucket is compared across the buckets' boundaries by digests.
5. Blocks remove what the repeats cover.

A null text counts as empty. Texts shorter than LENGTH lose nothing. Documents without an id come
last. Rows with the same id follow one another in order of their texts. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import arrow_table, documents, in_blocks, packed, runs, unpacked

LENGTH, GRAM = 100, 51
# Places at which the gram of a passage can begin, and so the most bytes to the left of an anchor.
PLACES = LENGTH - GRAM + 1
LEFT = PLACES - 1
WIDTH = LEFT + LENGTH
KEY_BITS = 48
# Bytes of text in a block, and documents that splitters are sampled from, at most.
BLOCK_BYTES, SAMPLE = 4_000_000, 1_000
NO_GRAM = np.uint64(0xFFFFFFFFFFFFFFFF)


def _spread(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(31))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, by doubling the length."""
    out, length = _spread(data.astype(np.uint64) + np.uint64(1)), 1
    while length < GRAM:
        step = min(length, GRAM - length)
        out = _spread(out[:-step] * np.uint64(0xBF58476D1CE4E5B9) + out[step:])
        length += step
    return out


def _slid(x: np.ndarray, width: int, best) -> np.ndarray:
    """The best of each run of `width` values."""
    length = 1
    while length < width:
        step = min(length, width - length)
        x = best(x[:-step], x[step:])
        length += step
    return x


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the anchors of all passages; bounds: where texts begin, and the end."""
    places, hashes, first = [], [], 0
    while first < len(bounds) - 1:  # about a megabyte of texts at a time
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + 1_000_000)))
        last = min(last, len(bounds) - 1)
        low, high = bounds[first], bounds[last]
        if high - low >= LENGTH:
            found = _gram_hashes(data[low:high])
            change = np.zeros(high - low + 1, np.int32)
            starts, ends = bounds[first:last] - low, bounds[first + 1 : last + 1] - low
            np.add.at(change, np.where(ends - starts < LENGTH, starts, ends - GRAM + 1), 1)
            np.add.at(change, ends, -1)
            bad = np.cumsum(change)[: len(found)] > 0
            found[bad] = NO_GRAM
            least = _slid(found, PLACES, np.minimum)
            rim = np.zeros(PLACES - 1, np.uint64)
            chosen = _slid(np.concatenate([rim, least, rim]), PLACES, np.maximum) == found
            at = np.flatnonzero(chosen & ~bad)
            places.append(at + low)
            hashes.append(found[at])
        first = last
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


class Block:
    """The texts of one block in order of their ids, as bytes, with their anchors."""

    def __init__(self, table: pa.Table, wanted: bool = True):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids = table.column("doc_id")
        texts = [text.encode() for text in pc.fill_null(table.column("text"), "").to_pylist()]
        self.order = pc.fill_null(self.ids, 2**63 - 1).to_numpy()
        self.bounds = np.concatenate([[0], np.cumsum([len(text) for text in texts], dtype=np.int64)]).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        if wanted:
            self.at, hashes = anchors(self.data, self.bounds)
            keys = hashes >> np.uint64(64 - KEY_BITS)
            self.keys, self.key_of, self.times = np.unique(keys, return_inverse=True, return_counts=True)

    def ranges(self, count: int) -> np.ndarray:
        """Range of each key, of so many equal ranges of keys."""
        return (self.keys * np.uint64(count) >> np.uint64(KEY_BITS)).astype(np.int64)


def sent_keys(blocks: DataFrame, ranges: int) -> DataFrame:
    """(range, block, keys): the distinct anchor keys of a block in each range of keys."""

    def keys_of(key, table):
        block = Block(table)
        rows = [
            (at, key[0].as_py(), packed(np.diff(block.keys[part], prepend=np.uint64(0))))
            for at, part in runs(block.ranges(ranges))
        ]
        return arrow_table(rows, [("range", pa.int32()), ("block", pa.int32()), ("keys", pa.binary())])

    return blocks.groupBy("block").applyInArrow(keys_of, "range int, block int, keys binary")


def repeated_keys(sent: DataFrame) -> DataFrame:
    """(block, range, bits): for each key that a block has sent, whether another block has it."""

    def bits_of(table):
        sets = [np.cumsum(unpacked(blob, (np.uint64, 1))[0]) for blob in table.column("keys").to_pylist()]
        known, times = np.unique(np.concatenate(sets), return_counts=True)
        several = known[times > 1]
        rows = []
        for block, at, keys in zip(table.column("block").to_pylist(), table.column("range").to_pylist(), sets, strict=True):
            bits = np.zeros(len(keys), bool)
            if len(several):
                place = np.minimum(np.searchsorted(several, keys), len(several) - 1)
                bits = several[place] == keys
            rows.append((block, at, np.packbits(bits).tobytes()))
        return arrow_table(rows, [("block", pa.int32()), ("range", pa.int32()), ("bits", pa.binary())])

    return sent.groupBy("range").applyInArrow(bits_of, "block int, range int, bits binary")


# What rows of suffixes and of repeats hold: type and width of each part.
SUFFIX = ((np.int64, 1), (np.uint32, 1), (np.uint32, 1), (np.uint8, 1), (np.uint8, 1), (np.uint8, WIDTH))
REPEAT = ((np.uint32, 1), (np.uint32, 1), (np.uint64, 1))
# And what tells where a passage is that is the first of its bucket: digest, id, block, document, place, j.
FIRST = ((np.uint64, 1), (np.uint64, 1), (np.int64, 1), (np.uint32, 1), (np.uint32, 1), (np.uint32, 1), (np.uint8, 1))


def _possible(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bit j: a passage can begin j bytes before the anchor, given the bytes on its sides."""
    least = np.maximum(LENGTH - right.astype(np.int64), 0)
    most = np.minimum(left.astype(np.int64), PLACES - 1)
    bits = (np.uint64(1) << (most + 1).astype(np.uint64)) - (np.uint64(1) << least.astype(np.uint64))
    return np.where(most >= least, bits, np.uint64(0))


def suffixes(blocks: DataFrame, replies: DataFrame, splitters: np.ndarray, ranges: int) -> DataFrame:
    """(bucket, block, first, rows): packed SUFFIX rows, or REPEAT rows of what the block repeats itself."""

    def rows_of(key, texts, bits):
        out = []
        fields = [("bucket", pa.int32()), ("block", pa.int32()), ("first", pa.bool_()), ("rows", pa.binary())]
        if not texts.num_rows:
            return arrow_table(out, fields)
        block, number = Block(texts), key[0].as_py()
        elsewhere = np.zeros(len(block.keys), bool)
        told = dict(zip(bits.column("range").to_pylist(), bits.column("bits").to_pylist(), strict=True))
        for at, part in runs(block.ranges(ranges)):
            elsewhere[part] = np.unpackbits(np.frombuffer(told[at], np.uint8), count=part.stop - part.start)
        at = block.at[(elsewhere | (block.times > 1))[block.key_of]]
        if not len(at):
            return arrow_table(out, fields)
        doc = np.searchsorted(block.bounds, at, "right") - 1
        left = np.minimum(LEFT, at - block.bounds[doc])
        right = np.minimum(LENGTH, block.bounds[doc + 1] - at)
        padded = np.concatenate([np.zeros(LEFT, np.uint8), block.data, np.zeros(LENGTH, np.uint8)])
        around = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[at].copy()
        place = np.arange(WIDTH) - LEFT
        around[(place < -left[:, None]) | (place >= right[:, None])] = 0
        # Of equal suffixes the first is sent; the hash only finds them, the bytes decide.
        words = _words(np.concatenate([around, left[:, None].astype(np.uint8), right[:, None].astype(np.uint8)], 1))
        digest = np.zeros(len(words), np.uint64)
        for column in words.T:
            digest = _spread(digest + column)
        _, first, same = np.unique(digest, return_index=True, return_inverse=True)
        leader = first[same]
        equal = (words == words[leader]).all(1)
        repeats = np.flatnonzero(equal & (leader != np.arange(len(at))))
        sent = np.flatnonzero(~equal | (leader == np.arange(len(at))))
        position = (at - block.bounds[doc]).astype(np.uint32)
        masks = _possible(left[repeats], right[repeats])
        some = masks > 0
        if some.any():
            own = repeats[some]
            out.append((number % (len(splitters) + 1), number, False, packed(doc[own].astype(np.uint32), position[own], masks[some])))
        leads = np.ascontiguousarray(around[sent, LEFT : LEFT + GRAM]).view(f"S{GRAM}").ravel()
        low, high = np.searchsorted(splitters, leads, "left"), np.searchsorted(splitters, leads, "right")
        bucket = low + number % np.maximum(high - low, 1)
        sent, bucket = sent[np.argsort(bucket, kind="stable")], np.sort(bucket)
        for target, part in runs(bucket):
            own = sent[part]
            blob = packed(
                block.order[doc[own]], doc[own].astype(np.uint32), position[own],
                left[own].astype(np.uint8), right[own].astype(np.uint8), around[own],
            )
            out.append((target, number, True, blob))
        return arrow_table(out, fields)

    grouped = blocks.groupBy("block").cogroup(replies.groupBy("block"))
    return grouped.applyInArrow(rows_of, "bucket int, block int, first boolean, rows binary")


def _words(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as words of eight bytes that order as the bytes do."""
    filled = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    filled[:, : rows.shape[1]] = rows
    return filled.view(">u8").astype(np.uint64)


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows by multikey quicksort: rows still equal are split by their next word."""
    order = np.argsort(words[:, 0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for depth in range(1, words.shape[1]):
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group, key = np.cumsum(new)[at], words[order[at], depth]
        split = np.lexsort((key, group))
        order[at], key = order[at][split], key[split]
        new[at[1:]] |= (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    return order


def _classes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the number of leading bytes each shares with the one before it."""
    order = multikey_order(_words(rows))
    ordered = rows[order]
    differ = ordered[1:] != ordered[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return order, np.concatenate([[-1], shared])


def _class_at(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < depth)
    return out


def repeats_in(around: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bit j of each row: the passage from j bytes before its anchor on is that of an earlier row."""
    masks = np.zeros(len(around), np.uint64)
    if len(around) < 2:
        return masks
    order, shared = _classes(around[:, LEFT:])
    several = shared >= GRAM
    several[:-1] |= several[1:]
    rows = np.sort(order[several])
    if not len(rows):
        return masks
    right_order, right_shared = _classes(around[rows, LEFT:])
    left_order, left_shared = _classes(around[rows, :LEFT][:, ::-1])
    possible = _possible(left[rows], right[rows])
    for j in range(PLACES):
        can = np.flatnonzero(possible >> np.uint64(j) & np.uint64(1))
        if len(can) < 2:
            continue
        key = _class_at(right_order, right_shared, LENGTH - j)[can] * np.int64(len(rows) + 1)
        key += _class_at(left_order, left_shared, j)[can]
        by_key = np.argsort(key, kind="stable")
        again = key[by_key[1:]] == key[by_key[:-1]]
        masks[rows[can[by_key[1:][again]]]] |= np.uint64(1) << np.uint64(j)
    return masks


def _repeat_rows(block: np.ndarray, doc: np.ndarray, position: np.ndarray, masks: np.ndarray) -> list[tuple]:
    """(block, packed REPEAT rows) of each block."""
    order = np.argsort(block, kind="stable")
    return [
        (number, packed(*(a[order[part]] for a in (doc.astype(np.uint32), position.astype(np.uint32), masks))))
        for number, part in runs(block[order])
    ]


def _passage_digests(around: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the passages that begin j bytes before their anchors."""
    words = _words(around[:, LEFT - j : LEFT - j + LENGTH])
    one, two = np.zeros(len(words), np.uint64), np.full(len(words), 7, np.uint64)
    for column in words.T:
        one, two = _spread(one + column), _spread((two ^ column) * np.uint64(0xBF58476D1CE4E5B9))
    return one, two


def compared(rows: DataFrame, frequent: np.ndarray, ranges: int) -> DataFrame:
    """(block, rows): packed REPEAT rows; with `frequent` leads also (range, firsts): packed FIRST rows."""

    def found(table):
        keep = table.column("first").to_numpy()
        blocks, blobs = table.column("block").to_numpy(), table.column("rows").to_pylist()
        out = [(int(blocks[i]), blobs[i], None, None) for i in np.flatnonzero(~keep)]
        parts = [unpacked(blobs[i], *SUFFIX) for i in np.flatnonzero(keep)]
        if parts:
            own = np.repeat(blocks[keep], [len(part[0]) for part in parts])
            ids, doc, position, left, right, around = (np.concatenate(part) for part in zip(*parts, strict=True))
            order = np.lexsort((position, doc, ids))
            own, ids, doc, position, left, right, around = (
                a[order] for a in (own, ids, doc, position, left, right, around)
            )
            masks = repeats_in(around, left, right)
            some = np.flatnonzero(masks)
            out += [(*row, None, None) for row in _repeat_rows(own[some], doc[some], position[some], masks[some])]
            if len(frequent):
                leads = np.ascontiguousarray(around[:, LEFT : LEFT + GRAM]).view(f"S{GRAM}").ravel()
                firsts = np.where(np.isin(leads, frequent), _possible(left, right) & ~masks, np.uint64(0))
                for j in range(PLACES):
                    at = np.flatnonzero(firsts >> np.uint64(j) & np.uint64(1))
                    one, two = _passage_digests(around[at], j)
                    target = ((one >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                    order = np.argsort(target, kind="stable")
                    places = np.full(len(at), j, np.uint8)
                    columns = [one, two, ids[at], own[at].astype(np.uint32), doc[at], position[at], places]
                    for number, part in runs(target[order]):
                        out.append((None, None, number, packed(*(c[order[part]] for c in columns))))
        fields = [("block", pa.int32()), ("rows", pa.binary()), ("range", pa.int32()), ("firsts", pa.binary())]
        return arrow_table(out, fields)

    return rows.groupBy("bucket").applyInArrow(found, "block int, rows binary, range int, firsts binary")


def across_buckets(found: DataFrame) -> DataFrame:
    """(block, rows): the repeats, with firsts of frequent leads that are not the first of all buckets."""

    def later(table):
        parts = [unpacked(blob, *FIRST) for blob in table.column("firsts").to_pylist()]
        one, two, ids, block, doc, position, j = (np.concatenate(part) for part in zip(*parts, strict=True))
        start = position - j
        order = np.lexsort((start, doc, ids, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
        first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        # A passage with several anchors may be there several times.
        again = order[(ids[order] != ids[first]) | (doc[order] != doc[first]) | (start[order] != start[first])]
        masks = np.uint64(1) << j[again].astype(np.uint64)
        rows = _repeat_rows(block[again].astype(np.int64), doc[again], position[again], masks)
        return arrow_table(rows, [("block", pa.int32()), ("rows", pa.binary())])

    firsts = found.filter("firsts IS NOT NULL").select("range", "firsts")
    repeats = found.filter("rows IS NOT NULL").select("block", "rows")
    return repeats.unionByName(firsts.groupBy("range").applyInArrow(later, "block int, rows binary"))


def removed(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, the size of each text, removed bytes and runs, kept bytes."""

    def rows_of(texts, found):
        block = Block(texts, wanted=False)
        size = len(block.data)
        starts = np.zeros(size + 1, np.int32)
        for blob in found.column("rows").to_pylist():
            doc, position, masks = unpacked(blob, *REPEAT)
            at = block.bounds[doc] + position
            for j in range(PLACES):
                starts[at[(masks >> np.uint64(j) & np.uint64(1)) > 0] - j] = 1
        total = np.concatenate([[0], np.cumsum(starts[:size])])
        place = np.arange(1, size + 1)
        gone = total[place] - total[np.maximum(place - LENGTH, 0)] > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = block.bounds[:-1][np.diff(block.bounds) > 0]
        begins[inner] = gone[inner]  # a run ends with its document
        sums = [np.concatenate([[0], np.cumsum(flags)])[block.bounds] for flags in (gone, begins)]
        kept = block.data[~gone].tobytes()
        edges = block.bounds - sums[0]
        return pa.table(
            {
                "doc_id": block.ids,
                "n_bytes": np.diff(block.bounds),
                "n_removed": np.diff(sums[0]),
                "n_spans": np.diff(sums[1]),
                "kept": pa.array([kept[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
            }
        )

    grouped = blocks.groupBy("block").cogroup(found.groupBy("block"))
    return grouped.applyInArrow(
        rows_of,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary",
    )


def sampled_splitters(docs: DataFrame, count: int) -> np.ndarray:
    """Leading grams that cut the sampled suffixes into `count` equal parts."""
    sample = docs.select("doc_id", "text").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)

    def leads_of(batches):
        for batch in batches:
            block = Block(pa.Table.from_batches([batch]))
            padded = np.concatenate([block.data, np.zeros(GRAM, np.uint8)])
            leads = np.lib.stride_tricks.sliding_window_view(padded, GRAM)[block.at]
            yield pa.RecordBatch.from_arrays([pa.array([lead.tobytes() for lead in leads], pa.binary())], ["lead"])

    leads = sample.mapInArrow(leads_of, "lead binary").collect()
    leads = np.sort(np.array([bytes(row["lead"]) for row in leads], f"S{GRAM}"))
    if not len(leads):
        return leads
    return leads[np.arange(1, count) * len(leads) // count]


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) of every document."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = total // BLOCK_BYTES + 1
    blocks = in_blocks(docs, count)
    splitters = sampled_splitters(docs, count)
    frequent = np.unique(splitters[1:][splitters[1:] == splitters[:-1]])
    replies = repeated_keys(sent_keys(blocks, count))
    # Dealt out once, as are the texts: all uses of either read the same shuffle.
    found = compared(suffixes(blocks, replies, splitters, count), frequent, count).repartition("block")
    found = across_buckets(found) if len(frequent) else found.select("block", "rows")
    return removed(blocks, found)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
