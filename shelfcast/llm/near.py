"""Near-duplicate documents by a set similarity join along chosen paths.

A document is the set of its word shingles. Equal sets are one class. Each class has minwise values of
its set; from the root of each of several independent trees a node sends a class on by one or two of
these values, which the node's own hash selects, so that similar sets tend to stay together. Nodes of
a bounded size are compared exhaustively by their sketches; larger ones branch on. Nodes that are
still larger at the last level hold sets that are all alike; they are compared in tiles.

Classes that sketches put together are then compared on their full sets, exactly, in tiles where there
are many. Only links that connect are passed on, never all pairs of a group.

A null text has an empty set; empty sets are linked with nothing. Texts of fewer words than a shingle
have their whole sequence as the one shingle. Documents that repeat are of one class. Rows without an
id are documents too; a group of such rows alone has no component_id. Extra columns are left out by
`near_duplicates` and kept by `without_copies`.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import blobs, components, documents, forest, in_groups, per_text, stored, tiled

VALUES, TREES, LEVELS = 64, 12, 6
# Rows of a node that is compared rather than branched, and of a chunk of one that cannot branch.
NODE, CHUNK = 2_000, 20_000
# Bytes of the full sets, and sets, in a chunk of a class of candidates.
SET_BYTES, MEMBERS = 8_000_000, 20_000
# Share of similar pairs that an exact comparison may miss because too few values of their sketches agree.
MISSED = 2e-8


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


FACTORS = mixed(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)


def least_alike(top: int) -> float:
    """Share of the sketch that agrees in all but MISSED of the pairs with a similarity of top percent (0.5 for 80)."""
    p, missed = top / 100, 0.0
    for n in range(VALUES):
        missed += math.comb(VALUES, n) * p**n * (1 - p) ** (VALUES - n)
        if missed > MISSED:
            return n / VALUES
    return 1.0


def trees_for(top: int) -> int:
    """Trees that miss no more of the pairs with a similarity of top percent than TREES do at 80 percent."""

    def missed(p):
        out = 0.0
        for _ in range(LEVELS):
            one = 1 - p * (1 - out)
            out = 0.75 * one + 0.25 * one**2
        return out

    if top >= 80:
        return TREES
    return math.ceil(TREES * math.log(missed(0.8)) / math.log(missed(top / 100)))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of the whole text."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    length = min(size, len(hashes))
    out = np.zeros(len(hashes) - length + 1, np.uint64)
    for i in range(length):
        out = mixed(out + hashes[i : i + len(out)])
    if length < size:  # a short sequence is not the shingle of a longer text
        out = mixed(out + np.uint64(length))
    return np.unique(out)


def minwise(found: np.ndarray) -> np.ndarray:
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(found), 4096):
        part = (found[None, at : at + 4096] * FACTORS[:, None]) >> np.uint64(32)
        out = np.minimum(out, part.min(1).astype(np.uint32))
    return out


def children(nodes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the nodes that each goes on to: one selected value, and for a quarter of nodes two."""
    first = mixed(nodes)
    second = mixed(first)
    rows = np.arange(len(nodes))
    twice = np.flatnonzero(second % np.uint64(4) == 0)
    rows = np.concatenate([rows, twice])
    place = np.concatenate([first % np.uint64(VALUES), (first[twice] + np.uint64(1) + second[twice] // np.uint64(4) % np.uint64(VALUES - 1)) % np.uint64(VALUES)])
    value = values[rows, place.astype(np.int64)].astype(np.uint64)
    return rows, mixed(mixed(nodes[rows] + place + np.uint64(1)) + value)


def classes(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, a mark of the text, n_shingles, and the digest and minwise values of each set (null where it is empty)."""

    def rows_of(batches):
        import hashlib

        for batch in batches:
            out = {"doc_id": batch["doc_id"], "mark": batch["mark"], "n_shingles": [], "digest": [], "minwise": []}
            for text in batch["text"]:
                found = shingles(text, size)
                out["n_shingles"].append(len(found))
                out["digest"].append(hashlib.sha256(found.tobytes()).digest() if len(found) else None)
                out["minwise"].append(minwise(found).tobytes() if len(found) else None)
            yield out

    schema = "doc_id bigint, mark bigint, n_shingles bigint, digest binary, minwise binary"
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    return per_text(marked, ["doc_id", "text", "mark"], rows_of, schema)


def _branched(rows: DataFrame, trees: int = 0) -> DataFrame:
    """(node, rep) one level further down, from the roots of so many trees or from the given nodes."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            values = blobs(table, "minwise", np.uint32, VALUES)
            reps = table.column("rep").to_numpy()
            if trees:
                starts = (np.full(len(reps), tree, np.uint64) for tree in mixed(np.arange(1, trees + 1, dtype=np.uint64)))
            else:
                starts = [table.column("node").to_numpy().view(np.uint64)]
            for start in starts:
                at, nodes = children(start, values)
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(reps[at])], ["node", "rep"])

    return rows.mapInArrow(run, "node bigint, rep bigint")


def leaves(reps: DataFrame, trees: int) -> DataFrame:
    """(node, rep, n) of all nodes with several classes that do not branch on."""
    rows, out = _branched(reps.select("rep", "minwise"), trees), None
    for level in range(1, LEVELS + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        rows = stored(rows.join(sizes, "node"))
        done = rows if level == LEVELS else rows.filter(F.col("n") <= NODE)
        out = done if out is None else out.unionByName(done)
        large = rows.filter(F.col("n") > NODE).select("node", "rep")
        if level == LEVELS or large.isEmpty():
            break
        rows = _branched(large.join(reps.select("rep", "minwise"), "rep"))
    return out


def candidates(reps: DataFrame, top: int) -> DataFrame:
    """Links (a, b) that connect all classes whose sketches agree inside a node."""
    least = least_alike(top)
    sketch = reps.select("rep", F.col("n_shingles").alias("size"), "minwise")
    rows = leaves(reps, trees_for(top)).join(_short(sketch), "rep")
    rows = tiled(rows, F.ceil(F.col("n") / CHUNK), "rep").drop("n")

    def rows_of(table, begins):
        bits = blobs(table, "sketch", np.uint8, VALUES)
        sizes = table.column("size").to_numpy()
        ids = table.column("rep").to_numpy()
        lengths = np.diff(begins)
        a, b = [], []
        group = np.repeat(np.arange(len(lengths)), lengths)
        small = np.repeat(lengths <= 16, lengths)
        for step in range(1, int(min(lengths.max(), 16))):
            at = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
            at = at[_near_sizes(sizes[at], sizes[at + step], top)]
            at = at[(bits[at] == bits[at + step]).mean(1) >= least]
            a.append(ids[at])
            b.append(ids[at + step])
        for start, length in zip(begins[:-1][lengths > 16], lengths[lengths > 16], strict=True):
            part, size = bits[start : start + length], sizes[start : start + length]

            def like(row, others, part=part, size=size):
                out = _near_sizes(size[row], size[others], top)
                out[out] = (part[others[out]] == part[row]).mean(1) >= least
                return out

            pairs = np.array(forest(length, like), np.int64).reshape(-1, 2) + start
            a.append(ids[pairs[:, 0]])
            b.append(ids[pairs[:, 1]])
        return {"a": np.concatenate(a), "b": np.concatenate(b)} if a else None

    return in_groups(rows, ["node", "tile_a", "tile_b"], rows_of, "a bigint, b bigint")


def _short(rows: DataFrame) -> DataFrame:
    """The low byte of each minwise value."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                values = blobs(pa.Table.from_batches([batch]), "minwise", np.uint32, VALUES).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([row.tobytes() for row in values])], ["rep", "size", "sketch"]
                )

    return rows.mapInArrow(run, "rep bigint, size bigint, sketch binary")


def _near_sizes(a, b, top: int):
    """Sets of these sizes can have a similarity of top percent."""
    return 100 * np.minimum(a, b) >= top * np.maximum(a, b)


def exact_links(docs: DataFrame, members: DataFrame, shingle: int, top: int) -> DataFrame:
    """Links (a, b) that connect all classes of a group whose full sets are similar enough.

    `members` has the class as id, the document that stands for it, and its group with a number of chunks.
    """

    def sets(batches):
        for batch in batches:
            yield batch | {"found": [shingles(text, shingle).tobytes() for text in batch["text"]]}

    of = members.select("id", F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "component_id", "chunks")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).join(of, same)
    rows = per_text(
        texts.select("id", "component_id", "chunks", "text"),
        ["id", "component_id", "chunks", "text"],
        sets,
        "id bigint, component_id bigint, chunks int, found binary",
    )
    rows = tiled(rows.dropDuplicates(["id"]), F.col("chunks"), "id").drop("chunks")

    def rows_of(table, begins):
        ids, found = table.column("id").to_numpy(), table.column("found").to_pylist()
        out = []
        for start, end in zip(begins[:-1], begins[1:], strict=True):
            own = [np.frombuffer(blob, np.uint64) for blob in found[start:end]]
            out += [(ids[start + a], ids[start + b]) for a, b in similar(own, top)]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return {"a": pairs[:, 0], "b": pairs[:, 1]}

    return in_groups(rows, ["component_id", "tile_a", "tile_b"], rows_of, "a bigint, b bigint")


def similar(sets: list[np.ndarray], top: int) -> list[tuple[int, int]]:
    """Links that connect sets with 100 * intersection >= top * union, as all such pairs would.

    Similar sets share one of the rarest (100 - top) percent and one more of their shingles, whichever of
    the two is asked. An index of these shingles gives the partners of a set; only those of near size whose
    intersection is counted are compared. Sets already reached are not looked at again, and the index
    is made anew from the others whenever half of them are reached.
    """
    sizes = np.array([len(own) for own in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    _, flat, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Shingles numbered from the rarest on; each set in that order.
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(often))
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = rank[flat]
    flat = flat[np.lexsort((flat, owner))]
    # Shared shingles are at least top percent of either set.
    fronts = sizes - -(-top * sizes // 100) + 1
    leads = flat[_ranges(starts[:-1], fronts)]
    lead_owner = np.repeat(np.arange(len(sets)), fronts)
    order = np.argsort(leads, kind="stable")
    leads, lead_owner = leads[order], lead_owner[order]
    begins = np.searchsorted(leads, np.arange(len(often) + 1))

    marks, left = np.zeros(len(often), bool), np.ones(len(sets), bool)
    n_left = indexed = len(sets)
    out = []
    for start in range(len(sets)):
        if not left[start]:
            continue
        left[start], n_left, reached = False, n_left - 1, [start]
        while reached and n_left:
            if n_left * 2 < indexed:
                keep = left[lead_owner]
                leads, lead_owner, indexed = leads[keep], lead_owner[keep], n_left
                begins = np.searchsorted(leads, np.arange(len(often) + 1))
            row = reached.pop()
            own = flat[starts[row] : starts[row + 1]]
            front = own[: fronts[row]]
            found = lead_owner[_ranges(begins[front], begins[front + 1] - begins[front])]
            found = np.unique(found[left[found]])
            found = found[_near_sizes(sizes[row], sizes[found], top)]
            if not len(found):
                continue
            marks[own] = True
            cuts = np.concatenate([[0], np.cumsum(sizes[found])[:-1]])
            shared = np.add.reduceat(marks[flat[_ranges(starts[found], sizes[found])]].astype(np.int64), cuts)
            marks[own] = False
            new = found[100 * shared >= top * (sizes[row] + sizes[found] - shared)]
            left[new], n_left = False, n_left - len(new)
            out += [(row, int(other)) for other in new]
            reached += new.tolist()
    return out


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


def _labelled(docs: DataFrame, shingle: int, top: int) -> DataFrame:
    """doc_id, mark of the text, n_shingles, digest, class (null for an empty set) and component_id.

    Classes are numbered, so that rows that share an id, or have none, are told apart.
    """
    found = stored(classes(docs, shingle))
    first = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "mark", "n_shingles", "minwise")
    reps = found.filter("digest IS NOT NULL").groupBy("digest").agg(F.min(first).alias("first"))
    reps = reps.select("digest", *(f"first.{name}" for name in ("doc_id", "mark", "n_shingles", "minwise")))
    # Numbered as they are written, so that a class keeps its number whenever it is read.
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()))
    groups = components(candidates(reps, top))
    members = reps.select(F.col("rep").alias("id"), "doc_id", "mark", "n_shingles").join(groups, "id")
    chunks = F.ceil(F.greatest(F.sum("n_shingles") * 8 / SET_BYTES, F.count("*") / MEMBERS)).cast("int")
    members = members.join(members.groupBy("component_id").agg(chunks.alias("chunks")), "component_id")
    linked = components(exact_links(docs, members, shingle, top))
    ids = linked.join(reps.select(F.col("rep").alias("id"), "doc_id"), "id")
    heads = linked.join(ids.groupBy("component_id").agg(F.min("doc_id").alias("head")), "component_id")
    heads = heads.select(F.col("id").alias("rep"), F.col("component_id").alias("class"), "head")
    named = reps.select("digest", "rep", F.col("doc_id").alias("own")).join(heads, "rep", "left")
    named = named.select("digest", F.coalesce("class", "rep").alias("class"), F.coalesce("head", "own").alias("component_id"))
    return found.select("doc_id", "mark", "n_shingles", "digest").join(named, "digest", "left")


def near_duplicates(docs: DataFrame, shingle: int = 5, top: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept."""
    component = F.coalesce("component_id", "doc_id")
    return _labelled(docs, shingle, top).select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def without_copies(docs: DataFrame, shingle: int = 5, top: int = 80) -> DataFrame:
    """The documents with one row of each component, one with the smallest id; a null id comes after all others.

    Rows are told apart by their id and their text, so copies that share an id, or have none, go too. Rows
    without a word are linked with nothing and all stay.
    """
    rows = _labelled(docs, shingle, top).filter("digest IS NOT NULL")
    keys = stored(rows.groupBy(F.col("class").alias("group"), "doc_id", "mark").agg(F.count("*").alias("n")))
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "mark")
    first = keys.groupBy("group").agg(F.min(order).alias("first")).select("group", "first.doc_id", "first.mark")
    kept = keys.join(
        first.select(F.col("group").alias("_group"), F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")),
        (F.col("group") == F.col("_group")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")),
        "left",
    )
    kept = stored(kept.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "n", F.col("_group").isNotNull().alias("first")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_mark"))
    out = docs.join(kept.filter("NOT first OR n > 1"), same, "left_anti").select(*docs.columns)
    several = kept.filter("first AND n > 1")
    if several.isEmpty():
        return out
    # One of the rows that are equal in id and text.
    again = docs.join(several, same).dropDuplicates(["_id", "_mark"])
    return out.unionByName(again.select(*docs.columns))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=2)
