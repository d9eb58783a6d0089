"""Near-duplicate vectors by inverted lists and product quantisation.

Coarse centroids and the codebooks of their residuals are fitted on a bounded sample; every vector is
in the list of its nearest centroid. Within the link distance r of a vector there can only be members
of lists whose border with its own list is no further than r, so those are its probes, and nothing is
missed. In a list, distances to the members' codes are computed; a member whose code is further than r
plus its own coding error cannot link. What is left is compared by its exact cosine.

Equal vectors are one class. Lists of a label that follow each other make up a block of bounded size, and
a list that is larger is split into parts. A vector goes to its own block, and once to every other block
with lists it probes, which it names by bits; a task holds the members of one block, and the vectors that
probe it pass by. So a vector is sent as often as there are blocks at most, not lists. Only links that
connect are passed on. Vectors that are null, zero or hold null or non-finite components, and vectors without a
label, link with nothing; so do vectors of different length. Rows that repeat count as other vectors.
An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfcast.llm.common import _begins, components, shuffles_freed, stored

# Rows that centroids and codebooks are fitted on, at most: those first by a hash of their id.
SAMPLE = 32_768
# Most lists; codewords of a subspace; components in a subspace; rounds of fitting.
LISTS, CODEWORDS, WIDTH, ROUNDS = 4096, 64, 8, 8
# Members of a block, at most, and bytes of their numbers; rows that are placed and compared at once.
CHUNK, CHUNK_BYTES, SLICE = 32_768, 16 << 20, 256
# Members that are compared, and queries that are held, at once; links that are held until they are thinned out.
TILE, PAIRS = 4096, 1 << 20
# Partitions that blocks are dealt to, at least: their work grows faster than their rows.
SPREAD = 192
SLACK = 1e-6


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    norms, out = (centres**2).sum(1), np.empty(len(points), np.int64)
    for at in range(0, len(points), SLICE):
        out[at : at + SLICE] = np.argmin(norms - 2 * points[at : at + SLICE] @ centres.T, 1)
    return out


def _fitted(points: np.ndarray, count: int, seed: int) -> np.ndarray:
    """k-means; a centre that no point is nearest to stays where it is."""
    rng = np.random.default_rng(seed)
    centres = points[np.sort(rng.choice(len(points), min(count, len(points)), replace=False))].copy()
    for _ in range(ROUNDS):
        own = _nearest(points, centres)
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


@dataclass
class Index:
    size: int  # components of the longest vector, rounded up to whole subspaces
    radius: float  # distance of unit vectors with the least cosine that links
    centres: np.ndarray
    books: np.ndarray  # subspace x codeword x component

    def unit(self, vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Vectors as rows of length 1, filled up with zeros."""
        vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        out = np.zeros((len(vectors), self.size))
        out[np.arange(self.size)[None] < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        out /= np.abs(out).max(1, keepdims=True)
        return out / np.sqrt((out**2).sum(1, keepdims=True))

    def split(self, rows: np.ndarray) -> np.ndarray:
        return rows.reshape(len(rows), -1, WIDTH)

    def codes(self, units: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far each vector is from what its code stands for."""
        rest = self.split(units - self.centres[lists])
        codes = np.stack([_nearest(rest[:, m], self.books[m]) for m in range(len(self.books))], 1)
        coded = np.stack([self.books[m][codes[:, m]] for m in range(len(self.books))], 1)
        return codes.astype(np.uint8), np.sqrt(((rest - coded) ** 2).sum((1, 2)))

    @cached_property
    def apart(self) -> np.ndarray:
        """Distances between centres: once per task, and one centre at a time."""
        out = np.empty((len(self.centres), len(self.centres)))
        for row, centre in enumerate(self.centres):
            difference = self.centres - centre
            out[row] = np.sqrt(np.einsum("ij,ij->i", difference, difference))
        return out

    def borders(self, units: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Row x list: the lists with lower numbers whose border is within the radius; some rows at a time."""
        far = (self.centres**2).sum(1) + 1 - 2 * units @ self.centres.T
        far -= far[np.arange(len(lists)), lists][:, None]
        border = far <= 2 * (self.radius + SLACK) * self.apart[lists]
        return border & (np.arange(len(self.centres))[None] < lists[:, None])

    def probes(self, units: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists with lower numbers whose border is within the radius."""
        rows, probed = [], []
        for at in range(0, len(units), SLICE):
            found = np.nonzero(self.borders(units[at : at + SLICE], lists[at : at + SLICE]))
            rows.append(found[0] + at)
            probed.append(found[1])
        return (np.concatenate(rows), np.concatenate(probed)) if rows else (np.empty(0, np.int64),) * 2

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The residuals that codes stand for."""
        return np.concatenate([book[codes[:, m]] for m, book in enumerate(self.books)], 1)

    def distances(self, units: np.ndarray, at: int, decoded: np.ndarray) -> np.ndarray:
        """Squared distances from vectors to what the codes of a list's members stand for."""
        rest = units - self.centres[at]
        return (rest**2).sum(1)[:, None] - 2 * rest @ decoded.T + (decoded**2).sum(1)


def fit(reps: DataFrame, least: float, sample: int = SAMPLE) -> Index | None:
    """The index from at most `sample` classes; the number of lists follows the number of classes."""
    n, size = reps.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not n:
        return None
    rows = reps.select("rep", "embedding").orderBy(F.xxhash64("rep"), "rep").limit(sample).collect()
    size = -(-size // WIDTH) * WIDTH
    index = Index(size, float(np.sqrt(2 - 2 * least)), np.zeros((1, size)), np.zeros((0, 0, 0)))
    units = index.unit(pa.array([row["embedding"] for row in rows], pa.list_(pa.float64())))
    index.centres = _fitted(units, max(1, min(LISTS, int(np.sqrt(n)))), 1)
    rest = index.split(units - index.centres[_nearest(units, index.centres)])
    books = [_fitted(rest[:, m], CODEWORDS, 2 + m) for m in range(rest.shape[1])]
    index.books = np.stack(books)
    return index


def blocks(reps: DataFrame, index: Index) -> DataFrame:
    """(label, size, blocks): the first list of every block of a label, and its number of parts.

    Blocks hold about as many members each. A list with more than that is a block of its own, in parts.
    """

    def run(batches):
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            lists = _nearest(index.unit(batch.column(2)), index.centres).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists)], ["label", "size", "list"]
            )

    most = max(1, min(CHUNK, CHUNK_BYTES // (8 * index.size)))
    lists = reps.select("label", "size", "embedding").mapInArrow(run, "label bigint, size int, list int")
    lists = lists.groupBy("label", "size", "list").agg(F.count("*").alias("n"))
    # A label has no more rows here than there are lists.
    order = Window.partitionBy("label", "size").orderBy("list")
    turn = F.floor((F.sum("n").over(order) - F.col("n")) / most)
    lists = lists.select(
        "label", "size", "list", F.ceil(F.col("n") / most).cast("int").alias("parts"), turn.alias("turn")
    )
    lists = lists.withColumn("before", F.lag(F.struct("turn", "parts")).over(order)).filter(
        "before IS NULL OR before.turn <> turn OR before.parts > 1 OR parts > 1"
    )
    return lists.groupBy("label", "size").agg(F.sort_array(F.collect_list(F.struct("list", "parts"))).alias("blocks"))


def _records(border: np.ndarray, lists: np.ndarray, reps: np.ndarray, starts: np.ndarray, parts: np.ndarray):
    """(row, block, own, first, probes) of the rows of one label."""
    numbers, ends = np.cumsum(parts) - parts, [*starts[1:], border.shape[1]]
    home = np.searchsorted(starts, lists, "right") - 1
    mixed = (reps.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    part = mixed.astype(np.int64) % parts[home]
    for b, (start, end) in enumerate(zip(starts, ends, strict=True)):
        mine, probed = home == b, border[:, start:end]
        some = np.flatnonzero(mine | probed.any(1))
        if parts[b] > 1:  # its first list is its only one: members meet those in the parts before theirs
            probed = probed | (mine[:, None] & (np.arange(end - start) == 0)[None])
        bits = [row.tobytes() for row in np.packbits(probed[some], axis=1)]
        for row, probes in zip(some.tolist(), bits, strict=True):
            if mine[row]:
                yield row, numbers[b] + part[row], True, start, probes
            for other in range(part[row] if mine[row] else parts[b]):
                yield row, numbers[b] + other, False, start, probes


def placed(reps: DataFrame, layout: DataFrame, index: Index) -> DataFrame:
    """Every class in the block of its own list, with its code, and as a query in the blocks it probes.

    `probes` has a bit for every list of the block, from `first` on.
    """
    kind = reps.schema["embedding"].dataType.simpleString()
    schema = (
        f"label bigint, size int, rep bigint, copies bigint, embedding {kind}, block int, own boolean, first int, "
        "probes binary, list int, code binary, error double"
    )

    def run(batches):
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            units = index.unit(columns["embedding"])
            lists = _nearest(units, index.centres)
            codes, errors = index.codes(units, lists)
            border, reps = index.borders(units, lists), columns["rep"].to_numpy()
            labels: dict[tuple, list[int]] = {}
            for row, label in enumerate(zip(columns["label"].to_pylist(), columns["size"].to_pylist(), strict=True)):
                labels.setdefault(label, []).append(row)
            found = []
            for rows in map(np.array, labels.values()):
                given = columns["blocks"][int(rows[0])].as_py()
                starts, parts = (np.array([block[name] for block in given]) for name in ("list", "parts"))
                records = _records(border[rows], lists[rows], reps[rows], starts, parts)
                found += [(rows[row], *rest) for row, *rest in records]
            for start in range(0, len(found), TILE):
                row, block, own, first, probes = zip(*found[start : start + TILE], strict=True)
                at = np.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[columns[name].take(pa.array(at)) for name in ("label", "size", "rep", "copies", "embedding")],
                        pa.array(block, pa.int32()),
                        pa.array(own),
                        pa.array(first, pa.int32()),
                        pa.array(probes, pa.binary()),
                        pa.array(lists[at].astype(np.int32), mask=~np.array(own)),
                        pa.array([codes[i].tobytes() if mine else None for i, mine in zip(row, own)], pa.binary()),
                        pa.array(errors[at], mask=~np.array(own)),
                    ],
                    [field.split()[0] for field in schema.split(", ")],
                )

    # The table of blocks is small and its size known, so that Spark sends it to all tasks.
    rows = reps.select("rep", "copies", "label", "size", "embedding").join(layout, ["label", "size"])
    return rows.select("rep", "copies", "label", "size", "embedding", "blocks").mapInArrow(run, schema)


class _Pairs:
    """Pairs of rows, of which only those are kept that connect."""

    def __init__(self):
        self.left, self.right, self.n = [], [], 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        self.n += len(left)
        if self.n > PAIRS:
            left, right = self.connecting()
            self.left, self.right, self.n = [left], [right], 0

    def connecting(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.left:
            return (np.empty(0, np.int64),) * 2
        left, right = np.concatenate(self.left), np.concatenate(self.right)
        names, places = np.unique(np.concatenate([left, right]), return_inverse=True)
        pairs = _connecting(places[: len(left)], places[len(left) :], len(names))
        return names[pairs[:, 0]], names[pairs[:, 1]]


class _Block:
    """The members of a block, or of a part of one, which come first; vectors that probe it pass by."""

    def __init__(self, index: Index, least: float):
        self.index, self.least, self.tables, self.ids = index, least, [], None

    def take(self, table: pa.Table) -> Iterator[dict]:
        if table.column("own")[0].as_py():
            self.tables.append(table)
            return
        yield from self.ready()
        for at in range(0, table.num_rows if len(self.ids) else 0, TILE):
            part = table.slice(at, TILE)
            ids, copies = part.column("rep").to_numpy(), part.column("copies").to_numpy()
            yield from self.met(ids, copies, self.index.unit(part.column("embedding")), self.bits(part))

    def close(self) -> Iterator[dict]:
        yield from self.ready()
        if len(self.ids):
            yield self.counted(self.ids, self.counts)

    def ready(self) -> Iterator[dict]:
        """Members by list, once all are here, and the links among them."""
        if self.ids is not None:
            return
        self.ids = np.empty(0, np.int64)
        if not self.tables:
            return
        table, self.tables = pa.concat_tables(self.tables), []
        table = table.take(pa.array(np.argsort(table.column("list").to_numpy(), kind="stable")))
        self.ids, self.copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        self.counts, self.first = np.zeros(len(self.ids), np.int64), table.column("first")[0].as_py()
        self.units, self.errors = self.index.unit(table.column("embedding")), table.column("error").to_numpy()
        codes = b"".join(table.column("code").to_pylist())
        self.decoded = self.index.decoded(np.frombuffer(codes, np.uint8).reshape(len(self.ids), -1))
        lists, edges = table.column("list").to_numpy(), [*_begins(table, ["list"]), len(self.ids)]
        self.lists = [(int(lists[start]), start, end) for start, end in zip(edges[:-1], edges[1:], strict=True)]
        # In a list that is in parts, the own bit is for other parts.
        pairs, bits = _Pairs(), self.bits(table)
        for at, start, end in self.lists:
            own = np.arange(start, end)
            others = np.setdiff1d(np.flatnonzero(bits[:, at - self.first]), own, assume_unique=True)
            for queries in (others, own):
                for left, right in self.near(at, start, end, self.units, queries, queries is own):
                    np.add.at(self.counts, left, self.copies[right])
                    np.add.at(self.counts, right, self.copies[left])
                    pairs.add(left, right)
        yield self.linked(self.ids, pairs)

    def met(self, ids: np.ndarray, copies: np.ndarray, units: np.ndarray, bits: np.ndarray) -> Iterator[dict]:
        """Links of vectors that pass by."""
        counts, pairs = np.zeros(len(ids), np.int64), _Pairs()
        for at, start, end in self.lists:
            queries = np.flatnonzero(bits[:, at - self.first])
            for left, right in self.near(at, start, end, units, queries, False):
                np.add.at(counts, left, self.copies[right])
                np.add.at(self.counts, right, copies[left])
                pairs.add(left + len(self.ids), right)
        yield self.linked(np.concatenate([self.ids, ids]), pairs)
        yield self.counted(ids, counts)

    def near(
        self, at: int, start: int, end: int, units: np.ndarray, queries: np.ndarray, own: bool
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) of a list that link; with `own`, queries are its members, and a pair is looked at once."""
        for some in range(start, end, TILE):
            members = np.arange(some, min(some + TILE, end))
            least = (self.errors[members] + self.index.radius + SLACK) ** 2
            for row in range(0, len(queries), SLICE):
                rows = queries[row : row + SLICE]
                if own and rows[0] >= members[-1]:
                    continue
                close = self.index.distances(units[rows], at, self.decoded[members]) <= least
                if own:
                    close &= members[None] > rows[:, None]
                left = np.flatnonzero(close.any(0))
                if len(left):
                    exact = units[rows] @ self.units[members[left]].T >= self.least
                    found = np.nonzero(exact & close[:, left])
                    yield rows[found[0]], members[left[found[1]]]

    @staticmethod
    def bits(table: pa.Table) -> np.ndarray:
        probes = table.column("probes").to_pylist()
        return np.unpackbits(np.frombuffer(b"".join(probes), np.uint8).reshape(len(probes), -1), axis=1).astype(bool)

    @staticmethod
    def linked(ids: np.ndarray, pairs: _Pairs) -> dict:
        left, right = pairs.connecting()
        return {"a": ids[left], "b": pa.array(ids[right]), "n": np.zeros(len(left), np.int64)}

    @staticmethod
    def counted(ids: np.ndarray, counts: np.ndarray) -> dict:
        some = np.flatnonzero(counts)
        return {"a": ids[some], "b": pa.nulls(len(some), pa.int64()), "n": counts[some]}


def compared(rows: DataFrame, index: Index, least: float) -> DataFrame:
    """(a, b, n): to `a` link n vectors of this block, where b is null; else a and b are connected."""
    key = ["label", "size", "block"]

    def of_blocks(batches):
        at, block = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            begins = [*_begins(table, [*key, "own"]), table.num_rows] if table.num_rows else []
            for start, end in zip(begins[:-1], begins[1:], strict=True):
                part = table.slice(start, end - start)
                here = tuple(part.column(name)[0].as_py() for name in key)
                if here != at:
                    if block is not None:
                        yield from block.close()
                    at, block = here, _Block(index, least)
                yield from block.take(part)
        if block is not None:
            yield from block.close()

    def run(batches):
        for out in of_blocks(batches):
            if len(out["a"]):
                yield pa.RecordBatch.from_pydict({name: pa.array(out[name]) for name in ("a", "b", "n")})

    partitions = max(SPREAD, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(partitions, *key).sortWithinPartitions(*key, F.desc("own"))
    return dealt.mapInArrow(run, "a bigint, b bigint, n bigint")


def _connecting(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """As few of the pairs as connect the same rows."""
    if not len(left):
        return np.empty((0, 2), np.int64)
    both = np.concatenate([left, right]), np.concatenate([right, left])
    order = np.argsort(both[0], kind="stable")
    others = both[1][order]
    starts = np.searchsorted(both[0][order], np.arange(size + 1))
    rows = np.unique(both[0])
    seen, out = np.zeros(size, bool), []
    for first in rows:
        if seen[first]:
            continue
        seen[first], todo = True, [first]
        while todo:
            row = todo.pop()
            near = np.unique(others[starts[row] : starts[row + 1]])
            near = near[~seen[near]]
            seen[near] = True
            out += [(row, other) for other in near]
            todo += near.tolist()
    return np.array(out, np.int64).reshape(-1, 2)


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable by links) and kept."""
    value = F.col("embedding")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists(value, lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # Equal vectors meet by a digest of theirs, counted before the shuffle.
    same = F.unhex(F.sha2(F.concat_ws(",", F.col("label").cast("string"), value.cast("array<string>")), 256))
    rows = vectors.select(
        "vec_id", "embedding", F.col("label").cast("bigint").alias("label"), F.when(usable, same).alias("digest")
    )
    first = F.min(F.struct("vec_id", "label", "embedding"))
    reps = rows.filter("digest IS NOT NULL").groupBy("digest").agg(first.alias("first"), F.count("*").alias("copies"))
    reps = reps.select(
        "digest",
        F.col("first.vec_id").alias("rep"),
        "first.label",
        "first.embedding",
        F.size("first.embedding").alias("size"),
        "copies",
    )
    with shuffles_freed(vectors.sparkSession):
        reps = stored(reps)
    counts, named = _links(reps, least)
    classes = (
        reps.select("digest", "rep", "copies")
        .join(counts, F.col("rep") == F.col("a"), "left")
        .join(named, F.col("rep") == F.col("id"), "left")
        .select(
            "digest",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("component_id", "rep").alias("component"),
        )
    )
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id", "digest").join(classes, "digest", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def _links(reps: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(a, n): vectors outside the class that link to it; (id, component_id) of linked classes."""
    index = fit(reps, least)
    if index is None:
        empty = reps.select(F.col("rep").alias("a"), F.lit(0).alias("n"))
        return empty, empty.select(F.col("a").alias("id"), F.col("a").alias("component_id"))
    with shuffles_freed(reps.sparkSession):
        found = stored(compared(placed(reps, stored(blocks(reps, index)), index), index, least))
        counts = stored(found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n")))
        return counts, components(found.filter("b IS NOT NULL").select("a", "b"))


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
