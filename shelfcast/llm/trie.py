"""The trie of all prefixes of rebuilt conversations, by vertical bitmaps.

Turns are numbered within their conversation by a range-partitioned sort of all turns; a conversation then
begins with the first turns of another one. A turn is known by a digest of role and text, and a prefix by
two running sums, modulo 2^64, of hashes of (position, digest).

Conversations are cut into segments of SEGMENT turns, range-partitioned by conversation and segment, and
taken shard by shard: a bounded number of turns. A shard has, for every (position, turn), the set of its
conversations as bits of one number. From the bits of a prefix, the turn of its lowest conversation gives
the posting to intersect with: a child. What is left gives the next one, down to the end; a child's bits
give its number of members, its smallest, and the list of those that end there. Spark then adds up what
the shards say of each prefix. Shards follow each other in the order of conversation ids, so the lists of
ends do too, and are hashed one after another without being gathered.

Sums over subtrees need no walk over the tree: each node belongs to its smallest member, and the nodes
below a node v belong to members of v. So a sum over v's subtree is the sum of what belongs to v's
members (a second pass over the shards), less what belongs to v's smallest member above v.

Rows without conv_id are left out. A null role or text counts as empty. Rows of one conversation with the
same turn follow in the order of their digest, and repeated rows are turns of their own. Conversations
without a turn left are members of the root. The remainder of a negative id is negative, as in SQL. An empty table has no nodes. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfcast.llm.common import ranked, settled

# Turns of a segment, and turns and segments after which a shard is closed: bounds memory, not results.
SEGMENT, SHARD, SHARD_SEGMENTS = 1024, 16_384, 4096
# Fixed values of the rebuilding: ids in a family, and heads that are shorter than this.
FAMILY, HEADS = 5, 9
WORD = 1 << 64

NODES = "a bigint, b bigint, parent_a bigint, parent_b bigint, depth bigint, n bigint, conv_id bigint, n_bytes bigint, first_end bigint, ends string"
SUMS = "a bigint, b bigint, weight bigint, leaves bigint"


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, pos, key, n_bytes), and the number of turns of each conversation."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.unhex(F.substring(digest, 1, 32)).alias("key"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    placed = ranked(rows, [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("key")])
    counts = settled(placed.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count("*").alias("n_turns")))
    turns = placed.join(counts.select("conv_id", "first"), "conv_id")
    return turns.select("conv_id", (F.col("rank") - F.col("first")).alias("pos"), "key", "n_bytes"), counts.drop("first")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, n_bytes, n_turns) of the rebuilt conversations; one row at -1 for one without turns."""
    turns, counts = numbered(conversations)
    counts = counts.withColumns(
        {
            "head": F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)),
            "base": F.col("conv_id") - F.col("conv_id") % FAMILY,
        }
    )
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    borrowed = F.least("head", F.coalesce("base_turns", F.lit(0)))
    own = F.greatest(F.col("n_turns") - F.col("head"), F.lit(0))
    plan = counts.join(bases, "base", "left").select(
        "conv_id", "base", "head", borrowed.alias("borrowed"), (borrowed + own).alias("n_turns")
    )
    plan = settled(plan)
    kept = turns.join(plan, "conv_id").filter("pos >= head")
    kept = kept.select("conv_id", (F.col("borrowed") + F.col("pos") - F.col("head")).alias("pos"), "key", "n_bytes", "n_turns")
    heads = turns.filter(F.col("pos") < HEADS).withColumnRenamed("conv_id", "base").join(plan, "base")
    heads = heads.filter("pos < borrowed").select("conv_id", "pos", "key", "n_bytes", "n_turns")
    bare = plan.filter("n_turns = 0").selectExpr("conv_id", "-1L AS pos", "X'' AS key", "0L AS n_bytes", "n_turns")
    return kept.unionByName(heads).unionByName(bare)


def _wrapped(total: Column) -> Column:
    """A whole number as a signed 64-bit one, modulo 2^64."""
    word, half = (F.lit(str(number)).cast("decimal(38,0)") for number in (WORD, WORD // 2))
    rest = F.pmod(total.cast("decimal(38,0)"), word)
    return F.when(rest >= half, rest - word).otherwise(rest).cast("bigint")


def segments(turns: DataFrame) -> DataFrame:
    """Turns with segment, the two hashes, and the sums of hashes before the segment."""
    rows = turns.withColumns(
        {
            "segment": F.floor(F.greatest("pos", F.lit(0)) / SEGMENT),
            "a": F.xxhash64(F.lit(1), "pos", "key"),
            "b": F.xxhash64(F.lit(2), "pos", "key"),
        }
    )
    rows = settled(rows)
    # Only conversations of several segments; a row a segment.
    sums = rows.filter(F.col("n_turns") > SEGMENT).groupBy("conv_id", "segment")
    sums = sums.agg(*(F.sum(F.col(lane).cast("decimal(38,0)")).alias(lane) for lane in "ab"))
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv_id", "segment", *(_wrapped(F.sum(lane).over(before)).alias(f"start_{lane}") for lane in "ab"))
    found = {f"start_{lane}": F.coalesce(f"start_{lane}", F.lit(0)) for lane in "ab"}
    return rows.join(starts, ["conv_id", "segment"], "left").withColumns(found)


class Shard:
    """Segments of some conversations and their postings: for each (position, turn) the segments as bits."""

    def __init__(self, table: pa.Table):
        columns = {name: table.column(name).to_pylist() for name in table.column_names}
        self.weights = columns.get("weight")
        self.conv, self.begin, self.shift = [], [], []
        self.keys, self.bytes = columns["key"], columns["n_bytes"]
        self.a, self.b = columns["a"], columns["b"]
        self.postings: dict[tuple[int, bytes], int] = {}
        self.over: dict[int, int] = {}  # by depth: whose turns end there, in this segment or at all
        self.ended: dict[int, int] = {}
        self.roots: dict[tuple[int, int, int], int] = {}
        last, bit, segments, leaves = None, 0, columns["segment"], columns.get("leaves")
        self.of: list[tuple[int, int]] = []
        for row, (conv, pos) in enumerate(zip(columns["conv_id"], columns["pos"], strict=True)):
            unit = conv, segments[row]
            if unit != last:
                last, bit = unit, 1 << len(self.conv)
                depth = segments[row] * SEGMENT
                root = depth, columns["start_a"][row], columns["start_b"][row]
                self.roots[root] = self.roots.get(root, 0) | bit
                self.conv.append(conv)
                self.begin.append(row - depth)
                self.of.append((self.weights[row], leaves[row]) if leaves else (0, 0))
                if pos < 0:  # without turns
                    self.over[0] = self.over.get(0, 0) | bit
                    self.ended[0] = self.ended.get(0, 0) | bit
                    continue
            posting = pos, self.keys[row]
            self.postings[posting] = self.postings.get(posting, 0) | bit
            whole = pos + 1 == columns["n_turns"][row]
            if whole or (pos + 1) % SEGMENT == 0:
                self.over[pos + 1] = self.over.get(pos + 1, 0) | bit
            if whole:
                self.ended[pos + 1] = self.ended.get(pos + 1, 0) | bit

    def nodes(self):
        """(bits, depth, a, b, parent's a and b, bytes of the last turn) of every prefix in the shard."""
        for (depth, a, b), bits in self.roots.items():
            if depth == 0:
                yield bits, 0, 0, 0, None, None, 0
            todo = [(bits, depth, a, b)]
            while todo:
                bits, depth, a, b = todo.pop()
                rest = bits & ~self.over.get(depth, 0)
                while rest:
                    lowest = rest & -rest
                    row = self.begin[lowest.bit_length() - 1] + depth
                    child = rest & self.postings[depth, self.keys[row]] if rest != lowest else rest
                    rest ^= child
                    found = child, depth + 1, (a + self.a[row]) % WORD, (b + self.b[row]) % WORD
                    yield *found, a, b, self.bytes[row]
                    todo.append(found)

    def members(self, bits: int):
        while bits:
            lowest = bits & -bits
            yield lowest.bit_length() - 1
            bits ^= lowest

    def prefixes(self) -> pa.RecordBatch:
        """What the shard knows of each prefix."""
        out = [[] for _ in range(10)]
        for bits, depth, a, b, parent_a, parent_b, n_bytes in self.nodes():
            ends = bits & self.ended.get(depth, 0)
            ids = [self.conv[at] for at in self.members(ends)] if ends else None
            row = (
                a, b, parent_a, parent_b, depth, bits.bit_count(), self.conv[(bits & -bits).bit_length() - 1],
                n_bytes, ids and ids[0], ids and ",".join(map(str, ids)),
            )
            for column, value in zip(out, row, strict=True):
                column.append(value)
        for at in range(4):
            out[at] = _signed(out[at])
        return _batch(out, NODES)

    def sums(self) -> pa.RecordBatch:
        """Weights and leaves of the members of each prefix, added up."""
        out = [[] for _ in range(4)]
        for bits, _, a, b, *_ in self.nodes():
            of = [self.of[at] for at in self.members(bits)]
            for column, value in zip(out, (a, b, sum(w for w, _ in of), sum(n for _, n in of)), strict=True):
                column.append(value)
        return _batch([_signed(out[0]), _signed(out[1]), *out[2:]], SUMS)


def _signed(values: list[int | None]) -> list[int | None]:
    return [None if v is None else (v + WORD // 2) % WORD - WORD // 2 for v in values]


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    arrays = [pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def in_shards(rows: DataFrame, what: str, schema: str) -> DataFrame:
    """What the shards of the rows say; rows are sorted, and a shard closes where a segment ends."""
    order = ["conv_id", "segment"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "pos")

    def run(batches):
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                table = pa.Table.from_batches([batch.slice(at, SHARD)])
                held = table if held is None else pa.concat_tables([held, table])
                while held.num_rows >= SHARD:
                    cut = _cut(held, False)
                    yield getattr(Shard(held.slice(0, cut)), what)()
                    held = held.slice(cut)
        while held is not None and held.num_rows:
            cut = _cut(held, True)
            yield getattr(Shard(held.slice(0, cut)), what)()
            held = held.slice(cut)

    return sorted_rows.mapInArrow(run, schema)


def _cut(rows: pa.Table, last: bool) -> int:
    """Rows of the shard in front: whole segments, as many as a shard may have; the last one may go on below."""
    conv, segment = rows.column("conv_id").to_numpy(), rows.column("segment").to_numpy()
    begins = np.flatnonzero((conv[1:] != conv[:-1]) | (segment[1:] != segment[:-1])) + 1
    if len(begins) >= SHARD_SEGMENTS:
        return int(begins[SHARD_SEGMENTS - 1])
    return rows.num_rows if last else int(begins[-1])


def ends_digests(prefixes: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): the digest of all ids that end at a prefix. Lists of shards follow by their first id.

    SHA-256 takes its input in order, so the lists of one prefix are read by one task, a batch at a time.
    """
    key = ["a", "b"]
    lists = prefixes.filter("ends IS NOT NULL").select(*key, "first_end", "ends")
    lists = lists.repartition(*key).sortWithinPartitions(*key, "first_end")

    def run(batches):
        import hashlib

        last, digest = None, None
        for batch in batches:
            done = [[], [], []]
            for a, b, ends in zip(*(batch.column(name).to_pylist() for name in (*key, "ends")), strict=True):
                if (a, b) == last:
                    digest.update(b",")
                else:
                    if last:
                        _ended(done, last, digest)
                    last, digest = (a, b), hashlib.sha256()
                digest.update(ends.encode())
            yield _batch(done, "a bigint, b bigint, ends_sha256 string")
        if last:
            _ended(done := [[], [], []], last, digest)
            yield _batch(done, "a bigint, b bigint, ends_sha256 string")

    return lists.mapInArrow(run, "a bigint, b bigint, ends_sha256 string")


def _ended(done: list[list], key: tuple[int, int], digest) -> None:
    for column, value in zip(done, (*key, digest.hexdigest()), strict=True):
        column.append(value)


def _above(nodes: DataFrame) -> DataFrame:
    """Adds `above`: the weights that belong to the node's smallest member at lesser depths, by segments."""
    segment = F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / SEGMENT)
    nodes = nodes.withColumn("segment", segment)
    before = Window.partitionBy("conv_id", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    # Only of conversations that reach a second segment.
    totals = nodes.groupBy("conv_id", "segment").agg(F.sum("weight").alias("total"))
    carried = totals.select("conv_id", "segment", F.sum("total").over(earlier).alias("carried")).filter("segment > 0 AND carried <> 0")
    inside = nodes.withColumn("inside", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    inside = inside.join(carried, ["conv_id", "segment"], "left")
    return inside.withColumn("above", F.col("inside") + F.coalesce("carried", F.lit(0))).drop("inside", "carried", "segment")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each prefix of the rebuilt conversations; see the columns of the query."""
    turns = settled(segments(rebuilt(conversations)))
    prefixes = settled(in_shards(turns, "prefixes", NODES))
    same = {name: F.min(name).alias(name) for name in ("parent_a", "parent_b", "depth", "conv_id", "n_bytes")}
    nodes = prefixes.groupBy("a", "b").agg(F.sum("n").alias("n_convs"), *same.values())
    children = nodes.groupBy(F.col("parent_a").alias("a"), F.col("parent_b").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["a", "b"], "left").withColumns(
        {"n_children": F.coalesce("n_children", F.lit(0)), "weight": (F.col("n_convs") - 1) * F.col("n_bytes")}
    )
    nodes = settled(nodes)
    own = nodes.groupBy("conv_id").agg(
        F.sum("weight").alias("weight"), F.count_if(F.col("n_children") == 0).alias("leaves")
    )
    own = own.filter("weight > 0 OR leaves > 0")
    sums = in_shards(settled(turns.join(own, "conv_id")), "sums", SUMS)
    sums = sums.groupBy("a", "b").agg(F.sum("weight").alias("below"), F.sum("leaves").alias("n_leaves"))
    parents = nodes.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"))
    return (
        _above(nodes)
        .join(sums, ["a", "b"], "left")
        .join(ends_digests(prefixes), ["a", "b"], "left")
        .join(parents, ["parent_a", "parent_b"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
            (F.coalesce("below", F.lit(0)) - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
