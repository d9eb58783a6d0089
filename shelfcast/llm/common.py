"""What several operators share: checkpoints, text in tasks, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The white space that separates words, in every contract: space, tab, line feed, VT, FF, CR.
# bytes.split() cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set, one of this machine, if that is all there is."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """The frame checkpointed in the folder the cluster shares; survives a lost executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The frame written as Parquet to the folder the cluster shares, and read again."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Tables written inside delete their shuffle files when they stand, and not when the driver collects its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def removed(df: DataFrame) -> None:
    """Deletes a table of `stored` that nothing reads any more."""
    spark = df.sparkSession
    conf, Path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = Path(folder)
        path.getFileSystem(conf).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def per_text(
    df: DataFrame, columns: list[str], rows_of: Callable[[Iterator[dict]], Iterator[dict]], schema: str
) -> DataFrame:
    """Runs `rows_of` over the rows of each partition, a batch in memory at a time.

    `rows_of` takes a batch as a dictionary of Python lists and gives one of the columns of `schema`.
    """

    names = [part.split()[0] for part in schema.split(", ")]
    kinds = _arrow_schema(df.sparkSession, schema)

    def run(batches):
        def lists():
            for batch in batches:
                yield {name: batch.column(i).to_pylist() for i, name in enumerate(columns)}

        for out in rows_of(lists()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[name], kinds.field(name).type) for name in names], schema=kinds
            )

    return df.select(*columns).mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every id in `links` (a, b): the smallest id reachable, itself included.

    Each round points every id at its smallest neighbour, follows the pointers to their ends, and puts
    the ends in place of the ids in the links. Every tree of pointers becomes one id, so rounds and the
    jumps of each are logarithms of the number of ids, for chains too. The minimum is taken before the
    shuffle; the joins on hot ids are equi-joins that Spark splits.

    Rounds go on from written tables, whose sizes are known. A checkpoint keeps the size that was
    estimated for it, the product of the sizes that were joined, and in a loop that number gets so
    many digits that planning never ends.
    """
    links = stored(links.filter("a <> b").distinct())
    ids = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).distinct()
    found = stored(ids.select("id", F.col("id").alias("component_id")))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        ends = _ends(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")))
        before, found = found, found.join(ends, found.component_id == ends.a, "left").select(
            "id", F.coalesce("low", "component_id").alias("component_id")
        )
        found = stored(found)
        left = ends.select("a", F.col("low").alias("low_a"))
        right = ends.select(F.col("a").alias("b"), F.col("low").alias("low_b"))
        last, links = links, links.join(left, "a").join(right, "b")
        links = links.select(F.col("low_a").alias("a"), F.col("low_b").alias("b"))
        links = stored(links.filter("a <> b").distinct())
        for table in (before, last, ends):
            removed(table)
    return found


def _ends(pointers: DataFrame) -> DataFrame:
    """(a, low) with every pointer followed to the id that points at itself."""
    pointers = stored(pointers)
    while True:
        further = pointers.select(F.col("a").alias("_at"), F.col("low").alias("_low"))
        jumped = pointers.join(further, F.col("low") == F.col("_at"))
        jumped = stored(jumped.select("a", F.col("_low").alias("low"), (F.col("low") != F.col("_low")).alias("moved")))
        removed(pointers)
        pointers = jumped.select("a", "low")
        if jumped.filter("moved").isEmpty():
            return pointers


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """Adds `rank`, gapless from 0 in the given order, without bringing all rows into one task.

    Rows are range-partitioned and sorted; each partition numbers its own rows, and the counts of the
    partitions before it, one number per partition, are added. Rows that tie on `order` are numbered
    in any order: end it with what tells them apart.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Written out, so that partitions hold the same rows when they are read again.
    parts = settled(parts).withColumn("_part", F.spark_partition_id())
    parts = parts.withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    counts = parts.groupBy("_part").count().sort("_part").collect()
    starts = zip((row["_part"] for row in counts), accumulate((row["count"] for row in counts), initial=0))
    table = df.sparkSession.createDataFrame(list(starts), "_part int, _start bigint")
    joined = parts.join(F.broadcast(table), "_part")
    return joined.withColumn("rank", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def tiled(df: DataFrame, chunks: Column, row: str) -> DataFrame:
    """Deals the rows of large groups out to tiles, so that every pair of rows meets in one of them.

    A group of c chunks has a tile for every pair of chunks, and a row goes to the c tiles of its own
    chunk. Groups of one chunk are left whole. Adds `tile_a` and `tile_b`.
    """
    own = F.pmod(F.xxhash64(row), F.col("_chunks")).cast("int")
    split = df.withColumn("_chunks", chunks.cast("int")).withColumn("_own", own)
    split = split.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return split.withColumns(
        {"tile_a": F.least("_own", "_other"), "tile_b": F.greatest("_own", "_other")}
    ).drop("_chunks", "_own", "_other")


def in_groups(
    df: DataFrame, key: list[str], rows_of: Callable[[pa.Table, np.ndarray], dict | None], schema: str
) -> DataFrame:
    """Runs `rows_of` over tables of whole groups that stand together.

    `rows_of` takes the rows and where each group begins, with the number of rows at the end. Many
    small groups share a call; a group that reaches over batches is put together first.
    """
    kinds = _arrow_schema(df.sparkSession, schema)

    def run(batches):
        rest = None
        for batch in chain(batches, [None]):
            table = [] if batch is None else [pa.Table.from_batches([batch])]
            table = pa.concat_tables(([rest] if rest is not None else []) + table) if table or rest is not None else None
            if table is None or not table.num_rows:
                continue
            begins = _begins(table, key)
            whole = begins[-1] if batch is not None else table.num_rows
            rest = table.slice(whole) if batch is not None else None
            if whole:
                ends = begins if batch is not None else np.append(begins, whole)
                out = rows_of(table.slice(0, whole), ends)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], f.type) for f in kinds], schema=kinds
                    )

    return df.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def _begins(table: pa.Table, key: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for name in key:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def blobs(table: pa.Table, name: str, kind: type, width: int) -> np.ndarray:
    """A column of equally long binaries as rows of numbers."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(table.num_rows, width)


def forest(size: int, like: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that join rows 0 to size-1 as all pairs that are alike would, but without the others.

    `like(row, others)` tells which of `others` are alike. Rows already reached are not compared
    again, so a group of which all are alike takes one comparison per row.
    """
    left, out = np.arange(size), []
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            row = reached.pop()
            found = like(row, left)
            new = left[found]
            out += [(row, int(other)) for other in new]
            reached += new.tolist()
            left = left[~found]
    return out


def in_blocks(docs: DataFrame, count: int) -> DataFrame:
    """block, doc_id and text: documents dealt out by a hash of their id."""
    return docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int").alias("block"), "doc_id", "text")


def packed(*arrays: np.ndarray) -> bytes:
    """The arrays' bytes, compressed; numbers by planes, since their high bytes are alike."""
    import zstandard

    planes = [a.view(np.uint8).reshape(len(a), -1).T if a.ndim == 1 else a for a in map(np.ascontiguousarray, arrays)]
    return zstandard.compress(b"".join(plane.tobytes() for plane in planes), 1)


def unpacked(blob: bytes, *kinds: tuple[type, int]) -> list[np.ndarray]:
    """Arrays of equally many rows, each given by its type and width."""
    import zstandard

    data = np.frombuffer(zstandard.decompress(blob), np.uint8)
    rows, out, at = len(data) // sum(np.dtype(k).itemsize * w for k, w in kinds), [], 0
    for kind, width in kinds:
        size = np.dtype(kind).itemsize
        part = data[at : at + rows * width * size]
        at += rows * width * size
        if width == 1:
            out.append(np.ascontiguousarray(part.reshape(size, rows).T).reshape(-1).view(kind))
        else:
            out.append(part.view(kind).reshape(rows, width))
    return out


def runs(groups: np.ndarray):
    """(value, slice) of each run of equal values."""
    cuts = np.flatnonzero(np.diff(groups)) + 1
    edges = [0, *cuts.tolist(), len(groups)]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        if end > start:
            yield int(groups[start]), slice(start, end)


def arrow_table(rows: list[tuple], fields: list[tuple]) -> pa.Table:
    schema = pa.schema(fields)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
