"""Source tables laid out by snapshot: python -m shelfcast.sources.layout --sources DIR --out DIR.

A history of snapshots is read for its newest one only. Laid out in folders by snapshot date, the newest
date comes from the folders' names, and the filter on it leaves the files of older snapshots unopened.
Plan versions are a folder level above the date, because the newest date is asked among validated rows.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.session import with_settings
from shelfcast.sources.readers import load_sources
from shelfcast.sources.schemas import SCHEMAS

# The columns that the folders of a source stand for, outermost first.
FOLDERS = {
    "sales_plan": ["review_cycle_version", "snapshot_date"],
    "stock_snapshots": ["snapshot_date"],
}


def write_snapshots(df: DataFrame, root: str, name: str) -> str:
    """Writes rows of a source in its folders, and gives the table's path.

    Only the folders that the rows belong to are replaced, so a day's snapshot is added to the history, and
    written again after a failure, without touching other days. A large snapshot is spread over tasks by
    the hash of its rows; each task writes one file per folder.
    """
    path, folders = f"{root}/{name}", FOLDERS.get(name, [])
    if not folders:
        df.write.mode("overwrite").parquet(path)
        return path
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(tasks))
    rows = df.repartition(tasks, *folders, spread).sortWithinPartitions(*folders)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).parquet(path)
    return path


def lay_out(sources: dict[str, DataFrame], root: str, names: Iterable[str] = tuple(SCHEMAS)) -> None:
    for name in names:
        write_snapshots(sources[name], root, name)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfcast.sources.layout", description=__doc__)
    parser.add_argument("--sources", required=True, help="folder of parquet source tables")
    parser.add_argument("--out", required=True, help="folder to write them to, in folders by snapshot")
    parser.add_argument("--only", nargs="*", default=list(SCHEMAS), choices=list(SCHEMAS))
    given = parser.parse_args(args)
    spark: SparkSession = with_settings(SparkSession.builder.appName("shelfcast layout")).getOrCreate()
    lay_out(load_sources(spark, given.sources, given.only), given.out, given.only)


if __name__ == "__main__":
    main()
