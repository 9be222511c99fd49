"""Copies of intermediate rows in the folder that all executors and the driver share."""

from __future__ import annotations

import ctypes
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.sources.staging import kept_folder, remove, working_folder

def folder(spark: SparkSession) -> str:
    """Below spark.checkpoint.dir (a temporary folder only in local mode without it): a folder of
    this application, which goes when the application ends."""
    return kept_folder(spark, working_folder(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet below the shared folder and read back: this cuts the
    lineage, outlives executors and lets several readers share one computation."""
    return staged(df, name)[0]


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same with the path of the copy, for those who delete it."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def give_back() -> None:
    """Freed memory goes back to the system."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it has
        pass


def tidy(work):
    """A task's function whose worker gives freed memory back to the system at the end: workers
    live on, and the next stage finds theirs beside it."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


def free_name(columns: list[str], wanted: str) -> str:
    """The wanted name, with underscores until no column has it."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bucket_count(rows: int, per_bucket: int) -> int:
    return max(1, -(-rows // per_bucket))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links(a, b): the smallest node reachable.

    Alternating stars: each node hangs its larger neighbours on the smallest node it sees,
    then its smaller ones, until no link changes.  Rows are links throughout, one round
    shortens every path by a constant factor, and each round is staged.  A star's hub is
    handled by partial minima, so a hub of any size is no burden.
    """
    now, path = staged(links.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct(),
                       "links")
    while True:
        both = now.unionAll(now.select(F.col("a").alias("b"), F.col("b").alias("a")))  # a sees b
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours of a go to the smallest node a sees
        large = both.where("b > a").join(least, "a").select(F.col("m"), F.col("b").alias("a"))
        large = large.select(F.col("m").alias("b"), "a").distinct()
        # small star: the smaller neighbours of a, and a itself, go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("m").alias("b"), "a"),
                              F.struct(F.col("m").alias("b"), F.col("b").alias("a")))).alias("l"))
        after, written = staged(small.select("l.b", "l.a").where("a <> b").distinct(), "links")
        # the sums tell whether anything moved: both are over distinct links
        sums = [d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
                for d in (now, after)]
        remove(links.sparkSession, path)  # of a round nothing is needed once the next is written
        now, path = after, written
        if sums[0] == sums[1]:
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
