"""What the corpus operators share: tables in the shared folder, groups of sorted rows, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.folders import new_path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, partition_by: str | None = None, **options) -> DataFrame:
    """*df* written to the shared folder and read back: work done once, lineage cut, safe against lost executors.

    With *partition_by*, the last column, each of its values has a folder of its own. The shuffles of the write go once
    it is done, as nothing reads them again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path, partitionBy=partition_by)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in Arrow batches; a batch is counted in rows, and texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def forget(df: DataFrame) -> None:
    """Delete the files of a table that :func:`stored` made and no later step reads."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        while "=" in folder.getName():
            folder = folder.getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches in which equal keys follow one another (*key* is a long, without nulls)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if held and keys[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = keys[start]
    if held:
        yield pa.Table.from_batches(held)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for each node of *edges* ``(a, b)`` (longs): the least node that it reaches.

    Large-star and small-star steps in turn, which need about as many rounds as the logarithm of the longest chain.
    Minima are pre-aggregated and joined back, so a node with very many links is never gathered.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        roots = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(roots, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(small.union(roots.select("a", F.col("m").alias("b"))).distinct(), "links")
        forget(current)
        current = after
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("label"))
    )
