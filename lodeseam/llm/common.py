"""Steps that several training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeseam.session import cut, local_table, shared_dir

#: Edges that one task joins to components (some 150 MB).
ONE_TASK = 500_000
#: A side of a join is broadcast up to this many (narrow) rows, and shuffled beyond it.
SMALL_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let the shuffles of a query go once it is done: for writes whose query is not used again."""
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(option, None)
    spark.conf.set(option, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(option)
        else:
            spark.conf.set(option, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: a cut that survives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    with dropping_shuffles(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that :func:`stored` wrote, once nothing reads it any more."""
    jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(conf).delete(path, True)


class WordCodes(dict):
    """64-bit hashes of words, the same in every process; at most ``KEPT`` words are kept at hand."""

    KEPT = 200_000

    def __missing__(self, word: str | bytes) -> int:
        if len(self) > self.KEPT:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        return code

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0. A null id counts as empty text, so it is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sized(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small; the optimizer's choice beyond."""
    return F.broadcast(df) if df.count() <= rows else df


def doc_labels(labels: DataFrame, target: str) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from.

    Null ids and null labels are left out; an id labelled more than once counts once, with its
    largest label.
    """
    return (labels.select("doc_id", F.col(target).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
                   & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as (a, b); component is the smallest node.

    The smallest nodes themselves have no row, like nodes without edges. Up to ONE_TASK edges are joined by one task. Beyond,
    in rounds: each round every node takes the smallest node among itself and its neighbours, and edges are
    moved to those (large and small stars), so that paths shorten by more than half. Work per
    round follows the number of edges; a hub's edges are grouped by partial minimum only.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct())
    if edges.count() <= ONE_TASK:
        return cut(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).coalesce(1)
                   .mapInArrow(_joined, "node long, component long"))
    while True:
        # large star: neighbours above a node move to the smallest of its neighbourhood
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.where("m < a").select("a", F.col("m").alias("b"))).distinct())
        # small star: neighbours below a node move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        after = cut(small)
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("component"))
        edges = after


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, smallest node) of what the edges connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    ends = [(x, root(x)) for x in parent]
    yield pa.record_batch({"node": pa.array([x for x, y in ends if x != y], pa.int64()),
                           "component": pa.array([y for x, y in ends if x != y], pa.int64())})


def running_total(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows before, in the order of distinct keys.

    The rows are dealt into ranges; the sums of the ranges, one per partition, go over the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id()))
    total, base = 0, []
    for r in sorted(dealt.groupBy("__part").agg(F.sum(value).alias("n")).collect(), key=lambda r: r["__part"]):
        base.append((r["__part"], total))
        total += r.n
    before = Window.partitionBy("__part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(local_table(spark, base, "__part int, __base long"))  # a row per partition
    return (dealt.join(offsets, "__part")
            .withColumn(name, F.col("__base") + F.coalesce(F.sum(value).over(before), F.lit(0)))
            .drop("__part", "__base"))
