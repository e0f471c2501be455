"""Approximate nearest neighbours by a permutation index.

Pivots are drawn from the vectors. Each vector is represented by its ``prefix`` nearest pivots in order
and posted, with its place in that order, in the inverted files of those pivots. A query's order is
compared with the posted ones by the footrule distance (the sum of the differences of places; a pivot
missing from one order counts as one place past its end), and the nearest share of the
vectors by footrule is ranked again by Euclidean distance in double precision.

The index is split into blocks of at most ``BLOCK`` vectors, each with its own inverted files, and
the queries into blocks too; every block of queries meets every block of the index, and a
query's best of each block are merged. A block looks ``share`` of its vectors up again, so recall does not depend
on the number of blocks. Equal vectors are one entry that keeps its smallest ids.

Defined cases: rows whose vector is null, empty, zero or holds null or non-finite components take no part,
nor do rows with a null vec_id or with another number of components than most vectors (of equally frequent numbers, the
smaller). Rows that agree in vec_id and vector are one; a row with the query's vec_id is the query's
own. Ties go to the smaller vec_id. With fewer candidates than ``k``, all are returned; extra
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeseam.llm.common import stored

PIVOTS, PREFIX, SHARE = 128, 64, 0.35
BLOCK, QUERIES = 65_536, 2048
#: Blocks that even a small index is spread over.
SPREAD = 16


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector): the rows that take part, as arrays of doubles."""
    vector = F.col("embedding").cast("array<double>")
    whole = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("vector", lambda x: x != 0))
    rows = embeddings.select("vec_id", "embedding", vector.alias("vector")).where(whole).select("vec_id", "vector")
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vector") == (sizes.size if sizes else 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(ids, vector): each distinct vector with its k + 1 smallest ids, enough for any query."""
    # the limit works within map tasks already, so a very common vector stays small
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    distinct = rows.distinct()
    kept = distinct.withColumn("__n", F.row_number().over(by_vector)).where(F.col("__n") <= k + 1)
    return kept.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def prefixes(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first."""
    distance = (pivots ** 2).sum(axis=1) - 2 * vectors @ pivots.T
    prefix = min(prefix, len(pivots))
    near = np.argpartition(distance, prefix - 1, axis=1)[:, :prefix]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(distance, near, 1), axis=1, kind="stable"), 1)


class Block:
    """Inverted files of some entries: per pivot the entries that list it and at which place."""

    def __init__(self, ids: list, vectors: np.ndarray, pivots: np.ndarray, prefix: int):
        self.ids, self.vectors = ids, vectors
        order = prefixes(vectors, pivots, prefix)
        self.prefix = order.shape[1]
        entry, place = np.divmod(np.arange(order.size), self.prefix)
        by_pivot = np.argsort(order.ravel(), kind="stable")
        bounds = np.searchsorted(order.ravel()[by_pivot], np.arange(len(pivots) + 1))
        self.files = [(entry[by_pivot[a:b]], place[by_pivot[a:b]]) for a, b in zip(bounds, bounds[1:])]

    def nearest(self, query_id: int, query: np.ndarray, order: np.ndarray, k: int, share: float) -> list[tuple]:
        """(distance, vec_id) of the k best entries' ids after ranking by footrule and again by distance."""
        end = self.prefix
        # sums as if nothing were shared, then corrected by each shared pivot's difference of places
        footrule = np.full(len(self.ids), 2 * (end * (end + 1) // 2), np.int64)
        for at, pivot in enumerate(order):
            entry, place = self.files[pivot]
            footrule[entry] += np.abs(place - at) - (end - place) - (end - at)
        keep = max(k + 1, int(np.ceil(share * len(self.ids))))
        chosen = np.argsort(footrule, kind="stable")[:keep]
        distance = np.sqrt(((self.vectors[chosen] - query) ** 2).sum(axis=1))
        best = np.argsort(distance, kind="stable")
        limit = distance[best[min(k, len(best) - 1)]]
        found = [(d, i) for d, c in zip(distance, chosen) if d <= limit for i in self.ids[c] if i != query_id]
        return sorted(found)[:k]


def search(embeddings: DataFrame, is_query, k: int = 10, n_pivots: int = PIVOTS, prefix: int = PREFIX,
           share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of the rows for which ``is_query`` holds."""
    rows = stored(usable(embeddings))
    entry = stored(entries(rows, k))
    n = entry.count()
    blocks = max(1, -(-n // BLOCK), min(SPREAD, n // 64))
    # pivots: the distinct vectors of smallest hash; their number is a parameter
    pivots = np.array([r.vector for r in entry.orderBy(F.xxhash64("vector"), "vector").limit(n_pivots).collect()], float)
    queries = rows.where(is_query).distinct()
    query_blocks = max(1, -(-queries.count() // QUERIES))
    spread = F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int")
    # every block of the index goes to every block of queries, as packed rows
    index = (entry.withColumn("block", spread).withColumn("queries", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
             .select("block", "queries", "vector", "ids", F.lit(None).cast("long").alias("query_id")))
    asked = (queries.withColumn("queries", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select("block", "queries", "vector", F.lit(None).cast("array<bigint>").alias("ids"), F.col("vec_id").alias("query_id")))

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        asked = part["query_id"].notna().to_numpy()
        known = part[~asked]
        rows = []
        if len(known) and asked.any():
            block = Block([list(i) for i in known["ids"]], np.stack(known["vector"].to_list()), pivots, prefix)
            vectors = np.stack(part["vector"][asked].to_list())
            for query_id, query, order in zip(part["query_id"][asked].astype("int64"), vectors, prefixes(vectors, pivots, prefix)):
                rows.extend((query_id, d, i) for d, i in block.nearest(query_id, query, order, k, share))
        return pd.DataFrame(rows, columns=["query_id", "score", "vec_id"])
    found = index.union(asked).groupBy("block", "queries").applyInPandas(meet, "query_id long, score double, vec_id long")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
