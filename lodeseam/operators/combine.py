"""Combination search across the rows of a key.

Candidates are numbered 0..n-1. Keys holding the same candidates fall into one weighted row of
``sets``, and every support question is asked of that table: what do the rows containing this
prefix weigh, split by each further candidate? A task takes its rows a block at a time and stands them on end: a
bitmap of rows per candidate. The rows of a prefix are the intersection of its bitmaps, and only candidates that occur
in those rows are added up, as a sparse product. So a task holds one block and one table of sums, both bounded, however many
candidates there are, and nothing is emitted per key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import ALIAS_CHECKPOINTS, AMOUNT, SearchParams
from ..functions.bits import WORD, positions, word_count
from ..session import small_table

Itemset = tuple[int, ...]
MAX_SUMS = 2_000_000     # sums a task holds before it hands them on
BLOCK_ROWS, BLOCK_PREFIXES = 4096, 512


def item_lists(hits: DataFrame, metric: str, floor: float, n: int) -> DataFrame:
    """(key, acct, items, weight) from outcome rows of (test_id, key, acct[, amt]), test ids being below ``n``.

    Ids are gathered as bits of a few words, which hash-aggregates; a set per key would have every task sort its rows.
    """
    weight = F.max("amt") if metric == AMOUNT else F.lit(1.0)
    names = [f"_w{w}" for w in range(word_count(n))]
    bits = []
    for w, name in enumerate(names):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("test_id") - w * WORD)
        here = F.col("test_id").between(w * WORD, (w + 1) * WORD - 1)
        bits.append(F.bit_or(F.when(here, bit).otherwise(F.lit(0).cast("bigint"))).alias(name))
    return (hits.where(F.col("tag") == 1).groupBy("key", "acct")
            .agg(*bits, F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(float(floor))).alias("weight"))
            .select("key", "acct", positions([F.col(name) for name in names], n).alias("items"), "weight"))


def item_frequency(lists: DataFrame, checkpoints: list[str]) -> DataFrame:
    """(checkpoint, item, weight): summed weight of the lists holding each candidate."""
    cps = F.array(*[F.lit(c) for c in checkpoints])
    return (lists.select(F.explode("items").alias("item"), "weight")
            .groupBy("item").agg(F.sum("weight").alias("weight"))
            .select(F.get(cps, F.col("item")).alias("checkpoint"), "item", "weight"))


def shorten(items: Column, checkpoints: list[str], order: list[int], long_list: int,
            per_checkpoint: int) -> Column:
    """Long lists keep the most frequent candidates of each checkpoint.

    ``order`` gives each candidate's global position by frequency; which items stay depends on
    the list alone, so no shuffle is needed.
    """
    names = {c: i for i, c in enumerate(dict.fromkeys(checkpoints))}
    cps = F.array(*[F.lit(names[c]) for c in checkpoints])
    place = F.array(*[F.lit(o) for o in order])

    def stays(i: Column) -> Column:
        better = F.filter(items, lambda j: (F.get(cps, j) == F.get(cps, i))
                          & (F.get(place, j) < F.get(place, i)))
        return F.size(better) < per_checkpoint
    return F.when(F.size(items) > long_list, F.filter(items, stays)).otherwise(items)


def frequency_order(frequency: DataFrame, n: int) -> list[int]:
    """Position of each candidate by (weight descending, number)."""
    weight = {r["item"]: r["weight"] for r in frequency.collect()}
    ranked = sorted(range(n), key=lambda i: (-weight.get(i, 0.0), i))
    place = [0] * n
    for position, i in enumerate(ranked):
        place[i] = position
    return place


def weighted_sets(lists: DataFrame) -> DataFrame:
    """One row per distinct item list."""
    return lists.groupBy("items").agg(F.sum("weight").alias("weight"))


def key_sets(lists: DataFrame) -> DataFrame:
    """Item lists per key alone: accounts of a key pooled, the largest weight kept."""
    # a key's items are pooled as distinct rows: a key with very many accounts shrinks within map tasks
    held = lists.select("key", F.explode("items").alias("item")).distinct()
    items = held.groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    weight = lists.groupBy("key").agg(F.max("weight").alias("weight"))
    empty = F.array().cast(lists.schema["items"].dataType)
    return weighted_sets(weight.join(items, "key", "left").select(
        "key", F.coalesce("items", empty).alias("items"), "weight"))


def extension_support(sets: DataFrame, prefixes: list[Itemset], n: int,
                      checkpoints: list[str] | None = None, ahead: bool = False) -> DataFrame:
    """(prefix_id, item, support): weight of the rows that hold prefix and item.

    With ``checkpoints`` only items of a checkpoint that the prefix does not name are added up, with ``ahead`` only
    those with a number above the prefix's last. Prefixes are of one length.
    """
    wanted = np.array([tuple(p) for p in prefixes], np.int64).reshape(len(prefixes), -1)
    code = None if checkpoints is None else np.unique(checkpoints, return_inverse=True)[1]

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, sums = np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                keys, values = _products(batch.iloc[start:start + BLOCK_ROWS], wanted, n, code, ahead)
                held, sums = _added(np.concatenate([held, *keys]), np.concatenate([sums, *values]))
                if len(held) > MAX_SUMS:
                    yield table(held, sums)
                    held, sums = held[:0], sums[:0]
        yield table(held, sums)

    def table(held: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"prefix_id": (held // n).astype("int32"), "item": (held % n).astype("int32"), "support": sums})

    return (sets.select("items", "weight")
            .mapInPandas(add_up, "prefix_id int, item int, support double")
            .groupBy("prefix_id", "item").agg(F.sum("support").alias("support")))


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their values."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, values, len(distinct))


def _products(block: pd.DataFrame, prefixes: np.ndarray, n: int, code: np.ndarray | None,
              ahead: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sums of a block of rows: keys prefix * n + item, and their weights."""
    size = block["items"].map(len).to_numpy()
    item = np.concatenate([*block["items"], np.zeros(0)]).astype(np.int64)
    row, first, weight = np.repeat(np.arange(len(block)), size), np.cumsum(size) - size, block["weight"].to_numpy()
    bitmaps = np.zeros((n, -(-len(block) // 8)), np.uint8)
    np.bitwise_or.at(bitmaps, (item, row >> 3), (128 >> (row & 7)).astype(np.uint8))
    keys, values = [], []
    for start in range(0, len(prefixes), BLOCK_PREFIXES):
        part = prefixes[start:start + BLOCK_PREFIXES]
        inside = np.full((len(part), bitmaps.shape[1]), 255, np.uint8)
        for column in part.T:
            inside &= bitmaps[column]
        prefix, at = np.nonzero(np.unpackbits(inside, axis=1, count=len(block)))
        width = size[at]
        pair = np.repeat(np.arange(len(at)), width)
        other = item[np.repeat(first[at], width) + np.arange(len(pair)) - np.repeat(np.cumsum(width) - width, width)]
        mine = prefix[pair]
        keep = np.ones(len(pair), bool)
        if ahead and part.shape[1]:
            keep &= other > part[mine, -1]
        if code is not None:
            for column in part.T:
                keep &= code[other] != code[column[mine]]
        k, v = _added((start + mine[keep]) * n + other[keep], weight[at[pair[keep]]])
        keys.append(k)
        values.append(v)
    return keys, values


def frequent_sets(sets: DataFrame, checkpoints: list[str], sup_n: float,
                  max_size: int) -> dict[Itemset, float]:
    """All candidate sets of distinct checkpoints with enough weight, one job a level; only those reach the driver."""
    n = len(checkpoints)
    found: dict[Itemset, float] = {}
    level: list[Itemset] = [()]
    for _ in range(max_size):
        rows = extension_support(sets, level, n, checkpoints, ahead=True).where(F.col("support") >= sup_n).collect()
        grown = {(*level[p], i): w for p, i, w in sorted(map(tuple, rows))}
        found.update(grown)
        level = list(grown)
        if not level:
            break
    return found


def cap_sets(sets: dict[Itemset, float], limit: int | None) -> tuple[dict[Itemset, float], bool]:
    """The ``limit`` best supported sets and whether any were left out."""
    if limit is None or len(sets) <= limit:
        return sets, False
    kept = sorted(sets, key=lambda s: (-sets[s], len(s), s))[:limit]
    return {s: sets[s] for s in kept}, True


# ---- co-occurrence graph -----------------------------------------------------------------------

def pair_support(sets: DataFrame, n: int) -> DataFrame:
    """(a, b, support) of every two candidates that occur together, (a, a) being a's own weight."""
    return extension_support(sets, [(i,) for i in range(n)], n).select(
        F.col("prefix_id").alias("a"), F.col("item").alias("b"), "support")


def cooccurrence(pairs: DataFrame, sup_n: float) -> tuple[DataFrame, DataFrame]:
    """Nodes (item, size) and edges (a, b, shared, weight) from pair supports."""
    nodes = pairs.where("a = b").select(F.col("a").alias("item"), F.col("support").alias("size"))
    a = nodes.select(F.col("item").alias("a"), F.col("size").alias("size_a"))
    b = nodes.select(F.col("item").alias("b"), F.col("size").alias("size_b"))
    edges = (pairs.where((F.col("a") < F.col("b")) & (F.col("support") >= sup_n))
             .join(a, "a").join(b, "b")
             .select("a", "b", F.col("support").alias("shared"),
                     F.round(F.col("support") / (F.col("size_a") + F.col("size_b")
                                                 - F.col("support")), 2).alias("weight")))
    return nodes, edges


def spanning_forest(edges: DataFrame) -> DataFrame:
    """(a, b) edges that connect what the edges of each partition connect, at most one per node and partition."""
    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
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
        yield pa.record_batch({"a": pa.array([x for x, y in ends if x != y], pa.int32()),
                               "b": pa.array([y for x, y in ends if x != y], pa.int32())})
    return edges.select(F.col("a").cast("int"), F.col("b").cast("int")).mapInArrow(contract, "a int, b int")


def components(nodes: DataFrame, edges: DataFrame, parts: int = 64) -> DataFrame:
    """(item, component): the smallest item reachable from each node.

    Each partition of the edges puts out a spanning forest, and eight forests at a time are contracted to one, until a single one
    is left. A forest has fewer edges than there are nodes, whose number is that of the search's candidates; every edge of the last
    one leads to the smallest node of its component. One job, without rounds.
    """
    forest = spanning_forest(edges)
    while parts > 1:
        parts = -(-parts // 8)
        forest = spanning_forest(forest.repartition(parts))
    named = forest.select(F.col("a").alias("item"), F.col("b").alias("component"))
    return nodes.join(named, "item", "left").select("item", F.coalesce("component", "item").alias("component"))


def walk_seeds(labels: DataFrame, edges: DataFrame, limit: int | None = None,
               seed: int = 42) -> DataFrame:
    """(component, item) to start walks from, for components of more than two nodes.

    All nodes without a limit or when they fit it; otherwise a draw without replacement weighted by degree,
    by the exponential-key method with a hash as the random number.
    """
    degree = (edges.select(F.col("a").alias("item")).unionAll(edges.select(F.col("b").alias("item")))
              .groupBy("item").agg(F.count(F.lit(1)).alias("degree")))
    u = (F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(1_000_003)) + 1) / F.lit(1_000_004.0)
    size = F.count(F.lit(1)).over(W.partitionBy("component"))
    place = F.row_number().over(W.partitionBy("component").orderBy(
        -F.log(u) / F.col("degree"), "item"))
    return (labels.join(degree, "item").withColumns({"_size": size, "_place": place})
            .where((F.col("_size") > 2) & (F.lit(limit is None) | (F.col("_place") <= (limit or 0))))
            .select("component", "item"))


def small_component_sets(labels: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(items, support): lone nodes and connected pairs stand for themselves."""
    sized = labels.withColumn("_size", F.count(F.lit(1)).over(W.partitionBy("component")))
    lone = (sized.where("_size = 1").join(nodes, "item")
            .select(F.array("item").alias("items"), F.col("size").alias("support")))
    pair = (edges.join(sized.where("_size = 2").select(F.col("item").alias("a")), "a")
            .select(F.array("a", "b").alias("items"), F.col("shared").alias("support")))
    return lone.unionByName(pair)


def node_edge_sets(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(items, support) of every node and every edge, for the wider search."""
    return (nodes.select(F.array("item").alias("items"), F.col("size").alias("support"))
            .unionByName(edges.select(F.array("a", "b").alias("items"),
                                      F.col("shared").alias("support"))))


def walk_step(sets: DataFrame, walks: list[Itemset], at: list[int], edges: DataFrame,
              checkpoints: list[str], sup_n: float) -> dict[int, tuple[int, float]]:
    """Best next candidate per walk: a neighbour of its end, a new checkpoint, most weight left. One row per walk is collected."""
    links = edges.select(F.col("a").alias("end"), F.col("b").alias("item")).unionAll(
        edges.select(F.col("b").alias("end"), F.col("a").alias("item")))
    ends = small_table(sets.sparkSession, list(enumerate(at)), "prefix_id int, end int")
    moves = (extension_support(sets, walks, len(checkpoints), checkpoints).where(F.col("support") > sup_n)
             .join(ends, "prefix_id").join(links, ["end", "item"]))
    best = moves.groupBy("prefix_id").agg(F.max_by(F.struct("item", "support"), F.struct("support", -F.col("item"))).alias("m"))
    return {r.prefix_id: (r.m["item"], r.m["support"]) for r in best.collect()}


def greedy_walks(sets: DataFrame, seeds: list[int], sizes: dict[int, float],
                 edges: DataFrame, checkpoints: list[str], sup_n: float,
                 max_size: int) -> dict[Itemset, float]:
    """All walks advance together, one job per step; equal walks merge at the end."""
    walks = [(s,) for s in seeds]
    support = [sizes[s] for s in seeds]
    live = list(range(len(walks)))
    for _ in range(max_size - 1):
        moves = walk_step(sets, [walks[i] for i in live], [walks[i][-1] for i in live], edges, checkpoints, sup_n) if live else {}
        for place, (item, left) in moves.items():
            i = live[place]
            walks[i], support[i] = (*walks[i], item), left
        live = [live[place] for place in sorted(moves)]  # a walk that found no next candidate is over
    return {tuple(sorted(w)): s for w, s in zip(walks, support)}


def distinct_checkpoint_sets(sets: dict[Itemset, float], checkpoints: list[str],
                             aliases=ALIAS_CHECKPOINTS) -> dict[Itemset, float]:
    """Drop sets that repeat a checkpoint or consist of several names of one activity."""
    out = {}
    for items, support in sets.items():
        cps = {checkpoints[i] for i in items}
        alias_only = len(cps) > 1 and any(cps <= group for group in aliases)
        if len(cps) == len(items) and not alias_only:
            out[items] = support
    return out


def checkpoint_filter(sets: DataFrame, cps: str = "checkpoints",
                      aliases=ALIAS_CHECKPOINTS) -> DataFrame:
    """The same on a table with an array column of checkpoints."""
    distinct = F.array_distinct(cps)
    keep = F.size(distinct) == F.size(cps)
    for group in aliases:
        inside = F.size(F.array_except(distinct, F.array(*[F.lit(c) for c in sorted(group)]))) == 0
        keep = keep & ~((F.size(distinct) > 1) & inside)
    return sets.where(keep)


@dataclass
class Combination:
    mode: str
    sets: dict[Itemset, float]


def choose_mode(params: SearchParams) -> str:
    """The search that was asked for; no size decides it."""
    return params.mode


def combine(lists: DataFrame, checkpoints: list[str], sup_n: float,
            params: SearchParams) -> Combination:
    """The candidate sets of the search that ``params.mode`` names."""
    n, mode = len(checkpoints), choose_mode(params)
    if mode == "itemsets":
        if params.long_list is not None:
            order = frequency_order(item_frequency(lists, checkpoints), n)
            lists = lists.withColumn("items", shorten(
                F.col("items"), checkpoints, order, params.long_list, params.per_checkpoint))
        whole = weighted_sets(lists).persist()
        sets = frequent_sets(whole, checkpoints, sup_n, params.lvl_limit)
        whole.unpersist()
    else:
        by_key = key_sets(lists).persist()
        pairs = pair_support(by_key, n).persist()
        nodes, edges = cooccurrence(pairs, sup_n)
        labels = components(nodes, edges)
        sets = {tuple(r["items"]): r.support
                for r in small_component_sets(labels, nodes, edges).collect()}
        seeds = [r["item"] for r in walk_seeds(labels, edges, params.walk_seeds)
                 .orderBy("item").collect()]
        if params.include_nodes_edges:
            sets.update({tuple(r["items"]): r.support
                         for r in node_edge_sets(nodes, edges).collect()})
        sizes = {r["item"]: r["size"] for r in nodes.collect()}
        sets.update(greedy_walks(by_key, seeds, sizes, edges, checkpoints, sup_n, params.lvl_limit))
        pairs.unpersist()
        by_key.unpersist()
    return Combination(mode, distinct_checkpoint_sets(sets, checkpoints))
