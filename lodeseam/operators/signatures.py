"""Keys folded to signatures, so that a search reads distinct shapes of keys and not keys.

All rows of a key that matter to a group of tests (the cells of a feature, the conditions of a checkpoint) make the key's
signature: the distinct (tag, mask) of its rows. Keys with equal signatures are one row with a weight. A test picks rows by their masks;
the key counts with the largest tag, and the largest amount, among the rows picked, exactly as if its rows were read again.

Where a key has a single amount the weight is the sum of the amounts; otherwise the signature holds the largest amount of each
(tag, mask), which is all that a maximum over picked rows can depend on.

A group's signatures usually fit one task, which then runs the group's whole search (:func:`search_each`). A group of more than
``MAX_ROWS`` is measured in rounds instead, one aggregation over the signature table per round (:func:`measured`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..config import AMOUNT
from ..functions.metrics import EPS, kpi_columns
from ..session import small_table

#: Rows of the signatures of a group that one task may hold (a few words each).
MAX_ROWS = 2_000_000
#: Longer signatures are not searched for rows that others cover: that only saves space.
PRUNED = 24

Figures = tuple[float, float]


def signatures(rows: DataFrame, metric: str, alone: int = 0, covering: bool = False, words: list[str] | None = None) -> DataFrame:
    """(group, rows, keys, weight) from rows (group, key, tag[, amt], *words); the words become the array ``mask`` of a row.

    Without ``words`` the rows have the array. ``alone`` says that a (group, key) has one row, whose mask has no more than that many
    words. ``covering`` says that a row picked by a test is also picked in the form of a row with more bits, so that covered rows of
    the same tag can go. Words are numbers until keys are counted, and rows that are held in the order of (key, group) are
    not hashed for it.
    """
    if words is None:
        longest = alone or rows.agg(F.max(F.size("mask"))).first()[0] or 1
        words = [f"_w{w}" for w in range(longest)]
        rows = rows.select("*", *[F.get("mask", F.lit(w)).alias(name) for w, name in enumerate(words)]).drop("mask")
    if alone:
        return _lone_rows(rows, F.col("amt").cast("double") if metric == AMOUNT else F.lit(1.0), words)
    rows = rows.withColumn("tag", F.col("tag").cast("int"))
    if metric != AMOUNT:
        per_key = rows.groupBy("key", "group").agg(F.collect_set(F.struct("tag", *words)).alias("rows"))
        same = _uncovered(F.col("rows"), words) if covering else F.col("rows")
        return _counted(per_key.select("group", F.sort_array(same).alias("rows"), F.lit(1.0).alias("weight")), words)
    blank = F.lit(None).cast("double").alias("amt")
    per_row = rows.groupBy("key", "group", "tag", *words).agg(F.max(F.col("amt").cast("double")).alias("amt"))
    per_key = per_row.groupBy("key", "group").agg(
        F.collect_list(F.struct("tag", "amt", *words)).alias("rows"),
        F.min("amt").alias("low"), F.max("amt").alias("high"), F.count_if(F.col("amt").isNull()).alias("blank"))
    one = (F.col("low") == F.col("high")) & (F.col("blank") == 0) | F.col("high").isNull()
    same = F.transform("rows", lambda r: F.struct(r.tag.alias("tag"), blank, *[r[w].alias(w) for w in words]))
    if covering:
        same = _uncovered(same, words)
    keyed = per_key.select("group", F.sort_array(F.when(one, same).otherwise(F.col("rows"))).alias("rows"),
                           F.when(one, F.col("high")).otherwise(1.0).alias("weight"))
    return _counted(keyed, words)


def _lone_rows(rows: DataFrame, amount: Column, words: list[str]) -> DataFrame:
    """The same for keys of one row."""
    counted = (rows.select("group", F.col("tag").cast("int").alias("tag"), amount.alias("weight"), *words)
               .groupBy("group", "tag", *words).agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight")))
    row = F.struct("tag", F.lit(None).cast("double").alias("amt"), _mask([F.col(w) for w in words]))
    return counted.select("group", F.array(row).alias("rows"), "keys", "weight")


def _mask(words: list[Column]) -> Column:
    return F.filter(F.array(*words), lambda w: w.isNotNull()).alias("mask")  # a shorter mask has no word there


def _counted(keyed: DataFrame, words: list[str]) -> DataFrame:
    counted = keyed.groupBy("group", "rows").agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight"))
    has_amount = "amt" in keyed.schema["rows"].dataType.elementType.names

    def masked_row(r: Column) -> Column:
        amount = r.amt if has_amount else F.lit(None).cast("double")
        return F.struct(r.tag.alias("tag"), amount.alias("amt"), _mask([r[w] for w in words]))
    masked = F.transform("rows", masked_row)
    return counted.select("group", masked.alias("rows"), "keys", "weight")


def _uncovered(rows: Column, words: list[str]) -> Column:
    kept = F.filter(rows, lambda x: ~F.exists(rows, lambda y: _covers(y, x, words)))
    return F.when(F.size(rows).between(2, PRUNED), kept).otherwise(rows)


def _covers(y: Column, x: Column, words: list[str]) -> Column:
    """Whether row y has all bits of row x and more, at the same tag."""
    return (y.tag.eqNullSafe(x.tag) & reduce(or_, (y[w] != x[w] for w in words))
            & reduce(and_, (y[w].bitwiseAND(x[w]) == x[w] for w in words)))


def picked_by_any(mask: Column, bits: Column) -> Column:
    return F.exists(F.zip_with(mask, bits, lambda a, b: a.bitwiseAND(b) != 0), lambda hit: hit)


def picked_by_all(mask: Column, bits: Column) -> Column:
    return F.forall(F.zip_with(mask, bits, lambda a, b: a.bitwiseAND(b) == b), lambda hit: hit)


def measured(table: DataFrame, tests: list[tuple[object, list[int]]], picks: Callable[[Column, Column], Column],
             group: str) -> DataFrame:
    """(test_id, target_catch, target_rate) of the tests (group, words) that pick any row; ids are list positions."""
    wanted = small_table(table.sparkSession, [(i, g, bits) for i, (g, bits) in enumerate(tests)],
                         f"test_id int, group {group}, bits array<bigint>")
    hit = F.filter("rows", lambda r: picks(r.mask, F.col("bits")))
    figures = (table.join(wanted, "group").withColumn("hit", hit).where(F.size("hit") > 0)
               .select("test_id", F.array_max(F.transform("hit", lambda r: r.tag)).alias("tag"), "weight",
                       F.array_max(F.transform("hit", lambda r: r.amt)).alias("most"),
                       F.exists("rows", lambda r: r.amt.isNotNull()).alias("varies")))
    value = F.when(F.col("varies"), F.col("weight") * F.coalesce("most", F.lit(0.0))).otherwise(F.col("weight"))
    return figures.withColumn("amt", value).groupBy("test_id").agg(*kpi_columns(AMOUNT))


class Held:
    """The signatures of one group as arrays."""

    def __init__(self, table: pa.Table):
        lists = table.column("rows").combine_chunks()
        rows = lists.flatten()
        offsets = lists.offsets.to_numpy().astype(np.int64)
        self.start = offsets[:-1] - offsets[0]
        self.weight = table.column("weight").to_numpy()
        tag, amt, mask = rows.flatten()
        self.tag = _floats(tag)
        self.amt = _floats(amt)
        self.varies = np.logical_or.reduceat(self.amt > -np.inf, self.start)
        self.mask = mask.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)

    def any_of(self, bits: list[int]) -> Figures:
        return self._figures(((self.mask & np.array(bits, np.int64)) != 0).any(axis=1))

    def all_of(self, bits: list[int]) -> Figures:
        need = np.array(bits, np.int64)
        return self._figures(((self.mask & need) == need).all(axis=1))

    def _figures(self, hit: np.ndarray) -> Figures:
        if not hit.any():
            return 0.0, 0.0
        tag = np.maximum.reduceat(np.where(hit, self.tag, -np.inf), self.start)
        value = self.weight
        if self.varies.any():
            most = np.maximum.reduceat(np.where(hit, self.amt, -np.inf), self.start)
            value = np.where(self.varies, self.weight * np.where(most > -np.inf, most, 0.0), self.weight)
        caught, labelled = float(value[tag == 1].sum()), float(value[(tag == 1) | (tag == 0)].sum())
        return round(caught, 6), round(caught / (labelled + EPS), 10)


def _floats(values: pa.Array) -> np.ndarray:
    """Numbers with nulls as minus infinity."""
    return values.cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)


def group_sizes(table: DataFrame) -> dict:
    """Rows of the signatures of each group: a number per feature or checkpoint."""
    return {r["group"]: r.n for r in table.groupBy("group").agg(F.sum(F.size("rows")).alias("n")).collect()}


def search_each(table: DataFrame, groups: list, run: Callable[[object, Held], Iterator[tuple]], group: str, result: str) -> list:
    """The rows that ``run(group, signatures)`` yields for each of the groups; a task holds one group."""
    schema = f"group {group}, {result}"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def task(part: pa.Table) -> pa.Table:
        key = part.column("group")[0].as_py()
        rows = [(key, *r) for r in run(key, Held(part))]
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)
    if not groups:
        return []
    return table.where(F.col("group").isin(*groups)).groupBy("group").applyInArrow(task, schema).collect()
