"""Catch and rate of conditions, metrics of patterns.

Conditions are measured together in one pass over the activity. An index turns a row into the words of
the conditions it meets: per variable a search through sorted cuts or values finds the row's cell, and a table has
the conditions that each cell leaves possible. Rows collapse to the words a key meets, keys of equal words are
counted, and only those counts are asked for single conditions. A busy key shrinks on the map side.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..conditions import INF, Atom, Condition, Equals, Flag, InSet, Range
from ..config import AMOUNT, SearchParams
from ..functions.bits import holds_all, literal, pack, positions, word_count
from ..functions.metrics import Registry, fscore, kpi_columns
from ..session import local_table, small_table
from . import signatures as sig


def roles_of(df: DataFrame, metric: str = AMOUNT) -> list[str]:
    """The key-level columns a metric needs, as far as the table has them."""
    wanted = ("tag", "amt") if metric == AMOUNT else ("tag",)
    return [c for c in wanted if c in df.columns]


def _max_roles(df: DataFrame) -> list[Column]:
    return [F.max(c).alias(c) for c in roles_of(df)]


def baseline(population: DataFrame, metric: str) -> DataFrame:
    return population.agg(*kpi_columns(metric, "total_catch", "base_rate"))


def thresholds(population: DataFrame, params: SearchParams) -> DataFrame:
    """Total catch, base rate, minimum support and minimum block as one row."""
    n = F.col("total_catch")
    block = F.lit(float(params.min_block_size))
    block = F.greatest(block * n, F.lit(1.0)) if params.min_block_size < 1 else block
    return baseline(population, params.eval_metric).withColumns(
        {"sup_n": F.lit(float(params.min_support)) * n, "min_block": block})


def measure_condition(activity: DataFrame, condition: Condition, metric: str) -> DataFrame:
    roles = [F.max(c).alias(c) for c in roles_of(activity, metric)]
    return (activity.where(condition.column()).groupBy("key").agg(*roles)
            .agg(*kpi_columns(metric)))


def matching_ids(conditions: list[Condition]) -> Column:
    """Ids (list positions) of the conditions a row meets."""
    ids = F.array(*[F.when(c.column(), F.lit(i)) for i, c in enumerate(conditions)])
    return F.filter(ids, lambda i: i.isNotNull())


def kpi_by_test(hits: DataFrame, metric: str) -> DataFrame:
    """(test_id, catch, rate) from rows of (test_id, key, tag[, amt])."""
    return (hits.groupBy("test_id", "key").agg(*_max_roles(hits))
            .groupBy("test_id").agg(*kpi_columns(metric)))


def _cells(variable: str, atoms: list[Atom]) -> tuple[Column, list[list[bool]]]:
    """The number of the cell of a row's value, and which atoms hold in each cell. Cell 0 is a missing value."""
    name = f"`{variable}`"
    if all(isinstance(a, Flag) for a in atoms):
        cell = f"CASE WHEN {name} THEN 1 WHEN NOT {name} THEN 2 ELSE 0 END"
        return F.expr(cell), [[v is not None and v == a.value for a in atoms] for v in (None, True, False)]
    if any(isinstance(a, Range) for a in atoms) or any(not isinstance(v, str) for a in atoms for v in _values(a)):
        edges = {float(e) for a in atoms if isinstance(a, Range) for e in (a.lo, a.hi) if abs(e) != INF}
        points = {float(v) for a in atoms for v in _values(a) if not isinstance(v, str)}
        cuts = sorted(edges | points)
        # between two cuts, and each cut by itself: 2 * cuts + 1 cells
        found = [[_holds(a, None) for a in atoms], *([_holds(a, x) for a in atoms] for x in _between(cuts))]
        return F.expr(f"CASE WHEN {name} IS NULL THEN 0 ELSE {_search(name, [f'{c!r}D' for c in cuts])} END"), found
    values = sorted({v for a in atoms for v in _values(a) if v != "None"}, key=lambda v: v.encode())
    found = [[_holds(a, None) for a in atoms], *([_holds(a, x) for a in atoms] for v in values for x in (_OTHER, v)),
             [_holds(a, _OTHER) for a in atoms]]
    return F.expr(f"CASE WHEN {name} IS NULL THEN 0 ELSE {_search(name, [sql_text(v) for v in values])} END"), found


_OTHER = object()


def _values(atom: Atom) -> tuple:
    return atom.values if isinstance(atom, InSet) else (atom.value,) if isinstance(atom, Equals) else ()


def _between(cuts: list[float]) -> list[float]:
    """A value of every cell: below the first cut, the cut, between it and the next, ..."""
    if not cuts:
        return [0.0]
    out = [cuts[0] - 1.0 - abs(cuts[0])]
    for c, after in zip(cuts, [*cuts[1:], None]):
        out += [c, c + 1.0 + abs(c) if after is None else c + (after - c) / 2]
    return out


def _holds(atom: Atom, value) -> bool:
    """Whether an atom holds for a value; null fails all but the comparison with the missing value."""
    if isinstance(atom, Equals) and atom.value == "None":
        return value is None
    if value is None or value is _OTHER:
        return False
    return atom.lo < value <= atom.hi if isinstance(atom, Range) else value in _values(atom)


def _search(x: str, cuts: list[str], cell: int = 1) -> str:
    """SQL text: the number of x's cell among sorted cuts, by halving; a cut is a cell by itself."""
    if not cuts:
        return str(cell)
    half = len(cuts) // 2
    return (f"CASE WHEN {x} < {cuts[half]} THEN {_search(x, cuts[:half], cell)} WHEN {x} = {cuts[half]} THEN {cell + 2 * half + 1} "
            f"ELSE {_search(x, cuts[half + 1:], cell + 2 * half + 2)} END")


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def condition_words(activity: DataFrame, conditions: list[Condition], keep: list[str]) -> DataFrame:
    """``keep`` columns and ``mask``, the words of the conditions met, of rows that meet any.

    Per variable a row is looked up once, whatever the number of conditions on it. Rows of other checkpoints are filtered at the scan.
    """
    n = word_count(len(conditions))

    def words(flags: list[bool]) -> list[int]:
        return literal([i for i, f in enumerate(flags) if f], n)
    seen = sorted({c.checkpoint for c in conditions})
    rows = activity.where(F.col("checkpoint").isin(seen))
    cell = F.array_position(F.array(*[F.lit(c) for c in seen]), F.col("checkpoint")).cast("int") - 1
    tables = [(cell, [words([c.checkpoint == cp for c in conditions]) for cp in seen])]
    for variable in sorted({a.variable for c in conditions for a in c.atoms}):
        mine = [(i, a) for i, c in enumerate(conditions) for a in c.atoms if a.variable == variable]
        cell, holds = _cells(variable, [a for _, a in mine])
        possible = []
        for held in holds:
            failed = {i for (i, _), h in zip(mine, held) if not h}
            possible.append(words([i not in failed for i in range(len(conditions))]))
        tables.append((cell, possible))
    names, cells = [f"_w{w}" for w in range(n)], [f"_c{t}" for t in range(len(tables))]
    found = []
    for w, name in enumerate(names):  # a word at a time, as plain numbers
        looked_up = [F.get(F.array(*[F.lit(e[w]) for e in entries]).cast("array<bigint>"), F.col(c)) for c, (_, entries) in zip(cells, tables)]
        found.append(reduce(lambda a, b: a.bitwiseAND(b), looked_up).alias(name))
    numbered = rows.select(*keep, *[cell.alias(c) for c, (cell, _) in zip(cells, tables)]).select(*keep, *found)
    return numbered.where(" OR ".join(f"{name} != 0" for name in names)).select(*keep, F.array(*names).alias("mask"))


def measure_conditions(activity: DataFrame, conditions: list[Condition], metric: str) -> DataFrame:
    """(test_id, content, catch, rate) of every condition; one without rows gets zeros."""
    names = local_table(activity.sparkSession, [(i, c.text) for i, c in enumerate(conditions)],
                        "test_id int, content string")
    roles, n = roles_of(activity, metric), word_count(len(conditions))
    rows = condition_words(activity, conditions, ["checkpoint", "key", *roles])
    words = [f"w{w}" for w in range(n)]
    keys = (rows.groupBy("key", "checkpoint", *roles).agg(*[F.bit_or(F.get("mask", F.lit(w))).alias(name) for w, name in enumerate(words)])
            .withColumnRenamed("checkpoint", "group"))
    counts = sig.signatures(keys, metric, words=words)
    tests = [(c.checkpoint, literal([i], n)) for i, c in enumerate(conditions)]
    measured = sig.measured(counts, tests, sig.picked_by_any, "string")
    return names.join(measured, "test_id", "left").fillna(0.0, ["target_catch", "target_rate"])


# ---- patterns ------------------------------------------------------------------------------

def measure_pattern(population: DataFrame, activity: DataFrame, pattern: list[Condition],
                    metric: str, registry: Registry | None = None) -> DataFrame:
    """All metrics of one pattern and of the rest of the population, one row per flag."""
    registry = (registry or Registry.default()).for_roles(population.columns)
    met = [F.max(F.when(c.column(), 1).otherwise(0)).alias(f"_c{i}")
           for i, c in enumerate(pattern)]
    some = reduce(or_, [c.column() for c in pattern])  # reaches the scan: other rows decide nothing
    keys = (activity.where(some).groupBy("key").agg(*met)
            .where(" AND ".join(f"_c{i} = 1" for i in range(len(pattern))))
            .select("key", F.lit(1).alias("_hit")))
    sums = (population.groupBy("key").agg(*registry.sum_columns()).join(keys, "key", "left")
            .groupBy(F.coalesce("_hit", F.lit(0)).alias("pattern_flag"))
            .agg(*registry.resum_columns()))
    return _finish(sums, registry, metric, W.partitionBy())


def metrics_by_group(flagged: DataFrame, group: str, metric: str,
                     registry: Registry | None = None) -> DataFrame:
    """All metrics of each value of ``group`` in a population-grained table."""
    registry = (registry or Registry.default()).for_roles(flagged.columns)
    return _finish(flagged.groupBy(group).agg(*registry.sum_columns()), registry, metric,
                   W.partitionBy())


def _finish(sums: DataFrame, registry: Registry, metric: str, over) -> DataFrame:
    keep = [c for c in sums.columns if c not in registry.row_sums]
    full = sums.withColumns({f"total_{n}": F.sum(n).over(over) for n in registry.row_sums})
    out = full.select(*keep, *registry.metric_columns(),
                      F.col(f"total_{metric}").alias("_total"))
    share = F.when(F.col("_total") > 0, F.col(metric) / F.col("_total")).otherwise(0.0)
    return out.withColumn("pattr_fscore", fscore(F.col(f"{metric}_rate"), share)).drop("_total")


def key_words(activity: DataFrame, conditions: list[Condition]) -> DataFrame:
    """Per key, the conditions met by any of its rows, packed into words w0, w1, ..."""
    words = pack([c.column() for c in conditions])
    rows = activity.select("key", *[w.alias(f"w{i}") for i, w in enumerate(words)])
    names = [f"w{i}" for i in range(len(words))]
    return (rows.where(" OR ".join(f"{n} != 0" for n in names))
            .groupBy("key").agg(*[F.bit_or(n).alias(n) for n in names]))


ALL = -1    # anchor of the row that adds up the whole population


def measure_patterns(population: DataFrame, words: DataFrame, patterns: list[tuple[int, ...]],
                     metric: str, registry: Registry | None = None) -> DataFrame:
    """All metrics of many patterns over one key table (see :func:`key_words`).

    The population collapses to one row of sums per key, so a busy key is small before it moves;
    it is joined once and collapses again, to one row per distinct set of met conditions. Only
    those rows meet the pattern table, through the pattern's first condition.
    """
    registry = (registry or Registry.default()).for_roles(population.columns)
    names = [c for c in words.columns if c != "key"]
    n = 1 + max(max(p) for p in patterns)
    per_key = population.groupBy("key").agg(*registry.sum_columns())
    sets = (per_key.join(words, "key", "left")
            .groupBy(*[F.coalesce(w, F.lit(0)).alias(w) for w in names])
            .agg(*registry.resum_columns()))
    rows = [(ALL, ALL, *[0] * len(names))]
    rows += [(i, p[0], *literal(p, len(names))) for i, p in enumerate(patterns)]
    needs = small_table(population.sparkSession, rows, "pattern_id int, anchor int, "
                        + ", ".join(f"n{i} bigint" for i in range(len(names))))
    anchors = F.concat(F.array(F.lit(ALL)), positions([F.col(w) for w in names], n))
    sums = (sets.withColumn("anchor", F.explode(anchors)).join(needs, "anchor")
            .where(holds_all([F.col(w) for w in names],
                             [F.col(f"n{i}") for i in range(len(names))]))
            .groupBy("pattern_id").agg(*registry.resum_columns()))
    # one row per pattern is left here, so the unpartitioned window is rule-sized
    total = {f"total_{s}": F.max(F.when(F.col("pattern_id") == ALL, F.col(s)))
             .over(W.partitionBy()) for s in registry.row_sums}
    out = (sums.withColumns(total).where(F.col("pattern_id") != ALL)
           .select("pattern_id", *registry.metric_columns(),
                   F.col(f"total_{metric}").alias("_total")))
    share = F.when(F.col("_total") > 0, F.col(metric) / F.col("_total")).otherwise(0.0)
    ids = local_table(population.sparkSession, [(i,) for i in range(len(patterns))],
                      "pattern_id int")
    measured = out.withColumn("pattr_fscore", fscore(F.col(f"{metric}_rate"), share))
    return ids.join(measured.drop("_total"), "pattern_id", "left").fillna(0.0)
