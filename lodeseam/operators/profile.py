"""Value profiles of outcome activity: concentration, top values, exact quantiles, cuts.

All (checkpoint, variable) pairs are profiled together. The long form exists only between the
scan and the first map-side aggregation, which leaves one row per (pair, value, key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import AMOUNT, COUNT, Feature, VariableRules
from ..session import MAX_BROADCAST_ROWS, cut, small_table
from .shape import keep_value, name_matches

PAIR = ["checkpoint", "variable"]
PER_SPLIT = 250_000   # rows of a range that a group is divided into when rows are counted in order
ONE_TASK = 1_000_000  # distinct values of a pair that one task may sort


def long_values(activity: DataFrame, features: list[Feature], value_type: str = "string") -> DataFrame:
    """(checkpoint, variable, value, key, acct[, amt]) for the features of each row's checkpoint."""
    if not features:
        return (activity.where(F.lit(False)).withColumn("variable", F.lit(""))
                .withColumn("value", F.lit(None).cast(value_type)))
    by_variable: dict[str, list[str]] = {}
    for f in features:
        by_variable.setdefault(f.variable, []).append(f.checkpoint)
    entries = [F.when(F.col("checkpoint").isin(*cps),
                      F.struct(F.lit(v).alias("variable"),
                               F.col(f"`{v}`").cast(value_type).alias("value")))
               for v, cps in by_variable.items()]
    keep = ["checkpoint", "key", "acct"] + (["amt"] if "amt" in activity.columns else [])
    return (activity.select(*keep, F.explode(F.array(*entries)).alias("_e"))
            .select(*keep, "_e.variable", "_e.value").where("value is not null"))


def _per_value(rows: DataFrame, metric: str) -> DataFrame:
    """Per value: distinct keys or summed per-key amount as ``size``, and the rows ``n``.

    Both steps hash-aggregate: the first leaves one row per (pair, value, key).
    """
    per_key = rows.groupBy(*PAIR, "value", "key").agg(F.count(F.lit(1)).alias("n"), *_amount(metric))
    return per_key.groupBy(*PAIR, "value").agg(_size(metric), F.sum("n").alias("n"))


def _numbered(rows: DataFrame, features: list[Feature]) -> DataFrame:
    """Checkpoints and variables as numbers, which are narrower to group by than text; :func:`_named` puts the names back."""
    pairs = [sorted({f.checkpoint for f in features}), list(dict.fromkeys(f.variable for f in features))]
    return rows.withColumns({c: F.array_position(F.array(*[F.lit(n) for n in names]), F.col(c)).cast("int") for c, names in zip(PAIR, pairs) if names})


def _named(values: DataFrame, features: list[Feature]) -> DataFrame:
    pairs = [sorted({f.checkpoint for f in features}), list(dict.fromkeys(f.variable for f in features))]
    return values.withColumns({c: F.get(F.array(*[F.lit(n) for n in names]), F.col(c) - 1) for c, names in zip(PAIR, pairs) if names})


def _amount(metric: str) -> list[Column]:
    return [F.max("amt").alias("amt")] if metric == AMOUNT else []


def _size(metric: str) -> Column:
    size = F.sum("amt") if metric == AMOUNT else F.count(F.lit(1)).cast("double")
    return F.coalesce(size, F.lit(0.0)).alias("size")


def string_values(outcome: DataFrame, features: list[Feature], metric: str) -> DataFrame:
    """(checkpoint, variable, value string, size, n, several) of the string features.

    ``several`` says whether more than one account stands behind a value: the smallest and the largest hash of an account
    differ. Hashes are numbers, so both aggregations stay hash aggregations; text would have them sort. Accounts of equal
    hashes are told apart by :func:`account_counts`, which is asked where ``several`` is false and it matters.
    """
    rows = long_values(outcome, [f for f in features if f.type == "string"]).withColumn("who", account_hash(F.col("acct")))
    per_key = rows.groupBy(*PAIR, "value", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("who").alias("low"), F.max("who").alias("high"), *_amount(metric))
    return per_key.groupBy(*PAIR, "value").agg(
        _size(metric), F.sum("n").alias("n"), F.coalesce(F.min("low") < F.max("high"), F.lit(False)).alias("several"))


def account_hash(acct: Column) -> Column:
    return F.when(acct.isNotNull(), F.xxhash64(acct))


def number_values(outcome: DataFrame, features: list[Feature], metric: str) -> DataFrame:
    """(checkpoint, variable, value double, size, n) of the others; a boolean counts as 0 or 1."""
    others = [f for f in features if f.type != "string"]
    return _named(_per_value(_numbered(long_values(outcome, others, "double"), others), metric), others)


def running_count(rows: DataFrame, groups: list[str], order: str, n: str) -> DataFrame:
    """Add ``before``: the sum of ``n`` over the group's rows that sort earlier.

    ``order`` must be unique within a group. A group is divided at approximate quantiles into ranges of about PER_SPLIT
    rows, so no task sorts a whole group and the number of ranges follows the largest group. Split points and sums
    per range are one row per group and per range.
    """
    largest = rows.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    splits = max(2, -(-largest // PER_SPLIT))
    at = F.array(*[F.lit(i / splits) for i in range(1, splits)])
    bounds = rows.groupBy(*groups).agg(F.percentile_approx(order, at, F.lit(max(1000, 20 * splits))).alias("_bounds"))
    parts = (rows.join(_small(bounds, splits), groups)
             .withColumn("_split", F.size(F.filter("_bounds", lambda b: b < F.col(order))))
             .drop("_bounds"))
    offsets = earlier(parts.groupBy(*groups, "_split").agg(F.sum(n).alias("_n")),
                      groups, "_split", "_n", "_offset").drop("_n")
    return (earlier(parts, [*groups, "_split"], order, n, "_within")
            .join(_small(offsets), [*groups, "_split"])
            .withColumn("before", F.col("_offset") + F.col("_within"))
            .drop("_split", "_offset", "_within"))


def _small(df: DataFrame, values: int = 1) -> DataFrame:
    """Broadcast behind a count: rows of so many values each, up to the bound for small tables."""
    return F.broadcast(df) if df.count() * values <= MAX_BROADCAST_ROWS else df


def earlier(rows: DataFrame, groups: list[str], order: str, n: str, name: str) -> DataFrame:
    """Plain running sum, for groups that one task can sort."""
    window = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(n).over(window), F.lit(0)))


def concentration(sizes: DataFrame, metric: str) -> DataFrame:
    """Index per pair: how far the sorted cumulative size curve is from an even one.

    Equal sizes share one row, and a run of m equal sizes after r larger ones adds
    size * (m * (n - r) - m * (m - 1) / 2) to the sum of the cumulative curve. Sizes that count
    keys repeat: T (value, key) pairs give at most sqrt(2 T) distinct sizes, which one task can
    sort. Amounts need not repeat and are counted in splits. Their sums depend on the order in which rows arrive, in the
    last digit, and splits are looked at more than once, so they are summed once and stored.
    """
    runs = sizes.groupBy(*PAIR, (-F.col("size")).alias("_neg")).agg(
        F.count(F.lit(1)).cast("double").alias("m"))
    ranked = (earlier(runs, PAIR, "_neg", "m", "before") if metric == COUNT
              else running_count(cut(runs), PAIR, "_neg", "m"))
    m, r, size = F.col("m"), F.col("before"), -F.col("_neg")
    # sum of size * (m * (n - r) - m * (m - 1) / 2), with n known only after the sum
    parts = ranked.groupBy(*PAIR).agg(
        F.sum("m").alias("n"), F.sum(size * m).alias("total"),
        F.sum(size * (m * r + m * (m - 1) / 2)).alias("_less"))
    area = F.col("n") * F.col("total") - F.col("_less")
    even = F.col("n") * F.col("total") / 2
    return (parts.select(*PAIR, F.abs(F.try_divide(area, even) - 1).alias("concentration"))
            .where("concentration is not null"))


def top_values(sizes: DataFrame, rules: VariableRules, k: int | None = 10,
               over: float | None = None) -> DataFrame:
    """The k largest string values per pair, or all of a size over ``over``, by rank.

    Ignored values are left out; value text is the tiebreak. The sizes of a variable add up to no more than its
    rows, so a bound that is a share of the outcome bounds the number of values as well.
    """
    kept = sizes.where(keep_value(F.col("value"), rules.ignore_values))
    if over is not None:
        kept = kept.where(F.col("size") > over)
    rank = F.row_number().over(W.partitionBy(*PAIR).orderBy(F.col("size").desc(), "value"))
    ranked = kept.withColumn("rank", rank)
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def account_counts(top: DataFrame, outcome: DataFrame, features: list[Feature]) -> DataFrame:
    """Add the exact number of accounts behind each of these values."""
    wanted = top.select(*PAIR, "value")
    strings = [f for f in features if f.type == "string"]
    counts = (long_values(outcome, strings).join(wanted, [*PAIR, "value"])
              .select(*PAIR, "value", "acct").distinct()
              .groupBy(*PAIR, "value").agg(F.count("acct").alias("n_acct")))
    return top.join(counts, [*PAIR, "value"])


# ---- numeric ---------------------------------------------------------------------------------

def quantile_steps(min_support: float) -> list[float]:
    count = 1
    while (count + 1) * min_support < 1 - 1e-12:
        count += 1
    return sorted({*(i * min_support for i in range(1, count + 1)), 0.5})


def quantiles(counts: DataFrame, steps: list[float], one_task: int = ONE_TASK) -> DataFrame:
    """Exact, linearly interpolated quantiles of each pair, from its value counts.

    (checkpoint, variable, max_value, n_values, quantiles array in the order of ``steps``).
    The number of distinct values decides whether a pair is sorted by one task or in splits.
    """
    spark = counts.sparkSession
    totals = counts.groupBy(*PAIR).agg(F.sum("n").alias("total"), F.max("value").alias("max_value"),
                                       F.count(F.lit(1)).alias("n_values")).collect()
    wide = any(t.n_values > one_task for t in totals)
    before = (running_count(counts, PAIR, "value", "n") if wide
              else earlier(counts, PAIR, "value", "n", "before"))
    rows = []
    for t in totals:
        wanted, last = [], t.total - 1
        for place, p in enumerate(steps):
            low = int(p * last)
            share = p * last - low
            wanted += [{"place": place, "at": low, "share": 1 - share},
                       {"place": place, "at": min(low + 1, last), "share": share}]
        rows.append((t.checkpoint, t.variable, t.max_value, t.n_values, wanted))
    pairs = small_table(spark, rows, "checkpoint string, variable string, max_value double, "
                        "n_values bigint, wanted array<struct<place:int,at:bigint,share:double>>")
    here = F.filter("wanted", lambda w: (w["at"] >= F.col("before"))
                    & (w["at"] < F.col("before") + F.col("n")))
    # a handful of rows per pair reach this point: the neighbours of each wanted rank
    return (before.join(pairs, PAIR)
            .select(*PAIR, "max_value", "n_values", "value", F.explode(here).alias("_w"))
            .groupBy(*PAIR, "max_value", "n_values", F.col("_w.place").alias("place"))
            .agg(F.sum(F.col("value") * F.col("_w.share")).alias("q"))
            .groupBy(*PAIR, "max_value", "n_values")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "q"))),
                             lambda x: x["q"]).alias("quantiles")))


def rounded_cuts(values: Column) -> Column:
    """Positive quantiles on a coarse grid, distinct and sorted."""
    def grid(x: Column, step: int) -> Column:
        return F.floor(x / step) * step

    def coarse(x: Column) -> Column:
        return (F.when(x < 10, F.bround(x, 1)).when(x < 100, grid(x, 10).cast("double"))
                .when(x < 10_000, grid(x, 100).cast("double"))
                .otherwise(grid(x, 10_000).cast("double")))
    return F.array_sort(F.array_distinct(F.transform(F.filter(values, lambda x: x > 0), coarse)))


def fixed_cuts(cuts: tuple[float, ...], max_value: Column) -> Column:
    """The fixed cuts up to the first one that reaches the observed maximum."""
    every = F.array(*[F.lit(float(c)) for c in cuts])
    below = F.size(F.filter(every, lambda c: c < max_value))
    return F.slice(every, 1, F.least(F.lit(len(cuts)), below + 1))


def cuts_by_pair(summary: DataFrame, rules: VariableRules) -> DataFrame:
    """Cuts of every numeric pair: fixed where its name says so, else rounded quantiles."""
    cuts = rounded_cuts(F.col("quantiles"))
    for pattern, values in rules.fixed_cuts:
        cuts = F.when(F.lower("variable").rlike(f"(?i){pattern}"),
                      fixed_cuts(values, F.col("max_value"))).otherwise(cuts)
    return summary.select(*PAIR, "max_value", "n_values", cuts.alias("cuts"))


def direction(variable: str, rules: VariableRules) -> str:
    if name_matches(rules.up_names, variable):
        return "up"
    return "down" if name_matches(rules.down_names, variable) else "both"


def is_special(variable: str, rules: VariableRules) -> bool:
    return direction(variable, rules) != "both" or any(
        name_matches(p, variable) for p, _ in rules.fixed_cuts)
