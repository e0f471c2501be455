"""Pattern selection: qualify, prune, score, tag, rank and de-duplicate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..conditions import ATOM_SEP, CONDITION_SEP, Condition
from ..config import AMOUNT, PRIORITY_SCORE, RANKINGS, Feature
from ..functions.bits import holds_all, literal
from ..session import cut, local_table


@dataclass
class Pattern:
    """A qualified pattern; ``conditions`` are sorted by text."""

    name: str
    conditions: list[Condition]
    items: tuple[int, ...]
    target_catch: float
    target_rate: float
    pattr_fscore: float
    pattr_score: float
    metrics: dict[str, float] = field(default_factory=dict)
    inc_catch: float = 0.0
    inc_catch_share: float = 0.0
    after_dedup: bool = False

    @property
    def cp_str(self) -> str:
        return "-".join(c.checkpoint for c in self.conditions)

    @property
    def content(self) -> str:
        return CONDITION_SEP.join(c.text for c in self.conditions)

    @property
    def parts(self) -> set[str]:
        return {part for c in self.conditions for part in c.text.split(ATOM_SEP)}


# ---- sets ------------------------------------------------------------------------------------

def minimal_sets(sets: DataFrame) -> DataFrame:
    """The qualified sets that contain no other qualified set of two or more items.

    ``sets`` has set_id, items (sorted array) and qualified. Each qualified set looks for its own proper subsets, whose number the
    length limit of the search bounds, so nothing is compared that does not match.
    """
    good = sets.where("qualified")
    within = F.filter(F.transform(F.sequence(F.lit(1).cast("bigint"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.size("items")) - 2), lambda mask: F.filter(
        "items", lambda _, i: F.getbit(mask, i) == 1)), lambda part: F.size(part) >= 2)
    parts = (good.where(F.size("items") >= 3)
             .select(F.col("set_id").alias("covered"), F.explode(within).alias("items")))
    covered = parts.join(good.select("items"), "items", "left_semi").select(F.col("covered").alias("set_id")).distinct()
    return good.join(covered, "set_id", "left_anti")


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of parts."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def similar_pairs(sets: DataFrame, group: str, parts: str, over: float) -> DataFrame:
    """(a, b, similarity) of the sets of a group whose similarity is more than ``over`` and not 0; ``a`` sorts first.

    Sets are distinct arrays. Each is looked up by its rarest parts only: two sets of a similarity over ``over`` share one of
    the first size - ceil(over * size) + 1 parts of either, in the same order of all parts.
    """
    held = sets.select(F.col(group).alias("of"), F.col(parts).alias("s"))
    each = held.select("of", "s", F.explode("s").alias("part"))
    ordered = (each.join(each.groupBy("of", "part").agg(F.count(F.lit(1)).alias("n")), ["of", "part"])
               .groupBy("of", "s").agg(F.array_sort(F.collect_list(F.struct("n", "part"))).alias("by")))
    enough = F.least(F.size("s"), F.size("s") - F.ceil(F.lit(float(over)) * F.size("s")).cast("int") + 1)
    keys = ordered.select("of", "s", F.explode(F.slice("by", F.lit(1), enough)).alias("k")).select("of", F.col("k.part").alias("part"), "s")
    pairs = (keys.withColumnRenamed("s", "a").join(keys.withColumnRenamed("s", "b"), ["of", "part"])
             .where("a < b").select("a", "b").distinct())
    return (pairs.withColumn("similarity", similarity(F.col("a"), F.col("b")))
            .where((F.col("similarity") > over) & (F.col("similarity") > 0)))


def drop_similar(patterns: DataFrame, overlap: float) -> DataFrame:
    """Within one checkpoint string, keep a pattern unless a better kept one is too similar.

    ``patterns`` has cp_str, parts (distinct arrays within a checkpoint string), target_rate, pattr_score and content, which order them.
    In every round the patterns without an undecided better neighbour stay, and their neighbours go; what a walk through the
    patterns from the best to the worst would keep.
    """
    if patterns.isEmpty():
        return patterns
    merit = F.struct((-F.col("target_rate")).alias("r"), (-F.col("pattr_score")).alias("s"), F.col("content").alias("c"))
    known = patterns.select("cp_str", F.array_sort("parts").alias("s"), merit.alias("merit"))
    pairs = (similar_pairs(known, "cp_str", "s", overlap)
             .join(known.select(F.col("s").alias("a"), F.col("merit").alias("am")), "a")
             .join(known.select(F.col("s").alias("b"), F.col("merit").alias("bm")), "b"))
    ahead = F.col("am") < F.col("bm")
    edges = cut(pairs.select(F.when(ahead, F.col("a")).otherwise(F.col("b")).alias("better"),
                             F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("worse")))
    gone = None
    while not edges.isEmpty():
        free = edges.select("better").distinct().join(edges.select(F.col("worse").alias("better")), "better", "left_anti")
        now = cut(edges.join(free, "better", "left_semi").select("worse").distinct())
        gone = now if gone is None else gone.union(now)
        edges = cut(edges.join(now, "worse", "left_anti")
                    .join(now.select(F.col("worse").alias("better")), "better", "left_anti"))
    if gone is None:
        return patterns
    worse = gone.select(F.col("worse").alias("gone"))
    return patterns.join(worse, F.array_sort("parts") == F.col("gone"), "left_anti")


# ---- score -------------------------------------------------------------------------------------

def pattern_scores(parts: DataFrame, features: DataFrame) -> DataFrame:
    """(pattern_id, pattr_score, cp_str) from one row per condition.

    ``parts``: pattern_id, place, checkpoint, variables; ``features``: checkpoint, variable,
    priority, cp_priority (configuration-sized).
    """
    weights = F.create_map(*[F.lit(x) for kv in PRIORITY_SCORE.items() for x in kv])
    atoms = (parts.select("pattern_id", "place", "checkpoint",
                          F.explode_outer("variables").alias("variable"))
             .join(features.select("checkpoint", "variable",
                                   weights[F.col("priority")].alias("atom_score")),
                   ["checkpoint", "variable"], "left"))
    by_checkpoint = features.groupBy("checkpoint").agg(
        weights[F.min("cp_priority")].alias("cp_score"))
    conditions = (atoms.groupBy("pattern_id", "place", "checkpoint")
                  .agg(F.coalesce(F.avg("atom_score"), F.lit(0.0)).alias("atom_score"))
                  .join(by_checkpoint, "checkpoint", "left"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "checkpoint"))),
                          lambda s: s.checkpoint)
    return conditions.groupBy("pattern_id").agg(
        F.sum(F.col("atom_score") + F.coalesce("cp_score", F.lit(0.0))).alias("pattr_score"),
        F.array_join(ordered, "-").alias("cp_str"))


def score_of(conditions: list[Condition], features: list[Feature]) -> float:
    """The same score for a pattern the driver already holds."""
    by_pair = {(f.checkpoint, f.variable): PRIORITY_SCORE[f.priority] for f in features}
    by_cp: dict[str, int] = {}
    for f in features:
        by_cp[f.checkpoint] = min(f.cp_priority, by_cp.get(f.checkpoint, f.cp_priority))
    total = 0.0
    for c in conditions:
        atoms = [by_pair[(c.checkpoint, a.variable)] for a in c.atoms]
        total += PRIORITY_SCORE[by_cp[c.checkpoint]] + (sum(atoms) / len(atoms) if atoms else 0.0)
    return round(total, 9)  # equal scores stay equal, in whatever order they were added up


# ---- tagging and ranking -------------------------------------------------------------------------

def tag_population(population: DataFrame, words: DataFrame,
                   patterns: dict[str, tuple[int, ...]]) -> DataFrame:
    """The population with one 0/1 column per pattern: one left join on the per-key words."""
    names = [c for c in words.columns if c != "key"]
    flags = [F.coalesce(holds_all([F.col(w) for w in names],
                                  [F.lit(v).cast("bigint") for v in literal(ids, len(names))])
                        .cast("int"), F.lit(0)).alias(name)
             for name, ids in patterns.items()]
    return (population.join(words, "key", "left")
            .select(*[population[c] for c in population.columns], *flags))


def outcome_value(metric: str) -> Column:
    value = F.col("amt") if metric == AMOUNT else F.lit(1.0)
    return F.when(F.col("tag") == 1, value).otherwise(F.lit(0.0))


def flag_vectors(tagged: DataFrame, names: list[str], metric: str) -> DataFrame:
    """Outcome caught by each distinct combination of flags."""
    return tagged.groupBy(*names).agg(
        F.coalesce(F.sum(outcome_value(metric)), F.lit(0.0)).alias("target_catch"))


def flag_vectors_by_key(population: DataFrame, words: DataFrame,
                        patterns: dict[str, tuple[int, ...]], metric: str) -> DataFrame:
    """The same without the tagged table: the population shrinks to its keys before the join."""
    per_key = population.groupBy("key").agg(F.sum(outcome_value(metric)).alias("_caught"))
    return tag_population(per_key, words, patterns).groupBy(*patterns).agg(
        F.coalesce(F.sum("_caught"), F.lit(0.0)).alias("target_catch"))


def incremental_catch(vectors: DataFrame, ranked: list[str], total: float) -> DataFrame:
    """(pattr_name, place, inc_catch, inc_catch_share): each vector counts for its first hit."""
    spark = vectors.sparkSession
    first = F.coalesce(*[F.when(F.col(n) == 1, F.lit(i)) for i, n in enumerate(ranked)])
    sums = (vectors.withColumn("place", first).where("place is not null")
            .groupBy("place").agg(F.sum("target_catch").alias("inc_catch")))
    names = local_table(spark, list(enumerate(ranked)), "place int, pattr_name string")
    return (names.join(sums, "place", "left").fillna(0.0, ["inc_catch"])
            .withColumn("inc_catch_share", F.col("inc_catch") / F.lit(float(total))))


def ranked(patterns: DataFrame, priority: str) -> DataFrame:
    """Add ``place`` by one of the named orders, name as tiebreak."""
    order = [F.col(c).desc() for c in RANKINGS[priority]]
    # one row per pattern: rule-sized
    return patterns.withColumn("place", F.row_number().over(
        W.orderBy(*order, F.col("pattr_name"))))


def rank_names(patterns: list[Pattern], priority: str) -> list[str]:
    """The same order for patterns the driver already holds."""
    return [p.name for p in sorted(patterns, key=lambda p: (
        *[-getattr(p, c) for c in RANKINGS[priority]], p.name))]


def dedup_names(vectors: DataFrame, names: list[str], total: float,
                cutoff: float) -> tuple[dict[str, tuple[float, float]], list[str]]:
    """Increments of all patterns in rank order, then again among those above the cutoff."""
    first = {r.pattr_name: (r.inc_catch, r.inc_catch_share)
             for r in incremental_catch(vectors, names, total).collect()}
    survivors = [n for n in names if first[n][1] > cutoff]
    if survivors:
        first.update({r.pattr_name: (r.inc_catch, r.inc_catch_share)
                      for r in incremental_catch(vectors, survivors, total).collect()})
    return first, survivors


def condition_catalog(patterns: list[Pattern]) -> list[Condition]:
    """Distinct conditions of the patterns, by text."""
    return [c for _, c in sorted({c.text: c for p in patterns for c in p.conditions}.items())]
