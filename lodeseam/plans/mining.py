"""The mining job: from two tables to ranked, de-duplicated patterns and a tagged population.

The activity is scanned for the checkpoint figures, the cell table and the mask table; the
value profiles read the outcome rows only, which are cached. Everything after the mask table works
on folded tables that are partitioned by key.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..conditions import Condition, pattern_text
from ..config import COUNT, Feature, SearchParams, VariableRules
from ..functions.metrics import Registry, kpi_columns
from ..operators import profile, select, shape
from ..operators.binning import CellTable, Gate, make_plans, run_searches
from ..operators.combine import combine, item_lists
from ..operators.measure import kpi_by_test, measure_patterns, roles_of, thresholds
from ..operators.trees import MaskTable, Node, Scored, grow_trees, leaf_nodes, to_condition
from ..session import local_table, small_table, tuned


#: Columns of the activity that every search reads besides the configured features.
MINING_ROLES = ("key", "acct", "tag", "checkpoint")


@dataclass
class MiningResult:
    """Rule-sized results and two lazy tables; call :meth:`release` when they are written."""

    found: bool
    patterns: list[select.Pattern] = field(default_factory=list)
    conditions: dict[str, list[Scored]] = field(default_factory=dict)
    candidates: list[Condition] = field(default_factory=list)
    stages: list[tuple[str, str, float, float | None]] = field(default_factory=list)
    mode: str = ""
    was_cut: bool = False
    tagged: DataFrame | None = None
    condition_catalog: DataFrame | None = None
    cached: list[DataFrame] = field(default_factory=list)

    @property
    def ranked(self) -> list[select.Pattern]:
        return [p for p in self.patterns if p.after_dedup]

    def note(self, stage: str, rows: Iterable[tuple[list[Condition], float, float | None]]) -> None:
        """Keep what a stage came to: the text of each set of conditions, catch (or support) and rate."""
        self.stages += [(stage, pattern_text(conditions), catch, rate) for conditions, catch, rate in rows]

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()
        self.cached.clear()


def checkpoint_kpis(activity: DataFrame, metric: str) -> DataFrame:
    """(checkpoint, outcome_rows, catch, rate) over the keys active at each checkpoint."""
    roles = [F.max(c).alias(c) for c in roles_of(activity, metric)]
    return (activity.groupBy("key", "checkpoint")
            .agg(F.count_if(F.col("tag") == 1).alias("_rows"), *roles)
            .groupBy("checkpoint").agg(F.sum("_rows").alias("outcome_rows"), *kpi_columns(metric)))


def eligible_features(sizes: DataFrame, features: list[Feature],
                      params: SearchParams) -> list[Feature]:
    """Features whose values are concentrated enough."""
    index = {(r.checkpoint, r.variable): r.concentration
             for r in profile.concentration(sizes, params.eval_metric).collect()}
    return [f for f in features
            if index.get((f.checkpoint, f.variable), -1.0) >= params.concentration_cutoff]


def profile_strings(strings: DataFrame, features: list[Feature],
                    rules: VariableRules, exclusions: DataFrame | None,
                    k: int | None = None, over: float | None = None,
                    outcome: DataFrame | None = None) -> dict[tuple[str, str], list]:
    """Values of each string feature as (value, used by several accounts), the largest first.

    A value that does not catch more than ``over`` by itself cannot enter a bin. Where all accounts of a value have one hash, which
    as a rule is one account, those of ``outcome`` are counted, in a pass that only such values cause.
    """
    wanted = [f for f in features if f.type == "string"]
    if not wanted:
        return {}
    best = shape.not_excluded(profile.top_values(strings, rules, k, over), exclusions)
    top: dict[tuple[str, str], list] = {}
    pairs = {(f.checkpoint, f.variable) for f in wanted}
    listed = [r for r in best.collect() if (r.checkpoint, r.variable) in pairs]
    alike = [(r.checkpoint, r.variable, r.value) for r in listed if not r.several and r.n > 1]
    several = set()
    if alike and outcome is not None:
        doubtful = small_table(outcome.sparkSession, alike, "checkpoint string, variable string, value string")
        counts = profile.account_counts(doubtful, outcome, wanted).where("n_acct > 1").collect()
        several = {(r.checkpoint, r.variable, r.value) for r in counts}
    for r in sorted(listed, key=lambda r: (r.checkpoint, r.variable, r.rank)):
        here = r.several or (r.checkpoint, r.variable, r.value) in several
        top.setdefault((r.checkpoint, r.variable), []).append((r.value, here))
    return top


def profile_numbers(numbers: DataFrame, features: list[Feature], params: SearchParams,
                    rules: VariableRules) -> tuple[dict, dict]:
    """Cuts of each numeric feature, and the values of those with very few."""
    if not any(f.type == "numeric" for f in features):
        return {}, {}
    summary = profile.quantiles(numbers, profile.quantile_steps(params.min_support))
    rows = profile.cuts_by_pair(summary, rules).collect()
    cuts = {(r.checkpoint, r.variable): tuple(r.cuts) for r in rows}
    few = [(r.checkpoint, r.variable) for r in rows if r.n_values <= params.discrete_max]
    discrete: dict[tuple[str, str], tuple] = {}
    if few:
        pair = F.struct("checkpoint", "variable")
        wanted = [F.struct(F.lit(c), F.lit(v)) for c, v in few]
        for r in sorted(numbers.where(pair.isin(*wanted)).collect(), key=lambda r: r.value):
            at = (r.checkpoint, r.variable)
            discrete[at] = (*discrete.get(at, ()), r.value)
    return cuts, discrete


def qualified_conditions(activity: DataFrame, outcome: DataFrame, features: list[Feature],
                         supported: set[str], params: SearchParams, rules: VariableRules,
                         gate: Gate, exclusions: DataFrame | None = None
                         ) -> dict[str, list[Scored]]:
    """Univariate search over all features of the supported checkpoints."""
    metric = params.eval_metric
    features = [f for f in features if f.checkpoint in supported]
    if not features:
        return {}
    strings = profile.string_values(outcome, features, metric).persist()
    numbers = profile.number_values(outcome, features, metric).persist()
    sizes = [df.select("checkpoint", "variable", "size") for df in (strings, numbers)]
    features = eligible_features(sizes[0].unionByName(sizes[1]), features, params)
    top = profile_strings(strings, features, rules, exclusions, params.top_values,
                          gate.min_block, outcome)
    cuts, discrete = profile_numbers(numbers, features, params, rules)
    strings.unpersist()
    numbers.unpersist()
    excluded = set() if exclusions is None else {
        (r.checkpoint, r.variable) for r in exclusions.select("checkpoint", "variable").collect()}
    plans = make_plans(features, top, cuts, discrete, excluded, rules)
    if not plans:
        return {}
    cells = CellTable(activity, plans, params.eval_metric)
    found = run_searches(cells, gate)
    cells.release()
    out: dict[str, list[Scored]] = {}
    for plan, atoms in zip(plans, found):
        for atom, catch, rate in atoms:
            out.setdefault(plan.feature.checkpoint, []).append(
                Scored(atom, catch, rate, plan.feature.priority))
    return out


def qualify(spark: SparkSession, sets: list[tuple[int, ...]], measured: list, candidates: list[Condition],
            features: list[Feature], params: SearchParams) -> list[select.Pattern]:
    """Patterns with enough rate, without supersets of smaller ones and without look-alikes."""
    metric = params.eval_metric
    good = [(i, list(s)) for i, (s, m) in enumerate(zip(sets, measured)) if m[f"{metric}_rate"] >= params.eval_cutoff]
    if not good:
        return []
    listed = local_table(spark, good, "set_id int, items array<int>").withColumn("qualified", F.lit(True))
    minimal = [sets[r.set_id] for r in select.minimal_sets(listed).select("set_id").collect()]
    named = sorted(((sorted((candidates[i] for i in s), key=lambda c: c.text), s) for s in minimal),
                   key=lambda pair: (len(pair[1]), [c.text for c in pair[0]]))
    figures = dict(zip(sets, measured))
    patterns, seen = [], {}
    for conditions, s in named:
        number = seen.get(len(s), 0)
        seen[len(s)] = number + 1
        m = figures[s].asDict()
        patterns.append(select.Pattern(
            f"pattr_lvl{len(s)}_{number}", conditions, s, m[metric], m[f"{metric}_rate"],
            m["pattr_fscore"], select.score_of(conditions, features),
            {k: v for k, v in m.items() if k not in ("pattern_id", "pattr_fscore")}))
    rows = [(p.name, p.cp_str, sorted(p.parts), p.target_rate, p.pattr_score, p.content) for p in patterns]
    kept = {r.name for r in select.drop_similar(local_table(
        spark, rows, "name string, cp_str string, parts array<string>, target_rate double, pattr_score double, content string"),
        params.overlap).select("name").collect()}
    return [p for p in patterns if p.name in kept]


def mine(population: DataFrame, activity: DataFrame, features: list[Feature],
         params: SearchParams = SearchParams(), rules: VariableRules = VariableRules(),
         exclusions: DataFrame | None = None, registry: Registry | None = None,
         tiebreak: tuple[str, ...] = ()) -> MiningResult:
    """Run the whole search on tables read by :mod:`lodeseam.sources.tables`."""
    metric = params.eval_metric
    if metric != COUNT and "amt" not in population.columns:
        raise ValueError("an amount role is needed to search by amount")
    with tuned(population.sparkSession):
        return _search(population, activity, features, params, rules, exclusions, registry, tiebreak)


def _search(population: DataFrame, activity: DataFrame, features: list[Feature], params: SearchParams,
            rules: VariableRules, exclusions: DataFrame | None, registry: Registry | None,
            tiebreak: tuple[str, ...]) -> MiningResult:
    metric = params.eval_metric
    features = [f for f in features if f.variable in activity.columns]
    used = {f.variable for f in features}
    wanted = {*MINING_ROLES, *used, *roles_of(activity, metric), *((*tiebreak, "timestamp") if params.recent_rows is not None else ())}
    activity = activity.select(*[f"`{c}`" for c in activity.columns if c in wanted])
    activity = shape.typed(activity, {f.variable: f.type for f in features}, params.strip_quotes)
    # read four times: only what the search needs, in the order of the keys that it is folded to
    activity = activity.sortWithinPartitions("key", "checkpoint", *roles_of(activity, metric)).persist()
    result = MiningResult(False)
    result.cached.append(activity)
    kpis = {r.checkpoint: r for r in checkpoint_kpis(activity, metric).collect()}
    size = sum(r.outcome_rows for r in kpis.values())
    if size == 0:
        return _done(result)
    limits = thresholds(population, params).first()
    gate = Gate.of(limits, params)
    supported = {cp for cp, r in kpis.items() if r.target_catch >= gate.sup_n}
    outcome = shape.profiled_outcome(activity, params.recent_rows, tiebreak)
    if params.recent_rows is not None:  # otherwise a filter of the table that is held
        result.cached.append(outcome.persist())
    result.conditions = qualified_conditions(activity, outcome, features, supported, params,
                                             rules, gate, exclusions)
    result.note("condition", (([Condition(cp, (c.atom,))], c.catch, c.rate)
                              for cp, listed in result.conditions.items() for c in listed))
    if not result.conditions:
        return _done(result)
    masks = MaskTable(activity, result.conditions, metric)
    result.cached.append(masks.table.persist())
    roots = {cp: (kpis[cp].target_catch, kpis[cp].target_rate) for cp in result.conditions}
    leaves = leaf_nodes(grow_trees(masks, roots, gate.sup_n, limits.total_catch))
    masks.release()
    result.candidates = [to_condition(masks, n) for n in leaves]
    result.note("leaf", (([c], n.catch, n.rate) for c, n in zip(result.candidates, leaves)))
    if not leaves:
        return _done(result)
    tests = [(n.checkpoint, n.atoms) for n in leaves]
    result.was_cut = params.recent_rows is not None
    source = MaskTable(outcome, result.conditions, metric) if result.was_cut else masks
    lists = item_lists(source.hits(tests), metric, params.weight_floor, len(tests)).persist()
    combined = combine(lists, [n.checkpoint for n in leaves], gate.sup_n, params)
    lists.unpersist()
    result.mode = combined.mode
    sets = sorted(s for s in combined.sets if len(s) <= params.lvl_limit)
    result.note("set", (([result.candidates[i] for i in s], combined.sets[s], None) for s in sets))
    if not sets:
        return _done(result)
    words = masks.key_words(tests).persist()
    result.cached.append(words)
    measured = sorted(measure_patterns(population, words, sets, metric, registry).collect(), key=lambda m: m.pattern_id)
    result.note("measured", (([result.candidates[i] for i in s], m[metric], m[f"{metric}_rate"]) for s, m in zip(sets, measured)))
    result.patterns = qualify(population.sparkSession, sets, measured, result.candidates, features, params)
    result.note("kept", ((p.conditions, p.target_catch, p.target_rate) for p in result.patterns))
    if not result.patterns:
        return _done(result)
    return _rank_and_tag(result, population, masks, words, leaves, limits.total_catch, params)


def _rank_and_tag(result: MiningResult, population: DataFrame, masks: MaskTable,
                  words: DataFrame, leaves: list[Node], total: float,
                  params: SearchParams) -> MiningResult:
    patterns, metric = result.patterns, params.eval_metric
    order = select.rank_names(patterns, params.rank_priority)
    flags = {p.name: p.items for p in patterns}
    result.tagged = select.tag_population(population, words, flags)
    vectors = select.flag_vectors_by_key(population, words, flags, metric).persist()
    gains, survivors = select.dedup_names(vectors, order, total, params.dedup_cutoff)
    vectors.unpersist()
    for p in patterns:
        p.inc_catch, p.inc_catch_share = gains[p.name]
        p.after_dedup = p.name in survivors
    patterns.sort(key=lambda p: order.index(p.name))
    result.note("ranked", ((p.conditions, p.inc_catch, p.inc_catch_share) for p in result.ranked))
    used = sorted({i for p in patterns for i in p.items}, key=lambda i: result.candidates[i].text)
    names = local_table(masks.table.sparkSession,
                        [(n, result.candidates[i].text) for n, i in enumerate(used)],
                        "test_id int, content string")
    hits = masks.hits([(leaves[i].checkpoint, leaves[i].atoms) for i in used])
    result.condition_catalog = names.join(kpi_by_test(hits, metric), "test_id")
    result.found = True
    return result


def _done(result: MiningResult) -> MiningResult:
    result.release()
    return result
