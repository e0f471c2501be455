"""Spark searches against plain loops over the same rows."""

import itertools
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lodeseam import mine
from lodeseam.config import VariableRules
from lodeseam.operators import combine, measure, shape
from lodeseam.operators.binning import Gate
from lodeseam.operators.trees import MaskTable, grow_trees, leaf_nodes, to_condition
from lodeseam.plans import mining
from lodeseam.plans.mining import checkpoint_kpis, qualified_conditions
from lodeseam.session import local_table
from tests.naive import Naive, supports
from workloads import fixtures as fx
from workloads import searching

RULES = VariableRules()
CASES = {
    "count": fx.F1,
    "amount": replace(fx.F1, eval_metric="target_amt"),
    "tight": replace(fx.F1, min_support=0.05, eval_cutoff=0.35, concentration_cutoff=0.15),
    "every value": replace(fx.F1, top_values=None),
}


@pytest.fixture(scope="module")
def inputs(spark, sf):
    population, activity = fx.cached(spark, sf)
    return (population, activity, [r.asDict() for r in population.collect()],
            [r.asDict() for r in activity.collect()])


def naive_of(inputs, params):
    return Naive(inputs[2], inputs[3], params, RULES, params.eval_metric == "target_amt")


def spark_conditions(inputs, params):
    population, activity = inputs[:2]
    gate = Gate.of(measure.thresholds(population, params).first(), params)
    supported = {r.checkpoint for r in checkpoint_kpis(activity, params.eval_metric).collect()
                 if r.target_catch >= gate.sup_n}
    found = qualified_conditions(activity, shape.outcome_activity(activity), fx.features(),
                                 supported, params, RULES, gate)
    return found, gate


@pytest.mark.parametrize("case", CASES)
def test_univariate_and_trees(inputs, case):
    params = CASES[case]
    naive = naive_of(inputs, params)
    expected = naive.univariate(fx.features())
    found, gate = spark_conditions(inputs, params)
    flat = {cp: {s.atom.text: (round(s.catch, 4), round(s.rate, 8)) for s in listed}
            for cp, listed in found.items()}
    assert flat == {cp: {t: (round(c, 4), round(q, 8)) for t, _, c, q, _ in listed}
                    for cp, listed in expected.items()}
    masks = MaskTable(inputs[1], found, params.eval_metric)
    roots = {r.checkpoint: (r.target_catch, r.target_rate)
             for r in checkpoint_kpis(inputs[1], params.eval_metric).collect()}
    nodes = leaf_nodes(grow_trees(masks, roots, gate.sup_n, naive.total))
    got = {to_condition(masks, n).text: round(n.catch, 4) for n in nodes}
    want = {chr(6).join([f'checkpoint="{cp}"', *leaf[0]]): round(leaf[2], 4)
            for cp, listed in expected.items() for leaf in naive.leaves(cp, listed)}
    assert got == want


@pytest.mark.parametrize("case", ["count", "amount", "every value"])
def test_whole_job(inputs, case):
    """Patterns, their measures, pruning and increments, rebuilt by loops from the candidates."""
    params = CASES[case]
    naive = naive_of(inputs, params)
    expected = naive.univariate(fx.features())
    candidates = [(cp, leaf[1], chr(6).join([f'checkpoint="{cp}"', *leaf[0]]))
                  for cp, listed in expected.items() for leaf in naive.leaves(cp, listed)]
    lists = list(naive.held([(cp, tests) for cp, tests, _ in candidates]).values())
    sets = {}
    for size in range(1, params.lvl_limit + 1):
        for s in itertools.combinations(range(len(candidates)), size):
            if len({candidates[i][0] for i in s}) == size:
                weight = supports(lists, [s])[s]
                if weight >= naive.sup:
                    sets[s] = weight
    met = {}
    for r in naive.rows:
        for i, (cp, tests, _) in enumerate(candidates):
            if r["checkpoint"] == cp and all(t(r) for t in tests):
                met.setdefault(r["key"], set()).add(i)
    figures = {s: naive.kpi([(p["tag"], p["amt"]) for p in naive.people
                             if set(s) <= met.get(p["key"], set())]) for s in sets}
    good = [s for s in sets if figures[s][1] >= params.eval_cutoff]
    minimal = {s for s in good if not any(len(b) > 1 and set(b) < set(s) for b in good)}

    found = mine(*inputs[:2], fx.features(), params, RULES, tiebreak=fx.TIEBREAK)
    assert found.found and found.mode == "itemsets"
    order = {c.text: i for i, c in enumerate(found.candidates)}
    assert set(order) == {text for _, _, text in candidates}
    place = {text: i for i, (_, _, text) in enumerate(candidates)}
    as_set = {p.name: tuple(sorted(place[c.text] for c in p.conditions)) for p in found.patterns}
    assert set(as_set.values()) <= minimal
    for p in found.patterns:
        catch, rate = figures[as_set[p.name]]
        assert p.target_catch == pytest.approx(catch) and p.target_rate == pytest.approx(rate)
    # every minimal set that was dropped resembles a better kept one of the same checkpoints
    kept = {as_set[p.name]: p for p in found.patterns}
    texts = {s: sorted(candidates[i][2] for i in s) for s in minimal}
    for s in minimal - set(kept):
        mine_parts = {x for t in texts[s] for x in t.split(chr(6))}
        rivals = [k for k in kept if [candidates[i][0] for i in sorted(k, key=lambda i: candidates[i][2])]
                  == [candidates[i][0] for i in sorted(s, key=lambda i: candidates[i][2])]]
        assert any(len(mine_parts & kept[k].parts) / len(mine_parts | kept[k].parts) > params.overlap
                   for k in rivals)
    # increments: first pass over all, second pass over the survivors
    def walk(names):
        seen, out = set(), {}
        for n in names:
            mine_keys = {k for k, items in met.items() if set(as_set[n]) <= items} - seen
            seen |= mine_keys
            out[n] = naive.kpi([(p["tag"], p["amt"]) for p in naive.people if p["key"] in mine_keys])[0]
        return out
    names = [p.name for p in found.patterns]
    first = walk(names)
    survivors = [n for n in names if first[n] / naive.total > params.dedup_cutoff]
    assert [p.name for p in found.ranked] == survivors
    second = walk(survivors)
    for p in found.patterns:
        assert p.inc_catch == pytest.approx(second.get(p.name, first[p.name]))
    tagged = found.tagged
    assert tagged.count() == len(naive.people)
    sums = tagged.agg(*[F.sum(n).alias(n) for n in names]).first()
    for n in names:
        assert sums[n] == sum(1 for p in naive.people if set(as_set[n]) <= met.get(p["key"], set()))
    found.release()


@pytest.mark.parametrize("name", ["mine_patterns", "pattern_result_rows", "mine_user_days"])
def test_whole_job_queries_look_at_every_value(spark, sf, monkeypatch, name):
    """All values that catch more than the gate are profiled, also those beyond the ten largest."""
    limits, profiled, profile_strings = [], [], mining.profile_strings

    def profile_and_note(*args):
        limits.append(args[4])
        profiled.append(profile_strings(*args))
        return profiled[-1]
    monkeypatch.setattr(mining, "profile_strings", profile_and_note)
    assert getattr(searching, name)(spark, sf).count() > 0
    assert limits == [None]
    if name != "mine_user_days":  # its variables are numbers
        assert max(map(len, profiled[0].values())) > 10


def test_worked_example(spark):
    # The transactions and supports of the worked example.
    rows = [([1, 2, 5], 100.0), ([2, 4], 49.57), ([2, 3], 134.38), ([1, 2, 4], 38.22),
            ([1, 3], 78.0), ([2, 3], 56.0), ([1, 3], 25.0), ([1, 2, 3, 5], 50.0),
            ([1, 2, 3], 35.0)]
    sets = combine.weighted_sets(local_table(spark, rows, "items array<int>, weight double"))
    found = combine.frequent_sets(sets, [f"c{i}" for i in range(6)], 100.0, 6)
    assert {k: round(v, 2) for k, v in found.items()} == {
        (1,): 326.22, (2,): 463.17, (3,): 378.38, (5,): 150.0, (1, 2): 223.22, (1, 3): 188.0,
        (1, 5): 150.0, (2, 3): 275.38, (2, 5): 150.0, (1, 2, 5): 150.0}


def test_walks(spark):
    """Greedy walks against loops, with candidates that share checkpoints."""
    cps = ["a", "a", "b", "b", "c", "d"]
    rows = [([0, 2, 4], 3.0), ([0, 2, 5], 2.0), ([1, 3, 4], 4.0), ([0, 3], 1.0), ([1, 2, 4, 5], 2.5),
            ([4, 5], 1.5), ([0, 1, 2, 3, 4, 5], 1.0)]
    sets = local_table(spark, rows, "items array<int>, weight double")
    sup_n, n = 2.0, len(cps)
    nodes, edges = combine.cooccurrence(combine.pair_support(sets, n), sup_n)
    pair = {(r.a, r.b): r.shared for r in edges.collect()}
    weight = supports(rows, [s for k in range(1, 5) for s in itertools.combinations(range(n), k)])
    assert pair == {p: weight[p] for p in itertools.combinations(range(n), 2) if weight[p] >= sup_n}
    sizes = {r["item"]: r["size"] for r in nodes.collect()}
    expected = {}
    for seed in range(n):
        walk, at = [seed], seed
        for _ in range(3):
            options = [(-weight[tuple(sorted((*walk, i)))], i) for i in range(n)
                       if i not in walk and tuple(sorted((at, i))) in pair
                       and cps[i] not in [cps[w] for w in walk]
                       and weight[tuple(sorted((*walk, i)))] > sup_n]
            if options:
                at = min(options)[1]
                walk.append(at)
        expected[tuple(sorted(walk))] = weight[tuple(sorted(walk))]
    assert combine.greedy_walks(sets, list(range(n)), sizes, edges, cps, sup_n, 4) == expected


def test_walk_mode_runs_whole(inputs):
    """The job walks when asked to; the wider search only adds sets."""
    params = replace(fx.F1, mode="walk")
    found = mine(*inputs[:2], fx.features(), params, RULES)
    wider = mine(*inputs[:2], fx.features(), replace(params, include_nodes_edges=True), RULES)
    assert found.mode == wider.mode == "walk" and wider.found
    for p in wider.patterns:
        flagged = measure.measure_pattern(*inputs[:2], p.conditions, "target_cnt")
        r = flagged.where("pattern_flag = 1").first()
        assert (p.target_catch, p.target_rate) == pytest.approx((r.target_cnt, r.target_cnt_rate))
    found.release()
    wider.release()


def test_nothing_is_left_out_when_there_is_much(spark):
    """Over 300 edges and keys that hold over ten candidates: all sets, and walks from all nodes."""
    n, rnd = 30, random.Random(1)
    lists = [tuple(sorted(rnd.sample(range(n), rnd.randint(11, 16)))) for _ in range(60)]
    rows = [(f"k{i}", f"a{i}", list(items), 1.0) for i, items in enumerate(lists)]
    df = spark.createDataFrame(rows, "key string, acct string, items array<int>, weight double")
    cps, params = [f"c{i}" for i in range(n)], replace(fx.F1, lvl_limit=3)
    weight = {s: sum(set(s) <= set(items) for items in lists)
              for k in (1, 2, 3) for s in itertools.combinations(range(n), k)}
    assert sum(len(s) == 2 and w >= 6 for s, w in weight.items()) > 300
    found = combine.combine(df, cps, 6.0, params)
    assert found.sets == {s: w for s, w in weight.items() if w >= 6}
    walked = combine.combine(df, cps, 6.0, replace(params, mode="walk"))
    assert walked.mode == "walk" and set().union(*walked.sets) == set(range(n))
    assert all(weight[s] == w for s, w in walked.sets.items())


def test_recency_cut(inputs):
    """When asked for, only the latest rows feed the profiles; measures stay whole."""
    params = replace(fx.F1, recent_rows=1)
    population, activity = inputs[:2]
    outcome = shape.profiled_outcome(activity, params.recent_rows, fx.TIEBREAK)
    rows = outcome.collect()
    every = {(r.key, r.checkpoint) for r in shape.outcome_activity(activity).collect()}
    assert len(rows) == len(every) and {(r.key, r.checkpoint) for r in rows} == every
    assert shape.profiled_outcome(activity, None).count() == shape.outcome_activity(activity).count()
    found = mine(population, activity, fx.features(), params, RULES, tiebreak=fx.TIEBREAK)
    assert found.was_cut
    for cp, listed in found.conditions.items():
        for s in listed[:2]:
            r = measure.measure_condition(activity, type(found.candidates[0])(cp, (s.atom,)),
                                          params.eval_metric).first()
            assert r.target_catch == s.catch
    found.release()


def test_mixed_tags_and_amounts_within_a_key(spark):
    """Roles that vary between the rows of a key: the maximum over the matching rows counts."""
    rows = [("k1", "a", 1, 5.0, "X", 1.0), ("k1", "a", 0, 9.0, "X", 2.0), ("k2", "b", None, 3.0, "X", 1.0),
            ("k2", "b", 0, None, "X", 2.0), ("k3", "c", 2, 7.0, "X", 1.0), ("k3", "c", 1, 8.0, "X", 2.0),
            ("k4", "d", 0, 4.0, "X", 1.0), ("k5", "e", 1, 6.0, "X", 3.0)]
    activity = local_table(spark, rows, "key string, acct string, tag int, amt double, "
                                        "checkpoint string, v double")
    dicts = [r.asDict() for r in activity.collect()]
    from lodeseam.config import Feature
    from lodeseam.operators.binning import CellTable, Plan
    for metric in ("target_cnt", "target_amt"):
        naive = Naive([], dicts, fx.F1, RULES, metric == "target_amt")
        plan = Plan(Feature("X", "v", "numeric", 1, 1), "both", cuts=(1.0, 2.0))
        cells = CellTable(activity, [plan], metric)
        tests = [frozenset(c) for k in (1, 2, 3) for c in itertools.combinations(range(3), k)]
        got = cells.measure([(0, t) for t in tests])
        for t, g in zip(tests, got):
            want = naive.measure("X", lambda r: (0 if r["v"] <= 1 else 1 if r["v"] <= 2 else 2) in t)
            assert g == pytest.approx(want)


def test_many_cells_span_words(spark):
    """More than 62 cells of one feature and more than 62 conditions of one checkpoint."""
    rows = [(f"k{i}", f"a{i}", i % 2, "X", float(i % 97)) for i in range(970)]
    activity = local_table(spark, rows, "key string, acct string, tag int, checkpoint string, v double")
    from lodeseam.conditions import Range
    from lodeseam.config import Feature
    from lodeseam.operators.binning import CellTable, Plan
    from lodeseam.operators.trees import Scored
    cuts = tuple(float(c) for c in range(90))
    cells = CellTable(activity, [Plan(Feature("X", "v", "numeric", 1, 1), "both", cuts=cuts)],
                      "target_cnt")
    whole, high = cells.measure([(0, frozenset(range(91))), (0, frozenset(range(70, 91)))])
    assert whole[0] == 485 and high[0] == sum(1 for r in rows if r[2] == 1 and r[4] > 69)
    listed = {"X": [Scored(Range("v", lo=c), 0.0, 0.0, 1) for c in cuts]}
    masks = MaskTable(activity, listed, "target_cnt")
    (got,) = masks.measure([("X", (3, 80))])
    assert got[0] == sum(1 for r in rows if r[2] == 1 and r[4] > 80)
