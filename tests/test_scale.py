"""Plan shapes and skew: what must hold for the jobs to survive large inputs."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeseam.conditions import Condition, Equals, Flag, InSet, Range
from lodeseam.config import Feature, VariableRules
from lodeseam.functions.bits import WORD
from lodeseam.operators import binning, combine, measure, profile, select, shape, signatures
from lodeseam.operators.binning import run_searches
from lodeseam.operators.trees import MaskTable, Scored, grow_trees
from lodeseam.plans import mining
from lodeseam.session import local_table, tuned
from workloads import fixtures as fx
from workloads import measuring, searching


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


NAMES = ["measure_conditions_batch", "measure_patterns_batch", "tag_population", "top_values_cnt",
         "concentration_amt", "quantile_cuts", "key_pattern_weights", "cooccurrence_edges",
         "minimal_sets", "flag_vector_rollup"]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join(spark, sf, name):
    import __spark_entry__ as entry
    plan = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf):
    rows = fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("key"), F.lit(1).alias("tag"),
        F.col("l_returnflag").alias("checkpoint"), F.col("l_quantity").alias("qty"))
    plan = plan_of(measure.measure_condition(rows, fx.C2, "target_cnt"))
    assert "EqualTo(l_returnflag,R)" in plan and "GreaterThan(l_quantity," in plan
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan


def test_recency_cut_ranks_before_the_shuffle(spark, sf):
    # straight from the scan: the fixture's joins may leave rows partitioned by key already
    rows = fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("key"), F.lit(1).alias("tag"),
        F.col("l_returnflag").alias("checkpoint"), F.col("l_shipdate").alias("timestamp"),
        F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part_no"))
    plan = plan_of(shape.recent_rows(shape.outcome_activity(rows), 2, fx.TIEBREAK))
    final, partial = plan.index("row_number(), 2, Final"), plan.index("row_number(), 2, Partial")
    assert final < plan.index("Exchange hashpartitioning(key") < partial


def test_top_values_rank_before_the_shuffle(spark, sf):
    outcome = shape.outcome_activity(fx.activity(spark, sf))
    sizes = profile.string_values(outcome, fx.features(), "target_cnt")
    plan = plan_of(profile.top_values(sizes, VariableRules()))
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_searches_read_signatures_and_not_keys(spark, sf):
    """After the fold, figures come from the counted signatures: no key, no shuffle but the one of the figures."""
    cells, gate = measuring.setup(spark, sf, ("both",))
    masks = searching.listed_masks(fx.cached(spark, sf)[1])
    for table, figures in ((cells, cells.kpis([(0, frozenset({0, 1}))])), (masks, masks.kpis([("R", (0, 1))]))):
        live = plan_of(figures).split("InMemoryTableScan")[0]
        assert live.count("Exchange hashpartitioning") == 1 and "hashpartitioning(test_id" in live
        assert "key" not in table.counts.columns
        table.release()


def test_searches_are_one_job_whatever_their_number(spark, sf):
    """No job per round: a task runs the search of a feature, or grows the tree of a checkpoint, to the end."""
    tracker = spark.sparkContext.statusTracker()
    cells, gate = measuring.setup(spark, sf)
    masks = searching.listed_masks(fx.cached(spark, sf)[1])
    roots = {cp: (1.0, 0.1) for cp in masks.conditions}
    for name, table, run in (("cells", cells, lambda: run_searches(cells, gate)),
                             ("masks", masks, lambda: grow_trees(masks, roots, 1.0, 100.0))):
        assert table.counts.count()
        spark.sparkContext.setJobGroup(name, name)
        assert any(run())
        assert len(tracker.getJobIdsForGroup(name)) <= 2
        spark.sparkContext.setJobGroup("", "")
        table.release()


def test_rounds_find_what_tasks_find(spark, sf, monkeypatch):
    """Groups over the bound of a task are searched in rounds, with the same results."""
    def found():
        cells, gate = measuring.setup(spark, sf)
        masks = searching.listed_masks(fx.cached(spark, sf)[1])
        out = run_searches(cells, gate), grow_trees(masks, {cp: (900.0, 0.2) for cp in masks.conditions}, 20.0, 2000.0)
        cells.release()
        masks.release()
        return out[0], [vars(n) for n in out[1]]
    whole = found()
    monkeypatch.setattr(signatures, "MAX_ROWS", 0)
    assert found() == whole and any(whole[0]) and len(whole[1]) > 3


def test_amounts_summed_in_another_order_keep_their_concentration(spark, sf):
    # a sum over rows that arrive in another order differs in the last digits
    noisy = F.udf(lambda x: x * (1 + random.random() * 1e-13), "double").asNondeterministic()
    outcome = shape.outcome_activity(fx.cached(spark, sf)[1])
    sizes = measuring.sizes_of(outcome, "target_amt")
    plain = {tuple(r[:2]): r[2] for r in profile.concentration(sizes, "target_amt").collect()}
    other = {tuple(r[:2]): r[2] for r in profile.concentration(
        sizes.withColumn("size", noisy("size")), "target_amt").collect()}
    assert plain and other == pytest.approx(plain, abs=1e-9)


@pytest.mark.parametrize("name", ["ignored_values", "top_values_cnt", "fixed_cuts"])
def test_profiles_of_the_outcome_do_not_store_the_activity(spark, sf, monkeypatch, name):
    def never(*args):
        raise AssertionError("the whole activity is stored")
    monkeypatch.setattr(fx, "cached", never)
    assert getattr(measuring, name)(spark, sf).count() > 0


def test_accounts_of_equal_hashes_are_told_apart(spark, monkeypatch):
    rows = [("c", "k1", "a1", 1, "both"), ("c", "k2", "a2", 1, "both"), ("c", "k3", "a1", 1, "one"), ("c", "k4", "a1", 1, "one")]
    outcome = local_table(spark, rows, "checkpoint string, key string, acct string, tag int, v string")
    features = [Feature("c", "v", "string", 1, 1)]
    for alike in (False, True):
        if alike:
            monkeypatch.setattr(profile, "account_hash", lambda acct: F.lit(7).cast("bigint"))
        strings = profile.string_values(outcome, features, "target_cnt")
        top = mining.profile_strings(strings, features, VariableRules(), None, None, 0.0, outcome)
        assert top == {("c", "v"): [("both", True), ("one", False)]}


def test_keys_of_one_row_are_counted_as_numbers(spark):
    rows = [(g, f"k{i}", i % 3, [i % 4 + 1, 8][:g + 1]) for i in range(60) for g in (0, 1)]
    table = local_table(spark, rows, "group int, key string, tag int, mask array<bigint>")
    lone = signatures.signatures(table, "target_cnt", 2)
    plain = signatures.signatures(table, "target_cnt")
    assert sorted(map(tuple, lone.collect())) == sorted(map(tuple, plain.collect()))
    assert all("mask" not in line.split("functions=")[0] and "rows" not in line.split("functions=")[0]
               for line in plan_of(lone).splitlines() if "Aggregate" in line)


def test_cells_are_folded_under_the_method_size_limit(spark, sf, monkeypatch):
    limits, fold = [], binning.sig.signatures

    def noted(rows, *args):
        limits.append(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
        return fold(rows, *args)
    monkeypatch.setattr(binning.sig, "signatures", noted)
    for name in ("qualified_conditions", "string_value_candidates"):
        assert getattr(measuring, name)(spark, sf).count() > 0
    assert limits == ["8000", "8000"]


def test_whole_jobs_hold_their_own_columns_in_key_order(spark, sf, monkeypatch):
    def never(*args):
        raise AssertionError("the whole activity is stored")
    masks = searching.listed_masks(fx.activity(spark, sf))
    masks.table.persist().count()
    with tuned(spark):
        counts = signatures.signatures(masks.table.withColumnRenamed("checkpoint", "group"), "target_cnt", 0, True, masks.names)
        assert counts.count() == len(counts.collect()) > 0
    masks.table.unpersist()
    final = plan_of(counts).split("InMemoryTableScan")[0]
    assert "SortAggregate" in final and "ObjectHashAggregate" not in final and "hashpartitioning(key" not in final
    monkeypatch.setattr(fx, "cached", never)
    assert searching.mine_patterns(spark, sf).count() > 0
    assert searching.refine_round(spark, sf).count() > 0
    assert searching.condition_catalog(spark, sf).count() > 0


def test_item_lists_are_gathered_as_bits(spark, sf):
    plan = plan_of(searching.lists_of(spark, sf))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    hits = local_table(spark, [(i, "k", "a", 1) for i in (70, 3, 61, 62, 3)] + [(5, "k", "b", 1), (6, "k", "b", 0)],
                       "test_id int, key string, acct string, tag int")
    lists = combine.item_lists(hits, "target_cnt", 0.01, 71).collect()
    assert sorted((r.acct, r["items"], r.weight) for r in lists) == [("a", [3, 61, 62, 70], 1.0), ("b", [5], 1.0)]


def test_running_count_in_splits(spark):
    """The split path and the one-task path agree, ties and skew included."""
    rows = [("a", "v", float(i * i % 1013), 1 + i % 7) for i in range(3000)]
    rows += [("b", "v", 1.0, 5), ("c", "v", -3.5, 1), ("c", "v", 2.0, 900)]
    counts = local_table(spark, rows, "checkpoint string, variable string, value double, n bigint")
    counts = counts.groupBy("checkpoint", "variable", "value").agg(F.sum("n").alias("n")).persist()
    a = profile.running_count(counts, profile.PAIR, "value", "n")
    b = profile.earlier(counts, profile.PAIR, "value", "n", "before")
    columns = ["checkpoint", "value", "before"]
    assert sorted(map(tuple, a.select(columns).collect())) == sorted(
        map(tuple, b.select(columns).collect()))
    steps = profile.quantile_steps(0.05)
    wide = profile.quantiles(counts, steps, one_task=1).orderBy("checkpoint").collect()
    narrow = profile.quantiles(counts, steps).orderBy("checkpoint").collect()
    assert [r.quantiles for r in wide] == [pytest.approx(r.quantiles) for r in narrow]
    counts.unpersist()


def test_busy_key(spark):
    """A third of the rows on one key: figures stay right and the key folds to a few rows."""
    n = 30_000
    activity = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.lit("a").alias("acct"), (F.col("id") % 3 == 0).cast("int").alias("tag"),
        F.lit("X").alias("checkpoint"), (F.col("id") % 50).cast("double").alias("v"))
    low, high = Range("v", hi=10), Range("v", lo=40)
    listed = {"X": [Scored(low, 0.0, 0.0, 1), Scored(high, 0.0, 0.0, 1)]}
    masks = MaskTable(activity, listed, "target_cnt")
    assert masks.table.where("key = 'hot'").count() == 2
    assert [m[0] for m in masks.measure([("X", (0,)), ("X", (1,)), ("X", (0, 1))])] == [1.0, 1.0, 0.0]
    got = measure.measure_conditions(activity, [Condition("X", (low,))], "target_cnt").first()
    assert got.target_catch == 1.0
    population = activity.select("key", "acct", "tag")
    words = measure.key_words(activity, [Condition("X", (low,)), Condition("X", (high,))])
    figures = measure.measure_patterns(population, words, [(0, 1)], "target_cnt").first()
    assert figures.target_cnt == n / 3 and figures.firing_cnt == n / 3
    vectors = select.flag_vectors_by_key(population, words, {"p": (0, 1)}, "target_cnt")
    assert {r.p: r.target_catch for r in vectors.collect()} == {0: 0.0, 1: n / 3}


def test_supports_do_not_depend_on_partitions(spark):
    rows = [([i % 5, 5 + i % 3], float(i)) for i in range(200)]
    sets = local_table(spark, rows, "items array<int>, weight double")
    one = combine.frequent_sets(sets.coalesce(1), [str(i) for i in range(8)], 1.0, 2)
    assert one == combine.frequent_sets(sets.repartition(16), [str(i) for i in range(8)], 1.0, 2)


def test_ten_thousand_candidates(spark):
    """Supports of many candidates: bitmaps per block of rows, a bounded table of sums, no array of all pairs."""
    n, rng = 10_000, np.random.default_rng(4)
    rows = [(sorted(set(rng.integers(0, n, 6).tolist()) | {int(rng.integers(0, 40))}), float(rng.integers(1, 5))) for _ in range(6_000)]
    sets = local_table(spark, rows, "items array<int>, weight double").repartition(4)
    checkpoints = [f"c{i % 7}" for i in range(n)]
    expected = Counter()
    for items, weight in rows:
        for k in (1, 2):
            for s in itertools.combinations(items, k):
                if len({checkpoints[i] for i in s}) == k:
                    expected[s] += weight
    assert combine.frequent_sets(sets, checkpoints, 9.0, 2) == {s: w for s, w in expected.items() if w >= 9.0}


def test_sums_are_handed_on_in_parts(spark, monkeypatch):
    rows = [([i % 5, 5 + i % 3, 9], float(i)) for i in range(500)]
    sets = local_table(spark, rows, "items array<int>, weight double")
    whole = combine.pair_support(sets, 10).orderBy("a", "b").collect()
    for name in ("MAX_SUMS", "BLOCK_ROWS", "BLOCK_PREFIXES"):
        monkeypatch.setattr(combine, name, 3)
    assert combine.pair_support(sets, 10).orderBy("a", "b").collect() == whole


def test_components_are_one_job_without_checkpoints(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 3_000, (2_400, 2)) if a != b]
    nodes = local_table(spark, [(i, 1.0) for i in range(3_000)], "item int, size double")
    got = combine.components(nodes, local_table(spark, edges, "a int, b int").repartition(16))
    assert "Scan ExistingRDD" not in plan_of(got)  # what a checkpoint would leave
    parent = list(range(3_000))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    assert {r["item"]: r.component for r in got.collect()} == {i: root(i) for i in range(3_000)}


def test_conditions_are_looked_up_per_variable(spark):
    """The index meets exactly the conditions that their columns meet, nulls and borders included."""
    rows = [(f"k{i}", cp, i % 3, x, t, f) for i, (cp, x, t, f) in enumerate(itertools.product(
        ("X", "Y", "Z", None), (None, -1.0, 0.0, 1.0, 1.5, 2.0, 9.0, float("inf")), (None, "", "a", "a'b\\", "zz", "é"), (None, True, False)))]
    df = local_table(spark, rows, "key string, checkpoint string, tag int, x double, t string, f boolean")
    atoms = [Range("x", 0.0, 2.0), Range("x", lo=1.0), Range("x", hi=1.5), Equals("x", 1.0), Equals("x", "None"), InSet("t", ("a", "é")),
             InSet("t", ("a'b\\",)), Equals("t", "None"), Equals("t", ""), Flag("f"), Flag("f", False)]
    conditions = [Condition(cp, c) for cp in ("X", "Y") for k in (0, 1, 2) for c in itertools.combinations(atoms, k)]
    met = measure.condition_words(df, conditions, ["key"]).collect()
    words = {r.key: r["mask"] for r in met}
    got = {(k, w * WORD + b) for k, mask in words.items() for w, word in enumerate(mask) for b in range(WORD) if word >> b & 1}
    ids = df.select("key", F.explode(measure.matching_ids(conditions)).alias("i")).collect()
    assert got == {(r.key, r.i) for r in ids} and len(got) > 2_000
    plan = plan_of(measure.condition_words(spark.range(1).selectExpr("'k' as key", "'X' as checkpoint", "1D as x"), [Condition("X", (atoms[0],))], ["key"]))
    assert "Generate" not in plan
