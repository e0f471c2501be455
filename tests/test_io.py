"""Readers, result tables, retention, configuration and the whole job on tables."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lodeseam.config import FIXED_CUTS, Roles, SearchParams, VariableRules
from lodeseam.functions.metrics import METRICS, Registry, f_beta
from lodeseam.operators import assets, combine, measure, shape
from lodeseam.operators.select import Pattern
from lodeseam.plans.job import Job, run
from lodeseam.session import local_table, shared_dir
from lodeseam.sources import results, tables
from workloads import fixtures as fx

CONFIG = """variable name,type,checkpoint,key_type,key_value,priority,cp_priority
qty,numeric,R,sender/receiver,,1,1
tax_pct,numeric,A,sender,sender,2,1
line_open,bool,A,sender,sender,1,1
p_type,string,N,sender,sender,1,2
empty_var,string,N,sender,sender,3,2
lot,numeric,N,sender,sender,3,2
"""


@pytest.fixture()
def config_path(tmp_path):
    path = tmp_path / "features.csv"
    path.write_text(CONFIG)
    return str(path)


def test_feature_config(spark, config_path):
    config = tables.read_feature_config(spark, config_path)
    assert config.count() == 6
    roles = shape.explode_roles(config)
    assert roles.where("`variable name` = 'qty'").count() == 2
    features = shape.collect_features(shape.expand_config(config, "single", ["lot"], ["empty_var"]))
    assert [(f.checkpoint, f.variable) for f in features] == [
        ("A", "line_open"), ("A", "tax_pct"), ("N", "p_type"), ("R", "qty")]
    dual = shape.collect_features(shape.expand_config(config, "dual"))
    assert {f.checkpoint for f in dual} == {"A_send@sndr", "N_send@sndr", "R_send@sndr",
                                            "R_recv@sndr"}
    copies = shape.single_scope(local_table(
        spark, [("DisputeLifecycleInitiation",), ("Other",)], "checkpoint string"))
    assert sorted(r.checkpoint for r in copies.collect()) == [
        "DisputeLifecycleInitiation", "DisputeLifecycleInitiation_recv",
        "DisputeLifecycleInitiation_send", "Other"]


def test_rules_and_registry(spark, tmp_path):
    rules = tmp_path / "rules.json"
    rules.write_text(json.dumps({"string": {"ignore_values": ["X"]},
                                 "number": {"direction_setting": {"up": "risk"}}}))
    read = tables.read_variable_rules(spark, str(rules))
    assert read.ignore_values == ("X",) and read.up_names == "risk"
    assert read.fixed_cuts == FIXED_CUTS and read.down_names == VariableRules().down_names
    metrics = tmp_path / "metrics.json"
    metrics.write_text(json.dumps({
        "sums": {"big_cnt": {"roles": ["amt"], "row": "if(amt > 100, 1, 0)"}},
        "metrics": {"big_share": "big_cnt / (firing_cnt + {eps})"}}))
    registry = Registry.load(spark, str(metrics))
    people = local_table(spark, [("a", 1, 50.0), ("b", 0, 150.0), ("c", None, 300.0)],
                         "key string, tag int, amt double")
    out = measure.metrics_by_group(people.withColumn("g", F.lit(1)), "g", "target_cnt", registry)
    row = out.first()
    assert row.big_share == pytest.approx(2 / 3.0001) and row.target_cnt_rate == pytest.approx(1 / 2.0001)
    # metrics whose roles are missing are left out
    assert "gloss" not in out.columns and "nloss_catch_rate" not in out.columns
    assert set(Registry.default().for_roles(["key", "tag"]).metrics) == {
        m for m in METRICS if m in ("firing_cnt", "target_cnt", "target_cnt_rate",
                                    "target_cnt_catch_rate")}


def test_parameters():
    for bad in ({"eval_metric": "x"}, {"search_scope": "both"}, {"rank_priority": "size"}):
        with pytest.raises(ValueError):
            SearchParams(**bad)
    assert SearchParams().with_lift_rules().lift == 1.3
    assert f_beta(0.5, 0.5) == 0.5 and f_beta(0.0, 1.0) == 0.0


def test_ingest(spark):
    raw = spark.sql("select 7 as id, 'u' as who, cast(1 as bigint) as bad, "
                    "cast(1.5 as decimal(10,2)) as amount, cast(2.25 as decimal(8,2)) as other")
    df = tables.ingest(raw, Roles(key="id", acct="who", tag="bad", amt="amount"), "id > 1")
    assert dict(df.dtypes) == {"key": "string", "acct": "string", "tag": "int", "amt": "double",
                               "other": "double"}
    assert df.first().asDict() == {"key": "7", "acct": "u", "tag": 1, "amt": 1.5, "other": 2.25}


def test_null_columns_and_modes(spark):
    df = local_table(spark, [("a", None, 1), ("b", None, None)], "x string, y string, z int")
    assert shape.null_columns(df) == ["y"] and shape.drop_null_columns(df).columns == ["x", "z"]
    params = SearchParams()
    assert combine.choose_mode(params) == "itemsets"
    assert combine.choose_mode(SearchParams(mode="walk")) == "walk"
    sets = {(0,): 5.0, (1,): 7.0, (0, 1): 5.0}
    assert combine.cap_sets(sets, 2) == ({(1,): 7.0, (0,): 5.0}, True)
    assert combine.cap_sets(sets, None) == (sets, False)
    kept = combine.distinct_checkpoint_sets(
        {(0, 1): 1.0, (0, 2): 1.0, (0, 1, 2): 1.0, (2, 3): 1.0}, ["Login", "RiskLiteLogin", "X", "X"])
    assert set(kept) == {(0, 2), (0, 1, 2)}


def test_weighted_seeds(spark):
    """More nodes than the limit: a fixed number of distinct nodes, the same on every run."""
    labels = local_table(spark, [(i, 0) for i in range(40)], "item int, component int")
    edges = local_table(spark, [(0, i) for i in range(1, 40)], "a int, b int")
    first = [r["item"] for r in combine.walk_seeds(labels, edges, 10).collect()]
    again = [r["item"] for r in combine.walk_seeds(labels.repartition(5), edges, 10).collect()]
    assert len(set(first)) == 10 and sorted(first) == sorted(again)
    assert 0 in first
    assert combine.walk_seeds(labels, edges).count() == 40


def test_components_need_several_rounds(spark):
    nodes = local_table(spark, [(i, 1.0) for i in range(9)], "item int, size double")
    edges = local_table(spark, [(0, 5), (1, 5), (1, 6), (2, 6), (2, 7), (3, 8)], "a int, b int")
    got = {r["item"]: r.component for r in combine.components(nodes, edges).collect()}
    assert got == {0: 0, 5: 0, 1: 0, 6: 0, 2: 0, 7: 0, 3: 3, 8: 3, 4: 4}
    assert shared_dir(spark)


def a_pattern(**changes):
    base = dict(name="p", conditions=[fx.C1, fx.C2], items=(0, 1), target_catch=3.14159,
                target_rate=0.987654, pattr_fscore=0.5, pattr_score=1.0,
                metrics={"nloss": 1.23456}, inc_catch=2.0, inc_catch_share=0.1, after_dedup=True)
    return Pattern(**{**base, **changes})


def test_result_tables(spark):
    ids, other = {"job_id": "j'1"}, {"job_id": "j2"}
    for kind in results.KINDS:
        results.ensure_table(spark, f"t_{kind}", kind)
        results.ensure_table(spark, f"t_{kind}", kind)
        keys, columns = results.KINDS[kind]
        assert len(spark.table(f"t_{kind}").columns) == len(keys) + len(columns.split(","))
    rows = results.pattern_rows(spark, [a_pattern(), a_pattern(name="q")])
    for run_ids in (ids, other, ids):
        results.write_run(rows, "t_service_result", "service_result", run_ids)
    written = spark.table("t_service_result")
    assert {r.job_id: r["count"] for r in written.groupBy("job_id").count().collect()} == {
        "j'1": 2, "j2": 2}
    r = written.where("job_id = 'j2' and pattr_name = 'p'").first()
    assert (r.target_rate, r.target_catch) == (0.9877, 3.1416) and r.after_dedup
    assert json.loads(r.other_metrics) == {"nloss": 1.2346}
    assert r.pattr_id.startswith("pattr_") and len(r.pattr_id) == 38
    assert r.update_dt == date.today() or isinstance(r.update_dt, date)
    results.clear_run(spark, "t_service_result", "service_result", ids)
    assert written.sparkSession.table("t_service_result").count() == 2
    batch = {"batch_id": "b", "alert_id": "a"}
    log = results.job_row(spark, "tags", 14, date(2024, 1, 25))
    results.write_run(log, "t_fp_log", "fp_log", batch)
    results.write_run(log, "t_fp_log", "fp_log", batch)
    (entry,) = spark.table("t_fp_log").collect()
    assert json.loads(entry.content) == {"pattr_table_name": "tags", "create_dt": "2024-01-25",
                                         "retire_dt": "2024-02-08"}
    with pytest.raises(ValueError):
        results.clear_run(spark, "t_fp_log", "fp_log", ids)


def test_retention(spark):
    results.write_tagged(local_table(spark, [("k", 1)], "key string, p int"), "tags_r", 3)
    assert not results.drop_if_expired(spark, "tags_r")
    assert results.drop_if_expired(spark, "tags_r", datetime.now() + timedelta(days=5))
    assert not spark.catalog.tableExists("tags_r")
    assert not results.drop_if_expired(spark, "tags_r")


def test_runs_never_share_tags():
    ids = [{"batch_id": "a_b", "alert_id": "c"}, {"batch_id": "a", "alert_id": "b_c"}, {"job_id": "x-y"},
           {"job_id": "x_2d_y"}, {"job_id": "A"}, {"job_id": "a"}]
    assert len({Job("p", "a", "c", i).tags().lower() for i in ids}) == len(ids)


def test_sweep_drops_retired_tags_of_other_runs(spark):
    for run_id, day in (("old", date(2024, 1, 1)), ("new", date(2024, 1, 20)), ("again", date(2024, 1, 1)), ("again", date(2024, 1, 20))):
        results.write_tagged(local_table(spark, [("k", 1)], "key string, p int"), f"swept_{run_id}")
        results.write_run(results.job_row(spark, f"swept_{run_id}", 14, day), "swept_log", "service_log", {"job_id": run_id})
    results.write_run(results.job_row(spark, "elsewhere", 14, date(2024, 1, 1)), "swept_log", "service_log", {"job_id": "x"})
    assert results.sweep(spark, "swept_log", "swept", date(2024, 1, 14)) == []
    assert results.sweep(spark, "swept_log", "swept", date(2024, 1, 15)) == ["swept_old"]
    assert results.sweep(spark, "swept_log", "swept", date(2024, 1, 15)) == []
    assert spark.catalog.tableExists("swept_new") and spark.catalog.tableExists("swept_again")


def test_assets(spark):
    df = local_table(spark, [("10.20.30.40", 0, 86_400_000 * 3 - 1), ("x", 86_400_000, 0)],
                     "ipAddress string, creationTime bigint, pit bigint")
    rows = assets.expand_asset(df, "IP").collect()
    assert [(r.IP3, r.IP2, r.daysFromCreTs) for r in rows] == [
        ("10.20.30", "10.20", 2), (None, None, -1)]
    assert "daysFromLastModTs" not in assets.expand_asset(df, "IP").columns
    assert assets.expand_asset(df, "PPAccount").columns == df.columns
    assert len(assets.ASSETS) == 14 and assets.asset_schema("Phone").fieldNames() == [
        "phoneNumber", "lastModifiedTime", "creationTime"]


def test_whole_job(spark, sf, tmp_path, config_path):
    population, activity = fx.cached(spark, sf)
    population.write.mode("overwrite").saveAsTable("people_in")
    activity.drop("empty_var").write.mode("overwrite").saveAsTable("acts_in")
    config = fx.feature_config(spark, sf).toPandas()
    config.to_csv(tmp_path / "all.csv", index=False)
    job = Job("people_in", "acts_in", str(tmp_path / "all.csv"), {"job_id": "n1"},
              Roles(amt="amt", gloss="gloss", nloss="nloss", ts="ts"), fx.F1,
              deprecated=("lot",), tag_table="tags_out", pattern_table="patterns_out",
              condition_table="conditions_out", log_table="log_out", stage_table="stages_out")
    for _ in range(2):
        found = run(spark, job)
    assert found.found and not found.cached
    assert spark.table("patterns_out").count() == len(found.patterns)
    assert spark.table("conditions_out").count() == len(
        {c.text for p in found.patterns for c in p.conditions})
    assert spark.table("log_out").count() == 1
    assert spark.table("stages_out").where("stage = 'kept'").count() == len(found.patterns)
    tags = spark.table(job.tags())
    assert tags.count() == population.count() and "expires_at" in tags.columns
    best = found.patterns[0]
    assert tags.where(f"{best.name} = 1 and tag = 1").count() == best.target_catch
    assert all("lot" not in c.text for p in found.patterns for c in p.conditions)
