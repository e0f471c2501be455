"""Metrics, condition and pattern measures, profiles and univariate search."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from lodeseam.config import VariableRules
from lodeseam.functions.metrics import fscore as fscore_column
from lodeseam.operators import measure, profile, shape
from lodeseam.operators.binning import (CellTable, Gate, make_plans, run_searches,
                                        value_candidates)
from lodeseam.plans import mining
from lodeseam.session import shared_dir
from lodeseam.sources import tables

from . import fixtures as fx
from .catalog import (BASE_SQL, NUMERIC, ORACLES, STRINGS, f1, fscore_sql, kpi, long_sql,
                      measure_sql, query, r4, r6)

CNT, AMT = "target_cnt", "target_amt"
RULES = VariableRules()
LIFTED = replace(fx.F1.with_lift_rules(), lift=1.1)

METRICS_SQL = """
  round(cast(count(*) as double),4) as firing_cnt, round(sum(amt),4) as firing_amt,
  round(cast(sum(t) as double),4) as target_cnt, round(sum(t*amt),4) as target_amt,
  round(sum(gloss),4) as gloss, round(sum(nloss),4) as nloss,
  round(sum(t)/(sum(lab)+0.0001),6) as target_cnt_rate,
  round(sum(t*amt)/(sum(lab*amt)+0.0001),6) as target_amt_rate,
  round(sum(gloss)/(sum(amt)+0.0001),6) as gloss_rate,
  round(sum(t)/({all_t}+0.0001),6) as target_cnt_catch_rate,
  round(sum(t*amt)/({all_ta}+0.0001),6) as target_amt_catch_rate,
  round(sum(gloss)/({all_g}+0.0001),6) as gloss_catch_rate,
  round(sum(nloss)/({all_n}+0.0001),6) as nloss_catch_rate,
  round({f},6) as pattr_fscore"""
_FS = fscore_sql("(sum(t)/(sum(lab)+0.0001))", "(sum(t)/{all_t})")
OVER = {"all_t": "sum(sum(t)) over ()", "all_ta": "sum(sum(t*amt)) over ()",
        "all_g": "sum(sum(gloss)) over ()", "all_n": "sum(sum(nloss)) over ()"}
WHOLE = {"all_t": "(select sum(t) from people)", "all_ta": "(select sum(t*amt) from people)",
         "all_g": "(select sum(gloss) from people)", "all_n": "(select sum(nloss) from people)"}


def metrics_sql(totals: dict[str, str]) -> str:
    return METRICS_SQL.format(f=_FS.format(**totals), **totals)


PEOPLE = (", people as (select *, case when tag=1 then 1 else 0 end as t, "
          "case when tag in (0,1) then 1 else 0 end as lab from population)")
RATES = ("target_cnt_rate", "target_amt_rate", "gloss_rate", "target_cnt_catch_rate",
         "target_amt_catch_rate", "gloss_catch_rate", "nloss_catch_rate", "pattr_fscore")
SUMS = ("firing_cnt", "firing_amt", "target_cnt", "target_amt", "gloss", "nloss")


def metric_columns():
    return [*[r4(c) for c in SUMS], *[r6(c) for c in RATES]]


@query("metrics_by_flag", f1(PEOPLE + ", hit as (select distinct key from activity "
                             "where checkpoint='R' and qty>40) select case when hit.key is null "
                             "then 0 else 1 end as flag," + metrics_sql(OVER)
                             + " from people left join hit on people.key=hit.key group by 1"))
def metrics_by_flag(spark, sf):
    hit = (fx.activity(spark, sf).where(fx.C2.column()).select("key").distinct()
           .withColumn("hit", F.lit(1)))
    flagged = (fx.population(spark, sf).join(hit, "key", "left")
               .withColumn("flag", F.coalesce("hit", F.lit(0))))
    return measure.metrics_by_group(flagged, "flag", CNT).select("flag", *metric_columns())


@query("metrics_by_roles", f1(PEOPLE + """ select tag, round(cast(count(*) as double),4) as firing_cnt, round(cast(sum(t) as double),4) as target_cnt,
  round(sum(t)/(sum(lab)+0.0001),6) as target_cnt_rate, round(sum(t)/(sum(sum(t)) over ()+0.0001),6) as target_cnt_catch_rate
from people group by tag"""))
def metrics_by_roles(spark, sf):
    """Without amounts and losses only the metrics that count are left."""
    people = fx.population(spark, sf).select("key", "acct", "ts", "tag")
    return measure.metrics_by_group(people, "tag", CNT).drop("pattr_fscore").select(
        "tag", r4("firing_cnt"), r4("target_cnt"), r6("target_cnt_rate"), r6("target_cnt_catch_rate"))


def _baseline_sql(metric):
    return f1(f" select {kpi(metric)} from population").replace(
        "target_catch", "total_catch").replace("target_rate", "base_rate")


@query("baseline_cnt", _baseline_sql(CNT))
def baseline_cnt(spark, sf):
    return measure.baseline(fx.population(spark, sf), CNT).select(r4("total_catch"), r6("base_rate"))


@query("baseline_amt", _baseline_sql(AMT))
def baseline_amt(spark, sf):
    return measure.baseline(fx.population(spark, sf), AMT).select(r4("total_catch"), r6("base_rate"))


@query("support_thresholds", f1(", " + BASE_SQL + """
select round(n,4) as total_catch, round(base_rate,6) as base_rate, round(cast(0.03*n as double),6) as sup_n,
  round(cast(greatest(0.01*n, 1) as double),6) as min_block from base"""))
def support_thresholds(spark, sf):
    return measure.thresholds(fx.population(spark, sf), fx.F1).select(
        r4("total_catch"), r6("base_rate"), r6("sup_n"), r6("min_block"))


def kpis():
    return r4("target_catch"), r6("target_rate")


@query("measure_condition", f1(measure_sql("checkpoint='R' and disc_score>7 and qty>30")))
def measure_condition(spark, sf):
    return measure.measure_condition(fx.activity(spark, sf), fx.R1, CNT).select(*kpis())


BATCH = [(fx.C1, "checkpoint='R' and disc_score>7"), (fx.C2, "checkpoint='R' and qty>40"),
         (fx.C3, "checkpoint='A' and tax_pct>6"), (fx.C4, "checkpoint='N' and p_type='PROMO'"),
         (fx.R1, "checkpoint='R' and disc_score>7 and qty>30"),
         (fx.R2, "checkpoint='A' and tax_pct>6 and line_open")]


def batch_sql(metric):
    return f1(" " + " union all ".join(measure_sql(cond, metric, f"{i} as test_id, ")
                                       for i, (_, cond) in enumerate(BATCH)))


def _batch(spark, sf, metric):
    return measure.measure_conditions(fx.activity(spark, sf), [c for c, _ in BATCH], metric).select(
        "test_id", *kpis())


@query("measure_conditions_batch", batch_sql(CNT))
def measure_conditions_batch(spark, sf):
    return _batch(spark, sf, CNT)


@query("measure_conditions_batch_amt", batch_sql(AMT))
def measure_conditions_batch_amt(spark, sf):
    return _batch(spark, sf, AMT)


HAS = ("has as (select key, " + ", ".join(
    f"max(case when {cond} then 1 else 0 end) as c{i}" for i, (_, cond) in enumerate(BATCH))
    + " from activity group by key)")


@query("measure_pattern", f1(PEOPLE + ", " + HAS + """
select case when c1=1 and c3=1 then 1 else 0 end as pattern_flag,""" + metrics_sql(OVER)
                             + " from people left join has on people.key=has.key group by 1"))
def measure_pattern(spark, sf):
    return measure.measure_pattern(fx.population(spark, sf), fx.activity(spark, sf), fx.R3,
                                   CNT).select("pattern_flag", *metric_columns())


PATTERNS = [(4,), (5,), (1, 3), (0, 2), (1, 2, 3), (0, 3)]


@query("measure_patterns_batch", f1(PEOPLE + ", " + HAS + " " + " union all ".join(
    f"select {i} as pattern_id," + metrics_sql(WHOLE) + " from people join has on people.key=has.key where "
    + " and ".join(f"c{j}=1" for j in p) for i, p in enumerate(PATTERNS))))
def measure_patterns_batch(spark, sf):
    words = measure.key_words(fx.activity(spark, sf), [c for c, _ in BATCH])
    return measure.measure_patterns(fx.population(spark, sf), words, PATTERNS, CNT).select(
        "pattern_id", *metric_columns())


CHECKPOINT_SQL = ("cps as (select checkpoint, cast(sum(case when tag=1 then 1 else 0 end) as double) as catch, "
                  "sum(case when tag=1 then 1 else 0 end)/(sum(case when tag in (0,1) then 1 else 0 end)"
                  "+0.0001) as rate from (select checkpoint, key, max(tag) as tag from activity "
                  "group by all) group by checkpoint)")


@query("fscore", f1(", " + BASE_SQL + ", " + CHECKPOINT_SQL + f"""
select checkpoint, round({fscore_sql('rate', '(catch/n)')},6) as f1,
  round(case when rate>0 and catch/n>0 then 5*rate*(catch/n)/(4*rate+catch/n) else 0 end,6) as f2 from cps, base"""))
def fscore(spark, sf):
    active = mining.checkpoint_kpis(fx.activity(spark, sf), CNT)
    total = measure.baseline(fx.population(spark, sf), CNT).first().total_catch
    share = F.col("target_catch") / F.lit(total)
    return active.select("checkpoint",
                       F.round(fscore_column(F.col("target_rate"), share), 6).alias("f1"),
                       F.round(fscore_column(F.col("target_rate"), share, 2.0), 6).alias("f2"))


# ---- profiles ----------------------------------------------------------------------------------

ALL_VARS = (*NUMERIC, "line_open", *STRINGS)


def sizes_sql(metric, variables=ALL_VARS):
    per_key = (f"per_key as (select checkpoint, variable, value, key, max(amt) as amt "
               f"from ({long_sql(variables)}) group by all)")
    size = "cast(count(*) as double)" if metric == CNT else "sum(amt)"
    return (f"{per_key}, sizes as (select checkpoint, variable, value, {size} as size "
            f"from per_key group by all)")


def concentration_sql(metric):
    return f1(", " + sizes_sql(metric) + """
, curve as (select checkpoint, variable, size, sum(size) over (partition by checkpoint, variable
  order by size desc, value rows unbounded preceding) as cum from sizes)
select checkpoint, variable, round(abs(sum(cum)/(count(*)*sum(size)/2)-1),6) as concentration
from curve group by all""")


def sizes_of(outcome, metric):
    return profile.string_values(outcome, fx.features(), metric).select(
        "checkpoint", "variable", "size").unionByName(profile.number_values(
            outcome, fx.features(), metric).select("checkpoint", "variable", "size"))


def numeric_values(outcome):
    return profile.number_values(outcome, [f for f in fx.features() if f.type == "numeric"], CNT)


def _concentration(spark, sf, metric):
    outcome = shape.outcome_activity(fx.cached(spark, sf)[1])
    return profile.concentration(sizes_of(outcome, metric), metric).select(
        "checkpoint", "variable", r6("concentration"))


@query("concentration_cnt", concentration_sql(CNT))
def concentration_cnt(spark, sf):
    return _concentration(spark, sf, CNT)


@query("concentration_amt", concentration_sql(AMT))
def concentration_amt(spark, sf):
    return _concentration(spark, sf, AMT)


STEPS = profile.quantile_steps(0.03)


def quantile_sql(variables=NUMERIC):
    steps = ",".join(repr(p) for p in STEPS)
    return (f"vals as ({long_sql(variables, cast='double')}), q as (select checkpoint, variable, "
            f"quantile_cont(value, [{steps}]) as qs, max(value) as max_value, "
            f"count(distinct value) as n_values from vals group by all)")


@query("quantile_cuts", f1(", " + quantile_sql() + """
select checkpoint, variable, max_value, cast(n_values as bigint) as n_values,
  unnest(range(1, len(qs)+1)) as place, round(unnest(qs), 6) as quantile from q"""))
def quantile_cuts(spark, sf):
    outcome = shape.outcome_activity(fx.cached(spark, sf)[1])
    summary = profile.quantiles(numeric_values(outcome), STEPS)
    return summary.select("checkpoint", "variable", "max_value", "n_values",
                          F.posexplode("quantiles").alias("p", "q")).select(
        "checkpoint", "variable", "max_value", "n_values",
        (F.col("p") + 1).cast("bigint").alias("place"), F.round("q", 6).alias("quantile"))


def top_sql(metric):
    return f1(", " + sizes_sql(metric, STRINGS) + f"""
, top as (select * from sizes qualify row_number() over (partition by checkpoint, variable
  order by size desc, value) <= 10)
select t.checkpoint, t.variable, t.value, round(any_value(t.size),4) as size,
  count(distinct acct) as n_acct
from top t join ({long_sql(STRINGS)}) l on t.checkpoint=l.checkpoint and t.variable=l.variable
  and t.value=l.value group by all""")


def _top(spark, sf, metric):
    outcome, features = shape.outcome_activity(fx.activity(spark, sf)), fx.features()
    top = profile.top_values(profile.string_values(outcome, features, metric), RULES)
    return profile.account_counts(top, outcome, features).select(
        "checkpoint", "variable", "value", r4("size"), "n_acct")


@query("top_values_cnt", top_sql(CNT))
def top_values_cnt(spark, sf):
    return _top(spark, sf, CNT)


@query("top_values_amt", top_sql(AMT))
def top_values_amt(spark, sf):
    return _top(spark, sf, AMT)


RULE_FILE = {"string": {"ignore_values": ["PROMO", "Brand#7", "Brand#21"]}}


@query("ignored_values", f1(", " + sizes_sql(CNT, STRINGS) + """
select checkpoint, variable, value, size from sizes where value not in ('PROMO', 'Brand#7', 'Brand#21')
qualify row_number() over (partition by checkpoint, variable order by size desc, value) <= 10"""))
def ignored_values(spark, sf):
    """Rules read from a file on shared storage; values on their ignore list never rank."""
    path = f"{shared_dir(spark)}/rules-{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(RULE_FILE),)], "value string").coalesce(1).write.text(path)
    outcome = shape.outcome_activity(fx.activity(spark, sf))
    top = profile.top_values(profile.string_values(outcome, fx.features(), CNT), tables.read_variable_rules(spark, path))
    return top.select("checkpoint", "variable", "value", "size")


CUTS_SQL = quantile_sql() + """
, rounded as (select checkpoint, variable, max_value, list_sort(list_distinct([
    case when x<10 then round_even(x,1) when x<100 then floor(x/10)*10
      when x<10000 then floor(x/100)*100 else floor(x/10000)*10000 end for x in qs if x > 0])) as cuts from q)
, fixed as (select checkpoint, variable, max_value, [cast(c as double) for c in [1,7,30,90,180,360]
    if c < max_value] as below from q where variable='days_to_ship')
, cuts as (select checkpoint, variable, cuts from rounded where variable<>'days_to_ship'
  union all select checkpoint, variable, list_append(below,
    cast([1,7,30,90,180,360,720][len(below)+1] as double)) from fixed)"""


def _cuts(spark, sf):
    outcome = shape.outcome_activity(fx.activity(spark, sf))
    summary = profile.quantiles(numeric_values(outcome).persist(), STEPS)
    return profile.cuts_by_pair(summary, RULES).select(
        "checkpoint", "variable", F.posexplode("cuts").alias("p", "cut")).select(
        "checkpoint", "variable", (F.col("p") + 1).cast("bigint").alias("place"), "cut")


@query("numeric_cuts", f1(", " + CUTS_SQL + """
select checkpoint, variable, unnest(range(1, len(cuts)+1)) as place, unnest(cuts) as cut
from cuts where variable<>'days_to_ship'"""))
def numeric_cuts(spark, sf):
    return _cuts(spark, sf).where("variable != 'days_to_ship'")


@query("fixed_cuts", f1(", " + CUTS_SQL + """
select checkpoint, variable, unnest(range(1, len(cuts)+1)) as place, unnest(cuts) as cut
from cuts where variable='days_to_ship'"""))
def fixed_cuts(spark, sf):
    return _cuts(spark, sf).where("variable = 'days_to_ship'")


# ---- univariate search ---------------------------------------------------------------------------

def setup(spark, sf, kinds=None, params=fx.F1, features=None, rules=RULES):
    """(cells, gate) with the plans of the wanted kinds, as the mining job builds them."""
    population, activity = fx.cached(spark, sf)
    features = [f for f in features or fx.features() if kinds is None or _may_be(f, kinds)]
    outcome = shape.outcome_activity(activity)
    gate = Gate.of(measure.thresholds(population, params).first(), params)
    top, cuts, discrete = {}, {}, {}
    if any(f.type == "string" for f in features):
        strings = profile.string_values(outcome, features, params.eval_metric)
        top = mining.profile_strings(strings, features, rules, None, fx.F1.top_values, None, outcome)
    if any(f.type == "numeric" for f in features):
        numbers = profile.number_values(outcome, features, params.eval_metric).persist()
        cuts, discrete = mining.profile_numbers(numbers, features, params, rules)
        numbers.unpersist()
    plans = make_plans(features, top, cuts, discrete, set(), rules)
    plans = [p for p in plans if kinds is None or p.kind in kinds]
    return CellTable(activity, plans, params.eval_metric), gate


def _may_be(feature, kinds):
    if feature.type != "numeric":
        return feature.type in kinds
    return profile.direction(feature.variable, RULES) in kinds or "discrete" in kinds


def search(spark, sf, kinds, params=fx.F1):
    """Conditions found by the searches of the wanted kinds."""
    return found_rows(spark, *setup(spark, sf, kinds, params))


def found_rows(spark, cells, gate):
    found = run_searches(cells, gate)
    cells.release()
    rows = [(p.feature.checkpoint, atom.text, catch, rate)
            for p, atoms in zip(cells.plans, found) for atom, catch, rate in atoms]
    return spark.createDataFrame(rows, "checkpoint string, content string, target_catch double, "
                                 "target_rate double").select("checkpoint", "content", *kpis())


def candidates_sql(lift2: float) -> str:
    return f1(", " + BASE_SQL + ", " + sizes_sql(CNT, STRINGS) + f"""
, top as (select * from sizes qualify row_number() over (partition by checkpoint, variable
  order by size desc, value) <= 10)
, accts as (select checkpoint, variable, value, count(distinct acct) as n_acct
  from ({long_sql(STRINGS)}) group by all)
, m as (select checkpoint, variable, value, {kpi()} from (select l.checkpoint, l.variable, l.value, l.key,
    max(l.tag) as tag from ({long_sql(STRINGS, where="true")}) l
    join top t on l.checkpoint=t.checkpoint and l.variable=t.variable and l.value=t.value group by all)
  group by all)
select m.checkpoint, m.variable, m.value, target_catch, target_rate
from m join accts a on m.checkpoint=a.checkpoint and m.variable=a.variable and m.value=a.value, base
where n_acct > 1 and m.value not in ('NULL','UNKNOWN','None')
  and target_rate > base_rate*{lift2} and target_catch > greatest(0.01*n, 1)""")


def _candidates(spark, sf, params):
    cells, gate = setup(spark, sf, ("string",), params)
    return value_candidates(cells, gate).select("checkpoint", "variable", "value", *kpis())


@query("string_value_candidates", candidates_sql(1.0))
def string_value_candidates(spark, sf):
    return _candidates(spark, sf, fx.F1)


@query("string_value_candidates_lift", candidates_sql(1.1 * 1.1))
def string_value_candidates_lift(spark, sf):
    return _candidates(spark, sf, LIFTED)


def string_bins_sql(lift: float = 1.0, best_first: bool = False, cap: float | None = None) -> str:
    """Every union of the top values is measured from a histogram of per-key value masks; the
    greedy merge is then a walk over the values that carries the list of bins."""
    order = "rate desc, catch desc, size desc, value" if best_first else "size desc, value"
    capped = "true" if cap is None else f"(bins[near]).c <= {cap} * whole"
    close = ("(abs((bins[near]).r - rate) / nullif((bins[near]).r, 0) < 0.5 or rate > 0.6 "
             "or ((bins[near]).r < 0.01 and rate < (bins[near]).r))")
    return f1(", " + BASE_SQL + ", " + sizes_sql(CNT, STRINGS) + f"""
, rows as materialized ({long_sql(STRINGS, where="true")})
, top as (select * from sizes qualify row_number() over (partition by checkpoint, variable
  order by size desc, value) <= 10)
, accts as (select checkpoint, variable, value, count(distinct case when tag=1 then acct end) as n_acct
  from rows group by all)
, single as (select checkpoint, variable, value, sum(case when tag=1 then 1.0 else 0 end) as catch,
    sum(case when tag=1 then 1 else 0 end)/(sum(case when tag in (0,1) then 1 else 0 end)+0.0001) as rate
  from (select checkpoint, variable, value, key, max(tag) as tag from rows group by all) group by all)
, placed as (select t.*, catch, rate, n_acct > 1 and t.value not in ('NULL','UNKNOWN','None')
    and rate > base_rate*{lift * lift} and catch > greatest(0.01*n, 1) as fits,
    row_number() over (partition by t.checkpoint, t.variable order by {order}) as place
  from top t join single s using (checkpoint, variable, value)
  join accts a using (checkpoint, variable, value), base)
, masks as (select checkpoint, variable, key, max(tag) as tag, bit_or(cast(1 << (place-1) as bigint)) as mask
  from rows join placed using (checkpoint, variable, value) group by all)
, hist as (select checkpoint, variable, mask, tag, count(*) as k from masks group by all)
, joined as (select checkpoint, variable, s, sum(case when tag=1 and mask & s <> 0 then k else 0 end) as c,
    sum(case when tag=1 and mask & s <> 0 then k else 0 end)
      / (sum(case when tag in (0,1) and mask & s <> 0 then k else 0 end)+0.0001) as r
  from hist, (select unnest(range(1, 1024)) as s) group by all)
, unions as (select checkpoint, variable,
    list(struct_pack(m := cast(s as bigint), c := cast(c as double), r := cast(r as double)) order by s) as u
  from joined group by all)
, steps as (select p.checkpoint, p.variable, place, fits, rate, catch, cast(1 << (place-1) as bigint) as bit, u,
    u[1023].c as whole from placed p join unions using (checkpoint, variable))
, walk as (
  select checkpoint, variable, 0 as place, u[1:0] as bins from unions
  union all
  select checkpoint, variable, place, case when not fits then bins
    when len(bins) = 0 or not ({close} and {capped}) then list_append(bins, u[bit])
    else [case when i = near then u[(bins[i]).m | bit] else bins[i] end for i in range(1, len(bins)+1)] end
  from (select s.*, bins, list_position([abs(b.r - rate) for b in bins],
          list_min([abs(b.r - rate) for b in bins])) as near
        from walk w join steps s on s.checkpoint=w.checkpoint and s.variable=w.variable and s.place=w.place+1))
, final as (select checkpoint, variable, unnest(bins) as b from walk
  qualify row_number() over (partition by checkpoint, variable order by place desc) = 1)
select f.checkpoint, f.variable || ' in (' || string_agg('"' || value || '"', ',' order by place) || ')' as content,
  round(any_value(b.c),4) as target_catch, round(any_value(b.r),6) as target_rate
from (select *, b.m as m from final) f join placed p on p.checkpoint=f.checkpoint and p.variable=f.variable
  and m & (1 << (place-1)) <> 0, base
group by f.checkpoint, f.variable, m, n having any_value(b.c) >= 0.03*n""", recursive=True)


@query("string_bins", string_bins_sql())
def string_bins(spark, sf):
    return search(spark, sf, ("string",))


@query("string_bins_lift", string_bins_sql(1.1, True, 0.8))
def string_bins_lift(spark, sf):
    return search(spark, sf, ("string",), LIFTED)


NUM = "case when {x}=floor({x}) then cast(cast({x} as bigint) as varchar) else cast({x} as varchar) end"


def one_sided_sql(variable: str, op: str) -> str:
    """All cuts measured on a side, then the pick in cut order."""
    shown = f"'{variable}{op}' || {NUM.format(x='cut')}"
    measured = f"""
, c as (select checkpoint, unnest(cuts) as cut, unnest(range(1, len(cuts)+1)) as place from cuts
  where variable='{variable}')
, m as (select checkpoint, cut, place, {kpi(digits=4)} from (
    select a.checkpoint, cut, place, key, max(tag) as tag from activity a
    join c on a.checkpoint=c.checkpoint and a.{variable} {op} cut group by all) group by all)
, g as (select *, 0.03*n as sup_n from m, base)"""
    if op == ">":
        return f1(", " + BASE_SQL + ", " + CUTS_SQL + measured + f"""
, strong as (select checkpoint, min(place) as first_strong from g where target_rate > 0.6 group by all)
, pick as (select g.* from g left join strong s on g.checkpoint=s.checkpoint
  where g.place = s.first_strong or (s.first_strong is null and target_catch > sup_n)
  qualify row_number() over (partition by g.checkpoint order by target_rate desc, place) = 1)
select checkpoint, {shown} as content, target_catch, target_rate from pick
where target_rate > base_rate and target_catch > sup_n""")
    return f1(", " + BASE_SQL + ", " + CUTS_SQL + measured + f"""
, walk as (select checkpoint, place, cut, target_catch, target_rate, base_rate, sup_n,
    case when target_catch > sup_n and target_rate > 0 then target_rate end as best from g where place = 1
  union all
  select g.checkpoint, g.place, g.cut, g.target_catch, g.target_rate, g.base_rate, g.sup_n,
    case when g.target_catch > g.sup_n and g.target_rate > least(coalesce(w.best, 0), 0.6)
      then g.target_rate else w.best end
  from walk w join g on g.checkpoint=w.checkpoint and g.place=w.place+1)
, taken as (select w.* from walk w left join walk p on p.checkpoint=w.checkpoint and p.place=w.place-1
  where w.target_catch > w.sup_n and w.target_rate > least(coalesce(p.best, 0), 0.6)
  qualify row_number() over (partition by w.checkpoint order by w.place desc) = 1)
select checkpoint, {shown} as content, target_catch, target_rate from taken
where target_rate > base_rate and target_catch > sup_n""", recursive=True)


@query("numeric_up", one_sided_sql("disc_score", ">"))
def numeric_up(spark, sf):
    return search(spark, sf, ("up",))


@query("numeric_down", one_sided_sql("days_to_ship", "<="))
def numeric_down(spark, sf):
    return search(spark, sf, ("down",))


def intervals_sql() -> str:
    """Every run of cells is measured; the merge is a walk over the cells."""
    variables = ("qty", "tax_pct", "lot")
    close = "(abs(w.r - s.r) / nullif(w.r, 0) < 0.5 or s.r > 0.6 or (w.r < 0.01 and s.r < w.r))"
    joins = f"s.r >= base_rate and s.cell < s.last and w.hi = s.cell-1 and {close}"

    def pick(merged, fresh, same):
        return f"case when {joins} then {merged} when s.r >= base_rate then {fresh} else {same} end"
    return f1(", " + BASE_SQL + ", " + CUTS_SQL + f"""
, v as ({long_sql(variables, where="true", cast="double")})
, keycells as (select v.checkpoint, v.variable, key, len([c for c in cuts if c < value]) as cell,
    len(cuts) as last, max(tag) as tag from v join cuts using (checkpoint, variable) group by all)
, runs as (select checkpoint, variable, unnest(range(0, last+1)) as lo, last from
    (select distinct checkpoint, variable, last from keycells))
, spans as (select checkpoint, variable, lo, unnest(range(lo, last+1)) as hi from runs)
, met as (select distinct s.checkpoint, s.variable, lo, hi, key, tag, last from spans s
  join keycells k on k.checkpoint=s.checkpoint and k.variable=s.variable and k.cell between lo and hi)
, m as (select checkpoint, variable, lo, hi, last, cast(sum(case when tag=1 then 1 else 0 end) as double) as c,
    sum(case when tag=1 then 1 else 0 end)/(sum(case when tag in (0,1) then 1 else 0 end)+0.0001) as r
  from met group by all)
, single as (select checkpoint, variable, lo as cell, last, c, r from m where lo = hi
  union all select s.checkpoint, s.variable, s.lo, u.last, 0.0, 0.0 from spans s join runs u using (checkpoint, variable, lo)
  where s.lo = s.hi and not exists (select 1 from m where m.checkpoint=s.checkpoint
    and m.variable=s.variable and m.lo=s.lo and m.hi=s.lo))
, walk as (
  select checkpoint, variable, cell, case when r > base_rate then 0 end as lo,
    case when r > base_rate then 0 end as hi, case when r > base_rate then c end as c,
    case when r > base_rate then r end as r from single, base where cell = 0
  union all
  select s.checkpoint, s.variable, s.cell, {pick("w.lo", "s.cell", "w.lo")}, {pick("s.cell", "s.cell", "w.hi")},
    {pick("x.c", "s.c", "w.c")}, {pick("x.r", "s.r", "w.r")}
  from walk w join single s on s.checkpoint=w.checkpoint and s.variable=w.variable and s.cell=w.cell+1
  left join m x on x.checkpoint=w.checkpoint and x.variable=w.variable and x.lo=w.lo and x.hi=s.cell, base)
, ends as (select * from walk where lo is not null
  qualify row_number() over (partition by checkpoint, variable, lo order by cell desc) = 1)
select e.checkpoint, case when lo = 0 then e.variable || '<=' || {NUM.format(x="cuts[hi+1]")}
    when hi = len(cuts) then e.variable || '>' || {NUM.format(x="cuts[lo]")}
    else e.variable || '>' || {NUM.format(x="cuts[lo]")} || ' and ' || e.variable || '<=' || {NUM.format(x="cuts[hi+1]")} end as content,
  round(c,4) as target_catch, round(r,6) as target_rate
from ends e join cuts using (checkpoint, variable), base where c >= 0.03*n and r >= base_rate""", recursive=True)


@query("numeric_intervals", intervals_sql())
def numeric_intervals(spark, sf):
    return search(spark, sf, ("both",))


@query("numeric_interval_rates", f1(", " + CUTS_SQL + f"""
, c as (select checkpoint, variable, unnest(range(0, len(cuts)+1)) as cell, cuts from cuts)
, v as ({long_sql(NUMERIC, where="true", cast="double")})
, hit as (select c.checkpoint, c.variable, c.cell, key, max(tag) as tag from v join c
  on v.checkpoint=c.checkpoint and v.variable=c.variable
  and (c.cell=0 or value > cuts[c.cell]) and (c.cell=len(cuts) or value <= cuts[c.cell+1]) group by all)
select checkpoint, variable, cast(cell as integer) as cell, {kpi()} from hit group by all"""))
def numeric_interval_rates(spark, sf):
    cells, _ = setup(spark, sf, ("both", "up", "down"))
    tests = [(p, frozenset({c})) for p, plan in enumerate(cells.plans) for c in range(plan.size)]
    names = spark.createDataFrame(
        [(i, cells.plans[p].feature.checkpoint, cells.plans[p].feature.variable, min(c))
         for i, (p, c) in enumerate(tests)],
        "test_id int, checkpoint string, variable string, cell int")
    return names.join(cells.kpis(tests), "test_id").select("checkpoint", "variable", "cell", *kpis())


@query("numeric_discrete", f1(", " + BASE_SQL + f"""
, m as (select checkpoint, lot, {kpi()} from (select checkpoint, lot, key, max(tag) as tag
  from activity group by all) group by all)
select checkpoint, 'lot=' || cast(cast(lot as bigint) as varchar) as content, target_catch, target_rate
from m, base where target_catch > 0.03*n and (target_rate > base_rate*1.0 or target_rate > 0.6)
and target_rate >= base_rate"""))
def numeric_discrete(spark, sf):
    return search(spark, sf, ("discrete",), replace(fx.F1, discrete_max=5))


def boolean_sql(met: bool, rate: str) -> str:
    return f1(", " + BASE_SQL + f"""
, m as (select checkpoint, {kpi()} from (select checkpoint, key, max(tag) as tag from activity
  where line_open = {met} group by all) group by all)
select checkpoint, 'line_open={met}' as content, target_catch, target_rate from m, base
where target_catch >= 0.03*n and target_rate >= {rate}""")


@query("boolean_conditions", boolean_sql(True, "base_rate"))
def boolean_conditions(spark, sf):
    return search(spark, sf, ("bool",))


@query("boolean_conditions_false", boolean_sql(False, "0"))
def boolean_conditions_false(spark, sf):
    """The variable is on the list of those whose condition is "is false"; every rate passes, as the true side is the better one."""
    cells, gate = setup(spark, sf, ("bool",), rules=replace(RULES, false_vars=("line_open",)))
    return found_rows(spark, cells, replace(gate, base_rate=0.0))


SEARCHES = ("string_bins", "numeric_up", "numeric_down", "numeric_intervals", "boolean_conditions")


@query("qualified_conditions", " union all ".join(
    f"select checkpoint, content, target_catch, target_rate from ({ORACLES[name]})"
    for name in SEARCHES))
def qualified_conditions(spark, sf):
    return search(spark, sf, None)


@query("eligible_features", f1(", " + BASE_SQL + ", " + CHECKPOINT_SQL + ", " + sizes_sql(CNT) + """
, curve as (select checkpoint, variable, size, sum(size) over (partition by checkpoint, variable
  order by size desc, value rows unbounded preceding) as cum from sizes)
, idx as (select checkpoint, variable, abs(sum(cum)/(count(*)*sum(size)/2)-1) as concentration
  from curve group by all)
select i.checkpoint, variable, round(concentration,6) as concentration
from idx i join cps c on i.checkpoint=c.checkpoint, base where catch >= 0.03*n and concentration >= 0.2"""))
def eligible_features(spark, sf):
    population, activity = fx.cached(spark, sf)
    sup_n = measure.thresholds(population, fx.F1).first().sup_n
    supported = mining.checkpoint_kpis(activity, CNT).where(F.col("target_catch") >= sup_n)
    sizes = sizes_of(shape.outcome_activity(activity), CNT)
    return (profile.concentration(sizes, CNT).where("concentration >= 0.2")
            .join(supported, "checkpoint", "left_semi")
            .select("checkpoint", "variable", r6("concentration")))
