"""Sources, shaping, configuration and derived features."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from lodeseam.conditions import Condition, Equals, Range
from lodeseam.config import Roles, VariableRules
from lodeseam.operators import assets, profile, shape
from lodeseam.operators.measure import matching_ids
from lodeseam.sources import tables

from . import fixtures as fx
from .catalog import f1, long_sql, query, r4

ROLES = Roles(amt="amt", gloss="gloss", nloss="nloss", ts="ts")
ACT_ROLES = Roles(amt="amt")


@query("src_population", f1("""
select key, acct, tag, round(amt,4) as amt, round(gloss,4) as gloss, round(nloss,4) as nloss,
  strftime(ts, '%Y-%m-%d') as day from population"""))
def src_population(spark, sf):
    return tables.ingest(fx.population(spark, sf), ROLES).select(
        "key", "acct", "tag", r4("amt"), r4("gloss"), r4("nloss"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("src_activity", f1("""
select key, acct, tag, round(amt,4) as amt, checkpoint, strftime("timestamp", '%Y-%m-%d %H:%M:%S') as "timestamp", line_no, part_no,
  qty, disc_score, tax_pct, days_to_ship, lot, line_open, p_type, p_brand, empty_var from activity"""))
def src_activity(spark, sf):
    return tables.ingest(fx.activity(spark, sf), ACT_ROLES).select(
        "key", "acct", "tag", r4("amt"), "checkpoint", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "line_no", "part_no", "qty", "disc_score", "tax_pct", "days_to_ship", "lot", "line_open", "p_type", "p_brand", "empty_var")


@query("src_filtered", f1("""
select 'activity' as side, count(*) as n, cast(sum(tag) as bigint) as tagged from activity where amt > 200000
union all select 'population', count(*), cast(sum(tag) as bigint) from population where amt > 200000"""))
def src_filtered(spark, sf):
    cond = "amt > 200000"
    sides = {"population": tables.ingest(fx.population(spark, sf), ROLES, cond),
             "activity": tables.ingest(fx.activity(spark, sf), ACT_ROLES, cond)}
    counted = [df.agg(F.count(F.lit(1)).alias("n"), F.sum("tag").cast("bigint").alias("tagged"))
               .select(F.lit(side).alias("side"), "n", "tagged") for side, df in sides.items()]
    return counted[0].unionByName(counted[1])


CONFIG_SQL = """
with seen as (select distinct l_returnflag as checkpoint from lineitem),
vars(variable, type, priority) as (values {values}),
config as (select variable, type, checkpoint,
  case when checkpoint='R' then 'sender/receiver' else 'sender' end as key_type,
  case when checkpoint='A' then 'sender/receiver' when checkpoint='R' then 'sender' end as key_value,
  priority, case when checkpoint='N' then 2 else 1 end as cp_priority from seen, vars),
roles as (select variable, type, checkpoint, kt as key_type, kv as key_value, priority, cp_priority
  from (select *, unnest(string_split(key_type,'/')) as kt from config) a,
  lateral (select unnest(string_split(coalesce(a.key_value,'sender'),'/')) as kv) b)
""".format(values=", ".join(f"('{v}','{t}',{p})" for v, t, p in fx.VARIABLES))


def _named(config):
    return config.withColumnRenamed("variable name", "variable").select(
        "variable", "type", "checkpoint", "key_type", "key_value", "priority", "cp_priority")


@query("feature_config", CONFIG_SQL + "select * from config")
def feature_config(spark, sf):
    return _named(tables.feature_columns(fx.feature_config(spark, sf)))


@query("feature_config_roles", CONFIG_SQL + "select * from roles")
def feature_config_roles(spark, sf):
    return _named(shape.explode_roles(fx.feature_config(spark, sf)))


@query("feature_config_dual", CONFIG_SQL + """
select variable, type, checkpoint || case key_type when 'sender' then '_send' else '_recv' end
  || case key_value when 'sender' then '@sndr' else '@rcvr' end as checkpoint,
  key_type, key_value, priority, cp_priority from roles""")
def feature_config_dual(spark, sf):
    return _named(shape.dual_scope(shape.explode_roles(fx.feature_config(spark, sf))))


@query("feature_config_single", CONFIG_SQL + """
select variable, type, checkpoint, key_type, key_value, priority, cp_priority from roles
union all select variable, type, checkpoint || s, key_type, key_value, priority, cp_priority
from roles, (values ('_send'), ('_recv')) t(s) where checkpoint in ('R','A')""")
def feature_config_single(spark, sf):
    return _named(shape.single_scope(shape.explode_roles(fx.feature_config(spark, sf)), "R|A"))


@query("feature_config_active", CONFIG_SQL + "select * from roles where variable not in ('lot')")
def feature_config_active(spark, sf):
    return _named(shape.without_variables(
        shape.explode_roles(fx.feature_config(spark, sf)), ["lot"]))


@query("features_by_checkpoint", CONFIG_SQL + """
select checkpoint, string_agg(distinct variable, ',' order by variable) as variables,
  min(cp_priority) as cp_priority from roles where variable <> 'empty_var' group by checkpoint""")
def features_by_checkpoint(spark, sf):
    config = shape.expand_config(fx.feature_config(spark, sf), "single", missing=["empty_var"])
    return shape.features_by_checkpoint(config).select(
        "checkpoint", F.array_join("variables", ",").alias("variables"), "cp_priority")


SEGMENTS = json.dumps([{"name": "p_type", "value": "PROMO"}, {"name": "p_type", "value": "SMALL"}])
MAPPING_SQL = """
select checkpoint, variable, string_agg(v, '|' order by v) as patterns from (
  select distinct l_returnflag as checkpoint, 'p_brand' as variable, p_type, p_brand as v
  from lineitem join part on l_partkey=p_partkey where p_type in ('PROMO','SMALL'))
group by checkpoint, variable"""


@query("exclusion_map", "with x as (" + MAPPING_SQL + ") select * from x")
def exclusion_map(spark, sf):
    mapping = (fx.table(spark, sf, "lineitem")
               .join(fx.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
               .select(F.lit("p_type").alias("alert_segment"),
                       F.col("p_type").alias("alert_segment_value"),
                       F.col("l_returnflag").alias("checkpoint"),
                       F.lit("p_brand").alias("config_segment"),
                       F.col("p_brand").alias("config_segment_value")).distinct())
    return tables.exclusion_map(mapping, SEGMENTS).select(
        "checkpoint", "variable", F.array_join("patterns", "|").alias("patterns"))


@query("target_activity", f1("select key, checkpoint, line_no, part_no, qty from activity where tag=1"))
def target_activity(spark, sf):
    return shape.outcome_activity(fx.activity(spark, sf)).select(
        "key", "checkpoint", "line_no", "part_no", "qty")


@query("activity_size_gate", f1("""
select count(*) as size, count(*) <= 10000 as fits from activity where tag=1"""))
def activity_size_gate(spark, sf):
    return shape.size_gate(fx.activity(spark, sf), 10_000)


@query("recent_k_per_checkpoint", f1("""
select key, checkpoint, line_no, part_no, qty from activity where tag=1
qualify row_number() over (partition by key, checkpoint
  order by "timestamp" desc, line_no desc, part_no desc) <= 2"""))
def recent_k_per_checkpoint(spark, sf):
    return shape.recent_rows(shape.outcome_activity(fx.activity(spark, sf)), 2, fx.TIEBREAK).select(
        "key", "checkpoint", "line_no", "part_no", "qty")


COLUMNS = ("acct", "amt", "checkpoint", "days_to_ship", "disc_score", "empty_var", "key",
           "line_no", "line_open", "lot", "p_brand", "p_type", "part_no", "qty", "tag", "tax_pct",
           "timestamp")


@query("non_null_columns", f1(", o as (select * from activity where tag=1) " + " union all ".join(
    f"select * from (select '{c}' as column_name, count(\"{c}\") as n from o) where n > 0"
    for c in COLUMNS)))
def non_null_columns(spark, sf):
    """The columns that are left, with their non-null counts."""
    left = shape.drop_null_columns(shape.outcome_activity(fx.activity(spark, sf)).select(*COLUMNS))
    counts = left.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in left.columns])
    return counts.unpivot([], list(left.columns), "column_name", "n")


@query("typed_activity", f1("""
select key, checkpoint, line_no, part_no,
  try_cast(case when checkpoint='A' then substr(p_brand, 7) else p_brand end as double) as brand_no,
  qty, line_open from activity"""))
def typed_activity(spark, sf):
    raw = fx.activity(spark, sf).select(
        "key", "checkpoint", "line_no", "part_no",
        F.when(F.col("checkpoint") == "A", F.substring("p_brand", 7, 10))
        .otherwise(F.col("p_brand")).alias("brand_no"),
        F.col("qty").cast("string").alias("qty"), F.col("line_open").cast("string").alias("line_open"))
    return shape.typed(raw, {"brand_no": "numeric", "qty": "numeric", "line_open": "bool"})


@query("clean_values", r"""
select doc_id, md5(translate(text, chr(13)||chr(10)||chr(9), '')) as cleaned,
  cast(length(text) - length(translate(text, chr(13)||chr(10)||chr(9), '')) as bigint) as removed
from documents""")
def clean_values(spark, sf):
    cleaned = shape.clean_value(F.col("text"))
    return fx.table(spark, sf, "documents").select(
        "doc_id", F.md5(cleaned).alias("cleaned"),
        (F.length("text") - F.length(cleaned)).cast("bigint").alias("removed"))


@query("excluded_segments", f1(f"""
, per_value as (select checkpoint, variable, value, count(distinct key) as size
  from ({long_sql(("p_type", "p_brand"))}) group by all),
top as (select * from per_value qualify row_number() over (
  partition by checkpoint, variable order by size desc, value) <= 10)
select checkpoint, variable, value, cast(size as double) as size from top
where not (checkpoint='R' and variable='p_brand' and regexp_matches(value, 'Brand#1.*'))"""))
def excluded_segments(spark, sf):
    outcome = shape.outcome_activity(fx.activity(spark, sf))
    top = profile.top_values(profile.string_values(outcome, fx.features(), "target_cnt"),
                             VariableRules())
    cells = spark.createDataFrame([("R", "p_brand", ["Brand#1.*"])],
                                  "checkpoint string, variable string, patterns array<string>")
    return shape.not_excluded(top, cells).select("checkpoint", "variable", "value", "size")


@query("numeric_ranges", f1("""
select content, count(*) as n from (select unnest([
  case when checkpoint='R' and qty<=10 then 'qty<=10' end,
  case when checkpoint='R' and qty>10 and qty<=30 then 'qty>10 and qty<=30' end,
  case when checkpoint='R' and qty>30 then 'qty>30' end]) as content from activity)
where content is not null group by content"""))
def numeric_ranges(spark, sf):
    ranges = [Range("qty", hi=10), Range("qty", 10, 30), Range("qty", lo=30)]
    names = F.array(*[F.lit(r.text) for r in ranges])
    ids = matching_ids([Condition("R", (r,)) for r in ranges])
    return (fx.activity(spark, sf).select(F.explode(ids).alias("i"))
            .select(F.get(names, F.col("i")).alias("content"))
            .groupBy("content").agg(F.count(F.lit(1)).alias("n")))


@query("null_condition", f1("""
select checkpoint, count(*) as n, count(distinct key) as keys from activity
where nullif(p_type, 'PROMO') is null and checkpoint = 'N' group by checkpoint"""))
def null_condition(spark, sf):
    noted = fx.activity(spark, sf).withColumn("note", F.nullif("p_type", F.lit("PROMO")))
    return (noted.where(Condition("N", (Equals("note", "None"),)).column()).groupBy("checkpoint")
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("keys")))


ASSET_CTE = """
with firsts as (select user_id, min(ts) as first_ts from events group by user_id),
assets as (select event_id,
  (e.user_id % 256) || '.' || (event_id % 256) || '.' || ((e.user_id*3) % 256) || '.' || ((event_id*7) % 256) as "ipAddress",
  epoch_ms(first_ts) as "creationTime", epoch_ms(ts) + 43200000 as "lastModifiedTime",
  case when event_id % 10 <> 0 then epoch_ms(ts) end as pit,
  string_split(c_name,'#')[1] as "firstName", string_split(c_name,'#')[2] as "lastName"
  from events e join firsts f on e.user_id=f.user_id left join customer on c_custkey=e.user_id)
"""


def _days(source: str) -> str:
    return f'cast(trunc((pit - "{source}")/86400000.0) as integer)'


@query("asset_ip_prefix", ASSET_CTE + r"""
select event_id, regexp_extract("ipAddress", '^\d+\.\d+\.\d+') as "IP3",
  regexp_extract("ipAddress", '^\d+\.\d+') as "IP2" from assets""")
def asset_ip_prefix(spark, sf):
    ip = F.col("ipAddress")
    return fx.assets(spark, sf).select("event_id", assets.ip_prefix(ip, 3).alias("IP3"),
                                       assets.ip_prefix(ip, 2).alias("IP2"))


DAY_SOURCES = {"daysFromCreTs": "creationTime", "daysFromLastModTs": "lastModifiedTime",
               "daysFromFirstUse": "creationTime", "daysFromLastUse": "lastModifiedTime",
               "daysFromInstallTs": "creationTime", "daysFromLastUpdtTs": "lastModifiedTime",
               "daysFromAcctCreTs": "creationTime", "daysFromFirstBuy": "lastModifiedTime"}


@query("asset_days_since", ASSET_CTE + "select event_id, " + ", ".join(
    f'{_days(s)} as "{n}"' for n, s in DAY_SOURCES.items()) + " from assets")
def asset_days_since(spark, sf):
    rows, out = fx.assets(spark, sf), ["event_id"]
    rows = rows.withColumns({assets.DAYS_SINCE[n][0]: F.col(s) for n, s in DAY_SOURCES.items()})
    for kind in ("URL", "AppGuid", "PPAccount"):
        rows = assets.expand_asset(rows, kind)
    return rows.select(*out, *DAY_SOURCES)


@query("asset_full_name", ASSET_CTE + """
select event_id, "firstName" || ' ' || "lastName" as "fullName" from assets""")
def asset_full_name(spark, sf):
    return fx.assets(spark, sf).select(
        "event_id", assets.full_name(F.col("firstName"), F.col("lastName")).alias("fullName"))


@query("asset_expand", ASSET_CTE + rf"""
select event_id, regexp_extract("ipAddress", '^\d+\.\d+\.\d+') as "IP3",
  regexp_extract("ipAddress", '^\d+\.\d+') as "IP2", {_days("creationTime")} as "daysFromCreTs",
  {_days("lastModifiedTime")} as "daysFromLastModTs" from assets""")
def asset_expand(spark, sf):
    base = ["ipAddress", "creationTime", "lastModifiedTime", "pit", "firstName", "lastName"]
    return assets.expand_asset(fx.assets(spark, sf), "IP").drop(*base)
