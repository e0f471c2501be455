"""Registry of the queries and their SQL twins, and the SQL pieces the twins share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def r6(c: str) -> Column:
    return F.round(c, 6).alias(c)


def r4(c: str) -> Column:
    return F.round(c, 4).alias(c)


F1_CTE = """
f as (
  select l_orderkey as k,
    max(case when l_returnflag='R' and l_discount>=0.08 and l_quantity>30 then 1 else 0 end) as r1,
    max(case when l_returnflag='A' and l_tax>=0.07 and l_linestatus='O' then 1 else 0 end) as r2,
    max(case when l_returnflag='R' and l_quantity>40 then 1 else 0 end) as r3a,
    max(case when l_returnflag='N' and p_type='PROMO' then 1 else 0 end) as r3b
  from lineitem join part on l_partkey=p_partkey group by l_orderkey),
population as (
  select cast(o_orderkey as varchar) as key, cast(o_custkey as varchar) as acct, o_orderdate as ts,
    case when o_custkey % 50 = 0 then null
         when r1=1 or r2=1 or (r3a=1 and r3b=1) then 1 else 0 end as tag,
    o_totalprice as amt, o_totalprice*0.10 as gloss, o_totalprice*0.04 as nloss
  from orders left join f on o_orderkey=k),
activity as (
  select p.key, p.acct, p.tag, p.amt, l_returnflag as checkpoint, l_shipdate as "timestamp",
    l_linenumber as line_no, l_partkey as part_no,
    l_quantity as qty, round(l_discount*100) as disc_score, round(l_tax*100) as tax_pct,
    cast(greatest(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)),0) as double) as days_to_ship,
    cast(l_linenumber % 4 as double) as lot, l_linestatus='O' as line_open, p_type, p_brand,
    cast(null as varchar) as empty_var
  from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey
  join population p on p.key=cast(l_orderkey as varchar))"""


def f1(body: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{F1_CTE}{body}"


VALUE = {"target_cnt": "1.0", "target_amt": "amt"}


def kpi(metric: str = "target_cnt", digits: int = 4) -> str:
    v = VALUE[metric]
    caught = f"coalesce(sum(case when tag=1 then {v} else 0 end),0)"
    return (f"round(cast({caught} as double),{digits}) as target_catch, "
            f"round(coalesce(cast({caught} as double)/(sum(case when tag in (0,1) then {v} else 0 end)"
            f"+0.0001),0),6) as target_rate")


def measure_sql(cond: str, metric: str = "target_cnt", head: str = "") -> str:
    return (f"select {head}{kpi(metric)} from (select key, max(tag) as tag, max(amt) as amt "
            f"from activity where {cond} group by key)")


def fscore_sql(rate: str, share: str) -> str:
    return (f"case when {rate}>0 and {share}>0 then 2*{rate}*{share}/({rate}+{share}) else 0.0 end")


BASE_SQL = ("base as (select cast(sum(case when tag=1 then 1 else 0 end) as double) as n, "
            "sum(case when tag=1 then 1 else 0 end)/(sum(case when tag in (0,1) then 1 else 0 end)+0.0001) "
            "as base_rate from population)")

# string and numeric features in long form, outcome rows only
NUMERIC = ("qty", "disc_score", "tax_pct", "days_to_ship", "lot")
STRINGS = ("p_type", "p_brand")


def long_sql(variables, where: str = "tag=1", cast: str = "varchar") -> str:
    return " union all ".join(
        f"select checkpoint, '{v}' as variable, cast({v} as {cast}) as value, key, acct, tag, amt "
        f"from activity where {where} and {v} is not null" for v in variables)
