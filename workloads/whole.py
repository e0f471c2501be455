"""The whole job as one SQL statement: a chain of common table expressions, recursive where the job decides step by step.

The twin follows the stages that :mod:`lodeseam.plans.mining` goes through: limits, cells, univariate searches, trees, item sets,
patterns, pruning, ranking, increments. Unions of cells are added up from a histogram of cell masks per feature, conjunctions from one
of row-mask sets per checkpoint; every greedy decision is a step of a recursive query that carries what was kept so far.
"""

from __future__ import annotations

from dataclasses import dataclass

from lodeseam.config import PRIORITY_SCORE, Feature, SearchParams, VariableRules
from lodeseam.operators import profile

from .catalog import BASE_SQL, F1_CTE, fscore_sql

RULES = VariableRules()
NUM = "case when {x}=floor({x}) then cast(cast({x} as bigint) as varchar) else cast({x} as varchar) end"


@dataclass(frozen=True)
class Domain:
    """The tables population and activity as SQL, and the features."""

    tables: str
    features: tuple[Feature, ...]

    def of(self, kind: str) -> list[str]:
        return sorted({f.variable for f in self.features if _kind(f) == kind})


def _kind(f: Feature) -> str:
    return profile.direction(f.variable, RULES) if f.type == "numeric" else f.type


def _long(variables: list[str], where: str, cast: str) -> str:
    return " union all ".join(f"select rid, checkpoint, '{v}' as variable, cast({v} as {cast}) as value, key, acct, tag from acts "
                              f"where {where} and {v} is not null" for v in variables)


def _caught(mask: str) -> str:
    return f"cast(coalesce(list_sum([x.a for x in h if (x.m & ({mask})) <> 0]), 0) as double)"


def _share(mask: str) -> str:
    return f"round({_caught(mask)} / (coalesce(list_sum([x.b for x in h if (x.m & ({mask})) <> 0]), 0) + 0.0001), 10)"


def _close(rate: str, other: str, cutoff: float) -> str:
    return f"(abs({other} - {rate}) / nullif({other}, 0) < 0.5 or {rate} > {cutoff} or ({other} < 0.01 and {rate} < {other}))"


def _inputs(domain: Domain, p: SearchParams) -> str:
    steps = ",".join(repr(s) for s in profile.quantile_steps(p.min_support))
    score = " ".join(f"when {k} then {v}" for k, v in PRIORITY_SCORE.items())
    features = ", ".join(f"('{f.checkpoint}', '{f.variable}', '{_kind(f)}', {f.priority}, {f.cp_priority})" for f in domain.features)
    numeric = domain.of("up") + domain.of("down") + domain.of("both")
    ((pattern, fixed),) = RULES.fixed_cuts
    named = f"regexp_matches(lower(variable), '{pattern}')"
    below = f"[cast(c as double) for c in {list(fixed[:-1])} if c < max_value]"
    cells = [f"""select v.rid, v.checkpoint, v.variable, v.key, v.acct, v.tag, len([c for c in cuts if c < value]) as cell
  from ({_long(numeric, "true", "double")}) v join cuts using (checkpoint, variable)"""]
    if domain.of("string"):
        cells.append(f"""select v.rid, v.checkpoint, v.variable, v.key, v.acct, v.tag, t.place - 1
  from ({_long(domain.of("string"), "true", "varchar")}) v join strings t using (checkpoint, variable, value)""")
    if domain.of("bool"):
        cells.append("select rid, checkpoint, variable, key, acct, tag, 0 from "
                     f"({_long(domain.of('bool'), 'true', 'boolean')}) where value")
    ignored = ", ".join(f"'{v}'" for v in RULES.ignore_values)
    strings = (f"""select checkpoint, variable, value, count(distinct key) as size, count(distinct acct) as n_acct
    from ({_long(domain.of("string"), "tag=1", "varchar")}) where value not in ({ignored}) group by all"""
               if domain.of("string") else
               "select '' as checkpoint, '' as variable, '' as value, 0 as size, 0 as n_acct where false")
    return f"""
, {BASE_SQL}
, lim as materialized (select n, round(base_rate, 10) as br, {p.min_support}*n as sup, greatest({p.min_block_size}*n, 1) as blk from base)
, feat(checkpoint, variable, kind, priority, cp_priority) as (values {features})
, prio as (select checkpoint, variable, kind, priority, case priority {score} end as score,
    case min(cp_priority) over (partition by checkpoint) {score} end as cp_score from feat)
, acts as materialized (select row_number() over () as rid, * from activity)
, cpk as materialized (select checkpoint, c, round(c/(lab+0.0001), 10) as r from (
    select checkpoint, cast(sum(case when tag=1 then 1 else 0 end) as double) as c, sum(case when tag in (0,1) then 1 else 0 end) as lab
    from (select checkpoint, key, max(tag) as tag from acts group by all) group by all), lim where c >= sup)
, q as (select checkpoint, variable, quantile_cont(value, [{steps}]) as qs, max(value) as max_value
  from ({_long(numeric, "tag=1", "double")}) group by all)
, cuts as materialized (select checkpoint, variable, cuts from (select checkpoint, variable, case when {named}
    then list_append({below}, cast({list(fixed)}[len({below})+1] as double))
    else list_sort(list_distinct([case when x<10 then round_even(x,1) when x<100 then floor(x/10)*10
      when x<10000 then floor(x/100)*100 else floor(x/10000)*10000 end for x in qs if x > 0])) end as cuts from q) where len(cuts) > 1)
, strings as materialized (select *, row_number() over (partition by checkpoint, variable order by size desc, value) as place
  from ({strings}) s, lim where size > blk)
, cells as materialized ({" union all ".join(cells)})
, hist as materialized (select checkpoint, variable, kind, list(struct_pack(m := m, a := a, b := b)) as h from (
    select checkpoint, variable, m, sum(case when tag=1 then 1 else 0 end) as a, sum(case when tag in (0,1) then 1 else 0 end) as b
    from (select checkpoint, variable, key, max(tag) as tag, bit_or(cast(1 as bigint) << cell) as m from cells group by all) group by all)
  join feat using (checkpoint, variable) where checkpoint in (select checkpoint from cpk) group by all)"""


def _univariate(p: SearchParams) -> str:
    cutoff = p.eval_cutoff
    merged = "(cast(1 as bigint) << (s.cell+1)) - (cast(1 as bigint) << w.lo)"
    joins = f"s.r >= br and s.cell < s.last and w.hi = s.cell-1 and {_close('s.r', 'w.r', cutoff)}"
    mask = "((bins[near]).m | bit)"

    def pick(both: str, fresh: str, same: str) -> str:
        return f"case when {joins} then {both} when s.r >= br then {fresh} else {same} end"
    return f"""
, sides as (select checkpoint, variable, kind, h, cuts, unnest(range(1, len(cuts)+1)) as place from hist join cuts using (checkpoint, variable)
  where kind in ('up', 'down'))
, side as materialized (select *, {_caught("s")} as c, {_share("s")} as r from (select *, case kind
    when 'up' then (cast(1 as bigint) << (len(cuts)+1)) - (cast(1 as bigint) << place) else (cast(1 as bigint) << place) - 1 end as s from sides))
, ups as (select g.* from side g left join (select checkpoint, variable, min(place) as strong from side where r > {cutoff} group by all) f
    using (checkpoint, variable), lim where kind = 'up' and (place = strong or (strong is null and c > sup and r > 0))
  qualify row_number() over (partition by checkpoint, variable order by r desc, place) = 1)
, downwalk as (select checkpoint, variable, 0 as place, cast(0 as double) as best, false as took from hist where kind = 'down'
  union all select g.checkpoint, g.variable, g.place, case when g.c > sup and g.r > least(w.best, {cutoff}) then g.r else w.best end,
    g.c > sup and g.r > least(w.best, {cutoff})
  from downwalk w join side g on g.checkpoint=w.checkpoint and g.variable=w.variable and g.place=w.place+1 and g.kind='down', lim)
, downs as (select g.* from side g join downwalk w using (checkpoint, variable, place) where kind = 'down' and took
  qualify row_number() over (partition by checkpoint, variable order by place desc) = 1)
, single as materialized (select *, {_caught("cast(1 as bigint) << cell")} as c, {_share("cast(1 as bigint) << cell")} as r from (
    select checkpoint, variable, h, cuts, len(cuts) as last, unnest(range(0, len(cuts)+1)) as cell
    from hist join cuts using (checkpoint, variable) where kind = 'both'))
, runs as (
  select checkpoint, variable, cell, case when r > br then 0 end as lo, case when r > br then 0 end as hi,
    case when r > br then c end as c, case when r > br then r end as r from single, lim where cell = 0
  union all
  select s.checkpoint, s.variable, s.cell, {pick("w.lo", "s.cell", "w.lo")}, {pick("s.cell", "s.cell", "w.hi")},
    {pick(_caught(merged), "s.c", "w.c")}, {pick(_share(merged), "s.r", "w.r")}
  from runs w join single s on s.checkpoint=w.checkpoint and s.variable=w.variable and s.cell=w.cell+1, lim)
, spans as (select r.*, cuts from (select * from runs where lo is not null
    qualify row_number() over (partition by checkpoint, variable, lo order by cell desc) = 1) r join cuts using (checkpoint, variable))
, steps as materialized (select t.checkpoint, t.variable, place, value, h, cast(1 as bigint) << (place-1) as bit,
    {_caught("cast(1 as bigint) << (place-1)")} as c, {_share("cast(1 as bigint) << (place-1)")} as r,
    n_acct > 1 and value not in ('NULL', 'UNKNOWN', 'None') as may
  from strings t join hist using (checkpoint, variable))
, merging as (
  select checkpoint, variable, cast(0 as bigint) as place, cast([] as struct(m bigint, c double, r double)[]) as bins from hist where kind = 'string'
  union all
  select checkpoint, variable, place, case when not (may and r > br and c > blk) then bins
    when len(bins) = 0 or not {_close("r", "(bins[near]).r", cutoff)} then list_append(bins, struct_pack(m := bit, c := c, r := r))
    else [case when i = near then struct_pack(m := {mask}, c := {_caught(mask)}, r := {_share(mask)}) else bins[i] end
      for i in range(1, len(bins)+1)] end
  from (select s.*, bins, list_position([abs(b.r - s.r) for b in bins], list_min([abs(b.r - s.r) for b in bins])) as near
    from merging w join steps s on s.checkpoint=w.checkpoint and s.variable=w.variable and s.place=w.place+1), lim)
, bins as (select checkpoint, variable, b.m as s, b.c as c, b.r as r from (select checkpoint, variable, unnest(bins) as b from merging
  qualify rank() over (partition by checkpoint, variable order by place desc) = 1))
, conds as materialized (
  select checkpoint, variable, variable || '>' || {NUM.format(x="cuts[place]")} as text, s, c, r from ups, lim where r > br and c > sup
  union all select checkpoint, variable, variable || '<=' || {NUM.format(x="cuts[place]")}, s, c, r from downs, lim where r > br and c > sup
  union all select checkpoint, variable, case when lo = 0 then variable || '<=' || {NUM.format(x="cuts[hi+1]")}
      when hi = len(cuts) then variable || '>' || {NUM.format(x="cuts[lo]")}
      else variable || '>' || {NUM.format(x="cuts[lo]")} || ' and ' || variable || '<=' || {NUM.format(x="cuts[hi+1]")} end,
    (cast(1 as bigint) << (hi+1)) - (cast(1 as bigint) << lo), c, r from spans, lim where c >= sup and r >= br
  union all select b.checkpoint, b.variable, b.variable || ' in (' || string_agg('"' || value || '"', ',' order by place) || ')', s, b.c, b.r
    from bins b join steps t on t.checkpoint=b.checkpoint and t.variable=b.variable and (b.s & t.bit) <> 0, lim
    where b.c >= sup group by b.checkpoint, b.variable, s, b.c, b.r
  union all select checkpoint, variable, variable || '=True', 1, {_caught("1")}, {_share("1")} from hist, lim
    where kind = 'bool' and {_caught("1")} >= sup and {_share("1")} >= br)"""


def _trees() -> str:
    meets = "len([y for y in x.ms if (y & (nd.m | bit)) = (nd.m | bit)]) > 0"
    tried = (f"[struct_pack(c := cast(coalesce(list_sum([x.a for x in h if {meets}]), 0) as double), "
             f"b := coalesce(list_sum([x.b for x in h if {meets}]), 0)) for nd in nodes]")
    return f"""
, placed as materialized (select c.*, priority, score, cp_score, row_number() over (partition by checkpoint order by priority, c desc, text) - 1 as place
  from conds c join prio using (checkpoint, variable))
, rowmask as materialized (select rid, x.checkpoint, key, acct, tag, bit_or(cast(1 as bigint) << place) as mask
  from cells x join placed p on p.checkpoint=x.checkpoint and p.variable=x.variable and (p.s & (cast(1 as bigint) << cell)) <> 0 group by all)
, sigs as materialized (select checkpoint, list(struct_pack(ms := ms, a := a, b := b)) as h from (
    select checkpoint, ms, sum(case when tag=1 then 1 else 0 end) as a, sum(case when tag in (0,1) then 1 else 0 end) as b
    from (select checkpoint, key, max(tag) as tag, list_sort(list(distinct mask)) as ms from rowmask group by all) group by all) group by all)
, growing as (
  select checkpoint, cast(0 as bigint) as place, [struct_pack(m := cast(0 as bigint), c := c, r := r, f := {fscore_sql("r", "(c/n)")},
      p := cast(-1 as bigint))] as nodes from cpk, lim where checkpoint in (select checkpoint from placed)
  union all
  select checkpoint, place + 1, case when best is not null and (t[best]).r - (nodes[best]).r > case priority when 1 then 0
      when 2 then case when len(k) > 0 then 0.1 else 0.05 end else case when len(k) > 0 then 0.15 else 0.1 end end
    then list_append(nodes, struct_pack(m := (nodes[best]).m | bit, c := (t[best]).c, r := (t[best]).r, f := (t[best]).f, p := (nodes[best]).m))
    else nodes end
  from (select *, rivals[list_position([(t[i]).f for i in rivals], list_max([(t[i]).f for i in rivals]))] as best from (
    select *, case when len(k) > 0 then k else [i for i in range(1, len(nodes)+1) if (t[i]).r > (nodes[i]).r and (t[i]).c >= sup] end as rivals from (
      select *, [i for i in range(1, len(nodes)+1) if (t[i]).r > (nodes[i]).r and (t[i]).c > 0.8*(nodes[i]).c] as k from (
        select checkpoint, place, priority, bit, nodes, sup, [struct_pack(c := x.c, r := x.r, f := {fscore_sql("x.r", "(x.c/n)")}) for x in
            [struct_pack(c := x.c, r := round(x.c/(x.b+0.0001), 10)) for x in {tried}]] as t
        from (select w.checkpoint, w.place, w.nodes, p.priority, cast(1 as bigint) << p.place as bit, g.h, n, sup
          from growing w join placed p on p.checkpoint=w.checkpoint and p.place=w.place join sigs g on g.checkpoint=w.checkpoint, lim))))))
, nodes as (select checkpoint, unnest(nodes) as nd from growing qualify rank() over (partition by checkpoint order by place desc) = 1)
, cands as materialized (select row_number() over (order by checkpoint, m) as cand, checkpoint, m, 'checkpoint="' || checkpoint || '"' || atoms as text,
    c, r, score, ['checkpoint="' || checkpoint || '"'] || listed as parts
  from (select checkpoint, nd.m as m, nd.c as c, nd.r as r from nodes a where nd.p >= 0
      and not exists (select 1 from nodes b where b.checkpoint=a.checkpoint and b.nd.p=a.nd.m)) l
  join (select l.checkpoint, l.nd.m as m, string_agg(chr(6) || text, '' order by place) as atoms, list(text order by place) as listed,
      any_value(cp_score) + avg(score) as score
    from nodes l join placed p on p.checkpoint=l.checkpoint and (l.nd.m & (cast(1 as bigint) << place)) <> 0 group by all) using (checkpoint, m))"""


def _patterns(p: SearchParams) -> str:
    levels = []
    for k in range(1, p.lvl_limit + 1):
        names = [f"l{i}" for i in range(k)]
        joins = " ".join(f"join lists {x} on {x}.key=l0.key and {x}.acct=l0.acct and {x}.cand>{y}.cand" for y, x in zip(names, names[1:]))
        apart = " and ".join(f"{x}.checkpoint<>{y}.checkpoint" for i, x in enumerate(names) for y in names[:i]) or "true"
        listed = "[" + ", ".join(f"{x}.cand" for x in names) + "]"
        levels.append(f"select {listed} as items, count(*) as support from lists l0 {joins}, lim where {apart} group by {listed}, sup having count(*) >= sup")
    rate = "sum(t)/(sum(lab)+0.0001)"
    overlap = "len(list_intersect(k, o.parts)) / len(list_distinct(list_concat(k, o.parts)))"
    return f"""
, chits as materialized (select distinct key, acct, tag, cand, c.checkpoint from rowmask r join cands c on c.checkpoint=r.checkpoint and (r.mask & c.m) = c.m)
, lists as materialized (select distinct key, acct, cand, checkpoint from chits where tag=1)
, sets as materialized (select row_number() over () as sid, items, support from ({" union all ".join(levels)}))
, met as materialized (select sid, key from (select sid, len(items) as size, unnest(items) as cand from sets)
  join (select distinct key, cand from chits) using (cand) group by sid, key, size having count(*) = size)
, people as (select *, case when tag=1 then 1 else 0 end as t, case when tag in (0,1) then 1 else 0 end as lab from population)
, good as materialized (select sid, items, sum(t) as hit, {rate} as rate, {fscore_sql(rate, "(sum(t)/any_value(n))")} as f
  from sets join met using (sid) join people using (key), lim group by sid, items having {rate} >= {p.eval_cutoff})
, smallest as (select * from good a where not exists (select 1 from good b where len(b.items) >= 2 and len(b.items) < len(a.items)
    and list_has_all(a.items, b.items)))
, described as (select sid, any_value(hit) as hit, any_value(rate) as rate, any_value(f) as f, list(c.text order by c.text) as texts, round(sum(c.score), 9) as score,
    string_agg(c.checkpoint, '-' order by c.text) as cp_str, list_distinct(flatten(list(c.parts))) as parts
  from (select *, unnest(items) as cand from smallest) s join cands c using (cand) group by sid)
, named as materialized (select *, 'pattr_lvl' || len(texts) || '_' || (row_number() over (partition by len(texts) order by texts) - 1) as name,
    row_number() over (partition by cp_str order by rate desc, score desc, array_to_string(texts, chr(7))) as place from described)
, unlike as (select cp_str, place, sid, [parts] as kept, true as taken from named where place = 1
  union all select cp_str, place, sid, case when ok then list_append(kept, parts) else kept end, ok from (
    select o.cp_str, o.place, o.sid, o.parts, w.kept, coalesce(list_max([{overlap} for k in w.kept]), 0) <= {p.overlap} as ok
    from unlike w join named o on o.cp_str=w.cp_str and o.place=w.place+1))
, final as materialized (select d.*, row_number() over (order by rate desc, score desc, name) as rnk
  from named d where sid in (select sid from unlike where taken))
, held as materialized (select p.rid, f.rnk from (select row_number() over () as rid, * from population where tag=1) p
  join met using (key) join final f using (sid))
, first as (select rnk, cast(count(*) as double) as c from (select rid, min(rnk) as rnk from held group by rid) group by rnk)
, living as (select f.rnk from final f join first using (rnk), lim where c/n > {p.dedup_cutoff})
, second as (select rnk, cast(count(*) as double) as c from (select rid, min(rnk) as rnk from held semi join living using (rnk) group by rid) group by rnk)
, done as (select f.*, l.rnk is not null as lives, coalesce(case when l.rnk is null then a.c else b.c end, 0) as inc,
    coalesce(case when l.rnk is null then a.c else b.c end, 0)/n as share
  from final f left join living l using (rnk) left join first a using (rnk) left join second b using (rnk), lim)"""


def whole_sql(domain: Domain, params: SearchParams, result: str) -> str:
    return f"with recursive {domain.tables}{_inputs(domain, params)}{_univariate(params)}{_trees()}{_patterns(params)}{result}"


ORDERS_TABLES = F1_CTE
USER_DAYS_TABLES = """
stream as (select *, user_id || '|' || strftime(ts, '%Y-%m-%d') as key, cast(json_extract_string(props, '$.k') as double) as k from events),
population as (select key, cast(min(user_id) as varchar) as acct, min(ts) as ts, max(case when (event_type='error' and value>60)
    or (event_type='purchase' and k<20) then 1 else 0 end) as tag, round(sum(value), 2) as amt from stream group by key),
activity as (select s.key, p.acct, p.tag, p.amt, event_type as checkpoint, s.ts as "timestamp", event_id, value as value_amount, k,
    cast(hour(s.ts) as double) as hour from stream s join population p using (key))"""

STAGES = """
, texts as (select sid, string_agg(text, chr(7) order by text) as content from (select sid, unnest(items) as cand from sets) join cands using (cand) group by sid)
, measured as (select sid, sum(t) as hit, sum(t)/(sum(lab)+0.0001) as rate from met join people using (key) group by sid)
, noted as (
  select 'condition' as stage, 'checkpoint="' || checkpoint || '"' || chr(6) || text as content, c as catch, r as rate from conds
  union all select 'leaf', text, c, r from cands
  union all select 'set', content, support, null from sets join texts using (sid)
  union all select 'measured', content, coalesce(hit, 0), coalesce(rate, 0) from texts left join measured using (sid)
  union all select 'kept', array_to_string(texts, chr(7)), hit, rate from done
  union all select 'ranked', array_to_string(texts, chr(7)), inc, share from done where lives)
select stage, replace(replace(content, chr(6), ' & '), chr(7), ' | ') as content, round(cast(catch as double), 4) as catch, round(rate, 6) as rate from noted"""

RANKED = """
select cast(row_number() over (order by rnk) as integer) as place, name as pattr_name,
  replace(array_to_string(texts, ' | '), chr(6), ' & ') as pattr_content, cp_str, round(cast(hit as double), 4) as target_catch,
  round(rate, 6) as target_rate, round(f, 6) as pattr_fscore, round(score, 6) as pattr_score, round(inc, 4) as inc_catch,
  round(share, 6) as inc_catch_share from done where lives"""
