"""Trees, combination search, pattern selection and the whole mining job."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from lodeseam.conditions import Condition, Flag, InSet, Range, pattern_text
from lodeseam.config import RANKINGS
from lodeseam.operators import combine, measure, select
from lodeseam.operators.trees import (MaskTable, Node, Scored, best_parent, grow_trees, leaf_table,
                                      to_condition)
from lodeseam.plans.mining import mine
from lodeseam.session import tuned
from lodeseam.sources import results

from . import fixtures as fx
from . import whole
from .catalog import BASE_SQL, f1, fscore_sql, measure_sql, query, r4, r6
from .measuring import CNT, PEOPLE, RATES, SUMS, WHOLE, kpis, metrics_sql

# ---- refinement ---------------------------------------------------------------------------------

LISTED = {
    "R": [(Range("disc_score", lo=7), "disc_score>7", 1), (Range("qty", lo=30), "qty>30", 1),
          (Flag("line_open"), "line_open", 2), (InSet("p_type", ("PROMO", "SMALL")),
                                                "p_type in ('PROMO','SMALL')", 3)],
    "A": [(Range("tax_pct", lo=6), "tax_pct>6", 1), (Flag("line_open"), "line_open", 1),
          (Range("qty", lo=30), "qty>30", 3)],
    "N": [(InSet("p_type", ("PROMO",)), "p_type='PROMO'", 1), (Range("qty", lo=30), "qty>30", 2)],
}


def listed_masks(activity) -> MaskTable:
    """The mask table over the listed conditions, each with its own measured figures."""
    return masks_and_figures(activity)[0]


def masks_and_figures(activity, also: tuple[Condition, ...] = ()) -> tuple[MaskTable, list[tuple[float, float]]]:
    """The same with the (catch, rate) of other conditions, which are measured in the same pass."""
    flat = [(cp, atom, p) for cp, rows in LISTED.items() for atom, _, p in rows]
    got = {r.test_id: r for r in measure.measure_conditions(
        activity, [*[Condition(cp, (a,)) for cp, a, _ in flat], *also], CNT).collect()}
    conditions: dict[str, list[Scored]] = {}
    for i, (cp, atom, p) in enumerate(flat):
        conditions.setdefault(cp, []).append(
            Scored(atom, got[i].target_catch, got[i].target_rate, p))
    figures = [(got[len(flat) + i].target_catch, got[len(flat) + i].target_rate) for i in range(len(also))]
    return MaskTable(activity, conditions, CNT), figures


# one fixed round: nodes of checkpoint R are the root and disc_score>7; each candidate is tried
ROUND = [(g, n, atoms, cond, node, p)
         for g, (extra, cond, p) in enumerate([((1,), "qty>30", 1), ((2,), "line_open", 2),
                                               ((3,), "p_type in ('PROMO','SMALL')", 3)])
         for n, (atoms, node) in enumerate([(extra, "true"), ((0, *extra), "disc_score>7")])]


@query("refine_round", f1(", " + BASE_SQL + """
, m as (""" + " union all ".join(
    f"select {g} as group_id, {n} as node_id, {p} as priority, nt.target_catch as node_catch, "
    f"nt.target_rate as node_rate, t.target_catch, t.target_rate from "
    f"({measure_sql(f'checkpoint=$$R$$ and {node}')}) nt, "
    f"({measure_sql(f'checkpoint=$$R$$ and {node} and {cond}')}) t"
    for g, n, _, cond, node, p in ROUND) + f""")
, s as (select m.*, {fscore_sql('target_rate', '(target_catch/n)')} as f, target_rate-node_rate as gain,
    target_catch > 0.8*node_catch and target_rate > node_rate as keeps, n from m, base)
, c as (select *, max(cast(keeps as int)) over (partition by group_id) = 1 as any_keeps from s)
, best as (select * from c where keeps or (not any_keeps and target_catch >= 0.03*n and gain > 0)
  qualify row_number() over (partition by group_id order by f desc, node_id) = 1)
select group_id, node_id, target_catch, target_rate, round(f,6) as fscore from best
where gain > case priority when 1 then 0 when 2 then case when keeps then 0.1 else 0.05 end
  else case when keeps then 0.15 else 0.1 end end""").replace("$$", "'"))
def refine_round(spark, sf):
    limits = measure.thresholds(fx.held_people(spark, sf), fx.F1).first()
    used = sorted({atom.variable for listed in LISTED.values() for atom, _, _ in listed})
    with tuned(spark):
        activity = fx.in_key_order(fx.activity(spark, sf), used)
        masks, figures = masks_and_figures(activity, (Condition("R"), fx.C1))
    nodes = [Node("R", (), *figures[0], 0.0), Node("R", (0,), *figures[1], 0.0, 0)]
    with tuned(spark):
        results = masks.measure([("R", atoms) for _, _, atoms, _, _, _ in ROUND])
    masks.release()
    activity.unpersist()
    rows = []
    for group in sorted({g for g, *_ in ROUND}):
        tried = [(nodes[n], *r) for (g, n, *_), r in zip(ROUND, results) if g == group]
        priority = next(p for g, *_, p in ROUND if g == group)
        found = best_parent(tried, priority, limits.sup_n, limits.total_catch)
        if found:
            rows.append((group, nodes.index(found[0]), *found[1:]))
    return spark.createDataFrame(rows, "group_id int, node_id int, target_catch double, "
                                 "target_rate double, fscore double").select(
        "group_id", "node_id", *kpis(), r6("fscore"))


def grown(spark, sf):
    population, activity = fx.cached(spark, sf)
    limits = measure.thresholds(population, fx.F1).first()
    masks = listed_masks(activity)
    cps = list(LISTED)
    got = {r.test_id: r for r in measure.measure_conditions(
        activity, [Condition(cp) for cp in cps], CNT).collect()}
    roots = {cp: (got[i].target_catch, got[i].target_rate) for i, cp in enumerate(cps)}
    nodes = grow_trees(masks, roots, limits.sup_n, limits.total_catch)
    masks.release()
    return masks, nodes


def trees_sql() -> str:
    """All conjunctions of a checkpoint's atoms are measured; the growth is a walk over the atoms
    in insertion order that carries the list of nodes (m = atoms as bits, p = parent's bits)."""
    atoms = ", ".join(f"('{cp}', {k}, '{cp}{i}', '{atom.text.replace(chr(39), chr(39) * 2)}', {p})"
                      for k, (cp, rows) in enumerate(LISTED.items()) for i, (atom, _, p) in enumerate(rows))
    flags = " union all ".join(
        f"select checkpoint, key, tag, line_no, part_no, \"timestamp\", '{cp}{i}' as atom, "
        f"coalesce({cond}, false) as met from activity where checkpoint='{cp}'"
        for cp, rows in LISTED.items() for i, (_, cond, _) in enumerate(rows))
    return f1(", " + BASE_SQL + f"""
, atoms(checkpoint, cp_place, atom, text, priority) as (values {atoms})
, flags as materialized ({flags})
, alone as (select atom, sum(case when tag=1 then 1 else 0 end) as catch from
    (select atom, key, max(tag) as tag from flags where met group by all) group by atom)
, placed as (select a.*, row_number() over (partition by a.checkpoint order by priority, catch desc, text) as place
  from atoms a join alone using (atom))
, rowmask as (select f.checkpoint, key, tag, sum(case when met then 1 << (place-1) else 0 end)::bigint as mask
  from flags f join placed using (atom) group by f.checkpoint, key, tag, line_no, part_no, "timestamp")
, conj as (select checkpoint, s, cast(sum(case when tag=1 then 1 else 0 end) as double) as c,
    round(sum(case when tag=1 then 1 else 0 end)/(sum(case when tag in (0,1) then 1 else 0 end)+0.0001),10) as r
  from (select checkpoint, s, key, max(tag) as tag from rowmask, (select unnest(range(0, 16)) as s)
    where mask & s = s group by all) group by all)
, every as (select checkpoint, s, coalesce(c, 0) as c, coalesce(r, 0) as r, {fscore_sql("coalesce(r,0)", "(coalesce(c,0)/n)")} as f
  from (select checkpoint, unnest(range(0, 16)) as s from (select distinct checkpoint from atoms))
  left join conj using (checkpoint, s), base)
, table_of as (select checkpoint, list(struct_pack(m := cast(s as bigint), c := c, r := r, f := f,
    p := cast(-1 as bigint)) order by s) as u from every group by checkpoint)
, walk as (
  select checkpoint, 0 as place, [u[1]] as nodes from table_of
  union all
  select checkpoint, place, case when gain > needed then list_append(nodes, struct_pack(
      m := u[slot].m, c := u[slot].c, r := u[slot].r, f := u[slot].f, p := from_m)) else nodes end from (
    select *, (nodes[best]).m as from_m, ((nodes[best]).m | bit) + 1 as slot, u[((nodes[best]).m | bit) + 1].r - (nodes[best]).r as gain,
      case priority when 1 then 0 when 2 then case when len(k) > 0 then 0.1 else 0.05 end
        else case when len(k) > 0 then 0.15 else 0.1 end end as needed from (
      select *, rivals[list_position([u[((nodes[i]).m | bit) + 1].f for i in rivals],
          list_max([u[((nodes[i]).m | bit) + 1].f for i in rivals]))] as best from (
        select *, case when len(k) > 0 then k else [i for i in range(1, len(nodes)+1)
            if u[((nodes[i]).m | bit) + 1].r > (nodes[i]).r and u[((nodes[i]).m | bit) + 1].c >= sup_n] end as rivals from (
          select *, [i for i in range(1, len(nodes)+1) if u[((nodes[i]).m | bit) + 1].r > (nodes[i]).r
              and u[((nodes[i]).m | bit) + 1].c > 0.8 * (nodes[i]).c] as k from (
            select a.checkpoint, a.place, a.priority, cast(1 << (a.place-1) as bigint) as bit, nodes, u, 0.03*n as sup_n
            from walk w join placed a on a.checkpoint=w.checkpoint and a.place=w.place+1
            join table_of t on t.checkpoint=w.checkpoint, base))))))
, grown as (select checkpoint, unnest(nodes) as node from walk
  qualify row_number() over (partition by checkpoint order by place desc) = 1)
, numbered as (select g.checkpoint, node.m as m, node.p as p, node.c as c, node.r as r, node.f as f,
    cast(row_number() over (order by len(bin(node.m)) * (case when node.m = 0 then 0 else 1 end), cp_place) - 1 as integer) as id
  from grown g join (select distinct checkpoint, cp_place from atoms) using (checkpoint))
select x.id as node_id, y.id as parent_id, x.checkpoint, 'checkpoint="' || x.checkpoint || '"' || coalesce((
    select string_agg(chr(6) || text, '' order by place) from placed a
    where a.checkpoint=x.checkpoint and x.m & (1 << (a.place-1)) <> 0), '') as content,
  round(x.c,4) as target_catch, round(x.r,6) as target_rate, round(x.f,6) as fscore
from numbered x left join numbered y on y.checkpoint=x.checkpoint and y.m=x.p""", recursive=True)


@query("condition_trees", trees_sql())
def condition_trees(spark, sf):
    masks, nodes = grown(spark, sf)
    rows = [(i, n.parent, n.checkpoint, to_condition(masks, n).text, n.catch, n.rate, n.fscore)
            for i, n in enumerate(nodes)]
    return spark.createDataFrame(
        rows, "node_id int, parent_id int, checkpoint string, content string, "
        "target_catch double, target_rate double, fscore double").select(
        "node_id", "parent_id", "checkpoint", "content", *kpis(), r6("fscore"))


# a fixed tree over measured nodes: each (node, parent) and its condition
TREE = [(0, None, "R", "checkpoint='R'"), (1, 0, "R", "checkpoint='R' and disc_score>7"),
        (2, 1, "R", "checkpoint='R' and disc_score>7 and qty>30"),
        (3, 0, "R", "checkpoint='R' and qty>40"), (4, None, "N", "checkpoint='N'")]


@query("leaf_candidates", f1(" , t as (" + " union all ".join(
    measure_sql(cond, head=f"{i} as node_id, {'null' if p is None else p} as parent_id, "
                           f"'{cp}' as checkpoint, ") for i, p, cp, cond in TREE)
    + """) select node_id, checkpoint, target_catch, target_rate from t
where parent_id is not null and node_id not in (select parent_id from t where parent_id is not null)"""))
def leaf_candidates(spark, sf):
    conditions = [Condition("R"), fx.C1, fx.R1, fx.C2, Condition("N")]
    measured = measure.measure_conditions(fx.activity(spark, sf), conditions, CNT)
    tree = spark.createDataFrame([(i, p, cp) for i, p, cp, _ in TREE],
                                 "node_id int, parent_id int, checkpoint string")
    nodes = tree.join(measured.withColumnRenamed("test_id", "node_id"), "node_id")
    return leaf_table(nodes).select("node_id", "checkpoint", *kpis())


# ---- combination ---------------------------------------------------------------------------------

ITEMS = [(fx.C1, "checkpoint='R' and disc_score>7"), (fx.C2, "checkpoint='R' and qty>40"),
         (fx.C3, "checkpoint='A' and tax_pct>6"), (fx.C4, "checkpoint='N' and p_type='PROMO'"),
         (Condition("A", (Flag("line_open"),)), "checkpoint='A' and line_open"),
         (Condition("N", (Range("qty", lo=45),)), "checkpoint='N' and qty>45"),
         (Condition("R", (InSet("p_type", ("SMALL",)),)), "checkpoint='R' and p_type='SMALL'"),
         (Condition("A", (Range("days_to_ship", hi=7),)), "checkpoint='A' and days_to_ship<=7"),
         (Condition("N", (Range("disc_score", lo=9),)), "checkpoint='N' and disc_score>9"),
         (Condition("R", (InSet("p_brand", ("Brand#7",)),)), "checkpoint='R' and p_brand='Brand#7'")]
CPS = [c.checkpoint for c, _ in ITEMS]
N_ITEMS = len(ITEMS)

HITS_SQL = """
, hits as (select key, acct, item, max(amt) as amt from (select key, acct, amt, unnest([{cases}]) as item
  from activity where tag=1) where item is not null group by all)
, cps as (select unnest(range(0, {n})) as item, unnest([{cps}]) as checkpoint)
, lists as (select key, acct, item, greatest(max({w}) over (partition by key, acct), 0.01) as weight from hits)
""".format(cases=", ".join(f"case when {sql} then {i} end" for i, (_, sql) in enumerate(ITEMS)),
           n=N_ITEMS, cps=", ".join(f"'{c}'" for c in CPS), w="{w}")


def hits_sql(metric: str = CNT) -> str:
    return HITS_SQL.replace("{w}", "1.0" if metric == CNT else "amt")


def lists_of(spark, sf, metric=CNT):
    """Item lists of the outcome keys over the fixed candidates."""
    activity = fx.activity(spark, sf)
    ids = measure.matching_ids([c for c, _ in ITEMS])
    some = reduce(or_, [c.column() for c, _ in ITEMS])  # reaches the join: other rows decide nothing
    hits = activity.where(some).select("key", "acct", "tag", "amt", F.explode(ids).alias("test_id"))
    return combine.item_lists(hits, metric, 0.01, N_ITEMS)


@query("key_pattern_weights", f1(hits_sql("target_amt") + """
select key, acct, string_agg(cast(item as varchar), ',' order by item) as items,
  round(any_value(weight),4) as weight from lists group by key, acct"""))
def key_pattern_weights(spark, sf):
    return lists_of(spark, sf, "target_amt").select(
        "key", "acct", F.array_join("items", ",").alias("items"), r4("weight"))


FREQ = ", freq as (select checkpoint, l.item, sum(weight) as weight from lists l join cps c on l.item=c.item group by all)"


@query("pattern_frequency", f1(hits_sql() + FREQ + """
select checkpoint, cast(item as integer) as item, round(cast(weight as double),4) as weight from freq"""))
def pattern_frequency(spark, sf):
    return combine.item_frequency(lists_of(spark, sf), CPS).select(
        "checkpoint", "item", r4("weight"))


@query("capped_itemlists", f1(hits_sql() + FREQ + """
, counted as (select l.*, f.checkpoint, f.weight as freq,
    count(*) over (partition by key, acct) as held from lists l join freq f on l.item=f.item)
, ranked as (select *, row_number() over (partition by key, acct, checkpoint
    order by freq desc, item) as place from counted)
select key, acct, string_agg(cast(item as varchar), ',' order by item) as items from ranked
where held <= 4 or place <= 1 group by key, acct"""))
def capped_itemlists(spark, sf):
    lists = lists_of(spark, sf)
    order = combine.frequency_order(combine.item_frequency(lists, CPS), N_ITEMS)
    short = combine.shorten(F.col("items"), CPS, order, long_list=4, per_checkpoint=1)
    return lists.select("key", "acct", F.array_join(F.array_sort(short), ",").alias("items"))


SUP = ", sup as (select 0.03*n as sup_n from base)"


def level_select(k: int) -> str:
    names = [f"l{i}" for i in range(k)]
    joins = " ".join(f"join lists {x} on {x}.key=l0.key and {x}.acct=l0.acct and {x}.item>{p}.item"
                     for p, x in zip(names, names[1:]))
    cps = " ".join(f"join cps c{i} on c{i}.item=l{i}.item" for i in range(k))
    apart = " and ".join(f"c{i}.checkpoint<>c{j}.checkpoint" for i in range(k) for j in range(i)) or "true"
    shown = " || ',' || ".join(f"l{i}.item" for i in range(k))
    return f"""
select cast({shown} as varchar) as items, round(cast(sum(l0.weight) as double),4) as support
from lists l0 {joins} {cps}, sup where {apart} group by 1, sup_n having sum(l0.weight) >= sup_n"""


def level_sql(k: int) -> str:
    return f1(", " + BASE_SQL + SUP + hits_sql() + level_select(k))


def level(spark, sf, k):
    sets = combine.weighted_sets(lists_of(spark, sf)).persist()
    sup_n = measure.thresholds(fx.population(spark, sf), fx.F1).first().sup_n
    found = combine.frequent_sets(sets, CPS, sup_n, k)
    sets.unpersist()
    return spark.createDataFrame([(",".join(map(str, s)), w) for s, w in found.items() if len(s) == k],
                                 "items string, support double").select("items", r4("support"))


@query("itemsets_l1", level_sql(1))
def itemsets_l1(spark, sf):
    return level(spark, sf, 1)


@query("itemsets_l2", level_sql(2))
def itemsets_l2(spark, sf):
    return level(spark, sf, 2)


@query("itemsets_l3", level_sql(3))
def itemsets_l3(spark, sf):
    return level(spark, sf, 3)


def all_levels_sql(limit: int) -> str:
    """The sets of all levels; the best supported ones stay."""
    levels = " union all ".join(f"select {k} as size, * from ({level_select(k)})" for k in (1, 2, 3))
    return f1(", " + BASE_SQL + SUP + hits_sql() + f""", found as ({levels})
select items, support from (select *, [cast(i as integer) for i in string_split(items, ',')] as s from found)
qualify row_number() over (order by support desc, size, s) <= {limit}""")


@query("capped_sets", all_levels_sql(12))
def capped_sets(spark, sf):
    """The search that the parameters name, and its best supported sets."""
    lists = lists_of(spark, sf).persist()
    sup_n = measure.thresholds(fx.population(spark, sf), fx.F1).first().sup_n
    found = combine.combine(lists, CPS, sup_n, fx.F1)
    lists.unpersist()
    kept, was_cut = combine.cap_sets(found.sets, 12)
    assert found.mode == "itemsets" and was_cut == (len(found.sets) > 12)
    return spark.createDataFrame([(",".join(map(str, s)), w) for s, w in kept.items()],
                                 "items string, support double").select("items", r4("support"))


# the graph is drawn at a higher support, so that it falls into several components
EDGE_SHARE = 0.135
GRAPH_SQL = """, esup as (select {share}*n as sup_n from base)
, bykey as (select key, item, max(weight) as weight from (select key, item,
    max(weight) over (partition by key) as weight from lists) group by all)
, nodes as (select item, cast(sum(weight) as double) as size from bykey group by item)
, edges as (select a.item as a, b.item as b, cast(sum(a.weight) as double) as shared,
    any_value(na.size) as sa, any_value(nb.size) as sb
  from bykey a join bykey b on a.key=b.key and a.item<b.item
  join nodes na on na.item=a.item join nodes nb on nb.item=b.item, esup
  group by a.item, b.item, sup_n having sum(a.weight) >= sup_n)
, links as (select a, b from edges union all select b, a from edges)
, reach(item, other) as (select item, item from nodes union
  select r.item, l.b from reach r join links l on r.other=l.a)
, comps as (select item, min(other) as component from reach group by item)"""


def graph_sql(body: str, share: float = EDGE_SHARE) -> str:
    return f1(", " + BASE_SQL + hits_sql() + GRAPH_SQL.format(share=share) + body, recursive=True)


def graph(spark, sf):
    """(sets, nodes, edges) of the co-occurrence graph over the fixed candidates."""
    sets = combine.key_sets(lists_of(spark, sf)).persist()
    total = measure.baseline(fx.population(spark, sf), CNT).first().total_catch
    nodes, edges = combine.cooccurrence(combine.pair_support(sets, N_ITEMS).persist(),
                                        EDGE_SHARE * total)
    return sets, nodes, edges, EDGE_SHARE * total


@query("cooccurrence_nodes", graph_sql(
    " select cast(item as integer) as item, round(size,4) as size from nodes"))
def cooccurrence_nodes(spark, sf):
    return graph(spark, sf)[1].select("item", r4("size"))


@query("cooccurrence_edges", graph_sql(""" select cast(a as integer) as a, cast(b as integer) as b,
 round(shared,4) as shared, round(shared/(sa+sb-shared),2) as weight from edges"""))
def cooccurrence_edges(spark, sf):
    return graph(spark, sf)[2].select("a", "b", r4("shared"), "weight")


@query("pattern_components", graph_sql(
    " select cast(item as integer) as item, cast(component as integer) as component from comps"))
def pattern_components(spark, sf):
    _, nodes, edges, _ = graph(spark, sf)
    return combine.components(nodes, edges)


@query("walk_seeds", graph_sql(""" select cast(component as integer) as component,
 cast(item as integer) as item from comps
 qualify count(*) over (partition by component) > 2"""))
def walk_seeds(spark, sf):
    _, nodes, edges, _ = graph(spark, sf)
    return combine.walk_seeds(combine.components(nodes, edges), edges, 300)


@query("small_component_sets", graph_sql("""
, sized as (select *, count(*) over (partition by component) as n_items from comps)
select cast(s.item as varchar) as items, round(size,4) as support from sized s
  join nodes n on n.item=s.item where n_items = 1
union all select a || ',' || b, round(shared,4) from edges join sized s on s.item=a where n_items = 2"""))
def small_component_sets(spark, sf):
    _, nodes, edges, _ = graph(spark, sf)
    return combine.small_component_sets(combine.components(nodes, edges), nodes, edges).select(
        F.array_join("items", ",").alias("items"), r4("support"))


@query("node_edge_sets", graph_sql("""
select cast(item as varchar) as items, round(size,4) as support from nodes
union all select a || ',' || b, round(shared,4) from edges"""))
def node_edge_sets(spark, sf):
    _, nodes, edges, _ = graph(spark, sf)
    return combine.node_edge_sets(nodes, edges).select(
        F.array_join("items", ",").alias("items"), r4("support"))


@query("greedy_step", graph_sql("""
, moves as (select l.a as seed, l.b as next, sum(x.weight) as support from links l
  join cps ca on ca.item=l.a join cps cb on cb.item=l.b
  join bykey x on x.item=l.a join bykey y on y.item=l.b and y.key=x.key, esup
  where ca.checkpoint<>cb.checkpoint group by l.a, l.b, sup_n having sum(x.weight) > sup_n)
select cast(seed as integer) as seed, cast(next as integer) as next,
  round(cast(support as double),4) as support from moves
qualify row_number() over (partition by seed order by support desc, next) = 1"""))
def greedy_step(spark, sf):
    sets, nodes, edges, sup_n = graph(spark, sf)
    walks = [(i,) for i in range(N_ITEMS)]
    moves = combine.walk_step(sets, walks, list(range(N_ITEMS)), edges, CPS, sup_n)
    return spark.createDataFrame([(walks[w][0], item, s) for w, (item, s) in moves.items()],
                                 "seed int, next int, support double").select(
        "seed", "next", r4("support"))


@query("greedy_walks", graph_sql("""
, first as (select l.a as i0, l.b as i1, sum(x.weight) as support from links l
  join cps ca on ca.item=l.a join cps cb on cb.item=l.b
  join bykey x on x.item=l.a join bykey y on y.item=l.b and y.key=x.key, esup
  where ca.checkpoint<>cb.checkpoint group by l.a, l.b, sup_n having sum(x.weight) > sup_n
  qualify row_number() over (partition by l.a order by sum(x.weight) desc, l.b) = 1)
, second as (select f.i0, f.i1, l.b as i2, sum(x.weight) as support from first f
  join links l on l.a=f.i1 join cps c0 on c0.item=f.i0 join cps c1 on c1.item=f.i1 join cps c2 on c2.item=l.b
  join bykey x on x.item=f.i0 join bykey y on y.item=f.i1 and y.key=x.key
  join bykey z on z.item=l.b and z.key=x.key, esup
  where c2.checkpoint<>c0.checkpoint and c2.checkpoint<>c1.checkpoint
  group by f.i0, f.i1, l.b, sup_n having sum(x.weight) > sup_n
  qualify row_number() over (partition by f.i0 order by sum(x.weight) desc, l.b) = 1)
select distinct array_to_string(list_sort([i for i in [nd.item, f.i1, s.i2] if i is not null]), ',') as items,
  round(cast(coalesce(s.support, f.support, nd.size) as double),4) as support
from nodes nd left join first f on f.i0=nd.item left join second s on s.i0=nd.item""", 0.03))
def greedy_walks(spark, sf):
    sets, nodes, edges, _ = graph(spark, sf)
    sup_n = measure.thresholds(fx.population(spark, sf), fx.F1).first().sup_n
    nodes, edges = combine.cooccurrence(combine.pair_support(sets, N_ITEMS), sup_n)
    sizes = {r["item"]: r["size"] for r in nodes.collect()}
    found = combine.greedy_walks(sets, sorted(sizes), sizes, edges, CPS, sup_n, 3)
    return spark.createDataFrame([(",".join(map(str, s)), w) for s, w in found.items()],
                                 "items string, support double").select("items", r4("support"))


@query("distinct_checkpoint_sets", f1(hits_sql() + """
, held as (select key, acct, string_agg(cast(l.item as varchar), ',' order by l.item) as items,
    count(*) as n, count(distinct checkpoint) as n_cps, bool_and(checkpoint in ('A','N')) as alias_only
  from lists l join cps c on c.item=l.item group by key, acct)
select distinct items from held where n = n_cps and not (n_cps > 1 and alias_only)"""))
def distinct_checkpoint_sets(spark, sf):
    """Distinct candidate sets held by keys, with A and N declared names of one activity."""
    cps = F.array(*[F.lit(c) for c in CPS])
    sets = combine.weighted_sets(lists_of(spark, sf)).withColumn(
        "checkpoints", F.transform("items", lambda i: F.get(cps, i)))
    return combine.checkpoint_filter(sets, aliases=(frozenset({"A", "N"}),)).select(
        F.array_join("items", ",").alias("items"))


# ---- selection -----------------------------------------------------------------------------------

SETS = [(0,), (2,), (0, 2), (1, 2), (0, 3), (1, 3), (2, 3), (0, 2, 3), (1, 2, 3)]
HAS = ("has as (select key, " + ", ".join(
    f"max(case when {cond} then 1 else 0 end) as c{i}" for i, (_, cond) in enumerate(ITEMS))
    + " from activity group by key)")
MEASURED_SQL = PEOPLE + ", " + HAS + ", measured as (" + " union all ".join(
    f"select {i} as pattern_id, '{','.join(map(str, p))}' as items, {len(p)} as level,"
    + metrics_sql(WHOLE) + " from people join has on people.key=has.key where "
    + " and ".join(f"c{j}=1" for j in p) for i, p in enumerate(SETS)) + ")"


def measured_sets(spark, sf, activity=None):
    population = fx.held_people(spark, sf)
    activity = fx.cached(spark, sf)[1] if activity is None else activity
    words = measure.key_words(activity, [c for c, _ in ITEMS])
    items = spark.createDataFrame([(i, list(s)) for i, s in enumerate(SETS)],
                                  "pattern_id int, items array<int>")
    return measure.measure_patterns(population, words, SETS, CNT).join(items, "pattern_id")


@query("qualified_patterns", f1(MEASURED_SQL + """
select items, cast(level as integer) as level, target_cnt, target_cnt_rate, pattr_fscore
from measured where target_cnt_rate >= 0.6"""))
def qualified_patterns(spark, sf):
    return measured_sets(spark, sf).where("target_cnt_rate >= 0.6").select(
        F.array_join("items", ",").alias("items"), F.size("items").alias("level"),
        r4("target_cnt"), r6("target_cnt_rate"), r6("pattr_fscore"))


@query("minimal_sets", f1(MEASURED_SQL + """
, good as (select pattern_id, string_split(items, ',') as s, items, level from measured where target_cnt_rate >= 0.5)
select items, cast(pattern_id as integer) as set_id from good a where not exists (
  select 1 from good b where b.level >= 2 and b.level < a.level and list_has_all(a.s, b.s))"""))
def minimal_sets(spark, sf):
    sets = measured_sets(spark, sf).select(
        F.col("pattern_id").alias("set_id"), "items",
        (F.col("target_cnt_rate") >= 0.5).alias("qualified"))
    return select.minimal_sets(sets).select(F.array_join("items", ",").alias("items"), "set_id")


# the distinct candidate sets that keys hold, each against every other that names the same checkpoints
@query("pattern_similarity", f1(hits_sql() + """
, held as (select list_sort(list(distinct item)) as s from lists group by key, acct)
, sets as (select s, array_to_string(list_sort(list_distinct(flatten([[c.checkpoint for c in cs if c.item = i] for i in s]))), '-') as cp_str
  from (select distinct s from held), (select list(cps) as cs from cps))
select array_to_string(a.s, ',') as a, array_to_string(b.s, ',') as b,
  round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 6) as similarity
from sets a join sets b on a.cp_str = b.cp_str and a.s < b.s and list_has_any(a.s, b.s)"""))
def pattern_similarity(spark, sf):
    cps = F.array(*[F.lit(c) for c in CPS])
    sets = lists_of(spark, sf).select("items").distinct().withColumn("cp_str", F.array_join(F.array_sort(
        F.array_distinct(F.transform("items", lambda i: F.get(cps, i)))), "-"))
    return select.similar_pairs(sets, "cp_str", "items", 0.0).select(
        F.array_join("a", ",").alias("a"), F.array_join("b", ",").alias("b"), F.round("similarity", 6).alias("similarity"))


def measured_patterns(spark, sf, activity=None):
    """Pattern objects of the fixed sets, as the driver holds them."""
    features = fx.features()
    out = []
    for r in measured_sets(spark, sf, activity).orderBy("pattern_id").collect():
        conditions = sorted((ITEMS[i][0] for i in r["items"]), key=lambda c: c.text)
        out.append(select.Pattern(f"p{r.pattern_id}", conditions, tuple(r["items"]), r.target_cnt,
                                  r.target_cnt_rate, r.pattr_fscore,
                                  select.score_of(conditions, features), {"nloss": r.nloss}))
    return out


def dissimilar_sql() -> str:
    """Patterns of a checkpoint string in order of merit, carrying the list of kept ones."""
    texts = [sorted((ITEMS[j][0] for j in s), key=lambda c: c.text) for s in SETS]
    merit = sorted(range(len(SETS)), key=lambda i: [c.text for c in texts[i]])
    rows = ", ".join("({}, {}, '{}', {}, [{}])".format(
        i, merit.index(i), "-".join(c.checkpoint for c in texts[i]),
        select.score_of(texts[i], fx.features()),
        ", ".join("'" + part + "'" for c in texts[i] for part in c.text.split(chr(6)))) for i in range(len(SETS)))
    rates = " union all ".join(
        f"select {i} as pattern_id, sum(t)/(sum(lab)+0.0001) as rate from people join has on people.key=has.key where "
        + " and ".join(f"c{j}=1" for j in p) for i, p in enumerate(SETS))
    return f1(PEOPLE + ", " + HAS + f""", rates as ({rates})
, known(pattern_id, merit, cp_str, score, parts) as (values {rows})
, ordered as (select k.*, rate, row_number() over (partition by cp_str order by rate desc, score desc, merit) as place
  from known k join rates using (pattern_id))
, walk as (select cp_str, place, [parts] as kept, true as taken, pattern_id from ordered where place = 1
  union all select cp_str, place, case when ok then list_append(kept, parts) else kept end, ok, pattern_id from (
    select o.*, w.kept, coalesce(list_max([len(list_intersect(k, o.parts))
        / len(list_distinct(list_concat(k, o.parts))) for k in w.kept]), 0) <= 0.25 as ok
    from walk w join ordered o on o.cp_str=w.cp_str and o.place=w.place+1))
select 'p' || w.pattern_id as pattr_name, w.cp_str, round(rate,6) as target_rate
from walk w join rates using (pattern_id) where taken""", recursive=True)


@query("dissimilar_patterns", dissimilar_sql())
def dissimilar_patterns(spark, sf):
    return select.drop_similar(scored_sets(spark, sf), 0.25).select("pattr_name", "cp_str", r6("target_rate"))


def scored_sets(spark, sf):
    """The measured fixed sets with their scores, and the parts of their text."""
    listed, texts = [], []
    for i, s in enumerate(SETS):
        conditions = sorted((ITEMS[j][0] for j in s), key=lambda c: c.text)
        listed += [(i, place, c.checkpoint, [a.variable for a in c.atoms]) for place, c in enumerate(conditions)]
        texts.append((i, f"p{i}", pattern_text(conditions), sorted({x for c in conditions for x in c.text.split(chr(6))})))
    features = spark.createDataFrame([(f.checkpoint, f.variable, f.priority, f.cp_priority) for f in fx.features()],
                                     "checkpoint string, variable string, priority int, cp_priority int")
    parts = spark.createDataFrame(listed, "pattern_id int, place int, checkpoint string, variables array<string>")
    named = spark.createDataFrame(texts, "pattern_id int, pattr_name string, content string, parts array<string>")
    return (measured_sets(spark, sf).join(select.pattern_scores(parts, features), "pattern_id").join(named, "pattern_id")
            .withColumns({"target_catch": F.col("target_cnt"), "target_rate": F.col("target_cnt_rate")}))


SCORE_SQL = """, parts(pattern_id, place, checkpoint, variable) as (values {rows})
, prio(checkpoint, variable, score, cp_score) as (values {prio})
, conds as (select pattern_id, place, p.checkpoint, avg(score) + any_value(cp_score) as score
  from parts p join prio r on r.checkpoint=p.checkpoint and r.variable=p.variable group by all)
, scores as (select pattern_id, sum(score) as pattr_score, string_agg(checkpoint, '-' order by place) as cp_str
  from conds group by pattern_id)"""
_W = {1: 0.5, 2: 0.2, 3: 0.1}


def _score_sql():
    rows, prio = [], [f"('{f.checkpoint}','{f.variable}',{_W[f.priority]},{_W[f.cp_priority]})"
                      for f in fx.features()]
    for i, s in enumerate(SETS):
        for place, c in enumerate(sorted((ITEMS[j][0] for j in s), key=lambda c: c.text)):
            rows += [f"({i},{place},'{c.checkpoint}','{a.variable}')" for a in c.atoms]
    return SCORE_SQL.format(rows=", ".join(rows), prio=", ".join(prio))


@query("pattern_score", f1(MEASURED_SQL + _score_sql() + """
select s.pattern_id, cp_str, round(cast(pattr_score as double),6) as pattr_score, target_cnt
from scores s join measured m on m.pattern_id=s.pattern_id"""))
def pattern_score(spark, sf):
    return scored_sets(spark, sf).select("pattern_id", "cp_str", r6("pattr_score"), r4("target_cnt"))


NAMED = {"r1": (0, 2), "r2": (2,), "r3": (1, 3), "r4": (4, 5), "r5": (0,)}


def tagged_of(spark, sf):
    words = measure.key_words(fx.activity(spark, sf), [c for c, _ in ITEMS])
    return select.tag_population(fx.population(spark, sf), words, NAMED)


TAGGED_SQL = ", " + HAS + ", tagged as (select p.*, " + ", ".join(
    "coalesce(cast(" + " and ".join(f"c{i}=1" for i in ids) + f" as integer), 0) as {n}"
    for n, ids in NAMED.items()) + " from population p left join has on p.key=has.key)"


@query("tag_population", f1(TAGGED_SQL + " select key, acct, tag, r1, r2, r3, r4, r5 from tagged"))
def tag_population(spark, sf):
    return tagged_of(spark, sf).select("key", "acct", "tag", *NAMED)


@query("flag_vector_rollup", f1(TAGGED_SQL + """
select r1, r2, r3, r4, r5, round(cast(sum(case when tag=1 then 1 else 0 end) as double),4) as target_catch
from tagged group by all"""))
def flag_vector_rollup(spark, sf):
    return select.flag_vectors(tagged_of(spark, sf), list(NAMED), CNT).select(
        *NAMED, r4("target_catch"))


FIRST = "case " + " ".join(f"when {n}=1 then {i}" for i, n in enumerate(NAMED)) + " end"


@query("incremental_catch", f1(", " + BASE_SQL + TAGGED_SQL + f"""
, firsts as (select {FIRST} as place, sum(case when tag=1 then 1 else 0 end) as c from tagged group by 1)
select names.place, pattr_name, round(cast(coalesce(c,0) as double),4) as inc_catch,
  round(coalesce(c,0)/n,6) as inc_catch_share
from (select cast(unnest(range(0,5)) as integer) as place, unnest(['r1','r2','r3','r4','r5']) as pattr_name) names
left join firsts on firsts.place=names.place, base"""))
def incremental_catch(spark, sf):
    total = measure.baseline(fx.population(spark, sf), CNT).first().total_catch
    vectors = select.flag_vectors(tagged_of(spark, sf), list(NAMED), CNT)
    return select.incremental_catch(vectors, list(NAMED), total).select(
        "place", "pattr_name", r4("inc_catch"), r6("inc_catch_share"))


def _rank_query(priority: str):
    order = ", ".join(f"{c} desc" for c in RANKINGS[priority])
    sql = f1(MEASURED_SQL + _score_sql() + f"""
, p as (select 'p' || m.pattern_id as pattr_name, target_cnt as target_catch, target_cnt_rate as target_rate,
  pattr_fscore, round(cast(pattr_score as double),6) as pattr_score
  from measured m join scores s on s.pattern_id=m.pattern_id)
select pattr_name, cast(row_number() over (order by {order}, pattr_name) as integer) as place from p""")
    name = "rank_" + priority.removeprefix("target_").replace("+", "_").replace("pattr_", "")

    @query(name, sql)
    def run(spark, sf):
        table = scored_sets(spark, sf).select("pattr_name", r4("target_catch"), r6("target_rate"), r6("pattr_fscore"), r6("pattr_score"))
        return select.ranked(table, priority).select("pattr_name", "place")
    return run


for _p in RANKINGS:
    _rank_query(_p)


DEDUP_CUTOFF = 0.1


@query("dedup_patterns", f1(", " + BASE_SQL + TAGGED_SQL + f"""
, firsts as (select {FIRST} as place, sum(case when tag=1 then 1 else 0 end) as c from tagged group by 1)
, names as (select unnest(range(0,5)) as place, unnest(['r1','r2','r3','r4','r5']) as name)
, kept as (select names.place, name from names join firsts on firsts.place=names.place, base
  where c/n > {DEDUP_CUTOFF})
, again as (select key, tag, min(k.place) as place from (
    unpivot (select key, tag, r1, r2, r3, r4, r5 from tagged) on r1, r2, r3, r4, r5 into name name value hit) u
  join kept k on k.name=u.name where hit=1 group by key, tag)
select name as pattr_name, round(cast(sum(case when tag=1 then 1 else 0 end) as double),4) as inc_catch,
  round(sum(case when tag=1 then 1 else 0 end)/any_value(n),6) as inc_catch_share
from again join kept on kept.place=again.place, base group by name"""))
def dedup_patterns(spark, sf):
    total = measure.baseline(fx.population(spark, sf), CNT).first().total_catch
    vectors = select.flag_vectors(tagged_of(spark, sf), list(NAMED), CNT).persist()
    gains, kept = select.dedup_names(vectors, list(NAMED), total, DEDUP_CUTOFF)
    vectors.unpersist()
    return spark.createDataFrame([(n, *gains[n]) for n in kept],
                                 "pattr_name string, inc_catch double, inc_catch_share double").select(
        "pattr_name", r4("inc_catch"), r6("inc_catch_share"))


CATALOG = sorted({i for s in SETS for i in s}, key=lambda i: ITEMS[i][0].text)
CATALOG_SQL = " union all ".join(
    measure_sql(ITEMS[i][1], head="'" + ITEMS[i][0].text.replace(chr(6), " & ") + "' as content, ")
    for i in CATALOG)


def catalog_of(spark, sf):
    activity = fx.held_rows(spark, sf, sorted({a.variable for c, _ in ITEMS for a in c.atoms}))
    conditions = select.condition_catalog(measured_patterns(spark, sf, activity))
    return measure.measure_conditions(activity, conditions, CNT).withColumn(
        "content", F.replace("content", F.lit(chr(6)), F.lit(" & ")))


@query("condition_catalog", f1(" " + CATALOG_SQL))
def condition_catalog(spark, sf):
    return catalog_of(spark, sf).select("content", *kpis())


@query("condition_result_rows", f1(", c as (" + CATALOG_SQL + """)
select content as act_content, round(target_catch,4) as target_catch, round(target_rate,4) as target_rate from c"""))
def condition_result_rows(spark, sf):
    return results.condition_rows(catalog_of(spark, sf)).select(
        "act_content", "target_catch", "target_rate")


ORDERS = whole.Domain(whole.ORDERS_TABLES, tuple(fx.features()))
METRICS = (*SUMS, *(r for r in RATES if r != "pattr_fscore"))


@query("pattern_result_rows", whole.whole_sql(ORDERS, fx.EVERY_VALUE, f"""
, whole as (select rnk, {metrics_sql(WHOLE)} from done join met using (sid) join people using (key) group by rnk)
select name as pattr_name, replace(array_to_string(texts, ' | '), chr(6), ' & ') as pattr_content, cp_str,
  round(rate, 4) as target_rate, round(cast(hit as double), 4) as target_catch, round(inc, 4) as inc_catch,
  round(share, 4) as inc_catch_share, round(f, 4) as pattr_fscore, round(score, 4) as pattr_score, lives as after_dedup,
  {", ".join(f"round(w.{m}, 4) as {m}" for m in METRICS)} from done join whole w using (rnk)"""))
def pattern_result_rows(spark, sf):
    population, activity = fx.held_people(spark, sf), fx.activity(spark, sf)
    found = mine(population, activity, fx.features(), fx.EVERY_VALUE, tiebreak=fx.TIEBREAK)
    rows = results.pattern_rows(spark, found.patterns).drop("pattr_id", "update_dt", "update_ts")
    found.release()
    metrics = [F.get_json_object("other_metrics", f"$.{m}").cast("double").alias(m) for m in METRICS]
    return rows.withColumn("pattr_content", shown("pattr_content")).select("*", *metrics).drop("other_metrics")


def shown(content: str):
    """Pattern text with printable separators."""
    return F.replace(F.replace(content, F.lit(chr(6)), F.lit(" & ")), F.lit(chr(7)), F.lit(" | "))


def ranked_rows(spark, found):
    """The ranked patterns of a finished search, one row each."""
    rows = [(i + 1, p.name, p.content, p.cp_str, p.target_catch, p.target_rate, p.pattr_fscore, p.pattr_score,
             p.inc_catch, p.inc_catch_share) for i, p in enumerate(found.ranked)]
    found.release()
    table = spark.createDataFrame(
        rows, "place int, pattr_name string, pattr_content string, cp_str string, "
        "target_catch double, target_rate double, pattr_fscore double, pattr_score double, "
        "inc_catch double, inc_catch_share double")
    return table.select("place", "pattr_name", shown("pattr_content").alias("pattr_content"), "cp_str", *kpis(),
                        r6("pattr_fscore"), r6("pattr_score"), r4("inc_catch"), r6("inc_catch_share"))


@query("mine_patterns", whole.whole_sql(ORDERS, fx.EVERY_VALUE, whole.RANKED))
def mine_patterns(spark, sf):
    population, activity = fx.held_people(spark, sf), fx.activity(spark, sf)
    return ranked_rows(spark, mine(population, activity, fx.features(), fx.EVERY_VALUE, tiebreak=fx.TIEBREAK))


@query("mining_stages", whole.whole_sql(ORDERS, fx.EVERY_VALUE, whole.STAGES))
def mining_stages(spark, sf):
    """What every stage of the whole job came to."""
    population, activity = fx.held_people(spark, sf), fx.activity(spark, sf)
    found = mine(population, activity, fx.features(), fx.EVERY_VALUE, tiebreak=fx.TIEBREAK)
    found.release()
    return results.stage_rows(spark, found.stages).select("stage", shown("content").alias("content"), r4("catch"), r6("rate"))


EVENTS = replace(fx.EVERY_VALUE, min_support=0.05, eval_cutoff=0.4, lvl_limit=2)
USER_DAYS = whole.Domain(whole.USER_DAYS_TABLES, tuple(fx.event_features()))


@query("mine_user_days", whole.whole_sql(USER_DAYS, EVENTS, whole.RANKED))
def mine_user_days(spark, sf):
    """The same job on the event stream's user days."""
    population, activity = fx.user_days(spark, sf)
    population = population.persist()
    rows = ranked_rows(spark, mine(population, activity, fx.event_features(), EVENTS, tiebreak=("event_id",)))
    population.unpersist()
    return rows
