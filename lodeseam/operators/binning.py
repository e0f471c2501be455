"""Univariate search: turn every eligible feature into conditions worth refining.

The cells of a feature (top string values, numeric intervals, a boolean) become bits. One pass
folds the activity into a row per (checkpoint, key, tag, amt) whose words say which cells of each
feature the key reaches; a second one counts keys of equal cells, per feature (:mod:`.signatures`). Any
union of cells of one feature is exact on those counts, and nothing after them reads keys.

A search is a generator: it yields the cell sets it wants measured and is sent their
(catch, rate). A task runs the whole search of a feature over the feature's counts, so all searches are one
Spark job. A feature with too many distinct cell sets for a task is searched in rounds over the table of counts.
"""

from __future__ import annotations

from collections.abc import Generator
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..conditions import INF, Atom, Equals, Flag, InSet, Range
from ..config import MISSING_WORDS, Feature, SearchParams, VariableRules
from ..functions.bits import WORD, literal, word_count
from ..session import local_table, tuned
from . import signatures as sig
from .measure import roles_of
from .profile import direction, is_special

Cells = frozenset[int]
Found = list[tuple[Atom, float, float]]
Search = Generator[list[Cells], dict[Cells, tuple[float, float]], Found]


@dataclass(frozen=True)
class Gate:
    """Thresholds shared by all searches."""

    sup_n: float
    base_rate: float
    min_block: float
    eval_cutoff: float
    lift: float = 1.0
    coverage_cap: float | None = None
    best_first: bool = False

    @staticmethod
    def of(row, params: SearchParams) -> "Gate":
        return Gate(row.sup_n, row.base_rate, row.min_block, params.eval_cutoff, params.lift,
                    params.coverage_cap, params.best_first)


def _count_below(x: str, cuts: list[float], start: int = 0) -> str:
    """SQL text: how many sorted cuts are below x, by halving. Text, as it can be long."""
    if not cuts:
        return str(start)
    half = len(cuts) // 2
    return (f"CASE WHEN {x} > {cuts[half]!r}D THEN {_count_below(x, cuts[half + 1:], start + half + 1)} "
            f"ELSE {_count_below(x, cuts[:half], start)} END")


@dataclass(frozen=True)
class Plan:
    """One feature with its cells, and where its bits live."""

    feature: Feature
    kind: str                          # string | up | down | both | discrete | bool
    values: tuple = ()                 # strings: (value, many_accts); discrete: numbers
    cuts: tuple[float, ...] = ()
    polarity: bool = True

    @property
    def size(self) -> int:
        if self.kind in ("string", "discrete"):
            return len(self.values)
        return 1 if self.kind == "bool" else len(self.cuts) + 1

    def cell(self) -> Column:
        """Number of the cell a row falls into, null for none."""
        x = F.col(f"`{self.feature.variable}`")
        if self.kind == "bool":
            return F.when(x == F.lit(self.polarity), F.lit(0))
        if self.kind in ("string", "discrete"):
            named = [v[0] if self.kind == "string" else v for v in self.values]
            out = F.when(x == F.lit(named[0]), F.lit(0))
            for i, v in enumerate(named[1:], 1):
                out = out.when(x == F.lit(v), F.lit(i))
            return out
        below = F.expr(_count_below(f"`{self.feature.variable}`", [float(c) for c in self.cuts]))
        return F.when(x.isNotNull(), below)

    def interval(self, first: int, last: int) -> Range:
        """The range covered by cells first..last."""
        lo = -INF if first == 0 else self.cuts[first - 1]
        hi = INF if last == len(self.cuts) else self.cuts[last]
        return Range(self.feature.variable, lo, hi)

    def search(self, gate: Gate) -> Search:
        return {"string": string_search, "up": up_search, "down": down_search,
                "both": interval_search, "discrete": discrete_search,
                "bool": bool_search}[self.kind](self, gate)


def make_plans(features: list[Feature], top: dict[tuple[str, str], list[tuple[str, bool]]],
               cuts: dict[tuple[str, str], tuple[float, ...]],
               discrete: dict[tuple[str, str], tuple[float, ...]],
               excluded: set[tuple[str, str]], rules: VariableRules) -> list[Plan]:
    plans = []
    for f in features:
        pair = (f.checkpoint, f.variable)
        if f.type == "string" and top.get(pair):
            plans.append(Plan(f, "string", values=tuple(top[pair])))
        elif f.type == "bool" and pair not in excluded:
            plans.append(Plan(f, "bool", polarity=f.variable not in rules.false_vars))
        elif f.type == "numeric" and discrete.get(pair) and not is_special(f.variable, rules):
            plans.append(Plan(f, "discrete", values=discrete[pair]))
        elif f.type == "numeric" and len(cuts.get(pair, ())) > 1:
            plans.append(Plan(f, direction(f.variable, rules), cuts=tuple(cuts[pair])))
    return plans


def _bit(cell: Column) -> Column:
    """The word with bit ``cell`` set; empty for a cell outside the word or none."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), cell)
    return F.when(cell.between(0, WORD - 1), bit).otherwise(F.lit(0).cast("bigint"))


class CellTable:
    """The folded activity and the word layout of each checkpoint's features.

    Feature number s of a checkpoint uses slot s. The cell numbers of a row are worked out in one
    projection and turned into bits in the next, so that each is computed once.
    """

    def __init__(self, activity: DataFrame, plans: list[Plan], metric: str):
        self.plans, self.metric = plans, metric
        slots: list[list[Plan]] = []
        seen: dict[str, int] = {}
        placed = []
        for p in plans:
            slot = seen.get(p.feature.checkpoint, 0)
            seen[p.feature.checkpoint] = slot + 1
            if slot == len(slots):
                slots.append([])
            slots[slot].append(p)
            placed.append(slot)
        first, cells, bits = [], [], []
        for s, members in enumerate(slots):
            first.append(len(bits))
            cell = None
            for p in members:
                here = F.col("checkpoint") == F.lit(p.feature.checkpoint)
                cell = F.when(here, p.cell()) if cell is None else cell.when(here, p.cell())
            cells.append(cell.alias(f"c{s}"))
            for w in range(max(word_count(p.size) for p in members)):
                bits.append(_bit(F.col(f"c{s}") - w * WORD).alias(f"w{len(bits)}"))
        self.slot = placed
        self.spans = [(a, b - a) for a, b in zip(first, [*first[1:], len(bits)])]
        words = [f"w{i}" for i in range(len(bits))]
        roles = roles_of(activity, metric)
        folded = (activity.where(F.col("checkpoint").isin(*seen))
                  .select("checkpoint", "key", *roles, *cells)
                  .select("checkpoint", "key", *roles, *bits)
                  .groupBy("key", "checkpoint", *roles)
                  .agg(*[F.bit_or(w).alias(w) for w in words]))
        self.table = folded.select("checkpoint", "key", *roles, F.array(*words).alias("words"))
        mixed = [(F.min(c) != F.max(c)) | ~F.count(c).isin(F.lit(0), F.count(F.lit(1))) for c in roles]
        rows = activity.where(F.col("checkpoint").isin(*seen)).groupBy("key", "checkpoint")
        self.mixed = rows.agg(F.coalesce(reduce(or_, mixed), F.lit(False)).alias("mixed")).where("mixed")

    @cached_property
    def counts(self) -> DataFrame:
        """The signatures of the keys, a group per plan number; kept until :meth:`release`."""
        with tuned(self.table.sparkSession):
            return self._count()

    def _count(self) -> DataFrame:
        keys = self.table
        # as a rule the roles are the key's, and then a (checkpoint, key) has a single row
        alone = self.mixed.isEmpty()
        names = [f"_w{w}" for w in range(max(n for _, n in self.spans))]
        slots = []
        for s, (start, n) in enumerate(self.spans):
            plan = None
            for p, plan_of in enumerate(self.plans):
                if self.slot[p] == s:
                    here = F.col("checkpoint") == F.lit(plan_of.feature.checkpoint)
                    plan = F.when(here, F.lit(p)) if plan is None else plan.when(here, F.lit(p))
            here = [F.get("words", F.lit(start + w)) if w < n else F.lit(None).cast("bigint") for w in range(len(names))]
            slots.append(F.struct(plan.alias("group"), *[c.alias(name) for c, name in zip(here, names)]))
        rows = (keys.select("key", *roles_of(keys), F.explode(F.array(*slots)).alias("s"))
                .select("s.group", "key", *roles_of(keys), *[f"s.{name}" for name in names])
                .where(F.col("group").isNotNull()).where(" OR ".join(f"{name} != 0" for name in names)))
        counted = sig.signatures(rows, self.metric, len(names) if alone else 0, False, names).persist()
        self.sizes = sig.group_sizes(counted)
        return counted

    def release(self) -> None:
        if "counts" in self.__dict__:
            self.counts.unpersist()

    def bits(self, plan: int, cells: Cells) -> list[int]:
        return literal(sorted(cells), self.spans[self.slot[plan]][1])

    def kpis(self, tests: list[tuple[int, Cells]]) -> DataFrame:
        """(test_id, target_catch, target_rate) of the tests that meet any key.

        Tests are (plan number, cells); the test id is the position in the list.
        """
        return sig.measured(self.counts, [(p, self.bits(p, c)) for p, c in tests], sig.picked_by_any, "int")

    def measure(self, tests: list[tuple[int, Cells]]) -> list[tuple[float, float]]:
        got = {r.test_id: (r.target_catch, r.target_rate) for r in self.kpis(tests).collect()}
        return [got.get(i, (0.0, 0.0)) for i in range(len(tests))]


def value_candidates(cells: CellTable, gate: Gate) -> DataFrame:
    """String values that may enter a bin: above the base rate, big enough, several accounts."""
    tests, rows = [], []
    for p, plan in enumerate(cells.plans):
        for i, value in enumerate(plan.values if plan.kind == "string" else ()):
            if value[1] and value[0] not in MISSING_WORDS:
                rows.append((len(tests), plan.feature.checkpoint, plan.feature.variable, value[0]))
                tests.append((p, frozenset({i})))
    names = local_table(cells.table.sparkSession, rows,
                        "test_id int, checkpoint string, variable string, value string")
    return (names.join(cells.kpis(tests), "test_id")
            .where((F.col("target_rate") > gate.base_rate * gate.lift ** 2)
                   & (F.col("target_catch") > gate.min_block)))


def run_searches(cells: CellTable, gate: Gate) -> list[Found]:
    """The results of every search, in plan order."""
    counts = cells.counts
    small = [p for p in range(len(cells.plans)) if 0 < cells.sizes.get(p, 0) <= sig.MAX_ROWS]
    plans, spans, slot = cells.plans, cells.spans, cells.slot

    def whole_search(p: int, held: sig.Held):
        for atom, catch, rate in _alone(plans[p].search(gate), lambda c: held.any_of(literal(sorted(c), spans[slot[p]][1]))):
            low, high = (atom.lo, atom.hi) if isinstance(atom, Range) else (getattr(atom, "value", None), None)
            yield (list(atom.values) if isinstance(atom, InSet) else None, None if low is None else float(low), high, catch, rate)
    found: list[Found] = [[] for _ in cells.plans]
    fields = "values array<string>, low double, high double, catch double, rate double"
    for r in sig.search_each(counts, small, whole_search, "int", fields):
        found[r["group"]].append((_atom(plans[r["group"]], r), r.catch, r.rate))
    rest = [p for p in range(len(cells.plans)) if p not in set(small)]
    for p, atoms in zip(rest, _in_rounds(cells, rest, gate)):
        found[p] = atoms
    return found


def _atom(plan: Plan, r) -> Atom:
    name = plan.feature.variable
    if plan.kind == "string":
        return InSet(name, tuple(r["values"]))
    if plan.kind == "bool":
        return Flag(name, bool(r.low))
    return Equals(name, r.low) if plan.kind == "discrete" else Range(name, r.low, r.high)


def _alone(search: Search, figures) -> Found:
    """A search that is answered at once."""
    try:
        asked = next(search)
        while True:
            asked = search.send({c: figures(c) for c in asked})
    except StopIteration as done:
        return done.value


def _in_rounds(cells: CellTable, numbers: list[int], gate: Gate) -> list[Found]:
    """Advance the searches of some plans together, one Spark job a round, until all are done."""
    found: dict[int, Found] = {}
    live: dict[int, tuple[Search, list[Cells]]] = {}
    for i in numbers:
        search = cells.plans[i].search(gate)
        live[i] = (search, next(search))
    while live:
        tests = [(i, c) for i, (_, asked) in live.items() for c in asked]
        results = cells.measure(tests)
        answers: dict[int, dict[Cells, tuple[float, float]]] = {}
        for (i, c), r in zip(tests, results):
            answers.setdefault(i, {})[c] = r
        for i, (search, _) in list(live.items()):
            try:
                live[i] = (search, search.send(answers.get(i, {})))
            except StopIteration as done:
                found[i] = done.value
                del live[i]
    return [found[i] for i in numbers]


def is_close(rate: float, bin_rate: float, gate: Gate) -> bool:
    """A value joins a bin of similar rate, any value above the cutoff joins, tiny ones join."""
    gap = abs(bin_rate - rate) / bin_rate if bin_rate else INF
    return gap < 0.5 or rate > gate.eval_cutoff or (bin_rate < 0.01 and rate < bin_rate)


def string_search(plan: Plan, gate: Gate) -> Search:
    n = plan.size
    asked = [frozenset({i}) for i in range(n)]
    if gate.coverage_cap is not None:
        asked.append(frozenset(range(n)))
    got = yield asked
    cap = INF if gate.coverage_cap is None else gate.coverage_cap * got[frozenset(range(n))][0]
    order = list(range(n))
    if gate.best_first:
        order.sort(key=lambda i: (-got[frozenset({i})][1], -got[frozenset({i})][0]))
    bins: list[tuple[list[int], float, float]] = []
    for i in order:
        value, many_accts = plan.values[i]
        catch, rate = got[frozenset({i})]
        if value in MISSING_WORDS or not many_accts:
            continue
        if not (rate > gate.base_rate * gate.lift ** 2 and catch > gate.min_block):
            continue
        near = min(range(len(bins)), key=lambda b: abs(bins[b][2] - rate), default=None)
        if near is not None and is_close(rate, bins[near][2], gate) and bins[near][1] <= cap:
            members = [*bins[near][0], i]
            merged = yield [frozenset(members)]
            bins[near] = (members, *merged[frozenset(members)])
        else:
            bins.append(([i], catch, rate))
    return [(InSet(plan.feature.variable, tuple(plan.values[i][0] for i in members)), catch, rate)
            for members, catch, rate in bins if catch >= gate.sup_n]


def discrete_search(plan: Plan, gate: Gate) -> Search:
    got = yield [frozenset({i}) for i in range(plan.size)]
    out = []
    for i, value in enumerate(plan.values):
        catch, rate = got[frozenset({i})]
        if catch > gate.sup_n and (rate > gate.base_rate * gate.lift or rate > gate.eval_cutoff):
            out.append((Equals(plan.feature.variable, float(value)), catch, rate))
    return _final(out, gate)


def bool_search(plan: Plan, gate: Gate) -> Search:
    got = yield [frozenset({0})]
    catch, rate = got[frozenset({0})]
    atom = Flag(plan.feature.variable, plan.polarity)
    return [(atom, catch, rate)] if catch >= gate.sup_n and rate >= gate.base_rate else []


def up_search(plan: Plan, gate: Gate) -> Search:
    """x > cut: the first cut above the cutoff, else the best rate with enough catch."""
    top = len(plan.cuts)
    sets = [frozenset(range(c + 1, top + 1)) for c in range(top)]
    got = yield sets
    best, best_catch, best_rate = None, 0.0, 0.0
    for c, cells in enumerate(sets):
        catch, rate = got[cells]
        if rate > gate.eval_cutoff or (rate > best_rate and catch > gate.sup_n):
            best, best_catch, best_rate = c, catch, rate
        if rate > gate.eval_cutoff:
            break
    return _one_sided(plan, gate, best, best_catch, best_rate,
                      None if best is None else plan.interval(best + 1, top))


def down_search(plan: Plan, gate: Gate) -> Search:
    """x <= cut: later cuts replace earlier ones while the rate rises or stays above the cutoff."""
    sets = [frozenset(range(c + 1)) for c in range(len(plan.cuts))]
    got = yield sets
    best, best_catch, best_rate = None, 0.0, 0.0
    for c, cells in enumerate(sets):
        catch, rate = got[cells]
        if rate > min(best_rate, gate.eval_cutoff) and catch > gate.sup_n:
            best, best_catch, best_rate = c, catch, rate
    return _one_sided(plan, gate, best, best_catch, best_rate,
                      None if best is None else plan.interval(0, best))


def _one_sided(plan, gate, best, catch, rate, atom) -> Found:
    if best is None or not (rate > gate.base_rate * gate.lift and catch > gate.sup_n):
        return []
    return _final([(atom, catch, rate)], gate)


def interval_search(plan: Plan, gate: Gate) -> Search:
    """Neighbouring intervals above the base rate, merged while their rates are close.

    All extensions of a merge that might follow are asked for at once, so a run of merges costs
    one round. The open last interval stands alone.
    """
    last = plan.size - 1
    got = dict((yield [frozenset({i}) for i in range(plan.size)]))
    runs: list[tuple[int, int, float, float]] = []
    for i in range(plan.size):
        catch, rate = got[frozenset({i})]
        if not (rate > gate.base_rate if i == 0 else rate >= gate.base_rate):
            continue
        if 0 < i < last and runs and runs[-1][1] == i - 1 and is_close(rate, runs[-1][3], gate):
            first = runs[-1][0]
            cells = frozenset(range(first, i + 1))
            if cells not in got:
                ahead, end = [cells], i + 1
                while end < last and got[frozenset({end})][1] >= gate.base_rate:
                    ahead.append(frozenset(range(first, end + 1)))
                    end += 1
                got.update((yield ahead))
            runs[-1] = (first, i, *got[cells])
        else:
            runs.append((i, i, catch, rate))
    return _final([(plan.interval(a, b), catch, rate) for a, b, catch, rate in runs], gate)


def _final(found: Found, gate: Gate) -> Found:
    return [f for f in found if f[1] >= gate.sup_n and f[2] >= gate.base_rate * gate.lift]
