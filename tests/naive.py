"""The search written as plain loops over rows, to check the Spark jobs on small inputs."""

import math
import re
from fractions import Fraction

import numpy as np

EPS = 0.0001


class Naive:
    def __init__(self, people, rows, params, rules, amount=False):
        self.people, self.rows, self.p, self.rules, self.amount = people, rows, params, rules, amount
        self.total, base = self.kpi([(r["tag"], r["amt"]) for r in people])
        self.base, self.sup = base, params.min_support * self.total
        self.block = max(params.min_block_size * self.total, 1)
        self.by_cp = {}
        for r in rows:
            self.by_cp.setdefault(r["checkpoint"], []).append(r)

    def kpi(self, keyed):
        caught = labelled = 0.0
        for tag, amt in keyed:
            v = (amt or 0.0) if self.amount else 1.0
            caught += v if tag == 1 else 0
            labelled += v if tag in (0, 1) else 0
        return round(caught, 6), round(caught / (labelled + EPS), 10)

    def measure(self, cp, test):
        best = {}
        for r in self.by_cp.get(cp, ()):
            if test(r):
                tag, amt = best.get(r["key"], (None, None))
                best[r["key"]] = (max_of(tag, r["tag"]), max_of(amt, r["amt"]))
        return self.kpi(best.values())

    # ---- univariate
    def close(self, rate, other):
        gap = abs(other - rate) / other if other else math.inf
        return gap < 0.5 or rate > self.p.eval_cutoff or (other < 0.01 and rate < other)

    def strings(self, cp, var):
        sizes = {}
        for r in self.by_cp[cp]:
            if r["tag"] == 1 and r[var] is not None and r[var] not in self.rules.ignore_values:
                keys, accts = sizes.setdefault(r[var], ({}, set()))
                keys[r["key"]] = max_of(keys.get(r["key"]), r["amt"])
                accts.add(r["acct"])
        size = {v: sum(a or 0 for a in k.values()) if self.amount else len(k)
                for v, (k, _) in sizes.items()}
        top = sorted(size, key=lambda v: (-size[v], v))[:self.p.top_values]
        if self.p.top_values is None:
            top = [v for v in top if size[v] > self.block]
        bins = []
        for v in top:
            if v in ("NULL", "UNKNOWN", "None") or len(sizes[v][1]) < 2:
                continue
            catch, rate = self.measure(cp, lambda r: r[var] == v)
            if not (rate > self.base and catch > self.block):
                continue
            near = None
            for i, (_, _, other) in enumerate(bins):
                if near is None or abs(other - rate) < abs(bins[near][2] - rate):
                    near = i
            if near is not None and self.close(rate, bins[near][2]):
                members = bins[near][0] + [v]
                bins[near] = (members, *self.measure(cp, lambda r: r[var] in members))
            else:
                bins.append(([v], catch, rate))
        return [(f'{var} in ({",".join(chr(34) + v + chr(34) for v in m)})',
                 lambda r, m=tuple(m): r[var] in m, c, q) for m, c, q in bins if c >= self.sup]

    def cuts(self, cp, var):
        values = [r[var] for r in self.by_cp[cp] if r["tag"] == 1 and r[var] is not None]
        if not values:
            return []
        for pattern, fixed in self.rules.fixed_cuts:
            if re.search(pattern, var, re.I):
                out = []
                for i, c in enumerate(fixed):
                    out.append(float(c))
                    if c >= max(values) or i == len(fixed) - 1:
                        break
                return out
        steps, k = [0.5], 1
        while k * self.p.min_support < 1 - 1e-12:
            steps.append(k * self.p.min_support)
            k += 1
        out = set()
        for q in np.quantile(values, sorted(set(steps))):
            if q <= 0:
                continue
            grid = 10 if q < 100 else 100 if q < 10000 else 10000
            out.add(round(float(q), 1) if q < 10 else float(int(q / grid) * grid))
        return sorted(out)

    def numbers(self, cp, var):
        cuts = self.cuts(cp, var)
        if len(cuts) < 2:
            return []

        def within(lo, hi):
            return lambda r: r[var] is not None and lo < r[var] <= hi
        found = []
        if re.search(self.rules.up_names, var, re.I):
            best = (0.0, 0.0, None)
            for c in cuts:
                catch, rate = self.measure(cp, within(c, math.inf))
                if rate > self.p.eval_cutoff:
                    best = (catch, rate, c)
                    break
                if rate > best[1] and catch > self.sup:
                    best = (catch, rate, c)
            if best[1] > self.base and best[0] > self.sup:
                found.append((best[2], math.inf, *best[:2]))
        elif re.search(self.rules.down_names, var, re.I):
            best = (0.0, 0.0, None)
            for c in cuts:
                catch, rate = self.measure(cp, within(-math.inf, c))
                if rate > min(best[1], self.p.eval_cutoff) and catch > self.sup:
                    best = (catch, rate, c)
            if best[1] > self.base and best[0] > self.sup:
                found.append((-math.inf, best[2], *best[:2]))
        else:
            edges = [-math.inf, *cuts, math.inf]
            for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
                catch, rate = self.measure(cp, within(lo, hi))
                if rate < self.base or (i == 0 and rate <= self.base):
                    continue
                if (0 < i < len(edges) - 2 and found and found[-1][1] == lo
                        and self.close(rate, found[-1][3])):
                    lo = found.pop()[0]
                    catch, rate = self.measure(cp, within(lo, hi))
                found.append((lo, hi, catch, rate))
        return [(range_text(var, lo, hi), within(lo, hi), c, q) for lo, hi, c, q in found
                if c >= self.sup and q >= self.base]

    def bools(self, cp, var):
        want = var not in self.rules.false_vars
        catch, rate = self.measure(cp, lambda r: r[var] is want)
        ok = catch >= self.sup and rate >= self.base
        return [(f"{var}={want}", lambda r: r[var] is want, catch, rate)] if ok else []

    def index(self, cp, var):
        sizes = {}
        for r in self.by_cp[cp]:
            if r["tag"] == 1 and r[var] is not None:
                keys = sizes.setdefault(r[var], {})
                keys[r["key"]] = max_of(keys.get(r["key"]), r["amt"])
        s = sorted((sum(a or 0 for a in k.values()) if self.amount else len(k)
                    for k in sizes.values()), reverse=True)
        if not s or not sum(s):
            return -1.0
        return abs(sum(np.cumsum(s)) / (len(s) * sum(s) / 2) - 1)

    def univariate(self, features):
        out = {}
        for f in features:
            if f.checkpoint not in self.by_cp:
                continue
            if self.measure(f.checkpoint, lambda r: True)[0] < self.sup:
                continue
            if self.index(f.checkpoint, f.variable) < self.p.concentration_cutoff:
                continue
            search = {"string": self.strings, "numeric": self.numbers, "bool": self.bools}[f.type]
            for text, test, catch, rate in search(f.checkpoint, f.variable):
                out.setdefault(f.checkpoint, []).append((text, test, catch, rate, f.priority))
        return out

    # ---- trees
    def f(self, rate, catch):
        share = catch / self.total
        return 2 * rate * share / (rate + share) if rate > 0 and share > 0 else 0.0

    def leaves(self, cp, listed):
        catch, rate = self.measure(cp, lambda r: True)
        nodes = [((), (), catch, rate, None)]
        for text, test, c, _, priority in sorted(listed, key=lambda s: (s[4], -s[2], s[0])):
            tried = []
            for n in nodes:
                tests = (*n[1], test)
                catch, rate = self.measure(cp, lambda r: all(t(r) for t in tests))
                tried.append((n, catch, rate))
            pool = [t for t in tried if t[1] > 0.8 * t[0][2] and t[2] > t[0][3]]
            needed = {1: 0, 2: 0.1, 3: 0.15}[priority]
            if not pool:
                pool = [t for t in tried if t[1] >= self.sup and t[2] > t[0][3]]
                needed = {1: 0, 2: 0.05, 3: 0.1}[priority]
            if not pool:
                continue
            n, catch, rate = max(pool, key=lambda t: self.f(t[2], t[1]))
            if rate - n[3] > needed:
                nodes.append(((*n[0], text), (*n[1], test), catch, rate, n))
        used = [n[4] for n in nodes]
        return [n for n in nodes if n[4] is not None and not any(n is u for u in used)]

    # ---- combination
    def held(self, candidates):
        """(key, acct) -> (items, weight) over outcome rows."""
        out = {}
        for r in self.rows:
            if r["tag"] != 1:
                continue
            for i, (cp, tests) in enumerate(candidates):
                if r["checkpoint"] == cp and all(t(r) for t in tests):
                    at = out.setdefault((r["key"], r["acct"]), [set(), None])
                    at[0].add(i)
                    at[1] = max_of(at[1], r["amt"] if self.amount else 1.0)
        return {k: (items, max(w or 0.0, self.p.weight_floor)) for k, (items, w) in out.items()}


def max_of(a, b):
    return b if a is None else a if b is None else max(a, b)


def number(x):
    return str(int(x)) if float(x).is_integer() else repr(float(x))


def range_text(var, lo, hi):
    if lo == -math.inf:
        return f"{var}<={number(hi)}"
    if hi == math.inf:
        return f"{var}>{number(lo)}"
    return f"{var}>{number(lo)} and {var}<={number(hi)}"


def supports(lists, candidates):
    """Exact weight of every candidate set."""
    return {c: float(sum(Fraction(w) for items, w in lists if set(c) <= set(items)))
            for c in candidates}
