"""Row conditions as Columns, with a stable text form.

A *condition* is a checkpoint plus atoms that must hold on one activity row. A *pattern* is a
set of conditions, each of which must hold on some row of the key.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

ATOM_SEP, CONDITION_SEP = chr(6), chr(7)     # fixed values: separators of the text form
INF = float("inf")


def number_text(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else repr(float(x))


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class InSet:
    variable: str
    values: tuple[str, ...]

    @property
    def text(self) -> str:
        return f"{self.variable} in ({','.join(chr(34) + v + chr(34) for v in self.values)})"

    def column(self) -> Column:
        return _col(self.variable).isin(*self.values)


@dataclass(frozen=True)
class Equals:
    """Equality; the literal ``"None"`` stands for a missing value."""

    variable: str
    value: str | float

    @property
    def text(self) -> str:
        shown = f'"{self.value}"' if isinstance(self.value, str) else number_text(self.value)
        return f"{self.variable}={shown}"

    def column(self) -> Column:
        if self.value == "None":
            return _col(self.variable).isNull()
        return _col(self.variable) == F.lit(self.value)


@dataclass(frozen=True)
class Range:
    """lo < x <= hi, either side may be open."""

    variable: str
    lo: float = -INF
    hi: float = INF

    @property
    def text(self) -> str:
        low, high = f"{self.variable}>{{}}", f"{self.variable}<={{}}"
        if self.lo == -INF:
            return high.format(number_text(self.hi))
        if self.hi == INF:
            return low.format(number_text(self.lo))
        return f"{low.format(number_text(self.lo))} and {high.format(number_text(self.hi))}"

    def column(self) -> Column:
        sides = []
        if self.lo != -INF:
            sides.append(_col(self.variable) > F.lit(float(self.lo)))
        if self.hi != INF:
            sides.append(_col(self.variable) <= F.lit(float(self.hi)))
        return reduce(and_, sides)


@dataclass(frozen=True)
class Flag:
    variable: str
    value: bool = True

    @property
    def text(self) -> str:
        return f"{self.variable}={self.value}"

    def column(self) -> Column:
        return _col(self.variable) == F.lit(self.value)


Atom = InSet | Equals | Range | Flag


@dataclass(frozen=True)
class Condition:
    checkpoint: str
    atoms: tuple[Atom, ...] = field(default=())

    @property
    def text(self) -> str:
        return ATOM_SEP.join([f'checkpoint="{self.checkpoint}"', *(a.text for a in self.atoms)])

    def column(self) -> Column:
        return reduce(and_, (a.column() for a in self.atoms),
                      F.col("checkpoint") == F.lit(self.checkpoint))

    def with_atom(self, atom: Atom) -> "Condition":
        return Condition(self.checkpoint, (*self.atoms, atom))


def pattern_text(conditions: list[Condition]) -> str:
    return CONDITION_SEP.join(sorted(c.text for c in conditions))
