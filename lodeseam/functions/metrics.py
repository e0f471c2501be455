"""Report metrics, KPI selection and the F-score.

Every metric is a ratio or a copy of plain sums, so groups can be pre-aggregated to the sums
and combined in any order; the metric values are worked out once at the end.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..config import AMOUNT, COUNT

EPS = 0.0001                     # fixed value: smoothing term of every ratio

# sum name -> (roles it needs, row expression)
ROW_SUMS: dict[str, tuple[tuple[str, ...], str]] = {
    "firing_cnt": ((), "1"),
    "firing_amt": (("amt",), "amt"),
    "target_cnt": (("tag",), "if(tag = 1, 1, 0)"),
    "target_amt": (("tag", "amt"), "if(tag = 1, amt, 0D)"),
    "gloss": (("gloss",), "gloss"),
    "nloss": (("nloss",), "nloss"),
    "labelled_cnt": (("tag",), "if(tag in (0, 1), 1, 0)"),
    "labelled_amt": (("tag", "amt"), "if(tag in (0, 1), amt, 0D)"),
}

# metric name -> expression over the sums of its group and total_<sum> over all groups
METRICS: dict[str, str] = {
    "firing_cnt": "firing_cnt",
    "firing_amt": "firing_amt",
    "target_cnt": "target_cnt",
    "target_amt": "target_amt",
    "gloss": "gloss",
    "nloss": "nloss",
    "target_cnt_rate": "target_cnt / (labelled_cnt + {eps})",
    "target_amt_rate": "target_amt / (labelled_amt + {eps})",
    "gloss_rate": "gloss / (firing_amt + {eps})",
    "target_cnt_catch_rate": "target_cnt / (total_target_cnt + {eps})",
    "target_amt_catch_rate": "target_amt / (total_target_amt + {eps})",
    "gloss_catch_rate": "gloss / (total_gloss + {eps})",
    "nloss_catch_rate": "nloss / (total_nloss + {eps})",
}


@dataclass(frozen=True)
class Registry:
    """The sums and metrics to report; extend it with further SQL expressions."""

    row_sums: dict[str, tuple[tuple[str, ...], str]]
    metrics: dict[str, str]

    @staticmethod
    def default() -> "Registry":
        return Registry(dict(ROW_SUMS), dict(METRICS))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Registry":
        """Defaults plus the ``sums`` and ``metrics`` of a JSON file on any Spark-readable path."""
        text = spark.read.text(path, wholetext=True).first()[0]
        extra = json.loads(text)
        base = Registry.default()
        base.row_sums.update({name: (tuple(spec.get("roles", ())), spec["row"])
                              for name, spec in extra.get("sums", {}).items()})
        base.metrics.update(extra.get("metrics", {}))
        return base

    def for_roles(self, columns: list[str]) -> "Registry":
        """Only what the available role columns can feed."""
        sums = {n: s for n, s in self.row_sums.items() if set(s[0]) <= set(columns)}
        dropped = set(self.row_sums) - set(sums)
        metrics = {n: e for n, e in self.metrics.items() if not _names(e) & dropped}
        return Registry(sums, metrics)

    def sum_columns(self) -> list[Column]:
        return [F.coalesce(F.sum(F.expr(row).cast("double")), F.lit(0.0)).alias(name)
                for name, (_, row) in self.row_sums.items()]

    def resum_columns(self) -> list[Column]:
        return [F.sum(name).alias(name) for name in self.row_sums]

    def metric_columns(self) -> list[Column]:
        """Metric values from a row that has the sums and ``total_*`` columns."""
        return [F.coalesce(F.expr(e.format(eps=f"{EPS}D")), F.lit(0.0)).alias(n)
                for n, e in self.metrics.items()]


def _names(expression: str) -> set[str]:
    words = "".join(c if c.isalnum() or c == "_" else " " for c in expression).split()
    return {w.removeprefix("total_") for w in words}


def kpi_columns(metric: str, catch: str = "target_catch", rate: str = "target_rate") -> list[Column]:
    """Catch and rate over rows that carry one ``tag`` (and ``amt``) per key.

    The last digits of a sum of amounts depend on the order of the rows, and the search compares
    figures; rounding well below any meaningful digit keeps its decisions the same on every run.
    """
    value = {COUNT: F.lit(1.0), AMOUNT: F.col("amt").cast("double")}[metric]
    caught = F.coalesce(F.sum(F.when(F.col("tag") == 1, value).otherwise(0.0)), F.lit(0.0))
    labelled = F.sum(F.when(F.col("tag").isin(0, 1), value).otherwise(0.0))
    share = F.coalesce(caught / (labelled + F.lit(EPS)), F.lit(0.0))
    return [F.round(caught, 6).alias(catch), F.round(share, 10).alias(rate)]


def fscore(rate: Column, share: Column, beta: float = 1.0) -> Column:
    """F-beta of rate and catch share; zero unless both are positive."""
    b2 = F.lit(beta * beta)
    return F.when((rate > 0) & (share > 0),
                  (1 + b2) * rate * share / (b2 * rate + share)).otherwise(0.0)


def f_beta(rate: float, share: float, beta: float = 1.0) -> float:
    """The same for figures the driver already holds."""
    if rate <= 0 or share <= 0:
        return 0.0
    return (1 + beta * beta) * rate * share / (beta * beta * rate + share)
