"""Row and column shaping before the search: filters, recency cut, typing, configuration."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import KEY_TYPE_SUFFIX, KEY_VALUE_SUFFIX, ROLE_COPY_CHECKPOINTS, Feature

SPARK_TYPE = {"string": "string", "numeric": "double", "bool": "boolean"}


def outcome_activity(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("tag") == 1)


def size_gate(activity: DataFrame, cutoff: int) -> DataFrame:
    """One row: outcome activity size and whether it fits without the recency cut."""
    size = F.count_if(F.col("tag") == 1)
    return activity.agg(size.alias("size"), (size <= cutoff).alias("fits"))


def recent_rows(activity: DataFrame, k: int, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The latest ``k`` rows of each (key, checkpoint)."""
    order = [F.col("timestamp").desc(), *[F.col(f"`{c}`").desc() for c in tiebreak]]
    rank = F.row_number().over(W.partitionBy("key", "checkpoint").orderBy(*order))
    return activity.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def profiled_outcome(activity: DataFrame, k: int | None, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Outcome activity for profiling: all of it, or the latest ``k`` rows of each (key, checkpoint)."""
    outcome = outcome_activity(activity)
    return outcome if k is None else recent_rows(outcome, k, tiebreak)


def null_columns(df: DataFrame) -> list[str]:
    """Columns that are null on every row, found in one pass."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if not row[c]]


def drop_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*null_columns(df))


def typed(activity: DataFrame, types: dict[str, str], quotes: bool = False) -> DataFrame:
    """Cast the configured features and clean string values, in one projection.

    Text that does not parse as its type becomes null.
    """
    def shaped(c: str) -> Column:
        column = F.col(f"`{c}`")
        if c == "key":
            return column.cast("string").alias(c)
        if c not in types:
            return column
        column = column.try_cast(SPARK_TYPE[types[c]])
        return (clean_value(column, quotes) if types[c] == "string" else column).alias(c)
    return activity.select(*[shaped(c) for c in activity.columns])


# ---- feature configuration ---------------------------------------------------------------

def explode_roles(config: DataFrame, default_value: str = "sender") -> DataFrame:
    """One row per pair of roles named in the ``a/b`` cells."""
    return (config
            .withColumn("key_value", F.coalesce("key_value", F.lit(default_value)))
            .withColumn("key_type", F.explode(F.split("key_type", "/")))
            .withColumn("key_value", F.explode(F.split("key_value", "/"))))


def _lookup(values: dict[str, str], key: str) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col(key)]


def dual_scope(config: DataFrame) -> DataFrame:
    """Checkpoint names gain the suffixes of both roles."""
    return config.withColumn("checkpoint", F.concat(
        "checkpoint", _lookup(KEY_TYPE_SUFFIX, "key_type"),
        _lookup(KEY_VALUE_SUFFIX, "key_value")))


def single_scope(config: DataFrame, role_copies: str = ROLE_COPY_CHECKPOINTS) -> DataFrame:
    """Checkpoints that exist once per role also get a copy under each role's name."""
    suffixes = F.when(F.col("checkpoint").rlike(role_copies),
                      F.array(F.lit(""), F.lit("_send"), F.lit("_recv"))).otherwise(
                          F.array(F.lit("")))
    return (config.withColumn("_suffix", F.explode(suffixes))
            .withColumn("checkpoint", F.concat("checkpoint", "_suffix")).drop("_suffix"))


def without_variables(config: DataFrame, names: list[str]) -> DataFrame:
    return config.where(~F.col("variable name").isin(*names)) if names else config


def expand_config(config: DataFrame, scope: str, deprecated: list[str] = (),
                  missing: list[str] = (), role_copies: str = ROLE_COPY_CHECKPOINTS) -> DataFrame:
    out = without_variables(explode_roles(config), list(deprecated))
    out = dual_scope(out) if scope == "dual" else out
    out = without_variables(out, list(missing))
    return single_scope(out, role_copies) if scope == "single" else out


def unique_features(config: DataFrame) -> DataFrame:
    """One row per (checkpoint, variable), the strongest priority winning."""
    return (config.groupBy("checkpoint", F.col("variable name").alias("variable"))
            .agg(F.min("type").alias("type"), F.min("priority").alias("priority"),
                 F.min("cp_priority").alias("cp_priority")))


def features_by_checkpoint(config: DataFrame) -> DataFrame:
    return (unique_features(config).groupBy("checkpoint")
            .agg(F.sort_array(F.collect_set("variable")).alias("variables"),
                 F.min("cp_priority").alias("cp_priority")))


def collect_features(config: DataFrame) -> list[Feature]:
    """Configuration-sized, so the driver may hold it."""
    rows = unique_features(config).orderBy("checkpoint", "variable").collect()
    return [Feature(r.checkpoint, r.variable, r.type, r.priority, r.cp_priority) for r in rows]


# ---- string values -----------------------------------------------------------------------

def clean_value(c: Column, quotes: bool = False) -> Column:
    """Strip line breaks and tabs (and quotes, in the stricter variant)."""
    return F.translate(c, "\r\n\t" + ("'\"" if quotes else ""), "")


def keep_value(c: Column, ignore: tuple[str, ...]) -> Column:
    return ~c.isin(*ignore) if ignore else F.lit(True)


def not_excluded(values: DataFrame, exclusions: DataFrame | None) -> DataFrame:
    """Drop (checkpoint, variable, value) rows whose value matches an excluded pattern."""
    if exclusions is None:
        return values
    joined = exclusions.select("checkpoint", "variable",
                               F.array_join("patterns", "|").alias("_pattern"))
    hit = F.coalesce(F.rlike("value", F.col("_pattern")), F.lit(False))
    return (values.join(joined, ["checkpoint", "variable"], "left")
            .where(~hit).drop("_pattern"))


def name_matches(pattern: str, variable: str) -> bool:
    return bool(pattern) and re.search(pattern, variable, re.IGNORECASE) is not None
