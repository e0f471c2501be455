"""Readers: population, activity, feature configuration, variable rules, exclusion map."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Roles, VariableRules
from ..session import small_table

FEATURE_SCHEMA = T.StructType([
    T.StructField("variable name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("checkpoint", T.StringType()),
    T.StructField("key_type", T.StringType()),
    T.StructField("key_value", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("cp_priority", T.IntegerType()),
])


def read_table(spark: SparkSession, source: str, fmt: str | None = None) -> DataFrame:
    """A catalog table by name, or a path when a format is given."""
    return spark.read.format(fmt).load(source) if fmt else spark.table(source)


def ingest(df: DataFrame, roles: Roles, row_filter: str | None = None) -> DataFrame:
    """Give role columns their canonical names and types; keep every other column.

    The optional filter is a plain predicate, so it reaches the scan.
    """
    if row_filter:
        df = df.where(row_filter)
    wanted = roles.mapping()
    renamed = set(wanted.values())
    out = []
    for name, column in wanted.items():
        if column not in df.columns:
            continue
        c = F.col(f"`{column}`")
        if name in ("key", "acct", "counter_acct"):
            c = c.cast("string")
        elif name == "tag":
            c = c.cast("int")
        elif name in ("amt", "gloss", "nloss"):
            c = c.cast("double")
        out.append(c.alias(name))
    for f in df.schema.fields:
        if f.name in renamed:
            continue
        c = F.col(f"`{f.name}`")
        out.append(c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c)
    return df.select(*out)


def read_population(spark, source, roles: Roles, row_filter=None, fmt=None, view: str = "population_view") -> DataFrame:
    """The population under canonical names, also as a view; runs that share a session name their own views."""
    df = ingest(read_table(spark, source, fmt), roles, row_filter)
    df.createOrReplaceTempView(view)
    return df


def read_activity(spark, source, roles: Roles, row_filter=None, fmt=None, view: str = "activity_view") -> DataFrame:
    """The activity under canonical names, also as a view; runs that share a session name their own views."""
    df = ingest(read_table(spark, source, fmt), roles, row_filter)
    df.createOrReplaceTempView(view)
    return df


def read_feature_config(spark: SparkSession, path: str) -> DataFrame:
    """The CSV by column name; a missing ``key_value`` column is read as null."""
    return feature_columns(spark.read.option("header", True).csv(path))


def feature_columns(raw: DataFrame) -> DataFrame:
    """The configuration's columns by name and type, absent ones as null."""
    return raw.select(*[
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in raw.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in FEATURE_SCHEMA.fields])


def read_variable_rules(spark: SparkSession, path: str) -> VariableRules:
    """Variable rules from a JSON file on any Spark-readable path; absent parts keep defaults."""
    spec = json.loads(spark.read.text(path, wholetext=True).first()[0])
    base = VariableRules()
    number = spec.get("number", {})
    direction = number.get("direction_setting", {})
    cuts = number.get("fix_bins_setting")
    return VariableRules(
        ignore_values=tuple(spec.get("string", {}).get("ignore_values", base.ignore_values)),
        false_vars=tuple(spec.get("bool", {}).get("false_vars", base.false_vars)),
        fixed_cuts=(base.fixed_cuts if cuts is None
                    else tuple((name, tuple(values)) for name, values in cuts.items())),
        up_names=direction.get("up", base.up_names),
        down_names=direction.get("down", base.down_names))


def exclusion_map(mapping: DataFrame, segments_json: str | None) -> DataFrame:
    """(checkpoint, variable, patterns) for the requested (segment, value) pairs."""
    spark = mapping.sparkSession
    pairs = [(p["name"], p["value"]) for p in json.loads(segments_json or "[]")]
    wanted = small_table(spark, pairs, "alert_segment string, alert_segment_value string")
    return (mapping.join(wanted, ["alert_segment", "alert_segment_value"], "left_semi")
            .groupBy("checkpoint", F.col("config_segment").alias("variable"))
            .agg(F.sort_array(F.collect_list("config_segment_value")).alias("patterns")))
