"""Result tables: schemas, creation, idempotent writes, retention."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.select import Pattern

# Columns of the result tables. The ids of a run come first in every row.
_PATTERN = ("pattr_name string, pattr_id string, pattr_content string, cp_str string, "
            "target_rate double, target_catch double, inc_catch double, inc_catch_share double, "
            "pattr_fscore double, pattr_score double, other_metrics string, after_dedup boolean, "
            "update_dt date, update_ts timestamp")
_CONDITION = ("act_id string, act_content string, target_rate double, target_catch double, "
              "update_dt date, update_ts timestamp")
_LOG = "content string, update_dt date, update_ts timestamp"
_STAGE = "stage string, content string, catch double, rate double, update_dt date, update_ts timestamp"
KINDS: dict[str, tuple[tuple[str, ...], str]] = {
    "fp_result": (("batch_id", "alert_id"), _PATTERN),
    "service_result": (("job_id",), _PATTERN),
    "fp_act_res": (("batch_id", "alert_id"), _CONDITION),
    "service_act_res": (("job_id",), _CONDITION),
    "fp_log": (("batch_id", "alert_id"), _LOG),
    "service_log": (("job_id",), _LOG),
    "fp_stage": (("batch_id", "alert_id"), _STAGE),
    "service_stage": (("job_id",), _STAGE),
}


def ensure_table(spark: SparkSession, table: str, kind: str) -> None:
    """Create the result table of this kind unless it exists; the run ids partition it."""
    ids, columns = KINDS[kind]
    if not spark.catalog.tableExists(table):
        keys = ", ".join(f"{i} string" for i in ids)
        spark.sql(f"CREATE TABLE {table} ({columns}, {keys}) USING parquet "
                  f"PARTITIONED BY ({', '.join(ids)})")


def _partition(kind: str, ids: dict[str, str]) -> str:
    if set(ids) != set(KINDS[kind][0]):
        raise ValueError(f"{kind} is identified by {KINDS[kind][0]}")

    def quoted(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(f"{k}={quoted(v)}" for k, v in ids.items())


def clear_run(spark: SparkSession, table: str, kind: str, ids: dict[str, str]) -> None:
    """Remove what an earlier attempt of this run wrote."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_partition(kind, ids)})")


def write_run(rows: DataFrame, table: str, kind: str, ids: dict[str, str]) -> None:
    """Replace this run's partition; other runs stay as they are."""
    spark = rows.sparkSession
    ensure_table(spark, table, kind)
    columns = ", ".join(c for c in spark.table(table).columns if c not in ids)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({_partition(kind, ids)}) "
              f"SELECT {columns} FROM {{rows}}", rows=rows)


def pattern_rows(spark: SparkSession, patterns: list[Pattern]) -> DataFrame:
    """One row per qualified pattern; numbers to four places, other metrics as JSON."""
    raw = spark.createDataFrame(
        [(p.name, p.content, p.cp_str, p.target_rate, p.target_catch, p.inc_catch,
          p.inc_catch_share, p.pattr_fscore, p.pattr_score,
          {k: float(v) for k, v in p.metrics.items()}, p.after_dedup) for p in patterns],
        "pattr_name string, pattr_content string, cp_str string, target_rate double, "
        "target_catch double, inc_catch double, inc_catch_share double, pattr_fscore double, "
        "pattr_score double, metrics map<string,double>, after_dedup boolean")
    rounded = {c: F.round(c, 4) for c in ("target_rate", "target_catch", "inc_catch",
                                          "inc_catch_share", "pattr_fscore", "pattr_score")}
    metrics = F.to_json(F.transform_values("metrics", lambda _, v: F.round(v, 4)))
    return _stamped(raw.withColumns(rounded).withColumn("other_metrics", metrics)
                    .drop("metrics"), "pattr_id", "pattr_")


def condition_rows(measured: DataFrame) -> DataFrame:
    """One row per distinct condition, from (content, target_catch, target_rate)."""
    raw = measured.select(F.col("content").alias("act_content"),
                          F.round("target_rate", 4).alias("target_rate"),
                          F.round("target_catch", 4).alias("target_catch"))
    return _stamped(raw, "act_id", "act_")


def stage_rows(spark: SparkSession, stages: list[tuple[str, str, float, float | None]]) -> DataFrame:
    """What each stage of a search came to (condition, leaf, set, measured, kept, ranked): content, catch, rate.

    The catch of a set is its support; catch and rate of a ranked pattern are its increment and share.
    """
    return spark.createDataFrame(stages, "stage string, content string, catch double, rate double").withColumns(
        {"update_dt": F.current_date(), "update_ts": F.current_timestamp()})


def _stamped(rows: DataFrame, id_column: str, prefix: str) -> DataFrame:
    name = F.concat(F.lit(prefix), F.replace(F.uuid(), F.lit("-"), F.lit("")))
    return rows.withColumns({id_column: name, "update_dt": F.current_date(),
                             "update_ts": F.current_timestamp()})


def job_row(spark: SparkSession, tag_table: str, retention_days: int,
            today: date | None = None) -> DataFrame:
    """What the run produced and when it retires, as JSON."""
    created = today or datetime.now().date()
    content = json.dumps({"pattr_table_name": tag_table, "create_dt": created.isoformat(),
                          "retire_dt": (created + timedelta(days=retention_days)).isoformat()})
    return spark.createDataFrame([(content,)], "content string").withColumns(
        {"update_dt": F.current_date(), "update_ts": F.current_timestamp()})


def write_tagged(tagged: DataFrame, table: str, retention_days: int = 14) -> None:
    """The tagged population as a table that knows when it expires."""
    expires = F.current_timestamp() + F.make_dt_interval(F.lit(retention_days))
    tagged.withColumn("expires_at", expires).write.mode("overwrite").saveAsTable(table)


def drop_if_expired(spark: SparkSession, table: str, now: datetime | None = None) -> bool:
    """Retention upkeep: drop the table once its last row has expired."""
    if not spark.catalog.tableExists(table):
        return False
    last = spark.table(table).agg(F.max("expires_at")).first()[0]
    if last is None or last > (now or datetime.now()):
        return False
    spark.sql(f"DROP TABLE {table}")
    return True


def sweep(spark: SparkSession, log_table: str, tag_table: str, today: date | None = None) -> list[str]:
    """Drop the tag tables, of whatever run, whose job rows say that they have retired; their names.

    Only names that begin with ``tag_table`` are taken from the log. A run that was repeated has one row, with its last dates.
    """
    def entry(name: str) -> Column:
        return F.get_json_object("content", f"$.{name}")
    named = spark.table(log_table).groupBy(entry("pattr_table_name").alias("name")).agg(F.max(entry("retire_dt")).alias("last"))
    retired = named.where((F.col("last") <= F.lit((today or datetime.now().date()).isoformat()))
                          & F.col("name").startswith(f"{tag_table}_"))
    dropped = [r.name for r in retired.orderBy("name").collect() if spark.catalog.tableExists(r.name)]  # a row per run
    for name in dropped:
        spark.sql(f"DROP TABLE {name}")
    return dropped
