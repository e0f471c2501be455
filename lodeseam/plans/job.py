"""The whole job: read the tables, search, write the tagged population and the result tables."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..config import Roles, SearchParams, VariableRules
from ..functions.metrics import Registry
from ..operators import shape
from ..sources import results, tables
from .mining import MiningResult, mine


@dataclass(frozen=True)
class Job:
    """Where a run reads and writes. ``ids`` is a job id, or a batch id and an alert id."""

    population: str
    activity: str
    feature_config: str
    ids: dict[str, str]
    roles: Roles = field(default_factory=Roles)
    params: SearchParams = field(default_factory=SearchParams)
    input_format: str | None = None        # None: the sources are catalog tables
    row_filter: str | None = None
    rules_path: str | None = None
    metrics_path: str | None = None
    exclusion_table: str | None = None
    exclusion_segments: str | None = None  # JSON list of {"name": .., "value": ..}
    deprecated: tuple[str, ...] = ()
    tiebreak: tuple[str, ...] = ()         # orders rows of equal time, for params.recent_rows
    tag_table: str = "pattern_tags"        # a digest of the run's ids is appended: each run has its own
    pattern_table: str = "pattern_results"
    condition_table: str = "condition_results"
    log_table: str = "pattern_jobs"
    stage_table: str = "pattern_stages"
    retention_days: int = 14

    def digest(self) -> str:
        """Different for different ids, whatever characters they hold, also where names ignore case."""
        return hashlib.sha256(json.dumps(self.ids, sort_keys=True).encode()).hexdigest()

    def tags(self) -> str:
        """The name of this run's table of tags."""
        return f"{self.tag_table}_{self.digest()}"

    def kinds(self) -> tuple[str, str, str, str]:
        prefix = "service" if "job_id" in self.ids else "fp"
        return f"{prefix}_result", f"{prefix}_act_res", f"{prefix}_log", f"{prefix}_stage"


def run(spark: SparkSession, job: Job) -> MiningResult:
    """Run once; running again with the same ids replaces what the first run wrote.

    Tags of any run that the log says has retired are dropped first.
    """
    pattern_kind, condition_kind, log_kind, stage_kind = job.kinds()
    outputs = ((job.pattern_table, pattern_kind), (job.condition_table, condition_kind),
               (job.log_table, log_kind), (job.stage_table, stage_kind))
    for table, kind in outputs:
        results.ensure_table(spark, table, kind)
    results.sweep(spark, job.log_table, job.tag_table)
    results.drop_if_expired(spark, job.tags())
    population = tables.read_population(spark, job.population, job.roles, job.row_filter,
                                        job.input_format, f"population_{job.digest()}")
    activity = tables.read_activity(spark, job.activity, job.roles, job.row_filter,
                                    job.input_format, f"activity_{job.digest()}")
    listed = tables.read_feature_config(spark, job.feature_config)
    names = {r[0] for r in listed.select("variable name").distinct().collect()}  # rule-sized
    held = [f"`{c}`" for c in activity.columns if c in names]
    missing = shape.null_columns(shape.outcome_activity(activity).select(*held)) if held else []
    config = shape.expand_config(listed, job.params.search_scope, list(job.deprecated), missing)
    rules = tables.read_variable_rules(spark, job.rules_path) if job.rules_path else VariableRules()
    registry = Registry.load(spark, job.metrics_path) if job.metrics_path else None
    found = mine(population, activity, shape.collect_features(config), job.params, rules,
                 _exclusions(spark, job), registry, job.tiebreak)
    if not found.found:  # what an earlier run wrote goes only after a search that found nothing
        for table, kind in outputs:
            results.clear_run(spark, table, kind, job.ids)
    else:
        results.write_tagged(found.tagged, job.tags(), job.retention_days)
        results.write_run(results.pattern_rows(spark, found.patterns), job.pattern_table,
                          pattern_kind, job.ids)
        results.write_run(results.condition_rows(found.condition_catalog), job.condition_table,
                          condition_kind, job.ids)
        results.write_run(results.job_row(spark, job.tags(), job.retention_days),
                          job.log_table, log_kind, job.ids)
        results.write_run(results.stage_rows(spark, found.stages), job.stage_table, stage_kind, job.ids)
    found.release()
    return found


def _exclusions(spark: SparkSession, job: Job) -> DataFrame | None:
    if not (job.exclusion_table and job.exclusion_segments):
        return None
    return tables.exclusion_map(spark.table(job.exclusion_table), job.exclusion_segments)
