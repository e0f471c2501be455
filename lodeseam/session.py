"""Session helpers: where intermediate tables live and how big a broadcast may be."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a private one only where none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured and not current:
        spark.sparkContext.setCheckpointDir(configured)
    elif not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodeseam-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget how it was made."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def tuned(spark: SparkSession) -> Iterator[None]:
    """Session settings the search relies on for speed, put back afterwards; results do not depend on them.

    The JVM never compiles methods over 8000 bytes. The wide projections that turn rows into
    bits exceed that when fused into one method, so Spark is told to split them instead. Tables that are held in the order of
    their keys are aggregated in that order, in one step and without a hash table.
    """
    wanted = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.adaptive.enabled": "true",
              "spark.sql.execution.replaceHashWithSortAgg": "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A driver-held table; through Arrow it becomes a local relation of known size."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrow = to_arrow_schema(fields)
    return spark.createDataFrame(pa.table(
        [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow))


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A rule-sized table for a join.

    Its length is known here, so it is broadcast only under the bound; a longer one is left to
    the optimizer, which then shuffles.
    """
    df = local_table(spark, rows, schema)
    return F.broadcast(df) if len(rows) <= MAX_BROADCAST_ROWS else df
