"""Mining inputs derived from the benchmark tables: orders x line items, user days, assets."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeseam.config import Feature, SearchParams
from lodeseam.conditions import Condition, Flag, InSet, Range

F1 = SearchParams(top_values=10, min_support=0.03, eval_cutoff=0.6, dedup_cutoff=0.01, concentration_cutoff=0.0,
                  lvl_limit=3, min_block_size=0.01)
#: For the whole jobs, which no twin with ten values a variable binds: every value that the gate admits.
EVERY_VALUE = replace(F1, top_values=None)
TIEBREAK = ("line_no", "part_no")

VARIABLES = (                      # variable, type, priority
    ("qty", "numeric", 1), ("disc_score", "numeric", 1), ("tax_pct", "numeric", 2),
    ("days_to_ship", "numeric", 3), ("lot", "numeric", 3), ("line_open", "bool", 1),
    ("p_type", "string", 1), ("p_brand", "string", 2), ("empty_var", "string", 3))
CP_PRIORITY = {"R": 1, "A": 1, "N": 2}

C1 = Condition("R", (Range("disc_score", lo=7),))
C2 = Condition("R", (Range("qty", lo=40),))
C3 = Condition("A", (Range("tax_pct", lo=6),))
C4 = Condition("N", (InSet("p_type", ("PROMO",)),))
R1 = Condition("R", (Range("disc_score", lo=7), Range("qty", lo=30)))
R2 = Condition("A", (Range("tax_pct", lo=6), Flag("line_open")))
R3 = [C2, C4]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    flag = F.col("l_returnflag")

    def any_row(c):
        return F.max(F.when(c, 1).otherwise(0))
    rules = (line.join(part, line.l_partkey == part.p_partkey)
             .groupBy(F.col("l_orderkey").alias("k")).agg(
                 any_row((flag == "R") & (F.col("l_discount") >= 0.08)
                         & (F.col("l_quantity") > 30)).alias("r1"),
                 any_row((flag == "A") & (F.col("l_tax") >= 0.07)
                         & (F.col("l_linestatus") == "O")).alias("r2"),
                 any_row((flag == "R") & (F.col("l_quantity") > 40)).alias("r3a"),
                 any_row((flag == "N") & (F.col("p_type") == "PROMO")).alias("r3b")))
    hit = (F.col("r1") == 1) | (F.col("r2") == 1) | ((F.col("r3a") == 1) & (F.col("r3b") == 1))
    return (table(spark, sf_dir, "orders").join(rules, F.col("o_orderkey") == F.col("k"), "left")
            .select(F.col("o_orderkey").cast("string").alias("key"),
                    F.col("o_custkey").cast("string").alias("acct"),
                    F.col("o_orderdate").alias("ts"),
                    F.when(F.col("o_custkey") % 50 == 0, None).when(hit, 1).otherwise(0).alias("tag"),
                    F.col("o_totalprice").alias("amt"),
                    (F.col("o_totalprice") * 0.10).alias("gloss"),
                    (F.col("o_totalprice") * 0.04).alias("nloss")))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    people = population(spark, sf_dir).select("key", "acct", "ts", "tag", "amt")
    days = F.date_diff(F.col("l_shipdate").cast("date"), F.col("ts").cast("date"))
    return (line.join(part, line.l_partkey == part.p_partkey)
            .join(people, people.key == line.l_orderkey.cast("string"))
            .select("key", "acct", "tag", "amt", F.col("l_returnflag").alias("checkpoint"),
                    F.col("l_shipdate").alias("timestamp"),
                    F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part_no"),
                    F.col("l_quantity").alias("qty"),
                    F.round(F.col("l_discount") * 100).alias("disc_score"),
                    F.round(F.col("l_tax") * 100).alias("tax_pct"),
                    F.greatest(days, F.lit(0)).cast("double").alias("days_to_ship"),
                    (F.col("l_linenumber") % 4).cast("double").alias("lot"),
                    (F.col("l_linestatus") == "O").alias("line_open"), "p_type", "p_brand",
                    F.lit(None).cast("string").alias("empty_var")))


_PEOPLE: dict[tuple[str, str], DataFrame] = {}
_CACHE: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def held_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The population, persisted once per session; whole jobs hold what they need of the activity themselves."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _PEOPLE:
        _PEOPLE[at] = population(spark, sf_dir).persist()
    return _PEOPLE[at]


def cached(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(population, activity), persisted once per session for jobs that scan them repeatedly."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _CACHE:
        _CACHE[at] = (held_people(spark, sf_dir), activity(spark, sf_dir).persist())
    return _CACHE[at]


def in_key_order(activity: DataFrame, variables: list[str]) -> DataFrame:
    """These variables of the activity, persisted in the order of the keys they are folded to; the caller lets go of it."""
    rows = activity.select("key", "acct", "tag", "checkpoint", *variables)
    return rows.sortWithinPartitions("key", "checkpoint", "tag").persist()


_HELD: dict[tuple, DataFrame] = {}


def held_rows(spark: SparkSession, sf_dir: str, variables: list[str]) -> DataFrame:
    """The same once per session, for results that are read later."""
    at = (spark.sparkContext.applicationId, sf_dir, *variables)
    if at not in _HELD:
        _HELD[at] = in_key_order(activity(spark, sf_dir), variables)
    return _HELD[at]


def features(checkpoints=("A", "N", "R"), skip=("empty_var",)) -> list[Feature]:
    return [Feature(cp, v, t, p, CP_PRIORITY[cp])
            for cp in checkpoints for v, t, p in VARIABLES if v not in skip]


def feature_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration row per observed checkpoint and variable, with role cells to expand."""
    seen = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("checkpoint")).distinct()
    rows = F.array(*[F.struct(F.lit(v).alias("variable name"), F.lit(t).alias("type"),
                              F.lit(p).alias("priority")) for v, t, p in VARIABLES])
    cp = F.create_map(*[F.lit(x) for kv in CP_PRIORITY.items() for x in kv])
    return (seen.select("checkpoint", F.explode(rows).alias("r")).select(
        "r.variable name", "r.type", "checkpoint",
        F.when(F.col("checkpoint") == "R", "sender/receiver").otherwise("sender").alias("key_type"),
        F.when(F.col("checkpoint") == "A", "sender/receiver")
        .when(F.col("checkpoint") == "R", "sender").alias("key_value"),
        "r.priority", cp[F.col("checkpoint")].alias("cp_priority")))


def user_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Second domain: (population, activity) of user days over the event stream."""
    events = table(spark, sf_dir, "events").withColumns({
        "key": F.concat_ws("|", F.col("user_id"), F.date_format("ts", "yyyy-MM-dd")),
        "k": F.get_json_object("props", "$.k").cast("double")})
    bad = (((F.col("event_type") == "error") & (F.col("value") > 60))
           | ((F.col("event_type") == "purchase") & (F.col("k") < 20)))
    people = events.groupBy("key").agg(
        F.min("user_id").cast("string").alias("acct"), F.min("ts").alias("ts"),
        F.max(F.when(bad, 1).otherwise(0)).alias("tag"), F.round(F.sum("value"), 2).alias("amt"))
    rows = (events.join(people.select("key", "acct", "tag", "amt"), "key")
            .select("key", "acct", "tag", "amt", F.col("event_type").alias("checkpoint"),
                    F.col("ts").alias("timestamp"), "event_id",
                    F.col("value").alias("value_amount"), "k",
                    F.hour("ts").cast("double").alias("hour")))
    return people, rows


def event_features() -> list[Feature]:
    kinds = ("click", "error", "purchase", "signup", "view")
    return [Feature(cp, v, "numeric", p, 1) for cp in kinds
            for v, p in (("value_amount", 1), ("k", 1), ("hour", 3))]


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset rows derived from the event stream, with a point in time that is sometimes missing."""
    events = table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.split("c_name", "#").alias("n"))

    def octet(column, step):
        return ((F.col(column) * step) % 256).cast("string")

    def millis(c):
        return F.unix_millis(F.col(c).cast("timestamp"))
    return (events.join(first, "user_id").join(names, "user_id", "left")
            .select("event_id",
                    F.concat_ws(".", octet("user_id", 1), octet("event_id", 1),
                                octet("user_id", 3), octet("event_id", 7)).alias("ipAddress"),
                    millis("first_ts").alias("creationTime"),
                    (millis("ts") + 43_200_000).alias("lastModifiedTime"),
                    F.when(F.col("event_id") % 10 != 0, millis("ts")).alias("pit"),
                    F.get("n", F.lit(0)).alias("firstName"), F.get("n", F.lit(1)).alias("lastName")))
