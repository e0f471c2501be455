"""The corpus pipeline: quality, line dedup, near duplicates, decontamination, then BPE.

Every stage but the last takes and returns all columns of ``documents`` and works on whatever the stage before
kept. Null texts count as empty; rows with a null doc_id are kept or dropped by their text alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeseam.llm import decontaminate, jaccard, lexicon, line_dedup, quality
from lodeseam.llm.common import discard, sized, stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier scores 0.3 or more."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(model, F.col("text")) >= 0.3)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without later copies of repeated line runs; one that loses all its lines goes.

    ``n_chars`` follows the text where it changes.
    """
    cleaned = line_dedup.without_later_copies(docs).where("n_deleted = 0 or n_deleted < n_lines")
    row = F.col("row")
    if "n_chars" in docs.columns:
        kept = docs.schema["n_chars"].dataType
        row = F.when(F.col("n_deleted") > 0, row.withField("n_chars", F.length("row.text").cast(kept))).otherwise(row)
    return cleaned.select(row.alias("row")).select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by word shingles, directly or not, the one of smallest id, null ids last.

    Each row is judged by its own text, whatever its id. Of rows of one group and id the one of smallest text hash stays, and
    of rows equal in both one, the first by all columns. Texts without words are linked with nothing and all stay.
    """
    spare = stored(jaccard.spare_rows(docs).withColumnsRenamed({"doc_id": "id", "text_hash": "hash"}))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))  # no column of theirs meets one of these
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("hash"))
    kept = rows.join(sized(spare), same, "left_anti").select("row.*")
    repeated = spare.where("first")
    if repeated.isEmpty():
        return kept
    one = (rows.join(sized(repeated), same, "left_semi").groupBy("row.doc_id", F.xxhash64("row.text").alias("hash"))
           .agg(F.min_by("row", F.to_json("row")).alias("row")))
    return kept.union(one.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    found = decontaminate.contaminated(table(spark, sf_dir, "benchmark"), F.col("text"))
    return docs.where(~found)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text that is left."""
    return lexicon.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", keep_good), ("line dedup", drop_repeated_lines), ("near duplicates", keep_one_of_each_group),
          ("decontamination", drop_contaminated), ("bpe", encode)]
#: SQL expresses neither the trained score nor the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return docs
