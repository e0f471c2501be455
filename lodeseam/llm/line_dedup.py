"""Line dedup: repeated runs of lines are found in a suffix array of line ids; later copies go.

A run of successive lines of one document is deleted if it has at least ``min_words`` words and
occurs before as well: earlier in the order of (doc_id, text hash, line), possibly overlapping. A line goes if any such run covers it.

1. Lines that occur once end every repeated run, so only the others get a position; positions that
   follow each other are successive lines.
2. The suffix array is built by prefix doubling: a suffix's rank by its first line, then by its first
   2, 4, 8, ... lines, each from two ranks of the round before. A rank is the number of smaller
   suffixes, from counts of distinct pairs of ranks in range partitions. Doubling
   ends once it is as deep as the longest window of step 3.
3. The suffixes that share their first n lines form one interval of the array. It is named by the ranks
   of the two halves (overlapping, of 2^j lines each) of that prefix, and its first copy is its least
   position. Intervals are taken for each line's shortest window of ``min_words`` words forwards, and each
   line's shortest window backwards: a maximal repeated run is the union of the windows in it.
4. Later copies cover lines; covered lines are left out of the text.

DataFrame operations only. Line ids are two 64-bit hashes.

Defined cases: a null text stays null; a text that loses all lines becomes empty; empty lines count
as lines without words; rows equal in doc_id and text are one document and all lose the same lines; null
doc_ids come first; documents without deletions and all other columns come back unchanged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeseam.llm.common import running_total, sized, stored

MIN_WORDS = 50
#: Up to so many changed documents the runs to delete are broadcast to the texts.
SMALL_CHANGES = 200_000


def lines_of(documents: DataFrame) -> DataFrame:
    """(doc_id, __hash, line, a, b, words): every line with its id (a, b) and number of words."""
    texts = documents.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("__hash"))
    line = F.col("__line")
    return (texts.select("doc_id", "__hash", F.posexplode(F.split("text", "\n")).alias("line", "__line"))
            .select("doc_id", "__hash", "line", F.xxhash64(line).alias("a"), F.xxhash64(F.lit(17), line).alias("b"),
                    (F.size(F.split(line, r"\S+")) - 1).alias("words")))


def positions(lines: DataFrame) -> DataFrame:
    """(doc, pos, doc_id, __hash, line, a, b, words) of the lines that occur at several places.

    ``doc`` is the position that the document's line 0 has; positions of documents do not touch.
    """
    place = F.xxhash64("doc_id", "__hash", "line")
    again = (lines.groupBy("a", "b").agg(F.min(place).alias("low"), F.max(place).alias("high"))
             .where("low <> high").select("a", "b"))
    kept = stored(lines.join(sized(stored(again)), ["a", "b"]).distinct())
    spans = kept.groupBy("doc_id", "__hash").agg((F.max("line") + 2).cast("long").alias("span"))
    starts = stored(running_total(spans, ["doc_id", "__hash"], "span", "doc").drop("span"))
    starts = starts.withColumnsRenamed({"doc_id": "__id", "__hash": "__h"})
    return (kept.join(sized(starts), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h")))
            .select("doc", (F.col("doc") + F.col("line")).alias("pos"), "doc_id", "__hash", "line", "a", "b", "words"))


def windows(rows: DataFrame, min_words: int) -> DataFrame:
    """(doc, start, n): of each line the shortest windows of ``min_words`` words from it and up to it.

    The other end is the nearest line by words so far, found by sorting lines and wanted word counts
    together within a stretch of successive lines.
    """
    in_doc = Window.partitionBy("doc").orderBy("pos")
    rows = rows.select("doc", "pos", "words", (F.col("pos") - F.row_number().over(in_doc)).alias("stretch"))
    stretch = Window.partitionBy("doc", "stretch")
    rows = (rows.withColumn("after", F.sum("words").over(stretch.orderBy("pos")))
            .withColumn("before", F.col("after") - F.col("words"))
            .withColumn("last", F.max("pos").over(stretch)).withColumn("total", F.max("after").over(stretch)))
    point = F.when(F.col("line"), F.col("pos"))

    def with_wanted(wanted):
        return rows.withColumn("line", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn(
            "key", F.when(F.col("line"), F.col("before")).otherwise(wanted))

    def near(*order):
        by = stretch.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return F.last(point, ignorenulls=True).over(by)
    forward = (with_wanted(F.col("before") + min_words)
               .withColumn("next", near(F.desc("key"), F.desc("line"), F.desc("pos"))).where("not line")
               .withColumn("end", F.coalesce(F.col("next") - 1, F.when(F.col("total") - F.col("before") >= min_words,
                                                                       F.col("last"))))
               .select("doc", F.col("pos").alias("start"), F.col("end").alias("end")))
    backward = (with_wanted(F.col("after") - min_words)
                .withColumn("prev", near(F.asc("key"), F.desc("line"), F.asc("pos"))).where("not line")
                .select("doc", F.col("prev").alias("start"), F.col("pos").alias("end")))
    return (forward.union(backward).where("start is not null and end is not null")
            .select("doc", "start", (F.col("end") - F.col("start") + 1).alias("n")).distinct())


def ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """(pos, rank): the number of suffixes whose keys are smaller."""
    classes = suffixes.groupBy(*keys).agg(F.count("*").alias("__n"))
    ranks = stored(running_total(classes, keys, "__n", "__rank").drop("__n"))
    return stored(suffixes.join(sized(ranks), keys).select("pos", F.col("__rank").alias("rank")))


def doubled(suffixes: DataFrame, depth: int) -> DataFrame:
    """Ranks by twice ``depth`` lines; a suffix that ends before is the smaller."""
    second = suffixes.select((F.col("pos") - depth).alias("pos"), F.col("rank").alias("second"))
    pairs = suffixes.join(second, "pos", "left").withColumn("second", F.coalesce("second", F.lit(-1)))
    return ranked(pairs, ["rank", "second"])


def first_copies(of_depth: DataFrame, suffixes: DataFrame, depth: int) -> DataFrame:
    """(start, n) of the first copy in the interval of each window of depth to 2 depth - 1 lines."""
    def rank_at(place, name):
        return suffixes.select(F.col("pos").alias(place), F.col("rank").alias(name))
    named = (of_depth.withColumn("second", F.col("start") + F.col("n") - depth)
             .join(rank_at("start", "left"), "start").join(rank_at("second", "right"), "second"))
    return named.groupBy("left", "right", "n").agg(F.min("start").alias("start")).select("start", "n")


def deleted_runs(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, __hash, runs): per document the lines to delete, as [first, last] runs."""
    rows = stored(positions(stored(lines_of(documents))))
    found = stored(windows(rows, min_words))
    longest = found.agg(F.max("n")).first()[0] or 0
    suffixes, depth, firsts = ranked(rows.select("pos", "a", "b"), ["a", "b"]), 1, []
    while longest:
        of_depth = found.where((F.col("n") >= depth) & (F.col("n") < 2 * depth))
        firsts.append(stored(first_copies(of_depth, suffixes, depth)))
        if 2 * depth > longest:
            break
        suffixes, depth = doubled(suffixes, depth), 2 * depth
    later = found.join(reduce(DataFrame.union, firsts), ["start", "n"], "left_anti") if firsts else found
    changes = (later.select("doc", F.col("start").alias("pos"), F.lit(1).alias("change"))
               .union(later.select("doc", F.col("start") + F.col("n"), F.lit(-1)))
               .groupBy("doc", "pos").agg(F.sum("change").alias("change")))
    at = Window.partitionBy("doc").orderBy("pos", "line")
    covered = (rows.select("doc", "pos", F.col("line"), F.lit(0).cast("long").alias("change"))
               .union(changes.select("doc", "pos", F.lit(-1), "change"))
               .withColumn("cover", F.sum("change").over(at)).where("line >= 0 and cover > 0"))
    runs = (covered.withColumn("run", F.col("line") - F.row_number().over(at))
            .groupBy("doc", "run").agg(F.min("line").alias("first"), F.max("line").alias("last")))
    per_doc = runs.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    names = rows.select("doc", "doc_id", "__hash").distinct()
    return per_doc.join(names, "doc").select("doc_id", "__hash", "runs")


def without_later_copies(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(n_lines, n_deleted, row): the documents, with later copies of repeated runs deleted from the text of ``row``.

    The documents travel as a struct, so that no column of theirs meets one of this module's.
    """
    runs = stored(deleted_runs(documents.select("doc_id", "text"), min_words))
    runs = sized(runs.withColumnsRenamed({"doc_id": "id", "__hash": "hash"}), SMALL_CHANGES)
    doc_id, text, row = F.col("row.doc_id"), F.col("row.text"), F.col("row")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda _, i: ~F.exists("runs", lambda r: i.between(r["first"], r["last"])))
    n_deleted = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    rows = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row"))
    joined = rows.join(runs, doc_id.eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("hash")), "left")
    return joined.select(F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.coalesce(n_deleted, F.lit(0)).alias("n_deleted"),
                         F.when(F.col("runs").isNull(), row).otherwise(row.withField("text", F.array_join(kept, "\n"))).alias("row"))
