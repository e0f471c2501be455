"""Audit of how the sources of a language differ: pairs of sources, and the terms that set a source apart.

Terms are runs of letters A-Z and characters above U+007F, A-Z lower-cased. A language keeps the terms that occur in at least
``MIN_DOCS`` of its rows. A group is a (lang, source) that occurs, a null text, lang or source being empty. In a group, or in the whole
language, a kept term of count c has p = 1 + floor(10^9 * (c + 1) / (N + V)): N the sum of c over the kept terms, V their number. The
price of a term is floor((p - q)^2 / q). A group's price against another group is the sum over all kept terms; against its
language each of its own terms with p > q is priced and the dearest ``TOP`` are listed. All arithmetic is in whole numbers.

Counting: a task adds up the terms of its rows per group; the sums move once, by (lang, term). Kept terms are numbered by (lang, term);
``BLOCK`` consecutive numbers are a block. A group's terms of a block are one row: two arrays sorted by term, so no array
grows with the vocabulary. A pair task co-groups the rows of two groups of a language for one block and walks the shorter array
through the longer by galloping: that prices the terms of both, of one only and of the other only, both ways at once. Terms that neither
has cost the same each; they are counted over all blocks and added at the end.

Defined cases: a group without (kept) terms has N = 0 and takes part; with V = 0 all prices are 0; a source without a partner
has no pairs; repeated rows count each; ids, also null ones, and extra columns play no part; texts of any length are read whole, in pieces;
an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeseam.llm.common import running_total, sized, stored

MIN_DOCS, TOP, UNIT = 3, 200, 1_000_000_000
#: Terms of a block; distinct (group, term) sums a task holds; bytes of a text split at once.
BLOCK, HELD, CUT = 1 << 16, 500_000, 4_000_000
_TERM = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(text: bytes) -> Iterator[bytes]:
    """The text, lower-cased, with a space for every byte outside terms, in pieces that cut no term."""
    at = 0
    while len(text) - at > CUT:
        part = text[at:at + CUT].translate(_TERM)
        end = part.rfind(b" ")
        if end < 0:
            break
        yield part[:end]
        at += end + 1
    yield text[at:].translate(_TERM)


def term_sums(documents: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): occurrences and rows with the term, added up per group and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (count, docs) in sums.items():
                n = len(count)
                yield pa.record_batch([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                                       pa.array(count.keys(), pa.binary()).cast(pa.string()), pa.array(count.values(), pa.int64()),
                                       pa.array([docs[t] for t in count], pa.int64())],
                                      names=["lang", "source", "term", "count", "docs"])
            sums.clear()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                count, docs = sums[lang, source]
                met: set[bytes] = set()
                for piece in pieces(text.as_py()):
                    found = piece.split()
                    count.update(found)
                    met.update(found)
                docs.update(met)
            if sum(len(count) for count, _ in sums.values()) > HELD:
                yield from rows()
        yield from rows()
    return documents.mapInArrow(run, "lang string, source string, term string, count long, docs long")


def kept_terms(documents: DataFrame) -> DataFrame:
    """(lang, term, place, total, held): a row per kept term, numbered over all languages; ``held`` has source and count."""
    sums = term_sums(documents).repartition("lang", "term")  # also deals what the next two steps group by
    per_group = sums.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    per_term = (per_group.groupBy("lang", "term")
                .agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"), F.collect_list(F.struct("source", "count")).alias("held"))
                .where(F.col("docs") >= MIN_DOCS).select("lang", "term", "total", "held", F.lit(1).alias("one")))
    return running_total(per_term, ["lang", "term"], "one", "place").drop("one")


def price_of(count: Column | int, size: Column, terms: Column) -> Column:
    """p of a count, as a whole number of any size."""
    wide = "decimal(28,0)"
    part = F.lit(UNIT).cast("decimal(10,0)") * (F.lit(1) + count).cast(wide)
    return F.call_function("div", part, (size + terms).cast(wide)) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def per_billion(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total), by long division in steps of a thousand so that nothing overflows."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + more
    return whole + 1


def gallop(needles: np.ndarray, hay: np.ndarray, stride: int = 64) -> np.ndarray:
    """Where each needle stands, or would stand, in ``hay``; both ascending.

    Every ``stride``-th needle is sought in the rest of ``hay``; those between start at its place, double their
    step until they have passed their target, and halve the last step.
    """
    anchors = np.searchsorted(hay, needles[::stride])
    low = np.repeat(anchors, stride)[:len(needles)]
    step = np.ones(len(needles), np.int64)
    going = np.arange(len(needles))
    while len(going):
        probe = low[going] + step[going] - 1
        going = going[(probe < len(hay)) & (hay[np.minimum(probe, len(hay) - 1)] < needles[going])] if len(hay) else going[:0]
        low[going] += step[going]
        step[going] *= 2
    high = np.minimum(low + step - 1, len(hay))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        before = open_ & (hay[np.minimum(middle, len(hay) - 1)] < needles)
        low = np.where(before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low


def priced(a: np.ndarray, b: np.ndarray, a_count: np.ndarray, b_count: np.ndarray, a_total: int, b_total: int) -> tuple[int, int, int]:
    """Sums of the prices of a's terms against b and of b's against a, over the terms of either, and their number."""
    swapped = len(a) > len(b)
    if swapped:
        a, b, a_count, b_count, a_total, b_total = b, a, b_count, a_count, b_total, a_total
    at = gallop(a, b)
    shared = np.zeros(len(a), bool)
    inside = at < len(b)
    shared[inside] = b[at[inside]] == a[inside]
    only_b = np.ones(len(b), bool)
    only_b[at[shared]] = False
    no_a, no_b = np.zeros(int(only_b.sum()), np.int64), np.zeros(int((~shared).sum()), np.int64)
    p = per_billion(np.concatenate([a_count[shared], a_count[~shared], no_a]), a_total)
    q = per_billion(np.concatenate([b_count[at[shared]], no_b, b_count[only_b]]), b_total)
    square = (p - q) ** 2
    forth, back = int((square // q).sum()), int((square // p).sum())
    return (back, forth, len(p)) if swapped else (forth, back, len(p))


def group_rows(kept: DataFrame) -> DataFrame:
    """(lang, source, block, places, counts): a group's terms of a block, ascending."""
    at = F.array_sort(F.collect_list(F.struct("place", "count")))
    return (kept.select("lang", "place", F.floor(F.col("place") / BLOCK).alias("block"), F.explode("held").alias("h"))
            .select("lang", "place", "block", F.col("h.source").alias("source"), F.col("h.count").alias("count"))
            .groupBy("lang", "source", "block").agg(at.alias("x"))
            .select("lang", "source", "block", F.col("x.place").alias("places"), F.col("x.count").alias("counts")))


def pair_prices(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, a, b, forth, back, terms) of unordered pairs (lang, a, b, a_total, b_total), over the terms that either has."""
    def side(name: str) -> DataFrame:
        mine = rows.withColumnRenamed("source", name)
        names = ["lang", "a", "b", "block", "a_total", "b_total", "places", "counts"]
        return mine.join(pairs, ["lang", name]).select(*names).toDF(*names)  # renamed: the two sides share no column

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        some = left if left.num_rows else right
        key = {c: some.column(c)[:1] for c in ("lang", "a", "b")}
        (a, a_count), (b, b_count) = ([np.concatenate([x.values.to_numpy() for x in t.column(c)] or [np.zeros(0, np.int64)])
                                       for c in ("places", "counts")] for t in (left, right))
        forth, back, n = priced(a, b, a_count, b_count, some.column("a_total")[0].as_py(), some.column("b_total")[0].as_py())
        return pa.table({**key, "forth": [forth], "back": [back], "terms": [n]})
    keys = ("lang", "a", "b", "block")
    parts = side("a").groupBy(*keys).cogroup(side("b").groupBy(*keys)).applyInArrow(
        task, "lang string, a string, b string, forth long, back long, terms long")
    return parts.groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("forth", "back", "terms")])


def audit(documents: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) of the parts ``pair`` and ``term``."""
    clean = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = stored(kept_terms(clean))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_size"))
    sizes = (kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source"))
             .agg(F.sum("h.count").alias("size")))
    groups = stored(clean.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(by_lang, "lang", "left")
                    .fillna(0, ["size", "terms", "lang_size"]))
    return _pairs(kept, groups).unionByName(_terms(kept, groups))


def _ranked(part: str, rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Every group against every other of its language: in the result there is a row for each of them."""
    a, b = (groups.select("lang", F.col("source").alias(s), F.col("size").alias(f"{s}_size"), "terms") for s in "ab")
    pairs = stored(a.join(b.drop("terms"), "lang").where("a < b")
                   .withColumns({"a_total": F.col("a_size") + F.col("terms"), "b_total": F.col("b_size") + F.col("terms")}))
    found = pair_prices(group_rows(kept), pairs.where("terms > 0").select("lang", "a", "b", "a_total", "b_total"))
    p, q = (price_of(0, F.col(f"{s}_size"), F.col("terms")) for s in "ab")
    absent = F.col("terms") - F.coalesce("found", F.lit(0))
    whole = (pairs.join(found.withColumnRenamed("terms", "found"), ["lang", "a", "b"], "left")
             .select("lang", "a", "b", *[F.when(F.col("terms") > 0, F.coalesce(name, F.lit(0)) + absent * gap(x, y)).otherwise(0).alias(name)
                                         for name, x, y in (("forth", p, q), ("back", q, p))]))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("forth").alias("value")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("back").alias("value"))))
    return _ranked("pair", whole.select("lang", ways.alias("w")).select("lang", "w.*"))


def _terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """The dearest terms of each group: first of a group's terms in a block, then of what is left."""
    size = sized(groups.select("lang", F.col("source").alias("of"), "size", "terms", "lang_size"))
    rows = (kept.select("lang", F.col("term").alias("item"), "place", "total", F.explode("held").alias("h"))
            .join(size.withColumnRenamed("lang", "in"), (F.col("lang") == F.col("in")) & (F.col("h.source") == F.col("of")))
            .select("lang", F.col("of").alias("source"), "item", F.floor(F.col("place") / BLOCK).alias("block"),
                    price_of(F.col("h.count"), F.col("size"), F.col("terms")).alias("p"),
                    price_of(F.col("total"), F.col("lang_size"), F.col("terms")).alias("q"))
            .where("p > q").withColumn("value", gap(F.col("p"), F.col("q"))))
    in_block = W.partitionBy("lang", "source", "block").orderBy(F.col("value").desc(), "item")
    best = rows.withColumn("n", F.row_number().over(in_block)).where(F.col("n") <= TOP).drop("n")
    return _ranked("term", best).where(F.col("rank") <= TOP)


#: The same in DuckDB.
SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS size FROM kept GROUP BY lang),
groups AS (SELECT d.lang, d.source, coalesce(any_value(l.v), 0) AS v, any_value(l.size) AS lang_size, coalesce(sum(c.n), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN langs l USING (lang)
  LEFT JOIN (SELECT c.* FROM counts c JOIN kept k USING (lang, term)) c ON c.lang = d.lang AND c.source = d.source GROUP BY d.lang, d.source),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.size + g.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (g.lang_size + g.v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM cells a JOIN cells b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM cells WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
