"""Merkle manifest of a documents table, and a recursive query that climbs from every leaf to the root.

A row is a leaf: the SHA-256 of doc_id, source, lang, n_chars and text, each as ``-`` if null and as UTF-8 byte
count, ``:`` and value otherwise. The leaves of a source, ascending by doc_id, make a tree: every ``ARITY``
consecutive nodes become the SHA-256 of their hex digests until one node, the subroot, is left. The subroots, ascending by
source, make one more tree in the same way; what is left of it is the root.

The levels are written as rows of parents: the digests of the children, and the link to the parent's own parent. A recursive
query then climbs: it joins each row with its parent, folds the digest at hand with the stored siblings, and appends
those siblings to the proof. Leaves under one parent have the same siblings above it, so they climb in one row that holds
a digest per leaf and the shared siblings once; each leaf's own siblings are put in front at the end.

Defined cases: a null id sorts first and its crc32 is that of an empty text; a null source is a group of its own, the first; rows
with equal ids are ordered by leaf digest, so repeated rows are separate leaves; texts of any length are hashed whole; extra
columns play no part; a table of one row is its own root with an empty proof; an empty table gives no rows and no root.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeseam.llm.common import running_total, sized, stored

ARITY, DIGEST = 16, 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The tree over the subroots.
TOP = -1


@dataclass
class Manifest:
    """``leaves``: doc_id, tree, no, leaf, presented. ``nodes``: a row per parent of a tree (module docstring).
    ``subroots``: tree, source, digest. ``root``: hex, or None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def leaf_digest(fields: list[Column]) -> Column:
    """The SHA-256, as 32 bytes, of the fields with their lengths."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                                     for t in texts]), 256))


def altered(doc_id: Column) -> Column:
    """Whether 5 divides the crc32 of the id as decimal text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def hex_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def numbered(documents: DataFrame, presented_text: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Leaves (doc_id, tree, no, n, leaf, presented) and trees (source, tree, first, n), both written tables.

    ``presented`` is the digest of the row with ``presented_text`` in place of its text. Leaves are numbered over all
    sources in one order, dealt by range, so a source with most of the rows is spread like any other.
    """
    fields = [F.col(f) for f in FIELDS]
    other = leaf_digest([*fields[:-1], presented_text]) if presented_text is not None else leaf_digest(fields)
    rows = documents.select("doc_id", "source", leaf_digest(fields).alias("leaf"),
                            F.when(altered(F.col("doc_id")), other).alias("other"), F.lit(1).alias("one"))
    rows = rows.withColumn("presented", F.coalesce("other", "leaf")).drop("other")
    placed = stored(running_total(rows, ["source", "doc_id", "leaf"], "one", "place").drop("one"))
    trees = placed.groupBy("source").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = stored(running_total(trees.withColumn("one", F.lit(1)), ["source"], "one", "tree").drop("one"))
    small = sized(trees.withColumnRenamed("source", "of"))
    leaves = (placed.join(small, F.col("source").eqNullSafe(F.col("of")))
              .select("doc_id", "tree", (F.col("place") - F.col("first")).alias("no"), "n", "leaf", "presented"))
    return leaves, trees


def levels(nodes: DataFrame, widest: int) -> list[DataFrame]:
    """The parents of each level of trees given by their lowest nodes (tree, no, n, digest); ``n`` nodes at most ``widest``.

    Parents: tree, level, no, n (parents of the level), digest, children (the children's digests one after another).
    """
    made, level = [], 0
    while widest > 1:
        level, widest = level + 1, -(-widest // ARITY)
        child = F.array_sort(F.collect_list(F.struct("no", "digest")))
        parents = (nodes.where("n > 1").groupBy("tree", F.floor(F.col("no") / ARITY).alias("up"), "n")
                   .agg(F.unhex(F.array_join(F.transform(child, lambda c: F.hex(c.digest)), "")).alias("children")))
        made.append(stored(parents.select(
            "tree", F.lit(level).alias("level"), F.col("up").alias("no"), F.ceil(F.col("n") / ARITY).alias("n"),
            F.unhex(F.sha2(hex_of(F.col("children")), 256)).alias("digest"), "children")))
        nodes = made[-1]
    return made


def _linked(parents: DataFrame, topmost: tuple[Column, Column, Column, Column]) -> DataFrame:
    """Parents with the link to their own parent; the last one of a tree has ``topmost`` (tree, level, no, place)."""
    inside = (F.col("tree"), F.col("level") + 1, F.floor(F.col("no") / ARITY), (F.col("no") % ARITY).cast("int"))
    return parents.select("tree", "level", "no", "children", *[
        F.when(F.col("n") > 1, a).otherwise(b).alias(name)
        for a, b, name in zip(inside, topmost, ("up_tree", "up_level", "up_no", "place"))])


def _entry(several: bool) -> tuple[Column, Column, Column, Column]:
    """Where the topmost node of a source's tree hangs in the tree over the sources."""
    where = (F.lit(TOP).cast("long"), F.lit(1), F.floor(F.col("tree") / ARITY), (F.col("tree") % ARITY).cast("int"))
    return where if several else _nowhere()


def _nowhere() -> tuple[Column, Column, Column, Column]:
    return (F.lit(None).cast("long"), F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("int"))


def build(documents: DataFrame, presented_text: Column | None = None) -> Manifest:
    """Hash all rows and store every level. ``presented_text`` is what the rows of :func:`altered` are shown with."""
    leaves, trees = numbered(documents, presented_text)
    sizes = trees.agg(F.count(F.lit(1)).alias("sources"), F.max("n").alias("widest")).first()
    bottom = leaves.select("tree", "no", "n", F.col("leaf").alias("digest"))
    made = levels(bottom, sizes.widest or 0)
    last = [df.where("n = 1").select("tree", "digest") for df in (bottom, *made)]
    subroots = stored(reduce(DataFrame.union, last).join(sized(trees.select("tree", "source")), "tree"))
    tops = levels(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("no"),
                                  F.lit(sizes.sources).cast("long").alias("n"), "digest"), sizes.sources)
    linked = [_linked(p, _entry(sizes.sources > 1)) for p in made] + [_linked(p, _nowhere()) for p in tops]
    empty = documents.sparkSession.createDataFrame(
        [], "tree long, level int, no long, children binary, up_tree long, up_level int, up_no long, place int")
    top = (tops[-1] if tops else subroots).select(hex_of(F.col("digest")).alias("root")).first()
    return Manifest(leaves, reduce(DataFrame.union, linked, empty), subroots, top.root if top else None)


CLIMB = """
WITH RECURSIVE climb AS (
  SELECT tree, up_tree, up_level, up_no, place, climbers, proof FROM {start}
  UNION ALL
  SELECT c.tree, n.up_tree, n.up_level, n.up_no, n.place,
         transform(c.climbers, (x, i) -> named_struct('doc_id', x.doc_id, 'leaf', x.leaf, 'fold', unhex(sha2(lower(hex(concat(
             substring(n.children, 1, {digest} * coalesce(c.place, i)), x.fold,
             substring(n.children, {digest} * coalesce(c.place, i) + {digest} + 1)))), 256)))),
         CASE WHEN c.place IS NULL THEN c.proof
              ELSE concat(c.proof, substring(n.children, 1, {digest} * c.place),
                          substring(n.children, {digest} * c.place + {digest} + 1)) END
  FROM climb c JOIN {nodes} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_no = n.no)
SELECT tree, climbers, proof FROM climb WHERE up_level IS NULL
"""


def climb(manifest: Manifest) -> DataFrame:
    """(tree, climbers, proof): all leaves at the root, in rows of those that share a parent.

    ``climbers`` has doc_id, leaf and ``fold``, the root folded from the presented digest; ``proof`` the siblings above the leaves' own.
    """
    several = manifest.subroots.count() > 1
    spark = manifest.leaves.sparkSession
    one_tree = (F.col("tree"), F.lit(1), F.floor(F.col("no") / ARITY), F.lit(None).cast("int"))
    placed = manifest.leaves.select("tree", "no", "doc_id", "leaf", "presented", *[
        F.when(F.col("n") > 1, a).otherwise(b).alias(name)
        for a, b, name in zip(one_tree, _entry(several), ("up_tree", "up_level", "up_no", "place"))])
    climber = F.struct("no", "doc_id", "leaf", F.col("presented").alias("fold"))
    start = (placed.groupBy("tree", "up_tree", "up_level", "up_no", "place")
             .agg(F.transform(F.array_sort(F.collect_list(climber)), lambda x: F.struct(x.doc_id, x.leaf, x.fold)).alias("climbers"))
             .withColumn("proof", F.lit(b"")))
    option, before = "spark.sql.cteRecursionRowLimit", spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set(option, "-1")  # the rows of all steps: in proportion to the leaves
    try:
        return stored(spark.sql(CLIMB, start=stored(start), nodes=manifest.nodes, digest=DIGEST))
    finally:
        spark.conf.set(option, before)


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, proof, folded): a row per leaf; ``proof`` the digests of all siblings on the way, 32 bytes each."""
    at, x = F.col("at"), F.col("x")
    own = F.unhex(F.array_join(F.transform("climbers", lambda c: F.hex(c.leaf)), ""))
    rows = climb(manifest).select("tree", "proof", own.alias("own"), F.posexplode("climbers").alias("at", "x"))
    siblings = F.concat(F.substring("own", F.lit(1), at * DIGEST), F.substring("own", at * DIGEST + DIGEST + 1, F.octet_length("own")), "proof")
    subroots = sized(manifest.subroots.select("tree", F.col("digest").alias("subroot")))
    return (rows.join(subroots, "tree")
            .select(x.doc_id.alias("doc_id"), x.leaf.alias("leaf"), "subroot", siblings.alias("proof"), x.fold.alias("folded")))


def verified(documents: DataFrame) -> DataFrame:
    """The manifest's digests of each row, and whether the row as presented (some with a lower-cased text) still folds to the root."""
    manifest = build(documents, F.translate("text", UPPER, LOWER))
    root = F.lit(manifest.root).cast("string")
    return proofs(manifest).select(
        "doc_id", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(hex_of(F.col("proof")), 256).alias("proof_sha256"), hex_of(F.col("folded")).alias("folded_root"),
        (hex_of(F.col("folded")) == root).alias("verified"))


#: The same in DuckDB, with a recursive build and a recursive climb per leaf.
SQL = """
WITH RECURSIVE enc AS (
  SELECT doc_id, source, text, crc.c % 5 = 0 AS altered,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents, LATERAL (SELECT xor(list_reduce(
    list_transform(range(8 * length(coalesce(doc_id::VARCHAR, ''))), lambda i:
      CASE WHEN i % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, (i // 8 + 1)::INT, 1))::BIGINT ELSE 0 END),
    lambda a, e: CASE WHEN xor(a, e) & 1 = 1 THEN xor(xor(a, e) >> 1, 3988292384) ELSE xor(a, e) >> 1 END,
    4294967295), 4294967295) AS c) crc),
hashed AS (
  SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN altered
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS presented FROM enc),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS no, count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
inner_nodes AS (
  SELECT tree, 0 AS level, no, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT tree, level + 1, no // 16, (any_value(n) + 15) // 16, sha256(string_agg(hash, '' ORDER BY no))
  FROM inner_nodes WHERE n > 1 GROUP BY tree, level, no // 16),
top_nodes AS (
  SELECT -1 AS tree, 0 AS level, tree AS no, count(*) OVER () AS n, hash FROM inner_nodes WHERE n = 1
  UNION ALL
  SELECT -1, level + 1, no // 16, (any_value(n) + 15) // 16, sha256(string_agg(hash, '' ORDER BY no))
  FROM top_nodes WHERE n > 1 GROUP BY level, no // 16),
ways AS (
  SELECT tree, level, no, n,
    coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre,
    coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post
  FROM (SELECT * FROM inner_nodes UNION ALL SELECT * FROM top_nodes)
  WINDOW w AS (PARTITION BY tree, level, no // 16 ORDER BY no)),
climb AS (
  SELECT doc_id, leaf, tree AS of, tree, 0 AS level, no, presented AS fold, '' AS proof, row_number() OVER () AS r FROM leaves
  UNION ALL
  SELECT c.doc_id, c.leaf, c.of, CASE WHEN w.n > 1 THEN c.tree ELSE -1 END, CASE WHEN w.n > 1 THEN c.level + 1 ELSE 0 END,
    CASE WHEN w.n > 1 THEN c.no // 16 ELSE c.tree END,
    CASE WHEN w.n > 1 THEN sha256(w.pre || c.fold || w.post) ELSE c.fold END,
    CASE WHEN w.n > 1 THEN c.proof || w.pre || w.post ELSE c.proof END, c.r
  FROM climb c JOIN ways w ON w.tree = c.tree AND w.level = c.level AND w.no = c.no
  WHERE w.n > 1 OR c.tree >= 0)
SELECT c.doc_id, c.leaf, s.hash AS subroot, t.hash AS root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root,
  c.fold = t.hash AS verified
FROM climb c JOIN inner_nodes s ON s.tree = c.of AND s.n = 1, (SELECT level, hash FROM top_nodes WHERE n = 1) t
WHERE c.tree = -1 AND c.level = t.level
"""
