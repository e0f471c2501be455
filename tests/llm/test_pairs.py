"""Near duplicates, nearest neighbours, preference pairs and the pipeline against brute force."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lodeseam.llm import common, decontaminate, jaccard, line_dedup, permutation, preference, quality, queries
from lodeseam.llm.common import WordCodes, components
from tests.llm.test_texts import without_copies


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def grouped(rows):
    """Sorted (doc_id, size, component) as text, by comparing all documents that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    holds, parent = {}, list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holds.get(g, ())).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in s:
            holds.setdefault(g, []).append(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted((str(d), len(s), str(low.get(root(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("many", [16, 1])
def test_jaccard_groups(spark, sf, monkeypatch, many):
    monkeypatch.setattr(jaccard, "MANY", many)
    if many == 1:  # and several ranges and runs
        monkeypatch.setattr(jaccard, "RANGE", 2_000)
        monkeypatch.setattr(jaccard, "RUN", 3_000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    base = rows[7][1].split()
    rows += [(1000 + i, " ".join(base[:i] + [f"w{i}"] + base[i:])) for i in range(30)]  # a chain of near copies
    rows += [(2000, None), (2001, ""), (2002, "a b"), (2003, "A  b"), (2003, "A  b"), (None, "a\tb"), (None, None),
             (None, "only this one here"), (None, "only this one  here"), (2004, "É b"), (2005, "é b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set_id", F.lit("x"))
    got = jaccard.groups(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == grouped(rows)
    assert jaccard.groups(df.limit(0)).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    checked = 0
    for trial in range(1500):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 400 if trial % 2 else 40))).astype(np.uint64))
        added = rng.integers(0, 2**63, int(rng.integers(0, len(a) // 3 + 1))).astype(np.uint64)
        b = np.unique(np.concatenate([a[int(rng.integers(0, len(a) // 4 + 1)):], added]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        checked += 1
        common = np.unique(np.concatenate([a[::trial % 5 + 1], b[:trial % 3 * 20]])) if trial % 7 else np.zeros(0, np.uint64)
        signature, of = jaccard.signatures([a, b], common)
        assert set(signature[of == 0].tolist()) & set(signature[of == 1].tolist())
    assert checked > 500


def test_sketches_never_hide_a_similar_set():
    rng = np.random.default_rng(3)
    dropped = 0
    for trial in range(600):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 3000 if trial % 2 else 300))).astype(np.uint64))
        b = np.unique(np.concatenate([a[int(rng.integers(0, len(a) + 1)) // (1 + trial % 5):],
                                      rng.integers(0, 2**63, int(rng.integers(0, len(a) // 2 + 2))).astype(np.uint64)]))
        if not len(b):
            continue
        differ, seen = len(np.setxor1d(a, b)), jaccard.apart_at_least(jaccard.sketch(a), jaccard.sketch(b))
        assert seen <= differ and seen == jaccard.apart_at_least(jaccard.sketch(b), jaccard.sketch(a))
        both = (len(a) + len(b) - differ) // 2
        assert (100 * both >= 75 * (len(a) + len(b) - both)) == (7 * differ <= len(a) + len(b))
        dropped += 7 * seen > len(a) + len(b)
        if 3 * max(len(a), len(b)) <= 4 * min(len(a), len(b)) and len(a) > 50 and 2 * both < len(a) + len(b) - both:
            assert 7 * seen > len(a) + len(b)
    assert dropped > 100


def test_unlike_copies_of_one_text_are_not_compared(spark, monkeypatch):
    """Copies that differ from each other in too many places share most signatures, yet only a few pairs need their shingles."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(60):
        words = [f"w{k}" for k in range(150)]
        for at in 5 * rng.choice(30, 5, replace=False):
            words[at] = f"x{at}"
        rows.append((i, " ".join(words)))
    compared, joined, linked, other = [], [], jaccard.Sets.linked, jaccard._other_pairs
    monkeypatch.setattr(jaccard, "MANY", 1)  # all signatures are crowded
    monkeypatch.setattr(jaccard.Sets, "linked", lambda self, pairs: (compared.append(pairs.count()), linked(self, pairs))[1])
    monkeypatch.setattr(jaccard, "_other_pairs", lambda *a: (joined.append(other(*a)), joined[-1])[1])
    got = jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == grouped(rows)
    assert sum(compared) < 300 and sum(p.count() for p in joined) < 300  # of 1,770 pairs


@pytest.mark.parametrize("one_task", [500_000, 0])
def test_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(common, "ONE_TASK", one_task)
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(50, 80)] + rng.integers(0, 60, (20, 2)).tolist()
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {n: c for n, c in label.items() if n != c}


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    vectors = (centres[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    vectors[500:900] = vectors[500]  # a very common vector
    rows = [(i, v.tolist(), i) for i, v in enumerate(vectors)]
    odd = [(3000, None, 0), (3100, [0.0] * 16, 0), (3200, [None] + [1.0] * 15, 0), (3300, [float("nan")] * 16, 0),
           (3400, [float("inf")] * 16, 0), (3500, [1.0], 0), (3600, [], 0), (None, rows[1][1], 0), rows[100], rows[100]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int")
    got = permutation.search(df, F.col("vec_id") % 100 == 0).toPandas()
    exact, hits = vectors.astype(float), []
    assert set(got["query_id"]) == set(range(0, 3000, 100))
    for q, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        distance = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(3000), distance)) if i != q][:10]
        assert list(part["rank"]) == list(range(1, 11))
        assert part["score"].to_numpy() == pytest.approx(distance[part["vec_id"]], abs=0)
        assert list(zip(part["score"], part["vec_id"])) == sorted(zip(part["score"], part["vec_id"]))
        hits.append(len(set(order) & set(part["vec_id"])) / 10)
    assert np.mean(hits) >= 0.9
    assert got[got["query_id"] == 500].sort_values("rank")["vec_id"].tolist() == list(range(501, 511))
    few = permutation.search(df.where("vec_id < 4"), F.col("vec_id") % 100 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]
    assert permutation.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_preference_pairs(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"),
            (2, 2, "user", None), (3, 0, "user", "hi"), (3, 0, "user", "hi"), (4, None, "user", "hi"), (4, 0, None, ""),
            (5, 0, "user", "hi"), (5, 1, "assistant", "yes"), (6, 0, "user", "alone"), (None, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    conversations = preference.conversations_of(df)
    pairs = preference.same_opening(conversations)
    assert {tuple(r) for r in pairs.collect()} == {(1, 2), (1, 3), (1, 4), (1, 5)}
    got = {r.rejected_id: r for r in preference.completions(conversations, pairs).collect()}
    assert got[2].prompt == "<|im_start|>user\nhi<|im_end|>\n" and got[2].n_prompt_turns == 1
    assert got[2].chosen == "<|im_start|>assistant\nyes<|im_end|>\n" and got[2].chosen_mask == "22x0,14x1"
    assert got[2].rejected_mask == "22x0,13x1,28x0" and got[3].rejected == got[3].rejected_mask == ""
    assert got[5].n_prompt_turns == 2 and got[5].chosen == got[5].rejected == ""
    db = duckdb.connect()
    db.register("conversations", pa.table({c: [r[i] for r in rows] for i, c in enumerate(["conv_id", "turn", "role", "text"])}))
    both = pairs.union(preference.neighbours(conversations)).distinct()
    ours = [tuple(r) for r in preference.completions(conversations, both).collect()]
    assert sorted(db.sql(preference.SQL).fetchall()) == sorted(ours)
    assert preference.completions(preference.conversations_of(df.limit(0)), pairs).count() == 0


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("component_id", F.lit("kept"))
    clashing = ("__id", "__h", "__runs", "__n_lines", "__score", "__found", "__row", "id", "hash", "row", "first")
    odd = [(90_001, None, None, None, None, "a"), (90_002, "", "en", "s", 0, "b"), (90_003, "x", None, None, 1, "c"),
           (90_003, "x", None, None, 1, "c"), (None, "y z", None, None, 3, "d")]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).withColumns({c: F.lit("own") for c in clashing})
    columns, last = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, last, sf))
        assert after.columns == columns, name
        assert after.count() <= last.count()
        stage(spark, docs.limit(0), sf).count()
        last = after
    left = last.collect()
    texts = [(r.doc_id, r.text) for r in left]
    assert all(d == c for d, _, c in grouped(texts))  # no group has a second member
    out = corpus_pipeline.STAGES[-1][1](spark, last, sf)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in left)
    assert 150 < len(left) < 206


def test_pipeline_keeps_one_row_of_each_group(spark, sf):
    """Null, repeated and shared ids: a row per group stays, and every group keeps one."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [(1, a, "p"), (None, a, "q"), (None, a + " more", "q"),      # copies without id of a document with one
            (None, b, "q"), (None, b, "p"), (None, b + " more", "q"),   # only rows without id
            (2, c, "q"), (2, c, "p"), (2, c, "p"), (3, c, "p"),         # repeated rows under the smallest id
            (4, d, "p"), (5, d, "p"), (5, e, "p"), (5, "alone here", "p"), (1, e + " more", "p"),  # ids with several texts
            (None, "x y z", "p"), (None, None, "p"), (6, "", "p"), (6, "", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in corpus_pipeline.keep_one_of_each_group(spark, docs, sf).collect()]
    low_b = min((r for r in rows[3:6]), key=lambda r: (hashes(spark, r[1]), r[2]))
    assert sorted(map(str, got)) == sorted(map(str, [
        rows[0], low_b, (2, c, "p"), rows[10], (1, e + " more", "p"), rows[13], *rows[15:]]))


def hashes(spark, text):
    return spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]


def test_queries_have_their_columns(spark, sf):
    expected = {"op1_quality": "doc_id held_out score predicted", "op3_token_file": "doc_id start n_tokens ids_crc32",
                "op4_jaccard": "doc_id n_shingles component_id", "op6_permutation": "query_id rank vec_id score",
                "op7_lexicon": "doc_id n_tokens ids_sha256 decoded_sha256", "op10_toxicity": "doc_id held_out score predicted"}
    for name, columns in expected.items():
        df = queries.QUERIES[name](spark, sf)
        assert df.columns == columns.split(), name
        assert df.count() > 0


def test_pipeline_equals_plain_loops(spark, sf):
    """The whole pipeline by loops over all rows, lines, pairs and items, and the tokenizers library."""
    read = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(read, spark.read.parquet(f"{sf}/labels.parquet"))
    docs = sorted((r.doc_id, r.text or "") for r in read.collect())
    docs = [(d, t) for d, t in docs if model.score(np.array([quality.statistics(t)]))[0] >= 0.3]
    texts = without_copies(docs, line_dedup.MIN_WORDS)
    docs = [(d, t) for (d, before), t in zip(docs, texts) if t or not before]
    docs = [(d, t) for (d, t), (_, _, c) in zip(docs, by_id(docs, grouped(docs))) if c == str(d)]
    codes, items = WordCodes(), [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items = [codes.of(words) for words in items if words]

    def leaked(text):
        body = codes.of(decontaminate.words_of(text))
        return len(body) and any(decontaminate.fitting(i, body)[0] <= int(0.2 * len(i) + 1e-9) for i in items)
    docs = [(d, t) for d, t in docs if not leaked(t)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for d, t in docs:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        sha = (hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)))
        expected.append((d, len(ids), *sha))
    assert 100 < len(docs) < 190
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect()) == sorted(expected)


def by_id(docs, found):
    """The rows of ``grouped`` in the order of the documents."""
    place = {str(d): i for i, (d, _) in enumerate(docs)}
    return sorted(found, key=lambda r: place[r[0]])
