"""Classifiers, tokenizers, token counts, decontamination and line dedup against brute force."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from lodeseam.llm import decontaminate, lexicon, line_dedup, quality, token_file, toxicity, unigram
from lodeseam.llm.common import WordCodes, held_out, running_total

ODD_TEXTS = ["", "Σίσυφος ΟΔΟΣ'S don't I'LL x1234½²", "a<|endoftext|>B<|startoftext|>", "\x1cab\x1dc  d\xa0e f",
             "é İstanbul ǅ ß", "日本語テキスト 🎉🎉 a_b-c__d", "x" * 500 + " " + "ab" * 300, "  ", " ٣٤ १२", "'s's't''re",
             "<|", "ﬁ ﬀ \u0085q", "Ὀδυσσεύς ΣΣ Σ", "\x00\x01\x7f", "a  b   c \n d\n\n e ", " lead\ttab \n\n  x", "nul\0 here"]


#: Names that operators use for columns of their own.
CLASHING = ("__id", "__h", "__runs", "__n_lines", "__n_deleted", "__score", "__found", "__row", "id", "hash", "runs", "row", "n_lines", "first")


def docs_of(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # columns whose names operators use themselves
    return df.withColumns({"n_tokens": F.lit("x"), "score": F.lit(1), "line": F.lit("y")}) if extra else df


@pytest.fixture(scope="module")
def texts(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60).collect()
    return [(r.doc_id, r.text) for r in rows]


def test_word_bpe_equals_the_library(spark, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = texts + [(10_000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(1, None), (None, "a b"), (1, None)]
    for words in (65_536, 0):  # with and without a lexicon
        got = lexicon.encode(docs_of(spark, rows), path, words).collect()
        expected = []
        for i, t in rows:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids
            expected.append((i, len(ids), " ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)))
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert lexicon.digests(docs_of(spark, rows).limit(0), path).count() == 0


def test_automaton_is_minimal_and_exact():
    words = sorted([b"tops", b"taps", b"top", b"tap", b"stops", b"staps", b"a"])
    flat = lexicon.build_automaton((w, list(w)) for w in words)
    automaton = lexicon.Automaton(flat)
    assert automaton.look_up(words + [b"to", b"", b"topsy"]) == [list(w) for w in words] + [None] * 3
    assert flat[1] < sum(map(len, words)) / 2  # suffixes are shared
    assert lexicon.Automaton(lexicon.build_automaton([])).look_up([b"a"]) == [None]


def test_token_file_round_trip(spark, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = texts + [(10_000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(1, None), (None, "a b"), (1, None)]
    folder = token_file.new_folder(spark)
    token_file.write(docs_of(spark, rows), path, folder)
    got = token_file.read(spark, folder).orderBy("start").collect()
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    ids.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    assert [(r.doc_id, list(r.ids)) for r in got] == ids
    starts = np.cumsum([0] + [len(x) for _, x in ids])
    assert [r.start for r in got] == starts[:-1].tolist() and [r.n_tokens for r in got] == np.diff(starts).tolist()
    crcs = {(r.start, r.ids_crc32) for r in token_file.digests(spark, folder).collect()}
    assert crcs == {(s, zlib.crc32(np.array(x, "<u4").tobytes())) for s, (_, x) in zip(starts.tolist(), ids)}
    folder = token_file.new_folder(spark)
    token_file.write(docs_of(spark, rows).limit(0), path, folder)
    assert token_file.read(spark, folder).count() == 0


WIDE_SPACES = ["\u00a0", "\u3000", "\t", "\n", "\r", "\x0b", "\x1c", "\u0085", "\u2009", "  "]


def test_pieces_have_the_ids_of_whole_texts():
    """Single spaces next to, between and apart from other white space."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        pieces = token_file.Pieces(f.read())
    rnd = random.Random(5)
    parts = [" "] * 6 + WIDE_SPACES + ["the", "The", ".", "a", "é", "12", "'s", "日本", "\0", "?!"]
    texts = [" \xa0 \xa0", ". \xa0 \xa0", "the \xa0 \xa0", "a \n b", *ODD_TEXTS]
    texts += ["".join(rnd.choices(parts, k=rnd.randint(1, 9))) for _ in range(100_000)]
    got = pieces.encode(texts)
    expected = pieces.tokenizer.encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, g, e in zip(texts, got, expected) if np.frombuffer(g, "<u4").tolist() != e.ids + [token_file.END]]
    assert wrong == []


class Counted:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.sent = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.sent += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_the_library_gets_a_word_once(monkeypatch):
    """Not once more for each mark behind it and each line break beside it."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        pieces = token_file.Pieces(f.read())
    counted = {name: Counted(getattr(pieces, name)) for name in ("tokenizer", "merger") if hasattr(pieces, name)}
    for name, tokenizer in counted.items():
        monkeypatch.setattr(pieces, name, tokenizer)
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzéàüß", k=8)) for _ in range(300)]
    texts = ["start " + "".join(rnd.choice(words) + rnd.choice(["", ".", ",", "!?", ";"]) + rnd.choice([" ", " ", "\n"])
                                for _ in range(150)) + "end" for _ in range(100)]
    got = pieces.encode(texts)
    expected = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids + [token_file.END] for e in expected]
    # with a space before it, and at the beginning of a line
    assert sum(c.sent for c in counted.values()) <= 2 * sum(len(w.encode()) + 2 for w in words) + 100


def test_ranges_are_told_by_the_first_ids(spark):
    """The driver samples what tells the ranges; the order goes by all ids."""
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 1, 2]), bytes([rnd.randint(0, 1) * 255]) * 63 + bytes(rnd.choices([0, 127, 128], k=rnd.randint(0, 4))))
            for _ in range(400)]
    dealt = token_file.in_order(spark.createDataFrame(rows, "doc_id long, ids binary"), 4)
    got = [(r.doc_id, bytes(r.ids)) for r in dealt.collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    ranges = re.findall(r"rangepartitioning\((.*)", dealt._jdf.queryExecution().executedPlan().toString())
    assert ranges and not any("ids" in re.sub(r"substring\(ids[^)]*\)", "", x) for x in ranges), ranges


def test_ids_stay_whole_beside_nulls(spark, sf):
    """A long id that no double holds, in one batch with a null."""
    big = 2**60 + 1
    df = docs_of(spark, [(big, "first text here to find"), (None, "other text"), (None, None), (big + 2, "")]).coalesce(1)
    benchmark = spark.createDataFrame([(big, "first text here to find")], "item_id long, text string")
    folder = token_file.new_folder(spark)
    token_file.write(df, public_tokenizers.path("byte_bpe_50k.json"), folder)
    found = {"op3": token_file.read(spark, folder), "op3 digests": token_file.digests(spark, folder),
             "op5": unigram.token_counts(df, public_tokenizers.path("piece_bpe_32k.model")),
             "op7": lexicon.digests(df, public_tokenizers.path("word_bpe_49k.json"))}
    for name, out in found.items():
        assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([big, None, None, big + 2], key=str), name
    (hit,) = decontaminate.matches(df, benchmark).collect()
    assert (hit.doc_id, hit.item_id, hit.edit_distance) == (big, big, 0)


def test_huffman_code():
    rng = np.random.default_rng(0)
    count = rng.zipf(1.2, 30_000) % 10**9
    bits = token_file.code_lengths(count)
    assert bits.max() <= token_file.MAX_BITS and (2.0 ** -bits[bits > 0].astype(float)).sum() <= 1
    entropy = -(count / count.sum() * np.log2(np.maximum(count, 1) / count.sum())).sum()
    assert entropy <= (bits * count).sum() / count.sum() < entropy + 0.5
    assert token_file.code_lengths(np.array([0, 7])).tolist() == [0, 1]
    words, table = token_file.code_words(bits)
    ids = rng.choice(np.flatnonzero(count), 5000)
    for n in (1, 1023, 1024, 1025, 5000):
        payload, offsets = token_file.pack(ids[:n], bits, words)
        assert (token_file.unpack(payload, offsets, n, table) == ids[:n]).all()


def test_unigram_counts_equal_the_library(spark, texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    tokenizer = Tokenizer(models.Unigram(unigram.vocabulary(path), 0, True))
    rows = texts + [(10_000 + i, t) for i, t in enumerate([*ODD_TEXTS, "☃☃a", "<s> <0x41>", "▁▁ a▁b"])] + [(1, None), (5, "a b"), (5, "a b"), (6, "long " * 60_000)]
    got = unigram.token_counts(docs_of(spark, rows), path).collect()
    expected = [(i, len(tokenizer.encode("▁" + t.replace(" ", "▁")).ids) if t else 0) for i, t in rows]
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted(expected)
    assert unigram.token_counts(docs_of(spark, rows).limit(0), path).count() == 0


def test_unigram_ties_and_pieces_across_marks():
    pieces = [("<unk>", -9.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("b▁a", -0.5), ("▁", -1.0)]
    tokenizer = Tokenizer(models.Unigram(pieces, 0, False))
    counter = unigram.Counter(pieces)
    assert not counter.by_word
    for text in ("ab", "abab", "b a", "ab ab b a"):
        assert counter.count(text)[0] == len(tokenizer.encode("▁" + text.replace(" ", "▁")).ids)


def test_decontamination(spark, sf, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(900, None), (901, ""), (902, "only four words here"), (903, items[0][1])]
    rnd = random.Random(3)
    rows, planted = list(texts[:30]), []
    for n in range(60):
        item, text = items[rnd.randrange(40)]
        words = text.split()
        for _ in range(rnd.randint(0, int(0.2 * len(words)))):
            at = rnd.randrange(len(words))
            words[at:at + rnd.randint(0, 1)] = rnd.choice([[], [f"zz{n}"]])
        rows.append((5000 + n, " ".join(texts[n % 30][1].split()[:50] + words + texts[n % 20][1].split()[:30])))
        planted.append((5000 + n, item))
    rows += [(6000, "x only FOUR words  here y"), (6001, "only four other words here"), (6002, None), (6002, None), (6003, "")]
    df, benchmark = docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r.edit_distance for r in decontaminate.matches(df, benchmark).collect()}
    codes = WordCodes()
    expected = {}
    for d, text in rows:
        body = codes.of(decontaminate.words_of(text))
        for i, item in items:
            words = codes.of(decontaminate.words_of(item))
            if len(words) and len(body):
                distance = decontaminate.fitting(words, body)[0]
                if distance <= int(0.2 * len(words) + 1e-9):
                    expected[d, i] = distance
    assert got.items() <= expected.items() and len(got) >= 0.97 * len(expected)
    assert (6000, 902) in got and (6001, 902) not in got
    flagged = df.withColumn("bad", decontaminate.contaminated(benchmark, F.col("text"))).where("bad").select("doc_id")
    assert {r.doc_id for r in flagged.collect()} == {d for d, _ in got}
    assert decontaminate.matches(df, benchmark.limit(0)).count() == 0
    assert decontaminate.matches(df.limit(0), benchmark).count() == 0


def test_decontamination_recall_of_each_length(spark, sf):
    """Copies with as many edits as are allowed, of every length from 5 to 300 words: the keys alone meet 0.998 of them."""
    rng, finder = np.random.default_rng(11), decontaminate.Finder([[f"w{i}-{n}" for i in range(n)] for n in range(5, 301)]).tuned()
    met = sum(finder._met([words] * 20, finder.tables[len(words)], rng) for words in finder.items if finder.tables[len(words)])
    hashed = sum(20 for words in finder.items if finder.tables[len(words)])
    assert met >= decontaminate.TARGET_RECALL * hashed > 0


def test_decontamination_without_hashing(spark, sf, texts, monkeypatch):
    """Where no number of tables is enough the windows are compared exactly: nothing is missed."""
    monkeypatch.setattr(decontaminate, "MOST_TABLES", 0)
    monkeypatch.setattr(decontaminate, "TARGET_RECALL", 2.0)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()][:40]
    rnd, rows = random.Random(9), []
    for n in range(80):
        words = items[n % 40][1].split()
        for _ in range(int(0.2 * len(words))):
            at = rnd.randrange(len(words))
            words[at:at + rnd.randint(0, 1)] = rnd.choice([[], [f"zz{n}"]])
        rows.append((n, " ".join(["before"] * 7 + words + ["after"] * 5)))
    finder = decontaminate.Finder([decontaminate.words_of(t) for _, t in items]).tuned(2.0)
    assert not any(finder.tables[len(w)] for w in finder.items if finder.allowed(len(w)))
    found, codes = finder.find([t for _, t in rows]), WordCodes()
    for (n, text), got in zip(rows, found):
        body = codes.of(decontaminate.words_of(text))
        for i, (_, item) in enumerate(items):
            words = codes.of(decontaminate.words_of(item))
            assert (i in got) == (decontaminate.fitting(words, body)[0] <= finder.allowed(len(words)))


def test_decontamination_in_slices(spark, sf, monkeypatch):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = [(i, r.text) for i, r in enumerate(items.limit(10).collect())]
    monkeypatch.setattr(decontaminate, "MAX_ITEMS", 15)
    assert decontaminate.matches(docs_of(spark, rows), items).select("doc_id").distinct().count() == 10


def test_fitting_is_the_edit_distance():
    rnd = random.Random(2)
    for _ in range(60):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randint(1, 7))] for _ in range(2))
        best = min(levenshtein(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        distance, start, end = decontaminate.fitting(np.array(a), np.array(b))
        assert distance == best == levenshtein(a, b[start:end])


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def without_copies(docs, min_words):
    lines = [t.split("\n") for _, t in docs]
    places = defaultdict(list)
    for d, body in enumerate(lines):
        for i, line in enumerate(body):
            places[line].append((d, i))
    gone = [[False] * len(body) for body in lines]
    for d, body in enumerate(lines):
        for i in range(len(body)):
            best = 0
            for e, j in places[body[i]]:
                if (e, j) >= (d, i):
                    break
                n = 0
                while i + n < len(body) and j + n < len(lines[e]) and body[i + n] == lines[e][j + n]:
                    n += 1
                best = max(best, n)
            if best and sum(len(x.split()) for x in body[i:i + best]) >= min_words:
                gone[d][i:i + best] = [True] * best
    return ["\n".join(x for x, g in zip(body, marks) if not g) for body, marks in zip(lines, gone)]


@pytest.mark.parametrize("min_words", [3, 9])
def test_line_dedup(spark, min_words):
    rnd = random.Random(min_words)
    common = ["a b", "c", "", "d e f", "g", "h i"]
    docs = [(i, "\n".join(rnd.choice(common if rnd.random() < 0.7 else [f"u{n}" for n in range(20)])
                          for _ in range(rnd.randint(1, 14)))) for i in range(60)]
    docs += [(60, "\n".join(["c"] * 40)), (61, docs[3][1] + "\n" + docs[4][1]), (62, "")]
    rows = docs + [(70, None), docs[5], docs[5], (None, docs[6][1])]
    df = docs_of(spark, rows)
    df = df.withColumns({c: F.lit("own") for c in CLASHING})
    out = line_dedup.without_later_copies(df, min_words).select("row.*")
    assert out.columns == df.columns and out.where(" and ".join(f"{c} = 'own'" for c in CLASHING)).count() == len(rows)
    got = defaultdict(set)
    for r in out.collect():
        got[r.doc_id].add(r.text)
    order = [(None, docs[6][1]), *docs]
    expected = dict(zip((d for d, _ in order), without_copies(order, min_words)))
    assert got == {**{d: {t} for d, t in expected.items()}, 70: {None}}
    assert out.count() == len(rows)
    assert line_dedup.without_later_copies(df.limit(0), min_words).count() == 0


def test_running_total(spark):
    rows = [(None, 5), (3, 1), (1, 2), (2, 7)]
    df = running_total(spark.createDataFrame(rows, "k long, v long"), ["k"], "v", "before")
    assert {r.k: r.before for r in df.collect()} == {None: 0, 1: 5, 2: 7, 3: 14}


def labelled(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


@pytest.mark.parametrize("module, target, threshold", [(quality, "quality", 0.3), (toxicity, "toxic", 0.5)])
def test_classifiers(spark, module, target, threshold):
    docs, labels = labelled(spark, "/root/testdata/sf0.01" if module is quality else "/root/testdata/sf0.1")
    model = module.fit(docs, labels)
    scored = docs.withColumn("held", held_out(F.col("doc_id"))).withColumn("p", module.score(model, F.col("text")))
    rows = scored.where("held").join(labels, "doc_id").select("p", F.col(target).alias("y")).collect()
    right = np.mean([(r.p >= threshold) == bool(r.y) for r in rows])
    assert right >= (0.97 if module is quality else 0.97)
    extra = docs_of(spark, [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x " * 30_000)])
    p = [r.p for r in extra.withColumn("p", module.score(model, F.col("text"))).collect()]
    assert all(0 <= x <= 1 for x in p) and p[0] == p[1] and p[2] == p[3]


@pytest.mark.parametrize("module, target", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_without_both_classes(spark, module, target):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(10)] + [(None, None)])
    ones = spark.createDataFrame([(i, 1) for i in range(10)] + [(None, 1), (3, None), (3, 0)], f"doc_id long, {target} int")
    for labels, value in ((ones, 1.0), (ones.limit(0), 0.5 if module is quality else 0.0)):
        score = module.score(module.fit(docs, labels), F.col("text"))
        assert {r.p for r in docs.select(score.alias("p")).collect()} == {value}
    assert module.fit(docs.limit(0), ones).share in (0.0, 0.5)


def labelled_rows(spark, sf, target):
    """(doc_id, text) of all documents, and the label of those that may be learned from."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    label = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        if r[target] in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 5 != 0:
            label[r.doc_id] = max(r[target], label.get(r.doc_id, 0))
    return docs, label


def test_quality_equals_a_plain_discriminant(spark, sf):
    """The scores of two shrunk Gaussians, with determinants and inverses in place of factors and sums of products."""
    docs, label = labelled_rows(spark, sf, "quality")
    groups = [np.array([quality.statistics(t) for d, t in docs if label.get(d) == k]) for k in (0, 1)]
    n = [len(g) for g in groups]
    spread = [np.cov(g.T, bias=True) for g in groups]
    pooled = (n[0] * spread[0] + n[1] * spread[1]) / sum(n)

    def density(x, k):
        s = 0.95 * (0.7 * spread[k] + 0.3 * pooled) + 0.05 * np.diag(np.diag(pooled) + 1e-6)
        away = x - groups[k].mean(axis=0)
        return np.log(n[k]) - np.linalg.slogdet(s)[1] / 2 - away @ np.linalg.inv(s) @ away / 2
    read = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(read, spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r.s for r in read.select("doc_id", quality.score(model, F.col("text")).alias("s")).collect()}
    for d, t in docs:
        x = np.array(quality.statistics(t))
        gap = np.clip(density(x, 0) - density(x, 1), -700, 700)
        assert got[d] == pytest.approx(1 / (1 + np.exp(gap)), abs=1e-6)


def test_toxicity_equals_a_plain_regression(spark, sf):
    """N-grams counted by dictionaries, ratios one by one, and the regression over a dense table."""
    docs, label = labelled_rows(spark, sf, "toxic")
    held = [(set(toxicity.grams(t).tolist()), label[d]) for d, t in docs if d in label]
    n = [sum(y == k for _, y in held) for k in (0, 1)]
    count = defaultdict(lambda: [0, 0])
    for grams, y in held:
        for g in grams:
            count[g][y] += 1
    ratio = {g: np.log((c[1] + 1) / (n[1] + 2)) - np.log((c[0] + 1) / (n[0] + 2)) for g, c in count.items()}
    best = sorted(ratio, key=lambda g: (-round(max(ratio[g] * count[g][1] / n[1], -ratio[g] * count[g][0] / n[0]), 12), g))[:toxicity.MAX_FEATURES]
    x = np.array([[ratio[g] if g in grams else 0.0 for g in best] for grams, _ in held])
    y = np.array([v for _, v in held], float)
    cost = np.where(y == 1, 0.5 / n[1], 0.5 / n[0])
    w, b, m, v = np.zeros(len(best)), 0.0, np.zeros(len(best) + 1), np.zeros(len(best) + 1)
    for step in range(1, 301):
        slope = cost * (1 / (1 + np.exp(-(x @ w + b))) - y)
        g = np.append(x.T @ slope + 1e-3 * w, slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    weight = dict(zip(best, w * np.array([ratio[g] for g in best])))
    read = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(read, spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r.s for r in read.select("doc_id", toxicity.score(model, F.col("text")).alias("s")).collect()}
    away = [abs(got[d] - 1 / (1 + np.exp(-(b + sum(weight.get(g, 0.0) for g in toxicity.grams(t).tolist()))))) for d, t in docs]
    assert max(away) < 0.02 and sum(away) / len(away) < 2e-3  # n-grams that tie at the last place may differ
