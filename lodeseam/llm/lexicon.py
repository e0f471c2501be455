"""Word BPE through a lexicon: frequent words in a minimal automaton, all others merged exactly.

Words that occur often in the corpus are compiled into a minimal acyclic automaton over their bytes
(equal suffixes share states). Each word's number in it, summed up along its path, selects its ids.
The automaton is one flat file in the shared folder; Spark ships it to every executor, where the
Python workers memory-map it. Words that it does not hold are merged by rank, many at a time.

The lexicon only saves work: results are the same whatever it holds.

Defined cases: null and empty texts have no ids and decode to empty text; texts of any length are
processed whole, in blocks of words; repeated rows give equal results; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lodeseam.session import shared_dir

LEXICON_WORDS = 65_536
#: A task reports a word to the corpus count once it has met it this often.
MIN_IN_TASK = 4
#: Words whose results a task keeps at hand, and characters of text it handles at once.
KEPT, BLOCK_CHARS = 400_000, 4_000_000
#: Longer words are merged one by one with a heap.
WIDEST = 64
_PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_PYTHON_ONLY_SPACE = "\x1c\x1d\x1e\x1f"
_NONE = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@dataclass
class Merges:
    """The merge table of a BPE file with word ends, as sorted arrays."""

    tokens: list[str]
    special: dict[str, int]
    plain: np.ndarray
    final: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray

    @classmethod
    def read(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary, end = file["model"]["vocab"], file["model"]["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        tokens = [""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for token, i in [*vocabulary.items(), *special.items()]:
            tokens[i] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        key = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        letters = byte_alphabet()
        return cls(tokens, special, np.array([vocabulary[c] for c in letters], np.int64),
                   np.array([vocabulary[c + end] for c in letters], np.int64), key[order], order,
                   np.array([vocabulary[a + b] for a, b in pairs], np.int64)[order])

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; the rank is _NONE where the pair does not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], _NONE), self.results[at]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word (not empty), by merging the pair of lowest rank, leftmost first."""
        out: list[list[int]] = [[]] * len(words)
        length = np.array([len(w) for w in words])
        low = 0
        for high in (8, 16, 32, WIDEST):
            rows = np.flatnonzero((length > low) & (length <= high))
            low = high
            for start in range(0, len(rows), 50_000):
                part = rows[start:start + 50_000]
                for i, ids in zip(part, self._merge_rows([words[i] for i in part], length[part], high)):
                    out[i] = ids
        for i in np.flatnonzero(length > WIDEST):
            out[i] = self._merge_long(words[i])
        return out

    def _merge_rows(self, words: list[bytes], length: np.ndarray, width: int) -> list[list[int]]:
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = np.full((len(words), width + 1), -1, np.int64)
        ids[:, :width] = np.where(np.arange(width) < length[:, None], self.plain[raw], -1)
        every = np.arange(len(words))
        ids[every, length - 1] = self.final[raw[every, length - 1]]
        rank, result = self._find(ids[:, :-1], ids[:, 1:])
        done: list[list[int]] = [[]] * len(words)
        while len(every):
            best = rank.argmin(axis=1)
            row = np.arange(len(every))
            going = rank[row, best] != _NONE
            for i, left in zip(every[~going], ids[~going].tolist()):
                done[i] = left[:left.index(-1)]
            every, ids, rank, result, best = every[going], ids[going], rank[going], result[going], best[going]
            row = np.arange(len(every))
            ids[row, best] = result[row, best]
            column = np.arange(ids.shape[1] - 1)
            shift = column[None, :] > best[:, None]  # everything right of the merged pair moves by one
            ids[:, :-1] = np.where(shift, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            for table, empty in ((rank, _NONE), (result, 0)):
                table[:, :-1] = np.where(shift[:, :-1], table[:, 1:], table[:, :-1])
                table[:, -1] = empty
            rank[row, best], result[row, best] = self._find(ids[row, best], ids[row, best + 1])
            before = row[best > 0]
            at = best[before]
            rank[before, at - 1], result[before, at - 1] = self._find(ids[before, at - 1], ids[before, at])
        return done

    def _merge_long(self, word: bytes) -> list[int]:
        ids = self.plain[np.frombuffer(word, np.uint8)]
        ids[-1] = self.final[word[-1]]
        rank, result = self._find(ids[:-1], ids[1:])
        ids = ids.tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = [(r, i, ids[i], ids[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), result.tolist()))
                 if r != _NONE]
        heapq.heapify(queue)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue  # one side has been merged meanwhile
            ids[i], ids[j], after[i] = merged, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids):
                    r, m = self._find(np.array([ids[a]]), np.array([ids[b]]))
                    if r[0] != _NONE:
                        heapq.heappush(queue, (int(r[0]), a, ids[a], ids[b], int(m[0])))
        return [i for i in ids if i >= 0]


def build_automaton(entries: Iterable[tuple[bytes, list[int]]]) -> np.ndarray:
    """The flat automaton of (word, ids), words ascending and distinct.

    Layout, all int64: counts of edges, words and ids; the edges' keys (state << 8 | byte,
    ascending), targets and numbers (words that come before those behind the edge); whether each state ends a
    word; the offsets of each word's ids; the ids. State 0 is the root.
    """
    register: dict[tuple, int] = {}
    nodes: list[tuple[bool, tuple]] = []
    words, ids, offsets = 0, [], [0]

    def settle(path: list, depth: int) -> None:
        """Replace the open nodes below ``depth`` by registered equals, the deepest first."""
        while len(path) > depth + 1:
            ends, edges = path.pop()
            shape = (ends, tuple(edges))
            if shape not in register:
                register[shape] = len(nodes)
                nodes.append(shape)
            path[-1][1][-1] = (path[-1][1][-1][0], register[shape])

    path: list = [[False, []]]
    last = b""
    for word, out in entries:
        same = next((k for k, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        settle(path, same)
        for byte in word[same:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        last, words = word, words + 1
        ids.extend(out)
        offsets.append(len(ids))
    settle(path, 0)
    root = len(nodes)
    nodes.append((path[0][0], tuple(path[0][1])))
    behind = [0] * len(nodes)  # children are registered before their parents
    edges = []
    for state, (ends, out_edges) in enumerate(nodes):
        count = int(ends)
        for byte, target in out_edges:
            edges.append(((0 if state == root else state + 1) << 8 | byte, target + 1, count))
            count += behind[target]
        behind[state] = count
    edges.sort()
    table = np.array(edges, np.int64).reshape(-1, 3).T
    ends = np.array([nodes[root][0], *(n[0] for n in nodes)], np.int64)
    return np.concatenate([np.array([table.shape[1], len(ends), words, len(ids)], np.int64), table[0], table[1],
                           table[2], ends, np.array(offsets, np.int64), np.array(ids, np.int64)])


@dataclass
class Automaton:
    """A flat automaton, opened for look-up."""

    flat: np.ndarray
    parts: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        edges, states, words, ids = (int(n) for n in self.flat[:4])
        cuts = np.cumsum([4, edges, edges, edges, states, words + 1, ids])
        self.parts = [self.flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def look_up(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, None for words that it does not hold; all words walk in step."""
        keys, targets, numbers, ends, offsets, ids = self.parts
        if not len(keys) or not words:
            return [None] * len(words)
        raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        length = np.array([len(w) for w in words])
        start = np.concatenate(([0], np.cumsum(length)[:-1]))
        found: list[list[int] | None] = [None] * len(words)
        alive, state, number, depth = np.arange(len(words)), np.zeros(len(words), np.int64), \
            np.zeros(len(words), np.int64), 0
        while len(alive):
            over = length[alive] == depth
            hit = over & (ends[state] == 1)
            for i, w in zip(alive[hit].tolist(), number[hit].tolist()):
                found[i] = ids[offsets[w]:offsets[w + 1]].tolist()
            alive, state, number = alive[~over], state[~over], number[~over]
            key = state << 8 | raw[start[alive] + depth]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            known = keys[at] == key
            alive, at = alive[known], at[known]
            state, number, depth = targets[at], number[known] + numbers[at], depth + 1
        return found


def segments(text: str, special: dict[str, int]) -> Iterator[str | list[str]]:
    """Special tokens as they are, and the white-space separated, normalised words between them."""
    parts = re.split("(" + "|".join(map(re.escape, special)) + ")", text) if special and "<|" in text else [text]
    for part in parts:
        if part in special:
            yield part
            continue
        if not unicodedata.is_normalized("NFC", part):
            part = unicodedata.normalize("NFC", part)
        odd = any(c in part for c in _PYTHON_ONLY_SPACE)
        # a capital sigma is lowered by itself, not by its place in the word
        lower = part.replace("Σ", "σ").lower()
        yield [w for w in _SPACE.split(lower) if w] if odd else lower.split()


def pre_tokens(word: str) -> list[str]:
    """The parts of a word that merge by themselves."""
    if word.isalpha():
        return [word]
    if word[:-1].isalpha() and word[-1] in ".,":
        return [word[:-1], word[-1]]
    return _PRE_TOKENS.findall(word)


class Encoder:
    """Results per word, joined by spaces: its ids as decimals, and its tokens."""

    def __init__(self, merges: Merges, automaton: Automaton | None = None):
        self.merges, self.automaton = merges, automaton
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}

    def _keep(self, word: str, ids: list[int]) -> None:
        tokens = self.merges.tokens
        self.ids[word] = " ".join(map(str, ids))
        self.tokens[word] = " ".join([tokens[i] for i in ids])

    def learn(self, words: set[str]) -> None:
        """Keep the results of words, each made of parts that merge by themselves."""
        ids, tokens = self.ids, self.tokens
        compound = [(w, pre_tokens(w)) for w in words if not w.isalpha()]
        distinct = {w for w in words if w.isalpha()}
        distinct.update(p for _, ps in compound for p in ps if p not in ids)
        parts = list(distinct)
        raw = [p.encode("utf-8", "surrogatepass") for p in parts]
        found = self.automaton.look_up(raw) if self.automaton else [None] * len(raw)
        rest = [i for i, x in enumerate(found) if x is None]
        for i, merged in zip(rest, self.merges.merge([raw[i] for i in rest])):
            found[i] = merged
        for part, x in zip(parts, found):
            self._keep(part, x)
        for word, ps in compound:
            ids[word] = " ".join([ids[p] for p in ps])
            tokens[word] = " ".join([tokens[p] for p in ps])

    def encode(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of ids, ids as decimals, decoded text) of each whole text."""
        special = self.merges.special
        split = [list(segments(t, special)) if t else [] for t in texts]
        new: set[str] = set()
        for parts in split:
            for part in parts:
                if isinstance(part, str):
                    self._keep(part, [special[part]])
                else:
                    new.update(part)
        self.learn({w for w in new if w not in self.ids})
        rows = []
        for parts in split:
            words = parts[0] if len(parts) == 1 and not isinstance(parts[0], str) else \
                [w for p in parts for w in ([p] if isinstance(p, str) else p)]
            ids = " ".join(map(self.ids.__getitem__, words))
            rows.append((ids.count(" ") + 1 if ids else 0, ids, " ".join(map(self.tokens.__getitem__, words))))
        if len(self.ids) > KEPT:
            self.ids.clear()
            self.tokens.clear()
        return rows


def blocks(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """The texts in runs of about BLOCK_CHARS characters; a text is never cut."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def frequent_words(documents: DataFrame, special: dict[str, int], words: int = LEXICON_WORDS) -> list[str]:
    """The most frequent parts of words over all documents, the most frequent first."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                for part in segments(text or "", special):
                    if not isinstance(part, str):
                        seen.update(part)
            if len(seen) > KEPT:
                yield report(seen)
                seen.clear()
        yield report(seen)

    def report(seen: Counter) -> pd.DataFrame:
        parts: Counter = Counter()
        for word, n in seen.items():
            if n >= MIN_IN_TASK and len(word) <= WIDEST:
                for part in pre_tokens(word):
                    parts[part] += n
        return pd.DataFrame({"word": pd.Series(list(parts.keys()), dtype=object), "n": list(parts.values())})
    counts = documents.select("text").mapInPandas(counted, "word string, n long")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return [r.word for r in top.collect()]


def publish(spark: SparkSession, flat: np.ndarray) -> str:
    """Write an automaton to the shared folder and let Spark ship it; returns its file name."""
    name = f"lexicon-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(flat.tobytes()))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def encode(documents: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as decimals joined by spaces; decoded text."""
    return _encoded(documents, path, lexicon_words, "n_tokens long, ids string, decoded string", lambda r: r)


def digests(documents: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what ``encode`` gives."""
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return _encoded(documents, path, lexicon_words, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                    lambda r: (r[0], sha(r[1]), sha(r[2])))


def _encoded(documents: DataFrame, path: str, lexicon_words: int, schema: str, shape) -> DataFrame:
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    merges = Merges.read(path)
    words = sorted({w.encode("utf-8", "surrogatepass"): None for w in
                    frequent_words(documents, merges.special, lexicon_words)})
    name = publish(spark, build_automaton(zip(words, merges.merge(words))))
    tables = spark.sparkContext.broadcast(merges)
    id_type = documents.schema["doc_id"].dataType.simpleString()
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables.value, Automaton(np.memmap(SparkFiles.get(name), np.int64, "r")))
        for batch in batches:
            start = 0
            for block in blocks(batch.column("text").to_pylist()):
                rows = [shape(r) for r in encoder.encode(block)]
                found = {f.name: pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)}
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(start, len(block)), **found})
                start += len(block)
    return documents.mapInArrow(run, f"doc_id {id_type}, {schema}")
