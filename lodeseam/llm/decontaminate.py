"""Benchmark decontamination: CGK embedding and bit sampling over item-sized windows.

A document is contaminated by an item of n words if some run of its words is within an edit distance
of k = floor(share * n) words of it (words lower-cased, split at white space).

1. Windows. An item cut into k + 1 pieces keeps one piece whole under k edits, so a passage within the distance
   holds q = floor(n / (k + 1)) successive words of the item. Only windows of n words that put such
   words at their place in the item are looked at; this loses no passage.
2. Search. Windows and items are walked by the CGK random embedding, which turns edits into
   differing places, several times over; each table samples ``sampled`` places of one embedding, and a
   window meets the items with which it agrees in a table. The number of tables is doubled until
   edited copies of the items, k edits each, are met with the target recall.
3. Verification. The exact edit distance between the item and the best run of words around the window.

Items are collected in slices of at most ``MAX_ITEMS``; documents are read once per slice.

Defined cases: null and empty texts hold nothing; an item without words (or null) is never found; items with fewer than 1 / share words
must occur exactly; repeated rows give repeated results; items with equal text are all reported;
extra columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.pandas.types import to_arrow_schema

from lodeseam.llm.common import WordCodes

SHARE = 0.2
TARGET_RECALL = 0.998
MAX_ITEMS = 100_000
#: Lengths up to this factor apart are tuned together; more tables than this are not tried.
BAND, MOST_TABLES = 1.25, 4096
#: Embeddings, places sampled by a table, and texts whose words are looked through at once.
EMBEDDINGS, SAMPLED, BLOCK = 8, 3, 500
_ODD = np.int64(-7046029254386353131)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several columns of hashes; order matters."""
    total = np.zeros(parts[0].shape, np.int64)
    for part in parts:
        total = (total ^ part) * _ODD
        total ^= (total >> 29) & np.int64(0x7FFFFFFFF)
    return total


def embed(symbols: np.ndarray, seed: int) -> np.ndarray:
    """CGK walks (row, embedding, 3 n): repeat the symbol in hand, go on by a random bit of it."""
    rows, n = symbols.shape
    padded = np.hstack([symbols, np.zeros((rows, 1), np.int64)])
    salt = np.random.default_rng(seed).integers(-2**63, 2**63, (3 * n, EMBEDDINGS))
    out = np.empty((rows, EMBEDDINGS, 3 * n), np.int64)
    at = np.zeros((rows, EMBEDDINGS), np.int64)
    row = np.arange(rows)[:, None]
    for j in range(3 * n):
        out[:, :, j] = symbol = padded[row, at]
        bit = ((symbol ^ salt[j]) * _ODD >> 40) & 1
        at = np.minimum(at + bit, n)
    return out


def keys(symbols: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """(row, table): the hash of the places that each table samples."""
    walks = embed(symbols, seed)
    places = np.random.default_rng(seed + 1).integers(0, walks.shape[2], (tables, SAMPLED))
    return np.stack([_mixed([np.full(len(symbols), t, np.int64)] + [walks[:, t % EMBEDDINGS, p] for p in places[t]])
                     for t in range(tables)], axis=1)


def fitting(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to a run of the text, and that run: the first to end, the longest."""
    def last_row(pattern: np.ndarray, body: np.ndarray, free: bool) -> np.ndarray:
        column = np.arange(len(body) + 1)
        row = np.zeros_like(column) if free else column.copy()
        for i, symbol in enumerate(pattern, 1):
            step = np.minimum(row[1:] + 1, row[:-1] + (body != symbol))
            best = np.concatenate(([i], step))
            row = np.minimum.accumulate(best - column) + column  # insertions
        return row
    ends = last_row(item, text, True)
    end = int(ends.argmin())
    back = last_row(item[::-1], text[:end][::-1], False)
    return int(ends[end]), end - int(np.flatnonzero(back == ends[end])[-1]), end


@dataclass
class Finder:
    """Finds the items (of one slice) in texts; the item tables are built where it is first used."""

    items: list[list[str]]
    share: float = SHARE
    #: Tables by number of words of an item; 0 where hashing does not meet the target and windows are compared exactly.
    tables: dict[int, int] = field(default_factory=dict)
    words: WordCodes | None = None

    def allowed(self, n: int) -> int:
        return math.floor(self.share * n + 1e-9)

    def tuned(self, target: float = TARGET_RECALL, sample: int = 200) -> Finder:
        """With as many tables as it takes to meet edited copies of the items, for each band of lengths by itself."""
        bands: dict[int, list[list[str]]] = {}
        for words in self.items:
            if words:
                bands.setdefault(round(math.log(len(words), BAND)) if self.allowed(len(words)) else -1, []).append(words)
        for band, members in bands.items():
            rng = np.random.default_rng(7)
            chosen = [members[i] for i in rng.permutation(len(members))[:sample]]
            tables = 2 * EMBEDDINGS
            while band >= 0 and tables and self._met(chosen, tables, rng) < target * len(chosen):
                tables = 2 * tables if 2 * tables <= MOST_TABLES else 0
            tables *= 2 if band >= 0 else 1  # what was just enough for the sample may not be for others: squares the share that is missed
            self.tables.update((len(words), tables) for words in members)
        return self

    def _met(self, chosen: list[list[str]], tables: int, rng: np.random.Generator) -> int:
        """How many items share a key with a copy of as many edits as are allowed."""
        pairs: dict[int, list] = {}
        for words in chosen:
            codes, n = WordCodes().of(words), len(words)
            copy = codes.tolist()
            for _ in range(self.allowed(n)):
                at, kind = int(rng.integers(len(copy))), rng.integers(3)
                copy[at:at + (kind < 2)] = [] if kind == 0 else [int(rng.integers(2**62))]
            pairs.setdefault(n, []).append((codes, (copy + [0] * n)[:n]))
        met = 0
        for n, both in pairs.items():
            first, second = (keys(np.array(side, np.int64), tables, n) for side in zip(*both))
            met += int((first == second).any(axis=1).sum())
        return met

    def _prepare(self) -> None:
        self.codes = [WordCodes().of(w) for w in self.items]
        grams: dict[int, list] = {}
        groups: dict[int, list[int]] = {}
        for i, codes in enumerate(self.codes):
            n = len(codes)
            if n:
                groups.setdefault(n, []).append(i)
                q = n // (self.allowed(n) + 1)
                windows = np.lib.stride_tricks.sliding_window_view(codes, q)
                grams.setdefault(q, []).append((_mixed(list(windows.T)), np.arange(len(windows)), np.full(len(windows), n)))
        self.grams = {}
        for q, parts in grams.items():  # (hash, offset in the item, words of the item), by hash
            found = np.unique(np.stack([np.concatenate(p) for p in zip(*parts)], axis=1), axis=0)
            self.grams[q] = found
        self.groups = {}
        for n, members in groups.items():
            symbols, tables = np.stack([self.codes[i] for i in members]), self.tables[n]
            table = keys(symbols, tables, n) if tables else self._grams_of(symbols)
            order = np.argsort(table, axis=None, kind="stable")
            self.groups[n] = (table.ravel()[order], np.repeat(members, table.shape[1])[order])
        self.words = WordCodes()

    def _grams_of(self, symbols: np.ndarray) -> np.ndarray:
        """The runs of words, so short that an allowed copy of an item keeps one of its item's: the exact way."""
        n = symbols.shape[1]
        windows = np.lib.stride_tricks.sliding_window_view(symbols, n // (self.allowed(n) + 1), axis=1)
        return _mixed([windows[:, :, j] for j in range(windows.shape[2])])

    def _windows(self, codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Distinct (first word, words, text) of the windows to look at."""
        out = []
        for q, table in self.grams.items():
            if len(codes) < q:
                continue
            gram = _mixed([codes[j:len(codes) - q + 1 + j] for j in range(q)])
            low = np.searchsorted(table[:, 0], gram)
            hit = np.flatnonzero((table[np.minimum(low, len(table) - 1), 0] == gram)
                                 & (doc[:len(gram)] == doc[q - 1:]))
            low, high = low[hit], np.searchsorted(table[:, 0], gram[hit], "right")
            entry = np.repeat(low, high - low) + _ramp(high - low)
            at = np.repeat(hit, high - low)
            out.append(np.stack([at - table[entry, 1], table[entry, 2], doc[at]], axis=1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)

    def find(self, texts: list[str | None]) -> list[dict[int, tuple[int, int, int]]]:
        """Per whole text: item -> (edit distance, first word, word behind the last)."""
        if self.words is None:
            self._prepare()
        results: list[dict] = [{} for _ in texts]
        whole, spans = [], []  # words of the texts with windows, and windows (text, first, words)
        for start in range(0, len(texts), BLOCK):
            split = [words_of(t) for t in texts[start:start + BLOCK]]
            length = np.array([len(w) for w in split])
            codes = self.words.of([w for words in split for w in words])
            doc, begin = np.repeat(np.arange(len(split)), length), np.cumsum(length) - length
            for first, n, text in self._windows(codes, doc).tolist():
                spans.append((start + text, first - int(begin[text]), n))
            used = {t for t, _, _ in spans if t >= start}
            whole.extend((t, codes[begin[t - start]:begin[t - start] + length[t - start]]) for t in used)
        codes_of = dict(whole)
        for n in sorted({n for _, _, n in spans}):
            of_size = [s for s in spans if s[2] == n]
            for at in range(0, len(of_size), 2000):
                self._match(of_size[at:at + 2000], int(n), codes_of, results)
        return results

    def _match(self, spans: list, n: int, codes_of: dict, results: list[dict]) -> None:
        symbols = np.zeros((len(spans), n), np.int64)
        for row, (text, first, _) in zip(symbols, spans):
            low = max(first, 0)
            part = codes_of[text][low:first + n]
            row[low - first:low - first + len(part)] = part
        table, members = self.groups[n]
        found = keys(symbols, self.tables[n], n) if self.tables[n] else self._grams_of(symbols)
        low, high = np.searchsorted(table, found), np.searchsorted(table, found, "right")
        pairs = {(int(row), int(item)) for row, t in zip(*np.nonzero(high > low))
                 for item in members[low[row, t]:high[row, t]]}
        k = self.allowed(n)
        for row, item in sorted(pairs):
            text, first, _ = spans[row]
            low = max(first - k, 0)
            distance, start, end = fitting(self.codes[item], codes_of[text][low:max(first + n + k, 0)])
            best = (distance, low + start, low + end)
            if distance <= k and best < results[text].get(item, (k + 1, 0, 0)):
                results[text][item] = best

def _ramp(length: np.ndarray) -> np.ndarray:
    return np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)


def finders(benchmark: DataFrame, share: float = SHARE) -> Iterator[tuple[list, Finder]]:
    """(item ids, finder) of each slice of the benchmark."""
    items = benchmark.select("item_id", "text")
    slices = max(1, math.ceil(items.count() / MAX_ITEMS))
    for s in range(slices):
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == s)
        rows = sorted(part.collect(), key=lambda r: (str(r.item_id), r.text or ""))
        yield [r.item_id for r in rows], Finder([words_of(r.text) for r in rows], share).tuned()


def matches(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, edit_distance, first_word, n_words): each item found in each document."""
    documents = documents.select("doc_id", "text")
    id_type, item_type = (t.schema[c].dataType.simpleString() for t, c in ((documents, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {id_type}, item_id {item_type}, edit_distance int, first_word int, n_words int"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    out = None
    for ids, finder in finders(benchmark, share):
        shared = documents.sparkSession.sparkContext.broadcast((ids, finder))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, finder = shared.value
            for batch in batches:
                rows = [(at, ids[item], d, a, b - a) for at, found in enumerate(finder.find(batch.column("text").to_pylist()))
                        for item, (d, a, b) in found.items()]
                held = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.record_batch([held, *(pa.array([r[i] for r in rows], arrow.field(i).type) for i in range(1, 5))], schema=arrow)
        part = documents.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out


def contaminated(benchmark: DataFrame, text: Column, share: float = SHARE) -> Column:
    """Whether a text column holds any item."""
    result = F.lit(False)
    for _, finder in finders(benchmark, share):
        result = result | _holds(benchmark.sparkSession.sparkContext.broadcast(finder))(text)
    return result


def _holds(shared):
    @pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(found) for found in shared.value.find(list(texts))], dtype=bool)
    return holds
