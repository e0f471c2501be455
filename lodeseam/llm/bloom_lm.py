"""Language-model scores from a log-frequency Bloom filter of bigram counts.

Tokens are the white-space separated words of a text, A-Z lower-cased, and one end token (the empty word) after them. The
end token also stands before a text. Two things are learned from the training rows, over all of their tokens:

* the exact count of every token, as arrays sorted by 64-bit hash (words of equal hash are told apart by trying another seed);
* a Bloom filter that holds each bigram once per level 1..q, where q is the place of its count on the scale 1, 2, 3, 4, 6, 8, 12, 16, 24, ...
  (steps of half a binary digit). A count is looked up by probing levels until one is absent, and stands for the mean count of its last
  level. A bigram is never rated below its level; an absent one passes a level by mistake in under one case of a hundred (``BITS``
  bits an entry, all bits of an entry in one word).

A token w after h has probability (k + MU * p(w)) / (c(h) + MU): k the looked-up count of hw, at most c(h) and c(w); c exact;
p(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)), which alone makes the base score. Over all w that sums to 1 with exact counts.

Bigram keys move once, as sorted arrays per hash range; each range is counted, quantised and turned into its own piece of the filter by one task.
Workers get the model by broadcast, in rounds of at most ``ROUND_BYTES``. A task reads its texts once, takes the words and bigrams of up to
``LOOKED_UP`` tokens through all rounds, one round in memory at a time, and adds up. The scores do not depend on the number of rounds.

Defined cases: a null id trains (the crc32 of an empty text is 0); null and empty texts are the end token alone; texts of any length are read
whole, in pieces cut at white space; repeated rows train and score each; extra columns play no part; with no training rows N, V
and all counts are 0 and every token has probability 1; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeseam.llm.common import discard, stored

END = b""
BITS, PROBES = 16, 5
#: The least count of each level.
SCALE = np.unique([x << e for e in range(61) for x in (1, 2, 3)])
LEVELS = len(SCALE)
MU = 60.0
#: Bytes of model in one broadcast: what a worker, and the driver, has in memory at once.
ROUND_BYTES = 24 << 20
#: Tokens that a task looks up in one pass through the rounds (some 50 bytes each).
LOOKED_UP = 1_500_000
#: Bigram occurrences that share a piece of the filter, at most as many keys as a task holds; words of a piece of the vocabulary.
PIECE_TOKENS, PIECE_WORDS = 4_000_000, 1_000_000
#: Tokens handled at once; bytes of text handled at once or cut off a longer one; bytes of words, and number of bigrams, a task keeps at hand.
BLOCK, CUT, KEPT, HELD = 200_000, 1_000_000, 24 << 20, 2_000_000
_SPACE = re.compile(rb"[ \t-\r]")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@contextmanager
def short_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Fewer rows than usual go to a worker at once, as texts can be long."""
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(option)
    spark.conf.set(option, str(rows))
    try:
        yield
    finally:
        spark.conf.set(option, before)


class Words(dict):
    """Numbers of the words a task has met, and their hashes. :meth:`forget` them once they are :meth:`full`."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed, self.names, self.hashes, self.size = seed, [], np.zeros(0, np.uint64), 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        self.size += len(word) + 160
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        new = [xxhash.xxh3_64_intdigest(w, self.seed) for w in self.names[len(self.hashes):]]
        if new:
            self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        return numbers

    def full(self) -> bool:
        return self.size > KEPT

    def forget(self) -> None:
        self.clear()
        self.names, self.hashes, self.size = [], np.zeros(0, np.uint64), 0


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``CUT`` bytes, no word cut in two."""
    at = 0
    while len(text) - at > CUT:
        space = _SPACE.search(text, at + CUT)
        if space is None:
            break
        yield text[at:space.start()]
        at = space.end()
    yield text[at:]


def token_blocks(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(number of the text, token) of all tokens, a block at a time."""
    owner, words, sizes = [], [], []

    def block() -> tuple[np.ndarray, list[bytes]]:
        return np.repeat(np.array(owner, np.int64), sizes), words
    for number, text in enumerate(texts):
        for piece in pieces((text or b"").lower()):
            found = piece.split()
            words += found
            owner.append(number)
            sizes.append(len(found))
            if len(words) >= BLOCK:
                yield block()
                owner, words, sizes = [], [], []
        words.append(END)
        owner.append(number)
        sizes.append(1)
    if words:
        yield block()


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``CUT`` bytes of text, so that what is held per token stays small."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
        part = (np.cumsum(size) - size) // CUT
        edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else []
        for a, b in zip(edge, edge[1:]):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def bigrams(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return scrambled(before * _MIX[0] + scrambled(now))


def slots(keys: np.ndarray, level: int, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Where a level of each key is held in a filter of so many 64-bit words, and the bits it sets there."""
    h = scrambled(keys + np.uint64(level * int(_MIX[0]) % (1 << 64)))
    at = ((h >> np.uint64(32)) * np.asarray(words, np.uint64)) >> np.uint64(32)
    bits = np.zeros(len(keys), np.uint64)
    for i in range(PROBES):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return at.astype(np.int64), bits


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


# ---- what is learned -----------------------------------------------------------------------------

def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): exact counts of all tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Words(), np.zeros(0, np.int64)

        def rows() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(words.names, pa.binary()), "n": pa.array(total)})
        for batch in slices(batches):
            for _, block in token_blocks(texts_of(batch)):
                part = np.bincount(words.of(block), minlength=len(words.names))
                part[:len(total)] += total
                total = part
                if words.full():
                    yield rows()
                    words.forget()
                    total = np.zeros(0, np.int64)
        yield rows()
    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, distinct: int) -> tuple[DataFrame, int]:
    """Pieces (piece, hashes, counts) of the sorted vocabulary by hash range, and the seed with no two equal hashes."""
    shift = _shift(distinct, PIECE_WORDS)
    for seed in range(64):
        def hashed(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in batch.column("word").to_pylist()], np.uint64)
                yield pa.record_batch({"piece": _range(h, shift), "hash": h.view(np.int64), "n": batch.column("n")})

        def piece(rows: pa.Table) -> pa.Table:
            h = rows.column("hash").to_numpy().view(np.uint64)
            order = np.argsort(h)
            h, n = h[order], rows.column("n").to_numpy()[order]
            return pa.table({"piece": rows.column("piece")[:1], "hashes": [h.tobytes()], "counts": [n.astype(np.int64).tobytes()],
                             "clash": [bool((h[1:] == h[:-1]).any())]})
        made = stored(counts.mapInArrow(hashed, "piece long, hash long, n long").groupBy("piece")
                      .applyInArrow(piece, "piece long, hashes binary, counts binary, clash boolean"))
        if made.where("clash").isEmpty():
            return made, seed
        discard(made)
    raise RuntimeError("words of equal hash under every seed")


def _shift(n: int, each: int) -> int:
    """By how many bits a 64-bit hash is shifted to number ranges that hold ``each`` of ``n`` values."""
    return 64 - max(0, (max(n, 1) - 1) // each).bit_length()


def _range(hashes: np.ndarray, shift: int) -> np.ndarray:
    return (hashes >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(hashes), np.int64)


def bigram_counts(texts: DataFrame, shift: int, seed: int) -> DataFrame:
    """(piece, once, keys, counts): hashes of bigrams met once, and of others with counts, per hash range and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, loose, n_loose = Words(seed), (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0
        end = np.uint64(xxhash.xxh3_64_intdigest(END, seed))

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([held[0], *loose])
            return counted(keys, np.concatenate([held[1], np.ones(len(keys) - len(held[0]), np.int64)]))

        def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            piece = _range(keys, shift)
            first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])) if len(keys) else []
            out = []
            for a, b in zip(first, [*first[1:], len(keys)]):
                one = n[a:b] == 1
                out.append((int(piece[a]), keys[a:b][one].tobytes(), keys[a:b][~one].tobytes(), n[a:b][~one].tobytes()))
            return pa.record_batch([pa.array([r[i] for r in out], pa.binary() if i else pa.int64()) for i in range(4)],
                                   names=["piece", "once", "keys", "counts"])
        for batch in slices(batches):
            last = end
            for _, block in token_blocks(texts_of(batch)):
                numbers = words.of(block)
                now = words.hashes[numbers]
                loose.append(bigrams(np.concatenate([[last], now[:-1]]), now))
                last, n_loose = now[-1], n_loose + len(now)
                if words.full():
                    words.forget()
                if n_loose >= HELD:
                    held, loose, n_loose = merged(), [], 0
                    if len(held[0]) >= HELD:
                        yield rows(*held)
                        held = (held[0][:0], held[1][:0])
        yield rows(*merged())
    return texts.select("text").mapInArrow(run, "piece long, once binary, keys binary, counts binary")


def bloom(parts: DataFrame) -> DataFrame:
    """(piece, bits, seen, total): the filter of each hash range, and bigrams and their counts per level."""
    def joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind)

    def piece(rows: pa.Table) -> pa.Table:
        once, more = joined(rows.column("once"), np.uint64), joined(rows.column("keys"), np.uint64)
        keys, n = counted(np.concatenate([once, more]),
                          np.concatenate([np.ones(len(once), np.int64), joined(rows.column("counts"), np.int64)]))
        level = np.searchsorted(SCALE, n, "right")
        bits = np.zeros(max(1, int(level.sum()) * BITS // 64), np.uint64)
        for q in range(1, int(level.max(initial=0)) + 1):
            at, mask = slots(keys[level >= q], q, len(bits))
            np.bitwise_or.at(bits, at, mask)
        return pa.table({"piece": rows.column("piece")[:1], "bits": [bits.tobytes()],
                         "seen": [np.bincount(level, minlength=LEVELS + 1).tolist()],
                         "total": [np.bincount(level, n, LEVELS + 1).astype(np.int64).tolist()]})
    return parts.groupBy("piece").applyInArrow(piece, "piece long, bits binary, seen array<long>, total array<long>")


@dataclass
class Model:
    """``words`` and ``filter``: written tables of pieces. ``texts``: how often the end token occurs. ``value``: the mean count of
    each level."""

    words: DataFrame
    filter: DataFrame
    seed: int
    word_shift: int
    filter_shift: int
    tokens: int
    distinct: int
    texts: int
    value: np.ndarray


def fit(texts: DataFrame) -> Model:
    """Learn from the column ``text``."""
    with short_batches(texts.sparkSession):
        return _fit(texts)


def _fit(texts: DataFrame) -> Model:
    counts = stored(word_counts(texts))
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
                      F.coalesce(F.max(F.when(F.col("word") == F.lit(END), F.col("n"))), F.lit(0)).alias("texts")).first()
    words, seed = vocabulary(counts, size.v)
    discard(counts)
    shift = _shift(size.n, PIECE_TOKENS)
    pieces = stored(bloom(bigram_counts(texts, shift, seed)))
    level = (pieces.select(F.posexplode(F.arrays_zip("seen", "total")).alias("q", "x")).groupBy("q")
             .agg(F.sum("x.seen").alias("seen"), F.sum("x.total").alias("total")).collect())
    value = np.zeros(LEVELS + 1)
    for r in level:
        value[r.q] = r.total / r.seen if r.seen else 0.0
    return Model(words, pieces, seed, _shift(size.v, PIECE_WORDS), shift, size.n, size.v, size.texts, value)


# ---- scoring ---------------------------------------------------------------------------------------

@dataclass
class Round:
    """Pieces of a model in workers' memory: a range of the vocabulary and one of the filter."""

    hashes: np.ndarray
    counts: np.ndarray
    first: int            # number of the first piece of the filter that is here
    start: np.ndarray     # where each piece starts in ``bits``, and the end
    bits: np.ndarray

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """Exact counts; 0 for words that are not here."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.counts[at], 0)

    def level(self, keys: np.ndarray, shift: int) -> np.ndarray:
        """The last level that is present, with all below it, of each bigram; 0 for none."""
        found = np.zeros(len(keys), np.uint8)
        piece = _range(keys, shift) - self.first
        left = np.flatnonzero((piece >= 0) & (piece < len(self.start) - 1))
        start = self.start[piece[left]]
        width = self.start[piece[left] + 1] - start
        left, start, width = left[width > 0], start[width > 0], width[width > 0]
        for q in range(1, LEVELS + 1):
            if not len(left):
                break
            at, mask = slots(keys[left], q, width)
            held = self.bits[start + at] & mask == mask
            left, start, width = left[held], start[held], width[held]
            found[left] = q
        return found


def rounds(model: Model) -> list[dict[str, dict]]:
    """The pieces of each round, ``ROUND_BYTES`` at most: their 64-bit values by table and number, and the names of the ``files`` they are in.
    A larger piece is a round by itself."""
    sizes = [(kind, r.piece, r.n, r.file.rpartition("/")[2]) for kind, table, column in
             (("filter", model.filter, "bits"), ("words", model.words, "hashes"))
             for r in table.select("piece", F.octet_length(column).alias("n"), F.input_file_name().alias("file")).collect()]
    groups, room = [], 0
    for kind, piece, n, file in sorted(sizes):
        taken = n if kind == "filter" else 2 * n  # words come with their counts
        if not groups or taken > room:
            groups.append({"filter": {}, "words": {}, "files": {"filter": set(), "words": set()}})
            room = ROUND_BYTES
        groups[-1][kind][piece] = n // 8
        groups[-1]["files"][kind].add(file)
        room -= taken
    return groups or [{"filter": {}, "words": {}, "files": {"filter": set(), "words": set()}}]


def gathered(model: Model, group: dict[str, dict]) -> Round:
    """The pieces of a round, on the driver to be broadcast; they come one partition at a time into their places."""
    def start(widths: dict[int, int]) -> np.ndarray:
        """Where the pieces from the first to the last start, and the end."""
        first, last = (min(widths), max(widths)) if widths else (0, -1)
        return np.cumsum([0, *(widths.get(p, 0) for p in range(first, last + 1))], dtype=np.int64)

    def read(kind: str, table: DataFrame, *columns: str) -> list[np.ndarray]:
        widths = group[kind]
        at, first = start(widths), min(widths, default=0)
        out = [np.zeros(int(at[-1]), np.uint64) for _ in columns]
        if widths:
            files = table.sparkSession.read.schema(table.schema).parquet(*(f"{table.stored_at}/{f}" for f in sorted(group["files"][kind])))
            for row in files.where(F.col("piece").between(first, max(widths))).select("piece", *columns).toLocalIterator():
                for values, column in zip(out, row[1:]):
                    values[at[row.piece - first]:at[row.piece - first + 1]] = np.frombuffer(column, np.uint64)
        return out
    hashes, counts = read("words", model.words, "hashes", "counts")
    (bits,) = read("filter", model.filter, "bits")
    return Round(hashes, counts.view(np.int64), min(group["filter"], default=0), start(group["filter"]), bits)


def scores(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row, as a written table."""
    with short_batches(documents.sparkSession):
        return _scores(documents, model)


def _scores(documents: DataFrame, model: Model) -> DataFrame:
    spark = documents.sparkSession
    id_type = documents.schema["doc_id"].dataType.simpleString()
    shared = [spark.sparkContext.broadcast(gathered(model, group)) for group in rounds(model)]
    scored = stored(documents.select("doc_id", "text").mapInArrow(
        _scoring(shared, model), f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double"))
    for part in shared:
        part.destroy()
    return scored


def _parts(shared: list[Broadcast]) -> Iterator[Round]:
    """The rounds one after the other. Of several a worker keeps none, as ``value`` would."""
    for part in shared:
        alone = len(shared) == 1 or not hasattr(part, "_path")  # an encrypted one is in memory already
        yield part.value if alone else part.load_from_path(part._path)


class Tokens:
    """Tokens that are looked up together: the row of each and the place of its word among ``hashes``."""

    def __init__(self, seed: int):
        self.words, self.last = Words(seed), np.array([xxhash.xxh3_64_intdigest(END, seed)], np.uint64)
        self.clear()

    def clear(self) -> None:
        """Forget the tokens, but not the hash of the last one: the end token stands before every text."""
        self.owner, self.place, self.keys, self.known, self.n = [], [], [], [], 0
        self.words.forget()

    def add(self, owner: np.ndarray, block: list[bytes]) -> None:
        numbers = self.words.of(block)
        now = self.words.hashes[numbers]
        self.keys.append(bigrams(np.concatenate([self.last, now[:-1]]), now))
        self.owner.append(owner.astype(np.int32))
        self.place.append((numbers + sum(map(len, self.known))).astype(np.int32))
        self.last, self.n = now[-1:], self.n + len(now)
        if self.words.full():
            self.known.append(self.words.hashes)
            self.words.forget()

    def look_up(self, parts: Iterable[Round], shift: int) -> tuple[np.ndarray, np.ndarray]:
        """The count of each place, and the level of each token's bigram. Every bigram is probed once, in the order of the pieces."""
        hashes = np.concatenate([*self.known, self.words.hashes])
        keys, self.keys = np.concatenate(self.keys), []
        order = np.argsort(keys)
        keys = keys[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        keys = keys[new]
        counts, found = np.zeros(len(hashes), np.int64), np.zeros(len(keys), np.uint8)
        for part in parts:
            counts += part.count(hashes)
            low, high = (min(x << shift, 1 << 64) for x in (part.first, part.first + len(part.start) - 1))
            a, b = (int(np.searchsorted(keys, np.uint64(x))) if x < 1 << 64 else len(keys) for x in (low, high))
            for at in range(a, b, BLOCK):
                here = slice(at, min(at + BLOCK, b))
                found[here] = part.level(keys[here], shift)
            del part  # before the next one is read
        level = np.empty(len(order), np.uint8)
        level[order] = np.repeat(found, np.diff(np.flatnonzero(np.concatenate([new, [True]]))))
        return counts, level


def _scoring(shared: list[Broadcast], model: Model) -> Callable:
    """Scores of batches of texts by the rounds of the model."""
    seed, shift, texts, value = model.seed, model.filter_shift, model.texts, model.value
    tokens, distinct = model.tokens, model.distinct

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, rows = Tokens(seed), [], 0
        sums, before = np.zeros((4, 0)), np.array([texts])

        def add_up() -> None:
            """Add the tokens at hand to the sums of their rows."""
            nonlocal sums, before
            counts, levels = held.look_up(_parts(shared), shift)
            sums = np.concatenate([sums, np.zeros((4, rows - sums.shape[1]))], axis=1)
            owners, places = np.concatenate(held.owner), np.concatenate(held.place)
            held.clear()
            for at in range(0, len(owners), BLOCK):
                n, level, owner = counts[places[at:at + BLOCK]], levels[at:at + BLOCK], owners[at:at + BLOCK]
                history = np.concatenate([before, n[:-1]])
                before = n[-1:]
                base = (n + 0.5) / (tokens + 0.5 * (distinct + 1))
                pair = np.minimum(value[level], np.minimum(n, history))
                smooth = (pair + MU * base) / (history + MU)
                low = int(owner[0])
                for row, weights in enumerate((None, n > 0, np.log10(base), np.log10(smooth))):
                    part = np.bincount(owner - low, weights)
                    sums[row, low:low + len(part)] += part

        def given_out(done: int) -> pa.RecordBatch:
            """The first rows, which have no more tokens."""
            nonlocal ids, rows, sums
            known, left = sums[:, :done], pa.concat_arrays(ids)
            ids, rows, sums = [left.slice(done)], rows - done, sums[:, done:]
            return pa.record_batch({"doc_id": left.slice(0, done), "n_tokens": known[0].astype(np.int64),
                                    "n_known": known[1].astype(np.int64), "base_score": known[2], "score": known[3]})
        for batch in slices(batches):
            first, rows = rows, rows + batch.num_rows
            ids.append(batch.column("doc_id"))
            for owner, block in token_blocks(texts_of(batch)):
                held.add(owner + first, block)
                if held.n >= LOOKED_UP:
                    add_up()
                    done = int(owner[-1]) + first  # the last one may go on
                    yield given_out(done)
                    first -= done
        if held.n:
            add_up()
        if rows:
            yield given_out(rows)
    return run


def trains(doc_id: Column) -> Column:
    """The crc32 of the id as decimal text, modulo 5, is not 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 1


def learned_and_scored(documents: DataFrame) -> DataFrame:
    """Scores of all rows by a model of those that train."""
    model = fit(documents.where(trains(F.col("doc_id"))).select("text"))
    scored = scores(documents, model)
    discard(model.words)
    discard(model.filter)
    return scored.select(
        "doc_id", (~trains(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
