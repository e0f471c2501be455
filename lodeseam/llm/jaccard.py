"""N-gram Jaccard join by PartEnum signatures, and the groups that its links form.

A document's set holds its distinct word shingles. Sets of sizes a <= b with Jaccard similarity of at
least 3/4 differ in at most (a + b) / 7 elements. Sizes fall into bands [l, 4 l / 3]; instance i of
the scheme serves pairs whose larger set is in band i, so a set takes part in the instances of its
own band and of the next. An instance with up to k differences deals the shingles into first-level
parts, so many that some part has at most ``spare`` differences; each part is dealt into
``pieces``, and every choice of pieces - spare of them is a signature. Similar sets share one.

Two unlike sets can agree on a signature that is empty or holds only shingles of some widespread
passage. Such signatures are weak and left out, as are parts that have one. A set with fewer weak parts
than it must share with a similar set still shares one that is not weak. Every other set also
emits single shingles: the first quarter of its shingles and one more, rare ones first, of which two
similar sets must share one. So no pair is lost, whatever shingles are held to be common.

A signature shared by more than MANY sets is not followed up. Two similar sets that share no rarer signature both
have such a one, so among all those sets the shingles are counted, and each set emits the rarest of its shingles
by that count, again the first quarter and one more. A passage that many sets hold is then the last that any of them emits.

Equal sets are one class from the start. A class has a sketch: for each remainder of a hash, whether an odd number of its shingles
has it. Where two sketches differ, a shingle is in one set only, so pairs whose sketches differ in more places than
similar sets may are dropped before any shingles move. Classes that share a signature are compared exactly, first
each with the smallest class that it shares one with, then with the smallest of each signature, then with one class of another group
per signature in some turns, then those of different groups; so a group of near copies is joined by a star and not by all its pairs.

Classes and shingles are told apart by 64-bit hashes.

Defined cases: a text with fewer words than a shingle is one shingle; null texts and texts
without words have an empty set and are linked with nothing; repeated rows are linked; a
null id is never a component's name unless all its ids are null; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodeseam.llm.common import SMALL_ROWS, WordCodes, components, discard, sized, stored

WORDS = 5
BLOCK = 400
#: Up to this set size parts are cut in three pieces with one difference to spare; beyond it they
#: are whole, which makes fewer signatures.
FINE_SIZE = 250
#: A signature of more sets is not followed up; turns in which its sets are paired with one other each before all are.
MANY, TURNS = 16, 4
#: Shingles are counted in runs of about so many; signatures move in runs of so many, to ranges of so many shingles' signatures.
COUNTED, RUN, RANGE = 3_000_000, 750_000, 1_000_000
#: Shingles of more than one in so many documents are common; so many of them are kept at most.
COMMON, MAX_COMMON = 1000, 500_000
#: Remainders of the smallest sketch, and of those by which the sets of a crowded signature are joined.
FOLD = 512
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None], codes: WordCodes, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each whole text. Only A-Z are lower-cased; words end at
    space and tab to carriage return, as bytes.split has it."""
    split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    length = np.array([len(w) for w in split], np.int64)
    code = codes.of([w for ws in split for w in ws]).astype(np.uint64)
    n = max(0, len(code) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(words):
        rolled = rolled * np.uint64(0x100000001B3) + code[j:j + n]
    rolled = _mix(rolled)
    sets, at = [], 0
    for k in length.tolist():
        if k >= words:
            sets.append(np.unique(rolled[at:at + k - words + 1]))
        elif k:
            whole = np.uint64(k)
            for c in code[at:at + k]:
                whole = _mix(np.array([whole ^ c]))[0]
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += k
    return sets


def fingerprint(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def sketch(shingles: np.ndarray) -> bytes:
    """For each of 2^k remainders, at least FOLD and two for a shingle, whether an odd number of shingles has it."""
    buckets = max(FOLD, 1 << (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def apart_at_least(x: bytes, y: bytes) -> int:
    """By the sketches of two sets, a number of shingles that only one of them has; there may be more.

    The larger sketch is folded to the size of the other: a remainder modulo 2^(k-1) joins two modulo 2^k.
    """
    x, y = sorted((x, y), key=len)
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    bits = 8 * len(y)
    while bits > 8 * len(x):
        bits //= 2
        b = b >> bits ^ b & (1 << bits) - 1
    return (a ^ b).bit_count()


def bands(largest: int) -> np.ndarray:
    """The upper sizes of the bands, from 1, until one covers ``largest`` and one lies above."""
    upper = [1]
    while len(upper) < 2 or upper[-2] < largest:
        upper.append((upper[-1] + 1) * 4 // 3)
    return np.array(upper, np.int64)


def signatures(sets: list[np.ndarray],
               common: np.ndarray = np.zeros(0, np.uint64)) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of non-empty sets; the second is the set's place in the list."""
    size = np.array([len(s) for s in sets], np.int64)
    used = np.flatnonzero(size)
    if not len(used):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    upper = bands(int(size.max()))
    band = np.searchsorted(upper, size)
    out = []
    for up in (0, 1):
        instance = band + up
        fine = upper[np.minimum(instance, len(upper) - 1)] <= FINE_SIZE
        for pieces, spare, part in ((3, 1, used[fine[used]]), (1, 0, used[~fine[used]])):
            if len(part):
                out.append(_instance([sets[i] for i in part], part, size[part], instance[part],
                                     upper[instance[part]], upper[band[part]], pieces, spare, bool(up), common))
    return tuple(np.concatenate(c) for c in zip(*out))


def _instance(sets, owner, size, instance, largest, own_largest, pieces, spare, up, common):
    """Signatures of sets in one kind of instance, all sets at once."""
    most = 2 * largest // 7  # differences of any pair of the instance
    parts = most // (spare + 1) + 1 + (most // (spare + 1) + 9) * (2 if spare else 1) // 10
    # differences of a pair with this set: its partner is no larger than 4/3 of it, nor than its band here
    partner = size * 4 // 3 if up else np.minimum(own_largest, size * 4 // 3)
    shared = parts - (size + partner) // 7 // (spare + 1)  # parts with at most ``spare`` differences
    base = np.cumsum(parts) - parts
    element = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), size)
    dealt = _mix(element + np.uint64(77))
    first = ((dealt >> np.uint64(32)) * parts[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    piece = ((dealt & np.uint64(0xFFFFFFFF)) * np.uint64(pieces) >> np.uint64(32)).astype(np.int64)
    slot = (base[of] + first) * pieces + piece
    total = int(parts.sum())
    sums = np.zeros(total * pieces, np.uint64)
    np.add.at(sums, slot, _mix(element + np.uint64(991)))
    sums = sums.reshape(total, pieces)
    rare = ~np.isin(element, common)
    held = np.bincount(slot[rare], minlength=total * pieces).reshape(total, pieces)
    if spare:  # every choice of pieces
        chosen = np.array([np.isin(range(pieces), c) for c in combinations(range(pieces), pieces - spare)]).T
        sums, held = sums @ chosen.astype(np.uint64), held @ chosen.astype(np.int64)
    part_of = np.repeat(np.arange(len(sets)), parts)
    number = np.arange(total) - base[part_of]
    weak = (held == 0).any(axis=1)
    n_weak = np.bincount(part_of, weak, len(sets)).astype(np.int64)

    def nth(flags: np.ndarray) -> np.ndarray:
        """How many flags are set among a set's parts up to each part."""
        return np.cumsum(flags) - np.repeat(np.concatenate(([0], np.cumsum(flags)))[base], parts)
    all_weak = n_weak >= shared
    emit = held > 0
    if up:  # the larger set emits all that are not weak, so this one may leave out more of them
        enough = ~weak & (nth(~weak) <= (parts - shared + 1)[part_of])
        emit &= (enough | all_weak[part_of])[:, None]
    row, choice = np.nonzero(emit)
    salt = _mix((instance[part_of[row]].astype(np.uint64) << np.uint64(40)) + (number[row].astype(np.uint64) << np.uint64(8))
                + choice.astype(np.uint64) + np.uint64(5))
    singles = [(_prefix(sets[i], common), owner[i]) for i in np.flatnonzero(all_weak)]
    return (np.concatenate([_mix(sums[row, choice] ^ salt), *(x for x, _ in singles)]),
            np.concatenate([owner[part_of[row]], *(np.full(len(x), i) for x, i in singles)]))


def _prefix(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Signatures of the single shingles that come first; a similar set holds at least 3/4 of them all."""
    n = len(shingles) - -(-3 * len(shingles) // 4) + 1
    order = np.lexsort((shingles, np.isin(shingles, common)))
    return _mix(shingles[order[:n]] ^ np.uint64(0xA5A5A5A5))


def _map(df: DataFrame, per_task, schema: str, columns: list[str]) -> DataFrame:
    """Blocks of the columns' values through the generator function that ``per_task`` makes; last, None."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = per_task()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                yield from work(*(part.column(part.schema.get_field_index(c)) for c in columns))
        yield from work(*[None] * len(columns))
    return df.select(*columns).mapInArrow(run, schema)


def fingerprints(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_id, sketch, shingle, held): a row per document, then rows of common shingles.

    set_id and sketch are null for empty sets and equal for equal ones. The rows with a shingle say in how many
    sets of one run it occurs, if in several.
    """
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def per_task():
        codes, run = WordCodes(), {}

        def counted():
            shingle, held = np.unique(np.concatenate(list(run.values())), return_counts=True)
            often = held >= max(3, len(run) // (2 * COMMON))
            n = int(often.sum())
            run.clear()
            return [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(shingle[often].view(np.int64)),
                    pa.array(held[often])]

        def work(ids, texts, hashes):
            names = ["doc_id", "text_hash", "n_shingles", "set_id", "sketch", "shingle", "held"]
            if ids is not None:
                sets = shingle_sets(texts.to_pylist(), codes, words)
                set_ids = [fingerprint(s) if len(s) else None for s in sets]
                run.update((i, s) for i, s in zip(set_ids, sets) if i is not None)
                none = pa.nulls(len(sets), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, hashes, pa.array([len(s) for s in sets], pa.int64()),
                                                  pa.array(set_ids, pa.int64()), pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                                                  none, none], names)
            if run and (ids is None or sum(map(len, run.values())) >= COUNTED):
                columns = counted()
                yield pa.RecordBatch.from_arrays([pa.nulls(len(columns[0]), id_arrow), columns[0], *columns], names)
        return work
    id_arrow = to_arrow_type(documents.schema["doc_id"].dataType)
    return _map(documents.withColumn("text_hash", F.xxhash64("text")), per_task,
                f"doc_id {id_type}, text_hash long, n_shingles long, set_id long, sketch binary, shingle long, held long",
                ["doc_id", "text", "text_hash"])


def common_shingles(rows: DataFrame) -> np.ndarray:
    """The shingles of more than one in COMMON sets, as far as the runs have seen it, sorted.

    They only decide which signatures are weak, so results do not depend on them.
    """
    n = rows.where("n_shingles > 0").count()
    held = rows.where("shingle is not null").groupBy("shingle").agg(F.sum("held").alias("held"))
    top = held.where(F.col("held") * COMMON >= n).orderBy(F.desc("held"), "shingle").limit(MAX_COMMON)
    return np.sort(top.select("shingle").toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


def members(documents: DataFrame, common: np.ndarray, shingles: int, words: int = WORDS) -> DataFrame:
    """(set_ids, many): the different sets of each signature that 2 to MANY sets share; in ``many`` rows the sets of all other signatures.

    Signatures move as sorted arrays, one per hash range and run, with the sets of the range by number: a range keeps 32 bits of
    each signature, which now and then brings unlike sets together, to be told apart by the exact check. ``shingles``, the
    number in all documents, decides how many ranges there are, so a range stays of one size.
    """
    shared_common = documents.sparkSession.sparkContext.broadcast(common)
    top = max(0, (max(shingles, 1) - 1) // RANGE).bit_length()

    def per_task():
        codes, seen, runs = WordCodes(), set(), []

        def blobs():
            signature, of, ids = (np.concatenate(x) for x in zip(*runs))
            runs.clear()
            order = np.argsort(signature)
            signature, owner = signature[order], of[order]
            part = (signature >> np.uint64(64 - top)).astype(np.int64) if top else np.zeros(len(signature), np.int64)
            key = (signature << np.uint64(top)) >> np.uint64(32)
            edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            rows = []
            for x, y in zip(edge, edge[1:]):
                held, number = np.unique(owner[x:y], return_inverse=True)
                rows.append((int(part[x]), key[x:y].astype(np.uint32).tobytes(), number.astype(np.uint32 if len(held) >> 16 else np.uint16).tobytes(),
                             ids[held].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary() if i else pa.int64()) for i in range(4)],
                                              ["part", "keys", "numbers", "sets"])

        def work(texts):
            sets = {}
            for s in shingle_sets([] if texts is None else texts.to_pylist(), codes, words):
                if len(s) and (i := fingerprint(s)) not in seen:
                    seen.add(i)
                    sets[i] = s
            if sets:
                signature, of = signatures(list(sets.values()), shared_common.value)
                runs.append((signature, of + sum(len(r[2]) for r in runs), np.fromiter(sets, np.int64, len(sets))))
            if runs and (texts is None or sum(len(r[0]) for r in runs) >= RUN):
                yield blobs()
        return work

    def shared(rows: pa.Table) -> pa.Table:
        """The sets of each signature of a range."""
        keys, ids = [], []
        for key, number, held in zip(*(rows.column(c).to_pylist() for c in ("keys", "numbers", "sets"))):
            key, held = np.frombuffer(key, np.uint32), np.frombuffer(held, np.int64)
            keys.append(key)
            ids.append(held[np.frombuffer(number, np.uint16 if len(number) == 2 * len(key) else np.uint32)])
        key, ids = np.concatenate(keys), np.concatenate(ids)
        order = np.lexsort((ids, key))
        key, ids = key[order], ids[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])))  # equal sets of several tasks count once
        key, ids = key[new], ids[new]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(start, len(key)))
        few, crowd = np.repeat((count > 1) & (count <= MANY), count), np.unique(ids[np.repeat(count > MANY, count)])
        size = np.append(count[(count > 1) & (count <= MANY)], len(crowd))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), pa.array(np.concatenate([ids[few], crowd])))
        return pa.table([lists, pa.array(np.arange(len(size)) == len(size) - 1)], ["set_ids", "many"])
    found = _map(documents, per_task, "part long, keys binary, numbers binary, sets binary", ["text"])
    return found.groupBy("part").applyInArrow(shared, "set_ids array<long>, many boolean")


class Sets:
    """The shingle sets of set ids, made again from the text of the smallest doc_id that has the set."""

    def __init__(self, documents: DataFrame, filled: DataFrame, words: int):
        self.documents, self.words = documents, words
        self.classes = stored(filled.groupBy("set_id").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))
        # rows repeated with their id, and sets that only rows without id have, take a longer way
        self.repeated = not filled.groupBy("doc_id", "set_id").count().where("count > 1").isEmpty()
        self.nameless = not self.classes.where("doc_id is null").isEmpty()

    def texts(self, set_ids: DataFrame) -> DataFrame:
        """(set_id, text) of a document with each set; other texts of the same id may come along."""
        named = sized(set_ids.join(self.classes.select("set_id", "doc_id"), "set_id"))
        texts = self.documents.join(named, "doc_id").select("set_id", "text")
        if self.nameless:
            texts = texts.union(self.documents.where("doc_id is null").select(F.lit(None).cast("long"), "text"))
        return texts

    def rarest(self, set_ids: DataFrame) -> DataFrame:
        """(signature, set_id, n, at, before): of each set the shingles of which a similar one among these sets shares one.

        Of n shingles, ordered by the number of these sets that have them, that is the first n - ceil(3 n / 4) + 1. Shingles that a
        single set has come first and need no row. ``at`` is the number of shingles before; ``before`` the next smaller set of the
        signature, if its size and place allow a similarity of 3/4.
        """
        words, set_ids = self.words, stored(set_ids)

        def per_task():
            codes = WordCodes()

            def work(ids, texts):
                if ids is not None:
                    sets = shingle_sets(texts.to_pylist(), codes, words)
                    own = [fingerprint(s) if len(s) else None for s in sets]
                    right = [k for k, (o, i) in enumerate(zip(own, ids.to_pylist())) if o is not None and i in (None, o)]
                    size = [len(sets[k]) for k in right]
                    if right:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(np.array([own[k] for k in right], np.int64), size)),
                             pa.array(np.concatenate([sets[k] for k in right]).view(np.int64))], ["set_id", "shingle"])
            return work
        rows = _map(self.texts(set_ids), per_task, "set_id long, shingle long", ["set_id", "text"])
        if self.nameless:
            rows = rows.join(set_ids, "set_id", "left_semi")
        if self.repeated or self.nameless:
            rows = rows.distinct()
        often = rows.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).where("held > 1")
        by_count = often.groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("held", "shingle"))).alias("s"))
        n = F.col("n")
        room = n - F.ceil(3 * n / 4) + 1 - (n - F.size("s"))  # less the shingles that only this set has
        kept = (by_count.join(self.classes.select("set_id", "n"), "set_id").where(room > 0)
                .select("set_id", "n", (n - F.size("s")).alias("own"), F.posexplode(F.slice("s", F.lit(1), room.cast("int"))).alias("place", "x")))
        kept = kept.select("set_id", F.col("x.shingle").alias("signature"), "n", (F.col("own") + F.col("place")).alias("at"))
        by_size = Window.partitionBy("signature").orderBy("n", "set_id")
        near = F.lag(F.struct("set_id", "n", "at")).over(by_size)
        together = _reach(F.col("n"), F.col("at"), F.col("near.n"), F.col("near.at"))
        return kept.withColumn("near", near).select("signature", "set_id", "n", "at", F.when(together, F.col("near.set_id")).alias("before"))

    def of(self, set_ids: DataFrame) -> DataFrame:
        """(set_id, shingles), one row per set."""
        words, set_ids = self.words, stored(set_ids.distinct())

        def per_task():
            codes = WordCodes()

            def work(ids, texts):
                if ids is not None:
                    sets = shingle_sets(texts.to_pylist(), codes, words)
                    own = [fingerprint(s) if len(s) else None for s in sets]
                    right = pa.array([o is not None and i in (None, o) for o, i in zip(own, ids.to_pylist())], pa.bool_())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64()).filter(right),
                         pa.array([s.tobytes() for s in sets], pa.binary()).filter(right)], ["set_id", "shingles"])
            return work
        sets = _map(self.texts(set_ids), per_task, "set_id long, shingles binary", ["set_id", "text"])
        if self.nameless:
            sets = sets.join(set_ids, "set_id", "left_semi")
        return stored(sets.dropDuplicates(["set_id"]) if self.repeated or self.nameless else sets)

    def folded(self, set_ids: DataFrame) -> DataFrame:
        """(set_id, odd): the sketch folded to FOLD remainders, in numbers of 64 bits."""
        def per_task():
            def work(ids, sketches):
                if ids is not None:
                    odd = [np.bitwise_xor.reduce(np.frombuffer(x, np.int64).reshape(-1, FOLD // 64), axis=0) for x in sketches.to_pylist()]
                    yield pa.RecordBatch.from_arrays([ids, pa.array(odd, pa.list_(pa.int64()))], ["set_id", "odd"])
            return work
        return stored(_map(self.classes.join(sized(set_ids), "set_id"), per_task, "set_id long, odd array<long>", ["set_id", "sketch"]))

    def near(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) of distinct, stored pairs of set ids whose sizes and sketches allow a similarity of 3/4.

        Sets of n and m shingles have it if no more than (n + m) / 7 shingles are in one of them only.
        """
        ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        known = stored(self.classes.join(sized(ids), "set_id").select("set_id", "n", "sketch"))

        def per_task():
            def work(a, b, n, m, left, right):
                if a is None:
                    return
                keep = pa.array([7 * apart_at_least(x, y) <= i + j for x, y, i, j in zip(
                    left.to_pylist(), right.to_pylist(), n.to_pylist(), m.to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])
            return work
        both = (pairs.join(known.withColumnsRenamed({"set_id": "a", "sketch": "left"}), "a")
                .join(known.withColumnsRenamed({"set_id": "b", "n": "m", "sketch": "right"}), "b")
                .where("3 * n <= 4 * m and 3 * m <= 4 * n"))
        found = stored(_map(both, per_task, "a long, b long", ["a", "b", "n", "m", "left", "right"]))
        discard(known)
        return found

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) of pairs of set ids whose sets have a Jaccard similarity of at least 3/4."""
        sets = self.of(pairs.select(F.explode(F.array("a", "b")).alias("set_id")))

        def per_task():
            def work(a, b, left, right):
                if a is None:
                    return
                keep = []
                for x, y in zip(left, right):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= 75 * (len(x) + len(y) - both))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])
            return work
        both = (pairs.join(sets.withColumnsRenamed({"set_id": "a", "shingles": "left"}), "a")
                .join(sets.withColumnsRenamed({"set_id": "b", "shingles": "right"}), "b"))
        found = stored(_map(both, per_task, "a long, b long", ["a", "b", "left", "right"]))
        discard(sets)
        return found


def _grouped(documents: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n_shingles, set_id) of every row; (set_id, component, component_id) of the groups of several rows.

    ``component`` names one group only; component_id, the smallest doc_id, may be null or name several.
    """
    documents = documents.select("doc_id", "text")
    rows = stored(fingerprints(documents, words))
    base = rows.where("shingle is null").select("doc_id", "text_hash", "n_shingles", "set_id")
    sets = Sets(documents, rows.where("set_id is not null"), words)
    common = common_shingles(rows)
    n_shingles = rows.agg(F.sum("n_shingles").alias("n")).first().n or 0
    found = stored(members(documents, common, n_shingles, words))
    crowded = stored(found.where("many").select(F.explode("set_ids").alias("set_id")).distinct())
    few, crowds = found.where("not many and size(set_ids) > 0").select("set_ids"), None
    if not crowded.isEmpty():
        crowds = stored(sets.rarest(crowded))
    few = stored(few.distinct())  # near copies share many signatures, with the same sets each
    discard(found)
    close = few.select(F.explode(F.slice("set_ids", 2, MANY)).alias("a"), F.col("set_ids")[0].alias("b"))
    if crowds is not None:
        close = close.union(crowds.where("before is not null").select(F.greatest("set_id", "before"), F.least("set_id", "before")))
    sizes = sets.classes.select("set_id", "n")
    tried = stored(close.distinct())
    close = sets.near(tried)

    together = (few.select(F.xxhash64("set_ids").alias("signature"), F.explode("set_ids").alias("set_id"))
                .join(sizes, "set_id").select("signature", "set_id", "n", F.lit(0).alias("at")))
    together = stored(together if crowds is None else together.union(crowds.select("signature", "set_id", "n", "at")))
    first = stored(close.groupBy("a").agg(F.min("b").alias("b")))
    links = sets.linked(first)
    close = stored(close.join(first, ["a", "b"], "left_anti"))
    links = stored(links.union(sets.linked(stored(_apart(close, components(links))))))
    for pairs in (*[(lambda names, turn=turn: _neighbours(together, names, turn)) for turn in range(TURNS)],
                  lambda names: _other_pairs(few, crowds, names, sets)):
        new = stored(pairs(components(links)).join(tried, ["a", "b"], "left_anti"))
        links = stored(links.union(sets.linked(sets.near(new))))
        tried = tried.union(new)

    names = components(links)
    classes = sets.classes
    named = classes.join(names, classes["set_id"] == names["node"], "left").select(
        "set_id", "doc_id", "copies", F.coalesce("component", "set_id").alias("component"))
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("size"))
    # only groups of several rows differ from the row's own id
    several = named.join(lowest.where("size > 1"), "component").select("set_id", "component", "component_id")
    return base, stored(several)


def groups(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id is the smallest linked doc_id."""
    base, several = _grouped(documents, words)
    return (base.join(sized(several.select("set_id", "component_id")), "set_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def spare_rows(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, first) of rows, told by both, that are not all to be kept if each group keeps one row.

    A group's ``first`` has its smallest doc_id, null ids last, and of those the smallest xxhash64 of its text.
    It is listed only if several rows are equal in both; all of the group's other rows are listed.
    """
    base, several = _grouped(documents, words)
    rows = stored(base.join(sized(several), "set_id").groupBy("component", "doc_id", "text_hash")
                  .agg(F.count("*").alias("n")))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    lowest = sized(stored(rows.groupBy("component").agg(F.min(order).alias("low"))))
    first = F.col("doc_id").eqNullSafe(F.col("low.doc_id")) & (F.col("text_hash") == F.col("low.text_hash"))
    return (rows.join(lowest, "component").withColumn("first", first).where("not first or n > 1")
            .select("doc_id", "text_hash", "first"))


def _named(rows: DataFrame, names: DataFrame, column: str, name: str) -> DataFrame:
    names = names.select(F.col("node").alias(column), F.col("component").alias(name))
    return rows.join(names, column, "left").withColumn(name, F.coalesce(name, column))


def _apart(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """The pairs of sets that are in different groups."""
    return _named(_named(pairs, names, "a", "x"), names, "b", "y").where("x <> y").select("a", "b")


def _reach(n: Column, at: Column, m: Column, by: Column) -> Column:
    """Whether sets of n and m shingles can have a similarity of 3/4 if none of the ``at`` and ``by`` before a shared one is shared.

    Of similar sets that holds at the first shingle they share, in the order of the counts.
    """
    return 7 * F.least(n - at, m - by) >= 3 * (n + m)


def _neighbours(together: DataFrame, names: DataFrame, turn: int) -> DataFrame:
    """Of each signature the sets of different groups that are neighbours, in another order on every turn.

    A pair per row, so that a large group which the links so far leave in parts grows together before all pairs of parts are looked at.
    """
    rows = _named(together, names, "set_id", "name")
    order = Window.partitionBy("signature").orderBy(F.xxhash64("set_id", F.lit(turn)))
    near = rows.withColumn("near", F.lag(F.struct("set_id", "name", "n", "at")).over(order))
    return (near.where((F.col("name") != F.col("near.name")) & _reach(F.col("n"), F.col("at"), F.col("near.n"), F.col("near.at")))
            .select(F.greatest("set_id", "near.set_id").alias("a"), F.least("set_id", "near.set_id").alias("b")).distinct())


def _other_pairs(few: DataFrame, crowds: DataFrame | None, names: DataFrame, sets: Sets) -> DataFrame:
    """Sets of one signature that are in different groups; signatures within a group drop out.

    Of a crowded signature's sets only those pairs become rows whose places and folded sketches allow a similarity of 3/4.
    """
    numbered = few.withColumn("bucket", F.xxhash64("set_ids")).select("bucket", F.explode("set_ids").alias("set_id"))
    member = F.struct("set_id", "name")
    buckets = (_named(numbered, names, "set_id", "name").groupBy("bucket")  # at most MANY rows each
               .agg(F.sort_array(F.collect_set(member)).alias("m"), F.min("name").alias("low"), F.max("name").alias("high"))
               .where("low <> high"))
    pairs = F.flatten(F.transform("m", lambda x: F.transform(
        F.filter("m", lambda y: (y["set_id"] < x["set_id"]) & (y["name"] != x["name"])),
        lambda y: F.struct(x["set_id"].alias("a"), y["set_id"].alias("b")))))
    found = buckets.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    if crowds is not None:
        rows = _named(crowds.drop("before"), names, "set_id", "name")
        mixed = rows.groupBy("signature").agg(F.min("name").alias("low"), F.max("name").alias("high")).where("low <> high")
        rows = stored(rows.join(mixed.select("signature"), "signature", "left_semi"))
        odd = sets.folded(rows.select("set_id").distinct())
        rows = rows.join(sized(odd, SMALL_ROWS // 10), "set_id")
        left, right = (rows.select(*[F.col(old).alias(f"{side}_{old}") for old in ("signature", "set_id", "name", "n", "at", "odd")])
                       for side in ("a", "b"))
        apart = (F.col("a_set_id") > F.col("b_set_id")) & (F.col("a_name") != F.col("b_name"))
        reach = _reach(*[F.col(c) for c in ("a_n", "a_at", "b_n", "b_at")])
        differ = sum(F.bit_count(F.col("a_odd")[i].bitwiseXOR(F.col("b_odd")[i])) for i in range(FOLD // 64))
        alike = 7 * differ <= F.col("a_n") + F.col("b_n")
        found = found.union(left.join(right, (F.col("a_signature") == F.col("b_signature")) & apart & reach & alike)
                            .select(F.col("a_set_id").alias("a"), F.col("b_set_id").alias("b")))
    return found.distinct()
