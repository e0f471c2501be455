"""Token ids in binary files: canonical length-limited Huffman coding, decoded in independent blocks.

File format. A folder holds two tables. ``code`` has one row: the end id and, for each id, the number
of bits of its code word (one byte each, 0 for ids that do not occur); the words are the
canonical ones: ascending by (bits, id), each the predecessor plus one, shifted left where the number
of bits grows. ``shards`` has rows of about SHARD ids, in ascending order of documents over (part,
start): the ids' bits, most significant first; the bit offset of every BLOCK-th id; the documents'
ids and numbers of ids; ``start``, the number of ids before it in its part. Any block can be decoded from its
offset alone, by a table of all MAX_BITS-bit prefixes.

Defined cases: a null or empty text is the end id alone; documents with a null id come first; equal
ids are ordered by their tokens; repeated rows are all written; a text of any length is written
whole; extra columns play no part; an empty table makes an empty file.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer, pre_tokenizers

from lodeseam.llm.common import dropping_shuffles, stored
from lodeseam.llm.lexicon import byte_alphabet
from lodeseam.session import shared_dir

MAX_BITS, BLOCK, SHARD = 18, 1024, 1 << 19
END = 0
#: Texts that are put together at once, bytes of text whose pieces are found at once, words that the library merges at once.
BATCH, LONGEST, LINES = 500, 16 << 20, 50_000
#: The place before a space between two characters that are no white space, so that a piece is a word with its space.
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: A piece with white space at an end, apart from one space before it, where no cut may be.
_ODD = re.compile(r"(?! ?\S(?:.*\S)?\Z)", re.S).match
#: Letters that every version of Unicode has as such, and marks.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-/:-@\[-`{-~"
#: The tokenizer always cuts behind such letters, before such marks, and a run of either is cut at apostrophes only.
_WORD = rf"^(?P<word> ?[{_LETTERS}]+)(?P<marks>[{_MARKS}]*)$"
_RUN = rf"^(?: ?[{_LETTERS}]+|[{_MARKS.replace('!-/', '!-&(-/')}]+)$"


@lru_cache(1)
def _tokenizer(file: str) -> Tokenizer:
    """Read once per worker, not once per task."""
    return Tokenizer.from_str(file)


@lru_cache(1)
def _merger(file: str) -> tuple[Tokenizer, np.ndarray]:
    """The library's merges alone, of lines in the byte alphabet, and the number of bytes of each id."""
    tokenizer = _tokenizer(file)
    merger = Tokenizer(tokenizer.model)
    merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    size = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        size[i] = len(token)
    return merger, size


#: The byte alphabet's code point of each byte; the newline between lines stays.
_SHOWN = np.array([ord(c) if i != ord("\n") else i for i, c in enumerate(byte_alphabet())], "<u4")


def _gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` that begin at ``start``, one behind the other."""
    after = np.cumsum(size)
    return pool[np.repeat(start - after + size, size) + np.arange(after[-1] if len(after) else 0)]


class Pieces:
    """The tokenizer's ids of whole texts, put together from those of space-separated pieces.

    The tokenizer always cuts before a space that has white space on neither side, as such a space begins the next word, and on both sides of
    a newline that is no part of longer white space. So a text has the ids of the pieces between these cuts, each with the space before it.
    Distinct pieces of a block of texts are found by Arrow. Those that are letters and marks behind them are cut in between, and the
    distinct runs go to the library's merges, many in one call; any other piece goes to the whole tokenizer.
    """

    def __init__(self, file: str, width: str = "<u4"):
        self.tokenizer, (self.merger, self.bytes_of) = _tokenizer(file), _merger(file)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = np.dtype(width)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids and end id of each text, as little-endian integers."""
        return [ids for rows in self.encode_array(pa.array(texts, pa.string())) for ids in rows.to_pylist()]

    def encode_array(self, texts: pa.Array) -> Iterator[pa.Array]:
        """The same for an array, BATCH texts after the other."""
        texts = texts.cast(pa.large_string()).fill_null("")
        lists = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, "\n", "\0\n\0"), " ", "\0 "), "\0")
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        pieces = lists.flatten().dictionary_encode()
        del lists
        at, (pool, start, size, odd) = pieces.indices.to_numpy(), self._ids(pieces.dictionary, strict=True)
        slow = pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False)
        if odd.any():
            slow = slow | (np.add.reduceat(odd[at], first[:-1], dtype=np.int64) > 0)
        slow = np.flatnonzero(slow)
        cut, cut_first = self._cut_where_alone(texts.take(pa.array(slow)))
        cut_at, (cut_pool, cut_start, cut_size, _) = cut.indices.to_numpy(), self._ids(cut.dictionary, strict=False)
        for low in range(0, len(texts), BATCH):
            high = min(low + BATCH, len(texts))
            rows = self._joined(pool, start, size, at, first[low:high + 1])
            a, b = np.searchsorted(slow, [low, high])
            if a < b:
                place = np.arange(len(rows))
                place[slow[a:b] - low] = len(rows) + np.arange(b - a)
                rows = pa.concat_arrays([rows, self._joined(cut_pool, cut_start, cut_size, cut_at, cut_first[a:b + 1])])
                rows = rows.take(pa.array(place))
            yield rows

    @staticmethod
    def _cut_where_alone(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The pieces of texts that have other white space, or nothing, cut only where a space is alone, and where those of a text begin."""
        pieces, count = [pa.array([], pa.large_string())], [0]
        for low in range(0, len(texts), BATCH):
            split = [_CUT.split(t) if t else [] for t in texts.slice(low, BATCH).to_pylist()]
            pieces.append(pa.array(chain.from_iterable(split), pa.large_string()))
            count += map(len, split)
        return pa.concat_arrays(pieces).dictionary_encode(), np.cumsum(count)

    def _joined(self, pool: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray, first: np.ndarray) -> pa.Array:
        """The ids of each text and the end id; ``at`` tells the pieces, ``first`` where those of a text begin."""
        at = at[first[0]:first[-1]]
        ends = np.concatenate([[0], np.cumsum(size[at])])[first - first[0]]
        ids = np.insert(_gather(pool, start[at], size[at]), ends[1:], END)
        offsets = pa.array((ends + np.arange(len(ends))) * ids.itemsize, pa.int32())
        return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, offsets.buffers()[1], pa.py_buffer(ids)])

    def _ids(self, pieces: pa.Array, strict: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: all of them, where each piece's begin, and how many there are. If ``strict``, pieces that have white space
        at an end, where no cut may be, have none and are told by the last array."""
        cut = pc.extract_regex(pieces, _WORD)
        plain = cut.is_valid().to_numpy(zero_copy_only=False)
        for token in self.added:
            plain = plain & ~pc.match_substring(pieces, token).to_numpy(zero_copy_only=False)
        cut = cut.filter(pa.array(plain, pa.bool_()))
        runs = pa.concat_arrays([cut.field("word"), cut.field("marks")]).dictionary_encode()
        part = runs.indices.to_numpy().reshape(2, -1).T.ravel()  # a word, its marks, the next word
        pool, start, size = self._run_ids(runs.dictionary)
        pool = _gather(pool, start[part], size[part])
        found = np.zeros(len(pieces), np.int64)
        found[plain] = size[part].reshape(-1, 2).sum(1)
        others = pieces.filter(pa.array(~plain, pa.bool_())).to_pylist()
        odd = [strict and p != "\n" and bool(_ODD(p)) for p in others]
        rest, found[~plain] = self._whole(["" if o else p for p, o in zip(others, odd)])
        place = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])  # the order of the pool
        begin = np.zeros(len(pieces), np.int64)
        begin[place] = np.cumsum(found[place]) - found[place]
        is_odd = np.zeros(len(pieces), bool)
        is_odd[~plain] = odd
        return np.concatenate([pool, rest]), begin, found, is_odd

    def _run_ids(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words and of marks: all of them, where each begins, and how many there are."""
        whole = ~pc.match_substring_regex(runs, _RUN).to_numpy(zero_copy_only=False)
        lines = runs.filter(pa.array(~whole, pa.bool_()))
        pool, count = [], []
        for low in range(0, len(lines), LINES):
            some = lines.slice(low, LINES).cast(pa.large_binary())
            text = np.frombuffer(b"\n".join(some.to_numpy(zero_copy_only=False)), np.uint8)
            found = self.merger.encode_batch_fast([_SHOWN[text].tobytes().decode("utf-32-le")], add_special_tokens=False)[0]
            pool.append(np.array(found.ids, self.width))
            ends = np.searchsorted(np.cumsum(self.bytes_of[pool[-1]]), np.cumsum(pc.binary_length(some).to_numpy())) + 1
            count.append(np.diff(ends, prepend=0))
        rest, rest_count = self._whole(runs.filter(pa.array(whole, pa.bool_())).to_pylist())
        size = np.zeros(len(runs), np.int64)
        size[~whole] = np.concatenate([*count, np.zeros(0, np.int64)])
        size[whole] = rest_count
        place = np.concatenate([np.flatnonzero(~whole), np.flatnonzero(whole)])
        start = np.zeros(len(runs), np.int64)
        start[place] = np.cumsum(size[place]) - size[place]
        return np.concatenate([*pool, rest]), start, size

    def _whole(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces by the whole tokenizer, and how many each has."""
        ids = [np.zeros(0, self.width)]
        for low in range(0, len(pieces), BATCH):
            ids += [np.array(x.ids, self.width) for x in self.tokenizer.encode_batch_fast(pieces[low:low + BATCH], add_special_tokens=False)]
        return np.concatenate(ids), np.array([len(x) for x in ids[1:]], np.int64)


def tokens(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): each whole text's ids with the end id, 16 bits each if the vocabulary allows."""
    documents = documents.select("doc_id", "text")
    with open(path, encoding="utf-8") as f:
        file = f.read()
    width = _width(file)
    shared = documents.sparkSession.sparkContext.broadcast(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value, width)
        for batch in batches:
            for part in _slices(batch):
                at = 0
                for ids in pieces.encode_array(part.column("text")):
                    yield pa.record_batch({"doc_id": part.column("doc_id").slice(at, len(ids)), "ids": ids})
                    at += len(ids)
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(run, f"doc_id {id_type}, ids binary")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in runs of at most, but for a single longer one, LONGEST bytes of text."""
    after = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < len(after):
        stop = max(at + 1, int(np.searchsorted(after, (after[at - 1] if at else 0) + LONGEST, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _width(file: str) -> str:
    return "<u2" if Tokenizer.from_str(file).get_vocab_size() <= 1 << 16 else "<u4"


def counts(ids: DataFrame, width: str) -> np.ndarray:
    """How often each id occurs in the corpus; the driver gets a row per id of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = np.bincount(np.frombuffer(b"".join(batch.column("ids").slice(start, BATCH).to_pylist()), width))
                if len(part) > len(total):
                    total = np.pad(total, (0, len(part) - len(total)))
                total[:len(part)] += part
        at = np.flatnonzero(total)
        yield pa.record_batch({"id": at, "n": total[at]})
    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r.id for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def code_lengths(count: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of each id's code word: the least total size with no word over ``max_bits`` (package-merge)."""
    used = np.flatnonzero(count)
    used = used[np.argsort(count[used], kind="stable")]
    bits = np.zeros(len(count), np.uint8)
    if len(used) < 2:
        bits[used] = 1
        return bits
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids do not fit into {max_bits} bits")
    leaf = count[used].astype(np.float64)
    merged, kept = leaf, []
    for _ in range(max_bits - 1):  # pairs of the cheapest, merged with the leaves again
        even = len(merged) // 2 * 2
        both = np.concatenate([leaf, merged[0:even:2] + merged[1:even:2]])
        order = np.argsort(both, kind="stable")
        kept.append(order < len(leaf))
        merged = both[order]
    take, depth = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for is_leaf in reversed(kept):
        leaves = int(is_leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    depth[:take] += 1
    bits[used] = depth
    return bits


def code_words(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The canonical words, and the decoding table: id << 5 | bits of each MAX_BITS-bit prefix."""
    used = np.flatnonzero(bits)
    used = used[np.lexsort((used, bits[used]))]
    span = np.left_shift(np.int64(1), MAX_BITS - bits[used].astype(np.int64))
    start = np.cumsum(span) - span
    words = np.zeros(len(bits), np.uint64)
    words[used] = start >> (MAX_BITS - bits[used].astype(np.int64))
    table = np.zeros(1 << MAX_BITS, np.int64)
    table[:span.sum()] = np.repeat(used << 5 | bits[used], span)
    return words, table


def pack(ids: np.ndarray, bits: np.ndarray, words: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' bits, and the bit offset of every BLOCK-th id."""
    value, size = words[ids], bits[ids].astype(np.int64)
    if len(ids) % 2:
        value, size = np.append(value, np.uint64(0)), np.append(size, 0)
    value = value[::2] << size[1::2].astype(np.uint64) | value[1::2]  # two words are set in at once
    size = size[::2] + size[1::2]
    after = np.cumsum(size)
    at = after - size
    word = at >> 6
    free = 64 - (at & 63) - size
    over = np.flatnonzero(free < 0)  # goes on in the next 64 bits
    rest = value[over] << (64 + free[over]).astype(np.uint64)
    value <<= np.maximum(free, 0).astype(np.uint64)
    value[over] >>= (-free[over]).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros((int(after[-1]) >> 6) + 3, np.uint64)
    out[word[first]] = np.add.reduceat(value, first)
    out[word[over] + 1] += rest
    return out.astype(">u8").tobytes(), at[::BLOCK // 2]


def unpack(payload: bytes, offsets: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    """``n`` ids; each block runs from its own offset, all blocks in step."""
    window = np.ndarray((len(payload) - 7,), ">u8", payload, strides=(1,))
    at = offsets.astype(np.int64)
    found = np.zeros((BLOCK, len(at)), np.uint32)
    for step in range(min(BLOCK, n)):
        if step == n - (len(found[0]) - 1) * BLOCK and len(at) > 1:
            at, bits = at[:-1], bits[:-1]  # the last block is over
        if step % 3 == 0:  # 64 bits hold three words from any bit of the first byte
            bits = window[at >> 3].astype(np.uint64) << (at & 7).astype(np.uint64)
        entry = table[bits >> np.uint64(64 - MAX_BITS)]
        found[step, :len(at)] = entry
        entry &= 31
        at = at + entry
        bits = bits << entry.astype(np.uint64)
    return (found >> np.uint32(5)).T.ravel()[:n]


def in_order(ids: DataFrame, parts: int) -> DataFrame:
    """Ranges of (doc_id, ids). They are told by the first ids only, as the driver gets a sample of what tells them."""
    return ids.repartitionByRange(parts, "doc_id", F.substring("ids", 1, 64)).sortWithinPartitions("doc_id", "ids")


def write(documents: DataFrame, path: str, folder: str) -> None:
    """Encode all documents and write the two tables of the format into ``folder``."""
    spark = documents.sparkSession
    with open(path, encoding="utf-8") as f:
        width = _width(f.read())
    ids = stored(tokens(documents, path))
    bits = code_lengths(counts(ids, width))
    words, _ = code_words(bits)
    id_type = ids.schema["doc_id"].dataType.simpleString()
    spark.createDataFrame([(END, bytes(bits))], "end_id int, bits binary").coalesce(1).write.parquet(f"{folder}/code")

    id_list = to_arrow_type(T.ArrayType(ids.schema["doc_id"].dataType))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, doc_ids, blobs, held = TaskContext.get().partitionId(), 0, [], [], 0

        def shard() -> pa.RecordBatch:
            all_ids = np.frombuffer(b"".join(blobs), width).astype(np.int64)
            payload, offsets = pack(all_ids, bits, words)
            lengths = [len(b) // np.dtype(width).itemsize for b in blobs]
            return pa.record_batch({
                "part": pa.array([part], pa.int32()), "start": pa.array([start], pa.int64()), "n": pa.array([len(all_ids)], pa.int64()),
                "payload": pa.array([payload], pa.binary()), "offsets": pa.array([offsets], pa.list_(pa.int64())),
                "doc_ids": pa.array([doc_ids], id_list), "lengths": pa.array([lengths], pa.list_(pa.int64()))})
        for batch in batches:
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                doc_ids.append(doc_id)
                blobs.append(blob)
                held += len(blob) // np.dtype(width).itemsize
                if held >= SHARD:
                    yield shard()
                    start, doc_ids, blobs, held = start + held, [], [], 0
        if held:
            yield shard()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with dropping_shuffles(spark):
        (in_order(ids, parts).mapInArrow(shards, "part int, start long, n long, payload binary, offsets array<long>, "
                                   f"doc_ids array<{id_type}>, lengths array<long>")
         .write.option("compression", "none").parquet(f"{folder}/shards"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of the files; ``start`` counts the ids of all documents before."""
    return _decoded(spark, folder, "ids array<long>", pa.list_(pa.int64()), lambda ids: ids.astype(np.int64))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files."""
    return _decoded(spark, folder, "ids_crc32 long", pa.int64(), lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def _decoded(spark: SparkSession, folder: str, column: str, kind: pa.DataType, shape) -> DataFrame:
    bits = np.frombuffer(spark.read.parquet(f"{folder}/code").first().bits, np.uint8)
    _, table = code_words(bits)
    shards = spark.read.parquet(f"{folder}/shards")
    id_type = shards.schema["doc_ids"].dataType.elementType
    totals = {r.part: r.n for r in shards.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one per task
    before, base = 0, {}
    for part in sorted(totals):
        base[part] = before
        before += totals[part]
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                ids, lengths = unpack(s["payload"], np.array(s["offsets"]), s["n"], table), np.array(s["lengths"])
                ends = np.cumsum(lengths)
                yield pa.record_batch({
                    "doc_id": pa.array(s["doc_ids"], arrow_id), "start": base[s["part"]] + s["start"] + ends - lengths,
                    "n_tokens": lengths,
                    column.split()[0]: pa.array([shape(ids[e - k:e]) for e, k in zip(ends, lengths)], kind)})
    return shards.mapInArrow(run, f"doc_id {id_type.simpleString()}, start long, n_tokens long, {column}")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
