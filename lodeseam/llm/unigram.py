"""Token counts without tokens: Viterbi over a unigram vocabulary, carrying score and count only.

White space U+0020 becomes a mark, and a mark comes before a text that is not empty. An Aho-Corasick automaton
lists the pieces that end at each character. For each end the best score wins; of equal scores the
one whose last piece is longest, as a tokenizer keeps the first it meets when it goes through the
starts in order. A character that no one-character piece covers may be unknown, at the least score
less 10, and then counts one byte token for each byte. No path is kept, so memory is one number
pair per character of a word.

Where no piece holds a mark behind another character, the best path always breaks before a mark, and
with whole-number scores sums are exact; so a text's count is the sum over its words, and each word
is worked out once per task. With any other vocabulary, texts go through whole.

Defined cases: null and empty texts have 0 tokens and score 0; texts of any length are counted
whole; repeated rows count alike; extra columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task keeps at hand.
KEPT = 1_000_000
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a SentencePiece model file; an earlier piece wins over an equal one."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in reversed(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.by_word = (all(MARK not in piece.lstrip(MARK) for piece, _ in pieces)
                        and all(float(score).is_integer() for _, score in pieces))
        self.counts: dict[str, int] = {}
        self.scores: dict[str, float] = {}

    def viterbi(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best path through a marked text."""
        best, count = [0.0] + [float("-inf")] * len(text), [0] * (len(text) + 1)
        matches = self.automaton.iter(text)
        last, found = next(matches, (None, None))
        for end in range(1, len(text) + 1):
            top, pieces, single = float("-inf"), 0, False
            while last == end - 1:  # the longest first
                size, score = found
                single = single or size == 1
                if best[end - size] + score > top:
                    top, pieces = best[end - size] + score, count[end - size] + 1
                last, found = next(matches, (None, None))
            if not single and best[end - 1] + self.unknown > top:
                top = best[end - 1] + self.unknown
                pieces = count[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))
            best[end], count[end] = top, pieces
        return count[-1], best[-1]

    def count(self, text: str | None) -> tuple[int, float]:
        """Tokens and score of a whole text."""
        if not text:
            return 0, 0.0
        if not self.by_word:
            return self.viterbi(MARK + text.replace(" ", MARK))
        if "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
            words = _WORD.findall(MARK + text.replace(" ", MARK))
        else:
            words = [MARK + w for w in text.split(" ")]
        if len(self.counts) > KEPT:
            self.counts.clear()
            self.scores.clear()
        for word in {w for w in words if w not in self.counts}:
            self.counts[word], self.scores[word] = self.viterbi(word)
        return sum(map(self.counts.__getitem__, words)), sum(map(self.scores.__getitem__, words))


def token_counts(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, score) of every whole text."""
    documents = documents.select("doc_id", "text")
    pieces = documents.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces.value)
        for batch in batches:
            found = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_tokens": pa.array([n for n, _ in found], pa.int64()),
                                   "score": pa.array([s for _, s in found], pa.float64())})
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(run, f"doc_id {id_type}, n_tokens long, score double")
