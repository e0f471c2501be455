"""Boolean vectors packed into 62-bit words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 62


def word_count(n: int) -> int:
    return max(1, -(-n // WORD))


def pack(flags: list[Column]) -> list[Column]:
    """One bigint per 62 flags; a null flag counts as false."""
    words = []
    for start in range(0, max(len(flags), 1), WORD):
        bits = [F.when(f, F.lit(1 << b)).otherwise(F.lit(0)).cast("bigint")
                for b, f in enumerate(flags[start:start + WORD])]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("bigint")))
    return words


def literal(ids: list[int] | tuple[int, ...], words: int) -> list[int]:
    """The word values with exactly the given positions set."""
    out = [0] * words
    for i in ids:
        out[i // WORD] |= 1 << (i % WORD)
    return out


def holds_all(have: list[Column], need: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, (h.bitwiseAND(n) == n for h, n in zip(have, need)))


def positions(words: list[Column], n: int) -> Column:
    """Sorted array of the set positions."""
    def in_word(w: int) -> Column:
        ids = F.array(*[F.lit(i) for i in range(w * WORD, min(n, (w + 1) * WORD))])
        return F.filter(ids, lambda i: F.getbit(words[w], i - w * WORD) == 1)
    return F.concat(*[in_word(w) for w in range(word_count(n))])
