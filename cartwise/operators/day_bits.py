"""Active days as bitmaps (A4, A5, P10).

A pair's days before the as-of day are bits of 64-bit words: bit ``(age - 1) % 64`` of word
``(age - 1) div 64``. A word is one ``bit_or`` in a map-side combined aggregate, whatever
the number of events, and merges with other words of the pair by ``bit_or`` again, so a new
day is added without reading old events. Active days of a window are the bits under a
mask; the last active day is the lowest bit and the first the highest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64


def words_for(days: int) -> int:
    return -(-days // WORD)


def _bit(age: Column, word: int) -> Column:
    at = age - 1 - WORD * word
    return F.when(at.between(0, WORD - 1), F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int")))


def day_words(rows: DataFrame, keys: list[str], days: int, age: str = "age", out: str = "days",
              when: Column | None = None) -> DataFrame:
    """``keys`` and ``out``: an array of words with the days (ages 1 to ``days``) on which a
    row, or a row that meets ``when``, lies."""
    bits = [_bit(F.col(age).cast("bigint"), w) for w in range(words_for(days))]
    bits = [F.when(when, b) if when is not None else b for b in bits]
    return rows.groupBy(*keys).agg(F.array(*[F.coalesce(F.bit_or(b), F.lit(0).cast("bigint")) for b in bits]).alias(out))


def merged(words: DataFrame, keys: list[str], days: int, out: str = "days") -> DataFrame:
    """Words of the same keys put together (e.g. of days loaded at different times)."""
    return words.groupBy(*keys).agg(F.array(*[F.bit_or(F.col(out)[w]) for w in range(words_for(days))]).alias(out))


def shifted(words: Column, by: int, days: int) -> Column:
    """The words as seen ``by`` days later; days older than the words hold fall out."""
    whole, rest = divmod(by, WORD)
    n = words_for(days)
    zero = F.lit(0).cast("bigint")
    at = lambda i: words[i] if 0 <= i < n else zero
    low = lambda i: F.shiftrightunsigned(at(i), WORD - rest) if rest else zero
    high = lambda i: F.shiftleft(at(i), rest) if rest else at(i)
    return F.array(*[high(w - whole).bitwiseOR(low(w - whole - 1)) for w in range(n)])


def active_in(words: Column, window: int) -> Column:
    """Distinct active days with age at most ``window``."""
    out = F.lit(0).cast("bigint")
    for w in range(words_for(window)):
        left = window - WORD * w
        mask = -1 if left >= WORD else (1 << left) - 1
        out = out + F.bit_count(words[w].bitwiseAND(F.lit(mask).cast("bigint")))
    return out.cast("bigint")


def last_age(words: Column, days: int) -> Column:
    """Age of the latest active day: the lowest bit; null where there is none."""
    # the zeros below the lowest bit are the ones of ~x & (x - 1); (x ^ -1) is ~x, and no step can overflow
    # but x - 1 at the smallest value, whose lowest bit is the highest
    least = F.lit(-(1 << 63)).cast("bigint")
    lowest = lambda x: F.when(x == least, WORD - 1).otherwise(
        F.bit_count(F.bitwise_not(x).bitwiseAND(x - 1)))
    return F.coalesce(*[F.when(words[w] != 0, lowest(words[w]) + 1 + WORD * w) for w in range(words_for(days))]).cast("bigint")


def first_age(words: Column, days: int) -> Column:
    """Age of the earliest active day: the highest bit; null where there is none."""
    # a word as binary digits without leading zeros is as long as its highest bit says
    highest = lambda x: F.length(F.bin(x))
    return F.coalesce(*[F.when(words[w] != 0, highest(words[w]) + WORD * w)
                        for w in reversed(range(words_for(days)))]).cast("bigint")
