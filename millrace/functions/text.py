"""Column expressions over text: normalisation, tokens, hashes."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

#: Exactly the characters that count as white space (``\\s`` misses NBSP, ``(?U)\\s`` misses U+001C to U+001F).
SPACE = "[\\s\\x1c-\\x1f\\x85\\p{Z}]+"
# Fixed value: what may stand around a word.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~…“”‘’—–"


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE, " "))


@F.pandas_udf(StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def _bare(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)))


def is_ascii(text: Column) -> Column:
    """Whether text is ASCII alone: it has as many bytes as characters. Told without looking for anything, so it is asked before patterns that only other texts can need."""
    return F.octet_length(text) == F.length(text)


def with_normalised(df: DataFrame, column: str, to: str) -> DataFrame:
    """df with ``to``: column in NFC with single spaces. Only texts that hold a character over U+02FF can need
    composing; only those are sent to Python, in the same scan (the others go as nulls)."""
    needs = F.coalesce(F.col(column).rlike("[^\\x{0}-\\x{2FF}]"), F.lit(False))
    return df.withColumn(to, collapse(F.coalesce(_nfc(F.when(needs, F.col(column))), F.col(column))))


def tokens(text: Column) -> Column:
    """Words of normalised text (none of the empty text)."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def core(token: Column) -> Column:
    return F.btrim(token, F.lit(PUNCTUATION))


def prefix(token: Column) -> Column:
    return F.left(token, F.length(token) - F.length(F.ltrim(token, F.lit(PUNCTUATION))))


def suffix(token: Column) -> Column:
    return F.when(core(token) == "", "").otherwise(F.right(token, F.length(token) - F.length(F.rtrim(token, F.lit(PUNCTUATION)))))


#: Accented Latin letters and what they are without accents (fixed values).
ACCENTED, BARE = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ", "aaaaaaeeeeiiiiooooouuuuncyy"


def bare(text: Column) -> Column:
    """Lower-case Latin text without accents, JVM side; ``bare_any`` covers every script."""
    return F.translate(text, ACCENTED, BARE)


bare_any = _bare


def as_tree(value: Column) -> Column:
    """value, for long conditions: evaluated as a tree inside a lambda, which keeps its step out of whole-stage code.

    There it would be part of one method; one of over 8000 bytes is never compiled by the JVM, and runs some twenty times slower than the tree does.
    """
    return F.element_at(F.transform(F.array(F.lit(0)), lambda _: value), 1)


def nth_word(text: Column, i: Column) -> Column:
    """Word i, from 0, of normalised text that has so many; cut out by its spaces, so that no array is made."""
    cut = lambda t, count: F.call_function("substring_index", t, F.lit(" "), count)
    return cut(cut(text, i + 1), F.lit(-1))


def before_word(text: Column, i: Column) -> Column:
    """What stands before word i of normalised text, without the space between them; empty for the first one."""
    return F.call_function("substring_index", text, F.lit(" "), i)


def rank_hash(*parts: Column | str | int) -> Column:
    """SHA-256 of the parts joined by bars, as lower hex: its string order is its numeric order."""
    return F.sha2(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]), 256)


def shard_of(key: Column, n: int) -> Column:
    """The SHA-256 of key modulo n (under 2**31), by Horner's rule over 32-bit digits."""
    h, spot = F.sha2(key, 256), F.lit(0).cast("long")
    for k in range(0, 64, 8):
        spot = (spot * (1 << 32) + F.conv(F.substring(h, k + 1, 8), 16, 10).cast("long")) % n
    return spot


def tie_hash(seed: int, key: Column) -> Column:
    return F.sha2(F.concat(F.lit(str(seed)), F.lit("\x00"), key), 256)


def length_bucket(text: Column) -> Column:
    n = F.size(tokens(text))
    return F.when(n < 10, "<10").when(n < 20, "10-19").when(n < 30, "20-29").when(n < 50, "30-49").otherwise("50+")


def distance(a: str, b: str, swaps: bool = False) -> int:
    """Edit distance in code points; with ``swaps``, of adjacent transpositions too, none of which is edited again.

    Hyyro's bit vectors: a column of the table is two whole numbers of as many bits as a has characters, so a step of b costs some ten operations on
    them, whatever the distance is.
    """
    head, least = 0, min(len(a), len(b))
    while head < least and a[head] == b[head]:
        head += 1
    head = max(0, head - swaps)  # a transposition may reach back over one equal character
    a, b = a[head:], b[head:]
    tail, least = 0, min(len(a), len(b))
    while tail + swaps < least and a[-1 - tail] == b[-1 - tail] and (not swaps or a[-2 - tail] == b[-2 - tail]):
        tail += 1
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b or a == b:
        return 0 if a == b else len(a) or len(b)
    held, bit = {}, 1
    for x in a:
        held[x] = held.get(x, 0) | bit
        bit <<= 1
    full, last = bit - 1, bit >> 1
    up, down, diagonal, before, out = full, 0, 0, 0, len(a)
    for y in b:
        same = held.get(y, 0)
        swapped = ((~diagonal & same) << 1) & before if swaps else 0
        diagonal = (((((same & up) + up) ^ up) | same | down) & full) | swapped
        right, left = down | (~(diagonal | up) & full), diagonal & up
        out += (right & last > 0) - (left & last > 0)
        right, left = (right << 1 | 1) & full, (left << 1) & full
        up, down, before = left | (~(diagonal | right) & full), right & diagonal, same
    return out


def osa(a: str, b: str) -> int:
    return distance(a, b, swaps=True)


_word_distance = lru_cache(maxsize=1 << 12)(distance)


def told_distance(a: str, b: str, swaps: bool = False) -> int | None:
    """The distance, where bounds tell it: texts of as many words are no farther from each other than their words are, place by place, and no nearer than the characters
    that one has more often than the other (a transposition changes no character). Mostly both are the same number; nothing is returned where they are not."""
    x, y = a.split(" "), b.split(" ")
    if len(x) != len(y):
        return None
    most, over = 0, {}
    for u, v in zip(x, y, strict=True):
        if u != v:
            most += _word_distance(u, v, swaps)
            for c in u:
                over[c] = over.get(c, 0) + 1
            for c in v:
                over[c] = over.get(c, 0) - 1
    more = sum(n for n in over.values() if n > 0)
    return most if most == max(more, more - sum(over.values())) else None


def _distances(a: pd.Series, b: pd.Series, swaps: bool) -> pd.Series:
    """The conditions of a sample follow each other and mostly ask the same, so the last pairs are remembered."""

    @lru_cache(maxsize=16)
    def one(x: str | None, y: str | None) -> int | None:
        if x is None or y is None:
            return None
        told = told_distance(x, y, swaps)
        return distance(x, y, swaps) if told is None else told

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")


@F.pandas_udf(LongType())
def osa_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return _distances(a, b, True)


@F.pandas_udf(LongType())
def _edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return _distances(a, b, False)


def edit_distance(a: Column, b: Column) -> Column:
    """Edit distance in code points; equal texts never leave the JVM."""
    return F.when(a == b, F.lit(0)).otherwise(_edit_distance(F.when(a != b, a), F.when(a != b, b)).cast("int"))
