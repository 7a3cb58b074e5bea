"""Similarities of names and texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.functions.let import let

# Weights of the name similarity.
CHAR_WEIGHT, BIGRAM_WEIGHT, LENGTH_WEIGHT = 0.3, 0.5, 0.2
PREFIX_FACTOR, SHORT_PREFIX_FACTOR, SHORT_PREFIX = 0.8, 0.5, 3


def _grams(text: Column, n: int) -> Column:
    """Distinct n-grams of characters; none of a text that is shorter."""
    at = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.substring(text, i, F.lit(n))))


def name_parts(column: Column | str) -> Column:
    """What name_similarity compares of a name, to be computed once for each name:
    (t: lower case, g1: characters, g2: bigrams)."""
    text = F.lower(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")))
    return let(text, lambda t: F.struct(t.alias("t"), _grams(t, 1).alias("g1"), _grams(t, 2).alias("g2")))


def _by_prefix(a: Column, b: Column) -> Column:
    """The similarity of names in lower case of which one is empty or begins with the other, else null."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    ratio = short / long * F.when(short < SHORT_PREFIX, SHORT_PREFIX_FACTOR).otherwise(PREFIX_FACTOR)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).when(F.startswith(a, b) | F.startswith(b, a), ratio)


def prefix_similarity(a: str, b: str) -> Column:
    """name_similarity where a name begins with the other, from their lengths alone; else null."""
    return _by_prefix(F.lower(a), F.lower(b))


def parts_similarity(x: Column, y: Column) -> Column:
    """name_similarity of two columns of name_parts."""
    a, b = x["t"], y["t"]
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))

    def jaccard(k: str) -> Column:
        both = F.size(F.array_intersect(x[k], y[k]))
        union = F.size(x[k]) + F.size(y[k]) - both
        return F.when(union == 0, 0.0).otherwise(both / union)

    mixed = CHAR_WEIGHT * jaccard("g1") + BIGRAM_WEIGHT * jaccard("g2") + LENGTH_WEIGHT * (short / long)
    return F.coalesce(_by_prefix(a, b), mixed)


def _bits(items: Column) -> Column:
    """A bit of 64 for each item, by its hash."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))
    return F.aggregate(items, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseOR(bit(x)))


def name_outline(column: Column | str) -> Column:
    """What may_reach compares of a name: (t: lower case, l: its length, and of its
    characters and bigrams n: how many, b: their bits, o: how many more than bits)."""

    def outline(p: Column) -> Column:
        return F.struct(p["t"].alias("t"), F.length(p["t"]).alias("l"), *[c for k in (1, 2) for c in (F.size(p[f"g{k}"]).alias(f"n{k}"), p[f"b{k}"].alias(f"b{k}"), (F.size(p[f"g{k}"]) - F.bit_count(p[f"b{k}"])).alias(f"o{k}"))])

    with_bits = let(name_parts(column), lambda p: F.struct(p["t"].alias("t"), p["g1"].alias("g1"), p["g2"].alias("g2"), _bits(p["g1"]).alias("b1"), _bits(p["g2"]).alias("b2")))
    return let(with_bits, outline)


def may_reach(x: Column, y: Column, least: float) -> Column:
    """False only if name_similarity of two columns of name_outline is below least: no
    more items are common than bits are, and those of x that share a bit."""

    def most(k: int) -> Column:
        n, m = x[f"n{k}"], y[f"n{k}"]
        both = F.least(F.bit_count(x[f"b{k}"].bitwiseAND(y[f"b{k}"])) + x[f"o{k}"], n, m)
        return both / F.greatest(n + m - both, F.lit(1))

    ratio = F.least(x["l"], y["l"]) / F.greatest(x["l"], y["l"], F.lit(1))
    mixed = CHAR_WEIGHT * most(1) + BIGRAM_WEIGHT * most(2) + LENGTH_WEIGHT * ratio
    return (mixed >= least - 1e-9) | F.startswith(x["t"], y["t"]) | F.startswith(y["t"], x["t"])


def name_similarity(a: Column | str, b: Column | str) -> Column:
    """From 0 to 1: equal names 1, a name that begins with the other by their
    lengths, else by common characters, bigrams and lengths."""
    return let(F.struct(name_parts(a).alias("x"), name_parts(b).alias("y")), lambda p: parts_similarity(p["x"], p["y"]))


#: Longest text whose characters are bits of one machine word.
WORD_BITS = 62


def _common(short: str, window: str) -> int:
    """Length of the longest common subsequence, a bit for each character of short."""
    at = {}
    for i, c in enumerate(short):
        at[c] = at.get(c, 0) | 1 << i
    ones = (1 << len(short)) - 1
    row = ones
    for c in window:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & ones
    return len(short) - row.bit_count()


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _all_windows(short: str, codes: np.ndarray, least: float) -> float:
    """The best ratio of short, of WORD_BITS characters at most, with the windows of
    a text that is no shorter: all windows take a step at once, a bit for each
    character of short. Windows that have too few of its characters are left out."""
    m, n = len(short), len(codes)
    masks = np.zeros(n + 2 * (m - 1), np.uint64)
    top = max(map(ord, short)) + 1
    bits = np.zeros(top + 1, np.uint64)
    for i, c in enumerate(short):
        bits[ord(c)] |= np.uint64(1 << i)
    masks[m - 1 : m - 1 + n] = bits[np.minimum(codes, top)]
    ends = np.arange(1, n + m)
    size = np.minimum(ends, n) - np.maximum(0, ends - m)
    known = np.concatenate(([0], np.cumsum(masks != 0)))
    most = 200.0 * (known[m:] - known[:-m]) / (m + size)
    at = np.flatnonzero((most >= least) & (most > 0))
    if not len(at):
        return 0.0
    ones = np.uint64((1 << m) - 1)
    row = np.full(len(at), ones, np.uint64)
    for k in range(m):
        hit = row & masks[at + k]
        row = ((row + hit) | (row - hit)) & ones
    return float((200.0 * (m - np.bitwise_count(row).astype(np.int64)) / (m + size[at])).max())


def best_window_ratio(a: str, b: str, least: float = 0.0, codes: np.ndarray | None = None) -> float:
    """0 to 100: the most that the shorter text has in common with a part of the
    longer one that is no longer, parts at both ends included. A ratio below `least`
    may be given as 0. codes: of b, if it is there already."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    m, best = len(short), 0.0
    if m <= WORD_BITS:
        return _all_windows(short, codes if codes is not None and long is b else codes_of(long), least)
    known = set(short)
    for end in range(1, len(long) + m):
        part = long[max(0, end - m) : min(end, len(long))]
        # only parts whose outer character is in the shorter text can be best
        if (part[-1] if end <= len(long) else part[0]) not in known:
            continue
        best = max(best, 200.0 * _common(short, part) / (m + len(part)))
    return best


@F.pandas_udf(T.DoubleType())
def partial_ratio(name: pd.Series, text: pd.Series) -> pd.Series:
    """best_window_ratio of both in lower case; null if either is."""
    return pd.Series([None if x is None or y is None else best_window_ratio(x.lower(), y.lower()) for x, y in zip(name, text, strict=True)], dtype="float64")
