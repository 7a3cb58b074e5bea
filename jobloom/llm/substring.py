"""Substring deduplication by fixed-block anchors.

A window of `width` words holds a whole block of (width + 1) // 2 words at a
multiple of that length from its document's start. So every document's
non-overlapping blocks are indexed, and the windows of block length from every
word of every document probe that index. Where a block is met again, both places
are extended: the windows of full width around them are compared over all
documents, and consecutive ones that repeat make up the maximal repeats.

Documents are dealt into groups of bounded size. A group sends each distinct hash
once to the hash's bucket, with flags or its smallest and largest document, and
the bucket answers it; so a passage of any frequency is one row per group, and
text crosses the network once. Windows are compared by 96 bits of two hashes that
share nothing: of 10^13 different windows some 6e-4 pairs would be taken for equal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import dealt, frugal, planes, unplanes, whole_ids
from jobloom.llm.textvec import inside, wide_words, windows, words

WIDTH = 13
GROUP_BYTES = 4 << 20
#: Groups whose hashes meet in a bucket.
GROUPS_A_BUCKET = 6
U = np.uint64
#: Probes travel with 48 of their 64 bits. A chance hit costs a comparison of full
#: windows, which have all bits.
PROBE = U(0xFFFFFFFFFFFF0000)


def sorted_runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first place of each distinct key in that order)."""
    order = np.argsort(keys)
    ranked = keys[order]
    return order, np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(keys) else np.empty(0, np.int64)


def _distinct(hashes: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """sorted_runs() of the pairs of both."""
    order, at = sorted_runs(hashes)
    ranked, other = hashes[order], check[order]
    if ((ranked[1:] == ranked[:-1]) & (other[1:] != other[:-1])).any():  # a collision of 64 bits
        order = np.lexsort((check, hashes))
        ranked, other = hashes[order], check[order]
        at = np.flatnonzero(np.concatenate(([True], (ranked[1:] != ranked[:-1]) | (other[1:] != other[:-1]))))
    return order, at


def by_bucket(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes: a bucket is a range of them."""
    edges = np.searchsorted(hashes >> U(32), (np.arange(buckets + 1, dtype=object) * (1 << 32) // buckets).astype(np.int64).astype(U))
    edges[-1] = len(hashes)
    return [(b, int(i), int(j)) for b, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if j > i]


def member(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted table, -1 where there is none."""
    if not len(table):
        return np.full(len(hashes), -1, np.int64)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return np.where(table[at] == hashes, at, -1)


def _documents(part: pd.DataFrame) -> pd.DataFrame:
    return part[~part["no_id"]]


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text, n_words, n_removed, spans) of each row of docs.

    Every word covered by a window whose words, unchanged, also start in a
    document with a smaller doc_id is removed; windows are those of the input.
    spans: the maximal runs of removed words, array of (begin, end) in words.
    text: the words that stay, joined by one space. A null text has no words.
    Rows that repeat a doc_id are one document to each other. A null doc_id takes
    no part: it keeps all its words. No rows give none; other columns are ignored.
    """
    frugal(docs.sparkSession)
    block = (width + 1) // 2
    rows, groups = dealt(docs, GROUP_BYTES)
    buckets = max(1, -(-groups // GROUPS_A_BUCKET))

    def anchors(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = _documents(part)
        hashes, first = words(part["text"].tolist(), False)
        ok = np.flatnonzero(inside(first, block))
        doc = np.repeat(np.arange(len(part)), np.diff(first))[ok]
        aligned = (ok - first[doc]) % block == 0
        ids = part["doc_id"].to_numpy(np.int64)[doc]
        probe = windows(hashes, block)[ok] & PROBE
        order, at = sorted_runs(probe)
        flags = np.empty(0, np.uint8)
        if len(at):
            low, high = np.minimum.reduceat(ids[order], at), np.maximum.reduceat(ids[order], at)
            flags = np.logical_or.reduceat(aligned[order], at).astype(np.uint8) | ((low != high) << 1).astype(np.uint8)
        probe = probe[order][at]
        found = [(b, int(key[0]), planes(probe[i:j]), flags[i:j].tobytes()) for b, i, j in by_bucket(probe, buckets)]
        return pd.DataFrame(found, columns=["bucket", "pid", "hashes", "flags"])

    def met(part: pd.DataFrame) -> pd.DataFrame:
        each = [unplanes(x, U) for x in part["hashes"]]
        hashes, flags = np.concatenate(each), np.frombuffer(b"".join(part["flags"]), np.uint8)
        order, at = sorted_runs(hashes)
        any_of = np.bitwise_or.reduceat(flags[order], at)
        many = np.diff(np.concatenate((at, [len(hashes)]))) > 1
        hits = hashes[order][at][(any_of & 1 == 1) & (many | (any_of & 2 == 2))]
        back = [x[member(x, hits) >= 0] for x in each]
        return pd.DataFrame({"pid": part["pid"], "hits": [planes(x) for x in back]})

    def extended(part: pd.DataFrame, told: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, places, ids, hashes, check) of the windows that hold a block met again."""
        (hashes, second), first = wide_words(part["text"].tolist(), False)
        hits = np.sort(np.concatenate([np.empty(0, U), *(unplanes(x, U) for x in told["hits"])]))
        hit = member(windows(hashes, block) & PROBE, hits) >= 0
        count = np.concatenate(([0], np.cumsum(hit)))
        ok = inside(first, width)
        n = len(ok)
        near = count[block : block + n] > count[:n] if n else ok
        places = np.flatnonzero(ok & near)
        ids = np.repeat(part["doc_id"].to_numpy(np.int64), np.diff(first))[places]
        return first, places, ids, windows(hashes, width)[places], (windows(second, width)[places] >> U(32)).astype("<u4")

    def ask(key: tuple, part: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        _, _, ids, hashes, check = extended(_documents(part), told)
        order, at = _distinct(hashes, check)
        low = high = ids
        if len(at):
            low, high = np.minimum.reduceat(ids[order], at), np.maximum.reduceat(ids[order], at)
        hashes, check = hashes[order][at], check[order][at]
        found = [(b, int(key[0]), planes(hashes[i:j]), check[i:j].tobytes(), planes(low[i:j]), planes(high[i:j])) for b, i, j in by_bucket(hashes, buckets)]
        return pd.DataFrame(found, columns=["bucket", "pid", "hashes", "check", "low", "high"])

    def smallest(part: pd.DataFrame) -> pd.DataFrame:
        """For each question which of its windows start in a smaller document, a bit
        each in the question's order, and of those the smallest document."""
        each = [unplanes(x, U) for x in part["hashes"]]
        hashes, check = np.concatenate(each), np.frombuffer(b"".join(part["check"]), "<u4")
        low = np.concatenate([unplanes(x, np.int64) for x in part["low"]])
        order, at = _distinct(hashes, check)
        table, other, least = hashes[order][at], check[order][at], np.minimum.reduceat(low[order], at)
        found = []
        for bucket, pid, x, raw, high in zip(part["bucket"], part["pid"], each, part["check"], part["high"], strict=True):
            place, mark = np.searchsorted(table, x), np.frombuffer(raw, "<u4")
            while (step := other[place] != mark).any():
                place += step
            own = least[place]
            later = own < unplanes(high, np.int64)
            if later.any():
                found.append((bucket, pid, np.packbits(later).tobytes(), planes(own[later])))
        return pd.DataFrame(found, columns=["bucket", "pid", "later", "least"])

    def cut(key: tuple, part: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        known = _documents(part)
        told, answer = hits[hits["hits"].notna()], hits[hits["later"].notna()]
        first, places, ids, hashes, check = extended(known, told)
        order, at = _distinct(hashes, check)
        asked = {b: (i, j) for b, i, j in by_bucket(hashes[order][at], buckets)}
        least = np.full(len(at), np.iinfo(np.int64).max)
        for bucket, later, own in zip(answer["bucket"], answer["later"], answer["least"], strict=True):
            i, j = asked[int(bucket)]
            least[i + np.flatnonzero(np.unpackbits(np.frombuffer(later, np.uint8), count=j - i))] = unplanes(own, np.int64)
        of = np.empty(len(places), np.int64)
        of[order] = np.repeat(least, np.diff(np.concatenate((at, [len(places)]))))
        gone = places[ids > of]
        turn = np.zeros(int(first[-1]) + 1, np.int64)
        np.add.at(turn, gone, 1)
        np.add.at(turn, gone + width, -1)
        dead = np.cumsum(turn)[:-1] > 0
        found = []
        for doc_id, text, i, j in zip(known["doc_id"], known["text"], first, first[1:], strict=False):
            own = text.encode("utf-8", "surrogatepass").split()
            spans = np.flatnonzero(np.diff(np.concatenate(([0], dead[i:j].astype(np.int8), [0])))).reshape(-1, 2)
            if len(spans):
                own = [w for w, x in zip(own, dead[i:j].tolist(), strict=True) if not x]
            found.append((doc_id, b" ".join(own).decode("utf-8", "surrogatepass"), j - i, int(np.diff(spans).sum()), [{"begin": int(a), "end": int(b)} for a, b in spans]))
        for text in part[part["no_id"]]["text"]:
            own = text.encode("utf-8", "surrogatepass").split()
            found.append((None, b" ".join(own).decode("utf-8", "surrogatepass"), len(own), 0, []))
        out = pd.DataFrame([x[1:] for x in found], columns=["text", "n_words", "n_removed", "spans"])
        out.insert(0, "doc_id", whole_ids([x[0] or 0 for x in found], [x[0] is None for x in found]))
        return out

    dealt_rows = rows.groupBy("pid")
    blobs = dealt_rows.applyInPandas(anchors, "bucket int, pid int, hashes binary, flags binary")
    hits = blobs.groupBy("bucket").applyInPandas(met, "pid int, hits binary")
    asked = dealt_rows.cogroup(hits.groupBy("pid")).applyInPandas(ask, "bucket int, pid int, hashes binary, check binary, low binary, high binary")
    answers = asked.groupBy("bucket").applyInPandas(smallest, "bucket int, pid int, later binary, least binary")
    both = hits.select("pid", "hits").unionByName(answers.select("pid", "bucket", "later", "least"), allowMissingColumns=True)
    return dealt_rows.cogroup(both.groupBy("pid")).applyInPandas(cut, "doc_id long, text string, n_words long, n_removed long, spans array<struct<begin:long,end:long>>")
