"""Outlines of shingle sets: no similar pair is lost, and what they tell is exact."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from jobloom.functions.outline import bucket_keys, compared, outlined
from jobloom.operators import dedup


def outlines_of(sets, least):
    s = pa.array([sorted(x) for x in sets], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets))), s], names=["doc", "s"])
    return pa.Table.from_batches(outlined(least)(iter([batch])))


def test_outlines_tell_or_leave_open_and_lose_nothing():
    draw = random.Random(5)
    value = lambda: draw.randrange(-(2**63), 2**63)
    sets = []
    for n in (1, 2, 3, 15, 16, 19, 20, 21, 31, 32, 60, 63, 64, 65, 127, 128, 250, 1000, 1023, 1025):
        own = [value() for _ in range(n)]
        for k in (0, 0, 1, 2, n // 40, n // 20, n // 10):
            more, less = draw.randint(0, k), draw.randint(0, min(k, n - 1))
            sets.append(set(own[less:]) | {value() for _ in range(more)})
    for least in (0.6, 0.95, 1.0):
        table = outlines_of(sets, least)
        rows = table.to_pylist()
        assert [r["n"] for r in rows] == [len(s) for s in sets]
        posted = pa.Table.from_batches(bucket_keys(iter(table.to_batches()))).to_pylist()
        keys = {}
        for r in posted:
            keys.setdefault(r["doc"], set()).add(r["key"])
        pairs, told = [], 0
        for i, a in enumerate(sets):
            for j in range(i):
                b = sets[j]
                if min(len(a), len(b)) >= least * max(len(a), len(b)) - 1e-9:
                    x, y = rows[i], rows[j]
                    ends = (x["upper"] if x["level"] < y["level"] else x["own"], y["upper"] if y["level"] < x["level"] else y["own"])
                    pairs.append((i, j, len(a), len(b), *ends))
                if len(a & b) / len(a | b) >= least:
                    assert keys[i] & keys[j]
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pairs, strict=True)], names=["i", "j", "n", "m", "x", "y"])
        got = {(r["i"], r["j"]): r["similarity"] for b in compared(least)(iter([batch])) for r in b.to_pylist()}
        for i, j, *_ in pairs:
            true = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if (i, j) not in got:
                assert true < least
            elif got[i, j] is not None:
                assert got[i, j] == true
                told += true < 1
        assert told > 20 or least == 1


def test_pairs_are_those_of_whole_sets_and_texts_stay_where_they_are(spark, monkeypatch):
    draw = random.Random(9)
    texts = []
    for i in range(12):
        own = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice((3, 30, 180, 400)))]
        texts += [" ".join(own), " ".join(own) + " fin", " ".join(["v", *own[1:]]), " ".join([*own[1:-1], "u", "t"]), "  ".join(own)]
    rows = spark.createDataFrame([(m, t) for m in (1, 2) for t in [*texts, texts[0], "", None]] + [(None, texts[0])], "month int, pst_detail string")

    def grams(text):
        word = text.split()
        return {tuple(word[i : i + 5]) for i in range(len(word) - 4)} if len(word) >= 5 else {" ".join(word)[i : i + 5] for i in range(max(1, len(" ".join(word)) - 4))}

    md5 = {t: hashlib.md5(t.encode()).hexdigest() for t in [*texts, ""]}
    want = set()
    for a in md5:
        for b in md5:
            x, y = grams(a), grams(b)
            if md5[a] < md5[b] and len(x & y) / len(x | y) >= 0.95:
                want |= {(m, md5[a], md5[b], round(len(x & y) / len(x | y), 9)) for m in (1, 2)}
    for known in (dedup.KNOWN, 0):
        monkeypatch.setattr(dedup, "KNOWN", known)
        out = dedup.similar_texts(rows, "month")
        got = [(r.month, r.a, r.b, round(r.similarity, 9)) for r in out.collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 20 and np.all([w[3] >= 0.95 for w in want])
