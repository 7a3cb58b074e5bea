"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

Documents with the same shingle set are one class, however many they are, and
one of them stands for it. Of every class, each of the COORDINATES coordinates
of its signature is posted under the pair of coordinate and value.

A pair of similarity 0.75 agrees in MATCHES coordinates or more (it misses that
with a probability of some 5e-6). Each class orders its coordinates by their
number of postings, the rarest first; two classes that agree in MATCHES of them
share one of the first COORDINATES - MATCHES + 1 of both, so only that prefix is
posted and the frequent rest is skipped. A value that only one class has needs
no posting, and a class with fewer than MATCHES shared values leaves at once.

Merging goes in two turns, so that a large group of near copies never becomes
all its pairs. First each list links its members to its hub, the one whose values
are the most frequent, which in a group of near copies is like the original. Of each
pair the coordinates that agree are counted; pairs with MATCHES or more that could be
similar by size are confirmed on the full shingle sets, and components formed. Then only lists that still hold several components are
merged, in blocks of members, and only members of different components are
compared: pairs within a component could add nothing.

Pairs of a similarity of 0.5 have MATCHES as often as not, so before full sets are
fetched, pairs that are kept must also agree in a sketch of further coordinates. It
misses a similarity of exactly 0.75 with a probability of some 4e-6, beside the
threshold's some 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import empty_text, free_names, frugal, planes, trim, trimmed, unplanes, written
from jobloom.llm.graph import components
from jobloom.llm.substring import by_bucket, member, sorted_runs
from jobloom.llm.textvec import mix, windows, words
from jobloom.llm.tokens import release

SHINGLE = 5
#: Similar: 100 * intersection >= PERCENT * union.
PERCENT = 75
COORDINATES = 64
MATCHES = 32
#: Classes in a group that asks for counts, groups whose questions meet in a bucket.
CLASSES, GROUPS_A_BUCKET = 4096, 16
#: Parts of the pairs of a node that is in very many, and how many are few.
SALTS, LEAST_HOT = 16, 256
#: Members of a block of a long list.
BLOCK = 512
#: Before two sets are compared in full, they must agree in AGREE of SKETCH further
#: coordinates, of which a byte each is kept: 4.5 standard deviations below what a
#: similarity of 0.75 gives.
SKETCH = 768
AGREE = 522
U, U4 = np.uint64, np.uint32
_SEEDS = mix(np.arange(1, 2 * (COORDINATES + SKETCH) + 1, dtype=U))
_FLIP, _TIMES = (_SEEDS[::2] >> U(32)).astype(U4), (_SEEDS[1::2] >> U(32)).astype(U4) | U4(1)


def shingle_sets(texts: list[str], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; of one with fewer words than
    width, the hash of all of them; of one without words, none."""
    release()
    hashes, first = words(texts, True)
    every, found = windows(hashes, width), []
    for i, j in zip(first.tolist(), first[1:].tolist(), strict=False):
        if j - i >= width:
            own = np.sort(every[i : j - width + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif j > i:
            own = windows(hashes[i:j], j - i) + U(j - i)
        else:
            own = np.empty(0, U)
        found.append(own)
    return found


def _class_key(own: np.ndarray) -> tuple[int, int]:
    a, b = mix(own).sum(dtype=U), mix(own ^ U(0x5DEECE66D5DEECE6)).sum(dtype=U)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _signatures(sets: list[np.ndarray], first: int = 0, last: int = COORDINATES) -> np.ndarray:
    """The coordinates from first to last of each set; no set may be empty."""
    full = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    low = (full >> U(32)).astype(U4)
    out = np.empty((len(sets), last - first), U4)
    for k in range(first, last):
        out[:, k - first] = np.minimum.reduceat((low ^ _FLIP[k]) * _TIMES[k], starts)
    return out


def _sketch(own: np.ndarray) -> bytes:
    marks = _signatures([own], COORDINATES, COORDINATES + SKETCH)[0]
    return ((marks >> U4(24)) ^ (marks >> U4(7))).astype(np.uint8).tobytes()


def _signed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        for at in range(0, len(part), 256):
            own = part.iloc[at : at + 256]
            sets = shingle_sets(own["text"].tolist())
            full = [x for x in sets if len(x)]
            marks = iter(_signatures(full)) if full else iter(())
            keys = [_class_key(x) for x in sets]
            yield pd.DataFrame({"doc_id": own["doc_id"], "n": [len(x) for x in sets], "k1": [k for k, _ in keys], "k2": [k for _, k in keys], "signature": [next(marks).tobytes() if len(x) else None for x in sets]})
        trim()


def _posted(raw: bytes) -> np.ndarray:
    """Keys of the pairs of coordinate and value."""
    values = np.frombuffer(raw, U4).reshape(-1, COORDINATES).astype(U)
    return mix(values + (np.arange(1, COORDINATES + 1, dtype=U) << U(32)))


def _survivors(classes: DataFrame, n_classes: int) -> DataFrame:
    """(node, k1, k2, n, doc_id, weight, signature, slots, keys): classes that share MATCHES
    values or more with others; keys: their prefix of posted keys; slots: 32 bits of the
    posted key of each coordinate, 0 where none is posted; weight: postings of all
    its values."""
    groups = max(1, -(-n_classes // CLASSES))
    buckets = max(1, -(-groups // GROUPS_A_BUCKET))
    rows = classes.withColumn("pid", F.pmod(F.xxhash64("k1", "k2"), F.lit(groups)).cast("int")).groupBy("pid")

    @trimmed
    def ask(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        keys = np.sort(_posted(b"".join(part["signature"])).reshape(-1))
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        count = np.diff(np.concatenate((at, [len(keys)]))).astype("<u4")
        keys = keys[at]
        return pd.DataFrame([(b, int(key[0]), planes(keys[i:j]), planes(count[i:j])) for b, i, j in by_bucket(keys, buckets)], columns=["bucket", "pid", "keys", "counts"])

    @trimmed
    def answer(part: pd.DataFrame) -> pd.DataFrame:
        each = [unplanes(x, U) for x in part["keys"]]
        keys, count = np.concatenate(each), np.concatenate([unplanes(x, "<u4") for x in part["counts"]]).astype(np.int64)
        order, at = sorted_runs(keys)
        table, total = keys[order][at], np.add.reduceat(count[order], at)
        table, total = table[total > 1], total[total > 1]
        found = []
        for pid, own in zip(part["pid"], each, strict=True):
            place = member(own, table)
            found.append((pid, planes(own[place >= 0]), planes(total[place[place >= 0]])))
        return pd.DataFrame(found, columns=["pid", "keys", "counts"])

    @trimmed
    def prefix(key: tuple, part: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        table = np.concatenate([np.empty(0, U), *(unplanes(x, U) for x in told["keys"])])
        total = np.concatenate([np.empty(0, np.int64), *(unplanes(x, np.int64) for x in told["counts"])])
        order = np.argsort(table)
        table, total, found = table[order], total[order], []
        for row in part.itertuples(index=False):
            keys = _posted(row.signature)[0]
            place = member(keys, table)
            count = np.where(place >= 0, total[place] if len(total) else 1, 1)
            if (count > 1).sum() < MATCHES:
                continue
            first = np.lexsort((keys, count))[: COORDINATES - MATCHES + 1]
            first = first[count[first] > 1]
            slots = np.zeros(COORDINATES, U4)
            slots[first] = keys[first].astype(U4) | U4(1)
            found.append((row.k1, row.k2, row.n, row.doc_id, int(count.sum()), row.signature, slots.tobytes(), [{"key": k, "slot": s} for k, s in zip(keys[first].view(np.int64).tolist(), first.tolist(), strict=True)]))
        return pd.DataFrame(found, columns=["k1", "k2", "n", "doc_id", "weight", "signature", "slots", "keys"])

    asked = rows.applyInPandas(ask, "bucket int, pid int, keys binary, counts binary")
    told = asked.groupBy("bucket").applyInPandas(answer, "pid int, keys binary, counts binary")
    found = rows.cogroup(told.groupBy("pid")).applyInPandas(prefix, "k1 long, k2 long, n long, doc_id long, weight long, signature binary, slots binary, keys array<struct<key:long,slot:int>>")
    return written(found.withColumn("node", F.monotonically_increasing_id()), "survivors")


def _met(pairs: DataFrame, sets: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The pairs (a, b) with columns of sets of both: {"m": "sketch"} gives ma and mb.
    Nodes in more than a thousandth of the pairs, so fewer than a thousand on either
    side, have a copy of theirs for each of SALTS parts of their pairs."""
    pairs = written(pairs.select("a", "b"), "pairs")
    total = pairs.count()
    for key, by in (("a", "b"), ("b", "a")):
        side = sets.select(F.col("node").alias(key), *[F.col(c).alias(k + key) for k, c in columns.items()])
        counts = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") * 1000 > total) & (F.col("n") > LEAST_HOT))
        hot = [r[0] for r in counts.select(key).collect()]  # fewer than a thousand
        if not hot:
            pairs = pairs.join(side, key)
            continue
        every = F.sequence(F.lit(0), F.lit(SALTS - 1))
        side = side.withColumn("salt", F.explode(F.when(F.col(key).isin(hot), every).otherwise(F.array(F.lit(0)))))
        salt = F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(0).cast("int")
        pairs = pairs.withColumn("salt", salt).join(side, [key, "salt"]).drop("salt")
    return pairs


def _collide(a: np.ndarray, b: np.ndarray, mark_a: np.ndarray, mark_b: np.ndarray) -> np.ndarray:
    """Which pairs of rows of signatures agree in MATCHES coordinates or more, and of
    those, in AGREE of the sketch."""
    found = (a == b).sum(axis=1) >= MATCHES
    found[found] = (mark_a[found] == mark_b[found]).sum(axis=1) >= AGREE
    return found


def _columns(raw: pd.Series, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), kind).reshape(-1, width)


def _agreeing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) above the match threshold that could be similar by size."""
    rows = _met(pairs, sets, {"c": "signature", "m": "sketch", "n": "n"}).filter(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")

    def agree(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                marks = [_columns(part[c], U4, COORDINATES) for c in ("ca", "cb")] + [_columns(part[c], np.uint8, SKETCH) for c in ("ma", "mb")]
                yield part.loc[_collide(*marks), ["a", "b"]]

    return rows.mapInPandas(agree, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar. sets: (node, set). Shingles are
    64-bit hashes; two unlike sets of 10,000 share one by chance once in 10^11 pairs,
    and one shared shingle decides nothing but at the very threshold."""

    def confirm(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            ok = []
            for x, y in zip(part["sa"], part["sb"], strict=True):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = int((member(x, y) >= 0).sum())
                ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield part.loc[np.array(ok, bool), ["a", "b"]]
            trim()

    return _met(pairs, sets, {"s": "set"}).mapInPandas(confirm, "a long, b long")


def _full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, set, signature, sketch) of the survivors, from their whole texts."""
    rows = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", empty_text().alias("text")).join(nodes.select("doc_id", "node", "k1", "k2", "signature"), "doc_id")

    def own(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 256):
                some = part.iloc[at : at + 256]
                sets = shingle_sets(some["text"].tolist())
                same = [_class_key(x) == (a, b) for x, a, b in zip(sets, some["k1"], some["k2"], strict=True)]
                found = [(node, len(x), x.tobytes(), marks, _sketch(x)) for node, x, marks, ok in zip(some["node"], sets, some["signature"], same, strict=True) if ok]
                yield pd.DataFrame(found, columns=["node", "n", "set", "signature", "sketch"])
            trim()

    return written(rows.mapInPandas(own, "node long, n long, set binary, signature binary, sketch binary").dropDuplicates(["node"]), "sets")


def _cross_pairs(posts: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): members of one list, of different components, that agree in MATCHES
    coordinates and in the sketch. Long lists are compared block by block, and a pair only in the list of
    the first coordinate that both have posted alike."""
    rows = posts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("g")).filter("lo <> hi").select("key", "g")
    rows = written(rows.join(mixed, "key"), "mixed")
    total = rows.count()
    blocks = F.ceil(F.col("g") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("c")).cast("int")
    rows = rows.withColumn("c", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    rows = rows.select("node", "label", "key", "slot", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rows = rows.join(nodes.select("node", "slots"), "node").join(sets.select("node", "n", "signature", "sketch"), "node")
    rows = rows.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(max(1, total // (4 * BLOCK)))))

    @trimmed
    def pairs(part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, i, j), own in part.groupby(["key", "i", "j"], sort=False):
            node, label, n = (own[c].to_numpy(np.int64) for c in ("node", "label", "n"))
            values, mark = _columns(own["signature"], U4, COORDINATES), _columns(own["sketch"], np.uint8, SKETCH)
            slots, slot = _columns(own["slots"], U4, COORDINATES), int(own["slot"].iloc[0])
            block = own["own"].to_numpy()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            for at in range(0, len(left), 64):
                x = left[at : at + 64, None]
                ok = (label[x] != label[right]) & (100 * np.minimum(n[x], n[right]) >= PERCENT * np.maximum(n[x], n[right])) & (node[x] != node[right])
                if i == j:
                    ok &= node[x] < node[right]
                p, q = np.nonzero(ok)
                p, q = left[at + p], right[q]
                for k in range(0, len(p), 8192):
                    a, b = p[k : k + 8192], q[k : k + 8192]
                    here = ((slots[a] == slots[b]) & (slots[a] > 0)).argmax(axis=1) == slot
                    a, b = a[here], b[here]
                    same = _collide(values[a], values[b], mark[a], mark[b])
                    a, b = node[a[same]], node[b[same]]
                    found.append(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1))
        every = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        return pd.DataFrame(every, columns=["a", "b"])

    return rows.groupBy("task").applyInPandas(pairs, "a long, b long")


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, k1, k2) of each row of docs.

    Words are lower-cased A-Z; a set holds the distinct 5-word shingles, or all
    words of a shorter text as one. Two documents are linked if 100 * intersection
    >= 75 * union. component_id: the smallest doc_id reachable by links. kept:
    doc_id is its component_id; of rows that repeat a doc_id all are kept. Texts
    without words (null ones too) have no shingles and link with nothing. A null
    doc_id takes no part: its component_id is null and it is kept. No rows give
    none; other columns are ignored. k1 and k2 name the set.
    """
    frugal(docs.sparkSession)
    signed = docs.select(F.col("doc_id").cast("string"), empty_text().alias("text")).mapInPandas(_signed, "doc_id string, n long, k1 long, k2 long, signature binary")
    signed = written(signed.withColumn("doc_id", F.col("doc_id").cast("long")), "signed")
    rows = signed.drop("signature")
    classes = written(rows.filter("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "classes")
    sizes = classes.agg(F.count(F.lit(1)).alias("classes"), F.sum("copies").alias("rows")).first()
    large = classes.filter((F.col("copies") * 1000 > (sizes["rows"] or 0)) & (F.col("copies") > LEAST_HOT))
    hot = F.col("k1").isin([r["k1"] for r in large.select("k1").collect()])  # fewer than a thousand
    classes = classes.drop("copies")
    standing = signed.join(classes, ["k1", "k2", "doc_id"], "left_semi")
    nodes = _survivors(standing, sizes["classes"])
    sets = _full_sets(docs, nodes)
    posts = nodes.select("node", "weight", F.explode("keys").alias("_key")).select("node", "weight", "_key.key", "_key.slot")
    centre = posts.groupBy("key").agg(F.max_by("node", "weight").alias("a"), F.count(F.lit(1)).alias("g")).filter("g > 1").select("key", "a")
    stars = posts.join(centre, "key").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    links = written(_confirmed(_agreeing(stars, sets), sets), "links")
    labels = components(links)
    cross = _cross_pairs(posts, labels, nodes, sets)
    more = written(_confirmed(cross, sets), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = nodes.select("node", "k1", "k2", F.col("doc_id").alias("least")).join(labels, "node")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    found = named.join(least, "label").select("k1", "k2", "component_id")
    every = classes.join(found, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("component_id", "doc_id").alias("_component"))
    # a class of very many copies has a row for each of SALTS parts of them
    parts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salt = F.when(hot, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0).cast("int")
    every = every.withColumn("salt", F.explode(parts))
    joined = rows.filter("n > 0 and doc_id is not null").withColumn("salt", salt).join(every, ["k1", "k2", "salt"])
    alone = rows.filter("n = 0 or doc_id is null").withColumn("_component", F.col("doc_id"))
    both = joined.select(alone.columns).unionByName(alone)
    return both.select("doc_id", F.col("n").alias("n_shingles"), F.col("_component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("_component"), F.lit(True)).alias("kept"), "k1", "k2")


def drop_near(docs: DataFrame) -> DataFrame:
    """The rows of docs that near_groups keeps, all their columns unchanged: those
    whose doc_id is not among the dropped ones'. Rows that repeat a doc_id go
    together. Columns may have any names."""
    (name,) = free_names(docs.columns, "_gone")
    gone = near_groups(docs).filter(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
