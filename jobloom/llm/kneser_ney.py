"""Interpolated modified Kneser-Ney bigram model of words.

Counting. Tasks combine the bigrams of some MB of text and send each distinct one
once to a bucket of its context; the bucket adds up, writes a shard of sorted
bigram hashes with counts, and reports what its bigrams say about words: totals
and numbers of followers by context, numbers of distinct contexts by word. A
second round by word adds those to the unigram counts and writes shards of
sorted word hashes. Contexts with more than 1/HOT of all tokens (so fewer than
HOT) are spread over the buckets by what follows.

Scoring. Texts are dealt into groups; a group asks for each distinct word and
bigram once, the worker that gets a bucket's questions memory-maps that one
shard, and the answers go back to the groups. What a worker holds is bounded by
the size of a group or a shard, and what moves grows with the corpus in
proportion.

p(w | h) = (c(hw) - D) / c(h.) + g(h) p1(w); p1 from the number of distinct
contexts, discounted in the same way and interpolated with 1 / (V + 1).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import dealt, empty_text, forget, frugal, planes, scratch_path, unplanes, whole_ids, written
from jobloom.llm.substring import sorted_runs
from jobloom.llm.textvec import mix, words

GROUP_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
HOT = 1000
U = np.uint64
BEGIN, END = (int(x) for x in mix(np.array([1, 2], U) * U(0xD6E8FEB86659FD93)))
_Q = U(0xC2B2AE3D27D4EB4F)


class Model(NamedTuple):
    """root: folder of the shards; bigrams, words: tables (bucket, name, n); the rest
    are numbers: tokens N, distinct tokens V, distinct bigrams, discounts."""

    root: str
    bigrams: DataFrame
    words: DataFrame
    buckets: int
    hot: tuple[int, ...]
    tokens: int
    vocabulary: int
    pairs: int
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    low_rest: float


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens with an end each, the token before each, first token of each text)."""
    hashes, first = words(texts, True)
    n = len(texts)
    out = np.full(len(hashes) + n, U(END))
    begin = first + np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[begin[1:] - 1] = False
    out[keep] = hashes
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[begin[:-1]] = U(BEGIN)
    return out, before, begin


def pair_key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(before * _Q + token)


def pair_bucket(before: np.ndarray, token: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    by = np.where(np.isin(before, hot), pair_key(before, token), before) if len(hot) else before
    return (mix(by) % U(buckets)).astype(np.int64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a place of each distinct key, its number of places, for each place its key's rank)."""
    order, at = sorted_runs(keys)
    count = np.diff(np.concatenate((at, [len(keys)])))
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.repeat(np.arange(len(at)), count)
    return order[at], count, rank


def _sliced(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted buckets."""
    if len(bucket):
        at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        yield from zip(bucket[at[:-1]].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)


def _gathered(parts: Iterator[pd.DataFrame]) -> Iterator[list[str]]:
    texts, size = [], 0
    for part in parts:
        for text in part["text"]:
            texts.append(text)
            size += len(text) + 64
            if size >= GROUP_BYTES:
                yield texts
                texts, size = [], 0
    if texts:
        yield texts


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts that 1, 2, 3 and 4 n-grams have. Where a number is 0, as in tiny
    corpora, the discount is halfway: 0.5, 1, 1.5."""
    if min(n) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return tuple(min(max(x, 0.05), k) for k, x in enumerate(raw, 1))


def discounted(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """What the discount leaves of each count."""
    return count - np.array([0.0, *d])[np.minimum(count, 3)]


def _write(root: str, name: str, **arrays: np.ndarray) -> None:
    """A shard: the arrays one behind the other, then their places."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(root)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(b"".join(np.ascontiguousarray(x).tobytes() for x in arrays.values()))


@contextlib.contextmanager
def _mapped(root: str, name: str, n: int, kinds: dict[str, str]):
    """The arrays of a shard, memory-mapped: in place if its folder is mounted,
    else from a copy that goes when they are no longer used."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(root)
    path, copy = f"{path}/{name}", None
    if not isinstance(store, fs.LocalFileSystem):
        handle, copy = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as out, store.open_input_stream(path) as f:
            while block := f.read(1 << 22):
                out.write(block)
        path = copy
    try:
        at, found = 0, {}
        for key, kind in kinds.items():
            found[key] = np.memmap(path, kind, "r", at, (n,)) if n else np.empty(0, kind)
            at += n * np.dtype(kind).itemsize
        yield found
    finally:
        if copy:
            os.unlink(copy)


#: Counts of 255 and more stand beside the shard's name.
_PAIR = {"high": "<u4", "low": "<u2", "count": "u1"}
#: Bigrams are told apart by 64 bits wherever they are counted. What is stored and
#: asked has 48 of them; the bucket is known besides.
_ASKED = U(0xFFFFFFFFFFFF0000)
#: A word is as often a context as it is met; the beginning counts as often as the end.
_WORD = {"key": "<u8", "count": "<i8", "one": "<u4", "two": "<u4", "more": "<u4", "contexts": "<u4"}


def _find(table: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each key in a shard of bigrams."""
    high, low = (keys >> U(32)).astype("<u4"), (keys >> U(16)).astype("<u2")
    last = len(table["high"]) - 1
    at = np.minimum(np.searchsorted(table["high"], high), last)
    while (step := (table["high"][at] == high) & (table["low"][at] < low) & (at < last)).any():
        at += step
    return at, (table["high"][at] == high) & (table["low"][at] == low)


def train(docs: DataFrame, root: str | None = None) -> Model:
    """The model of the whole texts of docs (null: empty), each followed by an
    end token. Without rows: an empty model, which gives every token 1 / (V + 1)."""
    spark = docs.sparkSession
    frugal(spark)
    root = root or scratch_path(spark, "kneser-ney")
    texts = docs.select(empty_text().alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    def unigrams(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _gathered(parts):
            token, _, _ = tokens_of(some)
            at, count, _ = distinct(token)
            token = token[at]
            bucket = (mix(token) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            token, count = token[order], count[order].astype("<u4")
            yield pd.DataFrame([(b, planes(token[i:j]), planes(count[i:j])) for b, i, j in _sliced(bucket[order])], columns=["bucket", "keys", "counts"])

    def added(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        token = np.concatenate([unplanes(x, U) for x in part["keys"]])
        count = np.concatenate([unplanes(x, "<u4") for x in part["counts"]]).astype(np.int64)
        order, at = sorted_runs(token)
        token, count = token[order][at], np.add.reduceat(count[order], at)
        top = np.argsort(-count)[:HOT]
        return pd.DataFrame({"bucket": [key[0]], "n": [int(count.sum())], "v": [len(token)], "keys": [planes(token)], "counts": [planes(count)], "top": [token[top].view(np.int64)], "top_n": [count[top]]})

    counted = written(texts.mapInPandas(unigrams, "bucket long, keys binary, counts binary").groupBy("bucket").applyInPandas(added, "bucket long, n long, v long, keys binary, counts binary, top array<long>, top_n array<long>"), "unigrams")
    sums = counted.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    total, vocabulary = sums["n"] or 0, sums["v"] or 0
    tops = counted.select(F.explode(F.arrays_zip("top", "top_n")).alias("t")).filter(F.col("t.top_n") * HOT > total)
    hot = tuple(sorted(r[0] for r in tops.select("t.top").collect()))  # fewer than HOT rows
    hot_array = np.array([*hot, np.array([BEGIN], U).view(np.int64)[0]], np.int64).view(U)

    def bigrams(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _gathered(parts):
            token, before, _ = tokens_of(some)
            at, count, _ = distinct(pair_key(before, token))
            before, token = before[at], token[at]
            bucket = pair_bucket(before, token, hot_array, buckets)
            order = np.lexsort((before, bucket))
            before, token, count = before[order], token[order], count[order].astype("<u4")
            found = []
            for b, i, j in _sliced(bucket[order]):
                start = np.flatnonzero(np.concatenate(([True], before[i + 1 : j] != before[i : j - 1])))
                runs = np.diff(np.concatenate((start, [j - i]))).astype("<u4")
                found.append((b, planes(before[i:j][start]), planes(runs), planes(token[i:j]), planes(count[i:j])))
            yield pd.DataFrame(found, columns=["bucket", "contexts", "runs", "tokens", "counts"])

    def pair_shard(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        before = np.concatenate([np.repeat(unplanes(x, U), unplanes(r, "<u4")) for x, r in zip(part["contexts"], part["runs"], strict=True)])
        token = np.concatenate([unplanes(x, U) for x in part["tokens"]])
        count = np.concatenate([unplanes(x, "<u4") for x in part["counts"]]).astype(np.int64)
        order, at = sorted_runs(pair_key(before, token))
        keys = pair_key(before[order][at], token[order][at])
        before, token, count = before[order][at], token[order][at], np.add.reduceat(count[order], at)
        name = f"pairs-{key[0]:06d}-{uuid.uuid4().hex}.bin"
        _write(root, name, high=(keys >> U(32)).astype("<u4"), low=(keys >> U(16)).astype("<u2"), count=np.minimum(count, 255).astype("u1"))
        big = np.flatnonzero(count >= 255)
        found = []
        order, at = sorted_runs(before)
        own, c = before[order][at], count[order]
        stats = np.stack([np.add.reduceat(c, at), np.add.reduceat(c == 1, at, dtype=np.int64), np.add.reduceat(c == 2, at, dtype=np.int64), np.add.reduceat(c >= 3, at, dtype=np.int64)])
        follow, many, _ = distinct(token)
        for kind, word, values in (("h", own, stats), ("w", token[follow], many[None])):
            bucket = (mix(word) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            word, values = word[order], values[:, order]
            found += [(kind, b, planes(word[i:j]), planes(np.ascontiguousarray(values[:, i:j]).reshape(-1)), None, 0, None, None, None) for b, i, j in _sliced(bucket[order])]
        of = [int((count == k).sum()) for k in (1, 2, 3, 4)]
        found.append(("s", int(key[0]), None, None, name, len(keys), of, big, count[big]))
        return pd.DataFrame(found, columns=["kind", "bucket", "keys", "values", "name", "n", "of", "big", "big_n"])

    pairs = texts.mapInPandas(bigrams, "bucket long, contexts binary, runs binary, tokens binary, counts binary")
    told = written(pairs.groupBy("bucket").applyInPandas(pair_shard, "kind string, bucket long, keys binary, values binary, name string, n long, of array<long>, big array<long>, big_n array<long>"), "bigrams")
    shards = written(told.filter("kind = 's'").select("bucket", "name", "n", "of", "big", "big_n"), "shards")
    of = shards.select(F.sum("n"), *[F.sum(F.col("of")[k]) for k in range(4)]).first()
    distinct_pairs = of[0] or 0

    def word_shard(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        own = part[part["kind"] == "u"]
        word = np.sort(np.concatenate([np.empty(0, U), *(unplanes(x, U) for x in part["keys"])]))
        word = word[np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))]
        table = np.zeros((6, len(word)), np.int64)
        for kind, rows in (("u", slice(0, 1)), ("h", slice(1, 5)), ("w", slice(5, 6))):
            own = part[part["kind"] == kind]
            for keys, values in zip(own["keys"], own["values"], strict=True):
                at = np.searchsorted(word, unplanes(keys, U))
                table[rows, at] += unplanes(values, np.int64).reshape(-1, len(at))
        name = f"words-{key[0]:06d}-{uuid.uuid4().hex}.bin"
        table[1] = np.maximum(table[0], table[1])
        columns = dict(zip(list(_WORD)[1:], table[1:], strict=True))
        _write(root, name, key=word, **{k: x.astype(_WORD[k]) for k, x in columns.items()})
        contexts = columns["contexts"]
        of = [int((contexts == k).sum()) for k in (1, 2, 3, 4)] + [int((contexts >= 3).sum())]
        return pd.DataFrame({"bucket": [key[0]], "name": [name], "n": [len(word)], "of": [of]})

    by_word = told.filter("kind <> 's'").select("kind", "bucket", "keys", "values")
    by_word = by_word.unionByName(counted.select(F.lit("u").alias("kind"), "bucket", "keys", F.col("counts").alias("values")))
    named = written(by_word.groupBy("bucket").applyInPandas(word_shard, "bucket long, name string, n long, of array<long>"), "words")
    forget(told, counted)
    low = [x or 0 for x in named.select(*[F.sum(F.col("of")[k]) for k in range(5)]).first()]
    d, d1 = discounts([x or 0 for x in of[1:]]), discounts(low[:4])
    rest = (d1[0] * low[0] + d1[1] * low[1] + d1[2] * low[4]) / distinct_pairs if distinct_pairs else 1.0
    return Model(root, shards.drop("of"), named.drop("of"), buckets, hot, total, vocabulary, distinct_pairs, d, d1, rest)


def score(docs: DataFrame, model: Model, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *also, n_tokens, n_known, base_score, score) of each row of docs.

    n_tokens: words of the whole text and an end. n_known: those that training
    has. base_score: add-one unigrams. score: log10 probability under the model.
    A null text is empty: an end alone. No rows give none. `also`: columns that
    come along, of types that pandas keeps as they are."""
    frugal(docs.sparkSession)
    rows, _ = dealt(docs, GROUP_BYTES, also)
    root, buckets, d, d1, rest = model.root, model.buckets, model.discounts, model.low_discounts, model.low_rest
    uniform, pairs = 1.0 / (model.vocabulary + 1), max(1, model.pairs)
    floor = float(model.tokens + model.vocabulary + 1)
    hot = np.array([*model.hot, np.array([BEGIN], U).view(np.int64)[0]], np.int64).view(U)

    def questions(texts: list[str]) -> dict:
        """Distinct words, then distinct bigrams, each ordered by bucket and key."""
        token, before, begin = tokens_of(texts)
        out = {"begin": begin}
        for kind, keys in (("w", np.concatenate((token, before[begin[:-1]][:1]))), ("p", pair_key(before, token))):
            at, _, rank = distinct(keys)
            if kind == "w":
                bucket = (mix(keys[at]) % U(buckets)).astype(np.int64)
            else:
                bucket = pair_bucket(before[at], token[at], hot, buckets)
                out["pair_of"] = (before[at], token[at])
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(at), np.int64)
            place[order] = np.arange(len(at))
            out[kind] = (keys[at][order], bucket[order], place[rank])
            if kind == "p":
                out["pair_of"] = tuple(x[order] for x in out["pair_of"])
        return out

    def ask(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        asked, found = questions(part["text"].tolist()), []
        for kind in ("w", "p"):
            keys, bucket, _ = asked[kind]
            keys = keys & _ASKED if kind == "p" else keys
            found += [(kind, b, int(key[0]), planes(keys[i:j])) for b, i, j in _sliced(bucket)]
        return pd.DataFrame(found, columns=["kind", "bucket", "pid", "keys"])

    def answer(key: tuple, part: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        kind, found = key[0], []
        name, n = (shard["name"].iloc[0], int(shard["n"].iloc[0])) if len(shard) else ("", 0)
        with _mapped(root, name, n, _WORD if kind == "w" else _PAIR) if n else contextlib.nullcontext(None) as table:
            for pid, keys in zip(part["pid"], part["keys"], strict=True):
                keys = unplanes(keys, U)
                if table is None:
                    at, ok = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
                else:
                    at, ok = _find(table, keys) if kind == "p" else (np.minimum(np.searchsorted(table["key"], keys), n - 1), None)
                    ok = table["key"][at] == keys if ok is None else ok
                get = lambda k: np.where(ok, table[k][at], 0) if table is not None else np.zeros(len(keys), np.int64)  # noqa: B023, E731
                if kind == "p":
                    count = get("count").astype("<u4")
                    big = np.flatnonzero(count == 255)
                    if len(big):
                        count[big] = shard["big_n"].iloc[0][np.searchsorted(shard["big"].iloc[0], at[big])]
                    values = planes(count)
                else:
                    count = get("count")
                    left = d[0] * get("one") + d[1] * get("two") + d[2] * get("more")
                    back = np.where(count > 0, left / np.maximum(count, 1), 1.0)
                    values = planes(count.astype("<i8")) + planes(get("contexts").astype("<u4")) + planes(back.astype("<f4"))
                found.append((kind, int(key[1]), pid, values))
        return pd.DataFrame(found, columns=["kind", "bucket", "pid", "values"])

    names = ["doc_id", *also, "n_tokens", "n_known", "base_score", "score"]

    def use(key: tuple, part: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        asked = questions(part["text"].tolist())
        told = told.sort_values("bucket")
        blobs = {k: told[told["kind"] == k]["values"] for k in ("w", "p")}
        pair_count = np.concatenate([unplanes(x, "<u4") for x in blobs["p"]]).astype(np.int64)
        cut = lambda i, j, kind: np.concatenate([unplanes(x[i * len(x) // 4 : j * len(x) // 4], kind) for x in blobs["w"]])
        count, back = cut(0, 2, "<i8"), cut(3, 4, "<f4").astype(np.float64)
        low = discounted(cut(2, 3, "<u4").astype(np.int64), d1) / pairs + rest * uniform
        words_asked, _, at = asked["w"]
        order = np.argsort(words_asked)
        place = lambda x: order[np.searchsorted(words_asked[order], x)]
        h, w = (place(x) for x in asked["pair_of"])
        p = np.where(count[h] > 0, discounted(pair_count, d) / np.maximum(count[h], 1), 0.0) + back[h] * low[w]
        begin = asked["begin"]
        per_token = np.log10(p)[asked["p"][2]]
        n = count[at[: begin[-1]]]
        sums = [np.add.reduceat(x, begin[:-1]) for x in ((n > 0).astype(np.int64), np.log10((n + 1) / floor), per_token)]
        out = {"doc_id": whole_ids(part["doc_id"], part["no_id"]), **{c: part[c] for c in also}, "n_tokens": np.diff(begin)}
        return pd.DataFrame(out | dict(zip(names[-3:], sums, strict=True)))[names]

    groups = rows.groupBy("pid")
    asked = groups.applyInPandas(ask, "kind string, bucket long, pid int, keys binary")
    stored = model.bigrams.withColumn("kind", F.lit("p")).unionByName(model.words.withColumn("kind", F.lit("w")), allowMissingColumns=True)
    answers = asked.groupBy("kind", "bucket").cogroup(stored.groupBy("kind", "bucket")).applyInPandas(_only_asked(answer), "kind string, bucket long, pid int, values binary")
    kinds = dict(rows.dtypes)
    schema = ", ".join(["doc_id long", *(f"{c} {kinds[c]}" for c in also), "n_tokens long, n_known long, base_score double, score double"])
    return groups.cogroup(answers.groupBy("pid")).applyInPandas(use, schema)


def _only_asked(answer):
    """Shards that nobody asks for need no answer."""

    def maybe(key: tuple, part: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        return answer(key, part, shard) if len(part) else part.assign(values=part["keys"])[["kind", "bucket", "pid", "values"]]

    return maybe


def fold(column: str = "doc_id", folds: int = 7):
    """crc32 of the doc_id as text, modulo folds; a null doc_id is the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


__all__ = ["Model", "fold", "score", "train"]
