"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram
model of trusted text, against language-specific quantiles.

The model's symbols are the bytes of words and an end of word; a word that
repeats the one before it is one symbol of its own. Contexts stay within a word; so
a document's probability is a sum over its words, and a group of documents scores
each distinct word once. The model is fitted on all
documents labelled good and not toxic, whole texts: one half, by hash of doc_id,
gives the counts, the other half the means and quantiles, for a text is likelier
under a model that has counted it.

The n-gram counts are DataFrames, joined and aggregated by key. For scoring they
lie in shards; a group of documents asks the shards for its distinct n-grams and
contexts, so no worker holds the model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import dealt, empty_text, free_names, frugal, planes, small, trimmed, unplanes, written
from jobloom.llm.kneser_ney import discounts
from jobloom.llm.textvec import _slices
from jobloom.llm.tokens import release

ORDER = 4
#: Least shards of the model, n-grams of a shard, and groups that ask one copy of one
#: of SHARDS; more shards take fewer copies. So a task's n-grams and questions stay as
#: many however large the corpus and the model are.
SHARDS, SHARD_GRAMS, GROUPS_A_COPY = 16, 1 << 19, 512
GROUP_BYTES = 2 << 20
#: Symbols that every document has besides its own, at its language's mean.
PRIOR = 60
#: A document goes if its mean log-probability lies below the median of trusted
#: held-out documents by more than FENCE times the distance from there to LOW.
LOW, FENCE = 0.02, 3.0
#: Languages with fewer held-out documents have no threshold: all of theirs are kept.
LEAST = 30
_BITS, _END = 9, 257
#: Stands for a word that repeats the one before it; no UTF-8 text holds this byte.
_AGAIN = b"\xff"
#: All digits are one symbol.
_DIGITS = bytes(48 if 48 <= b < 58 else b for b in range(256))
U = np.uint64


def distinct_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last symbol of each word, word of each place in the texts, first
    place of each text). symbols: of the distinct words, ORDER - 1 zeros before
    each and the end behind; bytes are 1 to 256."""
    release()
    places, firsts, memo, at = [], [np.zeros(1, np.int64)], {}, 0
    for raw in _slices(texts):
        for text in raw:
            own = text.translate(_DIGITS).split()
            own = [_AGAIN if w == v else w for v, w in zip([None, *own], own, strict=False)]
            places += [memo.setdefault(w, len(memo)) for w in own]
            at += len(own)
            firsts.append([at])
    raws = list(memo)
    size = np.array([len(w) for w in raws], np.int64)
    ends = np.cumsum(size + ORDER)
    symbols = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    symbols[ends - 1] = _END
    data = np.frombuffer(b"".join(raws), np.uint8).astype(np.int64) + 1
    inner = np.ones(len(symbols), bool)
    inner[ends - 1] = False
    for k in range(ORDER - 1):
        inner[ends - size - ORDER + k] = False
    symbols[inner] = data
    return symbols, ends - 1, np.array(places, np.int64), np.concatenate(firsts).astype(np.int64)


def grams(symbols: np.ndarray) -> list[np.ndarray]:
    """Of every place the packed k-gram that ends there, k from 0 to ORDER."""
    out, n = [np.zeros(len(symbols), np.int64)], len(symbols)
    for k in range(1, ORDER + 1):
        own = np.zeros(n, np.int64)
        own[k - 1 :] = (out[-1][k - 2 : n - 1] << _BITS) | symbols[k - 1 :] if k > 1 else symbols
        out.append(own)
    return out


def _unlike(keys: np.ndarray) -> np.ndarray:
    """Distinct keys, sorted."""
    keys = np.sort(keys)
    return keys[np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))] if len(keys) else keys


def _tagged(gram, k: int):
    return gram + (k << 56)


def asked(texts: list[str]):
    """(symbols, places with a symbol, last, places, first, grams, every): every is the
    distinct tagged n-grams and contexts of the texts. Those of one order are an
    array of their own only until they are distinct, for a worker holds few arrays."""
    symbols, last, places, first = distinct_words(texts)
    ok, each = np.flatnonzero(symbols), grams(symbols)
    every = _unlike(np.concatenate([_unlike(of(each, ok, k)) for k in range(1, ORDER + 1) for of in (_own, _before)]))
    return symbols, ok, last, places, first, each, every


def _own(each: list[np.ndarray], ok: np.ndarray, k: int) -> np.ndarray:
    return _tagged(each[k][ok], k)


def _before(each: list[np.ndarray], ok: np.ndarray, k: int) -> np.ndarray:
    """The contexts of _own."""
    return _tagged(each[k - 1][ok - 1], k - 1)


def train(texts: DataFrame) -> DataFrame:
    """(key, alpha, gamma) of texts (text): alpha of an n-gram after its context,
    gamma of a context. Without text the table is empty, and every symbol has the
    same probability."""
    frugal(texts.sparkSession)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            symbols, last, places, _ = distinct_words(part["text"].tolist())
            if not len(places):
                continue
            times = np.bincount(places, minlength=len(last))
            word = np.searchsorted(last, np.arange(len(symbols)))
            ok = symbols > 0
            keys, back = np.unique(grams(symbols)[ORDER][ok], return_inverse=True)
            yield pd.DataFrame({"gram": keys, "n": np.bincount(back, times[word[ok]]).astype(np.int64)})

    top = written(texts.select(empty_text().alias("text")).mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    level, parts = top, []
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            level = written(level.groupBy(F.col("gram").bitwiseAND((1 << _BITS * k) - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams")
        of = level.agg(*[F.count_if(F.col("n") == c).alias(f"c{c}") for c in (1, 2, 3, 4)]).first()
        d = discounts(list(of))
        cut = F.col("n") - F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        after = level.withColumn("context", F.shiftright("gram", _BITS))
        stats = after.groupBy("context").agg(F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two"), F.count_if(F.col("n") > 2).alias("more"))
        nothing = F.lit(None).cast("double")
        parts.append(after.join(stats, "context").select(_tagged(F.col("gram"), k).alias("key"), (cut / F.col("total")).alias("alpha"), nothing.alias("gamma")))
        left = (d[0] * F.col("one") + d[1] * F.col("two") + d[2] * F.col("more")) / F.col("total")
        parts.append(stats.select(_tagged(F.col("context"), k - 1).alias("key"), nothing.alias("alpha"), left.alias("gamma")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return written(every.groupBy("key").agg(F.max("alpha").alias("alpha"), F.max("gamma").alias("gamma")), "model")


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, body, lang, symbols, log10): of each row of docs the number of
    symbols and their log10 probability. body: hash of the text."""
    frugal(docs.sparkSession)
    rows, n_groups = dealt(docs, GROUP_BYTES, ("lang",))
    shards = max(SHARDS, -(-model.count() // SHARD_GRAMS))
    copies = -(-n_groups * SHARDS // (GROUPS_A_COPY * shards))
    rows = rows.withColumn("body", F.xxhash64("text"))
    groups = rows.groupBy("pid")

    @trimmed
    def ask(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        every = asked(part["text"].tolist())[-1]
        shard = _shard(every, shards)
        return pd.DataFrame([(s, int(key[0]) % copies, int(key[0]), planes(every[shard == s])) for s in range(shards)], columns=["shard", "copy", "pid", "keys"])

    @trimmed
    def answer(key: tuple, part: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("key")
        key, alpha, gamma = (table[c].to_numpy() for c in ("key", "alpha", "gamma"))
        found = []
        for pid, keys in zip(part["pid"], part["keys"], strict=True):
            keys = unplanes(keys, np.int64)
            at = np.minimum(np.searchsorted(key, keys), max(0, len(key) - 1))
            ok = key[at] == keys if len(key) else np.zeros(len(keys), bool)
            found.append((pid, planes(keys[ok]), alpha[at[ok]].astype("<f8").tobytes(), gamma[at[ok]].astype("<f8").tobytes()))
        return pd.DataFrame(found, columns=["pid", "keys", "alpha", "gamma"])

    @trimmed
    def use(key: tuple, part: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        symbols, ok, last, places, first, each, every = asked(part["text"].tolist())
        table = np.concatenate([np.empty(0, np.int64), *(unplanes(x, np.int64) for x in told["keys"])])
        alpha, gamma = (np.concatenate([np.empty(0), *(np.frombuffer(x, "<f8") for x in told[c])]) for c in ("alpha", "gamma"))
        at = np.searchsorted(every, table)
        full_a, full_g = np.zeros(len(every)), np.ones(len(every))
        full_a[at], full_g[at] = np.nan_to_num(alpha), np.where(np.isnan(gamma), 1.0, gamma)
        p = np.full(len(ok), 1.0 / _END)
        for k in range(1, ORDER + 1):
            p = full_a[np.searchsorted(every, _own(each, ok, k))] + full_g[np.searchsorted(every, _before(each, ok, k))] * p
        flat = np.zeros(len(symbols))
        flat[ok] = np.log10(p)
        total = np.diff(np.concatenate(([0.0], np.cumsum(flat)[last]))) if len(last) else np.empty(0)
        size = np.diff(np.concatenate(([-1], last))) - (ORDER - 1)
        sums = [np.concatenate(([0], np.cumsum(x[places]) if len(places) else [])) for x in (size, total)]
        n, logs = (x[first[1:]] - x[first[:-1]] for x in sums)
        return pd.DataFrame({"doc_id": part["doc_id"], "no_id": part["no_id"], "body": part["body"], "lang": part["lang"], "symbols": n.astype(np.int64), "log10": logs.astype(np.float64)})

    shard = F.pmod(F.shiftright("key", 3).bitwiseXOR(F.col("key")), F.lit(shards)).cast("int")
    stored = model.withColumn("shard", shard).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    questions = groups.applyInPandas(ask, "shard int, copy int, pid int, keys binary")
    told = questions.groupBy("shard", "copy").cogroup(stored.groupBy("shard", "copy")).applyInPandas(answer, "pid int, keys binary, alpha binary, gamma binary")
    out = groups.cogroup(told.groupBy("pid")).applyInPandas(use, "doc_id long, no_id boolean, body long, lang string, symbols long, log10 double")
    return out.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> 3) ^ keys) % shards


def _other_half():
    return F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(2)) == 1


def trusted_sample(docs: DataFrame, labels: DataFrame, trusted: int | None = None) -> DataFrame:
    """(doc_id, held) of all labelled good documents; not held: half of them, or half
    of a draw of about `trusted` a language."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).filter("q = 1 and t = 0")
    if trusted is None:
        return written(docs.select("doc_id").join(good.select("doc_id"), "doc_id").groupBy("doc_id").agg(F.max(_other_half()).alias("held")), "trusted")
    known = written(docs.select("doc_id", "lang").join(good.select("doc_id"), "doc_id"), "labelled")
    share = known.groupBy("lang").agg((trusted / F.count(F.lit(1))).alias("share"))
    share = written(share.withColumnRenamed("lang", "_lang"), "shares")
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20))
    rows = known.join(small(share), F.col("lang").eqNullSafe(F.col("_lang")))
    held = (draw >= F.col("share") * (1 << 20)) | _other_half()
    return written(rows.groupBy("doc_id").agg(F.min(held).alias("held")), "trusted")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, body, lang, symbols, mean_log10, perplexity, threshold, kept) of
    each row of docs.

    mean_log10: mean log10 probability of a symbol, with PRIOR more at the mean of
    the language's trusted text, so that a few words say little. kept: it is not
    below threshold. Texts without words (null ones too) are kept: they have the
    mean. A null language is a language of its own. Labels that are null, or of
    unknown documents, count for nothing; several labels of one document must all
    be good. A language with fewer than LEAST held-out trusted documents keeps
    everything, with threshold null (and the mean of all); so does every language
    without trusted documents.
    """
    sample = trusted_sample(docs, labels)
    # filtered by the hash too: where there are too many to be broadcast, fewer texts are shuffled
    texts = docs.select("doc_id", "text").filter(~_other_half()).join(small(sample.filter("not held")), "doc_id").select("text")
    model = train(texts)
    scored = written(score(docs, model), "scored")
    base = scored.join(small(sample.filter("held")), "doc_id").filter("symbols > 0")
    means = base.groupBy("lang").agg((F.sum("log10") / F.sum("symbols")).alias("mu"), F.count(F.lit(1)).alias("docs"))
    overall = base.agg((F.sum("log10") / F.sum("symbols")).alias("mu")).first()["mu"]
    means = written(means.select(F.col("lang").alias("_lang"), F.when(F.col("docs") >= LEAST, F.col("mu")).alias("mu")), "means")
    mu = F.coalesce("mu", F.lit(overall), F.lit(0.0))
    smooth = (F.col("log10") + PRIOR * mu) / (F.col("symbols") + PRIOR)
    with_mean = lambda rows: rows.join(small(means), F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn("mean_log10", smooth).drop("_lang", "mu")
    base = written(with_mean(base), "held")
    cuts = lambda rows: rows.agg(F.percentile_approx("mean_log10", F.array(F.lit(0.5), F.lit(LOW)), F.lit(10_000)).alias("q"), F.count(F.lit(1)).alias("docs"))
    fence = F.col("q")[0] - FENCE * (F.col("q")[0] - F.col("q")[1])
    own = cuts(base.groupBy("lang")).filter(F.col("docs") >= LEAST).select(F.col("lang").alias("_lang"), fence.alias("threshold"))
    own = written(own, "fences")
    out = with_mean(scored).join(small(own), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    out = out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("mean_log10")))
    return out.withColumn("kept", F.coalesce(F.col("mean_log10") >= F.col("threshold"), F.lit(True))).select("doc_id", "body", "lang", "symbols", "mean_log10", "perplexity", "threshold", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that judged() keeps, all their columns unchanged, whatever
    their names."""
    name, body = free_names(docs.columns, "_gone", "_body")
    gone = written(judged(docs, labels).filter(~F.col("kept")).select(F.col("doc_id").alias(name), F.col("body").alias(body)).distinct(), "rejected")
    on = F.col("doc_id").eqNullSafe(F.col(name)) & (F.xxhash64(empty_text()) == F.col(body))
    return docs.join(gone, on, "left_anti")


__all__ = ["judged", "keep_good", "score", "train", "trusted_sample"]
