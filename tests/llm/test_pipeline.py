"""The stages of the pipeline and the classifier's model, against plain versions."""

import collections
import math
import random
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from jobloom.llm import kneser_ney, quality
from test_operators import brute_components, brute_targets, odd_documents, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


class PlainModel:
    """Interpolated modified Kneser-Ney over the symbols of words."""

    def __init__(self, texts):
        counts = collections.Counter()
        for text in texts:
            for own in symbols(text):
                padded = (0, 0, 0, *own)
                counts.update(padded[i - 3 : i + 1] for i in range(3, len(padded)))
        self.levels = []
        for k in (4, 3, 2, 1):
            if k < 4:
                counts = collections.Counter(g[1:] for g in counts)
            d = (0, *kneser_ney.discounts([sum(n == c for n in counts.values()) for c in (1, 2, 3, 4)]))
            total, left = collections.Counter(), collections.Counter()
            for g, n in counts.items():
                total[g[:-1]] += n
                left[g[:-1]] += d[min(n, 3)]
            self.levels.insert(0, (counts, d, total, left))

    def log10(self, text):
        out, n = 0.0, 0
        for own in symbols(text):
            padded = (0, 0, 0, *own)
            for i in range(3, len(padded)):
                p = 1 / 257
                for k, (counts, d, total, left) in enumerate(self.levels):
                    h = padded[i - k : i]
                    if total[h]:
                        c = counts[*h, padded[i]]
                        p = (c - d[min(c, 3)]) / total[h] + left[h] / total[h] * p
                out, n = out + math.log10(p), n + 1
        return n, out


def symbols(text):
    own = re.sub(rb"[0-9]", b"0", (text or "").encode()).split()
    return [[256, 257] if v == w else [*(b + 1 for b in w), 257] for v, w in zip([None, *own], own)]


def plain_judged(rows, held):
    """(doc_id, lang, symbols, mean, threshold, kept) of rows; held: of trusted
    doc_ids, False for those of the training half."""
    model = PlainModel(t for i, t, _ in rows if held.get(i) is False)
    scored = [(i, lang, *model.log10(t)) for i, t, lang in rows]
    base = collections.defaultdict(list)
    for i, lang, n, log in scored:
        if held.get(i) and n:
            base[lang].append((n, log))
    ratio = lambda x: sum(log for _, log in x) / sum(n for n, _ in x)
    every = [x for own in base.values() for x in own]
    overall = ratio(every) if every else 0.0
    mu = {lang: ratio(own) for lang, own in base.items() if len(own) >= quality.LEAST}
    mean = lambda lang, n, log: (log + quality.PRIOR * mu.get(lang, overall)) / (n + quality.PRIOR)
    fence = {}
    for lang in mu:
        own = sorted(mean(lang, n, log) for n, log in base[lang])
        mid, low = (own[max(0, math.ceil(q * len(own)) - 1)] for q in (0.5, quality.LOW))
        fence[lang] = mid - quality.FENCE * (mid - low)
    return [(i, lang, n, mean(lang, n, log), fence.get(lang), lang not in fence or mean(lang, n, log) >= fence[lang]) for i, lang, n, log in scored]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of documents and labels: odd documents, good ones in two languages
    (one with few labels), and bad ones."""
    rng, path = random.Random(8), str(tmp_path_factory.mktemp("tables"))
    syllables = ["ta", "ri", "on", "es", "lu", "men", "é"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [r[:5] for r in odd_documents()], []
    for i in range(1000, 1260):
        text = " ".join(word() for _ in range(rng.randrange(10, 60)))
        bad = i % 7 == 0
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text, "en" if i % 10 else "de", f"s{i % 4}", 1))
        labels.append((i, 0 if bad else 1, int(i == 1001)))
    labels += [(None, 1, 0), (1002, 1, None), (99_999, 1, 0), (1003, 0, 0), (1003, 1, 0), (1004, None, 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def by_quality(spark, given, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.createDataFrame(given, SCHEMA)
    held = {r.doc_id: r.held for r in quality.trusted_sample(docs, labels).collect()}
    assert sorted(set(held.values())) == [False, True]
    want = plain_judged([(r.doc_id, r.text, r.lang) for r in given], held)
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    got = [(r.doc_id, r.lang, r.symbols, r.mean_log10, r.threshold, r.kept) for r in quality.judged(docs, labels).collect()]
    for own, plain in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert own[:3] == plain[:3] and own[5] == plain[5]
        assert own[3] == pytest.approx(plain[3], rel=1e-9)
        assert own[4] == (None if plain[4] is None else pytest.approx(plain[4], rel=1e-9))
    assert {lang for _, lang, *_, fence, _ in want if fence is not None} == {"en"}
    assert 0 < sum(not r[5] for r in want) < len(want) / 2
    return collections.Counter(r for r, own in zip(given, want, strict=True) if own[5])


def by_text(given):
    """Least doc_id of each text; a null one only where there is no other."""
    least = {}
    for r in given:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        own = (r.doc_id is None, r.doc_id or 0)
        least[body] = min(least.get(body, own), own)
    return collections.Counter((None if none else i, body) for body, (none, i) in least.items())


def by_shingles(given):
    gone = {d for d, _, least in brute_components([(r.doc_id, r.text or "") for r in given]) if d != least}
    return collections.Counter(r for r in given if r.doc_id not in gone or r.doc_id is None)


def holds_targets(given, got):
    size = lambda r: len(words(r.text or ""))
    there, taken = collections.Counter(given), collections.Counter(got)
    assert all(n <= 3 * there[r] for r, n in taken.items())
    sizes, mixed, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in given:
        sizes[r.source] += size(r)
        largest[r.source] = max(largest[r.source], size(r))
    for r in got:
        mixed[r.source] += size(r)
    for source, target in brute_targets(sizes).items():
        assert abs(mixed[source] - target) <= max(1, largest[source])


def cut(given):
    """Pieces of 2048 tokens, the first as long as is left."""
    tokenizer, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), collections.Counter()
    for r in given:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        at = [0, *(k for k in range(len(ids) % 2048, len(ids), 2048) if k)]
        for piece, (a, b) in enumerate(zip(at, [*at[1:], len(ids)])):
            out[r.doc_id, piece, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
    return out


def placed(rows):
    """Pieces of packed rows, which must lie in their sequences without gaps."""
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= math.ceil(sum(r.length for r in rows) / 2048) + 1
    return collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows)


def test_stages_against_plain_versions(spark, folder, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "pack"]
    docs, rows = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        given, out = docs.collect(), stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        rows = docs.collect()
        assert name == "pack" or out.columns == columns
        if name == "quality":
            assert collections.Counter(rows) == by_quality(spark, given, folder)
        elif name == "exact":
            assert collections.Counter((r.doc_id, re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")) for r in rows) == by_text(given)
            assert not collections.Counter(rows) - collections.Counter(given)
        elif name == "near":
            assert collections.Counter(rows) == by_shingles(given)
        elif name == "mix":
            holds_targets(given, rows)
        else:
            assert placed(rows) == cut(given)
    assert placed(corpus_pipeline.run(spark, folder).collect()) == placed(rows)


def test_pipeline_of_no_documents(spark, folder, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
