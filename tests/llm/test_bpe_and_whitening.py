import collections
import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobloom.llm import bpe, queries, whitening

ODD = [*" \n\t ab'sSé̈漢한1.!|\x1c　\xa0\x85İıßẞ²ǅΣς_<>", "<|endoftext|>", "<|startoftext|>", "<|endof"]


def odd_rows():
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["the same words again " * 30000, "x" * 5000, "", "", None, None, " ", "\n", "one", "one", "a  b", " a", "a "]
    rows = [(i, t, "clash", 5) for i, t in enumerate(texts)]
    rows += [(3, "again with the id three", None, None), (None, "no id", "x", 1), (None, None, None, None), *[(7, texts[7], "x", 1)] * 20, (-(2**62) - 1, "far id", None, 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_is_the_tokenizer(spark, name):
    path, rows = public_tokenizers.path(name), odd_rows()
    plain = Tokenizer.from_file(path)
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, pid int").repartition(3)
    out = bpe.decode(bpe.encode(docs, path, group_bytes=20_000).withColumn("TEXT", F.lit("old")), path)
    assert out.columns == ["doc_id", "ids", "text"]
    want = collections.Counter()
    for i, text, *_ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        want[i, tuple(ids), plain.decode(ids, skip_special_tokens=False)] += 1
    assert collections.Counter((r.doc_id, tuple(r.ids), r.text) for r in out.collect()) == want


def test_bpe_of_special_strings_as_text_and_of_no_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "<|startoftext|>")], "doc_id long, text string")
    assert {r.doc_id: r.ids for r in bpe.encode(docs, path, special=False).collect()} == {i: plain.encode(t, add_special_tokens=False).ids for i, t in docs.collect()}
    assert bpe.decode(bpe.encode(docs.limit(0), path), path).count() == 0


def test_every_word_is_encoded_once():
    """Each distinct word of all groups reaches the encoder in one place."""
    rows = [(i, " ".join(random.Random(i).choices([f"w{k}" for k in range(50)], k=40))) for i in range(200)]
    blobs = [bpe._squeeze(bpe._SEP.join(t.encode() for _, t in rows[k::5])) for k in range(5)]
    asked = [bpe._asked([b], True, 7) for b in blobs]
    for bucket in range(7):
        for other in range(bucket):
            assert not {w for a in asked for w in a[bucket]} & {w for a in asked for w in a[other]}
    assert {w for a in asked for b in a for w in b} == {w.encode() for _, t in rows for w in t.split()}


def test_decoding_of_any_ids(spark):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        plain, rng = Tokenizer.from_file(path), random.Random(9)
        every = [i for i, p in enumerate(bpe.pieces(path)[0]) if p is not None]
        lists = [[rng.choice(every) for _ in range(rng.randrange(6))] for _ in range(300)] + [[0], []]
        rows = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "doc_id long, ids array<int>")
        assert {r.doc_id: r.text for r in bpe.decode(rows, path).collect()} == {k: plain.decode(x, skip_special_tokens=False) for k, x in enumerate(lists)}
    odd = spark.createDataFrame([(1, [320, None, 10**8, -1, 320]), (2, None)], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode(odd, public_tokenizers.path("word_bpe_49k.json")).orderBy("doc_id").collect()] == ["a</w> a</w>", ""]


def test_op12_query(spark, small_dir):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_bpe_round_trip(spark, small_dir).collect()}
    sha, want = (lambda x: hashlib.sha256(x.encode()).hexdigest()), set()
    for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(plain.decode(ids, skip_special_tokens=False))))
    assert got == want


def exact(vectors):
    """(n, deviations, covariance as fractions) of vectors, entry by entry."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, size = len(x), len(x[0])
    total = [sum(v[k] for v in x) for k in range(size)]
    deviation = [sum((n * v[k] - total[k]) ** 2 for k in range(size)) for v in x]
    centred = [[v[k] - Fraction(total[k], n) for k in range(size)] for v in x]
    return n, deviation, [[sum(v[i] * v[j] for v in centred) / n for j in range(size)] for i in range(size)], centred


@pytest.mark.parametrize("far", [1.0, 1e7, 1e15])
def test_whitening_is_exact(spark, far):
    rng = np.random.default_rng(4)
    mixed = rng.normal(size=(90, 6)) @ rng.normal(size=(6, 6)) * far
    rows = [(i, v.tolist(), 7, "x") for i, v in enumerate(mixed)] + [(90, mixed[0].tolist(), 1, None), (None, mixed[1].tolist(), 1, None)]
    bad = [(100, None, 1, "x"), (101, [1.0, None] + [0.0] * 4, 1, "x"), (102, [float("nan")] * 6, 1, "x"), (103, [float("inf")] * 6, 1, "x")]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, Whitened int, _c string").repartition(4)
    out, model, error = whitening.whiten(table)
    assert out.columns == ["vec_id", "embedding", "_c", "deviation", "whitened"]
    n, deviation, v, centred = exact([r[1] for r in rows])
    assert (model.n, n) == (len(rows), len(rows)) and error < 1e-9
    got = out.collect()
    want = collections.Counter((r[0], d if d < 1 << 63 else None) for r, d in zip(rows, deviation, strict=True))
    assert collections.Counter((r.vec_id, r.deviation) for r in got) == want
    cov = np.array([[float(x) for x in row] for row in v])
    assert np.allclose(cov @ model.axes, model.axes * model.values, rtol=0, atol=1e-12 * model.trace)
    assert all(np.diff(model.values) <= 0) and abs(model.trace - float(sum(v[k][k] for k in range(6)))) < 1e-12 * model.trace
    exactly = {r[0]: np.array([float(x) for x in c]) for r, c in zip(rows, centred, strict=True)}
    for r in got:
        assert np.allclose(r.whitened, exactly[r.vec_id] @ model.axes / np.sqrt(model.values), atol=1e-9)
    report = whitening.report(out, model, error).collect()
    assert len(report) == 6 * len(rows) and {r.n for r in report} == {len(rows)}
    shares = {r.component: r.explained for r in report}
    assert abs(sum(shares.values()) - 1) < 1e-9 and sorted(shares) == [1, 2, 3, 4, 5, 6]


def test_sums_of_large_integers():
    rng = random.Random(1)
    y = np.array([[rng.randrange(-(2**62), 2**62) for _ in range(4)] for _ in range(60)] + [[-(2**62), 2**62 - 1, -1, 0]], np.int64)
    own = y.astype(object)
    assert (whitening.cross_products(y) == own.T @ own).all() and (whitening.sums(y) == own.sum(axis=0)).all()


def test_whitening_of_odd_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for rows in ([], [(1, None)], [(1, [])]):
        out, model, error = whitening.whiten(make(rows))
        assert model is None and error == 0.0 and whitening.report(out, model, error).count() == 0
    same, model, error = whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    assert [r.whitened for r in same.collect()] == [[None, None]] * 2 and error == 0.0 and {r.deviation for r in same.collect()} == {0}
    flat, model, error = whitening.whiten(make([(1, [1.0, 5.0]), (2, [3.0, 5.0]), (3, [1.0])]))  # the last is (1, 0)
    assert error < 1e-12 and all(None not in r.whitened for r in flat.collect())
    line, model, error = whitening.whiten(make([(i, [float(i), 2.0 * i]) for i in range(5)]))
    assert error < 1e-9 and all(r.whitened[0] is not None and r.whitened[1] is None for r in line.collect())
    assert {r.component for r in whitening.report(line, model, error).collect()} == {1, 2}


def test_whitening_has_up_to_32_components(spark, small_dir):
    rows = queries.op11_embedding_whitening(spark, small_dir).collect()
    vectors = [r for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect() if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    assert len(rows) == 32 * len(vectors) and max(r.identity_error for r in rows) < 1e-9
    n, deviation, v, _ = exact([r.embedding for r in vectors])
    assert {(r.vec_id, r.n, r.deviation) for r in rows} == {(r.vec_id, n, d) for r, d in zip(vectors, deviation, strict=True)}
    values = np.linalg.eigvalsh(np.array([[float(x) for x in row] for row in v]))[::-1]
    shares = {r.component: r.explained for r in rows}
    assert all(abs(shares[k + 1] / (values[k] / values.sum()) - 1) < 1e-9 for k in range(32))
