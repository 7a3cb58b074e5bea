import glob
import math
import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from jobloom.operators import lexical, text_index

SCHEMA = "id long, text string, turn int"
WORD = re.compile(r"[^\W]+")


def split(text):
    return WORD.findall((text or "").lower())


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """An index of three batches and the texts that it should hold."""
    index = text_index.TextIndex(str(tmp_path_factory.mktemp("index")), "id", "long", 8, 2)
    rng, vocabulary = random.Random(2), ["the", "alpha", "beta", "gamma", "감사", "gammas", "한국", "a", "x" * 30, "x" * 29 + "y"]
    make = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(14)))
    held = {}

    def add(rows, deleted=()):
        for i in deleted:
            held.pop(i, None)
        for i, text, turn in sorted(rows, key=lambda r: r[2]):
            held[i] = text
        gone = spark.createDataFrame([(i,) for i in deleted], "id long")
        return text_index.add_batch(spark.createDataFrame(rows, SCHEMA), index, "text", "turn", gone)

    assert add([(i, make(), 0) for i in range(60)] + [(60, None, 0), (61, "", 0), (None, "alpha of null", 0), (62, "beta beta beta", 0)]) == 0
    before = files_of(index.path)
    assert add([(i, make(), 1) for i in range(20, 40)] + [(25, "alpha beta gamma", 2), (70, "the alpha of the alpha", 1)], [1, 2, 25, 999]) == 1
    assert all(files_of(index.path)[f] == t for f, t in before.items()), "batches are never changed"
    assert add([(1, "back again alpha", 0), (None, "beta of null", 0)], [70, 30]) == 2
    return index, held


def test_bm25_is_that_of_a_fresh_index(spark, built, tmp_path):
    index, held = built
    queries = spark.createDataFrame([(1, "alpha gamma the"), (2, "감사"), (3, "unknown"), (4, ""), (5, None), (6, "beta beta")], "q long, words string")
    got = {(r.q, r.id): (r.score, r["rank"]) for r in text_index.bm25(spark, index, queries, "q", "words", 5).collect()}
    plain = {i: [w for w in split(t) if w not in lexical.STOP_WORDS] for i, t in held.items()}
    n, average = len(plain), sum(map(len, plain.values())) / len(plain)
    want = {}
    for q, text in ((1, "alpha gamma"), (2, "감사"), (6, "beta")):
        scores = []
        for i, words in plain.items():
            parts = [(words.count(w), sum(w in x for x in plain.values())) for w in text.split() if w in words]
            if parts:
                scores.append((-round(sum(math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / average)) for tf, df in parts), 6), i is not None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores)[:5], 1):
            want[q, i] = (-score, rank)
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 2e-6 and got[k][1] == want[k][1] for k in want)
    fresh = text_index.rewrite(spark, index, str(tmp_path / "fresh"))
    assert text_index.batches(spark, fresh) == [0]
    assert {(r.q, r.id): (r.score, r["rank"]) for r in text_index.bm25(spark, fresh, queries, "q", "words", 5).collect()} == got


def test_phrases_from_positions(spark, built):
    index, held = built
    asked = ["alpha", "alpha beta", "beta beta", "the alpha of the alpha", "gamma the", "감사 한국", "alpha alpha alpha", "unknown alpha", "", None, "ALPHA, Beta!"]
    queries = spark.createDataFrame(list(enumerate(asked)), "q int, words string")
    got = {(r.q, r.id): r.n for r in text_index.phrases(spark, index, queries, "q", "words").collect()}
    want = {}
    for q, text in enumerate(asked):
        words = split(text)
        for i, body in held.items():
            have = split(body)
            n = sum(have[k : k + len(words)] == words for k in range(len(have))) if words else 0
            if n:
                want[q, i] = n
    assert got == want and want[2, 62] == 2


def test_prefixes_and_fuzzy_words(spark, built):
    index, held = built
    names = ["al", "gamma", "gammas", "감", "x" * 29, "zeta", "", "bta", "gamma beat", "x" * 28 + "yx", "the"]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    got = {(r.name, r.id) for r in text_index.prefixes(spark, index, table, "name").collect()}
    assert got == {(n, i) for n in names if n for i, t in held.items() if any(w.startswith(n) for w in split(t))}

    def edits(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    for fuzziness, prefix in ((1, 1), (2, 0), ("AUTO", 1), (0, 2)):
        most = lambda w: fuzziness if not isinstance(fuzziness, str) else (0 if len(w) < 3 else 1 if len(w) < 6 else 2)  # noqa: B023, E731
        want = {
            (n, i) for n in names for w in split(n) if w not in lexical.STOP_WORDS
            for i, t in held.items() if any(v[:prefix] == w[:prefix] and edits(v, w) <= most(w) for v in split(t))
        }
        got = {(r.name, r.id) for r in text_index.fuzzy(spark, index, table, "name", fuzziness, prefix).collect()}
        assert got == want, (fuzziness, prefix)
    with pytest.raises(ValueError, match="edits"):
        text_index.fuzzy(spark, index, table, "name", 3, 1)


def test_searches_read_the_folders_of_their_words_only(spark, built, tmp_path):
    index, _ = built
    asked = spark.createDataFrame([("alpha",)], "token string")
    want = sorted(map(str, text_index.postings_of(spark, index, asked).collect()))
    copy = shutil.copytree(index.path, tmp_path / "copy")
    own = asked.select(F.pmod(F.xxhash64("token"), F.lit(8))).first()[0]
    for folder in glob.glob(f"{copy}/postings/batch=*/bucket=*"):
        if not folder.endswith(f"bucket={own}"):
            shutil.rmtree(folder)
    assert want and sorted(map(str, text_index.postings_of(spark, index._replace(path=str(copy)), asked).collect())) == want
    plan = text_index.postings_of(spark, index, asked)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (IN|=)", plan)


def test_a_batch_that_failed_is_written_again(spark, tmp_path, monkeypatch):
    index = text_index.TextIndex(str(tmp_path), "id", "long", 4, 1)
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    text_index.add_batch(make([(1, "alpha", 0), (2, "beta", 0)]), index, "text")
    live = text_index._live
    monkeypatch.setattr(text_index, "_live", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        text_index.add_batch(make([(1, "gamma", 0), (3, "delta", 0)]), index, "text")
    monkeypatch.setattr(text_index, "_live", live)
    find = lambda word: sorted(r.id for r in text_index.prefixes(spark, index, spark.createDataFrame([(word,)], "name string"), "name").collect())
    assert find("alpha") == [1] and find("delta") == []
    assert text_index.add_batch(make([(1, "epsilon", 0)]), index, "text") == 1
    assert find("alpha") == [] and find("gamma") == [] and find("delta") == [] and find("epsilon") == [1] and find("beta") == [2]


def test_an_empty_index_answers(spark, tmp_path):
    index = text_index.TextIndex(str(tmp_path), "id", "long", 4, 1)
    queries = spark.createDataFrame([(1, "alpha")], "q long, name string")
    for turn in range(2):
        assert text_index.bm25(spark, index, queries, "q", "name").count() == 0 and text_index.phrases(spark, index, queries, "q", "name").count() == 0
        assert text_index.prefixes(spark, index, queries, "name").count() == 0 and text_index.fuzzy(spark, index, queries, "name", 1, 0).count() == 0
        if not turn:
            text_index.add_batch(spark.createDataFrame([], SCHEMA), index, "text")


def test_texts_of_a_task_share_rows_of_postings(spark, tmp_path):
    """A word has a row for the texts that a task took together, not one for each text."""
    index = text_index.TextIndex(str(tmp_path), "id", "long", 4)
    text_index.add_batch(spark.createDataFrame([(i, f"the alpha beta alpha w{i}", 0) for i in range(40)] + [(90, None, 0)], SCHEMA).coalesce(1), index, "text")
    rows = {}
    for r in spark.read.parquet(f"{tmp_path}/postings").collect():
        rows.setdefault(r.token, []).append(r)
    assert len(rows["alpha"]) < 40 and {tuple(p) for r in rows["alpha"] for p in r.positions} == {(1, 3)}
    assert sorted(k for r in rows["alpha"] for k in r["keys"]) == list(range(40))
    sizes = {k: n for r in rows[""] for k, n in zip(r["keys"], r.dls, strict=True)}
    assert sizes == {i: 4 for i in range(40)} | {90: 0}


def test_texts_are_taken_together_by_their_words():
    import pyarrow as pa

    words = [["x", "b", "x"], [], ["c"] * text_index.WORDS, ["x"], []]
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2, 3, 4, None]), "words": pa.array(words, pa.list_(pa.string()))})
    out = list(text_index._grouped("id")([batch.slice(0, 0), batch]))
    assert [len(b) for b in out] == [3, 2, 2]
    assert out[0].to_pylist() == [
        {"token": "x", "keys": [1], "dls": [3], "positions": [[0, 2]]}, {"token": "b", "keys": [1], "dls": [3], "positions": [[1]]},
        {"token": "", "keys": [1, 2], "dls": [3, 0], "positions": [[], []]},
    ]
    assert out[2].to_pylist()[1] == {"token": "", "keys": [4, None], "dls": [1, 0], "positions": [[], []]}


def test_phrases_of_many_queries_are_joined_by_a_shuffle(spark, built, monkeypatch):
    index, _ = built
    queries = spark.createDataFrame(list(enumerate(["alpha", "alpha beta", "alpha alpha alpha", "the alpha of the alpha", "unknown alpha"])), "q int, words string")
    find = lambda: sorted(map(str, text_index.phrases(spark, index, queries, "q", "words").collect()))
    want = find()
    monkeypatch.setattr(text_index, "SMALL", -1)
    assert find() == want and want


def test_fuzzy_reads_its_names_once(spark, tmp_path):
    """Making names may cost more than the search, so it isn't repeated for each of its uses."""
    seen = spark.sparkContext.accumulator(0)

    def made(name: str) -> str:
        seen.add(1)
        return name

    index = text_index.TextIndex(str(tmp_path), "id", "long", 4, 1)
    text_index.add_batch(spark.createDataFrame([(1, "alpha", 0), (2, "beta gamma", 0)], SCHEMA), index, "text")
    names = spark.createDataFrame([("alpa",), ("gamma",), ("omega",)], "name string").withColumn("name", F.udf(made)("name"))
    assert {(r.name, r.id) for r in text_index.fuzzy(spark, index, names, "name", 1, 0).collect()} == {("alpa", 1), ("gamma", 2)}
    assert seen.value <= 6  # once, and once more where Spark evaluates a name for its words
