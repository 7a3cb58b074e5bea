"""Every operator against a plain version, on texts with all the odd cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobloom.llm import exact, graph, kneser_ney, lines, mixing, neardup, packing, quality, substring, textvec, tokenfile, vector_search
from jobloom.llm.common import scratch_path
from jobloom.llm.tokens import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pid int, body string, hit boolean, block int, start long"


def odd_documents(seed=5):
    """Copies, near copies, shared passages, repeated rows and ids, nulls, empty
    and long texts, odd white space, large ids."""
    rng = random.Random(seed)
    vocabulary = [f"w{rng.randrange(10**6)}" for _ in range(300)] + ["Über", "İx", "ﬁn", "漢字", "É", "don't", "x\x1cy", "<|endoftext|>"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = make(120), make(30)
    texts = [base, base, base.upper(), base.replace(" ", "  "), base + " tail", " ".join(base.split(" ")[8:]), passage, make(20) + " " + passage + " " + make(9), passage + "\n" + make(40)]
    texts += [make(rng.randrange(1, 60)) for _ in range(12)] + [make(3), "one", "one", "ONE", "", "", None, None, " ", "\n", "\n\n", "\t a  b \r\n c\x0b\x0cd ", "a b c d", "A b  c d"]
    texts += [make(4000), "the same long line here\nshort\nthe same long line here", "\tThe same long line here \nother text that is long", "x" * 30 + "\n" + "x" * 30]
    long = texts[-4].split(" ")
    texts += [" ".join(long[1000:1200]), " ".join(long[:13]), " ".join(long[:12])]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[3]), (3, "again with the id three"), (None, base), (None, None), (None, "null id"), (2**60 + 1, passage), (2**60 + 3, passage)]
    rng.shuffle(rows)
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), None, 1, "x", True, 2, 3) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, fold=False):
    return WORD.findall(text.translate(FOLD) if fold else text)


def test_words_as_hashes():
    texts = ["", "a b", " Ab\tab\n", "é É", "x" * 3_000_000 + " y"]
    hashes, first = textvec.words(texts, True)
    assert np.diff(first).tolist() == [len(words(t)) for t in texts]
    assert hashes[0] == textvec.words(["zz A"], True)[0][1] and hashes[2] == hashes[3] and hashes[4] != hashes[5]
    assert textvec.inside(first, 2).sum() == sum(max(0, len(words(t)) - 1) for t in texts)


def thue_morse(n, flip):
    return "".join("ab"[(k.bit_count() + flip) % 2] for k in range(n))


def test_words_without_arithmetic_structure():
    """Polynomial hashes modulo 2^64 can't tell such words apart."""
    rng = random.Random(6)
    texts = [thue_morse(n, f) for n in (8, 60, 64, 65, 1024, 4096) for f in (0, 1)] + ["x" * n for n in range(1, 140)]
    texts += ["".join(rng.choice("ab\x00é") for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    hashes, first = textvec.wide_words(texts, False)
    of = {}
    for i, t in enumerate(texts):
        assert first[i + 1] - first[i] == 1
        of.setdefault(t, set()).add(tuple(hashes[:, first[i]].tolist()))
    assert all(len(x) == 1 for x in of.values())
    for lane in (0, 1):
        assert len({next(iter(x))[lane] for x in of.values()}) == len(of)


def test_unlike_long_words_are_no_copies(spark):
    rows = [(k, " ".join([thue_morse(4096, k)] * 13)) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.n_removed == 0 for r in substring.repeated_spans(docs).collect())
    assert all(r.kept for r in neardup.near_groups(docs).collect())


@pytest.mark.parametrize("special", [True, False])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_tokenizer(name, special, rows):
    path, rng = public_tokenizers.path(name), random.Random(2)
    plain = Tokenizer.from_file(path)
    alphabet = [*" \n\t ab'sSé̈漢한1.!|\x1c　\xa0\x85İıßẞ²ǅΣς_<>", *(t.content for t in plain.get_added_tokens_decoder().values()), "<|endof"]
    texts = [t for _, t in rows] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(4000)] + ["a <|endoftext|> b"]
    if not special:
        plain.encode_special_tokens = True
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    own = Encoder(path, memo=50, special=special)
    got = [np.frombuffer(x, "<u4").tolist() for i in range(0, len(texts), 100) for x in own.encode(texts[i : i + 100])]
    assert got == want


def test_packing(docs, rows, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    cut = packing.token_pieces(docs, path, 64)
    out = packing.pack(cut, 64, packing.NUMBERS).collect()
    own, bins, pieces = Encoder(path), collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, bytes(r.ids)))
    for own_bin in bins.values():
        at = 0
        for offset, length in sorted(own_bin):
            assert offset == at
            at += length
        assert at <= 64
    want = collections.defaultdict(list)
    for i, t in rows:
        raw = own.encode([t])[0] + bytes(4)
        ends = [k for k in range(len(raw) // 4 % 64, len(raw) // 4, 64) if k] if len(raw) // 4 > 64 else []
        for k, (a, b) in enumerate(zip([0, *ends], [*ends, len(raw) // 4])):
            want[i].append((k, a, b - a, raw[4 * a : 4 * b]))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    total = sum(r.length for r in out)
    assert len(bins) <= math.ceil(total / 64) + 1
    again = packing.pack(cut.drop("task", "nth").withColumns({"_task": F.lit("x"), "_RANK": F.lit(None).cast("long"), "offset": F.lit("old")}), 64)
    assert again.columns == ["doc_id", "piece", "start", "length", "ids", "_task", "_RANK", "sequence_id", "offset"]
    got = again.collect()
    assert len({r.sequence_id for r in got}) == len(bins) and all(r["_task"] == "x" and r["_RANK"] is None for r in got)
    assert packing.pack(packing.token_pieces(none, path), numbers=packing.NUMBERS).count() == 0 and packing.pack(packing.token_pieces(none, path)).count() == 0


def first_fit(histogram, capacity):
    """Bins of first-fit decreasing."""
    room = []
    for n in sorted(collections.Counter(histogram).elements(), reverse=True):
        for i, r in enumerate(room):
            if r >= n:
                room[i] -= n
                break
        else:
            room.append(capacity - n)
    return len(room)


def test_plan_of_bins():
    for seed in range(20):
        rng = random.Random(seed)
        histogram = {n: rng.randrange(1, 40) for n in rng.sample(range(1, 101), 30)}
        plan, left = packing.plan_bins(histogram, 100), collections.Counter(histogram)
        for times, use in plan:
            assert sum(n * k for n, k in use) <= 100
            for n, k in use:
                left[n] -= times * k
        assert not any(left.values())
        assert sum(t for t, _ in plan) <= 1.06 * first_fit(histogram, 100)  # few lengths, the hard case
    rng = random.Random(7)
    many = collections.Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    assert sum(t for t, _ in packing.plan_bins(many, 2048)) <= math.ceil(sum(n * c for n, c in many.items()) / 2048) + 1
    assert packing.plan_bins({}, 100) == []
    with pytest.raises(ValueError):
        packing.plan_bins({101: 1}, 100)


def test_token_file_round_trip(spark, docs, rows, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokens = tokenfile.write(docs, path, scratch_path(spark, "t"), shard_bytes=3000)
    assert tokens.shards.count() > 2
    known = collections.Counter(i for i, _ in rows)
    keys = [(i, k) for i, n in known.items() for k in range(n)]
    absent = [(77_000 + i, 0) for i in range(500)] + [(3, 9), (None, 99)]
    got = tokenfile.read(spark, tokens, spark.createDataFrame(keys + absent, "doc_id long, nth long")).collect()
    own, at, want = Encoder(path), 0, []
    for i, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        want.append(i)
    found = sorted((r.start, r.doc_id, bytes(r.ids)) for r in got)
    assert [i for _, i, _ in found] == want
    for start, _, raw in found:
        assert start == at
        at += len(raw) // 4
    assert collections.Counter((i, x) for _, i, x in found) == collections.Counter((i, own.encode([t])[0] + (1).to_bytes(4, "little")) for i, t in rows)
    assert collections.Counter((r.doc_id, r.nth) for r in tokens.keys.collect()) == collections.Counter(keys)
    empty = tokenfile.write(none, path, scratch_path(spark, "t"))
    assert tokenfile.read(spark, empty, spark.createDataFrame([(1, 0)], "doc_id long, nth long")).count() == 0


def test_perfect_hash_is_minimal():
    keys = textvec.mix(np.arange(5000, dtype=np.uint64))
    entries = np.zeros(5000, tokenfile._ENTRY)
    entries["print"], entries["at"] = keys & np.uint64(0xFFFFFFFF), np.arange(5000)
    names = np.zeros(5000, tokenfile._KEY)
    names["doc_id"] = np.arange(5000)
    region = tokenfile.build_bucket(keys, entries, names)
    found, ok = tokenfile.find_in_bucket(region, keys, names)
    assert ok.all() and (found["at"] == np.arange(5000)).all()
    absent = np.zeros(20_000, tokenfile._KEY)
    _, ok = tokenfile.find_in_bucket(region, textvec.mix(np.arange(10_000, 30_000, dtype=np.uint64)), absent)
    assert ok.sum() <= 1


def test_perfect_hash_of_equal_hashes():
    keys = textvec.mix(np.arange(300, dtype=np.uint64) // 3 * 2)  # three keys to a hash
    entries, names = np.zeros(300, tokenfile._ENTRY), np.zeros(300, tokenfile._KEY)
    entries["print"], entries["at"], names["nth"] = keys & np.uint64(0xFFFFFFFF), np.arange(300), np.arange(300)
    region = tokenfile.build_bucket(keys[:299], entries[:299], names[:299])
    found, ok = tokenfile.find_in_bucket(region, keys, names)
    assert ok[:299].all() and (found["at"][:299] == np.arange(299)).all() and not ok[299]
    ids = np.zeros(3, tokenfile._KEY)
    ids["doc_id"], ids["null"] = (0, -(2**63), 2**63 - 1), (1, 0, 0)
    assert len(set(tokenfile.key_hash(ids).tolist())) == 3


def test_token_file_of_one_hot_doc_id(spark):
    """Rows that repeat one doc_id fill several shards and have numbers of their own."""
    rows = [(None if i % 2 else -(2**63), f"text {i} " * 30) for i in range(200)] + [(2**63 - 1, "end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokens = tokenfile.write(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "t"), shard_bytes=4000)
    shards = tokens.shards.count()
    got = tokenfile.read(spark, tokens, tokens.keys).collect()
    assert shards > 5 and sorted(((r.doc_id is not None, r.doc_id or 0, r.nth) for r in got)) == sorted([(False, 0, k) for k in range(100)] + [(True, -(2**63), k) for k in range(100)] + [(True, 2**63 - 1, 0)])
    starts = sorted((r.start, len(r.ids) // 4, r.doc_id) for r in got)
    assert all(a + n == b for (a, n, _), (b, _, _) in zip(starts, starts[1:]))
    assert [d for _, _, d in starts] == [None] * 100 + [-(2**63)] * 100 + [2**63 - 1]


def shingles(text):
    w = words(text, True)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    least = list(range(len(rows)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and None not in (rows[i][0], rows[j][0]) and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                least[max(a, b)] = min(a, b)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return [(d, len(sets[i]), best.get(root(i)) if d is not None else None) for i, (d, _) in enumerate(rows)]


def test_near_duplicates(docs, rows, none):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = neardup.near_groups(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute_components(rows), key=key)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    left = neardup.drop_near(docs)
    gone = {r.doc_id for r in got if not r.kept}  # rows that repeat a doc_id go together
    assert left.columns == docs.columns and left.count() == sum(i not in gone for i, _ in rows)
    assert neardup.near_groups(none).count() == 0 and neardup.drop_near(none).count() == 0


def test_near_duplicates_in_chains(spark):
    """A chain whose ends are unlike, and a group too loose for one hub."""
    rng, base = random.Random(3), [f"v{i}" for i in range(60)]
    chain = [" ".join(base[i * 3 : i * 3 + 40]) for i in range(6)]
    loose = []
    for _ in range(150):
        own = [f"c{i}" for i in range(120)]
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        loose.append(" ".join(own))
    rows = list(enumerate(chain + loose))
    got = neardup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 200)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 90, 90: 90, 95: 90}


def test_exact_duplicates(docs, rows, none):
    body = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[body(t)].append(i)
    want = collections.Counter()
    for i, t in rows:
        known = [x for x in groups[body(t)] if x is not None]
        want[i, min(known) if known else None, len(groups[body(t)]), hashlib.sha256(body(t).encode()).hexdigest()] += 1
    got = exact.exact_groups(docs).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.digest) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    left = exact.drop_exact(docs)
    assert left.columns == docs.columns and sorted(body(r.text or "") for r in left.collect()) == sorted(groups)
    assert exact.exact_groups(none).count() == 0 and exact.drop_exact(none).count() == 0


def test_of_rows_that_repeat_an_id_the_same_one_stays(spark):
    rows = [(1, "a b", "x"), (1, "a  b", "y"), (1, "a b", None), (2, "a b", "w"), (None, "c", "q"), (None, "c", "p"), (3, "d", None)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, `no.te` string").repartition(3)
        left = exact.drop_exact(docs)
        assert left.columns == docs.columns
        assert collections.Counter(map(tuple, left.collect())) == collections.Counter([(1, "a  b", "y"), (None, "c", "p"), (3, "d", None)])


def test_exact_filter_rejects_only_absent(spark):
    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.col("id").alias("doc_id"), F.col("id").alias("tag"))
    index = exact.build_index(rows.unionByName(rows.filter("doc_id < 50")))
    looked = exact.probed(rows, exact.hit_filter(index))
    assert looked.filter("doc_id < 50 and not hit").count() == 0 and looked.filter("hit").count() < 60


def test_lines(docs, rows, none):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: x.strip(strip).translate(FOLD)
    first = {}
    for i, t in rows:
        if i is not None:
            for x in t.split("\n"):
                first[key(x)] = min(first.get(key(x), i), i)
    want = collections.Counter()
    for i, t in rows:
        left = [x for x in t.split("\n") if i is None or len(key(x)) < 10 or first[key(x)] >= i]
        want[i, "\n".join(left), len(t.split("\n")), len(t.split("\n")) - len(left)] += 1
    for batches in (1, 4):
        got = lines.dedup_lines(docs, batches=batches).collect()
        assert collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == want
    assert lines.dedup_lines(none).count() == 0


def test_line_runs_are_compacted(spark):
    root = scratch_path(spark, "store")
    for k in range(5):
        store = lines.RunStore(spark, root, 2)  # opened again each time
        store.add(spark.range(k * 10, k * 10 + 10).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.col("id").alias("first")))
    assert [len(x) for x in store.levels()] == [1, 0, 1] and store.union().count() == 50
    store.drop()
    assert store.union() is None


def test_line_runs_meet_a_batch_as_they_lie(spark):
    store = lines.RunStore(spark, fanout=3)
    text = F.concat_ws("\n", *[F.concat(F.lit(f"long line {k} of "), F.col("doc_id")) for k in range(8)], F.lit("the line of all documents"))
    for k in range(3):  # two batches each: the third run makes one of level 1, in the second call
        got = lines.dedup_lines(spark.range(k * 50, k * 50 + 50).withColumnRenamed("id", "doc_id").withColumn("text", text), batches=2, store=store)
        assert got.agg(F.sum("n_dropped")).first()[0] == (49 if k == 0 else 50)
    assert store.union().count() == 150 * 8 + 1 and [len(x) for x in store.levels()] == [0, 2]
    buckets = store.buckets()
    for path in store.paths():
        assert len(spark.read.parquet(path).inputFiles()) <= buckets  # a file a bucket
    own = spark.range(1000).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.lit(1).alias("n")).groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    with lines._read_sorted(spark, store.paths(), buckets) as runs:
        plan = store.marked(own, runs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange") == 1 and plan.count("Sort [") == 1, plan
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith("jobloom_")]
    assert tables == [] and spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"
    store.drop()


def test_lines_of_later_documents(spark):
    root, line = scratch_path(spark, "store"), "a line that is long enough"
    first = spark.createDataFrame([(5, line)], "doc_id long, text string")
    assert lines.dedup_lines(first, store=lines.RunStore(spark, root)).first().n_dropped == 0
    later = spark.createDataFrame([(1, line + "\nanother long line"), (2, "another long line")], "doc_id long, text string")
    got = lines.dedup_lines(later, store=lines.RunStore(spark, root)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "another long line"), (2, "")]


def test_lines_with_ids_of_the_whole_range_and_a_hot_line(spark):
    ids = [-(2**63), -5, 0, 7, 2**62, 2**63 - 1, *range(100, 400)]
    docs = spark.createDataFrame([(i, f"the same line everywhere\nonly in {i} itself") for i in ids], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in lines.dedup_lines(docs).collect()}
    assert got == {i: (f"only in {i} itself", 1) if i != -(2**63) else (f"the same line everywhere\nonly in {i} itself", 0) for i in ids}


def brute_removed(rows, width=13):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            if i is not None:
                first[tuple(w[k : k + width])] = min(first.get(tuple(w[k : k + width]), i), i)
    out = collections.Counter()
    for i, t in rows:
        w = words(t)
        dead = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                dead[k : k + width] = [True] * width
        out[i, " ".join(x for x, d in zip(w, dead) if not d), len(w), sum(dead)] += 1
    return out


@pytest.mark.parametrize("group", [2000, 1 << 22])
def test_substrings(docs, rows, none, group, monkeypatch):
    monkeypatch.setattr(substring, "GROUP_BYTES", group)
    got = substring.repeated_spans(docs).collect()
    assert collections.Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in got) == brute_removed(rows)
    assert all(sum(s.end - s.begin for s in r.spans) == r.n_removed for r in got)
    assert substring.repeated_spans(none).count() == 0


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        left = total - sum(target[s] for s in names if s not in open_)
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        target |= share | {s: float(cap * sizes[s]) for s in over}
        if not over:
            break
        open_ -= over
    return target


def test_mixing(spark, docs, rows, none):
    report = mixing.mix_report(docs).collect()
    assert collections.Counter((r.doc_id, r.size) for r in report) == collections.Counter((i, len(words(t))) for i, t in rows)
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(words(r.text or ""))
    want = brute_targets(sizes)
    assert sorted({round(r.target, 4) for r in report}) == pytest.approx(sorted({round(x, 4) for x in want.values()}))
    assert all(r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0) for r in report)
    again = mixing.mix_report(docs.repartition(2)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, report))
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "_shard", "_place"]
    assert sum(len(words(r.text or "")) for r in mixed.collect()) == sum(r.taken for r in report)
    assert mixing.mix_report(none).count() == 0 and mixing.mix(none).count() == 0


def test_mix_report_counts_the_mix(docs, monkeypatch):
    whole, mix = mixing.mix_report(docs).collect(), mixing._mix
    assert sum(r.taken for r in whole) > 0
    monkeypatch.setattr(mixing, "_mix", lambda *a: mix(*a).filter("_shard % 2 = 0"))
    half = mixing.mix_report(docs).collect()
    assert len(half) == len(whole) and 0 < sum(r.taken for r in half) < sum(r.taken for r in whole)


def test_mixed_shards_stay_whole(docs):
    at = mixing.shuffled(mixing.mix(docs)).select(F.spark_partition_id().alias("part"), "_shard", "_place").collect()
    assert all(r.part == r["_shard"] for r in at) and len({r.part for r in at}) > 1
    for shard in {r["_shard"] for r in at}:
        own = [r["_place"] for r in at if r["_shard"] == shard]
        assert own == sorted(own)


def test_mix_comes_near_targets(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.choice([1, 5, 50, 400, 3000 if i % 97 == 0 else 20])), f"s{i % 7}") for i in range(1500)]
    report = mixing.draws(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = report.groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("rows") * F.col("copies")).alias("n")).collect()
    assert len(got) == 7 and all(abs(r.n - r.t) <= 0.01 * r.t + 5 for r in got)


def test_mix_comes_as_near_as_single_documents_allow(spark):
    """No document that is left brings its source nearer, however odd the sizes are."""
    rng, rows = random.Random(12), []
    shapes = {"a": [1000], "b": [900] * 3, "c": [7, 7, 5000], "d": [1] * 40 + [3000], "e": [600, 601, 602, 5], "f": [0, 0, 50], None: [333] * 4}
    for source, sizes in shapes.items():
        for size in sizes:
            rows.append((len(rows), " ".join(["w"] * size), source))
    for turn in range(2):
        rng.shuffle(rows)
        drawn = mixing.draws(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
        for source in shapes:
            own = [r for r in drawn if r.source == source and r.size]
            gap = own[0].target - sum(r.size * r.rows * r.copies for r in own)
            whole = min(r.copies for r in own)
            left = [r.size * r.rows for r in own if r.copies == whole < 3]
            assert all(r.copies <= 3 for r in own) and all(abs(gap - x) >= abs(gap) - 1e-6 for x in left), source
        found = sorted((r.doc_id, r.copies) for r in drawn)
        assert not turn or found == before  # noqa: F821
        before = found  # noqa: F841


def test_shards_grow_with_the_mix(spark, monkeypatch):
    make = lambda n: spark.createDataFrame([(n, 1, 2)], "size long, rows long, copies long")
    monkeypatch.setattr(mixing, "SHARD_WORDS", 100)
    assert [mixing.shards_of(make(n)) for n in (1, 800, 801, 3000)] == [16, 16, 32, 64]
    monkeypatch.setattr(mixing, "SHARD_WORDS", 50)
    docs = spark.createDataFrame([(i, "w " * 40, "s") for i in range(60)], "doc_id long, text string, source string")
    at = mixing.mixed_shards(docs).select("doc_id", F.spark_partition_id().alias("part")).collect()
    assert len(at) == 60 and len({r.part for r in at}) > 16


def test_splitting_tree_is_exact(spark):
    blocks = spark.createDataFrame([("a", 500), ("b", 37), (None, 12)], "source string, n long")
    rows = mixing.shard_quotas(blocks, 8).collect()
    by_source, by_shard = collections.Counter(), collections.Counter()
    for r in rows:
        by_source[r.source] += r.quota
        by_shard[r.shard] += r.quota
    assert by_source == {"a": 500, "b": 37, None: 12} and max(by_shard.values()) - min(by_shard.values()) <= 3


def test_kneser_ney(docs, rows, none, monkeypatch):
    monkeypatch.setattr(kneser_ney, "GROUP_BYTES", 5000)
    monkeypatch.setattr(kneser_ney, "BUCKET_BYTES", 9000)
    marked = docs.withColumn("held", kneser_ney.fold() == 2)
    model = kneser_ney.train(marked.filter("not held"))
    got = kneser_ney.score(marked, model, ("held",)).collect()
    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    texts = [(i, [*words(t, True), "\n"]) for i, t in rows]
    train = [t for i, t in texts if not held(i)]
    c = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip(["", *t], t))
    contexts = collections.Counter(w for _, w in pairs)
    n, v = sum(c.values()), len(c)
    of = lambda x: [sum(k == i for k in x.values()) for i in (1, 2, 3, 4)]
    d, d1 = kneser_ney.discounts(of(pairs)), kneser_ney.discounts(of(contexts))
    cut = lambda k, own: k - (0, *own)[min(k, 3)]
    rest = sum((0, *d1)[min(k, 3)] for k in contexts.values()) / len(pairs)
    total, left = collections.Counter(), collections.Counter()
    for (h, _), k in pairs.items():
        total[h] += k
        left[h] += (0, *d)[min(k, 3)]
    low = lambda w: cut(contexts[w], d1) / len(pairs) + rest / (v + 1)
    p = lambda h, w: cut(pairs[h, w], d) / total[h] + left[h] / total[h] * low(w) if total[h] else low(w)
    assert sum(p("one", w) for w in c) + p("one", "never met") == pytest.approx(1)
    want = sorted((len(t), sum(c[w] > 0 for w in t), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), sum(math.log10(p(h, w)) for h, w in zip(["", *t], t))) for _, t in texts)
    assert model.tokens == n and model.vocabulary == v and model.pairs == len(pairs)
    have = sorted((r.n_tokens, r.n_known, r.base_score, r.score) for r in got)
    assert np.array(have) == pytest.approx(np.array(want), rel=1e-5)
    assert all(r.held == held(r.doc_id) for r in got)
    empty = kneser_ney.train(none)
    assert kneser_ney.score(none, model).count() == 0 and kneser_ney.score(docs, empty).filter("score is null").count() == 0


def test_quality(spark, none):
    rng = random.Random(1)
    syllables = ["ta", "ri", "on", "es", "lu", "men"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(600):
        own = [word() for _ in range(rng.randrange(5, 80))]
        bad = i % 6 == 0
        kind = i % 3 if bad else None
        text = " ".join(own)
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in own) if i % 12 else " ".join([own[0]] * 40 + [own[1]] * 30)
        rows.append((i, text, "en" if i % 2 else None, i))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(900, None, "en", 1), (901, "", None, 1), (None, "ta ri on", "xx", 1), (3, rows[3][1], "en", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, body long")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (5000, 1, None), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.judged(docs, marks).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    bad = [i for i in range(600) if i % 6 == 0]
    assert sum(kept[i] for i in bad) <= 0.02 * len(bad)
    assert sum(kept[i] for i in range(600) if i % 6) >= 0.99 * 500
    assert kept[900] and kept[901]
    left = quality.keep_good(docs, marks)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got)
    assert all(r.kept for r in quality.judged(docs, marks.limit(0)).collect())
    assert quality.judged(docs.limit(0), marks).count() == 0


def test_quality_keeps_a_language_without_labels(spark):
    rng = random.Random(2)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(60))
    rows = [(i, make("taeiolrs") if i < 300 else make("가나다라마바사아"), "en" if i < 300 else "ko") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(i, 1, 0) for i in range(300, 303)], "doc_id long, quality int, toxic int")
    for labels in (marks, marks.filter("doc_id < 300")):
        got = quality.judged(docs, labels).collect()
        assert all(r.kept and r.threshold is None for r in got if r.lang == "ko")
        assert all(r.threshold is not None for r in got if r.lang == "en")
        assert quality.keep_good(docs, labels).filter("lang = 'ko'").count() == 100


def test_quality_holds_all_good_documents_beside_the_training_half(spark):
    docs = spark.createDataFrame([(i, "en") for i in range(2000)], "doc_id long, lang string")
    marks = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(2000)], "doc_id long, quality int, toxic int")
    got = quality.trusted_sample(docs, marks, 100).collect()
    assert sorted(r.doc_id for r in got) == list(range(0, 2000, 2))
    assert 20 <= sum(not r.held for r in got) <= 80


def test_quality_model_is_a_distribution(spark):
    texts = spark.createDataFrame([("tari onta ri men taon",), ("ri ri mena",), (None,)], "text string")
    table = {r.key: (r.alpha, r.gamma) for r in quality.train(texts).collect()}
    context = [0, 0, 0, 117, 98]  # the beginning, t, a

    def p(symbol):
        out = 1 / 257
        for k in range(1, quality.ORDER + 1):
            gram = 0
            for s in [*context[len(context) - k + 1 :], symbol] if k > 1 else [symbol]:
                gram = gram << 9 | s
            alpha = table.get(gram + (k << 56), (None, None))[0] or 0.0
            gamma = table.get((gram >> 9) + (k - 1 << 56), (None, None))[1]
            out = alpha + (1.0 if gamma is None else gamma) * out
        return out

    assert sum(p(s) for s in range(1, 258)) == pytest.approx(1)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = rng.integers(-60, 60, (700, 8)).tolist()
    vectors[5], vectors[6], vectors[300:400] = vectors[4], vectors[4], [vectors[4]] * 100
    rows = list(enumerate(vectors))
    frame = spark.createDataFrame(rows, "vec_id long, v array<long>")
    queries = frame.filter("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in vector_search.top_k(frame, queries, 5, pivots=8, block=40).collect()}
    matrix = np.array(vectors)
    for q in range(0, 700, 10):
        scores = matrix @ matrix[q]
        want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if i != q))[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in want]
    few = frame.filter("vec_id < 3")
    assert vector_search.top_k(few, queries.filter("query_id = 0"), 5).count() == 2
    assert vector_search.top_k(frame.limit(0), queries, 5).count() == 0 and vector_search.top_k(frame, queries.limit(0), 5).count() == 0


def test_top_k_of_ragged_and_large_vectors(spark):
    rng = random.Random(8)
    rows = [(i, [rng.randrange(-(2**28), 2**28) for _ in range(rng.choice([0, 2, 5, 5, 5]))]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, v array<long>")
    queries = frame.filter("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in vector_search.top_k(frame, queries, 3, pivots=6, block=20).collect()}
    for q in range(0, 300, 10):
        scores = sorted((-sum(a * b for a, b in zip(v, rows[q][1])), i) for i, v in rows if i != q)[:3]
        assert [got[q, k + 1] for k in range(3)] == [(i, -s) for s, i in scores]


def test_unusable_vectors(spark):
    rows = [(1, [0.5, 1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]), (6, [-0.001, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = frame.filter(vector_search.usable()).select("vec_id", vector_search.quantised().alias("v")).orderBy("vec_id").collect()
    assert [(r.vec_id, r.v) for r in got] == [(1, [128, 256]), (6, [-1, 512])]


def test_columns_of_clashing_names(spark, docs):
    """What the stages add inside never meets a column of the documents."""
    own = ["_digest", "_Gone", "_gone_id", "_body", "_shard", "_place", "_id", "_Source", "_size", "_copy", "_task", "_nth", "pid", "no_id", "hit", "label", "component_id", "kept"]
    base = docs.select("doc_id", "text", "lang", "source")
    wide = base.withColumns({c: F.concat(F.lit(c), F.coalesce("source", F.lit(""))) for c in own})
    marks = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    stages = (exact.drop_exact, neardup.drop_near, lambda d: quality.keep_good(d, marks), lambda d: mixing.mix(d).select(d.columns))
    for stage in stages:
        out = stage(wide)
        assert out.columns == wide.columns
        plain = collections.Counter(map(tuple, stage(base).collect()))
        got = out.collect()
        assert collections.Counter(tuple(r)[:4] for r in got) == plain
        assert all(r[c] == c + (r.source or "") for r in got for c in own)


def test_collisions_are_counted():
    a = np.arange(4 * neardup.COORDINATES, dtype=np.uint32).reshape(4, -1)
    b, mark = a.copy(), np.zeros((4, neardup.SKETCH), np.uint8)
    b[1, : neardup.COORDINATES - neardup.MATCHES] ^= np.uint32(1 << 31)  # MATCHES agree
    b[2, : neardup.COORDINATES - neardup.MATCHES + 1] ^= np.uint32(1 << 31)  # one fewer
    other = mark.copy()
    other[3, : neardup.SKETCH - neardup.AGREE + 1] = 1
    assert neardup._collide(a, b, mark, other).tolist() == [True, True, False, False]


def test_index_excludes_where_vectors_cluster(spark, monkeypatch):
    """Of vectors in clusters the annuli leave most blocks out; the result is whole."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 8))
    v = centres[np.arange(2000) % 20] / np.linalg.norm(centres, axis=1)[np.arange(2000) % 20, None] + rng.normal(scale=0.01, size=(2000, 8))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]).astype(int)
    vectors = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, v array<long>")
    asked, scored = [], vector_search._scored

    def counted(index, queries, wanted, k):
        asked.append((wanted.count(), queries.count() * index.select("block").distinct().count()))
        return scored(index, queries, wanted, k)

    monkeypatch.setattr(vector_search, "_scored", counted)
    got = vector_search.top_k(vectors, vectors.filter("vec_id % 20 = 3").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), 5, 64, 64)
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got.collect()}
    for q in range(3, 2000, 20):
        scores = v @ v[q]
        best = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        assert [found[q, r + 1] for r in range(5)] == [(i, -s) for s, i in best]
    assert 4 * sum(n for n, _ in asked) < asked[0][1]


def test_packing_lets_go_of_the_tokenizer(spark, tmp_path, monkeypatch):
    """Workers that put pieces in their places are those that cut them before."""
    seen = str(tmp_path / "released")
    monkeypatch.setattr(packing, "release", lambda: open(seen, "w").close(), raising=False)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.pack(pieces, numbers=packing.NUMBERS).count() == 1
    packing.pack(pieces, numbers=packing.NUMBERS).collect()
    assert (tmp_path / "released").exists()


def test_quality_holds_few_arrays():
    """Of a group's n-grams: those of one order at a time, besides the packed ones of all."""
    import tracemalloc

    draw = random.Random(3)
    texts = ["".join(draw.choices("abcdefghij", k=7)) + " " + "".join(draw.choices("klmnopq", k=9)) for _ in range(30_000)]
    tracemalloc.start()
    symbols, ok, *_, each, every = quality.asked(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 13 * symbols.nbytes
    tagged = [quality._tagged(each[k][ok], k) for k in range(1, quality.ORDER + 1)] + [quality._tagged(each[k][ok - 1], k) for k in range(quality.ORDER)]
    assert np.array_equal(every, np.unique(np.concatenate(tagged)))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoding_by_arrays(name, rows):
    """Ids are those of encode; of a file that drops white space each distinct word of a batch is met once."""
    import pyarrow as pa

    path, rng = public_tokenizers.path(name), random.Random(4)
    alphabet = [*" \n\t abAB'sSé̈漢한1.!|\x1c　\xa0\x85İıßẞ²ǅΣςȺȿɀªº_", "<|endoftext|>", "H̱"]
    texts = [t for _, t in rows] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(2000)] + ["a <|endoftext|> b"]
    for special in (True, False):
        own, plain = Encoder(path, memo=60, special=special), Encoder(path, special=special)
        for i in range(0, len(texts), 300):
            part = texts[i : i + 300]
            ids, size = own.encode_arrays(pa.array(part, pa.string()), 7)
            want = [np.frombuffer(x, "<u4").tolist() + [7] for x in plain.encode(part)]
            assert size.tolist() == list(map(len, want)) and ids.tolist() == [k for x in want for k in x]
    if name == "word_bpe_49k.json":
        seen, own = [], Encoder(path)
        own._word = lambda word, space, find=own._word: (seen.append(word), find(word, space))[1]
        own.encode_arrays(pa.array(["Tiger, tiger!  burning", "bright tiger.\nBurning;"]), 1)
        assert sorted(seen) == ["bright", "burning", "tiger"]
    ids, size = Encoder(path).encode_arrays(pa.array([], pa.string()), 1)
    assert len(ids) == len(size) == 0
