"""Candidates of names: without large broadcasts, by distinct titles, bounded by bits."""

import random

from pyspark.sql import functions as F

from jobloom.functions.similarity import may_reach, name_outline, name_similarity
from jobloom.operators import lexical, match


def test_outlines_never_leave_out_what_is_similar(spark):
    draw = random.Random(3)
    names = sorted({"".join(draw.choice("abcd가나") for _ in range(draw.randint(1, 9))) for _ in range(150)} | {"", "abababab", "a" * 90})
    one = spark.createDataFrame([(n,) for n in names], "a string")
    pairs = one.crossJoin(one.select(F.col("a").alias("b")))
    for least in (0.3, 0.45, 0.6, 0.7):
        rows = pairs.withColumns({"s": name_similarity("a", "b"), "m": may_reach(name_outline("a"), name_outline("b"), least)})
        seen = rows.agg(F.count_if((F.col("s") >= least) & ~F.col("m")).alias("lost"), F.count_if(~F.col("m")).alias("out")).first()
        assert seen.lost == 0 and seen.out > 0


def test_tokens_are_not_broadcast(spark):
    rows = spark.createDataFrame([("가나다 라",), ("가나마",)], "name string")
    titles = rows.select(F.col("name").alias("title"))
    plan = lexical.fuzzy_matches(rows, titles, "name", "title", 2, 1, 0.6)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    plan = lexical.phrase_matches(rows, titles, "name", "title")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_candidates_of_titles_that_companies_share(spark):
    kinds = ("가나다라", "가나다마", "가나 다라", "가나다라지점", "가나다", "사아자차")
    rows = [(f"{i:03d}", kinds[i % 6] + ("" if i < 60 else "주식회사"), "서울시 강남구", "k", "9") for i in range(90)]
    companies = match.prepare_companies(spark.createDataFrame(rows, "bzno string, title string, address string, ksic string, ksic9 string").withColumn("o", F.col("bzno")), "o")
    names = spark.createDataFrame([("가나다라",), ("가나 다라",), ("가나다",), ("사아자",)], "processed_co_nm string")
    titles = companies.select("bzno", "processed_title")
    for policy in match.POLICIES:
        long_names = names.filter(F.length("processed_co_nm") > policy.short)
        side = ("processed_co_nm", "processed_title")
        found = [lexical.phrase_matches(names, titles, *side), lexical.prefix_matches(long_names, titles, *side), lexical.fuzzy_matches(long_names, titles, *side, policy.fuzziness, policy.prefix)]
        every = found[0].select(*side, "bzno").union(found[1].select(*side, "bzno")).union(found[2].select(*side, "bzno")).distinct()
        want = {}
        for r in every.withColumn("s", name_similarity(*side)).collect():
            if r.s >= (policy.similarity_short if len(r.processed_co_nm) <= policy.short else policy.similarity):
                want.setdefault(r.processed_co_nm, []).append((-round(r.s, 9), r.bzno))
        got = {}
        for r in match.name_candidates(names, companies, policy).collect():
            got.setdefault(r.processed_co_nm, []).append((-round(r.similarity, 9), r.c_bzno))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[: match.NAME_CANDIDATES] for k, v in want.items()}


def test_detail_reads_each_text_once(spark):
    """Preparing texts costs most of matching by text, so it isn't repeated for each of its uses."""
    seen = spark.sparkContext.accumulator(0)

    def prepared(text: str) -> str:
        seen.add(1)
        return text

    companies = match.prepare_companies(spark.createDataFrame([("1", "(주)가나다라", "", None, None)], "bzno string, title string, address string, ksic string, ksic9 string"))
    texts = [(str(i), f"(주)가나다라 {i} 에서 경력 개발자를 모집합니다.") for i in range(5)]
    rows = spark.createDataFrame(texts, "pst_id string, pst_detail string").select("pst_id", F.lit(None).cast("string").alias("pst_title"), "pst_detail", F.lit("").alias("region_m"), F.lit("").alias("address_m"))
    rows = rows.withColumn("processed_pst_detail", F.udf(prepared)("pst_detail"))
    found = match.match_by_detail(rows, companies, match.VERY_RELAXED).collect()
    assert {r.bzno for r in found} <= {"1"}
    assert seen.value == len(texts)


def test_bm25_cuts_each_text_once(spark):
    """Scores, frequencies and sizes come from one pass; repeated keys count as texts of their own."""
    seen = spark.sparkContext.accumulator(0)

    def read(text: str) -> str:
        seen.add(1)
        return text

    texts = [(1, "red fox"), (2, "red red hen and"), (3, None), (3, "a green hen"), (4, "")]
    plain = spark.createDataFrame(texts, "k int, t string")
    queries = spark.createDataFrame([("q", "red hen"), ("none", "and"), ("other", "blue")], "q string, w string")
    got = sorted(map(tuple, lexical.bm25_top(plain.withColumn("t", F.udf(read)("t")), queries, "k", "t", "q", "w").collect()))
    assert seen.value == len(texts)
    assert got == sorted(map(tuple, lexical.index_top(lexical.token_index(plain, "k", "t"), queries, "k", "q", "w").collect()))
    assert {r[1] for r in got} == {1, 2, 3}


def test_fuzzy_pairs_meet_once_without_being_told_apart(spark):
    """Names and titles of several tokens, repeated rows, long tokens and any prefix; no aggregation of what was found."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("ab가𝄞") for _ in range(draw.randint(1, 5)))
    words = ["x" * n + "y" * k for n in (22, 23, 24) for k in (0, 1, 2)]
    rows = sorted({" ".join(draw.choice([word(), draw.choice(words)]) for _ in range(draw.randint(1, 3))) for _ in range(24)})
    names = spark.createDataFrame([(n,) for n in [*rows, rows[0], "", None]], "name string")
    titles = spark.createDataFrame([(str(i % 20), t) for i, t in enumerate([*rows, "Aba aba", None])] * 2, "k string, title string")

    def edits(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    left = {r["name"]: r.t for r in names.withColumn("t", lexical.tokens("name")).collect()}
    right = {(r.k, r.title): r.t for r in titles.withColumn("t", lexical.tokens("title")).collect()}
    for prefix in (0, 2):
        found = lexical.fuzzy_matches(names, titles, "name", "title", 1, prefix)
        want = {(n, *k) for n, a in left.items() for k, b in right.items() if any(x[:prefix] == y[:prefix] and abs(len(x) - len(y)) < 2 and edits(x, y) <= 1 for x in a for y in b)}
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not plan.startswith("Aggregate") and "Aggregate" not in plan.split("Join")[0]
