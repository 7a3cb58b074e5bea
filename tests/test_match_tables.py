"""What matching by names reads, keeps and frees."""

import glob
import os

from pyspark.sql import functions as F

from jobloom.functions import text
from jobloom.functions.lineage import forget, shared_folder, stored
from jobloom.operators import match
from jobs import match_companies
from jobs.common import configuration

FIRMS = "bzno string, title string, address string, ksic string, ksic9 string"


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getAbsolutePath()}/**/shuffle_*", recursive=True)}


def test_stored_tables_free_their_shuffle_files(spark):
    before = shuffle_files(spark)
    table = stored(spark.range(100).withColumn("g", F.col("id") % 7).groupBy("g").count())
    assert shuffle_files(spark) <= before
    assert table.count() == 7 and table.inputFiles()
    where = table.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    forget(table)
    assert not glob.glob(where)


def test_names_in_turn_read_no_text_and_leave_no_shuffle_files(spark):
    seen = spark.sparkContext.accumulator(0)

    def prepared(text: str) -> str:
        seen.add(1)
        return text

    firms = match.prepare_companies(spark.createDataFrame([("1", "(주)가나다라마", "서울시 강남구", "k", "9"), ("2", "사아자차카", "", "k", "9")], FIRMS))
    # a pst_id that comes twice is matched once and isn't tried again; null ones stay for each attempt
    names = [("a", "가나다라마"), ("a", "없는이름이다"), ("b", "사아자차카지점"), ("c", "다른회사이름"), ("d", None), (None, "사아자차카"), ("e", "주식회사")]
    rows = spark.createDataFrame(names, "pst_id string, co_nm string").withColumns({"loc": F.lit("서울시 강남구"), "corp_addr": F.lit(None).cast("string"), "pst_title": F.lit(None).cast("string"), "pst_detail": F.lit("글")})
    rows = match.prepare_postings(rows).withColumn("processed_pst_detail", F.udf(prepared)("pst_detail"))
    before = shuffle_files(spark)
    found = match.match_progressively(rows, firms, by_text=False)
    assert seen.value == 0 and shuffle_files(spark) <= before
    got = sorted((str(r.pst_id), r.bzno, r.matching_policy, r.matching_attempt) for r in found.collect())
    # as the policies give it one by one
    left, want = rows, []
    for attempt, policy in enumerate(match.POLICIES):
        step = match.match_by_name(left, firms, policy).select("pst_id", "bzno").collect()
        want += [(str(r.pst_id), r.bzno, policy.name, attempt) for r in step]
        left = left.filter(~F.coalesce(F.col("pst_id").isin([r.pst_id for r in step if r.pst_id]), F.lit(False)))
    assert got == sorted(want) and {g[0] for g in got} == {"a", "b", "None"}


def test_a_name_meets_its_candidates_without_a_row_for_each(spark):
    """The rows that are ranked by posting are as many as the postings."""
    firms = match.prepare_companies(spark.createDataFrame([(str(i), "가나다라마", "서울시 강남구" if i == 3 else "", "k", "9") for i in range(5)], FIRMS))
    rows = spark.createDataFrame([(str(i), "가나다라마") for i in range(40)], "pst_id string, co_nm string").withColumns({"loc": F.lit("서울시"), "corp_addr": F.lit("서울시 강남구"), "pst_title": F.lit(None).cast("string"), "pst_detail": F.lit(None).cast("string")})
    out = match.match_by_name(match.prepare_postings(rows), firms, match.RELAXED)
    got = out.collect()
    assert len(got) == 40 and {r.bzno for r in got} == {"3"} and {r.match_type for r in got} == {"name_region_address_match"}
    assert "array_min" in out._jdf.queryExecution().optimizedPlan().toString()


def test_the_job_keeps_no_shuffle_files_and_no_tables_of_its_own(spark, tmp_path):
    source, output = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(i, i % 6, "M") for i in range(9)], "c_custkey long, c_nationkey long, c_mktsegment string").write.parquet(f"{source}/customer.parquet")
    spark.createDataFrame([(i, i % 9) for i in range(40)], "o_orderkey long, o_custkey long").write.parquet(f"{source}/orders.parquet")
    config = configuration(None, "match_companies.toml") | {"policies": ["relaxed"]}
    shared = shared_folder(spark).removeprefix("file:")
    before, tables = shuffle_files(spark), set(glob.glob(f"{shared}/stored-*/*.parquet"))
    found = match_companies.run(spark, source, output, config)
    left = [os.path.getsize(f) for f in shuffle_files(spark) - before if f.endswith(".data")]
    assert sum(left) < 2000, left  # of counts
    # what is left holds names and candidates, no prepared postings or companies
    kept = {f.rsplit("/", 1)[0] for f in set(glob.glob(f"{shared}/stored-*/*.parquet")) - tables}
    assert not any({"c_custkey", "co_nm", "title"} & set(spark.read.parquet(k).columns) for k in kept)
    again = sorted(map(tuple, found.collect()), key=str)
    assert again and again == sorted(map(tuple, match_companies.run(spark, source, output, config).collect()), key=str)


def test_patterns_run_on_texts_with_their_mark_only(spark):
    texts = ["[채용] 가나 채용안내 다라", "☞ 여기 바로가기 ☜ 강남점 채용", "또는 개인 양식 이력서 접수 가능 마바", "인턴 기간 3개월 법정 임금 준수", "<b>가나</b> 채용제목 입력주세요", "없음", "", None]
    rows = spark.createDataFrame([(t and t + "가 나 다 라 " * 20,) for t in texts], "t string")
    head = text.cut_at_keywords(text.head_of_text("t"))
    plain = head
    for pattern in text.BOILERPLATE:
        plain = F.regexp_replace(plain, text._java(pattern), " ")
    out = rows.select(text.preprocess_text("t").alias("a"), text.squeeze(plain).alias("b"))
    assert all(r.a == r.b for r in out.collect())
    guarded = rows.select(text.preprocess_text("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert all(f", {m})" in guarded for m in text.BOILERPLATE_MARKS)
    names = [f"{a}{sep}{b}" for a in ("가나", "") for b in ("(주)", "㈜", "주식회사 다라") for sep in ("", " ", "　", "\n")]
    found = spark.createDataFrame([(n,) for n in names], "t string").select("t", match.potential_names(F.col("t")).alias("n")).collect()
    by = {r.t: [x.name for x in r.n] for r in found}
    assert all(by[f"가나{sep}㈜"] == ["가나"] for sep in ("", " ", "　", "\n")) and by["가나　주식회사 다라"] == ["가나", "다라"]
