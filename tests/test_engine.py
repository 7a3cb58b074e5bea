import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.operators import classify, dedup, lexical, match, merge, skills
from jobloom.plans import fixtures, run
from tests.test_text import brute_ratio
from jobloom.queries import QUERIES
from jobloom.sources import tables
from jobloom.streaming import ingest

DETAIL = "충분히 긴 상세 내용입니다 "


def postings(spark, rows):
    return spark.createDataFrame(rows, "pst_id string, source string, month int, pst_detail string")


def ids(rows):
    return sorted(r.pst_id for r in rows.collect())


def test_exact_stages(spark):
    rows = postings(spark, [("1", "srm", 1, "x"), ("2", "jk", 1, "x"), ("3", "jk", 2, "x"), ("4", "jk", None, "x"), ("5", "jk", 3, "x"), ("6", "jk", 1, None), ("7", "jk", 1, None)])
    first = dedup.exact_dedup_month(rows)
    assert ids(first) == ["1", "3", "4", "5", "6", "7"]
    second = dedup.exact_dedup_source(first)
    assert ids(second) == ["1", "3", "6", "7"]
    assert ids(dedup.exact_dedup(second)) == ids(second)
    assert dedup.exact_dedup(rows.limit(0)).count() == 0


def test_fuzzy_stages(spark):
    base = [f"낱말{i}" for i in range(200)]
    edited = lambda k: " ".join([*base[:k], "다른", *base[k + 1 :]])
    rows = postings(spark, [("1", "jk", 1, " ".join(base)), ("2", "srm", 1, edited(199)), ("3", "jk", 1, edited(0)), ("4", "jk", 2, edited(199)), ("5", "jk", 2, "다른 글입니다 전혀 비슷하지 않은"), ("6", "jk", None, " ".join(base))])
    assert ids(dedup.fuzzy_dedup_month(rows)) == ["2", "4", "5", "6"]
    assert ids(dedup.fuzzy_dedup_source(rows)) == ["1", "2", "3", "5", "6"]


def test_similar_texts_against_all_pairs(spark):
    rng, rows = random.Random(4), []
    for i in range(40):
        own = [f"w{j}" for j in range(30 + i % 3)]
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own))] = f"v{rng.randrange(9)}"
        rows.append((str(i), "jk", i % 2, " ".join(own)))
    got = {(r.month, r.a, r.b) for r in dedup.similar_texts(postings(spark, rows), "month", 0.7).collect()}
    import hashlib

    sets = {}
    for _, _, month, t in rows:
        w = t.split()
        sets[month, hashlib.md5(t.encode()).hexdigest()] = {" ".join(w[k : k + 5]) for k in range(len(w) - 4)}
    want = {(m, a, b) for (m, a), x in sets.items() for (n, b), y in sets.items() if m == n and a < b and len(x & y) / len(x | y) >= 0.7}
    assert got == want and want


def test_merge_precedence_and_filters(spark):
    long, short = DETAIL, "열한 글자가 안 됨"[:10]
    jk = spark.createDataFrame([("1", long, "2024.02.01(목)"), ("9", short, None)], "pst_id string, pst_detail string, pst_strt string")
    jkhd = spark.createDataFrame([("1", long, "x"), ("2", long, "y")], "pst_id string, pst_detail string, wc string")
    srm = spark.createDataFrame([("2", long, "2024.03.11 14:31"), ("3", long, "2024.03.11 14:31")], "pst_id string, pst_detail string, pst_strt string")
    day = datetime.date(2025, 5, 1)
    out = merge.merge({s: merge.dated(r, s, day) for s, r in (("jk", jk), ("jkhd", jkhd), ("srm", srm))})
    assert out.schema.names == schemas.MERGED
    assert sorted((r.pst_id, r.source, r.year, r.month) for r in out.collect()) == [("1", "jk", 2024, 2), ("2", "jkhd", 2025, 5), ("3", "srm", 2024, 3)]


def test_latest_per_id(spark):
    rows = spark.createDataFrame([("1", "2024", 0), ("1", "2025", 1), ("2", None, 2), ("2", None, 3)], "pst_id string, pst_strt string, load_order long")
    assert sorted((r.pst_id, r.load_order) for r in merge.latest_per_id(rows).collect()) == [("1", 1), ("2", 2)]


def test_files(spark, tmp_path):
    assert tables.select_files(["0.csv", "17.csv", "18.csv", "2024_jk_3.csv", "1.txt"], "jk") == ["0.csv", "17.csv"]
    assert tables.select_files(["0.csv"], "other") == []
    path = tmp_path / "1.csv"
    row = ["7", "제목"] + ["x"] * 14 + ['"긴\n상세 ""인용"" 내용"', "주소"]
    path.write_text("\t".join(schemas.JK) + "\n" + "\t".join(row) + "\n", encoding="utf-8")
    got = tables.read_postings(spark, "jk", str(path)).collect()
    assert len(got) == 1 and got[0].pst_detail == '긴 상세 "인용" 내용' and got[0].corp_addr == "주소"
    assert tables.sample_per_file(tables.read_postings(spark, "jk", str(path)), 0).count() == 0
    company = tmp_path / "c.csv"
    company.write_text("|".join(schemas.COMPANY) + "\n" + "|".join(["007"] + ["y"] * 12) + "\n", encoding="utf-8")
    assert tables.read_companies(spark, str(company)).first().bzno == "007"
    occupations = tmp_path / "o.csv"
    occupations.write_text("target,keco_4,keco_t\n1,a,b\n")
    assert tables.read_occupations(spark, str(occupations)).first().target == 1
    assert tables.read_occupations(spark, str(tmp_path / "none.csv")) is None and tables.read_occupations(spark, str(company)) is None


def test_ledger(spark):
    files = spark.createDataFrame([("a",), ("b",)], "file_path string")
    empty = spark.createDataFrame([], schemas.LEDGER)
    ledger = tables.record(empty, files.filter("file_path = 'a'"), "jk", schemas.COMPLETED)
    assert [r.file_path for r in tables.pending_files(files, ledger).collect()] == ["b"]
    assert tables.pending_files(files, ledger, force=True).count() == 2
    again = tables.record(ledger, files, "jk", schemas.FAILED)
    assert sorted((r.file_path, r.status) for r in again.collect()) == [("a", "FAILED"), ("b", "FAILED")]


def test_updates(spark):
    rows = spark.createDataFrame([("1", "old", 1), ("2", "old", 2)], "pst_id string, t string, z int")
    news = spark.createDataFrame([("1", "new"), ("2", None)], "pst_id string, t string")
    assert sorted((r.pst_id, r.t) for r in tables.update_by_key(rows, news, "pst_id", ["t"]).collect()) == [("1", "new"), ("2", "old")]
    assert [r.pst_id for r in tables.delete_by_id(rows, news.limit(1)).collect()] == ["2"]
    old = spark.createDataFrame([(None, 3), (4, 5)], "target int, predicted_occupation int")
    assert sorted(r.target for r in tables.migrate_column(old).collect()) == [3, 4]


POLICY_CASES = [
    (match.STRICT, "가나다라마", "가나다라마", False, False, None),
    (match.STRICT, "가나다라마", "가나다라마", True, False, ("name_region_match", 0.9)),
    (match.STRICT, "가나다라", "가나다라", False, False, None),
    (match.MODERATE, "가나다라마", "가나다라마", False, False, ("name_only_match", 0.65)),
    (match.RELAXED, "가나", "가나", True, True, ("name_region_address_match", 1.0)),
    (match.MODERATE, "가나다라마바사아", "가나다라마바", False, False, None),
]


@pytest.mark.parametrize(("policy", "name", "title", "region", "address", "want"), POLICY_CASES)
def test_name_policies(spark, policy, name, title, region, address, want):
    place = "서울 강남구"
    rows = spark.createDataFrame([("1", name, place if region else None, place if address else None, None, None)], "pst_id string, co_nm string, loc string, corp_addr string, pst_title string, pst_detail string")
    firms = spark.createDataFrame([("b", title, place, "k", "k9")], "bzno string, title string, address string, ksic string, ksic9 string")
    got = match.match_by_name(match.prepare_postings(rows), match.prepare_companies(firms), policy).collect()
    assert ([(r.match_type, pytest.approx(r.confidence)) for r in got] or [None])[0] == want


def test_detail_match_and_progress(spark):
    kind = "pst_id string, co_nm string, loc string, corp_addr string, pst_title string, pst_detail string"
    text = "한빛소프트(주) 에서 경력 개발자를 모집합니다. " + "성실한 분을 찾습니다 " * 20
    rows = match.prepare_postings(spark.createDataFrame([("1", None, "서울 강남구", None, "개발자", text), ("2", "없는이름", None, None, None, None)], kind))
    firms = [("1", "한빛소프트", "서울 강남구", "k", "k9"), ("2", "다른회사", "부산시", "k", "k9"), ("1", "한빛소프트", "서울 강남구", "마지막", "k9")]
    firms = match.prepare_companies(spark.createDataFrame(firms, "bzno string, title string, address string, ksic string, ksic9 string").coalesce(1))
    assert firms.count() == 2
    got = match.match_progressively(rows, firms).collect()
    assert [(r.pst_id, r.bzno, r.match_type, r.matching_policy, r.ksic) for r in got] == [("1", "1", "detail_region_match", "strict", "마지막")]


def test_potential_names(spark):
    names = spark.range(1).select(match.potential_names(F.lit("우리 좋은 기업입니다. (주)한빛 그리고 담당 주식회사")).alias("n")).first().n
    assert [(n.name, n.confidence) for n in names] == [("우리", 0.7), ("우리 좋은", 0.7), ("우리 좋은 기업입니다", 0.7), ("기업입니다.", 0.9), ("한빛", 0.9)]


def test_lexical(spark):
    names = spark.createDataFrame([("한빛",), ("abcd",)], "name string")
    titles = spark.createDataFrame([("1", "주식 한빛 모임"), ("2", "한빛소프트"), ("3", "abce the"), ("4", "xbcd")], "bzno string, title string")
    pairs = lambda d: sorted((r.name, r.bzno) for r in d.collect())
    assert pairs(lexical.phrase_matches(names, titles, "name", "title")) == [("한빛", "1")]
    assert pairs(lexical.prefix_matches(names, titles, "name", "title")) == [("한빛", "1"), ("한빛", "2")]
    assert pairs(lexical.fuzzy_matches(names, titles, "name", "title", 1, 1)) == [("abcd", "3"), ("한빛", "1")]
    assert pairs(lexical.fuzzy_matches(names, titles, "name", "title", "AUTO", 0)) == [("abcd", "3"), ("abcd", "4"), ("한빛", "1")]
    assert [r.t for r in spark.range(1).select(lexical.tokens(F.lit("The Quick_1 개발, of")).alias("t")).collect()] == [["quick_1", "개발"]]


def test_skills(spark):
    assert skills.unwrap_pattern("r'(?i)java'").search("JAVA") and not skills.unwrap_pattern("java").search("JAVA")
    assert skills.unwrap_pattern("(") is None and skills.unwrap_pattern(None) is None
    known = [(f"A{k:03}", f"skill{k}", f"skill{k}") for k in range(30)] + [("Z1", "정반대", "skill1")]
    frame = spark.createDataFrame([(*k, None) for k in known], "skill_code string, skill_name string, ext_key string, softskill int")
    rows = spark.createDataFrame([("1", " ".join(f"skill{k}" for k in range(30)) + " A1, B2"), ("2", "none"), ("3", None)], "pst_id string, pst_detail string")
    got = skills.match_skills(rows, frame).collect()
    assert len(got) == 1 and [s.skill_code for s in got[0].skills] == [f"A{k:03}" for k in range(20)]
    lists = skills.joined_columns(skills.match_skills(rows, frame), frame).first()
    assert lists.skill_name.split(",")[0] == "skill0"


def test_expansion(spark):
    rows = spark.createDataFrame([("1", "A1, B2,C3", 1), ("2", "", 2), ("3", None, 3)], "pst_id string, skill_code string, month int")
    dictionary = spark.createDataFrame([("A1", "이름", 1)], "skill_code string, skill_name string, softskill int").withColumns({c: F.lit(None).cast("string") for c in schemas.SKILL if c not in ("skill_code", "skill_name", "softskill")})
    out = skills.expand(rows, dictionary)
    assert out.columns == schemas.EXPORT and {t for _, t in out.dtypes} == {"string"}
    assert sorted((r.pst_id, r.skill_code, r.skill_name, r.softskill) for r in out.collect()) == [("1", "A1", "이름", "1"), ("1", "B2", None, None), ("1", "C3", None, None)]


def test_export(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("EXPANDED_SKILLS_CSV_PATH", str(tmp_path / "out"))
    rows = spark.createDataFrame([("1", '한글, "인용"'), ("2", None)], "a string, b string")
    back = spark.read.option("header", True).option("escape", '"').csv(tables.export_csv(rows, one_file=True))
    assert sorted((r.a, r.b) for r in back.collect()) == [("1", '한글, "인용"'), ("2", None)]


def test_classifiers(spark):
    class Longest:
        def load(self):
            return 256

        def predict(self, model, texts):
            return [min(model, len(t)) for t in texts]

    rows = spark.createDataFrame([("01", "x" * 999), ("02", None)], "pst_id string, job_desc string")
    assert sorted((r.pst_id, r.predicted_occupation) for r in classify.predict_with(rows, Longest()).collect()) == [("01", 256), ("02", 0)]
    with pytest.raises(ValueError):
        classify.predict_with(rows.drop("job_desc"), Longest())
    train = spark.createDataFrame([(i, "개발 서버 코드" if i % 2 else "간호 병원 환자", i % 2) for i in range(40)], "pst_id int, t string, y int")
    got = classify.HashedLogistic(256).fit(train, "t", "y").predict(train, "pst_id", "t")
    assert all(r.predicted_occupation == r.pst_id % 2 for r in got.collect())


def test_stream(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    line = lambda i: "\t".join([str(i), "t", "c", "l", *["x"] * 7, "2024.03.11 14:31", "2024.03.12 14:31", DETAIL, "r", "a"])
    for k, numbers in enumerate([(1, 2), (2, 3)]):
        (source / f"{k}.csv").write_text("\t".join(schemas.SRM) + "\n" + "\n".join(map(line, numbers)) + "\n", encoding="utf-8")
        ingest.run(ingest.merged_stream(spark, "srm", str(source)), out, str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted((r.pst_id, r.source, r.month) for r in got.collect()) == [("1", "srm", 3), ("2", "srm", 3), ("3", "srm", 3)]


def test_whole_run(spark):
    kind = "pst_id string, pst_title string, co_nm string, loc string, pst_strt string, pst_detail string, corp_addr string, load_order long"
    rows = [("1", "t", "한빛소프트", "서울 강남구", "2024.02.01(목)", DETAIL + "skill1 skill2", "서울 강남구", 0), ("2", "t", None, None, None, DETAIL + "skill2", None, 1)]
    jk = spark.createDataFrame(rows, kind)
    firms = spark.createDataFrame([("1", "한빛소프트", "서울 강남구", "k", "k9")], "bzno string, title string, address string, ksic string, ksic9 string")
    dictionary = spark.createDataFrame([("A1", "skill1", "skill1"), ("A2", "skill2", "skill2")], "skill_code string, skill_name string, ext_key string").withColumns({c: F.lit(None).cast("string") for c in schemas.SKILL if c not in ("skill_code", "skill_name", "ext_key")})
    predictions = spark.createDataFrame([("1", 7)], "pst_id string, predicted_occupation int")
    occupations = spark.createDataFrame([(7, "k4", "kt")], "target int, keco_4 string, keco_t string")
    out = run.run(run.Inputs({"jk": jk}, firms, dictionary, occupations, predictions, fuzzy=True))
    assert sorted((r.pst_id, r.skill_code, r.bzno, r.keco_4) for r in out.collect()) == [("1", "A1", "1", "k4"), ("1", "A2", "1", "k4"), ("2", "A2", None, None)]


def test_partial_ratios_of_every_pair(spark, small_dir):
    names = {r.skill_code: r.skill_name for r in fixtures.skills(spark, small_dir).collect()}
    texts = {r.item_id: r.text.lower() for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()}
    got = {(r.item_id, r.skill_code): r.ratio for r in QUERIES["partial_ratios"](spark, small_dir).collect()}
    assert got.keys() == {(i, c) for i in texts for c in names}
    held = [(i, c) for i in texts for c in names if names[c] in texts[i]]
    assert held and all(got[x] == 100 for x in held)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


@pytest.mark.parametrize(("fuzziness", "prefix"), [(1, 2), (2, 1), ("AUTO", 0)])
def test_fuzzy_tokens_against_all_pairs(spark, fuzziness, prefix):
    rng = random.Random(prefix)
    make = lambda: "".join(rng.choice("가나b") for _ in range(rng.choice([1, 2, 4, 6])))
    words = sorted({make() for _ in range(90)})
    long = "".join(rng.choice("가나b") for _ in range(lexical.LONG_TOKEN))
    words += [long[:k] + x + long[k:] for k, x in ((9, ""), (9, "a"), (9, "aa"), (20, "b"), (24, "bb"))] + [long[:-1], long[:-2]]
    frame = spark.createDataFrame([(w,) for w in words], "name string")
    got = lexical.fuzzy_matches(frame, frame.select(F.col("name").alias("title")), "name", "title", fuzziness, prefix)
    most = lambda t: fuzziness if fuzziness != "AUTO" else 0 if len(t) < 3 else 1 if len(t) < 6 else 2
    want = {(a, b) for a in words for b in words if a[:prefix] == b[:prefix] and edits(a, b) <= most(a)}
    assert {(r.name, r.title) for r in got.collect()} == want


def test_stored_index(spark, tmp_path):
    rows = spark.createDataFrame([(1, "한빛 소프트 개발"), (2, "한빛 한빛"), (3, None)], "id int, t string")
    path, asked = str(tmp_path / "index"), spark.createDataFrame([("q", "한빛 개발 nowhere")], "q string, t string")
    assert lexical.write_index(rows, path, "id", "t") and not lexical.write_index(rows.limit(0), path, "id", "t")
    plain = lexical.bm25_top(rows, asked, "id", "t", "q", "t").collect()
    stored = lexical.index_top(lexical.read_index(spark, path), asked, "id", "q", "t").collect()
    assert sorted(map(tuple, stored)) == sorted(map(tuple, plain)) and [r.id for r in sorted(stored, key=lambda r: r["rank"])] == [1, 2]
    assert lexical.write_index(rows.limit(0), path, "id", "t", replace=True)
    assert lexical.index_top(lexical.read_index(spark, path), asked, "id", "q", "t").count() == 0
    cut = lexical.prepared(spark.createDataFrame([(None, None, "x" * 40_000), ("t", 3, None)], "co_nm string, month int, pst_detail string")).collect()
    assert sorted((r.co_nm, r.month, len(r.pst_detail)) for r in cut) == [("", 0, lexical.INDEXED), ("t", 3, 0)]


def test_fuzzy_month_against_a_plain_walk(spark):
    rng, base = random.Random(11), [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(150)] = f"x{rng.randrange(40)}"
        rows.append((f"{i:02}", rng.choice(["jk", "srm", "jkhd"]), rng.randrange(2), " ".join(own)))
    want = set()
    for month in (0, 1):
        own = [r for r in rows if r[2] == month]
        top = "srm" if any(r[1] == "srm" for r in own) else min(r[1] for r in own)
        kept = []
        for r in sorted(own, key=lambda r: (r[1] != top, r[1], r[0])):
            w = r[3].split()
            grams = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
            if not any(len(grams & g) / len(grams | g) >= 0.95 for g in kept):
                kept.append(grams)
                want.add(r[0])
    assert 2 < len(want) < 60
    assert set(ids(dedup.fuzzy_dedup_month(postings(spark, rows)))) == want


def test_frequent_shingles_come_last(spark, monkeypatch):
    """Boilerplate that all texts share proposes no pairs, and none is lost."""
    monkeypatch.setattr(dedup, "RARE", 3)
    shared = " ".join(f"b{i}" for i in range(60))
    rows = [(str(i), "jk", 1, f"{shared} " + " ".join(f"t{i // 2}x{j}" for j in range(60)) + (" end" if i % 2 else "")) for i in range(40)]
    got = {(r.a, r.b) for r in dedup.similar_texts(postings(spark, rows), "month").collect()}
    name = lambda i: hashlib.md5(rows[i][3].encode()).hexdigest()
    assert got == {tuple(sorted((name(i), name(i + 1)))) for i in range(0, 40, 2)}


def test_skill_dictionary_in_one_pass(spark, monkeypatch):
    rng = random.Random(3)
    keys = ["java", "(?i)Java", "script", "(?i)sk", "a.c", "(?i)c\\+\\+", "r'(?i)spring boot'", "SPARK"]
    known = [(f"A{k}", re_name, key) for k, (key, re_name) in enumerate((x, x.replace("(?i)", "").strip("r'").lower()) for x in keys)]
    own = [(c, n, skills.searcher(skills.unwrap_pattern(k))) for c, n, k in known]
    both = skills.Dictionary(own)
    monkeypatch.setattr(skills, "ahocorasick", None)
    plain = skills.Dictionary(own)
    for _ in range(300):
        text = " ".join(rng.choice(["Java", "javascript", "abc", "C++", "SPARK", "spark", "Spring Boot", "ſk", "ß"]) for _ in range(6))
        assert skills.tag(text, both, least=0) == skills.tag(text, plain, least=0)
    assert not plain.folded and both.folded and skills.tag("nothing", both) == []


def test_skill_dictionary_file(spark, tmp_path):
    path = tmp_path / "skills.csv"
    names = [c for c in schemas.SKILL if c != "softskill"]
    line = lambda code, name: ",".join({"skill_code": code, "skill_name": name, "ext_key": '"r\'(?i)a,b\'"'}.get(c, "x") for c in names)
    path.write_text(",".join(names) + "\n" + line("A1", "first") + "\n" + line("A1", "second") + "\n" + line("B2", "other") + "\n")
    got = tables.read_skills(spark, str(path)).orderBy("skill_code").collect()
    assert [(r.skill_code, r.skill_name, r.softskill, r.ext_key) for r in got] == [("A1", "first", None, "r'(?i)a,b'"), ("B2", "other", None, "r'(?i)a,b'")]
    path.write_text("skill_code\nA1\n")
    with pytest.raises(ValueError):
        tables.read_skills(spark, str(path))
    assert [r.category for r in tables.with_category(spark.createDataFrame([("A101",), ("A",)], "skill_code string")).collect()] == ["A1", "00"]


def test_sample_reload_and_pending(spark, tmp_path):
    rows = spark.createDataFrame([(f, i) for f in "ab" for i in range(5)], "file string, load_order long")
    assert sorted(map(tuple, tables.sample_per_file(rows, 2).collect())) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    files = spark.createDataFrame([("a",), ("b",)], "file_path string")
    ledger = tables.record(spark.createDataFrame([], schemas.LEDGER), files, "jk", schemas.COMPLETED)
    left = tables.forget_files(ledger, files.limit(1))
    assert [r.file_path for r in tables.pending_files(files, left).collect()] == ["a"]
    work = spark.createDataFrame([("1", None, 0), ("2", "", 1), ("3", "x", 1)], "pst_id string, skill_code string, matching_attempt int")
    assert ids(tables.pending_rows(work, "skill_code")) == ["1", "2"] and ids(tables.pending_rows(work, "skill_code", 1)) == ["2"]
    matched = work.withColumn("matched_company_name", F.col("skill_code")).withColumn("matching_attempt", F.lit(2))
    assert sorted((r.pst_id, r.matching_attempt) for r in match.reset_attempts(matched).collect()) == [("1", 0), ("2", 2), ("3", 2)]
    assert all(r.matching_attempt == 0 for r in match.reset_attempts(matched, every=True).collect())
    assert [match.policy_of_attempt(k).name for k in range(5)] == ["strict", "moderate", "relaxed", "relaxed", "relaxed"]
    path = str(tmp_path / "copy")
    tables.backup(work, path)
    tables.backup(work.limit(0), path)
    assert spark.read.parquet(path).count() == 3 and tables.has_rows(work, "pst_id") and not tables.has_rows(work, "none") and not tables.table_ready(spark, "no_such_table")
    assert work.select(dedup.text_preview("skill_code", 1).alias("p")).filter("p = 'x'").count() == 1
    assert classify.same_shaped({"a": random, "b": 1}, {"a": random, "c": 2}) == {"a": random}


def test_names_are_matched_in_all_postings(spark, small_dir):
    orders = spark.read.parquet(f"{small_dir}/orders.parquet").count()
    assert fixtures.mentions(spark, small_dir).count() == orders


def test_similarities_below_100(spark, small_dir):
    """Every posting and skill: the pattern's word in the text, then all windows."""
    known = [(r.skill_code, r.skill_name, r.ext_key) for r in fixtures.misspelt_skills(spark, small_dir).collect()]
    want, ratios = {}, set()
    for r in fixtures.postings(spark, small_dir).filter("length(pst_detail) < 500").collect():
        text, found = " ".join(r.pst_detail.split()), []
        for code, name, key in known:
            word, fold = re.search("([a-z]+)'?$", key).group(1), "(?i)" in key
            if word in (text.lower() if fold else text):
                ratio = brute_ratio(name, text.lower())
                if ratio >= 70:
                    found.append((-ratio, code))
        for place, (ratio, code) in enumerate(sorted(found)[:20], 1):
            want[r.pst_id, code] = (pytest.approx(-ratio, abs=1e-6), place)
            ratios.add(round(-ratio))
    got = {(r.pst_id, r.skill_code): (r.similarity, r.place) for r in QUERIES["skill_match_misspelt"](spark, small_dir).collect()}
    shorter = {r.pst_id for r in fixtures.postings(spark, small_dir).filter("length(pst_detail) < 500").collect()}
    assert {k: v for k, v in got.items() if k[0] in shorter} == want and len(ratios) > 4 and min(ratios) < 90
