import random
import re

import pytest
from pyspark.sql import functions as F

from jobloom.functions import similarity, text


def value(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    ("given", "want"),
    [("(주)한글 회사!ABC", "한글 회사ABC"), ("㈜가나 [본사]", "가나"), (None, ""), ("", ""), ("유한책임회사 가　나", "가 나"), ("a_b-c", "a_bc")],
)
def test_company_names(spark, given, want):
    assert value(spark, text.normalize_company_name(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize(("given", "want"), [("경기도 광주시", "광주"), ("전북특별자치도 전주시", "전북"), ("Tokyo", ""), (None, ""), ("서울 강남구", "서울")])
def test_regions(spark, given, want):
    assert value(spark, text.normalize_region(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [("서울특별시 강남구", "서울 서울특별시"), ("서울 강남구", "서울 강남구"), ("경기도 성남시 분당구", "경기 성남시"), ("대구 수성구", "대구 대구"), ("제주", "제주"), ("x", ""), (None, "")],
)
def test_addresses(spark, given, want):
    assert value(spark, text.extract_address(F.lit(given).cast("string"))) == want


def test_posting_text(spark):
    body = "<p>글로벌 기업 (주)테스트컴퍼니에서</p> 경력 개발자를 채용합니다. " + "함께 성장할 인재를 찾습니다 " * 4
    plain = re.sub(r"\s+", " ", re.sub("<[^>]+>", " ", body)).strip()
    assert value(spark, text.preprocess_text(F.lit(body))) == plain[: len(plain) // 3].strip()
    assert value(spark, text.preprocess_text(F.lit(None).cast("string"))) == ""


def test_keyword_cut_is_a_fold(spark):
    rng = random.Random(1)
    for _ in range(30):
        own = "".join(rng.choice(["포지션", "모집부문", "가", "나", " "]) for _ in range(60))
        want = own
        for k in text.CUT_KEYWORDS:
            if want.find(k) > 50:
                want = want[: want.find(k)]
        assert value(spark, text.cut_at_keywords(F.lit(own))) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [("업무 소개 근무 조건 주5일", "업무 소개"), ("근무조건 주5일", "근"), ("*** 입사 지원 안내", "안내"), (None, ""), ("그대로  둔다", "그대로 둔다"), ("a 상세 사항 전화 문의 요망 b", "a b")],
)
def test_descriptions(spark, given, want):
    assert value(spark, text.preprocess_description(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("삼성", "삼성전자", 0.25), ("한국전", "한국전력공사", 0.4), ("ABC", "abc", 1.0), ("가", "나", 0.2), ("현대자동차", "현대모비스", 0.346429), ("가나다", "나가다", 0.5), ("대한상사", "대한상시", 0.63), ("", "x", 0.0), (None, "x", 0.0)],
)
def test_name_similarity(spark, a, b, want):
    assert value(spark, similarity.name_similarity(F.lit(a).cast("string"), F.lit(b))) == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize(
    ("given", "want"),
    [("2024.02.01(목)", "2024-02-01 00:00:00"), ("2024.03.11 14:31", "2024-03-11 14:31:00"), ("상시채용", None), ("", None), (None, None), ("2024.02.30(금)", None)],
)
def test_posting_time(spark, given, want):
    got = value(spark, text.posting_time(F.lit(given).cast("string")))
    assert (str(got) if got else None) == want


def test_year_and_month(spark):
    year, month = text.year_and_month(F.lit("~ 2024.02.01(목) 마감"))
    assert (value(spark, year), value(spark, month)) == (2024, 2)
    year, month = text.year_and_month(F.lit(None).cast("string"))
    assert value(spark, year) is None and value(spark, month) is None


def test_small_functions(spark):
    assert [value(spark, text.skill_category(F.lit(c))) for c in ("A101", "A")] == ["A1", "00"]
    assert [value(spark, text.whole_number(F.lit(x).cast("string"))) for x in ("12", "abc", None, "3.7", "nan")] == [12, -1, -1, 3, -1]
    assert value(spark, text.clean_field(F.lit("a\nb\rc\u0000d"))) == "a b cd"
    assert value(spark, text.title_and_detail(F.lit(None).cast("string"), F.lit("d"))) == "d"
    assert value(spark, text.title_and_detail(F.lit("t"), F.lit(None).cast("string"))) == "t "


def brute_ratio(a, b):
    short, long = sorted((a, b), key=len)

    def common(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            last = 0
            for j, d in enumerate(y):
                last, row[j + 1] = row[j + 1], last + 1 if c == d else max(row[j + 1], row[j])
        return row[-1]

    m = len(short)
    parts = [long[max(0, e - m) : min(e, len(long))] for e in range(1, len(long) + m)]
    return max(200.0 * common(short, p) / (m + len(p)) for p in parts)


def test_best_window_ratio():
    rng = random.Random(0)
    for _ in range(400):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in "xy")
        assert similarity.best_window_ratio(a, b) == pytest.approx(brute_ratio(a, b))
    assert similarity.best_window_ratio("", "x") == 0.0 and similarity.best_window_ratio("ab", "xxabyy") == 100.0
