"""Text functions as Column expressions.

Python's \\w and \\s cover Unicode, Java's do not; so classes are spelt out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.let import let

#: What Python's \\s matches in a str.
BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"

# Legal forms that are no part of a company's name.
LEGAL_FORMS = (
    r"\(주\)", r"\(유\)", r"\(무\)", r"\(의\)", r"\(조\)", r"\(합\)", r"\(쭈\)", r"\(재\)", r"\(사\)", r"\(재단법인\)", r"\(사단법인\)",
    "주식회사", "유한회사", "합자회사", "합명회사", "유한책임회사", "사단법인", "재단법인", "㈜", "㈔", r"\[본사\]",
)

# Spellings of regions, the first that is contained decides.
REGION_SPELLINGS = (
    ("서울특별시", "서울"), ("서울시", "서울"), ("서울 ", "서울"), ("부산광역시", "부산"), ("부산시", "부산"), ("인천광역시", "인천"), ("인천시", "인천"),
    ("대구광역시", "대구"), ("대구시", "대구"), ("대전광역시", "대전"), ("대전시", "대전"), ("광주광역시", "광주"), ("광주시", "광주"), ("울산광역시", "울산"),
    ("울산시", "울산"), ("세종특별자치시", "세종"), ("세종시", "세종"), ("경기도", "경기"), ("강원도", "강원"), ("충청북도", "충북"), ("충북도", "충북"),
    ("충청남도", "충남"), ("충남도", "충남"), ("전라북도", "전북"), ("전북도", "전북"), ("전라남도", "전남"), ("전남도", "전남"), ("경상북도", "경북"),
    ("경북도", "경북"), ("경상남도", "경남"), ("경남도", "경남"), ("제주특별자치도", "제주"), ("제주도", "제주"),
)
REGIONS = ("서울", "부산", "인천", "대구", "대전", "광주", "울산", "세종", "경기", "강원", "충북", "충남", "전북", "전남", "경북", "경남", "제주")

# Headings behind which the company's own words end, in this order.
CUT_KEYWORDS = (
    "포지션", "모집부문", "모집분야", "채용분야", "담당업무", "모집직종", "직무내용", "업무내용", "지원자격", "지원방법", "지원서류", "근무조건",
    "자격요건", "자격조건", "우대사항", "주요업무", "근무지역", "근무시간", "급여조건", "복리후생", "접수방법", "전형방법", "지원기간", "접수기간",
    "모집요강", "채용공고", "공고기간", "지원내용", "채용내용", "모집내용",
)
#: Boilerplate; \s stands for BLANK. Each holds one of its marks.
BOILERPLATE = (
    r"채용제목을?\s*입력해?주세요", r"또는\s*개인\s*양식\s*이력서\s*접수\s*가능", r"인턴\s*기간\s*\p{Nd}+개월\s*법정\s*임금\s*준수", r"[가-힣]+점\s*채용", "채용공고",
    r"지원서\s*접수", r"이력서\s*접수", "모집공고", "채용안내", r"☞\s*.*\s*바로가기\s*☜", r"내용을\s*입력해?주세요", r"홈페이지\s*바로가기", r"블로그\s*바로가기",
    r"\[안내\]", r"\[공지\]", r"\[모집\]", r"\[채용\]",
)
BOILERPLATE_MARKS = (
    "채용제목", "또는", "인턴", "채용", "채용공고", "지원서", "이력서", "모집공고", "채용안내", "☞", "내용을", "홈페이지", "블로그", "[안내]", "[공지]", "[모집]", "[채용]",
)
# Boilerplate and section headings of descriptions.
DESCRIPTION_BOILERPLATE = (
    r"기업\s*소개\s*또는\s*채용\s*안내를\s*작성해\s*보세요\s*불필요시\s*'?소개글'?을\s*OFF하면\s*소개\s*영역이\s*숨겨집니다\.?",
    r"\*{3}\s*입사\s*지원",
    r"\*{3}\s*온라인\s*이력서",
    r"유의\s*사항\s*[ㆍ·]\s*학력[,\s]*성별[,\s]*연령을\s*보지\s*않는\s*블라인드\s*채용입니다\.?",
    r"입사\s*지원\s*서류에\s*허위\s*사실이\s*발견될\s*경우[,\s]*채용\s*확정\s*이후라도\s*채용이\s*취소될\s*수\s*있습니다\.?",
    r"모집\s*분야별로\s*마감일이\s*상이할\s*수\s*있으니\s*유의하시길\s*바랍니다\.?",
    r"상세\s*사항\s*전화\s*문의\s*요망",
    r"접수된\s*지원서는\s*최초\s*접수일로부터\s*1년간\s*보관되며\s*1년이\s*경과된\s*뒤에는\s*자동\s*파기",
    r"급여\s*및\s*복리후생은\s*당사\s*규정에\s*준하여\s*적용",
    r"3개월\s*근무\s*평가\s*후\s*정규직\s*전환\s*면접\s*실시",
    r"이력서\s*등\s*제출\s*서류에\s*허위\s*사실이\s*있을\s*시\s*채용\s*취소",
    r"자세한\s*상세\s*요강은\s*반드시\s*채용\s*홈페이지에서\s*직접\s*확인해\s*주시기\s*바랍니다",
)
DESCRIPTION_HEADINGS = (
    r"혜택\s*및\s*복지", r"근무\s*조건", r"전형\s*절차", r"접수\s*기간", r"지원\s*방법", r"지원\s*자격", r"채용\s*절차", r"제출\s*서류", r"기타\s*사항",
    r"복지\s*제도", r"급여\s*및", r"근무\s*형태", r"근무\s*환경", r"복리\s*후생", r"서류\s*전형", r"접수된\s*지원서",
)


def _java(pattern: str) -> str:
    """\\s as Python has it, also inside of brackets."""
    return pattern.replace(r"[,\s]", "[," + BLANK[1:]).replace(r"\s", BLANK)


def text_of(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, BLANK + "+", " "))


def clean_field(column: Column | str) -> Column:
    """Line ends as spaces, NUL characters gone."""
    return F.translate(F.col(column) if isinstance(column, str) else column, "\n\r\u0000", "  ")


def normalize_company_name(column: Column | str) -> Column:
    """Without legal forms and without anything but letters, digits, _ and spaces."""
    text = text_of(column)
    # each form holds one of these
    marked = reduce(Column.__or__, [F.contains(text, F.lit(m)) for m in ("(", "회사", "법인", "㈜", "㈔", "[본사]")])
    text = F.when(marked, F.regexp_replace(text, "|".join(LEGAL_FORMS), "")).otherwise(text)
    return squeeze(F.regexp_replace(text, r"[^\p{L}\p{N}_\s\p{Z}\x1c-\x1f\x85]", ""))


def normalize_region(column: Column | str) -> Column:
    """Province or city of a place name, '' if none is in it."""
    text, found = text_of(column), F
    for spelling, region in [*REGION_SPELLINGS, *((r, r) for r in REGIONS)]:  # the first that is met ends the search
        found = found.when(F.contains(text, F.lit(spelling)), F.lit(region))
    return found.otherwise("")


def extract_address(column: Column | str) -> Column:
    """Region and the first word that ends in a city, county or ward."""
    text = text_of(column)
    local = F.regexp_extract(text, "([가-힣]+시|[가-힣]+군|[가-힣]+구)", 1)
    return let(F.struct(normalize_region(text).alias("r"), local.alias("l")), lambda x: _address(x["r"], x["l"]))


def _address(region: Column, local: Column) -> Column:
    return F.when(region == "", F.lit("")).when(local == "", region).otherwise(F.concat_ws(" ", region, local))


def head_of_text(column: Column | str) -> Column:
    """Without tags, the first third but at most 200 characters."""
    tagless = lambda t: F.when(F.contains(t, F.lit("<")), F.regexp_replace(t, "<[^>]+>", " ")).otherwise(t)
    return let(squeeze(let(text_of(column), tagless)), lambda t: F.substring(t, F.lit(1), F.least(F.floor(F.length(t) / 3), F.lit(200)).cast("int")))


def cut_at_keywords(text: Column, keywords: tuple[str, ...] = CUT_KEYWORDS, least: int = 50) -> Column:
    """Each keyword in turn cuts where it is first met, if more than `least`
    characters stay; a fold, so that the expression stays small."""
    place = lambda a, k: F.call_function("locate", k, a)
    step = lambda a, k: F.when(place(a, k) > least + 1, F.substring(a, F.lit(1), place(a, k) - 1)).otherwise(a)
    return F.aggregate(F.array(*[F.lit(k) for k in keywords]), text, step)


def preprocess_text(column: Column | str) -> Column:
    """The part of a posting that names the company. A pattern is tried on texts with
    its mark only."""
    text = cut_at_keywords(head_of_text(column))
    without = lambda pattern, mark: lambda t: F.when(F.contains(t, F.lit(mark)), F.regexp_replace(t, _java(pattern), " ")).otherwise(t)
    for pattern, mark in zip(BOILERPLATE, BOILERPLATE_MARKS, strict=True):
        text = let(text, without(pattern, mark))
    return squeeze(text)


def title_and_detail(title: Column | str, detail: Column | str) -> Column:
    title = F.col(title) if isinstance(title, str) else title
    return F.concat(F.coalesce(F.concat(title, F.lit(" ")), F.lit("")), text_of(detail))


def preprocess_description(column: Column | str) -> Column:
    """Without boilerplate, up to the first section heading; a heading at the very
    start leaves one character."""

    def cleaned(text: Column) -> Column:
        for pattern in DESCRIPTION_BOILERPLATE:
            text = F.regexp_replace(text, "(?iu)" + _java(pattern), "")
        return text

    heading = F.lit("(?iu)(" + "|".join(map(_java, DESCRIPTION_HEADINGS)) + ")")
    cut = lambda x: F.when(x["p"] > 0, F.substring(x["t"], F.lit(1), F.greatest(x["p"] - 1, F.lit(1)))).otherwise(x["t"])
    shorter = lambda text: let(cleaned(text), lambda t: let(F.struct(t.alias("t"), F.regexp_instr(t, heading).alias("p")), cut))
    # every pattern holds a Hangul syllable, so a text without any stays as it is
    return squeeze(let(text_of(column), lambda t: F.when(t.rlike("[가-힣]"), shorter(t)).otherwise(t)))


def posting_time(column: Column | str) -> Column:
    """YYYY.MM.DD(weekday) or YYYY.MM.DD HH:MM as a timestamp, else null."""
    text = F.col(column) if isinstance(column, str) else column
    day = F.try_to_timestamp(F.regexp_extract(text, r"^(\d{4}\.\d{2}\.\d{2})", 1), F.lit("yyyy.MM.dd"))
    minute = F.try_to_timestamp(text, F.lit("yyyy.MM.dd HH:mm"))
    return F.when(text.rlike(r"^\d{4}\.\d{2}\.\d{2}\([\p{L}\p{N}_]+\)$"), day).when(text.rlike(r"^\d{4}\.\d{2}\.\d{2} \d{2}:\d{2}$"), minute)


def year_and_month(column: Column | str) -> tuple[Column, Column]:
    """Of the first date in the text, of either form."""
    text = text_of(column)
    form = r"(\d{4})\.(\d{2})\.\d{2}\([\p{L}\p{N}_]+\)", r"(\d{4})\.(\d{2})\.\d{2} \d{2}:\d{2}"
    pick = lambda group: F.coalesce(*[F.nullif(F.regexp_extract(text, p, group), F.lit("")) for p in form]).try_cast("int")
    return pick(1), pick(2)


def skill_category(code: Column | str) -> Column:
    """The first two characters of a code, 00 of a shorter one."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(F.length(code) >= 2, F.substring(code, 1, 2)).otherwise(F.lit("00"))


def whole_number(column: Column | str, otherwise: int = -1) -> Column:
    """Text as an integer, fractions cut off, what is no number as `otherwise`."""
    text = F.col(column) if isinstance(column, str) else column
    number = F.trim(text.cast("string")).try_cast("double")
    return F.coalesce(F.when(F.isnan(number), None).otherwise(number).try_cast("int"), F.lit(otherwise))
