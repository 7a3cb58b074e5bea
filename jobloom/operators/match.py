"""Postings matched to a company register, by name and by text, under policies
that are relaxed step by step."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions.let import let
from jobloom.functions.lineage import forget, stored
from jobloom.functions.similarity import name_parts, parts_similarity, prefix_similarity
from jobloom.functions.text import BLANK, extract_address, normalize_company_name, normalize_region, preprocess_text, text_of, title_and_detail
from jobloom.operators import lexical
from jobloom.sources.tables import first_wins


@dataclass(frozen=True)
class Policy:
    """Thresholds of one step. `discount` is taken off the score thresholds."""

    name: str
    short: int
    very_short: int
    similarity_short: float
    similarity: float
    score_short: float
    score: float
    fuzziness: int | str
    prefix: int
    name_weight: float
    region_weight: float
    address_weight: float
    detail_least: float
    detail_region: float
    detail_address: float
    discount: float = 0.1


# Thresholds and weights of the policies.
STRICT = Policy(
    "strict", short=3, very_short=4, similarity_short=0.8, similarity=0.7, score_short=0.85, score=0.75, fuzziness=1, prefix=2,
    name_weight=0.6, region_weight=0.3, address_weight=0.2, detail_least=0.35, detail_region=0.35, detail_address=0.25, discount=0.0,
)
MODERATE = Policy(
    "moderate", short=2, very_short=3, similarity_short=0.7, similarity=0.6, score_short=0.7, score=0.65, fuzziness=2, prefix=1,
    name_weight=0.65, region_weight=0.2, address_weight=0.15, detail_least=0.3, detail_region=0.3, detail_address=0.2,
)
RELAXED = Policy(
    "relaxed", short=2, very_short=2, similarity_short=0.55, similarity=0.45, score_short=0.6, score=0.5, fuzziness="AUTO", prefix=1,
    name_weight=0.7, region_weight=0.2, address_weight=0.1, detail_least=0.25, detail_region=0.15, detail_address=0.1,
)
VERY_RELAXED = Policy(
    "very_relaxed", short=2, very_short=2, similarity_short=0.4, similarity=0.3, score_short=0.5, score=0.4, fuzziness="AUTO:4,7", prefix=1,
    name_weight=0.8, region_weight=0.15, address_weight=0.05, detail_least=0.2, detail_region=0.2, detail_address=0.1,
)
POLICIES = (STRICT, MODERATE, RELAXED)

# Words that are no company's name.
BLOCKED = (
    "개인", "주", "담당", "가능", "접수", "채용", "모집", "인턴", "지원", "임금", "법정", "준수", "기간", "입사", "경력", "신입", "정규직", "계약직", "파견", "아르바이트", "공고", "채용공고", "지원서",
    "이력서", "지원자", "모집요강", "급여", "복지", "사원", "대리", "과장", "차장", "부장", "팀장", "매니저", "사무직", "영업직", "기술직", "포지션", "직무", "직책", "직위", "담당자", "전문가", "바리스타",
    "디자이너", "개발자", "상사", "기업", "업체", "회사", "주식회사", "법인", "그룹", "컴퍼니", "유한회사", "합자회사", "주식회사의", "인재", "비전", "안내", "문의", "설명회", "상세", "한남", "서현", "여수",
    "구로", "강남", "강서", "송파", "마포", "용산", "종로", "성동", "동작", "영등포", "금천", "관악", "동대문", "서대문", "성북", "강북", "도봉", "노원", "중랑", "광진", "인천", "부산", "대구",
    "광주", "대전", "울산", "세종", "경기", "강원", "충북", "충남", "전북", "전남", "준수(주)", "부동산", "25퍼센트", "이미지", "구내식당",
)
EXCLUDED_TITLES = ("준수(주)", "주", "주식회사의", "포지션", "회사", "부동산", "25퍼센트", "이미지", "바리스타", "인천", "구내식당")
SHORT_IN_TEXT = ("sk", "lg", "cj", "kt", "gs", "ds", "hp", "nc", "db", "kb", "sc", "sj", "gm")
SHORT_NAMES = ("sk", "lg", "cj", "kt", "gs", "db", "sc")
# A name beside a mark of a legal form.
MARKED_NAMES = (
    r"(\S+)\s*\(주\)", r"(\S+)\s*㈜", r"(\S+)\s*주식회사", r"주식회사\s*(\S+)", r"\(주\)\s*(\S+)", r"㈜\s*(\S+)", r"(\S+)\s*\(유\)", r"\(유\)\s*(\S+)",
    r"(\S+)\s*\(합\)", r"\(합\)\s*(\S+)", r"(\S+)\s*\(재\)", r"\(재\)\s*(\S+)", r"재단법인\s*(\S+)", r"(\S+)\s*재단법인", r"사단법인\s*(\S+)", r"(\S+)\s*사단법인",
)
#: A blank that is no space.
OTHER_BLANK = BLANK[:-1] + "&&[^ ]]"
LEGAL_MARK = r"(\([주유]\)|주식회사|유한회사|[㈜㈔])"
MARKED_CONFIDENCE, TITLE_CONFIDENCE, PLAIN_CONFIDENCE = 0.9, 0.95, 0.7
NAME_CANDIDATES, TEXT_CANDIDATES = 5, 10
#: What matching by name reads of a prepared posting.
NAMED = ("pst_id", "processed_co_nm", "region_m", "address_m")


def prepare_postings(rows: DataFrame) -> DataFrame:
    """With processed_co_nm, region_m, address_m and processed_pst_detail."""
    return rows.withColumns(
        {
            "processed_co_nm": normalize_company_name("co_nm"),
            "region_m": normalize_region("loc"),
            "address_m": extract_address("corp_addr"),
            "processed_pst_detail": preprocess_text(title_and_detail("pst_title", "pst_detail")),
        }
    )


def prepare_companies(rows: DataFrame, order: str | None = None) -> DataFrame:
    """One row a bzno, the last loaded, with processed_title, region_m and address_m."""
    rows = rows if order else rows.withColumn("_order", F.monotonically_increasing_id())
    rows = first_wins(rows, ["bzno"], F.col(order or "_order").desc())
    rows = rows.drop("_order") if not order else rows
    return rows.withColumns({"processed_title": normalize_company_name("title"), "region_m": normalize_region("address"), "address_m": extract_address("address")})


def _company_side(companies: DataFrame) -> DataFrame:
    names = ["bzno", "title", "processed_title", "region_m", "address_m", "ksic", "ksic9"]
    return companies.select(*[F.col(c).alias(f"c_{c}") for c in names])


def _java(pattern: str) -> str:
    return pattern.replace(r"\S", "[^" + BLANK[1:]).replace(r"\s", BLANK)


def _mark(pattern: str) -> str:
    """The mark of a legal form in a pattern of MARKED_NAMES."""
    return pattern.replace(r"(\S+)", "").replace(r"\s*", "").replace("\\", "")


def _blocked(name: Column) -> Column:
    return F.lower(name).isin(*BLOCKED)


def _best(rows: DataFrame, by: list[str], score: str, k: int, tie: str = "c_bzno") -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), tie)
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def _register(companies: DataFrame) -> DataFrame:
    """The companies among which names are searched: of one title only the first
    NAME_CANDIDATES can be among a name's best; _k numbers them."""
    of_title = Window.partitionBy("c_processed_title").orderBy("c_bzno")
    return stored(_company_side(companies).withColumn("_k", F.row_number().over(of_title)).filter(F.col("_k") <= NAME_CANDIDATES))


def name_candidates(postings: DataFrame, companies: DataFrame, policy: Policy) -> DataFrame:
    """(processed_co_nm, c_..., similarity): of each distinct name the companies found
    by phrase and, if it isn't short, by prefix and by fuzzy tokens, that pass the
    similarity threshold; the NAME_CANDIDATES most similar, ties to smaller bzno.

    Names meet distinct titles; of the titles those count that are best with their
    first company."""
    return _candidates(postings, _register(companies), policy)


def _candidates(postings: DataFrame, side: DataFrame, policy: Policy) -> DataFrame:
    """name_candidates among the companies of _register."""
    names = stored(postings.select("processed_co_nm").filter("processed_co_nm <> ''").distinct())
    first = side.filter("_k = 1 and c_processed_title <> ''").select("c_processed_title", F.col("c_bzno").alias("_first"))
    titles = first.select("c_processed_title")
    short = F.length("processed_co_nm") <= policy.short
    long_names = names.filter(~short)
    found = [
        lexical.phrase_matches(names, titles, "processed_co_nm", "c_processed_title"),
        lexical.prefix_matches(long_names, titles, "processed_co_nm", "c_processed_title"),
        lexical.fuzzy_matches(long_names, titles, "processed_co_nm", "c_processed_title", policy.fuzziness, policy.prefix, policy.similarity),
    ]
    # pairs by their keys, then the parts of each name, computed once
    least = F.when(short, policy.similarity_short).otherwise(policy.similarity)
    pairs = reduce(DataFrame.unionByName, [d.select("processed_co_nm", "c_processed_title") for d in found])
    pairs = stored(pairs.filter(F.coalesce(prefix_similarity("processed_co_nm", "c_processed_title"), F.lit(1.0)) >= least).distinct())
    every = pairs.join(names.withColumn("_x", name_parts("processed_co_nm")).hint("merge"), "processed_co_nm")
    every = every.join(first.withColumn("_y", name_parts("c_processed_title")).hint("merge"), "c_processed_title")
    every = every.withColumn("similarity", parts_similarity(F.col("_x"), F.col("_y"))).drop("_x", "_y")
    every = every.filter(F.col("similarity") >= least)
    best = _best(every, ["processed_co_nm"], "similarity", NAME_CANDIDATES, "_first").drop("_first")
    return _best(best.join(side.drop("_k").hint("merge"), "c_processed_title"), ["processed_co_nm"], "similarity", NAME_CANDIDATES)


def _agreements(rows: DataFrame) -> DataFrame:
    same = lambda k: (F.coalesce(F.col(k), F.lit("")) != "") & F.coalesce(F.col(k) == F.col(f"c_{k}"), F.lit(False))
    return rows.withColumns({"same_region": same("region_m"), "same_address": same("address_m")})


def _match_type(kind: str) -> Column:
    both = F.when(F.col("same_region") & F.col("same_address"), "region_address").when(F.col("same_region"), "region").when(F.col("same_address"), "address").otherwise("only")
    return F.concat(F.lit(kind + "_"), both, F.lit("_match"))


def _result(rows: DataFrame, kind: str, score: str, confidence: str, policy: Policy) -> DataFrame:
    return rows.select(
        "pst_id",
        F.col("c_title").alias("matched_company_name"),
        F.col("c_bzno").alias("bzno"),
        F.col("c_ksic").alias("ksic"),
        F.col("c_ksic9").alias("ksic9"),
        F.col(score).alias("score"),
        F.col(confidence).alias("confidence"),
        _match_type(kind).alias("match_type"),
        F.lit(policy.name).alias("matching_policy"),
    )


def _named(postings: DataFrame) -> DataFrame:
    """What matching by name reads of postings; their names are read beside it."""
    return stored(postings.filter("coalesce(co_nm, '') <> ''").select(*NAMED)).filter("processed_co_nm <> ''")


def _by_name(named: DataFrame, side: DataFrame, policy: Policy, left: bool = False) -> DataFrame:
    """named, each posting with its best match or none: `matched` marks the match of a
    pst_id, `left` (where asked for) the postings of those without any. A name's few
    candidates come to its postings as an array, so no row is made for each of them."""
    of_name = ["c_bzno", "c_title", "c_region_m", "c_address_m", "c_ksic", "c_ksic9"]
    candidates = _candidates(named, side, policy).groupBy("processed_co_nm")
    candidates = stored(candidates.agg(F.collect_list(F.struct("similarity", *of_name)).alias("found")))  # NAME_CANDIDATES at most
    size = F.length("processed_co_nm")
    same = lambda c, k: (F.coalesce(F.col(k), F.lit("")) != "") & F.coalesce(F.col(k) == c[f"c_{k}"], F.lit(False))
    bonus = lambda c, w: F.when(c, w).otherwise(0.0)
    least = F.when(size <= policy.short, policy.score_short - policy.discount).otherwise(policy.score - policy.discount)

    def scored(c: Column) -> Column:
        region, address = same(c, "region_m"), same(c, "address_m")
        score = c["similarity"] * policy.name_weight + bonus(region, policy.region_weight) + bonus(address, policy.address_weight)
        # rounded, so that a score that equals the threshold on paper passes; the least struct is the best candidate
        order = (-F.round(score, 9)).alias("unfit"), (-c["similarity"]).alias("unlike"), c["c_bzno"].alias("c_bzno")
        return F.struct(*order, region.alias("same_region"), address.alias("same_address"), *[c[k].alias(k) for k in ("c_title", "c_ksic", "c_ksic9")])

    def passes(c: Column) -> Column:
        enough = -c["unfit"] >= F.round(least, 9)
        return enough & ((size > policy.very_short) | c["same_region"] | c["same_address"]) if policy.name == "strict" else enough

    best = F.array_min(F.filter(F.transform("found", scored), passes)).alias("best")
    rows = named.join(candidates.hint("merge"), "processed_co_nm", "left" if left else "inner").select(*NAMED, best)
    rows = rows if left else rows.filter("best is not null")
    order = Window.partitionBy("pst_id").orderBy(F.col("best").asc_nulls_last())
    rows = rows.withColumns({"_n": F.row_number().over(order), "_top": F.first("best").over(order)})
    rows = rows.withColumns({"matched": (F.col("_n") == 1) & F.col("best").isNotNull(), "left": F.col("_top").isNull() | F.col("pst_id").isNull()})
    kept = {k: F.when(F.col("left"), F.col(k)) for k in NAMED[1:]} | {"best": F.when(F.col("matched"), F.col("best"))}
    return rows.filter("matched or left").drop("_n", "_top").withColumns(kept)


def _named_result(rows: DataFrame, policy: Policy) -> DataFrame:
    matched = rows.filter("matched").select("pst_id", "best.*").withColumn("score", -F.col("unfit"))
    return _result(matched, "name", "score", "score", policy)


def match_by_name(postings: DataFrame, companies: DataFrame, policy: Policy) -> DataFrame:
    """At most one match a posting, scored by name, region and address. Candidates
    are found once for each distinct name."""
    return _named_result(_by_name(_named(postings), _register(companies), policy), policy)


def potential_names(text: Column, marked: float = MARKED_CONFIDENCE) -> Column:
    """array of (name, confidence): the first one, two and three words of the first
    sentence, and the words beside marks of legal forms."""
    sentence = F.trim(F.regexp_extract(text, r"^([^.!?]+)[.!?]", 1))
    entry = lambda name, confidence: F.struct(name.alias("name"), F.lit(confidence).alias("confidence"))

    def begins(word: Column) -> Column:
        head = F.try_element_at(word, F.lit(1))
        first = F.when((F.length(head) >= 2) & ~_blocked(head), head)
        several = [F.when((F.size(word) >= n) & (F.length(F.array_join(F.slice(word, 1, n), " ")) > n), F.array_join(F.slice(word, 1, n), " ")) for n in (2, 3)]
        return F.transform(F.array_compact(F.array(first, *several)), lambda n: entry(n, PLAIN_CONFIDENCE))

    plain = let(F.filter(F.split(sentence, r"[\s\p{Z}]+"), lambda w: w != ""), begins)
    none = F.array().cast("array<string>")
    each = lambda p: F.regexp_extract_all(text, F.lit(_java(p)), F.lit(1))
    # where all blanks are spaces, patterns needn't look for the others
    spaced = lambda p: F.regexp_extract_all(text, F.lit(p.replace(r"\S", "[^ ]").replace(r"\s", " ")), F.lit(1))
    # a pattern is tried on texts with its mark only
    beside = F.flatten(F.array(*[F.when(~F.contains(text, F.lit(_mark(p))), none).when(text.rlike(OTHER_BLANK), each(p)).otherwise(spaced(p)) for p in MARKED_NAMES]))
    beside = F.filter(beside, lambda n: (F.length(n) >= 2) & ~_blocked(n))
    return F.concat(plain, F.transform(beside, lambda n: entry(n, marked)))


def match_by_detail(postings: DataFrame, companies: DataFrame, policy: Policy) -> DataFrame:
    """At most one match a posting, from the names in its text and title, and from
    titles that hold the whole text. A phrase's relevance is its BM25 score."""
    again = preprocess_text(title_and_detail("pst_title", "pst_detail"))
    text = let(F.col("processed_pst_detail"), lambda d: F.when(F.length(text_of(d)) >= 20, d).otherwise(again))
    longest = companies.agg(*[F.max(F.length(lexical.token_line(c))).alias(c) for c in ("title", "processed_title")]).first()
    longest = max((n for n in longest if n), default=0)
    worth = lambda e: (F.length(e["name"]) > 2) | F.lower(e["name"]).isin(*SHORT_NAMES)

    def read(text: Column) -> Column:
        found = F.filter(F.concat(potential_names(text), potential_names(text_of("pst_title"), TITLE_CONFIDENCE)), worth)
        # no title holds a text that is longer than all of them, which mostly shows at its beginning
        size = lambda t: F.length(lexical.token_line(t))
        held = F.when(size(F.substring(text, F.lit(1), F.lit(longest + 8))) > longest, None).when(size(text) <= longest, text)
        return F.when(text != "", F.struct(held.alias("text"), found.alias("found")))

    # a text is read once; what is left of it is small
    rows = stored(postings.select("pst_id", "region_m", "address_m", let(text, read).alias("read"))).select("pst_id", "region_m", "address_m", "read.*")
    named = rows.select("pst_id", "region_m", "address_m", F.posexplode("found").alias("turn", "entry")).select("pst_id", "region_m", "address_m", "turn", "entry.name", "entry.confidence")
    rows = rows.filter("text is not null").drop("found")
    side = _company_side(companies)
    keys = named.select("name").distinct()
    phrases = [lexical.phrase_matches(keys, side, "name", c).withColumn("_title", F.col(c)) for c in ("c_title", "c_processed_title")]
    hits = reduce(DataFrame.unionByName, phrases)
    hits = _relevance(hits, companies).groupBy("name", "c_bzno").agg(F.max("relevance").alias("relevance"))
    top = Window.partitionBy("name").orderBy(F.col("relevance").desc(), "c_bzno")
    hits = hits.withColumn("_n", F.row_number().over(top)).filter("_n <= 5").drop("_n").join(side, "c_bzno")
    by_name = _agreements(named.join(hits, "name"))
    first = Window.partitionBy("pst_id", "c_bzno").orderBy("turn")
    by_name = by_name.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    bonus = F.when(F.col("same_region"), policy.detail_region).otherwise(0.0) + F.when(F.col("same_address"), policy.detail_address).otherwise(0.0)
    by_name = by_name.withColumns({"rank": F.lit(0), "score": F.col("relevance"), "adjusted": F.col("confidence") * F.col("relevance") / 10.0 + bonus})
    by_text = search_in_detail(rows, companies).withColumns({"rank": F.lit(1), "adjusted": F.col("score") / 15.0 + bonus})
    columns = ["pst_id", *[c for c in side.columns], "same_region", "same_address", "rank", "score", "adjusted"]
    every = by_name.select(columns).unionByName(by_text.select(columns))
    one = Window.partitionBy("pst_id", "c_bzno").orderBy("rank")
    every = every.withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n")
    best = _best(every, ["pst_id"], "adjusted", 1).filter(F.col("adjusted") >= policy.detail_least)
    return _result(best, "detail", "score", "adjusted", policy)


def _relevance(hits: DataFrame, companies: DataFrame) -> DataFrame:
    """hits with the BM25 score of name against _title, over the register's titles."""
    words = companies.select(F.explode(F.array_distinct(lexical.tokens("processed_title"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    stats = companies.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(lexical.tokens("processed_title"))).alias("avg_dl"))
    pairs = hits.select("name", "c_bzno", "_title").distinct().withColumn("dl", F.size(lexical.tokens("_title")))
    each = pairs.withColumn("token", F.explode(F.array_distinct(lexical.tokens("name"))))
    tf = F.size(F.filter(lexical.tokens("_title"), lambda t: t == F.col("token")))
    each = each.withColumn("tf", tf).join(words, "token", "left").crossJoin(F.broadcast(stats))  # one row
    idf = F.log(1 + (F.col("n") - F.coalesce("df", F.lit(0)) + 0.5) / (F.coalesce("df", F.lit(0)) + 0.5))
    k1, b = lexical.K1, lexical.B
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.greatest("avg_dl", F.lit(1.0))))
    return each.groupBy("name", "c_bzno", "_title").agg(F.sum(weight).alias("relevance"))


def search_in_detail(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Companies whose title holds the posting's whole text as a phrase, with points
    for how the title is met in the text; the TEXT_CANDIDATES best of each posting."""
    side = _company_side(companies).filter("coalesce(c_title, '') <> '' and c_processed_title <> ''")
    texts = rows.select("pst_id", "region_m", "address_m", "text")
    keys = texts.select(F.col("text").alias("name")).distinct()
    hits = reduce(DataFrame.unionByName, [lexical.phrase_matches(keys, side, "name", c).withColumn("_title", F.col(c)) for c in ("c_title", "c_processed_title")])
    hits = _relevance(hits, companies).groupBy("name", "c_bzno").agg(F.max("relevance").alias("relevance")).join(side, "c_bzno")
    found = _agreements(texts.join(hits, texts["text"] == hits["name"]))
    title, name, text = F.col("c_title"), F.col("c_processed_title"), F.col("text")
    head = F.substring(text, 1, 200)
    found = found.filter(~_blocked(name) & ~title.isin(*EXCLUDED_TITLES))
    found = found.filter((F.length(name) > 2) | F.lower(name).isin(*SHORT_IN_TEXT) | F.col("same_region") | F.col("same_address"))
    words = F.filter(F.split(name, " "), lambda w: (F.length(w) >= 3) & ~_blocked(w))
    any_in = lambda where: F.exists(words, lambda w: F.contains(where, w))
    long_enough = F.length(name) >= 3
    points = (
        F.when(F.contains(head, title), 10.0).when(F.contains(text, title), 8.0).when(F.contains(head, name), 7.0).when(F.contains(text, name), 5.0)
        .when(long_enough & any_in(head), 4.0).when(long_enough & any_in(text), 3.0).otherwise(0.0)
    )
    points = points * F.when(title.rlike(LEGAL_MARK), 1.2).otherwise(1.0) + F.least(F.col("relevance") / 20.0, F.lit(1.0))
    return _best(found.withColumn("score", points).filter("score > 0"), ["pst_id"], "score", TEXT_CANDIDATES)


def match(postings: DataFrame, companies: DataFrame, policy: Policy) -> DataFrame:
    """By name first; what has no name or no match, by text."""
    by_name = stored(match_by_name(postings, companies, policy))
    rest = postings.join(by_name.select("pst_id").hint("merge"), "pst_id", "left_anti")
    return by_name.unionByName(match_by_detail(rest, companies, policy))


def match_progressively(postings: DataFrame, companies: DataFrame, policies: tuple[Policy, ...] = POLICIES, by_text: bool = True) -> DataFrame:
    """Policies in turn, each over what is left; with matching_attempt, from 0. The
    register is prepared once for all of them."""
    if not by_text:
        return _names_progressively(postings, companies, policies)
    left, found = postings, []
    companies = stored(companies)
    for attempt, policy in enumerate(policies):
        left = stored(left) if attempt else left
        got = stored(match(left, companies, policy).withColumn("matching_attempt", F.lit(attempt)))
        found.append(got)
        left = left.join(got.select("pst_id").hint("merge"), "pst_id", "left_anti")
    return reduce(DataFrame.unionByName, found)


def _names_progressively(postings: DataFrame, companies: DataFrame, policies: tuple[Policy, ...]) -> DataFrame:
    """match_progressively by names alone. An attempt's matches and what it leaves are one
    table; of a posting nothing is read that names don't need."""
    side, left, found = _register(companies), _named(postings), []
    for attempt, policy in enumerate(policies):
        rows = stored(_by_name(left, side, policy, left=attempt + 1 < len(policies)))
        if not attempt:
            forget(left)
        found.append(_named_result(rows, policy).withColumn("matching_attempt", F.lit(attempt)))
        left = rows.filter("left").select(*NAMED)
    return reduce(DataFrame.unionByName, found)


def policy_of_attempt(attempt: int) -> Policy:
    return POLICIES[min(attempt, len(POLICIES) - 1)]


def reset_attempts(rows: DataFrame, every: bool = False) -> DataFrame:
    """matching_attempt 0 for all rows, or for those without a match."""
    keep = F.lit(False) if every else F.col("matched_company_name").isNotNull()
    return rows.withColumn("matching_attempt", F.when(keep, F.col("matching_attempt")).otherwise(0))


def with_industry(matched: DataFrame, companies: DataFrame) -> DataFrame:
    """ksic and ksic9 of the register, one row a bzno: the last loaded."""
    one = first_wins(companies.withColumn("_order", F.monotonically_increasing_id()), ["bzno"], F.col("_order").desc())
    return matched.drop("ksic", "ksic9").join(one.select("bzno", "ksic", "ksic9").hint("merge"), "bzno", "left")


def match_statistics(matched: DataFrame) -> DataFrame:
    """(match_type, n, mean_confidence)."""
    return matched.groupBy("match_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def name_presence(rows: DataFrame) -> DataFrame:
    """(n_rows, with_name, without_name)."""
    has = F.coalesce(F.col("co_nm"), F.lit("")) != ""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(has).alias("with_name"), F.count_if(~has).alias("without_name"))
