"""Queries over the driver's tables, with the SQL that checks them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.functions import text
from jobloom.functions.lineage import cut_lineage, shared_folder, stored
from jobloom.functions.similarity import name_similarity, partial_ratio
from jobloom.operators import classify, dedup, lexical, match, merge, skills, stored_model, text_index
from jobloom.plans import fixtures as fx
from jobloom.sources import tables

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = fx.postings(spark, sf_dir).withColumns({"pst_strt": F.col("pst_strt_raw"), "pst_title": F.lit("공고")})
    return {s: rows.filter(F.col("source") == s).select([c for c in (*schemas.SOURCES[s], "year", "month") if c in rows.columns]) for s in schemas.SOURCES}


WHEN = """CASE WHEN regexp_matches(pst_strt_raw, '^\\d{4}\\.\\d{2}\\.\\d{2}\\([\\p{L}\\p{N}_]+\\)$') THEN CAST(try_strptime(substring(pst_strt_raw, 1, 10), '%Y.%m.%d') AS TIMESTAMP)
 WHEN regexp_matches(pst_strt_raw, '^\\d{4}\\.\\d{2}\\.\\d{2} \\d{2}:\\d{2}$') THEN CAST(try_strptime(pst_strt_raw, '%Y.%m.%d %H:%M') AS TIMESTAMP) END"""


@query(
    fx.with_(fx.POSTINGS)
    + f"""
SELECT pst_id, source, year, month, CASE WHEN source <> 'jkhd' THEN '공고' END AS pst_title, pst_detail, CAST(NULL AS VARCHAR) AS co_nm,
 CASE WHEN source <> 'jkhd' THEN strftime({WHEN}, '%Y-%m-%d %H:%M:%S') END AS pst_strt FROM v1 WHERE length(pst_detail) > 10"""
)
def merge_align_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merge.merge(_sources(spark, sf_dir))
    return rows.select("pst_id", "source", "year", "month", "pst_title", "pst_detail", "co_nm", F.date_format("pst_strt", "yyyy-MM-dd HH:mm:ss").alias("pst_strt"))


@query(
    fx.with_(fx.POSTINGS)
    + f"""
SELECT pst_id, strftime({WHEN}, '%Y-%m-%d %H:%M:%S') AS pst_strt, TRY_CAST(nullif(regexp_extract(pst_strt_raw, '(\\d{{4}})\\.\\d{{2}}\\.\\d{{2}}', 1), '') AS INT) AS year,
 TRY_CAST(nullif(regexp_extract(pst_strt_raw, '\\d{{4}}\\.(\\d{{2}})\\.\\d{{2}}', 1), '') AS INT) AS month FROM v1"""
)
def parse_posting_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, month = text.year_and_month("pst_strt_raw")
    when = F.date_format(text.posting_time("pst_strt_raw"), "yyyy-MM-dd HH:mm:ss")
    return fx.postings(spark, sf_dir).select("pst_id", when.alias("pst_strt"), year.alias("year"), month.alias("month"))


@query(
    fx.with_(fx.POSTINGS, " x AS (SELECT lpad(CAST(CAST(pst_id AS INT) // 2 AS VARCHAR), 8, '0') AS pst_id, source, pst_detail FROM v1)")
    + """
SELECT * FROM x WHERE source = 'jk'
UNION ALL SELECT * FROM x WHERE source = 'jkhd' AND NOT EXISTS (SELECT 1 FROM x y WHERE y.pst_id = x.pst_id AND y.source = 'jk')
UNION ALL SELECT * FROM x WHERE source = 'srm' AND NOT EXISTS (SELECT 1 FROM x y WHERE y.pst_id = x.pst_id AND y.source <> 'srm')"""
)
def merge_precedence_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.lpad(F.floor(F.col("pst_id").cast("int") / 2).cast("string"), 8, "0")
    return merge.precedence(fx.postings(spark, sf_dir).select(half.alias("pst_id"), "source", "pst_detail"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1")
def latest_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.latest_per_id(fx.table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT p_partkey, p_name, p_brand FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1")
def insert_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.first_wins(fx.table(spark, sf_dir, "part"), ["p_name"], "p_partkey").select("p_partkey", "p_name", "p_brand")


@query(
    """WITH s AS (SELECT user_id, event_id, value FROM events WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
n AS (SELECT user_id, event_id, value FROM events WHERE event_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT * FROM n UNION ALL SELECT * FROM s WHERE user_id NOT IN (SELECT user_id FROM n)"""
)
def latest_wins_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    last = lambda odd: tables.first_wins(events.filter(F.col("event_id") % 2 == odd), ["user_id"], F.col("event_id").desc())
    return tables.latest_wins(last(0), last(1), ["user_id"])


@query("""SELECT o_orderkey, coalesce(CAST(p_retailprice AS DOUBLE), o_totalprice) AS o_totalprice FROM orders LEFT JOIN part ON p_partkey = o_orderkey""")
def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = fx.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("o_orderkey"), F.col("p_retailprice").alias("o_totalprice"))
    return tables.update_by_key(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), news, "o_orderkey", ["o_totalprice"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def delete_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = fx.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return tables.delete_by_id(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), gone.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query(
    """WITH f AS (SELECT DISTINCT concat('in/', source, '/', CAST(doc_id % 50 AS VARCHAR), '.csv') AS file_path FROM documents),
l AS (SELECT file_path, CASE length(file_path) % 3 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'FAILED' ELSE 'PROCESSING' END AS status FROM f)
SELECT file_path FROM f WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.file_path = f.file_path AND status = 'COMPLETED')"""
)
def file_ledger_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fx.table(spark, sf_dir, "documents").select(F.concat(F.lit("in/"), "source", F.lit("/"), (F.col("doc_id") % 50).cast("string"), F.lit(".csv")).alias("file_path")).distinct()
    kind = F.length("file_path") % 3
    ledger = files.withColumn("status", F.when(kind == 0, schemas.COMPLETED).when(kind == 1, schemas.FAILED).otherwise(schemas.PROCESSING))
    return tables.pending_files(files, ledger)


_C1 = """
 m AS (SELECT month, min(source) AS lo, bool_or(source = 'srm') AS has FROM v1 WHERE month IS NOT NULL GROUP BY month HAVING count(DISTINCT source) > 1),
 d AS (SELECT v1.*, row_number() OVER (PARTITION BY v1.month, md5(pst_detail) ORDER BY CASE WHEN source = CASE WHEN has THEN 'srm' ELSE lo END THEN 0 ELSE 1 END, source, pst_id) AS rn
  FROM v1 JOIN m ON m.month = v1.month WHERE pst_detail IS NOT NULL),
 c1 AS (SELECT * FROM v1 WHERE pst_id NOT IN (SELECT pst_id FROM d WHERE rn > 1))"""


def _c2(of: str) -> str:
    return f"""
 t AS (SELECT source FROM {of} GROUP BY source HAVING count(DISTINCT month) > 1),
 e AS (SELECT pst_id, row_number() OVER (PARTITION BY source, md5(pst_detail) ORDER BY month NULLS LAST, pst_id) AS rn FROM {of} WHERE source IN (SELECT source FROM t) AND pst_detail IS NOT NULL),
 c2 AS (SELECT * FROM {of} WHERE pst_id NOT IN (SELECT pst_id FROM e WHERE rn > 1))"""


@query(fx.with_(fx.POSTINGS, _C1) + " SELECT pst_id, source, month FROM c1")
def exact_dedup_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup_month(fx.postings(spark, sf_dir)).select("pst_id", "source", "month")


@query(fx.with_(fx.POSTINGS, _c2("v1")) + " SELECT pst_id, source, month FROM c2")
def exact_dedup_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup_source(fx.postings(spark, sf_dir)).select("pst_id", "source", "month")


@query(fx.with_(fx.POSTINGS, _C1, _c2("c1")) + " SELECT pst_id, source, month FROM c2")
def exact_dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(fx.postings(spark, sf_dir)).select("pst_id", "source", "month")


@query(fx.with_(fx.POSTINGS) + " SELECT source, count(*) AS n_rows, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM v1 GROUP BY source")
def source_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.source_distribution(fx.postings(spark, sf_dir))


@query(
    fx.with_(fx.POSTINGS, _C1, _c2("c1"), " n AS (SELECT (SELECT count(*) FROM v1) AS a, (SELECT count(*) FROM c1) AS b, (SELECT count(*) FROM c2) AS c)")
    + """
SELECT 'start' AS stage, a AS n_rows, 0 AS removed, 0.0 AS removed_pct FROM n
UNION ALL SELECT 'month', b, a - b, round(100.0 * (a - b) / a, 6) FROM n UNION ALL SELECT 'source', c, b - c, round(100.0 * (b - c) / b, 6) FROM n"""
)
def dedup_stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.stage_report(fx.postings(spark, sf_dir))


def _pairs_sql(scope: str) -> str:
    return fx.with_(
        fx.POSTINGS,
        f""" h AS (SELECT DISTINCT {scope} AS sc, md5(pst_detail) AS id, pst_detail FROM v1),
 w AS (SELECT sc, id, lower(trim(regexp_replace(pst_detail, '\\s+', ' ', 'g'))) AS x FROM h),
 p AS (SELECT sc, id, x, string_split(x, ' ') AS l FROM w),
 s AS (SELECT sc, id, list_distinct(CASE WHEN len(l) >= 5 THEN list_transform(range(1, len(l) - 3), lambda i: array_to_string(list_slice(l, i, i + 4), ' '))
   WHEN length(x) >= 5 THEN list_transform(range(1, length(x) - 3), lambda i: substring(x, i, 5)) ELSE [x] END) AS k FROM p),
 u AS (SELECT sc, id, len(k) AS n, unnest(k) AS g FROM s),
 c AS (SELECT a.sc, a.id AS a, b.id AS b, count(*) AS k_both, any_value(a.n) AS n, any_value(b.n) AS m FROM u a JOIN u b ON a.sc = b.sc AND a.g = b.g AND a.id < b.id GROUP BY a.sc, a.id, b.id)""",
    ) + f" SELECT sc AS {scope}, a, b, round(k_both / (n + m - k_both), 6) AS similarity FROM c WHERE k_both / (n + m - k_both) >= 0.95 - 1e-12"


@query(_pairs_sql("month"))
def fuzzy_pairs_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.similar_texts(fx.postings(spark, sf_dir), "month").withColumn("similarity", F.round("similarity", 6))


@query(_pairs_sql("source"))
def fuzzy_pairs_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.similar_texts(fx.postings(spark, sf_dir), "source").withColumn("similarity", F.round("similarity", 6))


_NEAR_COPIES = """
v1 AS (SELECT pst_id, pst_detail, source, month FROM v0 UNION ALL
 SELECT pst_id || 'b', pst_detail || ' fin', CASE source WHEN 'jk' THEN 'srm' ELSE 'jk' END, month FROM v0)"""


def _near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings and of each a copy with another word at its end, of another source."""
    rows = fx.postings(spark, sf_dir).select("pst_id", "pst_detail", "source", "month")
    other = F.when(F.col("source") == "jk", "srm").otherwise("jk")
    return rows.unionByName(rows.select(F.concat("pst_id", F.lit("b")).alias("pst_id"), F.concat("pst_detail", F.lit(" fin")).alias("pst_detail"), other.alias("source"), "month"))


@query(_pairs_sql("month").replace(fx.POSTINGS, fx.POSTINGS.replace("v1 AS", "v0 AS", 1) + "," + _NEAR_COPIES))
def fuzzy_pairs_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.similar_texts(_near_copies(spark, sf_dir), "month").withColumn("similarity", F.round("similarity", 6))


def _walk_sql(views: str) -> str:
    """The postings that stay of v1 when each month is walked by rank: one goes if one that stayed is similar."""
    return (
        "WITH RECURSIVE " + views.removeprefix("WITH ").replace(" SELECT sc AS month", ", q AS (SELECT sc AS month", 1)
        + """), mo AS (SELECT month, CASE WHEN bool_or(source = 'srm') THEN 'srm' ELSE min(source) END AS top FROM v1 GROUP BY month),
 ra AS (SELECT pst_id, v1.source, v1.month, md5(pst_detail) AS id, row_number() OVER (PARTITION BY v1.month ORDER BY v1.source <> top, v1.source, pst_id) AS rn FROM v1 JOIN mo ON mo.month = v1.month),
 he AS (SELECT month, id, min(rn) AS rn FROM ra GROUP BY month, id),
 ed AS (SELECT month, a, b FROM q UNION ALL SELECT month, b, a FROM q),
 nb AS (SELECT he.month, he.rn, list(o.rn) AS near FROM ed JOIN he ON he.month = ed.month AND he.id = ed.a JOIN he o ON o.month = ed.month AND o.id = ed.b GROUP BY he.month, he.rn),
 nk AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY rn) AS k FROM nb),
 wa AS (SELECT DISTINCT month, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS stay, CAST([] AS BIGINT[]) AS gone FROM nk
  UNION ALL SELECT wa.month, nk.k, CASE WHEN list_has_any(stay, near) THEN stay ELSE list_append(stay, nk.rn) END, CASE WHEN list_has_any(stay, near) THEN list_append(gone, nk.rn) ELSE gone END
  FROM wa JOIN nk ON nk.month = wa.month AND nk.k = wa.k + 1),
 fin AS (SELECT month, gone FROM wa QUALIFY row_number() OVER (PARTITION BY month ORDER BY k DESC) = 1),
 go AS (SELECT month, unnest(gone) AS rn FROM fin)
SELECT ra.pst_id, ra.source, ra.month FROM ra JOIN he ON he.month = ra.month AND he.rn = ra.rn WHERE NOT EXISTS (SELECT 1 FROM go WHERE go.month = ra.month AND go.rn = ra.rn)"""
    )


def _of_v0(*views: str) -> str:
    """The pairs of a month where v1 is made of v0, the postings, by further views."""
    return _pairs_sql("month").replace(fx.POSTINGS, ",".join((fx.POSTINGS.replace("v1 AS", "v0 AS", 1), *views)))


@query(_walk_sql(_of_v0(_C1.replace("v1", "v0"), _c2("c1"), " v1 AS (SELECT * FROM c2)")))
def fuzzy_dedup_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.fuzzy_dedup_month(stored(dedup.exact_dedup(fx.postings(spark, sf_dir)))).select("pst_id", "source", "month")


@query(_walk_sql(_of_v0(_NEAR_COPIES)))
def fuzzy_dedup_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.fuzzy_dedup_month(_near_copies(spark, sf_dir)).select("pst_id", "source", "month")


@query(
    _pairs_sql("source").replace(" SELECT sc AS source", ", q AS (SELECT sc AS source", 1)
    + """), o AS (SELECT source, a AS id, b AS other FROM q UNION ALL SELECT source, b, a FROM q UNION ALL SELECT DISTINCT source, md5(pst_detail), md5(pst_detail) FROM v1),
 f AS (SELECT source, md5(pst_detail) AS id, min(month) AS mo FROM v1 GROUP BY 1, 2),
 z AS (SELECT o.source, o.id, min(f.mo) AS first FROM o JOIN f ON f.source = o.source AND f.id = o.other GROUP BY 1, 2)
SELECT pst_id, v1.source, month FROM v1 JOIN z ON z.source = v1.source AND z.id = md5(pst_detail) WHERE month <= first"""
)
def fuzzy_dedup_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.fuzzy_dedup_source(fx.postings(spark, sf_dir)).select("pst_id", "source", "month")


_HEAD = """h AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\\s\\p{Z}\\x1c-\\x1f\\x85]+', ' ', 'g')) AS x FROM pages)"""


@query("WITH " + _HEAD + " SELECT page_id, substring(x, 1, CAST(least(length(x) // 3, 200) AS INT)) AS head FROM h")
def strip_html_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "pages").select("page_id", text.head_of_text("html").alias("head"))


_KEYWORDS = ("the", "que", "les", "und", "tion", "of")


def _cut_sql() -> str:
    x = "coalesce(text, '')"
    steps, last = [], "d0"
    for i, k in enumerate(_KEYWORDS):
        steps.append(f"d{i + 1} AS (SELECT doc_id, CASE WHEN strpos(x, '{k}') > 51 THEN substring(x, 1, strpos(x, '{k}') - 1) ELSE x END AS x FROM {last})")
        last = f"d{i + 1}"
    return f"WITH d0 AS (SELECT doc_id, {x} AS x FROM documents), " + ", ".join(steps) + f" SELECT doc_id, x AS cut FROM {last}"


@query(_cut_sql())
def keyword_cut_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").select("doc_id", text.cut_at_keywords(text.text_of("text"), _KEYWORDS).alias("cut"))


_FORMS = "|".join(text.LEGAL_FORMS)
_NAME = f"trim(regexp_replace(regexp_replace(regexp_replace(coalesce(%s, ''), '{_FORMS}', '', 'g'), '[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}\\x1c-\\x1f\\x85]', '', 'g'), '[\\s\\p{{Z}}\\x1c-\\x1f\\x85]+', ' ', 'g'))"


@query(fx.with_(fx.COMPANIES) + f" SELECT bzno, {_NAME % 'title'} AS name FROM v2")
def normalize_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.companies(spark, sf_dir).select("bzno", text.normalize_company_name("title").alias("name"))


def _region(x: str) -> str:
    cases = " ".join(f"WHEN contains({x}, '{k}') THEN '{v}'" for k, v in (*text.REGION_SPELLINGS, *((r, r) for r in text.REGIONS)))
    return f"(CASE {cases} ELSE '' END)"


def _address(x: str) -> str:
    local = f"regexp_extract({x}, '([가-힣]+시|[가-힣]+군|[가-힣]+구)', 1)"
    return f"(CASE WHEN {_region(x)} = '' THEN '' WHEN {local} = '' THEN {_region(x)} ELSE {_region(x)} || ' ' || {local} END)"


@query(fx.with_(fx.COMPANIES) + f" SELECT bzno, {_region('address')} AS region FROM v2")
def normalize_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.companies(spark, sf_dir).select("bzno", text.normalize_region("address").alias("region"))


@query(fx.with_(fx.COMPANIES) + f" SELECT bzno, {_address('address')} AS address_m FROM v2")
def extract_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.companies(spark, sf_dir).select("bzno", text.extract_address("address").alias("address_m"))


def _similarity(a: str, b: str) -> str:
    grams = lambda x, n: f"list_distinct(list_transform(range(1, length({x}) - {n - 2}), lambda i: substring({x}, i, {n})))"
    both = lambda n: f"len(list_intersect({grams(a, n)}, {grams(b, n)}))"
    jaccard = lambda n: f"coalesce({both(n)} / nullif(len({grams(a, n)}) + len({grams(b, n)}) - {both(n)}, 0), 0.0)"
    short, long = f"least(length({a}), length({b}))", f"greatest(length({a}), length({b}))"
    return f"""(CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 WHEN starts_with({a}, {b}) OR starts_with({b}, {a}) THEN {short} / {long} * CASE WHEN {short} < 3 THEN 0.5 ELSE 0.8 END
 ELSE 0.3 * {jaccard(1)} + 0.5 * {jaccard(2)} + 0.2 * ({short} / {long}) END)"""


@query(
    fx.with_(fx.COMPANIES, fx.MENTIONS, f" n AS (SELECT pst_id, true_bzno, lower({_NAME % 'co_nm'}) AS a, lower({_NAME % 'title'}) AS b FROM v3 JOIN v2 ON v2.bzno = v3.true_bzno)")
    + f" SELECT pst_id, true_bzno, round({_similarity('a', 'b')}, 6) AS similarity FROM n"
)
def name_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = fx.companies(spark, sf_dir).select(F.col("bzno").alias("true_bzno"), text.normalize_company_name("title").alias("b"))
    rows = fx.mentions(spark, sf_dir).select("pst_id", "true_bzno", text.normalize_company_name("co_nm").alias("a")).join(titles, "true_bzno")
    return rows.select("pst_id", "true_bzno", F.round(name_similarity("a", "b"), 6).alias("similarity"))


def _names_and_titles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    spelt = cut_lineage(fx.mentions(spark, sf_dir).select("co_nm").distinct())  # each spelling is put into its normal form, not each mention
    names = spelt.select(text.normalize_company_name("co_nm").alias("name")).filter("name <> ''").distinct()
    return names, fx.companies(spark, sf_dir).select("bzno", text.normalize_company_name("title").alias("processed_title"))


_NAMES = f" na AS (SELECT DISTINCT {_NAME % 'co_nm'} AS name FROM v3 WHERE {_NAME % 'co_nm'} <> ''), ti AS (SELECT bzno, {_NAME % 'title'} AS processed_title FROM v2)"
_HEX = "translate(translate(%s, '가나다라마바사아자차카타파하거너', '0123456789abcdef'), '지점', 'xy')"


@query(fx.with_(fx.COMPANIES, fx.MENTIONS, _NAMES) + " SELECT name, bzno FROM na JOIN ti ON contains(' ' || lower(processed_title) || ' ', ' ' || lower(name) || ' ')")
def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.phrase_matches(*_names_and_titles(spark, sf_dir), "name", "processed_title").select("name", "bzno")


@query(fx.with_(fx.COMPANIES, fx.MENTIONS, _NAMES) + " SELECT name, bzno FROM na JOIN ti ON starts_with(lower(processed_title), name)")
def prefix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.prefix_matches(*_names_and_titles(spark, sf_dir), "name", "processed_title").select("name", "bzno")


@query(
    fx.with_(fx.COMPANIES, fx.MENTIONS, _NAMES)
    + f" SELECT name, bzno FROM na JOIN ti ON substring(name, 1, 1) = substring(processed_title, 1, 1) AND levenshtein({_HEX % 'name'}, {_HEX % 'processed_title'}) <= 1"
)
def fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.fuzzy_matches(*_names_and_titles(spark, sf_dir), "name", "processed_title", 1, 1).select("name", "bzno")


_STOP = ", ".join(f"'{w}'" for w in lexical.STOP_WORDS)
_TOKENS = f"list_filter(regexp_extract_all(lower(coalesce(%s, '')), '[\\p{{L}}\\p{{N}}_]+'), lambda t: t NOT IN ({_STOP}))"


@query(
    f"""WITH d AS (SELECT doc_id, {_TOKENS % 'text'} AS t FROM documents), n AS (SELECT count(*) AS n, avg(len(t)) AS a FROM d),
p AS (SELECT doc_id, token, count(*) AS tf, any_value(dl) AS dl FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS token FROM d) GROUP BY 1, 2),
f AS (SELECT token, count(*) AS df FROM p GROUP BY token), q AS (SELECT item_id, unnest(list_distinct({_TOKENS % 'text'})) AS token FROM benchmark),
s AS (SELECT item_id, doc_id, round(sum(ln(1 + (n.n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / a))), 6) AS score FROM q JOIN p USING (token) JOIN f USING (token), n GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s) SELECT item_id, doc_id, round(score, 4) AS score, rank FROM r WHERE rank <= 10"""
)
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.bm25_top(fx.table(spark, sf_dir, "documents"), fx.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("q")), "doc_id", "text", "item_id", "q", 10)
    return found.select("item_id", "doc_id", F.round("score", 4).alias("score"), "rank")


@query(ORACLE_SQL["bm25_topk"])
def stored_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bm25_topk from an index that is written, found to be there, and read."""
    path = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    if not lexical.write_index(docs, path, "doc_id", "text") or lexical.write_index(docs.limit(0), path, "doc_id", "text"):
        raise RuntimeError("an index is written once")
    found = lexical.index_top(lexical.read_index(spark, path), fx.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("q")), "doc_id", "item_id", "q", 10)
    return found.select("item_id", "doc_id", F.round("score", 4).alias("score"), "rank")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(ORACLE_SQL["bm25_topk"].replace("FROM documents", "FROM documents WHERE doc_id % 7 <> 5"))
def index_updates_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 after a second batch with new, changed, repeated and deleted texts, and
    after a third that deletes what the second brought."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text", F.lit(1).alias("turn"))
    index = text_index.TextIndex(_folder(spark, "index"), "doc_id", "long", 16)
    changed, new = F.col("doc_id") % 4 == 0, F.col("doc_id") % 10 == 3
    other = lambda rows: rows.withColumns({"text": F.concat(F.reverse("text"), F.lit(" the former text")), "turn": F.lit(0)})
    first = docs.filter(~new)
    text_index.add_batch(other(first.filter(changed)).unionByName(first.filter(~changed)), index, "text", "turn")
    text_index.add_batch(other(docs.filter(changed | new)).unionByName(docs.filter(changed | new)), index, "text", "turn", docs.filter("doc_id % 7 = 5 and doc_id % 10 <> 3 and doc_id % 4 <> 0"))
    text_index.add_batch(docs.limit(0), index, "text", "turn", docs.filter("doc_id % 7 = 5"))
    found = text_index.bm25(spark, index, fx.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("q")), "item_id", "q", 10)
    return found.select("item_id", "doc_id", F.round("score", 4).alias("score"), "rank")


_LINE = "' ' || array_to_string(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+'), ' ') || ' '"


@query(
    f"""WITH d AS (SELECT doc_id, {_LINE} AS line FROM documents), b AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM benchmark),
q AS (SELECT item_id, k AS words, array_to_string(list_slice(w, 3, 2 + k), ' ') AS phrase FROM b, (SELECT unnest([1, 2, 3, 8]) AS k) WHERE len(w) >= 2 + k)
SELECT item_id, words, doc_id FROM q JOIN d ON contains(line, ' ' || phrase || ' ')"""
)
def phrases_in_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one, two, three and eight words of each benchmark text in a row, from
    stored positions."""
    index = text_index.TextIndex(_folder(spark, "index"), "doc_id", "long")
    text_index.add_batch(fx.table(spark, sf_dir, "documents"), index, "text")
    words = lexical.tokens("text", stop=False)
    each = fx.table(spark, sf_dir, "benchmark").select("item_id", words.alias("w"), F.explode(F.array(*[F.lit(k) for k in (1, 2, 3, 8)])).alias("words")).filter(F.size("w") >= 2 + F.col("words"))
    asked = each.select(F.struct("item_id", "words").alias("q"), F.array_join(F.slice("w", F.lit(3), F.col("words")), " ").alias("phrase"))
    return text_index.phrases(spark, index, asked, "q", "phrase").select("q.item_id", "q.words", "doc_id")


def _titles_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, text_index.TextIndex]:
    names, titles = _names_and_titles(spark, sf_dir)
    index = text_index.TextIndex(_folder(spark, "titles"), "bzno", edits=1)
    text_index.add_batch(titles, index, "processed_title")
    return names, index


@query(ORACLE_SQL["phrase_search"])
def stored_phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, index = _titles_index(spark, sf_dir)
    return text_index.phrases(spark, index, names.withColumn("q", F.col("name")), "name", "q").select("name", "bzno")


@query(ORACLE_SQL["prefix_search"])
def stored_prefix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, index = _titles_index(spark, sf_dir)
    return text_index.prefixes(spark, index, names, "name")


@query(ORACLE_SQL["fuzzy_search"])
def stored_fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, index = _titles_index(spark, sf_dir)
    return text_index.fuzzy(spark, index, names, "name", 1, 1)


@query(
    fx.with_(fx.POSTINGS)
    + """ SELECT pst_id FROM v1 WHERE month IN (1, 2, 3) AND source <> 'jk' AND (CASE WHEN length(pst_detail) > 500 THEN 1 ELSE 0 END + CASE WHEN contains(pst_detail, 'the') THEN 1 ELSE 0 END) >= 1"""
)
def bool_filter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.postings(spark, sf_dir)
    return lexical.search(rows, [F.col("month").isin(1, 2, 3)], [F.col("source") == "jk"], [F.length("pst_detail") > 500, F.contains("pst_detail", F.lit("the"))], 1).select("pst_id")


def _prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = fx.mentions(spark, sf_dir).withColumns({"pst_title": F.lit(None).cast("string"), "pst_detail": F.lit(None).cast("string")})
    return match.prepare_postings(rows), match.prepare_companies(fx.companies(spark, sf_dir).withColumn("_o", F.col("bzno").cast("long")), "_o")


def _policy_sql(p: match.Policy, left: str, tag: str) -> str:
    edits = str(p.fuzziness) if not isinstance(p.fuzziness, str) else "(CASE WHEN length(name) < 3 THEN 0 WHEN length(name) < 6 THEN 1 ELSE 2 END)"
    very = f"AND (length(name) > {p.very_short} OR same_region OR same_address)" if p.name == "strict" else ""
    return f"""
 n{tag} AS (SELECT DISTINCT name FROM {left} WHERE name <> ''),
 c{tag} AS (SELECT name, bzno, title, processed_title, c_region, c_address, {_similarity('lower(name)', 'lower(processed_title)')} AS similarity FROM n{tag} JOIN co ON
  contains(' ' || lower(processed_title) || ' ', ' ' || lower(name) || ' ') OR (length(name) > {p.short} AND (starts_with(lower(processed_title), name)
  OR (substring(name, 1, {p.prefix}) = substring(processed_title, 1, {p.prefix}) AND levenshtein({_HEX % 'name'}, {_HEX % 'processed_title'}) <= {edits})))),
 t{tag} AS (SELECT * FROM c{tag} WHERE similarity >= CASE WHEN length(name) <= {p.short} THEN {p.similarity_short} ELSE {p.similarity} END QUALIFY row_number() OVER (PARTITION BY name ORDER BY similarity DESC, bzno) <= 5),
 a{tag} AS (SELECT pst_id, name, bzno, title, similarity, (region_m <> '' AND region_m = c_region) AS same_region, (address_m <> '' AND address_m = c_address) AS same_address FROM {left} JOIN t{tag} USING (name)),
 s{tag} AS (SELECT *, round(similarity * {p.name_weight} + CASE WHEN same_region THEN {p.region_weight} ELSE 0 END + CASE WHEN same_address THEN {p.address_weight} ELSE 0 END, 9) AS score FROM a{tag} WHERE true {very}),
 m{tag} AS (SELECT pst_id, title AS matched_company_name, bzno, round(score, 6) AS confidence,
  'name_' || CASE WHEN same_region AND same_address THEN 'region_address' WHEN same_region THEN 'region' WHEN same_address THEN 'address' ELSE 'only' END || '_match' AS match_type, '{p.name}' AS matching_policy
  FROM s{tag} WHERE score >= CASE WHEN length(name) <= {p.short} THEN {round(p.score_short - p.discount, 9)} ELSE {round(p.score - p.discount, 9)} END
  QUALIFY row_number() OVER (PARTITION BY pst_id ORDER BY score DESC, similarity DESC, bzno) = 1)"""


_MATCH = (
    f" po AS (SELECT pst_id, {_NAME % 'co_nm'} AS name, {_region(chr(34) + 'loc' + chr(34))} AS region_m, {_address('corp_addr')} AS address_m FROM v3),"
    f" co AS (SELECT bzno, title, {_NAME % 'title'} AS processed_title, {_region('address')} AS c_region, {_address('address')} AS c_address FROM v2)"
)
MATCHED = ("pst_id", "matched_company_name", "bzno", "confidence", "match_type", "matching_policy")


def _one_policy(policy: match.Policy):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return match.match_by_name(*_prepared(spark, sf_dir), policy).select(*MATCHED).withColumn("confidence", F.round("confidence", 6))

    run.__name__ = f"company_match_{policy.name}"
    query(fx.with_(fx.COMPANIES, fx.MENTIONS, _MATCH, _policy_sql(policy, "po", "")) + " SELECT * FROM m")(run)


for _p in match.POLICIES:
    _one_policy(_p)

_STEPS = []
for _i, _p in enumerate(match.POLICIES):
    _STEPS.append(_policy_sql(_p, "po" if not _i else f"l{_i}", str(_i)))
    _STEPS.append(f" l{_i + 1} AS (SELECT * FROM {'po' if not _i else f'l{_i}'} WHERE pst_id NOT IN (SELECT pst_id FROM m{_i}))")
_ALL = " UNION ALL ".join(f"SELECT *, {i} AS matching_attempt FROM m{i}" for i in range(3))
PROGRESSIVE = fx.with_(fx.COMPANIES, fx.MENTIONS, _MATCH, *_STEPS, f" r AS ({_ALL})")


def _progressive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.match_progressively(*_prepared(spark, sf_dir), by_text=False)


@query(PROGRESSIVE + " SELECT * FROM r")
def company_match_progressive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _progressive(spark, sf_dir).select(*MATCHED, "matching_attempt").withColumn("confidence", F.round("confidence", 6))


@query(PROGRESSIVE + " SELECT pst_id, r.bzno, ksic, ksic9 FROM r LEFT JOIN v2 ON v2.bzno = r.bzno")
def company_industry_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.with_industry(_progressive(spark, sf_dir), fx.companies(spark, sf_dir)).select("pst_id", "bzno", "ksic", "ksic9")


@query(PROGRESSIVE + " SELECT match_type, count(*) AS n, round(avg(confidence), 4) AS mean_confidence FROM r GROUP BY match_type")
def match_type_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.match_statistics(_progressive(spark, sf_dir)).withColumn("mean_confidence", F.round("mean_confidence", 4))


@query(fx.with_(fx.COMPANIES, fx.MENTIONS) + " SELECT count(*) AS n_rows, count(*) FILTER (coalesce(co_nm, '') <> '') AS with_name, count(*) FILTER (coalesce(co_nm, '') = '') AS without_name FROM v3")
def company_name_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.name_presence(fx.mentions(spark, sf_dir))


_MARKED = " || ".join(f"regexp_extract_all(x, '{p}', 1)" for p in match.MARKED_NAMES)
_BLOCKED = ", ".join(f"'{w}'" for w in match.BLOCKED)


def _text_sql(rows: str) -> str:
    """Of rows (..., pst_title, pst_detail): tx with `text`, what is left of title and detail for names."""
    space = "[\\s\\p{Z}\\x1c-\\x1f\\x85]"
    squeezed = lambda x: f"trim(regexp_replace({x}, '{space}+', ' ', 'g'))"
    whole = squeezed("regexp_replace(coalesce(pst_title || ' ', '') || coalesce(pst_detail, ''), '<[^>]+>', ' ', 'g')")
    steps = [f" k0 AS (SELECT *, substring(w, 1, CAST(least(length(w) // 3, 200) AS INT)) AS x FROM (SELECT *, {whole} AS w FROM {rows}))"]
    for i, k in enumerate(text.CUT_KEYWORDS):
        steps.append(f" k{i + 1} AS (SELECT * EXCLUDE (x), CASE WHEN strpos(x, '{k}') > 51 THEN substring(x, 1, strpos(x, '{k}') - 1) ELSE x END AS x FROM k{i})")
    cleaned = "x"
    for p in text.BOILERPLATE:
        cleaned = f"regexp_replace({cleaned}, '{p.replace(chr(92) + 's', space)}', ' ', 'g')"
    return ",".join(steps) + f", tx AS (SELECT * EXCLUDE (x, w), {squeezed(cleaned)} AS text FROM k{len(text.CUT_KEYWORDS)})"


def _potential_sql(of: str, marked: float) -> str:
    """List of (name, c) of the names that a text may hold."""
    marks = " || ".join(f"regexp_extract_all({of}, '{p}', 1)" for p in match.MARKED_NAMES)
    words = f"list_filter(regexp_split_to_array(trim(regexp_extract({of}, '^([^.!?]+)[.!?]', 1)), '[\\s\\p{{Z}}]+'), lambda w: w <> '')"
    first = f"CASE WHEN len({words}) >= 1 AND length({words}[1]) >= 2 AND lower({words}[1]) NOT IN ({_BLOCKED}) THEN {words}[1] END"
    several = [f"CASE WHEN len({words}) >= {n} AND length(array_to_string({words}[1:{n}], ' ')) > {n} THEN array_to_string({words}[1:{n}], ' ') END" for n in (2, 3)]
    plain = f"list_transform(list_filter([{first}, {', '.join(several)}], lambda z: z IS NOT NULL), lambda z: {{'name': z, 'c': CAST({match.PLAIN_CONFIDENCE} AS DOUBLE)}})"
    beside = f"list_transform(list_filter({marks}, lambda z: length(z) >= 2 AND lower(z) NOT IN ({_BLOCKED})), lambda z: {{'name': z, 'c': CAST({marked} AS DOUBLE)}})"
    return f"({plain} || {beside})"


def _detail_sql(p: match.Policy, left: str) -> str:
    """md: the matches by text of left (pst_id, region_m, address_m, pst_title, pst_detail) with the companies co."""
    each = "regexp_extract_all(lower(coalesce(%s, '')), '[\\p{L}\\p{N}_]+')"
    line = f"' ' || array_to_string({each}, ' ') || ' '"
    listed = lambda words: ", ".join(f"'{w}'" for w in words)
    known = f"list_filter(string_split(processed_title, ' '), lambda w: length(w) >= 3 AND lower(w) NOT IN ({_BLOCKED}))"
    held = lambda where: f"len(list_filter({known}, lambda w: contains({where}, w))) > 0"
    same = "(region_m <> '' AND region_m = c_region) AS same_region, (address_m <> '' AND address_m = c_address) AS same_address"
    bonus = f"CASE WHEN same_region THEN {p.detail_region} ELSE 0.0 END + CASE WHEN same_address THEN {p.detail_address} ELSE 0.0 END"
    return f"""{_text_sql(left)},
 rg AS (SELECT {_TOKENS % 'processed_title'} AS t FROM co), st AS (SELECT count(*) AS n, avg(len(t)) AS av FROM rg),
 dfs AS (SELECT token, count(*) AS df FROM (SELECT unnest(list_distinct(t)) AS token FROM rg) GROUP BY token),
 tl AS (SELECT bzno, x, {line % 'x'} AS ln, {_TOKENS % 'x'} AS t FROM (SELECT bzno, title AS x FROM co UNION SELECT bzno, processed_title FROM co)),
 en AS (SELECT pst_id, region_m, address_m, {_potential_sql('text', match.MARKED_CONFIDENCE)} || {_potential_sql("coalesce(pst_title, '')", match.TITLE_CONFIDENCE)} AS e FROM tx WHERE text <> ''),
 nd AS (SELECT pst_id, region_m, address_m, turn, e[turn].name AS name, e[turn].c AS c FROM (SELECT *, unnest(range(1, len(e) + 1)) AS turn FROM en)
  WHERE length(e[turn].name) > 2 OR lower(e[turn].name) IN ({listed(match.SHORT_NAMES)})),
 nm AS (SELECT name, {line % 'name'} AS nl, list_distinct({_TOKENS % 'name'}) AS q FROM (SELECT name FROM nd UNION SELECT text FROM tx WHERE text <> '') WHERE len({each % 'name'}) > 0),
 hi AS (SELECT name, bzno, x, t, unnest(q) AS token FROM nm JOIN tl ON contains(ln, nl)),
 hf AS (SELECT hi.*, len(list_filter(t, lambda w: w = token)) AS tf FROM hi),
 re AS (SELECT name, bzno, max(r) AS relevance FROM (SELECT name, bzno, x, sum(ln(1 + (n - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / greatest(av, 1.0)))) AS r
  FROM hf LEFT JOIN dfs USING (token), st GROUP BY name, bzno, x) GROUP BY name, bzno),
 r5 AS (SELECT re.*, title, processed_title, c_region, c_address FROM re JOIN co USING (bzno) WHERE name IN (SELECT name FROM nd) QUALIFY row_number() OVER (PARTITION BY name ORDER BY relevance DESC, bzno) <= 5),
 bn AS (SELECT *, {same} FROM nd JOIN r5 USING (name) QUALIFY row_number() OVER (PARTITION BY pst_id, bzno ORDER BY turn) = 1),
 bf AS (SELECT pst_id, text, re.*, title, processed_title, c_region, c_address, substring(text, 1, 200) AS head, {same} FROM tx JOIN re ON re.name = tx.text JOIN co USING (bzno)
  WHERE coalesce(title, '') <> '' AND processed_title <> '' AND lower(processed_title) NOT IN ({_BLOCKED}) AND title NOT IN ({listed(match.EXCLUDED_TITLES)})),
 bt AS (SELECT *, CASE WHEN contains(head, title) THEN 10.0 WHEN contains(text, title) THEN 8.0 WHEN contains(head, processed_title) THEN 7.0 WHEN contains(text, processed_title) THEN 5.0
   WHEN length(processed_title) >= 3 AND {held('head')} THEN 4.0 WHEN length(processed_title) >= 3 AND {held('text')} THEN 3.0 ELSE 0.0 END
   * CASE WHEN regexp_matches(title, '{match.LEGAL_MARK}') THEN 1.2 ELSE 1.0 END + least(relevance / 20.0, 1.0) AS score FROM bf
  WHERE (length(processed_title) > 2 OR lower(processed_title) IN ({listed(match.SHORT_IN_TEXT)}) OR same_region OR same_address)
  QUALIFY score > 0 AND row_number() OVER (PARTITION BY pst_id ORDER BY score DESC, bzno) <= {match.TEXT_CANDIDATES}),
 al AS (SELECT pst_id, bzno, title, same_region, same_address, 0 AS rk, relevance AS score, c * relevance / 10.0 + {bonus} AS adjusted FROM bn
  UNION ALL SELECT pst_id, bzno, title, same_region, same_address, 1, score, score / 15.0 + {bonus} FROM bt),
 on1 AS (SELECT * FROM al QUALIFY row_number() OVER (PARTITION BY pst_id, bzno ORDER BY rk) = 1),
 be AS (SELECT * FROM on1 QUALIFY row_number() OVER (PARTITION BY pst_id ORDER BY adjusted DESC, bzno) = 1),
 md AS (SELECT pst_id, title AS matched_company_name, bzno, round(adjusted, 6) AS confidence,
  'detail_' || CASE WHEN same_region AND same_address THEN 'region_address' WHEN same_region THEN 'region' WHEN same_address THEN 'address' ELSE 'only' END || '_match' AS match_type, '{p.name}' AS matching_policy
  FROM be WHERE adjusted >= {p.detail_least})"""


def _detailed(spark: SparkSession, sf_dir: str, named: bool = False) -> tuple[DataFrame, DataFrame]:
    """Mentions whose text names the company: in a sentence, or as all that is left of it; named:
    of every third one, the company's name or another stands in its field too."""
    titles = fx.companies(spark, sf_dir).select(F.col("bzno").alias("true_bzno"), "title")
    rows = fx.mentions(spark, sf_dir).join(titles, "true_bzno")
    key = F.col("pst_id").cast("long")
    body = F.concat(F.col("title"), F.lit(" 에서 경력 개발자를 모집합니다. "), F.repeat(F.lit("성실한 분을 찾습니다 "), 20))
    alone = F.concat("title", F.lit(" "), F.expr("repeat('z', 2 * length(title) - 1)"))
    name = F.when(key % 3 == 0, F.when(key % 2 == 0, F.col("title")).otherwise("다른 이름")) if named else F.lit(None).cast("string")
    kind = key % 7 < 4
    rows = rows.select("pst_id", name.alias("co_nm"), "loc", "corp_addr", F.when(kind, "개발자 모집").alias("pst_title"), F.when(kind, body).otherwise(alone).alias("pst_detail"))
    return match.prepare_postings(rows), match.prepare_companies(fx.companies(spark, sf_dir).withColumn("_o", F.col("bzno").cast("long")), "_o")


def _detailed_sql(named: bool) -> str:
    name = "CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN title ELSE '다른 이름' END END" if named else "CAST(NULL AS VARCHAR)"
    return (
        f" dm AS (SELECT pst_id, {name} AS co_nm, loc, corp_addr, CASE WHEN k % 7 < 4 THEN '개발자 모집' END AS pst_title,"
        " CASE WHEN k % 7 < 4 THEN title || ' 에서 경력 개발자를 모집합니다. ' || repeat('성실한 분을 찾습니다 ', 20) ELSE title || ' ' || repeat('z', 2 * length(title) - 1) END AS pst_detail"
        " FROM (SELECT v3.*, title, CAST(pst_id AS BIGINT) AS k FROM v3 JOIN v2 ON v2.bzno = true_bzno)),"
        f" po AS (SELECT pst_id, {_NAME % 'co_nm'} AS name, {_region(chr(34) + 'loc' + chr(34))} AS region_m, {_address('corp_addr')} AS address_m, pst_title, pst_detail FROM dm),"
        f" co AS (SELECT bzno, title, {_NAME % 'title'} AS processed_title, {_region('address')} AS c_region, {_address('address')} AS c_address FROM v2)"
    )


@query(fx.with_(fx.COMPANIES, fx.MENTIONS, _detailed_sql(False), _detail_sql(match.RELAXED, "po")) + " SELECT * FROM md")
def company_match_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.match(*_detailed(spark, sf_dir), match.RELAXED).select(*MATCHED).withColumn("confidence", F.round("confidence", 6))


@query(
    fx.with_(fx.COMPANIES, fx.MENTIONS, _detailed_sql(True), _policy_sql(match.STRICT, "po", ""), " le AS (SELECT * FROM po WHERE pst_id NOT IN (SELECT pst_id FROM m))", _detail_sql(match.STRICT, "le"))
    + " SELECT * FROM m UNION ALL SELECT * FROM md"
)
def company_match_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By name where there is one that matches, else by text."""
    return match.match(*_detailed(spark, sf_dir, True), match.STRICT).select(*MATCHED).withColumn("confidence", F.round("confidence", 6))


@query(
    fx.with_(fx.COMPANIES, " t AS (SELECT bzno, '우수기업 ' || title || ' 채용 (주)한빛 안내' AS x FROM v2)", f" u AS (SELECT bzno, unnest({_MARKED}) AS name FROM t)")
    + f" SELECT bzno, name, count(*) AS n FROM u WHERE length(name) >= 2 AND lower(name) NOT IN ({_BLOCKED}) GROUP BY bzno, name"
)
def legal_marker_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentence = F.concat(F.lit("우수기업 "), "title", F.lit(" 채용 (주)한빛 안내"))
    each = fx.companies(spark, sf_dir).select("bzno", F.explode(match.potential_names(sentence)).alias("e")).select("bzno", "e.name")
    return each.groupBy("bzno", "name").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN substring(text, 1, 40) || ' 근무 조건 ' || text WHEN doc_id % 3 = 1 THEN '복리후생 ' || text ELSE text END AS x FROM documents),
p AS (SELECT doc_id, x, strpos(x, '근무 조건') AS a, strpos(x, '복리후생') AS b FROM d)
SELECT doc_id, trim(regexp_replace(CASE WHEN a > 0 THEN substring(x, 1, greatest(a - 1, 1)) WHEN b > 0 THEN substring(x, 1, greatest(b - 1, 1)) ELSE x END, '[\\s\\p{Z}\\x1c-\\x1f\\x85]+', ' ', 'g')) AS cut FROM p"""
)
def boilerplate_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 3
    x = F.when(kind == 0, F.concat(F.substring("text", 1, 40), F.lit(" 근무 조건 "), F.col("text"))).when(kind == 1, F.concat(F.lit("복리후생 "), "text")).otherwise(F.col("text"))
    return fx.table(spark, sf_dir, "documents").select("doc_id", text.preprocess_description(x).alias("cut"))


_TAGGED = """ hit AS (SELECT pst_id, skill_code, skill_name FROM (SELECT pst_id, trim(regexp_replace(pst_detail, '[\\s\\p{Z}\\x1c-\\x1f\\x85]+', ' ', 'g')) AS x FROM v1) p JOIN v4
  ON CASE WHEN starts_with(ext_key, '(?i)') OR starts_with(ext_key, 'r''') THEN contains(lower(x), skill_name) ELSE contains(x, skill_name) END),
 top AS (SELECT *, row_number() OVER (PARTITION BY pst_id ORDER BY skill_code) AS pos FROM hit QUALIFY pos <= 20)"""


def _tagged(spark: SparkSession, sf_dir: str, known: DataFrame) -> DataFrame:
    return skills.match_skills(fx.postings(spark, sf_dir), known)


@query(
    fx.with_(fx.POSTINGS, fx.SKILLS, _TAGGED)
    + " SELECT pst_id, string_agg(skill_code, ',' ORDER BY pos) AS skill_code, string_agg(skill_name, ',' ORDER BY pos) AS skill_name FROM top GROUP BY pst_id"
)
def skill_match_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = cut_lineage(fx.skills(spark, sf_dir))
    return skills.joined_columns(_tagged(spark, sf_dir, known), known)


@query(
    fx.with_(fx.POSTINGS, fx.SKILLS, _TAGGED)
    + """ SELECT v1.pst_id, source, CAST(month AS VARCHAR) AS month, skill_code, skill_name, CAST(softskill AS VARCHAR) AS softskill FROM top JOIN v1 USING (pst_id) JOIN v4 USING (skill_code, skill_name)"""
)
def skill_explode_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = cut_lineage(fx.skills(spark, sf_dir)).withColumns({c: F.lit(None).cast("string") for c in schemas.SKILL if c not in ("skill_code", "skill_name", "ext_key", "softskill")})
    tagged = skills.joined_columns(_tagged(spark, sf_dir, known), known)
    rows = fx.postings(spark, sf_dir).join(tagged.select("pst_id", "skill_code"), "pst_id")
    return skills.expand(rows, known).select("pst_id", "source", "month", "skill_code", "skill_name", "softskill")


@query(
    """WITH p AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN CAST(doc_id % 447 AS VARCHAR) WHEN 1 THEN 'abc' WHEN 2 THEN NULL ELSE CAST(doc_id % 447 AS VARCHAR) || '.7' END AS predicted FROM labels),
t AS (SELECT doc_id, coalesce(CAST(trunc(TRY_CAST(predicted AS DOUBLE)) AS INT), -1) AS target FROM p)
SELECT doc_id, target, CASE WHEN target BETWEEN 0 AND 299 THEN 'K' || CAST(target AS VARCHAR) END AS keco_4 FROM t"""
)
def classify_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, number = F.col("doc_id") % 4, (F.col("doc_id") % 447).cast("string")
    predicted = F.when(kind == 0, number).when(kind == 1, "abc").when(kind == 3, F.concat(number, F.lit(".7")))
    codes = spark.range(300).select(F.col("id").cast("int").alias("target"), F.concat(F.lit("K"), F.col("id").cast("string")).alias("keco_4"), F.lit(None).cast("string").alias("keco_t"))
    rows = fx.table(spark, sf_dir, "labels").select("doc_id", predicted.alias("predicted_occupation"))
    return classify.with_codes(rows, codes).select("doc_id", "target", "keco_4")


@query()
def classify_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    known = docs.join(fx.table(spark, sf_dir, "labels"), "doc_id")
    return classify.HashedLogistic().fit(known, "text", "quality").predict(docs, "doc_id", "text")


_WORD_FEATURES = f"list_transform(regexp_extract_all(lower(substring(coalesce(text, ''), 1, {classify.INPUT})), '[\\p{{L}}\\p{{N}}_]+'), lambda w: CAST(CAST('0x' || substring(md5(w), 1, 8) AS BIGINT) % {stored_model.FEATURES} AS INT))"
_LANGUAGES = ("de", "en", "es", "fr")
_LABEL = f"quality + 2 * toxic + 4 * CASE lang {' '.join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(_LANGUAGES))} END"
_LABELS = 4 * len(_LANGUAGES)


@query(
    f"""WITH d AS (SELECT doc_id, lang, {_WORD_FEATURES} AS f FROM documents), k AS (SELECT {_LABEL} AS c, f FROM d JOIN labels USING (doc_id)),
c AS (SELECT CAST(range AS INT) AS c FROM range({_LABELS})), n AS (SELECT c, f, count(*) AS n FROM (SELECT c, unnest(f) AS f FROM k WHERE c IS NOT NULL) GROUP BY 1, 2),
s AS (SELECT c.c, coalesce(sum(n), 0) AS s FROM c LEFT JOIN n ON n.c = c.c GROUP BY 1),
b AS (SELECT c.c, ln((count(k.c) + 1) / ((SELECT count(*) FROM k WHERE c IS NOT NULL) + {_LABELS})) AS b FROM c LEFT JOIN k ON k.c = c.c GROUP BY 1),
w AS (SELECT doc_id, f, count(*) AS t FROM (SELECT doc_id, unnest(f) AS f FROM d) GROUP BY 1, 2),
x AS (SELECT w.doc_id, s.c, sum(w.t * ln((coalesce(n.n, 0) + 1) / (s.s + {stored_model.FEATURES}))) AS x FROM w CROSS JOIN s LEFT JOIN n ON n.c = s.c AND n.f = w.f GROUP BY 1, 2),
y AS (SELECT doc_id, b.c, round(coalesce(x, 0) + b, 6) AS y FROM d CROSS JOIN b LEFT JOIN x USING (doc_id, c))
SELECT doc_id, CAST(c AS INT) AS predicted_occupation, round(y, 4) AS score FROM y QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY y DESC, c) = 1"""
)
def classify_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages and labels of all documents by weights that are learnt, stored and loaded."""
    docs, path = fx.table(spark, sf_dir, "documents"), _folder(spark, "model")
    read = docs.select("doc_id", "lang", classify.classifier_input("text").alias("text"))  # no more of a text is joined
    known = read.join(fx.table(spark, sf_dir, "labels"), "doc_id").withColumn("label", F.expr(_LABEL))
    stored_model.save(stored_model.train(known, "text", "label", _LABELS), path)
    model = stored_model.load(spark, path, stored_model.initial(_LABELS))
    return stored_model.predict(docs, model, "doc_id", "text").withColumn("score", F.round("score", 4))


def _ratio_sql(rows: str) -> str:
    """Of rows (..., a, b): with `ratio`, the best common subsequence of the shorter
    text with the windows of the longer one, a bit for each of its characters."""
    bits = "list_sum(list_transform(range(1, m + 1), lambda i: CASE WHEN substring(s, i, 1) = c THEN CAST(1 AS BIGINT) << CAST(i - 1 AS INT) ELSE 0 END))"
    row = "(((r + (r & x)) | (r - (r & x))) & ones)"
    window = "list_slice(masks, greatest(1, e - m + 1), least(e, n))"
    common = f"m - bit_count(list_reduce({window}, lambda r, x: {row}, ones))"
    size = "(least(e, n) - greatest(0, e - m))"
    return f"""
 rs AS (SELECT *, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l FROM {rows}),
 rm AS (SELECT *, CAST(length(s) AS BIGINT) AS m, CAST(length(l) AS BIGINT) AS n, (CAST(1 AS BIGINT) << CAST(length(s) AS INT)) - 1 AS ones FROM rs),
 rc AS (SELECT *, list_transform(string_split(l, ''), lambda c: CAST(coalesce({bits}, 0) AS BIGINT)) AS masks FROM rm),
 rated AS (SELECT * EXCLUDE (s, l, m, n, ones, masks), CASE WHEN m = 0 THEN CASE WHEN n = 0 THEN 100.0 ELSE 0.0 END WHEN contains(l, s) THEN 100.0
  ELSE list_max(list_transform(range(1, n + m), lambda e: CAST(200.0 AS DOUBLE) * ({common}) / (m + {size}))) END AS ratio FROM rc)"""


@query(
    fx.with_(fx.SKILLS, " x AS (SELECT item_id, skill_code, lower(skill_name) AS a, lower(text) AS b FROM benchmark, v4)", _ratio_sql("x"))
    + " SELECT item_id, skill_code, round(ratio, 6) AS ratio FROM rated"
)
def partial_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.broadcast(fx.skills(spark, sf_dir).select("skill_code", F.col("skill_name").alias("name")))  # 40 rows
    items = fx.table(spark, sf_dir, "benchmark").select("item_id", "text")
    return items.crossJoin(known).select("item_id", "skill_code", F.round(partial_ratio("name", "text"), 6).alias("ratio"))


@query()  # SQL compares every window of every text with every name: too slow
def skill_match_misspelt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarities below 100: names that differ from what their patterns find."""
    tagged = skills.match_skills(fx.postings(spark, sf_dir), cut_lineage(fx.misspelt_skills(spark, sf_dir)))
    each = tagged.select("pst_id", F.posexplode("skills").alias("at", "s"))
    return each.select("pst_id", "s.skill_code", F.round("s.similarity", 6).alias("similarity"), (F.col("at") + 1).alias("place"))


@query("SELECT CASE WHEN length(c) >= 2 THEN substring(c, 1, 2) ELSE '00' END AS category, count(*) AS n FROM (SELECT substring(p_brand, 1, CAST(p_partkey % 4 AS INT)) AS c FROM part) GROUP BY 1")
def skill_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.substring(F.col("p_brand"), F.lit(1), (F.col("p_partkey") % 4).cast("int"))
    return fx.table(spark, sf_dir, "part").select(text.skill_category(code).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(fx.with_(fx.POSTINGS) + " SELECT pst_id, CAST(CAST('0x' || substring(md5(pst_id), 1, 8) AS BIGINT) % 8 AS INT) AS shard FROM v1")
def hash_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.postings(spark, sf_dir).select("pst_id", skills.shard_of("pst_id", 8).alias("shard"))
