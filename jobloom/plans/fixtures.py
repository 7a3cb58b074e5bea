"""Postings, companies, mentions and skills made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _third():
    return F.floor(F.col("doc_id") / 3).cast("int") % 12 + 1


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pst_id, pst_detail, source, month, year, pst_strt_raw) of documents."""
    kind = F.col("doc_id") % 3
    month = F.lpad(_third().cast("string"), 2, "0")
    raw = F.when(kind == 0, F.concat(F.lit("2024."), month, F.lit(".11 14:31"))).when(kind == 1, F.concat(F.lit("2024."), month, F.lit(".01(목)")))
    return table(spark, sf_dir, "documents").select(
        F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("pst_id"),
        F.col("text").alias("pst_detail"),
        F.when(kind == 0, "srm").when(kind == 1, "jk").otherwise("jkhd").alias("source"),
        _third().alias("month"),
        F.lit(2024).alias("year"),
        raw.alias("pst_strt_raw"),
    )


POSTINGS = """
v1 AS (SELECT lpad(CAST(doc_id AS VARCHAR), 8, '0') AS pst_id, text AS pst_detail,
 CASE doc_id % 3 WHEN 0 THEN 'srm' WHEN 1 THEN 'jk' ELSE 'jkhd' END AS source,
 CAST(floor(doc_id / 3) AS INT) % 12 + 1 AS month, 2024 AS year,
 CASE doc_id % 3 WHEN 0 THEN concat('2024.', lpad(CAST(CAST(floor(doc_id / 3) AS INT) % 12 + 1 AS VARCHAR), 2, '0'), '.11 14:31')
                 WHEN 1 THEN concat('2024.', lpad(CAST(CAST(floor(doc_id / 3) AS INT) % 12 + 1 AS VARCHAR), 2, '0'), '.01(목)') END AS pst_strt_raw
 FROM documents)"""


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(bzno, nm, title, address, ksic, ksic9) of customer."""
    name = F.substring(F.translate(F.md5(F.col("c_custkey").cast("string")), "0123456789abcdef", "가나다라마바사아자차카타파하거너"), F.lit(1), (F.col("c_custkey") % 5 + 2).cast("int"))
    form, place = F.col("c_custkey") % 3, F.col("c_nationkey") % 6
    rows = table(spark, sf_dir, "customer").withColumn("nm", name)
    return rows.select(
        F.col("c_custkey").cast("string").alias("bzno"),
        "nm",
        F.when(form == 0, F.concat(F.lit("(주)"), "nm")).when(form == 1, F.concat("nm", F.lit(" 주식회사"))).otherwise(F.col("nm")).alias("title"),
        F.when(place == 0, "서울특별시 강남구").when(place == 1, "경기도 성남시 분당구").when(place == 2, "부산광역시 해운대구").when(place == 3, "경기도 광주시").when(place == 4, "충청남도 천안시").otherwise("").alias("address"),
        F.col("c_mktsegment").alias("ksic"),
        F.col("c_nationkey").cast("string").alias("ksic9"),
    )


COMPANIES = """
v2 AS (SELECT CAST(c_custkey AS VARCHAR) AS bzno, nm,
 CASE c_custkey % 3 WHEN 0 THEN concat('(주)', nm) WHEN 1 THEN concat(nm, ' 주식회사') ELSE nm END AS title,
 CASE c_nationkey % 6 WHEN 0 THEN '서울특별시 강남구' WHEN 1 THEN '경기도 성남시 분당구' WHEN 2 THEN '부산광역시 해운대구'
      WHEN 3 THEN '경기도 광주시' WHEN 4 THEN '충청남도 천안시' ELSE '' END AS address,
 c_mktsegment AS ksic, CAST(c_nationkey AS VARCHAR) AS ksic9
 FROM (SELECT *, substring(translate(md5(CAST(c_custkey AS VARCHAR)), '0123456789abcdef', '가나다라마바사아자차카타파하거너'), 1, CAST(2 + c_custkey % 5 AS INT)) AS nm FROM customer) c)"""


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pst_id, co_nm, loc, corp_addr, true_bzno) of all orders: company names as
    postings spell them."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("bzno"))
    rows = orders.join(companies(spark, sf_dir).hint("merge"), "bzno")  # a small file may hold millions of names
    form = F.col("o_orderkey") % 5
    shorter = F.substring(F.col("nm"), F.lit(1), F.length("nm") - 1)
    return rows.select(
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("pst_id"),
        F.when(form == 0, F.col("title")).when(form == 1, F.col("nm")).when(form == 2, F.concat("nm", F.lit("지점"))).when(form == 3, shorter).alias("co_nm"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("address")).otherwise("제주도 서귀포시").alias("loc"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("address")).otherwise("").alias("corp_addr"),
        F.col("bzno").alias("true_bzno"),
    )


MENTIONS = """
v3 AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS pst_id,
 CASE o_orderkey % 5 WHEN 0 THEN title WHEN 1 THEN nm WHEN 2 THEN concat(nm, '지점') WHEN 3 THEN substring(nm, 1, length(nm) - 1) END AS co_nm,
 CASE WHEN o_orderkey % 2 = 0 THEN address ELSE '제주도 서귀포시' END AS loc,
 CASE WHEN o_orderkey % 3 = 0 THEN address ELSE '' END AS corp_addr, bzno AS true_bzno
 FROM orders JOIN v2 ON v2.bzno = CAST(o_custkey AS VARCHAR))"""


def skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 40 most frequent longer English words as a skill dictionary."""
    from pyspark.sql import Window

    words = table(spark, sf_dir, "documents").filter("lang = 'en'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w"))
    counts = words.filter(F.length("w") >= 5).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), "w").limit(40)  # the dictionary is the report of 40
    rows = top.withColumn("rnk", F.row_number().over(Window.orderBy(F.col("n").desc(), "w")))
    form = F.col("rnk") % 3
    code = F.concat(F.when(F.col("rnk") % 2 == 0, "A1").otherwise("B2"), F.lpad(F.col("rnk").cast("string"), 4, "0"))
    key = F.when(form == 0, F.concat(F.lit("(?i)"), "w")).when(form == 1, F.col("w")).otherwise(F.concat(F.lit("r'(?i)"), "w", F.lit("'")))
    return rows.select(code.alias("skill_code"), F.col("w").alias("skill_name"), key.alias("ext_key"), (F.col("rnk") % 2).cast("int").alias("softskill"))


SKILLS = """
v4 AS (SELECT concat(CASE WHEN rnk % 2 = 0 THEN 'A1' ELSE 'B2' END, lpad(CAST(rnk AS VARCHAR), 4, '0')) AS skill_code, w AS skill_name,
 CASE rnk % 3 WHEN 0 THEN concat('(?i)', w) WHEN 1 THEN w ELSE concat('r''(?i)', w, '''') END AS ext_key, CAST(rnk % 2 AS INT) AS softskill, rnk
 FROM (SELECT w, row_number() OVER (ORDER BY n DESC, w) AS rnk FROM (
  SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents WHERE lang = 'en') t WHERE length(w) >= 5 GROUP BY w) g) r
 WHERE rnk <= 40)"""


def misspelt_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """skills() with the same patterns and other names: the word as it is, without a
    letter, with another letter, three of its letters behind two others, or with more behind it."""
    rows = skills(spark, sf_dir).withColumnRenamed("skill_name", "w")
    kind = F.substring("skill_code", -1, 1).cast("int") % 5
    name = (
        F.when(kind == 1, F.concat(F.substring("w", 1, 2), F.expr("substring(w, 4)"))).when(kind == 2, F.concat(F.substring("w", 1, 2), F.lit("q"), F.expr("substring(w, 4)")))
        .when(kind == 3, F.concat(F.lit("zq"), F.substring("w", 1, 3))).when(kind == 4, F.concat("w", F.lit(" qz"))).otherwise(F.col("w"))
    )
    return rows.select("skill_code", name.alias("skill_name"), "ext_key", "softskill")


def with_(*views: str) -> str:
    return "WITH " + ",".join(views)
