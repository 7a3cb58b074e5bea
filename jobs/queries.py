"""The jobs as queries over the driver's tables: each runs twice into a folder of
its own and returns the output as it then is."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import queries as own
from jobloom.functions.lineage import shared_folder
from jobloom.plans import fixtures as fx
from jobs import ingest_postings, match_companies
from jobs.common import configuration


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_match_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, config = _folder(spark, "match-companies"), configuration(None, "match_companies.toml")
    for _ in range(2):
        out = match_companies.run(spark, sf_dir, folder, config)
    return out.select("pst_id", "matched_company_name", "bzno", F.round("confidence", 6).alias("confidence"), "match_type", "matching_policy", "matching_attempt", "ksic", "ksic9")


def job2_ingest_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a pattern: the table may be a file, and a stream takes folders and patterns only
    folder, config = _folder(spark, "ingest-postings"), configuration(None, "ingest_postings.toml")
    for _ in range(2):
        out = ingest_postings.run(spark, f"{sf_dir}/documents.parque[t]", f"{folder}/out", f"{folder}/checkpoint", config)
    when = F.date_format("pst_strt", "yyyy-MM-dd HH:mm:ss")
    return out.select("pst_id", "source", "year", "month", "pst_title", when.alias("pst_strt"), F.md5("pst_detail").alias("detail_md5"))


QUERIES = {f.__name__: f for f in (job1_match_companies, job2_ingest_postings)}

ORACLE_SQL = {
    "job1_match_companies": own.PROGRESSIVE + " SELECT r.*, v2.ksic, v2.ksic9 FROM r LEFT JOIN v2 ON v2.bzno = r.bzno",
    "job2_ingest_postings": fx.with_(
        fx.POSTINGS,
        " x AS (SELECT lpad(CAST(CAST(v1.pst_id AS INT) // 2 AS VARCHAR), 8, '0') AS pst_id, v1.source, year, month, CASE WHEN v1.source <> 'jkhd' THEN coalesce(lang, '') || ' 공고' END AS pst_title,"
        f" CASE WHEN v1.source <> 'jkhd' THEN strftime({own.WHEN}, '%Y-%m-%d %H:%M:%S') END AS pst_strt, md5(pst_detail) AS detail_md5"
        " FROM v1 JOIN documents ON lpad(CAST(doc_id AS VARCHAR), 8, '0') = v1.pst_id WHERE length(pst_detail) > 10)",
    )
    + """
SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY pst_id
 ORDER BY CASE source WHEN 'jk' THEN 1 WHEN 'jkhd' THEN 2 ELSE 3 END, pst_strt DESC NULLS LAST, detail_md5, coalesce(pst_title, '')) = 1""",
}
