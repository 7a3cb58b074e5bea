"""The stages in their order, each a transformation of tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.functions.lineage import cut_lineage
from jobloom.operators import classify, dedup, match, merge, skills
from jobloom.sources import tables


@dataclass
class Inputs:
    """postings: by source. as_of: the day of sources without dates."""

    postings: dict[str, DataFrame]
    companies: DataFrame
    skills: DataFrame
    occupations: DataFrame | None = None
    predictions: DataFrame | None = None
    as_of: date | None = None
    fuzzy: bool = False


def merged(inputs: Inputs) -> DataFrame:
    return merge.merge({s: merge.latest_per_id(merge.dated(rows, s, inputs.as_of)) for s, rows in inputs.postings.items()})


def deduplicated(rows: DataFrame, fuzzy: bool = False) -> DataFrame:
    """Each stage reads its input several times, so lineage is cut between them."""
    rows = cut_lineage(dedup.exact_dedup_source(cut_lineage(dedup.exact_dedup_month(cut_lineage(rows)))))
    return cut_lineage(dedup.fuzzy_dedup_source(cut_lineage(dedup.fuzzy_dedup_month(rows)))) if fuzzy else rows


def run(inputs: Inputs) -> DataFrame:
    """Merge, deduplicate, match companies, attach occupations, tag skills, expand.
    Stage outputs are joined by pst_id."""
    rows = deduplicated(merged(inputs), inputs.fuzzy)
    companies = cut_lineage(match.prepare_companies(inputs.companies))
    matched = match.match_progressively(cut_lineage(match.prepare_postings(rows)), companies)
    rows = rows.join(matched.select("pst_id", "matched_company_name", "bzno", "ksic", "ksic9"), "pst_id", "left")
    if inputs.predictions is not None and inputs.occupations is not None:
        codes = classify.with_codes(inputs.predictions, inputs.occupations).select("pst_id", "keco_4", "keco_t")
        rows = rows.join(codes, "pst_id", "left")
    rows = cut_lineage(rows)
    tagged = skills.joined_columns(skills.match_skills(rows, inputs.skills), inputs.skills)
    rows = tables.update_by_key(rows, tagged.select("pst_id", "skill_code"), "pst_id", ["skill_code"])
    return skills.expand(rows, inputs.skills)


def read_inputs(spark: SparkSession, folders: dict[str, list[str]], companies: str, dictionary: str, occupations: str | None = None) -> Inputs:
    """folders: the paths of each source, of which those with a number of its range
    are read."""
    postings = {s: tables.read_postings(spark, s, files) for s, names in folders.items() if s in schemas.SOURCES and (files := tables.select_files(names, s))}
    known = tables.read_occupations(spark, occupations) if occupations else None
    return Inputs(postings, tables.read_companies(spark, companies), tables.read_skills(spark, dictionary), known)


def posting_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "month").agg(F.count(F.lit(1)).alias("n_rows"))
