"""Matches postings to the company register, policy by policy, and goes on where an
earlier run stopped.

    python -m jobs.match_companies --input FOLDER --output FOLDER [--config FILE]

Output: `outcomes`, for each attempt the postings that it took and their match or
none; `matches`, the matched postings with the industry of their company, by policy.
A posting is pending at an attempt if no earlier one matched it and this one hasn't
taken it yet. So a run that was killed goes on with the attempt it was at, a second
run over the same tables has nothing to do, and one over more tables takes what is
new only.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions.lineage import forget, freed, stored
from jobloom.operators import match
from jobloom.sources.keyed import read_or_empty
from jobs.common import configuration, logger, session, show_log, table

LOG = logger("match_companies")
OUTCOME = "pst_id string, matched_company_name string, bzno string, score double, confidence double, match_type string, matching_policy string, generation int, matching_attempt int"
_KNOWN = {p.name: p for p in (*match.POLICIES, match.VERY_RELAXED)}


def pending(postings: DataFrame, outcomes: DataFrame, attempt: int, generation: int) -> DataFrame:
    """Postings that this attempt has still to take."""
    matched, taken = F.col("bzno").isNotNull(), (F.col("matching_attempt") == attempt) & (F.col("generation") >= generation)
    return postings.join(outcomes.filter(matched | taken).select("pst_id").hint("merge"), "pst_id", "left_anti")


def run(spark: SparkSession, source: str, output: str, config: dict) -> DataFrame:
    """Reads the tables of config in the folder source; returns the matches."""
    tables = {k: table(spark, source, v, config["format"]) for k, v in config["tables"].items()}
    companies = spark.sql(config["sql"]["companies"], **tables)
    postings = spark.sql(config["sql"]["postings"], companies=companies.hint("merge"), **{k: v for k, v in tables.items() if f"{{{k}}}" in config["sql"]["postings"]})
    register = stored(match.prepare_companies(companies, "loaded"))
    rows = match.prepare_postings(postings)
    rows = stored(rows if config["by_text"] else rows.select("co_nm", *match.NAMED))  # without texts that nothing reads
    LOG.info("read %d postings and %d companies from %s", rows.count(), register.count(), source)
    generation = config["generation"]
    for attempt, name in enumerate(config["policies"]):
        outcomes = read_or_empty(spark, f"{output}/outcomes", OUTCOME)
        left = stored(pending(rows, outcomes, attempt, generation))
        if left.isEmpty():
            LOG.info("attempt %d (%s): nothing pending", attempt, name)
            continue
        policy = _KNOWN[name]
        found = match.match(left, register, policy) if config["by_text"] else match.match_by_name(left, register, policy)
        taken = left.select("pst_id").distinct().join(found.drop("ksic", "ksic9").hint("merge"), "pst_id", "left")
        taken = taken.withColumns({"generation": F.lit(generation), "matching_attempt": F.lit(attempt)})
        _append(taken.select([c.split()[0] for c in OUTCOME.split(", ")]), f"{output}/outcomes")
        forget(left)
        done = read_or_empty(spark, f"{output}/outcomes", OUTCOME).filter(F.col("matching_attempt") == attempt).agg(F.count(F.lit(1)).alias("n"), F.count("bzno").alias("m")).first()
        LOG.info("attempt %d (%s): took %d, matched %d in all", attempt, name, done["n"], done["m"])
    matched = read_or_empty(spark, f"{output}/outcomes", OUTCOME).filter("bzno is not null")
    out = match.with_industry(matched, register.select("bzno", "ksic", "ksic9")).drop("generation")
    freed(out.write.mode("overwrite").partitionBy("matching_policy"), f"{output}/matches")
    forget(rows, register)
    back = spark.read.schema(out.schema).parquet(f"{output}/matches")
    LOG.info("wrote %d matches to %s", back.count(), output)
    return back


def _append(taken: DataFrame, path: str) -> None:
    freed(taken.write.mode("append").partitionBy("matching_attempt"), path)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("input", "output"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config")
    given = parser.parse_args(arguments)
    show_log()
    spark = session("match_companies")
    try:
        run(spark, given.input, given.output, configuration(given.config, "match_companies.toml"))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
