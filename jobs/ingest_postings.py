"""Merges postings that arrive as files into one table, a row a posting.

    python -m jobs.ingest_postings --input PATH --output FOLDER --checkpoint FOLDER [--config FILE]

PATH is a folder, or a pattern of files or folders. A stream takes the files there
that its checkpoint hasn't seen and ends. Postings are
aligned to one schema, those with little text left out. Of the rows of a posting
that of the first source in the order of precedence stays, of one source the
latest, whatever the order in which they arrive; so a batch that runs again changes
nothing. Only folders of postings that change are rewritten. Output: `postings`, the table (see
jobloom.sources.keyed), and `log`, by batch what was read and written.
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.operators import merge
from jobloom.sources import keyed
from jobs.common import configuration, logger, session, show_log

LOG = logger("ingest_postings")


def keyed_table(output: str, buckets: int) -> keyed.KeyedTable:
    return keyed.KeyedTable(f"{output.rstrip('/')}/postings", schemas.merged(), "pst_id", buckets)


def order(column):
    """Precedence of the source, then the latest, then the text itself."""
    rank = F.array_position(F.array(*[F.lit(s) for s in schemas.PRECEDENCE]), column("source"))
    late = F.coalesce(-F.unix_micros(column("pst_strt").cast("timestamp")), F.lit((1 << 63) - 1))
    return F.struct(rank.alias("rank"), late.alias("late"), F.md5(F.coalesce(column("pst_detail"), F.lit(""))).alias("text"), F.coalesce(column("pst_title"), F.lit("")).alias("title"))


def aligned(batch: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of the files in the merged columns."""
    rows = batch.select(*[F.expr(v).alias(k) for k, v in columns.items()])
    parts = []
    for source, names in schemas.SOURCES.items():
        own = rows.filter(F.col("source") == source).select([c for c in rows.columns if c in (*names, "year", "month")])
        parts.append(merge.align(own if {"year", "month"} <= set(own.columns) else merge.dated(own, source), source))
    return reduce(DataFrame.unionByName, parts)


def take(spark: SparkSession, batch: DataFrame, number: int, output: str, config: dict) -> None:
    """One batch into the table."""
    table = keyed_table(output, config["buckets"])
    keyed.recover(spark, table)
    rows = aligned(batch, config["columns"])
    written = keyed.replace(spark, table, keyed.better(spark, table, rows, order))
    read = batch.count()
    log = spark.createDataFrame([(number, read, written.rows, written.buckets)], "batch long, n_read long, n_changed long, n_folders int")
    log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{output}/log")
    LOG.info("batch %d: read %d rows, changed %d postings in %d of %d folders", number, read, written.rows, written.buckets, table.buckets)


def run(spark: SparkSession, source: str, output: str, checkpoint: str, config: dict) -> DataFrame:
    """Takes what is new at source and returns the whole table."""
    kind = config["format"]
    keyed.recover(spark, keyed_table(output, config["buckets"]))
    schema = spark.read.format(kind).load(source).schema
    files = spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", config["files_per_batch"]).load(source)
    step = lambda batch, number: take(batch.sparkSession, batch, number, output, config)
    query = files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
    query.awaitTermination()
    out = keyed.rows_of(spark, keyed_table(output, config["buckets"]))
    LOG.info("%s holds %d postings", output, out.count())
    return out


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("input", "output", "checkpoint"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config")
    given = parser.parse_args(arguments)
    show_log()
    spark = session("ingest_postings")
    try:
        run(spark, given.input, given.output, given.checkpoint, configuration(given.config, "ingest_postings.toml"))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
