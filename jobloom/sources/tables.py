"""Sources and sinks: delimited files, dictionaries, the file ledger, exports."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom import schemas
from jobloom.functions.text import clean_field, skill_category

# The numbers of the files that belong to a folder.
FILE_NUMBERS = {"jk": range(18), "jkhd": range(3), "srm": range(15)}


def read_delimited(spark: SparkSession, paths: str | list[str], schema: T.StructType, sep: str = "\t") -> DataFrame:
    """Columns by position; the header line is there but not looked at. Quoted
    fields may hold line ends, and a quote in them is doubled."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", True).option("enforceSchema", True)
    return reader.option("multiLine", True).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1).csv(paths)


def read_postings(spark: SparkSession, source: str, paths: str | list[str]) -> DataFrame:
    """Postings of one source as strings, cleaned, with file and load_order."""
    names = schemas.SOURCES[source]
    raw = read_delimited(spark, paths, schemas.strings(*names))
    return raw.select(*[clean_field(n).alias(n) for n in names], F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("load_order"))


def read_companies(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All 13 columns as strings: numbers keep leading zeros."""
    return read_delimited(spark, paths, schemas.strings(*schemas.COMPANY), "|")


def read_skills(spark: SparkSession, path: str) -> DataFrame:
    """Skill dictionary from Parquet, CSV or, where pandas can read it, a workbook.
    softskill may be missing."""
    if path.endswith(".parquet"):
        rows = spark.read.parquet(path)
    elif path.endswith((".xlsx", ".xls")):
        import pandas as pd

        frame = pd.read_excel(path, dtype=str).astype(object)
        rows = spark.createDataFrame(frame.where(frame.notna(), None), schemas.strings(*frame.columns))
    else:
        rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    missing = [c for c in schemas.SKILL if c not in rows.columns and c != "softskill"]
    if missing:
        raise ValueError(f"skill dictionary lacks {missing}")
    soft = F.col("softskill").cast("string").try_cast("int") if "softskill" in rows.columns else F.lit(None).cast("int")
    rows = rows.select(*[F.col(c).cast("string") for c in schemas.SKILL if c not in ("softskill", "ext_key")], soft.alias("softskill"), F.col("ext_key").cast("string"))
    return first_wins(rows.withColumn("_order", F.monotonically_increasing_id()), ["skill_code"], "_order").drop("_order")


def read_occupations(spark: SparkSession, path: str) -> DataFrame | None:
    """(target, keco_4, keco_t); None if the file or one of its columns is missing."""
    try:
        rows = spark.read.option("header", True).csv(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    if not {"target", "keco_4", "keco_t"} <= set(rows.columns):
        return None
    return rows.select(F.col("target").try_cast("int").alias("target"), "keco_4", "keco_t")


def select_files(names: Iterable[str], source: str) -> list[str]:
    """CSV files of a source's folder: all digits of the name are its number, which
    must be in the folder's range. A folder that isn't known has none."""
    numbers = FILE_NUMBERS.get(source, ())
    found = []
    for name in sorted(n for n in names if n.endswith(".csv")):
        digits = re.sub(r"\D", "", os.path.basename(name))
        if digits and int(digits) in numbers:
            found.append(name)
    return found


def file_number(path) -> F.Column:
    """The number of a file from its path column, for a filter inside a plan."""
    return F.nullif(F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), "[^0-9]", ""), F.lit("")).try_cast("long")


def sample_per_file(rows: DataFrame, most: int = 1000) -> DataFrame:
    """The first `most` rows of each file; needs file and load_order."""
    window = Window.partitionBy("file").orderBy("load_order")
    return rows.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= most).drop("_n")


def pending_files(files: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Files (file_path, ...) that the ledger doesn't have as completed."""
    done = ledger.filter(F.col("status") == schemas.COMPLETED).select("file_path")
    return files if force else files.join(done, "file_path", "left_anti")


def record(ledger: DataFrame, files: DataFrame, table: str, status: str, at: datetime | None = None) -> DataFrame:
    """The ledger with a state for the files; the latest of each file counts."""
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    news = files.select("file_path", F.lit(table).alias("table_name"), when.alias("processed_at"), F.lit(status).alias("status"))
    return latest_wins(ledger, news, ["file_path"])


def forget_files(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """The ledger without the files (file_path): a forced reload begins with that."""
    return delete_by_id(ledger, files, "file_path")


def pending_rows(rows: DataFrame, column: str, attempt: int | None = None) -> DataFrame:
    """Rows that a stage has still to work on: column is null or empty and, if attempt
    is given, matching_attempt is that."""
    left = rows.filter(F.coalesce(F.col(column).cast("string"), F.lit("")) == "")
    return left if attempt is None else left.filter(F.col("matching_attempt") == attempt)


def first_wins(rows: DataFrame, key: list[str], *order) -> DataFrame:
    """One row of each key, the first by order: an insert that skips what is there."""
    window = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def latest_wins(stored: DataFrame, news: DataFrame, key: list[str]) -> DataFrame:
    """Upsert: rows of news replace those of their key."""
    return stored.join(news.select(*key).distinct(), key, "left_anti").unionByName(news)


def update_by_key(rows: DataFrame, news: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rows with the values of news (one row a key) where it has any."""
    side = news.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = rows.join(side, key, "left")
    old = lambda c: [F.col(c)] if c in rows.columns else []
    kept = [c for c in rows.columns if c not in columns]
    return joined.select(*kept, *[F.coalesce(F.col(f"_new_{c}"), *old(c)).alias(c) for c in columns])


def delete_by_id(rows: DataFrame, ids: DataFrame, key: str = "pst_id") -> DataFrame:
    return rows.join(ids.select(key).distinct(), key, "left_anti")


def with_category(skills: DataFrame) -> DataFrame:
    return skills.withColumn("category", skill_category("skill_code"))


def migrate_column(rows: DataFrame, old: str = "predicted_occupation", new: str = "target") -> DataFrame:
    """Values of a column's former name where the new one has none."""
    if old not in rows.columns:
        return rows
    value = F.coalesce(F.col(new), F.col(old)) if new in rows.columns else F.col(old)
    return rows.withColumn(new, value).drop(old)


def has_rows(rows: DataFrame, *columns: str) -> bool:
    """Whether the columns are there and any row is."""
    return set(columns) <= set(rows.columns) and not rows.isEmpty()


def table_ready(spark: SparkSession, name: str, *columns: str) -> bool:
    return spark.catalog.tableExists(name) and has_rows(spark.table(name), *columns)


def backup(rows: DataFrame, path: str) -> None:
    """A copy, unless one is there."""
    rows.write.mode("ignore").parquet(path)


def save(rows: DataFrame, path: str, replace: bool = False) -> None:
    """Partitioned by source and month, so that later stages read what they need."""
    by = [c for c in ("source", "month") if c in rows.columns]
    rows.write.mode("overwrite" if replace else "errorifexists").partitionBy(*by).parquet(path)


def export_csv(rows: DataFrame, path: str | None = None, one_file: bool = False) -> str:
    """CSV with a header in UTF-8; the path may come from EXPANDED_SKILLS_CSV_PATH.
    One file only on request: it is written by a single task."""
    path = path or os.environ["EXPANDED_SKILLS_CSV_PATH"]
    out = rows.coalesce(1) if one_file else rows
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)
    return path


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a relational store, partitioned by the reader's options."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
