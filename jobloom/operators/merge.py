"""Sources aligned to one schema and merged."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.functions.text import posting_time, year_and_month


def dated(rows: DataFrame, source: str, as_of: date | None = None) -> DataFrame:
    """rows with year and month: from pst_strt, or of as_of where a source has no dates."""
    if "pst_strt" in rows.columns:
        year, month = year_and_month("pst_strt")
    else:
        day = F.lit(as_of).cast("date") if as_of else F.current_date()
        year, month = F.year(day), F.month(day)
    return rows.withColumns({"year": year, "month": month})


def latest_per_id(rows: DataFrame, key: str = "pst_id", at: str = "pst_strt", order: str = "load_order") -> DataFrame:
    """One row of each key: the latest by text order of `at`, nulls last, then the first loaded."""
    sort = ([F.col(at).desc_nulls_last()] if at in rows.columns else []) + [F.col(order).asc()]
    window = Window.partitionBy(key).orderBy(*sort)
    return rows.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def align(rows: DataFrame, source: str) -> DataFrame:
    """The merged columns, nulls where a source has none, only postings with more
    than ten characters of detail."""
    kinds = {f.name: f.dataType for f in schemas.merged().fields}

    def column(name: str):
        if name == "source":
            value = F.lit(source)
        elif name not in rows.columns:
            value = F.lit(None)
        elif name in ("pst_strt", "pst_end"):
            value = posting_time(name)
        else:
            value = F.col(name)
        return value.cast(kinds[name]).alias(name)

    return rows.filter(F.length("pst_detail") > 10).select(*map(column, schemas.MERGED))


def merge(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources under one another; a posting in several is that of the first in
    PRECEDENCE. One shuffle, by pst_id."""
    every = reduce(DataFrame.unionByName, [align(sources[s], s) for s in schemas.PRECEDENCE if s in sources])
    return precedence(every)


def precedence(rows: DataFrame, key: str = "pst_id") -> DataFrame:
    rank = F.array_position(F.array(*[F.lit(s) for s in schemas.PRECEDENCE]), F.col("source"))
    window = Window.partitionBy(key).orderBy(rank)
    return rows.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")
