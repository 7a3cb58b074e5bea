"""Tables of one row a key, as Parquet in folders by hash of the key.

A change is computed against the columns it needs, and only the folders that a
changed key falls in are read whole and replaced, by dynamic partition overwrite.
What replaces them is written beside the table first, with a mark that it is whole:
if a run is killed while folders are being replaced, `recover` replaces them again
from there. Deleted keys stay as marks, so that no folder is ever left without rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAGED, PUBLISHED = "STAGED", "PUBLISHED"
_STATE = "step string, rows long, buckets int"


class KeyedTable(NamedTuple):
    """path: of folders `rows`, `staged` and `state`; schema: without what is kept
    beside the rows; buckets: folders, to be the same in all calls."""

    path: str
    schema: T.StructType
    key: str
    buckets: int = 64


class Written(NamedTuple):
    """rows: changed keys; buckets: folders replaced."""

    rows: int
    buckets: int


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet at path, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _stored(spark: SparkSession, table: KeyedTable, folder: str = "rows") -> DataFrame:
    schema = T.StructType([*table.schema.fields, T.StructField("_deleted", T.BooleanType()), T.StructField("_bucket", T.IntegerType())])
    return read_or_empty(spark, f"{table.path}/{folder}", schema)


def rows_of(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return _stored(spark, table).filter("not _deleted").select(table.schema.names)


def first_of_key(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """One row a key, the least by order. Aggregated before the shuffle, so that a key
    of any number of rows is one row of each task."""
    best = rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*rows.columns), order).alias("_row"))
    return best.select("_row.*")


def better(spark: SparkSession, table: KeyedTable, news: DataFrame, order) -> DataFrame:
    """The rows of news, one a key, that have no stored row of their key or come
    before it. order: of a prefix of columns, the sorting value."""
    names = table.schema.names
    once = first_of_key(news.select(names), table.key, order(F.col))
    known = rows_of(spark, table).select(F.col(table.key).alias("_k"), order(F.col).alias("_o"))
    joined = once.join(known, F.col(table.key).eqNullSafe(F.col("_k")), "left")
    return joined.filter(F.col("_o").isNull() | (order(F.col) < F.col("_o"))).select(names)


def unlike(spark: SparkSession, table: KeyedTable, news: DataFrame) -> DataFrame:
    """Upsert: the rows of news (one a key) that differ from what is stored."""
    names = table.schema.names
    stored = rows_of(spark, table).select(F.col(table.key).alias("_k"), F.struct(*names).alias("_r"))
    joined = news.select(names).join(stored, F.col(table.key).eqNullSafe(F.col("_k")), "left")
    return joined.filter(F.col("_r").isNull() | ~F.struct(*names).eqNullSafe(F.col("_r"))).select(names)


def absent(spark: SparkSession, table: KeyedTable, news: DataFrame) -> DataFrame:
    """Insert that skips: the rows of news (one a key) whose key isn't stored."""
    known = rows_of(spark, table).select(F.col(table.key).alias("_k"))
    return news.select(table.schema.names).join(known, F.col(table.key).eqNullSafe(F.col("_k")), "left_anti")


def updated(spark: SparkSession, table: KeyedTable, news: DataFrame, columns: list[str]) -> DataFrame:
    """Update: stored rows with the values of news (one row a key) where it has any,
    of keys that it changes."""
    side = news.select(F.col(table.key).alias("_k"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = rows_of(spark, table).join(side, F.col(table.key).eqNullSafe(F.col("_k")))
    value = {c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}
    changed = F.lit(False)
    for c in columns:
        changed |= ~value[c].eqNullSafe(F.col(c))
    return joined.filter(changed).select([value.get(c, F.col(c)).alias(c) for c in table.schema.names])


def stage(spark: SparkSession, table: KeyedTable, changed: DataFrame, deleted: bool = False) -> Written:
    """Writes the folders of the changed rows (one a key) as they will be, beside the
    table. deleted: the keys of changed are to go."""
    bucket = F.pmod(F.xxhash64(table.key), F.lit(table.buckets)).cast("int")
    wide = [F.col(n) if n in changed.columns else F.lit(None).cast(table.schema[n].dataType).alias(n) for n in table.schema.names]
    news = changed.select(*wide, F.lit(deleted).alias("_deleted"), bucket.alias("_bucket"))
    news.write.mode("overwrite").parquet(f"{table.path}/changes")
    news = spark.read.schema(news.schema).parquet(f"{table.path}/changes")
    counts = news.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # buckets rows at most
    rows, touched = sum(r["n"] for r in counts), [r["_bucket"] for r in counts]
    if rows:
        old = _stored(spark, table).filter(F.col("_bucket").isin(touched))
        gone = news.select(F.col(table.key).alias("_k"))
        every = old.join(gone, F.col(table.key).eqNullSafe(F.col("_k")), "left_anti").unionByName(news)
        every.repartition("_bucket", F.pmod(F.xxhash64(F.lit(1), table.key), F.lit(4))).write.mode("overwrite").partitionBy("_bucket").parquet(f"{table.path}/staged")
    _mark(spark, table, STAGED if rows else PUBLISHED, rows, len(touched))
    return Written(rows, len(touched))


def _mark(spark: SparkSession, table: KeyedTable, step: str, rows: int, buckets: int) -> None:
    spark.createDataFrame([(step, rows, buckets)], _STATE).coalesce(1).write.mode("overwrite").parquet(f"{table.path}/state")


def publish(spark: SparkSession, table: KeyedTable, written: Written) -> Written:
    """Replaces the staged folders. May be repeated."""
    if written.rows:
        staged = _stored(spark, table, "staged")
        spread = F.pmod(F.xxhash64(F.lit(1), table.key), F.lit(4))
        staged.repartition("_bucket", spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(f"{table.path}/rows")
        _mark(spark, table, PUBLISHED, *written)
    return written


def recover(spark: SparkSession, table: KeyedTable) -> Written:
    """Ends what a run that was killed had staged whole, if there is any."""
    last = read_or_empty(spark, f"{table.path}/state", _STATE).first()
    return publish(spark, table, Written(last["rows"], last["buckets"])) if last and last["step"] == STAGED else Written(0, 0)


def replace(spark: SparkSession, table: KeyedTable, changed: DataFrame, deleted: bool = False) -> Written:
    """The changed rows (one a key) in the table, in place of those of their keys."""
    recover(spark, table)
    return publish(spark, table, stage(spark, table, changed, deleted))
