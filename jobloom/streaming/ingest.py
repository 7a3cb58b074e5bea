"""Postings that arrive as files, merged batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobloom import schemas
from jobloom.functions.text import clean_field
from jobloom.operators.merge import align, dated


def stream_postings(spark: SparkSession, source: str, folder: str, per_batch: int = 100) -> DataFrame:
    """Files of a folder as they come; the checkpoint knows which are done, as the
    ledger does for batch runs."""
    names = schemas.SOURCES[source]
    reader = spark.readStream.schema(schemas.strings(*names)).option("sep", "\t").option("header", True).option("multiLine", True)
    raw = reader.option("quote", '"').option("escape", '"').option("maxFilesPerTrigger", per_batch).csv(folder)
    return raw.select(*[clean_field(n).alias(n) for n in names])


def merged_stream(spark: SparkSession, source: str, folder: str) -> DataFrame:
    return align(dated(stream_postings(spark, source, folder), source), source)


def first_seen(rows: DataFrame, hours: int = 48) -> DataFrame:
    """Each posting once, as long as its copies come within the watermark; state is
    bounded by it."""
    stamped = rows.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", f"{hours} hours")
    return stamped.dropDuplicatesWithinWatermark(["pst_id"]).drop("arrived")


def append_new(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: what the table at path hasn't yet, by pst_id. A batch that
    runs again adds nothing."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        one = batch.dropDuplicates(["pst_id"])
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            one = one.join(spark.read.parquet(path).select("pst_id"), "pst_id", "left_anti")
        one.write.mode("append").parquet(path)

    return write


def run(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append_new(path))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
