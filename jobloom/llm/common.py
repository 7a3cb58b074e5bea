"""What the operators share: a scratch folder that all executors see, written
tables that cut lineage, and the dealing of documents into bounded groups."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import math
import tempfile
import time
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all contracts: space and tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Frees a written table's shuffle files as soon as the write has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; where it is unset (tests
    in local mode) a folder of our own."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="jobloom-")
        spark.conf.set("spark.checkpoint.dir", base)
        atexit.register(_remove, base)
    return base.rstrip("/") + "/jobloom-llm"


def _remove(uri: str) -> None:
    from pyarrow import fs

    with contextlib.suppress(Exception):
        store, path = fs.FileSystem.from_uri(uri)
        store.delete_dir(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, path)
    return path


def written(df: DataFrame, label: str, partition_by: str | None = None, group_bytes: int | None = None) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends
    there, and an executor lost later takes nothing with it. group_bytes: what a
    writer holds of its file at most, for rows with large values."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer = writer.option("parquet.block.size", group_bytes) if group_bytes else writer
        writer.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        for name in table.inputFiles()[:1]:
            folder = name[: name.rindex("/part-")]
            while "=" in folder.rsplit("/", 1)[1]:
                folder = folder.rsplit("/", 1)[0]
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(table: DataFrame, rows: int = 200_000) -> DataFrame:
    """A written table, to be broadcast if it has no more than `rows` rows; else
    joined as it is, with Spark splitting hot keys."""
    return F.broadcast(table) if table.count() <= rows else table


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores in front until no column has them: what an
    operator adds to rows of unknown columns never meets one of theirs."""
    taken, found = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def empty_text(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def dealt(docs: DataFrame, group_bytes: int, also: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(doc_id, no_id, text, pid): documents dealt by hash into groups of about
    group_bytes of text. A null text is empty, a null doc_id is 0 with no_id. Row identity is doc_id and text,
    so rows that share a doc_id needn't share a group."""
    size = docs.agg(F.sum(F.octet_length(F.col("text"))).alias("b"), F.count(F.lit(1)).alias("n")).first()
    groups = max(1, math.ceil(((size["b"] or 0) + 64 * size["n"]) / group_bytes))
    pid = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    no_id = F.col("doc_id").isNull()  # pandas would turn integers beside nulls into floats
    return docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), no_id.alias("no_id"), empty_text().alias("text"), *also, pid.alias("pid")), groups


_last_trim = 0.0


def trim() -> None:
    """Gives memory that a worker no longer uses back to the system, at most once a
    second: idle workers of earlier stages stay beside those of the next."""
    global _last_trim
    if time.monotonic() - _last_trim < 1:
        return
    _last_trim = time.monotonic()
    with contextlib.suppress(Exception):  # where the allocator can't do it
        import pyarrow

        pyarrow.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(work):
    """A function of groups that trims behind itself. It has as many parameters, by
    which Spark tells whether it wants the key."""

    def run(*args):
        try:
            return work(*args)
        finally:
            trim()

    return {1: lambda a: run(a), 2: lambda a, b: run(a, b), 3: lambda a, b, c: run(a, b, c)}[work.__code__.co_argcount]


def whole_ids(values, null) -> "pd.arrays.IntegerArray":
    """Integers with nulls where null is true, never by way of floats."""
    import pandas as pd

    return pd.arrays.IntegerArray(np.array(values, np.int64), np.array(null, bool))


def planes(values: np.ndarray) -> bytes:
    """Bytes of an array, plane by plane: the high bytes of sorted values then
    compress to almost nothing in the shuffle."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def unplanes(blob: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(blob, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(dtype)


def frugal(spark: SparkSession) -> None:
    """Arrow batches to Python of at most some MB, whatever the length of texts."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 2000), ("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)):
        with contextlib.suppress(Exception):
            if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
                spark.conf.set(key, most)
