"""Cutting the lineage of iterative plans."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

#: Frees a written table's shuffle files as soon as the write has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share; in
    local mode without one, a temporary folder."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="jobloom-")
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(rows: DataFrame) -> DataFrame:
    """rows as checkpointed in the shared folder."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def stored(rows: DataFrame) -> DataFrame:
    """rows as Parquet in the shared folder, for tables that grow with the input: they take
    less than a checkpoint's rows, columns that nobody reads stay unread, and the shuffle
    files they were made from go with the end of the write, not of the session."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    atexit.register(_remove, path)
    freed(rows.write, path)
    return spark.read.schema(rows.schema).parquet(path)


def freed(writer: DataFrameWriter, path: str) -> None:
    """Writes Parquet to path; the shuffle files that it took go with the end of the write."""
    conf = SparkSession.active().conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def forget(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        for name in table.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _remove(uri: str) -> None:
    from pyarrow import fs

    with contextlib.suppress(Exception):  # a store that only Spark reaches keeps it, as it does a checkpoint
        store, path = fs.FileSystem.from_uri(uri)
        store.delete_dir(path)
