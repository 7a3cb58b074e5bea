"""Line deduplication over levelled sorted runs of line hashes.

Documents come in BATCHES batches of ascending doc_id, of like numbers of rows. The
keys of a batch's lines are merge-joined with the runs so far, which lie sorted in
buckets of the hash: a key that is there has its smallest document already, any other is
added by a new run of level 0. FANOUT runs of one level are compacted into one of the
next. A hash has 128 bits; runs hold 24 bytes a key, never text. A store with a root
of its own outlives the call, and documents that come later are held against it.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import LOWER, UPPER, empty_text, forget, scratch_path, written

BATCHES = 4
FANOUT = 3
LEAST = 10
#: Keys of a bucket of a new store.
BUCKET_KEYS = 4_000_000
RUN = "h1 long, h2 long, first long"
_ENDS = " \t\n\x0b\x0c\r"


def line_key(line):
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_ENDS)), UPPER, LOWER)


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, body, place, h1, h2): the long lines of each row, hashed. body, the
    hash of the whole text, tells rows that repeat a doc_id apart."""
    keys = F.transform(F.split(empty_text(), "\n"), line_key)
    lines = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64(empty_text()).alias("body"), F.posexplode(keys).alias("place", "key"))
    return lines.filter(F.char_length("key") >= least).select("doc_id", "body", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


@contextlib.contextmanager
def _sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Scans of bucketed tables keep their buckets and, with a file a bucket, their order."""
    wanted = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _write_sorted(keys: DataFrame, path: str, buckets: int) -> None:
    """keys as a table sorted in buckets of (h1, h2). Its name is for this write only: the folder stays."""
    name = f"jobloom_{uuid.uuid4().hex}"
    keys.write.bucketBy(buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).format("parquet").saveAsTable(name)
    keys.sparkSession.sql(f"DROP TABLE {name}")


@contextlib.contextmanager
def _read_sorted(spark: SparkSession, paths: list[str], buckets: int, schema: str = RUN) -> Iterator[list[DataFrame]]:
    """The tables that _write_sorted wrote, bucketed, until the block ends."""
    names = [f"jobloom_{uuid.uuid4().hex}" for _ in paths]
    try:
        with _sorted_buckets(spark):
            for name, path in zip(names, paths, strict=True):
                spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {buckets} BUCKETS LOCATION '{path}'")
            yield [spark.table(name) for name in names]
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


class RunStore:
    """Runs of (h1, h2, first) by level, a folder each under root, sorted in buckets of
    the key; all runs of a store have the same buckets, so that a batch meets them as
    they lie, without a shuffle or a sort of what is stored. A run counts once it is
    written whole, so a store that was left in the middle of an addition is as it was
    before, and may be opened again: by its root, with what it holds. A new store has
    the session's shuffle partitions as buckets, doubled until one holds about
    BUCKET_KEYS keys of the first addition or fewer."""

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        self.root = root or scratch_path(spark, "runs")

    def _folder(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def levels(self) -> list[list[str]]:
        """The runs of each level: their folders."""
        store, root = self._folder(self.root)
        names = sorted(f.getPath().getName() for f in store.listStatus(root)) if store.exists(root) else []
        whole = [n for n in names if store.exists(self._folder(f"{self.root}/{n}/_SUCCESS")[1])]
        found = [[] for _ in range(1 + max((int(n.split("-")[1]) for n in whole), default=-1))]
        for name in whole:
            found[int(name.split("-")[1])].append(f"{self.root}/{name}")
        return found

    def paths(self) -> list[str]:
        """The folders of all runs; a key may be in two of them."""
        return [p for level in self.levels() for p in level]

    def buckets(self, keys: int = 0) -> int:
        """Buckets of the runs; of a store without any, those for so many keys."""
        for path in self.paths():
            return int(path.rsplit("/", 1)[1].split("-")[2])
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        while buckets * BUCKET_KEYS < keys:
            buckets *= 2
        return buckets

    def marked(self, keys: DataFrame, runs: list[DataFrame]) -> DataFrame:
        """keys with a boolean column older: whether one of the runs holds them."""
        for i, run in enumerate(runs):
            keys = keys.join(run.select("h1", "h2", F.lit(True).alias(f"_in{i}")).hint("merge"), ["h1", "h2"], "left")
        older = F.coalesce(*[F.col(f"_in{i}") for i in range(len(runs))], F.lit(False))
        return keys.withColumn("older", older).drop(*[f"_in{i}" for i in range(len(runs))])

    def union(self) -> DataFrame | None:
        """The keys of all runs; a key may be there twice."""
        paths = self.paths()
        return self.spark.read.schema(RUN).parquet(*paths) if paths else None

    def add(self, keys: DataFrame, buckets: int | None = None) -> None:
        """A new run of level 0; the runs of a level that is full become one of the next.
        Keys that don't come by bucket make several files a bucket, which are then sorted when read."""
        buckets = buckets or self.buckets()
        self._write(keys, 0, buckets)
        level = 0
        while level < len(levels := self.levels()):
            full = levels[level]
            if len(full) >= self.fanout:
                self._write(self.spark.read.schema(RUN).parquet(*full).repartition(buckets, "h1", "h2"), level + 1, buckets)
                self._delete(full)
            level += 1

    def _write(self, keys: DataFrame, level: int, buckets: int) -> None:
        _write_sorted(keys.select("h1", "h2", "first"), f"{self.root}/run-{level}-{buckets}-{uuid.uuid4().hex}", buckets)

    def _delete(self, paths: list[str]) -> None:
        for path in paths:
            store, folder = self._folder(path)
            store.delete(folder, True)

    def drop(self) -> None:
        self._delete([self.root])


def _joined(rows: DataFrame, hits: DataFrame, total: int) -> DataFrame:
    """rows with the first of their key. Keys of more than a thousandth of the rows,
    fewer than a thousand, are sent to the rows; the others meet by key."""
    hits = written(hits, "hits")
    hot = hits.filter(F.col("n") * 1000 > total).select("h1", "h2", F.col("first").alias("_first"))
    cold = hits.filter(F.col("n") * 1000 <= total).select("h1", "h2", "first")
    if hot.isEmpty():
        return rows.join(cold, ["h1", "h2"])
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), ["h1", "h2"], "left")
    met = marked.filter("_hot").select(*rows.columns, F.col("_first").alias("first"))
    return met.unionByName(marked.filter("_hot is null").select(rows.columns).join(cold, ["h1", "h2"]).select(*rows.columns, "first"))


def shared_lines(docs: DataFrame, least: int = LEAST, batches: int = BATCHES, store: RunStore | None = None) -> DataFrame:
    """(doc_id, body, place) of the lines that go: their key is in a smaller doc_id,
    or in the store, where there is one; it then holds the keys of docs as well."""
    shares = F.array(*[F.lit(k / batches) for k in range(1, batches)]) if batches > 1 else None
    edges = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, F.lit(1000)).alias("q")).first()["q"] if shares is not None else None
    batch = sum(((F.col("doc_id") > F.lit(q)).cast("int") for q in edges or ()), F.lit(0))
    lines = written(_lines(docs, least).withColumn("batch", batch), "lines", "batch")
    own_store, gone = store or RunStore(docs.sparkSession), []
    buckets = own_store.buckets(lines.count())
    for b in range(batches):
        rows = lines.filter(F.col("batch") == b).drop("batch")
        own = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
        path = scratch_path(docs.sparkSession, "batchkeys")
        with _read_sorted(docs.sparkSession, own_store.paths(), buckets) as runs:
            _write_sorted(own_store.marked(own, runs), path, buckets)
        with _read_sorted(docs.sparkSession, [path], buckets, RUN + ", last long, n long, older boolean") as (own,):
            # a document of the batch loses the line if an older batch or, in this one, a smaller document holds it
            hits = own.filter("older or last > first").select("h1", "h2", "n", F.when(~F.col("older"), F.col("first")).alias("first"))
            lost = _joined(rows, hits, own.agg(F.sum("n")).first()[0] or 0).filter("first is null or doc_id > first").select("doc_id", "body", "place")
            gone.append(written(lost, "lost"))
            own_store.add(own.filter("not older"), buckets)
        own_store._delete([path])
    forget(lines)
    if store is None:
        own_store.drop()
    return reduce(DataFrame.unionByName, gone)


def _strip(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        kept, before, dropped = [], [], []
        for text, gone in zip(part["text"], part["gone"], strict=True):
            lines = text.split("\n")
            gone = () if gone is None else set(gone)
            left = [x for i, x in enumerate(lines) if i not in gone] if gone else lines
            kept.append("\n".join(left))
            before.append(len(lines))
            dropped.append(len(lines) - len(left))
        yield pd.DataFrame({"doc_id": part["doc_id"], "text": kept, "n_lines": before, "n_dropped": dropped})


def dedup_lines(docs: DataFrame, least: int = LEAST, batches: int = BATCHES, store: RunStore | None = None) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) with the lines that stay, joined by \\n.

    Keys of at least `least` code points lose all their lines but those of the
    smallest doc_id that holds the key. A null or empty text is one empty line.
    Rows that repeat a doc_id count as one document. A null doc_id takes no part:
    its text stays whole. Tables without rows give none; other columns are ignored.
    With a store, lines that it holds go from all documents, and it is added to.
    """
    lost = shared_lines(docs, least, batches, store)
    dead = lost.distinct().groupBy(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).agg(F.collect_list("place").alias("gone"))
    rows = docs.select("doc_id", empty_text().alias("text"))
    rows = rows.join(dead, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_body")), "left").select(F.col("doc_id").cast("string"), "text", "gone")
    # as a string, for pandas would turn integers beside nulls into floats
    return rows.mapInPandas(_strip, "doc_id string, text string, n_lines long, n_dropped long").withColumn("doc_id", F.col("doc_id").cast("long"))
