"""Exact deduplication by a log-structured merge index of text digests.

Only DataFrame functions. The documents' digests fill MEMTABLES memtables (dealt
by a hash of doc_id); each is flushed as a run sorted by digest that holds, per
digest, the smallest doc_id and the number of rows. Compaction merges FANOUT
runs into one of the next level and keeps the smallest identifier, until one
run is left. The last run carries a filter, a bitmap of the digests that more
than one row holds. Rows that the filter rejects stay unseen by any lookup; the
texts of the others, and only they, are compared byte by byte.

A group of copies of any size is one row per task wherever rows are grouped,
and the lookup is a join with salted keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import BLANK, empty_text, forget, free_names, scratch_dir, written

MEMTABLES = 16
FANOUT = 4
#: Bits of the filter: 8 MB, whatever the input. Once it is crowded, more rows
#: are verified than need be, and the result is the same.
FILTER_BITS = 1 << 26
#: Parts of a digest's rows at the look-up.
SALTS = 16


def normalised(column: str = "text"):
    return F.regexp_replace(empty_text(column), BLANK, " ")


def _place(digest):
    return F.pmod(F.xxhash64(digest), F.lit(FILTER_BITS))


def _merged(runs: DataFrame, *by: str) -> DataFrame:
    """One entry per digest: the smallest doc_id, a row that has it, the rows."""
    first = F.coalesce(F.min_by("tag", "keep_id"), F.min("tag"))
    return runs.groupBy(*by, "digest").agg(F.min("keep_id").alias("keep_id"), first.alias("tag"), F.sum("n").alias("n"))


def build_index(digests: DataFrame) -> DataFrame:
    """(digest, keep_id, tag, n) of digests (doc_id, digest, tag): flush, then
    compact level by level. All runs of a level are merged in one job."""
    rows = digests.select(
        F.pmod(F.xxhash64("doc_id", "tag"), F.lit(MEMTABLES)).cast("int").alias("run"), "digest", F.col("doc_id").alias("keep_id"), "tag", F.lit(1).cast("long").alias("n")
    )
    left = MEMTABLES
    level = written(_merged(rows, "run").sortWithinPartitions("run", "digest"), "runs")
    while left > 1:
        older, left = level, -(-left // FANOUT)
        merged = _merged(older.withColumn("run", F.floor(F.col("run") / FANOUT).cast("int")), "run")
        level = written(merged.sortWithinPartitions("run", "digest"), "runs")
        forget(older)
    return level.drop("run")


def hit_filter(index: DataFrame) -> DataFrame:
    """(bucket, bits): a bitmap of the digests that several rows hold. At most
    FILTER_BITS / 32768 rows of 4 KB, so it may be broadcast."""
    place = index.filter("n > 1").select(_place(F.col("digest")).alias("p"))
    return place.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))


def probed(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """rows with a boolean column hit: whether the filter may hold their digest."""
    p = _place(F.col("digest"))
    bit = F.bitmap_bit_position(p)
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = rows.withColumn("bucket", F.bitmap_bucket_number(p)).join(F.broadcast(bitmap), "bucket", "left")
    hit = F.coalesce(F.expr("getbit(_byte, _at)") == 1, F.lit(False))
    return joined.withColumns({"_byte": byte, "_at": (bit % 8).cast("int")}).withColumn("hit", hit).drop("bucket", "bits", "_byte", "_at")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, digest (the
    SHA-256 of the normalised text, hex).

    Texts are equal if they are the same bytes once each run of white space is
    one space; a null text is empty. Of equal texts the smallest doc_id stays; of
    repeated rows with that doc_id, one. Null doc_ids come last: a group of them
    alone keeps one row, with keep_id null. No rows give no rows. Only doc_id and
    text are read; other columns, whatever their names, are left alone.
    """
    digest = F.sha2(normalised(), 256)
    digests = written(docs.select("doc_id", digest.alias("digest"), F.monotonically_increasing_id().alias("tag")), "digests")
    index = build_index(digests)
    bitmap = written(hit_filter(index), "filter")
    texts = docs.select(normalised().alias("text")).select("text", F.sha2("text", 256).alias("digest"))
    hits = probed(texts, bitmap).filter("hit")
    checked = hits.groupBy("digest").agg((F.min("text") == F.max("text")).alias("same"))
    clash = written(checked.filter("not same").select("digest"), "clash")
    looked = probed(digests, bitmap)
    single = looked.filter("not hit").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    # salted by row, so that a group of copies of any size looks up in SALTS tasks
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    entry = index.filter("n > 1").select("digest", "keep_id", F.col("tag").alias("first"), "n", salts.alias("salt"))
    found = looked.filter("hit").withColumn("salt", F.pmod("tag", F.lit(SALTS)).cast("int")).join(entry, ["digest", "salt"], "left")
    several = found.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("tag") == F.col("first"), F.lit(True)).alias("kept"),
        "digest",
    )
    result = single.unionByName(several)
    if clash.isEmpty():  # always so, but for a collision of SHA-256
        return result
    return result.join(clash, "digest", "left_anti").unionByName(_by_text(docs, clash))


def _by_text(docs: DataFrame, clash: DataFrame) -> DataFrame:
    """The groups of clashing digests, by the texts themselves."""
    rows = docs.select("doc_id", normalised().alias("body")).withColumn("digest", F.sha2("body", 256)).join(clash, "digest", "left_semi")
    rows = written(rows.withColumn("tag", F.monotonically_increasing_id()), "clashing")
    group = rows.groupBy("body").agg(F.min("doc_id").alias("keep_id"), F.coalesce(F.min_by("tag", "doc_id"), F.min("tag")).alias("first"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(group, "body").select("doc_id", "keep_id", "group_size", (F.col("tag") == F.col("first")).alias("kept"), "digest")


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_groups keeps, all their columns unchanged,
    whatever their names.

    The rows that are dropped, and they alone, leave by an anti-join on doc_id
    and digest. Of rows that repeat a doc_id and its text, one stays: the first
    by its columns written as JSON, in the order of the columns."""
    digest, gone_id, gone_digest, first = free_names(docs.columns, "_digest", "_gone_id", "_gone", "_first")
    groups = exact_groups(docs).filter(~F.col("kept"))
    named = groups.select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("_same"))
    gone, twice = named.filter("not _same").drop("_same"), named.filter("_same").drop("_same").distinct()
    marked = docs.withColumn(digest, F.sha2(normalised(), 256))
    on = (F.col(digest) == F.col(gone_digest)) & F.col("doc_id").eqNullSafe(F.col(gone_id))
    left = marked.join(gone, on, "left_anti")
    if (twice := written(twice, "twice")).isEmpty():
        return left.drop(digest)
    row = F.struct(*["`" + c.replace("`", "``") + "`" for c in docs.columns])
    again = left.join(twice, on, "left_semi").groupBy(digest, "doc_id").agg(F.min_by(row, F.to_json(row)).alias(first)).select(f"{first}.*")
    return left.join(twice, on, "left_anti").drop(digest).unionByName(again)


__all__ = ["build_index", "drop_exact", "exact_groups", "hit_filter", "normalised", "probed", "scratch_dir"]
