"""A text index of several batches, kept as plain Parquet tables, and its searches.

In the index's folder, each table in folders by batch:

* `postings`: (token, keys, dls, positions), in folders by hash of the token: a row holds
  the texts with a token of those that a task took together, its lists in step. dl
  counts a text's words that aren't stop words. Every text is in one row of the token ''
* `terms`: (token) in folders by hash of its first character
* `shorter`: (short, token): what is left of a token when up to `edits` characters are
  left out, in folders by hash of it; none for an index without fuzzy search
* `replaced`: (key, old, dl): texts of earlier batches whose key came again or was deleted
* `batches`: what the batch holds. Written last: a batch without it is not there

A batch is written once and never changed; writing a batch again that failed half-way
replaces its own folders. Readers take the texts that no later batch replaced, so
searches answer as an index built anew would. Searches read the folders of the
tokens that they ask for and no others. Only texts whose key repeats cross the
network; postings do once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.functions.lineage import cut_lineage
from jobloom.operators.lexical import B, K1, LONG_TOKEN, STOP_WORDS, allowed_edits, deletions, tokens
from jobloom.sources.keyed import read_or_empty

#: Folders of a batch, the most edits that fuzzy searches allow, and text of a file of postings.
BUCKETS, EDITS, FILE_BYTES = 64, 2, 32 << 20
#: Words of the texts that a task takes together, unless one text has more.
WORDS = 1 << 18
#: Words of queries that are sent to every executor at most; more are joined by a shuffle.
SMALL = 100_000


class TextIndex(NamedTuple):
    """path: its folder; key: the texts' key and its type; buckets: folders of each
    table; edits: of fuzzy searches, for which a term of L characters is stored up to
    L * L / 2 times, so that large vocabularies may do without. The same for all batches."""

    path: str
    key: str
    kind: str = "string"
    buckets: int = BUCKETS
    edits: int = 0


def _bucket(index: TextIndex, value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(index.buckets)).cast("int")


_FIELDS = {
    "postings": "token string, keys array<{kind}>, dls array<int>, positions array<array<int>>, batch int, bucket int",
    "terms": "token string, batch int, bucket int",
    "shorter": "short string, token string, batch int, bucket int",
    "replaced": "{key} {kind}, old int, dl int, batch int",
    "batches": "n_docs long, n_words long, n_replaced long, n_words_replaced long, batch int",
}


def batches(spark: SparkSession, index: TextIndex) -> list[int]:
    """The numbers of the batches that are whole."""
    return sorted(r["batch"] for r in read_or_empty(spark, f"{index.path}/batches", _FIELDS["batches"]).collect())


def _table(spark: SparkSession, index: TextIndex, name: str, known: list[int], buckets: list[int] | None = None) -> DataFrame:
    rows = read_or_empty(spark, f"{index.path}/{name}", _FIELDS[name].format(key=index.key, kind=index.kind)).filter(F.col("batch").isin(known))
    return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))


def _folders(index: TextIndex, values: DataFrame) -> list[int]:
    """The folders of a column of values: `buckets` rows at most."""
    return [r[0] for r in values.select(_bucket(index, F.col(values.columns[0]))).distinct().collect()]


def _live(spark: SparkSession, index: TextIndex, rows: DataFrame, known: list[int]) -> DataFrame:
    """rows (key, batch, ...) of texts that no later batch replaced."""
    gone = _table(spark, index, "replaced", known).select(F.col(index.key).alias("_gone"), F.col("old").alias("_old"))
    return rows.join(gone, F.col(index.key).eqNullSafe(F.col("_gone")) & (F.col("batch") == F.col("_old")), "left_anti")


def _listed(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(offsets, len(values)), pa.int32()), values)


def _grouped(key: str):
    """Texts (key, words) as rows of postings: the words of some texts are sorted
    by their numbers in the texts' common dictionary, which keeps texts and places in order."""

    def group(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch["words"]
        encoded = words.flatten().dictionary_encode()
        codes, size = encoded.indices.to_numpy(), words.value_lengths().to_numpy()
        text = np.repeat(np.arange(len(batch), dtype=np.int32), size)
        place = np.arange(len(codes), dtype=np.int32) - np.repeat((np.cumsum(size) - size).astype(np.int32), size)
        worth = ~np.isin(encoded.dictionary.to_numpy(zero_copy_only=False), STOP_WORDS)
        counted = np.bincount(text[worth[codes]], minlength=len(batch))
        short = codes.astype(np.uint16) if len(encoded.dictionary) <= 1 << 16 else codes
        order = np.argsort(short, kind="stable")  # of two bytes, a radix sort
        codes, text, place = codes[order], text[order], place[order]
        first = np.ones(len(codes), bool)
        first[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(first)  # where a word of a text begins
        codes, text = codes[at], text[at]
        new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)])  # and where a word does
        # the row of the token '' comes last
        token = pa.concat_arrays([encoded.dictionary.take(pa.array(codes[new])).cast(pa.string()), pa.array([""], pa.string())])
        of = np.append(text, np.arange(len(batch)))
        keys, dls = batch[key].take(pa.array(of)), pa.array(counted[of], pa.int32())
        positions = _listed(np.append(at, np.full(len(batch), len(place))), pa.array(place, pa.int32()))
        lists = np.append(new, len(codes))
        return pa.RecordBatch.from_arrays([token, *[_listed(lists, c) for c in (keys, dls, positions)]], ["token", "keys", "dls", "positions"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, at = np.cumsum(batch["words"].value_lengths().to_numpy(), dtype=np.int64), 0
            while at < len(batch):
                before = ends[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(ends, before + WORDS, "right")))
                yield group(batch.slice(at, end - at))
                at = end

    return run


def _put(spark: SparkSession, index: TextIndex, rows: DataFrame, name: str, number: int, files: int = 0) -> DataFrame:
    """Writes a table of a batch; with files, in folders of that many files each."""
    path = f"{index.path}/{name}/batch={number}"
    if files:
        spread = F.pmod(F.xxhash64(*rows.columns[:2]), F.lit(files))
        rows.repartition("bucket", spread).sortWithinPartitions("bucket", rows.columns[0]).write.mode("overwrite").partitionBy("bucket").parquet(path)
    else:
        rows.write.mode("overwrite").parquet(path)
    return _table(spark, index, name, [number])


#: What single postings have beside their keys, and the lists that it comes from.
_LISTS = {"dl": "dls", "tf": "transform(positions, p -> size(p))", "positions": "positions"}


def _each(index: TextIndex, rows: DataFrame, names: tuple[str, ...], *by: str) -> DataFrame:
    """Rows of postings as rows (by..., key, names...) of single texts; lists that
    aren't needed aren't read."""
    lists = rows.select(*by, F.col("keys").alias(index.key), *[F.expr(_LISTS[n]).alias(f"_{n}") for n in names])
    each = lists.select(*by, F.inline(F.arrays_zip(index.key, *[f"_{n}" for n in names])))
    return each.withColumnsRenamed({f"_{n}": n for n in names})


def _texts(spark: SparkSession, index: TextIndex, known: list[int]) -> DataFrame:
    """(key, batch, dl) of all texts of some batches, replaced ones too."""
    bucket = _folders(index, spark.createDataFrame([("",)], "token string"))
    return _each(index, _table(spark, index, "postings", known, bucket).filter("token = ''"), ("dl",), "batch")


def _finish(spark: SparkSession, index: TextIndex, posted: DataFrame, number: int, files: int, again: DataFrame) -> int:
    """The tables of a batch whose postings are there; again: keys of earlier texts that go."""
    known = [n for n in batches(spark, index) if n != number]
    terms = _put(spark, index, posted.select("token").filter("token <> ''").distinct().withColumn("bucket", _bucket(index, F.substring("token", 1, 1))), "terms", number, 1)
    if index.edits:
        left = F.explode(F.array_distinct(deletions(F.col("token"), F.lit(index.edits), index.edits)))
        _put(spark, index, terms.filter(F.length("token") <= LONG_TOKEN).select(left.alias("short"), "token").withColumn("bucket", _bucket(index, F.col("short"))), "shorter", number, files)
    before = _live(spark, index, _texts(spark, index, known), known)
    gone = before.join(again.select(F.col(index.key).alias("_k")), F.col(index.key).eqNullSafe(F.col("_k")), "left_semi")
    gone = _put(spark, index, gone.select(index.key, F.col("batch").alias("old"), "dl"), "replaced", number)
    count = lambda rows: rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("w")).first()
    more, less = count(_texts(spark, index, [number])), count(gone)
    spark.createDataFrame([(more["n"], more["w"], less["n"], less["w"])], _FIELDS["batches"].rsplit(", ", 1)[0]).coalesce(1).write.mode("overwrite").parquet(f"{index.path}/batches/batch={number}")
    return number


def add_batch(docs: DataFrame, index: TextIndex, text: str, order: str | None = None, deleted: DataFrame | None = None) -> int:
    """Adds docs (key, text, ...) to the index; of rows that repeat a key the last by
    `order` counts, or the greatest text without it. deleted: (key, ...) that are to
    go; a key in both stays with its new text. The number of the batch."""
    spark, key = docs.sparkSession, index.key
    known = batches(spark, index)
    number = known[-1] + 1 if known else 0
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")).first()["b"]
    files = 1 + size // (FILE_BYTES * index.buckets)
    last = F.struct(F.col(order) if order else F.lit(0), F.col(text))
    repeated = docs.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_k")
    same = F.col(key).eqNullSafe(F.col("_k"))
    several = docs.join(repeated, same, "left_semi").groupBy(key).agg(F.max_by(text, last).alias("_text"))
    one = docs.join(repeated, same, "left_anti").select(key, F.col(text).alias("_text")).unionByName(several)
    own = one.select(F.col(key).cast(index.kind).alias(key), tokens("_text", stop=False).alias("words"))
    posted = own.mapInArrow(_grouped(key), _FIELDS["postings"].format(kind=index.kind).rsplit(", ", 2)[0]).withColumn("bucket", _bucket(index, F.col("token")))
    posted = _put(spark, index, posted, "postings", number, files)
    again = _texts(spark, index, [number]).select(key)
    if deleted is not None:
        again = again.unionByName(deleted.select(F.col(key).cast(index.kind).alias(key))).distinct()
    return _finish(spark, index, posted, number, files, again)


def rewrite(spark: SparkSession, index: TextIndex, path: str) -> TextIndex:
    """The live texts of all batches as the first batch of a new index at path."""
    known, new = batches(spark, index), index._replace(path=path)
    rows = _table(spark, index, "postings", known).withColumn("_row", F.monotonically_increasing_id())
    live = _live(spark, index, _each(index, rows, ("dl", "positions"), "token", "batch", "bucket", "_row"), known)
    row = live.groupBy("_row", "token", "bucket").agg(F.collect_list(F.struct(index.key, "dl", "positions")).alias("_l"))
    posted = _put(spark, new, row.select("token", F.col(f"_l.{index.key}").alias("keys"), F.col("_l.dl").alias("dls"), "_l.positions", "bucket"), "postings", 0, len(known))
    _finish(spark, new, posted, 0, 1, _texts(spark, new, [0]).select(index.key).limit(0))
    return new


def _found(spark: SparkSession, index: TextIndex, asked: DataFrame, *names: str, small: bool = False) -> DataFrame:
    """(token, key, names..., batch) of the live texts that hold a token of asked
    (token), of which there may be several rows. names: of dl, tf (how many
    positions) and positions. small: asked goes to every executor."""
    known, once = batches(spark, index), asked.select("token").distinct()
    rows = _table(spark, index, "postings", known, _folders(index, once)).join(F.broadcast(once) if small else once, "token", "left_semi")
    return _live(spark, index, _each(index, rows, names, "token", "batch"), known)


def postings_of(spark: SparkSession, index: TextIndex, asked: DataFrame) -> DataFrame:
    """(token, key, dl, positions) of the live texts that hold a token of asked
    (token), of which there may be several rows."""
    return _found(spark, index, asked, "dl", "positions").drop("batch")


def bm25(spark: SparkSession, index: TextIndex, queries: DataFrame, query_key: str, text: str, k: int = 10) -> DataFrame:
    """(query_key, key, score, rank): the k best of each query, ties to the smaller
    key. Any common word that is no stop word is a match."""
    asked = queries.select(query_key, F.explode(F.array_distinct(tokens(text))).alias("token"))
    rows = _found(spark, index, asked, "dl", "tf")
    of = read_or_empty(spark, f"{index.path}/batches", _FIELDS["batches"])
    size = of.agg(F.sum(F.col("n_docs") - F.col("n_replaced")).alias("n"), F.sum(F.col("n_words") - F.col("n_words_replaced")).alias("w")).first()
    n, average = float(size["n"] or 0), (size["w"] or 0) / max(1, size["n"] or 0)
    df = _found(spark, index, asked).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(average)))
    weighed = rows.join(df, "token").select("token", index.key, weight.alias("w"))
    scores = asked.join(weighed, "token").groupBy(query_key, index.key).agg(F.round(F.sum("w"), 6).alias("score"))
    order = Window.partitionBy(query_key).orderBy(F.col("score").desc(), index.key)
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def phrases(spark: SparkSession, index: TextIndex, queries: DataFrame, query_key: str, text: str) -> DataFrame:
    """(query_key, key, n): texts that hold all words of a query in a row, and how often. A query
    starts from its rarest word: the places of that word, less its place in the
    query, are where the phrase may begin. There its next rarest word is looked for,
    and the others where that one is, too. Queries without words, and with words
    that no text holds, find nothing."""
    words = tokens(text, stop=False)
    asked = queries.select(F.col(query_key).alias("_q"), F.size(words).alias("_size"), F.posexplode(words).alias("_at", "token")).distinct()
    df = _found(spark, index, asked).groupBy("token").agg(F.count(F.lit(1)).alias("_df"))
    # the words of a query by how rare they are
    ranked = asked.join(df, "token").groupBy("_q", "_size").agg(F.sort_array(F.collect_list(F.struct("_df", "_at", "token"))).alias("_w"))
    ranked = cut_lineage(ranked.filter(F.size("_w") == F.col("_size")))
    # few queries go to every executor; the size of rows that were cut off isn't known to the planner
    small = (ranked.agg(F.sum("_size")).first()[0] or 0) <= SMALL
    sent = F.broadcast if small else (lambda rows: rows)

    def held(rows: DataFrame) -> DataFrame:
        """(_word, ...) of rows with the texts that hold the word, _doc, and where the query
        would begin in them, _here."""
        found = _found(spark, index, rows.select(F.col("_word.token").alias("token")), "positions", small=small)
        met = found.join(sent(rows), F.col("_word.token") == F.col("token")).withColumnRenamed(index.key, "_doc")
        begin = F.filter(F.transform("positions", lambda p: p - F.col("_word._at")), lambda p: p >= 0)
        return met.select("_q", "_size", "_doc", begin.alias("_here")).filter(F.size("_here") > 0)

    def also(starts: DataFrame, rows: DataFrame) -> DataFrame:
        """starts (_q, _size, _doc, _here) at which a further word of the query, of rows, is, too."""
        further = sent(rows.select(F.col("_q").alias("_o"), F.col("_word.token").alias("_t"), F.col("_word._at").alias("_at")))
        each = starts.join(further, F.col("_q") == F.col("_o"))
        found = _found(spark, index, rows.select(F.col("_word.token").alias("token")), "positions", small=small).select("token", F.col(index.key).alias("_d"), "positions")
        met = each.join(found, (F.col("_t") == F.col("token")) & F.col("_doc").eqNullSafe(F.col("_d")))
        there = F.transform("positions", lambda p: p - F.col("_at"))
        return met.select("_q", "_size", "_doc", F.array_intersect("_here", there).alias("_here")).filter(F.size("_here") > 0)

    nth = lambda rows, n: rows.select("_q", "_size", F.col("_w")[n].alias("_word"))
    single, several = ranked.filter("_size = 1"), ranked.filter("_size > 1")
    pairs = cut_lineage(also(held(nth(several, 0)), nth(several, 1)))
    rest = several.filter("_size > 2").select("_q", "_size", F.explode(F.slice("_w", F.lit(3), F.col("_size"))).alias("_word"))
    more = also(pairs.filter("_size > 2"), rest).select("_q", "_size", "_doc", F.explode("_here").alias("_start"))
    whole = more.groupBy("_q", "_doc", "_size", "_start").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == F.col("_size") - 2)
    whole = whole.groupBy("_q", "_doc").agg(F.count(F.lit(1)).alias("n"))
    two = pairs.filter("_size = 2").select("_q", "_doc", F.size("_here").cast("long").alias("n"))
    word = nth(single, 0).select("_q", F.col("_word.token").alias("token"))
    one = _found(spark, index, word, "tf", small=small).join(sent(word), "token").select("_q", F.col(index.key).alias("_doc"), F.col("tf").cast("long").alias("n"))
    return one.unionByName(two).unionByName(whole).select(F.col("_q").alias(query_key), F.col("_doc").alias(index.key), "n")


def _keys_of(spark: SparkSession, index: TextIndex, found: DataFrame) -> DataFrame:
    """(name, key) of found (name, token)."""
    return found.join(_found(spark, index, found), "token").select(found.columns[0], index.key).distinct()


def prefixes(spark: SparkSession, index: TextIndex, names: DataFrame, name: str) -> DataFrame:
    """(name, key): texts with a word that begins with the whole name. Names meet the
    beginnings of the terms in the folders of their first characters."""
    asked = names.select(name).filter(F.length(name) > 0).distinct()
    longest = asked.agg(F.max(F.length(name))).first()[0] or 0
    terms = _table(spark, index, "terms", batches(spark, index), _folders(index, asked.select(F.substring(name, 1, 1)))).select("token").distinct()
    starts = terms.select("token", F.explode(F.sequence(F.lit(1), F.least(F.length("token"), F.lit(longest)))).alias("_n")) if longest else terms.withColumn("_n", F.lit(0)).limit(0)
    starts = starts.select("token", F.substring("token", F.lit(1), F.col("_n")).alias("_start"))
    return _keys_of(spark, index, asked.join(starts, F.col(name) == F.col("_start")).select(name, "token"))


def fuzzy(spark: SparkSession, index: TextIndex, names: DataFrame, name: str, fuzziness: int | str, prefix: int) -> DataFrame:
    """(name, key): texts with a word a few edits (those of the index at most) from a word of the
    name that is no stop word, with the same first `prefix` characters. Words meet
    the terms by what is left when characters are left out; very long ones, whose
    terms are not stored so, by the terms of their first character."""
    if index.edits < (EDITS if isinstance(fuzziness, str) else fuzziness):
        raise ValueError(f"an index for {index.edits} edits")
    known = batches(spark, index)
    asked = cut_lineage(names.select(name, F.explode(F.array_distinct(tokens(name))).alias("_word")).distinct())  # read several times
    edits = allowed_edits(F.col("_word"), fuzziness)
    words = asked.select("_word").distinct()
    keys = words.filter(F.length("_word") <= LONG_TOKEN + EDITS).select("_word", F.explode(F.array_distinct(deletions(F.col("_word"), edits, index.edits))).alias("short"))
    stored = _table(spark, index, "shorter", known, _folders(index, keys.select("short"))).select("short", "token")
    pairs = keys.join(stored, "short").select("_word", "token")
    far = words.filter(F.length("_word") > LONG_TOKEN - EDITS)
    terms = _table(spark, index, "terms", known, _folders(index, far.select(F.substring("_word", 1, 1)))).filter(F.length("token") > LONG_TOKEN).select("token")
    beside = F.abs(F.length("_word") - F.length("token")) <= EDITS
    if prefix > 0:
        beside &= F.substring("_word", 1, prefix) == F.substring("token", 1, prefix)
        long = far.join(terms, (F.substring("_word", 1, 1) == F.substring("token", 1, 1)) & beside)
    else:  # any first character: all folders
        long = far.join(_table(spark, index, "terms", known).filter(F.length("token") > LONG_TOKEN).select("token"), (F.length("_word") - F.length("token")).between(-EDITS, EDITS))
    near = (F.levenshtein("_word", "token") <= edits) & (F.substring("_word", 1, prefix) == F.substring("token", 1, prefix))
    found = pairs.unionByName(long.select("_word", "token")).filter(near).distinct()
    return _keys_of(spark, index, cut_lineage(asked.join(found, "_word").select(name, "token")))


__all__ = ["TextIndex", "add_batch", "batches", "bm25", "fuzzy", "phrases", "postings_of", "prefixes", "rewrite"]
