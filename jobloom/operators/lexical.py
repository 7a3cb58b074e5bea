"""Token index and lexical search: phrase, prefix, fuzzy and BM25 queries."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.functions.let import let
from jobloom.functions.lineage import cut_lineage, stored
from jobloom.functions.similarity import may_reach, name_outline

# English stop words of the standard analyser, and BM25's parameters.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with"
).split()
K1, B = 1.2, 0.75
#: Characters of a posting's text that are indexed.
INDEXED = 32_000
#: Longer tokens have no deletion neighbourhood, whose size grows with their length's square.
LONG_TOKEN = 24
#: Folders of a stored index, by hash of the token.
BUCKETS = 64


def prepared(rows: DataFrame) -> DataFrame:
    """For the index: nulls as '' or 0, the detail cut."""
    text = [n for n, t in rows.dtypes if t == "string" and n != "pst_detail"]
    number = [n for n in ("year", "month") if n in rows.columns]
    out = rows.na.fill("", text).na.fill(0, number)
    return out.withColumn("pst_detail", F.substring(F.coalesce("pst_detail", F.lit("")), 1, INDEXED)) if "pst_detail" in rows.columns else out


def tokens(column: Column | str, stop: bool = True) -> Column:
    """Lower-case words of letters, digits and _, without stop words."""
    text = F.lower(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")))
    found = F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    return F.filter(found, lambda t: ~t.isin(STOP_WORDS)) if stop else found


def token_line(column: Column | str) -> Column:
    """Tokens between single spaces, a space at both ends: phrases are substrings."""
    return F.concat(F.lit(" "), F.array_join(tokens(column, stop=False), " "), F.lit(" "))


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token, tf, dl) of every token of every document."""
    words = docs.select(key, tokens(text).alias("t")).select(key, F.explode("t").alias("token"), F.size("t").alias("dl"))
    return words.groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"), F.min("dl").alias("dl"))


class TokenIndex(NamedTuple):
    """postings: (key, token, tf, dl); sizes: one row (n, avg_dl)."""

    postings: DataFrame
    sizes: DataFrame


def token_index(docs: DataFrame, key: str, text: str) -> TokenIndex:
    sizes = docs.select(F.size(tokens(text)).alias("dl"))
    return TokenIndex(postings(docs, key, text), sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avg_dl")))


def write_index(docs: DataFrame, path: str, key: str, text: str, replace: bool = False) -> bool:
    """Stores the index of docs in folders by hash of the token, sorted by token. An
    index that is there stays as it is, unless it is to be replaced. Whether it was
    written. The sizes come last: without them there is no index."""
    spark = docs.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/sizes/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done) and not replace:
        return False
    index = token_index(docs, key, text)
    rows = index.postings.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int"))
    parts = F.pmod(F.xxhash64(key), F.lit(8))  # of a bucket, so that no task has one alone
    rows.repartition("bucket", parts).sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    like = F.lit(None).cast(docs.schema[key].dataType).alias(key)  # the key's name and type, for an index without tokens
    index.sizes.select("n", "avg_dl", like).write.mode("overwrite").parquet(f"{path}/sizes")
    return True


def read_index(spark: SparkSession, path: str) -> TokenIndex:
    sizes = spark.read.parquet(f"{path}/sizes")
    rows = T.StructType([sizes.schema.fields[-1], T.StructField("token", T.StringType()), T.StructField("tf", T.LongType()), T.StructField("dl", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
    return TokenIndex(spark.read.schema(rows).parquet(f"{path}/postings"), sizes.select("n", "avg_dl"))


def bm25_top(docs: DataFrame, queries: DataFrame, key: str, text: str, query_key: str, query_text: str, k: int = 10) -> DataFrame:
    """index_top without an index: each text is cut into tokens once, and has a row
    with the token '' beside those of the queries' tokens, from which the sizes come."""
    asked = queries.select(F.explode(F.array_append(tokens(query_text), F.lit(""))).alias("token")).distinct()
    own = docs.select(key, tokens(text).alias("t"))
    # explode_outer, for no filter on its array is then put before it, which would cut the text again
    words = own.select(key, F.explode_outer(F.array_append("t", F.lit(""))).alias("token"), F.size("t").alias("dl"))
    found = words.join(asked, "token", "left_semi").groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"), F.min("dl").alias("dl"), F.sum("dl").alias("all"))
    found = cut_lineage(found)
    sizes = found.filter("token = ''").agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("n"), (F.sum("all") / F.sum("tf")).alias("avg_dl"))
    return index_top(TokenIndex(found.filter("token <> ''").drop("all"), sizes), queries, key, query_key, query_text, k)


def index_top(index: TokenIndex, queries: DataFrame, key: str, query_key: str, query_text: str, k: int = 10) -> DataFrame:
    """(query_key, key, score, rank): the k best of each query, ties to the smaller
    key. Any common token is a match. Only the tokens of queries meet the index, and
    of a stored one only their folders are read."""
    asked = queries.select(query_key, F.explode(F.array_distinct(tokens(query_text))).alias("token"))
    known, rows = asked.select("token").distinct(), index.postings
    if "bucket" in rows.columns:
        wanted = known.select(F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int").alias("b")).distinct().collect()  # BUCKETS rows at most
        rows = rows.filter(F.col("bucket").isin([r.b for r in wanted])).drop("bucket")
    rows = rows.join(known, "token", "left_semi")
    df = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avg_dl")))
    weighed = rows.join(df, "token").crossJoin(F.broadcast(index.sizes)).select(key, "token", weight.alias("w"))  # one row
    scores = asked.join(weighed, "token").groupBy(query_key, key).agg(F.round(F.sum("w"), 6).alias("score"))
    order = Window.partitionBy(query_key).orderBy(F.col("score").desc(), key)
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def phrase_matches(names: DataFrame, titles: DataFrame, name: str, title: str) -> DataFrame:
    """names x titles whose tokens hold the name's tokens in a row. They meet by the
    name's token that the fewest titles have; a name with one that none has meets no title."""
    # explode_outer, for no filter on its array is then put before it, which would cut the title again
    right = titles.withColumn("_in", token_line(title)).withColumn("_word", F.explode_outer(F.array_distinct(tokens(title, False))))
    df = right.groupBy("_word").agg(F.count(F.lit(1)).alias("_df"))
    words = F.array_distinct(tokens(name, False))
    each = names.select(name).distinct().select(F.col(name).alias("_name"), F.size(words).alias("_size"), F.explode_outer(words).alias("_token"))
    known = each.join(df.hint("merge"), F.col("_token") == F.col("_word")).groupBy("_name", "_size").agg(F.min_by("_token", F.struct("_df", "_token")).alias("_token"), F.count(F.lit(1)).alias("_n"))
    left = names.join(known.filter("_n = _size").select("_name", "_token").hint("merge"), F.col(name) == F.col("_name")).withColumn("_line", token_line(name))
    return left.join(right.hint("merge"), (F.col("_token") == F.col("_word")) & F.contains("_in", "_line")).drop("_line", "_token", "_in", "_word", "_name")


def prefix_matches(names: DataFrame, titles: DataFrame, name: str, title: str) -> DataFrame:
    """names x titles with a token that begins with the whole name, as it is. Names
    meet the beginnings of the distinct tokens, then the titles by the token."""
    right = titles.withColumn("_word", F.explode_outer(F.array_distinct(tokens(title, False))))
    wanted = names.select(F.col(name).alias("_name")).filter(F.length(name) > 0).distinct()
    longest = F.broadcast(wanted.agg(F.coalesce(F.max(F.length("_name")), F.lit(1)).alias("_longest")))  # one row
    start = F.explode_outer(F.transform(F.sequence(F.lit(1), F.least(F.length("_word"), F.col("_longest"))), lambda n: F.substring(F.col("_word"), F.lit(1), n)))
    starts = right.select("_word").distinct().crossJoin(longest).select(F.col("_word").alias("_token"), start.alias("_start"))
    pairs = wanted.join(starts.hint("merge"), F.col("_name") == F.col("_start")).select("_name", "_token")
    found = names.join(pairs.hint("merge"), F.col(name) == F.col("_name")).join(right.hint("merge"), F.col("_token") == F.col("_word")).drop("_name", "_token", "_word")
    return found.distinct()


def allowed_edits(token: Column, fuzziness: int | str) -> Column:
    """A number, or AUTO by length: 0 up to 2 characters, 1 up to 5, then 2."""
    if not isinstance(fuzziness, str):
        return F.lit(int(fuzziness))
    low, high = (int(x) for x in fuzziness.partition(":")[2].split(",")) if ":" in fuzziness else (3, 6)
    return F.when(F.length(token) < low, 0).when(F.length(token) < high, 1).otherwise(2)


def _shorter(texts: Column, empty: Column) -> Column:
    """Every text with one character left out."""
    cut = lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))
    return F.flatten(F.transform(texts, lambda t: F.when(F.length(t) > 0, cut(t)).otherwise(empty)))


def deletions(token: Column, edits: Column, most: int) -> Column:
    """The token and what is left of it when up to `edits` characters, `most` at most, are left out."""
    empty = F.array().cast("array<string>")
    found, last = F.array(token), F.array(token)
    for k in range(1, most + 1):
        last = _shorter(last, empty)
        found = F.concat(found, F.when(edits >= k, last).otherwise(empty))
    return found


def _neighbours(token: Column, edits: Column, most: int, prefix: int) -> Column:
    """Keys by which tokens a few edits apart meet: their first characters with what
    is left when up to `edits` characters are left out. Very long tokens meet by
    their first characters alone."""
    empty = F.array().cast("array<string>")
    start = F.substring(token, 1, prefix)
    short = F.transform(F.array_distinct(deletions(token, edits, most)), lambda t: F.concat(start, F.lit("/"), t))
    size = F.length(token)
    return F.concat(F.when(size <= LONG_TOKEN, short).otherwise(empty), F.when(size > LONG_TOKEN - most, F.array(start)).otherwise(empty))


def _one_edit_keys(token: Column, prefix: int, known: bool) -> Column:
    """Keys by which each two tokens one edit apart or equal, with the same first characters,
    meet once: what is left without a character, of the longer one only; and of two of
    one length what is left with the place of the character."""
    start, size = F.substring(token, 1, prefix), F.length(token)
    kind = lambda k, texts: F.transform(texts, lambda t: F.concat(F.lit(k), start, F.lit("/"), t))
    own, less = F.array(token), F.array_distinct(_shorter(F.array(token), F.array().cast("array<string>")))
    longer = [kind("a", F.concat(own, less)), kind("b", own)] if known else [kind("a", own), kind("b", less)]
    places = F.when(size > prefix, F.sequence(F.lit(prefix + 1), size)).otherwise(F.array().cast("array<int>"))
    same = F.transform(places, lambda i: F.concat(F.lit("c"), i.cast("string"), F.lit("/"), F.substring(token, F.lit(1), i - 1), F.substring(token, i + 1, size)))
    short = F.when(size <= LONG_TOKEN, F.concat(*longer, same)).otherwise(F.array().cast("array<string>"))
    return F.concat(short, F.when(size >= LONG_TOKEN, F.array(F.concat(F.lit("d"), start))).otherwise(F.array().cast("array<string>")))


def spread(rows: DataFrame, by: str) -> DataFrame:
    """rows dealt by a column to tasks that are not made fewer for how small it is: each row
    of it costs more than its size tells."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, by)


def fuzzy_matches(names: DataFrame, titles: DataFrame, name: str, title: str, fuzziness: int | str, prefix: int, least: float = 0.0) -> DataFrame:
    """names x titles with tokens that are a few edits apart and agree in their first
    `prefix` characters. Any token of the name will do. Distinct tokens meet first, by
    deletion neighbourhoods, those one edit apart only once; no side is broadcast, for small
    files may hold many tokens.

    least: pairs whose name_similarity is below it may be left out. Tokens that are
    all of their names and titles are held against it where they meet, by a bound from
    bits first."""
    most = 2 if isinstance(fuzziness, str) else int(fuzziness)
    left = names.distinct().withColumn("_all", F.array_distinct(tokens(name))).select(*names.columns, F.explode_outer("_all").alias("_token"), (F.size("_all") > 1).alias("_several")).filter("_token is not null")
    right = titles.distinct().withColumn("_all", F.array_distinct(tokens(title))).select(*titles.columns, F.explode_outer("_all").alias("_word"), (F.size("_all") > 1).alias("_many")).filter("_word is not null")
    edits = allowed_edits(F.col("_token"), fuzziness)
    # with a bound few pairs are left to be told apart, and fewer keys cost less
    once = most == 1 and not isinstance(fuzziness, str) and least == 0
    asked = spread(left.select("_token", (F.lower(name) != F.col("_token")).alias("_more")), "_token").groupBy("_token").agg(F.max("_more").alias("_more"))
    known = spread(right.select("_word", (F.lower(title) != F.col("_word")).alias("_other")), "_word").groupBy("_word").agg(F.max("_other").alias("_other"))
    close = F.levenshtein("_token", "_word") <= edits
    if once:
        long = F.greatest(F.length("_token"), F.length("_word")) > LONG_TOKEN
        close = F.when(F.startswith("_key", F.lit("c")), F.col("_token") != F.col("_word")).otherwise(~F.startswith("_key", F.lit("d")) | (long & close))
    if least > 0:
        asked, known = asked.withColumn("_x", name_outline("_token")), known.withColumn("_y", name_outline("_word"))
        part = F.col("_more") | F.col("_other")
        close = F.when(part | may_reach(F.col("_x"), F.col("_y"), least), close).otherwise(False)
    # explode_outer, for no filter on its array is then put before it, which would make the keys again
    # keys that say nothing beyond being equal move as their hashes: tokens that meet are compared anyway
    hashed = lambda keys: F.transform(keys, lambda k: F.xxhash64(k))
    asked = asked.withColumn("_key", F.explode_outer(_one_edit_keys(F.col("_token"), prefix, False) if once else hashed(_neighbours(F.col("_token"), edits, most, prefix))))
    known = known.withColumn("_at", F.explode_outer(_one_edit_keys(F.col("_word"), prefix, True) if once else hashed(_neighbours(F.col("_word"), F.lit(most), most, prefix))))
    near = (F.col("_key") == F.col("_at")) & (F.substring("_token", 1, prefix) == F.substring("_word", 1, prefix))
    near &= F.when(F.abs(F.length("_token") - F.length("_word")) <= edits, close).otherwise(False)
    pairs = asked.join(known.hint("merge"), near).select(F.col("_token").alias("_t"), F.col("_word").alias("_w"))
    # with a bound names meet by many keys: those are gone before the pairs move on
    pairs = pairs if once else stored(pairs.distinct()) if least > 0 else pairs.distinct()
    found = left.join(pairs.hint("merge"), F.col("_token") == F.col("_t")).join(right.hint("merge"), F.col("_w") == F.col("_word"))
    # of the tokens by which a name and a title meet, the first counts; so no row has to be told from all others
    def first(x: Column) -> Column:
        t, w = x["t"], x["w"]
        close = lambda a, b: (F.levenshtein(a, b) <= allowed_edits(a, fuzziness)) & (F.substring(a, 1, prefix) == F.substring(b, 1, prefix))
        before = lambda texts, own: F.slice(texts, F.lit(1), F.array_position(texts, own).cast("int") - 1)
        other = F.exists(before(t, F.col("_token")), lambda a: F.exists(w, lambda b: close(a, b)))
        return ~(other | F.exists(before(w, F.col("_word")), lambda b: close(F.col("_token"), b)))

    both = F.struct(F.array_distinct(tokens(name)).alias("t"), F.array_distinct(tokens(title)).alias("w"))
    return found.filter(F.when(F.col("_several") | F.col("_many"), let(both, first)).otherwise(True)).select(*names.columns, *titles.columns)


def search(rows: DataFrame, must: list[Column] = (), must_not: list[Column] = (), should: list[Column] = (), least: int = 0) -> DataFrame:
    """Boolean query: all of must, none of must_not, at least `least` of should."""
    for c in must:
        rows = rows.filter(c)
    for c in must_not:
        rows = rows.filter(~F.coalesce(c, F.lit(False)))
    if should and least:
        rows = rows.filter(sum((F.coalesce(c, F.lit(False)).cast("int") for c in should), F.lit(0)) >= least)
    return rows
