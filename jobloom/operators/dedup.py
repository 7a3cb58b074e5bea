"""Duplicate postings, exact and fuzzy.

Exact stages rank copies without gathering a group's rows: the winner of each
group is a mergeable aggregate (a minimum of a rank), joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.let import let
from jobloom.functions.lineage import forget, stored
from jobloom.functions.outline import bucket_keys, compared, outlined

#: The source whose copy stays, where a month has it.
PRIORITY = "srm"
SIMILAR = 0.95
SHINGLE = 5
#: Texts that are counted again: so many are told by every task, more by a shuffle of all.
KNOWN = 200_000
#: Nothing reads it: texts meet by buckets of shingles, and need no list of frequent ones.
RARE = 50


def _keep_first(rows: DataFrame, group: list[str], rank: Column, eligible: Column) -> DataFrame:
    """rows without the eligible ones that are not the first of their group by rank."""
    marked = rows.withColumn("_eligible", F.coalesce(eligible, F.lit(False)) & F.col("pst_detail").isNotNull()).withColumn("_text", F.md5("pst_detail")).withColumn("_rank", rank)
    first = marked.filter("_eligible").groupBy(*group, "_text").agg(F.min("_rank").alias("_first"))
    joined = marked.join(first, [*group, "_text"], "left")
    return joined.filter(~F.col("_eligible") | (F.col("_rank") == F.col("_first"))).select(rows.columns)


def exact_dedup_month(rows: DataFrame) -> DataFrame:
    """Stage 1: in each month with more than one source, one posting of each text:
    of srm if the month has it, else of the smallest source; then by source and id."""
    months = rows.filter("month is not null").groupBy("month").agg(F.min("source").alias("lo"), F.max("source").alias("hi"), F.max(F.col("source") == PRIORITY).alias("has"))
    # one row a month
    facts = F.broadcast(months.filter("lo <> hi").select("month", F.when(F.col("has"), F.lit(PRIORITY)).otherwise(F.col("lo")).alias("_top")))
    wide = rows.join(facts, "month", "left")
    rank = F.struct((F.col("source") != F.col("_top")).cast("int"), F.col("source"), F.col("pst_id"))
    return _keep_first(wide, ["month"], rank, F.col("_top").isNotNull()).select(rows.columns)


def exact_dedup_source(rows: DataFrame) -> DataFrame:
    """Stage 2: in each source with more than one month, one posting of each text:
    the earliest month, null last, then by id."""
    sources = rows.groupBy("source").agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    facts = sources.filter("lo <> hi").select("source", F.lit(True).alias("_several"))
    # one row a source: joined by key, a source's texts would all be read by one task
    wide = rows.join(F.broadcast(facts), "source", "left")
    rank = F.struct(F.col("month").isNull().cast("int"), F.coalesce("month", F.lit(0)), F.col("pst_id"))
    return _keep_first(wide, ["source"], rank, F.col("_several")).select(rows.columns)


def exact_dedup(rows: DataFrame) -> DataFrame:
    return exact_dedup_source(exact_dedup_month(rows))


def stage_report(rows: DataFrame) -> DataFrame:
    """(stage, n_rows, removed, removed_pct) of both exact stages."""
    first = exact_dedup_month(rows)
    parts = [(0, "start", rows), (1, "month", first), (2, "source", exact_dedup_source(first))]
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("k"), F.lit(name).alias("stage"), "n_rows") for k, name, df in parts]
    every = counts[0].unionByName(counts[1]).unionByName(counts[2])
    before = every.select((F.col("k") + 1).alias("k"), F.col("n_rows").alias("was"))
    removed = F.coalesce(F.col("was") - F.col("n_rows"), F.lit(0))
    out = every.join(before, "k", "left").select("stage", "n_rows", removed.alias("removed"), F.coalesce("was", "n_rows").alias("was"))
    return out.select("stage", "n_rows", "removed", F.round(F.coalesce(100.0 * F.col("removed") / F.nullif("was", F.lit(0)), F.lit(0.0)), 6).alias("removed_pct"))


def source_distribution(rows: DataFrame) -> DataFrame:
    """(source, n_rows, share_pct)."""
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("source", "n_rows", F.round(100.0 * F.col("n_rows") / F.col("total"), 6).alias("share_pct"))  # one row


def text_preview(column: str, most: int = 2000) -> Column:
    return F.substring(F.coalesce(F.col(column), F.lit("")), 1, most)


def shingles(column: str, width: int = SHINGLE) -> Column:
    """Distinct word shingles; of texts with fewer words, character shingles, or the
    text itself. Hashed; those of words by the hashes of their words, so that no
    shingle is built as a string."""
    text = F.lower(F.trim(F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"\s+", " ")))
    at = lambda n: F.sequence(F.lit(1), n - (width - 1))

    def cut(x: Column) -> Column:
        word, text = x["word"], x["text"]
        run = lambda h, i: F.xxhash64(*[F.element_at(h, i + k) for k in range(width)])
        by_word = let(F.transform(word, lambda w: F.xxhash64(w)), lambda h: F.transform(at(F.size(h)), lambda i: run(h, i)))
        by_char = F.transform(at(F.length(text)), lambda i: F.substring(text, i, F.lit(width)))
        return F.when(F.size(word) >= width, by_word).when(F.length(text) >= width, F.transform(by_char, lambda c: F.xxhash64(c))).otherwise(F.array(F.xxhash64(text)))

    return F.array_distinct(let(F.struct(text.alias("text"), F.split(text, " ").alias("word")), cut))


def similar_texts(rows: DataFrame, scope: str, least: float = SIMILAR) -> DataFrame:
    """(scope, a, b, similarity): pairs a < b of different texts (by MD5) of one scope
    whose shingle sets have a Jaccard similarity of at least `least`, which is above 0.5.

    Sets are divided into buckets by their hashes' values, into more than two such sets
    differ by in shingles; so one bucket is alike in both, and texts meet by buckets. What
    moves is an outline of each set, from which the similarity follows where buckets differ
    in one shingle each; only the other pairs are counted from texts again. Copies of a
    text are one member of their scope, so no group of copies pairs up."""
    if not 0.5 < least <= 1:
        raise ValueError("least: above 0.5 and 1 at most")
    texts = rows.filter(F.col(scope).isNotNull() & F.col("pst_detail").isNotNull()).select(scope, F.md5("pst_detail").alias("id"), "pst_detail")
    kind = texts.schema[scope].dataType.simpleString()
    sets = texts.select(scope, "id", F.sort_array(shingles("pst_detail")).alias("s"))
    outlines = sets.mapInArrow(outlined(least), f"`{scope}` {kind}, id string, n int, level int, own binary, upper binary")
    one = outlines.groupBy(scope, "id").agg(*[F.any_value(c).alias(c) for c in ("n", "level", "own", "upper")])
    one = stored(one.withColumn("doc", F.monotonically_increasing_id()))
    posted = one.select(scope, "doc", "n", "level", "own", "upper").mapInArrow(bucket_keys, f"`{scope}` {kind}, doc long, n int, key long")
    posted = posted.select("doc", "n", F.xxhash64(scope, "key").alias("h"))
    other = posted.select(F.col("doc").alias("with"), F.col("n").alias("m"), F.col("h").alias("_h"))
    near = (F.col("h") == F.col("_h")) & (F.col("doc") < F.col("with")) & (F.least("n", "m") >= F.greatest("n", "m") * least - 1e-9)
    pairs = stored(posted.join(other.hint("merge"), near).select("doc", "with").distinct())
    side = lambda k: one.select(F.col("doc").alias(k), F.struct(scope, "id", "n", "level", "own", "upper").alias(f"{k}_")).hint("merge")
    both = pairs.join(side("doc"), "doc").join(side("with"), "with").select(F.col("doc_").alias("x"), F.col("with_").alias("y")).filter(F.col(f"x.{scope}") == F.col(f"y.{scope}"))
    at = lambda c, o: F.when(F.col(f"{c}.level") < F.col(f"{o}.level"), F.col(f"{c}.upper")).otherwise(F.col(f"{c}.own"))
    both = both.select(F.col(f"x.{scope}").alias(scope), F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("m"), at("x", "y").alias("x"), at("y", "x").alias("y"))
    found = stored(both.mapInArrow(compared(least), f"`{scope}` {kind}, a string, b string, similarity double"))
    forget(one, pairs)
    left = found.filter("similarity is null").drop("similarity")
    told = found.filter("similarity is not null")
    return told if left.isEmpty() else told.unionByName(_counted(texts, left, scope, least))


def _counted(texts: DataFrame, pairs: DataFrame, scope: str, least: float) -> DataFrame:
    """pairs (scope, a, b) with their similarity, from the shingles of their texts."""
    wanted = stored(reduce(DataFrame.unionByName, [pairs.select(scope, F.col(k).alias("id")) for k in "ab"]).distinct())
    few = wanted.count() <= KNOWN
    heads = texts.join(F.broadcast(wanted) if few else wanted.hint("merge"), [scope, "id"], "left_semi").groupBy(scope, "id").agg(F.min("pst_detail").alias("pst_detail"))
    sets = stored(heads.select(scope, "id", shingles("pst_detail").alias("s")))
    side = lambda k: sets.select(scope, F.col("id").alias(k), F.col("s").alias(f"s_{k}")).hint("merge")
    both = pairs.join(side("a"), [scope, "a"]).join(side("b"), [scope, "b"])
    common = F.size(F.array_intersect("s_a", "s_b"))
    similarity = common / (F.size("s_a") + F.size("s_b") - common)
    return both.select(scope, "a", "b", similarity.alias("similarity")).filter(F.col("similarity") >= least - 1e-12)


def _outranked(edges: DataFrame) -> DataFrame:
    """(node) that go, of edges (node, above): one goes if one that stays is above it.
    Round by round: what has nothing above it stays, and what it is above of goes."""
    left, gone = stored(edges.distinct()), []
    while not left.isEmpty():
        stay = left.select("above").distinct().join(left.select(F.col("node").alias("above")).distinct(), "above", "left_anti")
        now = stored(left.join(stay, "above", "left_semi").select("node").distinct())
        gone.append(now)
        rest = left.join(now, "node", "left_anti").join(now.withColumnRenamed("node", "above"), "above", "left_anti")
        left = stored(rest.select("node", "above"))
    return reduce(DataFrame.unionByName, gone, edges.select("node").limit(0))


def fuzzy_dedup_month(rows: DataFrame, least: float = SIMILAR) -> DataFrame:
    """Stage 3: in each month, a posting goes if one that stays is similar and ranks
    before it: of the priority source, then by source and id."""
    months = rows.filter("month is not null").groupBy("month").agg(F.min("source").alias("lo"), F.max(F.col("source") == PRIORITY).alias("has"))
    facts = months.select("month", F.when(F.col("has"), F.lit(PRIORITY)).otherwise(F.col("lo")).alias("_top"))  # one row a month
    wide = rows.join(F.broadcast(facts), "month", "left")
    rank = F.struct((F.col("source") != F.col("_top")).cast("int").alias("p"), F.col("source").alias("s"), F.col("pst_id").alias("i"))
    marked = wide.withColumn("_id", F.md5("pst_detail")).withColumn("_rank", F.when(F.col("month").isNotNull() & F.col("pst_detail").isNotNull(), rank))
    heads = marked.filter("_rank is not null").groupBy("month", "_id").agg(F.min("_rank").alias("_head"))
    pairs = similar_texts(rows, "month", least)
    side = lambda k: heads.select("month", F.col("_id").alias(k), F.col("_head").alias(f"r_{k}"))
    ranked = pairs.join(side("a"), ["month", "a"]).join(side("b"), ["month", "b"])
    node = lambda k: F.concat_ws("/", F.col("month").cast("string"), F.col(k))
    later = F.col("r_a") > F.col("r_b")
    edges = ranked.select(F.when(later, node("a")).otherwise(node("b")).alias("node"), F.when(later, node("b")).otherwise(node("a")).alias("above"))
    gone = _outranked(edges).select(F.col("node").alias("_gone")).distinct()
    kept = marked.join(heads, ["month", "_id"], "left").filter(F.col("_rank").isNull() | (F.col("_rank") == F.col("_head")))
    return kept.withColumn("_node", F.concat_ws("/", F.col("month").cast("string"), F.col("_id"))).join(gone, F.col("_node") == F.col("_gone"), "left_anti").select(rows.columns)


def fuzzy_dedup_source(rows: DataFrame, least: float = SIMILAR) -> DataFrame:
    """Stage 4: in each source, a posting goes if one of an earlier month is similar."""
    earliest = rows.filter("month is not null and pst_detail is not null").groupBy("source", F.md5("pst_detail").alias("_id")).agg(F.min("month").alias("_own"))
    pairs = similar_texts(rows.filter("month is not null"), "source", least)
    both = pairs.select("source", F.col("a").alias("_id"), F.col("b").alias("other")).unionByName(pairs.select("source", F.col("b").alias("_id"), F.col("a").alias("other")))
    near = both.join(earliest.withColumnRenamed("_id", "other"), ["source", "other"]).groupBy("source", "_id").agg(F.min("_own").alias("_near"))
    facts = earliest.join(near, ["source", "_id"], "left").select("source", "_id", F.least("_own", "_near").alias("_first"))
    marked = rows.withColumn("_id", F.md5("pst_detail")).join(facts, ["source", "_id"], "left")
    return marked.filter("month is null or _first is null or month <= _first").select(rows.columns)
