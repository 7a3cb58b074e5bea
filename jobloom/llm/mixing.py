"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Only DataFrame functions. Every source is cut into permuted blocks of documents
(by a seeded hash). A source whose target is r times its size gives every
document floor(r) times and, of a further pass, a permuted prefix of blocks; the
block where that prefix ends is drawn by document, and what is still missing is
drawn in further rounds among documents that fit, until none does, so that a long
document can't keep a source from its target. If the smallest document that is left then
comes nearer to the target by crossing it, it is taken too.

The blocks of all passes are the balls of an urn whose colours are the sources.
The tree halves the output shards again and again; at each node the blocks that
go left are a draw without replacement, so their numbers by source are
multivariate hypergeometric, and the quotas of all shards add up to those of the
sources exactly. Shards then take disjoint ranges of each source's permuted
blocks and order their rows by a seeded hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import WORD, empty_text, forget, free_names, small, written

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20_240_607
#: Blocks a source is cut into: a document's block is its seeded hash modulo this.
BLOCKS = 1024
#: Output shards: SHARDS at least, and of a larger mix one for each SHARD_WORDS words.
SHARDS, SHARD_WORDS = 16, 1 << 26


def n_words(column: str = "text"):
    return F.regexp_count(empty_text(column), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) of (source, source_size).

    Targets are in proportion to weights, which repeat over the sources in order
    of code points, null last. Those above cap times their source stop there, and
    the rest is shared again: the water level under which the capped ones lie is
    found from the sums over the sources sorted by cap * size / weight.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.row_number().over(every) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (k % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", w).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    up = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("full"),
        F.sum("w").over(after).alias("open_w"),
        F.sum("source_size").over(Window.partitionBy()).cast("double").alias("total"),
    )
    level = (F.col("total") - F.col("full")) / F.col("open_w")
    # The first source that the level leaves below its cap sets the level of all.
    set_by = F.min(F.when(level * F.col("w") <= F.col("most"), F.struct(F.col("most") / F.col("w"), level.alias("level")))).over(Window.partitionBy())
    target = F.least(F.col("most"), F.coalesce(F.col("w") * F.col("_set.level"), F.col("most")))
    return rows.withColumn("_set", set_by).select("source", "source_size", target.alias("target"))


def _units(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, size, rows, mass, key, block): rows that agree in doc_id,
    source and size are one unit, drawn together."""
    rows = docs.select("doc_id", "source", n_words().alias("size"))
    units = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    key = F.xxhash64(F.lit(seed), "doc_id", "size")
    return units.select("*", (F.col("size") * F.col("rows")).alias("mass"), key.alias("key"), F.pmod(F.shiftright(key, 7), F.lit(BLOCKS)).cast("int").alias("block"))


def _prefix(units: DataFrame, gaps: DataFrame) -> DataFrame:
    """units with the boolean drawn: a permuted prefix of each source's units that
    fit into its gap. Sums by block decide on whole blocks; only in the block
    where the gap ends are the units themselves put in order."""
    gaps = written(gaps, "gaps")
    fits = units.join(small(gaps), units["source"].eqNullSafe(gaps["_source"]) & ~F.col("drawn") & (F.col("mass") <= F.col("gap")) & (F.col("mass") > 0), "left")
    fits = fits.withColumn("fit", F.col("gap").isNotNull())
    sums = fits.filter("fit").groupBy(F.col("source").alias("_s"), F.col("block").alias("_b")).agg(F.sum("mass").alias("in_block"), F.max("gap").alias("_gap"))
    line = Window.partitionBy("_s").orderBy("_b")
    sums = sums.withColumn("upto", F.sum("in_block").over(line)).withColumn("before", F.col("upto") - F.col("in_block"))
    sums = written(sums.filter("before <= _gap").select("_s", "_b", "before", (F.col("upto") <= F.col("_gap")).alias("whole")), "sums")
    told = fits.join(small(sums), F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")), "left")
    edge = F.col("fit") & F.col("before").isNotNull() & ~F.col("whole")
    inner = Window.partitionBy("source", "block").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    columns = units.columns
    at_edge = told.filter(edge).withColumn("drawn", F.col("before") + F.sum("mass").over(inner) <= F.col("gap")).select(columns)
    rest = told.filter(~edge | edge.isNull()).withColumn("drawn", F.col("drawn") | (F.col("fit") & F.coalesce("whole", F.lit(False)))).select(columns)
    return rest.unionByName(at_edge)


def _nearest(units: DataFrame, gaps: DataFrame) -> DataFrame:
    """units of which none fits any more, with one more drawn of each source that it
    brings nearer to its target: the smallest, by key among equals."""
    gaps = written(gaps, "gaps")
    left = units.filter(~F.col("drawn") & (F.col("mass") > 0)).join(small(gaps), F.col("source").eqNullSafe(F.col("_source")))
    first = left.filter(F.col("mass") < 2 * F.col("gap")).groupBy("source").agg(F.min(F.struct("mass", "key", "doc_id", "size")).alias("_first"))
    first = written(first.select(F.col("source").alias("_s"), "_first"), "nearest")
    told = units.join(small(first), F.col("source").eqNullSafe(F.col("_s")), "left")
    return told.withColumn("drawn", F.col("drawn") | F.coalesce(F.struct("mass", "key", "doc_id", "size").eqNullSafe(F.col("_first")), F.lit(False))).select(units.columns)


def shards_of(drawn: DataFrame) -> int:
    """Output shards for what is drawn: a power of two, for the tree halves."""
    words = drawn.agg(F.sum(F.col("size") * F.col("rows") * F.col("copies"))).first()[0] or 0
    return max(SHARDS, 1 << max(0, -(-int(words) // SHARD_WORDS) - 1).bit_length())


def draws(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, copies, block): how often
    the mix takes each unit. A written table."""
    units = written(_units(docs, seed), "units")
    sizes = units.groupBy("source").agg(F.sum("mass").alias("source_size"))
    goal = written(targets(sizes, weights, cap), "targets").select(F.col("source").alias("_source"), "source_size", "target")
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap)).cast("long")
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, whole).otherwise(F.lit(0)))
    goal = goal.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    now, before = units.withColumn("drawn", F.lit(False)), None

    def gaps() -> DataFrame:
        got = now.groupBy("source").agg(F.sum(F.when(F.col("drawn"), F.col("mass")).otherwise(0)).alias("got"))
        return goal.filter("whole < %d" % cap).join(got, F.col("_source").eqNullSafe(F.col("source"))).select("_source", (F.col("left") - F.col("got")).alias("gap"))

    while True:  # a round draws at least one unit wherever one fits
        done = now.agg(F.sum(F.when(F.col("drawn"), F.col("mass")))).first()[0] or 0
        if done == before:
            break
        before, older, now = done, now, written(_prefix(now, gaps()), "drawn")
        forget(older)
    now = _nearest(now, gaps())
    out = now.join(small(goal), F.col("source").eqNullSafe(F.col("_source")))
    copies = F.col("whole") + F.col("drawn").cast("long")
    out = out.select("doc_id", "source", "size", "rows", "source_size", "target", copies.alias("copies"), "block")
    return out


def shard_quotas(blocks: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(source, shard, quota, before) of blocks (source, n): the splitting tree.

    A level's nodes hold quotas by source. The balls of a node are put in a seeded
    order and the first half, to the ball, goes left: a draw without replacement.
    Balls are blocks, so their number doesn't grow with the documents.
    """
    level = blocks.select("source", F.lit(0).alias("shard"), F.col("n").alias("quota"))
    depth = max(0, (shards - 1).bit_length())
    for d in range(depth):
        balls = level.filter("quota > 0").select("source", "shard", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("ball"))
        order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + d), "shard", "source", "ball"), "source", "ball")
        size = F.count(F.lit(1)).over(Window.partitionBy("shard"))
        right = (F.row_number().over(order) > F.ceil(size / 2)).cast("int")
        level = balls.withColumn("shard", F.col("shard") * 2 + right).groupBy("source", "shard").agg(F.count(F.lit(1)).alias("quota"))
    before = F.coalesce(F.sum("quota").over(Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return level.withColumn("before", before)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, shards: int | None = None) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with two more columns at
    the end: _shard, and _place, by which the rows of a shard are in random order.
    Where docs has a column of such a name, the new one has another underscore.

    A null source is a source of its own, after the others. Texts without words
    (null or empty ones too) have no size, bring nothing to their source's target
    and are taken by a whole pass over their source only. A source without words
    has target 0 and gives nothing. Rows that agree in doc_id, source and size are
    taken together. The same rows and seed give the same mix, in any partitioning.
    A table without rows gives none.
    """
    drawn = written(draws(docs, weights, cap, seed).filter("copies > 0"), "draws")
    return _mix(docs, drawn, seed, shards or shards_of(drawn))


def _mix(docs: DataFrame, drawn: DataFrame, seed: int, shards: int) -> DataFrame:
    """mix() of units already drawn."""
    passes = drawn.select("source", "block", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    blocks = passes.distinct()
    ranked = blocks.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy("copy", F.xxhash64(F.lit(seed), "block", "copy"), "block")))
    ranked = written(ranked, "blocks")
    quotas = shard_quotas(ranked.groupBy("source").agg(F.count(F.lit(1)).alias("n")), shards, seed)
    quotas = written(quotas, "quotas").select(F.col("source").alias("_q"), "shard", "quota", "before")
    placed = ranked.join(small(quotas), F.col("source").eqNullSafe(F.col("_q")) & (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("quota")))
    placed = written(placed.select(F.col("source").alias("_src"), F.col("block").alias("_block"), F.col("copy").alias("_copy"), F.col("shard").alias("_shard")), "placed")
    units = drawn.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "block", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    where = units.join(small(placed), F.col("_source").eqNullSafe(F.col("_src")) & (F.col("block") == F.col("_block")) & (F.col("copy") == F.col("_copy")))
    shard, place, id_, source, size, copy = free_names(docs.columns, "_shard", "_place", "_id", "_source", "_size", "_copy")
    where = where.select(*[F.col(a).alias(b) for a, b in (("_id", id_), ("_source", source), ("_size", size), ("_shard", shard), ("_copy", copy))])
    on = F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").eqNullSafe(F.col(source)) & (n_words() == F.col(size))
    rows = docs.join(where, on)
    return rows.withColumn(place, F.xxhash64(F.lit(seed), shard, "doc_id", copy)).select(*docs.columns, shard, place)


def shuffled(mixed: DataFrame, shards: int | None = None) -> DataFrame:
    """The rows of mix(), each shard a partition of its own and in order of place.
    shards: their number, or more; by default the greatest that there is."""
    shard, place = mixed.columns[-2:]
    shards = shards or (mixed.agg(F.max(shard)).first()[0] or 0) + 1
    return mixed.repartitionById(shards, F.col(shard).cast("int")).sortWithinPartitions(place)


def mixed_shards(docs: DataFrame) -> DataFrame:
    """mix() shuffled: the columns of docs, a partition a shard."""
    drawn = written(draws(docs).filter("copies > 0"), "draws")
    shards = shards_of(drawn)
    return shuffled(_mix(docs, drawn, SEED, shards), shards).select(docs.columns)


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken.

    taken is counted in the rows of the mix, written shard by shard; documents
    that it doesn't hold are taken 0 times."""
    drawn = written(draws(docs), "draws")
    shards = shards_of(drawn)
    emitted = written(_mix(docs, drawn.filter("copies > 0"), SEED, shards), "emitted")  # frees the join's shuffle before the next
    mixed = written(shuffled(emitted, shards), "mixed")
    forget(emitted)
    out = mixed.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), n_words().alias("_size")).agg(F.count(F.lit(1)).alias("emitted"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    counted = drawn.join(out, on, "left")
    taken = F.col("size") * F.coalesce("emitted", F.lit(0)) / F.col("rows")
    each = counted.withColumn("taken", taken.cast("long")).withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select("doc_id", "size", "source_size", "target", "taken")
