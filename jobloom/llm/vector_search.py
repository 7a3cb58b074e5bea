"""Exact top-k by inner product over a pivot-distance index.

Vectors are integers. With a further component sqrt(M - |v|^2), M the largest
squared norm, and 0 for the query, |q - v|^2 = |q|^2 + M - 2 q.v: the nearest by
distance are those of the largest inner product. Every vector is keyed by its nearest pivot and its
distance to it; sorted by that key and cut into blocks, each block is an annulus
around its pivots. A query first reads the block where its own key lies and the
blocks beside it; the k-th best score there gives a radius r. Then the annuli
expand: by the triangle inequality only blocks with d(q, p) - r <= d(v, p)
<= d(q, p) + r can hold anything better, and the search stops with them.

Pivots are PIVOTS vectors of smallest hash. All scores are integers and exact;
bounds are widened by a rounding slack, so they exclude nothing by error. Queries
that ask for one block are answered QUERIES at a time, in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import frugal, small, written

PIVOTS = 32
#: Vectors in a block.
BLOCK = 1024
#: Bounds of the rounding error of distances: absolute, in units of the integer
#: vectors, and in proportion to the greatest of them (more than the root of 2^-53,
#: for distances are roots of differences).
SLACK, SLACK_SHARE = 1e-3, 1e-7
#: Queries that one task holds against a block.
QUERIES = 4096


def quantised(column: str = "embedding", scale: int = 256):
    """Each component x as floor(scale * x)."""
    return F.transform(F.col(column), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(column: str = "embedding"):
    """Vectors that take part: not null, without null or non-finite components."""
    bad = F.exists(F.col(column), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~bad


def _squares(column):
    return F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x * x)


def build_index(vectors: DataFrame, pivots: int = PIVOTS, block: int = BLOCK) -> tuple[DataFrame, np.ndarray, int]:
    """(blocks, pivots, M) of vectors (vec_id, v): blocks is a written table
    (block, vec_id, v, pivot, d) sorted by pivot and distance."""
    head = vectors.agg(F.max(_squares("v")).alias("m"), F.count(F.lit(1)).alias("n")).first()
    most, n = head["m"] or 0, head["n"]
    chosen = vectors.select("v").distinct().orderBy(F.xxhash64("v")).limit(pivots).collect()  # pivots rows
    centres = np.array([_lifted(np.array(r["v"], np.float64)[None], most)[0] for r in chosen])

    def keyed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                d = _distances(_lifted(np.stack(part["v"].to_numpy()).astype(np.float64), most), centres)
                near = d.argmin(axis=1)
                yield part.assign(pivot=near.astype(np.int32), d=d[np.arange(len(d)), near])

    rows = vectors.mapInPandas(keyed, "vec_id string, v array<long>, pivot int, d double") if n else vectors.select("vec_id", "v", F.lit(0).alias("pivot"), F.lit(0.0).alias("d"))
    # the hash parts vectors that repeat, however many
    rows = rows.repartitionByRange(max(1, -(-n // block)), "pivot", "d", F.xxhash64("vec_id")).sortWithinPartitions("pivot", "d")
    return written(rows.withColumn("block", F.spark_partition_id()), "index"), centres, most


def _lifted(v: np.ndarray, most: int) -> np.ndarray:
    return np.concatenate((v, np.sqrt(np.maximum(0.0, most - (v * v).sum(axis=1)))[:, None]), axis=1)


def _distances(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, ((v[:, None, :] - centres[None]) ** 2).sum(axis=2)))


def _best(part: pd.DataFrame, asked: pd.DataFrame, k: int) -> list[tuple]:
    """The k best of part's vectors for each query."""
    v, ids = np.stack(part["v"].to_numpy()), np.array([int(x) for x in part["vec_id"]], np.int64)
    found = []
    for at in range(0, len(asked), 128):
        some = asked.iloc[at : at + 128]
        q = np.stack(some["q"].to_numpy())
        scores = q @ v.T
        for row, (query, score) in enumerate(zip(some["query_id"], scores, strict=True)):
            ok = ids != int(query)
            order = np.lexsort((ids, -score))
            order = order[ok[order]][:k]
            found += [(query, str(ids[i]), int(score[i])) for i in order]
    return found


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (query_id, q) the k vectors
    (vec_id, v) of the largest inner product but the one with its own id, ties to
    the smaller vec_id; all of them, if there are fewer.

    v and q are arrays of long whose squares sum to less than 2^62; use quantised()
    and usable(). Where lengths differ, the shorter ones go on with zeros.
    Rows that repeat a vec_id are vectors of their own, equal in all; of queries
    that repeat one is answered. Null ids take no part. No vectors: no rows."""
    frugal(vectors.sparkSession)
    vectors = vectors.filter("vec_id is not null").select(F.col("vec_id").cast("string"), "v")
    queries = queries.filter("query_id is not null").select(F.col("query_id").cast("string"), "q").dropDuplicates(["query_id"])
    sizes = vectors.agg(F.min(F.size("v")), F.max(F.size("v"))).first(), queries.agg(F.min(F.size("q")), F.max(F.size("q"))).first()
    width = max((s[1] or 0 for s in sizes), default=0)
    if any(s[0] is not None and s[0] < width for s in sizes):
        longer = lambda c: F.concat(c, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(c)))
        vectors, queries = vectors.withColumn("v", longer("v")), queries.withColumn("q", longer("q"))
    index, centres, most = build_index(vectors, pivots, block)
    if not len(centres):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rings = written(index.groupBy("block", "pivot").agg(F.min("d").alias("low"), F.max("d").alias("high")), "rings")

    def measured(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                q = np.stack(part["q"].to_numpy())
                d = _distances(np.concatenate((q.astype(np.float64), np.zeros((len(q), 1))), axis=1), centres)
                yield part.assign(d=list(d), norm=(q * q).sum(axis=1))

    asked = written(queries.mapInPandas(measured, "query_id string, q array<long>, d array<double>, norm long"), "queries")
    each = asked.select("query_id", F.posexplode("d").alias("pivot", "dq"))
    reach = each.join(small(rings), "pivot").select("query_id", "block", "pivot", "dq", "low", "high")
    gap = F.greatest(F.col("low") - F.col("dq"), F.col("dq") - F.col("high"), F.lit(0.0)).alias("gap")
    # a lower bound of the distance to anything in the block
    bound = written(reach.select("query_id", "block", gap, "dq").groupBy("query_id", "block").agg(F.min("gap").alias("gap"), F.min("dq").alias("dq")), "bounds")
    first = Window.partitionBy("query_id").orderBy("gap", "dq", "block")
    near = bound.withColumn("turn", F.row_number().over(first)).filter("turn <= 2")
    begun = written(_scored(index, asked, near, k), "begun")
    kth = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").cast("long"))
    worst = begun.withColumn("r", F.row_number().over(kth)).filter(F.col("r") == k).select("query_id", "score")
    radius = F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + F.lit(float(most)) - 2.0 * F.col("score")))
    radius = asked.select("query_id", "norm").join(worst, "query_id", "left").select("query_id", "norm", F.coalesce(radius, F.lit(float("inf"))).alias("radius"))
    done = near.select("query_id", "block")
    more = bound.join(radius, "query_id").filter(F.col("gap") <= F.col("radius") + SLACK + SLACK_SHARE * F.sqrt(F.col("norm") + F.lit(float(most)))).join(done, ["query_id", "block"], "left_anti")
    every = begun.unionByName(_scored(index, asked, more, k))
    out = every.withColumn("rank", F.row_number().over(kth)).filter(F.col("rank") <= k)
    return out.select(F.col("query_id").cast("long"), F.col("rank").cast("int"), F.col("vec_id").cast("long"), "score")


def _scored(index: DataFrame, asked: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The k best of each wanted (query_id, block)."""
    parts = max(1, -(-asked.count() // QUERIES))
    turn = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
    side = wanted.select("query_id", "block").join(asked.select("query_id", "q", turn.alias("turn")), "query_id")
    rows = index.select("block", "vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("turn"))

    def best(key: tuple, part: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        found = _best(part, some, k) if len(part) and len(some) else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"score": np.int64})

    return rows.groupBy("block", "turn").cogroup(side.groupBy("block", "turn")).applyInPandas(best, "query_id string, vec_id string, score long")


__all__ = ["build_index", "quantised", "top_k", "usable"]
