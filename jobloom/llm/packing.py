"""Best-fit packing of token sequences by minimum bin slack.

The lengths of all pieces are a histogram of at most `capacity` counts, whatever
the corpus. The plan is made on it: the bin takes the longest piece that is left,
and a bitset subset-sum over the lengths that are left (each as often as it is
left) finds the fullest combination that goes with it. That combination is
removed as often as the counts allow, so one step plans millions of bins. Each
step leaves some length with fewer pieces than it uses, at least halving a count
that is below capacity / length; so there are O(capacity) steps.

Pieces then take their bins by rank among the pieces of their length: ranks come
from counts by partition, and no length gathers in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import empty_text, forget, free_names, frugal, small, trim, written
from jobloom.llm.tokens import encoder, release

CAPACITY = 2048
END_ID = 0
NUMBERS = ("task", "nth")
GROUP_BYTES = 16 << 20


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(times, [(length, how many)])] that uses up the histogram."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must be between 1 and the capacity")
    order, plan = sorted(left, reverse=True), []
    while order:
        longest = order[0]
        room = capacity - longest
        mask, reach, added = (1 << (room + 1)) - 1, 1, []
        for n in order:
            if n > room:
                continue
            copies, k = min(left[n] - (n == longest), room // n), 1
            while copies > 0:
                k = min(k, copies)
                added.append((n, k, reach))
                reach |= (reach << (n * k)) & mask
                copies -= k
                k *= 2
            if reach >> room & 1:
                break
        at, use = reach.bit_length() - 1, {longest: 1}
        for n, k, before in reversed(added):
            if not before >> at & 1:
                at -= n * k
                use[n] = use.get(n, 0) + k
        times = min(left[n] // k for n, k in use.items())
        plan.append((times, list(use.items())))
        for n, k in use.items():
            left[n] -= times * k
        order = [n for n in order if left[n]]
    return plan


def _places(plan: list) -> dict[str, np.ndarray]:
    """By (length, first rank): how many go in a bin, the first bin, the offset there."""
    rank, found, base = {}, [], 0
    for times, use in plan:
        offset = 0
        for n, k in use:
            at = rank.get(n, 0)
            found.append((n, at, k, base, offset))
            rank[n] = at + times * k
            offset += n * k
        base += times
    table = np.array(sorted(found) or np.empty((0, 5)), np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 44) + table[:, 1], "first": table[:, 1], "k": table[:, 2], "bin": table[:, 3], "offset": table[:, 4]}


class _Counter:
    """Numbers pieces within a task, by length."""

    def __init__(self) -> None:
        self.seen, self.task = np.zeros(0, np.int64), np.int32(TaskContext.get().partitionId())

    def next(self, lengths: pd.Series) -> np.ndarray:
        length = lengths.to_numpy(np.int64)
        if len(length) and length.max() >= len(self.seen):
            self.seen = np.concatenate((self.seen, np.zeros(length.max() + 1 - len(self.seen), np.int64)))
        nth = lengths.groupby(length).cumcount().to_numpy(np.int64) + self.seen[length]
        self.seen += np.bincount(length, minlength=len(self.seen))
        return nth


def pack(pieces: DataFrame, capacity: int = CAPACITY, numbers: tuple[str, str] | None = None) -> DataFrame:
    """pieces with sequence_id and offset: each piece whole in one sequence of at
    most `capacity`, gapless from 0. `length` must be from 1 to capacity in every
    row. Other columns, ids too, pass unchanged, nulls and repeated rows as well,
    whatever their names; only a sequence_id and offset that are there already are
    replaced. No rows give none. numbers: the columns (task, nth) by which
    token_pieces has numbered its pieces; they are dropped. Without them the pieces
    are numbered here, in a pass of their own."""
    pieces = pieces.drop("sequence_id", "offset").withColumn("length", F.col("length").cast("long"))
    task_, nth_ = numbers or free_names(pieces.columns, "_task", "_nth")
    before_, rank_ = free_names([*pieces.columns, task_, nth_], "_before", "_rank")
    # whole numbers as strings in between, for pandas would turn them into floats beside nulls
    whole = {k: t for k, t in pieces.dtypes if t in ("bigint", "int", "smallint", "tinyint") and k not in ("length", task_, nth_)}
    back = lambda rows: rows.withColumns({k: F.col(k).cast(t) for k, t in whole.items()})
    given = written(pieces.withColumns({k: F.col(k).cast("string") for k in whole}), "pieces", group_bytes=GROUP_BYTES)  # so that no task needs two Python workers, one with a tokenizer
    fields = [f for f in given.schema.fields if f.name not in (task_, nth_)]

    def numbered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _Counter()
        for part in parts:
            yield part.assign(**{task_: counter.task, nth_: counter.next(part["length"])})

    if numbers:
        rows = given
    else:
        rows = written(given.mapInPandas(numbered, T.StructType([*fields, T.StructField(task_, T.IntegerType()), T.StructField(nth_, T.LongType())])), "pieces")
        forget(given)
    counts = written(rows.groupBy(F.col(task_).alias("task"), "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    places = _places(plan_bins(histogram, capacity))
    line = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("task").alias(task_), "length", F.coalesce(F.sum("n").over(line), F.lit(0)).alias(before_))
    ranked = rows.join(small(written(before, "before")), [task_, "length"]).withColumn(rank_, F.col(nth_) + F.col(before_))
    ranked = ranked.select(*[f.name for f in fields], rank_)

    def put(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()  # no tokenizer is needed any more, and idle workers would keep it
        trim()
        for part in parts:
            length, rank = part["length"].to_numpy(np.int64), part.pop(rank_).to_numpy(np.int64)
            i = np.searchsorted(places["key"], (length << 44) + rank, "right") - 1
            copy, slot = np.divmod(rank - places["first"][i], places["k"][i])
            yield part.assign(sequence_id=places["bin"][i] + copy, offset=places["offset"][i] + slot * length)

    kinds = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return back(ranked.mapInPandas(put, kinds))


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, special: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids, task, nth) of whole texts and an end id each.

    ids: little-endian 32-bit. task and nth: the NUMBERS by which pack() tells pieces
    of one length apart. A null text is empty and gives the end id alone. Only
    documents of more than `capacity` ids are cut, into pieces of that many; the
    first piece is what is over. Strings of the tokenizer's added tokens are those
    tokens; with special=False they are ordinary text. A null doc_id stays null; other
    columns are ignored."""
    frugal(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, counter = encoder(tokenizer, special).encode, _Counter()
        for part in parts:
            for at in range(0, len(part), 256):
                own = part.iloc[at : at + 256]
                rows = []
                for doc_id, raw in zip(own["doc_id"], encode(own["text"].tolist()), strict=True):
                    raw += end
                    total = len(raw) // 4
                    first = total % capacity or capacity
                    for piece, stop in enumerate(range(first, total + 1, capacity)):
                        start = max(0, stop - capacity) if piece else 0
                        rows.append((doc_id, piece, start, stop - start, raw[4 * start : 4 * stop]))
                found = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"]).astype({"piece": "int32"})
                yield found.assign(task=counter.task, nth=counter.next(found["length"]))
            trim()

    # doc_id as a string, for pandas would turn integers beside nulls into floats
    rows = docs.select(F.col("doc_id").cast("string"), empty_text().alias("text"))
    kinds = "doc_id string, piece int, start long, length long, ids binary, task int, nth long"
    return rows.mapInPandas(cut, kinds).withColumn("doc_id", F.col("doc_id").cast("long"))
