"""BPE ids of whole texts by a table of distinct words, and texts of ids.

Encoding. Rows are dealt into groups of about GROUP_BYTES of text by a hash; what a
scan task has of a group goes there as one compressed block. A group asks for each of its distinct words
once: words fall into buckets by hash, a bucket gathers the distinct words of all
groups, encodes each once and sends every group the ids of the words it asked for.
The group joins them back by position in its texts. Two places of a text are
different words if no token can span what is between them, so the ids are those of
the whole text. A word of any frequency is one word a group, and a bucket takes its
groups one after the other, so that it holds the distinct words only.

Decoding. The pieces of the file, a bounded vocabulary, go to every executor; ids
meet them by their number, a batch at a time, and are joined as the file's decoder
says: none (pieces with a space between them) or byte-level.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import dealt, frugal, planes, trimmed, unplanes
from jobloom.llm.tokens import byte_letters, encoder, release, units

#: Text of a group, and what a scan task gathers before it sends blocks.
GROUP_BYTES, HELD_BYTES = 8 << 20, 16 << 20
#: Buckets of words: so many times the root of the number of groups.
SPREAD = 4
#: Of compression, and words that a bucket encodes at a time.
LEVEL, AT_ONCE = 5, 5000
#: Stands between words and texts in a block: no UTF-8 has this byte.
_SEP = b"\xff"
#: Pieces of the largest vocabulary that decode() takes.
MOST_PIECES = 2_000_000

_BLOCK = "pid int, ids binary, no_id binary, times binary, texts binary"


def _squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", LEVEL).compress(raw, asbytes=True)


def _expand(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def words(raw: bytes, drops: bool) -> list[bytes]:
    """A text as words that encode by themselves; in a row they are the text, but
    for white space that the file drops."""
    if drops:
        return raw.replace(b"\n", b" ").split(b" ")
    first, *more = units(raw.decode("utf-8", "surrogatepass"), False)
    return [x.encode("utf-8", "surrogatepass") for x in [first, *(u if u[:1] == "\n" else " " + u for u in more)]]


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (doc_id, no_id, text, pid) as blocks of a group; rows that repeat both
    id and text are one with their number."""
    held, size = {}, 0
    for part in batches:
        for i, no_id, text, pid in zip(part["doc_id"].tolist(), part["no_id"].tolist(), part["text"].tolist(), part["pid"].tolist(), strict=True):
            own, key = held.setdefault(pid, {}), (i, no_id, text)
            size += 64 + (0 if key in own else len(text))
            own[key] = own.get(key, 0) + 1
        if size > HELD_BYTES:
            yield from map(_block, held.items())
            held, size = {}, 0
    yield from map(_block, held.items())


def _block(item: tuple[int, dict]) -> pd.DataFrame:
    pid, own = item
    texts = _SEP.join(t.encode("utf-8", "surrogatepass") for _, _, t in own)
    rows = (np.array([i for i, _, _ in own], np.int64).tobytes(), np.array([n for _, n, _ in own], bool).tobytes(), np.array(list(own.values()), np.int64).tobytes())
    return pd.DataFrame([(pid, *rows, _squeeze(texts))], columns=["pid", "ids", "no_id", "times", "texts"])


def _texts(blob: bytes) -> list[bytes]:
    return _expand(blob).split(_SEP)


def _asked(blobs: list[bytes], drops: bool, buckets: int) -> list[list[bytes]]:
    """The distinct words of a group's blocks, in order, by bucket."""
    distinct, found = set(), [[] for _ in range(buckets)]
    for blob in blobs:
        for text in _texts(blob):
            distinct.update(words(text, drops))
    for raw in sorted(distinct):
        found[zlib.crc32(raw) % buckets].append(raw)
    return found


def encode(docs: DataFrame, path: str, special: bool = True, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, ids): of each row of docs the token ids of its whole text, an array
    of integers, by the tokenizers file at path.

    A null text is empty and has no ids; a null doc_id stays null. Rows that repeat
    a doc_id, or all, come as often. No rows give none. Other columns, whatever their
    names, are left out. special: strings of the file's added tokens are these
    tokens; else they are ordinary text."""
    frugal(docs.sparkSession)
    rows, n_groups = dealt(docs, group_bytes)
    buckets = math.ceil(SPREAD * math.sqrt(n_groups))
    groups = rows.mapInPandas(_blocks, _BLOCK).groupBy("pid")
    drops = encoder(path, special).drops

    @trimmed
    def ask(key: tuple, table: pa.Table) -> pa.Table:
        release()
        asked = _asked(table["texts"].to_pylist(), drops, buckets)
        some = [b for b in range(buckets) if asked[b]]
        return pa.table({"bucket": pa.array(some, pa.int32()), "pid": pa.array([key[0].as_py()] * len(some), pa.int32()), "asked": pa.array([_squeeze(_SEP.join(asked[b])) for b in some], pa.binary())})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = encoder(path, special, 10 * AT_ONCE), {}
        for batch in batches:
            for pid, bucket, blob in zip(batch["pid"].to_pylist(), batch["bucket"].to_pylist(), batch["asked"].to_pylist(), strict=True):
                asked = _expand(blob).split(_SEP)
                new = [w for w in asked if w not in known]
                for at in range(0, len(new), AT_ONCE):
                    part = new[at : at + AT_ONCE]
                    known.update(zip(part, own.encode([w.decode("utf-8", "surrogatepass") for w in part]), strict=True))
                ids = [known[w] for w in asked]
                sizes = np.array([len(x) // 4 for x in ids], "<u4")
                told = _squeeze(planes(sizes) + planes(np.frombuffer(b"".join(ids), "<u4")))
                yield pa.RecordBatch.from_pydict({"pid": pa.array([pid], pa.int32()), "bucket": pa.array([bucket], pa.int32()), "n": pa.array([len(asked)], pa.int32()), "told": pa.array([told], pa.binary())})

    @trimmed
    def use(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        release()
        blobs, known = table["texts"].to_pylist(), {}
        asked = _asked(blobs, drops, buckets)
        for bucket, n, blob in zip(told["bucket"].to_pylist(), told["n"].to_pylist(), told["told"].to_pylist(), strict=True):
            raw = _expand(blob)
            ends = 4 * np.cumsum(unplanes(raw[: 4 * n], "<u4"), dtype=np.int64)
            ids = unplanes(raw[4 * n :], "<u4").tobytes()
            known.update(zip(asked[bucket], (ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)), strict=True))
            asked[bucket] = None
        found = [b"".join(map(known.__getitem__, words(t, drops))) for blob in blobs for t in _texts(blob)]
        ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found])))
        ids = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(found), "<i4"))).cast(pa.list_(pa.int32()))
        return pa.table({
            "doc_id": np.frombuffer(b"".join(table["ids"].to_pylist()), np.int64), "no_id": np.frombuffer(b"".join(table["no_id"].to_pylist()), bool),
            "times": np.frombuffer(b"".join(table["times"].to_pylist()), np.int64), "ids": ids,
        })

    questions = groups.applyInArrow(ask, "bucket int, pid int, asked binary")
    answers = questions.groupBy("bucket").applyInArrow(_streamed(answer), "pid int, bucket int, n int, told binary")
    out = groups.cogroup(answers.groupBy("pid")).applyInArrow(use, "doc_id long, no_id boolean, times long, ids array<int>")
    each = out.withColumn("_each", F.explode(F.sequence(F.lit(1), "times")))
    return each.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "ids")


def _streamed(work):
    """work as Spark recognises functions of a group's batches: by annotations that
    are types, not their names."""

    def run(batches):
        yield from work(batches)

    run.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def pieces(path: str) -> tuple[list[str | None], str | None]:
    """(piece of each id, None where no token has it; kind of the file's decoder)."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    kind = (file.get("decoder") or {}).get("type")
    if kind not in (None, "ByteLevel"):
        raise ValueError(f"no decoding as {kind}")
    known = {i: p for p, i in file["model"]["vocab"].items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
    if len(known) > MOST_PIECES:
        raise ValueError("a vocabulary of more pieces than executors should hold")
    return [known.get(i) for i in range(max(known) + 1)], kind


def decode(rows: DataFrame, path: str) -> DataFrame:
    """rows (ids, ...) with `text`, behind their other columns and in place of one of
    that name in any spelling. Null ids, and ids that no token has, say nothing; no
    ids are an empty text, a null array too. Bytes that are no UTF-8 are U+FFFD.
    Repeated rows and null doc_ids stay; no rows give none."""
    frugal(rows.sparkSession)
    every, kind = pieces(path)
    every = rows.sparkSession.sparkContext.broadcast(every)  # MOST_PIECES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(every.value, pa.large_string())
        if kind:
            letters = {ord(c): b for b, c in byte_letters().items()}
            raw = [None if p is None else bytes(map(letters.__getitem__, map(ord, p))) if all(ord(c) in letters for c in p) else p.encode() for p in every.value]
            table = pa.array(raw, pa.large_binary())
        for batch in batches:
            lists = batch["ids"]
            flat = lists.flatten()
            ok = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table))), False)
            found = table.take(pc.if_else(ok, flat, None))
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            known = np.asarray(found.is_valid().to_numpy(zero_copy_only=False), np.int64)
            ends = np.concatenate(([0], np.cumsum(known)))[np.concatenate(([0], np.cumsum(size)))]
            back = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), found.drop_null())
            text = pc.binary_join(back, pa.scalar(b"" if kind else " ", table.type))
            if kind:
                text = pa.array([x.decode("utf-8", "replace") for x in text.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), text.cast(pa.string())], [*kept, "text"])

    kept = [c for c in rows.columns if c.lower() != "text"]
    used = rows.select(kept)
    return used.mapInArrow(run, T.StructType([*used.schema.fields, T.StructField("text", T.StringType())]))
