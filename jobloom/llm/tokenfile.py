"""Token ids in binary shards with a minimal perfect hash index.

A shard is a header and the raw ids of its documents, little-endian, 2 or 4
bytes each. Shards are ranges of ascending doc_id. The index maps a key (doc_id
and the place among rows that repeat it) to shard, offset and length: keys fall
into buckets of about BUCKET keys by hash; in a bucket, levels of bit arrays
give each key a slot of its own, without gaps (a key takes the first level where
no other key has its bit); a slot holds a 32-bit fingerprint, so keys that were
never stored are told apart. Keys whose hashes are equal, and those that LEVELS
levels leave over, stand in a list with the keys themselves. A lookup reads one
bucket: constant time.

Files are written under a name of the attempt and become visible by the table
that lists them, so a task that runs again leaves nothing wrong behind.
"""

from __future__ import annotations

import math
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.llm.common import empty_text, frugal, small, written
from jobloom.llm.textvec import mix
from jobloom.llm.tokens import encoder

END_ID = 1
SHARD_BYTES = 8 << 20
BUCKET = 1024
BUCKETS_IN_FILE = 64
MAGIC = b"TOKS\x01"
_HEADER = "<5sBHQ"
_HEADER_SIZE = struct.calcsize(_HEADER)
_ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u8")])
_KEY = np.dtype([("doc_id", "<i8"), ("nth", "<i8"), ("null", "<i8")])
LEVELS = 64
U = np.uint64


class TokenFile(NamedTuple):
    """root: folder; shards: (shard, name, base, width); index: (file, name); keys:
    (doc_id, nth) of all documents."""

    root: str
    shards: DataFrame
    index: DataFrame
    buckets: int
    keys: DataFrame


def _store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _put(root: str, name: str, *parts: bytes) -> None:
    store, path = _store(root)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as out:
        for part in parts:
            out.write(part)


def key_hash(keys: np.ndarray) -> np.ndarray:
    own = mix(keys["doc_id"].view(U) + keys["null"].view(U) * U(0xD6E8FEB86659FD93))
    return mix(own ^ mix(keys["nth"].view(U) * U(0x9E3779B97F4A7C15) + keys["null"].view(U)))


def _key_array(part: pd.DataFrame) -> np.ndarray:
    """Of columns doc_id (text or null) and nth."""
    keys = np.zeros(len(part), _KEY)
    keys["null"] = part["doc_id"].isna()
    keys["doc_id"] = [0 if x is None else int(x) for x in part["doc_id"]]
    keys["nth"] = part["nth"]
    return keys


def build_bucket(hashes: np.ndarray, entries: np.ndarray, keys: np.ndarray) -> bytes:
    """Numbers of levels, entries and listed keys, sizes of the levels; the levels,
    the entries by slot, the listed keys and their entries."""
    _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
    alike = times[back] > 1
    levels, rest, slots, used = [], np.flatnonzero(~alike), np.empty(len(hashes), np.int64), 0
    while len(rest) and len(levels) < LEVELS:
        bits = max(64, -(-2 * len(rest) // 64) * 64)
        place = (mix(hashes[rest] + U(len(levels) + 1)) % U(bits)).astype(np.int64)
        alone = np.bincount(place, minlength=bits) == 1
        ok = alone[place]
        rank = np.cumsum(alone) - 1
        slots[rest[ok]] = used + rank[place[ok]]
        used += int(alone.sum())
        levels.append(np.packbits(alone, bitorder="little").tobytes())
        rest = rest[~ok]
    listed = np.concatenate((np.flatnonzero(alike), rest))
    slotted = np.ones(len(hashes), bool)
    slotted[listed] = False
    table = np.empty(used, _ENTRY)
    table[slots[slotted]] = entries[slotted]
    sizes = np.array([len(levels), used, len(listed), *map(len, levels)], "<u4").tobytes()
    return sizes + b"".join(levels) + table.tobytes() + keys[listed].tobytes() + entries[listed].tobytes()


def find_in_bucket(region: bytes, hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, found) for each hash and key."""
    depth, n, listed = np.frombuffer(region, "<u4", 3).tolist()
    sizes = np.frombuffer(region, "<u4", depth, 12).tolist()
    at, used = 12 + 4 * depth, 0
    slots, rest = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
    for level, size in enumerate(sizes):
        bits = np.unpackbits(np.frombuffer(region, np.uint8, size, at), bitorder="little")
        rank = np.cumsum(bits.astype(np.int64)) - 1
        place = (mix(hashes[rest] + U(level + 1)) % U(len(bits))).astype(np.int64)
        hit = bits[place] == 1
        slots[rest[hit]] = used + rank[place[hit]]
        used += int(rank[-1]) + 1
        rest, at = rest[~hit], at + size
    table = np.frombuffer(region, _ENTRY, n, at)
    found = slots >= 0
    entries = table[np.where(found, slots, 0)] if n else np.zeros(len(hashes), _ENTRY)
    found &= entries["print"] == (hashes & U(0xFFFFFFFF)).astype("<u4")
    if listed:
        at += n * _ENTRY.itemsize
        names = np.frombuffer(region, _KEY, listed, at).tolist()
        more = np.frombuffer(region, _ENTRY, listed, at + listed * _KEY.itemsize)
        where = {k: i for i, k in enumerate(names)}
        for i, key in enumerate(keys.tolist()):
            if (j := where.get(key)) is not None:
                entries[i], found[i] = more[j], True
    return entries, found


def _keys(rows: DataFrame, buckets: int) -> DataFrame:
    """rows of (doc_id, nth, ...) with hash, bucket and file."""

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            h = key_hash(_key_array(part))
            bucket = ((h >> U(32)) % U(buckets)).astype(np.int64)
            yield part.assign(hash=h.view(np.int64), bucket=bucket, file=bucket // BUCKETS_IN_FILE)

    # doc_id as a string, for pandas would turn integers beside nulls into floats
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    kinds = ", ".join(f"{k} {t}" for k, t in rows.dtypes)
    return rows.mapInPandas(hashed, f"{kinds}, hash long, bucket long, file long")


def write(docs: DataFrame, tokenizer: str, root: str, end_id: int = END_ID, width: int = 2, shard_bytes: int = SHARD_BYTES, special: bool = True) -> TokenFile:
    """Writes the ids of every whole text of docs and an end id, in ascending
    doc_id order, to files under root.

    A null text is empty and has the end id alone. Null doc_ids come first. Rows
    that repeat a doc_id are kept, ordered by a hash of the text and by the text; as
    many as they are, they fill several shards. Other columns are ignored. A table
    without rows has no shards. width: bytes an id takes, 2 or 4. Strings of the
    tokenizer's added tokens are those tokens, with special=False ordinary text."""
    spark = docs.sparkSession
    frugal(spark)
    rows = docs.select("doc_id", empty_text().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    parts = max(1, math.ceil((size["b"] or 0) / shard_bytes))
    by = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by, "text").withColumn("doc_id", F.col("doc_id").cast("string"))
    kind = np.dtype(f"<u{width}")
    columns = "doc_id string, nth long, shard long, name string, at long, n long"

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        name, at, last, nth = f"shard-{number:06d}-{uuid.uuid4().hex}.bin", 0, object(), 0
        encode = encoder(tokenizer, special).encode_arrays
        store, path = _store(root)
        store.create_dir(path, recursive=True)
        out = None
        for batch in batches:
            if out is None:
                out = store.open_output_stream(f"{path}/{name}")
                out.write(struct.pack(_HEADER, MAGIC, width, 0, number))
            ids, size = encode(batch["text"], end_id)
            if len(ids) and ids.max() > np.iinfo(kind).max:
                raise ValueError(f"ids of this tokenizer need more than {width} bytes")
            out.write(ids.astype(kind).tobytes())
            turns = []
            for doc_id in batch["doc_id"].to_pylist():
                nth = nth + 1 if doc_id == last else 0
                last = doc_id
                turns.append(nth)
            start = at + np.cumsum(size) - size
            at += len(ids)
            k = len(turns)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, (turns, [number] * k, [name] * k, start, size))], columns.replace(" string", "").replace(" long", "").split(", "))
        if out is not None:
            out.close()

    placed = written(ordered.mapInArrow(shard, columns), "placed")
    placed = _counted_on(placed)
    shards = placed.groupBy("shard", "name").agg(F.sum("n").alias("ids"))
    base = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = written(shards.select("shard", "name", base.alias("base"), F.lit(width).alias("width")), "shards")  # one row a shard
    buckets = max(1, math.ceil(size["n"] / BUCKET))

    def bucket(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        h = part["hash"].to_numpy(np.int64).view(U)
        entries = np.empty(len(h), _ENTRY)
        entries["print"], entries["shard"], entries["at"], entries["n"] = h & U(0xFFFFFFFF), part["shard"], part["at"], part["n"]
        return pd.DataFrame({"bucket": [key[0]], "file": [key[0] // BUCKETS_IN_FILE], "region": [build_bucket(h, entries, _key_array(part))]})

    def file(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("bucket")
        name = f"index-{key[0]:06d}-{uuid.uuid4().hex}.bin"
        sizes = dict(zip(part["bucket"], map(len, part["region"]), strict=True))
        each = [0] + [sizes.get(key[0] * BUCKETS_IN_FILE + i, 0) for i in range(BUCKETS_IN_FILE)]
        ends = np.cumsum(each) + 8 * (BUCKETS_IN_FILE + 1)
        _put(root, name, ends.astype("<u8").tobytes(), *part["region"])
        return pd.DataFrame({"file": [key[0]], "index": [name]})

    regions = _keys(placed.select("doc_id", "nth", "shard", "at", "n"), buckets).groupBy("bucket").applyInPandas(bucket, "bucket long, file long, region binary")
    index = written(regions.groupBy("file").applyInPandas(file, "file long, index string"), "index")
    return TokenFile(root, shards, index, buckets, placed.select(F.col("doc_id").cast("long").alias("doc_id"), "nth"))


def _counted_on(placed: DataFrame) -> DataFrame:
    """placed with nth counted on where rows of one doc_id fill several shards."""
    ends = written(placed.groupBy("shard").agg(F.min_by("doc_id", "at").alias("first"), F.max_by("doc_id", "at").alias("last")), "ends")
    before = F.lag(F.struct("last")).over(Window.orderBy("shard"))  # one row a shard
    split = ends.withColumn("_before", before).filter(F.col("_before").isNotNull() & F.col("first").eqNullSafe(F.col("_before.last"))).select(F.col("first").alias("_id")).distinct()
    split = written(split, "split")
    if split.isEmpty():
        return placed
    counts = placed.join(small(split), F.col("doc_id").eqNullSafe(F.col("_id"))).groupBy("_id", F.col("shard").alias("_shard")).agg(F.count(F.lit(1)).alias("n"))  # fewer ids than shards
    line = Window.partitionBy("_id").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    more = written(counts.select("_id", "_shard", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("_more")), "before")
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("shard") == F.col("_shard"))
    joined = placed.join(small(more), on, "left").withColumn("nth", F.col("nth") + F.coalesce("_more", F.lit(0)))
    return written(joined.select(placed.columns), "placed")


def lookup(tokens: TokenFile, keys: DataFrame) -> DataFrame:
    """(doc_id, nth, shard, at, n) of the keys (doc_id, nth) that are stored."""
    root = tokens.root
    keyed = _keys(keys.select("doc_id", "nth"), tokens.buckets).join(small(tokens.index), "file")

    def probe(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        store, path = _store(root)
        i = int(key[0]) % BUCKETS_IN_FILE
        with store.open_input_file(f"{path}/{part['index'].iloc[0]}") as f:
            a, b = struct.unpack("<QQ", f.read_at(16, 8 * i))
            region = f.read_at(b - a, a)
        h = part["hash"].to_numpy(np.int64).view(U)
        if not region:
            entries, found = np.zeros(len(h), _ENTRY), np.zeros(len(h), bool)
        else:
            entries, found = find_in_bucket(region, h, _key_array(part))
        out = pd.DataFrame({"doc_id": part["doc_id"], "nth": part["nth"], "shard": entries["shard"].astype(np.int64), "at": entries["at"].astype(np.int64), "n": entries["n"].astype(np.int64)})
        return out[found]

    return keyed.groupBy("bucket").applyInPandas(probe, "doc_id string, nth long, shard long, at long, n long")


def read(spark: SparkSession, tokens: TokenFile, keys: DataFrame) -> DataFrame:
    """(doc_id, nth, start, ids) of the keys (doc_id, nth), read from the files.
    ids: little-endian 32-bit; start: ids of all documents before it."""
    frugal(spark)
    root = tokens.root
    found = lookup(tokens, keys).join(small(tokens.shards), "shard")
    parts = max(1, tokens.shards.count())
    found = found.repartitionByRange(parts, "shard", "at").sortWithinPartitions("shard", "at")

    def payload(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _store(root)
        for batch in batches:
            for name, own in batch.groupby("name", sort=False):
                with store.open_input_file(f"{path}/{name}") as f:
                    magic, width, _, _ = struct.unpack(_HEADER, f.read_at(_HEADER_SIZE, 0))
                    if magic != MAGIC:
                        raise ValueError(f"{name} is no token shard")
                    for i in range(0, len(own), 256):
                        rows = own.iloc[i : i + 256]
                        at, n = rows["at"].to_numpy(), rows["n"].to_numpy()
                        low, high = at.min(), (at + n).max()
                        ids = np.frombuffer(f.read_at((high - low) * width, _HEADER_SIZE + low * width), f"<u{width}").astype("<u4")
                        raw = [ids[a : a + k].tobytes() for a, k in zip(at - low, n, strict=True)]
                        yield pd.DataFrame({"doc_id": rows["doc_id"], "nth": rows["nth"], "start": rows["base"] + rows["at"], "ids": raw})

    return found.mapInPandas(payload, "doc_id string, nth long, start long, ids binary").withColumn("doc_id", F.col("doc_id").cast("long"))
