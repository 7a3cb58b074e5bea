"""Outlines of sets of 64-bit hashes: for buckets of their values the sum, the sum of mixed
values and the number. Sets that differ in d values differ in d buckets at most, and a
bucket that one value was added to tells which."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BUCKET = np.dtype([("sum", "<u8"), ("mixed", "<u8"), ("n", "<u2")])
#: Rows that are worked on at a time, whatever the size of Arrow's batches.
SLICE = 256


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def bucket_bits(level: int, least: float) -> int:
    """More buckets, a power of two, than two sets of less than 2 ** (level + 1) values differ
    by in values if their Jaccard similarity is at least `least`: so one is alike in both."""
    apart = math.floor(2 * (2 ** (level + 1) - 1) * (1 - least) / (1 + least) + 1e-9)
    return apart.bit_length()


def _outlines(values: np.ndarray, n: np.ndarray, bits: np.ndarray) -> list[bytes]:
    """Of sets of n[i] ascending values each."""
    of = np.repeat(np.arange(len(n)), n)
    base = np.concatenate(([0], np.cumsum(1 << bits)))
    shift = np.uint64(64) - bits.astype(np.uint64)[of]
    at = base[of] + np.where(shift < 64, values >> np.minimum(shift, np.uint64(63)), np.uint64(0)).astype(np.int64)
    found = np.zeros(base[-1], BUCKET)
    if len(at):
        first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        found["sum"][at[first]] = np.add.reduceat(values, first)
        found["mixed"][at[first]] = np.add.reduceat(mix(values), first)
        found["n"][at[first]] = np.diff(np.concatenate((first, [len(at)])))
    blob, size = found.tobytes(), BUCKET.itemsize
    return [blob[size * i : size * j] for i, j in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def outlined(least: float):
    """Batches (..., s: ascending hashes) with n, level, own and upper instead of s: the outline at
    the level of the set's size and, if larger sets of the next may be as similar, at that one."""
    bits = np.array([bucket_bits(k, least) for k in range(33)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                s = part.column("s")
                n = np.asarray(s.value_lengths()).astype(np.int64)
                values = np.asarray(s.flatten()).view(np.uint64) ^ np.uint64(1 << 63)
                level = np.frexp(n.astype(float))[1].astype(np.int64) - 1
                upper = n >= np.ceil(least * 2.0 ** (level + 1) - 1e-9)
                own = _outlines(values, n, bits[level])
                higher = iter(_outlines(values[np.repeat(upper, n)], n[upper], bits[level[upper] + 1]))
                more = [next(higher) if u else None for u in upper.tolist()]
                rest = [part.column(c) for c in part.schema.names if c != "s"]
                names = [c for c in part.schema.names if c != "s"] + ["n", "level", "own", "upper"]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(n, pa.int32()), pa.array(level, pa.int32()), pa.array(own, pa.binary()), pa.array(more, pa.binary())], names=names)

    return run


def bucket_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., level, own, upper) as a row (..., key) for each bucket, by which equal buckets meet."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            part = batch.slice(i, SLICE)
            level = np.asarray(part.column("level"))
            for name, up in (("own", 0), ("upper", 1)):
                blobs = part.column(name).to_pylist()
                rows = np.array([j for j, b in enumerate(blobs) if b is not None], np.int64)
                if not len(rows):
                    continue
                sizes = np.array([len(blobs[j]) // BUCKET.itemsize for j in rows])
                found = np.frombuffer(b"".join(blobs[j] for j in rows), BUCKET)
                at = np.arange(len(found)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                place = (at.astype(np.uint64) << np.uint64(6)) + np.repeat(level[rows] + up, sizes).astype(np.uint64)
                key = mix(found["sum"] + mix(found["mixed"] + mix(found["n"].astype(np.uint64) + mix(place))))
                where = pa.array(np.repeat(rows, sizes))
                rest = [c for c in part.schema.names if c not in ("level", "own", "upper")]
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(where) for c in rest], pa.array(key.view(np.int64))], names=[*rest, "key"])


def compared(least: float):
    """(..., n, m, x, y) as (..., similarity) of the pairs of sets of n and m values with outlines
    x and y of one level, unless it is below `least`; null where outlines don't tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                x, y = (part.column(c).to_pylist() for c in "xy")
                sizes = np.array([len(b) // BUCKET.itemsize for b in x])
                a, b = (np.frombuffer(b"".join(c), BUCKET) for c in (x, y))
                of = np.repeat(np.arange(len(x)), sizes)
                more = a["n"].astype(np.int64) - b["n"]
                other = (a["sum"] != b["sum"]) | (a["mixed"] != b["mixed"]) | (more != 0)
                apart = {k: np.where(more > 0, a[k] - b[k], b[k] - a[k]) for k in ("sum", "mixed")}
                one = (np.abs(more) == 1) & (mix(apart["sum"]) == apart["mixed"])
                differ = np.where(more == 0, 2, np.abs(more)) * other  # at least; of `one` exactly
                at_least = np.bincount(of, differ, len(x)).astype(np.int64)
                told = np.bincount(of, other & ~one, len(x)) == 0
                both = np.asarray(part.column("n")).astype(np.int64) + np.asarray(part.column("m"))
                common = (both - at_least) / 2
                similarity = common / (both - common)
                keep = np.flatnonzero(similarity >= least - 1e-12)
                rest = [c for c in part.schema.names if c not in ("n", "m", "x", "y")]
                columns = [part.column(c).take(pa.array(keep)) for c in rest]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(similarity[keep], pa.float64(), mask=~told[keep])], names=[*rest, "similarity"])

    return run
