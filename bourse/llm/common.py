"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.session import scratch_dir

# Text handled by one numpy step; longer texts make a step of their own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), so other columns can carry any names. A null text
    is an empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back: cuts
    the lineage, survives lost executors. An enclosing ``session.scratch``
    block removes it at its end."""
    spark = df.sparkSession
    path = scratch_dir(spark, "bourse", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def steps(batches, column: str = "text", limit: int = STEP_BYTES):
    """Slices of Arrow batches with at most ``limit`` bytes of text each (or
    one row), so that working memory doesn't follow the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat_bytes(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values end to end, and where each value starts
    (one more entry than values). Nulls are empty."""
    col = column.cast(pa.large_binary())
    n = len(col)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * col.offset)
    data = col.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return flat, offsets - offsets[0]


def sorted_groups(batches, key: str):
    """(key, table) for each run of equal keys in batches sorted by ``key``
    (a column of longs)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        lo = 0
        for hi in [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]:
            if held and keys[lo] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last, lo = keys[lo], hi
    if held:
        yield last, pa.Table.from_batches(held)


# ---- 64-bit hashes in numpy --------------------------------------------------

_RNG = np.random.default_rng(0x5EED)
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        out = []
        for b in (_BASE, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[:] = out
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_sums(flat: np.ndarray, lower: bool) -> np.ndarray:
    up, _ = _powers(len(flat))
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[flat] * up, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hashes of byte spans from their prefix sums."""
    _, down = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(flat: np.ndarray, offsets: np.ndarray):
    """Start, end and text number of every word ``[^\\x20\\x09-\\x0D]+``."""
    solid = ~_SPACE[flat]
    before = np.empty(len(flat), bool)
    if len(flat):
        before[0] = False
        before[1:] = solid[:-1]
        inner = offsets[1:-1]
        before[inner[inner < len(flat)]] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(len(flat), bool)
    if len(flat):
        after[-1] = False
        after[:-1] = solid[1:]
        inner = offsets[1:-1] - 1
        after[inner[inner >= 0]] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end of every word (A-Z as a-z), and the bytes."""
    flat, offsets = flat_bytes(column)
    starts, ends, owner = words(flat, offsets)
    return span_hashes(prefix_sums(flat, lower=True), starts, ends), owner, starts, ends, flat


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
