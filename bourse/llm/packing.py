"""Best-fit packing planned on the histogram of lengths.

The driver plans over counts, not documents: it walks the lengths downwards
and gives all pieces of a length to the fullest open sequences that still
hold them (best-fit decreasing). Sequences in one state are one entry, so
the plan has as many steps as there are states, whatever the number of
documents. Pieces then take the planned places by joining on their rank
within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import keyed_texts, steps, stored
from bourse.llm.encode import encoder

CAPACITY = 4096
END = 1
# Units whose ids a process keeps: fewer than elsewhere, as processes outlive
# their stage and the pipeline's next ones need the memory.
KEPT_UNITS = 250_000
# Most places of the plan; far above what 4096 lengths give (a few thousand).
PLAN_ROWS = 1_000_000
PLACE = "length long, first long, last long, per_sequence long, sequence long, at long"


def _pieces(path: str, end: int, capacity: int):
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        enc = encoder(path, KEPT_UNITS)
        for batch in steps(batches):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = enc.encode(text) + last
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k:k + 4 * capacity]
                    out.append((doc, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for all pieces: (length, first rank, rank after the last,
    pieces in each sequence, first sequence, place of the first piece in it).
    Ranks fill one sequence after the other."""
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences (first, how many)
    rooms: list[int] = []
    out = []
    sequences = 0

    def leave(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in free:
                free[room] = []
                insort(rooms, room)
            free[room].append((first, many))

    for length in sorted(histogram, reverse=True):
        n, rank = histogram[length], 0
        while n:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, many = free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms.pop(k)
            else:
                room, first = capacity, sequences
                many = -(-n // (capacity // length))
                sequences += many
            each = min(room // length, n)
            used = min(many, n // each)
            out.append((length, rank, rank + each * used, each, first, capacity - room))
            leave(room - each * length, first, used)
            leave(room, first + used, many - used)
            n -= each * used
            rank += each * used
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every
    piece of every row of ``docs``.

    Null and empty texts are the end id alone. Only texts longer than
    ``capacity`` are cut. Repeated rows and null ids are packed like any
    other row; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    pieces = stored(keyed_texts(docs, id_col, text_col).mapInArrow(
        _pieces(tokenizer, end, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    # At most ``capacity`` rows, whatever the input.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = plan(histogram, capacity)
    if len(places) > PLAN_ROWS:
        raise ValueError(f"the plan has {len(places)} places, more than {PLAN_ROWS}")
    # A length may hold a third of all pieces: ranks count within shares of it.
    shares = min(1024, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares)))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    base = shared.groupBy("length", "share").agg(F.count("*").alias("n")) \
        .select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32")
    ranked = shared.withColumn("inner", F.row_number().over(inside) - 1).join(base, ["length", "share"]) \
        .withColumn("rank", F.col("base") + F.col("inner")).drop("share", "base", "inner")
    p = spark.createDataFrame(places, PLACE).withColumnRenamed("length", "planned")
    index = F.col("rank") - F.col("first")
    return ranked.join(F.broadcast(p), (F.col("length") == F.col("planned")) & (F.col("rank") >= F.col("first")) &
                       (F.col("rank") < F.col("last"))) \
        .select("doc_id", "piece", "start", "length", "ids_crc32",
                (F.col("sequence") + F.floor(index / F.col("per_sequence"))).cast("long").alias("sequence_id"),
                (F.col("at") + F.pmod(index, F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"))
