"""Token ids in ORC files: integer run-length encoding, row indexes, and Bloom
filters on document ids.

Rows lie in ascending doc_id order over all files. ORC stores the ids of a
stripe run-length encoded and keeps statistics per stripe and per group of
rows, so a reader takes stripes in parallel and skips those whose id range
or Bloom filter excludes the documents it wants.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourse.llm.common import keyed_texts, list_column, steps, stored
from bourse.llm.encode import encoder

END = 2
# Documents per row group: small, since one row holds a document's ids.
ROW_GROUP = 1000
ORC = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": str(ROW_GROUP),
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
SCHEMA = "doc_id long, row long, ids array<int>"


def _encode(path: str, end: int):
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        enc = encoder(path)
        row = 0
        for batch in steps(batches):
            ids = [enc.encode(t) + last for t in batch.column("text").to_pylist()]
            flat = np.frombuffer(b"".join(ids), "<i4")
            n = len(ids)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.arange(row, row + n)),
                list_column(flat, [len(x) // 4 for x in ids], pa.int32())], names=["doc_id", "row", "ids"])
            row += n
    return run


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end: int = END, id_col: str = "doc_id",
                    text_col: str = "text") -> None:
    """Encode every text, append ``end``, and write the ids below ``path`` in
    ascending id order: one sorted range of ids to a file, ``row`` counting
    a file's documents. Null and empty texts have the end id alone;
    repeated rows are all written; null ids come first; an empty table
    writes no documents."""
    texts = keyed_texts(docs, id_col, text_col)
    # Rows that share an id, or have none, are split by their texts.
    texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text") \
        .mapInArrow(_encode(tokenizer, end), SCHEMA).write.options(**ORC).orc(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, row, ids and the file's number, as ``write_token_ids`` wrote
    them: null ids, repeated rows and documents of any length are rows like
    any other; a folder without documents gives none. A filter on doc_id
    reaches the files' indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).withColumn(
        "file", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long"))


def _digest(batches):
    for batch in batches:
        ids = batch.column("ids")
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        raw = memoryview(flat.tobytes())
        counts = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate(([0], np.cumsum(counts))) * 4
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("file", "row", "doc_id")] + [pa.array(counts), pa.array(crc, pa.int64())],
            names=["file", "row", "doc_id", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files:
    start counts the ids of all documents before it. The files are read once,
    into a table of counts and checksums. Sums run within a file
    first; the running sum over files has a row per file. A null doc_id passes
    through (such documents come first), repeated rows have a start each, a
    document without text has its end id alone, and a folder without documents
    gives an empty result."""
    rows = stored(read_token_ids(spark, path).mapInArrow(
        _digest, "file long, row long, doc_id long, n_tokens long, ids_crc32 long"), "token_index")
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("total")) \
        .select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(files, "file") \
        .select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
