"""The corpus pipeline: quality rules, near-duplicates, benchmark leaks,
secrets, packing. Each stage takes the documents its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.llm.common import table
from bourse.llm.decontaminate import benchmark_matches
from bourse.llm.minhash_dedup import near_duplicate_rows, row_key
from bourse.llm.packing import pack
from bourse.llm.quality import quality_rules
from bourse.llm.queries import vocabulary
from bourse.llm.secrets import redacted, secret_spans
from bourse.session import scratch, shared_dir

# Percent of shared shingles from which two documents are near-duplicates.
SIMILAR = 80
ROWS = 7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Null, empty and blank texts
    have no words and go; repeated rows are judged each; a null doc_id
    passes through; an empty table stays empty; other columns, of any name,
    pass."""
    judged = docs.withColumn("row", F.struct(*docs.columns))
    return quality_rules(judged, id_col="row").filter("kept").select("doc_id.*")


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the row with the
    smallest doc_id (rows without one come last, then by a hash of the text);
    of repeated rows one. Documents without words are linked with nothing and
    all stay, as do rows that share a doc_id but no class. An empty table
    stays empty; other columns, of any name, pass."""
    rows = _rows(docs)
    found = near_duplicate_rows(docs, SIMILAR, ROWS)
    first = F.min_by("rid", F.struct(F.col("doc_id").isNull(), "doc_id", "rid"))
    kept = found.filter("class IS NOT NULL").groupBy("class").agg(first.alias("key")).select("key") \
        .unionByName(found.filter("class IS NULL").select(F.col("rid").alias("key"))).distinct()
    once = rows.join(kept, "key", "left_semi")
    wordy = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return once.filter(wordy).dropDuplicates(["key"]).unionByName(once.filter(~wordy)).select("row.*")


def _rows(docs: DataFrame) -> DataFrame:
    """(key, text, row): whole rows aside, so that columns of any name pass.
    The key tells rows apart that share a doc_id but not a text."""
    return docs.select(row_key().alias("key"), "text", F.struct(*docs.columns).alias("row"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none;
    repeated rows go or stay together; a null doc_id is a row like any other;
    without benchmark items, or documents, nothing goes; other columns, of any
    name, pass."""
    rows = _rows(docs)
    leaks = benchmark_matches(rows, table(spark, sf_dir, "benchmark"), id_col="key") \
        .select(F.col("doc_id").alias("key")).distinct()
    return rows.join(leaks, "key", "left_anti").select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced (n_chars, if
    there, follows). Null and empty texts hold none and stay as they are;
    repeated rows are changed alike; a null doc_id is a row like any other;
    an empty table stays empty; other columns, of any name, pass."""
    rows = _rows(docs)
    found = secret_spans(rows, id_col="key").filter(F.size("spans") > 0) \
        .select(F.col("doc_id").alias("key"), "spans").dropDuplicates(["key"])
    text = F.when(F.col("spans").isNotNull(), redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    clean = rows.join(found, "key", "left").select("row", "spans", text.alias("clean"))
    row = F.col("row").withField("text", F.col("clean"))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("spans").isNotNull(), F.length("clean")).otherwise(F.col("row.n_chars"))
        row = row.withField("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return clean.select(row.alias("row")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' pieces in training sequences, as
    ``pack`` gives them: a null or empty text is its end token only, repeated
    rows take places of their own, a null doc_id passes through, an empty
    table gives no places."""
    return pack(docs, vocabulary())


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

# Tokens, MinHash classes and edit matches have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each one's result is
    written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, "bourse", "pipeline", name.replace(" ", "_"))
        with scratch(spark):  # what the stage has staged goes once its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
