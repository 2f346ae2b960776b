"""Readers with explicit schemas (no inference pass over the data)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bourse.functions import ingest_epoch_from_path, parse_range
from bourse.operators.quality import assert_not_empty
from bourse.schemas import BRONZE_READ, CALENDAR, CORRUPT, SYMBOLS
from bourse.sinks import versions


def _csv_by_header(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header row, columns taken by header name (not position) and
    cast to ``schema``; a missing column is an error."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_company_map(spark: SparkSession, path: str) -> DataFrame:
    """S3: symbol -> company_name CSV with a header row (any column order)."""
    return _csv_by_header(spark, path, SYMBOLS)


def read_symbols(spark: SparkSession, path: str, check_empty: bool = True) -> DataFrame:
    """The distinct symbols of a symbol CSV. Stays a DataFrame."""
    df = read_company_map(spark, path)
    if check_empty:
        assert_not_empty(df, f"symbol list {path}")
    return df.select("symbol").distinct()


def read_bronze(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """Bronze documents -> (ticker, results, ingested_at, source_file,
    results_count, corrupt).

    Nothing vanishes: a document that does not parse, or that has a field
    that does not fit the schema, keeps its text in ``corrupt``
    (``quality.corrupt_documents`` lists them). ``results_count`` is the
    provider's own count, or NULL.

    ``multi_line=False`` reads JSON Lines (splittable unless compressed;
    what ``land_bronze`` writes, with gzip). Use ``True`` for files that each hold one pretty-printed
    document: on a JSON Lines file it silently keeps only the first record.
    ``ingested_at`` comes from the file path (P4): ``{ticker}_{epoch}.json``
    or an ``ingest={epoch}`` folder. ``path`` may be a list of folders; of a
    versioned one (``land_bronze``) the current version is read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return read_bronze_files(spark, [f for p in paths for f in versions.folders(spark, p)], multi_line)


def read_bronze_files(spark: SparkSession, files: list[str], multi_line: bool = False) -> DataFrame:
    """``read_bronze`` of files or folders as they stand, whatever version
    they belong to."""
    raw = spark.read.schema(BRONZE_READ).option("multiLine", multi_line).option("recursiveFileLookup", True) \
               .option("columnNameOfCorruptRecord", CORRUPT).json(files)
    src = F.col("_metadata.file_path")
    return raw.select(
        "ticker", "results",
        F.timestamp_seconds(ingest_epoch_from_path(src)).alias("ingested_at"),
        src.alias("source_file"), F.col("resultsCount").alias("results_count"),
        F.col(CORRUPT).alias("corrupt"))


def bronze_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(source_file, changed, length) of the files in bronze folders; their
    contents are not read."""
    meta = {"source_file": "file_path", "changed": "file_modification_time", "length": "file_size"}
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,json.gz}") \
                .load(list(folders)).select(*[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()])


def read_silver(spark: SparkSession, path: str, dates=None) -> DataFrame:
    """The silver Parquet table, optionally cut to a date range.

    Of a table written with ``write_silver(partition_by="year")`` only the
    parts of the range's years are opened. Any other Parquet folder is read
    as it is; a ``year`` partition column is used to prune and dropped, so
    the result has the silver schema either way.
    """
    rng = parse_range(dates)
    version = versions.current(spark, path)
    if version is None:
        df = spark.read.parquet(path)
        if "year" in df.columns:
            df = df if rng is None else df.filter(F.col("year").between(rng[0].year, rng[1].year))
            df = df.drop("year")
    else:
        schema = StructType.fromJson(json.loads(version.notes["schema"]))
        parts = [folder for name, folder in version.parts if rng is None or _may_hold(name, rng)]
        df = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*parts) if parts \
            else spark.createDataFrame([], schema)
    return df if rng is None else df.filter(F.col("date").between(F.lit(rng[0]), F.lit(rng[1])))


def _may_hold(part: str, rng) -> bool:
    """Whether a part may hold dates of the range."""
    year = part.removeprefix("year=")
    return part == "all" or year != "" and rng[0].year <= int(year) <= rng[1].year


def read_calendar(spark: SparkSession, path: str, dates=None, fmt: str = "csv") -> DataFrame:
    """Calendar (date, weeknum, year), optionally cut to a date range."""
    if fmt == "csv":
        raw = spark.read.option("header", True).csv(path)
        df = raw.select(F.to_date("date", "yyyy-MM-dd").alias("date"),
                        F.col("weeknum").cast("int").alias("weeknum"),
                        F.col("year").cast("int").alias("year"))
    else:
        df = spark.read.schema(CALENDAR).parquet(path)
    rng = parse_range(dates)
    if rng is not None:
        df = df.filter(F.col("date").between(F.lit(rng[0]), F.lit(rng[1])))
    return df.select("date", "weeknum", "year")
