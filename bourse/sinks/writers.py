"""Writers for every layer (K1-K4)."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from bourse.functions import MARKET_ZONE, parse_range
from bourse.operators.bars import bronze_documents
from bourse.sinks import versions


def bronze_folder(root: str, dates=None) -> str:
    """Folder of one landed range: ``{root}/{start}_{end}``, or
    ``{root}/all`` for documents that cover no declared range."""
    rng = parse_range(dates)
    name = "all" if rng is None else f"{rng[0].isoformat()}_{rng[1].isoformat()}"
    return f"{root.rstrip('/')}/{name}"


def land_bronze(bars: DataFrame, root: str, dates=None, zone: str = MARKET_ZONE,
                period: str = "month", symbols: DataFrame | None = None,
                ingest_epoch: int | None = None, mode: str = "overwrite") -> str:
    """K1: write bars as bronze documents (JSON Lines, gzip) and return the folder.

    Each landing is a part of its own below the range folder
    (``bronze_folder``, ``sinks.versions``):
    ``_versions/{number}-{id}/ingest={epoch}/part-*.json.gz``. ``dates`` names
    the range folder; cut the ticks to the range before resampling
    (``ticks_in_range``), so partial first and last bars hold only in-range
    ticks. ``mode="overwrite"`` makes this landing the only part of the next
    version, so landing a range again never leaves a second copy of a
    ticker; ``mode="append"`` adds it to the parts there are (a re-landing,
    resolved by ``keep="latest"``). Readers see the earlier version until
    the new one is complete.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    folder = bronze_folder(root, dates)
    epoch = int(time.time()) if ingest_epoch is None else int(ingest_epoch)
    docs = bronze_documents(bars, zone=zone, period=period, symbols=symbols)
    land_documents(docs, folder, epoch, mode)
    return folder


def land_documents(docs: DataFrame, folder: str, ingest_epoch: int, mode: str = "overwrite") -> None:
    """Write ready documents (``bronze_documents``) as one ingest of a range folder.

    Field names and equal digits are most of a document's bytes, so files are
    compressed. A reader takes a gzip file in one task: there are as many as
    tasks that wrote.
    """
    spark = docs.sparkSession
    base = versions.current(spark, folder)
    part = f"{versions.new_folder(folder, base)}/ingest={ingest_epoch}"
    docs.withColumn("period", F.col("period").cast("string")).write.option("zlib.compress.level", "BEST_SPEED") \
        .json(part, compression="gzip")
    kept = base.parts if base and mode == "append" else ()
    versions.publish(spark, folder, base, [*kept, (f"ingest={ingest_epoch}", part)])


def land_provider_documents(bars: DataFrame, root: str, dates=None, zone: str = MARKET_ZONE,
                            ingest_epoch: int | None = None) -> str:
    """K1 in the provider's own layout, and the folder: one pretty-printed
    document for each ticker, ``{root}/{start}_{end}/{ticker}_{epoch}.json``
    (read with ``multi_line=True``).

    Spark writes each document to a file of its own in a hidden folder; only
    the renaming runs on the driver, file by file. A document holds all bars
    of its ticker in the range, as a provider answers: for day bars or
    coarser. Landing again adds files beside the earlier ones.
    """
    folder = bronze_folder(root, dates)
    epoch = int(time.time()) if ingest_epoch is None else int(ingest_epoch)
    spark = bars.sparkSession
    years = bronze_documents(bars, zone=zone, period="year")
    docs = years.groupBy("ticker").agg(F.sum("resultsCount").alias("n"), F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("period", "results"))), lambda d: d["results"])).alias("results"))
    document = F.struct("ticker", F.col("n").alias("queryCount"), F.col("n").alias("resultsCount"), F.lit(True).alias("adjusted"),
                        "results", F.lit("OK").alias("status"))
    hidden = f"{folder}/_landing-{uuid.uuid4().hex[:12]}"
    docs.select(F.concat("ticker", F.lit(f"_{epoch}.json")).alias("file"), F.to_json(document, {"pretty": "true"}).alias("value")) \
        .repartition("file").write.partitionBy("file").text(hidden)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(conf)
    for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(hidden).select("path").collect():
        name = r.path.rsplit("/", 2)[1].removeprefix("file=")
        store.rename(path(r.path), path(f"{folder}/{name}"))
    return folder


def write_silver(df: DataFrame, path: str, partition_by=None, only_years=None, notes: dict | None = None) -> None:
    """K2: Parquet, as the next version of the table (``sinks.versions``).
    Call only after validation passed.

    ``partition_by="year"`` writes a part for each calendar year of ``date``,
    so that date-range reads open only the years they need
    (``read_silver(dates=...)``). With ``only_years`` (a set; None for rows
    without a date) ``df`` holds all rows of those years and replaces them;
    the other years' parts are kept as they are. Else the whole table is
    replaced. ``notes`` are kept with the version.
    """
    spark = df.sparkSession
    base = versions.current(spark, path)
    folder = versions.new_folder(path, base)
    notes = {**(notes or {}), "schema": df.schema.json()}
    if partition_by is None:
        df.write.parquet(folder)
        versions.publish(spark, path, base, [("all", folder)], notes)
        return
    if partition_by != "year":
        raise ValueError("partition_by must be None or 'year'")
    # Few files a folder, and rows of a ticker side by side.
    df.withColumn("year", F.year("date")).hint("rebalance", "year").sortWithinPartitions("year", "ticker", "date") \
        .write.partitionBy("year").parquet(folder)
    years = spark.read.schema(StructType([*df.schema.fields, StructField("year", IntegerType())])).parquet(folder) \
                 .select("year").distinct().orderBy("year").collect()  # from folder names
    written = [("year=", f"{folder}/year=__HIVE_DEFAULT_PARTITION__") if r.year is None
               else (f"year={r.year}", f"{folder}/year={r.year}") for r in years]
    kept = []
    if only_years is not None and base:
        replaced = {f"year={'' if y is None else y}" for y in only_years}
        kept = [p for p in base.parts if p[0] not in replaced]
    versions.publish(spark, path, base, [*kept, *written], notes)


def write_gold(df: DataFrame, path: str, single_file: bool = False) -> None:
    """K3: CSV with header, overwrite. ``single_file`` coalesces to one task:
    use it only for results whose size is bounded (top-k, one row, per year)."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite") \
        .option("header", True).csv(path)


def write_calendar(df: DataFrame, csv_path: str | None = None,
                   parquet_path: str | None = None) -> None:
    """K4: the calendar as CSV (ISO dates, header) and/or Parquet."""
    if csv_path:
        df.write.mode("overwrite").option("header", True) \
          .option("dateFormat", "yyyy-MM-dd").csv(csv_path)
    if parquet_path:
        df.write.mode("overwrite").parquet(parquet_path)
