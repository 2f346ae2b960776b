"""Fixed schemas of every boundary: symbols, bronze documents, silver, calendar."""

from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampType)

# Symbol list / company map CSV (header row).
SYMBOLS = StructType([
    StructField("symbol", StringType()),
    StructField("company_name", StringType()),
])

# One bar inside a bronze document, provider field names:
# c close, h high, l low, n trades, o open, t bar start (epoch ms),
# v volume, vw volume-weighted average price.
BRONZE_BAR = StructType([
    StructField("c", DoubleType()),
    StructField("h", DoubleType()),
    StructField("l", DoubleType()),
    StructField("n", LongType()),
    StructField("o", DoubleType()),
    StructField("t", LongType()),
    StructField("v", DoubleType()),
    StructField("vw", DoubleType()),
])

# A bronze document. Other top-level provider fields are ignored on read.
BRONZE = StructType([
    StructField("ticker", StringType()),
    StructField("resultsCount", LongType()),
    StructField("results", ArrayType(BRONZE_BAR)),
])

# Column that keeps the text of a document that did not parse or did not fit.
CORRUPT = "_corrupt_record"
BRONZE_READ = StructType([*BRONZE.fields, StructField(CORRUPT, StringType())])

# Silver table, in order; primary key (date, ticker).
SILVER = StructType([
    StructField("ticker", StringType()),
    StructField("company_name", StringType()),
    StructField("close", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("trades", LongType()),
    StructField("open", DoubleType()),
    StructField("volume", DoubleType()),
    StructField("volume_weighted_average_price", DoubleType()),
    StructField("ingested_at", TimestampType()),
    StructField("date", DateType()),
])
SILVER_KEY = ["date", "ticker"]

# ISO calendar: week number and ISO year of every day.
CALENDAR = StructType([
    StructField("date", DateType()),
    StructField("weeknum", IntegerType()),
    StructField("year", IntegerType()),
])
