"""Bronze documents -> the validated silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.functions import MARKET_ZONE, epoch_ms_to_date
from bourse.schemas import SILVER

# Provider field -> silver column (fixed values).
FIELD_NAMES = {
    "c": "close",
    "h": "high",
    "l": "low",
    "n": "trades",
    "o": "open",
    "v": "volume",
    "vw": "volume_weighted_average_price",
}


def explode_results(bronze: DataFrame, carry=()) -> DataFrame:
    """One row per bar. Documents with a missing or empty ``results``
    produce no row (see ``quality.missing_results`` to report them).
    ``carry`` names further document columns to keep."""
    return bronze.select("ticker", "ingested_at", *carry, F.explode("results").alias("bar"))


def flatten_bars(exploded: DataFrame, zone: str = MARKET_ZONE, carry=()) -> DataFrame:
    """P2 + P3: struct fields -> named columns, bar start -> trading date in
    ``zone`` (a provider's daily bar starts at midnight market time)."""
    cols = [F.col(f"bar.{k}").alias(v) for k, v in FIELD_NAMES.items()]
    return exploded.select(
        "ticker", *cols, "ingested_at", *carry,
        epoch_ms_to_date(F.col("bar.t"), zone).alias("date"))


def attach_company(bars: DataFrame, company_map: DataFrame) -> DataFrame:
    """LEFT join ``ticker = symbol``; unknown tickers keep a NULL name.

    No hint: Spark broadcasts the map when its size estimate is small and
    falls back to a shuffle join (AQE splits a hot ticker) when it is not.
    """
    m = company_map.select(F.col("symbol").alias("_sym"), "company_name")
    return bars.join(m, bars["ticker"] == m["_sym"], "left").drop("_sym")


def select_silver(df: DataFrame, carry=()) -> DataFrame:
    """P5: exactly the silver columns, in order, with silver types (and the
    columns of ``carry`` after them)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER.fields], *carry)


def keep_latest(silver: DataFrame, keys=("date", "ticker")) -> DataFrame:
    """When a ticker was landed more than once, keep per key the row of
    the latest ingest (ties: the larger row). An aggregate, so it runs with
    a partial step and never gathers a whole ticker in one task."""
    keys = list(keys)
    rest = [c for c in silver.columns if c not in keys]
    latest = F.max(F.struct("ingested_at", *[c for c in rest if c != "ingested_at"]))
    return silver.groupBy(*keys).agg(latest.alias("_r")) \
                 .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]) \
                 .select(*silver.columns)


def to_silver(bronze: DataFrame, company_map: DataFrame, zone: str = MARKET_ZONE,
              keep: str = "strict") -> DataFrame:
    """B1 transform: explode -> company -> flatten -> date -> silver columns.

    ``keep="latest"`` resolves re-landed tickers (D16); the default keeps
    every row so that ``quality.assert_primary_key`` reports duplicates.
    """
    if keep not in ("strict", "latest"):
        raise ValueError("keep must be 'strict' or 'latest'")
    out = silver_rows(bronze, company_map, zone)
    return keep_latest(out) if keep == "latest" else out


def silver_rows(bronze: DataFrame, company_map: DataFrame, zone: str = MARKET_ZONE, carry=()) -> DataFrame:
    """The rows of ``to_silver`` before re-landings are resolved."""
    flat = flatten_bars(explode_results(bronze, carry), zone, carry)
    return select_silver(attach_company(flat, company_map), carry)
