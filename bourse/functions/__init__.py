"""Column expressions. All are built-in Spark functions (JVM side, codegen)."""

from bourse.functions.dates import (FIXED_SPAN_SECONDS, MARKET_ZONE, MONDAY_OFFSET_SECONDS,
                                    bucket_key, bucket_key_start, bucket_start, epoch_ms_to_date,
                                    epoch_ms_to_local, in_time_range, ingest_epoch_from_path,
                                    iso_week, iso_year, local_to_epoch_ms,
                                    normalise_span, parse_range, wall_clock)
from bourse.functions.numeric import round_half, safe_div
from bourse.functions.ordering import order_key

__all__ = [
    "FIXED_SPAN_SECONDS", "MARKET_ZONE", "MONDAY_OFFSET_SECONDS", "normalise_span",
    "bucket_key", "bucket_key_start", "bucket_start", "epoch_ms_to_date", "epoch_ms_to_local",
    "in_time_range", "ingest_epoch_from_path", "iso_week", "iso_year", "local_to_epoch_ms",
    "order_key", "parse_range", "round_half", "safe_div", "wall_clock",
]
