"""Several order columns as one number that sorts as they do.

Spark aggregates by hash only if every buffer has a fixed width. ``min_by``
over a struct has none and sorts each task's rows; over one DECIMAL(38) it
needs no sort.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, IntegerType, LongType, ShortType,
                               StructType, TimestampNTZType, TimestampType)

# Digits that a column's values take, and what makes its least value 1 (null
# is 0 and sorts first, as in a struct). Times are those of the years 1 to
# 9999, in microseconds (fixed values).
_YEAR_1 = 62_135_596_800_000_000
_WIDTH = {BooleanType: (1, 1), ByteType: (3, 2**7 + 1), ShortType: (5, 2**15 + 1), IntegerType: (10, 2**31 + 1), DateType: (10, 2**31 + 1),
          LongType: (20, 2**63 + 1), TimestampType: (18, _YEAR_1 + 1), TimestampNTZType: (18, _YEAR_1 + 1)}
_MOST = 38


def _whole(name: str, kind: DataType) -> Column:
    """A column's value as a whole number."""
    value = F.col(name)
    if isinstance(kind, TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, TimestampNTZType):  # by its own clock, whatever the session's zone
        return ((value - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).cast("decimal(18,6)") * 1_000_000).cast("decimal(18,0)")
    return F.unix_date(value) if isinstance(kind, DateType) else value.cast("long")


def order_key(columns: list[str], schema: StructType) -> Column:
    """One column that sorts as ``columns`` do, one after the other: the
    column itself, a DECIMAL(38) if all together fit, or else a struct."""
    if len(columns) == 1:
        return F.col(columns[0])
    kinds = [schema[c].dataType for c in columns]
    if any(type(k) not in _WIDTH for k in kinds) or sum(_WIDTH[type(k)][0] for k in kinds) > _MOST:
        return F.struct(*columns)
    key = None
    for name, kind in zip(columns, kinds):
        digits, least = _WIDTH[type(kind)]
        part = F.coalesce(_whole(name, kind).cast("decimal(20,0)") + F.lit(Decimal(least)), F.lit(Decimal(0))).cast(f"decimal({digits},0)")
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            part = F.when(part >= 0, part).otherwise(F.raise_error(F.lit(f"{name} lies before the year 1")))
        key = part if key is None else (key.cast(f"decimal({_MOST},0)") * F.lit(Decimal(10**digits)) + part).cast(f"decimal({_MOST},0)")
    return key
