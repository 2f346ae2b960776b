"""Places in a sorted order, without a window over all rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bourse.session import staged


def places(df: DataFrame, order: list[Column], within: list[str] | None = None, name: str = "place") -> DataFrame:
    """``df`` with the place (from 1) of each row in ``order``, counted over
    all rows or within each group of equal ``within`` columns (nulls are a
    group).

    Rows are range-partitioned by group and order, so a large group spans
    many partitions. A row's place is the number of its group's rows in
    earlier partitions plus its place inside its own. Only one count for each
    partition and group meets in a window. Rows that tie in ``order`` get
    different places, in no defined order. The sorted rows are written to the
    shared folder once, as all counts must see one partitioning; an empty
    frame stays empty. Columns called ``_id``, ``_part`` or ``_before`` are
    not allowed.
    """
    within = list(within or [])
    by = [*[F.col(c).asc() for c in within], *order]
    rows = staged(df.repartitionByRange(*by).sortWithinPartitions(*by)
                  .withColumn("_id", F.monotonically_increasing_id()), "places")
    # The id holds the partition above its lowest 33 bits, the row's number in it below.
    part = F.shiftright("_id", 33).alias("_part")
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*within, part).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")) \
        .select(*within, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_before"))
    same = [F.col(f"r.`{c}`").eqNullSafe(F.col(f"o.`{c}`")) for c in within]
    return rows.withColumn("_part", part).alias("r") \
        .join(counts.alias("o"), [F.col("r._part") == F.col("o._part"), *same]) \
        .select(*[F.col(f"r.`{c}`") for c in df.columns], (F.col("r._id") + F.col("o._before")).alias(name))
