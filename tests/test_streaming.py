"""Streaming ingestion equals the batch transforms on the same input."""

import os

from pyspark.sql import functions as F

from bourse.operators.bars import resample_bars
from bourse.operators.silver import to_silver
from bourse.session import shared_dir
from bourse.sinks import land_bronze
from bourse.sources import fixtures as fx
from bourse.sources.readers import read_bronze
from bourse.streaming import bars_stream, silver_stream
from bourse.streaming.ingest import complete_bars, latest_silver, open_bars
from tests.conftest import SF0001, rows


def test_silver_stream_equals_batch(spark):
    bars = fx.order_bars(spark, SF0001)
    root = shared_dir(spark, "t", "stream")
    folder = land_bronze(bars, f"{root}/bronze", zone="UTC", ingest_epoch=1_700_000_000)
    cmap = fx.company_map(spark, SF0001)
    q = silver_stream(spark, folder, cmap, f"{root}/silver", f"{root}/ckpt", zone="UTC")
    q.awaitTermination(300)
    got = spark.read.parquet(f"{root}/silver")
    want = to_silver(read_bronze(spark, folder), cmap, zone="UTC")
    assert rows(got.drop("ingested_at")) == rows(want.drop("ingested_at"))
    # a restart with nothing new adds nothing
    q = silver_stream(spark, folder, cmap, f"{root}/silver", f"{root}/ckpt", zone="UTC")
    q.awaitTermination(300)
    assert spark.read.parquet(f"{root}/silver").count() == want.count()


def test_relanding_leaves_one_row_for_each_key(spark):
    root = shared_dir(spark, "t", "stream")
    bars = fx.order_bars(spark, SF0001)
    cmap = fx.company_map(spark, SF0001)
    for epoch, add in ((100, 0), (200, 1)):
        folder = land_bronze(bars.withColumn("close", F.col("close") + add), f"{root}/bronze", zone="UTC",
                             ingest_epoch=epoch, mode="append")
        silver_stream(spark, folder, cmap, f"{root}/silver", f"{root}/ckpt", zone="UTC").awaitTermination(300)
    assert spark.read.parquet(f"{root}/silver").count() == 2 * bars.count()
    got = latest_silver(spark, f"{root}/silver")
    assert got.count() == bars.count() and got.select(F.unix_seconds("ingested_at")).distinct().count() == 1
    assert got.agg(F.sum("close")).first()[0] > bars.agg(F.sum("close")).first()[0]


def test_stream_stops_at_a_corrupt_document(spark):
    import pytest
    root = shared_dir(spark, "t", "stream")
    spark.createDataFrame([('{"ticker":"A","results":[{"c":1',)], "value string").write.text(f"{root}/in/ingest=5")
    q = silver_stream(spark, f"{root}/in", fx.company_map(spark, SF0001), f"{root}/silver", f"{root}/ckpt")
    with pytest.raises(Exception, match="corrupt document"):
        q.awaitTermination(300)


def test_bars_stream_emits_closed_bars(spark):
    path = os.path.join(SF0001, "events.parquet")
    schema = spark.read.parquet(path).schema
    src = spark.readStream.schema(schema).parquet(path + "*")
    ticks = src.select(F.col("user_id").cast("string").alias("ticker"), "ts",
                       F.col("value").alias("price"))
    stream = bars_stream(ticks, multiplier=1, timespan="hour", delay="0 seconds")
    root = shared_dir(spark, "t", "bars")
    q = stream.writeStream.format("parquet").option("path", f"{root}/out") \
              .option("checkpointLocation", f"{root}/ckpt").outputMode("append") \
              .trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.read.parquet(f"{root}/out")
    batch = resample_bars(fx.event_ticks(spark, SF0001), timespan="hour")
    assert got.count() > 0
    # every emitted bar equals the batch bar; only bars still open at the
    # watermark are not emitted yet
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
    last = batch.agg(F.max("bar_start")).first()[0]
    assert batch.filter(F.col("bar_start") < last).join(got, ["ticker", "bar_start"], "left_anti") \
                .count() == 0


def test_bars_of_a_folder_table_are_complete(spark):
    """The registered query on a table kept as a folder of files."""
    from bourse.plans.registry import QUERIES
    root = shared_dir(spark, "t", "folder")
    spark.read.parquet(f"{SF0001}/events.parquet").repartition(5).write.parquet(f"{root}/events.parquet")
    got = QUERIES["bars_stream_hourly"](spark, root)
    want = resample_bars(fx.event_ticks(spark, SF0001), timespan="hour")
    assert rows(got) == rows(want.select(*got.columns))


def test_open_bars_come_from_the_state(spark):
    """With volumes, over several batches; a closed bar that the sink lacks
    isn't made up."""
    ticks = fx.event_ticks(spark, SF0001).withColumn("volume", F.abs("price") + 1)
    root = shared_dir(spark, "t", "open")
    ticks.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{root}/in")
    for schema, order, delay in ((ticks.schema, "ts", "40 days"), (ticks.schema, ["ts", "price"], "40 days"), (ticks.schema, "ts", "0 seconds")):
        out = f"{root}/{delay.replace(' ', '_')}_{len(order)}"
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4 if delay[0] == "0" else 1).parquet(f"{root}/in")
        q = bars_stream(src, volume="volume", timespan="hour", delay=delay, order_by=order).writeStream \
            .format("parquet").option("path", f"{out}/bars").option("checkpointLocation", f"{out}/ckpt") \
            .outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(300)
        want = resample_bars(ticks, volume="volume", timespan="hour", order_by=order)
        emitted = spark.read.schema(want.schema).parquet(f"{out}/bars")
        rounded = [F.round(c, 9).alias(c) for c in ("volume", "vwap")]
        keep = ["ticker", "bar_start", "open", "high", "low", "close", "trades"]
        assert rows(complete_bars(emitted, f"{out}/ckpt").select(*keep, *rounded)) == rows(want.select(*keep, *rounded))
        left = open_bars(spark, f"{out}/ckpt")
        assert left.count() == want.count() - emitted.count() > 0
        assert rows(complete_bars(emitted.limit(0), f"{out}/ckpt").select(*keep)) == rows(left.select(*keep))
        assert (emitted.count() == 0) == (delay == "40 days")


def test_state_of_another_query_is_refused(spark):
    import pytest
    root = shared_dir(spark, "t", "other")
    src = spark.readStream.schema(spark.read.parquet(f"{SF0001}/events.parquet").schema).parquet(f"{SF0001}/events.parquet*")
    q = src.groupBy(F.col("user_id").alias("ticker"), F.window(F.col("ts").cast("timestamp"), "1 hour")).count().writeStream \
        .format("memory").queryName("others").option("checkpointLocation", f"{root}/ckpt").outputMode("update") \
        .trigger(availableNow=True).start()
    q.awaitTermination(300)
    with pytest.raises(ValueError, match="no state of bars"):
        open_bars(spark, f"{root}/ckpt")


def test_bars_stream_watermark_late_ticks(spark):
    import datetime as dt
    T = dt.datetime
    root = shared_dir(spark, "t", "late")
    schema = "ticker string, ts timestamp_ntz, price double"

    def land(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/{name}")

    def run():
        src = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
        q = bars_stream(src, timespan="hour", delay="30 minutes").writeStream \
            .format("parquet").option("path", f"{root}/out") \
            .option("checkpointLocation", f"{root}/ckpt").outputMode("append") \
            .trigger(availableNow=True).start()
        q.awaitTermination(300)

    land([("A", T(2024, 1, 1, 9, 10), 10.0), ("A", T(2024, 1, 1, 9, 50), 11.0),
          ("A", T(2024, 1, 1, 10, 20), 12.0)], "b1")
    run()
    # watermark 09:50: the 09:00 bar is still open, nothing emitted yet
    assert spark.read.parquet(f"{root}/out").count() == 0
    land([("A", T(2024, 1, 1, 9, 55), 9.0),      # late but within 30 minutes: counted
          ("A", T(2024, 1, 1, 11, 40), 13.0)], "b2")
    run()
    still = {r.bar_start: r.trades for r in open_bars(spark, f"{root}/ckpt").collect()}
    assert still == {T(2024, 1, 1, 11): 1}
    out = {r.bar_start: r for r in spark.read.parquet(f"{root}/out").collect()}
    bar9 = out[T(2024, 1, 1, 9)]
    assert (bar9.open, bar9.low, bar9.close, bar9.trades) == (10.0, 9.0, 9.0, 3)
    assert T(2024, 1, 1, 10) in out and T(2024, 1, 1, 11) not in out
    land([("A", T(2024, 1, 1, 9, 58), 1.0)], "b3")   # behind the watermark: dropped
    run()
    out2 = spark.read.parquet(f"{root}/out")
    assert out2.filter(F.col("bar_start") == T(2024, 1, 1, 9)).count() == 1
    assert out2.filter(F.col("low") == 1.0).count() == 0
    assert complete_bars(out2, f"{root}/ckpt").count() == 3
