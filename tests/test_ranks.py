"""Places in a sorted order: against Python's sort, ties, nulls, hot groups."""

from collections import Counter

from pyspark.sql import functions as F

from bourse.operators.ranks import places


def test_total_order_and_groups(spark):
    rows = [(k % 3 if k % 7 else None, (k * 37) % 101) for k in range(500)]
    df = spark.createDataFrame(rows, "g int, x int").repartition(5)
    total = places(df, [F.desc("x"), F.asc("g")]).collect()
    assert sorted(r.place for r in total) == list(range(1, 501))
    by_place = sorted(total, key=lambda r: r.place)
    assert [r.x for r in by_place] == sorted((x for _, x in rows), reverse=True)
    inside = places(df, [F.asc("x")], ["g"]).collect()
    for g, n in Counter(g for g, _ in rows).items():
        own = sorted((r for r in inside if r.g == g), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(1, n + 1))
        assert [r.x for r in own] == sorted(x for k, x in rows if k == g)


def test_hot_group_spans_partitions(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("g"), F.col("id").alias("x"))
    out = places(df, [F.asc("x")], ["g"])
    assert out.filter("place <> x + 1").count() == 0
    # The only window is over counts: a row for each partition and group.
    p = out._jdf.queryExecution().executedPlan().toString()
    windows = p.split("Window [")[1:]
    assert len(windows) == 1 and "count(1)" in windows[0]


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], "x int, place2 int")
    assert places(df, [F.asc("x")]).count() == 0
    odd = spark.createDataFrame([(1, 2)], "`a.b` int, r int")
    assert places(odd, [F.asc("r")], ["r"]).columns == ["a.b", "r", "place"]
