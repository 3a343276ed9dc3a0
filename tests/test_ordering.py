"""O1-O3: places in a global order."""

import random

from pyspark.sql import functions as F

from ledgerlens.operators.ordering import with_position


def test_positions_follow_the_order(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), i, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int, position string").repartition(7)
    out = with_position(df, F.col("a").desc_nulls_last(), F.col("b").asc()).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = {r["position"]: (r["a"], r["b"]) for r in out}
    assert [got[i + 1] for i in range(len(rows))] == [w[:2] for w in want]


def test_ties_get_places_of_their_own(spark):
    df = spark.createDataFrame([(1, "p"), (1, "p"), (0, "p"), (1, "q")], "a int, k string").repartition(3)
    out = sorted(r["place"] for r in with_position(df, F.col("a").asc(), name="place").collect())
    assert out == [1, 2, 3, 4]


def test_empty(spark):
    df = spark.createDataFrame([], "a int")
    out = with_position(df, F.col("a").asc())
    assert out.columns == ["a", "position"] and out.count() == 0


def test_no_task_orders_all_rows(spark):
    df = spark.range(1000).repartition(4)
    text = with_position(df, F.col("id").desc())._jdf.queryExecution().toString()
    assert "Window" not in text and "SinglePartition" not in text
