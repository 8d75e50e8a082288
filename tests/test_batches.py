"""Delivery batches of an exact size, numbered over many tasks."""

from objsync.operators.results import csv_texts, delivery_batches
from objsync.sources import files


def test_numbers_are_gapless_over_tasks(spark):
    df = spark.range(0, 2503, 1, 7).selectExpr("id k", "id % 3 row_kind")
    rows = delivery_batches(df, 100).collect()
    assert sorted(r["row"] for r in rows) == list(range(2503)) and all(r["batch"] == r["row"] // 100 for r in rows)
    by_key = delivery_batches(df.repartition(5), 100, ["k"]).collect()
    assert all(r["row"] == r["k"] for r in by_key)
    assert delivery_batches(df.limit(0)).count() == 0


def test_texts_hold_exactly_a_batch(spark):
    df = spark.range(0, 1003, 1, 6).selectExpr("id k", "if(id % 2 = 0, null, concat('a,', id, '\\n\"x')) `t\"x`")
    texts = csv_texts(df, 50, ["k"]).orderBy("batch").collect()
    assert [r["batch"] for r in texts] == list(range(21))
    back = files.normalize_chunks(csv_texts(df, 50), "body", df.columns, quoted_blank=True)
    assert sorted((int(r[0]), r[1]) for r in back.collect()) == sorted((r[0], r[1]) for r in df.collect())
    assert texts[3]["body"].split("\n")[1].startswith('"150"')


def test_a_plan_without_a_window_or_single_task(spark):
    df = spark.range(0, 1000, 1, 6).selectExpr("id k")
    text = delivery_batches(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "SinglePartition" not in text


def test_batches_leave_the_columns_of_their_input(spark):
    df = spark.range(25).withColumnRenamed("id", "n")
    batches = delivery_batches(df, batch_rows=10)
    assert batches.columns == ["n", "row", "batch"] and df.columns == ["n"] and df.schema.names == ["n"]
