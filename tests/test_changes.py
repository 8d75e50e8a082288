"""Change folders: small batches by key written alone, merged on read and folded in by compaction."""

import pytest
from pyspark.sql import functions as F

from objsync.config import TargetConfig
from objsync.plans.flow import Flow
from objsync.plans.store import VersionedTable
from objsync.streaming.sync import apply_changes
from tests.conftest import rows


def start(spark, folder, buckets):
    table = VersionedTable(spark, folder, ["k"], buckets=buckets)
    table.append(spark.range(1000).selectExpr("id k", "0 at", "'old' v"))
    return table, {k: (0, "old") for k in range(1000)}


def batch(spark, number):
    keys = [(k * 37 + number * 11) % 1200 for k in range(100)]
    data = [(k, (number * 7 + k) % 13, f"b{number}") for k in dict.fromkeys(keys)]
    return data, spark.createDataFrame(data, "k bigint, at int, v string")


def merge(held, data):
    for k, at, v in data:
        if k not in held or (at, v) >= held[k]:
            held[k] = (at, v)


@pytest.mark.parametrize("buckets", [0, 8])
def test_ten_batches_before_and_after_compaction(spark, folder, buckets):
    table, held = start(spark, folder, buckets)
    for number in range(10):
        data, df = batch(spark, number)
        assert apply_changes(table, df, number, "s", ["at", "v"], compact_after=99)
        merge(held, data)
        written = spark.read.parquet(f"{folder}/{table.current().changes[-1][0]}").count()
        assert written == len(data)
    want = sorted((k, at, v) for k, (at, v) in held.items())
    assert sorted(map(tuple, table.read().collect())) == want
    commit = table.compact()
    assert commit.changes == () and commit.state["stream:s"] == 9
    assert sorted(map(tuple, table.read().collect())) == want
    assert table.compact().version == commit.version
    assert table.expire() > 10 and sorted(map(tuple, table.read().collect())) == want


def test_compaction_comes_by_itself(spark, folder):
    table, held = start(spark, folder, 8)
    for number in range(7):
        data, df = batch(spark, number)
        apply_changes(table, df, number, "s", ["at", "v"], compact_after=3)
        merge(held, data)
        assert len(table.current().changes) < 3
    assert sorted(map(tuple, table.read().collect())) == sorted((k, *v) for k, v in held.items())


def test_other_writes_beside_changes(spark, folder):
    table, held = start(spark, folder, 8)
    data, df = batch(spark, 1)
    apply_changes(table, df, 0, "s", ["at", "v"])
    merge(held, data)
    # An upsert sees the changes and holds against them, though its order is lower.
    Flow("x", spark.createDataFrame([(data[0][0], -5, "set"), (5000, 1, "new")], "k bigint, at int, v string"),
         TargetConfig("T", "merge", primary_key="k")).run(spark, table)
    held[data[0][0]], held[5000] = (-5, "set"), (1, "new")
    assert sorted(map(tuple, table.read().collect())) == sorted((k, *v) for k, v in held.items())
    table.append(spark.createDataFrame([(6000, 1, "more", 7)], "k bigint, at int, v string, extra int"))
    assert table.read().count() == len(held) + 1 and rows(table.read().filter("k = 6000")) == [(6000, 1, "more", 7)]
    with pytest.raises(ValueError, match="compact it first"):
        table.prepare_change(df.withColumn("extra", F.lit(1)), ["v"])
    table.compact()
    assert table.read().count() == len(held) + 1
    table.replace(df)
    assert table.current().changes == () and table.read().count() == len(data)


def test_a_read_does_not_shuffle_the_buckets(spark, folder):
    table, _ = start(spark, folder, 4)
    _, df = batch(spark, 1)
    apply_changes(table, df, 0, "s", ["at", "v"])
    text = table.read()._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
