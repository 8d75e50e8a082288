"""What the plans must look like: pruned scans, pushed filters, no Python, no needless shuffle of the target."""

import re

import pytest

from objsync.operators import keymap, results, write
from objsync.plans.queries import CATALOG

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def whole_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cursor_and_filter_reach_the_scan(spark):
    text = plan(CATALOG["extract_filter_incremental"](spark, SF))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "EqualTo(o_orderstatus,O)" in pushed and "GreaterThan(o_orderdate" in pushed
    assert re.search(r"ReadSchema: struct<(.*?)>", text).group(1).count(":") == 3 and "Sort" not in text


def test_parent_lookup_reads_only_used_columns(spark):
    text = plan(CATALOG["extract_relationship"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert sorted(s.count(":") for s in schemas) == [2, 3, 3] and text.count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("name", ["resolve_keys", "upsert_merge", "delete_by_key", "merge_sync", "flow_flagship"])
def test_core_operators_stay_in_the_jvm(spark, name):
    text = plan(CATALOG[name](spark, SF))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text and "Window" not in text


def test_small_batch_leaves_the_target_unshuffled(spark, folder):
    target = spark.range(0, 1000, 1, 4).selectExpr("id k", "cast(id as string) v")
    target.write.parquet(f"{folder}/t")
    target.limit(5).write.parquet(f"{folder}/b")
    target, batch = spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/b")
    text = plan(write.upsert(target, batch, "k", target_unique=True).table)
    above = text[: text.index("/t]")]
    assert "BroadcastHashJoin" in above and "Exchange hashpartitioning" not in above


def test_large_batch_shuffles_each_side_once_by_key(spark, folder):
    """Beyond the broadcast limit: the target by rows once, and by key only once for the check."""
    target = spark.range(0, 1000, 1, 4).selectExpr("id k", "cast(id as string) v")
    target.write.parquet(f"{folder}/t")
    target.limit(500).write.parquet(f"{folder}/b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = write.upsert(spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/b"), "k").table
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        scans = re.findall(r"InMemoryFileIndex\(1 paths\)\[file:\S*/(t|b)\].*?ReadSchema: struct<(.*?)>", final)
        assert sorted(scans) == [("b", "k:bigint"), ("b", "k:bigint,v:string"), ("t", "k:bigint"), ("t", "k:bigint,v:string")]
        assert "ReusedExchange" in final and "BroadcastExchange" not in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keep_last_reduces_before_the_shuffle(spark):
    text = plan(CATALOG["stream_sync"](spark, SF).groupBy("user_id").agg({"ts": "max"}))
    assert "partial_max" in text
    text = plan(CATALOG["keymap_merge"](spark, SF))
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning")


@pytest.mark.parametrize("case", ["resolve", "split", "label", "upsert", "cells", "delete"])
def test_a_hot_key_is_split(spark, folder, case):
    """Beyond the broadcast limit, with low thresholds: the rows of a hot key go to several tasks."""
    spark.range(0, 40_000, 1, 8).selectExpr("if(id % 2 = 0, 'hot', concat('k', id)) k", "id v", "uuid() pad").write.parquet(f"{folder}/r")
    spark.range(0, 21_000).selectExpr("if(id = 0, 'hot', concat('k', id)) key", "cast(id as string) Id").write.parquet(f"{folder}/m")
    many, few = spark.read.parquet(f"{folder}/r"), spark.read.parquet(f"{folder}/m")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name) for name in conf if name != "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        if case == "resolve":
            df = keymap.resolve_keys(many, few, "k")
        elif case == "split":
            df = keymap.split_resolved(many, few, "k")[0]
        elif case == "label":
            df = results.label_errors(many, [], ["k"])
        elif case == "delete":
            df = write.delete_by_key(many, few.selectExpr("key k"), "k").table
        elif case == "upsert":
            df = write.upsert(many.limit(0), many, "k").rejects
        else:
            df = write.upsert(many, few.selectExpr("key k", "cast(Id as long) v"), "k").table
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "SortMergeJoin(skew=true)" in plan(df)
    finally:
        for name in conf:
            spark.conf.set(name, before[name]) if name in before else spark.conf.unset(name)
