import os

import pytest
from pyspark.sql import functions as F

from objsync.config import ResourceConfig, TargetConfig
from objsync.operators import mapping as mp
from objsync.plans.flow import Flow, Staging, sync
from objsync.plans.incremental import state_frame
from objsync.plans.store import VersionedTable
from objsync.sources.objects import ObjectStore
from objsync.streaming.sync import apply_changes, file_feed, start_sync
from tests.conftest import rows


def frame(spark, *data):
    return spark.createDataFrame(data, "k string, v int")


@pytest.mark.parametrize("buckets", [0, 4])
def test_commits_and_reads(spark, folder, buckets):
    table = VersionedTable(spark, f"{folder}/t", ["k"] if buckets else (), buckets)
    assert table.current() is None and table.state == {}
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(frame(spark, ("a", 1), ("b", 2)), cursor="5")
    table.append(frame(spark, ("c", 3)).withColumn("extra", F.lit("x")), note="n")
    assert table.current().version == 2 and table.state == {"cursor": "5", "note": "n"}
    assert rows(table.read()) == [("a", 1, None), ("b", 2, None), ("c", 3, "x")]
    old = table.current()
    table.replace(table.read().filter("k <> 'a'"))  # reads what it replaces
    assert rows(table.read().select("k")) == [("b",), ("c",)]
    assert table.read(at=old).count() == 3


def test_second_commit_of_a_version_is_refused(spark, folder):
    table = VersionedTable(spark, folder)
    table.append(frame(spark, ("a", 1)))
    with pytest.raises(Exception, match="already exists"):
        table._publish(table.current())
    assert table.current().version == 1


def test_an_update_of_an_outdated_version_is_refused(spark, folder):
    table = VersionedTable(spark, folder)
    base = table.append(frame(spark, ("a", 1)))
    table.append(frame(spark, ("b", 2)))
    with pytest.raises(Exception, match="already exists"):
        table.replace(table.read(at=base).withColumn("v", F.lit(9)), base=base)
    assert rows(table.read()) == [("a", 1), ("b", 2)]


def test_failed_write_commits_nothing(spark, folder):
    table = VersionedTable(spark, folder)
    table.append(frame(spark, ("a", 1)))
    with pytest.raises(Exception):
        table.replace(frame(spark, ("b", 2)).withColumn("v", F.raise_error(F.lit("boom"))))
    assert rows(table.read()) == [("a", 1)]


def test_the_layout_is_kept(spark, folder):
    table = VersionedTable(spark, folder, ["k"], 4)
    table.append(frame(spark, ("a", 1), ("b", 2)))
    opened = VersionedTable(spark, folder)
    assert opened.keys == ["k"] and opened.rule == table.rule
    with pytest.raises(ValueError, match="buckets by"):
        VersionedTable(spark, folder, ["k"], 8)


def test_a_rule_keeps_neighbouring_keys_together(spark, folder):
    table = VersionedTable(spark, folder, ["id"], bucket_by="id div 100")
    table.append(spark.range(1000).withColumn("v", F.lit(0)).union(spark.createDataFrame([(None, 0)], "id long, v int")))
    before = dict(table.current().folders)
    assert sorted(before) == [-1, *range(10)]
    merge = TargetConfig("t", "merge", primary_key="id")
    Flow("t", spark.range(20, 60).withColumn("v", F.lit(1)), merge).run(spark, table)
    after = dict(table.current().folders)
    assert [b for b in after if after[b] != before[b]] == [0] and table.read().count() == 1001


def test_buckets_need_keys(spark, folder):
    with pytest.raises(ValueError):
        VersionedTable(spark, folder, buckets=4)


def test_only_touched_buckets_are_rewritten(spark, folder):
    table = VersionedTable(spark, folder, ["id"], 16)
    table.append(spark.range(1000).withColumn("v", F.lit(0)))
    before = dict(table.current().folders)
    merge = TargetConfig("t", "merge", primary_key="id")
    Flow("t", spark.range(3).select(F.col("id").cast("int"), F.lit(1).alias("v")), merge).run(spark, table)
    after = dict(table.current().folders)
    changed = {b for b in after if after[b] != before[b]}
    assert 1 <= len(changed) <= 3 and len(after) == len(before)
    assert table.read().count() == 1000 and table.read().filter("v = 1").count() == 3


def test_upsert_flow_reports_and_writes_rejects(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    target = TargetConfig("Thing", "upsert", primary_key="k")
    first = Flow("things", frame(spark, ("a", 1), ("b", 2), ("b", 3), (None, 4)), target)
    result = first.run(spark, table, rejects_root=f"{folder}/rejects")
    assert (result.records_processed, result.records_failed, result.rows_loaded) == (4, 3, 1)
    assert result.rejects_path.startswith(f"{folder}/rejects/object=Thing/operation=upsert/run=")
    assert rows(result.frame(spark).drop("job_id")) == [("Thing", "upsert", 4, 3)]
    again = Flow("things", frame(spark, ("a", 9), ("c", 5)), target).run(spark, table)
    assert again.records_failed == 0 and again.rejects_path is None and again.commit.version == 2
    assert rows(table.read()) == [("a", 9), ("c", 5)]


def test_empty_flow_raises_unless_allowed(spark, folder):
    table = VersionedTable(spark, folder)
    nothing = frame(spark, ("a", 1)).filter("v > 1")
    with pytest.raises(ValueError, match="'none' produced no rows"):
        Flow("none", nothing, TargetConfig("T", "replace")).run(spark, table)
    assert table.current() is None
    Flow("none", nothing, TargetConfig("T", "replace", allow_empty=True)).run(spark, table)
    assert table.read().count() == 0


def test_replace_is_whole_whatever_the_batch_size(spark, folder):
    """More rows than one delivery batch; a second replace leaves only its own rows."""
    table = VersionedTable(spark, folder)
    replace = TargetConfig("T", "replace")
    Flow("r", spark.range(25_000), replace).run(spark, table)
    Flow("r", spark.range(12_000), replace).run(spark, table)
    assert table.read().count() == 12_000


def test_insert_and_delete_flows(spark, folder):
    table = VersionedTable(spark, folder)
    insert = TargetConfig("T", "insert")
    Flow("i", spark.createDataFrame([("1", "a"), ("2", "b")], "Id string, Email string"), insert).run(spark, table)
    Flow("i", spark.createDataFrame([("3", "c")], "Id string, Email string"), insert).run(spark, table)
    delete = TargetConfig("T", "delete", primary_key="Email")
    result = Flow("d", spark.createDataFrame([("a",), ("zz",)], "Email string"), delete).run(spark, table)
    assert (result.records_processed, result.records_failed) == (2, 1)
    assert rows(table.read()) == [("2", "b"), ("3", "c")]


def test_a_failing_flow_raises_and_keeps_the_table(spark, folder):
    table = VersionedTable(spark, folder)
    table.append(frame(spark, ("a", 1)))
    bad = (lambda df: mp.map_columns(df, {"k": "k", "unknown": "v"}),)
    with pytest.raises(ValueError, match="does not have"):
        Flow("x", frame(spark, ("b", 2)), TargetConfig("T", "insert"), bad).run(spark, table)
    assert rows(table.read()) == [("a", 1)]


def test_a_misfit_is_found_before_the_records_are_read(spark, folder):
    table = VersionedTable(spark, folder)
    table.append(frame(spark, ("a", 1)))
    unread = frame(spark, ("b", 2)).withColumn("extra", F.raise_error(F.lit("was read")).cast("int"))
    with pytest.raises(ValueError, match="does not have"):
        Flow("x", unread, TargetConfig("T", "upsert", primary_key="k")).run(spark, table)
    with pytest.raises(ValueError, match="needs a key"):
        Flow("x", unread, TargetConfig("T", "merge")).run(spark, table)


def test_incremental_sync_moves_the_cursor_with_the_data(spark, folder):
    source = {"Thing": spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, stamp int")}
    store = ObjectStore(lambda name: source[name])
    config = ResourceConfig("things", "Thing", "id", ("id", "name", "stamp"), replication_key="stamp")
    target = TargetConfig("tb", "merge", primary_key="thing_id")
    steps = (lambda df: mp.map_columns(df, {"thing_id": "id", "name": "name"}),)
    table = VersionedTable(spark, folder, ["thing_id"], 4)
    assert sync(spark, store, config, table, target, steps).records_processed == 2
    assert table.state["last_value"] == "20" and table.state["value_type"] == "int"
    source["Thing"] = spark.createDataFrame([(1, "a", 10), (2, "B", 30), (3, "c", 31)], "id int, name string, stamp int")
    assert sync(spark, store, config, table, target, steps).records_processed == 2
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError, match="no rows"):
        sync(spark, store, config, table, target, steps)
    assert table.state["last_value"] == "31"
    states = state_frame(spark, {"things": {**table.state, "version": table.current().version}})
    assert rows(states) == [("things", "stamp", "31", "int", 2)]


def test_replayed_and_late_stream_batches(spark, folder):
    table = VersionedTable(spark, folder, ["k"], 4)
    change = lambda *data: spark.createDataFrame(data, "k string, t int, v string")
    assert apply_changes(table, change(("a", 1, "x"), ("a", 3, "z"), ("b", 1, "p")), 0, "s", ["t"])
    assert not apply_changes(table, change(("a", 9, "again")), 0, "s", ["t"])
    assert apply_changes(table, change(("a", 2, "late"), ("b", 2, "q"), ("c", 1, "n")), 1, "s", ["t"])
    assert rows(table.read()) == [("a", 3, "z"), ("b", 2, "q"), ("c", 1, "n")]


def test_stream_over_many_files(spark, folder):
    feed = spark.range(0, 900, 1, 9).select((F.col("id") % 50).alias("user"), F.col("id").alias("t"))
    feed.write.parquet(f"{folder}/in")
    table = VersionedTable(spark, f"{folder}/t", ["user"], 4)
    versions = []
    for checkpoint in ("one", "one", "two"):  # the second start finds nothing new, the third starts over
        stream = file_feed(spark, f"{folder}/in", feed.schema, files_per_trigger=3)
        start_sync(stream, table, ["t"], f"{folder}/{checkpoint}").awaitTermination()
        assert sorted(rows(table.read())) == [(u, 850 + u) for u in range(50)]
        versions.append(table.current().version)
    assert versions == [3, 3, 6] and list(table.state.values()) == [2, 2]


@pytest.mark.parametrize("buckets", [0, 4])
def test_expire_keeps_what_the_last_version_names(spark, folder, buckets):
    table = VersionedTable(spark, folder, ["id"] if buckets else (), buckets)
    table.append(spark.range(100).withColumn("v", F.lit(0)))
    merge = TargetConfig("t", "merge", primary_key="id")
    for n in (1, 2):
        Flow("t", spark.range(1).withColumn("v", F.lit(n)), merge).run(spark, table)
    assert table.expire() == 2 and table.expire() == 0
    assert table.read().count() == 100 and table.read().filter("v = 2").count() == 1


def test_staged_copies_are_gone_after_a_run(spark, folder):
    with Staging(spark) as staging:
        copy = staging.copy(spark.range(5))
        assert copy.count() == 5
        kept = copy.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(kept)
    assert not os.path.exists(kept)
