import random

import pytest
from pyspark.sql import functions as F

from objsync.config import TargetConfig
from objsync.operators import results, write
from objsync.operators.dedup import keep_last
from tests.conftest import rows

SHAPE = "Id string, ext string, name string, n int"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [("001", "A", "ann", 1), ("002", "B", "bob", 2), ("003", "C", "cat", 3), ("004", "D", "dup", 4), ("005", "D", "dup", 5),
         ("006", None, "nokey", 6)], SHAPE)


def test_insert(spark, target):
    batch = spark.createDataFrame([("x", "Z")], "name string, ext string")
    plan = write.insert(target, batch)
    assert plan.table.count() == 7 and plan.table.columns == target.columns and plan.rejects.isEmpty()
    with pytest.raises(ValueError, match="does not have"):
        write.insert(target, spark.range(1).toDF("extra"))
    assert write.insert(target, spark.range(1).toDF("extra"), evolve=True).table.columns[-1] == "extra"


def test_replace_ignores_former_content(spark, target):
    batch = spark.createDataFrame([("Z", 9)], "ext string, n int")
    assert rows(write.replace(target, batch).table) == [(None, "Z", None, 9)]
    assert rows(write.replace(target.limit(1), batch).table) == [(None, "Z", None, 9)]
    assert write.wiped_ids(target).count() == 6


def test_upsert_full_rows(spark, target):
    batch = spark.createDataFrame([("002", "B", "BOB", None), ("007", "E", "eve", 7)], SHAPE)
    plan = write.upsert(target, batch, "ext")
    assert ("002", "B", "BOB", None) in rows(plan.table) and plan.table.count() == 7
    assert plan.rejects.isEmpty() and plan.accepted.count() == 2
    assert rows(write.upsert_outcomes(target, plan.accepted, ["ext"])) == [("inserted", 1), ("unchanged", 5), ("updated", 1)]


@pytest.mark.parametrize("policy, n", [("overwrite", None), ("keep", 2)])
def test_upsert_partial(spark, target, policy, n):
    batch = spark.createDataFrame([("B", None), ("E", 7)], "ext string, n int")
    table = rows(write.upsert(target, batch, "EXT", null_policy=policy).table)
    assert ("002", "B", "bob", n) in table and (None, "E", None, 7) in table and len(table) == 7


def test_upsert_rejects(spark, target):
    batch = spark.createDataFrame([("A", 1), ("A", 2), ("D", 3), (None, 4), ("", 5), ("E", 6), ("B", 7)], "ext string, n int")
    plan = write.upsert(target, batch, "ext")
    codes = {r.n: r.error_code for r in plan.rejects.collect()}
    assert codes == {1: "DUPLICATE_VALUE", 2: "DUPLICATE_VALUE", 3: "DUPLICATE_EXTERNAL_ID",
                     4: "REQUIRED_FIELD_MISSING", 5: "REQUIRED_FIELD_MISSING"}
    table = rows(plan.table)
    assert ("001", "A", "ann", 1) in table and ("004", "D", "dup", 4) in table and ("005", "D", "dup", 5) in table
    assert ("002", "B", "bob", 7) in table and (None, "E", None, 6) in table and len(table) == 7


def test_upsert_keep_last(spark, target):
    batch = spark.createDataFrame([("A", 1, 1), ("A", 5, 2), ("A", 3, 2)], "ext string, n int, t int")
    plan = write.upsert(target, batch, "ext", on_duplicate="keep_last", order_by=["t", "n"], evolve=True)
    assert ("001", "A", "ann", 5, 2) in rows(plan.table)
    with pytest.raises(ValueError, match="order_by"):
        write.upsert(target, batch, "ext", on_duplicate="keep_last", evolve=True)
    with pytest.raises(ValueError, match="on_duplicate"):
        write.upsert(target, batch, "ext", on_duplicate="first", evolve=True)
    with pytest.raises(ValueError, match="null_policy"):
        write.upsert(target, batch, "ext", null_policy="drop", evolve=True)
    with pytest.raises(ValueError, match="Columns not found"):
        write.upsert(target, batch, "nokey", evolve=True)


def test_keep_last_of_a_key_only_frame(spark):
    assert rows(keep_last(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"], ["k"])) == [(1,), (2,)]


def test_delete_by_id(spark, target):
    ids = spark.createDataFrame([("001",), ("001",), ("zzz",), (None,)], "Id string")
    assert [r.Id for r in write.delete_by_id(target, ids).table.orderBy("Id").collect()] == ["002", "003", "004", "005", "006"]


def test_delete_by_key_two_of_three(spark, target):
    keymap = spark.createDataFrame([("001", "A"), ("002", "B")], "Id string, key string")
    batch = spark.createDataFrame([("A",), ("B",), ("EXT003",), (None,), ("A",)], "ext string")
    plan = write.delete_by_key(target, batch, "ext", keymap)
    assert sorted(r.Id for r in plan.accepted.collect()) == ["001", "002"] and plan.table.count() == 4
    assert [(r.ext, r.error_code) for r in plan.rejects.collect()] == [("EXT003", "ENTITY_NOT_FOUND")]


def test_delete_by_key_of_the_target_itself(spark, target):
    batch = spark.createDataFrame([("D",), ("A",), ("zz",), (None,)], "ext string")
    plan = write.delete_by_key(target, batch, "ext")
    assert sorted(r.Id for r in plan.accepted.collect()) == ["001", "004", "005"]
    assert sorted(r.Id for r in plan.table.collect()) == ["002", "003", "006"]
    assert [r.ext for r in plan.rejects.collect()] == ["zz"]


def test_delete_by_key_never_takes_a_key_for_an_id(spark, target):
    """Keys that look like ids of real rows, and a map that knows none of them."""
    keymap = spark.createDataFrame([], "Id string, key string")
    batch = spark.createDataFrame([("001",), ("002",)], "ext string")
    plan = write.delete_by_key(target, batch, "ext", keymap)
    assert plan.table.count() == 6 and plan.accepted.isEmpty()


def config(operation, key=None):
    return TargetConfig("T", operation, primary_key=key)


def test_dispatch(spark, target):
    batch = spark.createDataFrame([("001", "A", "x", 1)], SHAPE)
    counts = {
        "insert": write.plan_write(target, batch, config("insert")).table.count(),
        "upsert": write.plan_write(target, batch, config("upsert", ("ext", "Id"))).table.count(),
        "merge": write.plan_write(target, batch, config("merge", ("ext", "Id"))).table.count(),
        "replace": write.plan_write(target, batch, config("replace")).table.count(),
        "by_id": write.plan_write(target, batch, config("delete", "id")).table.count(),
        "by_key": write.plan_write(target, batch, config("delete", "ext")).table.count(),
    }
    assert counts == {"insert": 7, "upsert": 6, "merge": 6, "replace": 1, "by_id": 5, "by_key": 5}


@pytest.mark.parametrize("operation", ["update", "UPSERT", ""])
def test_dispatch_refuses(target, operation):
    with pytest.raises(ValueError, match="no such operation"):
        write.plan_write(target, target, config(operation, "ext"))


def test_dispatch_needs_a_plain_key(target):
    with pytest.raises(ValueError, match="Not a name"):
        write.plan_write(target, target, config("upsert", "Owner.Email"))
    with pytest.raises(ValueError, match="needs a key"):
        write.plan_write(target, target, config("delete"))


def brute_upsert(target, batch):
    """Row by row on small data: batch rows with a unique key and at most one target row."""
    keys = [k for k, _ in batch]
    table = dict()
    held = [k for k, _ in target]
    good = {k: v for k, v in batch if k is not None and keys.count(k) == 1 and held.count(k) <= 1}
    table = [(k, good[k] if k in good else v) for k, v in target]
    return sorted(table + [(k, v) for k, v in good.items() if k not in held], key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_upsert_against_brute_force(spark, seed, threshold):
    rng = random.Random(seed)
    pick = lambda n: [(rng.choice([None, *"abcdefghijkl"]), rng.randint(0, 99)) for _ in range(n)]
    old, new = pick(10), pick(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        target, batch = (spark.createDataFrame(x, "k string, v int") for x in (old, new))
        for policy in ("overwrite", "keep"):
            plan = write.upsert(target, batch, "k", null_policy=policy)
            assert rows(plan.table) == brute_upsert(old, new)
            assert plan.accepted.count() + plan.rejects.count() == len(new)
        once = write.upsert(target, batch, "k").table
        assert rows(write.upsert(once, batch, "k").table) == rows(once)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_delete_then_upsert_is_upsert(spark, target):
    batch = spark.createDataFrame([("001", "A", "x", 1), ("009", "Q", "q", 9)], SHAPE)
    emptied = write.delete_by_id(target, batch).table
    assert rows(write.upsert(emptied, batch, "ext").table) == rows(write.upsert(target, batch, "ext").table)


def test_labels_and_results(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (2, "b", "y"), (2, "c", ""), (2, None, "z")], "job int, k string, req string")
    labelled = results.label_errors(df, ["req", "k"], ["k"])
    got = {(r.k, r.req): r.error_code for r in labelled.collect()}
    assert got == {("a", "x"): None, ("b", None): results.REQUIRED_MISSING, ("b", "y"): results.DUPLICATE,
                   ("c", ""): results.REQUIRED_MISSING, (None, "z"): results.REQUIRED_MISSING}
    good, bad = results.split_errors(labelled)
    assert good.count() == 1 and bad.count() == 4 and good.columns == df.columns
    assert rows(results.job_results(labelled, F.col("job"), "T", "upsert")) == [("1", "T", "upsert", 2, 1), ("2", "T", "upsert", 3, 3)]


def test_rejects_folder(spark, folder):
    df = results.without_rows(spark.range(1)).unionByName(results.with_error(spark.range(2), "X", "né, \"q\"\nz"))
    path = results.write_rejects(df, folder, "Account", "upsert", "r1")
    assert path == f"{folder}/object=Account/operation=upsert/run=r1"
    back = spark.read.options(**results.CSV_OPTIONS).option("multiLine", True).csv(path)
    assert back.columns == ["id", "error_code", "error_message"] and back.first().error_message == 'né, "q"\nz'


def test_delete_by_key_where_there_are_no_ids(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    plan = write.delete_by_key(target, spark.createDataFrame([("2",), ("9",)], "k string"), "k")
    assert rows(plan.table) == [(1, "a"), (None, "c")]
    assert rows(plan.accepted) == [(2,)] and [r.k for r in plan.rejects.collect()] == ["9"]
