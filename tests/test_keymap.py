import pytest
from pyspark.sql import functions as F

from objsync.operators import keymap as km
from objsync.operators.joins import hot_keys, lookup_join
from tests.conftest import rows


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame([("001A", "ACC1"), ("001B", "ACC2"), ("001C", "007"), ("001D", None)], "Id string, Ext string")


@pytest.fixture(scope="module")
def contacts(spark):
    return spark.createDataFrame(
        [(1, "ACC1"), (2, "ACC2"), (3, "ACC9"), (4, None), (5, ""), (6, "ACC1"), (7, "00fake")], "n int, acc string"
    )


def test_full_and_keyed_maps(accounts, contacts):
    assert rows(km.build_keymap(accounts, "Id", "Ext")) == [("001A", "ACC1"), ("001B", "ACC2"), ("001C", "007")]
    keyed = km.build_keymap(accounts, "Id", "Ext", contacts.select("acc"))
    assert keyed.columns == ["Id", "key"] and rows(keyed) == [("001A", "ACC1"), ("001B", "ACC2")]


def test_more_than_400_keys(spark):
    many = spark.range(1000).select(F.concat(F.lit("00"), "id").alias("Id"), F.col("id").cast("string").alias("Ext"))
    assert km.build_keymap(many, "Id", "Ext", many.select("Ext")).count() == 1000


def test_numeric_looking_keys_match_as_text(spark, accounts):
    df = spark.createDataFrame([("007",)], "acc string")
    assert rows(km.resolve_keys(df, km.build_keymap(accounts, "Id", "Ext"), "acc")) == [("001C",)]
    numbers = spark.createDataFrame([(7,)], "acc int")
    assert rows(km.resolve_keys(numbers, km.build_keymap(accounts, "Id", "Ext"), "acc")) == [("7",)]


def test_lookup_keys(contacts):
    assert rows(km.lookup_keys(contacts, "acc")) == [("00fake",), ("ACC1",), ("ACC2",), ("ACC9",)]


def test_missing_keys(accounts, contacts):
    keymap = km.build_keymap(accounts, "Id", "Ext")
    assert rows(km.missing_keys(contacts.select("acc"), keymap)) == [("00fake",), ("ACC9",)]
    assert km.missing_keys(contacts.select("acc"), None).count() == 4


@pytest.mark.parametrize("hot", [None, [], ["ACC1", "ACC9"]])
@pytest.mark.parametrize("policy, misses", [("pass", ["ACC9", None, "", "00fake"]), ("null", [None] * 4)])
def test_resolve_keeps_every_row(accounts, contacts, hot, policy, misses):
    got = km.resolve_keys(contacts, km.build_keymap(accounts, "Id", "Ext"), "acc", "AccountId", on_miss=policy, hot=hot)
    assert got.columns == ["n", "acc", "AccountId"]
    found = {r.n: r.AccountId for r in got.collect()}
    assert len(found) == 7 and (found[1], found[2], found[6]) == ("001A", "001B", "001A")
    assert [found[n] for n in (3, 4, 5, 7)] == misses


def test_resolve_in_place_keeps_column_order(spark, accounts):
    df = spark.createDataFrame([("ACC1", 1)], "acc string, n int")
    assert rows(km.resolve_keys(df, km.build_keymap(accounts, "Id", "Ext"), "acc")) == [("001A", 1)]


def test_unknown_policy(accounts, contacts):
    with pytest.raises(ValueError, match="on_miss"):
        km.resolve_keys(contacts, accounts, "acc", on_miss="drop")


def test_reject_policy(accounts, contacts):
    good, bad = km.split_resolved(contacts, km.build_keymap(accounts, "Id", "Ext"), "acc", "AccountId")
    assert sorted(r.n for r in good.collect()) == [1, 2, 4, 6]
    assert [(r.n, r.error_code) for r in bad.orderBy("n").collect()] == [(n, "INVALID_CROSS_REFERENCE_KEY") for n in (3, 5, 7)]


def test_unresolved_report_counts_rows(accounts, contacts):
    got = km.unresolved_keys(contacts, km.build_keymap(accounts, "Id", "Ext"), "acc")
    assert rows(got) == [("", 1), ("00fake", 1), ("ACC9", 1), (None, 1)]


def test_ambiguous_key_fails_only_when_used(spark, contacts):
    keymap = spark.createDataFrame([("1", "ACC1"), ("2", "ACC1"), ("3", "ACC2")], "Id string, key string")
    assert rows(km.ambiguous_keys(keymap)) == [("ACC1", 2, "1", "2")]
    with pytest.raises(Exception, match="More than one Id for key ACC1"):
        km.resolve_keys(contacts, keymap, "acc").collect()
    assert km.resolve_keys(contacts.filter("acc = 'ACC2'"), keymap, "acc").first().acc == "3"


def test_merge_later_load_wins_and_keys_are_unique(spark):
    def load(*pairs):
        return spark.createDataFrame(pairs, "Id string, key string")

    merged = km.merge_keymaps(load(("9", "a"), ("2", "b")), load(("1", "a")), load(("5", "c"), ("6", "c")))
    assert rows(merged) == [("1", "a"), ("2", "b"), ("6", "c")]


def test_registry_lifecycle(spark, accounts, contacts, folder):
    maps = km.KeyMaps(spark, folder)
    assert not maps.has("Account", "Ext")
    with pytest.raises(KeyError):
        maps.get("Account", "Ext")
    maps.init("Account", "Ext")
    assert maps.get("Account", "Ext").count() == 0
    with pytest.raises(ValueError, match="needs keys"):
        maps.define("Account", "Ext", accounts)
    assert maps.define("Account", "Ext", accounts, keys=contacts.select("acc")) == 2
    assert maps.define("Account", "Ext", accounts, keys=contacts.select("acc")) == 2
    assert maps.define("Account", "Ext", accounts, full_load=True) == 3
    assert maps.update("Account", "Ext", spark.createDataFrame([("new", "ACC1")], "Id string, key string")) == 3
    resolved = maps.resolve(contacts, "Account", "Ext", "acc")
    assert {r.n: r.acc for r in resolved.collect()}[1] == "new"


def test_registry_clear(spark, folder):
    maps = km.KeyMaps(spark, folder)
    for name, field in (("Account", "Ext"), ("Account", "Code"), ("AccountPlan", "Ext")):
        maps.init(name, field)
    maps.clear("Account", "Ext")
    assert not maps.has("Account", "Ext") and maps.has("Account", "Code")
    maps.clear("Account")
    assert not maps.has("Account", "Code") and maps.has("AccountPlan", "Ext")
    maps.clear()
    assert not maps.has("AccountPlan", "Ext")


def test_failed_load_raises(spark, accounts, folder):
    with pytest.raises(Exception):
        km.KeyMaps(spark, folder).define("Account", "NoSuchField", accounts, full_load=True)


def test_shared_maps_are_per_store(spark):
    assert km.shared_keymaps(spark, "prod") is km.shared_keymaps(spark, "prod")
    assert km.shared_keymaps(spark, "prod") is not km.shared_keymaps(spark, "dev")


def test_hot_keys_are_found_and_spread(spark):
    """A third of the rows share a key, a third have none; wholly equal rows occur too."""
    many = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), F.lit(1).alias("one")
    )
    assert hot_keys(many, "k", share=0.1) == ["hot"]
    lookup = many.select("k").dropna().distinct().withColumn("v", F.concat(F.lit("v"), "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup_join(many, lookup, "k", hot=["hot"], salt=16)
        assert joined.columns == ["k", "one", "v"]
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert joined.count() == 30_000 and max(sizes) < 0.5 * 30_000
        assert joined.filter("v is null").count() == 10_000
        assert joined.filter("k = 'hot' and v = 'vhot'").count() == 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
