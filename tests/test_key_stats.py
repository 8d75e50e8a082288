"""Statistics per folder: what is skipped, what never is, and that results do not change."""

import pytest
from pyspark.sql import functions as F

from objsync.config import TargetConfig
from objsync.plans.flow import Flow
from objsync.plans.store import VersionedTable
from tests.conftest import rows


def filled(spark, folder, **options):
    """Ten loads of 100 rows; ``mail`` and ``code`` of a load lie close together."""
    table = VersionedTable(spark, folder, stats=["mail", "code"], **options)
    for load in range(10):
        part = spark.range(load * 100, load * 100 + 100).selectExpr(
            "id", "concat('m', lpad(id, 5, '0')) mail", "(id * 7919) % 100000 code", "cast(id as double) v")
        table.append(part)
    return table


def mails(spark, *numbers):
    return spark.createDataFrame([(f"m{n:05d}",) for n in numbers], "mail string")


def test_ranges_and_filters_skip_folders(spark, folder):
    table = filled(spark, folder)
    assert len(table.folders_with(mails(spark, 250, 251))) == 1
    assert len(table.folders_with(mails(spark, 250, 777))) == 2
    # Within the range of all folders, in none of them: the filters tell.
    assert len(table.folders_with(spark.createDataFrame([(12345,)], "code bigint"))) <= 1
    assert table.folders_with(mails(spark, 99999)) == set() and table.folders_with(mails(spark)) == set()
    assert len(table.folders_with(spark.createDataFrame([(7919 * 321 % 100000,)], "code bigint"))) <= 2


@pytest.mark.parametrize("options", [{}, {"keys": ["id"], "buckets": 4}])
def test_every_key_is_found(spark, folder, options):
    table = filled(spark, folder, **options)
    for column in ("mail", "code"):
        keys = table.read().filter("id % 9 = 0").select(column)
        assert table.lookup(keys).count() == 112
        one = keys.filter(F.col(column) == keys.agg(F.min(column)).first()[0])
        assert table.lookup(one).count() == 1 and len(table.folders_with(one)) < len(table.current().folders)


@pytest.mark.parametrize("options", [{}, {"keys": ["id"], "buckets": 4}])
def test_a_delete_and_an_upsert_rewrite_only_what_may_hold_the_keys(spark, folder, options):
    table = filled(spark, folder, **options)
    before = {path for _, path in table.current().folders}
    gone = mails(spark, 120, 121, 5555)
    Flow("d", gone, TargetConfig("T", "delete", primary_key="mail")).run(spark, table)
    left = {path for _, path in table.current().folders}
    assert len(before - left) <= 2 and table.read().count() == 998
    batch = spark.createDataFrame([(-1, "m00300", 1, -5.0), (-2, "new", 2, -6.0)], "id bigint, mail string, code bigint, v double")
    before = left
    Flow("u", batch, TargetConfig("T", "upsert", primary_key="mail")).run(spark, table)
    left = {path for _, path in table.current().folders}
    assert len(before - left) <= 1 and table.read().count() == 999
    assert rows(table.read().filter("v < 0")) == [(-1, "m00300", 1, -5.0), (-2, "new", 2, -6.0)]
    # What was written anew has statistics of its own.
    assert rows(table.lookup(mails(spark, 301)).select("id")) == [(301,)] and len(table.folders_with(mails(spark, 301))) == 1


def test_a_delete_through_a_key_map(spark, folder):
    table = VersionedTable(spark, folder, stats=["Id"])
    for load in range(5):
        table.append(spark.range(load * 10, load * 10 + 10).selectExpr("concat('i', id) Id", "id v"))
    keymap = spark.createDataFrame([("i7", "seven"), ("i8", "eight")], "Id string, key string")
    batch = spark.createDataFrame([("seven",), ("nine",)], "k string")
    before = {path for _, path in table.current().folders}
    result = Flow("d", batch, TargetConfig("T", "delete", primary_key="k")).run(spark, table, keymap)
    assert len(before - {path for _, path in table.current().folders}) == 1
    assert table.read().count() == 49 and result.records_failed == 1


def test_missing_statistics_read_all(spark, folder):
    plain = VersionedTable(spark, folder)
    plain.append(spark.range(5).selectExpr("id", "concat('m', id) mail"))
    assert plain.folders_with(mails(spark, 1)) is None
    table = VersionedTable(spark, folder, stats=["mail"])
    old = table.current().folders[0][1]
    table.append(spark.range(5, 10).selectExpr("id", "concat('m', id) mail"))
    key = spark.createDataFrame([("m2",)], "mail string")
    # The folder from before always counts, the new one only for its own keys.
    assert table.folders_with(key) == {old} and table.lookup(key).count() == 1
    assert VersionedTable(spark, folder).stats == ["mail"]
    # Change folders have none, so nothing is skipped beside them.
    keyed = VersionedTable(spark, f"{folder}/k", ["id"], 2, stats=["mail"])
    keyed.append(spark.range(5).selectExpr("id", "concat('m', id) mail"))
    keyed.publish(keyed.prepare_change(spark.createDataFrame([(1, "moved")], "id bigint, mail string"), ["mail"]))
    assert keyed.folders_with(key) is None
    assert keyed.lookup(spark.createDataFrame([("moved",)], "mail string")).count() == 1


def test_odd_values(spark, folder):
    """NULL, empty, long and repeated text, minus zero, NaN, dates, times and decimals."""
    table = VersionedTable(spark, folder, stats=["s", "d", "day", "at", "n", "nothing"])
    long = "z" * 500
    table.append(spark.sql(f"""
        SELECT * FROM VALUES (1, '', -0.0D, date'2024-01-02', timestamp'2024-01-02 03:04:05', 1.50BD),
          (2, '{long}', double('NaN'), NULL, NULL, NULL), (3, NULL, 5.0D, date'1969-12-31', timestamp'1969-12-31 23:00:00', -2.25BD),
          (4, '{long}', 5.0D, NULL, NULL, 0.00BD) AS t(id, s, d, day, at, n)"""))
    table.append(spark.sql("SELECT 9 id, 'other' s, 77.0D d, date'2030-01-01' day, timestamp'2030-01-01 00:00:00' at, 9.00BD n"))

    def found(query):
        keys = table.fitted(spark.sql(query))
        folders = table.folders_with(keys)
        assert folders is not None and len(folders) <= 1
        return [row[0] for row in rows(table.lookup(keys).select("id"))]

    assert found("SELECT '' s") == [1] and found(f"SELECT '{long}' s") == [2, 4]
    assert found("SELECT 0.0D d") == [1] and found("SELECT double('NaN') d") == [2]
    assert found("SELECT date'1969-12-31' day") == [3] and found("SELECT 1.5BD n") == [1]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert found("SELECT timestamp'2024-01-02 12:04:05' at") == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found("SELECT CAST(NULL AS string) s") == []


def test_expire_drops_statistics_of_dropped_folders(spark, folder):
    table = filled(spark, folder)
    table.replace(table.read())
    table.expire()
    names = table._names(table._hadoop.Path(f"{folder}/_stats"))
    assert names == [table.current().folders[0][1]] and table.lookup(mails(spark, 5)).count() == 1
