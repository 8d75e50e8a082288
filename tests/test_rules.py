import datetime as dt

import pytest
from pyspark.sql import functions as F

from objsync.functions import rules
from objsync.functions.literals import text_literal, with_literals


def verdicts(spark, values, dotted=False):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, name string")
    return [r.verdict for r in rules.audit_names(df, "name", "verdict", dotted).orderBy("n").collect()]


def test_object_names(spark):
    good = ["Account", "Custom_Object__c", "My_Event__e", "Update__c", "A1"]
    assert verdicts(spark, good) == ["ok"] * 5
    bad = ["", None, "Account!", "Object-Name", "1Account", "_x", "Account\n", "Account; DROP TABLE Users", "Owner.Name"]
    assert verdicts(spark, bad) == ["empty", "empty"] + ["invalid"] * 7
    assert verdicts(spark, ["DROP", "delete", "Truncate", "EXECUTE"]) == ["keyword", "keyword", "dangerous", "dangerous"]


def test_field_names(spark):
    names = ["Account.Name", "Contact.Account.Name", "Owner__r.Email", "Account..Name", "Account.", "Account.Delete"]
    assert verdicts(spark, names, dotted=True) == ["ok", "ok", "ok", "invalid", "invalid", "keyword"]


def test_all_names_of_a_mapping(spark):
    df = spark.sql("select array('Id', 'Owner.Name') a union all select array('Id', 'Bad-Name')")
    assert sorted(r[0] for r in df.select(rules.all_names_ok(F.col("a"))).collect()) == [False, True]


FILTERS = {
    "Name LIKE 'Acme%'": "ok",
    "Status IN ('Active', 'Pending')": "ok",
    "(A = 1 OR B = 2) AND Update__c = true": "ok",
    "Name = 'Ünïcode 株式会社'": "ok",
    "Name = 'Acme'; DROP TABLE Account": "dangerous",
    "Name = 'Acme' -- comment": "dangerous",
    "Name = 'Acme' /* x */": "dangerous",
    "Name = 'a\0b'": "dangerous",
    "DELETE FROM Account": "keyword",
    "truncate Account": "dangerous",
    "Id IN (SELECT Id FROM Contact)": "keyword",
    "Id IN (select\nId)": "ok",
    "Name = 'Acme": "unbalanced",
    "été DROP": "keyword",
    "éDROP = 1": "ok",
    "": "ok",
}


def test_filters(spark):
    df = spark.createDataFrame(list(FILTERS.items()), "text string, want string")
    assert rules.audit_filter_text(df, "text", "got").filter("got <> want").collect() == []


def test_subquery_over_two_lines_is_not_a_match(spark):
    """The search does not cross line ends before the keyword."""
    df = spark.createDataFrame([("Id IN (\nselect Id)",), ("Id IN (x select\ny)",)], "text string")
    assert [r.got for r in rules.audit_filter_text(df, "text", "got").collect()] == ["ok", "ok"]


def test_driver_guard():
    assert rules.check_name("Owner__r.Email") == "Owner__r.Email"
    for bad in ("", "Account!", "DROP", "Account\n"):
        with pytest.raises(ValueError):
            rules.check_name(bad)
    with pytest.raises(ValueError):
        rules.check_name("Owner.Name", dotted=False)


def test_literals_by_type(spark):
    row = (dt.datetime(2025, 1, 18, 10, 0, 0, 123000), dt.date(1000, 1, 1), True, 7, 12345678.5, 0.5, "O'Brien", None)
    df = spark.createDataFrame([row], "t timestamp_ntz, d date, b boolean, i long, big double, small double, s string, n string")
    got = with_literals(df, {f"{c}_l": c for c in df.columns}).select(*(f"{c}_l" for c in df.columns)).first()
    assert list(got) == ["2025-01-18T10:00:00.123Z", "1000-01-01", "true", "7", "12345678.5", "0.5", "'O\\'Brien'", "NULL"]


@pytest.mark.parametrize("value, shown", [
    (1e7, "10000000.0"), (123456789012.25, "123456789012.25"), (0.0005, "0.0005"), (-2e8, "-200000000.0"), (1e16, "1.0E16"),
])
def test_number_literals_have_no_needless_exponent(spark, value, shown):
    df = spark.createDataFrame([(value,)], "x double")
    assert with_literals(df, {"l": "x"}).first().l == shown


def test_backslash_escape_is_optional(spark):
    df = spark.createDataFrame([("a\\b'c",)], "s string")
    got = df.select(text_literal(F.col("s")), text_literal(F.col("s"), escape_backslash=True)).first()
    assert list(got) == ["'a\\b\\'c'", "'a\\\\b\\'c'"]
