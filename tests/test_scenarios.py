"""The acceptance scenarios end to end on small files: accounts, contacts with lookup, deletion, reset, prospects."""

import json

import pytest
from pyspark.sql import functions as F

from objsync.config import TargetConfig
from objsync.functions.text import concat_strip, template
from objsync.operators import keymap as km
from objsync.operators import mapping as mp
from objsync.plans.flow import Flow
from objsync.plans.store import VersionedTable
from objsync.sources.files import checked_csv, read_json
from tests.conftest import rows

ACCOUNTS = '''AccountID,Name,Type,AnnualRevenue,BillingPostalCode
T01,"Tuiles & Fils",Customer,1500000.50,06000
T02,"L'Été ""Bleu""",Prospect,,75002
'''
CONTACTS = """AccountID,FirstName,LastName,Email,Birthdate,MobilePhone
T01,Zoé,Noël,zoe@example.test,1980-05-15,0601020304
T02,Ali,Benz,ali@example.test,1000-01-01,0600000002
T99,No,Account,no@example.test,,
,Lone,Wolf,lone@example.test,,
"""


@pytest.fixture
def put(folder):
    def write(name, text):
        path = f"{folder}/{name}"
        with open(path, "w", encoding="utf-8") as out:
            out.write(text)
        return path

    return write


@pytest.fixture
def accounts(spark, folder, put):
    table = VersionedTable(spark, f"{folder}/account")
    mapping = {"ExternalId": "AccountID", "AccountNumber": "AccountID", "Name": "Name", "AnnualRevenue": "AnnualRevenue",
               "Phone": "Phone", "BillingPostalCode": "BillingPostalCode"}
    flow = Flow(
        "accounts", checked_csv(spark, put("accounts.csv", ACCOUNTS)),
        TargetConfig.from_hints({"name": "Account", "write_disposition": "append", "operation": "upsert", "primary_key": "ExternalId"}),
        (lambda df: mp.map_columns(df, mapping, strict=False), lambda df: mp.apply_types(df, {"AnnualRevenue": "decimal"})),
    )
    flow.run(spark, table)
    return table


def test_accounts(accounts):
    first, second = accounts.read().orderBy("ExternalId").collect()
    assert (first.Name, first.AccountNumber, str(first.AnnualRevenue), first.BillingPostalCode) == ("Tuiles & Fils", "T01", "1500000.50", "06000")
    assert (second.Name, second.AnnualRevenue, second.Phone) == ('L\'Été "Bleu"', None, None)


def test_contacts_with_lookup_then_deletion(spark, folder, put, accounts):
    source = checked_csv(spark, put("contacts.csv", CONTACTS))
    ids = accounts.read().withColumn("Id", F.concat(F.lit("001"), "ExternalId"))
    maps = km.KeyMaps(spark, f"{folder}/maps")
    assert maps.define("Account", "ExternalId", ids, keys=source.select("AccountID")) == 2
    contacts = VersionedTable(spark, f"{folder}/contact", ["Email"], 4)
    mapping = {"FirstName": "FirstName", "LastName": "LastName", "Email": "Email", "AccountId": "AccountID", "Born": "Birthdate"}
    steps = (
        lambda df: maps.resolve(df, "Account", "ExternalId", "AccountID"),
        lambda df: mp.map_columns(df, mapping),
        lambda df: mp.apply_types(df, {"Born": "date"}),
    )
    target = TargetConfig("Contact", "upsert", primary_key="Email")
    for _ in range(2):  # a second run of the same file changes nothing
        assert Flow("contacts", source, target, steps).run(spark, contacts).rows_loaded == 4
    assert rows(contacts.read().select("Email", "AccountId")) == [
        ("ali@example.test", "001T02"), ("lone@example.test", None), ("no@example.test", "T99"), ("zoe@example.test", "001T01")]
    assert contacts.read().filter("Email like 'ali%'").select(F.year("Born")).first()[0] == 1000

    held = contacts.read().withColumn("Id", F.concat(F.lit("003"), F.substring("Email", 1, 3)))
    with_ids = VersionedTable(spark, f"{folder}/contact_ids")
    with_ids.append(held)
    emails = checked_csv(spark, put("gone.csv", "Email\nzoe@example.test\nunknown@example.test"))
    result = Flow("deletion", emails, TargetConfig("Contact", "delete", primary_key="Email")).run(spark, with_ids)
    assert (result.records_processed, result.records_failed) == (2, 1) and with_ids.read().count() == 3


def test_reset(spark, folder, put):
    table = VersionedTable(spark, f"{folder}/fixed")
    steps = (lambda df: mp.require_columns(df, ["name", "code"]), lambda df: mp.map_columns(df, {"Name": "name", "Code": "code"}))
    target = TargetConfig.from_hints({"name": "FixedRecord", "write_disposition": "replace"})
    Flow("reset", checked_csv(spark, put("a.csv", 'name,code,x\n"a","1",z\n"b","2",z\n')), target, steps).run(spark, table)
    Flow("reset", checked_csv(spark, put("b.csv", 'name,code\n"c","3"\n')), target, steps).run(spark, table)
    assert rows(table.read()) == [("c", "3")]
    with pytest.raises(ValueError, match="code"):
        Flow("reset", checked_csv(spark, put("c.csv", "name\nq\n")), target, steps).run(spark, table)
    assert rows(table.read()) == [("c", "3")]


def test_prospects(spark, folder, put):
    seat = {"number": "12", "kind": "RUE", "street": "DE LYON ", "town": "LYON"}
    records = [{"siren": "1", "full": "UN", "nature": "5710", "seat": seat}, {"siren": "2", "full": "DEUX", "nature": "1000", "seat": seat},
               {"siren": "", "full": "VIDE"}, {"siren": "3", "full": "TROIS"}]
    path = put("api.json", "\n".join(map(json.dumps, records)))
    source = read_json(spark, path, "siren string, full string, nature string, seat struct<number: string, kind: string, street: string, town: string>")
    steps = (
        lambda df: mp.exclude_value(df, "nature", "1000"),
        lambda df: mp.require_filled(df, "siren"),
        lambda df: mp.map_columns(df, {
            "ExternalId": "siren", "Name": "full", "Type": F.lit("Prospect"), "City": F.col("seat.town"),
            "Street": concat_strip(F.col("seat.number"), F.col("seat.kind"), F.col("seat.street")),
            "Text": template("Nature: {n}", n=F.col("nature")),
        }),
    )
    table = VersionedTable(spark, f"{folder}/account")
    Flow("prospects", source, TargetConfig("Account", "upsert", primary_key="ExternalID"), steps).run(spark, table)
    assert rows(table.read()) == [("1", "UN", "Prospect", "LYON", "12RUEDE LYON", "Nature: 5710"), ("3", "TROIS", "Prospect", None, "", "Nature: ")]
