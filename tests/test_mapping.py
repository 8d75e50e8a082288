import pandas as pd
import pytest
from pyspark.sql import functions as F

from objsync.functions.text import child_or, concat_strip, template
from objsync.operators import mapping as mp
from tests.conftest import rows


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("A1", "Ann", "x"), ("A2", "Bob", None)], "AccountID string, FirstName string, Note string")


def test_one_source_to_two_outputs_and_pruning(people):
    df = mp.map_columns(people, {"ExternalId": "AccountID", "Number": "AccountID", "Kind": F.lit("P")})
    assert rows(df) == [("A1", "A1", "P"), ("A2", "A2", "P")]


def test_missing_column_strict_and_lenient(people):
    with pytest.raises(ValueError, match=r"Columns not found: \['Phone'\]"):
        mp.map_columns(people, {"Phone": "Phone"})
    assert rows(mp.map_columns(people, {"Phone": "Phone", "F": "firstname"}, strict=False)) == [(None, "Ann"), (None, "Bob")]


def test_required_columns(people):
    with pytest.raises(ValueError, match="code"):
        mp.require_columns(people, ["AccountID", "code"])


def test_required_keys(spark):
    df = spark.createDataFrame([("1",), ("",), (None,)], "k string")
    assert rows(mp.require_filled(df, "k")) == [("1",)]


def test_concat_strip_and_template(spark):
    df = spark.createDataFrame([(" 12", None, "Rue\t "), (None, None, None)], "a string, b string, c string")
    got = df.select(concat_strip(F.col("a"), F.col("b"), F.col("c")), concat_strip(F.col("a"), F.col("b"), F.col("c"), sep=" "),
                    template("N: {b}- {a}!", a=F.col("a"), b=F.col("b")))
    assert rows(got) == [("", "", "N: - !"), ("12Rue", "12 Rue", "N: -  12!")]


def test_child_default(spark):
    df = spark.sql("select named_struct('k', cast(null as string), 'v', 5) s union all select null")
    assert rows(df.select(child_or(F.col("s.k")), child_or(F.col("s.v"), "0"))) == [("", "0"), ("", "5")]


def test_types(spark):
    df = spark.createDataFrame([("1", "2025-01-18T10:00:00.000Z", "x", "19.99")], "n string, t string, bad string, m string")
    typed = mp.apply_types(df, {"n": "bigint", "t": "timestamp", "m": "decimal"})
    assert [t for _, t in typed.dtypes] == ["bigint", "timestamp", "string", "decimal(18,2)"]
    assert typed.select(F.date_format("t", "HH:mm")).first()[0] == "10:00"
    assert mp.apply_types(df, {"bad": "bigint"}, strict=False).first().bad is None
    with pytest.raises(Exception):
        mp.apply_types(df, {"bad": "bigint"}).collect()


def test_flatten_and_child_table(spark):
    df = spark.sql("select 1 id, named_struct('a', 1, 'in', named_struct('b', 2)) s, array(named_struct('q', 7), named_struct('q', 8)) xs")
    assert mp.flatten(df.drop("xs")).columns == ["id", "s__a", "s__in__b"]
    assert rows(mp.explode_child(df, ["id"], "xs")) == [(1, 0, 7), (1, 1, 8)]


def test_evolution(spark):
    a, b = spark.sql("select 1 id, 'x' name"), spark.sql("select 2 id, true flag")
    assert rows(mp.evolve_union(a, b)) == [(1, "x", None), (2, None, True)]


def test_user_transform_may_drop_and_multiply(spark):
    def expand(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.loc[batch.index.repeat(batch["id"])]

    assert rows(mp.expand_records(spark.range(3), expand, "id long")) == [(1,), (2,), (2,)]
