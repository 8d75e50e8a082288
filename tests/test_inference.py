"""Types from text, their lattice, and tables whose columns widen."""

import itertools
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from objsync.operators.inference import inferred_types, typed, wider, widest
from objsync.plans.store import VersionedTable
from tests.conftest import rows


def kinds(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return inferred_types(df.repartition(3))["c"].simpleString()


@pytest.mark.parametrize("values,want", [
    ((None, None), "void"), ((), "void"), (("1", None, "-2147483648"), "int"), (("1", "2147483648"), "bigint"),
    (("1", "9223372036854775808"), "decimal(19,0)"), (("1", "2.50", "-100.125"), "decimal(6,3)"), (("0.5",), "decimal(2,1)"),
    (("007",), "string"), (("+1",), "string"), (("-0",), "string"), (("1", ""), "string"), (("9" * 39,), "string"), (("1e5",), "string"),
    (("true", "false", None), "boolean"), (("true", "1"), "string"), (("2024-02-29", None), "date"), (("2023-02-29",), "string"),
    (("2024-02-29", "2024-01-01T10:00:00"), "timestamp_ntz"), (("2024-01-01 10:00:00.5",), "timestamp_ntz"), (("2024-01-01", "5"), "string"),
])
def test_the_least_type(spark, values, want):
    assert kinds(spark, *values) == want


def test_inference_is_one_pass_over_all_columns(spark):
    df = spark.range(1000).selectExpr("string(id) a", "if(id = 777, 'x', string(id)) b", "string(date_add(date'2024-01-01', int(id))) d", "id n")
    assert {n: k.simpleString() for n, k in inferred_types(df).items()} == {"a": "int", "b": "string", "d": "date"}
    assert inferred_types(df.select("n")) == {}
    cast = typed(df, inferred_types(df))
    assert [f.dataType.simpleString() for f in cast.schema.fields] == ["int", "string", "date", "bigint"]


def test_the_lattice_is_a_join(spark):
    some = [T.NullType(), T.IntegerType(), T.LongType(), T.DecimalType(10, 2), T.DecimalType(30, 12), T.DoubleType(), T.FloatType(),
            T.DateType(), T.TimestampNTZType(), T.BooleanType(), T.StringType()]
    for a, b in itertools.product(some, some):
        assert wider(a, b) == wider(b, a) and wider(a, a) == a and wider(wider(a, b), a) == wider(a, b)
    assert wider(T.LongType(), T.DecimalType(10, 2)) == T.DecimalType(21, 2)
    assert widest({"a": T.IntegerType()}, {"a": T.LongType(), "b": T.DateType()}) == {"a": T.LongType(), "b": T.DateType()}


@pytest.mark.parametrize("options", [{}, {"keys": ["k"], "buckets": 3}])
def test_int_to_bigint_to_decimal_to_text(spark, folder, options):
    table = VersionedTable(spark, folder, **options)

    def load(*data):
        table.append_texts(spark.createDataFrame(list(data), "k string, v string"))
        return table.current().schema["v"].dataType.simpleString()

    assert load(("1", "5"), ("2", None)) == "int"
    first = table.current().folders
    assert load(("3", "5000000000")) == "bigint"
    assert set(first) < set(table.current().folders)  # Spark reads the old files as they are
    assert rows(table.read()) == [(1, 5), (2, None), (3, 5000000000)]
    assert load(("4", "1.25")) == "decimal(21,2)"
    assert rows(table.read().filter("v = 5")) == [(1, Decimal("5.00"))]
    assert load(("5", "seven"), ("6", "007")) == "string"
    assert rows(table.read()) == [(1, "5.00"), (2, None), (3, "5000000000.00"), (4, "1.25"), (5, "seven"), (6, "007")]
    assert table.current().version == 4 and table.current().schema["k"].dataType.simpleString() == "int"


def test_a_widened_key_stays_one_key(spark, folder):
    table = VersionedTable(spark, folder, ["k"], buckets=4)
    table.append_texts(spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string"))
    table.append_texts(spark.createDataFrame([("2.5", "c")], "k string, v string"))
    batch = spark.createDataFrame([(Decimal("1.00"), "new")], "k decimal(12,2), v string")
    touched = table.touched(batch)
    assert rows(table.read(touched).filter("k = 1")) == [(Decimal("1.0"), "a")]


def test_new_and_empty_columns(spark, folder):
    table = VersionedTable(spark, folder, stats=["a"])
    table.append_texts(spark.createDataFrame([("1", None)], "a string, b string"))
    table.append_texts(spark.createDataFrame([("2", "2024-05-06", "x")], "a string, b string, c string"))
    table.append_texts(spark.createDataFrame([], "a string, b string"))
    assert table.current().schema["c"].dataType.simpleString() == "string"
    assert table.read().select("a").filter("a IS NOT NULL").count() == 2
    assert table.lookup(spark.createDataFrame([(2,)], "a int")).count() == 1
    assert table.widen({"a": T.IntegerType()}).version == table.current().version
    table.widen({"a": T.LongType()})
    # Statistics of the former type are not used.
    assert table.folders_with(spark.createDataFrame([(2,)], "a bigint")) is None
    assert table.lookup(spark.createDataFrame([(2,)], "a bigint")).count() == 1
