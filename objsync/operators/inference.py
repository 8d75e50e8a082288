"""Types of text columns from their values, and the least type that holds the values of two.

The lattice, from the least type up: ``int``, ``bigint``, ``decimal``, ``string``, and ``date``,
``timestamp_ntz``, ``string`` beside it, and ``boolean``, ``string``. A column without values is ``void``, which any
type holds. A text belongs to a type only if the value written out again is the same
text, but for trailing zeros of a decimal and seconds of a time: ``007`` and ``+1`` stay text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import named

MOST_DIGITS = 38
_WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_DECIMAL_TEXT = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
_MINUS_ZERO = r"^-0(\.0+)?$"
_DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"


def inferred_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, T.DataType]:
    """The least type of each text column (or of the given ones), from all rows in one pass.

    Per column a few minima and maxima are kept, which combine in any order; one row reaches the driver.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)] if columns is None else list(columns)
    if not names:
        return {}
    found = df.agg(*[_summary(named(name)).alias(f"c{n}") for n, name in enumerate(names)]).first()
    return {name: _least(found[f"c{n}"]) for n, name in enumerate(names)}


def _summary(text: Column) -> Column:
    """What all values of a column have in common."""
    number = text.rlike(_DECIMAL_TEXT) & ~text.rlike(_MINUS_ZERO)
    digits = F.length(F.regexp_replace(F.substring_index(text, ".", 1), "-", ""))
    scale = F.when(text.contains("."), F.length(F.regexp_replace(F.substring_index(text, ".", -1), "0+$", ""))).otherwise(0)
    whole = number & ~text.contains(".")

    def every(test: Column) -> Column:
        # NULL only where the text is NULL, and such rows say nothing.
        return F.min(F.when(text.isNotNull(), F.coalesce(test, F.lit(False))))

    return F.struct(
        F.count(text).alias("n"),
        every(text.isin("true", "false")).alias("boolean"),
        every(whole & text.try_cast("int").isNotNull()).alias("int"),
        every(whole & text.try_cast("bigint").isNotNull()).alias("bigint"),
        every(number).alias("number"),
        F.max(F.when(number, digits)).alias("digits"),
        F.max(F.when(number, scale)).alias("scale"),
        every(text.rlike(_DATE_TEXT) & text.try_cast("date").isNotNull()).alias("date"),
        every(text.rlike(f"{_DATE_TEXT}|{_TIME_TEXT}") & text.try_cast("timestamp_ntz").isNotNull()).alias("time"),
    )


def _least(found) -> T.DataType:
    if not found["n"]:
        return T.NullType()
    for test, kind in (("boolean", T.BooleanType()), ("int", T.IntegerType()), ("bigint", T.LongType())):
        if found[test]:
            return kind
    if found["number"] and found["digits"] + found["scale"] <= MOST_DIGITS:
        return T.DecimalType(found["digits"] + found["scale"], found["scale"])
    if found["date"]:
        return T.DateType()
    return T.TimestampNTZType() if found["time"] else T.StringType()


def wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """The least type that holds every value of both without loss; text where there is no other."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    whole = isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType)
    if whole:
        return max(left, right, key=lambda kind: _WHOLE_DIGITS[kind.simpleString()])
    exact = (T.IntegralType, T.DecimalType)
    if isinstance(left, exact) and isinstance(right, exact):
        (a, s), (b, t) = _places(left), _places(right)
        return T.DecimalType(max(a, b) + max(s, t), max(s, t)) if max(a, b) + max(s, t) <= MOST_DIGITS else T.StringType()
    kinds = {type(left), type(right)}
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if T.DoubleType in kinds and any(isinstance(kind, T.IntegralType) and _WHOLE_DIGITS[kind.simpleString()] <= 10 for kind in (left, right)):
        return T.DoubleType()
    return T.StringType()


def _places(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return _WHOLE_DIGITS[kind.simpleString()], 0


def widest(*types: Mapping[str, T.DataType]) -> dict[str, T.DataType]:
    """Column by column, the least type over several loads."""
    names = dict.fromkeys(name for kinds in types for name in kinds)
    return {name: reduce(wider, (kinds[name] for kinds in types if name in kinds)) for name in names}


def typed(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """The columns under the given types; ones without a value in sight stay text."""
    shown = {name: kind for name, kind in types.items() if not isinstance(kind, T.NullType)}
    return df.select(*[named(n).cast(shown[n]).alias(n) if n in shown else named(n) for n in df.columns])
