"""Column values as filter literals: quoted text, ISO dates and times, numbers, booleans, NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The literal formats.
DATE_FORMAT = "yyyy-MM-dd"


def utc_time(instant: Column) -> Column:
    """An instant as the wall time in UTC; neither daylight saving nor the session's zone plays a part."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def datetime_text(value: Column, data_type: T.DataType) -> Column:
    """yyyy-MM-ddTHH:mm:ss.SSSZ; an instant is given in UTC, a time without zone as it stands."""
    wall = utc_time(value) if isinstance(data_type, T.TimestampType) else value
    text = wall.cast("string")
    day, time = F.substring_index(text, " ", 1), F.substring_index(text, " ", -1)
    millis = F.rpad(F.regexp_extract(time, r"\.(\d{1,3})", 1), 3, "0")
    return F.concat(day, F.lit("T"), F.substring_index(time, ".", 1), F.lit("."), millis, F.lit("Z"))


def text_literal(text: Column, escape_backslash: bool = False) -> Column:
    """Text in single quotes, each inner quote behind a backslash."""
    if escape_backslash:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))


def number_literal(number: Column, floating: bool = False) -> Column:
    """Plain digits; an exponent only outside 0.0001 .. 1e16, where digits would mislead."""
    if not floating:
        return number.cast("string")
    shown = number.cast("string")
    digits = F.rtrim(shown.cast("decimal(38,20)").cast("string"), F.lit("0"))
    digits = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    size = F.abs(number)
    plain = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    return F.when(plain, digits).otherwise(shown)


def literal(value: Column, data_type: T.DataType) -> Column:
    """The literal of a column, chosen by its Spark type; NULL becomes the word NULL."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        shown = datetime_text(value, data_type)
    elif isinstance(data_type, T.DateType):
        shown = F.date_format(value, DATE_FORMAT)
    elif isinstance(data_type, T.BooleanType):
        shown = F.lower(value.cast("string"))
    elif isinstance(data_type, (T.FloatType, T.DoubleType)):
        shown = number_literal(value, floating=True)
    elif isinstance(data_type, T.NumericType):
        shown = number_literal(value)
    else:
        shown = text_literal(value.cast("string"))
    return F.coalesce(shown, F.lit("NULL"))


def with_literals(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add ``{output: source}`` literal columns, each by the type of its source."""
    return df.withColumns({out: literal(F.col(src), df.schema[src].dataType) for out, src in columns.items()})
