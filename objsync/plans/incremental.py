"""The cursor of an incremental sync: where it stands and what lies past it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.literals import utc_time
from objsync.functions.text import named
from objsync.sources.objects import after

STATE_SCHEMA = "resource string, cursor_field string, last_value string, value_type string, version long"


def high_value(df: DataFrame, cursor: str) -> str | None:
    """The highest cursor value as text, NULL for no rows; an instant is given in UTC, whatever the session's zone."""
    return df.agg(_text(F.max(named(cursor)), df.schema[cursor].dataType)).first()[0]


def high_pair(df: DataFrame, cursor: str, keys: Sequence[str]) -> tuple[str | None, list[str] | None]:
    """The highest cursor value and, of the rows that have it, the highest key, as text; no key for no rows."""
    columns = [cursor, *keys]
    top = F.max(F.struct(*[named(c).alias(f"_{n}") for n, c in enumerate(columns)]))
    texts = [_text(F.col("top").getField(f"_{n}"), df.schema[c].dataType).alias(f"_{n}") for n, c in enumerate(columns)]
    value, *key = df.agg(top.alias("top")).filter("top is not null").select(*texts).first() or (None,)
    return value, key or None


def _text(value: Column, kind: T.DataType) -> Column:
    return F.concat(utc_time(value).cast("string"), F.lit("Z")) if isinstance(kind, T.TimestampType) else value.cast("string")


def past_boundary(df: DataFrame, cursor: str, last_value: Any, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows from the cursor value on that are not held yet.

    A strict bound loses rows that arrive late with the very value the last run
    ended on. The inclusive bound sees them, and the rows held at that value or
    later are taken out by key and cursor.
    """
    on = [*keys, cursor]
    seen = held.filter(after(held, cursor, last_value, inclusive=True)).select(*[named(n) for n in on])
    fresh = df.filter(after(df, cursor, last_value, inclusive=True))
    return fresh.join(seen, on, "left_anti").select(*[named(n) for n in df.columns])


def state_frame(spark: SparkSession, states: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """One row per resource from the states of its target tables."""
    rows = [
        (name, s.get("cursor_field"), s.get("last_value"), s.get("value_type"), s.get("version"))
        for name, s in states.items()
    ]
    return spark.createDataFrame(rows, STATE_SCHEMA)
