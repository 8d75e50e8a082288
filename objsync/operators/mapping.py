"""Record mapping: rename, constants, required keys, types, flattening and schema evolution."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import is_filled, is_not

# Loader type names and the Spark type of each.
TYPE_NAMES = {
    "text": "string",
    "bigint": "bigint",
    "double": "double",
    "bool": "boolean",
    "timestamp": "timestamp",
    "date": "date",
    "decimal": "decimal(18,2)",
    "binary": "binary",
    "json": "string",
}


def map_columns(df: DataFrame, mapping: Mapping[str, str | Column], strict: bool = True) -> DataFrame:
    """Select ``{output: source column or expression}`` and drop everything else.

    A missing source column raises when strict and is NULL otherwise. One source
    may feed several outputs.
    """
    present = {name.lower() for name in df.columns}
    sources = [source for source in mapping.values() if isinstance(source, str)]
    missing = [name for name in sources if name.lower() not in present]
    if strict:
        require_columns(df, sources)

    def one(output: str, source: str | Column) -> Column:
        if isinstance(source, Column):
            return source.alias(output)
        if source in missing:
            return F.lit(None).cast("string").alias(output)
        return F.col(f"`{source}`").alias(output)

    return df.select(*(one(output, source) for output, source in mapping.items()))


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Raise before any job runs when a column is missing."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in names if name.lower() not in present]
    if missing:
        raise ValueError(f"Columns not found: {missing}")
    return df


def spelled(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Column names the way the DataFrame writes them; raises for one it lacks."""
    names = list(names)
    require_columns(df, names)
    written = {name.lower(): name for name in df.columns}
    return [written[name.lower()] for name in names]


def require_filled(df: DataFrame, *keys: str) -> DataFrame:
    """Skip rows whose key is NULL or empty."""
    return df.filter(reduce(lambda a, b: a & b, (is_filled(F.col(key)) for key in keys)))


def exclude_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop the rows of one category; rows without a category stay."""
    return df.filter(is_not(F.col(column), value))


def apply_types(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns by loader or Spark type name; ``strict=False`` turns bad values into NULL."""
    columns = {name.lower(): name for name in df.columns}
    casts = {}
    for column, type_name in types.items():
        if column.lower() not in columns:
            continue
        name = columns[column.lower()]
        source, target = F.col(f"`{name}`"), TYPE_NAMES.get(type_name, type_name)
        casts[name] = source.cast(target) if strict else source.try_cast(target)
    return df.withColumns(casts) if casts else df


def flatten(df: DataFrame, separator: str = "__") -> DataFrame:
    """Structs of any depth as ``parent__child`` columns; other columns are kept."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> Iterator[Column]:
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{part}`" for part in here)).alias(separator.join(here))

    return df.select(*leaves(df.schema, ()))


def explode_child(df: DataFrame, keys: list[str], array: str, index: str = "idx",
                  value: str = "value") -> DataFrame:
    """An array column as a child table: parent keys, position and element (structs flattened)."""
    child = df.select(*keys, F.posexplode(array).alias(index, value))
    return flatten(child)


def evolve_union(*frames: DataFrame) -> DataFrame:
    """Rows of several shapes under all their columns; absent ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def expand_records(df: DataFrame, expand: Callable[[pd.DataFrame], pd.DataFrame],
                   schema: T.StructType | str) -> DataFrame:
    """A user's own Python transform, one batch of records in and any number out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield expand(batch)

    return df.mapInPandas(run, schema)
