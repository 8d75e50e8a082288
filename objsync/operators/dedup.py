"""One row per key: the latest one, or none at all when a key repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync.functions.text import all_named, named
from objsync.operators.joins import split_join


def keep_last(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row with the highest ``order_by`` values per key.

    An aggregate instead of a window: each input partition is reduced to one row
    per key before the shuffle, so a hot key never meets in one task. The order
    must be total for a repeatable result.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.select(*all_named(keys)).distinct()
    last = F.max_by(F.struct(*all_named(rest)), F.struct(*all_named(order_by))).alias("_last")
    return df.groupBy(*all_named(keys)).agg(last).select(
        *(F.col("_last").getField(n).alias(n) if n in rest else named(n) for n in df.columns))


def merge_latest(target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The target after changes that have one row per key: the later row by ``order_by`` stays.

    A change that arrives late does not replace a newer row. Only the target rows
    whose key occurs in the changes are compared; the others pass through.
    """
    changed = changes.select(*all_named(keys))
    rivals = split_join(target, changed, list(keys), "left_semi").select(*all_named(target.columns))
    untouched = split_join(target, changed, list(keys), "left_anti").select(*all_named(target.columns))
    both = rivals.unionByName(changes, allowMissingColumns=True)
    return untouched.unionByName(keep_last(both, list(keys), list(order_by)), allowMissingColumns=True)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once; counted before the shuffle."""
    return df.groupBy(*all_named(keys)).agg(F.count("*").alias("_n")).filter("_n > 1").select(*all_named(keys))
