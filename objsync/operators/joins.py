"""Lookup joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from objsync.functions.text import all_named, named

SALT, SPREAD = "_salt", "_spread"


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The distinct keys in which no part is NULL; combined before the shuffle."""
    filled = reduce(lambda rows, key: rows.filter(named(key).isNotNull()), keys, df)
    return filled.select(*all_named(keys)).distinct()


def hot_keys(df: DataFrame, key: str, share: float = 0.01, tracked: int = 10_000) -> list:
    """Keys that hold more than ``share`` of the rows, from one sketch pass over the key column.

    At most ``1 / share`` keys can qualify, so the list is small at any scale.
    It only steers where rows go: a missed key costs speed, never rows.
    """
    filled = df.select(F.col(key).alias("key")).filter(F.col("key").isNotNull())
    found = filled.agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(key, {int(1 / share)}, {tracked})").alias("top")
    ).first()
    return [entry["item"] for entry in found["top"] or [] if entry["count"] > share * found["n"]]


def split_join(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join on equal-named keys whose hot keys are split at run time, also against an aggregate on those keys.

    Spark splits a skewed join only between two shuffles made for it. An aggregate on
    the same keys would be joined where it lies; a hash of the keys as one more join
    key asks for a shuffle of its own, and the aggregated side is the small one.
    """
    spread = F.xxhash64(*all_named(keys))
    return rows.withColumn(SPREAD, spread).join(other.withColumn(SPREAD, spread), [*keys, SPREAD], how).drop(SPREAD)


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left",
                hot: list | None = None, salt: int = 32) -> DataFrame:
    """Join rows to a lookup on one equal-named key.

    Without ``hot`` Spark broadcasts the lookup if its size allows and otherwise
    splits skewed partitions at run time. With a list
    of hot keys, the rows of each (and rows without a key) are spread over
    ``salt`` tasks, and only the hot lookup rows are repeated to meet them.
    """
    if hot is None:
        return split_join(rows, lookup, [key], how)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    spread = F.coalesce(is_hot, F.lit(True))
    salted = rows.withColumn(SALT, F.when(spread, _slot(rows, salt)).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salt - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(lookup.withColumn(SALT, F.explode(copies)), [key, SALT], how).drop(SALT)


def _slot(rows: DataFrame, salt: int) -> Column:
    """A slot that a retried task computes again exactly; equal rows differ by input partition."""
    plain = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(salt)).cast("int")
