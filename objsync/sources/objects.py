"""Extract objects: field list, parent lookups, user filter, cursor and optional limit.

An ``ObjectStore`` says how an object name becomes a DataFrame and which parents
it can look up. ``extract`` only describes the work, so column pruning and
filter push-down reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.config import ResourceConfig, validate_resources
from objsync.functions.rules import check_name
from objsync.functions.text import named
from objsync.operators.mapping import apply_types


@dataclass(frozen=True)
class Parent:
    """A many-to-one lookup: child column ``foreign_key`` holds the parent's ``parent_key``.

    A parent key that repeats fails the job when a row uses it; ``unique`` says that
    none does and spares the aggregate that finds out.
    """

    object: str
    foreign_key: str
    parent_key: str
    unique: bool = False


@dataclass(frozen=True)
class ObjectStore:
    """Named objects and the parents reachable from each of them."""

    load: Callable[[str], DataFrame]
    parents: Mapping[str, Mapping[str, Parent]] = field(default_factory=dict)


def file_store(spark: SparkSession, root: str, fmt: str = "parquet", suffix: str | None = None,
               parents: Mapping[str, Mapping[str, Parent]] | None = None, **options: Any) -> ObjectStore:
    """Objects as files ``root/<name><suffix>`` of any Spark format; each load lists the files anew."""
    ending = f".{fmt}" if suffix is None else suffix
    return ObjectStore(lambda name: spark.read.format(fmt).options(**options).load(f"{root}/{name}{ending}"), parents or {})


def table_store(spark: SparkSession, database: str | None = None,
                parents: Mapping[str, Mapping[str, Parent]] | None = None) -> ObjectStore:
    """Objects as catalog tables."""
    return ObjectStore(lambda name: spark.table(f"{database}.{name}" if database else name), parents or {})


def jdbc_store(spark: SparkSession, url: str, split: Mapping[str, tuple[str, Any, Any]] | None = None,
               partitions: int = 64, parents: Mapping[str, Mapping[str, Parent]] | None = None,
               **options: Any) -> ObjectStore:
    """Objects as database tables; ``split`` names column and bounds that cut a large one into parallel reads."""

    def load(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
        if split and name in split:
            column, low, high = split[name]
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high,
                                    numPartitions=partitions)
        return reader.load()

    return ObjectStore(load, parents or {})


def extract(store: ObjectStore, config: ResourceConfig, last_value: Any = None, inclusive: bool = False,
            last_key: Sequence[Any] | None = None) -> DataFrame:
    """The selected rows of one object.

    Dotted fields walk to parents and keep the dotted name; the filter may use
    the object's own columns, the selected dotted fields and ``filter_fields``.
    The cursor bound is strict (unless ``inclusive``) and applies from the second run on, when
    ``last_value`` is known. With ``last_key``, the key of the last row read, the bound is the
    pair of both: a limited extract goes on among rows of one cursor value, and behind
    rows without one, which come first. Rows are sorted only for a limit, by cursor then key,
    because a sort no limit follows would be a full shuffle for nothing.
    """
    if not config.fields:
        raise ValueError(f"Resource '{config.name}' selects no fields")
    rows = with_parents(store, config.object, [check_name(f) for f in (*config.fields, *config.filter_fields)])
    if config.query_filter is not None and not _is_blank(config.query_filter):
        rows = rows.filter(config.query_filter)
    if config.replication_key and last_key is not None:
        rows = rows.filter(after_pair(rows, config.replication_key, last_value, config.keys, last_key))
    elif config.replication_key and last_value is not None:
        rows = rows.filter(after(rows, config.replication_key, last_value, inclusive))
    if config.limit is not None:
        rows = rows.orderBy(*filter(None, (config.replication_key, *config.keys))).limit(config.limit)
    return apply_types(rows.select(*(F.col(name).alias(name) for name in config.fields)), config.column_types)


def _is_blank(condition: str | Column) -> bool:
    return isinstance(condition, str) and not condition.strip()


def after(rows: DataFrame, cursor: str, last_value: Any, inclusive: bool = False) -> Column:
    """The cursor bound as a constant of the column's own type, which the scan can use."""
    bound = F.lit(last_value).cast(rows.select(named(cursor)).schema[0].dataType)
    return named(cursor) >= bound if inclusive else named(cursor) > bound


def after_pair(rows: DataFrame, cursor: str, last_value: Any, keys: Sequence[str], last_key: Sequence[Any]) -> Column:
    """The bound (cursor, key) > (last value, last key); its first part is a plain one that the scan can use."""
    kinds = rows.select(*[named(key) for key in keys]).schema
    last = F.struct(*[F.lit(value).cast(kind.dataType).alias(kind.name) for value, kind in zip(last_key, kinds, strict=True)])
    further = F.struct(*[named(key).alias(kind.name) for key, kind in zip(keys, kinds, strict=True)]) > last
    if last_value is None:
        return named(cursor).isNotNull() | further
    return after(rows, cursor, last_value, inclusive=True) & (after(rows, cursor, last_value) | further)


def with_parents(store: ObjectStore, name: str, fields: Iterable[str]) -> DataFrame:
    """Left-join the parents that dotted fields walk to, each as a struct column within its child.

    A struct lets ``Owner.Role.Title`` be selected or filtered by that very text.
    It holds only the fields named and the keys of further parents; fields on one
    path share its join. Every parent joins the growing row by itself, so that
    Spark sees its true size and broadcasts a small one.
    """
    needed: dict[str, set[str]] = {}
    for path, _, column in (field.rpartition(".") for field in fields if "." in field):
        for prefix in _prefixes(path):
            needed.setdefault(prefix, set())
        needed[path].add(column)
    paths = sorted(needed, key=lambda path: (path.count("."), path))
    objects, parents = {"": name}, {}
    for path in paths:
        above, _, relation = path.rpartition(".")
        parents[path] = _parent(store, objects[above], relation)
        objects[path] = parents[path].object
        if above:
            needed[above].add(parents[path].foreign_key)
    base = store.load(name)
    rows, flat = base, {path: f"_{n}_" for n, path in enumerate(paths)}
    for path in paths:
        above, parent = path.rpartition(".")[0], parents[path]
        lookup = store.load(parent.object).select(
            F.col(parent.parent_key).alias("_key"), *(F.col(c).alias(flat[path] + c) for c in sorted(needed[path]))
        )
        if not parent.unique:
            lookup = _once(lookup, f"{parent.object}.{parent.parent_key}")
        foreign = F.col(flat[above] + parent.foreign_key if above else parent.foreign_key)
        rows = rows.join(lookup, foreign == F.col("_key"), "left").drop("_key")

    def nested(path: str) -> Column:
        inner = [p for p in paths if p.rpartition(".")[0] == path]
        return F.struct(*(F.col(flat[path] + c).alias(c) for c in sorted(needed[path])), *map(nested, inner)).alias(
            path.rpartition(".")[2]
        )

    return rows.select(*base.columns, *(nested(path) for path in paths if "." not in path)) if paths else rows


def _once(lookup: DataFrame, name: str) -> DataFrame:
    """One row per ``_key``; using a key that repeats raises."""
    values = [c for c in lookup.columns if c != "_key"]
    several = F.raise_error(F.concat(F.lit(f"More than one row for {name} = "), F.col("_key").cast("string")))
    kept = lookup.groupBy("_key").agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in values])
    return kept.select("_key", *[F.when(F.col("_n") == 1, F.col(c)).otherwise(several).alias(c) for c in values])


def _prefixes(path: str) -> list[str]:
    parts = path.split(".")
    return [".".join(parts[: n + 1]) for n in range(len(parts))]


def _parent(store: ObjectStore, name: str, relation: str) -> Parent:
    try:
        return store.parents[name][relation]
    except KeyError:
        raise ValueError(f"Object '{name}' has no parent '{relation}'") from None


def extract_all(store: ObjectStore, configs: Iterable[Mapping[str, Any] | ResourceConfig],
                last_values: Mapping[str, Any] | None = None) -> dict[str, DataFrame]:
    """One lazy DataFrame per checked resource, in the order given."""
    seen = last_values or {}
    return {c.name: extract(store, c, seen.get(c.name)) for c in validate_resources(configs)}


def row_counts(frames: Mapping[str, DataFrame], total: str | None = None) -> DataFrame:
    """(resource, n): rows per resource and, when named, their sum."""
    counts = reduce(
        DataFrame.unionByName,
        (df.agg(F.count("*").alias("n")).select(F.lit(name).alias("resource"), "n") for name, df in frames.items()),
    )
    if total is None:
        return counts
    return (
        counts.rollup("resource").agg(F.sum("n").alias("n"))
        .withColumn("resource", F.coalesce("resource", F.lit(total)))
    )


def high_values(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(resource, cursor_field, last_value): the highest cursor seen per resource, as text."""
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.max(cursor).cast("string").alias("last_value"))
            .select(F.lit(name).alias("resource"), F.lit(cursor).alias("cursor_field"), "last_value")
            for name, (df, cursor) in frames.items()
        ),
    )
