"""Tables whose content changes by adding a folder and then naming it in a commit file.

Parquet folders cannot be overwritten while they are read, and have no MERGE. A
change therefore writes new folders, and one small JSON file listing the folders
of the new version, with the schema and the sync state, makes them visible. A
job that fails leaves folders no commit names. Writers must not overlap: a
second commit of the same version is refused.

A bucketed table spreads its rows over folders by a rule on their key, and an
update by key rewrites only the buckets its batch touches. ``buckets=n`` is a hash
rule for batches of any keys; ``bucket_by`` takes a SQL expression with a whole
number, such as ``id div 1000000``, which keeps keys that change together in few
buckets. The layout is part of every commit, so a table is always opened with the
one it was written in.

``stats`` names further columns by which rows are looked for. Each folder written from then on
gets their ranges and a filter of their values beside it (``_stats``), so that a lookup, a
delete or an upsert by such a column reads and rewrites only folders that may hold its keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import named
from objsync.operators.dedup import keep_last, merge_latest
from objsync.operators.inference import inferred_types, typed, wider
from objsync.operators.joins import distinct_keys, split_join
from objsync.plans.key_stats import folders_that_may_hold, write_stats

BUCKET = "bucket"
# A bucket is a folder and an entry of every commit; a rule that makes more of them is a mistake.
MOST_BUCKETS = 100_000


@dataclass(frozen=True)
class Commit:
    """One version: its schema, its folders with the bucket of each, the layout, and the sync state.

    ``changes`` are folders of changed rows in the order they came, each with the
    buckets that hold its rows already; ``order_by`` says which row of a key is the latest.
    ``stats`` are the written folders that have statistics, with the columns and types of these.
    """

    version: int
    schema: T.StructType
    folders: tuple[tuple[int | None, str], ...]
    keys: tuple[str, ...] = ()
    rule: str | None = None
    state: dict[str, Any] = field(default_factory=dict)
    changes: tuple[tuple[str, tuple[int, ...]], ...] = ()
    order_by: tuple[str, ...] = ()
    stats_columns: tuple[str, ...] = ()
    stats: tuple[tuple[str, dict[str, str]], ...] = ()


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), buckets: int = 0,
                 bucket_by: str | None = None, stats: Sequence[str] = ()):
        if (buckets or bucket_by) and not keys:
            raise ValueError("Buckets need key columns")
        self._spark, self.path, self.stats = spark, path.rstrip("/"), list(stats)
        self.keys, self.rule = list(keys), bucket_by or (_hash_rule(keys, buckets) if buckets else None)
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        self._files = self._hadoop.Path(self.path).getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._files.getUri(), conf)
        self._adopt_layout()

    def _adopt_layout(self) -> None:
        held = self.current()
        if held is None:
            return
        if self.rule and (tuple(self.keys), self.rule) != (held.keys, held.rule):
            raise ValueError(f"{self.path} has keys {list(held.keys)} and buckets by {held.rule}")
        self.keys, self.rule = list(held.keys), held.rule
        self.stats = self.stats or list(held.stats_columns)

    def current(self) -> Commit | None:
        """The latest commit, if any."""
        folder = self._hadoop.Path(f"{self.path}/_commits")
        if not self._files.exists(folder):
            return None
        names = [name for name in self._names(folder) if name.endswith(".json") and not name.startswith(".")]
        return self._load(max(names)) if names else None

    @property
    def state(self) -> dict[str, Any]:
        commit = self.current()
        return dict(commit.state) if commit else {}

    def read(self, buckets: Iterable[int] | None = None, at: Commit | None = None,
             folders: Iterable[str] | None = None) -> DataFrame:
        """The rows of the latest (or a given) version, of all or some buckets, or of some folders without change folders.

        Change folders are merged on the way: their latest rows are the small side of the
        joins, so the rows of the buckets are not shuffled for them below Spark's broadcast limit.
        """
        commit = at or self.current()
        if commit is None:
            raise FileNotFoundError(f"Nothing was committed to {self.path}")
        wanted = None if buckets is None else set(buckets)
        if folders is not None:
            some = [f"{self.path}/{path}" for path in sorted(folders)]
            return self._spark.read.schema(commit.schema).parquet(*some) if some else self._spark.createDataFrame([], commit.schema)
        paths = [f"{self.path}/{p}" for b, p in commit.folders if wanted is None or b in wanted]
        rows = self._spark.read.schema(commit.schema).parquet(*paths) if paths else self._spark.createDataFrame([], commit.schema)
        changed = self._changed(commit, wanted)
        if changed is None:
            return rows
        return merge_latest(rows, changed, self.keys, commit.order_by).select(*[named(n) for n in commit.schema.names])

    def _changed(self, commit: Commit, wanted: set[int] | None = None) -> DataFrame | None:
        """The latest row of each key in the change folders; None where there are none."""
        parts: dict[tuple[int, ...], list[str]] = {}
        for path, folded in commit.changes:
            parts.setdefault(folded, []).append(f"{self.path}/{path}")
        rows = None
        for folded, paths in parts.items():
            part = self._spark.read.schema(commit.schema).parquet(*paths)
            if folded:
                part = part.filter(~self._bucket_of().isin(list(folded)))
            rows = part if rows is None else rows.unionByName(part)
        if rows is None:
            return None
        if wanted is not None and self.rule:
            rows = rows.filter(self._bucket_of().isin(list(wanted)) if wanted else F.lit(False))
        return keep_last(rows, self.keys, list(commit.order_by))

    def fitted(self, rows: DataFrame, base: Commit | None = None) -> DataFrame:
        """The rows with the column types of the latest (or a given) version.

        Text is parsed and numbers are converted where that loses nothing; a value
        that does not fit fails the job, and a type that cannot be converted is
        refused at once. Columns that the table lacks stay as they are.
        """
        commit = base or self.current()
        return _fitted(rows, commit.schema) if commit else rows

    def touched(self, batch: DataFrame) -> set[int] | None:
        """The buckets that hold the keys of a batch; never more than there are buckets, and ``MOST_BUCKETS`` at most."""
        if not self.rule:
            return None
        batch = self.fitted(batch)
        found = batch.select(self._bucket_of()).distinct().limit(MOST_BUCKETS + 1).collect()
        if len(found) > MOST_BUCKETS:
            raise ValueError(f"The rule '{self.rule}' makes more than {MOST_BUCKETS} buckets of one batch")
        return {row[0] for row in found}

    def folders_with(self, keys: DataFrame, base: Commit | None = None) -> set[str] | None:
        """The folders that may hold a row with the given keys, by the statistics; None where these cannot tell.

        ``keys`` has columns of the table; each that has statistics narrows the folders. A folder
        without statistics of a column in its present type counts as holding all keys.
        """
        commit = base or self.current()
        if commit is None or commit.changes:
            return None
        kinds = {f.name.lower(): f.dataType for f in commit.schema.fields}
        every = {path for _, path in commit.folders}
        found = None
        for name in keys.columns:
            kind = kinds.get(name.lower())
            if kind is None or keys.schema[name].dataType.simpleString() != kind.simpleString():
                continue
            known = {folder for folder, columns in commit.stats if columns.get(name.lower()) == kind.simpleString()}
            if not known:
                continue
            unknown = {path for path in every if path.partition("/")[0] not in known}
            held = folders_that_may_hold(self._spark, [f"{self.path}/_stats/{f}" for f in sorted(known)], keys, name, kind)
            if held is not None:
                found = (every if found is None else found) & (held | unknown)
        return found

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows that have the given keys, from the folders that may hold them."""
        commit = self.current()
        wanted = distinct_keys(self.fitted(keys, commit), *keys.columns)
        folders = self.folders_with(wanted, commit)
        return split_join(self.read(at=commit, folders=folders), wanted, wanted.columns, "left_semi").select(
            *[named(n) for n in commit.schema.names])

    def append(self, df: DataFrame, **state: Any) -> Commit:
        """Add rows beside the present ones."""
        return self.publish(self.prepare_append(df, **state))

    def replace(self, df: DataFrame, buckets: Iterable[int] | None = None, base: Commit | None = None,
                **state: Any) -> Commit:
        """Make these rows the whole table, or the whole of some buckets.

        ``base`` is the version the rows were made from; if another one has been
        committed since, the commit is refused, so no update gets lost.
        """
        return self.publish(self.prepare_replace(df, buckets, base, **state))

    def append_texts(self, texts: DataFrame, **state: Any) -> Commit:
        """Append text columns under the types their values have; columns of the table widen where these ask for it.

        The types come from all rows of the load, and a column without any value says nothing. A column
        that held whole numbers and now gets fractions becomes a decimal, one that gets
        words becomes text, in the commit that adds the rows.
        """
        base = self.current()
        held = {f.name.lower(): f.dataType for f in base.schema.fields} if base else {}
        found = inferred_types(texts)
        kinds = {name: wider(held.get(name.lower(), kind), kind) for name, kind in found.items() if not isinstance(kind, T.NullType)}
        # A column without a value gets its type from the first load that has one.
        known = [n for n in texts.columns if n in kinds or n not in found or n.lower() in held] or texts.columns
        if base is None:
            return self.append(typed(texts.select(*[named(n) for n in known]), kinds), **state)
        commit = self.prepare_append(typed(texts.select(*[named(n) for n in known]), kinds), self.prepare_widen(kinds, base), **state)
        return self.publish(replace(commit, version=base.version + 1))

    def widen(self, types: Mapping[str, T.DataType], **state: Any) -> Commit:
        """Give columns types that hold their values and those of the given types."""
        base = self.current()
        commit = self.prepare_widen(types, base, **state)
        return base if commit is base else self.publish(commit)

    def prepare_widen(self, types: Mapping[str, T.DataType], base: Commit | None = None, **state: Any) -> Commit:
        """The widened version; nothing is seen before ``publish``, and nothing is written if readers convert by themselves.

        Spark reads whole numbers as longer ones and floats as doubles. Any other change, and one
        that gives a key another text and so another bucket, writes the rows anew.
        """
        base = base or self.current()
        wanted = {name.lower(): kind for name, kind in types.items()}
        fields = [T.StructField(f.name, wider(f.dataType, wanted.get(f.name.lower(), f.dataType)), True) for f in base.schema.fields]
        moved = [(old, new) for old, new in zip(base.schema.fields, fields) if old.dataType != new.dataType]
        if not moved:
            return base
        if all(_reads_as(old.dataType, new.dataType, old.name in self.keys) for old, new in moved):
            return replace(base, version=base.version + 1, schema=T.StructType(fields), state={**base.state, **state})
        rows = self.read(at=base)
        rows = rows.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in fields])
        return self._prepare(base, rows, lambda old, new: new, state)

    def prepare_append(self, df: DataFrame, base: Commit | None = None, **state: Any) -> Commit:
        """Write the folders of an append; nothing is seen before ``publish``."""
        base = base or self.current()
        commit = self._prepare(base, df, lambda old, new: old + new, state)
        return replace(commit, changes=base.changes, order_by=base.order_by) if base else commit

    def prepare_change(self, df: DataFrame, order_by: Sequence[str], **state: Any) -> Commit:
        """Write rows that replace or join those of their keys, alone; nothing is seen before ``publish``.

        The row with the highest ``order_by`` values is the one of its key, whether it comes
        with this change, an earlier one or lies in a bucket. Costs follow the change and not the table.
        """
        base = self.current()
        if not self.keys or not order_by:
            raise ValueError("A change needs the table's keys and columns to order by")
        if base is None:
            return self._prepare(None, keep_last(df, self.keys, list(order_by)), lambda old, new: new, state)
        if base.changes and tuple(order_by) != base.order_by:
            raise ValueError(f"{self.path} holds changes ordered by {list(base.order_by)}; compact it first")
        version = base.version + 1
        folder = f"v={version}-{uuid.uuid4().hex}"
        df = _fitted(df, base.schema)
        self._check_rule(df)
        df.write.parquet(f"{self.path}/{folder}")
        return Commit(version, _union_schema(base.schema, df.schema), base.folders, tuple(self.keys), self.rule,
                      {**base.state, **state}, (*base.changes, (folder, ())), tuple(order_by))

    def compact(self, **state: Any) -> Commit | None:
        """Fold all change folders into the buckets they touch (or the whole table, if it has none)."""
        base = self.current()
        changed = self._changed(base) if base else None
        if changed is None:
            return base
        touched = self.touched(changed)
        return self.publish(replace(self.prepare_replace(self.read(touched, base), touched, base, **state), changes=(), order_by=()))

    def prepare_replace(self, df: DataFrame, buckets: Iterable[int] | None = None, base: Commit | None = None,
                        folders: Iterable[str] | None = None, **state: Any) -> Commit:
        """Write the folders of a replacement, of all, some buckets or some folders; nothing is seen before ``publish``."""
        base = base or self.current()
        if folders is not None:
            left = set(folders)
            return self._prepare(base, df, lambda old, new: tuple(f for f in old if f[1] not in left) + new, state)
        if buckets is None:
            return self._prepare(base, df, lambda old, new: new, state)
        gone = set(buckets)
        commit = self._prepare(base, df, lambda old, new: tuple(f for f in old if f[0] not in gone) + new, state)
        # The new buckets hold what was changed in them.
        changes = tuple((path, tuple(sorted(gone.union(folded)))) for path, folded in base.changes) if base else ()
        return replace(commit, changes=changes, order_by=base.order_by if changes else ())

    def expire(self, keep: int = 1) -> int:
        """Delete the folders that none of the last ``keep`` versions names, and older commits; returns how many folders.

        Folders of stored ties (``_ties``) go the same way. Readers of older versions and unfinished writers must be gone.
        """
        folder = self._hadoop.Path(f"{self.path}/_commits")
        commits = sorted(name for name in self._names(folder) if name.endswith(".json") and not name.startswith("."))
        last = [self._load(name) for name in commits[-max(keep, 1):]]
        kept = {path for commit in last for _, path in (*commit.folders, *((None, path) for path, _ in commit.changes))}
        written = [v for v in self._names(self._hadoop.Path(self.path)) if v.startswith("v=")]
        dropped = 0
        for version in written:
            names = self._names(self._hadoop.Path(f"{self.path}/{version}"))
            inner = [f"{version}/{name}" for name in names if name.startswith(f"{BUCKET}=")]
            gone = [path for path in inner or [version] if path not in kept]
            for path in [version] if inner and len(gone) == len(inner) else gone:
                self._files.delete(self._hadoop.Path(f"{self.path}/{path}"), True)
            dropped += len(gone)
        ties = self._hadoop.Path(f"{self.path}/_ties")
        named_ties = {str(commit.state.get("ties") or "").rpartition("/")[2] for commit in last}
        for name in self._names(ties) if self._files.exists(ties) else ():
            if name not in named_ties:
                self._files.delete(self._hadoop.Path(f"{self.path}/_ties/{name}"), True)
                dropped += 1
        stats = self._hadoop.Path(f"{self.path}/_stats")
        named_stats = {folder for commit in last for folder, _ in commit.stats}
        for name in self._names(stats) if self._files.exists(stats) else ():
            if name not in named_stats:
                self._files.delete(self._hadoop.Path(f"{self.path}/_stats/{name}"), True)
        for name in commits[: -max(keep, 1)]:
            self._files.delete(self._hadoop.Path(f"{self.path}/_commits/{name}"), False)
        return dropped

    def _names(self, folder) -> list[str]:
        return [status.getPath().getName() for status in self._files.listStatus(folder)]

    def _bucket_of(self) -> Column:
        return F.coalesce(F.expr(self.rule).cast("long"), F.lit(-1).cast("long")).alias(BUCKET)

    def _check_rule(self, df: DataFrame) -> None:
        """Refuse a rule that reads more than the keys: rows of one key must share a bucket."""
        if self.rule:
            try:
                df.select(*[named(key) for key in self.keys]).select(self._bucket_of())
            except AnalysisException as error:
                raise ValueError(f"The rule '{self.rule}' must read the keys {self.keys} only: {error}") from None

    def _prepare(self, base: Commit | None, df: DataFrame, arrange, state: dict[str, Any]) -> Commit:
        version = base.version + 1 if base else 1
        folder = f"v={version}-{uuid.uuid4().hex}"
        # Folders that stay fix the types of what is written beside them.
        kept = bool(base and arrange(base.folders, ()))
        if kept:
            df = _fitted(df, base.schema)
        self._check_rule(df)
        written = self._write(df, folder)
        folders = arrange(base.folders if base else (), written)
        schema = _union_schema(base.schema, df.schema) if kept else df.schema
        state = {**(base.state if base else {}), **state}
        stats = (*(base.stats if base else ()), *self._write_stats(folder, df.schema, bool(written)))
        in_use = {path.partition("/")[0] for _, path in folders}
        return Commit(version, schema, folders, tuple(self.keys), self.rule, state, stats_columns=tuple(self.stats),
                      stats=tuple(entry for entry in stats if entry[0] in in_use))

    def _write_stats(self, folder: str, schema: T.StructType, rows: bool) -> tuple[tuple[str, dict[str, str]], ...]:
        """The statistics of a folder that was just written, from its key columns."""
        if not self.stats or not rows:
            return ()
        if self.rule:
            held = self._spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.LongType())])).parquet(f"{self.path}/{folder}")
            of_row = F.concat(F.lit(f"{folder}/{BUCKET}="), F.col(BUCKET).cast("string"))
        else:
            held, of_row = self._spark.read.schema(schema).parquet(f"{self.path}/{folder}"), F.lit(folder)
        columns = write_stats(held, of_row, self.stats, f"{self.path}/_stats/{folder}")
        return ((folder, columns),) if columns else ()

    def _write(self, df: DataFrame, folder: str) -> tuple[tuple[int | None, str], ...]:
        if not self.rule:
            df.write.parquet(f"{self.path}/{folder}")
            return ((None, folder),)
        # The rebalance splits an oversized bucket over several tasks and packs small ones.
        spread = df.withColumn(BUCKET, self._bucket_of()).hint("rebalance", F.col(BUCKET))
        spread.write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        names = sorted(self._names(self._hadoop.Path(f"{self.path}/{folder}")))
        return tuple(
            (int(name.partition("=")[2]), f"{folder}/{name}") for name in names if name.startswith(f"{BUCKET}=")
        )

    def publish(self, commit: Commit) -> Commit:
        """Make a prepared version the current one; refused if its number is taken."""
        self._publish(commit)
        return commit

    def _publish(self, commit: Commit) -> None:
        """Write aside, then rename without overwrite: a commit is seen whole or not at all."""
        name = f"{commit.version:012d}.json"
        aside = self._hadoop.Path(f"{self.path}/_commits/.{name}.{uuid.uuid4().hex}")
        body = {
            "version": commit.version,
            "schema": commit.schema.jsonValue(),
            "folders": commit.folders,
            "keys": commit.keys,
            "rule": commit.rule,
            "state": commit.state,
            "changes": commit.changes,
            "order_by": commit.order_by,
            "stats_columns": commit.stats_columns,
            "stats": commit.stats,
        }
        out = self._files.create(aside, False)
        out.write(json.dumps(body).encode())
        out.close()
        rename = self._spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        self._context.rename(aside, self._hadoop.Path(f"{self.path}/_commits/{name}"), rename)

    def _load(self, name: str) -> Commit:
        stream = self._files.open(self._hadoop.Path(f"{self.path}/_commits/{name}"))
        body = json.loads(bytes(stream.readAllBytes()))
        stream.close()
        return Commit(
            body["version"],
            T.StructType.fromJson(body["schema"]),
            tuple((bucket, path) for bucket, path in body["folders"]),
            tuple(body["keys"]),
            body["rule"],
            body["state"],
            tuple((path, tuple(folded)) for path, folded in body.get("changes", ())),
            tuple(body.get("order_by", ())),
            tuple(body.get("stats_columns", ())),
            tuple((folder, columns) for folder, columns in body.get("stats", ())),
        )


def _hash_rule(keys: Sequence[str], buckets: int) -> str:
    """A hash of the keys' text, so that an int and a bigint of one value agree, and zero with minus zero."""
    texts = ", ".join(f"if(string(`{key}`) = '-0.0', '0.0', string(`{key}`))" for key in keys)
    return f"pmod(xxhash64({texts}), {buckets})"


def _fitted(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows under the types of a schema, as far as it has their columns."""
    wanted = {f.name.lower(): f.dataType for f in schema.fields}
    casts = {}
    for column in rows.schema.fields:
        target = wanted.get(column.name.lower(), column.dataType)
        if column.dataType.simpleString() == target.simpleString():
            continue
        value = named(column.name)
        numbers = isinstance(column.dataType, T.NumericType) and isinstance(target, T.NumericType)
        if not (numbers or isinstance(column.dataType, (T.StringType, T.NullType)) and isinstance(target, T.AtomicType)
                or isinstance(target, T.StringType) and isinstance(column.dataType, T.AtomicType)):
            raise ValueError(f"Column '{column.name}' is {column.dataType.simpleString()}, the table has {target.simpleString()}")
        cast = value.try_cast(target)
        # What comes back must be what was given; text may be spelt in another way.
        same = cast.try_cast(column.dataType).eqNullSafe(value) if numbers else _same_value(value, cast, target)
        wrong = F.raise_error(F.concat(F.lit(f"Value of '{column.name}' does not fit {target.simpleString()}: "), value.cast("string")))
        casts[column.name] = F.when(value.isNull() | same, cast).otherwise(wrong.cast(target))
    return rows.select(*[casts.get(n, named(n)).alias(n) for n in rows.columns]) if casts else rows


def _same_value(text: Column, cast: Column, target: T.DataType) -> Column:
    """Whether a text still has its value after a cast: no digit, time of day or fraction of a second is lost."""
    if isinstance(target, (T.FractionalType, T.DecimalType)):
        exact = "decimal(38,18)"
        written = cast.cast("string") if not isinstance(target, T.DecimalType) else cast
        digits = text.try_cast(exact) == written.try_cast(exact)
        # Beyond what a decimal holds, as 1e300 or NaN, doubles are compared.
        return cast.isNotNull() & F.coalesce(digits, text.try_cast("double") == written.try_cast("double"), F.lit(False))
    if isinstance(target, T.DateType):
        return cast.isNotNull() & text.try_cast("timestamp_ntz").eqNullSafe(cast.cast("timestamp_ntz"))
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return cast.isNotNull() & ~text.cast("string").rlike(r"\.\d{6}0*[1-9]")
    return cast.isNotNull()


def _reads_as(old: T.DataType, new: T.DataType, key: bool) -> bool:
    """Whether Spark reads files of one type as another, without a change of a key's text."""
    if isinstance(old, T.IntegralType) and isinstance(new, T.IntegralType):
        return True
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType) and not key


def _union_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """All columns of both, nullable; folders that lack a column read as NULL."""
    held = {f.name.lower() for f in old.fields}
    added = [f for f in new.fields if f.name.lower() not in held]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in [*old.fields, *added]])
