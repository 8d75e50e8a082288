"""Flows: a source, its transforms and a configured target, planned lazily or run with a commit."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.config import ResourceConfig, TargetConfig
from objsync.functions.text import named
from objsync.operators.keymap import resolved_ids
from objsync.operators.results import write_rejects
from objsync.operators.write import WritePlan, plan_write
from objsync.plans.incremental import high_pair, high_value, past_boundary
from objsync.plans.store import Commit, VersionedTable
from objsync.session import drop_folder, scratch_folder
from objsync.sources.objects import ObjectStore, extract

Transform = Callable[[DataFrame], DataFrame]
RESULT_SCHEMA = "job_id string, object string, operation string, records_processed long, records_failed long"


@dataclass(frozen=True)
class RunResult:
    """What a run did: rows read, rows refused and where they are, and the commit."""

    job_id: str
    object: str
    operation: str
    records_processed: int
    records_failed: int
    rejects_path: str | None
    commit: Commit | None

    @property
    def rows_loaded(self) -> int:
        return self.records_processed - self.records_failed

    def frame(self, spark: SparkSession) -> DataFrame:
        row = (self.job_id, self.object, self.operation, self.records_processed, self.records_failed)
        return spark.createDataFrame([row], RESULT_SCHEMA)


@dataclass(frozen=True)
class Flow:
    """Records from ``source`` through ``transforms`` into ``target``."""

    name: str
    source: DataFrame
    target: TargetConfig
    transforms: Sequence[Transform] = ()

    def records(self) -> DataFrame:
        return reduce(lambda df, step: df.transform(step), self.transforms, self.source)

    def plan(self, target: DataFrame, keymap: DataFrame | None = None) -> WritePlan:
        """The outcome as DataFrames; nothing runs."""
        return plan_write(target, self.records(), self.target, keymap)

    def run(self, spark: SparkSession, table: VersionedTable, keymap: DataFrame | None = None,
            rejects_root: str | None = None, staged: bool = False, **state) -> RunResult:
        """Stage the records, write the new version and the rejects, commit, and report.

        The staged copy is read by every later step, so the source is read once
        and a lost executor costs a re-read of the copy; ``staged`` says that the
        source is such a copy already. Inserts and replaces use the records once
        besides their count, which comes from the written copy too. No rows is an
        error unless the target allows it; any failure raises and commits nothing,
        and a plan that does not fit the target fails before the records are read.
        Rejects lie beside the table unless ``rejects_root`` is given; the commit
        holds their number and folder.
        """
        job = uuid.uuid4().hex
        held = table.current()
        records = self.records()
        self._write_plan(spark.createDataFrame([], held.schema if held else records.schema), records, keymap, not held)
        with Staging(spark) as staging:
            records = records if staged else staging.copy(records)
            processed = records.count()
            if processed == 0 and not self.target.allow_empty:
                raise ValueError(f"Flow '{self.name}' produced no rows")
            commit, plan = self._write(spark, table, records, keymap, state)
            failed, path = 0, None
            if self.target.operation in ("upsert", "merge", "delete"):
                failed = plan.rejects.count()  # from key columns; the rows are read only if there are any
                if failed:
                    root = rejects_root or f"{table.path}/_rejects"
                    path = write_rejects(plan.rejects, root, self.target.name, self.target.operation, job)
            commit = table.publish(replace(commit, state={**commit.state, "rejected": failed, "rejects_path": path}))
        return RunResult(job, self.target.name, self.target.operation, processed, failed, path, commit)

    def _write(self, spark: SparkSession, table: VersionedTable, staged: DataFrame, keymap: DataFrame | None,
               state: dict) -> tuple[Commit, WritePlan]:
        base = table.current()
        staged = table.fitted(staged, base)
        empty = spark.createDataFrame([], staged.schema)
        whole = table.read(at=base) if base else empty
        if self.target.operation in ("insert", "replace"):
            plan = self._write_plan(whole, staged, keymap, base is None)
            if self.target.operation == "insert":
                return table.prepare_append(plan.accepted, **state), plan
            return table.prepare_replace(plan.table, base=base, **state), plan
        # Keys live in one bucket each, so a change by those keys needs only the touched ones.
        by_bucket = list(self.target.matching_keys) == table.keys and (self.target.operation != "delete" or keymap is None)
        touched = table.touched(staged) if by_bucket and base else None
        # Other keys may lie anywhere; statistics of them, where the table has any, tell in which folders.
        folders = table.folders_with(self._sought(staged, keymap), base) if base and touched is None else None
        affected = table.read(touched, base, folders) if base else empty
        plan = self._write_plan(affected, staged, keymap, base is None)
        return table.prepare_replace(plan.table, touched, base, folders, **state), plan

    def _sought(self, staged: DataFrame, keymap: DataFrame | None) -> DataFrame:
        """The values by which the operation looks for rows, under the names they have in the table."""
        if self.target.operation != "delete":
            return staged.select(*[named(key) for key in self.target.matching_keys])
        if self.target.keyed_by_id:
            return staged.select(named(self.target.keys[0]))
        key = self.target.matching_keys[0]
        if keymap is None:
            return staged.select(named(key))
        return resolved_ids(keymap, staged, key)

    def _write_plan(self, target: DataFrame, records: DataFrame, keymap: DataFrame | None, first: bool) -> WritePlan:
        """The plan of the operation; the first records of a table bring its columns."""
        return plan_write(target, records, replace(self.target, evolve=self.target.evolve or first), keymap)


def sync(spark: SparkSession, store: ObjectStore, config: ResourceConfig, table: VersionedTable,
         target: TargetConfig, transforms: Sequence[Transform] = (), late_ties: bool = False) -> RunResult:
    """Extract what lies past the cursor, map it, write it, and move the cursor with the commit.

    The cursor is kept in the commit of the target, so data and cursor move
    together. It is read from the extracted rows, since the mapping may drop it.
    ``late_ties`` also finds rows that arrive later with the very value the last run
    ended on: the keys read at that value are kept in a folder beside the table,
    which the commit names, and the next run takes them out of an inclusive extract.

    With a limit the cursor is the pair of value and key, so runs stop and go on anywhere,
    also among rows of one value and among rows without one, which come first. Such a
    cursor cannot see late ties; the two exclude each other. Without a limit, rows whose
    cursor is NULL are read by the first run only.
    """
    state, cursor = table.state, config.replication_key
    limited = bool(cursor) and config.limit is not None
    if limited and late_ties:
        raise ValueError(f"Resource '{config.name}': a limited sync cannot look for late ties")
    if limited and not set(config.keys) <= set(config.fields):
        raise ValueError(f"Resource '{config.name}': a limited sync must select its key {list(config.keys)}")
    last_key = state.get("last_key") if cursor else None
    last, ties = (state.get("last_value"), state.get("ties")) if cursor else (None, None)
    known = spark.read.parquet(ties) if late_ties and ties else None
    with Staging(spark) as staging:
        rows = extract(store, config, last, inclusive=known is not None, last_key=last_key)
        if known is not None:
            rows = past_boundary(rows, cursor, last, known, config.keys)
        rows = staging.copy(rows)
        moved = {}
        if cursor:
            value_type = rows.select(named(cursor)).schema[0].dataType.simpleString()
            moved = {"cursor_field": cursor, "value_type": value_type}
            if limited:
                value, key = high_pair(rows, cursor, config.keys)
                moved |= {"last_value": value if key else last, "last_key": key or last_key}
            else:
                highest = high_value(rows, cursor)
                moved |= {"last_value": highest or last, "last_key": None if highest else last_key}
            if late_ties and moved["last_value"] is not None:
                moved["ties"] = _keep_ties(table, rows, known, cursor, moved["last_value"], config.keys)
        return Flow(config.name, rows, target, transforms).run(spark, table, staged=True, **moved)


def _keep_ties(table: VersionedTable, rows: DataFrame, known: DataFrame | None, cursor: str, last: str,
               keys: Sequence[str]) -> str:
    """The keys of the rows at the cursor's last value, in a folder of their own."""
    columns = [named(n) for n in (*keys, cursor)]
    held = rows.select(*columns)
    if known is not None:
        held = held.unionByName(known.select(*columns))
    folder = f"{table.path}/_ties/{uuid.uuid4().hex}"
    at_last = named(cursor) == F.lit(last).cast(rows.schema[cursor].dataType)
    held.filter(at_last).distinct().write.parquet(folder)
    return folder


class Staging:
    """Copies of rows in the shared folder for the length of a run.

    A copy has an exact size and a row count in its file footers, and outlives
    the executors that wrote it.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._folders = spark, []

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        for folder in self._folders:
            drop_folder(self._spark, folder)

    def copy(self, rows: DataFrame) -> DataFrame:
        folder = scratch_folder(self._spark, "staging")
        self._folders.append(folder)
        rows.write.parquet(folder)
        return self._spark.read.schema(rows.schema).parquet(folder)
