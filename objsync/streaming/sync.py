"""Continuous sync: a change feed drained into a versioned table, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from objsync.operators.dedup import keep_last
from objsync.operators.results import filled_rows, missing_fields
from objsync.plans.store import VersionedTable


# The property under which Spark tells a micro-batch the id that its checkpoint keeps.
QUERY_ID = "sql.streaming.queryId"


def apply_changes(table: VersionedTable, changes: DataFrame, batch_id: int, stream: str, order_by: Sequence[str],
                  compact_after: int = 16) -> bool:
    """Merge one micro-batch and record its number in the same commit; a replayed batch is skipped.

    The batch is written alone, as a change folder, so a batch of a hundred keys writes a
    hundred rows whatever the size of the table; a change that arrives late does not replace a newer
    row. Once there are ``compact_after`` change folders they are folded into the buckets they touch.
    Rows without a key cannot be merged: they are left out, and the commit counts
    those of all batches of the stream (``keyless:<stream>``).
    """
    applied = f"stream:{stream}"
    base = table.current()
    if base and base.state.get(applied, -1) >= batch_id:
        return False
    changes = table.fitted(changes, base)
    keyed = filled_rows(changes, table.keys)
    keyless = f"keyless:{stream}"
    lost = changes.select(F.count_if(missing_fields(table.keys) != "")).first()[0]
    state = {applied: batch_id}
    if lost:
        state[keyless] = (base.state.get(keyless, 0) if base else 0) + lost
    commit = table.publish(table.prepare_change(keep_last(keyed, table.keys, list(order_by)), order_by, **state))
    if len(commit.changes) >= compact_after:
        table.compact()
    return True


def start_sync(feed: DataFrame, table: VersionedTable, order_by: Sequence[str], checkpoint: str,
               continuous: str | None = None, compact_after: int = 16) -> StreamingQuery:
    """Drain what is there (or keep running every ``continuous`` interval) with exactly-once effect.

    The target table is the only state, so no watermark is needed and a change
    may be as late as it likes. Limit the files per trigger on the feed to bound
    a micro-batch. Batches are numbered per checkpoint: with a new one the feed
    is drained again, which changes nothing that was already merged. ``compact_after``
    is the number of change folders that readers merge at most.
    """

    def apply(changes: DataFrame, batch_id: int) -> None:
        stream = changes.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        apply_changes(table, changes, batch_id, stream, order_by, compact_after)

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def file_feed(spark: SparkSession, folder: str, schema, fmt: str = "parquet", pattern: str | None = None,
              files_per_trigger: int | None = None) -> DataFrame:
    """A stream over the files that appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)
