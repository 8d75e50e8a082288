"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from objsync.session import drop_folder, scratch_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows of one Arrow batch and its bytes: what a Python worker holds at a time,
# besides a single text that is longer.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of the session, since texts differ in length by orders of magnitude."""
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# Whether Spark deletes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, and each later use reads the copy.

    The shuffle files of the write go at its end, since nothing reads them again.
    """
    session = df.sparkSession
    folder = scratch_folder(session, purpose)
    before = session.conf.get(CLEANUP, None)
    session.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        session.conf.unset(CLEANUP) if before is None else session.conf.set(CLEANUP, before)
    copy = session.read.schema(df.schema).parquet(folder)
    copy._stored_in = folder
    return copy


def discard(*copies: DataFrame) -> None:
    """Delete what ``stored`` has written, once nothing reads it any more."""
    for copy in copies:
        drop_folder(copy.sparkSession, copy._stored_in)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def free_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The input without columns that an operator's result columns would clash with."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def add_columns(df: DataFrame, fields: StructType, make: Callable[[], Callable], inputs: Sequence[str]) -> DataFrame:
    """Columns computed per Arrow batch beside the input's.

    ``make`` runs once per task and returns a function from the input columns of a
    batch to one Arrow array per field. A column of the input with the name of a
    result is replaced.
    """
    taken = {n.lower() for n in fields.names}
    kept = [c for c in df.columns if c.lower() not in taken]
    schema = StructType([df.schema[c] for c in kept] + list(fields))
    names = kept + fields.names
    source = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, *inputs])])

    def run(batches):
        work = make()
        for batch in batches:
            new = work(*[batch.column(c) for c in inputs])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + list(new), names)

    return source.mapInArrow(run, schema)


def ranked(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], name: str,
           total: str | None = None) -> DataFrame:
    """The row number (from 1) of each row within its keys, ordered by bucket and then by ``order``.

    ``total`` names a column for the rows of the keys.

    A window over a key would put all its rows into one task. Here rows are dealt
    by key and bucket, numbered within the bucket, and shifted by the rows of
    earlier buckets, which are counted beforehand. The bucket must follow the
    order and split every key evenly; keys and bucket must not be null.
    """
    part = [*keys, bucket]
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    rows = F.sum("__rows")
    shift = df.groupBy(*part).agg(F.count("*").alias("__rows")).select(
        *part, F.coalesce(rows.over(earlier), F.lit(0)).alias("__shift"),
        *([rows.over(Window.partitionBy(*keys)).alias(total)] if total else []))
    within = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    numbered = df.withColumn(name, within.cast("long"))
    return numbered.join(shift, part).withColumn(name, F.col(name) + F.col("__shift")).drop("__shift")


class Sieve:
    """A bitmap of fixed size over 64-bit hashes: passes every member and a few others.

    It only thins out what an exact join decides afterwards. Its size does not
    grow with the data; a crowded bitmap passes more, never less.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.astype(np.uint64) & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def sieve(df: DataFrame, column: str, bits: int = 24, written: bool = False) -> Sieve:
    """The sieve of a column of longs; the words of the bitmap are put together by an aggregate.

    ``written`` lets the words pass through the shared folder, so that no shuffle files stay.
    """
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    marks = df.groupBy(F.shiftright(at, 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63L as int))")).alias("bits"))
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    rows = (stored(marks, "sieve") if written else marks).toArrow()
    words[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return Sieve(words)


def hash_mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shift, xor and multiply rounds)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
