"""Rejected rows, results per job, and the CSV files both are delivered in."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import all_named, is_filled, named
from objsync.operators.dedup import repeated_keys
from objsync.operators.joins import split_join
from objsync.operators.mapping import flatten
from objsync.session import scratch_folder
from objsync.sources.files import CSV_OPTIONS

# Error codes of rejected rows and the size of a delivery batch.
REQUIRED_MISSING = "REQUIRED_FIELD_MISSING"
DUPLICATE = "DUPLICATE_VALUE"
DUPLICATE_TARGET = "DUPLICATE_EXTERNAL_ID"
NOT_FOUND = "ENTITY_NOT_FOUND"
BATCH_ROWS = 10_000

# A row's number within its task, and the task, as Spark packs them into one number.
_AT, _TASK, _TASK_BITS = "_at", "_task", 33


def missing_fields(required: Sequence[str]) -> Column:
    """The names of the required columns that are NULL or empty, comma separated; '' when none."""
    return F.concat_ws(", ", *(F.when(~is_filled(named(name)), F.lit(name)) for name in required))


def filled_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose named columns are all filled, as plain tests that a scan can apply."""
    for name in names:
        df = df.filter(named(name).isNotNull())
        if isinstance(df.schema[name].dataType, T.StringType):
            df = df.filter(named(name) != "")
    return df


def with_error(df: DataFrame, code: str, message: Column | str) -> DataFrame:
    text = F.lit(message) if isinstance(message, str) else message
    return df.select("*", F.lit(code).alias("error_code"), text.alias("error_message"))


def without_rows(df: DataFrame) -> DataFrame:
    """A rejects DataFrame of the right shape that holds nothing."""
    return with_error(df.filter(F.lit(False)), DUPLICATE, "")


def missing_rejects(df: DataFrame, required: Sequence[str]) -> DataFrame:
    gone = missing_fields(required)
    return with_error(
        df.filter(gone != ""), REQUIRED_MISSING, F.concat(F.lit("Required fields are missing: "), gone)
    )


def label_errors(df: DataFrame, required: Sequence[str], unique: Sequence[str]) -> DataFrame:
    """Every row with ``error_code`` and ``error_message``, NULL for a good row.

    The repeated keys are counted first and joined back, so that no task has to
    hold all rows of one key.
    """
    complete = filled_rows(df, unique).select(*all_named(unique))
    repeated = repeated_keys(complete, list(unique)).withColumn("_repeated", F.lit(True))
    gone = missing_fields(required)
    code = F.when(gone != "", F.lit(REQUIRED_MISSING)).when(F.col("_repeated"), F.lit(DUPLICATE))
    message = F.when(gone != "", F.concat(F.lit("Required fields are missing: "), gone)).when(
        F.col("_repeated"), F.lit(f"Duplicate value on: {', '.join(unique)}")
    )
    joined = split_join(df, repeated, list(unique), "left")
    return joined.select(*all_named(df.columns), code.alias("error_code"), message.alias("error_message"))


def split_errors(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a labelled DataFrame."""
    good = labelled.filter(F.col("error_code").isNull()).drop("error_code", "error_message")
    return good, labelled.filter(F.col("error_code").isNotNull())


def job_results(labelled: DataFrame, job: Column, target: str, operation: str) -> DataFrame:
    """Processed and failed rows per job."""
    return labelled.groupBy(job.cast("string").alias("job_id")).agg(
        F.lit(target).alias("object"),
        F.lit(operation).alias("operation"),
        F.count("*").alias("records_processed"),
        F.count("error_code").alias("records_failed"),
    ).select("job_id", "object", "operation", "records_processed", "records_failed")


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, batch_rows: int = 0) -> str:
    """CSV files with header: the given columns, NULL as blank, empty text as a blank in quotes.

    ``batch_rows`` bounds the rows per file for a receiver that takes batches;
    0 leaves one file per task. Structs are flattened, since CSV has no nesting.
    """
    rows = flatten(df.select(*columns) if columns else df)
    rows.write.options(**CSV_OPTIONS).option("maxRecordsPerFile", batch_rows).csv(path)
    return path


def delivery_batches(df: DataFrame, batch_rows: int = BATCH_ROWS, order_by: Sequence[str] = ()) -> DataFrame:
    """The rows with ``row``, a gapless number from 0, and ``batch``, that number in batches of exactly ``batch_rows``.

    The rows are written once to the shared folder, in the order asked for or as they
    come. A task's rows are numbered as they are written; the counts per task, a row each,
    are summed up on the driver and shift these numbers. No window and no single task sees the rows.
    """
    spark = df.sparkSession
    rows = df.orderBy(*all_named(order_by)) if order_by else df
    folder = scratch_folder(spark, "batches")
    rows.withColumn(_AT, F.monotonically_increasing_id()).write.parquet(folder)
    held = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(_AT, T.LongType())])).parquet(folder).withColumn(_TASK, F.shiftright(_AT, _TASK_BITS))
    shifts, total = [], 0
    for task, n in held.groupBy(_TASK).count().orderBy(_TASK).collect():
        shifts.append((task, total))
        total += n
    shift = spark.createDataFrame(shifts, f"{_TASK} long, _shift long")
    row = (F.col("_shift") + F.col(_AT).bitwiseAND(F.lit((1 << _TASK_BITS) - 1))).alias("row")
    numbered = held.join(shift, _TASK).select(*[named(n) for n in df.columns], row)
    return numbered.select("*", F.expr(f"row div {batch_rows}").alias("batch"))


def csv_texts(df: DataFrame, batch_rows: int = BATCH_ROWS, order_by: Sequence[str] = ()) -> DataFrame:
    """(batch, body): the rows as CSV texts with header, each of exactly ``batch_rows`` rows but for the last.

    NULL is blank and every value is in quotes, so empty text is told from NULL.

    A task makes the texts of its batches one after the other from rows in order. Values
    become text before they reach Python, where a NULL would turn integers into floats.
    """
    flat = flatten(df)
    texts = flat.select(*(F.col(f"`{name}`").cast("string").alias(f"_{n}") for n, name in enumerate(flat.columns)),
                        *[named(name).alias(f"_by{n}") for n, name in enumerate(order_by)])
    columns = [f"_{n}" for n in range(len(flat.columns))]
    numbered = delivery_batches(texts, batch_rows, [f"_by{n}" for n in range(len(order_by))]).select("batch", "row", *columns)
    header = ",".join('"' + n.replace('"', '""') + '"' if set(n) & set('",\n\r') else n for n in flat.columns) + "\n"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only this function travels to the workers, so it calls nothing of this package.
        from pyarrow import csv

        options = csv.WriteOptions(include_header=False, quoting_style="all_valid")

        def text(number, parts):
            out = pa.BufferOutputStream()
            for part in parts:
                csv.write_csv(part, out, options)
            body = header + out.getvalue().to_pybytes().decode()
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([body], type=pa.string())], ["batch", "body"])

        number, parts = None, []
        for batch in batches:
            owners = batch.column(0).to_pylist()
            first = 0
            while first < len(owners):
                # Rows come in order, so a batch is a run of them.
                last = first
                while last < len(owners) and owners[last] == owners[first]:
                    last += 1
                if parts and owners[first] != number:
                    yield text(number, parts)
                    parts = []
                number = owners[first]
                parts.append(batch.slice(first, last - first).select(columns))
                first = last
        if parts:
            yield text(number, parts)

    dealt = numbered.repartition("batch").sortWithinPartitions("batch", "row")
    return dealt.mapInArrow(write, "batch long, body string")


def write_rejects(rejects: DataFrame, root: str, target: str, operation: str, run: str) -> str:
    """Rejected rows as CSV in a folder named by object, operation and run."""
    return write_csv(rejects, f"{root}/object={target}/operation={operation}/run={run}")
