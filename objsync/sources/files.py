"""File sources: checked CSV, JSON records, CSV text in columns, and rows per input chunk."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How CSV is quoted on both the reading and the writing side.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
CORRUPT = "_corrupt_record"
# Stands for an unquoted blank while a quoted one is read as empty text: 122 random bits, drawn anew
# by each application, so no cell of a file that exists already is taken for it.
BLANK = f"\ue000{uuid.uuid4().hex}"


def text_schema(columns: list[str], corrupt: str | None = None) -> T.StructType:
    names = [*columns, corrupt] if corrupt else columns
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, corrupt: str | None = None,
             multiline: bool = True, quoted_blank: bool = False) -> DataFrame:
    """CSV as text columns, so that keys and codes keep their leading zeros. A blank is NULL.

    A ragged record, with more or fewer cells than the header, fails the job when it
    is read; ``corrupt`` names a column that keeps its whole line instead. Every
    file's header must name the columns in their order, else the read fails too.
    With ``quoted_blank`` a blank in quotes is empty text, which is how ``write_csv``
    tells it from NULL. ``multiline=False`` makes files without line breaks inside
    values splittable; with line breaks a file is the smallest unit, so large
    files are for ``split_csv``.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multiline)
    if columns is None:
        columns = reader.csv(path).columns
    if quoted_blank:
        reader = reader.option("nullValue", BLANK)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    else:
        # Without pruning every record is parsed whole, so that none is ragged unseen.
        reader = reader.option("mode", "FAILFAST").option("columnPruning", "false")
    return reader.option("enforceSchema", "false").schema(text_schema(columns, corrupt)).csv(path)


def checked_csv(spark: SparkSession, path: str | None, **options) -> DataFrame:
    """``read_csv`` after checking that the path is given, exists, and holds bytes and rows."""
    if not path:
        raise ValueError("No CSV path")
    glob = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(glob)
    if not found:
        raise FileNotFoundError(f"No CSV at {path}")
    if sum(files.getContentSummary(status.getPath()).getLength() for status in found) == 0:
        raise ValueError(f"CSV without content: {path}")
    rows = read_csv(spark, path, **options)
    if rows.isEmpty():
        raise ValueError(f"CSV without records: {path}")
    return rows


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON records, one per line, with a declared schema so that no pass is spent on inference."""
    return spark.read.schema(schema).json(path)


def json_fields(text: Column, schema: str) -> Column:
    """A JSON text column as a struct of the named fields; broken text gives NULL fields."""
    return F.from_json(text, schema)


def csv_line(columns: list[str]) -> Column:
    """The named columns as one CSV line; NULL is blank and empty text a blank in quotes."""
    return F.to_csv(F.struct(*columns), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})


def csv_fields(line: Column, schema: str) -> Column:
    """One CSV line as a struct; a blank is NULL, and one in quotes empty text."""
    return F.from_csv(line, schema, {"escape": '"', "multiLine": "true", "nullValue": BLANK})


def normalize_chunks(chunks: DataFrame, text: str, columns: list[str], quoted_blank: bool = False,
                     corrupt: str | None = None) -> DataFrame:
    """Records of CSV texts with a header line, one text per row.

    Each text carries its own header: columns it lacks are NULL, others are
    ignored, and a text without records gives nothing. All values stay text of any
    length; a blank is NULL, or empty text if it is in quotes and ``quoted_blank`` is
    set. Cells that a short record lacks are NULL. A record with more cells than
    the header fails the job, or keeps its line in the column ``corrupt``.
    A text is one exported chunk, so it is small however many there are; it is
    parsed as a whole by a columnar reader.
    """
    schema = text_schema(columns, corrupt)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only this function travels to the workers, so it calls nothing of this package.
        from pyarrow import csv

        def read(data: bytes, odd: list | None):
            def invalid(row):
                if odd is None or (row.actual_columns > row.expected_columns and corrupt is None):
                    return "error"
                odd.append(row)
                return "skip"

            return csv.read_csv(
                pa.BufferReader(data), csv.ReadOptions(use_threads=False, block_size=len(data) + 1),
                csv.ParseOptions(newlines_in_values=True, invalid_row_handler=invalid),
                csv.ConvertOptions(column_types={c: pa.string() for c in columns}, include_columns=columns, null_values=[""],
                                   include_missing_columns=True, strings_can_be_null=True, quoted_strings_can_be_null=not quoted_blank))

        for batch in batches:
            for chunk in batch.column(0).drop_null().to_pylist():
                if not chunk.strip():
                    continue
                odd, data = [], chunk.encode()
                found = [read(data, odd)]
                if odd:
                    header = data[:data.index(b"\n") + 1]
                    short = [r.text + "," * (r.expected_columns - r.actual_columns) for r in odd if r.actual_columns < r.expected_columns]
                    found += [read(header + "\n".join(short).encode(), None)] if short else []
                long = [r.text for r in odd if r.actual_columns > r.expected_columns]
                for part in found:
                    arrays = [part.column(c).combine_chunks() for c in columns]
                    extra = [pa.nulls(part.num_rows, pa.string())] if corrupt else []
                    yield pa.RecordBatch.from_arrays([*arrays, *extra], names)
                if long:
                    yield pa.RecordBatch.from_arrays([*[pa.nulls(len(long), pa.string()) for _ in columns], pa.array(long)], names)

    names = schema.names
    return chunks.select(text).mapInArrow(parse, schema)


def file_chunks(df: DataFrame) -> DataFrame:
    """(chunk, n): rows per input file of a file-based DataFrame."""
    return df.groupBy(F.col("_metadata.file_path").alias("chunk")).agg(F.count("*").alias("n"))


def key_chunks(df: DataFrame, key: str, size: int) -> DataFrame:
    """(chunk, n, first_key, last_key): rows per key range of a fixed width."""
    chunk = F.expr(f"({key} - pmod({key}, {size})) div {size}")
    return df.groupBy(chunk.alias("chunk")).agg(
        F.count("*").alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key")
    )
