"""One CSV file over many tasks, also where line breaks stand inside its values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from objsync.session import scratch_folder
from objsync.sources.files import BLANK, CSV_OPTIONS, text_schema

# Columns of the marked lines: the file and the byte range a line was read from, its number there,
# whether the quotes before it in the range are odd and those in it are, and the last line that
# opened a record, once if the range starts outside of quotes and once if inside; -1 for none.
LINES = "path string, block long, line long, before boolean, odd boolean, opened0 long, opened1 long, text string"


def split_csv(spark: SparkSession, path: str, columns: list[str] | None = None, quoted_blank: bool = False) -> DataFrame:
    """``read_csv`` for files of any size: byte ranges are read side by side, and records may hold line breaks.

    Spark's line reader cuts a file at ``spark.sql.files.maxPartitionBytes``. A range does not
    know whether it starts inside quotes, so its lines are marked for both cases and stored; the
    parities of all ranges, a row each, are then summed up along each file. A line with even
    quotes outside of quotes is a record by itself and goes no further way. Only the lines of
    records with line breaks are shuffled, by the line their record starts at, which may lie ranges
    before. Parsing is left to ``from_csv``.

    Values are text and a blank is NULL (with ``quoted_blank`` one in quotes is empty text). A
    ragged record, a file with another header and a file whose last quote is not closed fail the
    job. Blank lines are skipped. A quote within a value must be doubled and its value quoted, as
    ``write_csv`` does; rows come in no order.
    """
    if columns is None:
        columns = spark.read.options(**CSV_OPTIONS).option("multiLine", True).csv(path).columns
    lines = _marked(spark, path)
    located = lines.join(_ranges(lines), ["path", "block"])
    inside = F.col("before") != F.col("starts_inside")
    located = located.withColumns({"inside": inside, "open_after": inside != F.col("odd")})
    # Conditional values, so that no later filter on parsed cells is moved to lines that are no records.
    whole = ~F.col("inside") & ~F.col("open_after")
    single = located.select(F.when(whole, _is_first("block", "line")).alias("header"), F.when(whole, F.col("text")).alias("text")).filter(
        "text is not null")
    opened = F.when(F.col("starts_inside"), F.col("opened1")).otherwise(F.col("opened0"))
    start = F.when(opened >= 0, F.struct("block", opened.alias("line"))).otherwise(F.col("carried"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "text")))
    broken = located.filter("inside or open_after").groupBy("path", start.alias("start")).agg(parts.alias("parts")).select(
        _is_first("start.block", "start.line").alias("header"),
        F.array_join(F.transform("parts", lambda part: part["text"]), "\n").alias("text"))
    return _parsed(single.unionByName(broken), columns, quoted_blank)


def _marked(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files, marked per byte range (see ``LINES``) and stored, so that every use sees the same ranges."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only this function travels to the workers, so it calls nothing of this package.
        import pyarrow.compute as pc

        held, line, odd, opened = None, 0, 0, [-1, -1]
        for batch in batches:
            paths, blocks, texts = (batch.column(n) for n in range(3))
            n = batch.num_rows
            quotes = pc.count_substring(texts, '"').to_numpy(zero_copy_only=False) & 1
            starts = blocks.to_numpy(zero_copy_only=False)
            moved = (starts[1:] != starts[:-1]) | pc.not_equal(paths.slice(1), paths.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(moved) + 1).tolist(), n] if n else []
            for first, last in zip(edges, edges[1:], strict=False):
                place = (paths[first].as_py(), int(starts[first]))
                if place != held:
                    held, line, odd, opened = place, 0, 0, [-1, -1]
                own = quotes[first:last]
                after = (odd + np.cumsum(own)) & 1
                before = np.concatenate([[odd], after[:-1]])
                number = line + np.arange(last - first)
                found = []
                for start in (0, 1):
                    opening = np.where((before == start) & (after != start), number, -1)
                    found.append(np.maximum.accumulate(np.maximum(opening, opened[start])))
                line, odd, opened = line + last - first, int(after[-1]), [int(f[-1]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [paths.slice(first, last - first), blocks.slice(first, last - first), pa.array(number), pa.array(before == 1),
                     pa.array(own == 1), pa.array(found[0]), pa.array(found[1]), texts.slice(first, last - first)],
                    ["path", "block", "line", "before", "odd", "opened0", "opened1", "text"])

    folder = scratch_folder(spark, "lines")
    lines.mapInArrow(mark, LINES).write.parquet(folder)
    return spark.read.schema(LINES).parquet(folder)


def _ranges(lines: DataFrame) -> DataFrame:
    """Per byte range: whether it starts inside quotes, and the line before it that opened the record it starts in."""
    ranges = lines.groupBy("path", "block").agg(
        F.sum(F.col("odd").cast("long")).alias("quotes"), F.max("opened0").alias("opened0"), F.max("opened1").alias("opened1"))
    file = Window.partitionBy("path")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    unclosed = F.raise_error(F.concat(F.lit("A quote is not closed in "), "path"))
    starts = F.when(F.sum("quotes").over(file) % 2 == 1, unclosed.cast("boolean")).otherwise(
        F.coalesce(F.sum("quotes").over(earlier) % 2 == 1, F.lit(False)))
    ranges = ranges.withColumn("starts_inside", starts)
    last = F.when(F.col("starts_inside"), F.col("opened1")).otherwise(F.col("opened0"))
    opening = F.when(last >= 0, F.struct("block", last.alias("line")))
    return ranges.select("path", "block", "starts_inside", F.last(opening, ignorenulls=True).over(earlier).alias("carried"))


def _is_first(block: str, line: str) -> Column:
    return (F.col(block) == 0) & (F.col(line) == 0)


def _parsed(records: DataFrame, columns: list[str], quoted_blank: bool) -> DataFrame:
    """The records as rows; header records are checked and left out."""
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", **({"nullValue": BLANK} if quoted_blank else {})}
    schema = text_schema([f"_{n}" for n in range(len(columns))])
    rows = records.withColumn("text", F.regexp_replace("text", r"\r\z", "")).filter("header or btrim(text) <> ''")
    rows = rows.select("header", F.from_csv("text", schema.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("cells"))
    wanted = F.struct(*[F.lit(name).alias(f"_{n}") for n, name in enumerate(columns)])
    named = F.lit(True)
    for n, name in enumerate(columns):
        named = named & F.col(f"cells._{n}").eqNullSafe(F.lit(name))
    other = F.raise_error(F.concat(F.lit("The header is not "), F.to_csv(wanted))).cast("boolean")
    rows = rows.filter(F.when(F.col("header").isNull() | ~F.col("header"), F.lit(True)).when(named, F.lit(False)).otherwise(other))
    return rows.select(*[F.col(f"cells._{n}").alias(name) for n, name in enumerate(columns)])
