"""Statistics of key columns per folder, which tell where given keys may lie and where they cannot.

A folder has the range of a column and a Bloom filter of its values. The filter is
a relation: each value sets four bits in one 64-bit word, and a row holds a word.
Words are combined before the shuffle, so a hot key costs nothing, and a filter
grows with its folder (16 to 32 bits a row) without any object that holds it whole.
A probe is an equi-join on the word; it ends at the first key that fits.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import named

# A bound longer than this is cut: a prefix is a lower bound, and an upper one is left open.
BOUND_CHARS = 64
ROWS_PER_WORD = 4
_BITS = 4


def comparable(column: Column, kind: T.DataType) -> Column | None:
    """A value whose text and order depend on nothing but the value; None for types without one.

    Text under a collation, where unequal bytes may be equal, has none.
    """
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # Minus zero equals zero.
        return F.when(column == 0, F.lit(0.0)).otherwise(column.cast("double"))
    if isinstance(kind, (T.IntegralType, T.DecimalType)) or kind.simpleString() == "string":
        return column
    return None


def write_stats(rows: DataFrame, folder: Column, columns: Sequence[str], path: str) -> dict[str, str]:
    """Write ranges and filters of the columns, for rows that ``folder`` assigns to folders; returns columns and types."""
    spark = rows.sparkSession
    kinds = {f.name.lower(): f for f in rows.schema.fields}
    ranges, hashes, done = [], [], {}
    for name in columns:
        held = kinds.get(name.lower())
        value = held and comparable(named(held.name), held.dataType)
        if value is None:
            continue
        done[held.name.lower()] = held.dataType.simpleString()
        filled = rows.select(folder.alias("folder"), value.alias("value")).filter("value IS NOT NULL")
        low, high = F.min("value").cast("string"), F.max("value").cast("string")
        ranges.append(filled.groupBy("folder").agg(F.count("*").alias("n"), low.alias("low"), high.alias("high")).select(
            F.lit(held.name.lower()).alias("column"), "folder",
            # A power of two, so that all folders of a table have few sizes.
            F.expr(f"shiftleft(1L, int(greatest(0, ceil(log2(n / {ROWS_PER_WORD})))))").alias("words"),
            F.substring("low", 1, BOUND_CHARS).alias("low"),
            F.when(F.length("high") <= BOUND_CHARS, F.col("high")).alias("high")))
        hashes.append(filled.select(F.lit(held.name.lower()).alias("column"), "folder", _hash("value").alias("hash")).distinct())
    if not ranges:
        return done
    reduce(DataFrame.unionByName, ranges).write.parquet(f"{path}/ranges")
    # One row per folder and column: read back, it is small enough to meet the hashes without a shuffle of them.
    sizes = spark.read.parquet(f"{path}/ranges").select("column", "folder", "words")
    marked = reduce(DataFrame.unionByName, hashes).join(sizes, ["column", "folder"])
    words = marked.groupBy("column", "folder", "words", _word().alias("word")).agg(F.bit_or(_mask()).alias("bits"))
    words.write.parquet(f"{path}/filters")
    return done


def folders_that_may_hold(spark: SparkSession, paths: Iterable[str], keys: DataFrame, column: str, kind: T.DataType) -> set[str] | None:
    """The folders of some statistics that may hold a key; None for types without statistics.

    What comes to the driver are names of folders, which each commit lists anyway.
    """
    value = comparable(named(column).cast(kind), kind)
    paths = list(paths)
    if value is None or not paths:
        return None
    of_column = F.col("column") == column.lower()
    ranges = spark.read.parquet(*[f"{path}/ranges" for path in paths]).filter(of_column)
    keys = keys.select(value.alias("value")).filter("value IS NOT NULL")
    ends = keys.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()
    if ends["low"] is None:
        return set()
    plain = keys.schema["value"].dataType
    low, high = F.lit(ends["low"]).cast(plain), F.lit(ends["high"]).cast(plain)
    near = F.coalesce(F.col("low").try_cast(plain) <= high, F.lit(True)) & F.coalesce(F.col("high").try_cast(plain) >= low, F.lit(True))
    within = ranges.filter(near).select("folder", "words")
    sizes = [row[0] for row in within.select("words").distinct().collect()]
    if not sizes:
        return set()
    probes = keys.select(_hash("value").alias("hash")).distinct().withColumn("words", F.explode(F.array(*map(F.lit, sizes))))
    probes = probes.select("words", _word().alias("word"), _mask().alias("mask")).distinct()
    filters = spark.read.parquet(*[f"{path}/filters" for path in paths]).filter(of_column)
    filters = filters.join(within, ["folder", "words"], "left_semi").alias("f")
    fits = (F.col("f.words") == F.col("p.words")) & (F.col("f.word") == F.col("p.word"))
    fits &= F.col("f.bits").bitwiseAND(F.col("p.mask")) == F.col("p.mask")
    return {row[0] for row in filters.join(probes.alias("p"), fits, "left_semi").select("folder").distinct().collect()}


def _hash(value: str) -> Column:
    return F.xxhash64(F.col(value).cast("string"))


def _word() -> Column:
    """The word of a hash: its high bits under a power of two."""
    return F.shiftrightunsigned("hash", 24).bitwiseAND(F.col("words") - 1)


def _mask() -> Column:
    """Four bits of a word from the low 24 bits of a hash."""
    bits = [F.expr(f"shiftleft(1L, int(shiftright(hash, {6 * i}) & 63))") for i in range(_BITS)]
    return reduce(Column.bitwiseOR, bits)
