"""Key maps: (Id, key) tables that turn business keys into internal ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.functions.text import is_filled
from objsync.operators.dedup import keep_last
from objsync.operators.joins import distinct_keys, lookup_join
from objsync.session import scratch_folder

ID, KEY = "Id", "key"
MISS_POLICIES = ("pass", "null")


def build_keymap(df: DataFrame, id_column: str, key_column: str, keys: DataFrame | None = None) -> DataFrame:
    """(Id, key) of all rows with a key, or of the given keys only. Both are text."""
    mapped = df.select(
        F.col(id_column).cast("string").alias(ID), F.col(key_column).cast("string").alias(KEY)
    ).filter(F.col(KEY).isNotNull())
    return mapped if keys is None else mapped.join(_as_keys(keys), KEY, "left_semi").select(ID, KEY)


def _as_keys(keys: DataFrame) -> DataFrame:
    """The distinct filled keys of a one-column DataFrame, as text."""
    return distinct_keys(keys.select(F.col(keys.columns[0]).cast("string").alias(KEY)).filter(is_filled(F.col(KEY))), KEY)


def lookup_keys(df: DataFrame, column: str) -> DataFrame:
    """The distinct filled lookup keys of a batch, as text."""
    return _as_keys(df.select(column))


def missing_keys(keys: DataFrame, keymap: DataFrame | None) -> DataFrame:
    """Requested keys that the map does not hold; all of them when there is no map."""
    wanted = _as_keys(keys)
    return wanted if keymap is None else wanted.join(_held_keys(wanted, keymap), KEY, "left_anti")


def _held_keys(wanted: DataFrame, keymap: DataFrame) -> DataFrame:
    """The wanted keys that the map holds: the few keys narrow the map before anything is shuffled against them."""
    return keymap.select(KEY).join(wanted.select(KEY), KEY, "left_semi").distinct()


def resolved_ids(keymap: DataFrame, df: DataFrame, lookup: str) -> DataFrame:
    """The distinct Ids that the keys of a batch stand for."""
    return keymap.join(lookup_keys(df, lookup), KEY, "left_semi").select(ID).distinct()


def merge_keymaps(*loads: DataFrame) -> DataFrame:
    """One Id per key from several loads in order: a later load wins, then the higher Id."""
    numbered = (load.select(ID, KEY, F.lit(n).alias("_load")) for n, load in enumerate(loads))
    return keep_last(reduce(DataFrame.unionByName, numbered), [KEY], ["_load", ID]).select(ID, KEY)


def ambiguous_keys(keymap: DataFrame) -> DataFrame:
    """(key, n, first_id, last_id) of keys that stand for more than one Id."""
    return (
        keymap.groupBy(KEY)
        .agg(F.count("*").alias("n"), F.min(ID).alias("first_id"), F.max(ID).alias("last_id"))
        .filter("first_id <> last_id")
    )


def resolve_keys(df: DataFrame, keymap: DataFrame, lookup: str, output: str | None = None, on_miss: str = "pass",
                 unique: bool = False, hot: list | None = None) -> DataFrame:
    """Replace a business key by its Id.

    A key the map lacks passes through (or becomes NULL with ``on_miss="null"``);
    NULL stays NULL; a key with several Ids fails the job when a row uses it.
    ``unique=True`` says the map has one Id per key and spares that check.
    ``hot`` lists keys that hold a large share of the rows (see ``hot_keys``).
    """
    if on_miss not in MISS_POLICIES:
        raise ValueError(f"on_miss must be one of {list(MISS_POLICIES)}")
    output = output or lookup
    matched = _match(df, keymap, lookup, unique, hot)
    found = F.col("_id") if on_miss == "null" else F.coalesce("_id", "_key")
    columns = [found.alias(output) if name == output else F.col(f"`{name}`") for name in df.columns]
    if output not in df.columns:
        columns.append(found.alias(output))
    return matched.select(*columns)


def split_resolved(df: DataFrame, keymap: DataFrame, lookup: str, output: str | None = None,
                   unique: bool = False, hot: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(resolved rows, rejected rows): rows whose filled key is not in the map are rejected."""
    matched = _match(df, keymap, lookup, unique, hot)
    missed = F.col("_key").isNotNull() & F.col("_id").isNull()
    output = output or lookup
    rest = [name for name in df.columns if name != output]
    resolved = matched.filter(~missed).select(*rest, F.col("_id").alias(output))
    rejected = matched.filter(missed).select(
        *df.columns,
        F.lit("INVALID_CROSS_REFERENCE_KEY").alias("error_code"),
        F.concat(F.lit(f"No match for {lookup}: "), "_key").alias("error_message"),
    )
    return resolved, rejected


def _match(df: DataFrame, keymap: DataFrame, lookup: str, unique: bool, hot: list | None) -> DataFrame:
    """The rows with ``_key`` (text) and ``_id`` (NULL on a miss)."""
    rows = df.withColumn("_key", F.col(lookup).cast("string"))
    if unique:
        ids = keymap.select(F.col(KEY).alias("_key"), F.col(ID).alias("_id"))
        return lookup_join(rows, ids, "_key", hot=hot)
    ids = keymap.groupBy(F.col(KEY).alias("_key")).agg(F.min(ID).alias("_first"), F.max(ID).alias("_last"))
    several = F.raise_error(F.concat(F.lit("More than one Id for key "), "_key"))
    one = F.when(F.col("_first") != F.col("_last"), several).otherwise(F.col("_first"))
    return lookup_join(rows, ids, "_key", hot=hot).withColumn("_id", one).drop("_first", "_last")


def unresolved_keys(df: DataFrame, keymap: DataFrame, lookup: str) -> DataFrame:
    """(key, n): rows per key that the map lacks, NULL included; counted before the join."""
    used = df.groupBy(F.col(lookup).cast("string").alias(KEY)).agg(F.count("*").alias("n"))
    return used.join(_held_keys(used, keymap), KEY, "left_anti")


class KeyMaps:
    """The key maps loaded in a session, by object and key field.

    Each load is written below the shared folder and read back: the map then has
    an exact size, which lets Spark choose between broadcast and shuffle, needs
    no recomputation when an executor is lost, and does not grow a lineage.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self._spark = spark
        self._root = root or scratch_folder(spark, "keymaps")
        self._maps: dict[tuple[str, str], DataFrame | None] = {}
        self._writes = 0

    def has(self, name: str, key_field: str) -> bool:
        return (name, key_field) in self._maps

    def init(self, name: str, key_field: str) -> None:
        """An empty entry, unless there is one."""
        self._maps.setdefault((name, key_field), None)

    def get(self, name: str, key_field: str) -> DataFrame:
        """The map; empty when nothing was loaded into it yet."""
        if not self.has(name, key_field):
            raise KeyError(f"No key map for {name}:{key_field}")
        found = self._maps[name, key_field]
        return self._spark.createDataFrame([], f"{ID} string, {KEY} string") if found is None else found

    def define(self, name: str, key_field: str, source: DataFrame, id_column: str = ID, full_load: bool = False,
               keys: DataFrame | None = None) -> int:
        """Load a map in full, or only the keys it does not hold yet. Returns its size; raises on failure."""
        self.init(name, key_field)
        if full_load:
            return self.update(name, key_field, build_keymap(source, id_column, key_field))
        if keys is None:
            raise ValueError(f"A keyed load of {name}:{key_field} needs keys")
        wanted = missing_keys(keys, self._maps[name, key_field])
        return self.update(name, key_field, build_keymap(source, id_column, key_field, wanted))

    def update(self, name: str, key_field: str, load: DataFrame) -> int:
        """Merge a load into the map, the new Ids winning, and return the number of keys."""
        self.init(name, key_field)
        held = self._maps[name, key_field]
        merged = merge_keymaps(load) if held is None else merge_keymaps(held, load)
        self._writes += 1
        folder = f"{self._root}/{name}/{key_field}/{self._writes}"
        merged.write.parquet(folder)
        self._maps[name, key_field] = self._spark.read.schema(merged.schema).parquet(folder)
        return self._maps[name, key_field].count()

    def resolve(self, df: DataFrame, name: str, key_field: str, lookup: str, **options) -> DataFrame:
        """``resolve_keys`` against a loaded map, whose keys are unique after the merge."""
        return resolve_keys(df, self.get(name, key_field), lookup, unique=True, **options)

    def clear(self, name: str | None = None, key_field: str | None = None) -> None:
        """Forget one map, all maps of an object, or all maps."""
        self._maps = {
            held: frame
            for held, frame in self._maps.items()
            if name is not None and (held[0] != name or (key_field is not None and held[1] != key_field))
        }


_shared: dict[tuple[str, str], KeyMaps] = {}


def shared_keymaps(spark: SparkSession, store: str) -> KeyMaps:
    """The key maps of this application for one store, made on first use."""
    slot = (spark.sparkContext.applicationId, store)
    if slot not in _shared:
        _shared[slot] = KeyMaps(spark)
    return _shared[slot]
