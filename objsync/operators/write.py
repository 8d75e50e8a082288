"""Write operations as plans: each returns the new content of the target and the rejected rows.

Nothing here touches storage. A target is matched by anti, semi and left joins
whose build side is the batch, so a batch within Spark's broadcast limit leaves
the target unshuffled, and a larger one meets it in a sort-merge join whose
skewed partitions are split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync.config import TargetConfig
from objsync.functions.text import all_named, named
from objsync.operators import results
from objsync.operators.dedup import keep_last
from objsync.operators.joins import distinct_keys, split_join
from objsync.operators.keymap import ID, KEY
from objsync.operators.mapping import spelled

NULL_POLICIES = ("overwrite", "keep")
KEY_TEXT = "_key_text"
DUPLICATE_POLICIES = ("reject", "keep_last")


@dataclass(frozen=True)
class WritePlan:
    """The target after the write, the batch rows that take part, and those that do not."""

    table: DataFrame
    accepted: DataFrame
    rejects: DataFrame


def insert(target: DataFrame, batch: DataFrame, evolve: bool = False) -> WritePlan:
    """Append all rows; columns the batch lacks are NULL."""
    _check_columns(target, batch, evolve)
    return WritePlan(target.unionByName(batch, allowMissingColumns=True), batch, results.without_rows(batch))


def replace(target: DataFrame, batch: DataFrame, evolve: bool = False) -> WritePlan:
    """The batch in the shape of the target, and nothing of its former content."""
    _check_columns(target, batch, evolve)
    table = target.filter(F.lit(False)).unionByName(batch, allowMissingColumns=True)
    return WritePlan(table, batch, results.without_rows(batch))


def wiped_ids(target: DataFrame, id_column: str = ID) -> DataFrame:
    """The ids a replace removes."""
    return target.select(id_column)


def upsert(target: DataFrame, batch: DataFrame, keys: str | Sequence[str], null_policy: str = "overwrite",
           on_duplicate: str = "reject", order_by: Sequence[str] = (), target_unique: bool = False,
           evolve: bool = False) -> WritePlan:
    """Update rows by key and insert the rest.

    Rows without a key and keys that repeat in the batch are rejected (or the
    last row by ``order_by`` is kept). A batch row whose key stands for several
    target rows is rejected too; ``target_unique=True`` says there are none and
    spares the check. Columns the batch lacks keep their value, and with
    ``null_policy="keep"`` so do those that are NULL in it.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {list(NULL_POLICIES)}")
    keys = spelled(batch, [keys] if isinstance(keys, str) else keys)
    _check_columns(target, batch, evolve)
    full_rows = null_policy == "overwrite" and {n.lower() for n in target.columns} <= {n.lower() for n in batch.columns}
    keyed = results.filled_rows(batch, keys)
    once = _one_row_per_key(keyed, keys, on_duplicate, order_by)
    given = _given_keys(keyed, keys, on_duplicate)
    status = _key_status(None if target_unique and full_rows else target, given, keys)
    marked = split_join(once, status, keys).select(*all_named(batch.columns), "_given", "_held")
    accepted = marked.filter("_given = 1 AND _held <= 1")
    refused = marked.filter("_given > 1 OR _held > 1")
    doubled = F.col("_given") > 1
    names = ", ".join(keys)
    rejects = results.missing_rejects(batch, keys).unionByName(
        refused.select(
            *all_named(batch.columns),
            F.when(doubled, results.DUPLICATE).otherwise(results.DUPLICATE_TARGET).alias("error_code"),
            F.when(doubled, f"Duplicate value on: {names}").otherwise(f"More than one record found for: {names}")
            .alias("error_message"),
        )
    )
    rows = accepted.select(*all_named(batch.columns))
    if full_rows:
        table = _overwrite_rows(target, rows, status, keys)
    else:
        added = accepted.filter("_held = 0").select(*all_named(batch.columns))
        table = _overwrite_cells(target, rows, keys, null_policy).unionByName(added, allowMissingColumns=True)
    return WritePlan(table, rows, rejects)


def _one_row_per_key(keyed: DataFrame, keys: list[str], on_duplicate: str, order_by: Sequence[str]) -> DataFrame:
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {list(DUPLICATE_POLICIES)}")
    if on_duplicate == "reject":
        return keyed
    if not order_by:
        raise ValueError("on_duplicate='keep_last' needs order_by columns")
    return keep_last(keyed, keys, list(order_by))


def _given_keys(keyed: DataFrame, keys: list[str], on_duplicate: str) -> DataFrame:
    """Per batch key, how often it counts (``_given``): once, if only its last row is kept."""
    times = F.count("*") if on_duplicate == "reject" else F.lit(1).cast("long")
    return keyed.groupBy(*all_named(keys)).agg(times.alias("_given"))


def _key_status(target: DataFrame | None, given: DataFrame, keys: list[str]) -> DataFrame:
    """The given keys with how often the target has each (``_held``).

    Only key columns are read, and the batch keys cut the target keys down
    before they are counted; a key that repeats in the batch is refused anyway,
    so its target rows are not looked for. Without a target nothing is held.
    """
    if target is None:
        return given.withColumn("_held", F.lit(0).cast("long"))
    held = target.select(*all_named(keys)).join(given.filter("_given = 1"), keys, "left_semi")
    held = held.groupBy(*all_named(keys)).agg(F.count("*").alias("_held"))
    return given.join(held, keys, "left").select(*all_named(keys), "_given", F.coalesce("_held", F.lit(0)).alias("_held"))


def _overwrite_rows(target: DataFrame, rows: DataFrame, status: DataFrame, keys: list[str]) -> DataFrame:
    replaced = status.filter("_given = 1 AND _held <= 1").select(*all_named(keys))
    untouched = split_join(target, replaced, keys, "left_anti").select(*all_named(target.columns))
    return untouched.unionByName(rows, allowMissingColumns=True)


def _overwrite_cells(target: DataFrame, rows: DataFrame, keys: list[str], null_policy: str) -> DataFrame:
    """The target rows, with the given cells replaced where a batch row has their key."""
    values = [name for name in rows.columns if name not in keys]
    packed = rows.select(*all_named(keys), F.struct(F.lit(True).alias("hit"), *all_named(values)).alias("_new"))
    held = {name.lower() for name in target.columns}

    def merged(name: str):
        old = named(name) if name.lower() in held else F.lit(None)
        new = F.col("_new").getField(name)
        if null_policy == "keep":
            return F.coalesce(new, old).alias(name)
        return F.when(F.col("_new.hit"), new).otherwise(old).alias(name)

    given = {name.lower(): name for name in values}
    columns = [merged(name) if name.lower() in given else named(name) for name in target.columns]
    columns += [merged(name) for name in values if name.lower() not in held]
    return split_join(target, packed, keys, "left").select(*columns)


def upsert_outcomes(target: DataFrame, accepted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(outcome, n): rows inserted, updated and unchanged, where there are any.

    The batch keys narrow the target's keys before anything is counted by key; the
    unchanged rows are the target's number of rows less the updated ones.
    """
    given = accepted.select(*all_named(keys)).distinct()
    held = target.select(*all_named(keys)).join(given, list(keys), "left_semi")
    held = held.groupBy(*all_named(keys)).agg(F.count("*").alias("_old"))
    by_key = given.join(held, list(keys), "left").select(
        F.expr("int(_old IS NULL)").alias("inserted"), F.coalesce("_old", F.lit(0)).alias("updated"), F.lit(0).alias("whole"))
    whole = target.agg(F.count("*").alias("whole")).select(F.lit(0).alias("inserted"), F.lit(0).alias("updated"), "whole")
    sums = by_key.unionByName(whole).agg(*[F.sum(c).alias(c) for c in ("inserted", "updated", "whole")])
    counts = {"inserted": F.col("inserted"), "updated": F.col("updated"), "unchanged": F.col("whole") - F.col("updated")}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("outcome"), n.alias("n")) for k, n in counts.items()]))
    return sums.select(each.alias("o")).select("o.outcome", "o.n").filter("n > 0")


def delete_by_id(target: DataFrame, ids: DataFrame, id_column: str = ID) -> WritePlan:
    """Remove the listed ids; ids that are not there do no harm."""
    doomed = distinct_keys(ids, id_column)
    table = target.join(doomed, id_column, "left_anti").select(*all_named(target.columns))
    return WritePlan(table, doomed, results.without_rows(ids))


def delete_by_key(target: DataFrame, batch: DataFrame, key: str, keymap: DataFrame | None = None,
                  id_column: str = ID) -> WritePlan:
    """Remove the rows whose business key resolves to an id.

    Only ids from the map are ever removed: an unresolved value cannot be taken
    for an id, whatever it looks like. Unresolved keys are reported as rejects.
    Without a map the target's own rows are matched by the key at once, without
    the way through their ids.
    """
    wanted = distinct_keys(batch.select(named(key).cast("string").alias(KEY)), KEY)
    if keymap is None:
        texts = target.withColumn(KEY_TEXT, named(key).cast("string"))
        given = wanted.withColumnRenamed(KEY, KEY_TEXT)
        table = split_join(texts, given, [KEY_TEXT], "left_anti").select(*all_named(target.columns))
        shown = id_column if id_column.lower() in (name.lower() for name in target.columns) else key
        doomed = split_join(texts, given, [KEY_TEXT], "left_semi").select(named(shown)).distinct()
        known = split_join(texts.select(KEY_TEXT), given, [KEY_TEXT], "left_semi").select(F.col(KEY_TEXT).alias(KEY)).distinct()
    else:
        doomed = keymap.join(wanted, KEY, "left_semi").select(F.col(ID).alias(id_column)).distinct()
        table = target.join(doomed, id_column, "left_anti").select(*all_named(target.columns))
        known = keymap.select(KEY).join(wanted, KEY, "left_semi").distinct()
    unresolved = wanted.join(known, KEY, "left_anti").select(F.col(KEY).alias(key))
    rejects = results.with_error(unresolved, results.NOT_FOUND, f"No record found for: {key}")
    return WritePlan(table, doomed, rejects)


def _check_columns(target: DataFrame, batch: DataFrame, evolve: bool) -> None:
    held = {name.lower() for name in target.columns}
    unknown = [name for name in batch.columns if name.lower() not in held]
    if unknown and not evolve:
        raise ValueError(f"Columns the target does not have: {unknown}")


def plan_write(target: DataFrame, batch: DataFrame, config: TargetConfig,
               keymap: DataFrame | None = None) -> WritePlan:
    """The plan of a configured operation; names are exact."""
    if config.operation == "insert":
        return insert(target, batch, config.evolve)
    if config.operation == "replace":
        return replace(target, batch, config.evolve)
    if config.operation in ("upsert", "merge"):
        return upsert(target, batch, config.matching_keys, config.null_policy, config.on_duplicate, config.order_by,
                      config.target_unique, config.evolve)
    if config.operation == "delete" and config.keyed_by_id:
        return delete_by_id(target, batch, config.keys[0])
    if config.operation == "delete":
        return delete_by_key(target, batch, config.matching_keys[0], keymap)
    raise ValueError(f"Target '{config.name}': no such operation as '{config.operation}'")
