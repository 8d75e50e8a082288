"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync.llm.common import free_names, ranked

# Rows of one bucket of the distributed numbering.
BUCKET_ROWS = 4096


def interleave(docs: DataFrame, shards: int, seed: str = "0", source: str = "source", key: str = "doc_id",
               ties: tuple[str, ...] = ()) -> DataFrame:
    """Deal rows over shards so that every shard has the mixture of the whole.

    Within each source the rows are shuffled by a seeded hash of the key and ranked.
    A row's place is its fractional rank, (rank - 1/2) / rows of the source, and the
    rows of all sources are sorted by it, so each stretch of the order holds the
    sources in proportion. The order is cut into ``shards`` stretches whose sizes
    differ by one row at most.

    Adds ``shard`` (from 0) and ``slot``, the gapless place in the shard (from 0);
    columns of these names are replaced. A null source is a source of its own; a
    null key is a key of its own; rows that agree in source, key and ``ties`` take
    their places in any order. Fewer rows than shards leave shards empty; no rows
    give no rows. No source is handled by one task, whatever its share.
    """
    total = docs.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    text = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    rows = free_names(docs, ("shard", "slot")).withColumns({
        "__source": F.concat(F.when(F.col(f"`{source}`").isNull(), "0").otherwise("1"), text(source)),
        "__draw": F.md5(F.concat(F.lit(f"{seed}:"), text(key)).cast("binary")),
    })
    drawn = F.conv(F.substring("__draw", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("__bucket", F.floor(drawn * buckets / F.lit(1 << 32)).cast("int"))
    order = ["__draw", f"`{key}`", *ties]
    rows = ranked(rows, ["__source"], "__bucket", order, "__rank", total="__size")
    rows = rows.withColumn("__place", (F.col("__rank") - 0.5) / F.col("__size"))
    rows = rows.withColumn("__bucket", F.floor(F.col("__place") * buckets).cast("int"))
    rows = ranked(rows, [], "__bucket", ["__place", "__source", *order], "__at")
    rows = rows.withColumn("shard", F.expr(f"cast((__at - 1) * {shards} div {max(1, total)}L as int)"))
    first = F.expr(f"(shard * {max(1, total)}L + {shards - 1}) div {shards}")
    return rows.withColumn("slot", F.col("__at") - 1 - first).drop("__source", "__draw", "__bucket", "__rank", "__size", "__place",
                                                    "__at")


def write_shards(dealt: DataFrame, folder: str) -> None:
    """One subfolder per shard, its rows in the order of their slots.

    A shard may be of any size, so its rows are dealt over several files by ranges
    of slots; the names of the files follow the order.
    """
    ordered = dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
