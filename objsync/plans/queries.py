"""The query catalogue: every operator applied to the test tables.

Stand-ins: an account is a customer with external key ``c_name``, its children
are orders with cursor ``o_orderdate``, parents are nation and region, the change
feed is ``events``, and rows with repeating keys come from lineitem.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.config import ResourceConfig, TargetConfig
from objsync.functions.literals import with_literals
from objsync.functions.rules import audit_filter_text, audit_names
from objsync.functions.text import child_or, concat_strip, object_id, template, zero_padded
from objsync.operators import keymap as km
from objsync.operators import mapping as mp
from objsync.operators import results, write
from objsync.operators.inference import inferred_types
from objsync.operators.joins import hot_keys
from objsync.plans.flow import Flow, sync
from objsync.plans.incremental import past_boundary
from objsync.plans.store import VersionedTable
from objsync.session import scratch_folder
from objsync.sources import files
from objsync.sources import objects as ob
from objsync.sources.objects import (
    ObjectStore,
    Parent,
    extract,
    extract_all,
    file_store,
    high_values,
)
from objsync.sources.split_csv import split_csv
from objsync.streaming.sync import apply_changes, file_feed, start_sync

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
PARENTS = {
    "orders": {"customer": Parent("customer", "o_custkey", "c_custkey", unique=True)},
    "customer": {"nation": Parent("nation", "c_nationkey", "n_nationkey")},
    "nation": {"region": Parent("region", "n_regionkey", "r_regionkey")},
}
LAST_SEEN = "1998-01-01 00:00:00"


def query(function: Query) -> Query:
    CATALOG[function.__name__] = function
    return function


@lru_cache(maxsize=8)
def objects(spark: SparkSession, sf: str) -> ObjectStore:
    return file_store(spark, sf, parents=PARENTS)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return objects(spark, sf).load(name)


def customer_name(number: str) -> Column:
    """The external key of a customer number."""
    return F.concat(F.lit("Customer#"), zero_padded(F.col(number), 9))


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    return customers.select(object_id(F.col("c_custkey")).alias("Id"), "c_name", "c_nationkey", "c_acctbal",
                            "c_mktsegment")


def new_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as accounts that the target does not hold."""
    return table(spark, sf, "supplier").select(
        object_id(F.col("s_suppkey"), "009").alias("Id"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )


def account_map(spark: SparkSession, sf: str, condition: str = "true") -> DataFrame:
    return km.build_keymap(accounts(spark, sf).filter(condition), "Id", "c_name")


def order_lookups(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("account_key", customer_name("o_custkey"))


# Extraction


@query
def extract_project(spark: SparkSession, sf: str) -> DataFrame:
    fields = ("o_orderkey", "o_custkey", "o_totalprice")
    return extract(objects(spark, sf), ResourceConfig("orders", "orders", "o_orderkey", fields))


@query
def extract_filter(spark: SparkSession, sf: str) -> DataFrame:
    fields = ("c_custkey", "c_name", "c_mktsegment")
    config = ResourceConfig("accounts", "customer", "c_custkey", fields, query_filter="c_mktsegment = 'BUILDING'")
    return extract(objects(spark, sf), config)


@query
def filter_operators(spark: SparkSession, sf: str) -> DataFrame:
    condition = (
        "(o_orderstatus = 'F' OR o_orderpriority LIKE '%URGENT') AND o_totalprice > 100000"
        " AND o_orderdate >= '1996-06-01' AND o_orderpriority IN ('1-URGENT', '5-LOW')"
    )
    fields = ("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return extract(objects(spark, sf), ResourceConfig("orders", "orders", "o_orderkey", fields, query_filter=condition))


@query
def extract_relationship(spark: SparkSession, sf: str) -> DataFrame:
    fields = ("c_custkey", "c_name", "nation.n_name", "nation.region.r_name")
    rows = extract(objects(spark, sf), ResourceConfig("accounts", "customer", "c_custkey", fields))
    return rows.toDF("c_custkey", "c_name", "nation_name", "region_name")


@query
def extract_relationship_filter(spark: SparkSession, sf: str) -> DataFrame:
    """A filter on a grandparent that is not selected."""
    config = ResourceConfig("accounts", "customer", "c_custkey", ("c_custkey", "c_name"),
                            query_filter="nation.region.r_name = 'ASIA'", filter_fields=("nation.region.r_name",))
    return extract(objects(spark, sf), config)


def _orders_since(query_filter: str | None = None) -> ResourceConfig:
    return ResourceConfig("orders", "orders", "o_orderkey", ("o_orderkey", "o_orderstatus", "o_orderdate"),
                          replication_key="o_orderdate", query_filter=query_filter)


@query
def extract_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return extract(objects(spark, sf), _orders_since(), LAST_SEEN)


@query
def extract_filter_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return extract(objects(spark, sf), _orders_since("o_orderstatus = 'O'"), LAST_SEEN)


@query
def extract_topn(spark: SparkSession, sf: str) -> DataFrame:
    config = ResourceConfig("orders", "orders", "o_orderkey", ("o_orderkey", "o_orderdate", "o_totalprice"),
                            replication_key="o_orderdate", limit=100)
    return extract(objects(spark, sf), config)


@query
def extract_all_counts(spark: SparkSession, sf: str) -> DataFrame:
    configs = [
        {"name": "accounts", "object": "customer", "primary_key": "c_custkey", "fields": ["c_custkey", "c_name"]},
        {"name": "open_orders", "object": "orders", "primary_key": "o_orderkey", "replication_key": "o_orderdate",
         "fields": ["o_orderkey", "o_orderdate"], "query_filter": "o_orderstatus = 'O'"},
        {"name": "lines", "object": "lineitem", "primary_key": ["l_orderkey", "l_linenumber"],
         "fields": ["l_orderkey", "l_linenumber"]},
    ]
    return ob.row_counts(extract_all(objects(spark, sf), configs, {"open_orders": LAST_SEEN}))


@query
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ob.row_counts({name: table(spark, sf, name) for name in TABLES}, total="total")


@query
def incremental_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return high_values({
        "orders": (table(spark, sf, "orders"), "o_orderdate"),
        "lines": (table(spark, sf, "lineitem"), "l_shipdate"),
        "events": (table(spark, sf, "events"), "event_id"),
    })


@query
def incremental_boundary(spark: SparkSession, sf: str) -> DataFrame:
    """Orders from the last date on; those of it in status P arrived late and are not held yet."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    held = orders.filter(F.col("o_orderdate") <= F.lit(LAST_SEEN).cast("timestamp_ntz")).filter("o_orderstatus <> 'P'")
    return past_boundary(orders, "o_orderdate", LAST_SEEN, held, ["o_orderkey"])


# Files and chunks


@query
def normalize_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as one CSV line and back."""
    customers = table(spark, sf, "customer")
    lines = customers.select(files.csv_line(customers.columns).alias("line"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in customers.schema.fields)
    return lines.select(files.csv_fields(F.col("line"), schema).alias("r")).select("r.*")


@query
def normalize_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as CSV texts of at most 100 records under a header, and back to records."""
    pages = table(spark, sf, "pages")
    records = files.normalize_chunks(results.csv_texts(pages, 100), "body", pages.columns)
    return mp.apply_types(records, {"page_id": "bigint"})


@query
def normalize_long_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with outer white space, line breaks and empty texts as CSV texts, and back to records."""
    documents = _odd_documents(spark, sf)
    records = files.normalize_chunks(results.csv_texts(documents), "body", documents.columns, quoted_blank=True)
    return mp.apply_types(records, {"doc_id": "bigint"})


def _odd_documents(spark: SparkSession, sf: str) -> DataFrame:
    number, text = F.col("doc_id") % 5, F.col("text")
    odd = (F.when(number == 0, F.concat(F.lit("  "), text, F.lit(" "))).when(number == 1, F.concat(F.lit("\n"), text, F.lit("\n\t")))
           .when(number == 2, F.lit("")).when(number == 3, text))
    return table(spark, sf, "documents").select("doc_id", odd.alias("text"), F.when(number != 2, "").alias("note"))


@query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    folder = results.write_csv(documents, scratch_folder(spark, "csv"), batch_rows=results.BATCH_ROWS)
    return mp.apply_types(files.read_csv(spark, folder, documents.columns), {"doc_id": "bigint", "n_chars": "bigint"})


@query
def csv_roundtrip_blanks(spark: SparkSession, sf: str) -> DataFrame:
    """Outer white space, line breaks, empty text and NULL through CSV files."""
    documents = _odd_documents(spark, sf)
    folder = results.write_csv(documents, scratch_folder(spark, "csv"), batch_rows=results.BATCH_ROWS)
    return mp.apply_types(files.read_csv(spark, folder, documents.columns, quoted_blank=True), {"doc_id": "bigint"})


@query
def csv_roundtrip_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    folder = results.write_csv(pages, scratch_folder(spark, "csv"), batch_rows=results.BATCH_ROWS)
    return mp.apply_types(files.read_csv(spark, folder, pages.columns), {"page_id": "bigint"})


@query
def csv_checked_read(spark: SparkSession, sf: str) -> DataFrame:
    folder = results.write_csv(table(spark, sf, "customer"), scratch_folder(spark, "csv"))
    return mp.apply_types(files.checked_csv(spark, folder, multiline=False),
                          {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})


@query
def csv_split_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages, whose html holds line breaks and quotes, as CSV files that are read by byte ranges."""
    pages = table(spark, sf, "pages")
    folder = results.write_csv(pages, scratch_folder(spark, "csv"))
    return mp.apply_types(split_csv(spark, folder, quoted_blank=True), {n: t for n, t in pages.dtypes if t != "string"})


@query
def csv_split_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Turns whose texts hold line breaks at both ends, counted and measured per conversation after a read by byte ranges."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit('\n"'), "text", F.lit('",\n\n')).alias("text"))
    read = split_csv(spark, results.write_csv(turns, scratch_folder(spark, "csv")), ["conv_id", "turn", "text"], quoted_blank=True)
    return read.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.count("*").alias("turns"), F.count("text").alias("texts"), F.sum(F.length("text")).alias("chars"), F.min("text").alias("first_text"))


@query
def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    return files.key_chunks(table(spark, sf, "customer"), "c_custkey", 500)


@query
def batch_stats(spark: SparkSession, sf: str) -> DataFrame:
    return files.key_chunks(table(spark, sf, "orders"), "o_orderkey", results.BATCH_ROWS)


@query
def json_struct_get(spark: SparkSession, sf: str) -> DataFrame:
    fields = files.json_fields(F.col("props"), "k bigint, label string")
    events = table(spark, sf, "events").withColumn("fields", fields)
    return events.select("event_id", F.col("fields.k").alias("k"), child_or(F.col("fields.label"), "none").alias("label"))


@query
def json_filter_nullsafe(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    categories = events.select("event_id", F.nullif("event_type", F.lit("view")).alias("category"))
    return mp.exclude_value(categories, "category", "error")


# Mapping


@query
def map_rename(spark: SparkSession, sf: str) -> DataFrame:
    mapping = {"order_ref": "o_orderkey", "order_number": "o_orderkey", "account": "o_custkey", "status": "o_orderstatus"}
    return mp.map_columns(table(spark, sf, "orders"), mapping)


@query
def map_missing_column(spark: SparkSession, sf: str) -> DataFrame:
    mapping = {"external_id": "c_name", "balance": "c_acctbal", "phone": "Phone", "website": "Website"}
    return mp.map_columns(table(spark, sf, "customer"), mapping, strict=False)


@query
def map_constant(spark: SparkSession, sf: str) -> DataFrame:
    mapping = {"external_id": "c_name", "type": F.lit("Prospect"), "country": F.lit("France")}
    return mp.map_columns(table(spark, sf, "customer"), mapping)


@query
def map_concat_strip(spark: SparkSession, sf: str) -> DataFrame:
    number = F.concat(F.lit(" \t"), F.col("p_brand"))
    street = concat_strip(number, F.nullif("p_type", F.lit("SMALL")), F.concat("p_name", F.lit("\n ")))
    return mp.map_columns(table(spark, sf, "part"), {"p_partkey": "p_partkey", "street": street})


@query
def map_template(spark: SparkSession, sf: str) -> DataFrame:
    text = template("Legal Nature: {nature}- Source: {source}", nature=F.nullif("p_type", F.lit("PROMO")),
                    source=F.col("p_brand"))
    return mp.map_columns(table(spark, sf, "part"), {"p_partkey": "p_partkey", "description": text})


@query
def map_required_key(spark: SparkSession, sf: str) -> DataFrame:
    key = F.when(F.col("c_mktsegment") == "MACHINERY", "").when(F.col("c_mktsegment") != "FURNITURE", F.col("c_name"))
    return mp.require_filled(table(spark, sf, "customer").select("c_custkey", key.alias("external_id")), "external_id")


@query
def type_cast(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("placed"),
        F.col("o_totalprice").cast("string").alias("price"), F.col("o_orderpriority").alias("rank"),
    )
    typed = mp.apply_types(texts, {"placed": "timestamp_ntz", "price": "double"})
    return mp.apply_types(typed, {"rank": "bigint"}, strict=False)


@query
def flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    place = F.struct(F.col("c_nationkey").alias("nation"), F.struct("c_mktsegment").alias("market")).alias("place")
    return mp.flatten(table(spark, sf, "customer").select("c_custkey", place))


@query
def explode_child(spark: SparkSession, sf: str) -> DataFrame:
    return mp.explode_child(table(spark, sf, "embeddings"), ["vec_id"], "embedding")


@query
def schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    new = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal")
    )
    return mp.evolve_union(old, new)


@query
def transform_map_in_pandas(spark: SparkSession, sf: str) -> DataFrame:
    """A user transform giving two records per order."""

    def expand(batch: pd.DataFrame) -> pd.DataFrame:
        status = pd.DataFrame({"o_orderkey": batch.o_orderkey, "kind": "status", "content": batch.o_orderstatus})
        rank = pd.DataFrame({"o_orderkey": batch.o_orderkey, "kind": "rank", "content": batch.o_orderpriority.str[2:]})
        return pd.concat([status, rank])

    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return mp.expand_records(orders, expand, "o_orderkey bigint, kind string, content string")


# Key maps


@query
def key_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return km.lookup_keys(table(spark, sf, "orders"), "o_custkey")


@query
def keymap_full(spark: SparkSession, sf: str) -> DataFrame:
    mapped = accounts(spark, sf).withColumn("c_name", F.nullif("c_name", F.lit("Customer#000000001")))
    return km.build_keymap(mapped, "Id", "c_name")


@query
def keymap_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return km.build_keymap(accounts(spark, sf), "Id", "c_name", order_lookups(spark, sf).select("account_key"))


@query
def keymap_missing(spark: SparkSession, sf: str) -> DataFrame:
    held = account_map(spark, sf, "c_mktsegment = 'AUTOMOBILE'")
    return km.missing_keys(order_lookups(spark, sf).select("account_key"), held)


@query
def keymap_merge(spark: SparkSession, sf: str) -> DataFrame:
    """All accounts, then a second load that gives one segment and the suppliers new ids."""
    moved = accounts(spark, sf).filter("c_mktsegment = 'AUTOMOBILE'").withColumn("Id", F.concat(F.lit("9"), "Id"))
    second = km.build_keymap(moved.unionByName(new_accounts(spark, sf)), "Id", "c_name")
    return km.merge_keymaps(account_map(spark, sf), second)


@query
def keymap_ambiguous(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        object_id(F.col("l_partkey"), "01t").alias("Id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key")
    )
    return km.ambiguous_keys(km.build_keymap(lines, "Id", "line_key"))


@query
def resolve_keys(spark: SparkSession, sf: str) -> DataFrame:
    orders = order_lookups(spark, sf).select("o_orderkey", "account_key")
    return km.resolve_keys(orders, account_map(spark, sf, "c_mktsegment = 'BUILDING'"), "account_key", "account_id")


@query
def resolve_keys_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Two fifths of the orders share one account and a fifth has none."""
    rank = F.col("o_orderpriority")
    key = F.when(rank.isin("1-URGENT", "2-HIGH"), "Customer#000000001").when(rank != "5-LOW", F.col("account_key"))
    orders = order_lookups(spark, sf).select("o_orderkey", key.alias("account_key"))
    return km.resolve_keys(orders, account_map(spark, sf), "account_key", "account_id", on_miss="null",
                           hot=hot_keys(orders, "account_key", share=0.05))


@query
def resolve_rejects(spark: SparkSession, sf: str) -> DataFrame:
    orders = order_lookups(spark, sf).select("o_orderkey", "account_key")
    return km.split_resolved(orders, account_map(spark, sf, "c_mktsegment <> 'BUILDING'"), "account_key")[1]


@query
def resolve_unresolved(spark: SparkSession, sf: str) -> DataFrame:
    held = account_map(spark, sf, "c_mktsegment = 'BUILDING'")
    return km.unresolved_keys(order_lookups(spark, sf), held, "account_key")


# Writing


@query
def insert_append(spark: SparkSession, sf: str) -> DataFrame:
    batch = new_accounts(spark, sf).drop("c_nationkey")
    return write.insert(accounts(spark, sf), batch).table


def _changed_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """One segment with a new balance, and the suppliers as new accounts."""
    changed = accounts(spark, sf).filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    return changed.unionByName(new_accounts(spark, sf))


@query
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    return write.upsert(accounts(spark, sf), _changed_accounts(spark, sf), "c_name").table


@query
def upsert_partial(spark: SparkSession, sf: str) -> DataFrame:
    """The batch carries key and balance only, and a NULL balance keeps the old one."""
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") + 100)
    batch = _changed_accounts(spark, sf).select("c_name", balance.alias("c_acctbal"))
    return write.upsert(accounts(spark, sf), batch, "c_name", null_policy="keep").table


@query
def upsert_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels fill two columns of the documents they name."""
    target = table(spark, sf, "documents").select("doc_id", "lang", "source", F.lit(-1).alias("quality"), F.lit(-1).alias("toxic"))
    return write.upsert(target, table(spark, sf, "labels"), "doc_id").table


@query
def upsert_split(spark: SparkSession, sf: str) -> DataFrame:
    target = accounts(spark, sf)
    plan = write.upsert(target, _changed_accounts(spark, sf), "c_name")
    return write.upsert_outcomes(target, plan.accepted, ["c_name"])


@query
def upsert_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as changes of their account: the last one decides."""
    target = accounts(spark, sf).select("Id", "c_name", F.lit("new").alias("stage"), F.lit(0.0).alias("last_price"))
    changes = order_lookups(spark, sf).select(
        F.col("account_key").alias("c_name"), F.col("o_orderstatus").alias("stage"),
        F.col("o_totalprice").alias("last_price"), "o_orderdate", "o_orderkey",
    )
    plan = write.upsert(target, changes, "c_name", on_duplicate="keep_last", order_by=["o_orderdate", "o_orderkey"],
                        evolve=True)
    return plan.table


def _doubled_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines whose key repeats and whose part is unknown for some."""
    part = F.when((F.col("l_returnflag") != "A") | (F.col("l_linestatus") != "O"), F.col("l_partkey"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", part.alias("l_partkey"), "l_suppkey", "l_quantity"
    )


@query
def upsert_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Batch keys that repeat, and batch keys that several target rows share."""
    lines = table(spark, sf, "lineitem")
    target = lines.filter("l_linestatus = 'F'").select("l_orderkey", "l_linenumber", "l_quantity")
    batch = lines.filter("l_linestatus = 'O'").select("l_orderkey", "l_linenumber", "l_quantity")
    return write.upsert(target, batch, ["l_orderkey", "l_linenumber"]).rejects


@query
def delete_by_id(spark: SparkSession, sf: str) -> DataFrame:
    large = table(spark, sf, "orders").filter("o_totalprice > 450000")
    ids = large.select(object_id(F.col("o_custkey")).alias("Id")).unionByName(new_accounts(spark, sf).select("Id"))
    return write.delete_by_id(accounts(spark, sf), ids).table


def _delete_large(spark: SparkSession, sf: str) -> write.WritePlan:
    keys = order_lookups(spark, sf).filter("o_totalprice > 450000").select("account_key")
    batch = keys.unionByName(new_accounts(spark, sf).select(F.col("c_name").alias("account_key")))
    return write.delete_by_key(accounts(spark, sf), batch, "account_key", account_map(spark, sf))


@query
def delete_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return _delete_large(spark, sf).table


@query
def delete_unresolved(spark: SparkSession, sf: str) -> DataFrame:
    return _delete_large(spark, sf).rejects


@query
def replace_wipe_ids(spark: SparkSession, sf: str) -> DataFrame:
    return write.wiped_ids(accounts(spark, sf))


@query
def replace_table(spark: SparkSession, sf: str) -> DataFrame:
    return write.replace(accounts(spark, sf), new_accounts(spark, sf).drop("c_nationkey")).table


@query
def merge_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Edited assistant turns and one new opening turn per conversation, by composite key."""
    target = table(spark, sf, "conversations")
    edited = target.filter("role = 'assistant'").withColumn("text", F.concat(F.lit("[edited] "), "text"))
    opening = target.filter("turn = 0").withColumn("turn", F.lit(-1).cast("bigint"))
    config = TargetConfig.from_hints(
        {"name": "turns", "write_disposition": "merge", "primary_key": ["conv_id", "turn"]}
    )
    return write.plan_write(target, edited.unionByName(opening), config).table


@query
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    labelled = results.label_errors(_doubled_lines(spark, sf), ["l_partkey"], ["l_orderkey", "l_linenumber"])
    return results.split_errors(labelled)[1]


@query
def job_results(spark: SparkSession, sf: str) -> DataFrame:
    labelled = results.label_errors(_doubled_lines(spark, sf), ["l_partkey"], ["l_orderkey", "l_linenumber"])
    return results.job_results(labelled, F.expr(f"l_orderkey div {results.BATCH_ROWS}"), "Line", "upsert")


# Literals and rules


@query
def literal_format(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"),
        (F.col("o_orderstatus") == "O").alias("is_open"), F.nullif("o_custkey", F.lit(1)).alias("account"),
        F.concat(F.lit("it's "), "o_orderpriority").alias("note"),
    )
    columns = {"at_literal": "o_orderdate", "day_literal": "day", "price_literal": "o_totalprice",
               "open_literal": "is_open", "account_literal": "account", "note_literal": "note"}
    return with_literals(orders, columns).select("o_orderkey", *columns)


@query
def audit_object_names(spark: SparkSession, sf: str) -> DataFrame:
    kind, brand = F.col("p_type"), F.col("p_brand")
    name = (
        F.when(kind == "ECONOMY", brand).when(kind == "SMALL", F.lit("Delete")).when(kind == "PROMO", F.lit(""))
        .when(kind == "STANDARD", F.concat(F.replace(brand, F.lit("#"), F.lit("_")), F.lit("__c")))
        .when(kind == "LARGE", F.concat(kind, F.lit("\n"))).otherwise(kind)
    )
    parts = table(spark, sf, "part").select("p_partkey", name.alias("name"))
    return audit_names(parts, "name", "verdict").drop("name")


@query
def audit_field_names(spark: SparkSession, sf: str) -> DataFrame:
    kind, brand = F.col("p_type"), F.replace(F.col("p_brand"), F.lit("#"), F.lit("_"))
    name = (
        F.when(kind == "ECONOMY", F.concat(F.lit("Owner."), brand)).when(kind == "SMALL", F.lit("Account.Drop"))
        .when(kind == "PROMO", F.lit("Owner..Name")).when(kind == "LARGE", F.lit("Update__c"))
        .when(kind != "MEDIUM", F.concat(brand, F.lit("__r.Account.Name")))
    )
    parts = table(spark, sf, "part").select("p_partkey", name.alias("name"))
    dotted = audit_names(parts, "name", "dotted", dotted=True)
    return audit_names(dotted, "name", "strict").drop("name")


@query
def audit_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts judged as filters."""
    return audit_filter_text(table(spark, sf, "documents").select("doc_id", "text"), "text", "verdict").drop("text")


@query
def audit_page_filters(spark: SparkSession, sf: str) -> DataFrame:
    return audit_filter_text(table(spark, sf, "pages").select("page_id", "html"), "html", "verdict").drop("html")


# Flows


@query
def flow_flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Order records with a looked-up account, mapped and upserted into the orders already held."""
    held = table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit(LAST_SEEN).cast("timestamp_ntz")).select(
        object_id(F.col("o_orderkey"), "801").alias("Id"), F.col("o_orderkey").cast("string").alias("OrderNumber"),
        F.lit("Draft").alias("Status"), F.lit(0.0).alias("Amount"), F.lit(None).cast("string").alias("AccountId"),
        F.col("o_orderpriority").alias("Description"),
    )
    source = order_lookups(spark, sf)
    account_ids = account_map(spark, sf, "c_mktsegment <> 'HOUSEHOLD'")
    flow = Flow(
        "orders", source,
        TargetConfig("Order", "upsert", primary_key="OrderNumber"),
        (
            lambda df: km.resolve_keys(df, account_ids, "account_key", "account_id", unique=True),
            lambda df: mp.map_columns(df, {
                "OrderNumber": F.col("o_orderkey").cast("string"), "Status": "o_orderstatus", "Amount": "o_totalprice",
                "AccountId": "account_id",
            }),
        ),
    )
    return flow.plan(held).table


@query
def flow_prospects(spark: SparkSession, sf: str) -> DataFrame:
    """JSON records with a nested seat, filtered, mapped and upserted as accounts."""
    parts = table(spark, sf, "part")
    seat = F.struct(F.col("p_size").cast("string").alias("street_number"), F.nullif("p_type", F.lit("SMALL")).alias("street_type"),
                    F.col("p_name").alias("street_name"), F.col("p_brand").alias("town"))
    record = F.struct(F.when(F.col("p_type") != "LARGE", F.col("p_partkey").cast("string")).alias("siren"), F.col("p_name").alias("full_name"),
                      F.nullif("p_type", F.lit("PROMO")).alias("nature"), seat.alias("seat"))
    raw = parts.select(F.to_json(record).alias("body"))
    schema = ("siren string, full_name string, nature string,"
              " seat struct<street_number: string, street_type: string, street_name: string, town: string>")
    target = parts.filter("p_size <= 25").select(
        F.col("p_partkey").cast("string").alias("ExternalId"), F.lit("old").alias("Name"), F.lit("Customer").alias("Type"),
        F.lit("").alias("BillingStreet"), F.lit("").alias("BillingCity"), F.lit("").alias("Description"),
        F.col("p_retailprice").alias("Revenue"),
    )
    flow = Flow(
        "prospects", raw, TargetConfig("Account", "upsert", primary_key="ExternalID"),
        (
            lambda df: df.select(files.json_fields(F.col("body"), schema).alias("r")).select("r.*"),
            lambda df: mp.exclude_value(df, "nature", "ECONOMY"),
            lambda df: mp.require_filled(df, "siren"),
            lambda df: mp.map_columns(df, {
                "ExternalId": "siren", "Name": "full_name", "Type": F.lit("Prospect"),
                "BillingStreet": concat_strip(F.col("seat.street_number"), F.col("seat.street_type"), F.col("seat.street_name")),
                "BillingCity": F.col("seat.town"),
                "Description": template("Legal Nature: {n}- Source: API", n=F.col("nature")),
            }),
        ),
    )
    return flow.plan(target).table


@query
def flow_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Account records from CSV files, mapped leniently and upserted."""
    folder = results.write_csv(table(spark, sf, "customer"), scratch_folder(spark, "csv"))
    target = accounts(spark, sf).filter("c_mktsegment <> 'FURNITURE'").select(
        "Id", F.col("c_name").alias("ExternalId"), F.lit("000").alias("AccountNumber"), F.lit(0.0).alias("AnnualRevenue"),
        F.lit("n/a").alias("Phone"), F.col("c_mktsegment").alias("Industry"), F.lit("kept").alias("Rating"),
    )
    mapping = {"ExternalId": "c_name", "AccountNumber": "c_name", "AnnualRevenue": "c_acctbal", "Phone": "Phone",
               "Industry": "c_mktsegment"}
    flow = Flow(
        "accounts", files.checked_csv(spark, folder, multiline=False), TargetConfig("Account", "upsert", primary_key=("ExternalId",)),
        (lambda df: mp.map_columns(df, mapping, strict=False), lambda df: mp.apply_types(df, {"AnnualRevenue": "double"})),
    )
    return flow.plan(target).table


@query
def flow_reset(spark: SparkSession, sf: str) -> DataFrame:
    """A reference table replaced as a whole, through two commits of a versioned table."""
    parts = VersionedTable(spark, scratch_folder(spark, "tables"))
    parts.append(table(spark, sf, "part").select(F.lit("old").alias("Name"), F.lit("old").alias("FixedCode"), F.col("p_type").alias("FixedText")))
    required = ["p_name", "p_brand", "p_type"]
    flow = Flow(
        "parts", table(spark, sf, "part"), TargetConfig.from_hints({"name": "FixedRecord", "write_disposition": "replace"}),
        (
            lambda df: mp.require_columns(df, required),
            lambda df: mp.map_columns(df, {"Name": "p_name", "FixedCode": "p_brand", "FixedText": "p_type"}),
        ),
    )
    flow.run(spark, parts)
    return parts.read()


@query
def flow_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their account's name merged into a bucketed table in two runs, the second past the cursor."""
    store, target = objects(spark, sf), VersionedTable(spark, scratch_folder(spark, "tables"), ["order_id"], buckets=8)
    first = ObjectStore(
        lambda name: store.load(name).filter("o_orderdate < '1998-01-01'") if name == "orders" else store.load(name), PARENTS
    )
    config = ResourceConfig("tb_orders", "orders", "o_orderkey", ("o_orderkey", "o_orderstatus", "o_orderdate", "customer.c_name"),
                            write_disposition="merge", replication_key="o_orderdate")
    merge = TargetConfig.from_hints({"name": "tb_orders", "write_disposition": "merge", "primary_key": "order_id"})
    mapping = {"order_id": "o_orderkey", "status": "o_orderstatus", "account": "customer.c_name"}
    for source in (first, store):
        sync(spark, source, config, target, merge, (lambda df: mp.map_columns(df, mapping),))
    return target.read()


@query
def flow_limited_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in runs of a third of the table each, which stop and go on among orders of one day."""
    store, target = objects(spark, sf), VersionedTable(spark, scratch_folder(spark, "tables"), ["o_orderkey"], buckets=8)
    third = store.load("orders").count() // 3 + 1
    config = ResourceConfig("tb_orders", "orders", "o_orderkey", ("o_orderkey", "o_orderstatus", "o_orderdate"),
                            write_disposition="merge", replication_key="o_orderdate", limit=third)
    merge = TargetConfig("tb_orders", "merge", primary_key="o_orderkey")
    for _ in range(3):
        sync(spark, store, config, target, merge)
    return target.read()


@query
def flow_results(spark: SparkSession, sf: str) -> DataFrame:
    """The result row of a run that accepts some order lines and rejects others."""
    lines = VersionedTable(spark, scratch_folder(spark, "tables"))
    flow = Flow("lines", _doubled_lines(spark, sf).withColumn("line_key", F.concat_ws("-", "l_orderkey", "l_linenumber")),
                TargetConfig("Line", "upsert", primary_key="line_key"))
    return flow.run(spark, lines, rejects_root=scratch_folder(spark, "rejects")).frame(spark).drop("job_id")


@query
def stream_sync(spark: SparkSession, sf: str) -> DataFrame:
    """The event feed drained into a table of users, each with its latest event."""
    schema = table(spark, sf, "events").schema
    users = VersionedTable(spark, scratch_folder(spark, "tables"), ["user_id"], buckets=8)
    feed = file_feed(spark, sf, schema, pattern="events.parquet")
    start_sync(feed, users, ["ts", "event_id"], scratch_folder(spark, "stream")).awaitTermination()
    return users.read()


def _change_batches(spark: SparkSession, sf: str) -> VersionedTable:
    """A table of users with five batches of events, each written as a change folder."""
    events = table(spark, sf, "events")
    users = VersionedTable(spark, scratch_folder(spark, "tables"), ["user_id"], buckets=8)
    for number in range(5):
        apply_changes(users, events.filter(f"event_id % 5 = {number}"), number, "events", ["ts", "event_id"], compact_after=9)
    return users


@query
def stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The latest event of each user, read across a bucketed table and its change folders."""
    return _change_batches(spark, sf).read()


@query
def compact_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The same once the change folders are folded into the buckets."""
    users = _change_batches(spark, sf)
    users.compact()
    return users.read()


@query
def file_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per written file: all rows are there and no file is larger than a batch."""
    folder = results.write_csv(table(spark, sf, "documents"), scratch_folder(spark, "csv"), batch_rows=500)
    written = files.file_chunks(files.read_csv(spark, folder))
    return written.agg(F.sum("n").alias("n"), (F.max("n") <= 500).alias("fits"), (F.count("*") * 500 >= F.sum("n")).alias("all_counted"))


@query
def text_stats(spark: SparkSession, sf: str) -> DataFrame:
    """CSV texts of exactly a delivery batch each, but for the last."""
    texts = results.csv_texts(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"))
    lines = texts.select((F.size(F.split("body", "\n")) - 2).cast("long").alias("n"))
    return lines.agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.count_if(F.col("n") == results.BATCH_ROWS).alias("whole"))


@query
def delivery_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in delivery batches by key: rows and keys of each."""
    batches = results.delivery_batches(table(spark, sf, "orders").select("o_orderkey"), order_by=["o_orderkey"])
    return batches.groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query
def batch_results(spark: SparkSession, sf: str) -> DataFrame:
    """Processed and failed lines of each delivery batch."""
    labelled = results.label_errors(_doubled_lines(spark, sf), ["l_partkey"], ["l_orderkey", "l_linenumber"])
    batches = results.delivery_batches(labelled, order_by=["l_orderkey", "l_linenumber"])
    return results.job_results(batches, F.col("batch"), "Line", "upsert")


@query
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """JSON files with a field that only some records have, read under a declared schema."""
    folder = scratch_folder(spark, "json")
    seat = F.struct(F.nullif("p_type", F.lit("SMALL")).alias("kind"), F.col("p_brand").alias("town"))
    table(spark, sf, "part").select(F.col("p_partkey").alias("siren"), seat.alias("seat")).write.json(folder)
    records = files.read_json(spark, folder, "siren bigint, seat struct<kind: string, town: string>, absent string")
    return records.select("siren", child_or(F.col("seat.kind"), "none").alias("kind"), "seat.town", "absent")


@query
def keymap_two_loads(spark: SparkSession, sf: str) -> DataFrame:
    """A key map loaded for the keys of one part of the orders, then for another, and used for all."""
    maps = km.KeyMaps(spark)
    lookups = order_lookups(spark, sf)
    for part in ("o_orderstatus = 'F'", "o_orderpriority = '1-URGENT'"):
        maps.define("Account", "c_name", accounts(spark, sf), keys=km.lookup_keys(lookups.filter(part), "account_key"))
    return maps.resolve(lookups, "Account", "c_name", "account_key", output="account_id", on_miss="null").select("o_orderkey", "account_id")


@query
def rejects_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """The rejects folder of a run, read as the CSV it is delivered in."""
    lines = VersionedTable(spark, scratch_folder(spark, "tables"))
    flow = Flow("lines", _doubled_lines(spark, sf).withColumn("line_key", F.concat_ws("-", "l_orderkey", "l_linenumber")),
                TargetConfig("Line", "upsert", primary_key="line_key"))
    path = flow.run(spark, lines).rejects_path
    return files.read_csv(spark, path).select("line_key", "l_quantity", "error_code", "error_message")


@query
def sync_late_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Two syncs of one store: files are added in between, some of their rows at the very cursor value the first ended on."""
    root = scratch_folder(spark, "objects")
    orders = table(spark, sf, "orders")
    late = "o_orderdate > timestamp_ntz'1997-12-31' OR (o_orderdate = timestamp_ntz'1997-12-31' AND o_orderkey % 2 = 1)"
    store, target = file_store(spark, root), VersionedTable(spark, scratch_folder(spark, "tables"), ["order_id"], buckets=8)
    config = ResourceConfig("tb_orders", "orders", "o_orderkey", ("o_orderkey", "o_orderstatus", "o_orderdate"), replication_key="o_orderdate")
    merge = TargetConfig("tb_orders", "merge", primary_key="order_id", allow_empty=True)
    for rows in (orders.filter(f"NOT ({late})"), orders.filter(late)):
        rows.write.mode("append").parquet(f"{root}/orders.parquet")
        sync(spark, store, config, target, merge, (lambda df: mp.map_columns(df, {"order_id": "o_orderkey", "status": "o_orderstatus"}),),
             late_ties=True)
    return target.read()


@query
def merge_text_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A batch with its keys as padded text, as CSV brings them, merged into a table bucketed by number."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    target = VersionedTable(spark, scratch_folder(spark, "tables"), ["c_custkey"], buckets=8)
    target.append(customers)
    batch = customers.filter("c_mktsegment = 'BUILDING'").select(
        zero_padded(F.col("c_custkey"), 9).alias("c_custkey"), (F.col("c_acctbal") + 100).cast("string").alias("c_acctbal"))
    Flow("customers", batch, TargetConfig("Customer", "merge", primary_key="c_custkey")).run(spark, target)
    return target.read()


def _orders_by_status(spark: SparkSession, sf: str, **layout) -> VersionedTable:
    """Orders in a load per status, with statistics of the customer."""
    target = VersionedTable(spark, scratch_folder(spark, "tables"), stats=["o_custkey"], **layout)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for status in ("F", "O", "P"):
        target.append(orders.filter(F.col("o_orderstatus") == status))
    return target


@query
def keyed_fetch(spark: SparkSession, sf: str) -> DataFrame:
    """The orders of some customers, from the folders whose statistics may hold them."""
    wanted = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return _orders_by_status(spark, sf).lookup(wanted)


@query
def delete_by_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Orders deleted by their customer, in a table whose buckets follow another key."""
    target = _orders_by_status(spark, sf, keys=["o_orderkey"], buckets=4)
    gone = table(spark, sf, "customer").filter("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"))
    Flow("orders", gone, TargetConfig("orders", "delete", primary_key="o_custkey", allow_empty=True)).run(spark, target)
    return target.read()


@query
def widening_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads of text whose column is a whole number first, then a decimal, then text."""
    target = VersionedTable(spark, scratch_folder(spark, "tables"))
    customers = table(spark, sf, "customer")
    loads = (("c_mktsegment = 'BUILDING'", "c_nationkey"), ("c_mktsegment = 'FURNITURE'", "cast(c_acctbal AS decimal(15, 2))"),
             ("c_mktsegment NOT IN ('BUILDING', 'FURNITURE')", "c_name"))
    for part, value in loads:
        target.append_texts(customers.filter(part).selectExpr("string(c_custkey) AS c_custkey", f"string({value}) AS value"))
    return target.read()


@query
def column_types(spark: SparkSession, sf: str) -> DataFrame:
    """The type of each column of the customers, from its text alone."""
    texts = table(spark, sf, "customer").selectExpr("string(c_custkey) k", "string(c_nationkey) n", "c_name AS t",
                                                    "string(c_custkey * 10000000000) AS b", "string(date_add(DATE'2020-01-01', c_nationkey)) AS d")
    return spark.createDataFrame([(n, kind.simpleString()) for n, kind in inferred_types(texts).items()], "name string, type string")
