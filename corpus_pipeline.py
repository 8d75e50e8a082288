"""A corpus from documents to packed sequences: five stages, each written and read again by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm import decontaminate, jaccard, language, packing, secret_scan
from objsync.llm.common import bounded_batches, stored
from objsync.session import tune

# Near duplicates on word shingles: five words, and a similarity of 0.8 or more.
NEAR = jaccard.Measure(words=5, above=80, below=100)


def _ready(spark: SparkSession) -> SparkSession:
    return bounded_batches(tune(spark))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a known language; texts that are null, without a letter or like no language go."""
    _ready(spark)
    models = language.train(docs.select("text", "lang"))
    known = language.predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), models, language.limits(models))
    return known.filter(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents keep one row: of those with the smallest id, nulls last, any one.

    Rows are told apart by id and text, so rows that share an id, or have none, stay
    or go by their own links. Rows that agree in both are copies, one of which stays,
    unless the text has no word: that is linked with nothing.
    """
    _ready(spark)
    row = F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id"), F.xxhash64("text").alias("hash"))
    groups = jaccard.link_documents(docs.select(row.alias("doc_id"), "text"), NEAR)
    first = groups.filter((F.col("doc_id") == F.col("component_id")) | (F.col("n_shingles") == 0))
    kept = stored(first.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("n_shingles").alias("n")).select(
        F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.hash").alias("__hash"), (F.col("rows") == 1).alias("single"), "n"), "kept")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    alone = docs.join(kept.filter("single or n = 0"), same, "left_semi")
    again = kept.filter("not single and n > 0")
    if not again.isEmpty():  # rows that agree in id and text, one of which stays
        alone = alone.unionByName(docs.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
    return alone.select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    _ready(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_passages(docs.select(F.struct(*docs.columns).alias("row"), "text"), items)
    return found.filter("n_hit = 0").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts; all documents stay."""
    _ready(spark)
    found = secret_scan.find_secrets(docs.select(F.struct(*docs.columns).alias("row"), "text"), secret_scan.train(docs))
    found = found.select("row", secret_scan.redacted(F.col("text"), F.col("spans")).alias("clean"))
    # Counted from the finished text: the same aggregate twice in one projection would share its running state.
    values = {"text": F.col("clean"), "n_chars": F.length("clean").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return found.select(*[values.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences of 4096."""
    _ready(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_pieces(docs, path))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark_passages),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Tokenizers and automata are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
