"""URL filters: host rules, word segmentation of host names and naive Bayes on their tokens."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from objsync.llm.common import add_columns, ascii_lower, free_names, stored

# The longest word that segmentation knows.
WORD = 24
# Tokens fall into this many features, which bounds the model.
BITS = 16


@dataclass(frozen=True)
class Rule:
    """A verdict for the urls of a host and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parsed(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path``, both empty where ``url`` is null or has no ``://``."""
    part = lambda n: F.coalesce(F.regexp_extract("url", "(?s)://([^/?#]*)([^?#]*)", n), F.lit(""))
    return free_names(pages, ("host", "path")).withColumns({"host": ascii_lower(part(1)), "path": part(2)})


def rule_columns(rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        at = F.col("host")
        fits = ((at == rule.host) | at.endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """How often each word (a run of ASCII letters, lower case, at most ``WORD`` long) occurs in all texts."""
    plain = F.regexp_replace(F.col(column), "<[^>]*>", " ")
    words = F.split(ascii_lower(plain), "[^a-z]+")
    return texts.select(F.explode(words).alias("word")).filter(F.length("word").between(1, WORD)).groupBy("word").agg(
        F.count("*").alias("n"))


def segment(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """Split each ``label`` into the words of the most probable unigram sequence (``words``).

    ``counts`` has ``word`` and ``n``; a word's cost is minus the logarithm of its
    share. Only counts of words that lie in some label are looked up, by a join on
    the parts of all distinct labels. A stretch without known words is one unknown
    word; each of its characters costs more than any known word.
    """
    distinct = labels.select("label").filter("label is not null").distinct().withColumn("id", F.md5(F.col("label").cast("binary")))
    # Windows first, then their beginnings: a long label is not repeated with each of its parts.
    starts = F.transform(F.sequence(F.lit(1), F.length("label")), lambda i: F.substring(F.col("label"), i, WORD))
    windows = distinct.filter("label != ''").select("id", F.posexplode(starts).alias("at", "window"))
    each = windows.select("id", "at", F.explode(F.transform(F.sequence(F.lit(1), F.length("window")), lambda n: F.substring(
        F.col("window"), F.lit(1), n))).alias("word"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    known = each.join(counts, "word").groupBy("id").agg(F.collect_set(F.struct("at", "word", "n")).alias("known"))
    rows = distinct.join(known, "id", "left")
    fields = StructType([StructField("words", ArrayType(StringType()))])

    def splitter():
        def split(labels, known):
            out = [_viterbi(label, found or [], total) for label, found in zip(
                labels.to_pylist(), known.to_pylist(), strict=True)]
            return [pa.array(out, type=pa.list_(pa.string()))]

        return split

    return add_columns(rows, fields, splitter, ["label", "known"]).select("label", "words")


def _viterbi(label: str, known: list[dict], total: int) -> list[str]:
    steps = {}
    for part in known:
        steps.setdefault(part["at"], []).append((len(part["word"]), math.log(total / part["n"])))
    unknown = math.log(total + 1) + 1
    best = [(0.0, 0, False)] + [(math.inf, 0, False)] * len(label)  # cost, where the last word starts, unknown
    for at in range(len(label)):
        cost = best[at][0]
        for size, price in steps.get(at, ()):
            best[at + size] = min(best[at + size], (cost + price, at, False))
        best[at + 1] = min(best[at + 1], (cost + unknown, at, True))
    cuts, at = [], len(label)
    while at:
        _, before, strange = best[at]
        if strange and cuts and cuts[-1][2]:
            cuts[-1][0] = before
        else:
            cuts.append([before, at, strange])
        at = before
    return [label[a:b] for a, b, _ in reversed(cuts)]


def judge(pages: DataFrame, rules: list[Rule], counts: DataFrame) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict``, and ``score`` and ``words`` behind the method's verdicts.

    Urls that a rule fits take its verdict, and are the labelled rows from which a
    multinomial naive Bayes learns the tokens of blocked and allowed urls: the
    words of the segmented host (its last label left out) and the path's tokens,
    digits as ``0``. Other urls are blocked where the log-odds ``score`` is positive.
    The model covers all labelled rows; tokens fall into ``2**BITS`` features, which
    bounds what is broadcast, and tokens of one feature share its weight.

    Null urls and urls without ``://`` have an empty host and path and no tokens, so
    the classes' prior decides; with labels of one class only, or none, that class
    (``allow``) is the prior. Repeated rows are judged alike; an empty table gives no
    rows; columns with a result's name are replaced. ``rules`` is a bounded list of
    conditions; hosts are segmented once each, however many pages they have.
    """
    names = ("host", "path", "rule", "verdict", "words", "score", "tokens")
    text, verdict = rule_columns(rules)
    rows = parsed(free_names(pages, names)).withColumns({"rule": text, "verdict": verdict})
    hosts = rows.select("host").distinct()
    pieces = F.filter(F.split("host", "[^a-z0-9\\x{80}-\\x{10FFFF}]+"), lambda p: p != "")
    listed = hosts.select("host", F.posexplode(pieces).alias("turn", "label"))
    split = listed.join(stored(segment(listed, counts), "labels"), "label")
    worded = split.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("turn", "words"))).alias("parts")).select(
        "host", F.flatten(F.col("parts.words")).alias("words"))
    rows = rows.join(stored(worded, "hosts"), "host", "left")
    own = F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0)))
    path = F.filter(F.split(F.regexp_replace(ascii_lower(F.col("path")), "[0-9]+", "0"), "[^a-z0-9\\x{80}-\\x{10FFFF}]+"),
                    lambda p: p != "")
    none = F.array().cast("array<string>")
    tokens = F.concat(F.transform(F.coalesce(own, none), lambda w: F.concat(F.lit("host="), w)),
                      F.transform(path, lambda w: F.concat(F.lit("path="), w)))
    rows = rows.withColumns({"words": F.coalesce("words", none), "tokens": F.transform(
        tokens, lambda w: F.pmod(F.xxhash64(w), F.lit(1 << BITS)).cast("int"))})
    weights, prior = _naive_bayes(rows.filter("rule is not null"))
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def scorer():
        def score(column):
            flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
            owner = np.repeat(np.arange(len(column)), np.diff(ends))
            return [pa.array(prior + np.bincount(owner, shared.value[flat], len(column)))]

        return score

    scored = add_columns(rows, StructType([StructField("score", DoubleType())]), scorer, ["tokens"])
    method = F.when(F.col("score") > 0, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("verdict", method)).drop("tokens")


def _naive_bayes(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """The log-odds of block over allow for each feature, with add-one smoothing, and of the classes."""
    classes = {r["verdict"]: r["count"] for r in labelled.groupBy("verdict").count().collect()}
    counts = np.zeros((2, 1 << BITS))
    for row in labelled.select("verdict", F.explode("tokens").alias("token")).groupBy("token").agg(
            *[F.count_if(F.col("verdict") == v).alias(v) for v in ("allow", "block")]).toLocalIterator():
        counts[:, row["token"]] = row["allow"], row["block"]
    logs = np.log((counts + 1) / (counts + 1).sum(axis=1, keepdims=True))
    allow, block = classes.get("allow", 0), classes.get("block", 0)
    return logs[1] - logs[0], math.log((block + 1) / (allow + 2))
