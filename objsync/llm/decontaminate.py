"""Benchmark passages in documents, found by one Aho-Corasick scan of the normalised text."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from objsync.llm.common import add_columns, ascii_lower, free_names, stored

# The characters that separate words, once A-Z is in lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
FIELDS = StructType([
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("item_ids", ArrayType(LongType())),
    StructField("spans", ArrayType(SPAN)),
    StructField("hit_words", ArrayType(LongType())),
])


def windows(items: DataFrame, size: int) -> DataFrame:
    """The distinct word windows of the items (``item_id``, ``text``) with the sorted ids that hold each."""
    words = F.filter(F.split(ascii_lower(F.col("text")), SEPARATORS), lambda w: w != "")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    listed = items.select("item_id", words.alias("words")).filter("item_id is not null and size(words) > 0")
    each = listed.select("item_id", F.explode(F.transform(starts, lambda i: F.concat_ws(
        " ", F.slice(F.col("words"), i + 1, size)))).alias("window"))
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))


def find_passages(docs: DataFrame, items: DataFrame, size: int = 10, max_windows: int = 1_000_000) -> DataFrame:
    """Mark what each document shares with a benchmark.

    ``docs`` has ``text``, ``items`` has ``item_id`` and ``text``. Words are runs of
    letters and digits (and of all characters beyond ASCII), A-Z in lower case. A
    window is ``size`` consecutive words of an item, or a shorter item as a whole.
    Result, beside the columns of ``docs`` (columns with a result's name are
    replaced): ``n_words``; ``n_hit``, the words inside an occurrence; ``item_ids``,
    the sorted items with an occurring window; ``spans``, the hit passages as
    code-point offsets of the original text, end exclusive; ``hit_words``, the
    positions of the hit words.

    Null and empty texts have no words and no hits; items without an id or without
    words match nothing; repeated items and documents count each by itself; empty
    tables give no rows or no hits.

    The automaton is broadcast. Its windows are counted first: ``max_windows`` is
    the bound of one automaton, and a larger benchmark is dealt over several, each
    with a scan of its own, whose hits are then united by document.
    """
    listed = stored(windows(items, size), "windows")
    total = listed.count()
    parts = max(1, -(-total // max_windows))
    if parts == 1:
        return _scan(docs, listed, size)
    inner = docs.select(F.struct("*").alias("row")).withColumn("uid", F.monotonically_increasing_id())
    base = stored(inner, "numbered")
    flat = base.select("uid", F.col("row.text").alias("text"))
    hits = None
    for part in range(parts):
        one = _scan(flat, listed.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == part), size)
        one = one.filter("n_hit > 0").select("uid", "item_ids", "hit_words")
        hits = one if hits is None else hits.unionByName(one)
    united = hits.groupBy("uid").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hits"))
    merged = base.join(stored(united, "hits"), "uid", "left").select(
        "row", F.col("row.text").alias("text"), "ids", F.coalesce("hits", F.array().cast("array<long>")).alias("hits"))
    spans = add_columns(merged, FIELDS, _from_words, ["text", "hits"])
    spans = spans.withColumn("item_ids", F.coalesce("ids", F.array().cast("array<long>")))
    kept = free_names(docs, FIELDS.names).columns
    return spans.select(*[F.col("row").getField(c).alias(c) for c in kept], *FIELDS.names)


def _scan(docs: DataFrame, listed: DataFrame, size: int) -> DataFrame:
    rows = listed.toArrow()
    patterns = docs.sparkSession.sparkContext.broadcast(
        (rows.column("window").to_pylist(), rows.column("ids").to_pylist()))
    return add_columns(docs, FIELDS, lambda: _scanner(patterns.value), ["text"])


def _normaliser():
    table = bytearray(range(256))
    for code in range(128):
        if re.match(SEPARATORS, chr(code).lower()):
            table[code] = 32
        else:
            table[code] = ord(chr(code).lower())
    return bytes(table)


def _scanner(patterns):
    """Scan a column of texts; one byte stands for one character, so that UTF-8 needs no decoding."""
    import ahocorasick

    texts, ids = patterns
    table = _normaliser()
    automaton = ahocorasick.Automaton()
    for number, window in enumerate(texts):
        automaton.add_word(f" {window} ".encode().decode("latin-1"), (number, window.count(" ") + 1))
    if texts:
        automaton.make_automaton()

    def scan(column):
        result = _Hits()
        for text in column.to_pylist():
            data = text.encode() if text else b""
            plain = data.translate(table)
            words = plain.split()
            found, hit, items = [], None, set()
            if words and texts:
                joined = b" " + b" ".join(words) + b" "
                found = list(automaton.iter(joined.decode("latin-1")))
            if found:
                spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
                ends = np.searchsorted(spaces, [end for end, _ in found])
                hit = np.zeros(len(words), dtype=bool)
                for end, (number, length) in set(zip(ends.tolist(), [value for _, value in found], strict=True)):
                    hit[end - length:end] = True
                    items.update(ids[number])
            result.add(data, plain, len(words), hit, sorted(items))
        return result.arrays()

    return scan


def _from_words():
    table = _normaliser()

    def mark(column, hits):
        result = _Hits()
        for text, words in zip(column.to_pylist(), hits.to_pylist(), strict=True):
            data = text.encode() if text else b""
            plain = data.translate(table)
            count = len(plain.split())
            hit = np.zeros(count, dtype=bool)
            hit[words] = True
            result.add(data, plain, count, hit if words else None, [])
        return result.arrays()

    return mark


class _Hits:
    """Collects the result columns of a batch."""

    def __init__(self):
        self.columns = defaultdict(list)

    def add(self, data: bytes, plain: bytes, count: int, hit, items: list) -> None:
        self.columns["n_words"].append(count)
        self.columns["n_hit"].append(0 if hit is None else int(hit.sum()))
        self.columns["item_ids"].append(items)
        self.columns["spans"].append([] if hit is None else _spans(data, plain, hit))
        self.columns["hit_words"].append([] if hit is None else np.flatnonzero(hit).tolist())

    def arrays(self) -> list[pa.Array]:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()),
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.int64())]
        return [pa.array(self.columns[n], type=k) for n, k in zip(FIELDS.names, kinds, strict=True)]


def _spans(data: bytes, plain: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code-point offsets of the original text."""
    places = [m.span() for m in re.finditer(rb"[^\s]+", plain)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    points = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
    before = lambda at: int(points[at - 1]) if at else 0
    return [{"start": before(places[a][0]), "end": before(places[b - 1][1])}
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
