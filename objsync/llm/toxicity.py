"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from objsync.llm.common import add_columns, hash_mix

FIELDS = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())])
# Characters of the texts that are turned into features at a time.
BLOCK = 1_500_000


@dataclass(frozen=True)
class Settings:
    """``orders``: lengths of the n-grams; ``bits``: they fall into 2**bits features.

    ``rows`` and ``chars`` bound the training sample: texts per class, and characters
    of a text on average. The ``kept`` features with the strongest ratios get a coefficient.
    ``decay`` is the weight of the squared coefficients, ``epochs`` and ``rate``
    belong to the fit.
    """

    orders: tuple[int, ...] = (4, 5, 6)
    bits: int = 19
    rows: int = 1500
    chars: int = 6000
    kept: int = 4000
    decay: float = 1e-2
    epochs: int = 150
    rate: float = 0.05


def train(labelled: DataFrame, settings: Settings = Settings(), draw: str | None = None) -> tuple[np.ndarray, float] | None:
    """Coefficients per feature and the intercept, from ``text`` and ``toxic`` (0 or 1).

    The classifier is fitted on a bounded sample: at most ``settings.rows`` distinct
    texts of each class, in the order of a hash of the text, up to ``rows * chars``
    characters in all. Texts are whole: past that bound they are left out, but for
    the first. Copies hold one place, and are put together before any row is dealt.
    One task fits the classifier; the driver receives the coefficients. Other labels
    and null texts are left out. ``draw`` names a column with xxhash64 of the text, if
    there is one: taken before a join, it keeps the texts out of the shuffle for the
    counts. Without rows of both
    classes there is no classifier (None).
    """
    known = labelled.filter("text is not null and toxic in (0, 1)").select(
        F.col("toxic").cast("int").alias("toxic"), "text",
        (F.col(f"`{draw}`") if draw else F.xxhash64("text")).alias("draw"))
    counts = {r["toxic"]: r["count"] for r in known.select("toxic", "draw").distinct().groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    size = F.when(F.col("toxic") == 1, counts[1]).otherwise(counts[0])
    unit = F.col("draw") / F.lit(float(1 << 64)) + F.lit(0.5)
    thinned = known.withColumn("unit", unit).filter(F.col("unit") * size <= 4 * settings.rows).distinct()
    drawn = Window.partitionBy("toxic").orderBy("unit", "text")
    held = F.sum(F.length("text")).over(drawn.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = (F.col("turn") == 1) | (F.col("held") <= settings.rows * settings.chars)
    sample = thinned.withColumns({"turn": F.row_number().over(drawn), "held": held}).filter(
        (F.col("turn") <= settings.rows) & fits).select("toxic", "text")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["toxic", "text"])
        weights, offset = _fit(list(group["text"]), group["toxic"].to_numpy(), settings)
        return pd.DataFrame({"weights": [weights.astype("<f4").tobytes()], "offset": [offset]})

    model = sample.withColumn("model", F.lit("all")).groupBy("model").applyInPandas(fit, "weights binary, offset double").head()
    return np.frombuffer(model["weights"], dtype="<f4"), model["offset"]


def predict(docs: DataFrame, model: tuple[np.ndarray, float] | None, settings: Settings = Settings()) -> DataFrame:
    """Add ``score`` (0 to 1, higher is likelier toxic) and ``predicted`` (1 from 0.5 on), from whole texts.

    The score is the logistic of the intercept and the coefficients of the n-grams
    that occur, each once. Letters count in lower case, runs of white space as one
    blank. Null and empty texts have no n-gram, so the intercept alone gives their
    score; without a classifier every score is 0. Columns of these names are
    replaced, repeated rows are scored alike, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scorer():
        def score(column):
            texts = column.to_pylist()
            if shared.value is None:
                values = np.zeros(len(texts))
            else:
                values = 1 / (1 + np.exp(-np.clip(_margins(texts, *shared.value, settings), -500, 500)))
            return [pa.array(values), pa.array((values >= 0.5).astype(np.int32))]

        return score

    return add_columns(docs, FIELDS, scorer, ["text"])


def _blocks(texts: list) -> list[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK`` characters, one text at least."""
    found, first, held = [], 0, 0
    for number, text in enumerate(texts):
        held += len(text or "")
        if held >= BLOCK:
            found.append((first, number + 1))
            first, held = number + 1, 0
    return [*found, (first, len(texts))] if first < len(texts) else found


def _grams(texts: list, orders: tuple[int, ...], bits: int):
    """For each order: the text and the feature of every n-gram. A NUL, which parts the texts here, counts as a blank in them."""
    joined = "\0".join(" " + (t or "").lower().replace("\0", " ") + " " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    codes = np.where(blank, np.uint32(32), codes)[keep].astype(np.uint64)
    gap = codes == 0
    owner = np.cumsum(gap, dtype=np.int32)
    value = codes.copy()
    for order in range(2, max(orders) + 1):
        value = value[:-1] * np.uint64(1_000_003) + codes[order - 1:]
        if order in orders:
            n = len(value)
            inside = owner[:n] == owner[order - 1:]
            inside &= ~gap[:n]
            # Each order is scrambled apart, and the top bits name the feature.
            mixed = hash_mix(value + np.uint64(order << 56)) >> np.uint64(64 - bits)
            yield owner[:n][inside], mixed[inside].astype(np.int64)


def _margins(texts: list, weights: np.ndarray, offset: float, settings: Settings) -> np.ndarray:
    out = np.full(len(texts), offset)
    heavy = weights != 0
    for first, last in _blocks(texts):
        for owner, feature in _grams(texts[first:last], settings.orders, settings.bits):
            counts = heavy[feature]
            pairs = np.unique((owner[counts].astype(np.int64) << settings.bits) | feature[counts])
            sums = np.bincount(pairs >> settings.bits, weights[pairs & ((1 << settings.bits) - 1)], last - first)
            out[first:last] += sums
    return out


def _fit(texts: list[str], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    pairs = []
    for first, last in _blocks(texts):
        for owner, feature in _grams(texts[first:last], settings.orders, settings.bits):
            pairs.append(np.unique(((owner.astype(np.int64) + first) << settings.bits) | feature))
    pairs = np.concatenate(pairs)
    rows, features = pairs >> settings.bits, pairs & ((1 << settings.bits) - 1)
    size, toxic = 1 << settings.bits, labels == 1
    hit = toxic[rows]
    p = np.bincount(features[hit], minlength=size)
    q = np.bincount(features[~hit], minlength=size)
    ratio = np.log(((1 + p) / (1 + p).sum()) / ((1 + q) / (1 + q).sum()))
    # A ratio counts by how many texts it rests on; the strongest ones stay.
    strength = np.abs(ratio) * np.sqrt(p + q) * (p + q > 2)
    if size > settings.kept:
        ratio[np.argpartition(-strength, settings.kept)[settings.kept:]] = 0
    ratio[strength == 0] = 0
    used = ratio[features] != 0
    rows, features = rows[used], features[used]
    scale = ratio[features]
    sign = np.where(toxic, 1.0, -1.0)
    weight = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    coefficients, offset = np.zeros(size), 0.0
    first, second, steps = np.zeros(size + 1), np.zeros(size + 1), 0
    for _ in range(settings.epochs):
        margin = np.bincount(rows, coefficients[features] * scale, len(labels)) + offset
        slope = -sign * weight / (1 + np.exp(np.clip(sign * margin, -500, 500)))
        gradient = np.append(np.bincount(features, slope[rows] * scale, size) + settings.decay * coefficients, slope.sum())
        steps += 1
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        step = settings.rate * (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.99**steps)) + 1e-9)
        coefficients -= step[:-1]
        offset -= step[-1]
    weights = coefficients * ratio
    return weights, float(offset)
