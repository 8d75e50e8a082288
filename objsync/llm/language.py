"""Language identification by cross-parsing entropy over suffix automata."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from objsync.llm.common import add_columns

UNKNOWN = "und"
# A text is parsed in stretches of this many symbols, side by side; phrases go on from one to the next.
STRETCH = 4096
# Symbols that are parsed at a time: what a worker holds.
BLOCK = 2_000_000

FIELDS = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def training_sample(labelled: DataFrame, rows: int, chars: int) -> DataFrame:
    """Distinct whole texts of each language in the order of a hash of the text: at most ``rows``, of ``rows * chars`` characters in all.

    Texts past either bound are left out, but for the first; one longer than the second
    bound comes after all others. Languages are counted first and thinned by a hash, and copies
    are put together before any row is dealt, so that the window that takes the first
    rows of a language never sees much more than it keeps.
    """
    known = labelled.filter("lang is not null and text rlike '\\\\p{L}'").select(F.col("lang").cast("string").alias("lang"), "text")
    known = known.withColumn("draw", F.xxhash64("text"))
    counts = {r["lang"]: r["count"] for r in known.select("lang", "draw").distinct().groupBy("lang").count().collect()}
    if not counts:
        return known.select("lang", F.lit(1).alias("turn"), "text").limit(0)
    size = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col("lang")]
    unit = (F.col("draw") / F.lit(float(1 << 64))) + F.lit(0.5)
    thinned = known.withColumn("unit", unit).filter(F.col("unit") * size <= 4 * rows).distinct()
    length = F.length("text")
    drawn = Window.partitionBy("lang").orderBy(length > rows * chars, "unit", "text")
    held = F.sum(length).over(drawn.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = thinned.withColumns({"turn": F.row_number().over(drawn), "held": held})
    fits = (F.col("turn") == 1) | (F.col("held") <= rows * chars)
    return numbered.filter((F.col("turn") <= rows) & fits).select("lang", "turn", "text")


def train(labelled: DataFrame, rows: int = 160, chars: int = 250) -> list[tuple[str, str]]:
    """The training text of each language of ``labelled`` (``text``, ``lang``), sorted by language.

    It is a bounded sample: at most ``rows`` distinct whole texts per language with
    ``rows * chars`` characters in all. Its suffix automaton has fewer than twice as many states;
    each task of ``predict`` builds it anew, in about a quarter of a second. Rows
    without a language or a letter are left out; no rows give no languages.
    """
    def build(group: pd.DataFrame) -> pd.DataFrame:
        texts = group.sort_values("turn")["text"]
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "text": ["\n".join(texts)]})

    sample = training_sample(labelled, rows, chars).groupBy("lang").applyInPandas(build, "lang string, text string")
    return sorted((r["lang"], r["text"]) for r in sample.collect())


def limits(models: list[tuple[str, str]]) -> list[float]:
    """The phrases per symbol from which a text is not like the language, for each of ``models``.

    A language's own texts need as many as the second half of its training text does
    under the first half; a text without anything of the language needs one for each
    symbol. The limit lies halfway, so neither the length of a text nor the number of
    languages moves it.
    """
    found = []
    for _, text in models:
        table, width = _symbols([text])
        half = len(text) // 2
        codes = _reduced(table[np.frombuffer(text[:half].encode("utf-32-le"), dtype=np.uint32)])
        counts, symbols, _ = _parsed([text[half:]], table, [_automaton(codes.tolist(), width)])
        found.append((1 + min(1.0, float(counts[0, 0] / symbols[0]))) / 2)
    return found


def predict(docs: DataFrame, models: list[tuple[str, str]], limits: list[float] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1), from the whole text of every document.

    Each language's suffix automaton parses the text: a phrase is the longest match
    of the rest of the text in the language's training text. The language needing
    the fewest phrases, each weighted by the logarithm of its training length, wins;
    ties go to the first language in sort order. Letters count in lower case, and
    each run of other characters is one blank. The score is the winner's share when
    every language has the weight 2 ** -(phrases * bits / sqrt(symbols)).

    ``und`` with score 0 where the text is null or has no letter, or where no
    language is known. With ``limits`` it is so, too, where the winner's phrases per
    symbol reach its limit; the phrase that the end of the text cuts off counts only
    where all symbols are phrases by themselves. Columns of these names are replaced;
    repeated rows are judged alike; an empty table gives no rows. Models are bounded
    by ``train``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((models, limits))
    return add_columns(docs, FIELDS, lambda: _predictor(*shared.value), ["text"])


def _symbols(texts: list[str]) -> tuple[np.ndarray, int]:
    """The symbol of each code point: 0 for what is no letter, 1 for a letter that no language has."""
    letters = sorted({c for text in texts for c in text.lower() if c.isalpha()})
    table = np.zeros(0x110000, dtype=np.uint8 if len(letters) < 250 else np.uint16)
    for code in range(0x110000):
        if chr(code).isalpha():
            table[code] = 1
    for number, letter in enumerate(letters, 2):
        for form in {letter, letter.upper()}:
            if len(form) == 1:
                table[ord(form)] = number
    return table, len(letters) + 2


def _reduced(codes: np.ndarray) -> np.ndarray:
    """Runs of 0 as a single 0."""
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def _automaton(codes: list[int], width: int) -> np.ndarray:
    """The transitions of the suffix automaton of a text, ready for parsing.

    Entry ``state * width + symbol`` holds four times the row of the next state, plus
    the phrases that end: one where no match goes on and the symbol starts the next
    phrase, and one for a symbol that the text lacks, which is a phrase by itself.
    """
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and code not in following[at]:
            following[at][code] = new
            at = link[at]
        if at >= 0:
            target = following[at][code]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and following[at].get(code) == target:
                    following[at][code] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    table = np.full((len(following), width), -1, dtype=np.int32)
    for state, steps in enumerate(following):
        for code, target in steps.items():
            table[state, code] = 4 * target * width
    start = np.where(table[0] >= 0, table[0] + 1, 2)
    table = np.where(table >= 0, table, start[None, :]).astype(np.int32)
    table[0, table[0] == 2] = 1
    return table.ravel()


def _predictor(models: list[tuple[str, str]], limits: list[float] | None = None):
    names = [name for name, _ in models]
    table, width = _symbols([text for _, text in models])
    automata, bits = [], []
    for _, text in models:
        codes = _reduced(table[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)])
        automata.append(_automaton(codes.tolist(), width))
        bits.append(math.log2(max(2, len(codes))))
    bits = np.array(bits)

    def judge(column):
        texts = column.to_pylist()
        winner = np.full(len(texts), -1)
        score = np.zeros(len(texts))
        counts, symbols, lettered = _parsed(texts, table, automata)
        known = np.flatnonzero(lettered) if names else []
        if len(known):
            cost = counts[known] * bits / np.sqrt(symbols[known])[:, None]
            winner[known] = cost.argmin(axis=1)
            score[known] = 1 / np.exp2(cost.min(axis=1)[:, None] - cost).sum(axis=1)
        if len(known) and limits is not None:
            least = counts[known, winner[known]]
            rate = np.where(least < symbols[known], least - 1, least) / symbols[known]
            strange = known[rate >= np.array(limits)[winner[known]]]
            winner[strange], score[strange] = -1, 0
        return [pa.array([names[w] if w >= 0 else UNKNOWN for w in winner], type=pa.string()), pa.array(score)]

    return judge


def _parsed(texts: list, table: np.ndarray, automata: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases by text and language, symbols by text, and whether there is a letter."""
    counts = np.zeros((len(texts), len(automata)))
    symbols = np.ones(len(texts))
    lettered = np.zeros(len(texts), dtype=bool)
    lanes, owners, held = [], [], 0
    for number, text in enumerate(texts):
        if not text:
            continue
        codes = _reduced(table[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)])
        if not codes.any():
            continue
        lettered[number] = True
        symbols[number] = len(codes)
        for at in range(0, len(codes), STRETCH):
            lanes.append(codes[at:at + STRETCH])
            owners.append(number)
        held += len(codes)
        if held >= BLOCK:
            _count(lanes, owners, automata, counts)
            lanes, owners, held = [], [], 0
    if lanes:
        _count(lanes, owners, automata, counts)
    return counts, symbols, lettered


def _count(lanes: list[np.ndarray], owners: list[int], automata: list[np.ndarray], counts: np.ndarray) -> None:
    """Parse all stretches in step, a symbol of each at a time, and add their phrases.

    Each stretch first starts with a phrase of its own. Where the one before leaves a phrase
    open, it is parsed again from there beside the first parse, until both agree, which
    they mostly do after a few phrases. So the phrases are those of the text as a whole.
    """
    lengths = np.array([len(lane) for lane in lanes])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    grid = np.zeros((lengths[0], len(lanes)), dtype=np.int32)
    for column, number in enumerate(order):
        grid[:len(lanes[number]), column] = lanes[number]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # lanes that have a symbol at a step
    owners = np.array(owners)
    column = np.empty(len(lanes), dtype=np.int64)
    column[order] = np.arange(len(lanes))
    following = np.flatnonzero(owners[1:] == owners[:-1]) + 1
    later, before = column[following], column[following - 1]
    final = np.ones(len(lanes), dtype=bool)
    final[before] = False
    owners = owners[order]
    for language, steps in enumerate(automata):
        state = np.zeros(len(lanes), dtype=np.int32)
        ended = np.zeros(len(lanes), dtype=np.int32)
        for step in range(lengths[0]):
            n = active[step]
            found = steps.take(state[:n] + grid[step, :n])
            ended[:n] += found & 3
            np.right_shift(found, 2, out=state[:n])
        begun = np.zeros(len(lanes), dtype=np.int32)
        while len(wrong := np.flatnonzero(begun[later] != state[before])):
            lane, true = later[wrong], state[before[wrong]]
            taken = begun[lane]
            begun[lane] = true
            step = 0
            while len(lane):
                over = lengths[lane] == step
                state[lane[over]] = true[over]
                lane, true, taken = lane[~over], true[~over], taken[~over]
                if not len(lane):
                    break
                symbols = grid[step, lane]
                true, taken = steps.take(true + symbols), steps.take(taken + symbols)
                ended[lane] += (true & 3) - (taken & 3)
                apart = (true >> 2) != (taken >> 2)
                lane, true, taken = lane[apart], true[apart] >> 2, taken[apart] >> 2
                step += 1
        # The end of a text ends its last phrase.
        np.add.at(counts[:, language], owners, ended + ((state > 0) & final))
