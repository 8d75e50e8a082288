"""Secrets in text: fixed patterns, and character Markov models that tell random strings from ordinary ones.

Everything here is column code: no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from objsync.llm.common import free_names

# The patterns of the base kinds and the sizes that a match must have.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
ACCESS = "AKIA[A-Z0-9]{12,}"  # 16 characters in all
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = "[A-Za-z0-9+/_=-]"
WIDTH = len(ALPHABET) + 1  # 0 is the place before the first character
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string>>"
FIELDS = ("start", "kind_no", "end", "kind")
FAR = (1 << 31) - 1
RESULTS = ("base", "spans", "n_assign", "n_access", "n_hex")


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios by previous and next character, and the ratio a token must exceed."""

    ratios: tuple[float, ...]
    least: float


def train(docs: DataFrame, rows: int = 20_000) -> Model:
    """Fit both first-order models from samples that the base patterns label.

    Random strings are the values of base matches; ordinary identifiers are the
    other tokens of four characters and more, once base matches are cut out. At most
    about ``rows`` distinct texts, chosen by a hash of the text, give samples. Spark counts
    the character pairs; the driver gets at most ``2 * 67 * 67`` counts. Smoothing
    adds one to each pair, so without any sample the models are equal and nothing
    exceeds them. A token must exceed the prior odds of ordinary over random strings.
    """
    hashed = docs.select(F.col("text").alias("text"), F.xxhash64("text").alias("hash")).filter("text is not null and text != ''")
    total = hashed.agg(F.count_distinct("hash")).first()[0]
    unit = F.col("hash") / F.lit(float(1 << 64)) + F.lit(0.5)
    sample = hashed.filter(unit * total <= rows).groupBy("hash").agg(F.max("text").alias("text"))
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    values = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_VALUE),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    labelled = sample.select(F.explode(F.array(
        F.struct(F.lit(1).alias("random"), values.alias("tokens")),
        F.struct(F.lit(0).alias("random"), F.regexp_extract_all(rest, F.lit(TOKEN + "{4,}"), F.lit(0)).alias("tokens")),
    )).alias("part")).select("part.random", F.explode("part.tokens").alias("token"))
    followed = F.zip_with(F.split("token", ""), F.concat(F.array(F.lit("^")), F.split("token", "")), lambda c, before: F.concat(before, c))
    pairs = labelled.select("random", F.explode(F.filter(followed, lambda pair: pair.isNotNull())).alias("pair")).groupBy("random", "pair").count()
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for row in pairs.collect():
        before, after = (ALPHABET.find(c) + 1 for c in row["pair"])
        if after:  # a value may hold a full stop, which no token does
            counts[row["random"]][before, after] = row["count"]
    return _model(counts)


def _model(counts: dict[int, Counter]) -> Model:
    ratios = []
    for before in range(WIDTH):
        logs = []
        for kind in (1, 0):
            line = [counts[kind][before, after] + 1 for after in range(1, WIDTH)]
            logs.append([math.log(n / sum(line)) for n in line])
        ratios.extend([0.0, *(r - o for r, o in zip(*logs, strict=True))])
    tokens = [sum(n for (before, _), n in counts[kind].items() if not before) for kind in (0, 1)]
    return Model(tuple(ratios), max(0.0, math.log((tokens[0] + 1) / (tokens[1] + 1))))


def find_secrets(docs: DataFrame, model: Model, least_length: int = 20) -> DataFrame:
    """Add the secrets of every whole text.

    ``base``: the matches of the fixed patterns, leftmost and not overlapping within
    a kind; ``spans``: these and, as kind ``markov``, each token of at least
    ``least_length`` characters that overlaps none of them and is likelier random
    than ordinary by more than the model's least ratio. Both are arrays of
    (start, kind_no, end, kind) in code points, end exclusive, by start and then in
    the order of ``KINDS``. ``n_assign``, ``n_access`` and ``n_hex`` count base spans.

    A null text is an empty one and has no spans; repeated rows are scanned alike; an
    empty table gives no rows; columns with a result's name are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = free_names(docs, RESULTS)
    rows = rows.withColumns({
        "__assign": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)),
        "__value": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
        "__access": F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        "__hex": F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
        "__text": F.regexp_extract_all(text, F.lit(f"{TOKEN}{{{least_length},}}"), F.lit(0)),
    })
    patterns = (("__assign", "__assign", ASSIGN), ("__access", "__access", ACCESS), ("__hex", "__hex", HEX),
                ("__token", "__text", f"{TOKEN}{{{least_length},}}"))
    rows = rows.withColumns({name: _places(text, F.col(matches), pattern, number)
                             for number, (name, matches, pattern) in enumerate(patterns)})
    strong = F.filter(F.zip_with("__assign", "__value", lambda s, v: F.struct(s.alias("span"), v.alias("value"))),
                      lambda m: F.length(m["value"]) >= ASSIGN_VALUE)
    rows = rows.withColumn("__assign", F.transform(strong, lambda m: m["span"]))
    rows = rows.withColumn("base", F.array_sort(F.concat("__assign", "__access", "__hex")))
    table = F.split(F.lit(",".join(f"{r:.6f}" for r in model.ratios)), ",").cast("array<double>")
    tokens = F.zip_with("__token", "__text", lambda s, t: F.struct(*[s[c].alias(c) for c in FIELDS], t.alias("text")))
    random = F.filter(_apart(F.col("base"), tokens), lambda s: _ratio(s["text"], table) > model.least)
    random = F.transform(random, lambda s: F.struct(*[s[c].alias(c) for c in FIELDS]))
    rows = rows.withColumn("spans", F.array_sort(F.concat("base", random)))
    rows = rows.withColumns({f"n_{kind}": F.size(f"__{kind}").cast("long") for kind in KINDS[:3]})
    return rows.drop("__assign", "__value", "__access", "__hex", "__token", "__text")


def _places(text: Column, matches: Column, pattern: str, number: int) -> Column:
    """Where the matches lie: the text between them, split by the same pattern, gives the distances."""
    steps = F.zip_with(matches, F.split(text, pattern, -1), lambda m, between: F.length(between) + F.length(m))
    ends = _scan(F.filter(steps, lambda n: n.isNotNull()), lambda a, b: a + b, 0)
    found = F.zip_with(ends, matches, lambda end, m: F.struct(
        (end - F.length(m)).alias("start"), F.lit(number).alias("kind_no"), end.alias("end"), F.lit(KINDS[number]).alias("kind")))
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(SPAN))


def _apart(base: Column, tokens: Column) -> Column:
    """The tokens that overlap no base span, by two sweeps over both in order of their starts."""
    plain = F.transform(base, lambda s: F.struct(*[s[c].alias(c) for c in FIELDS], F.lit(None).cast("string").alias("text")))

    def swept(both):
        is_base = lambda s: s["kind_no"] < 3
        reach = _scan(F.transform(both, lambda s: F.when(is_base(s), s["end"]).otherwise(0)), F.greatest, 0)
        ahead = F.reverse(_scan(F.reverse(F.transform(both, lambda s: F.when(is_base(s), s["start"]).otherwise(FAR))), F.least, FAR))
        found = F.filter(F.arrays_zip(both.alias("span"), reach.alias("reach"), ahead.alias("ahead")), lambda z: (
            z["span"]["kind_no"] == 3) & (z["reach"] <= z["span"]["start"]) & (z["ahead"] >= z["span"]["end"]))
        return F.transform(found, lambda z: z["span"])

    return F.when(F.size(base) == 0, tokens).otherwise(_let(F.array_sort(F.concat(plain, tokens)), swept))


def _ratio(token: Column, table: Column) -> Column:
    """The token's log-likelihood ratio: the sum over its characters given the ones before."""
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    parts = F.zip_with(places, F.concat(F.array(F.lit(0)), places), lambda at, before: F.get(table, before * WIDTH + at))
    return F.aggregate(parts, F.lit(0.0), lambda sum_, part: sum_ + F.coalesce(part, F.lit(0.0)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once, however often the body or a lambda in it names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _blocks(values: Column, body: Callable[[Column], Column]) -> Column:
    """The body for each stretch of about the square root of the array's length.

    Building an array or cutting a text piece by piece copies it for each piece; by stretches,
    and then of stretches, the copies stay far below the square of the length.
    """
    def cut(whole):
        size = F.greatest(F.ceil(F.sqrt(F.size(whole))), F.lit(1)).cast("int")
        count = F.greatest(F.ceil(F.size(whole) / size), F.lit(1)).cast("int")
        return F.transform(F.sequence(F.lit(0), count - 1), lambda k: body(F.slice(whole, k * size + 1, size)))

    return _let(values, cut)


def _scan(values: Column, join: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each whole number the join of all up to it."""
    last = lambda done: F.coalesce(F.get(done, F.size(done) - 1), F.lit(zero))

    def plain(part):
        return F.aggregate(part, F.array().cast("array<int>"), lambda done, v: F.concat(done, F.array(join(last(done), v))))

    def shifted(parts):
        sums = F.concat(F.array(F.lit(zero)), plain(F.transform(parts, last)))
        moved = F.zip_with(parts, sums, lambda part, sum_: F.transform(part, lambda v: join(sum_, v)))
        return F.flatten(F.filter(moved, lambda part: part.isNotNull()))

    return _let(_blocks(values, plain), shifted)


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every stretch that spans cover replaced by ``[secret]``; null stays null."""
    reach = _scan(F.transform(spans, lambda s: s["end"]), F.greatest, 0)
    zipped = F.zip_with(spans, F.concat(F.array(F.lit(0)), reach), lambda s, at: F.struct(at.alias("at"), s["start"].alias("start")))
    openings = F.filter(zipped, lambda z: z["start"] >= z["at"])  # a null start, of the last reach, is no opening

    def pieces(part):
        first = F.get(part, 0)["at"]
        stretch = F.substring(text, first + 1, F.get(part, F.size(part) - 1)["start"] - first)
        return _let(F.struct(stretch.alias("text"), first.alias("first"), part.alias("part")), lambda held: F.transform(
            held["part"], lambda z: F.concat(
                F.substring(held["text"], z["at"] - held["first"] + 1, z["start"] - z["at"]), F.lit("[secret]"))))

    cut = F.array_join(F.flatten(_blocks(openings, pieces)), "")
    rest = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(cut, rest)).otherwise(text)
