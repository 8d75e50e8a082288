"""Similarity join of word-shingle sets by token-combination prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from objsync.llm.common import Sieve, hash_mix, sieve, stored
from objsync.llm.graph import components

# Bytes of text that are hashed at a time, and tokens that are counted at a time.
BLOCK = 1 << 20
COUNTED = 1_500_000
# Tokens in more sets than this are frequent, as long as the list of them fits.
FREQUENT = 20
LISTED = 4_000_000
# Sets below 2**SINGLE_BAND tokens index single tokens only.
SINGLE_BAND = 4
FIRST_ROUND, GROWTH = 1, 8

ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D


@dataclass(frozen=True)
class Measure:
    """Sets of ``words``-word shingles are linked when ``below * intersection >= above * union``."""

    words: int = 4
    above: int = 85
    below: int = 100

    def least(self, n: int) -> int:
        """The least overlap of a set of ``n`` with any set it is linked to."""
        return -(-self.above * n // self.below)


def link_documents(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs`` (``doc_id``, ``text``).

    Words are runs of characters other than blanks and the controls 9 to 13, with
    A-Z in lower case. A text with fewer words than a shingle has one, all its words;
    a null text, or one without words, has an empty set and is linked with nothing.
    ``component_id`` is the smallest id that links reach, the row's own included.
    Rows with equal sets are always linked, so repeated rows and copies share a
    component; a null id counts for none, and a component of null ids alone has a
    null id. An empty table gives no rows; other columns are ignored.

    Shingles are 64-bit hashes. Equal sets are one node from the start on. Tokens
    are ordered rare first: counts over all texts, of all tokens, name the frequent
    ones. With ``e`` the tokens that a set may lack in a partner, its prefix is
    extended until ``e + 1`` tokens would have to be missing for two linked sets to
    share no signature: a rare token is a signature by itself, while the frequent
    tokens fall into classes by a hash and every pair of a class is one, so that the
    first token of a class adds nothing. The classes follow the size of the smaller
    set of a pair, and a set near a limit of sizes gives the signatures of both.

    Signatures of one set are dropped. In what remains, the first set of a signature
    is compared with the others; what it links is merged; then the next ``GROWTH``,
    and so on by powers, always between sets that no links connect yet. Thousands of
    near copies so cost one comparison each and not one per pair, while every pair
    that shares a signature is either compared or already connected. A comparison
    starts with bitmaps of a few bits per token, whose differing bits are a lower
    bound of the tokens in which two sets differ; only the sets of pairs that stand
    this test are read from the texts and intersected.
    """
    texts = docs.select(F.col("doc_id"), F.col("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    # A bucket of the counts holds about two million tokens, whatever the input.
    bits = max(8, int(size / 6 / 2_000_000).bit_length())
    listed = _frequent(texts, measure, bits)
    shared = docs.sparkSession.sparkContext.broadcast(listed)
    rows = stored(_signed(texts, measure, shared, bits), "signed")
    nodes = stored(rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("own"), F.count("*").alias("n")), "nodes")
    posts = _postings(rows, bits)
    labels = _linked(texts, rows, posts, measure)
    rooted = nodes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("own").alias("component_id"), F.sum("n").alias("rows")).filter("rows > 1").drop("rows")
    shared_ids = stored(rooted.join(stored(ids, "ids"), "root").select("node", "component_id"), "components")
    result = rows.select("doc_id", "n_shingles", "node").join(shared_ids, "node", "left")
    return result.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
                         F.coalesce("component_id", "doc_id").alias("component_id"))


# Shingle sets


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    up = np.full(n + 1, BASE, dtype=np.uint64)
    down = np.full(n + 1, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes."""

    def __init__(self, words: int):
        self.words = words
        self.letters = hash_mix(np.arange(1, 257, dtype=np.uint64) * ODD)
        for code in range(ord("A"), ord("Z") + 1):
            self.letters[code] = self.letters[code + 32]
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[32, *range(9, 14)]] = True
        self.up, self.down = _powers(BLOCK)

    def sets(self, texts: list) -> Iterator[np.ndarray]:
        first, held, data = 0, 0, []
        for text in texts:
            data.append(text.encode() if text else b"")
            held += len(data[-1]) + 1
            if held >= BLOCK // 2:
                yield from self._block(data)
                data, held = [], 0
        if data:
            yield from self._block(data)

    def _block(self, data: list[bytes]) -> Iterator[np.ndarray]:
        codes = np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8)
        if len(codes) >= len(self.up):
            self.up, self.down = _powers(len(codes))
        blank = self.blank[codes]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(self.letters[codes] * self.up[:len(codes)], out=sums[1:])
        words = hash_mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        limits = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
        first = np.searchsorted(starts, limits)
        size = self.words
        n = max(0, len(words) - size + 1)
        shingles = np.full(n, size, dtype=np.uint64)
        for place in range(size):
            shingles = hash_mix(shingles * ODD + words[place:place + n])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(shingles[a:b - size + 1])
            elif b == a:
                yield np.empty(0, dtype=np.uint64)
            else:
                whole = np.full(1, b - a, dtype=np.uint64)
                for word in words[a:b]:
                    whole = hash_mix(whole * ODD + word)
                yield whole


def _node(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


# Counts of 64-bit values by their leading bits


def _tally(rows: DataFrame, values, bits: int, least: int) -> DataFrame:
    """The leading ``bits + 32`` bits (``key``) of values that occur at least ``least`` times, and the count.

    ``values`` makes, per task, a function from a batch to an array of values. Each
    task adds up what it has seen, so a value of a third of all rows arrives once per
    stretch and not once per row; buckets of leading bits are then added one by one.
    """
    low = np.uint64(32)

    def count(batches):
        take, held, size = values(), [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(held) >> np.uint64(32 - bits), return_counts=True)
            buckets = (keys >> low).astype(np.int64)
            at = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(keys)]])
            cut = lambda array: [array[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(buckets[at[:-1]].astype(np.int32)), pa.array(cut(keys.astype(np.uint32)), type=pa.binary()),
                 pa.array(cut(counts.astype(np.uint32)), type=pa.binary())], ["bucket", "keys", "counts"])

        for batch in batches:
            for part in take(batch):
                held.append(part)
                size += len(part)
                if size >= COUNTED:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def add(batches):
        bucket, keys, counts = None, [], []

        def total():
            every, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.bincount(place, np.concatenate(counts), len(every)).astype(np.int64)
            often = sums >= least
            full = (np.int64(bucket) << 32) | every[often].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(full), pa.array(sums[often])], ["key", "n"])

        for batch in batches:
            for name, part, times in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if name != bucket and keys:
                    yield total()
                    keys, counts = [], []
                bucket = name
                keys.append(np.frombuffer(part, dtype=np.uint32))
                counts.append(np.frombuffer(times, dtype=np.uint32))
        if keys:
            yield total()

    dealt = rows.mapInArrow(count, "bucket int, keys binary, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(add, "key long, n long")


def _frequent(texts: DataFrame, measure: Measure, bits: int) -> np.ndarray:
    """The frequent tokens' leading bits, sorted.

    The list is broadcast, so it is counted first; where it would hold more than
    ``LISTED`` tokens the limit doubles. A token left out is treated as a rare one,
    which costs comparisons and loses no link.
    """
    def tokens():
        shingler = Shingler(measure.words)
        return lambda batch: shingler.sets(batch.column(0).to_pylist())

    often = stored(_tally(texts.select("text"), tokens, bits, FREQUENT + 1), "frequent")
    limit = FREQUENT
    while often.filter(F.col("n") > limit).count() > LISTED:
        limit *= 2
    keys = often.filter(F.col("n") > limit).select("key").toArrow().column("key").to_numpy()
    return np.sort(keys.astype(np.uint64))


# Signatures


def _bands(n: int, measure: Measure) -> range:
    """The sizes' bands in which a partner that is not larger may lie."""
    return range(max(1, measure.least(n)).bit_length(), n.bit_length() + 1)


def signatures(tokens: np.ndarray, frequent: np.ndarray, measure: Measure) -> tuple[np.ndarray, int]:
    """The signatures of a set, rare tokens first, and how many of them are rare tokens."""
    n = len(tokens)
    lacking = n - measure.least(n)
    rare = tokens[~frequent]
    if len(rare) > lacking:
        return rare[:lacking + 1], lacking + 1
    often = tokens[frequent]
    missing = lacking + 1 - len(rare)
    found = [rare]
    for band in _bands(n, measure):
        salt = hash_mix(np.array([band], dtype=np.uint64))[0]
        if band < SINGLE_BAND:
            found.append(hash_mix(often[:missing] ^ salt))
            continue
        classes = max(1, (1 << band) * (measure.below - measure.above) // (2 * measure.below))
        owner = (hash_mix(often ^ salt) % np.uint64(classes)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        begins = np.concatenate([[True], owner[order][1:] != owner[order][:-1]])
        place = np.arange(len(often)) - np.maximum.accumulate(np.where(begins, np.arange(len(often)), 0))
        turn = np.empty(len(often), dtype=np.int64)
        turn[order] = place
        # A class adds one for each token after its first.
        upto = int(np.searchsorted(np.cumsum(turn > 0), missing)) + 1
        own, member = often[:upto], owner[:upto]
        order = np.argsort(member, kind="stable")
        own, turn = own[order], turn[:upto][order]
        for back in range(1, int(turn.max(initial=0)) + 1):
            later = np.flatnonzero(turn >= back)
            found.append(hash_mix(hash_mix(own[later - back] ^ salt) + own[later] * ODD))
    return np.concatenate(found), len(rare)


def _signed(texts: DataFrame, measure: Measure, listed, bits: int) -> DataFrame:
    """Per row: its id, the size and the node of its set, the signatures and the number of rare ones."""
    fields = "n_shingles int, node long, rare int, signatures array<long>, bitmap binary"
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, {fields}"

    def sign(batches):
        shingler, table = Shingler(measure.words), listed.value
        for batch in batches:
            sizes, nodes, rares, lists, bitmaps = [], [], [], [], []
            for tokens in shingler.sets(batch.column(1).to_pylist()):
                sizes.append(len(tokens))
                if not len(tokens):
                    nodes.append(None), rares.append(0), lists.append(np.empty(0, dtype=np.uint64)), bitmaps.append(None)
                    continue
                found, rare = signatures(tokens, _member(tokens >> np.uint64(32 - bits), table), measure)
                nodes.append(_node(tokens)), rares.append(rare), lists.append(found), bitmaps.append(_bitmap(tokens))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, dtype=np.uint64), *lists]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, type=pa.int32()), pa.array(nodes, type=pa.int64()),
                 pa.array(rares, type=pa.int32()), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(bitmaps, type=pa.binary())],
                ["doc_id", "n_shingles", "node", "rare", "signatures", "bitmap"])

    return texts.mapInArrow(sign, schema)


def _bitmap(tokens: np.ndarray) -> bytes:
    """Whether an odd number of tokens falls on each bit; there are as many bits as tokens, within bounds."""
    bits = min(1 << 16, max(256, 1 << (len(tokens) - 1).bit_length()))
    odd = np.bincount((tokens >> np.uint64(7)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _differing(one: bytes, two: bytes) -> int:
    """A lower bound of the tokens that are in one of two sets only; the longer bitmap is folded."""
    while len(one) != len(two):
        one, two = (one, two) if len(one) > len(two) else (two, one)
        half = len(one) // 2
        folded = int.from_bytes(one[:half], "little") ^ int.from_bytes(one[half:], "little")
        one = folded.to_bytes(half, "little")
    return (int.from_bytes(one, "little") ^ int.from_bytes(two, "little")).bit_count()


def _member(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), dtype=bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _postings(rows: DataFrame, bits: int) -> DataFrame:
    """Signatures that several nodes have: ``sig``, ``node``, its size ``n``, ``rest`` and ``turn``.

    ``rest`` is the most that a pair can share beyond the token at hand if it has not
    met before; ``turn`` orders the nodes of a signature, those with most to share
    first. Most signatures occur once: counts of their leading bits and a bitmap of
    fixed size thin them out before any row is dealt.
    """
    def listed():
        return lambda batch: [batch.column(0).flatten().to_numpy().view(np.uint64)]

    again = stored(_tally(rows.select("signatures"), listed, bits, 2), "repeated")
    passed = rows.sparkSession.sparkContext.broadcast(sieve(again, "key", 26).words)

    def thin(batches):
        mask = Sieve(passed.value)
        for batch in batches:
            lists = batch.column("signatures")
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            counts = np.diff(ends)
            owner = np.repeat(np.arange(len(lists)), counts)
            place = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], counts)
            keep = mask.passes(flat.view(np.uint64) >> np.uint64(32 - bits))
            owner, place = owner[keep], place[keep]
            sizes, rare = batch.column("n_shingles").to_numpy()[owner], batch.column("rare").to_numpy()[owner]
            nodes = batch.column("node").to_numpy()[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[keep]), pa.array(nodes), pa.array(sizes), pa.array((sizes - np.minimum(place, rare) - 1).astype(np.int32))],
                ["sig", "node", "n", "rest"])

    each = rows.filter("node is not null").select("node", "n_shingles", "rare", "signatures").mapInArrow(
        thin, "sig long, node long, n int, rest int")
    distinct = each.groupBy("sig", "node").agg(F.first("n").alias("n"), F.max("rest").alias("rest"))
    own = Window.partitionBy("sig")
    turn = F.row_number().over(own.orderBy(F.expr("n - rest"), "node"))
    counted = distinct.withColumn("turn", turn).withColumn("many", F.count("*").over(own))
    return stored(counted.filter("many > 1").drop("many"), "postings")


# Comparison and merging


def _token_sets(texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """The tokens of the given nodes, read from the texts once more."""
    passed = texts.sparkSession.sparkContext.broadcast(sieve(nodes, "node", 24).words)

    def read(batches):
        shingler, mask, seen = Shingler(words), Sieve(passed.value), set()
        for batch in batches:
            found, kept = [], []
            for tokens in shingler.sets(batch.column(0).to_pylist()):
                node = _node(tokens)
                if len(tokens) and node not in seen and mask.passes(np.array([node], dtype=np.int64).view(np.uint64))[0]:
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(node)
                    found.append(node), kept.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.int64()), pa.array(kept, type=pa.binary())], ["node", "tokens"])

    each = texts.select("text").mapInArrow(read, "node long, tokens binary")
    return stored(each.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "sets")


def _compared(pairs: DataFrame, sets: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are similar enough, by their exact intersection."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))

    def compare(batches):
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = np.frombuffer(one.as_buffer(), dtype=np.uint64), np.frombuffer(two.as_buffer(), dtype=np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(measure.below * both >= measure.above * (len(x) + len(y) - both))
            keep = pa.array(keep, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def _standing(pairs: DataFrame, bitmaps: DataFrame, measure: Measure) -> DataFrame:
    """The pairs whose bitmaps do not rule a link out."""
    left = bitmaps.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("bitmap").alias("left"))
    right = bitmaps.select(F.col("node").alias("b"), "n", F.col("bitmap").alias("right"))

    def test(batches):
        for batch in batches:
            both = zip(*[batch.column(c).to_pylist() for c in ("left", "right", "m", "n")], strict=True)
            # Tokens in one set only are the sizes less twice the intersection.
            keep = pa.array([(measure.above + measure.below) * _differing(x, y) <= (measure.below - measure.above) * (m + n)
                             for x, y, m, n in both], type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "m", "n", "left", "right").mapInArrow(test, "a long, b long")


def _linked(texts: DataFrame, rows: DataFrame, posts: DataFrame, measure: Measure) -> DataFrame:
    """The component (``root``) of every node that shares a signature."""
    nodes = stored(posts.select("node").distinct(), "shared")
    labels = nodes.withColumn("root", F.col("node"))
    bitmaps = rows.select("node", F.col("n_shingles").alias("n"), "bitmap").join(nodes, "node", "left_semi")
    bitmaps = stored(bitmaps.dropDuplicates(["node"]), "bitmaps")
    sets = None
    lower, upper = 1, FIRST_ROUND
    open_posts = posts.withColumn("root", F.col("node"))
    while True:
        first, then = open_posts.filter(F.col("turn").between(lower, upper)).alias("p"), open_posts.alias("q")
        # Overlap that a link needs, against the most that the two can share from here on.
        possible = F.expr(f"(1 + least(p.rest, q.rest)) * {measure.above + measure.below}L >= (p.n + q.n) * {measure.above}L")
        apart = (F.col("p.turn") < F.col("q.turn")) & (F.col("p.root") != F.col("q.root")) & possible
        pairs = first.join(then, (F.col("p.sig") == F.col("q.sig")) & apart).select(
            F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()
        standing = stored(_standing(pairs, bitmaps, measure), "pairs")
        links = None
        if not standing.isEmpty():
            needed = standing.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            needed = stored(needed if sets is None else needed.join(sets.select("node"), "node", "left_anti"), "needed")
            if sets is None or not needed.isEmpty():
                read = _token_sets(texts, needed, measure.words)
                sets = read if sets is None else sets.unionByName(read)
            links = stored(_compared(standing, sets, measure), "links")
        if links is not None and not links.isEmpty():
            one = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
            two = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
            roots = components(links.join(one, "a").join(two, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
            moved = roots.select(F.col("node").alias("root"), F.col("root").alias("merged"))
            labels = stored(labels.join(moved, "root", "left").select("node", F.coalesce("merged", "root").alias("root")), "roots")
        left = open_posts.drop("root").filter(F.col("turn") > upper).join(labels, "node")
        several = left.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("sig")
        open_posts = stored(left.join(several, "sig", "left_semi"), "open")
        if open_posts.isEmpty():
            return labels
        lower, upper = upper + 1, upper * GROWTH
