"""Removal of passages that repeat across documents, by prefix doubling over sampled positions.

Prefix doubling names the string of length 2h at a place by the names at the place and
h further on. Strings of up to ``size / 2`` bytes are named within a task, where a name
is a 64-bit fingerprint, so that no rank has to be fetched by a join. From half the size on
names are dealt out by their hash: strings that no other document holds go after each round, and the pair of
two halves, ``size`` bytes, is the last. Not every place is ranked. A place is taken
where its name is the least of those in a window, so each string of ``size`` bytes holds
one, equal strings the same one, and a round handles a thirteenth of the bytes.

What is dealt carries the row and the byte it comes from, so a round's answer names the
places itself and nothing goes back to the texts but a list of places for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from objsync.llm.common import Sieve, add_columns, discard, free_names, hash_mix, sieve, stored

# Bytes that are named at a time; a longer text is read in stretches that overlap by a string.
STRETCH = 1 << 15
PLACE_BITS = 18
# Bits for the length of a run, which is below the size of a string.
RUN_BITS = 16
# Names of half the size that one bitmap is for, and how often the texts are read for their runs at most: with more names than
# fit, bitmaps pass more, and a third of all runs still bounds what is dealt at a time.
MEMBERS, SLICES = 1 << 24, 3
# Runs and bytes of runs that a task holds before it deals them out, and bytes of the texts for a partition that they are dealt to.
HELD, HELD_BYTES, PART_BYTES = 1 << 19, 4 << 20, 32 << 20
# Times that a name is dealt beyond which the runs around it are dealt by their own strings.
HOT = 1 << 13
SLOT_BITS = 14
NAMES = hash_mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
FIELDS = StructType([StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
                     StructField("spans", ArrayType(SPAN)), StructField("kept", BinaryType())])

# A run: the sums of its strings' names, hashes of the sampled place and of the strings to both sides of it, its row and bytes.
RUN = np.dtype([("k1", "<u8"), ("k2", "<u8"), ("gram", "<u4"), ("left", "<u2"), ("right", "<u2"), ("doc", "<i8"), ("row", "<i8"),
                ("start", "<u4"), ("more", "<u2"), ("kind", "u1")])
# A run whose bytes are dealt with it, and a string.
HEAD = np.dtype([("doc", "<i8"), ("row", "<i8"), ("start", "<u4"), ("more", "<u2")])
STRING = np.dtype([("k1", "<u8"), ("k2", "<u8"), ("doc", "<i8"), ("row", "<i8"), ("start", "<u4"), ("kind", "u1")])
# Kinds: to be compared; the same, of a hot name; in a smaller document, too, as its task has found.
PLAIN, SPREAD, GONE = range(3)


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """Cut from each ``text`` the bytes of every ``size``-byte string that also starts in a document with a smaller ``doc_id``.

    Texts are taken as UTF-8 bytes, null as none; strings never cross documents and are
    judged on the input. Result, beside the columns of ``docs`` (columns with a
    result's name are replaced): ``n_bytes``, ``n_removed``, ``spans``, the maximal
    removed runs as byte offsets, end exclusive, and ``kept``, the remaining bytes. A
    row without an id removes nothing and keeps all; rows that share an id do not
    remove each other's strings. Texts shorter than ``size`` stay whole; no rows give no rows.

    Rounds: names of half the size at sampled places, kept where they are dealt twice;
    the runs of strings around such a place, where copies become one; and, where runs with
    one place differ and may share a string, each string as a pair of names. What is alike
    within a task becomes one before it is dealt, and runs of a name that many have are
    dealt by their strings, so a passage of any share of the documents stays spread. The
    bitmap of the first round only thins out what the others decide, and the runs are taken
    in slices, so what is on disk at a time stays in proportion to the texts.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("row"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))
    texts = texts.filter(F.col("doc_id").isNotNull() & (F.octet_length("data") >= size))
    total = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 1
    parts = max(_shuffle_partitions(docs), -(-total // PART_BYTES))

    # A text deals a name once a stretch, so a name that is dealt twice is held by two documents, or by one that is long.
    source = texts.select("doc_id", "data")
    grams = source.mapInArrow(_scan(size, _grams), "gram long, doc long").groupBy("gram").count().filter("count > 1")
    grams = stored(grams, "grams")
    slices = min(SLICES, -(-grams.count() // MEMBERS) or 1)
    hot = grams.filter(F.col("count") > HOT).select("gram").toArrow().column(0).to_numpy()
    hot = docs.sparkSession.sparkContext.broadcast(np.unique(_mixed(hot.view(np.uint64))))

    settled = []
    for at in range(slices):
        shared = _sieve(grams.filter(F.pmod("gram", F.lit(slices)) == at), "gram")
        dealt = texts.mapInArrow(_runs(size, shared, hot, slices, at, parts), "part int, data binary")
        settled.append(stored(dealt.repartitionById(parts, F.col("part")).mapInArrow(_settle_runs, "doc long, row long, at long, slot int"), "contexts"))
        shared.destroy()
    hot.destroy()
    discard(grams)

    # Where all copies of a place agree in all strings around it, no string needs a look of its own.
    unlike = _union(settled).filter("slot >= 0")
    # As many runs at a time as have no more bytes than the texts.
    slices = -(-unlike.count() * 2 * size // total) or 1
    strings = []
    for at in range(slices):
        runs = unlike.filter(F.pmod(F.shiftright("slot", 1), F.lit(slices)) == at)
        runs = runs.groupBy(F.col("doc").alias("__doc"), F.col("row").alias("__row")).agg(
            F.collect_set(F.shiftleft("at", SLOT_BITS + 1).bitwiseOR(F.col("slot"))).alias("runs"))
        # A row of the build side is one text's list, and no text is sorted.
        found = texts.join(runs.hint("shuffle_hash"), (F.col("doc_id") == F.col("__doc")) & (F.col("row") == F.col("__row")))
        dealt = found.select("doc_id", "row", "data", "runs").mapInArrow(_pieces(size, slices, parts), "part int, heads binary, data binary, strings binary")
        strings.append(stored(dealt.repartitionById(parts, F.col("part")).mapInArrow(_settle_strings(size), "doc long, row long, at long"), "runs"))

    later = _union([s.filter("slot < 0").drop("slot") for s in settled] + strings)
    found = later.groupBy(F.col("doc").alias("__doc"), F.col("row").alias("__row")).agg(F.collect_set("at").alias("__runs"))
    found = stored(found, "cuts")
    discard(*settled, *strings)

    own = free_names(docs, FIELDS.names)
    marked = own.join(found, (F.col("doc_id") == F.col("__doc")) & (F.xxhash64("text") == F.col("__row")), "left")
    cut = add_columns(marked.withColumn("__data", F.coalesce(F.col("text").cast("binary"), F.lit(b""))), FIELDS, lambda: _cutter(size), ["__data", "__runs"])
    return cut.select(*own.columns, *FIELDS.names)


def _shuffle_partitions(df: DataFrame) -> int:
    """How many a shuffle starts with."""
    conf = df.sparkSession.conf
    return int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _sieve(df: DataFrame, column: str):
    """The bitmap of a column, with sixteen bits a value up to 16 MB, as a broadcast."""
    bits = min(27, max(16, (16 * df.count()).bit_length()))
    return df.sparkSession.sparkContext.broadcast(sieve(df, column, bits, written=True))


def _scan(size: int, emit, *sieves):
    """A function over Arrow batches of (doc, ..., data): what ``emit`` makes of the named stretches of the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [s.value for s in sieves]
        for batch in batches:
            for named in _stretches(batch, size):
                yield emit(named, *own)

    return run


@dataclass
class Named:
    """Texts or stretches of them, end to end, with the names of their strings.

    ``half[i]`` names the half-size string at byte i. A run is a range of bytes at which
    strings with one sampled place start: ``first`` and ``last`` of it, ``gram``, the name
    at that ``place``, and ``owner``, the number of the text, for which there are ``doc``,
    ``row`` and ``shift``, from a byte here to one of the text. ``cuts`` are the borders
    between runs, ``whole`` marks those within a text.
    """

    half: np.ndarray
    gap: int
    cuts: np.ndarray
    whole: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray
    owner: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    shift: np.ndarray
    place: np.ndarray

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Two sums over the names of each run's strings: runs with equal strings have equal sums."""
        name = _pair(self.half[:-self.gap], self.half[self.gap:])[:self.cuts[-1]]
        return self._sums(name), self._sums(_other(name))

    def second(self) -> np.ndarray:
        """The second of these sums."""
        return self._sums(_other(_pair(self.half[:-self.gap], self.half[self.gap:])[:self.cuts[-1]]))

    def _sums(self, name: np.ndarray) -> np.ndarray:
        return np.add.reduceat(name, self.cuts[:-1])[self.whole]

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        """The names that begin and end half of what a string has beside its place: equal strings have one of them in common."""
        side = (self.gap + 1) // 2
        return self.half[np.maximum(self.place - side, 0)], self.half[np.minimum(self.place + side, len(self.half) - 1)]


def _stretches(batch: pa.RecordBatch, size: int) -> Iterator[Named]:
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    rows = batch.column(1).to_numpy(zero_copy_only=False) if batch.num_columns > 2 else ids
    held, total = [], 0
    for number, data in enumerate(batch.column(batch.num_columns - 1)):
        data = data.as_py()
        for base in range(0, len(data) - size + 1, STRETCH):
            piece = data[base:base + STRETCH + size - 1]
            held.append((piece, ids[number], rows[number], base))
            total += len(piece)
            if total >= STRETCH:
                yield _named(held, size)
                held, total = [], 0
    if held:
        yield _named(held, size)


def _named(held: list[tuple], size: int) -> Named:
    lengths = np.array([len(p) for p, *_ in held])
    begin = np.cumsum(lengths) - lengths
    name, gap = _halves(np.frombuffer(b"".join(p for p, *_ in held), dtype=np.uint8), size)
    # The least name of those in a string, the first of equal ones: its place rides in the low bits.
    low = np.uint64((1 << PLACE_BITS) - 1)
    least, reach, window = name & ~low, 1, gap + 1
    least |= np.arange(len(least), dtype=np.uint64)
    while reach < window:
        further = min(2 * reach, window)
        least = np.minimum(least[:len(least) - (further - reach)], least[further - reach:])
        reach = further
    least &= low
    places = least.view(np.int64)
    # Bytes at which a string would leave its text belong to no run.
    border = np.zeros(len(places), dtype=bool)
    for end in (begin + lengths)[:-1]:
        border[end - size + 1:end] = True
    cuts = np.concatenate([[0], np.flatnonzero((places[1:] != places[:-1]) | (border[1:] != border[:-1])) + 1, [len(places)]])
    whole = ~border[cuts[:-1]]
    first, last = cuts[:-1][whole], cuts[1:][whole] - 1
    doc, row, base = (np.array([h[k] for h in held], dtype=np.int64) for k in (1, 2, 3))
    owner = np.searchsorted(begin, first, side="right") - 1
    return Named(name, gap, cuts, whole, first, last, name[places[first]], owner, doc, row, base - begin, places[first])


def _halves(data: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """The names of the half-size strings, and how far on the second half of a string starts."""
    step = (size + 1) // 2
    # Names of 1, 2, 4, ... bytes, and of half the size by two that overlap. Eight bytes are a name as they are.
    name, reach = (_words(data), 8) if step >= 8 else (NAMES[data], 1)
    while reach < step:
        further = min(2 * reach, step)
        name = _pair(name[:len(name) - (further - reach)], name[further - reach:])
        reach = further
    # A whole string is two halves, which overlap by a byte if its size is odd.
    return name, size - step


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number, scrambled: different bytes, different names."""
    name = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,)) * np.uint64(0xD6E8FEB86659FD93)
    name ^= name >> np.uint64(32)
    name *= np.uint64(0x8EBC6AF09C88C6E3)
    return name


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two names."""
    mixed = a * np.uint64(0xD6E8FEB86659FD93)
    mixed += b
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x8EBC6AF09C88C6E3)
    return mixed


def _other(name: np.ndarray) -> np.ndarray:
    """A second value of the names."""
    other = name ^ (name >> np.uint64(31))
    other *= np.uint64(0x9E3779B97F4A7C15)
    return other


def _grams(named: Named) -> pa.RecordBatch:
    # Owners ascend, so a stable sort by name puts the equal pairs side by side.
    order = np.argsort(named.gram, kind="stable")
    gram, owner = named.gram[order], named.owner[order]
    new = np.ones(len(gram), dtype=bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return _batch(gram=gram[new], doc=named.doc[owner[new]])


def _runs(size: int, shared, hot, slices: int, at: int, parts: int):
    """Deals out the runs whose names pass, those of one slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for named in _stretches(batch, size):
                held.append(_contexts(named, shared.value, slices, at))
                count += len(held[-1])
                if count >= HELD:
                    yield _deal_runs(np.concatenate(held), hot.value, parts)
                    held, count = [], 0
        if count:
            yield _deal_runs(np.concatenate(held), hot.value, parts)

    return run


def _contexts(named: Named, shared: Sieve, slices: int, at: int) -> np.ndarray:
    keep = shared.passes(named.gram)
    if slices > 1:
        keep &= named.gram.view(np.int64) % slices == at
    owner, first = named.owner[keep], named.first[keep]
    runs = np.zeros(len(owner), dtype=RUN)
    for field, values in zip(("k1", "k2", "left", "right"), (*named.contexts(), *(side >> np.uint64(48) for side in named.sides())), strict=True):
        runs[field] = values[keep]
    runs["gram"] = _mixed(named.gram[keep])
    runs["doc"], runs["row"], runs["start"], runs["more"] = named.doc[owner], named.row[owner], first + named.shift[owner], named.last[keep] - first
    return runs


def _mixed(gram: np.ndarray) -> np.ndarray:
    """32 bits of a name to deal it by: the least of many names is a small number."""
    return (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def _deal_runs(runs: np.ndarray, hot: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row a partition: runs are dealt by name, of hot names by their strings. Copies in later documents are found here."""
    spread, gone = np.isin(runs["gram"], hot), _later(runs["k1"], runs["k2"], runs["doc"])
    runs["kind"][spread] = SPREAD
    part = _part(np.where(spread, runs["k1"] >> np.uint64(32), runs["gram"]), parts)
    # Nothing is compared with these any more, so they are dealt evenly and without names.
    part[gone] = np.arange(gone.sum()) % parts
    for field in ("k1", "k2", "gram", "left", "right"):
        runs[field][gone] = 0
    runs["kind"][gone] = GONE
    numbers, blocks = _blocks(runs, part)
    return pa.RecordBatch.from_arrays([numbers, blocks], ["part", "data"])


def _settle_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that go, with slot -1, and those to be looked at string by string, with the slot of their name, doubled, plus one if it is hot."""
    runs = _records([data for batch in batches for data in batch.column(1)], RUN)
    gone = runs["kind"] == GONE
    yield from _found(runs[gone])
    runs = runs[~gone]
    gone = _later(runs["k1"], runs["k2"], runs["doc"])
    yield from _found(runs[gone])
    runs = runs[~gone]
    spread = runs["kind"] == SPREAD
    # Runs that are left differ between documents; those with a string in common agree to one side of the place.
    unlike = spread | _shared(runs["gram"], runs["left"], runs["doc"]) | _shared(runs["gram"], runs["right"], runs["doc"])
    slot = (runs["gram"] & np.uint32((1 << SLOT_BITS) - 1)).astype(np.int32) << 1 | spread
    yield from _found(runs[unlike], slot[unlike])


def _found(runs: np.ndarray, slot: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    slot = np.full(len(runs), -1) if slot is None else slot
    for low in range(0, len(runs), 1 << 16):
        some = runs[low:low + (1 << 16)]
        at = some["start"].astype(np.int64) << RUN_BITS | some["more"]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, type=pa.int64()) for c in (some["doc"].copy(), some["row"].copy(), at)),
                                          pa.array(slot[low:low + (1 << 16)].astype(np.int32))], ["doc", "row", "at", "slot"])


def _pieces(size: int, slices: int, parts: int):
    """Deals out the bytes of the listed runs of texts by the slot of their name; of hot names, each string by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            data = batch.column(2).to_pylist()
            lengths = np.array([len(d) for d in data])
            data = np.frombuffer(b"".join(data), dtype=np.uint8)
            lists = batch.column(3)
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            values = lists.flatten().to_numpy(zero_copy_only=False)
            heads = np.zeros(len(values), dtype=HEAD)
            heads["doc"], heads["row"] = (batch.column(k).to_numpy(zero_copy_only=False)[owner] for k in range(2))
            heads["start"], heads["more"] = values >> SLOT_BITS + 1 + RUN_BITS, values >> SLOT_BITS + 1 & (1 << RUN_BITS) - 1
            slot = values & (1 << SLOT_BITS + 1) - 1
            begin = (np.cumsum(lengths) - lengths)[owner] + heads["start"]
            # As many runs at a time as fit the bytes to hold.
            cuts = np.flatnonzero(np.diff(np.cumsum(heads["more"] + np.int64(size)) // HELD_BYTES)) + 1
            for some in np.split(np.arange(len(values)), cuts):
                lengths = heads["more"][some] + np.int64(size)
                held.append((heads[some], slot[some], data[_ranges(begin[some], lengths)]))
                total += lengths.sum()
                if total >= HELD_BYTES:
                    yield _deal_pieces(held, size, slices, parts)
                    held, total = [], 0
        if held:
            yield _deal_pieces(held, size, slices, parts)

    return run


def _deal_pieces(held: list[tuple], size: int, slices: int, parts: int) -> pa.RecordBatch:
    heads, slot, data = (np.concatenate(c) for c in zip(*held, strict=True))
    lengths = heads["more"] + np.int64(size)
    begin = np.cumsum(lengths) - lengths
    hot = slot & 1 == 1
    strings = _strings(heads[hot], data[_ranges(begin[hot], lengths[hot])], size)
    strings["kind"][_later(strings["k1"], strings["k2"], strings["doc"])] = GONE
    spread, blocks = _blocks(strings, _part(strings["k1"] >> np.uint64(32), parts))

    heads, begin, lengths = heads[~hot], begin[~hot], lengths[~hot]
    part = (slot[~hot] // 2 // slices) % parts
    order = np.argsort(part, kind="stable")
    data = data[_ranges(begin[order], lengths[order])].tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths[order])])
    numbers, tops = _blocks(heads, part)
    edges = ends[np.searchsorted(part[order], [*numbers.to_pylist(), parts])]
    none = [None] * len(numbers)
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([numbers, spread]), pa.array([*tops.to_pylist(), *[None] * len(spread)], type=pa.binary()),
        pa.array([*(data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)), *[None] * len(spread)], type=pa.binary()),
        pa.array([*none, *blocks.to_pylist()], type=pa.binary())], ["part", "heads", "data", "strings"])


def _settle_strings(size: int):
    """The strings that also start in a document with a smaller id, those in a row as one run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, spread, heads, data, total = [], [], [], [], 0
        for batch in batches:
            for head, piece, strings in zip(*(batch.column(k) for k in (1, 2, 3)), strict=True):
                if strings.is_valid:
                    spread.append(strings)
                    continue
                heads.append(head)
                data.append(piece.as_py())
                total += len(data[-1])
                if total >= HELD_BYTES // 8:
                    own.append(_strings(_records(heads, HEAD), np.frombuffer(b"".join(data), dtype=np.uint8), size))
                    heads, data, total = [], [], 0
        own.append(_strings(_records(heads, HEAD), np.frombuffer(b"".join(data), dtype=np.uint8), size))
        strings = np.concatenate([*own, _records(spread, STRING)])
        gone = strings["kind"] == GONE
        strings["kind"][~gone & _later(strings["k1"], strings["k2"], strings["doc"])] = GONE
        found = strings[strings["kind"] == GONE]
        if not len(found):
            return
        new = np.ones(len(found), dtype=bool)
        new[1:] = found["start"][1:] != found["start"][:-1] + np.uint32(1)
        for field in ("doc", "row"):
            new[1:] |= found[field][1:] != found[field][:-1]
        # A run of names is shorter than a string; those that touch become one when they are cut.
        new[::size] = True
        first = np.flatnonzero(new)
        runs = np.zeros(len(first), dtype=HEAD)
        for field in ("doc", "row", "start"):
            runs[field] = found[field][first]
        runs["more"] = np.diff(np.append(first, len(found))) - 1
        for batch in _found(runs):
            yield batch.select(["doc", "row", "at"])

    return run


def _strings(heads: np.ndarray, data: np.ndarray, size: int) -> np.ndarray:
    """The strings of runs whose bytes stand end to end."""
    counts = heads["more"] + np.int64(1)
    strings = np.zeros(counts.sum(), dtype=STRING)
    if len(strings):
        half, gap = _halves(data, size)
        lengths = counts + size - 1
        at = _ranges(np.cumsum(lengths) - lengths, counts)
        strings["k1"], strings["k2"] = half[at], half[at + gap]
        strings["doc"], strings["row"] = np.repeat(heads["doc"], counts), np.repeat(heads["row"], counts)
        strings["start"] = _ranges(heads["start"].astype(np.int64), counts)
    return strings


def _later(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows are in a document after the first one with their pair of names."""
    rows, group, first = _groups(a, b, doc)
    later = np.zeros(len(a), dtype=bool)
    later[rows] = doc[rows] > doc[rows[first]][group]
    return later


def _shared(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows have a pair of names that another document has, too."""
    rows, group, first = _groups(a, b, doc)
    last = np.append(first[1:], len(rows))[:len(first)] - 1
    shared = np.zeros(len(a), dtype=bool)
    shared[rows] = (doc[rows[first]] < doc[rows[last]])[group]
    return shared


def _groups(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose first name another has, by both names and document; the number of each one's pair; where the pairs begin."""
    order = np.argsort(a)
    same = a[order][1:] == a[order][:-1]
    twice = np.zeros(len(a), dtype=bool)
    twice[1:] = same
    twice[:-1] |= same
    rows = order[twice]
    rows = rows[np.lexsort((doc[rows], b[rows], a[rows]))]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (a[rows][1:] != a[rows][:-1]) | (b[rows][1:] != b[rows][:-1])
    return rows, np.cumsum(new) - 1, np.flatnonzero(new)


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partitions by 32-bit hashes."""
    return (hashes.astype(np.uint64) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _blocks(records: np.ndarray, part: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The partitions that have records, and these as bytes: first bytes of all, second bytes, ..., which compress well."""
    order = np.argsort(part, kind="stable")
    numbers, first = np.unique(part[order], return_index=True)
    rows = records[order].view(np.uint8).reshape(len(records), records.dtype.itemsize)
    edges = np.append(first, len(rows))
    blocks = [rows[a:b].T.tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.array(numbers, type=pa.int32()), pa.array(blocks, type=pa.binary())


def _records(blocks: list[pa.Scalar], kind: np.dtype) -> np.ndarray:
    rows = [np.frombuffer(b.as_buffer(), dtype=np.uint8).reshape(kind.itemsize, -1).T for b in blocks]
    return np.concatenate([np.zeros((0, kind.itemsize), dtype=np.uint8), *rows]).reshape(-1).view(kind)


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns.values()], list(columns))


def _cutter(size: int):
    def cut(texts: pa.Array, runs: pa.Array) -> list[pa.Array]:
        columns = [[] for _ in FIELDS]
        for data, starts in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
            spans: list[dict] = []
            for at in sorted(starts or []):
                low = at >> RUN_BITS
                high = low + (at & (1 << RUN_BITS) - 1)
                if spans and low <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], high + size)
                else:
                    spans.append({"start": low, "end": high + size})
            edges = [0, *[e for s in spans for e in (s["start"], s["end"])], len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            for column, value in zip(columns, (len(data), len(data) - len(kept), spans, kept), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        return [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]

    return cut
