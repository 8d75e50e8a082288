"""Packing token pieces into sequences: shortest pack first over the histogram of lengths."""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync.llm.common import ranked, stored

END_ID = 2
# Rows of one length that one task numbers.
BUCKET_ROWS = 4096
# Bytes of text that are encoded at a time, in whole rows.
BLOCK = 4 << 20
# Parts of at most so many characters whose ids a worker remembers; past that number it starts again.
LONGEST = 64
REMEMBERED = 600_000

PIECE = "start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 4096, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Cut each document's ids into pieces of ``size`` and a shorter rest.

    ``tokenizer`` is the path of a tokenizer file. A document's ids are those of its
    text without special tokens, then ``END_ID``; null text is empty text, so every
    row gives a piece at least. Result: the key, ``start`` (ids of the document
    before the piece), ``length``, ``ids_crc32`` (unsigned, of the ids as little-endian
    unsigned 32-bit numbers), ``doc_tokens`` and, unless left out, ``ids``. Repeated
    rows and rows with a null key are pieces of their own; other columns are ignored.
    """
    fields = PIECE if with_ids else PIECE.rpartition(",")[0]
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {fields}"
    # A worker keeps its copy of a broadcast from task to task and gives it up with the first task that has no use for it.
    memory = docs.sparkSession.sparkContext.broadcast({})

    def cut(batches):
        encode = _encoder(tokenizer, memory.value)
        for batch in _blocks(batches):
            ids, ends = encode(batch.column(1))
            tokens = np.diff(ends, prepend=0)
            pieces = -(-tokens // size)
            owner = np.repeat(np.arange(len(tokens)), pieces)
            starts = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
            lengths = np.minimum(size, tokens[owner] - starts)
            data = memoryview(ids.tobytes())
            first = 4 * (ends[owner] - tokens[owner] + starts)
            sums = [zlib.crc32(data[at:at + 4 * n]) for at, n in zip(first.tolist(), lengths.tolist(), strict=True)]
            arrays = [batch.column(0).take(pa.array(owner)), *map(pa.array, (starts, lengths, np.array(sums, dtype=np.int64), tokens[owner]))]
            if with_ids:  # pieces follow each other as the ids do
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                arrays.append(pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32))))
            yield pa.RecordBatch.from_arrays(arrays, [key, "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(arrays)])
            del ids, data, arrays
        pa.default_memory_pool().release_unused()

    return docs.select(key, "text").mapInArrow(cut, schema)


def _blocks(batches):
    """The batches in slices of whole rows with about ``BLOCK`` bytes of text each, or a single longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // BLOCK)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True):
            yield batch.slice(a, b - a)


def _encoder(path: str, memory: dict):
    """A column of texts to the ids of all, each text's followed by ``END_ID``, and where each text's end.

    White space separates the tokenizer's words, so the ids of a text are those of
    its blank-separated parts in turn. The distinct parts of a batch are found by Arrow and
    looked up once; their ids are then dealt out by position.
    """
    known = _known(path, memory)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        each = parts.flatten().dictionary_encode()
        found = [known[part] for part in each.dictionary.to_pylist()]
        sizes = np.fromiter((len(data) // 4 for data in found), dtype=np.int64, count=len(found))
        flat, codes = np.frombuffer(b"".join(found), dtype="<u4"), each.indices.to_numpy()
        lengths = sizes[codes]
        after = np.cumsum(lengths)
        at = np.repeat((np.cumsum(sizes) - sizes)[codes] - after + lengths, lengths) + np.arange(lengths.sum())
        last = np.cumsum(pc.list_value_length(parts).to_numpy())
        ends = np.concatenate([[0], after])[last]
        return np.insert(flat[at], ends, END_ID), ends + np.arange(1, len(ends) + 1)

    return encode


def _known(path: str, memory: dict):
    """A dictionary from a part to the bytes of its ids, kept in ``memory``.

    A part of letters is one word: it goes to the tokenizer's model at once, spelt as
    the tokenizer's normaliser and byte alphabet would spell it.
    """
    import unicodedata

    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    if path in memory:
        return memory[path]
    tokenizer = Tokenizer.from_file(path)
    model = tokenizer.model
    # The byte alphabet gives printable bytes their own character and the others, in order, the ones from 256 on.
    own = sorted(ord(c) for c in ByteLevel.alphabet() if ord(c) < 256)
    others = iter(range(256, 512))
    spelt = {byte: byte if byte in own else next(others) for byte in range(256)}
    moved = {byte: char for byte, char in spelt.items() if byte != char}

    def word(part):
        """The ids of a part of letters, or None where lower case depends on more than the letter."""
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
            if "\u03a3" in part or "\u0130" in part:
                return None
        part = part.lower()
        if not part.isascii():
            if not part.isalpha():
                return None
            part = part.encode().decode("latin-1").translate(moved)
        return [token.id for token in model.tokenize(part)]

    class Known(dict):
        def __missing__(self, part):
            # Lower case can turn the last letter into one with a mark, which a full stop would join.
            if part[-1:] in (".", ",") and part[:-1].isalpha() and "\u0130" not in part and len(part) <= LONGEST:
                data = self[part[:-1]] + self[part[-1]]
            else:
                ids = word(part) if part.isalpha() else None
                if ids is None:
                    ids = tokenizer.encode(part, add_special_tokens=False).ids
                data = np.array(ids, dtype="<u4").tobytes()
            if len(part) <= LONGEST:
                if len(self) >= REMEMBERED:
                    self.clear()
                self[part] = data
            return data

    memory[path] = Known()
    return memory[path]


def plan_packs(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Place the lengths of a histogram, longest first, each into the shortest pack with room.

    Packs that hold the same lengths are one pattern with a count, kept as a range
    of sequence ids, so the work follows the number of lengths and patterns and not
    the number of pieces. Result: slots (length, first rank, count, first sequence,
    offset); the pieces of that length with the ranks from the first on go, one
    each, to the sequences from the first on, at the offset.
    """
    slots, heap, following = [], [], 0  # heap: (used, first sequence, count)
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if heap and heap[0][0] + length <= size:
                used, first, count = heapq.heappop(heap)
                taken = min(count, left)
                if taken < count:
                    heapq.heappush(heap, (used, first + taken, count - taken))
            else:
                # The shortest pack lacks room, so all do: each new pack takes as many as fit.
                each = size // length
                used, first, taken = 0, following, max(1, left // each)
                following += taken
                if left >= each:
                    for turn in range(each - 1):
                        slots.append((length, rank, taken, first, used))
                        used, rank, left = used + length, rank + taken, left - taken
            slots.append((length, rank, taken, first, used))
            rank, left = rank + taken, left - taken
            if used + length < size:
                heapq.heappush(heap, (used + length, first, taken))
    return slots


def pack(pieces: DataFrame, size: int = 4096, key: str = "doc_id") -> DataFrame:
    """Give every piece (of ``token_pieces``) its ``sequence_id`` and ``offset``.

    Sequences hold at most ``size`` ids and are padded to it; offsets are gapless
    from 0. Equal pieces may change places. No pieces give no rows.

    Only the histogram of lengths, at most ``size`` rows, reaches the driver, and
    the slots made of it go back to the executors. The pieces of a length are
    numbered over many tasks, so a length of a third of all pieces stays spread.
    """
    # Equal pieces are told apart by a number, so that they too are dealt over many tasks.
    held = stored(pieces.withColumn("__n", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in held.groupBy("length").count().collect()}
    slots = plan_packs(counts, size)
    total = sum(counts.values())
    session = held.sparkSession
    buckets = max(1, -(-total // BUCKET_ROWS))
    spread = F.pmod(F.xxhash64(f"`{key}`", "start", "ids_crc32", "__n"), F.lit(buckets)).cast("int")
    numbered = ranked(held.withColumn("__bucket", spread), ["length"], "__bucket", [f"`{key}`", "start", "ids_crc32", "__n"], "__rank")
    table = session.sparkContext.broadcast(_slot_table(slots))

    def place(batches):
        lengths, ranks, firsts, offsets = table.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy() - 1
            # Slots are sorted by length and first rank: the last one that is not past the piece is its own.
            at = np.searchsorted(_joint(lengths, ranks), _joint(length, rank), side="right") - 1
            sequence = firsts[at] + rank - ranks[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [pa.array(sequence), pa.array(offsets[at])],
                [*kept, "sequence_id", "offset"])

    kept = [c for c in held.columns if c not in ("sequence_id", "offset", "__n")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema if f.name in kept)
    return numbered.drop("__bucket", "__n").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def _joint(lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Length and rank as one sortable number; ranks stay below 2**48."""
    return (lengths.astype(np.int64) << 48) + ranks.astype(np.int64)


def _slot_table(slots: list[tuple]) -> tuple[np.ndarray, ...]:
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 5)
    return table[:, 0], table[:, 1], table[:, 3], table[:, 4]
