import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from objsync.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


def whole_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check(rows, got, size):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    assert set(sequences) == set(range(len(sequences)))
    for (_, tokens), parts in pieces.items():
        assert sum(p["length"] for p in parts) % tokens == 0
    first = {r["doc_id"]: [] for r in got}
    for r in sorted(got, key=lambda r: r["start"]):
        first[r["doc_id"]] += r["ids"]
    ids = [i for i, _ in rows]
    for i, text in rows:
        if ids.count(i) == 1:
            assert first[i] == whole_ids(text)
    return len(sequences)


def test_round_trip_with_odd_texts(make, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 8)
    draw = random.Random(2)
    words = ["The", "cat's", "naïve", "e\u0301t\u0065\u0301", "12", "ab<|endoftext|>cd", "😀", "don't", "ÅB", "x\ty", "a\u00a0b", "'s"]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 90)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n \n"), (103, "z" * 20_000), (104, "same same"), (104, "same same"), (None, "no id")]
    df = make(rows, SCHEMA, clash=True)
    got = packing.pack(packing.token_pieces(df, PATH, 64), 64).collect()
    check(rows, got, 64)


def test_empty_table(make):
    df = make([], SCHEMA)
    assert packing.pack(packing.token_pieces(df, PATH)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_sequential_shortest_pack_first(seed):
    draw = random.Random(seed)
    size = 100
    histogram = Counter(draw.choice([draw.randint(1, size), 7, 50, size]) for _ in range(400))
    packs = []
    for length in sorted(histogram.elements(), reverse=True):
        best = min((p for p in packs if sum(p) + length <= size), key=sum, default=None)
        if best is None:
            packs.append([length])
        else:
            best.append(length)
    filled = defaultdict(list)
    for length, rank, count, first, offset in packing.plan_packs(histogram, size):
        for k in range(count):
            filled[first + k].append((offset, length))
    assert Counter(tuple(sorted(length for _, length in p)) for p in filled.values()) == Counter(tuple(sorted(p)) for p in packs)
    for spans in filled.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(spans), sorted(spans)[1:]))


def test_little_padding(spark, llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(packing.token_pieces(docs, PATH, with_ids=False)).selectExpr("sum(length) t", "count(distinct sequence_id) s").head()
    assert got["t"] / (got["s"] * 4096) > 0.95


def test_workers_give_up_the_tokenizer_after_the_stage(make):
    """The parts that a worker remembers go with the first task of another stage."""
    def held(batches):
        import gc

        import pyarrow as pa
        import tokenizers

        for _ in batches:
            pass
        gc.collect()
        alive = sum(type(o) is tokenizers.Tokenizer or type(o).__name__ == "Known" for o in gc.get_objects())
        kept = len(vars(tokenizers).get("_objsync_known", {}))
        yield pa.RecordBatch.from_arrays([pa.array([alive + kept])], ["n"])

    df = make([(i, f"word{i} and more") for i in range(64)], SCHEMA).repartition(8)
    assert packing.token_pieces(df, PATH).count() == 64
    assert {r["n"] for r in df.mapInArrow(held, "n long").collect()} == {0}


def test_blocks_are_whole_rows_of_bounded_text(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 10)
    texts = ["abc", None, "", "abcdefgh", "x" * 35, "é", None, "abc", "last"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    parts = list(packing._blocks([batch, batch.slice(0, 0), batch.slice(3, 4)]))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts + texts[3:7]
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()[:-1]) < 10 for p in parts)
