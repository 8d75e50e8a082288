from collections import Counter

from objsync.llm import shards

SCHEMA = "doc_id long, source string"


def dealt(df, n):
    return [tuple(r) for r in shards.interleave(df, n, "7").select("doc_id", "source", "shard", "slot").collect()]


def test_sizes_and_mixture(make, monkeypatch):
    monkeypatch.setattr(shards, "BUCKET_ROWS", 64)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2000)]
    got = dealt(make(rows, SCHEMA, clash=True).drop("shard", "slot"), 9)
    assert sorted(x[:2] for x in got) == sorted(rows)
    sizes = Counter(x[2] for x in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(9))
    for s in range(9):
        assert sorted(x[3] for x in got if x[2] == s) == list(range(sizes[s]))
    whole = Counter(x[1] for x in got)
    for (_, source), count in Counter((x[2], x[1]) for x in got).items():
        assert abs(count - whole[source] / 9) <= 2


def test_same_as_a_plain_sort(make, monkeypatch):
    import hashlib

    rows = [(i, f"s{i % 5}" if i % 4 else None) for i in range(300)]
    monkeypatch.setattr(shards, "BUCKET_ROWS", 16)
    draw = lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest()
    place = {}
    for source in {s for _, s in rows}:
        own = sorted((i for i, s in rows if s == source), key=draw)
        place |= {i: ((rank + 0.5) / len(own), "0" if source is None else "1" + source, draw(i)) for rank, i in enumerate(own)}
    order = sorted(place, key=place.get)
    want = {i: at * 7 // 300 for at, i in enumerate(order)}
    assert {x[0]: x[2] for x in dealt(make(rows, SCHEMA), 7)} == want


def test_nulls_repeats_and_empty(make):
    got = dealt(make([(None, None), (1, None), (1, "a"), (1, "a")], SCHEMA), 3)
    assert sorted((x[2], x[3]) for x in got) == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert dealt(make([], SCHEMA), 3) == []


def test_write_keeps_the_order_of_slots(make, llm, folder):
    df = shards.interleave(make([(i, "a") for i in range(50)], SCHEMA), 2, "7")
    shards.write_shards(df, folder + "/out")
    back = llm.read.parquet(folder + "/out/shard=1")
    assert [r["slot"] for r in back.coalesce(1).sort("slot").collect()] == list(range(25))
