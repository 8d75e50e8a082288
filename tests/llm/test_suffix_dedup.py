import hashlib
import os
import random
import time

import numpy as np

from objsync.llm import suffix_dedup
from objsync.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def brute(rows, size=50):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - size + 1) if doc is not None else ():
            key = data[at:at + size]
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - size + 1) if doc is not None else ():
            if first[data[at:at + size]] < doc:
                gone[at:at + size] = b"\1" * size
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df, size=50):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
                   for r in suffix_dedup.remove_repeats(df, size).collect()), key=repr)


def made(seed, count):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeéß") for _ in range(draw.randint(1, 7)))
    shared = [" ".join(word() for _ in range(draw.randint(8, 40))) for _ in range(5)]
    base = " ".join(word() for _ in range(120))
    rows = []
    for doc in range(count):
        kind = draw.randint(0, 4)
        text = " ".join(word() for _ in range(draw.randint(0, 60)))
        if kind == 1:
            text = text[:draw.randint(0, len(text))] + draw.choice(shared) + text[10:]
        elif kind == 2:
            text = base
        elif kind == 3:
            letters = list(base)
            for _ in range(draw.randint(1, 4)):
                letters[draw.randrange(len(letters))] = draw.choice("xyz")
            text = "".join(letters)[draw.randint(0, 40):]
        elif kind == 4:
            text = draw.choice(["", "a" * draw.randint(40, 400), "ab" * draw.randint(20, 200)])
        rows.append((draw.randrange(count * 2), text))
    return rows


def test_against_brute_force(make):
    rows = made(1, 120) + [(None, "a" * 300), (3, None), (3, None), (7, "q" * 49), (900, "q" * 50), (901, "x" + "q" * 50)]
    rows += [(500, "The same row, twice over, with more than fifty bytes in it.")] * 2 + [(None, None)]
    assert result(make(rows, SCHEMA, clash=True)) == brute(rows)


def test_other_sizes_and_short_stretches(make, monkeypatch):
    rows = made(2, 60)
    for size in (21, 8):
        assert result(make(rows, SCHEMA), size) == brute(rows, size)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 64)
    assert result(make(rows, SCHEMA)) == brute(rows)


def test_spans_are_byte_offsets_of_the_text(make):
    passage = "é passage that is longer than fifty bytes, and known twice; "
    rows = [(1, passage), (2, "before " + passage + "after")]
    cut = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(make(rows, SCHEMA)).collect()}
    assert cut[1]["spans"] == [] and bytes(cut[1]["kept"]).decode() == passage
    assert [tuple(s) for s in cut[2]["spans"]] == [(7, 7 + len(passage.encode()))] and bytes(cut[2]["kept"]) == b"before after"


def test_empty_table_and_very_long_text(make):
    assert result(make([], SCHEMA)) == []
    draw = random.Random(3)
    long = "".join(draw.choice("abcdefgh ") for _ in range(1_300_000))
    got = result(make([(1, long[600_000:600_300]), (2, long)], SCHEMA))
    assert [r[:4] for r in got] == [(1, 300, 0, 0), (2, 1_300_000, 300, 1)]


def test_names_of_places_are_dealt_once_a_text_and_cheaply():
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab ") for _ in range(draw.randint(60, 900))).encode() * draw.randint(1, 3) for _ in range(60)]
    named = suffix_dedup._named([(t, number // 2, number, 0) for number, t in enumerate(texts)], 50)
    rows = suffix_dedup._grams(named)
    pairs = sorted((g, int(named.doc[o])) for g, o in set(zip(named.gram.view(np.int64).tolist(), named.owner.tolist(), strict=True)))
    assert sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)) == pairs and len(pairs) < len(named.gram)
    assert np.array_equal(named.second(), named.contexts()[1])

    def least(work):
        times = []
        for _ in range(7):
            began = time.thread_time()
            work()
            times.append(time.thread_time() - began)
        return min(times)

    held = [(bytes(draw.choices(range(97, 123), k=1 << 16)), 1, 1, 0)]
    named = suffix_dedup._named(held, 50)
    assert least(lambda: suffix_dedup._grams(named)) < least(lambda: suffix_dedup._named(held, 50))


def test_half_names_take_two_pairings_and_tell_strings_apart(monkeypatch):
    draw = random.Random(8)
    texts = [bytes(draw.choices(b"ab", k=400)) for _ in range(12)] + [bytes(300), b"ab" * 150, bytes(draw.choices(range(256), k=500))]
    calls, pair = [], suffix_dedup._pair
    monkeypatch.setattr(suffix_dedup, "_pair", lambda a, b: calls.append(1) or pair(a, b))
    named = suffix_dedup._named([(t, number, number, 0) for number, t in enumerate(texts)], 50)
    assert len(calls) == 2
    data = b"".join(texts)
    names = {}
    for at, name in enumerate(named.half.tolist()):
        names.setdefault(data[at:at + 25], set()).add(name)
    assert len(named.half) == len(data) - 24 and all(len(n) == 1 for n in names.values())
    assert len(set().union(*names.values())) == len(names)


def test_rounds_count_names_and_sort_no_places(make, monkeypatch):
    plans, keep = {}, suffix_dedup.stored

    def noted(df, purpose):
        plans[purpose] = df._jdf.queryExecution().toString()
        return keep(df, purpose)

    monkeypatch.setattr(suffix_dedup, "stored", noted)
    rows = made(9, 40)
    assert result(make(rows, SCHEMA)) == brute(rows)
    assert "count(1)" in plans["grams"] and "min(doc" not in plans["grams"]
    assert "ShuffledHashJoin" in plans["runs"] and "SortMergeJoin" not in plans["runs"] and "BroadcastHashJoin" not in plans["runs"]


def test_a_long_text_repeats_itself_over_stretches_and_keeps_all(make, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 64)
    passage = "a passage of seventy bytes or so that one text holds again and again, "
    rows = [(1, passage * 9), (2, "another text of more than fifty bytes, which nothing else holds."), (3, "so " + passage + "it is")]
    assert result(make(rows, SCHEMA)) == brute(rows)
    assert [r[2] > 0 for r in result(make(rows, SCHEMA))] == [False, False, True]


def watched(monkeypatch):
    """What is stored, by purpose, and the folders that are still there."""
    made, keep = {}, suffix_dedup.stored

    def noted(df, purpose):
        copy = keep(df, purpose)
        made.setdefault(purpose, []).append((copy.count(), copy._stored_in))
        return copy

    monkeypatch.setattr(suffix_dedup, "stored", noted)
    return made


def test_names_that_fill_the_bitmap_are_taken_in_slices(make, monkeypatch):
    made_by = watched(monkeypatch)
    rows = [r for r in made(11, 120) if len(set(r[1])) > 2]
    expected = brute(rows)
    assert result(make(rows, SCHEMA)) == expected
    whole = [count for count, _ in made_by.pop("contexts")]
    monkeypatch.setattr(suffix_dedup, "MEMBERS", 8)
    assert result(make(rows, SCHEMA)) == expected
    # Not one run more is stored than before, and no slice has most of them.
    slices = [count for count, _ in made_by["contexts"]]
    assert len(whole) == 1 and len(slices) == suffix_dedup.SLICES and sum(slices) == sum(whole) and max(slices) < sum(slices) / 2


def test_only_the_lists_of_places_stay_on_disk(make, monkeypatch):
    made_by = watched(monkeypatch)
    rows = made(12, 60)
    assert result(make(rows, SCHEMA)) == brute(rows)
    there = {purpose for purpose, copies in made_by.items() for _, folder in copies if os.path.exists(folder.removeprefix("file:"))}
    assert {"grams", "contexts", "runs"} < set(made_by) and there == {"cuts"}


def test_halves_that_repeat_by_chance_are_not_stored(make, monkeypatch):
    made_by = watched(monkeypatch)
    draw = random.Random(13)
    word = lambda n: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    halves = [word(34) for _ in range(20)]
    rows = [(doc, word(60) + draw.choice(halves) + word(60) + draw.choice(halves) + word(60)) for doc in range(150)]
    assert [r[2] for r in result(make(rows, SCHEMA))] == [0] * 150
    assert made_by["grams"][0][0] >= 20 and made_by["contexts"][0][0] == 0


def test_runs_of_a_name_that_many_have_are_spread_over_partitions(make, monkeypatch):
    draw = random.Random(14)
    word = lambda n: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    line = word(70)
    rows = [(draw.randrange(400), word(80) + line[draw.randint(0, 8):] + word(80)) for _ in range(200)] + made(14, 60)
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    assert result(make(rows, SCHEMA)) == brute(rows)

    texts = [(t.encode(), doc, doc, 0) for doc, t in rows[:200]]
    named = suffix_dedup._named(texts, 50)
    names, counts = np.unique(named.gram, return_counts=True)
    hot = np.unique(suffix_dedup._mixed(names[counts > 20]))
    every = suffix_dedup.Sieve(np.full(1 << 10, 2**64 - 1, dtype=np.uint64))
    parts = {name: [len(b) // suffix_dedup.RUN.itemsize for b in suffix_dedup._deal_runs(suffix_dedup._contexts(named, every, 1, 0), own, 20).column(1).to_pylist()]
             for name, own in (("by name", hot[:0]), ("spread", hot))}
    assert sum(parts["by name"]) == sum(parts["spread"]) == len(named.gram)
    assert max(parts["spread"]) < 1.5 * len(named.gram) / 20 < max(parts["by name"])


def test_query(llm):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op11_prefix_doubling"](llm, sf).collect()), key=repr) == brute(rows)
