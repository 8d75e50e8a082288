import random
import re

import pytest

from objsync.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return [m.group() for m in WORD.finditer(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]


def brute(docs, items, size):
    out = []
    for doc, text in docs:
        own, hit, ids = words(text), set(), set()
        for item, other in items:
            listed = words(other)
            n = min(size, len(listed))
            windows = {tuple(listed[i:i + n]) for i in range(len(listed) - n + 1)} if n and item is not None else set()
            for i in range(len(own) - n + 1):
                if tuple(own[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids.add(item)
        out.append((doc, len(own), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def fixture():
    draw = random.Random(4)
    vocabulary = ["alpha", "Beta", "é", "x9", "it's", "ÄB", "ab"]
    text = lambda n: draw.choice([" ", "-", "\n"]).join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(draw.randint(1, 14))) for i in range(12)] + [(20, None), (21, "..."), (None, text(6)), (3, text(9)), (30, text(40))]
    docs = [(i, f"{text(30)} {draw.choice(items)[1]} {text(5)}") for i in range(40)]
    docs += [(50, None), (51, ""), (52, "!?"), (53, "pad " * 20_000 + str(items[-1][1])), (1, docs[1][1]), (None, docs[2][1])]
    return docs, items


@pytest.mark.parametrize("max_windows", [1_000_000, 20])
def test_matches_brute_force(make, max_windows):
    docs, items = fixture()
    found = decontaminate.find_passages(make(docs, DOCS, clash=True), make(items, ITEMS, clash=True), 6, max_windows)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in found.collect()), key=repr)
    assert got == brute(docs, items, 6)
    assert sum(r[2] > 0 for r in got) > 5


def test_spans_lead_back_to_the_text(make):
    docs, items = fixture()
    for r in decontaminate.find_passages(make(docs, DOCS), make(items, ITEMS), 6).collect():
        taken = [w for s in r["spans"] for w in words(r["text"][s["start"]:s["end"]])]
        assert len(taken) == r["n_hit"] == len(r["hit_words"])
        assert taken == [words(r["text"])[i] for i in r["hit_words"]]


def test_empty_tables(make):
    docs, items = fixture()
    assert decontaminate.find_passages(make([], DOCS), make(items, ITEMS)).count() == 0
    assert {r["n_hit"] for r in decontaminate.find_passages(make(docs, DOCS), make([], ITEMS)).collect()} == {0}
