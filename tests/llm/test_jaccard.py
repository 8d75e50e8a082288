import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from objsync.llm import graph, jaccard

SCHEMA = "doc_id long, text string"


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(rows, measure):
    sets = [shingles(text, measure.words) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and measure.below * both >= measure.above * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)].append(doc)
    return sorted(((doc, len(sets[i]), min(ids[find(i)], default=None)) for i, (doc, _) in enumerate(rows)), key=repr)


def corpus(seed, docs=90):
    """Families of edited copies, shared passages, short texts and repeats."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(400)}"
    passage = [word() for _ in range(40)]
    bases = [[word() for _ in range(draw.choice([6, 30, 120]))] for _ in range(8)]
    rows = []
    for i in range(docs):
        text = list(draw.choice(bases))
        for _ in range(draw.choice([0, 1, 1, 2, 3, 6])):
            text[draw.randrange(len(text))] = word()
        if draw.random() < 0.3:
            text += passage[: draw.choice([40, 20])]
        rows.append((i, draw.choice([" ", "\t", " \n "]).join(text).title() if draw.random() < 0.2 else " ".join(text)))
    rows += [(200 + i, " ".join(["word"] * n)) for i, n in enumerate([1, 2, 3, 4, 5, 9])] + [(210, "Word word"), (211, "word")]
    return rows + [(300, None), (301, ""), (302, " \n"), (5, rows[5][1]), (None, rows[6][1]), (None, "only null ids have this text")]


@pytest.mark.parametrize(("seed", "measure", "limit"), [
    (1, jaccard.Measure(), 20), (2, jaccard.Measure(), 2), (3, jaccard.Measure(5, 80, 100), 3), (4, jaccard.Measure(2, 60, 100), 1)])
def test_matches_brute_force(make, monkeypatch, seed, measure, limit):
    monkeypatch.setattr(jaccard, "FREQUENT", limit)
    rows = corpus(seed)
    got = sorted((tuple(r) for r in jaccard.link_documents(make(rows, SCHEMA, clash=True), measure).collect()), key=repr)
    assert got == brute(rows, measure)
    assert len({r[2] for r in got}) < len(got) - 10


def test_one_large_group_of_near_copies(make):
    draw = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):
        text = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 2, 3, 5, 9])):
            text[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    got = sorted((tuple(r) for r in jaccard.link_documents(make(rows, SCHEMA)).collect()), key=repr)
    assert got == brute(rows, jaccard.Measure())
    assert len({r[2] for r in got}) < 300


def test_empty_and_very_long(make):
    assert jaccard.link_documents(make([], SCHEMA)).count() == 0
    long = " ".join(f"t{i % 9000}" for i in range(200_000))
    rows = [(1, long), (2, long + " more words at the end"), (3, None)]
    got = sorted(tuple(r) for r in jaccard.link_documents(make(rows, SCHEMA)).collect())
    assert [(r[0], r[2]) for r in got] == [(1, 1), (2, 1), (3, 3)] and got[0][1] == len(shingles(long, 4))


@pytest.mark.parametrize("measure", [jaccard.Measure(), jaccard.Measure(5, 80, 100)])
def test_similar_sets_share_a_signature(measure):
    draw = np.random.default_rng(0)
    for n in [1, 2, 3, 5, 8, 13, 20, 47, 64, 65, 130, 700]:
        for _ in range(60):
            x = draw.choice(10 * n + 10, n, replace=False).astype(np.uint64)
            y = x.copy()
            swaps = draw.integers(0, n // 6 + 1)
            y[draw.choice(n, swaps, replace=False)] = np.arange(20_000, 20_000 + swaps)
            y = y[draw.integers(0, max(1, n // 10)):] if draw.random() < 0.5 else y
            x, y = np.unique(jaccard.hash_mix(x)), np.unique(jaccard.hash_mix(y))
            both = len(np.intersect1d(x, y))
            if measure.below * both < measure.above * (len(x) + len(y) - both):
                continue
            share = draw.random()
            often = lambda t: (jaccard.hash_mix(t + np.uint64(1)) % np.uint64(1000)) < np.uint64(1000 * share)  # noqa: E731, B023
            a, _ = jaccard.signatures(x, often(x), measure)
            b, _ = jaccard.signatures(y, often(y), measure)
            assert set(a.tolist()) & set(b.tolist())


def test_components_match_union_find(make):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 450)] + [(7, 7), (500, 501)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(tuple(r) for r in graph.components(make(edges, "a long, b long")).collect())
    assert all(got.get(x, x) == find(x) for x in root)
    assert graph.components(make([], "a long, b long")).count() == 0
