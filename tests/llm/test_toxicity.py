from pyspark.sql import functions as F

from objsync.llm import queries, toxicity

SCHEMA = "doc_id long, text string, toxic int"
MILD = ["the cat sat here", "a fine day it is", "we went to the market", "bread and butter"]


def rows():
    return [(i, f"{MILD[i % 4]} {MILD[i % 3]}" + (" you horrible moron" if i % 2 else ""), i % 2) for i in range(60)]


def test_learns_the_words_and_scores_odd_rows(make):
    docs = [*rows(), (100, None, None), (101, "", 7), (102, "calm " * 20_000 + "horrible moron", None), (103, "A HORRIBLE\n MORON", None),
            (103, "A HORRIBLE\n MORON", None), (104, f"{MILD[3]} {MILD[0]} {MILD[1]}", None)]
    df = make(docs, SCHEMA, clash=True)
    model = toxicity.train(df)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.predict(df, model).collect()}
    assert all(got[i][1] == i % 2 for i in range(60))
    assert got[102][1] == got[103][1] == 1 and got[104][1] == 0
    assert got[100] == got[101] and all(0 <= s <= 1 and p == (s >= 0.5) for s, p in got.values())
    assert toxicity.predict(df, model).count() == len(docs)


def test_nothing_to_learn_from(make):
    df = make(rows(), SCHEMA)
    assert toxicity.train(df.filter("toxic = 0")) is None
    assert {r["score"] for r in toxicity.predict(df, None).collect()} == {0.0}
    assert toxicity.predict(df.filter("false"), toxicity.train(df)).count() == 0


def test_blocks_do_not_change_margins(monkeypatch):
    import numpy as np

    settings = toxicity.Settings(bits=10)
    texts = ["abc def ghij"] * 3 + [None, "", "xyz" * 500]
    weights = np.arange(1 << 10, dtype=np.float32) % 7
    whole = toxicity._margins(texts, weights, 0.5, settings)
    monkeypatch.setattr(toxicity, "BLOCK", 10)
    assert np.allclose(whole, toxicity._margins(texts, weights, 0.5, settings))
    assert whole[0] == whole[1] and whole[3] == whole[4] == 0.5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op7_log_ratio_toxicity"](spark, sf).filter("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    both = got.join(labels, "doc_id")
    right, total, caught, toxic = both.agg(F.sum(F.expr("int(predicted = toxic)")), F.count("*"),
                                           F.sum(F.expr("int(predicted = 1 and toxic = 1)")), F.sum("toxic")).head()
    assert right / total > 0.97 and caught / toxic > 0.85


def sampled(monkeypatch, df, settings):
    """The texts and labels that the fit is given."""
    import pickle

    import numpy as np

    def seen(texts, labels, _):
        return np.frombuffer(pickle.dumps(list(zip(texts, labels.tolist(), strict=True))).ljust(1 << 20, b"\0"), dtype=np.uint8), 0.0

    monkeypatch.setattr(toxicity, "_fit", seen)
    weights, _ = toxicity.train(df, settings)
    return pickle.loads(weights.astype(np.uint8).tobytes())


def test_copies_hold_one_place_of_the_sample(make, monkeypatch):
    # Every text many times over: by rows, the copies of one text would fill all places.
    df = make([r for r in [(i, f"text number {i}", i % 2) for i in range(40)] for _ in range(50)], SCHEMA)
    got = sampled(monkeypatch, df, toxicity.Settings(rows=15))
    assert len(got) == len(set(got)) == 30 and sum(label for _, label in got) == 15


def test_sampled_texts_are_whole(make, monkeypatch):
    rows = [(i, f"{i} " + "calm " * 2000 + ("moron" if i % 2 else "fine"), i % 2) for i in range(8)]
    settings = toxicity.Settings(rows=4, chars=6000)
    got = sampled(monkeypatch, make(rows, SCHEMA), settings)
    # Two texts of 10,000 characters fit in 4 * 6,000 for each class, and none is cut.
    assert len(got) == 4 and {text.endswith("moron") == bool(label) for text, label in got} == {True}
    assert set(got) <= {(text, label) for _, text, label in rows}
    assert len(sampled(monkeypatch, make(rows, SCHEMA), toxicity.Settings(rows=4, chars=10))) == 2


def test_a_nul_character_is_a_blank(make):
    odd = [(i, t.replace(" ", "\0", 1), k) for i, t, k in rows()]
    model, plain = (toxicity.train(make(data, SCHEMA)) for data in (odd, rows()))
    assert model is not None
    df = make([(0, "you\0horrible\0\0moron", None), (1, "you horrible moron", None), (2, "\0", None), (3, "", None)], SCHEMA)
    got = {r["doc_id"]: r["score"] for r in toxicity.predict(df, plain).collect()}
    assert got[0] == got[1] and got[2] == got[3]
