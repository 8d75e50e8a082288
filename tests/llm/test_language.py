import numpy as np
from pyspark.sql import functions as F

from objsync.llm import language, queries

SCHEMA = "doc_id long, text string, lang string"
TEXTS = {"a": "the cat sat on the mat and the hat ", "b": "der hund und die katze sind im haus ", "c": "el perro y la gata en la casa "}


def rows():
    return [(i, TEXTS[lang] * 3, lang) for i, lang in enumerate("abcabc")]


def brute_phrases(text, model):
    at = count = 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at:at + size] in model:
            size += 1
        at, count = at + max(1, size - 1), count + 1
    return count


def test_phrases_are_longest_matches():
    models = list(TEXTS.values())
    table, width = language._symbols(models)
    code = lambda t: language._reduced(table[np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)])
    automata = [language._automaton(code(m).tolist(), width) for m in models]
    texts = ["The cat und der hund", "zzz qqq", "la la la katze!!", "мир the", "a" * 50, "x"]
    counts, symbols, lettered = language._parsed(texts, table, automata)
    as_text = lambda t: "".join(chr(c + 65) for c in code(t))
    assert counts.tolist() == [[brute_phrases(as_text(t), as_text(m)) for m in models] for t in texts]
    assert lettered.all() and symbols.tolist() == [len(code(t)) for t in texts]


def test_long_texts_are_parsed_whole(monkeypatch):
    draw = np.random.default_rng(3)
    models = ["abcabbaacc", "b" * 9 + "a", "cab"]
    table, width = language._symbols(models)
    automata = [language._automaton([table[ord(c)] for c in m], width) for m in models]
    texts = ["abc" * 40 + "zz", "b" * 200, "x", "", *("".join(draw.choice(list("aabbbcz"), n)) for n in range(1, 300, 7))]
    monkeypatch.setattr(language, "STRETCH", 8)
    counts, _, _ = language._parsed(texts, table, automata)
    assert counts.tolist() == [[brute_phrases(t, m) for m in models] for t in texts]


def test_predictions_and_odd_rows(make):
    docs = [*rows(), (10, None, "a"), (11, "", None), (12, "12 34 ... !", "b"), (13, "the cat and the mat", None), (13, "the cat and the mat", None)]
    df = make(docs, SCHEMA, clash=True)
    models = language.train(df.filter("doc_id < 6"))
    assert [m[0] for m in models] == ["a", "b", "c"]
    got = {(r["doc_id"]): (r["lang_pred"], r["score"]) for r in language.predict(df, models).collect()}
    assert [got[i][0] for i in range(6)] == list("abcabc") and got[13][0] == "a"
    assert [got[i] for i in (10, 11, 12)] == [("und", 0.0)] * 3
    assert all(0 <= s <= 1 for _, s in got.values())
    assert language.predict(df, models).filter("doc_id = 13").count() == 2


def test_nothing_to_learn_from(make):
    df = make(rows(), SCHEMA)
    assert language.train(df.filter("false")) == []
    assert {r["lang_pred"] for r in language.predict(df, []).collect()} == {"und"}
    assert language.predict(df.filter("false"), language.train(df)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op3_cross_parsing_language"](spark, sf).filter("held_out")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    right, total = got.join(docs, "doc_id").agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).head()
    assert total > 200 and right / total > 0.98


def test_training_takes_distinct_whole_texts(make):
    texts = [f"word{k} " + "abc def " * (k % 7) * 40 for k in range(30)]
    df = make([(k % 30, texts[k % 30], "a") for k in range(3000)], SCHEMA, clash=True)
    sample = [r["text"] for r in language.training_sample(df, 160, 1000).collect()]
    assert sorted(sample) == sorted(texts)
    few = [r["text"] for r in language.training_sample(df, 160, 10).collect()]
    assert few and set(few) <= set(texts) and (len(few) == 1 or sum(map(len, few)) <= 1600)
