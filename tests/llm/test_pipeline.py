"""The pipeline's stages against brute force, on rows planted for each."""

import random

import pytest

import corpus_pipeline as cp
from tests.llm.test_decontaminate import words
from tests.llm.test_jaccard import brute as near_groups
from tests.llm.test_packing import check
from tests.llm.test_secret_scan import brute as base_spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    draw = random.Random(6)
    stems = {"en": ["the", "thing", "over", "ring", "with"], "de": ["der", "schaft", "über", "keit", "und"]}
    text = lambda lang, n: " ".join("".join(draw.choice(stems[lang]) for _ in range(draw.randint(1, 3))) for _ in range(n))
    items = [(i, text("en", 14)) for i in range(5)]
    rows = [(i, text("en" if i % 2 else "de", 60), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100 + i, rows[i][1].replace(" ", "  ", 3) + " ende", "de") for i in range(0, 10, 2)]
    rows += [(120, rows[1][1], "en"), (121, f"{text('en', 30)} {items[2][1]} {text('en', 30)}", "en"), (122, f"{text('en', 40)} token = abcdefgh12345 {text('en', 9)}", "en")]
    rows += [(130, None, "en"), (131, "", None), (132, "12345 !", "de"), (133, "x", None), (1, rows[1][1], "en"), (None, text("de", 30), "de"), (140, text("en", 9000), "en")]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def ids(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect() if r["doc_id"] is not None)


def test_stages_one_by_one(spark, tables):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}

    kept = cp.identify_language(spark, docs, folder)
    assert kept.schema.names == docs.schema.names
    gone = set(before) - {i for i, _ in ids(kept)} - {None}
    assert {130, 131, 132} <= gone <= {130, 131, 132, 133}

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    alone = cp.drop_near_copies(spark, kept, folder)
    assert alone.schema.names == docs.schema.names
    want = sorted({i for i, _, root in near_groups(rows, cp.NEAR) if i is not None and i == root})
    assert [i for i, _ in ids(alone)] == want and not {100, 102, 120} & set(want)

    clean = cp.drop_benchmark_passages(spark, alone, folder)
    windows = {tuple(words(t)[i:i + 10]) for _, t in items for i in range(5)}
    hit = {i for i, t in ids(alone) if any(tuple(words(t)[k:k + 10]) in windows for k in range(len(words(t))))}
    assert hit == {121} and {i for i, _ in ids(clean)} == set(want) - hit

    safe = cp.redact_secrets(spark, clean, folder)
    assert safe.schema == clean.schema
    for i, text in ids(safe):
        spans = base_spans(before[i])
        assert (text == before[i]) == (not spans) and not base_spans(text)
    assert all(r["n_chars"] == len(r["text"]) for r in safe.collect())

    final = [(r["doc_id"], r["text"]) for r in safe.collect()]
    check(final, cp.pack_sequences(spark, safe, folder).collect(), 4096)


def test_run_is_all_stages(spark, tables):
    folder, _ = tables
    got = cp.run(spark, folder)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() > 50 and 4 <= len(cp.STAGES) <= 5


def test_empty_documents(spark, tables, tmp_path):
    folder, _ = tables
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("langs", [("en", "de"), ("en", "de", "fr", "es")])
def test_texts_of_no_known_language_go_at_any_length(spark, langs):
    draw = random.Random(8)
    stems = {"en": ["the", "thing", "over", "ring", "with"], "de": ["der", "schaft", "über", "keit", "und"],
             "fr": ["les", "tion", "été", "eau", "dans"], "es": ["los", "ción", "ñaja", "ando", "con"]}
    words = lambda parts, n, m: " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, m))) for _ in range(n))
    sizes = [1, 5, 40, 400, 4000, 20_000]
    rows = [(i, words(stems[langs[i % len(langs)]], 60, 3), langs[i % len(langs)], "s", 0) for i in range(80)]
    rows += [(100 + i, words("абвгдежзийклмн", n, 8), None, "s", 0) for i, n in enumerate(sizes)]
    rows += [(110, "ж", None, "s", 0), (111, "жд", None, "s", 0)]
    rows += [(200 + i, words(stems["en"], n, 3), None, "s", 0) for i, n in enumerate(sizes)]
    kept = {r["doc_id"] for r in cp.identify_language(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert kept == {*range(80), *range(200, 200 + len(sizes))}


def test_near_copies_are_decided_by_row(spark):
    draw = random.Random(9)
    text = lambda: " ".join(f"w{draw.randrange(10_000)}" for _ in range(40))
    a, b, c, d, e, f, g = (text() for _ in range(7))
    near = lambda t: t + " end"
    rows = [
        (None, a), (None, near(a)), (None, a),  # no id at all: one stays
        (5, b), (None, near(b)), (None, b),  # an id comes before none
        (7, c), (7, d),  # one id, two texts: both stay
        (1, e), (9, near(e)), (9, f),  # one row of an id goes, the other stays
        (11, g), (11, g), (11, near(g)),  # rows alike and a near copy under one id: one stays
        (13, ""), (13, ""), (None, None), (None, None),  # without words: linked with nothing
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["text"]) for r in cp.drop_near_copies(spark, docs, "").collect()), key=repr)
    none = [r for r in got if r[0] is None and r[1]]
    eleven = [r for r in got if r[0] == 11]
    assert len(none) == 1 and none[0][1] in (a, near(a))
    assert len(eleven) == 1 and eleven[0][1] in (g, near(g))
    rest = [r for r in got if r not in none + eleven]
    assert rest == sorted([(5, b), (7, c), (7, d), (1, e), (9, f), (13, ""), (13, ""), (None, None), (None, None)], key=repr)
