import pytest
from pyspark.sql import functions as F

from objsync.functions.text import object_id
from objsync.operators.mapping import exclude_value
from objsync.operators.results import csv_texts, write_csv
from objsync.sources import files
from tests.conftest import rows


def put(folder, text, name="data.csv"):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(text)
    return path


def test_keys_keep_leading_zeros(spark, folder):
    path = put(folder, "Id,Zip,Born\n001,06000,1000-01-01\n")
    df = files.checked_csv(spark, path)
    assert rows(df) == [("001", "06000", "1000-01-01")]
    assert df.select(F.col("Born").cast("date")).first()[0].year == 1000


def test_quotes_commas_line_breaks_and_no_final_newline(spark, folder):
    path = put(folder, 'Id,Text\n1,"a ""b"", c\nd"\n2,"R&D"')
    assert rows(files.read_csv(spark, path)) == [("1", 'a "b", c\nd'), ("2", "R&D")]


def test_private_use_characters_are_cells_like_others(spark, folder):
    path = put(folder, 'Id,Text\n1,\ue000\n2,""\n3,\n')
    assert rows(files.read_csv(spark, path, quoted_blank=True)) == [("1", "\ue000"), ("2", ""), ("3", None)]
    lines = spark.createDataFrame([("1,\ue000",)], "line string")
    assert lines.select(files.csv_fields(F.col("line"), "a string, b string").alias("c")).select("c.b").first()[0] == "\ue000"


def test_missing_cells_are_null(spark, folder):
    path = put(folder, "Id,Name,Email\n1,,x\n2,B,\n")
    assert rows(files.read_csv(spark, path)) == [("1", None, "x"), ("2", "B", None)]


def test_ragged_rows_are_kept_as_evidence(spark, folder):
    path = put(folder, "Id,Name\n1,A\n2,B,extra\n")
    df = files.read_csv(spark, path, corrupt=files.CORRUPT)
    assert rows(df.select("Id", files.CORRUPT)) == [("1", None), ("2", "2,B,extra")]


def test_glob_of_files(spark, folder):
    put(folder, "Id\n1\n", "a.csv")
    put(folder, "Id\n2\n", "b.csv")
    assert rows(files.checked_csv(spark, f"{folder}/*.csv")) == [("1",), ("2",)]


@pytest.mark.parametrize("text, error", [("", ValueError), ("Id,Name\n", ValueError), (None, FileNotFoundError)])
def test_checked_read_refuses(spark, folder, text, error):
    path = f"{folder}/none.csv" if text is None else put(folder, text)
    with pytest.raises(error):
        files.checked_csv(spark, path)


def test_checked_read_needs_a_path(spark):
    with pytest.raises(ValueError, match="No CSV path"):
        files.checked_csv(spark, None)


def test_chunk_texts(spark):
    texts = [("Id,Name\n001,A\n002,\"B, \"\"x\"\"\ny\"\n",), ("Name,Extra,Id\nC,zz,003\n",), ("Id\n004\n",), ("Id,Name\n",), ("",), (None,)]
    df = files.normalize_chunks(spark.createDataFrame(texts, "body string"), "body", ["Id", "Name"])
    assert rows(df) == [("001", "A"), ("002", 'B, "x"\ny'), ("003", "C"), ("004", None)]


def test_csv_line_and_back(spark):
    data = [(1, 'say "hi", you', None), (2, "two\nlines", "ünï"), (3, "a\\b", "x")]
    df = spark.createDataFrame(data, "n int, a string, b string")
    lines = df.select(files.csv_line(df.columns).alias("line"))
    back = lines.select(files.csv_fields(F.col("line"), "n int, a string, b string").alias("r")).select("r.*")
    assert rows(back) == sorted(data, key=repr)


def test_batches_as_texts_and_back(spark):
    data = [(n, None if n % 2 else f'v "{n}",\nx', n * 0.5) for n in range(25)]
    df = spark.createDataFrame(data, "n int, s string, d double").coalesce(1)
    texts = csv_texts(df, 10)
    assert texts.count() == 3 and all(r.body.startswith("n,s,d\n") for r in texts.collect())
    back = files.normalize_chunks(texts, "body", ["n", "s", "d"])
    assert rows(back) == sorted(((str(n), s, str(d)) for n, s, d in data), key=repr)


def test_written_csv_batches(spark, folder):
    df = spark.range(25).coalesce(1).select("id", F.struct(F.lit("x").alias("a")).alias("s"))
    path = write_csv(df, f"{folder}/out", batch_rows=10)
    back = files.read_csv(spark, path)
    assert back.columns == ["id", "s__a"] and back.count() == 25
    assert sorted(r.n for r in files.file_chunks(back).collect()) == [5, 10, 10]


def test_written_columns_follow_the_target(spark, folder):
    df = spark.createDataFrame([(1, "a", 9)], "Id int, Name string, Extra int")
    path = write_csv(df, f"{folder}/out", columns=["Name", "Id"])
    assert files.read_csv(spark, path).columns == ["Name", "Id"]


def test_json_source(spark, folder):
    put(folder, '{"siren": "1", "nature": "1000"}\n{"siren": "2", "seat": {"town": "Lyon"}}\n', "r.json")
    df = files.read_json(spark, folder, "siren string, nature string, seat struct<town: string>")
    assert rows(exclude_value(df, "nature", "1000").select("siren", "seat.town")) == [("2", "Lyon")]


def test_ragged_rows_fail_by_default(spark, folder):
    for number, text in enumerate(("Id,Name\n1,A\n2,B,extra\n", "Id,Name\n3\n")):
        path = put(folder, text, f"{number}.csv")
        with pytest.raises(Exception, match="(?i)malformed"):
            files.read_csv(spark, path).select("Id").collect()


@pytest.mark.parametrize("corrupt", [None, files.CORRUPT])
def test_a_file_with_columns_in_another_order_is_refused(spark, folder, corrupt):
    put(folder, "Id,Name\n1,A\n", "a.csv")
    put(folder, "Name,Id\nB,2\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, f"{folder}/*.csv", ["Id", "Name"], corrupt).collect()


def test_chunk_cells_of_any_length_and_ragged_chunks(spark):
    long = "x" * 1_000_000
    df = spark.createDataFrame([(f"Id,Name\n1,{long}\n2\n",), ("Id,Name\n3,,\n",)], "body string")
    first = df.filter("length(body) > 100")
    assert rows(files.normalize_chunks(first, "body", ["Id", "Name"])) == [("1", long), ("2", None)]
    with pytest.raises(Exception, match="Expected 2 columns, got 3"):
        files.normalize_chunks(df, "body", ["Id", "Name"]).collect()
    kept = files.normalize_chunks(df, "body", ["Id"], corrupt=files.CORRUPT)
    assert rows(kept) == [("1", None), ("2", None), (None, "3,,")]


def test_white_space_and_blanks_survive(spark, folder):
    data = [(" k ", "\ny\n", ""), ("\t", None, "  x "), ("", "a", None)]
    df = spark.createDataFrame(data, "k string, t string, e string")
    path = write_csv(df, f"{folder}/out")
    assert rows(files.read_csv(spark, path, quoted_blank=True)) == sorted(data, key=repr)
    back = files.normalize_chunks(csv_texts(df), "body", df.columns, quoted_blank=True)
    assert rows(back) == sorted(data, key=repr)
    lines = df.select(files.csv_line(df.columns).alias("line"))
    assert rows(lines.select(files.csv_fields(F.col("line"), "k string, t string, e string").alias("r")).select("r.*")) == sorted(data, key=repr)


def test_ids_beyond_the_width_stay_apart(spark):
    df = spark.createDataFrame([(7,), (1234567890123,), (1234567890124,)], "n long")
    assert rows(df.select(object_id(F.col("n")))) == [("001000000000007",), ("0011234567890123",), ("0011234567890124",)]
