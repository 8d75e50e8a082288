import random

import pytest
from pyspark.sql import functions as F

from objsync.operators.results import write_csv
from objsync.sources.files import read_csv
from objsync.sources.split_csv import _marked, split_csv
from tests.conftest import rows
from tests.test_files import put

SCHEMA = "id string, body string, note string"


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name in names:
        spark.conf.set(name, "2000")
    yield spark
    for name in names:
        spark.conf.unset(name)


def odd_rows(n, seed=3):
    draw = random.Random(seed)
    cell = lambda: draw.choice([
        None, "", "plain", "a,b", 'say "x"', "two\nlines", "\n", '"\n"', "\r\nend\r", "é😀\n" * 3, "x\n" * draw.randrange(40), ""])
    return [(str(k), cell(), cell()) for k in range(n)]


def test_one_file_is_read_by_many_tasks_and_equals_the_whole_read(small_ranges, folder):
    spark = small_ranges
    df = spark.createDataFrame(odd_rows(800), SCHEMA)
    path = write_csv(df.coalesce(1), f"{folder}/csv")
    got = split_csv(spark, path, quoted_blank=True)
    assert _marked(spark, path).select("block").distinct().count() > 10
    assert got.columns == ["id", "body", "note"]
    assert rows(got) == rows(df) == rows(read_csv(spark, path, quoted_blank=True))
    assert rows(split_csv(spark, path)) == rows(read_csv(spark, path))


def test_a_record_longer_than_many_ranges(small_ranges, folder):
    spark = small_ranges
    long = "line, \"quoted\"\n" * 2000
    data = [("1", long, "a"), ("2", None, "b"), ("3", long, None)]
    path = write_csv(spark.createDataFrame(data, SCHEMA).coalesce(1), f"{folder}/csv")
    assert rows(split_csv(spark, path)) == data


@pytest.mark.parametrize("seed", range(4))
def test_several_files_with_headers_of_their_own(small_ranges, folder, seed):
    spark = small_ranges
    df = spark.createDataFrame(odd_rows(300, seed), SCHEMA).repartition(3)
    path = write_csv(df, f"{folder}/csv")
    assert rows(split_csv(spark, f"{path}/*.csv", quoted_blank=True)) == rows(df)


def test_header_line_ends_and_blank_lines(spark, folder):
    path = put(folder, '﻿Id,"A\nb"\r\n001,"x\r\ny"\r\n\r\n2,\r\n3,"z"')
    assert rows(split_csv(spark, path, ["Id", "A\nb"])) == [("001", "x\r\ny"), ("2", None), ("3", "z")]


def test_files_without_records(spark, folder):
    assert rows(split_csv(spark, put(folder, "Id,Name\n"))) == []
    assert rows(split_csv(spark, put(folder, "", "empty.csv"), ["Id"])) == []


@pytest.mark.parametrize("text, message", [
    ('Id,Name\n1,"A\n', "not closed"), ("Id,Name\n1,A,B\n", "Malformed"), ("Id,Name\n1\n", "Malformed"), ("Name,Id\n1,A\n", "header")])
def test_broken_files_fail(spark, folder, text, message):
    with pytest.raises(Exception, match=message):
        split_csv(spark, put(folder, text), ["Id", "Name"]).collect()


def test_filters_do_not_reach_unfinished_lines(small_ranges, folder):
    path = write_csv(small_ranges.createDataFrame(odd_rows(200), SCHEMA).coalesce(1), f"{folder}/csv")
    df = split_csv(small_ranges, path)
    assert df.filter(F.col("id") == "7").count() == 1 and df.select("body").count() == 200
