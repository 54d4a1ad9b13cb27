import pytest
from pyspark.sql import functions as F

from tabml.functions import vectors
from tabml.functions.values import format_number, is_missing_text, text_to_number
from tabml.sources.delimited import detect_delimiter, read_table, unique_headers

NUMBERS = {
    "$1,200": 1200.0, "50%": 50.0, " 3.5 ": 3.5, ".5": 0.5, "5.": 5.0, "1e-3": 0.001, "+7": 7.0, "-2E2": -200.0,
    "0x1F": 31.0, "0b101": 5.0, "0o17": 15.0, "1,2,3": 123.0,
    "1d": None, "2f": None, "NaN": None, "Infinity": None, "-inf": None, "1e999": None, "0xZZ": None, "0x": None, "--1": None,
    "1_000": None, "-": None, ".": None, "": None, "n/a": None, "$": None, "1 2": None,
}


def test_numbers(spark):
    df = spark.createDataFrame([(k,) for k in NUMBERS], "v string")
    got = {r["v"]: r["n"] for r in df.select("v", text_to_number(F.col("v")).alias("n")).collect()}
    assert got == NUMBERS


def test_missing_tokens(spark):
    missing = ["", "  ", "NA", " n/a ", "Null", "NONE", "undefined", "?", " ?﻿", "\tna\n", None]
    present = ["nan", "0", "-", "missing", "n a"]
    df = spark.createDataFrame([(v,) for v in missing + present], "v string")
    got = [r[0] for r in df.select(is_missing_text(F.col("v"))).collect()]
    assert got == [True] * len(missing) + [False] * len(present)


@pytest.mark.parametrize("value,text", [(100.0, "100"), (155.0749, "155.07"), (1234567.5, "1234567.5"), (99.9996, "100"), (0.5, "0.5"), (-3.14159, "-3.142"), (None, "-"), (float("nan"), "-")])
def test_number_format(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(format_number(F.col("v"))).first()[0] == text


def test_headers():
    assert unique_headers(["a", "", "a", "A", " b ", None, "a_2"]) == ["a", "column_2", "a_2", "A_3", "b", "column_6", "a_2_2"]


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("line,expected", [("a,b;c", ","), ("a;b;c,d", ";"), ("a\tb", "\t"), ("a|b|c", "|"), ("alone", ",")])
def test_delimiter(spark, tmp_path, line, expected):
    assert detect_delimiter(spark, write(tmp_path / "t.csv", f"\n   \n{line}\n1\n")) == expected


@pytest.mark.parametrize("multiline", [True, False])
def test_ragged_rows(spark, tmp_path, multiline):
    path = write(tmp_path / "t.csv", '﻿x, y ,x\r\n1, "two, ""2""" ,3\r\n , ,\r\n4\r\n5,6,7,8\r\n')
    df = read_table(spark, path, multiline=multiline)
    assert df.columns == ["x", "y", "x_2"]
    assert [tuple(r) for r in df.collect()] == [("1", 'two, "2"', "3"), ("4", "", ""), ("5", "6", "7")]


def test_blank_records_before_header_and_quoted_breaks(spark, tmp_path):
    path = write(tmp_path / "t.csv", ';\n\na;"b.c";c\n1;"x\ny";3\na;b.c;c\n')
    df = read_table(spark, path, sep=";")
    assert df.columns == ["a", "b.c", "c"]
    assert [tuple(r) for r in df.collect()] == [("1", "x\ny", "3"), ("a", "b.c", "c")]


@pytest.mark.parametrize("text", ["", "a,b\n", "\n , \n"])
def test_too_short(spark, tmp_path, text):
    with pytest.raises(ValueError):
        read_table(spark, write(tmp_path / "t.csv", text))


def test_wide_and_narrow_vectors_agree(spark):
    df = spark.range(3).select(F.array(*[(F.col("id") * 0.1 + j).cast("double") for j in range(40)]).alias("features"))
    weights = [0.01 * j for j in range(40)]
    row = df.select(vectors.dot(F.col("features"), weights).alias("wide")).collect()
    short = df.select(vectors.dot(F.slice("features", 1, 20), weights[:20]) + vectors.dot(F.slice("features", 21, 20), weights[20:]))
    assert [r[0] for r in row] == pytest.approx([r[0] for r in short.collect()])


def test_softmax_and_argmax(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 999.0],), ([-5.0, 2.0, 2.0],)], "s array<double>")
    rows = df.select(vectors.softmax(F.col("s")).alias("p"), vectors.argmax(F.col("s")).alias("c")).collect()
    assert [r["c"] for r in rows] == [0.0, 1.0]
    assert all(abs(sum(r["p"]) - 1) < 1e-12 for r in rows)


def test_folder_keeps_first_records_that_are_data(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n a ;b\n1;2\n")
    (tmp_path / "b.csv").write_text("\n\na;b\n3;4\na;b\n")
    (tmp_path / "c.csv").write_text("5;6\n7\n")
    for multiline in (True, False):
        found = read_table(spark, str(tmp_path), multiline=multiline)
        assert found.columns == ["a", "b"]
        assert sorted(map(tuple, found.collect())) == [("1", "2"), ("3", "4"), ("5", "6"), ("7", ""), ("a", "b")]


def test_messy_records(spark, tmp_path):
    (tmp_path / "m.csv").write_text('\n,,\nid,"a ""b""",,id\n1,"x, y\nz", 2 ,"q"\n\n2,only\n3,a,b,c,extra\n')
    found = read_table(spark, str(tmp_path))
    assert found.columns == ["id", 'a "b"', "column_3", "id_2"]
    assert sorted(map(tuple, found.collect())) == [("1", "x, y\nz", "2", "q"), ("2", "only", "", ""), ("3", "a", "b", "c")]
