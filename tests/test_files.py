import os

import pytest
from conftest import rows

from twinrow.sources import files, sinks

ROW = ["id", "name", "val"]


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_csv_is_positional_and_unquoted(spark, folder):
    path = put(folder, "a.csv", '1,"a",x\n2,,\n3, b ,\t\n')
    assert rows(files.read_csv_rows(spark, path, ROW)) == [
        ("1", '"a"', "x"), ("2", "", ""), ("3", " b ", "\t"),
    ]


def test_csv_keeps_quotes_that_open_only(spark, folder):
    path = put(folder, "a.csv", '1,"a,x\n2,b"b,"\n')
    assert rows(files.read_csv_rows(spark, path, ROW)) == [("1", '"a', "x"), ("2", 'b"b', '"')]


def test_semicolons_and_several_files(spark, folder):
    paths = [put(folder, n, t) for n, t in (("a", "a;b,c;d\n"), ("b", "e;;\n"))]
    assert rows(files.read_csv_rows(spark, paths, ["f0", "f1", "f2"], ";")) == [
        ("a", "b,c", "d"), ("e", "", ""),
    ]


def test_only_line_feeds_end_lines(spark, folder):
    path = put(folder, "a.csv", "1,a,x\r\n2,b\r,y\n")
    assert rows(files.read_csv_rows(spark, path, ROW)) == [("1", "a", "x\r"), ("2", "b\r", "y")]
    path = put(folder, "b.csv", "1,a,x\r\n2,b,y\r\n")
    assert rows(files.read_csv_rows(spark, path, ROW, line_sep="\r\n")) == [("1", "a", "x"), ("2", "b", "y")]


def test_blank_lines_are_rows(spark, folder):
    path = put(folder, "a.csv", "1\n\n2\n \n")
    assert rows(files.read_csv_rows(spark, path, ["x"])) == [(" ",), ("",), ("1",), ("2",)]
    with pytest.raises(Exception, match="expected 3 fields"):
        files.read_csv_rows(spark, put(folder, "b.csv", "1,a,x\n\n"), ROW).collect()


@pytest.mark.parametrize("line", ["1,a", "1,a,x,y"])
def test_wrong_field_count_fails(spark, folder, line):
    path = put(folder, "a.csv", f"1,a,x\n{line}\n")
    with pytest.raises(Exception, match="expected 3 fields"):
        files.read_csv_rows(spark, path, ROW).collect()


@pytest.mark.parametrize("block", ["128m", "64", "7"])
def test_wrong_lines_go_out_with_their_place(spark, folder, block):
    good = [(str(i), "é" * (i % 4), "v") for i in range(40)]
    lines = [",".join(g) for g in good]
    for at, line in ((3, "short"), (17, "a,b,c,d"), (18, ""), (40, "é,é"), (43, "1,2,3,4,5")):
        lines.insert(at, line)
    path = put(folder, "a.csv", "\n".join(lines) + "\n")
    other = put(folder, "b.csv", "x\n1,2,3\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows_, wrong = files.split_csv_rows(spark, [path, other], ROW)
        got = sorted((r.file.rsplit("/", 1)[1], r.offset, r.fields, r.line) for r in wrong.collect())
        assert rows(rows_) == sorted([*good, ("1", "2", "3")], key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    raw = {n: open(p, "rb").read() for n, p in (("a.csv", path), ("b.csv", other))}
    assert [g[2:] for g in got] == [(1, "short"), (4, "a,b,c,d"), (1, ""), (2, "é,é"), (5, "1,2,3,4,5"), (1, "x")]
    for name, offset, _, line in got:
        assert raw[name][offset:].split(b"\n")[0] == line.encode()


def test_csv_round_trip(spark, folder):
    df = spark.createDataFrame(
        [("1", 'q"q', " x "), ("2", "", "back\\slash"), ("3", "'", "")], "id string, name string, val string"
    )
    sinks.write_csv(df, f"{folder}/out")
    assert rows(files.read_csv_rows(spark, f"{folder}/out", ROW)) == rows(df)


def test_space_separated_and_text_lines(spark, folder):
    df = spark.createDataFrame([("a", 2), ("b", None)], "word string, n long")
    sinks.write_csv(df, f"{folder}/csv", " ")
    sinks.write_text(df, f"{folder}/text")
    sinks.write_text(df.select("word"), f"{folder}/one")
    assert rows(files.read_lines(spark, f"{folder}/csv")) == [("a 2",), ("b ",)]
    assert rows(files.read_lines(spark, f"{folder}/text", f"{folder}/one")) == [
        ("(a,2)",), ("(b,null)",), ("a",), ("b",),
    ]


def test_preview_tells_how_many_there_are(spark, capsys):
    sinks.preview(spark.createDataFrame([("a",)] * 30, "word string"))
    assert "20 of 30 rows" in capsys.readouterr().out
