"""Quoted CSV in blocks against the whole-file reader."""

import random

import pytest

from haulgrain.sources import csv_records
from haulgrain.sources.csv_records import ends_quoted, read_quoted_csv

WHOLE_FILE = dict(header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=False)


@pytest.fixture
def block(spark):
    """Cut files into blocks of a few bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def size(n):
        for name in names:
            spark.conf.set(name, str(n))

    yield size
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def table(r, rows, end):
    cells = ["", "a", "x y", '""', '"q"', '"a,b"', '"two\nlines"', '"say ""hi"""', '"\n\n"', '"é,\n""\n"', " lead", "'", "\\", '"\\"', "7.50",
             '"crlf\r\nin"', 'in"ner', '5" x 6"', '"long ' + "line\n" * 9 + '"']
    lines = ["id,Note One,n"]
    for i in range(rows):
        lines.append(f"{i},{r.choice(cells)},{r.choice(cells[1:])}")
        if r.random() < 0.1:
            lines.append("")
    return end.join(lines) + r.choice(["", end])


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_blocks_equal_whole_files(spark, tmp_path, block, seed, end):
    r = random.Random(seed)
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(2):
        (folder / f"{k}.csv").write_bytes(table(r, 30, end).encode())
    # Where records end in CRLF the whole-file reader also rewrites line ends within fields; here they stay.
    same = (lambda x: x and x.replace("\r\n", "\n")) if end == "\r\n" else (lambda x: x)
    want = sorted((tuple(x) for x in spark.read.options(**WHOLE_FILE).csv(str(folder)).collect()), key=str)
    assert len(want) == 60
    for size in (17, 100, 10_000):
        block(size)
        got = read_quoted_csv(spark, str(folder))
        assert got.columns == ["id", "Note One", "n"]
        assert sorted((tuple(map(same, x)) for x in got.collect()), key=str) == want
        if size == 100:
            assert got.rdd.getNumPartitions() > 10


def test_one_field_over_many_blocks(spark, tmp_path, block):
    text = "line, with ""quotes""\n" * 400
    (tmp_path / "a.csv").write_text('id,text\n1,short\n2,"' + text.replace('"', '""') + '"\n3,"b\n"\n')
    block(64)
    got = {x["id"]: x["text"] for x in read_quoted_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {"1": "short", "2": text, "3": "b\n"}


def test_unblocked_reading_also_by_join(spark, tmp_path, block, monkeypatch):
    (tmp_path / "a.csv").write_text('id,text\n' + "".join(f'{i},"a\n{i}"\n' for i in range(50)))
    monkeypatch.setattr(csv_records, "BROADCAST_BLOCKS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    block(30)
    try:
        got = read_quoted_csv(spark, str(tmp_path / "a.csv")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {tuple(x) for x in got} == {(str(i), f"a\n{i}") for i in range(50)}


@pytest.mark.parametrize("text,message", [
    ('id,n\n1,"open\n2,b\n', "never closed"), ("", "no header"), ('a,A\n1,2\n', "columns of one name"),
    ('"a\nb,c\n', "longer than a block|never closed"), ("id,n\r1,2\r", "unreadable header")])
def test_broken_files_are_errors(spark, tmp_path, text, message):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(ValueError, match=message):
        read_quoted_csv(spark, str(tmp_path / "a.csv"))


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\ufeffid,n\n1,2\n")
    (tmp_path / "b.csv").write_text('"id",n\r\n3,4\r\n')
    (tmp_path / "c.csv").write_text("")
    assert {tuple(x) for x in read_quoted_csv(spark, str(tmp_path)).collect()} == {("1", "2"), ("3", "4")}
    (tmp_path / "c.csv").write_text("n,id\n5,6\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_quoted_csv(spark, str(tmp_path))


def test_line_ends_inside_quotes():
    for line, outside, inside in [
        ("", False, True), ("a,b", False, True), ('"a', True, False), ('a,"b', True, False), ('a,"b"', False, False), ('x"y', False, False),
        ('""', False, True), ('"""', True, False), ('a"', False, False), ('a",b', False, False), ('a","b', True, True), ('","', False, True), ('"a"x",b', False, False)]:
        assert (ends_quoted(line, False), ends_quoted(line, True)) == (outside, inside), line
