"""Quoted text read range by range, against the reader that gives a file to one task."""

import csv
import io
import random

import pytest

from areaflow.sources import files, quoted


def text(draw, rows, end):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=draw.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    writer.writerow(["id", "a name", "note"])
    pieces = ["x", "", " ", ",", '"', '""', "\n", "\n\n", '",', ',"', '"\n"', "ü", "a\r\nb" if end == "\r\n" else "\n,", "long " * 30]
    for k in range(rows):
        writer.writerow([k, "".join(draw.choices(pieces, k=draw.randint(0, 4))), "".join(draw.choices(pieces, k=draw.randint(0, 6)))])
    return out.getvalue()


@pytest.fixture
def small_ranges(spark):
    """Many ranges for small files."""
    settings = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("seed", "end"), [(1, "\n"), (2, "\n"), (3, "\r\n"), (4, "\n")])
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_ranges, seed, end):
    draw = random.Random(seed)
    for k in range(2):
        (tmp_path / f"{k}.csv").write_text(text(draw, 60, end), encoding="utf-8", newline="")
    found = quoted.scan_quoted(spark, str(tmp_path))
    expected = files.scan_all_string(spark, str(tmp_path))
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert quoted.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20


def test_quotes_in_plain_fields_do_not_open_one(spark, tmp_path, small_ranges):
    rows = ["id,t", '1,5" pipe', '2,"two', 'lines, ""q"""', '3,a "b" c', "", '4,"', '"', "5,end"] * 1
    (tmp_path / "t.csv").write_text("\n".join(rows) + "\n" + "\n".join(f'{k},"a\n{k}""\n"' for k in range(6, 40)))
    found = sorted(map(tuple, quoted.scan_quoted(spark, str(tmp_path / "t.csv")).collect()), key=lambda r: int(r[0]))
    assert found[:5] == [("1", '5" pipe'), ("2", 'two\nlines, "q"'), ("3", 'a "b" c'), ("4", "\n"), ("5", "end")]
    assert found[5:] == [(str(k), f'a\n{k}"\n') for k in range(6, 40)]


def test_one_record_over_many_ranges(spark, tmp_path, small_ranges):
    note = "\n".join(f"line {k}, \"\"x\"\"" for k in range(200))
    (tmp_path / "t.csv").write_text(f'id,t\n1,"{note}"\n2,b\n')
    found = sorted(map(tuple, quoted.scan_quoted(spark, str(tmp_path / "t.csv")).collect()))
    assert found == [("1", note.replace('""', '"')), ("2", "b")]


def test_differing_headers_and_long_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"' + "q\"\"" * 50_000 + '"\n')
    (tmp_path / "b.csv").write_text("y,z\n2,3\n")
    (tmp_path / "c.csv").write_text("x,y\n")
    found = quoted.scan_quoted(spark, *[str(tmp_path / f"{n}.csv") for n in "abc"])
    assert sorted((r["x"] or "", len(r["y"]), r["z"] or "") for r in found.collect()) == [("", 1, "3"), ("1", 100_000, "")]
