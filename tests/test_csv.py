"""Hand-written CSV that inference, default escapes or a CSV round trip would change."""

from __future__ import annotations

import gzip
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starflow.plans import ingest_bronze
from starflow.plans import bronze as bronze_module
from starflow.sources import one_record_per_line, read_csv, write_csv


def read(spark, tmp_path, text, **options):
    path = tmp_path / "raw.csv"
    path.write_text(text)
    return read_csv(spark, str(path), **options)


def values(df):
    return [tuple(row) for row in df.collect()]


def test_numbers_stay_text(spark, tmp_path):
    df = read(spark, tmp_path, "id,version,key\n007,17.10,0000000000000012\n1e5,120,1234567890123456\n")
    assert set(dict(df.dtypes).values()) == {"string"}
    assert values(df) == [("007", "17.10", "0000000000000012"), ("1e5", "120", "1234567890123456")]


def test_quotes_line_breaks_and_backslashes(spark, tmp_path):
    df = read(spark, tmp_path, 'a,b,c\n"say ""hi"", bye","line1\nline2","c:\\dir\\"\n')
    assert values(df) == [('say "hi", bye', "line1\nline2", "c:\\dir\\")]


def test_quoted_empty_field(spark, tmp_path):
    text = 'a,b\n"",\n'
    assert values(read(spark, tmp_path, text)) == [(None, None)]
    assert values(read(spark, tmp_path, text, keep_empty=True)) == [("", None)]


@pytest.mark.parametrize("multiline", [True, False])
def test_windows_line_ends_byte_order_mark_and_compression(spark, tmp_path, multiline):
    with gzip.open(tmp_path / "raw.csv.gz", "wb") as file:
        file.write(b"\xef\xbb\xbfid,b\r\n007,x\r\n1e5,\r\n")
    df = read_csv(spark, str(tmp_path / "raw.csv.gz"), multiline=multiline)
    assert df.columns == ["id", "b"]
    assert values(df) == [("007", "x"), ("1e5", None)]


def test_short_and_long_rows_are_kept(spark, tmp_path):
    assert values(read(spark, tmp_path, "a,b\n1\n1,2,3\n")) == [("1", None), ("1", "2")]


def test_padding_is_kept(spark, tmp_path):
    assert values(read(spark, tmp_path, "a,b\n  pad  ,x\n")) == [("  pad  ", "x")]


def test_repeated_and_blank_headers_are_accepted(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a,A,a,\n1,2,3,4\n")
    df = read_csv(spark, str(tmp_path / "raw.csv"), check_headers=False)
    assert df.columns == ["a0", "A1", "a2", "_c3"]
    assert values(df) == [("1", "2", "3", "4")]


def test_files_with_reordered_headers_can_be_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).collect()


def test_export_reads_back_unchanged(spark, tmp_path):
    rows = [
        ("  pad  ", 'say "hi", bye', "line1\nline2", "c:\\dir\\"),
        ("", None, "007", "1e5"),
        ("é", "|", ",", '"'),
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    path = str(tmp_path / "export")
    write_csv(df, path)
    assert sorted(values(read_csv(spark, path, keep_empty=True)), key=str) == sorted(rows, key=str)


def test_export_keeps_microseconds(spark, tmp_path):
    path = str(tmp_path / "export")
    write_csv(spark.sql("SELECT timestamp'2024-01-01 00:00:00.123456' AS t"), path)
    assert values(read_csv(spark, path)) == [("2024-01-01T00:00:00.123456Z",)]


@pytest.mark.parametrize("reading, spread", [("check", False), ("whole", True), ("whole", False)])
def test_bronze_equals_the_export(spark, tmp_path, reading, spread):
    text = 'Unnamed: 0,prop_$host,x.y\n1,"a\nb",007\n2,"c ""d""",\n3,,"  "\n'
    raw = read(spark, tmp_path, text)
    bronze = ingest_bronze(
        spark, str(tmp_path / "raw.csv"), str(tmp_path / "bronze"), reading, spread=spread
    )
    assert bronze.schema == raw.schema
    assert sorted(values(bronze)) == sorted(values(raw))
    assert sorted(values(bronze))[0] == ("1", "a\nb", "007")


def test_ingest_replaces_what_was_there(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    for ids in ("1\n2\n", "3\n"):
        (tmp_path / "raw.csv").write_text("id\n" + ids)
        staged = ingest_bronze(spark, str(tmp_path / "raw.csv"), bronze)
    assert values(staged) == [("3",)]


@pytest.mark.parametrize(
    "body, expected",
    [
        ('1,"say ""hi"", bye",x\n', True),
        ("1,,\r\n2,,\r\n", False),
        ("", True),
        ("\n\n1,2,3\n", True),
        ('1,"a\nb",x\n', False),
        ('5" pipe,2,3\n', False),
        ('x"y,"a\nb",z"w\n', False),
        ("1,a\rb,3\n", False),
        ("1,2,3\n  \n", False),
    ],
)
def test_one_record_per_line(spark, tmp_path, body, expected):
    (tmp_path / "raw.csv").write_bytes(("a,b,c\n" + body).encode())
    assert one_record_per_line(spark, str(tmp_path / "raw.csv")) is expected


@pytest.mark.parametrize(
    "body, expected",
    [
        ('1,"say ""hi"", bye","x"\r\n2,,\r\n', True),
        ("1, a ,007\r\n,,\r\n", True),
        ('1,"a\r\nb",x\r\n', False),
        ("1,a\rb,3\r\n", False),
        ("1,2,3\r\n4,5,6\n", False),
        ("1,2,3\r\n\r\n", False),
    ],
)
def test_windows_line_ends_are_read_split(spark, tmp_path, body, expected):
    path = str(tmp_path / "raw.csv")
    (tmp_path / "raw.csv").write_bytes(("a,b,c\r\n" + body).encode())
    assert one_record_per_line(spark, path) is expected
    if expected:
        assert values(read_csv(spark, path, multiline=False)) == values(read_csv(spark, path))


@settings(max_examples=80, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(body=st.text(alphabet='a," \n\r\t', max_size=30))
def test_lines_vouched_for_read_the_same_split_and_whole(spark, tmp_path, body):
    path = tmp_path / f"{abs(hash(body))}.csv"
    path.write_bytes(("a,b,c\n" + body).encode())
    if one_record_per_line(spark, str(path)):
        whole = read_csv(spark, str(path), multiline=True)
        split = read_csv(spark, str(path), multiline=False)
        assert values(whole) == values(split)


def test_long_quoted_fields_are_checked_without_overflow(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a,b\n1,\"" + '""x' * 200_000 + '"\n')
    assert one_record_per_line(spark, str(tmp_path / "raw.csv"))


def many_lines(path, rows, broken=False):
    pad = random.Random(0)
    note = '"line1\nline2"' if broken else '"say ""hi"", bye"'
    lines = [f"{i},{pad.randbytes(100).hex()},{note if i == rows // 2 else 'plain'}" for i in range(rows)]
    path.write_text("id,pad,note\n" + "\n".join(lines) + "\n")


@pytest.mark.parametrize("broken", [False, True])
def test_a_large_lone_file_is_split_also_where_a_record_spans_lines(spark, tmp_path, broken):
    many_lines(tmp_path / "raw.csv", 100_000, broken)
    bronze = ingest_bronze(spark, str(tmp_path / "raw.csv"), str(tmp_path / "bronze"))
    files = len(list((tmp_path / "bronze").glob("*.parquet")))
    assert files > 1
    whole = read_csv(spark, str(tmp_path / "raw.csv"))
    assert bronze.count() == 100_000
    assert bronze.exceptAll(whole).isEmpty()
    assert bronze.filter("id = 50000").first().note == ("line1\nline2" if broken else 'say "hi", bye')


def test_a_large_file_among_many_small_ones_is_split(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    many_lines(tmp_path / "raw" / "large.csv", 60_000)
    for i in range(12):
        many_lines(tmp_path / "raw" / f"small{i}.csv", 100)
    bronze = ingest_bronze(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"))
    counts = [r["count"] for r in bronze.groupBy("_metadata.file_path").count().collect()]
    assert sum(counts) == 61_200 and max(counts) < 60_000


@pytest.mark.parametrize("reading", ["check", "split", "whole"])
def test_how_files_are_read_does_not_depend_on_cores(spark, tmp_path, reading, monkeypatch):
    """The same reading, whatever number of cores is registered."""
    many_lines(tmp_path / "raw.csv", 200)
    asked = []
    real = bronze_module.read_csv
    monkeypatch.setattr(
        bronze_module, "read_csv", lambda *a, **k: asked.append(k["multiline"]) or real(*a, **k)
    )
    for cores in (2, 8):
        monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", cores)
        ingest_bronze(spark, str(tmp_path / "raw.csv"), str(tmp_path / f"b{cores}"), reading)
    assert asked == [reading == "whole"] * 2
    with pytest.raises(ValueError, match="check, split, records, whole"):
        ingest_bronze(spark, str(tmp_path / "raw.csv"), str(tmp_path / "b"), "auto")
