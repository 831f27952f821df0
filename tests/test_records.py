"""CSV with line breaks in fields, read split, against Spark's reader that takes each file whole."""

from __future__ import annotations

import gzip
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starflow.plans import ingest_bronze
from starflow.sources import read_csv, read_records
from starflow.sources import records as records_module


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes, so that records begin and end in any of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def set_to(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def same_as_whole(spark, path, **options):
    got, want = read_records(spark, path, **options), read_csv(spark, path, **options)
    assert got is not None
    assert got.schema == want.schema
    assert rows(got) == rows(want)
    return got


def random_csv(seed, records, end="\n"):
    draw = random.Random(seed)
    fields = ["", "plain", "007", "  pad ", '"a\nb"', '"say ""hi"", bye"', '"x\n\n\n"', '"\n"', '""', '"é\r\n日本"', '"' + "long\n" * 30 + '"']
    lines = [",".join(draw.choice(fields) for _ in range(draw.choice([3, 3, 3, 2, 4]))) for _ in range(records)]
    lines += [",,x", "1,2,3"]
    return "a,b,c" + end + end.join(lines) + (end if seed % 2 else "")


@pytest.mark.parametrize("seed, size", [(0, 50), (1, 120), (3, 1000)])
def test_any_split_of_a_file_gives_its_records(spark, tmp_path, small_splits, seed, size):
    (tmp_path / "raw.csv").write_bytes(random_csv(seed, size // 2).encode())
    small_splits(size)
    same_as_whole(spark, str(tmp_path / "raw.csv"), keep_empty=bool(seed % 2))


def test_many_files_windows_ends_marks_and_compression(spark, tmp_path, small_splits):
    for i in range(5):
        text = random_csv(2 * i + 1, 20, "\r\n").replace("é\r\n", "é\n")
        (tmp_path / f"{i}.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    with gzip.open(tmp_path / "z.csv.gz", "wb") as file:
        file.write(random_csv(9, 40, "\r\n").encode())
    small_splits(400)
    same_as_whole(spark, str(tmp_path))


def test_a_field_over_many_splits_and_a_header_with_line_breaks(spark, tmp_path, small_splits):
    text = '"a\nb",c\n1,"' + "many\nlines " * 60 + '"\n2,x\n'
    (tmp_path / "raw.csv").write_text(text)
    small_splits(50)
    assert same_as_whole(spark, str(tmp_path / "raw.csv")).columns == ["a\nb", "c"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(body=st.text(alphabet='a," \n\r\t', max_size=40), size=st.sampled_from([11, 1000]))
def test_what_is_vouched_for_reads_the_same(spark, tmp_path, small_splits, body, size):
    path = tmp_path / f"{abs(hash(body))}.csv"
    path.write_bytes(("a,b,c\n" + body).encode())
    small_splits(size)
    got = read_records(spark, str(path))
    if got is not None:
        assert rows(got) == rows(read_csv(spark, str(path)))


@pytest.mark.parametrize(
    "body",
    ['5" pipe,2,3\n', '1,"a\nb",x\n1,"open\n', '1,"a" x,"b\nc"\n', "1,a\rb,3\n", "1,2,3\r\n4,5,6\n", "1,2,3\n  \n"],
)
def test_what_cannot_be_vouched_for_is_read_whole(spark, tmp_path, body):
    path = str(tmp_path / "raw.csv")
    (tmp_path / "raw.csv").write_bytes(("a,b,c\n" + body).encode())
    assert read_records(spark, path) is None
    with pytest.raises(ValueError, match="quotes"):
        ingest_bronze(spark, path, str(tmp_path / "b"), "records")
    assert rows(ingest_bronze(spark, path, str(tmp_path / "b"))) == rows(read_csv(spark, path))


def test_headers_are_checked_on_request(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "2.csv").write_text('b,a\n2,"x\ny"\n')
    with pytest.raises(ValueError, match="header"):
        read_records(spark, str(tmp_path))
    assert rows(read_records(spark, str(tmp_path), check_headers=False)) == Counter({("1", "x\ny"): 1, ("2", "x\ny"): 1})


def test_repeated_headers(spark, tmp_path):
    (tmp_path / "raw.csv").write_text('a,A,a,\n1,"2\n",3,4\n')
    same_as_whole(spark, str(tmp_path / "raw.csv"), check_headers=False)


def test_no_records(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a,b\n")
    assert same_as_whole(spark, str(tmp_path / "raw.csv")).collect() == []


@pytest.mark.parametrize("most", [0, 100_000])
def test_bronze_of_one_file_is_many_tasks(spark, tmp_path, small_splits, monkeypatch, most):
    monkeypatch.setattr(records_module, "MOST_BROADCAST", most)
    pad = random.Random(0)
    lines = [f'{i},{pad.randbytes(60).hex()},"note\n{i}, ""ok"""' for i in range(20_000)]
    (tmp_path / "raw.csv").write_text("id,pad,note\n" + "\n".join(lines) + "\n")
    small_splits(200_000)
    bronze = ingest_bronze(spark, str(tmp_path / "raw.csv"), str(tmp_path / "bronze"))
    counts = [r["count"] for r in bronze.groupBy("_metadata.file_path").count().collect()]
    assert sum(counts) == 20_000 and max(counts) < 10_000
    assert rows(bronze) == rows(read_csv(spark, str(tmp_path / "raw.csv")))


def test_splits_that_change_between_the_passes_are_an_error(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "raw.csv").write_text(random_csv(1, 300))
    small_splits(500)
    real = records_module._saved

    def saved_then_split_anew(df, label):
        done = real(df, label)
        small_splits(300)
        return done

    monkeypatch.setattr(records_module, "_saved", saved_then_split_anew)
    with pytest.raises(Exception, match="split anew"):
        read_records(spark, str(tmp_path / "raw.csv"))


def test_records_are_written_once_and_looked_at_as_they_are_cut(spark, tmp_path, small_splits, monkeypatch):
    lines = [f'{i},"note\n{i:060d}"' for i in range(2_000)]
    (tmp_path / "raw.csv").write_text("id,note\n" + "\n".join(lines) + "\n")
    small_splits(10_000)
    saved, real = Counter(), records_module._saved

    def counted(df, label):
        done = real(df, label)
        saved[label] += done.count()
        return done

    monkeypatch.setattr(records_module, "_saved", counted)
    same_as_whole(spark, str(tmp_path / "raw.csv"))
    splits = saved["csv-splits"]
    assert 10 < splits < 20
    # All records, and two pieces of those over a border of splits, which are written again joined.
    assert sum(saved.values()) - splits <= 2_001 + 2 * splits
