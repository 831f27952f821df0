"""CSV whose fields hold line breaks, read split.

A line break ends a record only where an even number of quotes stands before it in the file. So
one pass counts the quotes of each split of a file; the sum over the splits before, a bit a split,
says which begin inside a field. A second pass then cuts each split at the ends of its
records, looks at each and writes it with what it found. What a split has of a record that goes over its border is put
together, and looked at, by a small join.

That is what a parser does that reads from the beginning, as long as quotes only enclose whole fields.
Every record is looked at for that, and where one differs the input is not read this way.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starflow.sources.csv import csv_options, read_csv
from starflow.sources.lake import read_parquet, scratch_path, write_parquet

# Parts of a record within one split: all of it, its beginning, its end, or a piece from the middle.
WHOLE, BEGINNING, END, MIDDLE = range(4)

# Splits whose numbers are sent to every task; more are joined by a shuffle of the lines.
MOST_BROADCAST = 100_000

# A record, not only spaces, of which every field is quoted throughout or holds no quote, and nothing else a parser
# might end a record at. Possessive, so that a match never backtracks.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",\r\n]*+)'
_REGULAR = rf"\A(?![\x00-\x20]+\z){_FIELD}(?:,{_FIELD})*+\z"


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("size"),
        "value",
    )


def split_parities(lines: DataFrame) -> DataFrame:
    """(split, file, start, size, inside) of each split: a number for it, and whether it begins inside a quoted field."""
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start", "size").agg(F.sum(quotes).alias("quotes"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return counted.select(F.monotonically_increasing_id().alias("split"), "file", "start", "size", inside.alias("inside"))


def _assembled():
    """Lines of splits, in order, to parts of records. Self-contained: it travels to the tasks as it is."""

    def assemble(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["split", "part", "first", "text"]
        split, begins_file, odd, begun_inside, ended, waiting = None, False, False, False, False, []

        def row(part: int, text: str):
            first = begins_file and not begun_inside and not ended
            return pa.record_batch([pa.array([split], pa.int64()), pa.array([part], pa.int32()), [first], [text]], names)

        def left_over():
            if waiting:
                inside = begun_inside and not ended
                yield row(3 if inside else 1, "\n".join(waiting))

        for batch in batches:
            splits = batch.column("split").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(splits)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                here = int(splits[begin])
                if here != split:
                    yield from left_over()
                    begun_inside = odd = batch.column("inside")[begin].as_py()
                    begins_file = batch.column("start")[begin].as_py() == 0
                    split, ended, waiting = here, False, []
                lines = batch.column("value").slice(begin, end - begin).cast(pa.large_string())
                quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
                parity = (int(odd) + np.cumsum(quotes)) & 1
                odd, ends = bool(parity[-1]), np.flatnonzero(parity == 0)
                if not len(ends):
                    waiting += lines.to_pylist()
                    continue
                # The first record may have begun in the batch, or the split, before.
                text = "\n".join([*waiting, *lines.slice(0, ends[0] + 1).to_pylist()])
                yield row(2 if begun_inside and not ended else 0, text)
                ended, waiting = True, lines.slice(ends[-1] + 1).to_pylist()
                if len(ends) > 1:
                    bounds = pa.array(ends + 1, pa.int64())
                    texts = pc.binary_join(pa.LargeListArray.from_arrays(bounds, lines), pa.scalar("\n", pa.large_string()))
                    n = len(texts)
                    yield pa.record_batch(
                        [
                            pa.array(np.full(n, here, np.int64)),
                            pa.array(np.zeros(n, np.int32)),
                            pa.array(np.zeros(n, np.bool_)),
                            texts.cast(pa.string()),
                        ],
                        names,
                    )
        yield from left_over()

    return assemble


def _judged(records: DataFrame) -> DataFrame:
    """Records, in `text`, without line end and byte order mark, and two columns more: `windows`, how they ended, and `unlike`,
    whether a parser might read them otherwise. Empty ones are left out, rows without text are not."""
    windows = F.col("text").endswith("\r")
    text = F.when(windows, F.left("text", F.length("text") - 1)).otherwise(F.col("text"))
    text = F.when(F.col("first"), F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    plain = records.withColumns({"text": text, "windows": windows})
    told = plain.filter(F.col("text").isNull() | (F.col("text") != "") | F.col("windows"))
    return told.withColumn("unlike", ~F.col("text").rlike(_REGULAR))


def _joined(pieces: DataFrame, splits: DataFrame) -> DataFrame:
    """(first, text) of the records that go over a border of splits, from their pieces."""
    order = F.when(F.col("part") == BEGINNING, 1).otherwise(0)
    placed = pieces.join(splits.select("split", "file", "start"), "split")
    keys = placed.select("file", "start", "part")
    # A record's number in its file is how many have begun so far.
    upto = W.partitionBy("file").orderBy("start", order).rowsBetween(W.unboundedPreceding, 0)
    number = F.sum((F.col("part") == BEGINNING).cast("long")).over(upto)
    numbered = placed.join(keys.withColumn("number", number), ["file", "start", "part"])
    texts = F.sort_array(F.collect_list(F.struct("start", "part", "piece")))
    return numbered.groupBy("file", "number").agg(
        F.bool_or("first").alias("first"),
        F.array_join(F.transform(texts, lambda p: p["piece"]), "\n").alias("text"),
    ).drop("number", "file")


def _records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`_judged` of every record that is not empty; `first` marks those that begin a file. Written."""
    lines = _lines(spark, path)
    splits = _saved(split_parities(lines), "csv-splits")
    known = F.broadcast(splits) if splits.count() <= MOST_BROADCAST else splits
    # Should files or settings change between the passes, that is an error and no wrong row.
    inside = F.coalesce("inside", F.raise_error(F.lit("the input was split anew while it was read")))
    placed = lines.join(known, ["file", "start", "size"], "left").select("split", "start", inside.alias("inside"), "value")
    parts = placed.mapInArrow(_assembled(), "split long, part int, first boolean, text string")
    whole = F.col("part") == WHOLE
    # Text that is not yet a record has a column of its own, so that the join reads no other.
    apart = parts.withColumns({"piece": F.when(~whole, F.col("text")), "text": F.when(whole, F.col("text"))})
    found = _saved(_judged(apart), "csv-records")
    pieces = found.filter("piece IS NOT NULL").select("split", "part", "first", "piece")
    over = _saved(_judged(_joined(pieces, splits)), "csv-joined")
    return found.filter("piece IS NULL").select(*over.columns).unionByName(over)


def read_records(
    spark: SparkSession, path: str | list[str], check_headers: bool = True, keep_empty: bool = False
) -> DataFrame | None:
    """What `read_csv` gives, but with files split and line breaks in fields; None if some record cannot be vouched for.

    Such a record has a quote that encloses no whole field, only spaces, a carriage return outside quotes
    other than in a Windows line end, or a line end unlike the others'; or a file's quotes do not match. Records are
    written once to the scratch folder; lines are shuffled only where there are more splits than
    MOST_BROADCAST. A record is one unit of memory.
    """
    records = _records(spark, path)
    facts = records.agg(
        F.coalesce(F.bool_or("unlike"), F.lit(False)).alias("unlike"),
        F.coalesce(F.bool_or("windows"), F.lit(False)).alias("windows"),
        F.coalesce(F.bool_and("windows"), F.lit(False)).alias("all_windows"),
    ).first()
    if facts["unlike"] or facts["windows"] != facts["all_windows"]:
        return None
    schema = read_csv(spark, path, check_headers=check_headers, keep_empty=keep_empty).schema
    names = [f"c{i}" for i in range(len(schema))]
    plain = ", ".join(f"{n} string" for n in names)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in csv_options(keep_empty).items()}
    # Where lines end as in Windows, Spark's reader takes that end in a field for a line feed.
    text = F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n")) if facts["windows"] else F.col("text")
    parsed = records.select("first", F.from_csv(text, plain, {**options, "multiLine": "true"}).alias("r"))
    if check_headers:
        same = [F.coalesce(F.col("r")[n], F.lit("")) == f.name for n, f in zip(names, schema)]
        other = parsed.filter("first").filter(~F.forall(F.array(*same), lambda x: x))
        if not other.isEmpty():
            raise ValueError("a file's header differs from the first file's header")
    return parsed.filter(~F.col("first")).select(*[F.col("r")[n].alias(f.name) for n, f in zip(names, schema)])
