"""CSV with every field as the text that was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A string no exported field holds, so that only unquoted empty fields match it.
_NO_SUCH_FIELD = "\u0000"


def csv_options(keep_empty: bool = False) -> dict[str, str | bool]:
    """How records are parsed, whoever finds where they end. Quotes inside a quoted field are doubled, per RFC 4180."""
    return {"inferSchema": False, "escape": '"', **({"nullValue": _NO_SUCH_FIELD} if keep_empty else {})}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = True,
    check_headers: bool = True,
    keep_empty: bool = False,
) -> DataFrame:
    """All columns as strings, under the header's names.

    Types are never inferred: that costs a pass over the data and rewrites ids
    such as "007" or "1e5". Quotes inside a quoted field are doubled, per RFC 4180.

    multiline      allow line breaks inside quoted fields. Spark then gives each
                   file to one task; turn it off where fields hold no line breaks, and
                   files split. `read_records` splits files with line breaks in fields.
    check_headers  fail if a file's header differs from the first file's. Needs unique,
                   non-blank headers. Off, Spark reads later files by position, whatever
                   their headers say.
    keep_empty     read a quoted empty field as '' rather than NULL.
    """
    reader = (
        spark.read.options(**csv_options(keep_empty))
        .option("header", True)
        .option("multiLine", multiline)
        .option("enforceSchema", not check_headers)
    )
    return reader.csv(path)


# One whole record: fields that are quoted throughout or hold no quote, and no
# carriage return, which the two ways of reading treat differently. Possessive, so
# that a match never backtracks.
_FIELD = r'(?:"[^"\r]*+(?:""[^"\r]*+)*+"|[^",\r]*+)'
_RECORD = rf"^{_FIELD}(?:,{_FIELD})*+"
_BLANK = r"^[\x00-\x20]+\z"


def one_record_per_line(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether every line is a record by itself, so that files may be read split.

    Exact, not a sample: a pass over the files as text, which splits, and stops at
    the first line that says otherwise. Lines may have Windows ends if all do, also
    the last; both ways of reading take these off. A line it cannot vouch for, such as one
    with a stray quote, an end unlike the others' or only spaces, counts as saying so.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return any(
        lines.filter(~F.col("value").rlike(_RECORD + end) | F.col("value").rlike(_BLANK)).isEmpty()
        for end in (r"\z", r"\r\z")
    )


def write_csv(df: DataFrame, path: str, by: Sequence[str] = (), add: bool = False) -> None:
    """Overwrite `path` with CSV files that `read_csv` reads back unchanged.

    Padding and microseconds are kept, which Spark's defaults would cut.

    by   columns that name folders, `column=value`, instead of being written; one pass deals the rows to all of them.
    add  keep the files that are there.
    """
    (
        df.write.mode("append" if add else "overwrite")
        .partitionBy(*by)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )
