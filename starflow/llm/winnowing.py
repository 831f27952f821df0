"""Document fingerprints by winnowing, with built-in expressions only.

Every run of `k` characters is hashed; of every `w` consecutive hashes the least is chosen, of equals the
rightmost. A passage of w + k - 1 characters that two texts share holds a whole window of
w hashes, so both choose the same hash from it: shared passages of that length always
show. Positions are kept with the hashes.

A chosen k-gram is one long: its hash, 31 bits, above the complement of its position, so the
least of some longs is the least hash, and of equal ones the rightmost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starflow.llm.rows import documents, row_key

K, W = 8, 32
_CHUNK = 32768  # characters whose k-grams are held at once
_POSITIONS = (1 << 32) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), evaluating `value` once however often it is used."""
    return F.transform(F.array(value), use).getItem(0)


def _hash(gram: Column) -> Column:
    return F.shiftleft(F.xxhash64(gram).bitwiseAND(0x7FFFFFFF), 32)


def _window_minima(values: Column, w: int) -> Column:
    """Minimum of every w consecutive values; of all where there are fewer.

    The minima of 2, 4, 8 ... values come from those of half as many. Values are looked up by
    place, since slices would copy them. What begins in the last w - 1 places is no window.
    """

    def widen(minima: Column, width: int) -> Column:
        apart = min(width, w - width)
        wider = F.transform(minima, lambda x, i: F.least(x, F.get(minima, i + apart)))
        if width + apart == w:
            return wider
        return _let(wider, lambda held: widen(held, width + apart))

    whole = F.slice(widen(values, 1), 1, F.size(values) - (w - 1)) if w > 1 else values
    return F.when(F.size(values) >= w, whole).otherwise(F.array(F.array_min(values)))


def _low(value: Column) -> Column:
    """The complement of a value's position."""
    return value.bitwiseAND(_POSITIONS)


def _settled(values: Column, before: Column, behind: Column, w: int) -> Column:
    """Of some values in the order of their positions, those that no window of w positions chooses something else over.

    A value is chosen if w positions or more lie between the smaller ones nearest on either side. Where the neighbours are both
    smaller and nearer than that, it goes; what it kept from being chosen, they keep from it too. Of neighbours one
    at most goes, so all go at once, until none does. `before` and `behind` are the lows of the positions outside.
    """

    def stays(held: Column, x: Column, i: Column) -> Column:
        left, right = F.get(held, i - 1), F.get(held, i + 1)
        apart = F.coalesce(_low(left), before) - F.coalesce(_low(right), behind)
        return F.when(left > x, F.lit(True)).when(right > x, F.lit(True)).otherwise(apart > w)

    def turn(state: Column, _: Column) -> Column:
        held = state["held"]
        fewer = F.filter(held, lambda x, i: stays(held, x, i))
        done = lambda x: F.struct(x.alias("held"), (F.size(x) == F.size(held)).alias("done"))
        return F.when(state["done"], state).otherwise(_let(fewer, done))

    # In w positions are w values at most, and each turn takes the largest of those that are to go.
    start = F.struct(values.alias("held"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(w)), start, turn)["held"]


# Values a window holds on average of those that are looked at first.
_FIRST = 10


def _chosen_values(values: Column, before: Column, w: int) -> Column:
    """The values that windows choose, in order. Minima are small, so only small values are looked at; where a window
    has none of those, all are."""
    every = F.array_distinct(_window_minima(values, w))
    if w <= _FIRST:
        return every
    behind = before - F.size(values) - 1
    small = F.filter(values, lambda x: x < ((1 << 31) * _FIRST // w) << 32)

    def unless_empty(found: Column) -> Column:
        far = F.filter(found, lambda x, i: F.coalesce(_low(F.get(found, i - 1)), before) - _low(x) > w)
        whole = (F.size(far) == 0) & (_low(F.get(found, F.size(found) - 1)) - behind <= w)
        return F.when(whole, found).otherwise(every)

    settled = _let(small, lambda held: _settled(held, before, behind, w))
    return F.when(F.size(values) >= w, _let(settled, unless_empty)).otherwise(every)


def _chosen(text: Column, offset: Column, k: int, w: int) -> Column:
    """Chosen k-grams of a short text, in the order in which they are first chosen."""
    grams = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{k}}}))."), 1)

    def of(top: Column) -> Column:
        valued = F.when(
            F.length(text) >= k, F.transform(grams, lambda gram, i: _hash(gram) + (top - i))
        ).otherwise(F.array(_hash(text) + top))
        return _let(valued, lambda values: _chosen_values(values, top + 1, w))

    # Once a text; inside the function over the grams it would be worked out for each.
    chosen = _let(F.lit(_POSITIONS) - offset, of)
    return F.when(F.length(text) > 0, chosen).otherwise(F.array().cast("array<bigint>"))


def chosen_grams(text: Column, k: int = K, w: int = W) -> Column:
    """Chosen k-grams of a text, as longs, in the order in which windows first choose them.

    A text with fewer than w k-grams is one window; with fewer than k characters, one
    k-gram; NULL and empty texts have none. Long texts are worked through in overlapping
    chunks, each with the windows that begin in it.
    """
    reach = w + k - 1
    text = F.coalesce(text, F.lit(""))
    chunks = F.greatest(F.ceil((F.length(text) - (reach - 1)) / _CHUNK), F.lit(1)).cast("int")

    def part(i: Column) -> Column:
        begin = i.cast("long") * _CHUNK
        piece = F.substring(text, (begin + 1).cast("int"), F.lit(_CHUNK + reach - 1))
        return _let(piece, lambda held: _chosen(held, begin, k, w))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), chunks - 1), part)))


def gram_hash(gram: Column) -> Column:
    return F.shiftright(gram, 32)


def gram_position(gram: Column) -> Column:
    return F.lit(_POSITIONS) - gram.bitwiseAND(_POSITIONS)


def fingerprint(grams: Column) -> Column:
    """The chosen hashes in order, eight hex digits each."""
    digits = F.transform(grams, lambda x: F.lpad(F.hex(gram_hash(x)), 8, "0"))
    return F.lower(F.array_join(digits, ""))


def distinct_hashes(grams: Column) -> Column:
    return F.array_distinct(F.transform(grams, gram_hash))


def _alike(hashes: Column, others: Column) -> Column:
    shared = F.size(F.array_intersect(hashes, others))
    total = F.size(hashes) + F.size(others) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the chosen hashes; 1 if both texts have none."""
    return _let(distinct_hashes(a), lambda x: _let(distinct_hashes(b), lambda y: _alike(x, y)))


def _chosen_by(grams: Column, windows: Column, w: int) -> Column:
    """Of a text's chosen grams, those that its first `windows` windows choose.

    A gram is first chosen when it comes into the window with a hash no greater than the one
    chosen before, or when that one has left.
    """

    def first(gram: Column, i: Column) -> Column:
        before = F.get(grams, i - 1)
        entering = gram_hash(gram) <= gram_hash(before)
        at = F.when(entering, gram_position(gram) - (w - 1)).otherwise(gram_position(before) + 1)
        return F.when(i == 0, F.lit(0)).otherwise(at)

    return F.filter(grams, lambda gram, i: first(gram, i) < windows)


def joined_grams(
    head: Column, head_grams: Column, head_size: Column,
    tail: Column, tail_grams: Column, tail_size: Column,
    k: int = K, w: int = W,
) -> Column:
    """Chosen grams of the first `head_size` characters of one text followed by the first
    `tail_size` of another, equal to those of the joined text.

    Windows that lie in one part choose what they choose in its text, whose grams are known. Only
    those across the joint are worked out anew, from the characters around it.
    """
    reach = w + k - 1
    none = F.array().cast("array<bigint>")
    begin = F.greatest(head_size - (reach - 1), F.lit(0))
    around = F.concat(
        F.substring(head, begin + 1, head_size - begin),
        F.substring(tail, F.lit(1), F.least(tail_size, F.lit(reach - 1))),
    )
    across = _let(
        around,
        lambda text: F.when(F.length(text) >= reach, _chosen(text, begin.cast("long"), k, w)).otherwise(none),
    )
    short = F.concat(F.substring(head, F.lit(1), head_size), F.substring(tail, F.lit(1), tail_size))
    moved = F.transform(
        _chosen_by(tail_grams, tail_size - (reach - 1), w), lambda x: x - head_size.cast("long")
    )
    parts = F.concat(_chosen_by(head_grams, head_size - (reach - 1), w), across, moved)
    return F.when(
        head_size + tail_size < reach, _let(short, lambda text: _chosen(text, F.lit(0).cast("long"), k, w))
    ).otherwise(F.array_distinct(parts))


def _labels(spark: SparkSession, parts: int, n: int) -> list[int]:
    """n different numbers that a shuffle by their hash deals to different ones of `parts` partitions, as far as
    there are enough."""
    numbers = spark.range(16 * parts).select(F.col("id").cast("int").alias("label"))
    dealt = numbers.groupBy(F.pmod(F.hash("label"), F.lit(parts)).alias("to")).agg(F.min("label").alias("label"))
    found = sorted(r["label"] for r in dealt.collect())
    return (found + list(range(16 * parts, 16 * parts + n)))[:n]


def with_next(
    docs: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """`prepare(docs)` and a column `next`, its `columns` of the document that follows in
    descending doc_id; the first document follows the last.

    `docs` has doc_id and row. `prepare` adds columns row by row, once for each document, and
    once more for one document a range.

    Documents are dealt into ranges of doc_id whose limits are approximate percentiles, so
    each range is a task's share. Each range also gets the largest document of the one below (the
    lowest: of the highest), and then finds all followers by itself. Rows that repeat
    a doc_id follow each other by `row`. Rows without doc_id are left out.
    """
    spark = docs.sparkSession
    known = docs.filter("doc_id IS NOT NULL")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    limits = known.agg(
        F.percentile_approx("doc_id", shares, F.lit(max(10_000, 20 * parts))).alias("limits")
    ).first()["limits"]
    limits = sorted(set(limits or []))
    bounds = F.array(*[F.lit(x).cast("long") for x in limits]) if limits else F.array().cast("array<bigint>")
    # One comparison a limit, against thousands of characters hashed.
    place = F.size(F.filter(bounds, lambda x: x <= F.col("doc_id")))
    labels = F.array(*[F.lit(x) for x in _labels(spark, parts, len(limits) + 1)])
    ranged = known.withColumn("range", F.get(labels, place))
    plain = ranged.columns
    # At most one row a range comes to the driver.
    tops = ranged.groupBy("range").agg(F.max(F.struct("doc_id", F.expr("-row AS low"))).alias("top"))
    tops = sorted(
        ((r["range"], r["top"]["doc_id"], -r["top"]["low"]) for r in tops.collect()), key=lambda t: t[1]
    )
    ranges = [r for r, _, _ in tops]
    guests = spark.createDataFrame(
        [(doc, row, ranges[(i + 1) % len(ranges)]) for i, (_, doc, row) in enumerate(tops)],
        "doc_id long, row long, into int",
    )
    visiting = (
        ranged.join(F.broadcast(guests), ["doc_id", "row"])
        .withColumn("range", F.col("into"))
        .select(*plain)
        .dropDuplicates(["doc_id", "row"])
    )
    order = Window.partitionBy("range").orderBy("guest", F.desc("doc_id"), "row")
    return (
        prepare(ranged)
        .withColumn("guest", F.lit(False))
        .union(prepare(visiting).withColumn("guest", F.lit(True)))
        .withColumn("next", F.lead(F.struct(*columns)).over(order))
        .filter("NOT guest")
        .drop("guest", "range")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return (
        documents(docs)
        .withColumn("row", row_key())
        .withColumn("text", F.coalesce("text", F.lit("")))
    )


def _with_grams(docs: DataFrame, k: int, w: int) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text")).withColumn(
        "grams", chosen_grams(F.col("text"), k, w)
    )


# Positions below this travel as two bytes each.
_NEAR = 1 << 16


def _packed(df: DataFrame) -> DataFrame:
    """`grams` as hashes of four bytes and positions of two, or four in a long text; half of a shuffle is grams."""
    place = F.transform("grams", gram_position)
    near = F.col("n_chars") <= _NEAR
    return df.withColumns(
        {
            "hashes": F.transform("grams", lambda x: gram_hash(x).cast("int")),
            "near": F.when(near, F.transform(place, lambda p: (p - _NEAR // 2).cast("smallint"))),
            "far": F.when(~near, place.cast("array<int>")),
        }
    ).drop("grams")


def _unpacked(hashes: Column, near: Column, far: Column) -> Column:
    """The longs that `_packed` had."""

    def whole(place: Callable[[Column], Column]) -> Column:
        return F.transform(
            hashes, lambda h, i: F.shiftleft(h.cast("long"), 32) + (F.lit(_POSITIONS) - place(i))
        )

    return F.when(near.isNotNull(), whole(lambda i: F.get(near, i).cast("long") + _NEAR // 2)).otherwise(
        whole(lambda i: F.get(far, i).cast("long"))
    )


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """(doc_id, row, text, n_chars, grams) of every row of `docs` (doc_id, text).

    `grams` are the chosen k-grams; `gram_hash` and `gram_position` read them. Equal texts have equal
    ones. `row` tells rows of one doc_id apart; identical rows give equal results. NULL
    texts count as empty.
    """
    return _with_grams(_keyed(docs), k, w)


def edited_fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the last third of its characters (rounded down) replaced by as many
    of the first of the next document in descending doc_id; of a shorter one by all. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and `positions`, those of
    the fingerprint's hashes. For a row without doc_id there is no next document: its
    third is replaced by nothing, and near_next is 0. Identical rows follow each other.
    """
    keyed = _keyed(docs)
    packed = ["hashes", "near", "far"]
    chained = with_next(
        keyed, ["text", "n_chars", *packed], lambda df: _packed(_with_grams(df, k, w))
    ).select(
        "doc_id",
        "text",
        "n_chars",
        _unpacked(*map(F.col, packed)).alias("grams"),
        F.when(
            F.col("next").isNotNull(),
            F.struct("next.text", "next.n_chars", _unpacked(*[F.col(f"next.{c}") for c in packed]).alias("grams")),
        ).alias("next"),
    )
    lone = _with_grams(keyed.filter("doc_id IS NULL"), k, w).drop("row").withColumn(
        "next", F.lit(None).cast(chained.schema["next"].dataType)
    )
    both = chained.union(lone.select(*chained.columns))
    # Sizes as columns: inside a function over an array they would be worked out for each element.
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    both = both.select(
        "doc_id",
        "n_chars",
        "grams",
        F.col("next").isNull().alias("lone"),
        F.coalesce("next.grams", F.array().cast("array<bigint>")).alias("next_grams"),
        F.substring("text", F.lit(1), F.col("n_chars") - cut).alias("head"),
        F.substring(F.coalesce("next.text", F.lit("")), F.lit(1), cut).alias("tail"),
        (F.col("n_chars") - cut).alias("head_size"),
        F.coalesce(F.least(cut, "next.n_chars"), F.lit(0)).alias("tail_size"),
    )
    edited = both.select(
        "doc_id",
        "n_chars",
        "grams",
        "lone",
        "next_grams",
        distinct_hashes(F.col("grams")).alias("own"),
        F.sha2(F.concat("head", "tail"), 256).alias("edited_sha256"),
        joined_grams(
            F.col("head"), F.col("grams"), F.col("head_size"),
            F.col("tail"), F.col("next_grams"), F.col("tail_size"), k, w,
        ).alias("edited_grams"),
    )
    return edited.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint(F.col("grams")).alias("fingerprint"),
        fingerprint(F.col("edited_grams")).alias("edited_fingerprint"),
        _let(distinct_hashes(F.col("edited_grams")), lambda x: _alike(F.col("own"), x)).alias("near_edited"),
        F.when(F.col("lone"), F.lit(0.0))
        .otherwise(_let(distinct_hashes(F.col("next_grams")), lambda x: _alike(F.col("own"), x)))
        .alias("near_next"),
        F.transform("grams", gram_position).alias("positions"),
    )
