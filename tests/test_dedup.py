from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starflow.operators import distinct_rows, first_row_per_key

SCHEMA = "k string, note string, t int, id string"
rows = st.lists(
    st.tuples(
        st.sampled_from([None, "a", "b", ""]),
        st.sampled_from([None, "x", "y"]),
        st.one_of(st.none(), st.integers(0, 3)),
        st.sampled_from([None, "1", "10", "2"]),
    ),
    min_size=1,
    max_size=30,
)


def rank(row):
    """NULLs last in the ordering columns, first among the columns that break ties."""
    _, note, t, id_ = row
    return (t is None, t or 0, id_ is None, id_ or "", note is not None, note or "")


def by_brute_force(data):
    first = {}
    for row in data:
        if row[0] not in first or rank(row) < rank(first[row[0]]):
            first[row[0]] = row
    return sorted(first.values(), key=str)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_first_row_per_key_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    first = first_row_per_key(df, ["k"], ["t", "id"])
    assert first.columns == df.columns
    assert sorted((tuple(r) for r in first.collect()), key=str) == by_brute_force(data)


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    data = [(f"k{i % 7}" if i % 3 else None, f"n{i % 5}", i % 2, str(i % 4)) for i in range(500)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(data, SCHEMA).repartition(int(partitions))
        first = first_row_per_key(df, ["k"], ["t", "id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in first), key=str) == by_brute_force(data)


def test_several_keys_and_an_ordering_key(spark):
    df = spark.createDataFrame([(1, 2, "b", 5), (1, 2, "a", 6), (1, 3, "c", 7)], "x int, y int, z string, w int")
    first = first_row_per_key(df, ["x", "y"], ["y", "z"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, 2, "a", 6), (1, 3, "c", 7)]


def test_distinct_rows_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), ("", "a")], "x string, y string")
    assert distinct_rows(df).count() == 2


def test_a_hot_key_leaves_one_row_per_task(spark):
    """A third of the rows share the NULL key; each task sends on at most one of them."""
    tasks = 8
    df = spark.range(0, 90_000, numPartitions=tasks).selectExpr(
        "if(id % 3 = 0, null, concat('u', id % 50)) AS k", "concat('n', id % 9) AS note", "id AS t"
    )
    first = first_row_per_key(df, ["k"], ["t"])
    first.collect()
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    shuffled = _shuffle_records(first)
    assert shuffled <= tasks * 51
    assert first.filter("k IS NULL").first().t == 0


def _shuffle_records(df) -> int:
    """Records written by the shuffles of a plan that has run."""

    def visit(node) -> int:
        written = node.metrics().get("shuffleRecordsWritten")
        here = written.get().value() if written.isDefined() else 0
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if "QueryStage" in name:
            return visit(node.plan())
        children = node.children()
        return here + sum(visit(children.apply(i)) for i in range(children.size()))

    return visit(df._jdf.queryExecution().executedPlan())


def test_columns_may_have_any_name(spark):
    names = ["x.y", "first", "a`b", "k0", "p1"]
    df = spark.createDataFrame([(1, "b", 2, "k", 5), (1, "a", 1, "k", 6)], ["k", "n", "t", "i", "j"])
    first = first_row_per_key(df.toDF(*names), ["x.y"], ["a`b", "first"])
    assert first.columns == names
    assert [tuple(r) for r in first.collect()] == [(1, "a", 1, "k", 6)]


def test_a_key_alone_is_enough(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert sorted(first_row_per_key(df, ["k"], []).collect(), key=str) == [(1,), (None,)]


def test_map_columns_are_refused_by_name(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 1) AS tags")
    with pytest.raises(ValueError, match="tags"):
        first_row_per_key(df, ["k"], ["k"])
