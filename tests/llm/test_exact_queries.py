"""Queries that SQL expresses, against that SQL; and on texts that the tables lack."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from oracle import MEDIUM, SMALL, oracle, rows_of

import __spark_entry__ as driver
from starflow.llm import queries as llm

SQL = llm.oracle_sql()


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name, sf_dir):
    assert rows_of(driver.queries()[name](spark, sf_dir)) == oracle(sf_dir, SQL[name])


def _random_texts(seed):
    """Many short repeats: copies, shared passages, runs, lines that differ in case and blanks."""
    draw = random.Random(seed)
    words = ["a", "b", "The", "the", "é", "n\x0b", "longer", "Ω x"]
    passages = [" ".join(draw.choices(words, k=draw.randint(18, 45))) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [
            draw.choice(passages) if draw.random() < 0.5 else " ".join(draw.choices(words, k=draw.randint(0, 30)))
            for _ in range(draw.randint(0, 4))
        ]
        texts.append(draw.choice(["\n", " ", " \n\t"]).join(parts))
    return texts + draw.choices(texts, k=20) + [None, "", " ", "a " * 60]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("name", sorted(name for name, sql in SQL.items() if "documents" in sql))
def test_random_texts_equal_the_sql(spark, tmp_path, name, seed):
    texts = _random_texts(seed)
    ids = random.Random(seed).sample(range(-50, 500), len(texts))
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    docs.repartition(5).write.parquet(str(tmp_path / "docs"))
    spark.read.parquet(str(tmp_path / "docs")).coalesce(1).write.parquet(str(tmp_path / "one"))
    part = next(Path(tmp_path / "one").glob("*.parquet"))
    part.rename(tmp_path / "documents.parquet")
    got = rows_of(driver.queries()[name](spark, str(tmp_path)))
    assert got == oracle(str(tmp_path), SQL[name])


def test_every_operator_has_a_query():
    names = [name for name in driver.queries() if name.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()
