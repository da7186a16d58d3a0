"""Every core query against its SQL twin, on the smallest tables; and the driver's contract."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from quadrille import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    return float(x) if isinstance(x, Decimal) else x


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql_twin(spark, duck, name):
    found = queries.QUERIES[name](spark, SF)
    twin = duck.execute(queries.SQL[name])
    columns = [d[0] for d in twin.description]
    assert sorted(found.columns) == sorted(columns)
    mine = sorted(repr([plain(r[c]) for c in sorted(columns)]) for r in found.collect())
    theirs = sorted(repr([plain(dict(zip(columns, r, strict=True))[c]) for c in sorted(columns)]) for r in twin.fetchall())
    assert mine == theirs


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert set(queries.QUERIES) == set(queries.SQL)
    assert os.path.isdir(SF)


def test_titles_of_all_lines(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = {(r["doc_id"], r["line"]) for r in queries.QUERIES["title_normal_form"](spark, SF).select("doc_id", "line").collect()}
    assert found == {(r["doc_id"], k) for r in documents for k in range((r["text"] or "").count("\n") + 1)}


def test_titled_people_of_all_parts(spark):
    found = queries.QUERIES["split_ranked_people"](spark, SF).collect()
    assert {r["title"] for r in found} == {"Dr", "Prof.", "a/prof", "Mrs", "Ms.", ""}
    assert {r["rank"] for r in found} == {1, 2, 3, 4} and len({r["x"] for r in found}) == spark.read.parquet(f"{SF}/part.parquet").count()


def test_whole_scopes_of_lines_and_words(spark):
    q = queries.QUERIES
    documents = spark.read.parquet(f"{SF}/documents.parquet").where("trim(text) != ''")
    assert q["csv_split_values_lines"](spark, SF).select("x").distinct().count() == documents.select("doc_id").distinct().count()
    assert q["count_distinct_having_words"](spark, SF).count() > q["count_distinct_having"](spark, SF).count()


def test_patterns_reach_the_scan(spark):
    """A pattern reads the table of its predicate, and of that the key and one column."""
    plan = queries.QUERIES["nested_not_exists"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 5 and "Generate" not in plan and "Union" not in plan
