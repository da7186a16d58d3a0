"""Pairs of rows with one value: each once, without a shuffle of pairs where resources have one row."""

import __spark_entry__
from quadrille.operators import resolve

SF = "/root/testdata/sf0.001"


def plain(rows, differ=False):
    return sorted({(x, y) for x, v, *a in rows for y, w, *b in rows if v == w and x != y and (not differ or a != b)})


def made(df):
    return sorted((r["x"], r["y"]) for r in df.collect())


def test_pairs_come_once(spark):
    rows = [(x, v) for x in range(40) for v in {x % 7, (x * x) % 11 if x % 3 == 0 else x % 7}]
    found = made(resolve.agreeing(spark.createDataFrame(rows, "x long, value int")))
    assert found == plain(rows)
    linked = [(x, x % 5, f"n{n % 4}") for x in range(30) for n in ({x} if x % 2 else {x, x + 1})]
    assert made(resolve.agreeing(spark.createDataFrame(linked, "x long, value int, via string"), ("via",))) == plain(linked, True)
    assert made(resolve.agreeing(spark.createDataFrame([], "x long, value int"))) == []


def test_pairs_of_dates_are_not_shuffled(spark):
    plan = __spark_entry__.queries()["atom_date"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan


def test_a_large_value_is_shared_out(spark, monkeypatch):
    monkeypatch.setattr(resolve, "PAIRS_A_TASK", 100)
    rows = [(x, "much" if x < 80 else f"v{x % 9}") for x in range(120)] + [(200, "much"), (200, "v1")]
    found = resolve.agreeing(spark.createDataFrame(rows, "x long, value string"))
    assert made(found) == plain(rows)
    alone = resolve.agreeing(spark.createDataFrame(rows[:80], "x long, value string"))
    assert sum(n > 0 for n in alone.rdd.glom().map(len).collect()) > 10


def test_pairs_of_intervals_are_not_shuffled(spark):
    plan = __spark_entry__.queries()["atom_interval"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan


def test_a_value_of_one_row_leaves_early(spark, monkeypatch):
    sizes, write = {}, resolve.written

    def counted(df, name):
        table = write(df, name)
        sizes.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(resolve, "written", counted)
    rows = [(x, f"v{x}") for x in range(50)] + [(x, "shared") for x in range(3)]
    assert made(resolve.agreeing(spark.createDataFrame(rows, "x long, value string"))) == plain(rows)
    assert sizes["agreeing"] == [53, 3]


def test_ends_of_an_interval_meet_their_times_before_each_other(spark, monkeypatch):
    monkeypatch.setattr(resolve, "agreeing", lambda rows, differ: rows)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = __spark_entry__.queries()["atom_interval"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") <= 10
