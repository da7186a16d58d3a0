"""The merge run finds all pairs that its rules say, as groups where it can."""

import __spark_entry__ as e
from quadrille import terms
from quadrille.operators import merge, resolve

PARTS = [(1, "a", 5, "B", "K"), (2, "b", 5, "B", "K"), (12, "c", 5, "B", "K"), (4, "c", 5, "B", "L"), (6, "d", 6, "B", "K")]


def tables(spark, path):
    spark.createDataFrame(PARTS, "p_partkey long, p_name string, p_size int, p_brand string, p_type string").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame([(1, 7), (1, 7), (2, 7), (4, 7), (12, 8), (6, 7), (None, 7), (2, None)], "l_partkey long, l_suppkey long").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_pairs_of_a_kind_whatever_their_remainder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(resolve, "agreeing", None)  # groups say it all: no pairs are made
    found = {r["rule"]: (r["pairs"], r["resources"], r["suspicious"]) for r in e.queries()["merge_statistics"](spark, tables(spark, tmp_path)).collect()}
    assert found == {"by-brand": (2, 2, False), "by-kind": (6, 3, False), "transitive": (4, 3, False), "offers": (6, 3, False)}


def test_a_long_chain_is_closed(spark):
    n = 600
    rows = [(f"http://t/{k:04}", p, o) for k in range(n) for p, o in ((terms.TYPE, "http://t/K"), ("http://t/a", str(k // 2)), ("http://t/b", str((k + 1) // 2)))]
    q = terms.quads(spark.createDataFrame([(s, p, o, "iri" if "://" in o else "lit") for s, p, o in rows], "s string, p string, o string, o_kind string"))
    _, statistics = merge.run(q, [merge.MergeRule(p, "http://t/K", (merge.Atom(f"http://t/{p}"),)) for p in "ab"])
    assert {r["rule"]: r["pairs"] for r in statistics.collect()} == {"a": n, "b": n - 2, "transitive": n * (n - 1) - 2 * n + 2}


def test_groups_become_pairs_when_a_rule_needs_it(spark):
    told = [("a1", "code", "1"), ("a2", "code", "1"), ("a3", "code", "2"), ("a2", "tag", "x"), ("a2", "tag", "y"), ("a3", "tag", "y"), ("a4", "tag", "x"), ("a1", "tag", "x")]
    rows = [(f"http://t/{s}", f"http://t/{p}", o, "lit") for s, p, o in told] + [(f"http://t/a{k}", terms.TYPE, "http://t/K", "iri") for k in range(1, 5)]
    q = terms.quads(spark.createDataFrame(rows, "s string, p string, o string, o_kind string"))
    same, statistics = merge.run(q, [merge.MergeRule(p, "http://t/K", (merge.Atom(f"http://t/{p}"),)) for p in ("code", "tag")])
    found = {(r["x"][-1] + r["y"][-1]): r["rule"] for r in same.collect()}
    expected = {"12": "code", "23": "tag", "24": "tag", "14": "tag", "13": "transitive", "34": "transitive"}
    assert found == expected | {k[::-1]: v for k, v in expected.items()} and same.count() == 12
    assert {r["rule"]: r["pairs"] for r in statistics.collect()} == {"code": 2, "tag": 6, "transitive": 4}


def test_pairs_within_a_large_class(spark, monkeypatch):
    rows = spark.createDataFrame([(x, x % 3) for x in range(40)], "x long, root long")
    monkeypatch.setattr(resolve, "PAIRS_A_TASK", 20)
    assert sorted((r["x"], r["x_y"]) for r in resolve.within(rows).collect()) == [(x, y) for x in range(40) for y in range(40) if x % 3 == y % 3]


def test_statements_of_one_row_are_not_joined(spark, tmp_path, monkeypatch):
    """Unless rows share a subject: then any statement of it goes with any other."""
    monkeypatch.setattr(merge.Evaluation, "agreed", None)
    assert e.queries()["merge_statistics"](spark, tables(spark, tmp_path / "a")).count() == 4
    monkeypatch.undo()
    monkeypatch.setattr("test_whole.PARTS", [(1, "a", 5, "B", "K"), (1, "b", 6, "C", "L"), (2, "a", 6, "B", "M")])
    found = {r["rule"]: r["pairs"] for r in e.queries()["merge_statistics"](spark, tables(spark, tmp_path / "b")).collect()}
    assert found == {"by-brand": 2, "offers": 2}
