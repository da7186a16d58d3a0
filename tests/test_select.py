from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators import select
from quadrille.plans.patterns import scan
from quadrille.terms import LABEL, OBO, TYPE, VIVO

N = "http://t/"


def make(spark, rows):
    data = [(N + s, p if "/" in p else N + p, N + o[1:] if o.startswith(":") else o, "iri" if o.startswith((":", "http")) else "lit") for s, p, o in rows]
    return terms.quads(spark.createDataFrame(data, "s string, p string, o string, o_kind string"))


def subjects(df):
    return {r[0].removeprefix(N) for r in df.select("s").distinct().collect()}


def test_search_and_neighbourhood(spark):
    q = make(spark, [("a", "title", "Système agricole"), ("b", "title", "agricoles"), ("a", "by", ":p"), ("p", LABEL, "Ann"), ("p", "at", ":o"), ("o", LABEL, "Org"), ("o", "in", ":c"), ("c", LABEL, "C"), ("b", "by", ":z"), ("z", LABEL, "Zed")])
    assert {r["x"] for r in select.search(q, "Agricole", [N + "title"]).collect()} == {N + "a"}
    part = select.relevant(q, "agricole", [N + "title"])
    assert subjects(part) == {"a", "p", "o"} and part.count() < q.count()


def test_dead_ends(spark):
    q = make(spark, [("r1", TYPE, VIVO + "Position"), ("r1", VIVO + "relates", ":x"), ("x", TYPE, ":Org"), ("r2", TYPE, VIVO + "Position"), ("r2", VIVO + "relates", ":y"), ("y", TYPE, terms.THING), ("p", VIVO + "relatedBy", ":r2")])
    assert subjects(select.without_dead_ends(q, (VIVO + "Position",))) == {"r1", "x", "y"}


def test_positions_move_to_the_top(spark):
    q = make(spark, [("pos", TYPE, VIVO + "Position"), ("pos", VIVO + "relates", ":lab"), ("pos", VIVO + "relates", ":ann"), ("lab", VIVO + "relatedBy", ":pos"), ("lab", LABEL, "Lab"), ("lab", select.PART_OF, ":unit"), ("unit", select.PART_OF, ":inst")])
    out = select.positions_at_top(q, N + "immediate")
    assert {r["o"] for r in scan(out, "?s", VIVO + "relates", "?o").collect()} == {N + "inst", N + "ann"}
    assert out.where((F.col("p") == N + "immediate") & (F.col("o") == "Lab")).count() == 1
    assert {r["s"] for r in scan(out, "?s", VIVO + "relatedBy", "?o").collect()} == {N + "inst"}


def test_people(spark):
    row = spark.createDataFrame([("Dr Ann B Dune; Prof. Bo Low;; Cy ; Dr",)], "t string").select(select.split_people(F.col("t")).alias("p")).first()["p"]
    assert [tuple(p) for p in row] == [("Ann B", "Dune", "Dr", 1), ("Bo", "Low", "Prof.", 2), ("Cy", "", "", 3), ("Dr", "", "", 4)]


def test_smush_and_known(spark):
    q = make(spark, [("a", "mail", "m"), ("b", "mail", "m"), ("b", "x", "1"), ("c", "to", ":b")])
    assert subjects(select.smush(q, N + "mail")) == {"a", "c"}
    k = make(spark, [("a", LABEL, "A"), ("a", OBO + "ARG_2000028", ":card"), ("card", "x", "1"), ("a", "y", "2"), ("b", "to", ":a")])
    out = select.rename_known(k, spark.createDataFrame([(N + "a", N + "known")], "old string, new string"))
    assert subjects(out) == {"known", "b"} and out.count() == 2
