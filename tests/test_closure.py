"""The bounded closure goes through one node of many alike, and finds what plain rounds find."""

import random

import pytest

from quadrille import terms
from quadrille.operators import merge, resolve


def rounds(edges, n):
    known = {(x, y) for x, y in edges if x != y}
    start = set(known)
    for _ in range(n):
        known |= {(x, z) for x, y in known for w, z in known if y == w and x != z}
    return known - start


def copies(edges, n):
    """Every node n times: copies are linked with each other and alike with others."""
    nodes = {x for e in edges for x in e}
    return [(f"{x}-{i}", f"{y}-{j}") for x, y in edges for i in range(n) for j in range(n)] + [(f"{x}-{i}", f"{x}-{j}") for x in nodes for i in range(n) for j in range(n)]


CHAIN = [(f"{k:02}", f"{k + 1:02}") for k in range(12)]
random.seed(3)
DIRECTED = [(f"{random.randrange(14):02}", f"{random.randrange(14):02}") for _ in range(18)]


@pytest.mark.parametrize("edges", [CHAIN, CHAIN + [(y, x) for x, y in CHAIN], DIRECTED, copies(CHAIN, 2), copies(DIRECTED, 3)])
def test_closure(spark, edges):
    found = [(r["x"], r["y"]) for r in resolve.transitive(spark.createDataFrame(edges, "x string, y string")).collect()]
    assert len(found) == len(set(found)) and set(found) == rounds(edges, 3)


def test_a_closed_class_is_one_node(spark, monkeypatch):
    sizes, write = {}, resolve.written

    def counted(df, name):
        table = write(df, name)
        sizes.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(resolve, "written", counted)
    assert resolve.transitive(spark.createDataFrame([(x, y) for x in range(60) for y in range(60)], "x long, y long")).isEmpty()
    assert max(sizes["closure"]) == 0


def test_rules_that_read_nothing_found_run_once(spark, monkeypatch):
    rows = [(f"http://t/{x}", p, o) for x in "abc" for p, o in ((terms.TYPE, "http://t/K"), ("http://t/code", "1"))]
    q = terms.quads(spark.createDataFrame([(s, p, o, "iri" if "://" in o else "lit") for s, p, o in rows], "s string, p string, o string, o_kind string"))
    ran, rule = [], merge.Evaluation.rule
    monkeypatch.setattr(merge.Evaluation, "rule", lambda self, r: ran.append(r.name) or rule(self, r))
    rules = [merge.MergeRule("code", "http://t/K", (merge.Atom("http://t/code"),)), merge.MergeRule("link", "http://t/K", (merge.Atom(None, "http://t/link"),))]
    same, _ = merge.run(q, rules)
    assert same.count() == 6 and ran == ["code", "link", "link"]


def test_a_closed_set_of_edges_is_not_closed_again(spark, monkeypatch):
    rows = [(f"http://t/{x}", p, o) for x in "abcd" for p, o in ((terms.TYPE, "http://t/K"), ("http://t/code", "1"))]
    q = terms.quads(spark.createDataFrame([(s, p, o, "iri" if "://" in o else "lit") for s, p, o in rows], "s string, p string, o string, o_kind string"))
    calls, transitive = [], resolve.transitive
    monkeypatch.setattr(resolve, "transitive", lambda *a, **k: calls.append(1) or transitive(*a, **k))
    same, _ = merge.run(q, [merge.MergeRule("code", "http://t/K", (merge.Atom("http://t/code"),))])
    assert same.count() == 12 and not calls
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 2)], "x long, y long")
    assert not resolve.closed(edges, resolve.classes(edges))


def test_rules_are_evaluated_again_only_for_objects_whose_class_changed(spark, monkeypatch):
    told = [("a1", "code", '1'), ("a2", "code", '1'), ("b1", "of", "a1"), ("b2", "of", "a2"), ("c1", "in", "b1"), ("c2", "in", "b2"), ("d1", "at", "e"), ("d2", "at", "e")]
    rows = [(f"http://t/{s}", f"http://t/{p}", o if p == "code" else f"http://t/{o}", "lit" if p == "code" else "iri") for s, p, o in told]
    rows += [(f"http://t/{s}", terms.TYPE, f"http://t/{s[0]}", "iri") for s in {s for s, _, _ in told}]
    q = terms.quads(spark.createDataFrame(rows, "s string, p string, o string, o_kind string"))
    made, exact = [], merge.Evaluation.exact
    monkeypatch.setattr(merge.Evaluation, "exact", lambda self, cls, *own: made.append(cls[-1]) or exact(self, cls, *own))
    rules = [merge.MergeRule(f"by-{p}", f"http://t/{cls}", (merge.Atom(None, f"http://t/{p}"),)) for cls, p in (("b", "of"), ("c", "in"), ("d", "at"))]
    same, _ = merge.run(q, [*rules, merge.MergeRule("by-code", "http://t/z", (merge.Atom("http://t/code"),)), merge.MergeRule("by-code", "http://t/a", (merge.Atom("http://t/code"),))], passes=2)
    assert {(r["x"][-2:], r["y"][-2:]) for r in same.collect()} == {(f"{k}{i}", f"{k}{3 - i}") for k in "abcd" for i in (1, 2)}
    assert made.count("d") == 1


def test_classes_of_whole_edges(spark):
    edges = {e for x, y in DIRECTED + CHAIN + copies([("k", "l")], 3) if x != y for e in ((x, y), (y, x))}
    plain, first = (sorted(map(tuple, resolve.classes(spark.createDataFrame(sorted(edges), "x string, y string"), whole=w).collect())) for w in (False, True))
    assert plain == first
    some, rest = [[e for e in sorted(edges) if (min(e) < "05") == small] for small in (True, False)]
    assert sorted(map(tuple, resolve.extended(resolve.classes(spark.createDataFrame(some, "x string, y string")), spark.createDataFrame(rest, "x string, y string")).collect())) == plain


def test_what_a_rule_compares_is_made_once(spark, monkeypatch):
    told = [("a1", "code", "1"), ("a2", "code", "1"), ("b1", "of", "a1"), ("b2", "of", "a2"), ("b2", "of", "a1"), ("b1", "for", "k"), ("b2", "for", "k"), ("b3", "for", "k")]
    rows = [(g, f"http://t/{s}", f"http://t/{p}", o if p == "code" else f"http://t/{o}", "lit" if p == "code" else "iri") for g in "gh" for s, p, o in told]
    rows += [("g", f"http://t/{s}", terms.TYPE, f"http://t/{s[0]}", "iri") for s in {s for s, _, _ in told}]
    q = terms.quads(spark.createDataFrame(rows, "g string, s string, p string, o string, o_kind string"))
    names, write = [], merge.written
    monkeypatch.setattr(merge, "written", lambda df, name: names.append(name) or write(df, name))
    rules = [merge.MergeRule("both", "http://t/b", (merge.Atom(None, "http://t/of"), merge.Atom(None, "http://t/for"))), merge.MergeRule("code", "http://t/z", (merge.Atom("http://t/code"),)), merge.MergeRule("code", "http://t/a", (merge.Atom("http://t/code"),))]
    for r in (rules, [merge.MergeRule("both", "http://t/a", rules[0].atoms), *rules]):
        names.clear()
        same, _ = merge.run(q, r)
        assert sorted((x["x"][-2:], x["y"][-2:]) for x in same.collect()) == [("a1", "a2"), ("a2", "a1"), ("b1", "b2"), ("b2", "b1")]
        assert names.count("values") == len(r) - 2


def test_stored_rows_may_have_repeats(spark):
    rows = [(x, f"v{x % 4}") for x in range(12)] * 2 + [(20 + x, f"w{x}") for x in range(60)]
    for own in (rows, rows[:24]):
        found = sorted(map(tuple, resolve.agreeing(spark.createDataFrame(own, "x long, value string"), stored=True).collect()))
        assert found == sorted({(x, y) for x, v in own for y, w in own if v == w and x != y})
