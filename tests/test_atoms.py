"""Atoms and the merges that follow from others, on a few statements."""

import pytest
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators import atoms, resolve
from quadrille.terms import LABEL, TYPE, VCARD, VIVO

N = "http://t/"


@pytest.fixture(scope="module")
def q(spark):
    rows = []

    def add(s, p, o):
        rows.append((N + s, p, N + o[1:] if o.startswith(":") else o, "iri" if o.startswith((":", "http")) else "lit"))

    for x, work, rank in (("p1", "w1", "1"), ("p2", "w2", "1"), ("p3", "w2", "2")):
        add(f"a-{x}", TYPE, VIVO + "Authorship"), add(f"a-{x}", VIVO + "rank", rank), add(f"a-{x}", VIVO + "relates", f":{x}"), add(f"a-{x}", VIVO + "relates", f":{work}")
        add(f"a-{x}", atoms.MOST_SPECIFIC, VIVO + "Authorship"), add(x, atoms.CONTACT, f":c-{x}"), add(f"c-{x}", atoms.HAS_NAME, f":n-{x}"), add(f"n-{x}", VCARD + "familyName", "Dune"), add(f"n-{x}", VCARD + "givenName", "A" if x != "p3" else "B")
        add(f"c-{x}", VCARD + "hasEmail", f":e-{x}"), add(f"e-{x}", VCARD + "email", "d@x" if x != "p3" else "e@x"), add(x, TYPE, ":Person")
        add(f"r-{x}", atoms.BEARER, f":{x}"), add(f"r-{x}", atoms.REALIZED_IN, ":project"), add(f"r-{x}", TYPE, ":Role"), add(f"r-{x}", atoms.MOST_SPECIFIC, ":Role")
    add("r-p2", LABEL, "labelled")
    for x, end in (("i1", "2020"), ("i2", "2020"), ("i3", "2021")):
        add(x, VIVO + "dateTimeInterval", f":{x}d"), add(f"{x}d", VIVO + "start", f":{x}s"), add(f"{x}s", VIVO + "dateTime", "2019"), add(f"{x}d", VIVO + "end", f":{x}e"), add(f"{x}e", VIVO + "dateTime", end)
        add(x, VIVO + "dateTimeValue", f":{x}s"), add(f"{x}s", VIVO + "dateTimePrecision", f":{'year' if x != 'i2' else 'day'}")
    add("lone", TYPE, ":Card"), add("held", TYPE, ":Card"), add("x", "http://t/has", ":held")
    return terms.quads(spark.createDataFrame(rows, "s string, p string, o string, o_kind string"))


@pytest.fixture(scope="module")
def roots(spark):
    return resolve.classes(spark.createDataFrame([(N + "w1", N + "w2"), (N + "p1", N + "p2"), (N + "c-p1", N + "c-p2")], "x string, y string"))


def pairs(df):
    return {(r["x"].removeprefix(N), r["y"].removeprefix(N)) for r in df.collect() if r["x"] < r["y"]}


def test_dates(q):
    assert pairs(resolve.same_value(atoms.date_interval(q, None))) == {("i1", "i2")}
    assert pairs(resolve.same_value(atoms.date_value(q, None))) == {("i1", "i3")}


def test_contacts_and_names(q):
    assert pairs(resolve.same_value(atoms.contact(q, N + "Person", VCARD + "hasEmail", VCARD + "email"))) == {("p1", "p2")}
    assert pairs(resolve.same_value(atoms.name_part(q, N + "Person", VCARD + "familyName"))) == {("p1", "p2"), ("p1", "p3"), ("p2", "p3")}
    assert pairs(atoms.shared_card_name(q, VCARD + "familyName")) == set()


def test_links_through_equivalence(q, roots):
    assert pairs(resolve.same_value(atoms.through_relationship(q, N + "Person", VIVO + "Authorship"))) == {("p2", "p3")}
    assert len(pairs(resolve.same_value(atoms.through_relationship(q, N + "Person", VIVO + "Authorship", roots)))) == 3
    assert len(pairs(resolve.same_value(atoms.through_role(q, None, N + "Role")))) == 3
    assert {r["x"] for r in atoms.through_role(q, None, N + "Role", process=True).collect()} == {N + "project"}
    assert atoms.object_property(q, None, atoms.CONTACT, roots).where(F.col("value") == N + "c-p2").count() == 0


def test_merges_that_follow(q, roots):
    assert pairs(atoms.same_rank_authors(q, roots)) == {("p1", "p2")}
    assert pairs(atoms.cards_of_equivalents(q, roots)) == {("c-p1", "c-p2")}
    assert pairs(atoms.parts_of_cards(q, roots)) == {("e-p1", "e-p2"), ("n-p1", "n-p2")}
    assert pairs(atoms.relationships(q, roots)) == {("a-p1", "a-p2")}
    assert pairs(atoms.roles(q, roots)) == set()


def test_smallest_and_orphans(spark, q):
    names = atoms.keep_smallest(spark.createDataFrame([("c", "a"), ("c", "b"), ("a", "c")], "x string, y string")).collect()
    assert [(r["old"], r["new"]) for r in names] == [("c", "a")]
    assert {r["s"] for r in atoms.orphans(q, (N + "Card",)).collect()} == {N + "lone"}
