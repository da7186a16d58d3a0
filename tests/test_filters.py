"""What a harvest leaves behind; and small operators of sources, selection and migration."""

import urllib.error

import pytest
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.functions import scalars
from quadrille.operators import migrate, rewrite, select
from quadrille.plans import filters as L
from quadrille.plans.rules import Rule, same_statements
from quadrille.plans.patterns import scan
from quadrille.sources import services
from quadrille.terms import BIBO, FOAF, LABEL, OWL, TYPE, VCARD, VIVO

N = "http://t/"


def make(spark, rows):
    data = [(N + s, p if "/" in p else N + p, N + o[1:] if o.startswith(":") else o, "iri" if o.startswith((":", "http")) else "lit") for s, p, o in rows]
    return terms.quads(spark.createDataFrame(data, "s string, p string, o string, o_kind string"))


def gone(spark, rows):
    """The irrelevant resources of a graph in which something points to everything."""
    names = {s for s, _, _ in rows}
    q = make(spark, rows + [("all", "lists", f":{x}") for x in names])
    return {r["x"].removeprefix(N): r["pointed"] for r in L.irrelevant(q).collect()}


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([("x", TYPE, FOAF + "Document"), ("y", TYPE, OWL + "Class"), ("z", TYPE, OWL + "ObjectProperty"), ("v", TYPE, OWL + "DatatypeProperty"), ("w", TYPE, OWL + "AnnotationProperty")], {x: False for x in "xyzvw"}),
        ([("o", TYPE, L.ORGANIZATION)], {"o": True}),
        ([("o", TYPE, L.ORGANIZATION), ("o", L.RELATED_BY, ":p"), ("p", TYPE, L.POSITION), ("p", L.RELATES, ":x"), ("x", TYPE, L.PERSON), ("x", L.BEARS, ":r"), ("r", L.RELATED_BY, ":g"), ("g", TYPE, L.GRANT)], {}),
        ([("o", TYPE, L.ORGANIZATION), ("g", TYPE, L.GRANT), ("g", VIVO + "assignedBy", ":o"), ("o2", TYPE, L.ORGANIZATION), ("o2", VIVO + "assigns", ":g"), ("o3", TYPE, L.ORGANIZATION), ("o3", L.BEARS, ":r"), ("r", L.RELATED_BY, ":g")], {}),
        ([("x", TYPE, L.PERSON), ("x", L.RELATED_BY, ":a"), ("a", TYPE, L.AUTHORSHIP), ("a", L.RELATES, ":x")], {"x": True, "a": True}),
        ([("r", TYPE, L.ROLE), ("r", L.REALIZED_IN, ":j"), ("j", TYPE, L.PROJECT), ("j", TYPE, L.PROCESS), ("s", TYPE, L.ROLE), ("k", TYPE, L.PROCESS), ("m", TYPE, L.PROJECT)], {"s": True, "k": True, "m": True}),
        ([("t", TYPE, L.RELATIONSHIP), ("t", L.RELATES, ":x"), ("t", L.RELATES, ":y"), ("u", TYPE, L.RELATIONSHIP), ("u", L.RELATES, ":x"), ("v", TYPE, L.RELATIONSHIP)], {"u": True, "v": True}),
    ],
)
def test_what_is_irrelevant(spark, rows, expected):
    assert gone(spark, rows) == expected


def test_rounds(spark):
    """An authorship without document goes, then its document and person, then the position, then the organization; a lone card goes with its parts."""
    q = make(spark, [
        ("a", TYPE, L.AUTHORSHIP), ("a", L.RELATES, ":x"), ("d", TYPE, BIBO + "Document"), ("d", L.RELATED_BY, ":a"), ("x", L.RELATED_BY, ":a"), ("x", TYPE, L.PERSON), ("p", TYPE, L.POSITION), ("p", L.RELATES, ":x"), ("o", L.RELATED_BY, ":p"), ("o", TYPE, L.ORGANIZATION), ("x", L.RELATED_BY, ":p"), ("keep", "cites", ":o"), ("keep", "cites", ":d"),
        ("c", TYPE, VCARD + "Kind"), ("c", VCARD + "hasEmail", ":e"), ("e", VCARD + "email", "m"), ("keep", LABEL, "K"),
    ])
    left = L.relevant_part(q)
    assert {(r["s"], r["p"]) for r in left.collect()} == {(N + "keep", LABEL)}
    assert L.relevant_part(left).count() == 1


def test_describe_and_subjects(spark):
    blank, deep = "n" + "0" * 16, "n" + "a" * 16
    q = make(spark, [("r", "atom", f":{blank}"), (blank, "part", f":{deep}"), (deep, LABEL, "x"), ("r", "to", ":other"), ("other", LABEL, "y"), ("r", TYPE, ":Rule")])
    found = select.describe(q, spark.createDataFrame([(N + "r",)], "x string"))
    assert {r["s"].removeprefix(N) for r in found.select("s").collect()} == {"r", blank, deep}
    assert [r["x"] for r in select.subjects(q).collect()] == [N + "r"] and select.subjects(q, N + "None").count() == 0


def test_rename_by_link(spark):
    q = make(spark, [("b1", "href", "http://g/1"), ("b1", LABEL, "one"), ("b2", "href", "http://g/2"), ("x", "to", ":b2"), ("b3", "href", "")])
    out = rewrite.rename_by_link(q, N + "href")
    assert {r["s"] for r in out.select("s").collect()} == {"http://g/1", N + "b2", N + "x", N + "b3"}


def test_same_statements_and_encoding(spark):
    q = make(spark, [("a", "p", "1"), ("b", "p", "2")])
    assert same_statements(q, q.orderBy("s")) and not same_statements(q, q.limit(1)) and not same_statements(q.limit(1), q)
    assert spark.range(1).select(scalars.url_encoded(F.lit("a b&é"))).first()[0] == "a+b%26%C3%A9"


def test_update_runs_in_order(spark):
    q = make(spark, [("a", TYPE, ":Old"), ("a", "p", "1"), ("a", "gone", "2")])
    out = migrate.update(
        q, [migrate.Change(N + "Old", N + "New", True), migrate.Change(N + "p", N + "q", True)], {N + "Old"},
        additions=[Rule("one", lambda x: scan(x, "?x", TYPE, N + "Old"), (("?x", N + "was", N + "Old"), ("?x", N + "bad", "not an iri")))], deletions=[lambda x: x.where(F.col("p") == N + "gone")],
        post_additions=[Rule("two", lambda x: scan(x, "?x", N + "q", "?v"), (("?x", N + "copy", "?v"),))], post_deletions=[lambda x: x.where(F.col("p") == N + "was")],
    )
    assert {(r["p"].removeprefix(N), r["o"].removeprefix(N)) for r in out.collect()} == {(TYPE, "New"), ("q", "1"), ("copy", "1")}


def test_token_pages(spark, tmp_path):
    page = lambda k, token: f"<r><id>h{k}</id><id>h{k % 2}</id><resumptionToken size='3'>{token}</resumptionToken></r>"
    (tmp_path / "first.xml").write_text(page(0, "t!10!x!y!z"))
    (tmp_path / "t!10!x!y!z.xml").write_text(page(1, "t!20!x!y!z"))
    (tmp_path / "t!30!x!y!z.xml").write_text(page(3, ""))
    at, pattern = f"file://{tmp_path}", "<resumptionToken[^>]*>([^<]*)<"
    spark.dataSource.register(services.TokenSource)
    read = spark.read.format("tokens").options(url=f"{at}/first.xml", token_url=at + "/{token}.xml", pattern=pattern, spacing=0, retries=0)
    found = [(r["page"], r["token"], r["body"] is None) for r in read.option("step", 10).load().collect()]
    assert found == [(0, None, False), (1, "t!10!x!y!z", False), (2, "t!20!x!y!z", True), (3, "t!30!x!y!z", False)]
    assert read.option("limit", 2).load().count() == 2
    with pytest.raises(Exception):
        read.option("limit", 9).option("step", 0).load().collect()
    (tmp_path / "h0.txt").write_text("zero")
    (tmp_path / "h1.txt").write_text("one")
    pages = read.option("limit", 4).option("step", 10).load()
    assert {(r["hit"], r["body"]) for r in services.hits(pages, "<id>([^<]*)</id>", at + "/{hit}.txt", 0, 0).collect()} == {("h0", "zero"), ("h1", "one"), ("h3", None)}
    assert services.limited(pages, 1).count() == 1 and services.limited(pages, None).count() == 4


def test_tokens_that_cannot_be_guessed():
    assert services.next_token("a!5!b", 50) == "a!55!b" and services.next_token("a!5", 5) == "a!10" and services.next_token("abc", 5) is None and services.next_token("a!x!b", 5) is None


def test_final_answers_are_not_tried_again(monkeypatch):
    monkeypatch.setattr(services.time, "sleep", lambda s: None)
    calls = []

    def get(url):
        calls.append(url)
        raise urllib.error.HTTPError(url, 404 if len(calls) > 1 else 503, "", {}, None)

    with pytest.raises(urllib.error.HTTPError):
        services.fetch("http://x", get=get)
    assert len(calls) == 2
