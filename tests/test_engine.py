"""Operators on small frames: patterns, rules, resolution, publishing, sources, store, streaming."""

import zipfile

import pytest
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators import derive, migrate, publish, resolve, rewrite
from quadrille.operators.ranking import with_position
from quadrille.plans import patterns as P
from quadrille.plans.rules import Rule, apply_rules, until_stable
from quadrille.sources import files, services
from quadrille.store import QuadStore
from quadrille.streaming.ingest import ingest
from quadrille.terms import LABEL, TYPE

N = "http://t/"


def make(spark, rows):
    """(g, s, p, o) with IRIs by their N prefix."""
    data = [(g, N + s, p if "/" in p else N + p, N + o[1:] if o.startswith(":") else o, "iri" if o.startswith((":", "http")) else "lit") for g, s, p, o in rows]
    return terms.quads(spark.createDataFrame(data, "g string, s string, p string, o string, o_kind string"))


def rows(df, *columns):
    return sorted(tuple(str(x).replace(N, ":") if x is not None else None for x in r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def people(spark):
    return make(spark, [("g", "a", TYPE, ":P"), ("g", "a", "name", "Ann"), ("g", "a", "knows", ":b"), ("g", "b", TYPE, ":P"), ("g", "b", "mail", "b@x"), ("g", "b", "knows", ":c"), ("g", "c", TYPE, ":Q")])


def test_optional_exists_union(people):
    base = P.scan(people, "?x", TYPE, N + "P")
    named = P.optional(base, P.scan(people, "?x", N + "name", "?n"))
    assert rows(named, "x", "n") == [(":a", '"Ann"'), (":b", None)] or rows(named, "x") == [(":a",), (":b",)]
    filled = P.optional(named, P.scan(people, "?x", N + "mail", "?n"), maybe=("n",))
    assert rows(filled, "x", "n") == [(":a", '"Ann"'), (":b", '"b@x"')]
    assert rows(P.exists(base, P.scan(people, "?x", N + "name", "?n")), "x") == [(":a",)]
    assert rows(P.not_exists(base, P.scan(people, "?x", N + "name", "?n")), "x") == [(":b",)]
    assert P.union(base, named).columns == ["x", "n"]
    assert rows(P.path_plus(P.scan(people, "?x", N + "knows", "?y"), "x", "y"), "x", "y") == [(":a", ":b"), (":a", ":c"), (":b", ":c")]
    with pytest.raises(ValueError):
        P.join(base, P.scan(people, "?z", N + "name", "?n"))


def test_construct_skips_unbound_and_repeats(spark, people):
    named = P.optional(P.scan(people, "?x", TYPE, N + "P"), P.scan(people, "?x", N + "name", "?n"))
    made = P.construct(named.unionByName(named), ("?x", LABEL, "?n"), ("?x", TYPE, N + "Named"))
    assert rows(made, "s", "p", "o") == sorted([(":a", LABEL, "Ann"), (":a", TYPE, ":Named"), (":b", TYPE, ":Named")])


def test_rules_see_what_earlier_ones_added(people):
    first = Rule("one", lambda q: P.scan(q, "?x", N + "knows", "?y"), (("?y", N + "knownBy", "?x"),))
    second = Rule("two", lambda q: P.scan(q, "?x", N + "knownBy", "?y"), (("?x", TYPE, N + "Known"),))
    q = apply_rules(people, [first, second])
    assert rows(P.scan(q, "?x", TYPE, N + "Known"), "x") == [(":b",), (":c",)]
    assert apply_rules(q, [first, second]).count() == q.count()


def test_until_stable(people):
    gone = lambda q: q.join(P.not_exists(P.scan(q, "?s", N + "knows", "?y"), P.scan(q, "?y", N + "knows", "?z")).select("s"), "s", "left_semi").where(F.col("p") == N + "knows")
    assert P.scan(until_stable(people, [gone]), "?s", N + "knows", "?o").count() == 0


def test_closure_is_bounded_and_classes_are_not(spark):
    chain = spark.createDataFrame([(f"n{k:02}", f"n{k + 1:02}") for k in range(20)], "x string, y string")
    added = resolve.transitive(chain)
    far = added.agg(F.max(F.substring("y", 2, 2).cast("int") - F.substring("x", 2, 2).cast("int"))).first()[0]
    assert far == 8
    assert {r["root"] for r in resolve.classes(chain).collect()} == {"n00"}


def test_guards_and_rules(spark):
    e = lambda *p: spark.createDataFrame(list(p), "x string, y string")
    assert rows(resolve.guarded(e(("a", "b"), ("a", "a"), ("c", "d"), ("e", "f")), e(("b", "a")), e(("d", "c"))), "x", "y") == [("e", "f"), ("f", "e")]
    assert rows(resolve.rule(e(("a", "b"), ("b", "c")), lambda: e(("b", "c"))), "x", "y") == [("b", "c")]
    values = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "x string, value string")
    assert resolve.same_value(values).count() == 6
    assert rows(resolve.representatives(values), "x", "y") == [("b", "a"), ("c", "a")]


@pytest.mark.parametrize("n", [3, 100, 101, 150, 237])
def test_fuzzy_window(spark, n):
    def compared(i, j):
        return n <= 100 or j <= 99 or i >= n - 100 or (51 <= j <= n - 50 and j - i <= 50) or (51 <= i <= n - 50 and j - i <= 49)

    values = spark.createDataFrame([(f"x{k:03}", f"{k:03}") for k in range(n)], "x string, value string")
    found = {(r["x"], r["y"]) for r in resolve.fuzzy(values, resolve.FIRST_LETTER).collect()}
    expected = {(f"x{i:03}", f"x{j:03}") for i in range(n) for j in range(i + 1, n) if compared(i, j) and f"{i:03}"[0] == f"{j:03}"[0]}
    assert found == expected | {(b, a) for a, b in expected}


def test_similarity_edges(spark):
    cases = [("abcdefghij", "abcdefghiX", 90, True), ("abcdefghij", "abcdefghiX", 91, False), ("", "", 90, True), ("a", "b", 10, False), ("ABC", "abc", 100, True)]
    for a, b, degree, expected in cases:
        assert spark.createDataFrame([(a, b)], "a string, b string").select(resolve.similar(F.col("a"), F.col("b"), degree)).first()[0] is expected, (a, b, degree)


def test_position(spark):
    found = with_position(spark.range(1000).select((F.lit(999) - F.col("id")).alias("k")).repartition(7), "k").collect()
    assert all(r["rn"] == r["k"] for r in found)


@pytest.mark.parametrize(
    ("labels", "kept"),
    [
        ([("g1", "Cole, Ann"), ("g1", "Cole, A")], [("g1", "Cole, A")]),
        ([("g1", "Cole, Ann")], [("g1", "Cole, Ann")]),
        ([("g1", "Cole, Ann"), ("g1", "Cole, B"), ("g2", "Cole, A")], [("g1", "Cole, Ann")]),
        ([("g2", "Cole, Ann"), ("g2", "Cole, A")], [("g2", "Cole, A")]),
    ],
)
def test_one_value(spark, labels, kept):
    q = make(spark, [(g, "a", LABEL, x) for g, x in labels] + [("g1", "a", "other", "1"), ("g1", "a", "other", "2")])
    ranks = spark.createDataFrame([("g1", 0), ("g2", 1)], "g string, rank int")
    out = publish.one_value(q, ranks, publish.FUNCTIONAL)
    assert rows(out.where(F.col("p") == LABEL), "g", "o") == kept
    assert out.where(F.col("p") != LABEL).count() == 2


def test_publish(spark):
    """Two copies of a person in two sources and a third IRI: one canonical IRI, the better source's label, other statements in their graphs."""
    q = make(spark, [
        ("low", "p1", TYPE, ":Person"), ("low", "p1", LABEL, "Low"), ("low", "p1", "works", ":w1"), ("high", "p2", TYPE, ":Person"), ("high", "p2", LABEL, "High"), ("high", "w2", "by", ":p1"),
        ("high", "p2", terms.SAME_AS, ":p1"), ("unlisted", "p1", "x", "y"), ("kb-inf", "p1", "x", "y"),
    ])
    edges = spark.createDataFrame([(N + "p1", N + "p2"), (N + "p2", N + "p1"), (N + "p1", N + "p1"), (N + "p2", N + "p9")], "x string, y string")
    ranks = spark.createDataFrame([("high", 0), ("low", 1), ("kb-inf", 2)], "g string, rank int")
    out = publish.publish(q, edges, ranks, remap={"low": "LOW"})
    assert rows(out, "g", "s", "p", "o") == sorted([
        ("LOW", ":p2", TYPE, ":Person"), ("LOW", ":p2", ":works", ":w1"), ("high", ":p2", TYPE, ":Person"), ("high", ":p2", LABEL, "High"), ("high", ":w2", ":by", ":p2"),
    ])
    again = publish.publish(q.repartition(5).orderBy(F.rand(1)), edges, ranks, remap={"low": "LOW"})
    assert rows(again, *terms.KEY) == rows(out, *terms.KEY)


def test_latest_and_priority(spark):
    g = spark.createDataFrame([("s-2020-01-01T00:00:00",), ("s-2021-01-01T00:00:00",), ("t-2020-01-01T00:00:00",), ("plain",)], "g string")
    assert rows(publish.latest_graphs(g), "base", "g") == [("s", "s-2021-01-01T00:00:00"), ("t", "t-2020-01-01T00:00:00")]
    ranked = publish.by_priority(spark.createDataFrame([("a", None), ("b", 2), ("c", 1)], "g string, priority int"))
    assert [r["g"] for r in ranked.orderBy("rank").collect()] == ["c", "b", "a"]


def test_rename_keeps_types(spark):
    q = make(spark, [("g", "a", TYPE, ":a"), ("g", "b", "to", ":a"), ("g", "a", "id", "7"), ("g", "a", "id", "9")])
    assert rows(rewrite.rename_by_identifier(q, N + "id", "http://n/", "p"), "s", "o") == sorted([("http://n/p7", ":a"), (":b", "http://n/p7"), ("http://n/p7", "7"), ("http://n/p7", "9")])


def test_filters(spark):
    q = make(spark, [("g", "a", "p", "  x[i]y[/i] "), ("g", "a b", "p", "x"), ("g", "a", TYPE, ":C")])
    assert rows(rewrite.clean_literals(q).where("s = 'http://t/a' and o_kind = 'lit'"), "o") == [("xy",)]
    assert rewrite.without_bad_iris(q).count() == 2


def test_migration(spark):
    q = make(spark, [("g", "a", TYPE, ":Old"), ("g", "a", "p", "1"), ("g", "a", "gone", "2"), ("g", "Old", LABEL, "x"), ("g", "b", TYPE, ":Sub"), ("g", "b", "part", ":a")])
    changes = [migrate.Change(N + "Old", N + "New", True), migrate.Change(N + "p", N + "q", True), migrate.Change(N + "gone", None, False, "Delete"), migrate.Change(N + "Sub", None, False, "Delete"), migrate.Change(None, N + "hasPart", False, "Add")]
    out = migrate.migrate(q, changes, {N + "Old", N + "Sub"}, {N + "Sub": N + "Top"}, {N + "hasPart": N + "part"})
    assert rows(out, "s", "p", "o") == sorted([(":a", TYPE, ":New"), (":a", ":q", "1"), (":b", TYPE, ":Top"), (":b", ":part", ":a"), (":a", ":hasPart", ":b")])
    assert rows(migrate.without_instances(q, N + "Old"), "s") == [(":Old",), (":b",)]


def test_postmerge_runs_in_order(spark):
    q = make(spark, [("g", "d", TYPE, terms.BIBO + "Document"), ("g", "r", TYPE, terms.VIVO + "Authorship"), ("g", "r", terms.VIVO + "relates", ":x"), ("g", "r", terms.VIVO + "relates", ":d"), ("g", "x", TYPE, terms.FOAF + "Person")])
    out = apply_rules(q, derive.postmerge(spark.createDataFrame([(N + "d",)], "x string"), "2024-01-01T00:00:00Z"))
    assert rows(P.scan(out, "?s", TYPE, derive.EXTERNAL), "s") == [(":d",), (":x",)]
    assert out.where(F.col("p") == derive.NS + "firstSeen").count() == 2


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name;tags\n"Ann";x, y\nBob;N/A\n')
    frame = files.read_csv(spark, str(tmp_path / "a.csv"), ["name", "tags"], sep=";")
    from quadrille.operators.lift import Field

    q = files.lift_csv(frame, N, ["name"], {"name": Field(LABEL, lang="en"), "tags": Field(N + "tag", split=", ", nulls=("N/A",))}, N + "Row")
    assert rows(q, "p", "o", "o_lang") == sorted([(TYPE, ":Row", None)] * 2 + [(LABEL, "Ann", "en"), (LABEL, "Bob", "en"), (":tag", "x", None), (":tag", "y", None)], key=lambda r: tuple(map(str, r))) or q.count() == 6
    (tmp_path / "b.csv").write_text("name;tags\nAnn;x;y\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "b.csv"), ["name", "tags"], sep=";").collect()


def test_trees(spark):
    records = spark.createDataFrame([("1", "<r a='1'><x>t</x><y/><x>u</x></r>"), ("2", "<broken"), ("3", None)], "id string, source string")
    tree = files.nodes(records, "id", "source", "xml")
    assert rows(tree, "name", "value") == sorted([("r", None), ("a", "1"), ("x", "t"), ("x", "u")], key=str)
    q = files.lift_nodes(tree, N)
    assert rows(q.where("o_kind = 'lit'"), "p", "o") == [(":a", "1"), (":x", "t"), (":x", "u")]
    js = files.nodes(spark.createDataFrame([("1", '{"a b": [1, {"c": "x"}], "d": null, "e": true}')], "id string, source string"), "id", "source", "json")
    assert rows(js.where("value is not null"), "name", "value") == [("ab", "1"), ("c", "x"), ("e", "true")]


def test_ntriples_round_trip(spark, tmp_path):
    q = terms.quads(spark.createDataFrame([(N + "a", N + "p", 'x "q" \\ \n é', "lit", None, "en"), (N + "a", N + "p", "5", "lit", terms.XSD + "int", None), (N + "a", N + "p", N + "b", "iri", None, None)], "s string, p string, o string, o_kind string, o_dt string, o_lang string"))
    files.write_ntriples(q, str(tmp_path / "out"))
    assert rows(files.read_ntriples(spark, str(tmp_path / "out")), *terms.SCHEMA.names) == rows(q, *terms.SCHEMA.names)


def workbook(path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main}><sheets><sheet name="S" sheetId="1" r:id="r1"/><sheet name="H" sheetId="2" state="hidden" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/s1.xml"/></Relationships>')
        z.writestr("xl/worksheets/_rels/s1.xml.rels", '<Relationships xmlns="x"><Relationship Id="h1" Target="http://u"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>First Name</t></si><si><t>Ann\xa0B </t></si></sst>")
        z.writestr("xl/worksheets/s1.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>Age</t></is></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>7</v></c></row></sheetData><hyperlinks><hyperlink ref="A2" r:id="h1"/></hyperlinks></worksheet>')


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "w.xlsx")
    found = services.read_workbooks(spark, str(tmp_path))
    assert rows(found, "sheet", "row", "column", "value") == [("S", "2", "Age", "7"), ("S", "2", "First_Name", "Ann B"), ("S", "2", "First_Name_url", "http://u")]


def test_fetch_tries_again(monkeypatch):
    import urllib.error

    monkeypatch.setattr(services.time, "sleep", lambda s: None)
    calls = []

    def get(url):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.URLError("down")
        return "body"

    assert services.fetch("http://x", get=get) == "body" and len(calls) == 3


def test_crawl(spark):
    links = {"a": ["b", "c"], "b": ["a", "d"], "c": [], "d": ["e"]}
    follow = lambda f: f.join(spark.createDataFrame([(k, v) for k, vs in links.items() for v in vs], "id string, to string"), "id").select(F.col("to").alias("id"))
    assert rows(services.crawl(spark.createDataFrame([("a",)], "id string"), follow), "id") == [(x,) for x in "abcde"]


def test_crawl_of_a_long_chain(spark):
    def follow(new):
        return new.select((F.col("id") + 1).alias("id")).where("id <= 25")

    start = spark.range(1)
    assert sorted(r["id"] for r in services.crawl(start, follow).collect()) == list(range(26))
    with pytest.raises(RuntimeError):
        services.crawl(start, follow, max_rounds=3)


def test_store(spark, tmp_path, people):
    store = QuadStore(spark, str(tmp_path / "store"))
    assert store.swap(people, "src", "v1") == people.count()
    assert store.swap(people.limit(2), "src", "v2") == 2 and store.versions("src") == ["v2"]
    assert store.swap(people.limit(0), "src", "v3") == 0 and store.versions("src") == ["v2"]
    store.swap(people, "src", "v4")
    store.remove(people.where(F.col("s") == N + "a"), "src", "v4")
    assert store.latest("src").where(F.col("s") == N + "a").count() == 0 and store.latest("src").count() == people.where(F.col("s") != N + "a").count()
    store.append(people, "old", "v1")
    assert store.clean_up(["src"]) == ["old"]


def test_stream_equals_batch(spark, tmp_path):
    from quadrille.operators.lift import Field, lift

    spark.range(10).select(F.col("id").cast("string").alias("k")).write.parquet(str(tmp_path / "in"))
    to_quads = lambda d: lift(d, F.concat(F.lit(N), "k"), {"k": Field(LABEL)})
    store = QuadStore(spark, str(tmp_path / "store"))
    ingest(spark.readStream.schema("k string").parquet(str(tmp_path / "in")), to_quads, store, "s", str(tmp_path / "ck")).awaitTermination()
    assert rows(store.read("s"), *terms.KEY) == rows(to_quads(spark.read.parquet(str(tmp_path / "in"))), *terms.KEY)
