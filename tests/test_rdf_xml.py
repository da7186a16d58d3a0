"""RDF/XML documents as statements, against statements written out by hand."""

from quadrille import terms
from quadrille.sources import files

HEAD = f'<rdf:RDF xmlns:rdf="{terms.RDF}" xmlns:x="http://x/" xml:base="http://b/doc" xml:lang="en">'


def read(spark, *sources):
    rows = files.rdf_xml(spark.createDataFrame(list(enumerate(sources)), "k long, source string"), "k", "source")
    return {(r["s"], r["p"], r["o"], r["o_kind"], r["o_dt"], r["o_lang"]) for r in rows.collect()}


def test_forms(spark):
    body = (
        '<x:Person rdf:about="#a" x:nick="A"><x:name>Ann</x:name><x:age rdf:datatype="http://i">7</x:age><x:knows rdf:resource="http://o/b"/><x:knows><x:Person rdf:about="http://o/c" xml:lang="fr"><x:name>Cé</x:name></x:Person></x:knows></x:Person>'
        '<rdf:Description rdf:nodeID="n"><x:has rdf:parseType="Resource"><x:v>1</x:v></x:has><x:list rdf:parseType="Collection"><rdf:Description rdf:about="http://o/1"/></x:list><x:bag><rdf:Bag><rdf:li>q</rdf:li><rdf:li>r</rdf:li></rdf:Bag></x:bag></rdf:Description>'
    )
    a, n, lit, i = "http://b/doc#a", "_:0-n", "lit", "iri"
    found = read(spark, HEAD + body + "</rdf:RDF>")
    assert {
        (a, terms.TYPE, "http://x/Person", i, None, None), (a, "http://x/nick", "A", lit, None, "en"), (a, "http://x/name", "Ann", lit, None, "en"), (a, "http://x/age", "7", lit, "http://i", None), (a, "http://x/knows", "http://o/b", i, None, None),
        (a, "http://x/knows", "http://o/c", i, None, None), ("http://o/c", terms.TYPE, "http://x/Person", i, None, None), ("http://o/c", "http://x/name", "Cé", lit, None, "fr"), (n, "http://x/has", "_:0-at1.0", i, None, None), ("_:0-at1.0", "http://x/v", "1", lit, None, "en"),
        (n, "http://x/list", "_:0-at1.1.0", i, None, None), ("_:0-at1.1.0", terms.RDF + "first", "http://o/1", i, None, None), ("_:0-at1.1.0", terms.RDF + "rest", terms.RDF + "nil", i, None, None), (n, "http://x/bag", "_:0-at1.2", i, None, None),
        ("_:0-at1.2", terms.TYPE, terms.RDF + "Bag", i, None, None), ("_:0-at1.2", terms.RDF + "_1", "q", lit, None, "en"), ("_:0-at1.2", terms.RDF + "_2", "r", lit, None, "en"),
    } == found


def test_odd_documents(spark):
    assert read(spark, None, "", "<a", HEAD + "</rdf:RDF>") == set()
    deep = "".join(f'<x:N rdf:about="http://o/{k}"><x:p>' for k in range(3000)) + "</x:p></x:N>" * 3000
    assert len(read(spark, HEAD + deep + "</rdf:RDF>")) == 6000


def test_files(spark, tmp_path):
    (tmp_path / "a.rdf").write_text(HEAD + '<x:N rdf:about="http://o/1"/></rdf:RDF>')
    assert [(r["g"], r["s"]) for r in files.read_rdf_xml(spark, str(tmp_path), "http://g").collect()] == [("http://g", "http://o/1")]
