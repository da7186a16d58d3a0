"""Mapping lists on records of a few statements: every expected statement is there, and a second run adds nothing."""

from quadrille import terms
from quadrille.plans import mappings as M
from quadrille.plans.rules import apply_rules
from quadrille.terms import BIBO, FOAF, LABEL, TYPE, VCARD, VIVO

N, G, A = "http://src/", "http://generic/", "http://a/"


def make(spark, rows):
    data = [(A + s, p, A + o[1:] if o.startswith(":") else o, "iri" if o.startswith((":", "http://src")) else "lit") for s, p, o in rows]
    return terms.quads(spark.createDataFrame(data, "s string, p string, o string, o_kind string"))


def run(spark, rows, rules):
    q = make(spark, rows)
    once = apply_rules(q, rules)
    assert apply_rules(once, rules).count() == once.count()
    return {(r["s"].replace(A, ":"), r["p"], r["o"].replace(A, ":")) for r in once.collect()}


def test_project_register(spark):
    out = run(spark, [
        ("p", TYPE, N + "project"), ("p", N + "title", "Rust"), ("p", N + "acronym", "R"), ("p", N + "id", "7"), ("p", N + "startDate", "2020-01-02"), ("p", N + "endDate", "2021-03-04"), ("p", N + "url", "r.org"),
        ("p", N + "relations", ":rel"), ("rel", N + "associations", ":asc"), ("asc", N + "organization", ":o"), ("asc", N + "organization", ":o2"), ("o", N + "legalName", "Org"), ("o", N + "shortName", "O"), ("o", N + "id", "1"), ("o", N + "kind", "coordinator"), ("o", N + "departmentName", "N/A"), ("o", N + "otherDepartmentName", "Soil 2"),
    ], M.project_register(N, N + "kind"))
    assert {(":p", LABEL, "R - Rust"), (":p-grant", VIVO + "identifier", "grant-7"), (":p-dti-end", VIVO + "dateTime", "2021-03-04T00:00:00Z"), (":p-vcard-url", VCARD + "url", "http://r.org"), (":o", TYPE, FOAF + "Organization")} <= out
    assert (":p-coordinator-a/o", TYPE, VIVO + "AdministratorRole") in out and (":p-orgRole-a/o2", M.REALIZED_IN, ":p") in out and (":p-orgRole-a/o", M.REALIZED_IN, ":p") not in out
    assert {x for x in out if x[1] == TYPE and x[2] == FOAF + "AcademicDepartment"} == {(":o-department-Soil2", TYPE, FOAF + "AcademicDepartment")}


def test_grant_workbook(spark):
    out = run(spark, [
        ("g", N + "Project_Title", "Wheat: Rust"), ("g", N + "Funding_Commencement_Year", "2019"), ("g", N + "Funding_Body", "FB"), ("g", N + "Administration_Organisation", "Uni"), ("g", N + "Lead_InvestigatorSplit", ":i"), ("i", G + "firstName", "Ann"), ("i", G + "lastName", "Dune"), ("i", VIVO + "rank", "1"),
        ("g", N + "Email_Address_of_Lead_Investigator", "a@x"),
    ], M.grant_workbook(N, G, "FB", "http://src/FB", "Body", "http://src/same"))
    assert {(":g", N + "localName", "wheat-rust-2019"), (":g-project", LABEL, "Wheat: Rust"), ("http://src/FB", VIVO + "assigns", ":g"), (":g-adminOrgRole", M.BEARER, ":g-adminOrg"), (":g-dti-start", VIVO + "dateTime", "2019-01-01T00:00:00Z"), (":g-pi1", LABEL, "Dune, Ann"), (":g-pi1-vcard-email", VCARD + "email", "a@x")} <= out
    assert not any(s == ":g-dti-end" for s, _, _ in out)


def test_article_index(spark):
    article = lambda x, title: [(x, N + "Ty", "0"), (x, N + "Id", x), (x, N + "D", "2018-05-06"), (x, N + "DN", title)]
    out = run(spark, [
        *article("x", "Leaf rust"), *article("y", "Bread of rye"), *article("z", "Soil"), ("z", N + "F", ":f9"), ("f9", N + "FN", "food"), ("x", N + "AA", ":aa"), ("aa", N + "AuId", "5"), ("aa", N + "S", "2"), ("aa", N + "lastName", "Dune"), ("aa", N + "firstName", "Ann"), ("aa", N + "AfId", "8"), ("aa", N + "AfN", "Uni"),
        ("x", N + "F", ":f"), ("f", N + "FN", "rusts"), ("f", N + "FId", "3"), ("x", N + "S", ":s"), ("s", N + "U", "http://u"), ("s", G + "position", "1"),
    ], M.article_index(N, G + "position", G, ("bread",), ("food",)))
    assert {s for s, p, o in out if (p, o) == (TYPE, BIBO + "Article")} == {":x"}
    assert {(":x-dtv", VIVO + "dateTime", "2018-05-06T00:00:00"), (":x-authorship2", VIVO + "rank", "2"), (M.HOME + "msracad-5", LABEL, "Dune, Ann"), (M.HOME + "msracad-8", LABEL, "Uni"), (":x", VIVO + "hasSubjectArea", M.HOME + "msracad-3"), (":x-vcard-url1", VCARD + "url", "http://u")} <= out


def test_profile_service(spark):
    W, C, P = N + "work/", N + "common/", N + "personal/"
    out = run(spark, [
        ("w", TYPE, W + "work"), ("w", W + "type", "book"), ("v", TYPE, W + "work"), ("v", W + "type", "unheard-of"), ("w", G + "path", "/0000-1/work/9"), ("me", G + "path", "/0000-1/person"), ("me", P + "name", ":n"), ("n", P + "family-name", "Dune"), ("n", P + "given-names", "Ann"),
        ("w", W + "contributors", ":cs"), ("cs", W + "contributor", ":c1"), ("c1", G + "position", "3"), ("c1", W + "credit-name", "Dune, A."), ("w", W + "title", ":t"), ("t", C + "title", "On rust"), ("w", C + "publication-date", ":d"), ("d", C + "year", "2017"),
        ("w", C + "external-ids", ":e"), ("e", C + "external-id", ":e1"), ("e1", C + "external-id-type", "doi"), ("e1", C + "external-id-value", "10.1/x"), ("w", W + "journal-title", "J of R"), ("w", W + "url", "http://u"),
    ], M.profile_service(W, C, G, P, G + "position"))
    me = M.HOME + "orcid-0000-1"
    assert {(":w", TYPE, BIBO + "Book"), (":v", TYPE, BIBO + "Document"), (":w-authorship-DuneA", VIVO + "rank", "3"), (me, VIVO + "orcidId", "https://orcid.org/0000-1"), (me, LABEL, "Dune, Ann"), (me, terms.SAME_AS, ":w-author-DuneA")} <= out
    assert {(":w-authorship-0000-1", VIVO + "rank", "3"), (":w", LABEL, "On rust"), (":w-year", VIVO + "dateTime", "2017-01-01T00:00:00Z"), (":w", BIBO + "doi", "10.1/x"), (M.HOME + "orcid-journal-J-of-R", LABEL, "J of R"), (":w-vcard-url", VCARD + "url", "http://u")} <= out
    assert (":w", TYPE, BIBO + "Document") not in out
