"""Mapping lists of harvested sources on records of a few statements; a second run adds nothing, but for things that the first rule of the register then sees."""

from test_mappings import A, G, N, make, run

from quadrille.plans import harvests as H
from quadrille.plans.rules import apply_rules, minus
from quadrille.terms import BIBO, FOAF, LABEL, OBO, THING, TYPE, VCARD, VIVO

V, K = G + "value", G + "position"


def test_harvested_repository(spark):
    out = run(spark, [
        ("d", N + "itemType", "ARTICLE"), ("d", N + "identifier", "7"), ("e", N + "itemType", "ARTICLE"), ("e", N + "articleInfos", ":i"), ("i", N + "articleType", "Editorial"), ("f", N + "itemType", "CHAPTER"), ("g", N + "itemType", "MAP"),
        ("d", N + "creator", ":c1"), ("d", N + "creator", ":c2"), ("c1", N + "author", ":p1"), ("c2", N + "author", ":p2"), ("c1", K, "3"), ("c2", K, "5"), ("p1", N + "identifier", "x1"), ("p1", N + "lastName", "Dune"), ("p1", N + "firstName", "Ann"), ("p1", N + "initial", "A."),
        ("p2", N + "lastName", "Roe"), ("p2", N + "initial", "B."), ("d", N + "title", ":t"), ("t", V, "On rust"), ("d", N + "abstract", ":ab"), ("ab", V, "Rouille"), ("ab", G + "language", "fra"), ("d", N + "abstract", ":ac"), ("ac", V, "Rust"), ("d", N + "keywords", ":k"), ("k", N + "keyword", "rust"),
        ("d", N + "year", "2019"), ("d", N + "doi", "10.1/x"), ("d", N + "collection", ":j"), ("j", N + "title", "J"), ("j", N + "issn", "1-2"), ("d", N + "attachment", ":at"), ("d", N + "record", ":r"), ("at", N + "accessCondition", "Publique"), ("at", N + "fileName", "f.pdf"), ("at", N + "attachmentId", "9"),
        ("p1", N + "externalAffiliation", ":o"), ("o", N + "name", "Uni"), ("p1", N + "inraAffiliation", ":own"), ("own", N + "unit", ":u"), ("u", N + "name", "Unit"), ("u", N + "laboratory", "Lab"),
    ], H.harvested_repository(N, V, K, G + "language", "http://src/own", "Own", "http://files?id=", G))
    kinds = {(s, o) for s, p, o in out if p == TYPE}
    assert {(":d", BIBO + "Article"), (":e", VIVO + "EditorialArticle"), (":f", BIBO + "Chapter"), (":p1", FOAF + "Person"), (":d-author3", FOAF + "Person")} <= kinds
    assert (":e", BIBO + "Article") not in kinds and not {o for s, o in kinds if s == ":g"}
    assert {(":d-authorship-p1", VIVO + "rank", "1"), (":d-authorship3", VIVO + "rank", "3"), (":d-authorship3", VIVO + "relates", ":d-author3"), (":p1", LABEL, "Dune, Ann"), (":d-author3", LABEL, "Roe, B."), (":d-author3-vcard-name", VCARD + "givenName", "B.")} <= out
    assert (":p1", LABEL, "Dune, A.") not in out and not any(s == ":p2" and p == LABEL for s, p, _ in out)
    assert {(":d", LABEL, "On rust"), (":d", BIBO + "abstract", "Rouille"), (":d", BIBO + "abstract", "Rust"), (":d", VIVO + "freetextKeyword", "rust"), (":d-dtv", VIVO + "dateTime", "2019-01-01T00:00:00Z"), (":d", BIBO + "doi", "10.1/x"), (":j", BIBO + "issn", "1-2")} <= out
    assert {(":r-vcard-url", VCARD + "url", "http://files?id=9"), (":o", LABEL, "Uni"), (":p1-position-o", VIVO + "relates", ":o"), (":p1-position-INRA", G + "immediateOrgName", "Lab"), (":p1-position-INRA", VIVO + "relates", "http://src/own")} <= out
    assert (":p1-position-INRA", G + "immediateOrgName", "Unit") not in out


def test_language_of_an_abstract(spark):
    q = make(spark, [("d", N + "abstract", ":a"), ("a", V, "Rouille"), ("a", G + "language", "fra"), ("d", N + "abstract", ":b"), ("b", V, "Rust")])
    rules = [r for r in H.harvested_repository(N, V, K, G + "language", "http://src/own", "Own", "http://f/", G) if r.name == "abstracts"]
    assert {(r["o"], r["o_lang"]) for r in apply_rules(q, rules).where(f"p = '{BIBO}abstract'").collect()} == {("Rouille", "fr"), ("Rust", None)}


def council(links):
    """Statements of project p's links: (kind, address)."""
    out = [("p", N + "links", ":ls")]
    for k, (rel, href) in enumerate(links):
        out += [("ls", N + "link", f":l{k}"), (f"l{k}", N + "rel", rel), (f"l{k}", N + "href", href)]
    return out


def test_council_register(spark):
    at = A + "api/"
    rows = council([("PI_PER", at + "persons/1"), ("COLLAB_ORG", at + "organisations/2"), ("FUND", at + "funds/3"), ("PUBLICATION", at + "publications/4")])
    rows += [("s", N + "project/project", ":p"), ("p", N + "project/title", "Rust"), ("p", N + "project/status", "Active"), ("l2", N + "start", "2020-01-02T03:04:05"), ("l2", N + "end", "2021-01-02T03:04:05")]
    rows += [("api/funds/3", N + "links", ":fl"), ("fl", N + "link", ":f0"), ("f0", N + "rel", "FUNDER"), ("f0", N + "href", at + "organisations/5"), ("api/funds/3", N + "fund/valuePounds", ":vp"), ("vp", N + "amount", "12")]
    rows += [("api/persons/1", TYPE, N + "person/person"), ("api/persons/1", N + "person/surname", "Dune"), ("api/persons/1", N + "person/firstName", "Ann"), ("api/persons/1", N + "person/otherNames", "B"), ("api/persons/1", N + "href", at + "persons/1")]
    rows += [("api/organisations/2", TYPE, N + "organisation/organisation"), ("api/organisations/2", N + "organisation/name", "Uni"), ("api/organisations/2", N + "organisation/addresses", ":as"), ("as", N + "address", ":ad"), ("ad", N + "line1", "One"), ("ad", N + "line3", "Three")]
    rows += [("api/publications/4", TYPE, N + "project/outcome/publication"), ("api/publications/4", N + "project/outcome/title", "On rust"), ("api/publications/4", N + "project/outcome/type", "Book"), ("api/publications/4", N + "project/outcome/doi", "http://dx.doi.org/10.1/x")]
    rules = H.council_register(N, V, G + "status")
    once = apply_rules(make(spark, rows), rules)
    again = apply_rules(once, rules)
    assert {r["o"] for r in minus(again, once).collect()} == {THING}  # the first rule then sees the nodes that later ones made
    out = {(r["s"].replace(A, ":"), r["p"], r["o"].replace(A, ":")) for r in once.collect()}
    who, org = ":api/persons/1", ":api/organisations/2"
    assert {(":p", TYPE, VIVO + "Project"), (":p-grant", VIVO + "fundingVehicleFor", ":p"), (":p", G + "status", "Active"), (who, LABEL, "Dune, Ann B"), (org + "-vcard-address", VCARD + "streetAddress", "One <br/> Three")} <= out
    assert {(":p-PI_PER-persons/1", VIVO + "relates", who), (":p-PI_PER-persons/1", VIVO + "relates", ":p"), (":p-pi-persons/1", TYPE, VIVO + "PrincipalInvestigatorRole"), (":p-participantOrg-organisations/2", H.BEARER, org), (":p-grant", VIVO + "relates", who)} <= out
    assert {(":p-dti-start", VIVO + "dateTime", "2020-01-02T00:00:00Z"), (":p-grant", VIVO + "assignedBy", ":api/organisations/5"), (":p-grant", VIVO + "totalAwardAmount", "12 GBP"), (":p", OBO + "RO_0002234", ":api/publications/4")} <= out
    assert {(":api/publications/4", TYPE, BIBO + "Book"), (":api/publications/4", BIBO + "doi", "10.1/x"), (":api/publications/4", LABEL, "On rust")} <= out
    todo = {r["url"].replace(at, "") for r in H.unfetched(make(spark, rows), N, not_these=(at + "organisations/5",)).collect()}
    assert todo == {"organisations/2", "funds/3", "publications/4"}


def test_publications_service(spark):
    out = run(spark, [
        ("s", N + "project", ":p"), ("p", N + "code", "77"), ("p", N + "title", "Rust"), ("p", N + "acronym", "R"), ("s", N + "project", ":p2"), ("p2", N + "title", "Bare"), ("p2", N + "acronym", ""), ("p", N + "startdate", "2020-01-02"), ("p", N + "enddate", "2021-01-02"), ("p", N + "websiteurl", "r.org"),
        ("p", N + "rels", ":rs"), ("rs", N + "rel", ":o"), ("o", N + "legalname", "Uni"), ("o", N + "legalshortname", "U"), ("o", N + "to", ":to"), ("to", N + "class", "hasParticipant"), ("o", N + "country", ":co"), ("co", N + "classname", "France"), ("s", N + "result", ":d"), ("d", N + "title", ":t"), ("t", V, "On rust"),
        ("d", N + "pid", ":pid"), ("pid", N + "classid", "doi"), ("pid", V, "10.1/x"), ("d", N + "children", ":ch"), ("ch", N + "instance", ":in"), ("in", N + "instancetype", ":it"), ("it", N + "classname", "Article"), ("in", N + "webresource", ":w"), ("w", N + "url", "http://u"), ("w", K, "2"),
        ("d", N + "dateofacceptance", "2018-05-06"), ("d", N + "creator", ":c"), ("c", N + "rank", "1"), ("c", N + "name", "Ann"), ("c", N + "surname", "Dune"), ("c", V, "Dune, Ann"), ("c", N + "orcid_pending", "0-1"), ("d", N + "creator", ":c2"), ("c2", N + "rank", "2"), ("c2", N + "name", "Bo"), ("c2", N + "surname", "Roe"),
        ("c2", V, "Roe, Bo"), ("c2", N + "URL", "https://academic.microsoft.com/#/detail/55"), ("d", N + "rels", ":dr"), ("dr", N + "rel", ":dp"), ("dp", N + "code", "77"), ("d", N + "journal", ":j"), ("j", V, "J of R"), ("j", N + "issn", "1-2"), ("j", N + "eissn", ""), ("d", N + "publisher", "P & Q"),
    ], H.publications_service(N, N, V, K))
    journal, bo = H.HOME + "openaire-journal-J-of-R", H.HOME + "msracad-55"
    assert {(":p", LABEL, "R - Rust"), (":p-grant", LABEL, "Rust"), (":p2", LABEL, "Bare"), (":p-grant", VIVO + "identifier", "77"), (":p-grant", VIVO + "dateTimeInterval", ":p-dti"), (":p-vcard-url", VCARD + "url", "http://r.org")} <= out
    assert {(":o", TYPE, FOAF + "Organization"), (":p-participant-a/o", TYPE, VIVO + "InvestigatorRole"), (":o-vcard-address", VIVO + "Country", "France"), (":d", BIBO + "doi", "10.1/x"), (":d", N + "pubId", "10.1-x"), (":d", TYPE, BIBO + "Article")} <= out
    assert {(":d-vcard-url-2", VCARD + "url", "http://u"), (":d-dtv", VIVO + "dateTime", "2018-01-01T00:00:00Z"), (":d-author-Dune-Ann", VIVO + "orcidId", "https://orcid.org/0-1"), (":d-authorship-Roe-Bo", VIVO + "relates", bo), (bo + "-vcard-name", VCARD + "familyName", "Roe")} <= out
    assert {(":p", VIVO + "supportedInformationResource", ":d"), (journal, BIBO + "issn", "1-2"), (journal, VIVO + "publicationVenueFor", ":d"), (H.HOME + "openaire-publisher-P-Q", VIVO + "publisherOf", journal)} <= out
    assert not any(p == BIBO + "eissn" for _, p, _ in out)
