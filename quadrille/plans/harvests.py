"""Mapping lists of sources that are harvested record by record: a document repository, a register of funded research, a service of publications with their projects.

They are made of the shapes of :mod:`quadrille.plans.mappings`; namespaces are parameters. What a rule needs and a record lacks makes no statement.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.functions.scalars import localname, strafter, strbefore, to_int
from quadrille.plans.mappings import BEARER, CONTACT, DAY, HOME, REALIZED_IN, copies, date, interval, name_card, node, path, role, told, types, url_card
from quadrille.plans.patterns import bind, exists, join, match, not_exists, optional, scan, union
from quadrille.plans.rules import Rule
from quadrille.terms import BIBO, FOAF, LABEL, OBO, THING, TYPE, VCARD, VIVO, XSD, iri, lit

RELATES, PROJECT, GRANT, FUNDS = VIVO + "relates", VIVO + "Project", VIVO + "Grant", VIVO + "fundingVehicleFor"
OUTPUT, INFORMATION = OBO + "RO_0002234", OBO + "IAO_0000030"

#: Classes by the kind of an item in a repository. Fixed values. Articles are told apart by their own kind.
ITEMS = {
    "RESEARCH_REPORT": BIBO + "Report", "THESIS": BIBO + "Thesis", "AUDIOVISUAL_DOCUMENT": BIBO + "AudioVisualDocument", "PROCEEDING_PAPER": VIVO + "ConferencePaper", "REPORT": BIBO + "Report", "DISSERTATION": BIBO + "Thesis",
    "PAPER": BIBO + "Document", "PEDAGOGICAL_DOCUMENT": BIBO + "Document", "BOOK": BIBO + "Book", "PROCEEDINGS": BIBO + "Proceedings", "CHAPTER": BIBO + "Chapter",
}
ARTICLES = {"Review article": VIVO + "Review", "Editorial": VIVO + "EditorialArticle"}

#: Roles in a project by the kind of a link: class, and what the role is named after. Fixed values.
ROLES = {
    "PI_PER": (VIVO + "PrincipalInvestigatorRole", "pi"), "COI_PER": (VIVO + "CoPrincipalInvestigatorRole", "copi"), "RESEARCH_COI_PER": (VIVO + "CoPrincipalInvestigatorRole", "copi"), "RESEARCH_PER": (VIVO + "InvestigatorRole", "researcher"),
    "STUDENT_PER": (OBO + "ERO_0000783", "student"), "SUPER_PER": (VIVO + "LeaderRole", "supervisor"), "PM_PER": (VIVO + "LeaderRole", "projectManager"), "LEAD_ORG": (VIVO + "AdministratorRole", "leadOrg"),
    "PARTICIPANT_ORG": (VIVO + "InvestigatorRole", "participantOrg"), "PP_ORG": (VIVO + "InvestigatorRole", "participantOrg"), "COLLAB_ORG": (VIVO + "InvestigatorRole", "participantOrg"),
}
OUTPUTS = ("PUBLICATION", "RESEARCH_DATABASE_AND_MODEL", "SOFTWARE_AND_TECHNICAL_PRODUCT")

#: Classes by the kind of an outcome in a register. Fixed values.
OUTCOMES = {
    "Journal Article/Review": BIBO + "Article", "Conference/Paper/Proceeding/Abstract": VIVO + "ConferencePaper", "Working Paper": VIVO + "WorkingPaper", "Book Chapter": BIBO + "Chapter", "Thesis": BIBO + "Thesis", "Book": BIBO + "Book",
    "Database/Collection of data": OBO + "ERO_0001716",
}
RESOLVER = "http://dx.doi.org/"


def words(value: Column) -> Column:
    """Runs of other characters than letters, digits and '_' as one '-'."""
    return F.regexp_replace(value, r"\W+", "-")


def family_first(family: str, given: str) -> Column:
    return F.concat(told(family), F.lit(", "), told(given))


def one_of(mapping: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair)), key)


def harvested_repository(n: str, value: str, position: str, language: str, institute: str, institute_label: str, attachments: str, local: str) -> list:
    """Documents of a repository that is harvested by pages: its namespace, the predicates of a lifted text, position and language, the own institute, the address of attachments before their number, and the local namespace."""

    def articles(q):
        kinds = path(q, "x", n + "articleInfos", n + "articleType", end="k").where(told("k").isin(*ARTICLES))
        rows = optional(scan(q, "?x", n + "itemType", terms.literal_key("ARTICLE")), kinds)
        return bind(rows, cls=F.coalesce(one_of(ARTICLES, told("k")), F.lit(BIBO + "Article")))

    def authors(q):
        """An author without an identifier belongs to the document; ranks begin with 1."""
        rows = bind(match(q, ("?x", n + "creator", "?y"), ("?y", n + "author", "?z"), ("?y", position, "?k")), k=to_int(told("k"))).where("k is not null")
        rows = join(rows, rows.groupBy("x").agg(F.min("k").alias("least")))
        known = union(*(scan(q, "?z", n + p, "?any").select("z") for p in ("identifier", "inraIdentifier"))).distinct().withColumn("known", F.lit(True))
        rows = bind(rows.join(known, "z", "left"), rank=F.col("k") - F.col("least") + 1, own=F.col("known").isNull())
        number = F.col("rank").cast("string")
        return bind(rows, p=F.when(F.col("own"), node("x", F.concat(F.lit("-author"), number))).otherwise(F.col("z")), a=node("x", F.when(F.col("own"), F.concat(F.lit("-authorship"), number)).otherwise(F.concat(F.lit("-authorship-"), localname(F.col("z"))))))

    def properties(q):
        return join(authors(q).where("own").select("z", "p"), scan(q, "?z", "?zp", "?zo"))

    def named(q):
        rows = exists(scan(q, "?x", n + "lastName", "?f"), scan(q, "?x", TYPE, FOAF + "Person"))
        rows = optional(optional(rows, scan(q, "?x", n + "firstName", "?first")), scan(q, "?x", n + "initial", "?initial"))
        return bind(rows, v=F.coalesce("first", "initial"), l=family_first("f", "v"), card=node("x", "-vcard"), name=node("x", "-vcard-name")).where("v is not null")

    def abstracts(q):
        rows = optional(join(scan(q, "?x", n + "abstract", "?y"), scan(q, "?y", value, "?v")), scan(q, "?y", language, "?lang"))
        return bind(rows, t=told("v"), code=F.substring(told("lang"), 1, 2))

    def attachments_of(q):
        rows = match(q, ("?d", n + "attachment", "?at"), ("?d", n + "record", "?x"), ("?at", n + "accessCondition", terms.literal_key("Publique")), ("?at", n + "fileName", "?u"), ("?at", n + "attachmentId", "?id"))
        return bind(rows, card=node("x", "-vcard"), url=node("x", "-vcard-url"), at_=F.concat(F.lit(attachments), told("id")))

    def elsewhere(q):
        rows = exists(scan(q, "?x", n + "externalAffiliation", "?o"), scan(q, "?x", TYPE, FOAF + "Person"))
        rows = optional(optional(rows, scan(q, "?o", n + "name", "?l")), scan(q, "?o", n + "country", "?country"))
        return bind(rows, pos=node("x", F.concat(F.lit("-position-"), localname(F.col("o")))))

    def here(q):
        """The laboratory of a unit stands before its name."""
        rows = exists(path(q, "x", n + "inraAffiliation", n + "unit", end="unit"), scan(q, "?x", TYPE, FOAF + "Person"))
        for var, p in (("lab", "laboratory"), ("plain", "name"), ("country", "country")):
            rows = optional(rows, scan(q, "?unit", n + p, f"?{var}"))
        return bind(rows, l=F.coalesce("lab", "plain"), pos=node("x", "-position-INRA"))

    return [
        Rule("document identifiers", lambda q: match(q, ("?x", n + "itemType", "?any"), ("?x", n + "identifier", "?id")), (("?x", n + "documentIdentifier", "?id"),)),
        types("item types", n + "itemType", ITEMS),
        Rule("articles", articles, (("?x", TYPE, "?cls"),)),
        Rule("authors", authors, (("?a", TYPE, VIVO + "Authorship"), ("?p", TYPE, FOAF + "Person"), ("?a", VIVO + "rank", lit(F.col("rank"), XSD + "int")), ("?a", RELATES, "?x"), ("?a", RELATES, "?p"))),
        Rule("authors' properties", properties, (("?p", "?zp", "?zo"),)),
        Rule("titles", lambda q: path(q, "x", n + "title", value, end="v"), (("?x", LABEL, "?v"),)),
        Rule("names", named, (("?x", LABEL, lit(F.col("l"))), *name_card("?x", "?card", "?name", "?f", "?v"))),
        Rule("abstracts", abstracts, (("?x", BIBO + "abstract", lit(F.col("t"), lang=F.col("code"))),)),
        Rule("keywords", lambda q: path(q, "x", n + "keywords", n + "keyword", end="v"), (("?x", VIVO + "freetextKeyword", "?v"),)),
        date("years", (n + "year",), "-dtv"),
        *copies("document", None, {n + "doi": BIBO + "doi"}),
        Rule("journals", lambda q: match(q, ("?x", n + "collection", "?j"), ("?j", n + "title", "?l"), ("?j", n + "issn", "?issn")), (("?x", VIVO + "hasPublicationVenue", "?j"), ("?j", TYPE, BIBO + "Journal"), ("?j", LABEL, "?l"), ("?j", BIBO + "issn", "?issn"))),
        Rule("attachments", attachments_of, (("?x", CONTACT, "?card"), ("?card", TYPE, VCARD + "Kind"), ("?card", VCARD + "hasURL", "?url"), ("?url", TYPE, VCARD + "URL"), ("?url", LABEL, "?u"), ("?url", VCARD + "url", lit(F.col("at_"), XSD + "anyURI")))),
        Rule("other affiliations", elsewhere, (("?o", TYPE, FOAF + "Organization"), ("?o", LABEL, "?l"), ("?o", local + "country", "?country"), ("?pos", TYPE, VIVO + "Position"), ("?pos", RELATES, "?x"), ("?pos", RELATES, "?o"))),
        Rule("own affiliations", here, (("?pos", TYPE, VIVO + "Position"), ("?pos", RELATES, "?x"), ("?pos", local + "immediateOrgName", "?l"), ("?x", local + "country", "?country"), ("?pos", RELATES, institute), (institute, TYPE, FOAF + "Organization"), (institute, LABEL, lit(institute_label)))),
    ]


def linked_records(n: str):
    """Links of a register's records as relationships, named after the record, the kind and the address: a rule that comes first."""

    def links(q):
        rows = bind(match(q, ("?y", n + "links", "?links"), ("?links", n + "link", "?link"), ("?link", n + "href", "?h"), ("?link", n + "rel", "?rel")), x=told("h"))
        return join(bind(rows, r=node("y", F.concat(F.lit("-"), told("rel"), F.lit("-"), strafter(F.col("x"), "/api/")))), scan(q, "?link", "?lp", "?lo"))

    return Rule("links", links, (("?r", RELATES, "?x"), ("?r", RELATES, "?y"), ("?r", TYPE, n + "Link"), ("?r", TYPE, VIVO + "Relationship"), ("?r", terms.RDFS + "comment", "?rel"), ("?links", n + "link", "?r"), ("?r", "?lp", "?lo")))


def unfetched(quads: DataFrame, n: str, kinds: tuple[str, ...] = ("/organisations/", "/persons/", "/publications/", "/funds/"), not_these: tuple[str, ...] = ()) -> DataFrame:
    """Addresses that links name and no record was fetched for: column url, each once. An address of a kind without a record's number, such as '…/organisations/' itself, is given by ``not_these``."""
    found = bind(path(quads, "links", n + "link", n + "href", end="h"), url=told("h")).select("url").distinct()
    found = found.where(reduce(lambda a, b: a | b, (F.col("url").contains(k) for k in kinds)) & ~F.col("url").isin(*not_these))
    return not_exists(found, scan(quads, "?url", n + "href", "?any").select("url"))


def council_register(n: str, value: str, status: str) -> list:
    """Projects, people, organizations, funds and outcomes of a research council's register: its namespace, the predicate of a lifted text, and that of a grant's state."""
    person, organization, project, fund, outcome = (n + x for x in ("person/", "organisation/", "project/", "fund/", "project/outcome/"))

    def people(q):
        rows = join(scan(q, "?x", TYPE, person + "person"), scan(q, "?x", person + "surname", "?f"))
        rows = optional(rows, scan(q, "?x", person + "firstName", "?v"))
        rows = optional(rows, scan(q, "?x", person + "otherNames", "?m").where(terms.is_literal(F.col("m"))))
        return bind(rows, l=F.concat(family_first("f", "v"), F.coalesce(F.concat(F.lit(" "), told("m")), F.lit(""))), card=node("x", "-vcard"), name=node("x", "-vcard-name"))

    def addresses(q):
        rows = join(scan(q, "?x", TYPE, organization + "organisation"), path(q, "x", organization + "addresses", n + "address", end="ad"))
        for var in ("line1", "line2", "line3", "line4", "city", "county", "postCode", "country"):
            rows = optional(rows, scan(q, "?ad", n + var, f"?{var}"))
        further = [F.coalesce(F.concat(F.lit(" <br/> "), told(f"line{k}")), F.lit("")) for k in (2, 3, 4)]
        return bind(rows, street=F.concat(told("line1"), *further), card=node("x", "-vcard"), adr=node("x", "-vcard-address"))

    def projects(q):
        rows = match(q, ("?any", project + "project", "?x"), ("?x", project + "title", "?l"))
        rows = optional(optional(rows, scan(q, "?x", project + "status", "?state")), scan(q, "?x", project + "abstractText", "?d"))
        return bind(optional(rows, path(q, "x", project + "identifiers", project + "identifier", value, end="id")), g=node("x", "-grant"))

    def links_of_projects(q):
        """Bindings x, link, rel, o of projects' links to what isn't a project."""
        rows = join(path(q, "x", n + "links", n + "link", end="link"), scan(q, "?link", n + "rel", "?rel"))
        rows = join(exists(rows, scan(q, "?x", TYPE, PROJECT)), scan(q, "?link", RELATES, "?o"))
        return bind(not_exists(rows, scan(q, "?o", TYPE, PROJECT)), kind=told("rel"))

    def roles(q):
        rows = links_of_projects(q).where(F.col("kind").isin(*ROLES))
        cls, ending = (one_of({k: x[i] for k, x in ROLES.items()}, F.col("kind")) for i in (0, 1))
        return bind(join(rows, scan(q, "?g", FUNDS, "?x")), cls=cls, r=node("x", F.concat(F.lit("-"), ending, F.lit("-"), strafter(F.col("o"), "/api/"))))

    def funds(q):
        rows = links_of_projects(q).where("kind = 'FUND'").select("x", "link", F.col("o").alias("fund"))
        rows = join(join(rows, match(q, ("?link", n + "start", "?a"), ("?link", n + "end", "?b"))), scan(q, "?g", FUNDS, "?x"))
        funders = join(join(scan(q, "?tie", n + "rel", terms.literal_key("FUNDER")), scan(q, "?tie", RELATES, "?fund")), scan(q, "?tie", RELATES, "?o"))
        rows = join(rows, funders.where(F.col("o").contains("organisations")).select("fund", "o"))
        rows = optional(rows, path(q, "fund", fund + "valuePounds", n + "amount", end="amount"))
        days = {v: F.concat(strbefore(told(x), "T"), F.lit("T00:00:00Z")) for v, x in (("ta", "a"), ("tb", "b"))}
        return bind(rows, **days, sum=F.concat(told("amount"), F.lit(" GBP")), i=node("x", "-dti"), s=node("x", "-dti-start"), e=node("x", "-dti-end"))

    def outcomes(q):
        rows = scan(q, "?x", TYPE, outcome + "publication")
        for var, p in (("d", "abstractText"), ("pmid", "pubMedId"), ("given", "doi")):
            rows = optional(rows, scan(q, "?x", outcome + p, f"?{var}"))
        return bind(rows, doi=F.when(told("given").startswith(RESOLVER), F.substr(told("given"), F.lit(len(RESOLVER) + 1))).otherwise(told("given")))

    def supported(q):
        rows = join(path(q, "g", n + "links", n + "link", RELATES, end="x"), scan(q, "?x", TYPE, outcome + "publication"))
        return exists(rows, scan(q, "?g", TYPE, GRANT))

    def days(var: str, time: str, link: str) -> tuple:
        return (("?i", link, var), (var, TYPE, VIVO + "DateTimeValue"), (var, VIVO + "dateTime", lit(F.col(time), XSD + "dateTime")), (var, VIVO + "dateTimePrecision", DAY))

    return [
        Rule("things", lambda q: union(q.select(F.col("s").alias("x")), q.where("o_kind = 'iri'").select(F.col("o").alias("x"))).distinct(), (("?x", TYPE, THING),)),
        linked_records(n),
        Rule("people", people, (("?x", TYPE, FOAF + "Person"), ("?x", LABEL, lit(F.col("l"))), *name_card("?x", "?card", "?name", "?f", "?v"), ("?name", VIVO + "middleName", "?m"))),
        Rule("organizations", lambda q: join(scan(q, "?x", TYPE, organization + "organisation"), scan(q, "?x", organization + "name", "?l")), (("?x", TYPE, FOAF + "Organization"), ("?x", LABEL, "?l"))),
        Rule("addresses", addresses, (("?x", CONTACT, "?card"), ("?card", TYPE, VCARD + "Organization"), ("?card", VCARD + "hasAddress", "?adr"), ("?adr", TYPE, VCARD + "Address"), ("?adr", VCARD + "streetAddress", lit(F.col("street"))), ("?adr", VCARD + "locality", "?city"), ("?adr", VCARD + "region", "?county"), ("?adr", VCARD + "postalCode", "?postCode"), ("?adr", VCARD + "country", "?country"))),
        Rule("projects", projects, (("?x", TYPE, PROJECT), ("?x", LABEL, "?l"), ("?x", VIVO + "description", "?d"), ("?x", status, "?state"), ("?g", TYPE, GRANT), ("?g", FUNDS, "?x"), ("?g", LABEL, "?l"), ("?g", VIVO + "description", "?d"), ("?g", VIVO + "sponsorAwardId", "?id"))),
        Rule("roles", roles, (("?g", RELATES, "?o"), ("?g", RELATES, "?r"), ("?r", TYPE, "?cls"), ("?r", BEARER, "?o"), ("?r", REALIZED_IN, "?x"))),
        Rule("funds", funds, (
            ("?g", VIVO + "dateTimeInterval", "?i"), ("?x", VIVO + "dateTimeInterval", "?i"), ("?i", TYPE, VIVO + "DateTimeInterval"), *days("?s", "ta", VIVO + "start"), *days("?e", "tb", VIVO + "end"),
            ("?o", TYPE, VIVO + "FundingOrganization"), ("?g", VIVO + "assignedBy", "?o"), ("?o", VIVO + "assigns", "?g"), ("?g", VIVO + "totalAwardAmount", lit(F.col("sum"))))),
        Rule("outputs", lambda q: links_of_projects(q).where(F.col("kind").isin(*OUTPUTS)), (("?x", OUTPUT, "?o"), ("?o", TYPE, INFORMATION))),
        *copies("outcome", None, {outcome + "title": LABEL}),
        types("outcome types", outcome + "type", OUTCOMES),
        Rule("outcomes", outcomes, (("?x", BIBO + "abstract", "?d"), ("?x", BIBO + "pmid", "?pmid"), ("?x", BIBO + "doi", lit(F.col("doi"))))),
        Rule("supported outcomes", supported, (("?g", VIVO + "supportedInformationResource", "?x"),)),
        Rule("positions", lambda q: exists(scan(q, "?x", n + "rel", terms.literal_key("EMPLOYED")), scan(q, "?x", TYPE, VIVO + "Relationship")), (("?x", TYPE, VIVO + "Position"),)),
    ]


def publications_service(n: str, results: str, value: str, position: str, profiles: str = "academic.microsoft.com", home: str = HOME) -> list:
    """Publications and projects of an open-access service: the namespaces of its fields and of its results, predicates of a lifted text and position, and the site whose profile numbers name authors."""

    def projects(q):
        rows = bind(optional(scan(q, "?any", results + "project", "?x"), scan(q, "?x", n + "code", "?id")), g=node("x", "-grant"))
        rows = optional(optional(rows, scan(q, "?x", n + "title", "?t")), scan(q, "?x", n + "acronym", "?a"))
        return bind(rows, l=F.when(told("a") != "", F.concat(told("a"), F.lit(" - "), told("t"))).otherwise(told("t")))

    def of_project(q):
        return join(scan(q, "?x", TYPE, PROJECT), scan(q, "?g", FUNDS, "?x"))

    def organizations(q):
        return match(q, ("?x", TYPE, PROJECT), ("?x", n + "rels", "?rels"), ("?rels", n + "rel", "?o"), ("?o", n + "legalname", "?l"), ("?o", n + "legalshortname", "?s"))

    def participants(q):
        rows = join(of_project(q), path(q, "x", n + "rels", n + "rel", end="o"))
        rows = exists(exists(rows, scan(q, "?o", TYPE, FOAF + "Organization")), join(scan(q, "?o", n + "to", "?to"), scan(q, "?to", n + "class", terms.literal_key("hasParticipant"))).select("o"))
        return bind(rows, r=node("x", F.concat(F.lit("-participant-"), strafter(F.col("o"), "://"))))

    def publications(q):
        rows = join(scan(q, "?any", results + "result", "?x"), path(q, "x", n + "title", value, end="l")).select("x", "l")
        rows = optional(rows, path(q, "x", n + "language", n + "classname", end="lang").where(told("lang") != "Undetermined"))
        rows = optional(optional(rows, scan(q, "?x", n + "description", "?d")), scan(q, "?x", n + "fulltext", "?full"))
        dois = join(scan(q, "?x", n + "pid", "?pid"), match(q, ("?pid", n + "classid", terms.literal_key("doi")), ("?pid", value, "?doi")))
        return bind(optional(rows, dois.select("x", "doi")), id=F.regexp_replace(told("doi"), r"[^a-zA-Z0-9\.]+", "-"))

    def kinds(q):
        names = exists(path(q, "x", n + "children", n + "instance", n + "instancetype", n + "classname", end="k"), scan(q, "?x", TYPE, BIBO + "Document"))
        known = one_of({"Article": BIBO + "Article", "Preprint": BIBO + "Manuscript", "Conference object": VIVO + "ConferencePaper"}, told("k"))
        return bind(names, cls=F.coalesce(known, F.when(told("k").contains("thesis"), F.lit(BIBO + "Thesis"))))

    def addresses_of(q):
        rows = exists(path(q, "x", n + "children", n + "instance", n + "webresource", end="res"), scan(q, "?x", TYPE, BIBO + "Document"))
        return bind(join(rows, match(q, ("?res", n + "url", "?u"), ("?res", position, "?k"))), k=F.concat(F.lit('"-'), told("k"), F.lit('"')))

    def authors(q):
        """An author with a profile is one person in all publications, another belongs to the publication."""
        rows = exists(scan(q, "?x", n + "creator", "?c"), scan(q, "?x", TYPE, BIBO + "Document"))
        rows = join(rows, match(q, ("?c", n + "rank", "?rank"), ("?c", n + "name", "?v"), ("?c", n + "surname", "?f"), ("?c", value, "?full")))
        rows = optional(rows, scan(q, "?c", n + "URL", "?profile").where(told("profile").contains(profiles)))
        rows = optional(optional(rows, scan(q, "?c", n + "orcid", "?sure")), scan(q, "?c", n + "orcid_pending", "?likely"))
        own = node("x", F.concat(F.lit("-author-"), words(told("full"))))
        rows = bind(rows, p=F.coalesce(F.concat(F.lit(home + "msracad-"), strafter(told("profile"), "/detail/")), own), a=node("x", F.concat(F.lit("-authorship-"), words(told("full")))), l=family_first("f", "v"))
        return bind(rows, orcid=F.concat(F.lit("https://orcid.org/"), F.coalesce(told("sure"), told("likely"))), card=node("p", "-vcard"), name=node("p", "-vcard-name"))

    def projects_of(q):
        codes = exists(path(q, "x", n + "rels", n + "rel", n + "code", end="id").where(told("id") != "unidentified"), scan(q, "?x", TYPE, BIBO + "Document"))
        return join(codes, exists(scan(q, "?project", VIVO + "identifier", "?id"), scan(q, "?project", TYPE, PROJECT)))

    def journals(q):
        rows = exists(scan(q, "?x", n + "journal", "?source"), scan(q, "?x", TYPE, BIBO + "Article"))
        rows = join(rows, scan(q, "?source", value, "?l"))
        for var in ("issn", "eissn"):
            rows = optional(rows, scan(q, "?source", n + var, f"?{var}").where(told(var) != ""))
        return bind(rows, j=F.concat(F.lit(home + "openaire-journal-"), words(told("l"))))

    def publishers(q):
        rows = exists(scan(q, "?x", n + "publisher", "?l"), scan(q, "?x", TYPE, BIBO + "Article"))
        rows = exists(join(rows, scan(q, "?x", VIVO + "hasPublicationVenue", "?j")), scan(q, "?j", TYPE, BIBO + "Journal"))
        return bind(rows, o=F.concat(F.lit(home + "openaire-publisher-"), words(told("l"))))

    def accepted(q):
        rows = exists(scan(q, "?x", n + "dateofacceptance", "?v"), scan(q, "?x", TYPE, BIBO + "Document"))
        return bind(rows, d=node("x", "-dtv"), t=F.concat(strbefore(told("v"), "-"), F.lit("-01-01T00:00:00Z"))).where("t like '____-%'")

    return [
        Rule("projects", projects, (("?x", TYPE, PROJECT), ("?x", VIVO + "identifier", "?id"), ("?x", n + "projectId", "?id"), ("?x", LABEL, lit(F.col("l"))), ("?g", TYPE, GRANT), ("?g", VIVO + "identifier", "?id"), ("?g", n + "grantId", "?id"), ("?g", FUNDS, "?x"), ("?g", LABEL, "?t"))),
        url_card("project URLs", lambda q: exists(scan(q, "?x", n + "websiteurl", "?u"), scan(q, "?x", TYPE, PROJECT))),
        interval("project dates", PROJECT, n + "startdate", n + "enddate", DAY, DAY, True),
        Rule("grant dates", lambda q: join(of_project(q), scan(q, "?x", VIVO + "dateTimeInterval", "?i")), (("?g", VIVO + "dateTimeInterval", "?i"),)),
        Rule("project keywords", lambda q: join(of_project(q), scan(q, "?x", n + "keywords", "?v")), (("?x", VIVO + "freetextKeyword", "?v"), ("?g", VIVO + "freetextKeyword", "?v"))),
        Rule("organizations", organizations, (("?o", TYPE, FOAF + "Organization"), ("?o", LABEL, "?l"), ("?o", FOAF + "alternativeTerm", "?s"))),
        url_card("organization URLs", lambda q: exists(scan(q, "?x", n + "websiteurl", "?u"), scan(q, "?x", TYPE, FOAF + "Organization")), VCARD + "Organization"),
        Rule("countries", lambda q: bind(exists(path(q, "x", n + "country", n + "classname", end="country"), scan(q, "?x", TYPE, FOAF + "Organization")), card=node("x", "-vcard"), adr=node("x", "-vcard-address")), (("?card", VCARD + "hasAddress", "?adr"), ("?adr", VIVO + "Country", "?country"))),
        Rule("participants", participants, role(VIVO + "InvestigatorRole")),
        Rule("publications", publications, (("?x", TYPE, BIBO + "Document"), ("?x", LABEL, "?l"), ("?x", VCARD + "Language", "?lang"), ("?x", VIVO + "description", "?d"), ("?x", BIBO + "abstract", "?full"), ("?x", BIBO + "doi", "?doi"), ("?x", n + "pubId", lit(F.col("id"))))),
        Rule("publication types", kinds, (("?x", TYPE, "?cls"),)),
        url_card("publication URLs", addresses_of),
        Rule("years", accepted, (("?x", VIVO + "dateTimeValue", "?d"), ("?d", TYPE, VIVO + "DateTimeValue"), ("?d", VIVO + "dateTimePrecision", VIVO + "yearPrecision"), ("?d", VIVO + "dateTime", lit(F.col("t"), XSD + "dateTime")))),
        Rule("keywords", lambda q: exists(path(q, "x", n + "subject", value, end="v"), scan(q, "?x", TYPE, BIBO + "Document")), (("?x", VIVO + "freetextKeyword", "?v"),)),
        Rule("authors", authors, (("?p", TYPE, FOAF + "Person"), ("?p", LABEL, lit(F.col("l"))), ("?a", TYPE, VIVO + "Authorship"), ("?a", VIVO + "rank", "?rank"), ("?a", RELATES, "?x"), ("?a", RELATES, "?p"), *name_card("?p", "?card", "?name", "?f", "?v"), ("?p", VIVO + "orcidId", iri(F.col("orcid"))), ("?orcid", TYPE, THING))),
        Rule("publications of projects", projects_of, (("?project", VIVO + "supportedInformationResource", "?x"), ("?x", VIVO + "informationSourceSupportedBy", "?project"))),
        Rule("journals", journals, (("?j", TYPE, BIBO + "Journal"), ("?j", LABEL, "?l"), ("?j", BIBO + "issn", "?issn"), ("?j", BIBO + "eissn", "?eissn"), ("?j", VIVO + "publicationVenueFor", "?x"), ("?x", VIVO + "hasPublicationVenue", "?j"))),
        Rule("publishers", publishers, (("?o", TYPE, FOAF + "Publisher"), ("?o", LABEL, "?l"), ("?o", VIVO + "publisherOf", "?j"))),
    ]
