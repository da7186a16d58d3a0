"""Mapping lifted records to the target ontology.

A mapping is an ordered list of rules, made of a few shapes that recur in every source: labels and other literals, types by a
vocabulary, identifiers, dates, contact cards, authorships, roles, venues, subjects. A source states its predicates and which shapes apply; ``MAPPINGS`` has
the lists by source. Nodes that a rule makes are named after what they belong to, so runs can be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.functions.scalars import slug, strafter, strbefore, to_int
from quadrille.plans.patterns import bind, exists, join, match, not_exists, optional, scan, union
from quadrille.plans.rules import Rule
from quadrille.terms import BIBO, FOAF, LABEL, OBO, SKOS, THING, TYPE, VCARD, VIVO, XSD, iri, lit

HOME = "http://example.org/quadrille/individual/"
CONTACT, BEARER, REALIZED_IN = OBO + "ARG_2000028", OBO + "RO_0000052", OBO + "BFO_0000054"
YEAR, DAY = VIVO + "yearPrecision", VIVO + "yearMonthDayPrecision"


def node(subject: str, ending: str | Column) -> Column:
    """The IRI of a node that belongs to ``subject``."""
    return F.concat(F.col(subject), F.lit(ending) if isinstance(ending, str) else ending)


def told(name: str) -> Column:
    return terms.text(F.col(name))


def compact(name: str) -> Column:
    """A value as part of an IRI: ASCII letters, digits and '_' only."""
    return F.regexp_replace(told(name), r"[^A-Za-z0-9_]", "")


def path(quads: DataFrame, start: str, *predicates: str, end: str) -> DataFrame:
    """Bindings start ... end along a chain of predicates."""
    names = [start, *(f"_{start}{k}" for k in range(1, len(predicates))), end]
    return reduce(join, (scan(quads, f"?{a}", p, f"?{b}") for a, b, p in zip(names, names[1:], predicates, strict=False))).select(start, end)


def copies(name: str, cls: str | None, pairs: Mapping[str, str]) -> list[Rule]:
    """Values of source predicates under target predicates, for instances of ``cls`` or all."""

    def where(p: str):
        return lambda q: exists(scan(q, "?x", p, "?v"), scan(q, "?x", TYPE, cls)) if cls else scan(q, "?x", p, "?v")

    return [Rule(f"{name} {target.rsplit('/', 1)[-1]}", where(p), (("?x", target, "?v"),)) for p, target in pairs.items()]


def types(name: str, predicate: str, classes: Mapping[str, str]) -> Rule:
    """Classes by the value of a literal: one scan for all values."""

    def where(q: DataFrame) -> DataFrame:
        cls = F.create_map(*(F.lit(x) for pair in classes.items() for x in pair))
        return bind(scan(q, "?x", predicate, "?v"), cls=F.try_element_at(cls, told("v")))

    return Rule(name, where, (("?x", TYPE, "?cls"),))


def default_type(name: str, of: str, cls: str) -> Rule:
    """A class for instances of ``of`` that have no other."""
    return Rule(name, lambda q: not_exists(scan(q, "?x", TYPE, of), scan(q, "?x", TYPE, "?t").where(F.col("t") != of)), (("?x", TYPE, cls),))


def identifiers(name: str, start: tuple[str, ...], kind: str, value: str, targets: Mapping[str, str]) -> list[Rule]:
    """Identifiers of a kind, found along ``start``, under the predicate for the kind."""
    return [Rule(f"{name} {k}", lambda q, k=k: join(join(path(q, "x", *start, end="i"), scan(q, "?i", kind, terms.literal_key(k))), scan(q, "?i", value, "?v")), (("?x", p, "?v"),)) for k, p in targets.items()]


def date(name: str, start: tuple[str, ...], suffix: str, precision: str = YEAR, tail: str = "-01-01T00:00:00Z") -> Rule:
    """A date value of its own for what is found along ``start``."""
    where = lambda q: bind(path(q, "x", *start, end="v"), d=node("x", suffix), t=F.concat(told("v"), F.lit(tail)))
    return Rule(name, where, (("?x", VIVO + "dateTimeValue", "?d"), ("?d", TYPE, VIVO + "DateTimeValue"), ("?d", VIVO + "dateTime", lit(F.col("t"), XSD + "dateTime")), ("?d", VIVO + "dateTimePrecision", precision)))


def interval(name: str, cls: str, start: str, end: str, start_precision: str, end_precision: str, end_needed: bool) -> Rule:
    """A date interval with a start and an end; without ``end_needed`` the end may be missing."""
    tails = {YEAR: "-01-01T00:00:00Z", DAY: "T00:00:00Z"}

    def where(q: DataFrame) -> DataFrame:
        first, last = exists(scan(q, "?x", start, "?a"), scan(q, "?x", TYPE, cls)), scan(q, "?x", end, "?b")
        rows = join(first, last) if end_needed else optional(first, last)
        rows = bind(rows, i=node("x", "-dti"), s=node("x", "-dti-start"), e=F.when(F.col("b").isNotNull(), node("x", "-dti-end")))
        return bind(rows, ts=F.concat(told("a"), F.lit(tails[start_precision])), te=F.concat(told("b"), F.lit(tails[end_precision])))

    def value(var: str, time: str, link: str, precision: str) -> tuple:
        at = F.when(F.col(var).isNotNull(), F.lit(VIVO + "DateTimeValue")), F.when(F.col(var).isNotNull(), F.lit(precision))
        return (("?i", link, f"?{var}"), (f"?{var}", TYPE, iri(at[0])), (f"?{var}", VIVO + "dateTime", lit(F.col(time), XSD + "dateTime")), (f"?{var}", VIVO + "dateTimePrecision", iri(at[1])))

    return Rule(name, where, (("?x", VIVO + "dateTimeInterval", "?i"), ("?i", TYPE, VIVO + "DateTimeInterval"), *value("s", "ts", VIVO + "start", start_precision), *value("e", "te", VIVO + "end", end_precision)))


def name_card(person: str, card: str, name: str, family: str, given: str) -> tuple:
    """Templates of a person's card with a name; arguments are variables."""
    return ((person, CONTACT, card), (card, TYPE, VCARD + "Individual"), (card, VCARD + "hasName", name), (name, TYPE, VCARD + "Name"), (name, VCARD + "familyName", family), (name, VCARD + "givenName", given))


def url_card(name: str, where, kind: str = VCARD + "Kind") -> Rule:
    """A card with a URL for bindings x, u; 'http://' is added where a URL has no scheme. ``k`` tells cards of one resource apart."""

    def bindings(q: DataFrame) -> DataFrame:
        rows = where(q)
        k = told("k") if "k" in rows.columns else F.lit("")
        full = F.when(told("u").rlike("^http"), told("u")).otherwise(F.concat(F.lit("http://"), told("u")))
        return bind(rows, card=node("x", F.concat(F.lit("-vcard"), k)), url=node("x", F.concat(F.lit("-vcard-url"), k)), full=full)

    return Rule(name, bindings, (("?x", CONTACT, "?card"), ("?card", TYPE, kind), ("?card", VCARD + "hasURL", "?url"), ("?url", TYPE, VCARD + "URL"), ("?url", VCARD + "url", lit(F.col("full"), XSD + "anyURI")), ("?url", LABEL, "?u")))


def authorship(link: str = "?a", work: str = "?x", author: str = "?p") -> tuple:
    """Templates of an authorship between a work and an author."""
    return ((link, TYPE, VIVO + "Authorship"), (link, VIVO + "relates", work), (work, VIVO + "relatedBy", link), (link, VIVO + "relates", author), (author, VIVO + "relatedBy", link), (author, TYPE, FOAF + "Person"))


def role(cls: str, owner: str = "?o", grant: str = "?g", project: str = "?x", at: str = "?r") -> tuple:
    """Templates of a role that ``owner`` has in a project under a grant."""
    return ((grant, VIVO + "relates", owner), (grant, VIVO + "relates", at), (at, TYPE, cls), (at, BEARER, owner), (at, REALIZED_IN, project))


def profile_service(w: str, c: str, generic: str, personal: str, position: str, home: str = HOME) -> list:
    """Works of a researcher profile service: namespaces of works, common parts, paths, personal details, and the position predicate of the lift."""
    ids = c + "external-ids", c + "external-id"

    def contributors(q):
        rows = join(path(q, "x", w + "contributors", w + "contributor", end="n"), match(q, ("?n", position, "?k"), ("?n", w + "credit-name", "?l")))
        return bind(rows, rank=to_int(told("k")), a=node("x", F.concat(F.lit("-authorship-"), compact("l"))), p=node("x", F.concat(F.lit("-author-"), compact("l"))))

    def owner(q):
        works = bind(match(q, ("?x", TYPE, w + "work"), ("?x", generic + "path", "?path")), id=strafter(strbefore(told("path"), "/work"), "/"))
        people = bind(scan(q, "?n", generic + "path", "?path"), id=F.regexp_extract(told("path"), "^/([^/]+)/person$", 1)).where("id != ''").select("n", "id")
        named = optional(optional(path(q, "n", personal + "name", end="name"), scan(q, "?name", personal + "family-name", "?f")), scan(q, "?name", personal + "given-names", "?v"))
        rows = bind(join(join(works.select("x", "id"), people), named), l=F.concat(told("f"), F.lit(", "), told("v")), iri_=F.concat(F.lit("https://orcid.org/"), "id"))
        return bind(rows, p=F.concat(F.lit(home + "orcid-"), "id"), a=node("x", F.concat(F.lit("-authorship-"), F.col("id"))))

    def cards(q):
        return bind(match(q, ("?x", TYPE, FOAF + "Person"), ("?x", c + "label", "?l")), card=node("x", "-vcard"), name=node("x", "-vcard-name"))

    def names(q):
        return match(q, ("?x", TYPE, FOAF + "Person"), ("?x", CONTACT, "?card"), ("?card", VCARD + "hasName", "?name"), ("?name", VCARD + "familyName", "?f"), ("?name", VCARD + "givenName", "?v"))

    def alike(q):
        one = bind(names(q), first=F.substring(told("v"), 1, 1)).select("x", "f", "first").distinct()
        return join(one, one.withColumnRenamed("x", "y")).where("x != y")

    def own_rank(q):
        known = match(q, ("?a", TYPE, VIVO + "Authorship"), ("?a", VIVO + "relates", "?x"), ("?x", VIVO + "orcidId", "?id"))
        unranked = not_exists(known, scan(q, "?a", VIVO + "rank", "?any"))
        others = not_exists(match(q, ("?y", VIVO + "relatedBy", "?b"), ("?b", VIVO + "rank", "?rank")), scan(q, "?y", VIVO + "orcidId", "?any"))
        same_work = join(scan(q, "?a", VIVO + "relates", "?w"), scan(q, "?b", VIVO + "relates", "?w"))
        return join(join(join(unranked.select("a", "x"), alike(q).select("x", "y")), others.select("y", "b", "rank")), same_work)

    def venues(q):
        rows = scan(q, "?x", w + "journal-title", "?l")
        issn = join(join(path(q, "x", *ids, end="i"), scan(q, "?i", c + "external-id-type", terms.literal_key("issn"))), scan(q, "?i", c + "external-id-value", "?issn")).select("x", "issn")
        return bind(optional(rows, issn), j=F.concat(F.lit(home + "orcid-journal-"), F.regexp_replace(told("l"), r"[^A-Za-z0-9_]+", "-")))

    return [
        types("work types", w + "type", {
            "journal-article": BIBO + "Article", "book": BIBO + "Book", "book-chapter": BIBO + "Chapter", "book-review": VIVO + "Review", "dissertation": BIBO + "Thesis", "edited-book": BIBO + "EditedBook",
            "manual": BIBO + "Manual", "working-paper": VIVO + "WorkingPaper", "website": BIBO + "Website",
        }),
        default_type("other works", w + "work", BIBO + "Document"),
        Rule("contributors", contributors, (*authorship(), ("?a", VIVO + "rank", lit(F.col("rank"), XSD + "int")), ("?p", c + "label", "?l"))),
        Rule("owner", owner, (*authorship(), ("?p", c + "label", lit(F.col("l"))), ("?p", VIVO + "orcidId", iri(F.col("iri_"))), ("?iri_", TYPE, THING))),
        Rule("cards", lambda q: bind(cards(q), f=F.when(told("l").contains(","), strbefore(told("l"), ",")).otherwise(F.element_at(F.split(told("l"), " "), -1)), v=F.trim(F.when(told("l").contains(","), strafter(told("l"), ",")).otherwise(F.regexp_replace(told("l"), r" ?[^ ]*$", "")))),
             name_card("?x", "?card", "?name", lit(F.col("f")), lit(F.col("v")))),
        Rule("person labels", lambda q: bind(names(q), l=F.concat(told("f"), F.lit(", "), told("v"))), (("?x", LABEL, lit(F.col("l"))),)),
        Rule("same person", alike, (("?x", terms.SAME_AS, "?y"), ("?y", terms.SAME_AS, "?x"))),
        Rule("owner's rank", own_rank, (("?a", VIVO + "rank", "?rank"),)),
        Rule("titles", lambda q: path(q, "x", w + "title", c + "title", end="v"), (("?x", LABEL, "?v"),)),
        date("years", (c + "publication-date", c + "year"), "-year"),
        *identifiers("identifier", ids, c + "external-id-type", c + "external-id-value", {"doi": BIBO + "doi", "pmid": BIBO + "pmid"}),
        Rule("venues", venues, (("?x", VIVO + "hasPublicationVenue", "?j"), ("?j", TYPE, BIBO + "Journal"), ("?j", LABEL, "?l"), ("?j", BIBO + "issn", "?issn"))),
        url_card("work URLs", lambda q: scan(q, "?x", w + "url", "?u")),
    ]


def project_register(n: str, kind: str) -> list:
    """Projects of a funding register: its namespace, and the predicate of an organization's part in a project."""

    def project(q):
        rows = optional(match(q, ("?x", TYPE, n + "project"), ("?x", n + "title", "?t")), scan(q, "?x", n + "acronym", "?a"))
        for var, p in (("d", "objective"), ("id", "id"), ("cost", "totalCost")):
            rows = optional(rows, scan(q, "?x", n + p, f"?{var}"))
        return bind(rows, l=F.concat(told("a"), F.lit(" - "), told("t")), g=node("x", "-grant"), gid=F.concat(F.lit("grant-"), told("id")))

    def members(q):
        return join(join(path(q, "x", n + "relations", n + "associations", n + "organization", end="o"), scan(q, "?x", TYPE, VIVO + "Project")), scan(q, "?g", VIVO + "fundingVehicleFor", "?x"))

    def with_part(part: str):
        return lambda q: bind(join(members(q), scan(q, "?o", kind, terms.literal_key(part))), r=node("x", F.concat(F.lit(f"-{part}-"), strafter(F.col("o"), "://"))))

    def no_part(q):
        has = match(q, ("?any", BEARER, "?o"), ("?g2", VIVO + "relates", "?any")).select("o")
        return bind(not_exists(members(q), has), r=node("x", F.concat(F.lit("-orgRole-"), strafter(F.col("o"), "://"))))

    def departments(q):
        rows = union(scan(q, "?o", n + "departmentName", "?l"), scan(q, "?o", n + "otherDepartmentName", "?l")).where(~told("l").isin("N/A", "-"))
        return bind(rows, dep=node("o", F.concat(F.lit("-department-"), compact("l"))))

    def addresses(q):
        rows = reduce(join, (path(q, "x", n + "address", n + p, end=var) for var, p in (("street", "street"), ("city", "city"), ("post", "postalCode"))))
        rows = join(exists(rows, scan(q, "?x", TYPE, FOAF + "Organization")), path(q, "x", n + "relations", n + "regions", n + "region", n + "name", end="country"))
        return bind(rows, card=node("x", "-vcard"), adr=node("x", "-vcard-address"))

    return [
        Rule("projects", project, (
            ("?x", TYPE, VIVO + "Project"), ("?x", LABEL, lit(F.col("l"))), ("?x", VIVO + "description", "?d"), ("?x", VIVO + "identifier", "?id"), ("?g", TYPE, VIVO + "Grant"), ("?g", LABEL, lit(F.col("l"))), ("?g", VIVO + "description", "?d"),
            ("?g", VIVO + "identifier", lit(F.col("gid"))), ("?g", VIVO + "totalAwardAmount", "?cost"), ("?g", VIVO + "fundingVehicleFor", "?x"))),
        interval("project dates", VIVO + "Project", n + "startDate", n + "endDate", DAY, DAY, True),
        url_card("project URLs", lambda q: exists(scan(q, "?x", n + "url", "?u"), scan(q, "?x", TYPE, VIVO + "Project"))),
        Rule("organizations", lambda q: join(scan(q, "?y", n + "organization", "?x").select("x").distinct(), match(q, ("?x", n + "legalName", "?l"), ("?x", n + "shortName", "?s"), ("?x", n + "id", "?id"))), (("?x", TYPE, FOAF + "Organization"), ("?x", LABEL, "?l"), ("?x", FOAF + "alternativeTerm", "?s"), ("?x", VIVO + "identifier", "?id"))),
        Rule("coordinators", with_part("coordinator"), role(VIVO + "AdministratorRole")),
        Rule("participants", with_part("participant"), role(VIVO + "InvestigatorRole")),
        Rule("other members", no_part, (("?o", OBO + "RO_0000053", "?r"), ("?r", TYPE, OBO + "BFO_0000023"), ("?r", REALIZED_IN, "?x"))),
        Rule("departments", departments, (("?dep", TYPE, FOAF + "AcademicDepartment"), ("?dep", LABEL, "?l"), ("?dep", OBO + "BFO_0000050", "?o"))),
        Rule("addresses", addresses, (("?x", CONTACT, "?card"), ("?card", TYPE, VCARD + "Organization"), ("?card", VCARD + "hasAddress", "?adr"), ("?adr", VCARD + "streetAddress", "?street"), ("?adr", VCARD + "locality", "?city"), ("?adr", VCARD + "postalCode", "?post"), ("?adr", VIVO + "Country", "?country"))),
        url_card("organization URLs", lambda q: path(q, "x", n + "address", n + "url", end="u"), VCARD + "Organization"),
    ]


def grant_workbook(n: str, g: str, body: str, funder: str, funder_label: str, same_as: str, end_precision: str = DAY) -> list:
    """Grants of a funding body's workbook: namespaces of its columns and of split names, and the funder."""

    def local_names(q):
        rows = join(scan(q, "?x", n + "Project_Title", "?t"), scan(q, "?x", n + "Funding_Commencement_Year", "?y"))
        return bind(rows, l=F.concat(slug(told("t")), F.lit("-"), F.substring(told("y"), 1, 4)))

    def grants(q):
        rows = optional(optional(scan(q, "?x", n + "Project_Title", "?t"), scan(q, "?x", n + "Project_Summary", "?d")), scan(q, "?x", n + "Funding_Amount", "?m"))
        return bind(rows, p=node("x", "-project"))

    def admin(q):
        rows = join(scan(q, "?g", n + "Administration_Organisation", "?l"), scan(q, "?g", VIVO + "fundingVehicleFor", "?x"))
        return bind(rows, o=node("g", "-adminOrg"), r=node("g", "-adminOrgRole"))

    def people(column: str, ending: str):
        def where(q):
            rows = join(join(scan(q, "?g", n + column, "?i"), scan(q, "?g", VIVO + "fundingVehicleFor", "?x")), match(q, ("?i", g + "firstName", "?v"), ("?i", g + "lastName", "?f"), ("?i", VIVO + "rank", "?k")))
            return bind(rows, o=node("g", F.concat(F.lit(ending), told("k"))), r=node("g", F.concat(F.lit(ending + "Role"), told("k"))), l=F.concat(told("f"), F.lit(", "), told("v")), card=node("o", "-vcard"), name=node("o", "-vcard-name"))

        return where

    def mail(q):
        rows = join(people("Lead_InvestigatorSplit", "-pi")(q), scan(q, "?g", n + "Email_Address_of_Lead_Investigator", "?e"))
        return bind(rows, m=node("o", "-vcard-email"))

    person = (("?o", TYPE, FOAF + "Person"), ("?o", LABEL, lit(F.col("l"))), *name_card("?o", "?card", "?name", "?f", "?v"))
    return [
        Rule("local names", local_names, (("?x", n + "localName", lit(F.col("l"))),)),
        Rule("grants", grants, (
            ("?x", TYPE, VIVO + "Grant"), ("?x", LABEL, "?t"), ("?x", VIVO + "description", "?d"), ("?x", VIVO + "totalAwardAmount", "?m"), ("?x", VIVO + "fundingVehicleFor", "?p"),
            ("?p", TYPE, VIVO + "Project"), ("?p", LABEL, "?t"), ("?p", VIVO + "description", "?d"))),
        Rule("funder", lambda q: exists(scan(q, "?x", TYPE, VIVO + "Grant"), scan(q, "?x", n + "Funding_Body", terms.literal_key(body))), (
            ("?x", VIVO + "assignedBy", funder), (funder, TYPE, VIVO + "FundingOrganization"), (funder, VIVO + "assigns", "?x"), (funder, LABEL, lit(funder_label)), (funder, terms.SAME_AS, same_as))),
        Rule("administration", admin, (("?o", TYPE, FOAF + "Organization"), ("?o", LABEL, "?l"), *role(VIVO + "AdministratorRole"))),
        interval("grant dates", VIVO + "Grant", n + "Funding_Commencement_Year", n + "Anticipated_End_Date", YEAR, end_precision, False),
        Rule("principal investigators", people("Lead_InvestigatorSplit", "-pi"), (*role(VIVO + "PrincipalInvestigatorRole"), *person)),
        Rule("their e-mail", mail, (("?card", VCARD + "hasEmail", "?m"), ("?m", TYPE, VCARD + "Email"), ("?m", TYPE, VCARD + "Work"), ("?m", VCARD + "email", "?e"))),
        Rule("investigators", people("Other_InvestigatorsSplit", "-investigator"), (*role(VIVO + "InvestigatorRole"), *person)),
    ]


def article_index(n: str, position: str, local: str, not_titles: tuple[str, ...] = (), not_topics: tuple[str, ...] = (), home: str = HOME) -> list:
    """Articles of an index with fields, affiliations and journals: its namespace, and words and topics that leave an article out."""

    def articles(q):
        rows = match(q, ("?x", n + "Ty", terms.literal_key("0")), ("?x", n + "Id", "?id"), ("?x", n + "D", "?d"), ("?x", n + "DN", "?t"))
        if not_titles:
            rows = rows.where(~told("t").rlike("(?i)" + "|".join(not_titles)))
        if not_topics:
            rows = not_exists(rows, path(q, "x", n + "F", n + "FN", end="topic").where(told("topic").isin(*not_topics)).select("x"))
        for var, p in (("doi", "DOI"), ("vol", "V"), ("iss", "I"), ("fp", "FP"), ("lp", "LP"), ("lang", "L"), ("cc", "CC"), ("ecc", "ECC")):
            rows = optional(rows, scan(q, "?x", n + p, f"?{var}"))
        return bind(rows, ident=F.concat(F.lit("msracad-"), told("id")), dtv=node("x", "-dtv"), time=F.concat(told("d"), F.lit("T00:00:00")))

    def of_articles(q):
        return join(scan(q, "?x", TYPE, BIBO + "Article"), scan(q, "?x", n + "AA", "?aa"))

    def individual(var: str) -> Column:
        return F.concat(F.lit(home + "msracad-"), told(var))

    def authors(q):
        rows = join(of_articles(q), match(q, ("?aa", n + "AuId", "?id"), ("?aa", n + "S", "?s"), ("?aa", n + "lastName", "?f"), ("?aa", n + "firstName", "?v")))
        return bind(rows, rank=to_int(told("s")), l=F.concat(told("f"), F.lit(", "), told("v")), a=node("x", F.concat(F.lit("-authorship"), F.col("rank").cast("string"))), p=individual("id"), card=node("p", "-vcard"), name=node("p", "-vcard-name"))

    def positions(q):
        rows = join(of_articles(q), match(q, ("?aa", n + "AuId", "?id"), ("?aa", n + "AfId", "?af"), ("?aa", n + "AfN", "?l")))
        return bind(rows, p=individual("id"), pos=F.concat(individual("id"), F.lit("-position-"), told("af")), o=individual("af"))

    def journals(q):
        return bind(join(match(q, ("?x", TYPE, BIBO + "Article"), ("?x", n + "BV", "?l")), path(q, "x", n + "J", n + "JId", end="id")), j=individual("id"))

    def subjects(q):
        return bind(join(match(q, ("?x", TYPE, BIBO + "Article"), ("?x", n + "F", "?field")), match(q, ("?field", n + "FN", "?l"), ("?field", n + "FId", "?id"))), c=individual("id"))

    return [
        Rule("articles", articles, (
            ("?x", TYPE, BIBO + "Article"), ("?x", VIVO + "identifier", lit(F.col("ident"))), ("?x", local + "language", "?lang"), ("?x", local + "citationCount", "?cc"), ("?x", local + "estimatedCitationCount", "?ecc"), ("?x", LABEL, "?t"),
            ("?x", BIBO + "doi", "?doi"), ("?x", BIBO + "volume", "?vol"), ("?x", BIBO + "issue", "?iss"), ("?x", BIBO + "pageStart", "?fp"), ("?x", BIBO + "pageEnd", "?lp"), ("?x", VIVO + "dateTimeValue", "?dtv"),
            ("?dtv", TYPE, VIVO + "DateTimeValue"), ("?dtv", VIVO + "dateTime", lit(F.col("time"), XSD + "dateTime")), ("?dtv", VIVO + "dateTimePrecision", YEAR))),
        Rule("authors", authors, (*authorship(), ("?a", VIVO + "rank", lit(F.col("rank"), XSD + "int")), ("?p", LABEL, lit(F.col("l"))), *name_card("?p", "?card", "?name", "?f", "?v"))),
        Rule("positions", positions, (("?pos", TYPE, VIVO + "Position"), ("?pos", VIVO + "relates", "?p"), ("?p", VIVO + "relatedBy", "?pos"), ("?pos", VIVO + "relates", "?o"), ("?o", VIVO + "relatedBy", "?pos"), ("?o", TYPE, FOAF + "Organization"), ("?o", LABEL, "?l"), ("?pos", local + "relatesDocument", "?x"), ("?x", local + "relatedByPosition", "?pos"))),
        Rule("journals", journals, (("?x", VIVO + "hasPublicationVenue", "?j"), ("?j", VIVO + "publicationVenueFor", "?x"), ("?j", TYPE, BIBO + "Journal"), ("?j", LABEL, "?l"))),
        Rule("subjects", subjects, (("?x", VIVO + "hasSubjectArea", "?c"), ("?c", VIVO + "subjectAreaOf", "?x"), ("?c", TYPE, SKOS + "Concept"), ("?c", LABEL, "?l"))),
        url_card("article URLs", lambda q: join(exists(scan(q, "?x", n + "S", "?src"), scan(q, "?x", TYPE, BIBO + "Article")), match(q, ("?src", n + "U", "?u"), ("?src", position, "?k")))),
    ]
