"""Atoms of merge rules: what makes two resources comparable, as rows (x, value), and merges that follow from others.

``resolve.same_value`` turns rows (x, value) into pairs. Equivalent resources count as one where ``roots`` are given: (node, root) of ``resolve.classes``; a resource
without a root is its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators.resolve import guarded, same_value
from quadrille.plans.patterns import bind, exists, join, match, not_exists, scan, union
from quadrille.terms import LABEL, MOST_SPECIFIC, OBO, TYPE, VCARD, VIVO

CONTACT, HAS_NAME = OBO + "ARG_2000028", VCARD + "hasName"
BEARER, REALIZED_IN = OBO + "RO_0000052", OBO + "BFO_0000054"
#: Parts of a card and where their values are. Fixed values.
CARD_PARTS = {VCARD + "hasEmail": VCARD + "email", VCARD + "hasTelephone": VCARD + "telephone", VCARD + "hasURL": VCARD + "url"}


def rooted(rows: DataFrame, column: str, roots: DataFrame | None) -> DataFrame:
    """``column`` with every resource replaced by the root of its class."""
    if roots is None:
        return rows
    side = roots.select(F.col("node").alias(column), F.col("root").alias("__root"))
    return rows.join(side, column, "left").withColumn(column, F.coalesce("__root", column)).drop("__root")


def _of(rows: DataFrame, quads: DataFrame, cls: str | None) -> DataFrame:
    return (exists(rows, scan(quads, "?x", TYPE, cls)) if cls else rows).select("x", "value").distinct()


def objects(quads: DataFrame, cls: str | None, predicate: str, roots: DataFrame | None = None) -> DataFrame:
    """The objects of a property, with repeats."""
    rows = rooted(scan(quads, "?x", predicate, "?value"), "value", roots)
    return (exists(rows, scan(quads, "?x", TYPE, cls)) if cls else rows).select("x", "value")


def object_property(quads: DataFrame, cls: str | None, predicate: str, roots: DataFrame | None = None) -> DataFrame:
    """The objects of a property."""
    return objects(quads, cls, predicate, roots).distinct()


def through_role(quads: DataFrame, cls: str | None, role_class: str, roots: DataFrame | None = None, process: bool = False) -> DataFrame:
    """What x has a role of the class in; for a process, who has such a role in it."""
    mine, other = (REALIZED_IN, BEARER) if process else (BEARER, REALIZED_IN)
    return _of(rooted(match(quads, ("?r", mine, "?x"), ("?r", TYPE, role_class), ("?r", other, "?value")), "value", roots), quads, cls)


def through_relationship(quads: DataFrame, cls: str | None, relationship_class: str, roots: DataFrame | None = None) -> DataFrame:
    """What else the relationships of the class that relate x relate."""
    rows = match(quads, ("?r", VIVO + "relates", "?x"), ("?r", TYPE, relationship_class), ("?r", VIVO + "relates", "?value")).where("x != value")
    return _of(rooted(rows, "value", roots), quads, cls)


def date_value(quads: DataFrame, cls: str | None, predicate: str = VIVO + "dateTimeValue") -> DataFrame:
    """Time and precision of a date value."""
    rows = match(quads, ("?x", predicate, "?d"), ("?d", VIVO + "dateTime", "?t"), ("?d", VIVO + "dateTimePrecision", "?p"))
    return _of(bind(rows, value=F.concat_ws("|", "t", "p")), quads, cls)


def date_interval(quads: DataFrame, cls: str | None, predicate: str = VIVO + "dateTimeInterval") -> DataFrame:
    """Start and end time of an interval; precision doesn't count."""
    rows = match(quads, ("?x", predicate, "?i"), ("?i", VIVO + "start", "?s"), ("?s", VIVO + "dateTime", "?a"), ("?i", VIVO + "end", "?e"), ("?e", VIVO + "dateTime", "?b"))
    return _of(bind(rows, value=F.concat_ws("|", "a", "b")), quads, cls)


def contact(quads: DataFrame, cls: str | None, part: str, value: str) -> DataFrame:
    """A value on the card of x: ``part`` leads from the card to the node that has ``value``."""
    return _of(match(quads, ("?x", CONTACT, "?card"), ("?card", part, "?n"), ("?n", value, "?value")), quads, cls)


def name_part(quads: DataFrame, cls: str | None, predicate: str) -> DataFrame:
    """A part of the name on the card of x."""
    return contact(quads, cls, HAS_NAME, predicate)


def card_and_name(quads: DataFrame, predicate: str) -> DataFrame:
    """Card and name node of x, where it has a part of a name."""
    rows = match(quads, ("?x", CONTACT, "?card"), ("?card", HAS_NAME, "?n"), ("?n", predicate, "?v"))
    return bind(rows, value=F.concat_ws("|", "card", "n")).select("x", "value").distinct()


def shared_card_name(quads: DataFrame, predicate: str) -> DataFrame:
    """Pairs that have one and the same card and name node, the strict reading of the name atom."""
    return same_value(card_and_name(quads, predicate))


def same_rank_authors(quads: DataFrame, roots: DataFrame, different: DataFrame | None = None) -> DataFrame:
    """Pairs of authors of one rank on equivalent works with one family name."""
    rows = match(quads, ("?a", TYPE, VIVO + "Authorship"), ("?a", VIVO + "rank", "?rank"), ("?a", VIVO + "relates", "?x"), ("?x", CONTACT, "?card"), ("?card", HAS_NAME, "?n"), ("?n", VCARD + "familyName", "?f"), ("?a", VIVO + "relates", "?work")).where("x != work")
    rows = bind(rooted(rows, "work", roots), value=F.concat_ws("|", "rank", "work", F.lower(terms.text(F.col("f")))))
    return guarded(same_value(rows.select("x", "value").distinct()), None, different)


def cards_of_equivalents(quads: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of cards whose owners are one."""
    rows = rooted(match(quads, ("?value", CONTACT, "?x")), "value", roots)
    return same_value(rows.select("x", "value").distinct())


def parts_of_cards(quads: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of names, e-mail addresses, telephone numbers and URLs with one value on equivalent cards."""
    parts = [bind(match(quads, ("?card", link, "?x"), ("?x", p, "?v")), kind=F.lit(link)) for link, p in CARD_PARTS.items()]
    names = bind(match(quads, ("?card", HAS_NAME, "?x"), ("?x", VCARD + "familyName", "?f"), ("?x", VCARD + "givenName", "?g")), v=F.concat_ws("|", "f", "g"), kind=F.lit(HAS_NAME))
    rows = rooted(union(*(p.select("card", "x", "v", "kind") for p in [*parts, names])), "card", roots)
    return same_value(bind(rows, value=F.concat_ws("|", "kind", "card", "v")).select("x", "value").distinct())


def _same_ends(quads: DataFrame, ends: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of relationships (x) of one most specific type whose two ends (a, b) are equivalent; those with a label or an interval are left out."""
    typed = join(ends, scan(quads, "?x", MOST_SPECIFIC, "?t"))
    plain = not_exists(typed, scan(quads, "?x", VIVO + "dateTimeInterval", "?i").select("x"), scan(quads, "?x", LABEL, "?l").select("x"))
    rows = rooted(rooted(plain, "a", roots), "b", roots)
    rows = bind(rows, value=F.concat_ws("|", "t", F.least("a", "b"), F.greatest("a", "b")))
    return same_value(rows.select("x", "value").distinct())


def relationships(quads: DataFrame, roots: DataFrame, classes: tuple[str, ...] = (VIVO + "Position", VIVO + "Authorship")) -> DataFrame:
    """Pairs of relationships that relate equivalent things."""
    of = scan(quads, "?x", TYPE, "?c").where(F.col("c").isin(*classes)).select("x").distinct()
    ends = exists(match(quads, ("?x", VIVO + "relates", "?a"), ("?x", VIVO + "relates", "?b")).where("a < b"), of)
    return _same_ends(quads, ends, roots)


def roles(quads: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of roles that equivalent bearers have in equivalent processes."""
    return _same_ends(quads, match(quads, ("?x", BEARER, "?a"), ("?x", REALIZED_IN, "?b")), roots)


def keep_smallest(pairs: DataFrame) -> DataFrame:
    """(old, new): each x takes the smallest y it is the same as, if that is smaller: names for ``rewrite.rename``."""
    return pairs.where("y < x").groupBy(F.col("x").alias("old")).agg(F.min("y").alias("new"))


def orphans(quads: DataFrame, classes: tuple[str, ...]) -> DataFrame:
    """Statements of instances of ``classes`` that nothing points to."""
    of = quads.where((F.col("p") == TYPE) & F.col("o_key").isin(*classes)).select("s").distinct()
    pointed = quads.where("o_kind = 'iri'").select(F.col("o").alias("s")).distinct()
    return quads.join(of.join(pointed, "s", "left_anti"), "s", "left_semi")
