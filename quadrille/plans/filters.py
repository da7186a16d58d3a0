"""What a harvest of a remote site leaves behind: instances that nothing relevant needs.

A table says for each class which ways make an instance relevant. All rules read the same statements; what is irrelevant goes, and again, until nothing goes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.plans.patterns import exists, join, not_exists, scan
from quadrille.store import written
from quadrille.terms import BIBO, FOAF, OBO, OWL, TYPE, VCARD, VIVO

BEARS, REALIZED_IN, ROLE, PROCESS = OBO + "RO_0000053", OBO + "BFO_0000054", OBO + "BFO_0000023", OBO + "BFO_0000015"
POSITION, GRANT, PROJECT, AUTHORSHIP, RELATIONSHIP = (VIVO + n for n in ("Position", "Grant", "Project", "Authorship", "Relationship"))
PERSON, ORGANIZATION, DOCUMENT = FOAF + "Person", FOAF + "Organization", BIBO + "Document"
RELATES, RELATED_BY = VIVO + "relates", VIVO + "relatedBy"

#: Classes none of whose instances is kept. Fixed values.
NEVER = (FOAF + "Document", OWL + "Class", OWL + "ObjectProperty", OWL + "DatatypeProperty", OWL + "AnnotationProperty")


@dataclass(frozen=True)
class Needs:
    """Instances of ``cls`` need one of ``ways``. A way is steps (predicate, class of what it leads to, or None); '^p' goes backwards, and a way of one class alone means being of that class, too."""

    cls: str
    ways: tuple


NEEDS = (
    Needs(ORGANIZATION, (((RELATED_BY, POSITION),), (("^" + RELATES, POSITION),), ((VIVO + "assigns", GRANT),), (("^" + VIVO + "assignedBy", GRANT),), ((BEARS, None), (RELATED_BY, GRANT)))),
    Needs(PERSON, (((RELATED_BY, AUTHORSHIP), (RELATES, DOCUMENT)), ((BEARS, None), (RELATED_BY, GRANT)), ((BEARS, None), (REALIZED_IN, PROJECT)))),
    Needs(POSITION, (((RELATES, PERSON),),)),
    Needs(ROLE, (((REALIZED_IN, PROJECT),), ((RELATED_BY, GRANT),))),
    Needs(PROCESS, (PROJECT,)),
    Needs(DOCUMENT, (((RELATED_BY, AUTHORSHIP), (RELATES, PERSON)),)),
    Needs(AUTHORSHIP, (((RELATES, DOCUMENT),),)),
    Needs(PROJECT, ((("^" + REALIZED_IN, None),),)),
)


def _along(quads: DataFrame, way) -> DataFrame:
    """(x) of what a way leads from."""
    if isinstance(way, str):
        return scan(quads, "?x", TYPE, way)
    rows, at = None, "x"
    for k, (p, cls) in enumerate(way):
        to = f"n{k}"
        step = scan(quads, f"?{to}", p[1:], f"?{at}") if p.startswith("^") else scan(quads, f"?{at}", p, f"?{to}")
        step = exists(step, scan(quads, f"?{to}", TYPE, cls)) if cls else step
        rows = step if rows is None else join(rows, step)
        at = to
    return rows.select("x").distinct()


def irrelevant(quads: DataFrame) -> DataFrame:
    """(x, pointed): resources whose statements go; ``pointed`` says that statements with x as object go, too."""
    typed = scan(quads, "?x", TYPE, "?t").select("x").distinct()
    links = quads.where("o_kind = 'iri'").select(F.col("o_key").alias("x")).distinct()
    found = [scan(quads, "?x", TYPE, "?t").where(F.col("t").isin(*NEVER)).select("x", F.lit(False).alias("pointed"))]
    for need in NEEDS:
        left = reduce(not_exists, (_along(quads, way) for way in need.ways), scan(quads, "?x", TYPE, need.cls))
        found.append(left.select("x", F.lit(True).alias("pointed")))
    related = scan(quads, "?x", RELATES, "?y").groupBy("x").agg(F.countDistinct("y").alias("n")).where("n > 1")
    found.append(not_exists(scan(quads, "?x", TYPE, RELATIONSHIP), related.select("x")).select("x", F.lit(True).alias("pointed")))
    alone = not_exists(typed, links)
    found.append(alone.select("x", F.lit(False).alias("pointed")))
    cards = exists(scan(quads, "?x", TYPE, VCARD + "Kind"), alone)
    children = join(cards, quads.where("o_kind = 'iri'").where(F.col("p") != TYPE).select(F.col("s").alias("x"), F.col("o_key").alias("child")))
    found.append(children.select(F.col("child").alias("x"), F.lit(False).alias("pointed")))
    return reduce(DataFrame.unionByName, found).groupBy("x").agg(F.max("pointed").alias("pointed"))


def relevant_part(quads: DataFrame, max_rounds: int = 8) -> DataFrame:
    """``quads`` without what is irrelevant, and without what is irrelevant then; rounds end when nothing goes or after ``max_rounds``."""
    for _ in range(max_rounds):
        gone = written(irrelevant(quads), "irrelevant")
        if gone.isEmpty():
            break
        left = quads.join(gone.select(F.col("x").alias("s")), "s", "left_anti").join(gone.where("pointed").select(F.col("x").alias("o_key")), "o_key", "left_anti")
        quads = written(left.select(*terms.SCHEMA.names), "relevant")
    return quads
