"""Migration of statements to another version of an ontology, by a list of changes and by rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators.rewrite import with_objects, without_bad_iris
from quadrille.plans.patterns import bind, construct, match
from quadrille.plans.rules import apply_rules, minus, until_stable
from quadrille.sources.files import read_csv


@dataclass(frozen=True)
class Change:
    """A row of the change list: a term's old and new name; ``change`` is 'Add', 'Delete' or empty."""

    source: str | None
    destination: str | None
    renamed: bool = False
    change: str = ""
    notes: str = ""


def read_changes(spark: SparkSession, path: str, line_sep: str | None = None) -> list[Change]:
    """The change list of a tab-separated file with five columns: source, destination, renamed (Yes), change, notes. It is small."""
    rows = read_csv(spark, path, ["source", "destination", "renamed", "change", "notes"], sep="\t", line_sep=line_sep)
    return [Change(r.source or None, r.destination or None, (r.renamed or "").strip().lower() == "yes", r.change or "", r.notes or "") for r in rows.toLocalIterator()]


def survivor(term: str, parents: Mapping[str, str], deleted: set[str], top: str | None) -> str | None:
    """The nearest ancestor that isn't deleted, else ``top``."""
    seen = set()
    while term in deleted and term not in seen:
        seen.add(term)
        term = parents.get(term, "")
    return top if not term or term in seen else term


def migrate(quads: DataFrame, changes: list[Change], classes: set[str], parents: Mapping[str, str] | None = None, inverses: Mapping[str, str] | None = None) -> DataFrame:
    """The statements under the new ontology, in one pass for all renames and deletions.

    ``classes`` tells which names are classes; others are properties. A renamed class keeps its instances, statements about the class itself go. A deleted class
    becomes its nearest surviving superclass, else owl:Thing; a deleted property its nearest surviving one, else its statements go; with the
    note 'Delete' they go in any case. For an added property with an inverse, inverse statements are added.
    """
    parents, inverses = parents or {}, inverses or {}
    deleted = {c.source for c in changes if c.change == "Delete" and c.source}
    to = {c.source: c.destination for c in changes if c.source and c.destination and (c.renamed or c.source != c.destination) and c.change != "Delete"}
    gone: set[str] = set()
    for c in changes:
        if c.change == "Delete" and c.source:
            new = survivor(c.source, parents, deleted, terms.THING if c.source in classes else None)
            if new is None or c.notes == "Delete" and c.source not in classes:
                gone.add(c.source)
            else:
                to[c.source] = new
    of_class, of_property = {a: b for a, b in to.items() if a in classes}, {a: b for a, b in to.items() if a not in classes}
    p, o = F.col("p"), F.col("o")
    for a, b in of_property.items():
        p = F.when(F.col("p") == a, F.lit(b)).otherwise(p)
    for a, b in of_class.items():
        o = F.when(F.col("o") == a, F.lit(b)).otherwise(o)
    rows = quads.where(~F.col("p").isin([*gone, ""]) & ~F.col("s").isin([*of_class, ""]))
    rows = with_objects(rows.withColumn("p", p), F.when(F.col("p") == terms.TYPE, o).otherwise(F.col("o")))
    for c in changes:
        if c.change == "Add" and c.destination in inverses:
            back = rows.where((F.col("p") == inverses[c.destination]) & (F.col("o_kind") == "iri")).select("g", F.col("o").alias("s"), F.lit(c.destination).alias("p"), F.col("s").alias("o"), "o_kind")
            rows = rows.unionByName(terms.quads(back))
    return rows.dropDuplicates(list(terms.KEY))


def update(quads: DataFrame, changes: list[Change], classes: set[str], parents: Mapping[str, str] | None = None, inverses: Mapping[str, str] | None = None, additions: Sequence = (), deletions: Sequence = (), post_additions: Sequence = (), post_deletions: Sequence = ()) -> DataFrame:
    """The whole run: additions, deletions, the change list, and further additions and deletions after it.

    Additions are rules or functions from statements to statements; what they add has good IRIs and is new. Deletions are functions that return the statements to delete, all reading the same statements.
    An added class needs nothing.
    """

    def added(rows: DataFrame, rules: Sequence) -> DataFrame:
        return apply_rules(rows, [lambda q, rule=rule: without_bad_iris(rule(q)) for rule in rules])

    def deleted(rows: DataFrame, rules: Sequence) -> DataFrame:
        return until_stable(rows, rules, 1) if rules else rows

    rows = deleted(added(quads.dropDuplicates(list(terms.KEY)), additions), deletions)
    return deleted(added(migrate(rows, changes, classes, parents, inverses), post_additions), post_deletions)


def without_instances(quads: DataFrame, cls: str) -> DataFrame:
    """Drops the instances of a class: statements about them and those that point to them."""
    gone = quads.where((F.col("p") == terms.TYPE) & (F.col("o_key") == cls)).select("s").distinct()
    return quads.join(gone, "s", "left_anti").join(gone.withColumnRenamed("s", "o_key"), "o_key", "left_anti").select(*terms.SCHEMA.names)


def move_to_card(quads: DataFrame, cls: str, predicate: str, link: str, card_predicate: str) -> DataFrame:
    """Moves a literal of the instances of ``cls`` to a node of their own (IRI with '-vcard'), linked from them; the old statements go."""
    found = bind(match(quads, ("?x", terms.TYPE, cls), ("?x", predicate, "?value")), card=F.concat("x", F.lit("-vcard")))
    made = construct(found, ("?x", link, "?card"), ("?card", terms.TYPE, terms.VCARD + "Individual"), ("?card", card_predicate, "?value"))
    old = quads.where(F.col("p") == predicate).join(found.select(F.col("x").alias("s"), F.col("value").alias("o_key")), ["s", "o_key"], "left_semi")
    return minus(quads, old).unionByName(made)
