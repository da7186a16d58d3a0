"""Selecting and reshaping parts of a graph: search, neighbourhoods, dead ends, top organizations, split names, smushing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators.rewrite import rename
from quadrille.plans.patterns import construct, join, match, not_exists, path_plus, scan, union
from quadrille.plans.rules import minus
from quadrille.store import written
from quadrille.terms import OBO, TYPE, VIVO

PART_OF = OBO + "BFO_0000050"


def search(quads: DataFrame, term: str, predicates: list[str], cls: str | None = None) -> DataFrame:
    """(x): resources with ``term`` as a whole word, in any case, in a literal of one of ``predicates``."""
    word = "(?i)\\b" + "".join(c if c.isalnum() or c == " " else "\\" + c for c in term) + "\\b"
    found = quads.where(F.col("p").isin(predicates) & (F.col("o_kind") == "lit") & F.col("o").rlike(word)).select(F.col("s").alias("x")).distinct()
    return join(found, scan(quads, "?x", TYPE, cls)) if cls else found


def neighbourhood(quads: DataFrame, entities: DataFrame, hops: int = 2) -> DataFrame:
    """All statements of ``entities`` (x) and of what they point to, ``hops`` steps deep. One set-based pass a step, for all entities together."""
    reached = written(entities.select(F.col("x").alias("s")).distinct(), "reached")
    new = reached
    for _ in range(hops):
        further = quads.join(new, "s", "left_semi").where((F.col("o_kind") == "iri") & (F.col("p") != TYPE)).select(F.col("o").alias("s")).distinct()
        new = written(further.join(reached, "s", "left_anti"), "reached")
        reached = reached.unionByName(new)
    return quads.join(reached, "s", "left_semi").select(*terms.SCHEMA.names)


def relevant(quads: DataFrame, term: str, predicates: list[str], cls: str | None = None, hops: int = 2) -> DataFrame:
    """The part of a graph that is about a term: what matches, and its neighbourhood."""
    return neighbourhood(quads, search(quads, term, predicates, cls), hops)


def without_dead_ends(quads: DataFrame, relationship_classes: tuple[str, ...]) -> DataFrame:
    """Drops relationships, and statements that point to them, if something they relate has no type but owl:Thing."""
    of = scan(quads, "?r", TYPE, "?t").where(F.col("t").isin(*relationship_classes)).select("r").distinct()
    related = join(of, scan(quads, "?r", VIVO + "relates", "?x"))
    known = scan(quads, "?x", TYPE, "?t").where(F.col("t") != terms.THING).select("x").distinct()
    dead = not_exists(related, known).select("r").distinct()
    return quads.join(dead.select(F.col("r").alias("s")), "s", "left_anti").join(dead.select(F.col("r").alias("o_key")), "o_key", "left_anti").select(*terms.SCHEMA.names)


def positions_at_top(quads: DataFrame, immediate: str) -> DataFrame:
    """Positions in a part of an organization become positions in its topmost ancestor; ``immediate`` keeps the part's name on the position."""
    parents = scan(quads, "?o", PART_OF, "?up")
    above = path_plus(parents, "o", "top")
    top = not_exists(above, parents.select(F.col("o").alias("top")))
    held = join(match(quads, ("?pos", TYPE, VIVO + "Position"), ("?pos", VIVO + "relates", "?o")), top)
    named = join(held, scan(quads, "?o", terms.LABEL, "?name"))
    old = quads.where(F.col("p") == VIVO + "relates").join(held.select(F.col("pos").alias("s"), F.col("o").alias("o_key")).distinct(), ["s", "o_key"], "left_semi")
    back = quads.where(F.col("p") == VIVO + "relatedBy").join(held.select(F.col("o").alias("s"), F.col("pos").alias("o_key")).distinct(), ["s", "o_key"], "left_semi")
    made = union(construct(held, ("?pos", VIVO + "relates", "?top"), ("?top", VIVO + "relatedBy", "?pos")), construct(named, ("?pos", immediate, "?name")))
    return minus(quads, union(old, back).select(*terms.SCHEMA.names)).unionByName(made).dropDuplicates(list(terms.KEY))


def split_people(text: Column) -> Column:
    """The people of a text like 'Dr Ann Dune; Prof Bo Low': an array of struct(first, last, title, rank).

    People are parted by ';', words by spaces. A title is a first 'Dr', 'Prof' or 'A/Prof', with or without a dot. Of two words the first is the first name and the
    other the last; one word is the first name; of more the last word is the last name.
    """
    title = r"^(?i:(?:A/)?Prof|Dr|Mr|Ms|Mrs|Professor)\.?$"
    people = F.filter(F.transform(F.split(text, ";"), lambda p: F.filter(F.split(F.trim(p), " +"), lambda w: w != "")), lambda w: F.size(w) > 0)

    def person(words: Column, rank: Column) -> Column:
        titled = F.get(words, 0).rlike(title) & (F.size(words) > 1)
        name = F.when(titled, F.slice(words, 2, F.size(words))).otherwise(words)
        last = F.when(F.size(name) > 1, F.get(name, F.size(name) - 1)).otherwise("")
        first = F.when(F.size(name) > 1, F.array_join(F.slice(name, 1, F.size(name) - 1), " ")).otherwise(F.get(name, 0))
        return F.struct(first.alias("first"), last.alias("last"), F.when(titled, F.get(words, 0)).otherwise("").alias("title"), (rank + 1).alias("rank"))

    return F.transform(people, person)


def smush(quads: DataFrame, predicate: str) -> DataFrame:
    """Makes one of all resources that share a value of ``predicate``: the smallest of each value; a resource with several values takes the smallest name."""
    holders = quads.where(F.col("p") == predicate).select("s", "o_key").distinct()
    least = holders.groupBy("o_key").agg(F.min("s").alias("new"))
    return rename(quads, holders.join(least, "o_key").where("s != new").select(F.col("s").alias("old"), "new"))


def rename_known(quads: DataFrame, names: DataFrame, dropped: tuple[str, ...] = (terms.LABEL, OBO + "ARG_2000028")) -> DataFrame:
    """Renames resources that another graph knows, by ``names`` (old, new): their own labels and cards go first, and so do cards that nothing points to then."""
    known = names.select(F.col("old").alias("s")).distinct()
    own = quads.where(F.col("p").isin(*dropped)).join(known, "s", "left_semi").select(*terms.SCHEMA.names)
    cards = own.where((F.col("p") == OBO + "ARG_2000028") & (F.col("o_kind") == "iri")).select(F.col("o").alias("s")).distinct()
    rest = minus(quads, own)
    pointed = rest.where((F.col("p") == OBO + "ARG_2000028") & (F.col("o_kind") == "iri")).select(F.col("o").alias("s")).distinct()
    return rename(rest.join(cards.join(pointed, "s", "left_anti"), "s", "left_anti").select(*terms.SCHEMA.names), names)


def describe(quads: DataFrame, entities: DataFrame, max_rounds: int = 40) -> DataFrame:
    """All statements of ``entities`` (x), and of nodes without a name of their own that they point to, however deep."""
    own = r"n[0-9a-f]{16}$"  # as terms.skolem names them
    reached = new = written(entities.select(F.col("x").alias("s")).distinct(), "described")
    for _ in range(max_rounds):
        further = quads.join(new, "s", "left_semi").where((F.col("o_kind") == "iri") & F.col("o").rlike(own)).select(F.col("o").alias("s")).distinct()
        new = written(further.join(reached, "s", "left_anti"), "described")
        if new.isEmpty():
            return quads.join(reached, "s", "left_semi").select(*terms.SCHEMA.names)
        reached = reached.unionByName(new)
    raise RuntimeError(f"nodes lead on after {max_rounds} rounds")


def subjects(quads: DataFrame, cls: str | None = None) -> DataFrame:
    """(x): the typed resources, or those of a class."""
    return scan(quads, "?x", TYPE, cls or "?t").select("x").distinct()
