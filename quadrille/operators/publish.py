"""Publishing: one canonical resource per equivalence class, one value per functional property, versioned graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators.resolve import classes
from quadrille.operators.rewrite import rename
from quadrille.terms import OBO, RDFS, VCARD, VIVO

#: Properties with one value beside those that the ontology declares. Fixed values.
FUNCTIONAL = (
    RDFS + "label", VIVO + "dateTimeValue", VIVO + "dateTimeInterval", VIVO + "rank", OBO + "ARG_2000028",
    *(VCARD + n for n in ("familyName", "givenName", "hasAddress", "hasName", "hasTitle", "locality", "postalCode", "region", "streetAddress")),
)
#: Further vcard properties that are meant to have one value; strict parity leaves them out. Fixed values.
MEANT_FUNCTIONAL = tuple(VCARD + n for n in ("country", "email", "telephone", "title", "url"))
#: Graphs that are never published: parts of their names. Fixed values.
NEVER = "filegraph|application|tbox|kb-inf"
UNRANKED = 2_147_483_647


def functional_properties(ontology: DataFrame | None = None, strict_parity: bool = False) -> list[str]:
    """The properties with one value: the fixed ones and those that ``ontology`` (quads, small) declares functional."""
    declared = [] if ontology is None else [r[0] for r in ontology.where((F.col("p") == terms.TYPE) & (F.col("o_key") == terms.OWL + "FunctionalProperty")).select("s").distinct().toLocalIterator()]
    return sorted({*FUNCTIONAL, *(() if strict_parity else MEANT_FUNCTIONAL), *declared})


def by_priority(sources: DataFrame) -> DataFrame:
    """(g, rank) of data sources (g, priority): ascending, those without priority last, then by name."""
    from pyspark.sql import Window as W

    order = F.coalesce("priority", F.lit(UNRANKED))
    return sources.withColumn("rank", F.row_number().over(W.orderBy(order, "g")))  # one row a data source: few


def latest_graphs(graphs: DataFrame) -> DataFrame:
    """(base, g): of graphs named base + '-' + time (yyyy-MM-ddTHH:mm:ss) the last of each base."""
    pattern = r"^(.*)-(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})$"
    named = graphs.select("g", F.regexp_extract("g", pattern, 1).alias("base"), F.regexp_extract("g", pattern, 2).alias("at")).where("base != ''")
    return named.groupBy("base").agg(F.max_by("g", "at").alias("g"))


def canonical(quads: DataFrame, edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """(old, new) for every resource with an equivalent: of its class the one whose home graph ranks best, then the smallest IRI. A home graph is one that gives a type."""
    homes = quads.where(F.col("p") == terms.TYPE).join(F.broadcast(ranks.select("g", "rank")), "g").groupBy(F.col("s").alias("node")).agg(F.min("rank").alias("rank"))
    members = classes(edges).join(homes, "node", "left").withColumn("rank", F.coalesce("rank", F.lit(UNRANKED)))
    best = members.groupBy("root").agg(F.min(F.struct("rank", "node")).alias("best"))
    return members.join(best, "root").select(F.col("node").alias("old"), F.col("best.node").alias("new"))


def shown(o: Column, dt: Column, lang: Column) -> Column:
    """An object as text, as functional values are ordered: lexical form with '@lang' or '^^datatype'."""
    return F.concat(o, F.when(lang.isNotNull(), F.concat(F.lit("@"), lang)).when(dt.isNotNull(), F.concat(F.lit("^^"), dt)).otherwise(F.lit("")))


def one_value(quads: DataFrame, ranks: DataFrame, properties: list[str] | tuple[str, ...]) -> DataFrame:
    """Keeps, for each subject and functional property, the smallest object of the best-ranked graph that has one; other statements stay.

    The best is an aggregate, so a subject with very many values is summed up before it is shuffled.
    """
    functional = F.col("p").isin(list(properties))
    ranked = quads.where(functional).join(F.broadcast(ranks.select("g", "rank")), "g", "left").withColumn("rank", F.coalesce("rank", F.lit(UNRANKED)))
    best = ranked.groupBy("s", "p").agg(F.min(F.struct("rank", shown(F.col("o"), F.col("o_dt"), F.col("o_lang")).alias("text"), "g", "o", "o_kind", "o_dt", "o_lang", "o_key")).alias("b"))
    return quads.where(~functional | F.col("p").isNull()).unionByName(best.select("b.g", "s", "p", "b.o", "b.o_kind", "b.o_dt", "b.o_lang", "b.o_key"))


def publish(quads: DataFrame, edges: DataFrame, ranks: DataFrame, properties: list[str] | tuple[str, ...] = FUNCTIONAL, remap: dict[str, str] | None = None) -> DataFrame:
    """The statements to publish: of ranked graphs only, without equivalences and graphs that are never published, canonical resources, one value where one is meant.

    ``ranks`` (g, rank) is a row per graph and is broadcast; ``remap`` moves graphs to others.
    """
    rows = quads.where((F.col("p") != terms.SAME_AS) & ~F.coalesce(F.col("g"), F.lit("")).rlike(NEVER)).join(F.broadcast(ranks.select("g")), "g", "left_semi")
    rows = one_value(rename(rows, canonical(rows, edges, ranks)), ranks, properties)
    for old, new in (remap or {}).items():
        rows = rows.withColumn("g", F.when(F.col("g") == old, F.lit(new)).otherwise(F.col("g")))
    return rows.dropDuplicates(list(terms.KEY))
