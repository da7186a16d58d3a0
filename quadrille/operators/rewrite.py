"""Rewriting statements: identifiers, classes, predicates, literals; and statement filters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.functions.scalars import contains_any

#: Parts of IRIs that already have a home of their own. Fixed values.
KEPT = ("orcid.org", "vivoweb.org", "aims.fao.org/aos/geopolitical")
#: Namespaces whose statements a harvest leaves behind. Fixed values.
GENERIC = ("vitro.mannlib.cornell.edu/ns/vitro/0.7", "ontology/vitro/public")


def with_objects(quads: DataFrame, o: Column) -> DataFrame:
    """``quads`` with new IRIs for objects that are IRIs; the key follows."""
    changed = quads.withColumn("o", F.when(F.col("o_kind") == "iri", o).otherwise(F.col("o")))
    return changed.withColumn("o_key", F.when(F.col("o_kind") == "iri", F.col("o")).otherwise(F.col("o_key"))).select(*terms.SCHEMA.names)


def rename(quads: DataFrame, names: DataFrame, types_too: bool = False) -> DataFrame:
    """Renames resources as subjects and objects by ``names`` (old, new); objects of rdf:type stay unless ``types_too``. Of several new names the least is taken. Repeats that arise go.

    The name table has unique keys; Spark broadcasts it below its own threshold and else shuffles, splitting hot subjects.
    """
    names = names.where("old is not null and new is not null").groupBy("old").agg(F.min("new").alias("new"))
    by_s, by_o = names.select(F.col("old").alias("s"), F.col("new").alias("new_s")), names.select(F.col("old").alias("o_key"), F.col("new").alias("new_o"))
    rows = quads.join(by_s, "s", "left").withColumn("s", F.coalesce("new_s", "s")).drop("new_s")
    rows = rows.join(by_o, "o_key", "left")
    new = F.col("new_o") if types_too else F.when(F.col("p") != terms.TYPE, F.col("new_o"))
    return with_objects(rows, F.coalesce(new, F.col("o"))).dropDuplicates(list(terms.KEY))


def rename_by_identifier(quads: DataFrame, predicate: str, namespace: str, prefix: str = "") -> DataFrame:
    """Names resources by the value of an identifying literal: namespace + prefix + value; of several values the least."""
    ids = quads.where((F.col("p") == predicate) & (F.col("o_kind") == "lit")).groupBy("s").agg(F.min("o").alias("id"))
    return rename(quads, ids.select(F.col("s").alias("old"), F.concat(F.lit(namespace + prefix), "id").alias("new")))


def home_iri(iri: Column, namespace: str, prefix: str = "") -> Column:
    """An IRI inside ``namespace``: itself if it is there or has a home of its own, else its path with '-' for '/'."""
    path = F.regexp_replace(F.regexp_replace(F.try_parse_url(iri, F.lit("PATH")), "^/", ""), "/", "-")
    return F.when(iri.startswith(namespace) | contains_any(iri, list(KEPT)), iri).otherwise(F.coalesce(F.concat(F.lit(namespace + prefix), path), iri))


def rewrite_iris(quads: DataFrame, namespace: str, prefix: str = "") -> DataFrame:
    """Brings subjects and objects into ``namespace``; objects of rdf:type stay."""
    rows = quads.withColumn("s", home_iri(F.col("s"), namespace, prefix))
    return with_objects(rows, F.when(F.col("p") == terms.TYPE, F.col("o")).otherwise(home_iri(F.col("o"), namespace, prefix)))


def reassign_types(quads: DataFrame, classes: Mapping[str, str], predicates: tuple[str, ...] = (terms.TYPE, terms.MOST_SPECIFIC)) -> DataFrame:
    """Other classes for instances, by old class."""
    new = F.col("o")
    for old, cls in classes.items():
        new = F.when(F.col("o") == old, F.lit(cls)).otherwise(new)
    return with_objects(quads, F.when(F.col("p").isin(*predicates), new).otherwise(F.col("o")))


def rename_predicates(quads: DataFrame, predicates: Mapping[str, str]) -> DataFrame:
    new = F.col("p")
    for old, p in predicates.items():
        new = F.when(F.col("p") == old, F.lit(p)).otherwise(new)
    return quads.withColumn("p", new)


def clean_literals(quads: DataFrame, tags: tuple[str, ...] = ("[i]", "[/i]")) -> DataFrame:
    """Trims literals and takes markup tags out; datatype and language stay."""
    value = F.col("o")
    for tag in tags:
        value = F.replace(value, F.lit(tag), F.lit(""))
    rows = quads.withColumn("o", F.when(F.col("o_kind") == "lit", F.trim(value)).otherwise(F.col("o")))
    return rows.withColumn("o_key", terms.key_of(F.col("o"), F.col("o_kind"), F.col("o_dt"), F.col("o_lang")))


def without_generic(quads: DataFrame, parts: tuple[str, ...] = GENERIC) -> DataFrame:
    """Drops statements whose predicate, or class, has one of ``parts`` in its IRI."""
    return quads.where(~contains_any(F.col("p"), list(parts)) & ~((F.col("p") == terms.TYPE) & contains_any(F.col("o"), list(parts))))


def without_bad_iris(quads: DataFrame) -> DataFrame:
    """Drops statements with IRIs that have white space, quotes, braces or angle brackets, or no scheme."""
    good = r'^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>"{}|\\^`]*$'
    return quads.where(F.col("s").rlike(good) & F.col("p").rlike(good) & ((F.col("o_kind") != "iri") | F.col("o").rlike(good)))


def rename_by_link(quads: DataFrame, predicate: str) -> DataFrame:
    """Names resources that nothing points to by the address that ``predicate`` gives (an IRI or a text); of several the least."""
    links = quads.where((F.col("o_kind") == "iri") & (F.col("p") != terms.TYPE)).select(F.col("o").alias("s")).distinct()
    told = quads.where((F.col("p") == predicate) & (F.col("o") != "")).join(links, "s", "left_anti").groupBy("s").agg(F.min("o").alias("new"))
    return rename(quads, told.select(F.col("s").alias("old"), "new"))
