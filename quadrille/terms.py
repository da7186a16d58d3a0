"""Terms and statements.

A statement is a row (g, s, p, o, o_kind, o_dt, o_lang, o_key). ``o`` is an IRI or the lexical form of a literal; ``o_key`` is one string that
is equal exactly for equal objects: the IRI itself, or ``"lexical"`` with ``@lang`` or ``^^datatype``. Plain literals and
xsd:string are the same. In bindings a variable holds such a key, so joins compare single strings.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
VIVO = "http://vivoweb.org/ontology/core#"
VCARD = "http://www.w3.org/2006/vcard/ns#"
OBO = "http://purl.obolibrary.org/obo/"
BIBO = "http://purl.org/ontology/bibo/"
FOAF = "http://xmlns.com/foaf/0.1/"
SKOS = "http://www.w3.org/2004/02/skos/core#"
TYPE, LABEL, SAME_AS, DIFFERENT_FROM, THING = RDF + "type", RDFS + "label", OWL + "sameAs", OWL + "differentFrom", OWL + "Thing"

MOST_SPECIFIC = "http://vitro.mannlib.cornell.edu/ns/vitro/0.7#mostSpecificType"

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("g", "s", "p", "o", "o_kind", "o_dt", "o_lang", "o_key")])
KEY = ("g", "s", "p", "o_key")


@dataclass(frozen=True)
class Origin:
    """The table that a part has a statement a row of, each row with a subject of its own: the subject, the object's key, and the condition under which there is a statement."""

    rows: DataFrame
    s: Column
    o_key: Column
    stated: Column


@dataclass(frozen=True)
class Part:
    """A part of a table of statements: all of one predicate and, if ``o`` is given, one object; of any where ``p`` is None."""

    rows: DataFrame
    p: str | None = None
    o: str | None = None
    origin: Origin | None = None


_parts: WeakKeyDictionary[DataFrame, list[Part]] = WeakKeyDictionary()


def parted(whole: DataFrame, parts: list[Part]) -> DataFrame:
    """``whole``, the union of ``parts``, which :func:`holding` then chooses from. What is made of ``whole`` in other ways is a plain DataFrame again."""
    _parts[whole] = parts
    return whole


def parts_of(quads: DataFrame) -> list[Part] | None:
    return _parts.get(quads)


def holding(quads: DataFrame, predicates: list[str], o: str | None = None) -> DataFrame:
    """The part of ``quads`` that can hold statements of ``predicates`` (and the object ``o``): all of them if nothing is known. It is left to Catalyst to filter that part."""
    parts = _parts.get(quads)
    chosen = [x.rows for x in parts or [] if x.p is None or x.p in predicates and (o is None or x.o is None or x.o == o)]
    return reduce(DataFrame.unionByName, chosen) if chosen else quads


def origins(quads: DataFrame, *patterns: tuple[str, str | None]) -> list[Origin] | None:
    """Where the statements of ``patterns`` (predicate, object or None) come from, if those of all patterns are one table's rows: no join is needed to have them together."""
    found = []
    for p, o in patterns:
        chosen = [x for x in _parts.get(quads) or [] if x.p is None or x.p == p and (o is None or x.o is None or x.o == o)]
        if len(chosen) != 1 or chosen[0].origin is None or chosen[0].o != o or found and chosen[0].origin.rows is not found[0].rows:
            return None
        found.append(chosen[0].origin)
    return found or None


@dataclass(frozen=True)
class Term:
    """An object under construction: a column and what it is."""

    value: Column
    kind: str
    datatype: str | None = None
    lang: str | Column | None = None


def iri(value: Column | str) -> Term:
    return Term(F.lit(value) if isinstance(value, str) else value, "iri")


def lit(value: Column | str, datatype: str | None = None, lang: str | Column | None = None) -> Term:
    value = F.lit(value) if isinstance(value, str) else value
    return Term(value.cast("string"), "lit", None if datatype == XSD + "string" else datatype, lang)


def key_of(o: Column, kind: Column, dt: Column, lang: Column) -> Column:
    """``o_key`` from the other object columns."""
    tail = F.when(lang.isNotNull(), F.concat(F.lit("@"), F.lower(lang))).when(dt.isNotNull() & (dt != XSD + "string"), F.concat(F.lit("^^"), dt)).otherwise(F.lit(""))
    return F.when(kind == "iri", o).otherwise(F.concat(F.lit('"'), o, F.lit('"'), tail))


def known_key(o: Column, kind: str, datatype: str | None = None, lang: str | Column | None = None) -> Column:
    """``o_key`` of an object whose kind is known beforehand: a plain expression, which patterns compare cheaply."""
    if kind == "iri":
        return o
    tail = F.lit(literal_key("", datatype)[1:])
    if isinstance(lang, Column):
        tail = F.when(lang.isNotNull(), F.concat(F.lit('"@'), F.lower(lang))).otherwise(tail)
    elif lang:
        tail = F.lit(literal_key("", lang=lang)[1:])
    return F.concat(F.lit('"'), o, tail)


def is_literal(var: Column) -> Column:
    return var.startswith('"')


def is_iri(var: Column) -> Column:
    return ~var.startswith('"')


_LITERAL = r'(?s)^"(.*)"(?:@([A-Za-z0-9-]+)|\^\^(\S+))?$'


def text(var: Column) -> Column:
    """STR(): the lexical form of a literal, an IRI as it is; null stays null."""
    plain = is_literal(var) & var.endswith('"') & (F.length(var) > 1)
    return F.when(plain, F.substr(var, F.lit(2), F.length(var) - 2)).when(is_literal(var), F.regexp_extract(var, _LITERAL, 1)).otherwise(var)


def parts(var: Column) -> tuple[Column, Column, Column, Column]:
    """(o, o_kind, o_dt, o_lang) of a variable."""
    literal, none = is_literal(var), F.lit(None).cast("string")
    found = [F.regexp_extract(var, _LITERAL, k) for k in (2, 3)]
    lang, dt = (F.when(literal & (x != ""), x).otherwise(none) for x in found)
    return text(var), F.when(literal, "lit").otherwise("iri"), dt, lang


def literal_key(value: str, datatype: str | None = None, lang: str | None = None) -> str:
    """The key of a literal that is known beforehand, for patterns."""
    return f'"{value}"' + (f"@{lang.lower()}" if lang else f"^^{datatype}" if datatype and datatype != XSD + "string" else "")


def skolem(namespace: str, *identity: Column) -> Column:
    """A deterministic IRI for a node without name: a hash of what identifies it."""
    return F.concat(F.lit(namespace + "n"), F.substring(F.sha2(F.concat_ws("\u001f", *identity), 256), 1, 16))


def quads(rows: DataFrame) -> DataFrame:
    """Rows with s, p, o and some of g, o_kind, o_dt, o_lang as statements with all columns: the missing ones are null, the kind a literal."""
    have, none = set(rows.columns), F.lit(None).cast("string")
    rows = rows.withColumns({c: none for c in ("g", "o_dt", "o_lang") if c not in have} | ({} if "o_kind" in have else {"o_kind": F.lit("lit")}))
    rows = rows.withColumn("o_dt", F.when(F.col("o_dt") != XSD + "string", F.col("o_dt")))
    return rows.withColumn("o_key", key_of(F.col("o"), F.col("o_kind"), F.col("o_dt"), F.col("o_lang"))).select(*SCHEMA.names)
