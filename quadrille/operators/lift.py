"""Tables as statements, and statements as tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille import terms


@dataclass(frozen=True)
class Field:
    """How a column becomes objects: a literal (of a datatype or language), or the IRI ``prefix`` + value. ``split`` is a pattern that cuts it into several; values in ``nulls`` are none."""

    predicate: str
    prefix: str | None = None
    datatype: str | None = None
    lang: str | None = None
    split: str | None = None
    nulls: tuple[str, ...] = ()


_OBJECT = "struct<p:string,o:string,o_kind:string,o_dt:string,o_lang:string,o_key:string>"


def _object(p: str, o: Column, kind: str, datatype: str | None = None, lang: str | None = None) -> list[Column]:
    return [F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(datatype).cast("string").alias("o_dt"), F.lit(lang).cast("string").alias("o_lang"), terms.known_key(o, kind, datatype, lang).alias("o_key")]


def _structs(values: Column, fields: Callable[[Column], list[Column]]) -> Column:
    return F.transform(values, lambda v: F.struct(*fields(v)))


def lift(rows: DataFrame, subject: Column, fields: Mapping[str, Field], cls: str | None = None, graph: str | None = None, one_pass: bool = False, own_subjects: bool = False) -> DataFrame:
    """One statement per row, field and value, and the type. Nothing is shuffled. Values are trimmed; null and empty ones are none.

    The plan has a part for each field, with a constant predicate: a pattern on one predicate reaches the scan of one column and leaves the other parts
    out. ``one_pass`` makes all statements of a row together instead, for rows that are dear to compute or when all statements are wanted.
    ``own_subjects``: no two rows have one subject, so what compares statements of one subject can read them off the row (``terms.origins``).
    """

    def values(name: str, f: Field) -> Column:
        value = rows[name].cast("string")
        good = lambda v: v.isNotNull() & (v != "") & ~v.isin(*f.nulls) if f.nulls else v.isNotNull() & (v != "")
        return F.filter(F.transform(F.split(value, f.split) if f.split else F.array(value), lambda v: F.trim(v)), good)

    def stated(f: Field, v: Column) -> list[Column]:
        kind, dt, lang = ("iri", None, None) if f.prefix is not None else ("lit", None if f.datatype == terms.XSD + "string" else f.datatype, f.lang)
        o = F.concat(F.lit(f.prefix), v) if f.prefix else v
        return _object(f.predicate, o, kind, dt, lang)

    g, s = F.lit(graph).cast("string").alias("g"), subject.alias("s")
    typed = _object(terms.TYPE, F.lit(cls), "iri")
    if one_pass:
        made = [F.array(F.struct(*typed))] if cls else []
        made += [F.coalesce(_structs(values(n, f), partial(stated, f)), F.array().cast(f"array<{_OBJECT}>")) for n, f in fields.items()]
        return rows.select(g, s, F.explode(F.concat(*made)).alias("x")).select("g", "s", "x.*").where("s is not null")
    origin = lambda o, stated: terms.Origin(rows, subject, o, subject.isNotNull() & stated) if own_subjects else None
    branches = [terms.Part(rows.select(g, s, *typed).where("s is not null"), terms.TYPE, cls, origin(F.lit(cls), F.lit(True)))] if cls else []
    for n, f in fields.items():
        if f.split:
            each, at = rows.select(s, F.explode(values(n, f)).alias("v")), None
        else:
            text = isinstance(rows.schema[n].dataType, T.StringType)
            value = F.trim(rows[n]) if text else rows[n].cast("string")
            each = rows.select(s, value.alias("v")).where("v != ''" if text else "v is not null")
            good = value != "" if text else value.isNotNull()
            at = origin(stated(f, value)[-1], good & ~value.isin(*f.nulls) if f.nulls else good)
            each = each.where(~F.col("v").isin(*f.nulls)) if f.nulls else each
        branches.append(terms.Part(each.select(g, "s", *stated(f, F.col("v"))).where("s is not null"), f.predicate, None, at))
    return terms.parted(reduce(DataFrame.unionByName, (x.rows for x in branches)), branches)


def flatten(quads: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """A row per subject with the least lexical form of each predicate (name -> predicate): one pass, one shuffle."""
    rows = terms.holding(quads, list(fields.values())).where(F.col("p").isin(list(fields.values())))
    return rows.groupBy("s").agg(*(F.min(F.when(F.col("p") == p, F.col("o"))).alias(n) for n, p in fields.items()))
