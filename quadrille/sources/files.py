"""CSV, JSON and XML records as statements; N-Triples as a sink and a source, RDF/XML as a source."""

from __future__ import annotations

import json
import re
import unicodedata
import urllib.parse
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille import terms
from quadrille.operators.lift import Field, lift
from quadrille.terms import TYPE, XSD

_BAD_TAG = re.compile(r"[^A-Za-z0-9_.\-]")


def read_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ",", quote: str = '"', null: str = "", line_sep: str | None = None) -> DataFrame:
    """Rows of CSV files with a header, all text; a row of another width fails the read."""
    reader = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).option("header", True).option("sep", sep).option("quote", quote).option("nullValue", null).option("mode", "FAILFAST").option("encoding", "UTF-8")
    return (reader.option("lineSep", line_sep) if line_sep else reader).csv(path)


def lift_csv(rows: DataFrame, namespace: str, key: list[str], fields: Mapping[str, Field], cls: str | None = None, graph: str | None = None) -> DataFrame:
    """Statements of CSV rows; a row's subject is a hash of its key columns, so a row that comes twice is one resource."""
    return lift(rows, terms.skolem(namespace, *(F.col(c) for c in key)), fields, cls, graph)


_NODES = "record string, node string, parent string, name string, position int, value string"


def _xml_nodes(record: str, source: str | None) -> Iterator[tuple]:
    """(record, node, parent, name, position, value) of elements with text or children, and attributes; nodes are paths. A source that doesn't parse gives nothing. Depth is not limited."""
    if not source:
        return
    try:
        root = ET.fromstring(unicodedata.normalize("NFC", source))
    except ET.ParseError:
        return

    filled: dict[ET.Element, bool] = {}
    for e in reversed(list(root.iter())):  # children before parents, however deep
        filled[e] = bool((e.text or "").strip() or e.attrib or any(filled[c] for c in e))

    stack = [(root, "0", None, 1)]
    while stack:
        e, path, parent, position = stack.pop()
        if not filled[e]:
            continue
        name = e.tag.rsplit("}", 1)[-1]
        children = [c for c in e if filled[c]]
        leaf = not children and not e.attrib
        yield record, path, parent, name, position, e.text.strip() if leaf or (e.text or "").strip() else None
        for k, v in sorted(e.attrib.items()):
            yield record, f"{path}@{k}", path, k.rsplit("}", 1)[-1], None, v
        stack += [(c, f"{path}.{n}", path, n) for n, c in enumerate(children, 1)]


def _json_nodes(record: str, source: str | None) -> Iterator[tuple]:
    """The same for JSON: members are children named by their keys (characters that tags can't have dropped), array items repeat the name of their array."""
    if not source:
        return
    try:
        top = json.loads(source)
    except (ValueError, RecursionError):  # not JSON, or nested deeper than the parser goes
        return
    stack = [(top, "0", None, "record", 1)]
    while stack:
        x, path, parent, name, position = stack.pop()
        if x is None or x in ("", [], {}):
            continue
        if isinstance(x, dict):
            yield record, path, parent, name, position, None
            members = [(k, v) for key, value in x.items() if (k := _BAD_TAG.sub("", key)) for v in (value if isinstance(value, list) else [value])]
            stack += [(v, f"{path}.{n}", path, k, n) for n, (k, v) in enumerate(members, 1)]
        elif isinstance(x, list):
            stack += [(v, f"{path}.{n}", parent, name, n) for n, v in enumerate(x, 1)]
        else:
            yield record, path, parent, name, position, json.dumps(x) if isinstance(x, bool) else str(x)


def nodes(records: DataFrame, id_col: str, source_col: str, kind: str) -> DataFrame:
    """The tree of each XML or JSON record as rows (record, node, parent, name, position, value). Records stay whole; nothing is shuffled."""
    read = {"xml": _xml_nodes, "json": _json_nodes}[kind]
    names = [c.split()[0] for c in _NODES.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [row for i, x in zip(frame["record"], frame["source"], strict=True) for row in read(i, x)]
            yield pd.DataFrame(found, columns=names).astype({"position": "Int32"})

    return records.select(F.col(id_col).cast("string").alias("record"), F.col(source_col).alias("source")).mapInPandas(run, _NODES)


def lift_nodes(tree: DataFrame, namespace: str, graph: str | None = None) -> DataFrame:
    """Generic statements of a tree: a leaf is a literal of its parent under its name, another node a resource linked from it, with its type and position."""
    inner = tree.where("value is null")
    me, up, name = terms.skolem(namespace, F.col("record"), F.col("node")), terms.skolem(namespace, F.col("record"), F.col("parent")), F.concat(F.lit(namespace), "name")
    none = F.lit(None).cast("string")

    def statement(s: Column, p: Column, o: Column, kind: str, dt: str | None = None) -> Column:
        return F.struct(s.alias("s"), p.alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), (F.lit(dt) if dt else none).alias("o_dt"))

    links = inner.select(F.explode(F.array(statement(me, F.lit(TYPE), name, "iri"), statement(up, name, me, "iri"), statement(me, F.lit(namespace + "position"), F.col("position").cast("string"), "lit", XSD + "int"))).alias("x"), F.col("parent"))
    links = links.where("parent is not null or x.p = '" + TYPE + "'").select("x.*")
    leaves = tree.where("value is not null").select(statement(F.when(F.col("parent").isNull(), me).otherwise(up), name, F.col("value"), "lit").alias("x")).select("x.*")
    return terms.quads(links.unionByName(leaves).withColumn("g", F.lit(graph).cast("string"))).where("s is not null and o is not null")


def to_ntriples(quads: DataFrame) -> DataFrame:
    """A line per statement."""
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("o", r"\\", r"\\\\"), '"', r'\\"'), "\n", r"\\n"), "\r", r"\\r")
    literal = F.concat(F.lit('"'), safe, F.lit('"'), F.coalesce(F.concat(F.lit("@"), "o_lang"), F.concat(F.lit("^^<"), "o_dt", F.lit(">")), F.lit("")))
    o = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), "o", F.lit(">"))).otherwise(literal)
    return quads.select(F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> "), o, F.lit(" .")).alias("value"))


def write_ntriples(quads: DataFrame, path: str) -> None:
    to_ntriples(quads).write.text(path)


def read_ntriples(spark: SparkSession, path: str, graph: str | None = None) -> DataFrame:
    """Statements of N-Triples files; lines that aren't statements are left out. A literal ends at the last quote of its line, so that long ones need no recursion in the pattern."""
    line = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"(.*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?)\s*\.\s*$'
    part = [F.regexp_extract("value", line, k) for k in range(7)]
    back = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(part[4], r"\\\\", "\u0000"), r"\\n", "\n"), r"\\r", "\r"), r'\\"', '"'), "\u0000", r"\\")
    rows = spark.read.text(path).where(part[0] != "").select(
        F.lit(graph).cast("string").alias("g"), part[1].alias("s"), part[2].alias("p"), F.when(part[3] != "", part[3]).otherwise(back).alias("o"),
        F.when(part[3] != "", "iri").otherwise("lit").alias("o_kind"), F.when(part[6] != "", part[6]).alias("o_dt"), F.when(part[5] != "", part[5]).alias("o_lang"),
    )
    return terms.quads(rows)


_RDF_SKIP = frozenset(terms.RDF + n for n in ("about", "ID", "nodeID", "resource", "datatype", "parseType", "Description"))


def _rdf_xml(record: str, source: str | None) -> Iterator[tuple]:
    """(s, p, o, o_kind, o_dt, o_lang) of one RDF/XML document: node elements and property elements, nested or referred to. Nodes without a name get one of their record and place. A document that doesn't parse gives nothing."""
    if not source:
        return
    try:
        root = ET.fromstring(source)
    except ET.ParseError:
        return
    rdf, space = "{" + terms.RDF + "}", "{http://www.w3.org/XML/1998/namespace}"

    def name(tag: str) -> str:
        return tag[1:].replace("}", "", 1) if tag.startswith("{") else tag

    def full(reference: str, base: str) -> str:
        return urllib.parse.urljoin(base, reference) if base else reference

    def of(e: ET.Element, place: str, base: str) -> str:
        if (at := e.get(rdf + "about")) is not None:
            return full(at, base)
        if (at := e.get(rdf + "ID")) is not None:
            return full("#" + at, base)
        return f"_:{record}-{e.get(rdf + 'nodeID') or 'at' + place}"

    def own(e: ET.Element, subject: str, lang: str | None) -> Iterator[tuple]:
        for k, v in e.attrib.items():
            if k.startswith("{") and not k.startswith(space) and name(k) not in _RDF_SKIP:
                yield subject, name(k), v, "iri" if name(k) == TYPE else "lit", None, lang if name(k) != TYPE else None

    nodes = list(root) if root.tag == rdf + "RDF" else [root]
    stack = [(e, str(n), root.get(space + "base", ""), root.get(space + "lang")) for n, e in enumerate(nodes)]
    while stack:
        e, place, base, lang = stack.pop()
        base, lang = e.get(space + "base", base), e.get(space + "lang", lang)
        subject = of(e, place, base)
        if e.tag != rdf + "Description":
            yield subject, TYPE, name(e.tag), "iri", None, None
        yield from own(e, subject, lang)
        items = 0
        for n, c in enumerate(e):
            here, at, inner = f"{place}.{n}", c.get(space + "base", base), c.get(space + "lang", lang)
            p, resource, kind = name(c.tag), c.get(rdf + "resource"), c.get(rdf + "parseType")
            if c.tag == rdf + "li":
                items += 1
                p = f"{terms.RDF}_{items}"
            if resource is not None or c.get(rdf + "nodeID") is not None:
                o = full(resource, at) if resource is not None else f"_:{record}-{c.get(rdf + 'nodeID')}"
                yield subject, p, o, "iri", None, None
                yield from own(c, o, inner)
            elif kind == "Literal":
                yield subject, p, (c.text or "") + "".join(ET.tostring(x, encoding="unicode") for x in c), "lit", terms.RDF + "XMLLiteral", None
            elif kind == "Resource":
                o = f"_:{record}-at{here}"
                yield subject, p, o, "iri", None, None
                part = ET.Element(rdf + "Description", {rdf + "nodeID": "at" + here})
                part.extend(list(c))
                stack.append((part, here, at, inner))
            elif kind == "Collection":
                links = [f"_:{record}-at{here}.{k}" for k in range(len(c))] + [terms.RDF + "nil"]
                yield subject, p, links[0], "iri", None, None
                for k, x in enumerate(c):
                    yield links[k], terms.RDF + "first", of(x, f"{here}.{k}x", x.get(space + "base", at)), "iri", None, None
                    yield links[k], terms.RDF + "rest", links[k + 1], "iri", None, None
                    stack.append((x, f"{here}.{k}x", at, inner))
            elif len(c):
                yield subject, p, of(c[0], here, c[0].get(space + "base", at)), "iri", None, None
                stack.append((c[0], here, at, inner))
            else:
                dt = c.get(rdf + "datatype")
                yield subject, p, c.text or "", "lit", dt, None if dt else inner


def rdf_xml(records: DataFrame, id_col: str, source_col: str, graph: str | None = None) -> DataFrame:
    """Statements of RDF/XML documents, one a row. Documents stay whole; nothing is shuffled. Depth is not limited."""
    columns = ["s", "p", "o", "o_kind", "o_dt", "o_lang"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [row for i, x in zip(frame["record"], frame["source"], strict=True) for row in _rdf_xml(i, x)]
            yield pd.DataFrame(found, columns=columns, dtype=object)

    rows = records.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("record"), F.col(source_col).alias("source"))
    return terms.quads(rows.mapInPandas(run, ", ".join(f"{c} string" for c in columns)).withColumn("g", F.lit(graph).cast("string")))


def read_rdf_xml(spark: SparkSession, path: str, graph: str | None = None) -> DataFrame:
    """Statements of RDF/XML files; a file is one document."""
    return rdf_xml(spark.read.text(path, wholetext=True).select(F.sha2(F.input_file_name(), 256).alias("file"), "value"), "file", "value", graph)
