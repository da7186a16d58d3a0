"""The register of queries with their SQL twins, and what queries share: how driver tables become statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators.lift import Field, lift
from quadrille.plans import patterns as P
from quadrille.terms import LABEL

NS = "http://example.org/quadrille/"
FLAGSHIP = "publish_flow"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a function under its name, with its SQL twin."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def v(predicate: str) -> str:
    return NS + predicate


#: How driver tables become statements: class, key, and fields (links have a prefix). Money is in cents, as text of doubles differs between engines.
LIFTS = {
    "customer": ("Customer", "c_custkey", {"c_name": Field(LABEL), "c_nationkey": Field(v("inNation"), NS + "nation/"), "c_mktsegment": Field(v("segment"))}),
    "nation": ("Nation", "n_nationkey", {"n_name": Field(LABEL), "n_regionkey": Field(v("inRegion"), NS + "region/")}),
    "region": ("Region", "r_regionkey", {"r_name": Field(LABEL)}),
    "supplier": ("Supplier", "s_suppkey", {"s_name": Field(LABEL), "s_nationkey": Field(v("inNation"), NS + "nation/")}),
    "part": ("Part", "p_partkey", {"p_name": Field(LABEL), "p_brand": Field(v("brand")), "p_type": Field(v("kind")), "p_size": Field(v("size"), datatype=terms.XSD + "int")}),
    "orders": ("Order", "o_orderkey", {"o_custkey": Field(v("by"), NS + "customer/"), "o_orderstatus": Field(v("status")), "o_orderpriority": Field(v("urgency"))}),
}


def quads(spark: SparkSession, sf_dir: str, *tables: str, one_pass: bool = False) -> DataFrame:
    def one(table: str) -> DataFrame:
        cls, key, fields = LIFTS[table]
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        return lift(rows, iri(table, rows[key]), fields, v(cls), NS + "graph/" + table, one_pass)

    return P.union(*map(one, tables))


def iri(table: str, key: Column) -> Column:
    return F.concat(F.lit(f"{NS}{table}/"), key.cast("string"))


def number(var: str) -> Column:
    """The key in an IRI of LIFTS."""
    return F.substring_index(var, "/", -1).cast("long").alias(var)


def told(var: str) -> Column:
    return terms.text(F.col(var)).alias(var)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
