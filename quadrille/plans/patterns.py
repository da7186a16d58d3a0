"""Graph patterns over quads.

Bindings are a DataFrame with a column per variable (named without '?'), holding object keys (see ``terms``); an unbound variable is
null. Every function returns a lazy plan: constants become filters that reach the scan, joins are equi-joins on the shared
variables, so Catalyst picks order and strategy.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.store import written
from quadrille.terms import Term


def scan(quads: DataFrame, s: str, p: str, o: str, g: str | None = None) -> DataFrame:
    """The bindings of one pattern. A part starting with '?' is a variable, any other a constant: an IRI, or for the object a key (``terms.literal_key``)."""
    names: dict[str, str] = {}
    rows = quads if p.startswith("?") else terms.holding(quads, [p], None if o.startswith("?") else o)
    for column, part in (("s", s), ("p", p), ("o_key", o), ("g", g)):
        if part is None:
            continue
        if not part.startswith("?"):
            rows = rows.where(F.col(column) == part)
        elif part[1:] in names:
            rows = rows.where(F.col(column) == F.col(names[part[1:]]))
        else:
            names[part[1:]] = column
    return rows.select(*(F.col(c).alias(v) for v, c in names.items()))


def shared(left: DataFrame, right: DataFrame) -> list[str]:
    found = [c for c in left.columns if c in right.columns]
    if not found:
        raise ValueError(f"no shared variable: {left.columns} and {right.columns}")
    return found


def join(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, shared(left, right))


def match(quads: DataFrame, *patterns: tuple[str, ...]) -> DataFrame:
    """The bindings of all patterns together."""
    return reduce(join, (scan(quads, *p) for p in patterns))


def star(quads: DataFrame, subject: str, **objects: str) -> DataFrame:
    """Bindings of patterns that share a subject and have constant predicates, in one pass: one shuffle by subject instead of a join for each.

    Meant for predicates with few values a subject; the values are gathered before they are combined.
    """
    values = {v: F.collect_set(F.when(F.col("p") == p, F.col("o_key"))).alias(v) for v, p in objects.items()}
    rows = terms.holding(quads, list(objects.values())).where(F.col("p").isin(list(objects.values()))).groupBy(F.col("s").alias(subject.lstrip("?"))).agg(*values.values())
    for v in objects:
        rows = rows.withColumn(v, F.explode(v))
    return rows


def optional(left: DataFrame, right: DataFrame, maybe: tuple[str, ...] = ()) -> DataFrame:
    """OPTIONAL: every row of ``left``, with what ``right`` adds. ``maybe`` names shared variables that ``left`` may have unbound: an unbound one takes any value
    of ``right``, a bound one must agree, and stays."""
    both = shared(left, right)
    keys = [c for c in both if c not in maybe]
    if not keys:
        raise ValueError("some shared variable must be bound")
    named = right.select(*(F.col(c).alias(f"__{c}" if c in both else c) for c in right.columns))
    on = [left[c] == named[f"__{c}"] for c in keys] + [left[c].isNull() | (left[c] == named[f"__{c}"]) for c in both if c in maybe]
    out = left.join(named, reduce(lambda a, b: a & b, on), "left")
    return out.select(*(F.coalesce(left[c], named[f"__{c}"]).alias(c) if c in maybe else left[c] for c in left.columns), *(named[c] for c in right.columns if c not in both))


def exists(left: DataFrame, *rights: DataFrame) -> DataFrame:
    """FILTER EXISTS of every pattern."""
    return reduce(lambda rows, right: rows.join(right.select(*shared(rows, right)), shared(rows, right), "left_semi"), rights, left)


def not_exists(left: DataFrame, *rights: DataFrame) -> DataFrame:
    """FILTER NOT EXISTS of every pattern."""
    return reduce(lambda rows, right: rows.join(right.select(*shared(rows, right)), shared(rows, right), "left_anti"), rights, left)


def union(*branches: DataFrame) -> DataFrame:
    """UNION: a variable that a branch lacks is unbound there."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    known = [terms.parts_of(b) for b in branches]
    return terms.parted(whole, [x for b, own in zip(branches, known, strict=True) for x in own or [terms.Part(b)]]) if any(known) else whole


def values(rows: DataFrame, variable: str, items: list[str]) -> DataFrame:
    """VALUES of one variable."""
    return rows.where(F.col(variable).isin(items))


def bind(rows: DataFrame, **columns: Column) -> DataFrame:
    """BIND: computed variables, in order; an expression that fails should be null (``try_`` functions)."""
    for name, column in columns.items():
        rows = rows.withColumn(name, column)
    return rows


def path_plus(edges: DataFrame, start: str, end: str, max_rounds: int = 40) -> DataFrame:
    """One or more steps along ``edges`` (two columns, from and to). Rounds double the length of paths, so there are as many as the logarithm of the longest."""
    a, b = edges.columns
    reach = written(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).distinct(), "path")
    n = reach.count()
    for _ in range(max_rounds):
        further = reach.join(reach.select(F.col("x").alias("y"), F.col("y").alias("z")), "y").select("x", F.col("z").alias("y"))
        reach = written(reach.unionByName(further).distinct(), "path")
        n, before = reach.count(), n
        if n == before:
            return reach.select(F.col("x").alias(start), F.col("y").alias(end))
    raise RuntimeError(f"paths grow after {max_rounds} rounds")


def construct(rows: DataFrame, *templates: tuple, graph: Column | str | None = None, branches: bool = False) -> DataFrame:
    """CONSTRUCT: per row a statement for each template (s, p, o), in one pass; those with an unbound part are left out, repeats too.

    A part is a variable ('?x'), a constant IRI, or a ``Term``. With ``branches`` the plan has one branch for each template and repeats stay: for rows without repeats
    whose statements patterns will scan one predicate at a time.
    """

    def column(part) -> Column:
        if isinstance(part, Term):
            return part.value
        return F.col(part[1:]) if part.startswith("?") else F.lit(part)

    def statement(s, p, o) -> Column:
        if isinstance(o, Term):
            dt = None if o.datatype == terms.XSD + "string" else o.datatype
            lang = o.lang if isinstance(o.lang, Column) else F.lit(o.lang)
            fields = o.value, F.lit(o.kind), F.lit(dt), lang, terms.known_key(o.value, o.kind, dt, o.lang)
        elif o.startswith("?"):
            fields = *terms.parts(F.col(o[1:])), F.col(o[1:])
        else:
            fields = F.lit(o), F.lit("iri"), F.lit(None), F.lit(None), F.lit(o)
        return F.struct(column(s).alias("s"), column(p).alias("p"), *(f.cast("string").alias(n) for f, n in zip(fields, terms.SCHEMA.names[3:], strict=True)))

    g = (graph if isinstance(graph, Column) else F.lit(graph).cast("string")).alias("g")
    bound = "s is not null and p is not null and o is not null"
    if branches:
        made = [rows.select(statement(*t).alias("t"), g).select("g", "t.*").where(bound) for t in templates]
        return terms.parted(union(*made), [terms.Part(x, p if isinstance(p, str) and not p.startswith("?") else None, o if isinstance(o, str) and not o.startswith("?") else None) for x, (_, p, o) in zip(made, templates, strict=True)])
    made = rows.select(F.explode(F.array(*(statement(*t) for t in templates))).alias("t"), g)
    return made.select("g", "t.*").where(bound).dropDuplicates(list(terms.KEY))
