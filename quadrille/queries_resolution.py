"""Queries of names and merges, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.functions import names
from quadrille.operators import atoms, merge, resolve
from quadrille.operators.lift import Field, lift
from quadrille.plans import patterns as P
from quadrille.registry import NS, iri, number, query, read, told, v
from quadrille.store import written
from quadrille.terms import LABEL, TYPE, VCARD, VIVO

# --- names --------------------------------------------------------------------------------------------------------------

#: Names of thirteen shapes from the words a, b (name) and c (kind) of a part. The family name is one word, two or three.
_SHAPES = """
p AS (SELECT p_partkey AS x, p_partkey % 13 AS shape, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b, lower(p_type) AS c, 'fam' || p_size AS f, 'von' || (p_size % 3) AS g, 'zu' AS h FROM part),
n AS (SELECT *, upper(a[1]) AS ia, upper(b[1]) AS ib, upper(c[1]) AS ic, a[1] AS sa, b[1] AS sb, c[1] AS sc, f[1] AS sf FROM p)
"""
#: Per shape, the forms that the written rules give: a level and its value.
_EXPECTED = {
    0: "A1:f, sa|B1:f, a|RB1:a, f",
    1: "A1:f, sa|A2:f, sa sb|B1:f, a|B2:f, a sb|C1:f, a b|RB1:ab, f",
    2: "A1:f, sa|A2:f, sa sb|A3:f, sa sb sc|B1:f, a|B2:f, a sb|B3:f, a sb sc|C1:f, a b|C2:f, a b sc|C3:f, a b c|RB1:abc, f",
    3: "A1:f, sa|A2:f, sa sb",
    4: "A1:f, sa|A2:f, sa sb|B1:f, a|B2:f, a sb",
    5: "A1:f, sb|A2:f, sa sb|B1:f, b|B2:f, sa b",
    6: "A1:f, sa|A2:f, sa sb|B1:f, a|B2:f, a sb|C1:f, a b|RB1:ab, f|B1:f, a-b",
    7: "A1:fg, sa|B1:fg, a|RB1:a, f|A1:g, sa|A2:g, sa sf|B1:g, a|B2:g, a sf|C1:g, a f|RB1:af, g",
    8: "A1:fg, sa|A2:fg, sa sb|B1:fg, a|B2:fg, a sb|C1:fg, a b|RB1:ab, f|RC1:ab, f g|A1:g, sa|A2:g, sa sb|A3:g, sa sb sf|B1:g, a|B2:g, a sb|B3:g, a sb sf|C1:g, a b|C2:g, a b sf|C3:g, a b f|RB1:abf, g",
    9: "A1:fgh, sa|A2:fgh, sa sb|A3:fgh, sa sb sc|B1:fgh, a|B2:fgh, a sb|B3:fgh, a sb sc|C1:fgh, a b|C2:fgh, a b sc|C3:fgh, a b c|RB1:abc, f|RC1:abc, f g|RC3:abc, f g h|A1:gh, sa|A2:gh, sa sb|A3:gh, sa sb sc|B1:gh, a|B2:gh, a sb|B3:gh, a sb sc"
    "|C1:gh, a b|C2:gh, a b sc|C3:gh, a b c|RB1:abcf, g|RC1:abcf, g h",
    10: "A1:f, sa|A2:f, sa sb|A3:f, sa sb sc",
    11: "A1:f, sa|A2:f, sa sb|A3:f, sa sb sc|B1:f, a|B2:f, a sb|B3:f, a sb sc",
    12: "A1:f, sa sb|A2:f, sa sb sc|A3:f, sa sb sc|B1:f, a sb|B2:f, a sb sc|B3:f, a sb sc|C1:f, a sb c|C2:f, a sb c",
}


def _expected() -> str:
    def value(text: str) -> str:
        family, given = text.split(", ")

        def glued(word: str) -> str:  # 'fgh' is f || g || h
            return word if word in ("a", "b", "c", "f", "g", "h", "sa", "sb", "sc", "sf") else " || ".join(word)

        return " || ' ' || ".join(" || '-' || ".join(map(glued, w.split("-"))) for w in family.split()) + " || ', ' || " + " || ' ' || ".join(" || '-' || ".join(map(glued, w.split("-"))) for w in given.split())

    return " UNION ALL ".join(f"SELECT x, shape, '{level}' AS level, {value(text)} AS value FROM n WHERE shape = {shape}" for shape, forms in _EXPECTED.items() for level, text in (form.split(":") for form in forms.split("|")))


_FORMS = f"WITH {_SHAPES}, forms AS (SELECT DISTINCT x, shape, level, value FROM ({_expected()}))"


def _people(spark, sf_dir) -> DataFrame:
    """(x, family, given) of parts as persons."""
    rows = read(spark, sf_dir, "part")
    a, b, c = F.get(F.split("p_name", " "), 0), F.get(F.split("p_name", " "), 1), F.lower("p_type")
    f, g, h = F.concat(F.lit("fam"), F.col("p_size").cast("string")), F.concat(F.lit("von"), (F.col("p_size") % 3).cast("string")), F.lit("zu")
    ia, ib, ic = (F.concat(F.upper(F.left(w, F.lit(1))), F.lit(".")) for w in (a, b, c))
    spaced = lambda *xs: F.concat_ws(" ", *xs)
    given = [a, spaced(a, b), spaced(a, b, c), spaced(ia, ib), spaced(a, ib), spaced(ia, b), F.concat_ws("-", a, b), a, spaced(a, b), spaced(a, b, c), F.concat(ia, ib, ic), spaced(a, ib, ic), spaced(a, ib, c)]
    family = [f, f, f, f, f, f, f, spaced(f, g), spaced(f, g), spaced(f, g, h), f, f, f]
    shape = (F.col("p_partkey") % len(given)).cast("int")
    return rows.select(F.col("p_partkey").alias("x"), F.get(F.array(*family), shape).alias("family"), F.get(F.array(*given), shape).alias("given"))


def _held(people: DataFrame) -> DataFrame:
    return people.select("x", F.md5(F.concat("family", F.lit(", "), "given")).alias("node"))


@query(_FORMS + "SELECT x, level, value FROM forms")
def author_normal_forms(spark, sf_dir):
    """Names with one to three given names, initials before, between and after them, hyphens, and family names of one to three words: all twelve levels."""
    people = _people(spark, sf_dir)
    return _held(people).join(names.forms_of(people), "node").select("x", "level", "value")


_LADDER = ", ".join("({!r}, {!r}, {!r}, {!r})".format(*step) for step in resolve.LADDER)


@query(
    _FORMS
    + f""",
steps(xl, yl, guard, guard_x) AS (VALUES {_LADDER}),
levels AS (SELECT x, list(DISTINCT level) AS ls FROM forms GROUP BY x),
held AS (SELECT forms.x, level, value, ls FROM forms JOIN levels ON forms.x = levels.x),
xs AS (SELECT x, value, yl, guard, guard_x FROM held JOIN steps ON level = xl WHERE NOT list_contains(ls, guard) AND NOT list_contains(ls, guard_x)),
open_ AS (SELECT xs.x AS x, h.x AS y FROM xs JOIN held h ON h.level = yl AND h.value = xs.value WHERE NOT list_contains(h.ls, guard) AND NOT list_contains(h.ls, guard_x)),
least_ AS (SELECT xs.x AS x, m.y FROM xs JOIN (SELECT level, value, min(x) AS y FROM held GROUP BY level, value) m ON m.level = yl AND m.value = xs.value),
pairs AS (SELECT x, y FROM open_ UNION SELECT x, y FROM least_)
SELECT x, y FROM pairs WHERE x <> y UNION SELECT y, x FROM pairs WHERE x <> y"""
)
def name_ladder(spark, sf_dir):
    """The same persons: pairs that meet on a step of the ladder, with its guards."""
    people = _people(spark, sf_dir)
    return resolve.name_ladder(_held(people), names.forms_of(people))


@query("""
WITH n AS (SELECT p_partkey AS x, p_partkey % 5 AS shape, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b FROM part),
t AS (SELECT *, CASE WHEN len(b) <= 3 THEN upper(b) ELSE upper(b[1]) || b[2:] END AS fixed_b, CASE WHEN len(a) <= 3 THEN upper(a) ELSE upper(a[1]) || a[2:] END AS fixed_a FROM n)
SELECT x, CASE shape WHEN 2 THEN upper(b[1]) || b[2:] WHEN 4 THEN fixed_b ELSE b END AS family, CASE shape WHEN 2 THEN upper(a[1]) || '.' WHEN 4 THEN fixed_a ELSE a END AS given FROM t""")
def parsed_names(spark, sf_dir):
    """Names in one string: 'family, given', 'given family', 'Family G.', with a nickname in parentheses, in capitals (words of up to three capitals pass for initials)."""
    a, b = F.get(F.split("p_name", " "), 0), F.get(F.split("p_name", " "), 1)
    texts = [F.concat(b, F.lit(", "), a), F.col("p_name"), F.concat(F.initcap(b), F.lit(" "), F.upper(F.left(a, F.lit(1))), F.lit(".")), F.concat(F.lit("(Nick) "), "p_name"), F.upper(F.concat(b, F.lit(", "), a))]
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("x"), F.get(F.array(*texts), (F.col("p_partkey") % 5).cast("int")).alias("name"))
    return rows.select("x", names.parsed(F.col("name")).alias("n")).select("x", "n.family", "n.given")


# --- atoms --------------------------------------------------------------------------------------------------------------


@query("""
WITH e AS (SELECT n_nationkey AS x, n_nationkey + 1 AS y FROM nation WHERE n_nationkey % 2 = 0)
SELECT c_custkey AS x, c_nationkey AS nation FROM customer UNION SELECT c_custkey, y FROM customer JOIN e ON c_nationkey = e.x""")
def values_through_equivalence(spark, sf_dir):
    """Customers with their nation, and with the nation that it is the same as."""
    customers, nations = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation").where("n_nationkey % 2 = 0")
    q = lift(customers, iri("customer", customers["c_custkey"]), {"c_nationkey": Field(v("inNation"), NS + "nation/")})
    edges = nations.select(iri("nation", nations["n_nationkey"]).alias("x"), iri("nation", nations["n_nationkey"] + 1).alias("y"))
    found = resolve.through_equivalence(P.scan(q, "?x", v("inNation"), "?value"), edges)
    return found.select(number("x"), F.substring_index("value", "/", -1).cast("int").alias("nation"))


def _roots(spark, sf_dir, table: str, key: str) -> DataFrame:
    """Rows 2k and 2k + 1 of a table are the same."""
    rows = read(spark, sf_dir, table)
    return rows.select(iri(table, rows[key]).alias("node"), iri(table, F.floor(rows[key] / 2) * 2).alias("root"))


@query("""
SELECT a.c_custkey AS x, b.c_custkey AS y FROM customer a JOIN customer b ON a.c_custkey // 2 = b.c_custkey // 2 AND a.c_custkey <> b.c_custkey""")
def sameas_cards(spark, sf_dir):
    """Cards of customers that are the same."""
    rows = read(spark, sf_dir, "customer").select(iri("customer", F.col("c_custkey")).alias("x"), iri("card", F.col("c_custkey")).alias("card"))
    q = P.construct(rows, ("?x", atoms.CONTACT, "?card"), branches=True)
    return atoms.cards_of_equivalents(q, _roots(spark, sf_dir, "customer", "c_custkey")).select(number("x"), number("y"))


@query("""
SELECT 'mail' AS part, a.c_custkey AS x, b.c_custkey AS y FROM customer a JOIN customer b ON a.c_custkey // 2 = b.c_custkey // 2 AND a.c_custkey <> b.c_custkey AND a.c_mktsegment = b.c_mktsegment
UNION ALL SELECT 'name', a.c_custkey, b.c_custkey FROM customer a JOIN customer b ON a.c_custkey // 2 = b.c_custkey // 2 AND a.c_custkey <> b.c_custkey AND a.c_nationkey % 3 = b.c_nationkey % 3""")
def sameas_card_parts(spark, sf_dir):
    """E-mail addresses and names with one value on cards that are the same."""
    rows = read(spark, sf_dir, "customer")
    made = rows.select(iri("card", rows["c_custkey"]).alias("card"), iri("mail", rows["c_custkey"]).alias("mail"), iri("name", rows["c_custkey"]).alias("name"), terms.known_key(rows["c_mktsegment"], "lit").alias("m"), terms.known_key((rows["c_nationkey"] % 3).cast("string"), "lit").alias("f"))
    q = P.construct(made, ("?card", VCARD + "hasEmail", "?mail"), ("?mail", VCARD + "email", "?m"), ("?card", atoms.HAS_NAME, "?name"), ("?name", VCARD + "familyName", "?f"), ("?name", VCARD + "givenName", "?f"), branches=True)
    cards = rows.select(iri("card", rows["c_custkey"]).alias("node"), iri("card", F.floor(rows["c_custkey"] / 2) * 2).alias("root"))
    return atoms.parts_of_cards(q, cards).select(F.regexp_extract("x", "/([a-z]+)/[0-9]+$", 1).alias("part"), number("x"), number("y"))


@query("""
WITH r AS (SELECT DISTINCT l_orderkey // 2 AS o, l_linenumber AS n, l_suppkey AS s, s_nationkey AS f FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT DISTINCT a.s AS x, b.s AS y FROM r a JOIN r b ON a.o = b.o AND a.n = b.n AND a.f = b.f AND a.s <> b.s""")
def sameas_authors_of_a_rank(spark, sf_dir):
    """Suppliers as authors of orders, their nation as family name, lines as ranks; orders 2k and 2k + 1 are one work."""
    lines, suppliers = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "supplier")
    link = lines.select(F.concat_ws("-", iri("line", lines["l_orderkey"]), lines["l_linenumber"].cast("string"), lines["l_suppkey"].cast("string")).alias("a"), iri("supplier", lines["l_suppkey"]).alias("x"), iri("orders", lines["l_orderkey"]).alias("work"), terms.known_key(lines["l_linenumber"].cast("string"), "lit").alias("rank")).distinct()
    people = suppliers.select(iri("supplier", suppliers["s_suppkey"]).alias("x"), iri("card", suppliers["s_suppkey"]).alias("card"), iri("name", suppliers["s_suppkey"]).alias("n"), terms.known_key(suppliers["s_nationkey"].cast("string"), "lit").alias("f"))
    q = P.union(
        P.construct(link, ("?a", TYPE, VIVO + "Authorship"), ("?a", VIVO + "rank", "?rank"), ("?a", VIVO + "relates", "?x"), ("?a", VIVO + "relates", "?work"), branches=True),
        P.construct(people, ("?x", atoms.CONTACT, "?card"), ("?card", atoms.HAS_NAME, "?n"), ("?n", VCARD + "familyName", "?f"), branches=True),
    )
    return atoms.same_rank_authors(q, _roots(spark, sf_dir, "orders", "o_orderkey")).select(number("x"), number("y"))


# --- merge runs ---------------------------------------------------------------------------------------------------------


def _config(spark, *rules: tuple[str, str, tuple[dict, ...]], disabled: tuple[str, ...] = ()) -> DataFrame:
    """A rule list as statements: (name, class, atoms by predicate)."""
    rows = []
    for name, cls, own in rules:
        rows += [(NS + name, TYPE, merge.RULE, "iri"), (NS + name, merge.CLASS, cls, "iri")]
        for k, atom in enumerate(own):
            at = f"{NS}{name}-atom-{k}"
            rows += [(NS + name, merge.HAS_ATOM, at, "iri"), *((at, p, str(o), "iri" if "://" in str(o) else "lit") for p, o in atom.items())]
    rows += [(NS + name, merge.DISABLED, "true", "lit") for name in disabled]
    return terms.quads(spark.createDataFrame(rows, "s string, p string, o string, o_kind string"))


#: Pairs of parts by two rules, their closure, and pairs of offers whose parts are the same and that are one supplier's.
_MERGED = """
WITH RECURSIVE by_brand AS (SELECT a.p_partkey AS x, b.p_partkey AS y FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey),
by_kind AS (SELECT a.p_partkey AS x, b.p_partkey AS y FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_brand = b.p_brand AND a.p_name < b.p_name AND a.p_partkey % 8 = b.p_partkey % 8),
both_kinds AS (SELECT x, y FROM by_kind UNION SELECT y, x FROM by_kind UNION
    SELECT a.p_partkey, b.p_partkey FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_brand = b.p_brand AND a.p_name = b.p_name AND a.p_partkey <> b.p_partkey AND a.p_partkey % 8 = b.p_partkey % 8),
direct AS (SELECT x, y FROM by_brand UNION SELECT x, y FROM both_kinds),
reach(x, y) AS (SELECT x, y FROM direct UNION SELECT r.x, d.y FROM reach r JOIN direct d ON r.y = d.x),
same AS (SELECT x, y FROM reach WHERE x <> y),
root AS (SELECT p_partkey AS p, least(p_partkey, coalesce(min(y), p_partkey)) AS root FROM part LEFT JOIN same ON x = p_partkey GROUP BY p_partkey),
offer AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s, root FROM lineitem JOIN root ON p = l_partkey),
merged AS (
    SELECT 'part/' || x AS x, 'part/' || y AS y, CASE WHEN (x, y) IN (SELECT x, y FROM by_brand) THEN 'by-brand' WHEN (x, y) IN (SELECT x, y FROM both_kinds) THEN 'by-kind' ELSE 'transitive' END AS rule FROM same
    UNION ALL SELECT 'offer/' || a.p || '-' || a.s, 'offer/' || b.p || '-' || b.s, 'offers' FROM offer a JOIN offer b ON a.root = b.root AND a.s = b.s AND a.p <> b.p)
"""
#: The same without the remainder, which leaves out pairs of one kind, size and brand.
_MERGED_WHOLE = _MERGED.replace(" AND a.p_partkey % 8 = b.p_partkey % 8", "")


def _merge_run(spark, sf_dir, rest: bool = False) -> merge.Found:
    """Parts are the same by name, size and brand, or by kind, size and brand (and ``rest``, a remainder); then, in the second pass, offers of one supplier whose parts are the same. A fourth rule is disabled."""
    parts = read(spark, sf_dir, "part").withColumn("rest", F.col("p_partkey") % 8)
    single = parts.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    offers = written(read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct(), "offers")
    node = F.concat_ws("-", iri("offer", offers["l_partkey"]), offers["l_suppkey"].cast("string"))
    q = P.union(
        lift(parts, iri("part", parts["p_partkey"]), {"p_name": Field(LABEL), "p_size": Field(v("size")), "p_brand": Field(v("brand")), "p_type": Field(v("kind")), "rest": Field(v("rest"))}, v("Part"), own_subjects=single),
        lift(offers, node, {"l_partkey": Field(v("part"), NS + "part/"), "l_suppkey": Field(v("from"), NS + "supplier/")}, v("Offer"), own_subjects=True),
    )
    data = lambda *ps: tuple({merge.DATA: p} for p in ps)
    config = _config(
        spark, ("by-brand", v("Part"), data(LABEL, v("size"), v("brand"))), ("by-kind", v("Part"), data(v("brand"), v("kind"), v("size"), *([v("rest")] if rest else []))),
        ("offers", v("Offer"), ({merge.OBJECT: v("from")}, {merge.OBJECT: v("part")})), ("off", v("Part"), data(v("brand"))), disabled=("off",),
    )
    return merge.merged(q, merge.load_rules(config))


@query(_MERGED + "SELECT x, y, rule FROM merged")
def merge_flow(spark, sf_dir):
    same = _merge_run(spark, sf_dir, rest=True).same()
    short = lambda c: F.substring(c, len(NS) + 1, 99).alias(c)
    return same.select(short("x"), short("y"), F.substring_index("rule", "/", -1).alias("rule"))


@query(_MERGED_WHOLE + "SELECT rule, count(*) AS pairs, count(DISTINCT x) AS resources, count(*) >= 128 AND count(*) >= count(DISTINCT x) * count(DISTINCT x) / 2 AS suspicious FROM merged GROUP BY rule")
def merge_statistics(spark, sf_dir):
    return _merge_run(spark, sf_dir).statistics().withColumn("rule", F.substring_index("rule", "/", -1))


def _qualified(spark, sf_dir, context: merge.Context, cls: str, statements: DataFrame, roots: DataFrame | None = None, data: str | None = None) -> DataFrame:
    """Pairs of one atom over a qualified property, where ``roots`` (node, root) are known to be the same. They are made of keys, which are shorter than IRIs."""
    none = spark.createDataFrame([], "x string, y string")
    known = none if roots is None else roots.where("node != root").select(F.col("node").alias("x"), F.col("root").alias("y"))
    rows = merge.Evaluation(statements, {"c": context}, known).agreed(cls, merge.Atom(data, "c"))
    return resolve.agreeing(rows.withColumn("x", number("x")), tuple(rows.columns[2:]))


def _held_roles(spark, sf_dir) -> DataFrame:
    """Suppliers have a role in an order for each line; the line's number is the role's label."""
    rows = read(spark, sf_dir, "lineitem")
    line = rows.select(F.concat_ws("-", iri("line", rows["l_orderkey"]), rows["l_linenumber"].cast("string"), rows["l_suppkey"].cast("string")).alias("r"), iri("supplier", rows["l_suppkey"]).alias("x"), iri("orders", rows["l_orderkey"]).alias("o"), terms.known_key(rows["l_linenumber"].cast("string"), "lit").alias("n"))
    return line.distinct()


@query("""
WITH r AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS n, l_suppkey AS s FROM lineitem)
SELECT DISTINCT a.s AS x, b.s AS y FROM r a JOIN r b ON a.o = b.o AND a.n = b.n AND a.s <> b.s""")
def atom_role(spark, sf_dir):
    """Suppliers with a role of one label in one order."""
    roles = _held_roles(spark, sf_dir)
    q = P.union(
        P.construct(roles, ("?x", v("bears"), "?r"), ("?r", TYPE, v("Supplying")), ("?r", atoms.REALIZED_IN, "?o"), ("?r", LABEL, "?n"), branches=True),
        P.construct(roles.select("x").distinct(), ("?x", TYPE, v("Supplier")), branches=True),
        P.construct(spark.range(1).select(F.lit(v("Supplying")).alias("k")), ("?k", terms.RDFS + "subClassOf", merge.ROLE), branches=True),
    )
    return _qualified(spark, sf_dir, merge.Context(v("bears"), v("Supplying")), v("Supplier"), q, None, LABEL)


@query("""
WITH r AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS n, l_suppkey AS s FROM lineitem)
SELECT DISTINCT a.o AS x, b.o AS y FROM r a JOIN r b ON a.s = b.s AND a.n = b.n AND a.o <> b.o AND a.o // 64 = b.o // 64""")
def atom_role_of_a_process(spark, sf_dir):
    """Orders as processes with a role of one label that one supplier has, the label being the line and a stretch of orders."""
    roles = _held_roles(spark, sf_dir).withColumn("n", terms.known_key(F.concat_ws("-", terms.text(F.col("n")), F.floor(F.substring_index("o", "/", -1).cast("long") / 64).cast("string")), "lit"))
    q = P.union(
        P.construct(roles, ("?o", v("realizes"), "?r"), ("?r", TYPE, merge.ROLE), ("?r", atoms.BEARER, "?x"), ("?r", LABEL, "?n"), branches=True),
        P.construct(roles.select("o").distinct(), ("?o", TYPE, merge.PROCESS), branches=True),
    )
    return _qualified(spark, sf_dir, merge.Context(v("realizes"), merge.ROLE), merge.PROCESS, q, None, LABEL)


@query("""
WITH r AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS n, l_suppkey AS s FROM lineitem)
SELECT DISTINCT a.s AS x, b.s AS y FROM r a JOIN r b ON a.o // 2 = b.o // 2 AND (a.o, a.n) <> (b.o, b.n) AND a.s <> b.s""")
def atom_relationship(spark, sf_dir):
    """Suppliers in different relationships with the same order, orders 2k and 2k + 1 being the same. A line is a relationship."""
    rows = read(spark, sf_dir, "lineitem")
    line = rows.select(F.concat_ws("-", iri("line", rows["l_orderkey"]), rows["l_linenumber"].cast("string")).alias("r"), iri("supplier", rows["l_suppkey"]).alias("x"), iri("orders", rows["l_orderkey"]).alias("o")).distinct()
    q = P.union(
        P.construct(line, ("?x", v("in"), "?r"), ("?r", TYPE, merge.RELATIONSHIP), ("?r", VIVO + "relates", "?o"), ("?r", VIVO + "relates", "?x"), branches=True),
        P.construct(line.select("x").distinct(), ("?x", TYPE, v("Supplier")), branches=True),
    )
    return _qualified(spark, sf_dir, merge.Context(v("in"), merge.RELATIONSHIP), v("Supplier"), q, _roots(spark, sf_dir, "orders", "o_orderkey"))


def _at(name: str, kind: str, time: Column, precision: Column) -> list:
    return [iri(name, F.col("key")).alias(kind), terms.known_key(time, "lit").alias(f"{kind}_t"), terms.known_key(precision, "lit").alias(f"{kind}_p")]


@query("""
SELECT a.o_orderkey AS x, b.o_orderkey AS y FROM orders a JOIN orders b ON a.o_orderdate = b.o_orderdate AND a.o_orderstatus = b.o_orderstatus AND a.o_orderkey <> b.o_orderkey""")
def atom_date(spark, sf_dir):
    """Orders with date values of one time and precision (the status)."""
    rows = read(spark, sf_dir, "orders").withColumn("key", F.col("o_orderkey"))
    made = rows.select(iri("orders", F.col("key")).alias("x"), *_at("date", "d", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")))
    q = P.construct(made, ("?x", TYPE, v("Order")), ("?x", VIVO + "dateTimeValue", "?d"), ("?d", TYPE, VIVO + "DateTimeValue"), ("?d", VIVO + "dateTime", "?d_t"), ("?d", VIVO + "dateTimePrecision", "?d_p"), branches=True)
    return _qualified(spark, sf_dir, merge.Context(VIVO + "dateTimeValue", VIVO + "DateTimeValue"), v("Order"), q)


@query("""
SELECT a.o_orderkey AS x, b.o_orderkey AS y FROM orders a JOIN orders b ON a.o_orderdate = b.o_orderdate AND a.o_custkey % 7 = b.o_custkey % 7 AND a.o_orderkey <> b.o_orderkey""")
def atom_interval(spark, sf_dir):
    """Orders with intervals of one start and end; the precision doesn't count."""
    rows = read(spark, sf_dir, "orders").withColumn("key", F.col("o_orderkey"))
    made = rows.select(iri("orders", F.col("key")).alias("x"), iri("interval", F.col("key")).alias("i"), *_at("start", "a", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")), *_at("end", "b", (F.col("o_custkey") % 7).cast("string"), F.col("o_orderpriority")))
    q = P.construct(made, ("?x", TYPE, v("Order")), ("?x", v("during"), "?i"), ("?i", TYPE, VIVO + "DateTimeInterval"), ("?i", VIVO + "start", "?a"), ("?a", VIVO + "dateTime", "?a_t"), ("?a", VIVO + "dateTimePrecision", "?a_p"), ("?i", VIVO + "end", "?b"), ("?b", VIVO + "dateTime", "?b_t"), branches=True)
    return _qualified(spark, sf_dir, merge.Context(v("during"), VIVO + "DateTimeInterval"), v("Order"), q)


@query("""
SELECT a.c_custkey AS x, b.c_custkey AS y FROM customer a JOIN customer b ON a.c_custkey // 3 = b.c_custkey // 3 AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey <> b.c_custkey""")
def atom_contact(spark, sf_dir):
    """Customers with one e-mail address on their cards."""
    rows = read(spark, sf_dir, "customer")
    made = rows.select(iri("customer", rows["c_custkey"]).alias("x"), iri("card", rows["c_custkey"]).alias("card"), iri("mail", rows["c_custkey"]).alias("m"), terms.known_key(F.concat_ws("@", rows["c_mktsegment"], F.floor(rows["c_custkey"] / 3).cast("string")), "lit").alias("e"))
    q = P.construct(made, ("?x", TYPE, v("Customer")), ("?x", atoms.CONTACT, "?card"), ("?card", VCARD + "hasEmail", "?m"), ("?m", TYPE, VCARD + "Work"), ("?m", VCARD + "email", "?e"), branches=True)
    return _qualified(spark, sf_dir, merge.Context(atoms.CONTACT, VCARD + "Work"), v("Customer"), q)


@query("""
SELECT a.s_suppkey AS x, b.s_suppkey AS y FROM supplier a JOIN supplier b ON a.s_nationkey // 2 = b.s_nationkey // 2 AND a.s_suppkey <> b.s_suppkey""")
def atom_of_a_class(spark, sf_dir):
    """Suppliers whose nations, values of a property that are of a class, are the same: 2k and 2k + 1."""
    suppliers, nations = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    q = P.union(lift(suppliers, iri("supplier", suppliers["s_suppkey"]), {"s_nationkey": Field(v("inNation"), NS + "nation/")}, v("Supplier")), lift(nations, iri("nation", nations["n_nationkey"]), {}, v("Nation")))
    return _qualified(spark, sf_dir, merge.Context(v("inNation"), v("Nation")), v("Supplier"), q, _roots(spark, sf_dir, "nation", "n_nationkey"))
