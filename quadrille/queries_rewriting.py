"""Queries of rewriting, selection, migration, sinks and the store, with their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quadrille import store, terms
from quadrille.functions import scalars
from quadrille.operators import atoms, derive, publish, rewrite, select
from quadrille.operators.lift import Field, lift
from quadrille.operators.migrate import Change, migrate, without_instances
from quadrille.plans import filters
from quadrille.plans import patterns as P
from quadrille.queries import _GRAPHS, _people
from quadrille.registry import NS, iri, number, quads, query, read, told, v
from quadrille.sources import files
from quadrille.terms import BIBO, FOAF, LABEL, OBO, TYPE, VIVO


@query(f"""
WITH k AS (SELECT p_partkey, p_brand, p_name || '|' || p_size || '|' || p_brand AS value, '{NS}part/' || p_partkey AS s FROM part)
SELECT DISTINCT min(s) OVER (PARTITION BY value) AS s, p_brand AS brand FROM k""")
def smush_by_value(spark, sf_dir):
    """Parts of one name, size and brand become one resource."""
    parts = read(spark, sf_dir, "part").withColumn("value", F.concat_ws("|", "p_name", "p_size", "p_brand"))
    q = lift(parts, iri("part", parts["p_partkey"]), {"value": Field(v("value")), "p_brand": Field(v("brand"))})
    return P.scan(select.smush(q, v("value")), "?s", v("brand"), "?brand").select("s", told("brand"))


@query(f"""
WITH c AS (SELECT *, c_nationkey % 2 = 0 AS known, CASE WHEN c_nationkey % 2 = 0 THEN '{NS}known/' ELSE '{NS}customer/' END || c_custkey AS s FROM customer)
SELECT s, '{TYPE}' AS p, '{NS}Customer' AS o FROM c UNION ALL SELECT s, '{NS}segment', c_mktsegment FROM c
UNION ALL SELECT s, '{LABEL}', c_name FROM c WHERE NOT known UNION ALL SELECT s, '{OBO}ARG_2000028', '{NS}card/' || c_custkey FROM c WHERE NOT known
UNION ALL SELECT '{NS}card/' || c_custkey, '{NS}note', c_name FROM c WHERE NOT known""")
def rename_known_resources(spark, sf_dir):
    """Customers of even nations are known elsewhere: they take their names from there, without label and card of their own."""
    rows = read(spark, sf_dir, "customer")
    rows = rows.withColumn("card", F.col("c_custkey"))
    q = P.union(
        lift(rows, iri("customer", rows["c_custkey"]), {"c_name": Field(LABEL), "c_mktsegment": Field(v("segment")), "card": Field(OBO + "ARG_2000028", NS + "card/")}, v("Customer")),
        lift(rows, iri("card", rows["c_custkey"]), {"c_name": Field(v("note"))}),
    )
    names = rows.where("c_nationkey % 2 = 0").select(iri("customer", rows["c_custkey"]).alias("old"), iri("known", rows["c_custkey"]).alias("new"))
    return select.rename_known(q, names).select("s", "p", "o")


@query(r"""
WITH w AS (SELECT p_partkey AS x, string_split(p_name || ' of the  ' || lower(p_type) || ' and for ' || p_brand || ' été', ' ') AS ws FROM part)
SELECT x, array_to_string(list_transform(ws, lambda t: CASE WHEN t IN ('the', 'and', 'of', 'for', '') THEN t ELSE upper(t[1]) || t[2:] END), ' ') AS name FROM w""")
def capitalized_names(spark, sf_dir):
    rows = read(spark, sf_dir, "part")
    text = F.concat("p_name", F.lit(" of the  "), F.lower("p_type"), F.lit(" and for "), "p_brand", F.lit(" été"))
    return rows.select(F.col("p_partkey").alias("x"), scalars.capitalize_words(text).alias("name"))


@query(f"SELECT c_custkey AS c, '{LABEL}' AS p, c_name AS o FROM customer UNION ALL SELECT c_custkey, '{NS}segment', c_mktsegment FROM customer")
def literal_objects(spark, sf_dir):
    found = P.scan(quads(spark, sf_dir, "customer"), "?c", "?p", "?o").where(terms.is_literal(F.col("o")))
    return found.select(number("c"), "p", told("o"))


@query(f"""
SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN '{NS}customer/' || c_custkey ELSE '{NS}nation/' || c_nationkey END AS x FROM customer""")
def iri_objects(spark, sf_dir):
    """Objects that are resources, some told by label and some by IRI."""
    rows = read(spark, sf_dir, "customer")
    made = rows.select(iri("customer", rows["c_custkey"]).alias("s"), F.when(rows["c_custkey"] % 3 == 0, iri("customer", rows["c_custkey"])).otherwise(iri("nation", rows["c_nationkey"])).alias("x"), terms.known_key(rows["c_name"], "lit").alias("l"))
    q = P.construct(made, ("?s", v("about"), "?x"), ("?s", v("about"), "?l"), branches=True)
    return P.scan(q, "?s", v("about"), "?x").where(terms.is_iri(F.col("x"))).select("x").distinct()


@query("SELECT c_custkey AS c FROM customer WHERE c_custkey % 7 > 3")
def bad_iris(spark, sf_dir):
    """Customers whose IRI is spoilt by a space, a quote, a bracket or a missing scheme go."""
    rows = read(spark, sf_dir, "customer")
    spoilt = F.get(F.array(F.concat(F.lit(NS + "a b/"), "c_custkey"), F.concat(F.lit(NS + 'a"b/'), "c_custkey"), F.concat(F.lit(NS + "a>b/"), "c_custkey"), F.concat(F.lit("customer/"), "c_custkey")), (F.col("c_custkey") % 7).cast("int"))
    q = lift(rows, F.coalesce(spoilt, iri("customer", rows["c_custkey"])), {}, v("Customer"))
    return P.scan(rewrite.without_bad_iris(q), "?c", TYPE, v("Customer")).select(number("c"))


@query(r"""
SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(.*?)://', 1) ELSE '' END AS scheme, CASE WHEN contains(url, '://') THEN regexp_extract(url, '://(.*)$', 1) ELSE '' END AS rest,
       CASE WHEN contains(url, '?') THEN regexp_extract(url, '\?(.*)$', 1) ELSE '' END AS query, regexp_extract(url, '([A-Za-z_À-￾][^/#:]*)$', 1) AS name FROM pages""")
def strings_before_and_after(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", scalars.strbefore(url, "://").alias("scheme"), scalars.strafter(url, "://").alias("rest"), scalars.strafter(url, "?").alias("query"), scalars.localname(url).alias("name"))


@query("SELECT doc_id, md5(text) AS text, lang FROM documents WHERE text IS NOT NULL")
def ntriples_round_trip(spark, sf_dir):
    """Whole texts, written as N-Triples to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    q = terms.quads(docs.select(iri("document", docs["doc_id"]).alias("s"), F.lit(v("text")).alias("p"), F.col("text").alias("o"), F.col("lang").alias("o_lang")).where("o is not null"))
    path = f"{store.shared_dir(spark)}/triples-{uuid.uuid4().hex}"
    files.write_ntriples(q, path)
    o, _, _, lang = terms.parts(F.col("o"))
    return P.scan(files.read_ntriples(spark, path), "?doc_id", v("text"), "?o").select(number("doc_id"), F.md5(o).alias("text"), lang.alias("lang"))


@query(_GRAPHS + f""",
named AS (SELECT canon AS s, CASE WHEN c.g = '{NS}graph/0' THEN '{NS}graph/admin' ELSE c.g END AS g, c.rank, c.label, c.note FROM c JOIN canon ON c.class = canon.class AND c.nation // 2 = canon.pair)
SELECT DISTINCT g, s, '{TYPE}' AS p, '{NS}Customer' AS o FROM named
UNION ALL SELECT DISTINCT g, s, '{NS}note', note FROM named
UNION ALL SELECT g, s, '{LABEL}', label FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY rank, label) AS nth FROM named) WHERE nth = 1""")
def publish_to_another_graph(spark, sf_dir):
    """What one graph has is published under another."""
    return publish.publish(*_people(spark, sf_dir), remap={NS + "graph/0": NS + "graph/admin"}).select("g", "s", "p", "o")


@query(f"""
SELECT '{NS}customer/' || c_custkey AS s, '{TYPE}' AS p, '{NS}Party' AS o FROM customer
UNION ALL SELECT '{NS}customer/' || c_custkey, '{NS}inNation', '{NS}nation/' || c_nationkey FROM customer
UNION ALL SELECT '{NS}nation/' || c_nationkey, '{NS}hasCustomer', '{NS}customer/' || c_custkey FROM customer
UNION ALL SELECT '{NS}customer/' || c_custkey, '{NS}name', c_name FROM customer""")
def migrate_classes(spark, sf_dir):
    """A deleted class becomes its superclass, a deleted property its superproperty or nothing, an added property the inverse of another."""
    changes = [Change(v("Customer"), None, False, "Delete"), Change(LABEL, None, False, "Delete"), Change(v("segment"), None, False, "Delete", "Delete"), Change(None, v("hasCustomer"), False, "Add")]
    return migrate(quads(spark, sf_dir, "customer", one_pass=True), changes, {v("Customer")}, {v("Customer"): v("Party"), LABEL: v("name")}, {v("hasCustomer"): v("inNation")}).select("s", "p", "o")


@query(f"""
SELECT '{NS}customer/' || c_custkey AS s FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT '{NS}nation/' || n_nationkey FROM nation""")
def migrate_without_instances(spark, sf_dir):
    """The instances of a deleted class go, with what points to them."""
    rows, nations = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    kind = F.when(F.col("c_mktsegment") == "BUILDING", v("Builder")).otherwise(v("Customer"))
    typed = rows.withColumn("kind", kind)
    q = P.union(lift(typed, iri("customer", typed["c_custkey"]), {"kind": Field(TYPE, "")}), lift(nations, iri("nation", nations["n_nationkey"]), {}, v("Nation")), lift(rows, iri("register", rows["c_nationkey"]), {"c_custkey": Field(v("lists"), NS + "customer/")}))
    left = without_instances(q, v("Builder"))
    return P.scan(left, "?s", TYPE, "?t").select("s")


@query("""
WITH n AS (SELECT o_custkey AS c, count(*) AS works FROM orders GROUP BY o_custkey) SELECT c FROM n WHERE works <= 6""")
def few_documents(spark, sf_dir):
    """Customers as authors of their orders; those with few are flagged."""
    orders = read(spark, sf_dir, "orders")
    made = orders.select(iri("by", orders["o_orderkey"]).alias("a"), iri("customer", orders["o_custkey"]).alias("x"), iri("order", orders["o_orderkey"]).alias("d"))
    q = P.union(
        P.construct(made, ("?a", TYPE, VIVO + "Authorship"), ("?a", VIVO + "relates", "?x"), ("?a", VIVO + "relates", "?d"), ("?d", TYPE, BIBO + "Document"), branches=True),
        P.construct(made.select("x").distinct(), ("?x", TYPE, FOAF + "Person"), branches=True),
    )
    return P.scan(derive.few_documents(6)(q), "?c", TYPE, derive.EXTERNAL).select(number("c"))


@query("SELECT 'card' AS kind, c_custkey AS x FROM customer WHERE c_custkey % 4 = 0")
def orphaned_cards(spark, sf_dir):
    """Cards that nothing points to."""
    rows = read(spark, sf_dir, "customer")
    q = P.union(lift(rows, iri("card", rows["c_custkey"]), {"c_name": Field(v("note"))}, v("Card")), lift(rows.where("c_custkey % 4 != 0"), iri("customer", rows["c_custkey"]), {"c_custkey": Field(atoms.CONTACT, NS + "card/")}))
    return P.scan(atoms.orphans(q, (v("Card"),)), "?x", TYPE, v("Card")).select(F.lit("card").alias("kind"), number("x"))


@query(f"""
WITH s AS (SELECT DISTINCT c_mktsegment AS segment, 'http://source.org/' || lower(c_mktsegment) || '?a=b c' AS source FROM customer)
SELECT source, '2024-06-01T12:00:00+02:00' AS version, '{NS}customer/' || c_custkey AS s, c_name AS o FROM customer JOIN s ON c_mktsegment = segment WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey <> 3
UNION ALL SELECT source, '2024-05-01T12:00:00+02:00', '{NS}customer/' || c_custkey, c_name FROM customer JOIN s ON c_mktsegment = segment WHERE c_mktsegment = 'HOUSEHOLD' AND c_nationkey <> 3""")
def store_versions(spark, sf_dir):
    """A store of a source for each segment. Two parts of a first version are appended, statements of one nation removed, two sources get a second version, that has no such statements; the last sources are
    cleaned up. What is left is the newest version of each source."""
    rows = read(spark, sf_dir, "customer")
    held = store.QuadStore(spark, f"{store.shared_dir(spark)}/store-{uuid.uuid4().hex}")
    first, second = "2024-05-01T12:00:00+02:00", "2024-06-01T12:00:00+02:00"
    named = lambda segment: f"http://source.org/{segment.lower()}?a=b c"
    for segment in ("BUILDING", "HOUSEHOLD", "MACHINERY", "FURNITURE", "AUTOMOBILE"):
        own = rows.where(F.col("c_mktsegment") == segment)
        q = lambda x: lift(x, iri("customer", x["c_custkey"]), {"c_name": Field(LABEL)}, one_pass=True)
        held.append(q(own.where("c_custkey % 2 = 0")), named(segment), first)
        held.append(q(own.where("c_custkey % 2 = 1")), named(segment), first)
        held.remove(q(own.where("c_nationkey = 3")), named(segment), first)
        if segment in ("BUILDING", "MACHINERY"):
            held.swap(held.latest(named(segment)), named(segment), second)
        if segment == "FURNITURE":
            held.clear(named(segment), first)
    held.clean_up([named("BUILDING"), named("HOUSEHOLD"), named("MACHINERY")])
    newest = [held.latest(source) for source in held.sources()]
    return P.union(*newest).where(F.col("p") == LABEL).select("source", "version", "s", "o")


@query("""
WITH good AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'), people AS (SELECT DISTINCT c_custkey, c_nationkey FROM customer JOIN good ON o_custkey = c_custkey)
SELECT 'order' AS kind, o_orderkey AS x FROM good JOIN customer ON o_custkey = c_custkey UNION ALL SELECT 'authorship', o_orderkey FROM good JOIN customer ON o_custkey = c_custkey UNION ALL SELECT 'customer', c_custkey FROM people UNION ALL SELECT 'position', c_custkey FROM people
UNION ALL SELECT DISTINCT 'nation', c_nationkey FROM people""")
def filter_irrelevant(spark, sf_dir):
    """Orders are documents of customers, who hold positions in nations. Authorships of pending orders don't tell their document: they go, then what needed them, round after round."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    work = orders.select(iri("order", orders["o_orderkey"]).alias("d"), iri("authorship", orders["o_orderkey"]).alias("a"), iri("customer", orders["o_custkey"]).alias("x"), F.when(orders["o_orderstatus"] != "P", iri("order", orders["o_orderkey"])).alias("told"))
    held = customers.select(iri("customer", customers["c_custkey"]).alias("x"), iri("position", customers["c_custkey"]).alias("p"), iri("nation", customers["c_nationkey"]).alias("n"))
    q = P.union(
        P.construct(work, ("?d", TYPE, BIBO + "Document"), ("?a", TYPE, VIVO + "Authorship"), ("?a", VIVO + "relates", "?x"), ("?x", VIVO + "relatedBy", "?a"), ("?a", VIVO + "relates", "?told"), ("?d", VIVO + "relatedBy", "?a"), branches=True),
        P.construct(held, ("?x", TYPE, FOAF + "Person"), ("?p", TYPE, VIVO + "Position"), ("?p", VIVO + "relates", "?x"), ("?p", VIVO + "relates", "?n"), ("?x", VIVO + "relatedBy", "?p"), ("?n", VIVO + "relatedBy", "?p"), branches=True),
        P.construct(held.select("n").distinct(), ("?n", TYPE, FOAF + "Organization"), branches=True),
    )
    return select.subjects(filters.relevant_part(q)).select(F.regexp_extract("x", "/([a-z]+)/[0-9]+$", 1).alias("kind"), number("x"))
