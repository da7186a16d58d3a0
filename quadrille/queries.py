"""Every query of the engine with its SQL twin, by name.

Each query lifts driver tables to quads (whole tables), runs an operator and projects back to flat columns; its twin is plain SQL on the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.functions import normal, scalars
from quadrille.operators import atoms, derive, publish, resolve, rewrite, select
from quadrille.operators.lift import Field, lift
from quadrille.plans import patterns as P
from quadrille.plans.rules import apply_rules, minus, until_stable
from quadrille.registry import FLAGSHIP, NS, QUERIES, SQL, iri, number, quads, query, read, told, v
from quadrille.sources import files
from quadrille.terms import FOAF, LABEL, OBO, TYPE, VIVO

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]


# --- patterns ---------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS c, n_name AS nation, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def bgp_chain_customer_region(spark, sf_dir):
    q = quads(spark, sf_dir, "customer", "nation", "region")
    found = P.match(q, ("?c", v("inNation"), "?n"), ("?n", LABEL, "?nation"), ("?n", v("inRegion"), "?r"), ("?r", LABEL, "?region"))
    return found.select(number("c"), told("nation"), told("region"))


@query("SELECT c_custkey AS c, c_name AS name, c_mktsegment AS segment FROM customer")
def bgp_star_customer(spark, sf_dir):
    return P.star(quads(spark, sf_dir, "customer"), "?c", name=LABEL, segment=v("segment")).select(number("c"), told("name"), told("segment"))


@query(f"""
SELECT '{NS}customer/' || c_custkey AS s, '{TYPE}' AS p, '{NS}Customer' AS o FROM customer
UNION ALL SELECT '{NS}customer/' || c_custkey, '{LABEL}', c_name FROM customer
UNION ALL SELECT '{NS}customer/' || c_custkey, '{NS}inNation', '{NS}nation/' || c_nationkey FROM customer
UNION ALL SELECT '{NS}customer/' || c_custkey, '{NS}segment', c_mktsegment FROM customer""")
def lift_customer_triples(spark, sf_dir):
    return quads(spark, sf_dir, "customer", one_pass=True).select("s", "p", "o")


@query("SELECT c_custkey AS c, o_orderkey AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'")
def optional_customer_orders(spark, sf_dir):
    q = quads(spark, sf_dir, "customer", "orders")
    pending = P.match(q, ("?o", v("by"), "?c"), ("?o", v("status"), terms.literal_key("P")))
    return P.optional(P.scan(q, "?c", TYPE, v("Customer")), pending).select(number("c"), number("o"))


@query("""
SELECT p.p_partkey AS x, CASE WHEN p_size > 25 THEN p_type ELSE p_brand END AS a FROM part p""")
def optional_first_match_wins(spark, sf_dir):
    q = quads(spark, sf_dir, "part")
    big = P.scan(q, "?x", v("size"), "?z").where(terms.text(F.col("z")).cast("int") > 25).select("x")
    first = P.optional(P.scan(q, "?x", TYPE, v("Part")), P.join(big, P.scan(q, "?x", v("kind"), "?a")))
    second = P.scan(q, "?x", v("brand"), "?a")
    bound = P.optional(first, second.withColumn("b", F.col("a")).select("x", "b")).withColumn("a", F.coalesce("a", "b"))
    return bound.select(number("x"), told("a"))


@query("""
SELECT c_custkey AS c, coalesce(urgent.o_orderpriority, c_mktsegment) AS a FROM customer
LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT') urgent ON urgent.o_custkey = c_custkey""")
def optional_rebinds_unbound(spark, sf_dir):
    q = quads(spark, sf_dir, "customer", "orders")
    urgent = P.match(q, ("?o", v("by"), "?c"), ("?o", v("urgency"), "?a")).where(F.col("a") == terms.literal_key("1-URGENT")).select("c", "a").distinct()
    once = P.optional(P.scan(q, "?c", TYPE, v("Customer")), urgent)
    always = P.scan(q, "?c", v("segment"), "?a")
    filled = P.optional(once.where("a is null"), always, maybe=("a",))
    return P.union(once.where("a is not null"), filled).select(number("c"), told("a"))


@query("SELECT n_name AS name FROM nation UNION SELECT p_type FROM part UNION SELECT c_mktsegment FROM customer")
def union_distinct(spark, sf_dir):
    q = quads(spark, sf_dir, "nation", "part", "customer")
    named = P.match(q, ("?x", TYPE, v("Nation")), ("?x", LABEL, "?name")).select("name")
    return P.union(named, P.scan(q, "?x", v("kind"), "?name").select("name"), P.scan(q, "?x", v("segment"), "?name").select("name")).distinct().select(told("name"))


@query("SELECT c_custkey AS c FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def minus_remove(spark, sf_dir):
    q = quads(spark, sf_dir, "customer", "orders")
    typed = q.where((F.col("p") == TYPE) & (F.col("o_key") == v("Customer")))
    filled = P.match(q, ("?o", v("by"), "?s"), ("?o", v("status"), terms.literal_key("F"))).select("s").distinct()
    return minus(typed, typed.join(filled, "s", "left_semi")).select(number("s").alias("c"))


@query("""
SELECT DISTINCT a.p_partkey AS x, b.p_partkey AS y FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey""")
def intersect_pairs(spark, sf_dir):
    q = quads(spark, sf_dir, "part")
    two = P.bind(P.star(q, "?x", n=LABEL, z=v("size")), value=F.concat_ws("|", "n", "z")).select("x", "value")
    three = P.bind(P.star(q, "?x", n=LABEL, b=v("brand")), value=F.concat_ws("|", "n", "b")).select("x", "value")
    return resolve.same_value(two).intersect(resolve.same_value(three)).select(number("x"), number("y"))


@query("SELECT c_custkey AS c FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def not_exists_orders(spark, sf_dir):
    q = quads(spark, sf_dir, "customer", "orders")
    urgent = P.match(q, ("?o", v("by"), "?c"), ("?o", v("urgency"), terms.literal_key("1-URGENT"))).select("c")
    return P.not_exists(P.scan(q, "?c", TYPE, v("Customer")), urgent).select(number("c"))


@query("""
SELECT n_nationkey AS n FROM nation WHERE NOT EXISTS (
    SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O'))""")
def nested_not_exists(spark, sf_dir):
    q = quads(spark, sf_dir, "nation", "customer", "orders")
    open_ = P.match(q, ("?o", v("by"), "?c"), ("?o", v("status"), terms.literal_key("O"))).select("c")
    without = P.not_exists(P.match(q, ("?c", TYPE, v("Customer")), ("?c", v("inNation"), "?n")), open_).select("n")
    return P.not_exists(P.scan(q, "?n", TYPE, v("Nation")), without).select(number("n"))


@query("SELECT n_nationkey AS n FROM nation WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING') OR EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey)")
def exists_any_of(spark, sf_dir):
    q = quads(spark, sf_dir, "nation", "customer", "supplier")
    building = P.match(q, ("?c", v("inNation"), "?n"), ("?c", v("segment"), terms.literal_key("BUILDING"))).select("n")
    supplied = P.match(q, ("?s", v("inNation"), "?n"), ("?s", TYPE, v("Supplier"))).select("n")
    return P.exists(P.scan(q, "?n", TYPE, v("Nation")), P.union(building, supplied)).select(number("n"))


@query("SELECT o_orderkey AS o, o_orderpriority AS urgency FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def values_inline(spark, sf_dir):
    found = P.scan(quads(spark, sf_dir, "orders"), "?o", v("urgency"), "?urgency")
    return P.values(found, "urgency", [terms.literal_key("1-URGENT"), terms.literal_key("2-HIGH")]).select(number("o"), told("urgency"))


@query("SELECT 'nation' AS g, n_name AS name FROM nation UNION ALL SELECT 'region', r_name FROM region")
def graph_filter(spark, sf_dir):
    q = quads(spark, sf_dir, "customer", "nation", "region")
    found = P.scan(q, "?s", LABEL, "?name", "?g").where(scalars.matches(F.col("g"), "graph/(nation|region)$"))
    return found.select(F.substring_index("g", "/", -1).alias("g"), told("name"))


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\blicense\b')")
def regex_search_docs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    q = lift(docs, iri("doc", docs["doc_id"]), {"text": Field(v("text"))})
    return P.scan(q, "?d", v("text"), "?t").where(scalars.matches(terms.text(F.col("t")), r"\blicense\b", "i")).select(number("d").alias("doc_id"))


@query("""
SELECT DISTINCT a.l_orderkey AS o, least(a.l_linenumber, b.l_linenumber) AS x, greatest(a.l_linenumber, b.l_linenumber) AS y FROM lineitem a JOIN lineitem b
ON a.l_orderkey = b.l_orderkey AND a.l_suppkey = b.l_suppkey AND a.l_linenumber <> b.l_linenumber""")
def theta_relationship_join(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    node = F.concat(iri("line", rows["l_orderkey"]), F.lit("-"), rows["l_linenumber"].cast("string"))
    q = lift(rows, node, {"l_orderkey": Field(v("ofOrder"), NS + "order/"), "l_suppkey": Field(v("from"), NS + "supplier/")})
    lines = P.star(q, "?a", o=v("ofOrder"), s=v("from"))
    pairs = P.join(lines, lines.withColumnRenamed("a", "b")).where("a != b")
    line = lambda c: F.substring_index(c, "-", -1).cast("int")
    return pairs.select(number("o"), F.least(line("a"), line("b")).alias("x"), F.greatest(line("a"), line("b")).alias("y")).distinct()


@query("SELECT DISTINCT a.p_partkey AS x, b.p_partkey AS y FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_partkey <> b.p_partkey")
def value_self_join(spark, sf_dir):
    both = P.bind(P.star(quads(spark, sf_dir, "part"), "?x", n=LABEL, z=v("size")), value=F.concat_ws("|", "n", "z"))
    return resolve.same_value(both.select("x", "value")).select(number("x"), number("y"))


@query("""
WITH RECURSIVE up(x, y) AS (
    SELECT p_partkey, p_partkey // 2 FROM part WHERE p_partkey > 0
    UNION SELECT up.x, up.y // 2 FROM up WHERE up.y > 0)
SELECT x, y FROM up""")
def path_plus_ancestors(spark, sf_dir):
    parts = read(spark, sf_dir, "part").where("p_partkey > 0").select("p_partkey", F.floor(F.col("p_partkey") / 2).alias("parent"))
    q = lift(parts, iri("part", parts["p_partkey"]), {"parent": Field(v("partOf"), NS + "part/")})
    return P.path_plus(P.scan(q, "?a", v("partOf"), "?b"), "x", "y").select(number("x"), number("y"))


# --- aggregates and ranks -----------------------------------------------------------------------------------------------


@query(r"""
WITH words AS (SELECT DISTINCT p_partkey AS d, unnest(string_split(p_name, ' ')) AS k FROM part),
slugs AS (SELECT d, regexp_replace(regexp_replace(lower(k), '[^a-z0-9_]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM words)
SELECT slug, count(DISTINCT d) AS works FROM slugs WHERE length(slug) BETWEEN 1 AND 31 GROUP BY slug HAVING count(DISTINCT d) >= 5""")
def count_distinct_having(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    q = lift(parts, iri("part", parts["p_partkey"]), {"p_name": Field(VIVO + "freetextKeyword", split=" ")})
    made = derive.keyword_concepts(q)
    of = P.scan(made, "?d", VIVO + "hasSubjectArea", "?c")
    return of.groupBy(F.regexp_replace("c", "^.*concept-", "").alias("slug")).agg(F.countDistinct("d").alias("works"))


@query(r"""
WITH words AS (SELECT DISTINCT doc_id AS d, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS k FROM documents),
slugs AS (SELECT d, regexp_replace(regexp_replace(lower(k), '[^a-z0-9_]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM words)
SELECT slug, count(DISTINCT d) AS works FROM slugs WHERE length(slug) BETWEEN 1 AND 31 GROUP BY slug HAVING count(DISTINCT d) >= 5""")
def count_distinct_having_words(spark, sf_dir):
    """All words of all documents as keywords."""
    documents = read(spark, sf_dir, "documents")
    q = lift(documents, iri("document", documents["doc_id"]), {"text": Field(VIVO + "freetextKeyword", split="[ \n]")})
    of = P.scan(derive.keyword_concepts(q), "?d", VIVO + "hasSubjectArea", "?c")
    return of.groupBy(F.regexp_replace("c", "^.*concept-", "").alias("slug")).agg(F.countDistinct("d").alias("works"))


@query("SELECT o_custkey AS c, min(o_orderpriority) AS least, max(o_orderpriority) AS most FROM orders GROUP BY o_custkey")
def min_max_per_subject(spark, sf_dir):
    found = P.bind(P.match(quads(spark, sf_dir, "orders"), ("?o", v("by"), "?c"), ("?o", v("urgency"), "?u")), u=terms.text(F.col("u")))
    return found.groupBy("c").agg(F.min("u").alias("least"), F.max("u").alias("most")).select(number("c"), "least", "most")


@query("SELECT DISTINCT l_orderkey AS o, l_linenumber AS position, l_linenumber - min(l_linenumber) OVER (PARTITION BY l_orderkey) + 1 AS rank FROM lineitem")
def offset_rank(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    node = F.concat(iri("line", rows["l_orderkey"]), F.lit("-"), rows["l_linenumber"].cast("string"))
    q = lift(rows, node, {"l_orderkey": Field(v("ofOrder"), NS + "order/"), "l_linenumber": Field(v("position"), datatype=terms.XSD + "int")})
    lines = P.bind(P.match(q, ("?a", v("ofOrder"), "?o"), ("?a", v("position"), "?n")), position=scalars.to_int(terms.text(F.col("n"))))
    return lines.select("o", "position", (F.col("position") - F.min("position").over(W.partitionBy("o")) + 1).alias("rank")).select(number("o"), "position", "rank")


@query("SELECT event_type AS base, strftime(max(date_trunc('second', ts)), '%Y-%m-%dT%H:%M:%S') AS version FROM events GROUP BY event_type")
def latest_version(spark, sf_dir):
    named = read(spark, sf_dir, "events").select(F.concat_ws("-", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("g")).distinct()
    return publish.latest_graphs(named).select("base", F.regexp_extract("g", r"-(\d{4}-\d{2}-\d{2}T.*)$", 1).alias("version"))


@query("SELECT row_number() OVER (ORDER BY coalesce(p, 2147483647), g) AS rank, g FROM (SELECT 'seg-' || c_mktsegment AS g, CASE WHEN count(*) % 2 = 0 THEN CAST(count(*) AS INTEGER) END AS p FROM customer GROUP BY c_mktsegment)")
def priority_order(spark, sf_dir):
    n = F.count(F.lit(1))
    sources = read(spark, sf_dir, "customer").groupBy(F.concat(F.lit("seg-"), "c_mktsegment").alias("g")).agg(F.when(n % 2 == 0, n).cast("int").alias("priority"))
    return publish.by_priority(sources).select(F.col("rank").cast("long").alias("rank"), "g")


# --- rewriting ----------------------------------------------------------------------------------------------------------


@query(f"""
SELECT '{NS}customer/' || o_custkey AS by, '{NS}order-' || o_orderkey AS x FROM orders""")
def rename_by_identifier(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    q = lift(orders, iri("tmp", orders["o_orderkey"]), {"o_custkey": Field(v("by"), NS + "customer/"), "o_orderkey": Field(v("number"))})
    return P.scan(rewrite.rename_by_identifier(q, v("number"), NS, "order-"), "?x", v("by"), "?by")


@query(f"""
SELECT DISTINCT url, CASE WHEN contains(url, 'orcid.org') OR contains(url, 'vivoweb.org') THEN url
       ELSE '{NS}web-' || replace(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^/', ''), '/', '-') END AS home FROM pages""")
def rewrite_uris(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("url", rewrite.home_iri(F.col("url"), NS, "web-").alias("home")).distinct()


@query(f"""
SELECT '{NS}customer/' || c_custkey AS s, CASE c_mktsegment WHEN 'BUILDING' THEN '{NS}Builder' ELSE '{NS}seg/' || c_mktsegment END AS o FROM customer""")
def reassign_type(spark, sf_dir):
    rows = read(spark, sf_dir, "customer")
    q = lift(rows, iri("customer", rows["c_custkey"]), {"c_mktsegment": Field(v("segmentType"), NS + "seg/")})
    q = rewrite.reassign_types(rewrite.rename_predicates(q, {v("segmentType"): TYPE}), {NS + "seg/BUILDING": v("Builder")})
    return q.where(F.col("p") == TYPE).select("s", "o")


@query("SELECT c_custkey AS c, c_mktsegment || ' x' AS o FROM customer")
def trim_literals(spark, sf_dir):
    rows = read(spark, sf_dir, "customer")
    marked = terms.quads(rows.select(iri("customer", rows["c_custkey"]).alias("s"), F.lit(v("note")).alias("p"), F.concat(F.lit("  [i]"), "c_mktsegment", F.lit("[/i] x ")).alias("o")))
    return rewrite.clean_literals(marked).select(number("s").alias("c"), "o")


@query(r"""
WITH t AS (SELECT p_partkey AS x, ['Dr ', 'Prof. ', 'a/prof  ', '', 'Mrs '][p_size % 5 + 1] || p_name || ';; ' || p_type || ' ; ' || p_brand || ' ' || p_name || ';' || CASE WHEN p_size % 2 = 0 THEN ' Ms. ' || p_brand ELSE 'Dr' END || '; ' AS people FROM part),
e AS (SELECT x, list_filter(list_transform(string_split(people, ';'), lambda p: trim(p)), lambda p: p <> '') AS ps FROM t),
r AS (SELECT x, unnest(ps) AS person, generate_subscripts(ps, 1) AS rank FROM e),
w AS (SELECT x, rank, list_filter(string_split(person, ' '), lambda t: t <> '') AS words FROM r),
n AS (SELECT x, rank, words, len(words) > 1 AND lower(rtrim(words[1], '.')) IN ('dr', 'prof', 'a/prof', 'mr', 'ms', 'mrs', 'professor') AS titled FROM w),
m AS (SELECT x, rank, CASE WHEN titled THEN words[1] ELSE '' END AS title, CASE WHEN titled THEN words[2:] ELSE words END AS name FROM n)
SELECT x, CASE WHEN len(name) > 1 THEN array_to_string(name[1:len(name) - 1], ' ') ELSE name[1] END AS first, CASE WHEN len(name) > 1 THEN name[len(name)] ELSE '' END AS last, title, CAST(rank AS INTEGER) AS rank FROM m""")
def split_ranked_people(spark, sf_dir):
    """The people of a text made of a part's columns: with and without titles, of one to three words, with empty entries between them."""
    rows = read(spark, sf_dir, "part")
    title = F.get(F.array(*map(F.lit, ("Dr ", "Prof. ", "a/prof  ", "", "Mrs "))), F.col("p_size") % 5)
    other = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" Ms. "), "p_brand")).otherwise("Dr")
    text = F.concat(title, "p_name", F.lit(";; "), "p_type", F.lit(" ; "), "p_brand", F.lit(" "), "p_name", F.lit(";"), other, F.lit("; "))
    return rows.select(F.col("p_partkey").alias("x"), F.explode(select.split_people(text)).alias("person")).select("x", "person.*")


@query(f"SELECT '{NS}customer/' || c_custkey AS s, '{LABEL}' AS p FROM customer UNION ALL SELECT '{NS}customer/' || c_custkey, '{TYPE}' FROM customer")
def filter_predicates(spark, sf_dir):
    return rewrite.without_generic(quads(spark, sf_dir, "customer"), (NS + "inNation", NS + "segment")).select("s", "p")


@query("""
WITH RECURSIVE gone(x) AS (
    SELECT p_partkey FROM part WHERE p_size = 1
    UNION SELECT p.p_partkey FROM part p JOIN gone ON p.p_partkey // 16 = gone.x AND p.p_partkey > 0)
SELECT p_partkey AS x FROM part WHERE p_partkey NOT IN (SELECT x FROM gone)""")
def filter_fixpoint(spark, sf_dir):
    """A part goes if its size is 1 or if what it belongs to is gone."""
    parts = read(spark, sf_dir, "part").withColumn("parent", F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 16)))
    q = lift(parts, iri("part", parts["p_partkey"]), {"p_size": Field(v("size")), "parent": Field(v("partOf"), NS + "part/")}, v("Part"))

    def small(rows):
        return rows.join(P.scan(rows, "?s", v("size"), terms.literal_key("1")), "s", "left_semi")

    def orphans(rows):
        lost = P.not_exists(P.scan(rows, "?s", v("partOf"), "?up"), P.scan(rows, "?up", TYPE, v("Part")))
        return rows.join(lost.select("s"), "s", "left_semi")

    return P.scan(until_stable(q, [small, orphans], 12), "?x", TYPE, v("Part")).select(number("x"))


@query("SELECT o_orderkey AS o FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')")
def dead_end_prune(spark, sf_dir):
    """Orders relate to customers, of which only builders have a type of their own; orders of others lead nowhere."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    typed = customers.withColumn("type", F.when(F.col("c_mktsegment") == "BUILDING", v("Builder")).otherwise(terms.THING))
    q = P.union(lift(orders, iri("order", orders["o_orderkey"]), {"o_custkey": Field(VIVO + "relates", NS + "customer/")}, v("Order")), lift(typed, iri("customer", typed["c_custkey"]), {"type": Field(TYPE, "")}))
    return P.scan(select.without_dead_ends(q, (v("Order"),)), "?o", TYPE, v("Order")).select(number("o"))


@query("SELECT o_orderkey AS o, strftime(o_orderdate, '%Y') || '-01-01T00:00:00Z' AS t FROM orders")
def year_precision_dates(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.concat(F.lit(NS + "order/"), F.col("o_orderkey").cast("string")).alias("o"), F.date_format("o_orderdate", "yyyy").alias("year"))
    made = derive.dated(orders, "o", "year")
    return P.match(made, ("?o", VIVO + "dateTimeValue", "?d"), ("?d", VIVO + "dateTime", "?t")).select(number("o"), told("t"))


# --- sources ------------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey AS x, unnest(string_split(p_name, ' ')) AS word FROM part")
def csv_split_values(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), "p_name")
    q = files.lift_csv(parts, NS, ["key"], {"key": Field(v("key")), "p_name": Field(v("word"), split=" ", nulls=("N/A",))})
    return P.match(q, ("?s", v("key"), "?x"), ("?s", v("word"), "?word")).select(terms.text(F.col("x")).cast("long").alias("x"), told("word"))


@query("SELECT x, line FROM (SELECT doc_id AS x, trim(unnest(string_split(text, chr(10)))) AS line FROM documents) WHERE line NOT IN ('', 'N/A')")
def csv_split_values_lines(spark, sf_dir):
    """All lines of all documents."""
    documents = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "text")
    q = files.lift_csv(documents, NS, ["key"], {"key": Field(v("key")), "text": Field(v("line"), split="\n", nulls=("N/A",))})
    return P.match(q, ("?s", v("key"), "?x"), ("?s", v("line"), "?line")).select(terms.text(F.col("x")).cast("long").alias("x"), told("line"))


@query("SELECT n_nationkey AS n, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation")
def xml_lift_nations(spark, sf_dir):
    rows = read(spark, sf_dir, "nation").select("n_nationkey", F.format_string('<nation region="%s"><name>%s</name><empty> </empty></nation>', F.col("n_regionkey").cast("string"), "n_name").alias("xml"))
    tree = files.nodes(rows, "n_nationkey", "xml", "xml")
    found = P.match(files.lift_nodes(tree, NS), ("?s", TYPE, v("nation")), ("?s", v("name"), "?name"), ("?s", v("region"), "?region"))
    ids = tree.where("parent is null").select(terms.skolem(NS, F.col("record"), F.col("node")).alias("s"), F.col("record").cast("int").alias("n"))
    return P.join(found, ids).select("n", told("name"), told("region"))


@query("SELECT event_id AS e, CAST(props->>'k' AS INTEGER) AS k FROM events WHERE props->>'k' IS NOT NULL")
def json_lift_events(spark, sf_dir):
    tree = files.nodes(read(spark, sf_dir, "events"), "event_id", "props", "json")
    ids = tree.where("parent is null").select(terms.skolem(NS, F.col("record"), F.col("node")).alias("s"), F.col("record").cast("long").alias("e"))
    return P.join(P.scan(files.lift_nodes(tree, NS), "?s", v("k"), "?k"), ids).select("e", scalars.to_int(terms.text(F.col("k"))).alias("k"))


@query("SELECT event_id AS e, CAST(props->>'k' AS INTEGER) AS k FROM events WHERE props->>'k' IS NOT NULL")
def json_tree_events(spark, sf_dir):
    tree = files.nodes(read(spark, sf_dir, "events"), "event_id", "props", "json")
    return tree.where("name = 'k'").select(F.col("record").cast("long").alias("e"), F.col("value").cast("int").alias("k"))


@query("SELECT page_id, url, md5(trim(html, chr(32) || chr(9) || chr(10) || chr(13))) AS body FROM pages")
def xml_lift_pages(spark, sf_dir):
    """Pages as XML records with the whole page as text."""
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    rows = read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit('<page url="'), safe(F.col("url")), F.lit('"><head><none/></head><body>'), safe(F.col("html")), F.lit("</body></page>")).alias("xml"))
    tree = files.nodes(rows, "page_id", "xml", "xml")
    found = P.match(files.lift_nodes(tree, NS), ("?s", TYPE, v("page")), ("?s", v("url"), "?url"), ("?s", v("body"), "?body"))
    ids = tree.where("parent is null").select(terms.skolem(NS, F.col("record"), F.col("node")).alias("s"), F.col("record").cast("long").alias("page_id"))
    return P.join(found, ids).select("page_id", told("url"), F.md5(terms.text(F.col("body"))).alias("body"))


# --- resolution ---------------------------------------------------------------------------------------------------------

_PAIRS = "SELECT DISTINCT a.p_partkey AS x, b.p_partkey AS y FROM part a JOIN part b ON a.p_partkey <> b.p_partkey AND "


def _name_size(spark, sf_dir) -> DataFrame:
    return P.bind(P.star(quads(spark, sf_dir, "part"), "?x", n=LABEL, z=v("size"), b=v("brand")), value=F.concat_ws("|", "n", "z", "b")).select("x", "value")


@query(_PAIRS + "a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_brand = b.p_brand")
def sameas_exact(spark, sf_dir):
    return resolve.guarded(resolve.same_value(_name_size(spark, sf_dir))).select(number("x"), number("y"))


@query(_PAIRS + "a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_type = b.p_type")
def sameas_intersection(spark, sf_dir):
    parts = read(spark, sf_dir, "part").withColumn("sized", F.concat_ws("|", "p_name", "p_size")).withColumn("kind", F.concat_ws("|", "p_name", "p_type", F.pmod("p_size", F.lit(10))))
    q = lift(parts, iri("part", parts["p_partkey"]), {"sized": Field(v("sized")), "kind": Field(v("kind"))}, v("Part"))
    return resolve.rule(*(resolve.same_value(resolve.data_property(q, v("Part"), v(p))) for p in ("sized", "kind"))).select(number("x"), number("y"))


@query("""
WITH r AS (SELECT DISTINCT l_orderkey AS o, l_suppkey AS s FROM lineitem)
SELECT a.o || '-' || a.s AS x, b.o || '-' || b.s AS y FROM r a JOIN r b ON a.o = b.o AND a.s // 2 = b.s // 2 AND a.s <> b.s""")
def sameas_relationship(spark, sf_dir):
    """Lines as relationships between orders and suppliers, where suppliers 2k and 2k + 1 are the same."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    node = F.concat_ws("-", iri("line", rows["l_orderkey"]), rows["l_suppkey"].cast("string"))
    line = rows.select(node.alias("x"), iri("order", rows["l_orderkey"]).alias("a"), iri("supplier", rows["l_suppkey"]).alias("b"))
    q = P.construct(line, ("?x", TYPE, VIVO + "Position"), ("?x", VIVO + "relates", "?a"), ("?x", VIVO + "relates", "?b"), ("?x", terms.MOST_SPECIFIC, VIVO + "Position"), branches=True)
    suppliers = read(spark, sf_dir, "supplier")
    roots = suppliers.select(iri("supplier", suppliers["s_suppkey"]).alias("node"), iri("supplier", F.floor(suppliers["s_suppkey"] / 2) * 2).alias("root"))
    return atoms.relationships(q, roots).select(F.regexp_replace("x", "^.*/", "").alias("x"), F.regexp_replace("y", "^.*/", "").alias("y"))


@query("""
WITH e0 AS (SELECT p_partkey AS x, p_partkey // 2 AS y FROM part WHERE p_partkey // 2 <> p_partkey),
e1 AS (SELECT x, y FROM e0 UNION SELECT a.x, b.y FROM e0 a JOIN e0 b ON a.y = b.x WHERE a.x <> b.y),
e2 AS (SELECT x, y FROM e1 UNION SELECT a.x, b.y FROM e1 a JOIN e1 b ON a.y = b.x WHERE a.x <> b.y),
e3 AS (SELECT x, y FROM e2 UNION SELECT a.x, b.y FROM e2 a JOIN e2 b ON a.y = b.x WHERE a.x <> b.y)
SELECT x, y FROM e3 EXCEPT SELECT x, y FROM e0""")
def sameas_transitive3(spark, sf_dir):
    edges = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("x"), F.floor(F.col("p_partkey") / 2).alias("y")).where("x != y")
    return resolve.transitive(edges)


@query(_PAIRS + "a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_brand = b.p_brand AND a.p_type = b.p_type")
def differentfrom_filter(spark, sf_dir):
    """Parts of one name, size and brand, but for those said to differ: of unlike kinds."""
    pairs = resolve.same_value(_name_size(spark, sf_dir))
    kind = P.scan(quads(spark, sf_dir, "part"), "?x", v("kind"), "?k")
    unlike = pairs.join(kind, "x").join(kind.select(F.col("x").alias("y"), F.col("k").alias("k2")), "y").where("k != k2").select("x", "y")
    return resolve.guarded(pairs, None, unlike).select(number("x"), number("y"))


_WINDOW = """
WITH v AS (SELECT {key} AS x, {value} AS value FROM {table}),
r AS (SELECT x, value, row_number() OVER (ORDER BY value, x) - 1 AS rn, count(*) OVER () AS n FROM v),
p AS (
    SELECT a.x AS x, b.x AS y, a.value AS a, b.value AS b FROM r a JOIN r b ON a.rn < b.rn AND b.rn - a.rn <= 99
    WHERE a.n <= 100 OR b.rn <= 99 OR a.rn >= a.n - 100 OR (b.rn BETWEEN 51 AND a.n - 50 AND b.rn - a.rn <= 50) OR (a.rn BETWEEN 51 AND a.n - 50 AND b.rn - a.rn <= 49)),
m AS (SELECT x, y FROM p WHERE {test})
SELECT x, y FROM m UNION SELECT y, x FROM m"""
_SIMILAR = "levenshtein(lower(a), lower(b)) = 0 OR (levenshtein(lower(a), lower(b)) < (length(a) + length(b)) // 2 AND CAST((1 - CAST(levenshtein(lower(a), lower(b)) AS FLOAT) / CAST((length(a) + length(b)) // 2 AS FLOAT)) * 100 AS FLOAT) >= {degree})"


@query(_WINDOW.format(key="CAST(c_custkey AS VARCHAR)", value="lower(c_name)", table="customer", test=_SIMILAR.format(degree=90)))
def fuzzy_window(spark, sf_dir):
    values = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("x"), F.lower("c_name").alias("value"))
    return resolve.fuzzy(values, 90)


@query(_WINDOW.format(key="CAST(c_custkey AS VARCHAR)", value="c_mktsegment", table="customer", test="substr(a, 1, 1) = substr(b, 1, 1)"))
def initials_match(spark, sf_dir):
    values = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("x"), F.col("c_mktsegment").alias("value"))
    return resolve.fuzzy(values, resolve.FIRST_LETTER)


@query(r"""
WITH d AS (SELECT doc_id, coalesce(string_split(text, chr(10)), [NULL]) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS k FROM d),
w AS (SELECT doc_id, k, list_filter(string_split(replace(line, '-', ' '), ' '), lambda t: t <> '' AND NOT (starts_with(t, '[') AND ends_with(t, ']'))) AS ws FROM l)
SELECT doc_id, k AS line, array_to_string(list_transform(list_filter(list_transform(ws, lambda t: regexp_replace(strip_accents(lower(t)), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')), lambda t: t <> ''), lambda t: CASE WHEN t = '&' THEN 'and' ELSE t END), ' ') AS form FROM w""")
def title_normal_form(spark, sf_dir):
    """Every line of every document; a document without text has one line without form."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line", "value"))
    return lines.select("doc_id", F.coalesce("line", F.lit(0)).cast("long").alias("line"), normal.title(F.col("value")).alias("form"))


@query(r"""
WITH t AS (
    SELECT p_partkey AS x, ['R&D ', '[Review] ', 'Ünï-Versité ', '& ', ''][p_partkey % 5 + 1] || p_name || ['-', ' & ', '&', ' [', ' Š '][p_size % 5 + 1] || p_type || ['', ']', ' &', '-&-', '  x'][p_size % 7 % 5 + 1] AS label FROM part),
w AS (SELECT x, list_filter(string_split(replace(label, '-', ' '), ' '), lambda t: t <> '' AND NOT (starts_with(t, '[') AND ends_with(t, ']'))) AS ws FROM t)
SELECT x, array_to_string(list_transform(ws, lambda t: CASE WHEN t = '&' THEN 'and' ELSE strip_accents(lower(t)) END), ' ') AS form FROM w""")
def title_normal_form_labels(spark, sf_dir):
    """Labels with '&' alone and inside words, brackets, hyphens and accents."""
    rows = read(spark, sf_dir, "part")
    pick = lambda k, *xs: F.get(F.array(*map(F.lit, xs)), k.cast("int"))
    label = F.concat(pick(F.col("p_partkey") % 5, "R&D ", "[Review] ", "Ünï-Versité ", "& ", ""), "p_name", pick(F.col("p_size") % 5, "-", " & ", "&", " [", " Š "), "p_type", pick(F.col("p_size") % 7 % 5, "", "]", " &", "-&-", "  x"))
    return rows.select(F.col("p_partkey").alias("x"), normal.title(label).alias("form"))


@query(r"""
WITH l AS (
    SELECT p_partkey AS x, upper(left(p_name, 3)) AS abc, CASE p_partkey % 12
        WHEN 0 THEN p_name || ' ' || p_type WHEN 1 THEN upper(left(p_name, 3)) WHEN 2 THEN '(' || upper(left(p_name, 3)) || ')'
        WHEN 3 THEN upper(left(p_name, 3)) || '-' || p_name || ' & ' || p_type || ' (' || upper(left(p_type, 2)) || ')' WHEN 4 THEN 'R&D Institute of ' || p_name
        WHEN 5 THEN 'Centre de Génétique ' || p_name || ' on the ' || p_type WHEN 6 THEN upper(p_name) || '-NORTH OF A-B' WHEN 7 THEN 'The ' || p_name || ' (north)'
        WHEN 8 THEN NULL WHEN 9 THEN p_name || '  &  ' || p_brand || ' (' || upper(left(p_name, 3)) || '.)  ' WHEN 10 THEN upper(left(p_name, 3)) || '-' || upper(left(p_type, 3)) || ' for ' || p_name ELSE 'U.S. & ' || p_name || '-' || p_brand END AS label FROM part),
t AS (SELECT *, string_split(rtrim(label, ' '), ' ') AS ws FROM l),
h AS (SELECT *, string_split(rtrim(ws[1], '-'), '-') AS hv FROM t),
c AS (
    SELECT *, len(ws) = 1 AND regexp_full_match(ws[1], '[.\-]*([A-Z][.\-]*){1,9}') AS sole,
           label <> upper(label) AND len(hv) = 2 AND regexp_full_match(hv[1], '[.\-]*([A-Z][.\-]*){1,9}') AND NOT regexp_full_match(coalesce(hv[2], ''), '[.\-]*([A-Z][.\-]*){1,9}') AS prefixed FROM h),
r AS (SELECT *, CASE WHEN sole THEN ws[1] WHEN prefixed THEN hv[1] END AS own, CASE WHEN prefixed THEN [hv[2]] || ws[2:] ELSE ws END AS vs FROM c),
e AS (SELECT *, regexp_replace(vs[-1], '[^A-Za-z0-9_]', '', 'g') AS bare FROM r),
f AS (SELECT *, starts_with(vs[-1], '(') AND regexp_full_match(bare, '[.\-]*([A-Z][.\-]*){1,9}') AS closing FROM e),
k AS (SELECT *, CASE WHEN closing THEN vs[:len(vs) - 1] ELSE vs END AS kept FROM f)
SELECT x, CASE WHEN label IS NOT NULL THEN array_to_string(list_filter(list_transform(kept, lambda w: CASE WHEN w = '&' THEN 'and' ELSE lower(regexp_replace(w, '[^A-Za-z0-9_]', '', 'g')) END),
       lambda w: w NOT IN ('the', 'of', 'for', 'from', 'on', 'a', 'an', '')), ' ') END AS form, CASE WHEN own IS NOT NULL AND closing THEN own || ' ' || bare WHEN closing THEN bare ELSE own END AS abbreviation FROM k""")
def org_normal_form(spark, sf_dir):
    """Labels of twelve kinds: plain, sole, leading and closing abbreviations, several of them, '&' inside words and alone, accents, capitals, null."""
    rows = read(spark, sf_dir, "part")
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    abc = F.upper(F.left(name, F.lit(3)))
    labels = [
        F.concat(name, F.lit(" "), kind), abc, F.concat(F.lit("("), abc, F.lit(")")), F.concat(abc, F.lit("-"), name, F.lit(" & "), kind, F.lit(" ("), F.upper(F.left(kind, F.lit(2))), F.lit(")")), F.concat(F.lit("R&D Institute of "), name),
        F.concat(F.lit("Centre de Génétique "), name, F.lit(" on the "), kind), F.concat(F.upper(name), F.lit("-NORTH OF A-B")), F.concat(F.lit("The "), name, F.lit(" (north)")),
        F.lit(None).cast("string"), F.concat(name, F.lit("  &  "), brand, F.lit(" ("), abc, F.lit(".)  ")), F.concat(abc, F.lit("-"), F.upper(F.left(kind, F.lit(3))), F.lit(" for "), name), F.concat(F.lit("U.S. & "), name, F.lit("-"), brand),
    ]
    label = F.get(F.array(*labels), (F.col("p_partkey") % len(labels)).cast("int"))
    return rows.select(F.col("p_partkey").alias("x"), normal.organization(label).alias("n")).select("x", "n.form", "n.abbreviation")


@query("SELECT count(*) AS pairs, count(DISTINCT x) AS resources, count(*) >= 128 AND count(*) >= count(DISTINCT x) * count(DISTINCT x) / 2 AS suspicious FROM (" + _PAIRS + "a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_brand = b.p_brand)")
def suspicious_result(spark, sf_dir):
    return resolve.suspicious(resolve.same_value(_name_size(spark, sf_dir)))


# --- publishing ---------------------------------------------------------------------------------------------------------

#: Customers in two graphs, by nation: the priority list has even nations first.
_GRAPHS = f"""
WITH c AS (SELECT '{NS}customer/' || c_custkey AS s, '{NS}graph/' || (c_nationkey % 2) AS g, c_nationkey % 2 AS rank, c_mktsegment AS note, c_name AS label,
                  c_nationkey AS nation, CAST(floor(CAST(round(c_acctbal * 100) AS BIGINT) / 10000) AS BIGINT) AS class FROM customer),
best AS (SELECT class, nation // 2 AS pair, min(rank) AS rank FROM c GROUP BY class, nation // 2),
canon AS (SELECT c.class, c.nation // 2 AS pair, min(c.s) AS canon FROM c JOIN best b ON c.class = b.class AND c.nation // 2 = b.pair AND c.rank = b.rank GROUP BY c.class, c.nation // 2)
"""


def _people(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(quads, edges, ranks): customers of a pair of nations with about one balance are one."""
    rows = read(spark, sf_dir, "customer").withColumn("class", F.floor(F.round(F.col("c_acctbal") * 100).cast("long") / 10000))
    rows = rows.withColumn("g", F.concat(F.lit(NS + "graph/"), (F.col("c_nationkey") % 2).cast("string"))).withColumn("value", F.concat_ws("|", "class", F.floor(F.col("c_nationkey") / 2)))
    node = iri("customer", rows["c_custkey"])
    q = lift(rows, node, {"g": Field(v("home")), "c_name": Field(LABEL), "c_mktsegment": Field(v("note"))}, v("Customer"))
    homes = q.where(F.col("p") == v("home")).select("s", F.col("o").alias("g"))
    q = q.where(F.col("p") != v("home")).drop("g").join(homes, "s").select(*terms.SCHEMA.names)
    edges = resolve.representatives(rows.select(node.alias("x"), "value"))
    ranks = spark.createDataFrame([(NS + "graph/0", 0), (NS + "graph/1", 1)], "g string, rank int")
    return q, edges, ranks


@query(_GRAPHS + "SELECT c.s AS old, canon AS new FROM c JOIN canon ON c.class = canon.class AND c.nation // 2 = canon.pair WHERE (SELECT count(*) FROM c d WHERE d.class = c.class AND d.nation // 2 = c.nation // 2) > 1")
def canonical_uri(spark, sf_dir):
    return publish.canonical(*_people(spark, sf_dir))


@query("""
WITH s AS (SELECT o_custkey AS c, o_orderpriority AS o, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS rank FROM orders)
SELECT c, o, rank FROM (SELECT c, o, rank, row_number() OVER (PARTITION BY c ORDER BY rank, o) AS nth FROM s) WHERE nth = 1""")
def functional_dedup(spark, sf_dir):
    q = quads(spark, sf_dir, "orders")
    told_by = P.star(q, "?o", s=v("by"), g=v("status"), label=v("urgency"))
    labels = terms.quads(told_by.select(terms.text(F.col("g")).alias("g"), "s", F.lit(LABEL).alias("p"), terms.text(F.col("label")).alias("o"))).dropDuplicates(list(terms.KEY))
    ranks = spark.createDataFrame([("F", 0), ("O", 1), ("P", 2)], "g string, rank int")
    return publish.one_value(labels, ranks, publish.FUNCTIONAL).join(F.broadcast(ranks), "g").select(number("s").alias("c"), "o", "rank")


@query(_GRAPHS + f""",
named AS (SELECT canon AS s, c.g, c.rank, c.label, c.note FROM c JOIN canon ON c.class = canon.class AND c.nation // 2 = canon.pair)
SELECT DISTINCT g, s, '{TYPE}' AS p, '{NS}Customer' AS o FROM named
UNION ALL SELECT DISTINCT g, s, '{NS}note', note FROM named
UNION ALL SELECT g, s, '{LABEL}', label FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY rank, label) AS nth FROM named) WHERE nth = 1""")
def publish_flow(spark, sf_dir):
    return publish.publish(*_people(spark, sf_dir)).select("g", "s", "p", "o")


# --- derived statements -------------------------------------------------------------------------------------------------


@query("""
WITH late AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'),
flagged AS (SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey NOT IN (SELECT o_orderkey FROM late)))
SELECT 'customer' AS kind, c_custkey AS x FROM flagged
UNION ALL SELECT 'nation', n_nationkey FROM nation WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_custkey NOT IN (SELECT c_custkey FROM flagged))""")
def external_flags(spark, sf_dir):
    """Works are orders, their people customers, organizations nations; pending orders are flagged from outside."""
    q = quads(spark, sf_dir, "orders", "customer", "nation")
    late = P.scan(q, "?x", v("status"), terms.literal_key("P"))
    q = apply_rules(q, [derive.seeds(late), derive.flag(v("Customer"), derive.linked("^" + v("by"))), derive.flag(v("Nation"), derive.linked("^" + v("inNation")))])
    found = P.scan(q, "?x", TYPE, derive.EXTERNAL).select(F.regexp_extract("x", "/([a-z]+)/[0-9]+$", 1).alias("kind"), number("x"))
    return found.where("kind in ('customer', 'nation')")


@query("SELECT n_nationkey AS c, c_custkey AS x FROM nation JOIN customer ON c_nationkey = n_nationkey")
def geo_location(spark, sf_dir):
    """Nations of the register have an ending or none, by their number; customers name the bare nation, or it with the ending."""
    nations, customers = read(spark, sf_dir, "nation"), read(spark, sf_dir, "customer").join(F.broadcast(read(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    ending = F.when(F.col("n_nationkey") % 3 == 0, " (country)").when(F.col("n_nationkey") % 3 == 1, ", Republic of").otherwise("")
    nations = nations.withColumn("label", F.concat("n_name", ending))
    q = P.union(lift(nations, iri("nation", nations["n_nationkey"]), {"label": Field(LABEL)}, VIVO + "Country"), lift(customers, iri("customer", customers["c_custkey"]), {"n_name": Field(VIVO + "countryName")}))
    return P.scan(derive.located(q), "?c", OBO + "RO_0001015", "?x").select(number("c"), number("x"))


@query("SELECT DISTINCT l_suppkey AS x, l_orderkey AS y FROM lineitem")
def participates_in(spark, sf_dir):
    """Suppliers are organizations and orders projects; odd lines are roles, even ones grants."""
    rows = read(spark, sf_dir, "lineitem")
    odd = rows["l_linenumber"] % 2 == 1
    node = F.concat_ws("-", iri("line", rows["l_orderkey"]), rows["l_linenumber"].cast("string"), rows["l_suppkey"].cast("string"))
    supplier, order = F.concat(F.lit(NS + "supplier/"), rows["l_suppkey"].cast("string")), F.concat(F.lit(NS + "order/"), rows["l_orderkey"].cast("string"))
    lines = rows.select(node.alias("r"), supplier.alias("x"), order.alias("y"), odd.alias("odd"))
    q = P.union(
        P.construct(lines.where("odd"), ("?r", OBO + "RO_0000052", "?x"), ("?r", OBO + "BFO_0000054", "?y"), branches=True),
        P.construct(lines.where("not odd"), ("?r", TYPE, VIVO + "Grant"), ("?r", VIVO + "relates", "?x"), ("?r", VIVO + "relates", "?y"), branches=True),
        P.construct(lines.select("x").distinct(), ("?x", TYPE, FOAF + "Organization"), branches=True),
        P.construct(lines.select("y").distinct(), ("?y", TYPE, VIVO + "Project"), branches=True),
    )
    return P.scan(derive.participates(q), "?x", OBO + "RO_0000056", "?y").select(number("x"), number("y"))


@query("SELECT c_custkey AS x, n_regionkey AS place FROM customer JOIN nation ON c_nationkey = n_nationkey")
def located_in_second_tier(spark, sf_dir):
    """Customers are persons with a position in a nation, which is in a region."""
    customers, nations = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    held = customers.select(iri("customer", customers["c_custkey"]).alias("x"), iri("position", customers["c_custkey"]).alias("pos"), F.concat(F.lit(NS + "nation/"), F.col("c_nationkey").cast("string")).alias("o"))
    placed = nations.select(iri("nation", nations["n_nationkey"]).alias("o"), F.concat(F.lit(NS + "region/"), F.col("n_regionkey").cast("string")).alias("place"))
    q = P.union(
        P.construct(held, ("?x", TYPE, FOAF + "Person"), ("?pos", TYPE, VIVO + "Position"), ("?pos", VIVO + "relates", "?x"), ("?pos", VIVO + "relates", "?o")),
        P.construct(placed, ("?o", TYPE, FOAF + "Organization"), ("?place", OBO + "RO_0001015", "?o")),
    )
    return P.scan(derive.second_tier(q), "?place", OBO + "RO_0001015", "?x").select(number("x"), number("place"))


@query("SELECT 'nation' AS kind, n_nationkey AS x, '2024-05-01T00:00:00Z' AS at FROM nation UNION ALL SELECT 'supplier', s_suppkey, '2024-05-01T00:00:00Z' FROM supplier")
def first_timestamp(spark, sf_dir):
    q = quads(spark, sf_dir, "nation", "supplier", "region")
    made = derive.first_seen("2024-05-01T00:00:00Z", (v("Region"),))(q)
    return P.scan(made, "?x", derive.NS + "firstSeen", "?at").select(F.regexp_extract("x", "/([a-z]+)/[0-9]+$", 1).alias("kind"), number("x"), told("at"))


@query(f"SELECT '{NS}customer/' || c_custkey || '-vcard' AS card, c_name AS name FROM customer")
def migrate_vcards(spark, sf_dir):
    """Labels of contacts move to a card of their own."""
    from quadrille.operators.migrate import move_to_card

    return P.scan(move_to_card(quads(spark, sf_dir, "customer"), v("Customer"), LABEL, terms.VCARD + "hasName", terms.VCARD + "formattedName"), "?card", terms.VCARD + "formattedName", "?name").select("card", told("name"))


@query(f"""
SELECT '{NS}customer/' || c_custkey AS s, '{TYPE}' AS p, '{NS}Client' AS o FROM customer
UNION ALL SELECT '{NS}customer/' || c_custkey, '{NS}title', c_name FROM customer
UNION ALL SELECT '{NS}customer/' || c_custkey, '{NS}inNation', '{NS}nation/' || c_nationkey FROM customer""")
def migrate_by_diff(spark, sf_dir):
    from quadrille.operators.migrate import Change, migrate

    changes = [Change(v("Customer"), v("Client"), True), Change(LABEL, v("title"), True), Change(v("segment"), None, False, "Delete", "Delete")]
    return migrate(quads(spark, sf_dir, "customer"), changes, classes={v("Customer")}).select("s", "p", "o")


# --- selection and derived merges ---------------------------------------------------------------------------------------


@query("SELECT c_custkey AS c, n_regionkey AS top FROM customer JOIN nation ON c_nationkey = n_nationkey")
def positions_at_top(spark, sf_dir):
    """Customers hold positions in nations, which are parts of regions."""
    customers, nations = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    held = customers.select(iri("position", customers["c_custkey"]).alias("pos"), F.concat(F.lit(NS + "nation/"), F.col("c_nationkey").cast("string")).alias("o"))
    parts = nations.select(iri("nation", nations["n_nationkey"]).alias("o"), F.concat(F.lit(NS + "region/"), F.col("n_regionkey").cast("string")).alias("up"))
    q = P.union(P.construct(held, ("?pos", TYPE, VIVO + "Position"), ("?pos", VIVO + "relates", "?o")), P.construct(parts, ("?o", select.PART_OF, "?up")))
    return P.scan(select.positions_at_top(q, v("immediate")), "?c", VIVO + "relates", "?top").select(number("c"), number("top"))


@query(f"""
WITH c AS (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'), n AS (SELECT DISTINCT nation.* FROM nation JOIN c ON c_nationkey = n_nationkey)
SELECT 'customer' AS kind, c_custkey AS x, 4 AS statements FROM c
UNION ALL SELECT 'nation', n_nationkey, 3 FROM n
UNION ALL SELECT DISTINCT 'region', n_regionkey, 2 FROM n""")
def relevant_subgraph(spark, sf_dir):
    q = quads(spark, sf_dir, "customer", "nation", "region")
    about = select.relevant(q, "building", [v("segment")], v("Customer"))
    return about.groupBy(F.regexp_extract("s", "/([a-z]+)/[0-9]+$", 1).alias("kind"), number("s").alias("x")).agg(F.count(F.lit(1)).cast("int").alias("statements"))


@query("SELECT p_partkey AS x, min(p_partkey) OVER (PARTITION BY p_name, p_size, p_brand) AS y FROM part QUALIFY x <> y")
def keep_smallest_peer(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("x"), F.concat_ws("|", "p_name", "p_size", "p_brand").alias("value"))
    return atoms.keep_smallest(resolve.representatives(parts)).select(F.col("old").alias("x"), F.col("new").alias("y"))


@query("""
WITH r AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s, l_orderkey AS o, l_linenumber AS n FROM lineitem)
SELECT DISTINCT a.o || '-' || a.n || '-' || a.p || '-' || a.s AS x, b.o || '-' || b.n || '-' || b.p || '-' || b.s AS y FROM r a JOIN r b ON a.p = b.p AND a.s = b.s AND (a.o, a.n) <> (b.o, b.n)""")
def sameas_roles(spark, sf_dir):
    """Lines as roles that suppliers have in parts: one type, one bearer, one process."""
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    line = rows.select(F.concat(F.lit(NS + "line/"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("x"), F.concat(F.lit(NS + "supplier/"), F.col("l_suppkey").cast("string")).alias("a"), F.concat(F.lit(NS + "part/"), F.col("l_partkey").cast("string")).alias("b"))
    q = P.construct(line, ("?x", atoms.BEARER, "?a"), ("?x", atoms.REALIZED_IN, "?b"), ("?x", atoms.MOST_SPECIFIC, v("Line")))
    none = spark.createDataFrame([], "node string, root string")
    return atoms.roles(q, none).select(F.regexp_replace("x", "^.*/", "").alias("x"), F.regexp_replace("y", "^.*/", "").alias("y"))


from quadrille import queries_resolution, queries_rewriting  # noqa: E402, F401  they register theirs
