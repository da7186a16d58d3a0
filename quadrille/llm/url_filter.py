"""URL filters by a temporal list join.

A list has dated entries: from a day on, a domain is blocked or allowed. Per domain the entries become validity
intervals, each up to the next entry. A capture is looked up under its host and all parent domains, as of its day
of fetch; of the entries in force the one for the longest domain decides.

The intervals of a domain are one row (an array sorted by day), so the list side of the join has unique keys and no capture is multiplied. A list of
at most ``MAX_BROADCAST_DOMAINS`` domains and ``MAX_BROADCAST_ENTRIES`` entries is broadcast; else both sides are shuffled by domain, and a host that holds a large
part of the captures is split by Spark's skew join, which may copy the one list row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quadrille.llm import common

MAX_BROADCAST_DOMAINS, MAX_BROADCAST_ENTRIES = 200_000, 500_000

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The lower-cased host of a URL without user, port and last dot; null without one."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    return F.when(host != "", host)


def intervals(entries: DataFrame) -> DataFrame:
    """(domain, spans): per domain the array of (listed_on, until, action) by day; ``until`` is the day of the next entry, null for the last.

    Of several entries for a domain and day a block wins. Entries without domain or day are left out.
    """
    daily = entries.select(F.lower("domain").alias("domain"), F.col("listed_on").cast("date").alias("listed_on"), "action").where("domain is not null and listed_on is not null and action in ('allow', 'block')")
    daily = daily.groupBy("domain", "listed_on").agg(F.max("action").alias("action"))
    dated = daily.withColumn("until", F.lead("listed_on").over(W.partitionBy("domain").orderBy("listed_on")))
    return dated.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("listed_on", "until", "action"))).alias("spans"))


def match(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_on") -> DataFrame:
    """One row per row of ``captures``: page_id, url, host, fetched_on (a date), entry (the domain that decided), listed_on, action, blocked.

    ``entries`` has domain, action ('block' or 'allow') and listed_on. A URL without host, a capture without day and one without an entry in
    force have nulls there and are not blocked. An entry is in force from its own day on. Repeated captures are answered one by one; other columns are not read.
    """
    rows = captures.select(captures[id_col].alias("page_id"), captures[url_col].alias("url"), captures[time_col].cast("date").alias("fetched_on"), F.monotonically_increasing_id().alias("row"))
    rows = common.written(rows.withColumn("host", host_of(F.col("url"))), "captures")
    listed = common.written(intervals(entries), "intervals")
    size = listed.agg(F.count(F.lit(1)).alias("domains"), F.sum(F.size("spans")).alias("entries")).first()
    small = size["domains"] <= MAX_BROADCAST_DOMAINS and (size["entries"] or 0) <= MAX_BROADCAST_ENTRIES
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    keys = rows.where("host is not null and fetched_on is not null").select("row", "fetched_on", F.explode(parents).alias("domain"))
    met = keys.join(F.broadcast(listed) if small else listed, "domain")
    in_force = F.filter("spans", lambda x: (x["listed_on"] <= F.col("fetched_on")) & (x["until"].isNull() | (F.col("fetched_on") < x["until"])))
    met = met.select("row", "domain", F.get(in_force, 0).alias("span")).where("span is not null")
    best = met.groupBy("row").agg(F.max(F.struct(F.length("domain").alias("length"), "domain", "span")).alias("best"))
    return rows.join(best, "row", "left").select(
        "page_id", "url", "host", "fetched_on", F.col("best.domain").alias("entry"), F.col("best.span.listed_on").alias("listed_on"), F.col("best.span.action").alias("action"), F.coalesce(F.col("best.span.action") == "block", F.lit(False)).alias("blocked")
    )


def drop_blocked(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_on") -> DataFrame:
    """The rows of ``captures`` that aren't blocked, all columns as they are; an id goes if one of its captures is blocked."""
    return common.without_ids(captures, common.written(match(captures, entries, id_col, url_col, time_col).where("blocked").select("page_id"), "blocked"), id_col)


def _days(n: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))


def sample_list(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of ``pages``, as the tables have none: by the MD5 of a host, some are blocked, freed and blocked again; two parent domains are blocked for all."""
    hosts = pages.select(host_of(pages["url"]).alias("domain")).where("domain is not null").distinct()
    k = F.conv(F.substring(F.md5("domain"), 1, 8), 16, 10).cast("long")
    dated = hosts.select(
        "domain",
        F.explode(
            F.array(
                F.when(k % 4 == 0, F.struct(_days(k % 400).alias("listed_on"), F.lit("block").alias("action"))),
                F.when(k % 8 == 0, F.struct(_days(k % 400 + 90).alias("listed_on"), F.lit("allow").alias("action"))),
                F.when(k % 16 == 0, F.struct(_days(k % 400 + 200).alias("listed_on"), F.lit("block").alias("action"))),
                F.when(k % 4 == 1, F.struct(_days(k % 600).alias("listed_on"), F.lit("allow").alias("action"))),
            )
        ).alias("entry"),
    ).where("entry is not null")
    fixed = pages.sparkSession.sql("SELECT * FROM VALUES ('example.net', date'2024-09-01', 'block'), ('example.net', date'2025-03-01', 'allow'), ('example.org', date'2025-06-01', 'block') AS t(domain, listed_on, action)")
    return dated.select("domain", "entry.*").unionByName(fixed)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", _days(F.pmod(F.col("page_id") * 7919, F.lit(730))).alias("fetched_on"))
    found = match(captures, sample_list(pages))
    return found.select("page_id", "host", F.col("fetched_on").cast("string").alias("fetched_on"), "entry", F.col("listed_on").cast("string").alias("listed_on"), "action", "blocked")


OP7_SQL = r"""
WITH captures AS (
    SELECT page_id, CAST(DATE '2024-01-01' + CAST(page_id * 7919 % 730 AS INTEGER) AS DATE) AS fetched_on,
           nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS host
    FROM pages),
hosts AS (SELECT DISTINCT host AS domain, CAST('0x' || substr(md5(host), 1, 8) AS BIGINT) AS k FROM captures WHERE host IS NOT NULL),
entries AS (
    SELECT domain, CAST(DATE '2024-01-01' + CAST(k % 400 AS INTEGER) AS DATE) AS listed_on, 'block' AS action FROM hosts WHERE k % 4 = 0
    UNION ALL SELECT domain, CAST(DATE '2024-01-01' + CAST(k % 400 + 90 AS INTEGER) AS DATE), 'allow' FROM hosts WHERE k % 8 = 0
    UNION ALL SELECT domain, CAST(DATE '2024-01-01' + CAST(k % 400 + 200 AS INTEGER) AS DATE), 'block' FROM hosts WHERE k % 16 = 0
    UNION ALL SELECT domain, CAST(DATE '2024-01-01' + CAST(k % 600 AS INTEGER) AS DATE), 'allow' FROM hosts WHERE k % 4 = 1
    UNION ALL SELECT * FROM (VALUES ('example.net', DATE '2024-09-01', 'block'), ('example.net', DATE '2025-03-01', 'allow'), ('example.org', DATE '2025-06-01', 'block'))),
found AS (
    SELECT c.page_id, e.domain, e.listed_on, e.action,
           row_number() OVER (PARTITION BY c.page_id ORDER BY length(e.domain) DESC, e.listed_on DESC) AS nth
    FROM captures c JOIN entries e ON (c.host = e.domain OR ends_with(c.host, '.' || e.domain)) AND e.listed_on <= c.fetched_on)
SELECT c.page_id, c.host, strftime(c.fetched_on, '%Y-%m-%d') AS fetched_on, f.domain AS entry, strftime(f.listed_on, '%Y-%m-%d') AS listed_on, f.action, coalesce(f.action = 'block', false) AS blocked
FROM captures c LEFT JOIN found f ON c.page_id = f.page_id AND f.nth = 1
"""
