"""Byte-limited shards by extendible hashing (built-in functions only).

The hash of a row's key is read as a bit string, most significant bit first. A directory maps
prefixes of that string to shards. The whole input is one bucket of depth 0; a bucket that
holds more bytes than the limit splits on its next bit, others stay as they are. So a shard's
name is the shortest prefix under which the rows fit.

The directory is computed from byte sums of fine cells (prefixes of ``start_bits`` bits more than the
expected depth), rolled up to all their prefixes in one aggregation. Only the rows of cells that are
still too large are looked at again, ``STEP_BITS`` further bits each time. Rows whose keys have the
same hash can't be parted by any bit, and a single row may exceed the limit: such a shard stays over it
and is marked ``oversized``.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import common

HASH_BITS, SPARE_BITS, STEP_BITS = 60, 4, 8
MAX_SHARD_BYTES = 64 << 20


def key_hash(key: Column) -> Column:
    """60 bits of the MD5 of the key as text; null counts as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def _sizes(rows: DataFrame, bits: int, start: int) -> DataFrame:
    """Bytes, rows and the range of hashes of every prefix of ``start`` to ``bits`` bits: cell sums first, then one roll-up."""
    cells = rows.groupBy(F.shiftright("h", HASH_BITS - bits).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    up = cells.select("*", F.explode(F.sequence(F.lit(start), F.lit(bits))).alias("depth")).withColumn("prefix", F.expr(f"shiftright(cell, {bits} - depth)"))
    return up.groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n_rows").alias("shard_rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _split(rows: DataFrame, limit: int, bits: int, start: int) -> DataFrame:
    """rows with depth, prefix, shard_bytes and shard_rows of their shard."""
    bits = min(bits, HASH_BITS)
    sizes = common.written(_sizes(rows, bits, start), "directory").withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi")))
    over = sizes.where("not fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    # a shard is a prefix that fits under one that doesn't; each takes its range of cells
    leaves = (
        sizes.where("fits")
        .withColumn("parent", F.shiftright("prefix", 1))
        .join(over.withColumn("split", F.lit(True)), ["depth", "parent"], "left")
        .where((F.col("depth") == start) | F.col("split"))
        .select("depth", "prefix", "shard_bytes", "shard_rows", F.explode(F.expr(f"sequence(shiftleft(prefix, {bits} - depth), shiftleft(prefix + 1, {bits} - depth) - 1)")).alias("cell"))
    )
    placed = rows.withColumn("cell", F.shiftright("h", HASH_BITS - bits))
    done = placed.join(leaves, "cell").drop("cell")
    large = sizes.where((F.col("depth") == bits) & ~F.col("fits")).select(F.col("prefix").alias("cell"))
    if bits == HASH_BITS or large.isEmpty():
        return done
    rest = common.written(placed.join(large, "cell", "left_semi").drop("cell"), "oversized")
    return done.unionByName(_split(rest, limit, bits + STEP_BITS, bits + 1))


def assign_shards(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", max_shard_bytes: int = MAX_SHARD_BYTES, id_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, shard (the bits of its prefix, '' for the only one), depth, shard_bytes, shard_rows, oversized.

    ``n_bytes`` is the UTF-8 length of the text (null: 0). Rows of one key share a shard. A shard is over the limit only
    if all its keys hash alike, then ``oversized`` is true. An empty table gives an empty result; null
    keys count as the empty key. Other columns are not read.
    """
    if max_shard_bytes < 1:
        raise ValueError("max_shard_bytes must be positive")
    rows = common.written(
        docs.select(docs[id_col or key_col].alias("doc_id"), key_hash(docs[key_col]).alias("h"), F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long").alias("n_bytes")),
        "hashed",
    )
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    bits = SPARE_BITS + ceil(log2(max(2, total / max_shard_bytes)))
    placed = _split(rows, max_shard_bytes, bits, 0)
    return placed.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(conv(cast(prefix as string), 10, 2), depth, '0')")).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        "shard_bytes",
        "shard_rows",
        (F.col("shard_bytes") > max_shard_bytes).alias("oversized"),
    )


def write_shards(docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", max_shard_bytes: int = MAX_SHARD_BYTES) -> DataFrame:
    """Writes ``docs``, all columns as they are, as Parquet under ``path``/shard_bits=b..., a folder per shard ('b' and the bits); returns the directory: shard, depth, shard_bytes, shard_rows, oversized.

    If ``docs`` has a column ``shard_bits``, the folders' name gets '_' before it until no column has it. A shard is written by one task, an oversized one by as many as it has limits. Null keys are one
    key, and rows of one key are in one folder. An empty table writes no shards.
    """
    placed = common.written(assign_shards(docs, key_col, text_col, max_shard_bytes), "placed")
    directory = common.written(placed.select("shard", "depth", "shard_bytes", "shard_rows", "oversized").distinct(), "shards")
    bits, piece, key = common.fresh(docs, "shard_bits"), common.fresh(docs, "shard_piece"), common.fresh(docs, "shard_key")
    pieces = F.ceil(F.col("shard_bytes") / max_shard_bytes)
    at = placed.groupBy(F.col("doc_id").alias(key)).agg(F.concat(F.lit("b"), F.first("shard")).alias(bits), F.greatest(F.lit(1), F.first(pieces)).alias(piece))
    rows = docs.join(at, docs[key_col].eqNullSafe(at[key])).drop(key).withColumn(piece, F.pmod(F.monotonically_increasing_id(), F.col(piece)))
    rows.repartition(bits, piece).drop(piece).write.partitionBy(bits).parquet(path)
    return directory


#: The query's limit: small enough that the smallest tables are split, too.
QUERY_SHARD_BYTES = 1 << 20


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(common.table(spark, sf_dir, "documents"), max_shard_bytes=QUERY_SHARD_BYTES)


OP8_SQL = f"""
WITH rows AS (
    SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h,
           CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes
    FROM documents),
depths AS (SELECT unnest(range(0, 21)) AS depth),
sums AS (
    SELECT doc_id, n_bytes, h, depth,
           CAST(sum(n_bytes) OVER (PARTITION BY depth, h >> (60 - depth)) AS BIGINT) AS shard_bytes,
           count(*) OVER (PARTITION BY depth, h >> (60 - depth)) AS shard_rows
    FROM rows CROSS JOIN depths),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS nth
    FROM sums WHERE shard_bytes <= {QUERY_SHARD_BYTES})
SELECT doc_id, n_bytes,
       CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(h >> (60 - depth)), 64, '0'), CAST(depth AS INTEGER)) END AS shard,
       CAST(depth AS INTEGER) AS depth, shard_bytes, shard_rows, false AS oversized
FROM placed WHERE nth = 1
"""
