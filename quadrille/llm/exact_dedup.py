"""Exact duplicates by a tree merge of sorted digest runs (built-in functions only).

Every row becomes a digest record (digest, length, check). The records of one input
partition form a *run*. Runs merge in binomial rounds: in round ``r`` the runs whose
numbers agree above bit ``bits * (r + 1)`` exchange their records and merge, so one round is a
multiway merge of ``2 ** bits`` runs and spans ``bits`` levels of the binomial tree. Every merge keeps, per
digest, the best identifier and the summed count. The state is a struct, which Spark
aggregates by sorting, so what partitions exchange and merge are sorted runs, with spilling.

Why it stays even: a key of a round is (digest, block of runs), and never has more than one record
per run of the block. A digest that a third of all rows share is dealt over all blocks in the
first round and has ``2 ** bits`` records in each later one. The survivors of digests
with copies then go down the same tree, round by round, until they reach (digest, run).

Records are verified at every level: they merge only when SHA-256, the length in bytes and a
second 64-bit hash of the normalised text all agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import common

#: Runs that are told apart, and the runs of one merge; both powers of two.
RUN_BITS, MERGE_BITS = 10, 5

KEY = ("digest", "n_bytes", "check")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, digest, n_bytes, check, run, row (a number of its own for each row). Written once, as both ways through the tree read it."""
    rows = common.ids_and_text(docs, id_col, text_col).select("doc_id", common.lower_ascii(F.col("text")).alias("norm"))
    return common.written(
        rows.select(
            "doc_id",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.octet_length("norm").cast("long").alias("n_bytes"),
            F.xxhash64("norm").alias("check"),
            F.spark_partition_id().bitwiseAND((1 << RUN_BITS) - 1).alias("run"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. ``keep`` says whether the
    smallest or the largest id of a group stays ("min", "max"); ids may be of any type that has an order.

    Defined cases: null text counts as empty, and all empty texts are one group. A null id never wins
    over another id; a group of null ids only has keep_id null. Rows that repeat id and text
    count each in group_size, and exactly one row of a group has kept = true.
    An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    best_of = F.min if keep == "min" else F.max
    here = F.col("doc_id").isNull() if keep == "min" else F.col("doc_id").isNotNull()  # a null id never wins
    rows = digests(docs, id_col, text_col)
    level = (
        rows.withColumn("block", F.col("run"))
        .groupBy(*KEY, "block")
        .agg(best_of(F.struct(here.alias("here"), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    )
    levels = [common.written(level, "run-0")]
    for _ in range(0, RUN_BITS, MERGE_BITS):
        up = levels[-1].withColumn("block", F.shiftright("block", MERGE_BITS))
        merged = up.groupBy(*KEY, "block").agg(best_of("best").alias("best"), F.sum("group_size").alias("group_size"))
        levels.append(common.written(merged, f"run-{len(levels)}"))
    best = levels[-1].where("group_size > 1").drop("block")
    for below, step in zip(reversed(levels[:-1]), [RUN_BITS, *[MERGE_BITS] * len(levels)], strict=False):
        if below is levels[-2]:  # the root has one block
            down = below.select(*KEY, "block").join(best, list(KEY))
        else:
            down = below.select(*KEY, "block", F.shiftright("block", step).alias("above")).join(best.withColumnRenamed("block", "above"), [*KEY, "above"]).drop("above")
        best = down
    found = rows.withColumnRenamed("run", "block").join(best, [*KEY, "block"], "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: one of each group of equal texts, a row that :func:`find_copies` keeps.

    That goes for rows without id and for rows that repeat an id, too: of several that agree in id and text, one stays, and texts of one id
    that differ are judged one by one.
    """
    found = common.written(find_copies(docs, id_col, text_col, keep).select("doc_id", F.col("text_sha256").alias("key"), "kept"), "copies")
    text = common.lower_ascii(F.coalesce(docs[text_col], F.lit("")))
    return common.rows_that_stay(docs, found, F.sha2(text, 256), id_col, one=True)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(common.table(spark, sf_dir, "documents"), keep="max")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM d
"""
