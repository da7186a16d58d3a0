"""What the operators of this package share: the shared folder, written tables, column naming, row filters."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.store import drop, exists, release, scratch, shared_copy, shared_dir, written

__all__ = ["MAX_BROADCAST_BYTES", "MAX_BROADCAST_IDS", "drop", "exists", "fresh", "ids_and_text", "lower_ascii", "release", "rows_that_stay", "scratch", "shared_copy", "shared_dir", "small", "table", "without_ids", "worker_state", "written"]

#: A set of ids is broadcast only up to this many rows, and if they are text up to this many bytes; beyond it the join shuffles.
MAX_BROADCAST_IDS, MAX_BROADCAST_BYTES = 1_000_000, 32 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    return F.translate(text, _UPPER, _UPPER.lower())


def ids_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, as ``doc_id`` and ``text``: other columns can't clash. Null text counts as empty."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, with '_' before it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small(ids: DataFrame) -> bool:
    """Whether a set of ids, of one column, may be broadcast. Its rows and the bytes of its texts are counted."""
    size = F.octet_length(ids.columns[0]) if dict(ids.dtypes)[ids.columns[0]] in ("string", "binary") else F.lit(8)
    found = ids.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    return found["n"] <= MAX_BROADCAST_IDS and (found["bytes"] or 0) <= MAX_BROADCAST_BYTES


def without_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", how: str = "left_anti") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``dropped`` (one column); null ids stay. With ``how`` "left_semi": the rows whose id is.

    The id set is measured first: a :func:`small` one is broadcast and the texts don't move, else
    both sides are shuffled by id.
    """
    name = fresh(docs, "gone")
    gone = dropped.toDF(name).where(F.col(name).isNotNull()).distinct()
    if small(gone):
        gone = F.broadcast(gone)
    return docs.join(gone, docs[id_col] == gone[name], how)


def rows_that_stay(docs: DataFrame, decided: DataFrame, key: Column, id_col: str = "doc_id", one: bool = False) -> DataFrame:
    """The rows of ``docs`` that ``decided`` keeps, all columns as they are.

    ``decided`` (doc_id, key, kept) has a row per row of ``docs``, and ``key`` is that key as a column of ``docs``. Nearly always the id tells: ids of which no row stays are
    dropped by id, and the texts don't move. Only rows without id, and rows of an id of which some stay and some don't, are looked up by id and key; with
    ``one``, a single row stays of those that agree in both, unless the key is empty.
    """
    marked = decided.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("all")).where("doc_id is null or not `all`")
    marked = written(marked, "marked-ids")
    rest = without_ids(docs.where(docs[id_col].isNotNull()), marked.select("doc_id"), id_col)
    mixed = marked.where("doc_id is not null and some").select("doc_id")
    no_id = not marked.where("doc_id is null").isEmpty()
    if mixed.isEmpty() and not no_id:
        return rest
    ours, theirs = fresh(docs, "row_key"), fresh(docs, "kept_key")
    kept = decided.where("kept").select("doc_id", F.col("key").alias(theirs)).distinct().withColumnRenamed("doc_id", theirs + "_id")
    parts = [without_ids(docs, mixed, id_col, "left_semi"), *([docs.where(docs[id_col].isNull())] if no_id else [])]
    for part in parts:
        keyed = part.withColumn(ours, key)
        if one:
            alone = F.octet_length(ours) == 0
            keyed = keyed.where(~alone).dropDuplicates([id_col, ours]).unionByName(keyed.where(alone))
        on = keyed[id_col].eqNullSafe(kept[theirs + "_id"]) & (keyed[ours] == kept[theirs])
        rest = rest.unionByName(keyed.join(kept, on, "left_semi").drop(ours))
    return rest


_T = TypeVar("_T")
_state: dict[Hashable, object] = {}


def worker_state(key: Hashable, make: Callable[[], _T]) -> _T:
    """What an operator keeps between the batches and tasks of a Python worker (caches, tables). A worker keeps the state of one operator: the next one's takes its place, so memory doesn't add up over a pipeline."""
    if key not in _state:
        _state.clear()
        _give_back()
        _state[key] = make()
    return _state[key]


def _give_back() -> None:
    """Returns what the last operator freed to the system; where that can't be asked for, nothing happens."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
