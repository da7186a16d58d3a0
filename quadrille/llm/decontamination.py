"""Benchmark decontamination: documents scanned for the n-grams of benchmark items.

The windows of the items (``n`` words, or the whole item if it has fewer) form the query set. It is
cut into blocks of at most ``block_windows`` windows, counted once for each item that has them, and ``BLOCK_BYTES`` bytes of different words, and each block is broadcast: the vocabulary of its words, a sorted array of
window hashes and the windows themselves. Each block scans all documents; a benchmark of the usual size is one block, and a larger one
costs further scans, not more memory.

A scan turns the words of a batch of documents into vocabulary numbers (0 for words that no item has), drops windows
that contain a 0, looks the rolling hashes of the rest up in the block, and verifies each hit word by word.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.llm import bpe, common

#: A word: digits, A-Z, a-z and everything beyond ASCII. Fixed value of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N = 10
#: Pairs of window and item in one broadcast block, about 200 bytes each, so 100 MB at most; and bytes of its words. A window that is longer by itself is a block.
BLOCK_WINDOWS, BLOCK_BYTES = 500_000, 64 << 20

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(WORD)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())]))


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").translate(_LOWER)) if text else []


class Block:
    """Windows of one length or several, with the items that have them."""

    def __init__(self, windows: dict[tuple[str, ...], list]):
        self.vocabulary: dict[str, int] = {}
        number = self.vocabulary.setdefault
        by_length: dict[int, list[tuple[list[int], list]]] = {}
        for words, items in windows.items():
            by_length.setdefault(len(words), []).append(([number(w, len(self.vocabulary) + 1) for w in words], items))
        self.lengths = {}
        for length, found in by_length.items():
            ids = np.array([x for x, _ in found], np.int64)
            hashes = rolling(ids.ravel(), length)[::length] if len(ids) else np.zeros(0, np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.lengths[length] = hashes[order], ids[order], [found[k][1] for k in order.tolist()]

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, list]]:
        """(start, length, items) of each window that occurs in ``ids``."""
        inside = np.concatenate(([0], np.cumsum(ids == 0)))
        for length, (hashes, windows, items) in self.lengths.items():
            if len(ids) < length:
                continue
            starts = np.flatnonzero(inside[length:] == inside[:-length])
            if not len(starts):
                continue
            h = rolling(ids, length, starts)
            low, high = np.searchsorted(hashes, h), np.searchsorted(hashes, h, "right")
            some = np.flatnonzero(low < high)
            for start, a, b in zip(starts[some].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
                for k in range(a, b):
                    if (windows[k] == ids[start : start + length]).all():
                        yield start, length, items[k]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (start, length) as disjoint runs in order."""
    out: list[tuple[int, int]] = []
    for start, length in sorted(spans):
        if out and start <= sum(out[-1]):
            out[-1] = out[-1][0], max(out[-1][1], start + length - out[-1][0])
        else:
            out.append((start, length))
    return out


def rolling(ids: np.ndarray, length: int, starts: np.ndarray | None = None) -> np.ndarray:
    """A hash of each window of ``length`` ids, by its start."""
    starts = np.arange(len(ids) - length + 1) if starts is None else starts
    h = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            h = (h ^ ids[starts + k].astype(np.uint64)) * _FACTOR
            h ^= h >> np.uint64(29)
    return h


def blocks(items: DataFrame, n: int = N, id_col: str = "item_id", text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> Iterator[Block]:
    """The query set of ``items``, in blocks; the driver holds one block at a time. A window that very many items have is in several blocks, each with some of them."""
    windows: dict[tuple[str, ...], list] = {}
    seen: set[str] = set()
    pairs = size = 0
    for item, text in items.select(items[id_col].alias("item_id"), items[text_col].alias("text")).toLocalIterator():
        words = words_of(text)
        for k in range(max(1, len(words) - n + 1) if words else 0):
            window = words[k : k + n]
            own = windows.setdefault(tuple(window), [])
            if not own or own[-1] != item:
                own.append(item)
                pairs += 1
                size += sum(4 * len(w) for w in set(window) - seen)
                seen.update(window)
            if pairs >= block_windows or size >= BLOCK_BYTES:
                yield Block(windows)
                windows, seen, pairs, size = {}, set(), 0, 0
    if windows:
        yield Block(windows)


def _scan(docs: DataFrame, block: Block | None, id_type: T.DataType) -> DataFrame:
    """Per document: doc_id, row, n_words, spans (start and length in words) and items."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS), T.StructField("items", T.ArrayType(id_type))])
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
    arrow_items = pa.list_(pa.string() if isinstance(id_type, T.StringType) else pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for part, texts in bpe.slices(batch, "text"):
                split = [_WORDS.findall(x.translate(_LOWER) if not x.isascii() else x.lower()) for x in texts]
                spans: list[list] = [[] for _ in texts]
                items: list[set] = [set() for _ in texts]
                if block is not None:
                    get = block.vocabulary.get
                    size = np.array([len(w) + 1 for w in split], np.int64)
                    ids = np.zeros(int(size.sum()), np.int64)  # a 0 ends each document
                    begin = np.cumsum(size) - size
                    for at, words in zip(begin.tolist(), split, strict=True):
                        ids[at : at + len(words)] = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
                    for start, length, found in block.hits(ids):
                        k = int(np.searchsorted(begin, start, "right")) - 1
                        spans[k].append((start - int(begin[k]), length))
                        items[k].update(found)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(w) for w in split], pa.int64()), pa.array([[{"start": a, "length": n} for a, n in merged(x)] for x in spans], arrow_span), pa.array(list(map(list, items)), arrow_items)], names=["doc_id", "n_words", "spans", "items"])

    return docs.mapInArrow(run, schema)


@F.pandas_udf(_SPANS)
def _merge_spans(spans: pd.Series) -> pd.Series:
    return spans.map(lambda x: [{"start": a, "length": n} for a, n in merged([(y["start"], y["length"]) for y in x])])


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items, spans, contaminated.

    Words are as in :data:`WORD` after lower-casing A-Z. ``spans`` are the merged runs of hit words (start and length
    in words), ``items`` the sorted ids of the items whose windows occur. Null texts and items have no words; items without words have no
    windows. With an empty benchmark nothing is hit. Rows that repeat an id are answered one by one, null ids too. Other columns are not read.
    """
    id_type = benchmark.schema[item_col].dataType
    id_type = id_type if isinstance(id_type, T.StringType) else T.LongType()
    query = blocks(benchmark, n, item_col, item_text_col, block_windows)
    first, second = next(query, None), next(query, None)
    if second is None:
        found = _scan(common.ids_and_text(docs, id_col, text_col), first, id_type)
    else:
        # One more scan a block. The answers meet by row number; but for the first block's, only rows with hits travel.
        rows = common.written(docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"), docs[text_col].alias("text")), "scanned")
        numbered = common.ids_and_text(rows, "row", "text")
        answers = common.written(_scan(numbered, first, id_type), "hits")
        for block in itertools.chain([second], query):
            answers = answers.unionByName(common.written(_scan(numbered, block, id_type).where("size(items) > 0"), "hits"))
        met = answers.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        found = rows.select("row", "id").join(met.withColumnRenamed("doc_id", "row"), "row").select(F.col("id").alias("doc_id"), "n_words", _merge_spans("spans").alias("spans"), "items")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["length"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_sort("items").alias("items"), "spans", (F.size("spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns as they are. Each row is judged by its own text, whatever its id; nothing is shuffled, and a row that a block hits isn't looked up in the next ones."""
    text = F.coalesce(docs[text_col], F.lit(""))
    for block in blocks(benchmark, n, item_col, item_text_col, block_windows):
        docs = docs.where(F.size(_spotter(docs.sparkSession.sparkContext.broadcast(block), 1)(text, F.array().cast(_SPANS))) == 0)
    return docs


def _spotter(shared, most: int | None = None):
    """Spans of a block's windows in texts, merged with those known; ``most``: no more than so many windows are looked for."""

    @F.pandas_udf(_SPANS)
    def spot(texts: pd.Series, spans: pd.Series) -> pd.Series:
        block = shared.value

        def one(text: str | None, known) -> list[dict]:
            words = words_of(text)
            ids = np.fromiter((block.vocabulary.get(w, 0) for w in words), np.int64, len(words))
            hits = [(start, length) for start, length, _ in itertools.islice(block.hits(ids), most)]
            return [{"start": a, "length": n} for a, n in merged([*((x["start"], x["length"]) for x in known), *hits])]

        return pd.Series(list(map(one, texts, spans)), index=texts.index, dtype=object)

    return spot


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    def one(text: str | None, runs) -> str | None:
        if not text:
            return text
        found = list(_WORDS.finditer(text.translate(_LOWER)))
        out, at = [], 0
        for x in runs:
            out.append(text[at : found[x["start"]].start()])
            at = found[x["start"] + x["length"] - 1].end()
        return "\n".join([*out, text[at:]])

    return pd.Series(list(map(one, texts, spans)), index=texts.index, dtype=object)


def cut_spans(docs: DataFrame, benchmark: DataFrame, n: int = N, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with the hit words, and what stands between them, cut out of the texts; the rest stays as it is. Null stays null.

    A cut leaves a line break. All blocks of a query set are looked up in the text as it was, and it is cut once.
    """
    spans = F.array().cast(_SPANS)
    for block in blocks(benchmark, n, item_col, item_text_col, block_windows):
        spans = _spotter(docs.sparkSession.sparkContext.broadcast(block))(F.col(text_col), spans)
    return docs.withColumn(text_col, _cut(F.col(text_col), spans))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(names, 256).alias("items_sha256"), "contaminated")
