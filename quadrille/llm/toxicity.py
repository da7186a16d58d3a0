"""Toxicity by logistic regression, trained with FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text, each 0 or 1: its words, the stems of its words (their first 4, 5 and 6 letters, so that
inflected forms share evidence), pairs of neighbouring words and pairs with one word skipped; all
hashed into ``2 ** BITS`` places. FTRL-proximal keeps a learning rate per coordinate, and its L1 term leaves most weights at
exactly 0, so the model is broadcast as its few non-zero weights.

The model is fitted in one task, on a bounded sample of the labelled rows (``max_rows``; those of smallest hashed
id, a quarter of them at most with label 1, if there are more). Scoring covers every row and the whole text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.llm import bpe, common

BITS, STEMS = 20, (4, 5, 6)
MAX_ROWS, EPOCHS = 16_000, 3
#: A worker's cache of words starts anew beyond so many.
CACHE_ENTRIES = 200_000

_WORDS = re.compile(r"[^\W\d_]+")
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SHIFT = np.uint64(64 - BITS)


class Features:
    """Turns texts into hashed features; words are hashed once."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.hashes = np.zeros(1 << 12, np.uint64)
        self.stems = np.zeros((1 << 12, len(STEMS)), np.int32)

    def _learn(self, words: set[str]) -> None:
        if len(self.number) + len(words) > CACHE_ENTRIES:
            self.number.clear()
        need = len(self.number) + len(words)  # at most
        if need > len(self.hashes):
            self.hashes, self.stems = np.resize(self.hashes, 2 * need), np.resize(self.stems, (2 * need, len(STEMS)))
        new, hashed = [w for w in words if w not in self.number], xxhash.xxh3_64_intdigest
        at = len(self.number)
        self.number.update(zip(new, range(at, at + len(new)), strict=True))
        self.hashes[at : at + len(new)] = [hashed(w) for w in new]
        for j, n in enumerate(STEMS):
            self.stems[at : at + len(new), j] = [hashed(w[:n], n) >> 64 - BITS if len(w) >= n else -1 for w in new]

    def of(self, text: str) -> np.ndarray:
        """The places of the features of a text; some repeat."""
        words = _WORDS.findall(text.lower())
        if not words:
            return np.zeros(0, np.int64)
        new = set(words)
        if not new <= self.number.keys():
            self._learn(new)
        ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        h = self.hashes[ids]
        single = np.unique(ids)
        stems = self.stems[single].ravel()
        with np.errstate(over="ignore"):
            pairs = [((h[:-step] * _B ^ h[step:] * _C ^ np.uint64(step)) * _A) >> _SHIFT for step in (1, 2) if len(h) > step]
        return np.concatenate([(self.hashes[single] >> _SHIFT).astype(np.int64), stems[stems >= 0].astype(np.int64), *(p.astype(np.int64) for p in pairs)])


@dataclass
class Model:
    """The non-zero weights and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS, np.float32)
        w[self.places] = self.weights
        return w


def ftrl(rows: Iterable[tuple[np.ndarray, int]], alpha: float = 0.3, beta: float = 1.0, l1: float = 4.0, l2: float = 0.1, epochs: int = EPOCHS, seed: int = 0) -> Model:
    """Fits a model on (features, label) rows, in an order that depends on ``seed`` alone. Without rows of both labels the weights are 0 and the bias is the smoothed share of label 1."""
    rows = [(np.unique(x), y) for x, y in rows]  # each feature counts once
    ones = sum(y for _, y in rows)
    bias = math.log((ones + 1) / (len(rows) - ones + 1))
    if ones in (0, len(rows)):
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), min(bias, -1.0) if not ones else bias)
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    order = np.random.default_rng(seed)
    bias_n = 0.0

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for k in order.permutation(len(rows)).tolist():
            at, y = rows[k]
            w = weights(at)
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + w.sum())))) - y
            root = np.sqrt(n[at])
            sigma = (np.sqrt(n[at] + g * g) - root) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
            bias_n += g * g
            bias -= alpha / (beta + math.sqrt(bias_n)) * g
    at = np.flatnonzero(np.abs(z) > l1)
    w = weights(at)
    return Model(at.astype(np.int32), w.astype(np.float32), bias)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out. Null counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(0))


_MODEL = T.StructType([T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("weights", T.ArrayType(T.FloatType())), T.StructField("bias", T.DoubleType())])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, rows = Features(), []
    for batch in batches:
        ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for at in range(len(ids)):
            text = batch.column(2)[at].as_py()
            rows.append((ids[at], labels[at], xxhash.xxh3_64_intdigest(text), np.unique(features.of(text)).astype(np.int32)))
    rows.sort(key=lambda r: r[:3])
    model = ftrl((x, y) for _, y, _, x in rows)
    yield pa.RecordBatch.from_arrays([pa.array([model.places], pa.list_(pa.int32())), pa.array([model.weights], pa.list_(pa.float32())), pa.array([model.bias], pa.float64())], names=_MODEL.names)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """A model of ``labels`` whose fold isn't 0. At most ``max_rows`` rows of labels are drawn, and their ids broadcast to find the texts; one task fits on those, and the driver gets the non-zero weights.

    Of rows that repeat a drawn id, one text counts, that of least hash, so the task gets no more rows than were drawn. Rows without id, labels other than 0 and 1, and labels without
    a row are left out; an id with both labels counts once with each.
    """
    usable = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label")).where(F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != 0)).distinct()
    drawn = [usable.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(k) for y, k in ((1, max_rows // 4), (0, max_rows - max_rows // 4))]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))
    found = common.ids_and_text(docs, id_col, text_col).join(ids, "doc_id")
    found = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")).select("doc_id", "label", "one.text")
    row = found.repartition(1).mapInArrow(_train, _MODEL).first()
    if row is None:  # Spark leaves the task out if it knows that there are no rows
        return ftrl([])
    return Model(np.array(row["places"], np.int32), np.array(row["weights"], np.float32), row["bias"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Null and empty texts, and texts without letters, get the score of the bias. Only the text enters the score. Repeated rows are scored one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = common.ids_and_text(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(shared)
        for batch in batches:
            for part, texts in bpe.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(judge, texts), pa.float64())], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, schema)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _judge(shared) -> Callable[[str], float]:
    """The score of a text, in a worker."""
    features, w, bias = common.worker_state("toxicity", Features), shared.value.dense(), shared.value.bias

    def score_of(text: str) -> float:
        at = features.of(text)
        at = np.unique(at[w[at] != 0])
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + float(w[at].sum(dtype=np.float64))))))

    return score_of


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't predict toxic, all columns as they are. Each row is judged by its own text, whatever its id; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.BooleanType())
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        judge = _judge(shared)
        for texts in batches:
            yield texts.map(lambda x: judge(x or "") >= 0.5).astype(bool)

    return docs.where(~toxic(F.coalesce(docs[text_col], F.lit(""))))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, fit(docs, common.table(spark, sf_dir, "labels")))
