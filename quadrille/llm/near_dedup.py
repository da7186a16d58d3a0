"""Near duplicates by b-bit MinHash.

1. Every text becomes the set of its distinct word shingles, as 64-bit hashes, and a node: the 128-bit digest of that set. Texts
   with one set are one node, so copies take part once. A node has ``HASHES`` minima; of each, ``BITS`` low bits are kept and
   packed into a signature, and each ``ROWS`` minima make the key of a band.
2. Nodes that share a band key share a bucket. A bucket's centre is its smallest node, and two nodes of a bucket meet in the group of its
   centre; a node is in a group once however many buckets it shares, so most candidates travel once.
3. Groups are cut into chunks of about ``CHUNK`` nodes, each with the group's centre, and a chunk is a task of bounded size. Inside it
   the similarity of two nodes is estimated from equal bit groups of their signatures, corrected for chance collisions; pairs far
   below the threshold (``SIGMAS`` standard errors) go, the rest are confirmed on the full sets. Nodes that are already
   connected there aren't compared. A task returns the edges of a star per connected part: no more rows than nodes, never all pairs.
4. Components of these edges. Most nodes of a large group are linked with its centre, and so with each other; what is left are groups whose nodes are in several components. Those are dealt
   once more: a component that fills chunks has its own, small ones share some, and only pairs of chunks that hold different components are compared, as in 3. The components of all edges, and
   the smallest id of each, are the answer.

A pair at the threshold shares no band with a probability of ``(1 - t ** ROWS) ** (HASHES / ROWS)``: 5e-8 at 0.8, 6e-11 at 0.85.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.llm import bpe, common
from quadrille.llm.components import components

#: A word: everything but ASCII white space. Fixed value of the contract.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE, PERCENT = 5, 80
HASHES, ROWS, BITS, SIGMAS = 128, 4, 4, 6.5
CHUNK, CHUNK_SHINGLES = 256, 1_000_000
CACHE_ENTRIES = 200_000

_WORDS = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_FACTORS = np.random.default_rng(20240229).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: For a byte of the XOR of two signatures, how many of its groups of bits are equal.
_EQUAL = np.array([sum(not x >> k & (1 << BITS) - 1 for k in range(0, 8, BITS)) for x in range(256)], np.uint8)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _MIX[0]
    return x ^ x >> np.uint64(29)


class Shingler:
    """Texts to shingle sets; words are hashed once."""

    def __init__(self):
        self.hash_of: dict[str, int] = {}

    def shingles(self, text: str, size: int) -> np.ndarray:
        """The sorted distinct hashes of the runs of ``size`` words, or of all words if there are fewer; none without words."""
        words = _WORDS.findall(text.lower() if text.isascii() else text.translate(_LOWER))
        if not words:
            return np.zeros(0, np.uint64)
        known = self.hash_of
        new = [w for w in set(words) if w not in known]
        if len(known) + len(new) > CACHE_ENTRIES:
            known.clear()
            new = set(words)
        known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(size, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = _stir(out ^ h[k : len(h) - n + 1 + k]) + _MIX[1]
        return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        low = np.minimum(low, (_FACTORS[:, None] * shingles[None, at : at + 2048]).min(1))
    return low


def signature(low: np.ndarray) -> bytes:
    """The kept bits of each of the minima, packed."""
    kept = (_stir(low) >> np.uint64(24) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    packed = np.zeros(HASHES * BITS // 8, np.uint8)
    for k in range(8 // BITS):
        packed |= kept[k :: 8 // BITS] << np.uint8(k * BITS)
    return packed.tobytes()


def band_keys(low: np.ndarray) -> np.ndarray:
    parts = low.reshape(-1, ROWS)
    key = np.arange(len(parts), dtype=np.uint64) * _MIX[2]
    for k in range(ROWS):
        key = _stir(key ^ parts[:, k]) + _MIX[3]
    return key.view(np.int64)


def estimate(equal: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal groups of bits: of unequal minima one in ``2 ** BITS`` looks equal."""
    chance = 2.0**-BITS
    return (equal / HASHES - chance) / (1 - chance)


def cut_off(percent: int) -> float:
    """Below this estimate a pair is left out: ``SIGMAS`` standard errors under the threshold."""
    chance, t = 2.0**-BITS, percent / 100
    p = t + (1 - t) * chance
    return t - SIGMAS * math.sqrt(p * (1 - p) / HASHES) / (1 - chance)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, full_sets: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, node (null without words), signature and bands, or the set itself as ``shingles``."""
    rows = common.ids_and_text(docs, id_col, text_col)
    more = [("shingles", T.ArrayType(T.LongType()))] if full_sets else [("signature", T.BinaryType()), ("bands", T.ArrayType(T.LongType()))]
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()), *(T.StructField(*x) for x in more)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = common.worker_state("shingles", Shingler)
        with np.errstate(over="ignore"):
            for batch in batches:
                for part, texts in bpe.slices(batch, "text"):
                    sets = [own.shingles(x, shingle) for x in texts]
                    columns = [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())]
                    if full_sets:
                        columns.append(pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())))
                    else:
                        lows = [minima(s) if len(s) else None for s in sets]
                        columns.append(pa.array([None if x is None else signature(x) for x in lows], pa.binary()))
                        columns.append(pa.array([None if x is None else band_keys(x) for x in lows], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _links(percent: int):
    cut = cut_off(percent)

    def unit(group: pd.DataFrame) -> pd.DataFrame:
        """The star edges of the nodes of one pair of chunks; of two chunks only pairs across are compared. Nodes of one label are connected beforehand, and one of them stands for it in the edges."""
        group = group.drop_duplicates("node").sort_values(["side", "node"], kind="stable")
        nodes, labels = group["node"].tolist(), group["label"].tolist()
        size = group["n_shingles"].to_numpy()
        marks = np.frombuffer(b"".join(group["signature"]), np.uint8).reshape(len(nodes), -1)
        sets = [np.asarray(x, np.int64).view(np.uint64) for x in group["shingles"]]  # sorted as unsigned
        across = int((group["side"] == 0).sum())
        two = 0 < across < len(nodes)
        place: dict[bytes, int] = {}
        root = np.array([place.setdefault(x, k) for k, x in enumerate(labels)])
        for i in range(across if two else len(nodes)):
            at = across if two else i + 1
            least, most = np.minimum(size[at:], size[i]), np.maximum(size[at:], size[i])
            open_ = np.flatnonzero((root[at:] != root[i]) & (100 * least >= percent * most)) + at
            if not len(open_):
                continue
            open_ = open_[estimate(_EQUAL[marks[open_] ^ marks[i]].sum(1, dtype=np.int64)) >= cut]
            if not len(open_):
                continue
            own = sets[i]
            other = np.concatenate([sets[j] for j in open_])
            found = np.minimum(np.searchsorted(own, other), len(own) - 1)
            ends = np.cumsum(size[open_])
            common_ = np.add.reduceat((own[found] == other).astype(np.int64), ends - size[open_])
            linked = open_[100 * common_ >= percent * (size[i] + size[open_] - common_)]
            for j in linked.tolist():
                if root[j] != root[i]:
                    root[root == max(root[i], root[j])] = min(root[i], root[j])
        first: dict[int, bytes] = {}
        for k in range(len(nodes)):
            first[root[k]] = min(first.get(root[k], nodes[k]), nodes[k])
        edges = [(nodes[k], first[root[k]]) for k in place.values() if nodes[k] != first[root[k]]]
        return pd.DataFrame(edges, columns=["u", "v"])

    return unit


def find_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two texts are linked if their shingle sets (lower-cased A-Z) have 100 * intersection >= percent * union.
    ``component_id`` is the smallest id that links lead to, ``kept`` whether it is the row's own. Null and empty texts and texts without words
    have no shingles and are linked with nothing. Rows that repeat an id and a set share its component. A null id is never a component's id,
    unless all its ids are null; such a row is kept. An empty table gives an empty result; other columns are not read.
    """
    return _found(docs, id_col, text_col, shingle, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _found(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """The rows of :func:`find_near_copies` with node and root: the smallest node of the component."""
    rows = common.written(sketches(docs, id_col, text_col, shingle), "sketches")
    some = rows.where("node is not null")
    nodes = common.written(some.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), F.first("bands").alias("bands")), "nodes")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre != last").select("key", "centre")
    members = common.written(keyed.join(buckets, "key").select("centre", "node").distinct(), "members")
    wanted = common.written(members.select("node").distinct().join(nodes.select("node", "least_id", "signature"), "node"), "wanted")
    texts = _rows_of(docs, wanted.select("least_id"), id_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sets = sketches(texts, shingle=shingle, full_sets=True).where("node is not null").dropDuplicates(["node"])
    sets = common.written(wanted.join(sets.select("node", "n_shingles", "shingles"), "node").drop("least_id"), "sets")

    def compared(dealt: DataFrame) -> DataFrame:
        return dealt.join(sets, "node").groupBy("centre", "a", "b").applyInPandas(_links(percent), T.StructType([T.StructField("u", T.BinaryType()), T.StructField("v", T.BinaryType())]))

    share = F.greatest(F.count(F.lit(1)) / CHUNK, F.sum("n_shingles") / CHUNK_SHINGLES)
    sizes = members.join(nodes.select("node", "n_shingles"), "node").groupBy("centre").agg(F.ceil(share).cast("int").alias("chunks"))
    # groups of several chunks are few: no more than members / CHUNK; the others' size isn't needed
    large = common.written(sizes.where("chunks > 1"), "large-groups")
    n_large = large.count()
    hinted = F.broadcast(large) if n_large <= common.MAX_BROADCAST_IDS else large
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = members.join(hinted, "centre", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).select("centre", "node", own.alias("a"))
    if n_large:
        dealt = dealt.unionByName(large.select("centre", F.col("centre").alias("node"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("a")))
    parts = common.written(components(compared(dealt.withColumns({"b": F.col("a"), "side": F.lit(0), "label": F.col("node")}))), "components")
    if n_large:
        further = _across(members.join(hinted.select("centre"), "centre", "left_semi"), parts, nodes, share)
        if further is not None:
            edges = parts.select(F.col("node").alias("u"), F.col("root").alias("v"))
            parts = common.written(components(edges.unionByName(compared(further))), "components")
    least = parts.join(nodes.select("node", "least_id"), "node").groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = parts.join(least, "root").select("node", "root", "component_id")
    copied = nodes.where("copies > 1").select("node", F.col("node").alias("root"), F.col("least_id").alias("component_id"))
    answer = linked.unionByName(copied.join(linked, "node", "left_anti"))
    found = rows.select("doc_id", "n_shingles", "node").join(answer, "node", "left").select("doc_id", "n_shingles", "node", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def _across(members: DataFrame, parts: DataFrame, nodes: DataFrame, share: Column) -> DataFrame | None:
    """The units (centre, a, b, node, side, label) that are still to be compared of groups with nodes in several components (their labels); none if there are no such groups."""
    labelled = members.join(parts, "node", "left").select("centre", "node", F.coalesce("root", "node").alias("label"))
    labelled = common.written(labelled, "labelled")
    split = common.written(labelled.groupBy("centre").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("centre"), "split-groups")
    n_split = split.count()
    if not n_split:
        return None
    labelled = labelled.join(F.broadcast(split) if n_split <= common.MAX_BROADCAST_IDS else split, "centre", "left_semi")
    shares = labelled.join(nodes.select("node", "n_shingles"), "node").groupBy("centre", "label").agg(share.alias("share"))
    shares = common.written(shares.withColumn("whole", F.col("share") >= 0.5), "shares")
    pools = shares.where("not whole").groupBy("centre").agg(F.ceil(F.sum("share")).cast("int").alias("pools"))
    placed = labelled.join(shares, ["centre", "label"]).join(pools, "centre", "left")
    of_label = F.concat_ws("-", F.hex("label"), F.pmod(F.xxhash64("node"), F.ceil("share")).cast("string"))
    pooled = F.concat(F.lit("pool-"), F.pmod(F.xxhash64("label"), F.col("pools")).cast("string"))
    placed = common.written(placed.select("centre", "node", "label", F.when(F.col("whole"), of_label).otherwise(pooled).alias("chunk"), F.when(F.col("whole"), F.col("label")).alias("only")), "placed")
    chunks = common.written(placed.select("centre", "chunk", "only").distinct(), "chunks")
    other = chunks.select("centre", F.col("chunk").alias("b"), F.col("only").alias("only_b"))
    pairs = chunks.withColumnRenamed("chunk", "a").join(other, "centre").where("(a < b and not coalesce(only = only_b, false)) or (a = b and only is null)").select("centre", "a", "b")
    first = placed.join(pairs.withColumn("chunk", F.col("a")), ["centre", "chunk"]).withColumn("side", F.lit(0))
    second = placed.join(pairs.where("a != b").withColumn("chunk", F.col("b")), ["centre", "chunk"]).withColumn("side", F.lit(1))
    return first.unionByName(second).select("centre", "a", "b", "node", "side", "label")


def _rows_of(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is among ``ids`` (null too): a few ids are broadcast, more are shuffled."""
    ids = ids.toDF("__id").distinct()
    if ids.count() <= common.MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[id_col].eqNullSafe(ids["__id"]), "left_semi")


def _node(shingle: int):
    @F.pandas_udf(T.BinaryType())
    def node(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = common.worker_state("shingles", Shingler)
        with np.errstate(over="ignore"):
            for texts in batches:
                sets = (own.shingles(x, shingle) for x in texts)
                yield pd.Series([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"" for s in sets], index=texts.index, dtype=object)

    return node


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of each component one row, of its smallest id.

    Rows that repeat an id are judged by their own texts. A row without id stays unless its text is linked with one that has an id. Texts without words are linked with nothing and stay.
    """
    found = common.written(_found(docs, id_col, text_col, shingle, percent).select("doc_id", F.coalesce("node", F.lit(b"")).alias("key"), "root", "kept"), "near-copies")
    # an id that has several texts in one component: the one of the smallest node stays
    # rows that go anyway needn't meet it: a large component has one open row or few
    open_ = F.coalesce(F.col("kept") & F.col("root").isNotNull() & F.col("doc_id").isNotNull(), F.lit(False))
    judged = found.where(open_)
    several = judged.groupBy("root").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first != last").select("root", "first")
    once = judged.join(several, "root", "left").select("doc_id", "key", F.coalesce(F.col("key") == F.col("first"), F.lit(True)).alias("kept"))
    once = once.unionByName(found.where(~open_).select("doc_id", "key", "kept"))
    # rows that agree in id and set: a second one is marked, so that they are looked up
    twice = once.where("doc_id is not null and kept and octet_length(key) > 0").groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key", F.lit(False).alias("kept"))
    key = _node(shingle)(F.coalesce(docs[text_col], F.lit("")))
    return common.rows_that_stay(docs, once.unionByName(twice), key, id_col, one=True)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_near_copies(common.table(spark, sf_dir, "documents"), percent=85)
