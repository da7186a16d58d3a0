"""Token counts by a two-tier lookup on the map side; nothing is shuffled.

A text falls into *pieces* at white space: a run of other characters with at most one space before it, or white
space. No pre-token of a byte-level tokenizer crosses a piece, and the tokenizer's own splitter cuts a piece into its pre-tokens.

First tier: a compact hash table of the token counts of frequent pre-tokens, made on the driver from the
tokenizer's vocabulary (and words given) and broadcast. It has one slot array, the pre-tokens' bytes and a byte
per count, and compares the bytes of a pre-token, so a hit is exact. Its entries are bounded by ``max_frequent``.
Second tier: caches in each Python worker, of pre-tokens that the table lacks, which the tokenizer's model encodes, and of the sums of pieces, so that a piece that
comes again isn't split again. Every piece goes this way. Caches are bounded in entries and in the length of an entry.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.llm import bpe, common

MAX_FREQUENT = 200_000
#: A worker's caches are cut down beyond so many entries, and have none of more characters.
CACHE_ENTRIES, CACHE_CHARS = 500_000, 64

_S = bpe.SPACE
PIECES = re.compile(f" ?[^{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class Counts:
    """A hash table from strings to small counts, in four arrays."""

    def __init__(self, counts: dict[str, int]):
        keys = [k.encode() for k in counts]
        size = 1 << max(4, (2 * len(keys)).bit_length())
        self.slots = np.full(size, -1, np.int32)
        self.ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        self.data = b"".join(keys)
        self.counts = np.fromiter(counts.values(), np.uint8, len(keys))
        for n, k in enumerate(keys):
            at = xxhash.xxh3_64_intdigest(k) & size - 1
            while self.slots[at] >= 0:
                at = at + 1 & size - 1
            self.slots[at] = n

    def get(self, key: str) -> int:
        """The count, 0 for a string that the table lacks."""
        k, last = key.encode(), len(self.slots) - 1
        at = xxhash.xxh3_64_intdigest(k) & last
        while (n := self.slots[at]) >= 0:
            if self.data[self.ends[n] : self.ends[n + 1]] == k:
                return int(self.counts[n])
            at = at + 1 & last
        return 0


def frequent_counts(tokenizer, words: Iterable[str] = (), max_frequent: int = MAX_FREQUENT) -> Counts:
    """Counts of the pre-tokens of the vocabulary and of ``words`` with and without a space before them, in the tokenizer's letters for bytes, ``max_frequent`` at most: the lowest ids, thus the most frequent, first."""
    byte_of = {c: b for b, c in enumerate(bpe.byte_letters())}
    split, model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model
    found: dict[str, None] = {}
    for piece, _ in sorted(tokenizer.get_vocab().items(), key=lambda x: x[1]):
        try:
            text = bytes(byte_of[c] for c in piece).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if [t for t, _ in split(text)] == [piece]:
            found[piece] = None
    found |= dict.fromkeys(t for w in words for p in (w, " " + w) for t, _ in split(p))
    sizes = {t: len(model.tokenize(t)) for t in itertools.islice(found, max_frequent)}
    return Counts({t: n for t, n in sizes.items() if 0 < n < 256})


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, spec: str, frequent: Counts):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec)
        self.split, self.model, self.frequent = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model, frequent
        self.spaced: dict[str, int] = {}  # what follows a space: the count of both
        self.bare: dict[str, int] = {}  # other pieces
        self.pretokens: dict[str, int] = {}
        special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def pretoken(self, token: str) -> int:
        n = self.pretokens.get(token)
        if n is None:
            n = self.frequent.get(token) or len(self.model.tokenize(token))
            if len(token) <= CACHE_CHARS:
                self.pretokens[token] = n
        return n

    def learn(self, known: dict[str, int], pieces: Iterable[str], before: str = "") -> list[str]:
        """Puts the counts of pieces into a cache; returns those that are too long to stay there."""
        split, of = self.split, self.pretoken
        known.update((p, sum([of(t) for t, _ in split(before + p)])) for p in pieces)
        return [p for p in pieces if len(p) > CACHE_CHARS]

    def count(self, texts: list[str]) -> list[int]:
        """Where no two spaces meet, text between spaces counts with the space before it and apart from the rest; other texts fall into pieces first."""
        totals, split = [0] * len(texts), []
        for k, x in enumerate(texts):
            parts = [x]
            if self.special is not None and self.special.search(x):
                parts = self.special.split(x)
                totals[k] = len(parts) - 1
            for part in parts:
                if "  " in part:
                    first, *rest = PIECES.findall(part)
                    spaced = [p[1:] for p in rest if p[0] == " " and p != " "]
                    bare = [first, *(p for p in rest if p[0] != " " or p == " ")]
                else:
                    first, *spaced = part.split(" ")
                    bare = [first] if first else []
                split.append((k, bare, spaced))
        if len(self.pretokens) > CACHE_ENTRIES:
            self.pretokens.clear()
        long: list[tuple[dict[str, int], list[str]]] = []
        for name, place, before in (("bare", 1, ""), ("spaced", 2, " ")):
            known, seen = getattr(self, name), set().union(*(x[place] for x in split))
            new = [p for p in seen if p not in known]
            if len(known) + len(new) > CACHE_ENTRIES:  # what this slice has stays, most of it is frequent
                known = {p: known[p] for p in seen if p in known}
                setattr(self, name, known)
            long.append((known, self.learn(known, new, before)))
        of_bare, of_spaced = self.bare.__getitem__, self.spaced.__getitem__
        for k, bare, spaced in split:
            totals[k] += sum(map(of_spaced, spaced)) + sum(map(of_bare, bare))
        for known, pieces in long:
            for p in pieces:
                del known[p]
        return totals


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, frequent_words: Iterable[str] = (), max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than ``limit``).

    The whole text counts, as the tokenizers library encodes it with ``add_special_tokens=False``;
    strings of special tokens inside a text count as one token, as by its default. The tokenizer must be byte-level
    BPE without normaliser and without a space put before texts. Null and empty texts have 0 bytes and 0 tokens. Other columns are not read.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if tokenizer.normalizer is not None or type(tokenizer.pre_tokenizer).__name__ != "ByteLevel" or tokenizer.pre_tokenizer.add_prefix_space:
        raise ValueError("a byte-level tokenizer without normaliser and prefix space is needed")
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer.to_str(), frequent_counts(tokenizer, frequent_words, max_frequent)))
    rows = common.ids_and_text(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = common.worker_state(("tokens", hash(shared.value[0])), lambda: Counter(*shared.value))
        for batch in batches:
            for part, texts in bpe.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(counter.count(texts), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
