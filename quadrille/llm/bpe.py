"""BPE encoding and decoding with a compiled lexicon of frequent words.

A tokenizer file (BPE with word ends) is compiled once, on the driver, into one flat file: the transducer of
``lexicon`` over frequent words, the table of merges and the strings of the ids. Spark ships the file to
each executor, where all Python workers memory-map it. A word is looked up in the worker's cache, then in the
transducer, and is else merged exactly, lowest rank first and leftmost among equals.

The frequent words are by default those of the vocabulary itself: pieces that end a word. More can be given.
The lexicon and the caches only save time; results don't depend on them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import sys
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.llm import common, lexicon

#: White space of Unicode, as the tokenizer's patterns mean it.
SPACE = "\t-\r \x85\xa0  -     　"
#: The contractions that split off. Fixed values of the tokenizer file's own pattern.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: A worker's cache is cut down beyond so many distinct entries (about 80 MB), and keeps none of more characters.
CACHE_ENTRIES, CACHE_CHARS = 250_000, 64
#: Texts of a batch are taken together up to so many characters.
SLICE_CHARS = 2_000_000

_CHUNKS = re.compile("[^\t-\r ]+")
_ODD = re.compile("[\x1c-\x1f]")


def later_letters(tokenizer_path: str) -> dict:
    """What the tokenizers library makes of the letters and digits that ``unicodedata`` doesn't know and ``regex`` does, as the three follow different versions of Unicode.

    ``neither``: those that count as neither letter nor digit for it; ``lower``: how it lower-cases others.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    unassigned = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    known = regex.findall(r"[\p{L}\p{N}]", unassigned)
    neither = [c for c in known if len(tokenizer.pre_tokenizer.pre_tokenize_str(f"!{c}!")) == 1]
    lower = {c: n for c in known if (n := tokenizer.normalizer.normalize_str(c)) != c}
    return {"neither": "".join(neither), "lower": lower}


def word_pattern(neither: str) -> regex.Pattern:
    """The split into words: contractions, runs of letters, single digits, runs of other characters but white space."""
    kinds = [rf"[\p{{{k}}}--[{neither}]]" if neither else rf"\p{{{k}}}" for k in "LN"]
    return regex.compile(rf"(?V1){CONTRACTIONS}|{kinds[0]}+|{kinds[1]}|(?:(?!{kinds[0]}|{kinds[1]})[^{SPACE}])+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


#: Words up to so many bytes merge together, a batch at a time; longer ones one by one on a heap.
BATCH_BYTES = 48
_TABLE_BITS, _NONE = 20, np.int64(1 << 62)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _slot(keys: np.ndarray, factor: np.uint64) -> np.ndarray:
    return ((keys.astype(np.uint64) * factor) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def pair_tables(keys: np.ndarray) -> dict[str, np.ndarray]:
    """Two hash tables over the pairs: what shares a slot of the first goes to the second, under a factor that leaves no two in one slot there."""
    first, second = np.full(1 << _TABLE_BITS, -1, np.int32), np.full(1 << _TABLE_BITS, -1, np.int32)
    at = _slot(keys, _FACTOR)
    first[at[::-1]] = np.arange(len(keys), dtype=np.int32)[::-1]
    rest = np.flatnonzero(first[at] != np.arange(len(keys)))
    factor = _FACTOR
    while True:
        factor = np.uint64(int(factor) * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1 | 1)
        at = _slot(keys[rest], factor)
        if len(np.unique(at)) == len(at):
            break
    second[at] = rest
    return {"table_1": first, "table_2": second, "factor_2": np.array([factor], np.uint64)}


class Merger:
    """Exact merges: of the adjacent pairs of a word the one of lowest rank merges first, the leftmost among equals."""

    def __init__(self, t: dict[str, np.ndarray]):
        self.keys, self.values, self.first, self.last = t["pair_keys"], t["pair_values"], t["first"], t["last"]
        self.table_1, self.table_2, self.factor_2 = t["table_1"], t["table_2"], t["factor_2"][0]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """rank << 20 | merged id of each pair, or a value above all."""
        key = a.astype(np.int64) << 20 | b
        at = self.table_1[_slot(key, _FACTOR)]
        out = np.full(len(key), _NONE)
        some = np.flatnonzero(at >= 0)
        same = self.keys[at[some]] == key[some]
        out[some[same]] = self.values[at[some[same]]]
        other = some[~same]
        if len(other):
            at = self.table_2[_slot(key[other], self.factor_2)]
            good = (at >= 0) & (self.keys[at] == key[other])
            out[other[good]] = self.values[at[good]]
        return out

    def symbols(self, word: bytes) -> np.ndarray:
        ids = self.first[np.frombuffer(word, np.uint8)]
        ids[-1:] = self.last[np.frombuffer(word[-1:], np.uint8)]
        return ids[ids >= 0]

    def merge_long(self, word: bytes) -> list[int]:
        """One word, in time n log n."""
        ids = self.symbols(word)
        n, heap = len(ids), []
        if n > 1:
            heap = [(int(r), i) for i, r in enumerate(self.rank(ids[:-1], ids[1:])) if r != _NONE]
        heapq.heapify(heap)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))

        def push(i: int) -> None:
            if i >= 0 and after[i] < n:
                r = int(self.rank(np.array([ids[i]]), np.array([ids[after[i]]]))[0])
                current[i] = r
                if r != _NONE:
                    heapq.heappush(heap, (r, i))

        current = dict((i, r) for r, i in heap)
        while heap:
            r, i = heapq.heappop(heap)
            if current.get(i) != r:
                continue
            gone = after[i]
            ids[i], ids[gone] = r & 0xFFFFF, -1
            current.pop(gone, None)
            current.pop(i, None)
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            push(before[i])
        return [x for x in ids if x >= 0]

    def __call__(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word. All words merge once a round; those without a pair left are done."""
        out: list[list[int]] = [[] for _ in words]
        short = []
        for k, w in enumerate(words):
            if len(w) > BATCH_BYTES:
                out[k] = self.merge_long(w)
            elif w:
                short.append(k)
        if not short:
            return out
        data = np.frombuffer(b"".join([words[k] for k in short]), np.uint8)
        ends = np.cumsum([len(words[k]) for k in short])
        ids = self.first[data]
        ids[ends - 1] = self.last[data[ends - 1]]
        owner = np.repeat(np.arange(len(short)), np.diff(ends, prepend=0))
        ids, owner = ids[ids >= 0], owner[ids >= 0]
        rank = np.full(len(ids), _NONE)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.rank(ids[inner], ids[inner + 1])
        while len(ids):
            start = np.flatnonzero(np.diff(owner, prepend=-1))
            low = np.minimum.reduceat(rank, start)
            size = np.diff(start, append=len(ids))
            done = low == _NONE
            if done.any():
                gone = np.repeat(done, size)
                flat, at = ids[gone].tolist(), 0
                for k, n in zip(owner[start[done]].tolist(), size[done].tolist(), strict=True):
                    out[short[k]] = flat[at : at + n]
                    at += n
                ids, owner, rank, low, size = ids[~gone], owner[~gone], rank[~gone], low[~done], size[~done]
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == np.repeat(low, size))
            hits = hits[np.diff(owner[hits], prepend=-1) != 0]
            ids[hits] = low & 0xFFFFF
            rank[hits] = _NONE
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            hits -= np.arange(len(hits))
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            touched = np.concatenate((hits, hits - 1))
            touched = touched[(touched >= 0) & (touched < len(ids) - 1)]
            inner = owner[touched] == owner[touched + 1]
            rank[touched] = np.where(inner, self.rank(ids[touched], ids[touched + 1]), _NONE)
            rank[-1] = _NONE
        return out


def compile_tokenizer(tokenizer_path: str, frequent_words: Iterable[str] = ()) -> dict[str, np.ndarray]:
    """The arrays of the compiled file. ``frequent_words`` are words as they stand after normalisation, beside those of the vocabulary."""
    spec = json.load(open(tokenizer_path, encoding="utf-8"))
    vocab, end, letters = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"], byte_letters()
    byte_of = {c: b for b, c in enumerate(letters)}
    pairs = {vocab[a] << 20 | vocab[b]: rank << 20 | vocab[a + b] for rank, (a, b) in reversed(list(enumerate(spec["model"]["merges"])))}
    t = {
        "pair_keys": np.array(list(pairs), np.int64),
        "pair_values": np.array(list(pairs.values()), np.int64),
        "first": np.array([vocab.get(c, -1) for c in letters], np.int32),
        "last": np.array([vocab.get(c + end, -1) for c in letters], np.int32),
    }
    t |= pair_tables(t["pair_keys"])
    merge = Merger(t)
    whole = [piece[: -len(end)] for piece in vocab if piece.endswith(end)]
    words = sorted({w.encode() for w in frequent_words} | {bytes(byte_of[c] for c in w) for w in whole if all(c in byte_of for c in w)})
    t |= {f"word_{k}": v for k, v in lexicon.compile_words(dict(zip(words, map(tuple, merge(words)), strict=True))).items()}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    by_id = {i: piece for piece, i in [*vocab.items(), *special.items()]}
    pieces = [by_id.get(i, "").encode() for i in range(max(by_id) + 1)]
    return t | {
        "piece_at": np.cumsum([0, *map(len, pieces)]).astype(np.int64),
        "piece_bytes": np.frombuffer(b"".join(pieces), np.uint8),
        "special": np.frombuffer(json.dumps(special).encode(), np.uint8),
        "later": np.frombuffer(json.dumps(later_letters(tokenizer_path)).encode(), np.uint8),
    }


_compiled: dict[tuple, str] = {}


def ship(spark: SparkSession, tokenizer_path: str, frequent_words: Iterable[str] = ()) -> str:
    """Compiles the tokenizer into the shared folder and hands the file to Spark, which brings it to every executor, also to later ones. Returns its name there."""
    words = tuple(sorted(set(frequent_words)))
    key = (os.path.realpath(tokenizer_path), words, spark.sparkContext.applicationId)
    if key not in _compiled or not common.exists(spark, _compiled[key]):
        arrays = compile_tokenizer(tokenizer_path, words)
        digest = hashlib.sha256(b"".join(a.tobytes() for a in arrays.values())).hexdigest()[:16]
        with tempfile.NamedTemporaryFile(suffix=".bin") as local:  # of the driver, gone at the end of this block
            lexicon.save(local.name, arrays)
            _compiled[key] = common.shared_copy(spark, local.name, f"lexicon-{digest}.bin")
    spark.sparkContext.addFile(_compiled[key])
    return os.path.basename(_compiled[key])


class WordBpe:
    """Encodes and decodes with a compiled file."""

    def __init__(self, path: str):
        t = lexicon.load(path)
        self.words = {k.removeprefix("word_"): v for k, v in t.items() if k.startswith("word_")}
        self.merge = Merger(t)
        at, data = t["piece_at"].tolist(), t["piece_bytes"].tobytes()
        self.pieces = [data[a:b].decode() for a, b in zip(at, at[1:], strict=False)]
        self.names = list(map(str, range(len(self.pieces))))
        self.piece_of = dict(zip(self.names, self.pieces, strict=True))
        self.special: dict[str, int] = json.loads(t["special"].tobytes())
        later = json.loads(t["later"].tobytes())
        self.later = str.maketrans(later["lower"] | {"Σ": "σ"})
        self.neither = frozenset(later["neither"])
        self.find_words, self.find_slowly = word_pattern("").findall, word_pattern(later["neither"]).findall
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, str] = {}  # a chunk without white space: its ids as text

    def word_ids(self, words: list[bytes]) -> list[list[int]]:
        rank = lexicon.ranks(self.words, words)
        merged = iter(self.merge([words[k] for k in np.flatnonzero(rank < 0)]))
        begin, end = self.words["offsets"][rank].tolist(), self.words["offsets"][rank + 1].tolist()
        ids = self.words["ids"]
        return [ids[a:b].tolist() if r >= 0 else next(merged) for r, a, b in zip(rank.tolist(), begin, end, strict=True)]

    def learn(self, chunks: list[str]) -> None:
        """Puts chunks into the cache. A word that was a chunk of its own before is known already."""
        known, find, parts, wanted = self.known, self.find_words, [], set()
        for c in chunks:
            if c.isascii():
                plain = c.lower()
                words = plain if plain.isalpha() else find(plain)
            else:
                plain = unicodedata.normalize("NFC", c).translate(self.later).lower()
                words = find(plain) if self.neither.isdisjoint(plain) else self.find_slowly(plain)
                words = words[0] if len(words) == 1 else words
            parts.append(words)
            if type(words) is str:
                wanted.add(words)
            else:
                wanted.update(words)
        found = {w: known[w] for w in wanted if w in known and w.isalpha()}
        new = [w for w in wanted if w not in found]
        names = self.names
        found.update((w, " ".join([names[i] for i in ids])) for w, ids in zip(new, self.word_ids([w.encode() for w in new]), strict=True))
        get = found.__getitem__
        known.update((c, get(ws) if type(ws) is str else " ".join(map(get, ws))) for c, ws in zip(chunks, parts, strict=True))

    def encode_slice(self, texts: list[str]) -> list[str]:
        """The ids of each text as decimals joined by one space. The words of all texts are looked up together."""
        split = []
        for x in texts:
            special = self.at_special is not None and "<" in x and self.at_special.search(x)
            split.append([y if y in self.special else _chunks(y) for y in self.at_special.split(x) if y] if special else [_chunks(x)])
        seen = set().union(*(y for parts in split for y in parts if not isinstance(y, str)))
        new = [y for y in seen if y not in self.known]
        if len(self.known) + len(new) > CACHE_ENTRIES:  # what this slice has stays, most of it is frequent
            self.known = {y: self.known[y] for y in seen if y in self.known}
        self.learn(new)
        known = self.known
        out = [" ".join(filter(None, [str(self.special[y]) if isinstance(y, str) else " ".join(filter(None, map(known.__getitem__, y))) for y in parts])) for parts in split]
        for y in new:
            if len(y) > CACHE_CHARS:
                del known[y]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The tokenizer has no decoder: the strings of the ids joined by one space. Ids that it lacks are left out."""
        pieces = self.pieces
        return " ".join([pieces[i] for i in ids if 0 <= i < len(pieces) and pieces[i]])

    def decode_text(self, ids: list[str]) -> str:
        """The same for known ids as decimals."""
        return " ".join(map(self.piece_of.__getitem__, ids))


def _chunks(text: str) -> list[str]:
    return text.split() if text.isascii() and not _ODD.search(text) else _CHUNKS.findall(text)


def _worker(name: str) -> WordBpe:
    path = SparkFiles.get(name)
    return common.worker_state(("bpe", path), lambda: WordBpe(path))


def slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with their texts, each of about :data:`SLICE_CHARS` bytes, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        end = int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_CHARS)) + 1
        part = batch.slice(at, end - at)
        yield part, ["" if x is None else x for x in part.column(part.schema.get_field_index(text)).to_pylist()]
        at = end


#: What encode can return beside the id of a row.
OUTPUTS = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "ids_sha256": T.StringType(), "decoded": T.StringType(), "decoded_sha256": T.StringType()}


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", outputs: Iterable[str] = ("n_tokens", "ids"), frequent_words: Iterable[str] = ()) -> DataFrame:
    """One row per row of ``docs``: its id and the columns named in ``outputs`` (see :data:`OUTPUTS`), for the whole text.

    The ids are those that the tokenizers library gives without added specials; strings of special
    tokens inside a text become their ids, as by its default. Null and empty texts have no tokens. Nothing is shuffled; a
    long text is one row of one task. Other columns of ``docs`` are not read.
    """
    outputs = list(outputs)
    name = ship(docs.sparkSession, tokenizer_path, frequent_words)
    rows = common.ids_and_text(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(o, OUTPUTS[o]) for o in outputs)])
    decodes = bool({"decoded", "decoded_sha256"} & set(outputs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker(name)
        kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
        for batch in batches:
            for part, texts in slices(batch, "text"):
                out: dict[str, list] = {o: [] for o in OUTPUTS}
                for line in bpe.encode_slice(texts):
                    texts_of_ids = line.split()
                    decoded = bpe.decode_text(texts_of_ids) if decodes else ""
                    out["n_tokens"].append(len(texts_of_ids))
                    out["ids"].append(np.fromiter(map(int, texts_of_ids), np.int32, len(texts_of_ids)) if "ids" in outputs else None)
                    out["ids_sha256"].append(hashlib.sha256(line.encode()).hexdigest())
                    out["decoded"].append(decoded)
                    out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(out[o], kinds.get(o, pa.string())) for o in outputs)], names=["doc_id", *outputs])

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the decoded text of ``ids_col`` as ``out_col``; null ids give null, unknown ids are left out. A column of that name is replaced."""
    name = ship(rows.sparkSession, tokenizer_path)

    @F.pandas_udf(T.StringType())
    def text(ids):
        bpe = _worker(name)
        return ids.map(lambda x: None if x is None else bpe.decode(x))

    return rows.withColumn(out_col, text(F.col(ids_col)))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
