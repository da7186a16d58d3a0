"""A minimal acyclic transducer from words (bytes) to sequences of ids, in flat arrays that can be memory-mapped.

Words go in sorted order; a state is registered as soon as no later word can change it, and equal
states (same finality, same edges) are shared, so common suffixes are stored once. Each edge carries an
additive output: the number of words that precede its branch. The outputs on a word's path sum to the
word's rank, and the rank selects its ids. Lookups walk all words of a batch together, one byte a step.
"""

from __future__ import annotations

import json

import numpy as np

_ALIGN = 64


def compile_words(words: dict[bytes, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """The arrays of the transducer of ``words``: edge keys (state * 256 + byte, sorted), targets, outputs, finality, ids by rank."""
    register: dict[tuple, int] = {}
    final: list[bool] = []
    edges: list[tuple[tuple[int, int], ...]] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(final)
            final.append(node[0])
            edges.append(key[1])
        return register[key]

    ordered = sorted(words)
    path: list[list] = [[False, []]]  # [final, [(byte, state)]] along the last word
    last = b""
    for word in [*ordered, None]:
        shared = 0
        if word is not None:
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
        while len(path) > shared + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        if word is not None:
            path += [[False, []] for _ in word[shared:]]
            path[-1][0] = True
            last = word
    start = freeze(path[0])
    below = [0] * len(final)  # words under each state; edges lead to states registered earlier
    for s, out in enumerate(edges):
        below[s] = final[s] + sum(below[t] for _, t in out)
    keys, targets, outputs = [], [], []
    for s, out in enumerate(edges):
        before = int(final[s])
        for byte, t in out:
            keys.append(s * 256 + byte)
            targets.append(t)
            outputs.append(before)
            before += below[t]
    ids = [words[w] for w in ordered]
    return {
        "keys": np.array(keys, np.int64),
        "targets": np.array(targets, np.int32),
        "outputs": np.array(outputs, np.int32),
        "final": np.array(final, np.bool_),
        "start": np.array([start], np.int64),
        "offsets": np.cumsum([0, *map(len, ids)]).astype(np.int64),
        "ids": np.array([i for x in ids for i in x], np.int32),
    }


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: a line of JSON that names the arrays, then their bytes."""
    at, head = 0, {}
    for name, a in arrays.items():
        head[name] = (a.dtype.str, a.shape, at)
        at += -(-a.nbytes // _ALIGN) * _ALIGN
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % _ALIGN) + b"\n"
    with open(path, "wb") as f:
        f.write(line)
        for name, a in arrays.items():
            f.seek(len(line) + head[name][2])
            f.write(a.tobytes())
        f.truncate(len(line) + at)


def load(path: str) -> dict[str, np.ndarray]:
    """The arrays of :func:`save`, memory-mapped: processes on one machine share the pages."""
    with open(path, "rb") as f:
        line = f.readline()
    whole = np.memmap(path, np.uint8, "r")
    out = {}
    for name, (kind, shape, at) in json.loads(line).items():
        n = int(np.prod(shape)) * np.dtype(kind).itemsize
        out[name] = whole[len(line) + at : len(line) + at + n].view(kind).reshape(shape)
    return out


def ranks(t: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The rank of each word, -1 for a word that the transducer lacks."""
    n = len(words)
    rank = np.full(n, -1, np.int64)
    if not n or not len(t["keys"]):
        if n and len(t["final"]) and t["final"][t["start"][0]]:
            rank[[i for i, w in enumerate(words) if not w]] = 0
        return rank
    length = np.fromiter(map(len, words), np.int64, n)
    begin = np.concatenate(([0], np.cumsum(length)[:-1]))
    data = np.frombuffer(b"".join(words), np.uint8)
    alive, state, total = np.arange(n), np.full(n, t["start"][0], np.int64), np.zeros(n, np.int64)
    step = 0
    while len(alive):
        ended = length[alive] == step
        if ended.any():
            good = ended & t["final"][state]
            rank[alive[good]] = total[good]
            alive, state, total = alive[~ended], state[~ended], total[~ended]
        if not len(alive):
            break
        key = state * 256 + data[begin[alive] + step]
        at = np.minimum(np.searchsorted(t["keys"], key), len(t["keys"]) - 1)
        known = t["keys"][at] == key
        alive, at = alive[known], at[known]
        state, total = t["targets"][at].astype(np.int64), total[known] + t["outputs"][at]
        step += 1
    return rank
