"""Byte-level BPE encoding and decoding.

A piece of text is a row of byte positions. A segment tree over the positions holds, at each
inner node, the smallest (rank, position) of the neighbouring pairs below it, so the root names
the leftmost pair of lowest rank. A merge changes three leaves - the merged pair and the pairs
of its live neighbours - and the paths above them. Short pieces run many at a time, one tree per
row of an array; a long piece has a tree of its own, so that n bytes take n log n steps.

Null text is empty and has no tokens. Empty text has no tokens. Rows may repeat, and columns
of the input named like a result column are replaced. Only the vocabulary is broadcast, whose
size is fixed.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField

from rigstream.llm.common import map_rows, once

#: Pieces up to so many bytes run together.
SHORT = 64
#: Trees that run together.
ROWS = 8_192
#: Encoded pieces, none longer than SHORT, that a worker remembers, and as many that it met before these.
REMEMBERED = 100_000
NONE = np.iinfo(np.int64).max


def read_ranks(path: str) -> bytes:
    """The bytes of a rank file (base64 token and rank per line)."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(rank_file: bytes) -> dict[bytes, int]:
    """Rank of each token."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}


def token_table(ranks: dict[bytes, int]) -> pa.BinaryArray:
    """The bytes of every id."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return pa.array(tokens, pa.binary())


class Encoder:
    """Encoder of one vocabulary."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex

        ranks = parse_ranks(rank_file)
        self.tokens = token_table(ranks)
        self.packed = [np.int32(i).tobytes() for i in range(len(self.tokens))]
        get = ranks.get
        merges = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = get(token[:cut])
                right = get(token[cut:])
                if left is not None and right is not None:
                    merges[left << 32 | right] = rank
        self.merges = merges
        self.keys = np.array(sorted(merges), np.int64)
        self.merged = np.array([merges[k] for k in self.keys.tolist()], np.int64)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.ranks = ranks

    def encode_texts(self, texts: list[str | None]) -> list[bytes]:
        """The token ids of each text, as the bytes of 32-bit numbers."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        new = [p for p in set(chain.from_iterable(split)) if p not in known]
        known.update((p, before[p]) for p in new if p in before)
        long = self._learn([p for p in new if p not in known])
        out = [b"".join(map(known.__getitem__, p)) for p in split]
        for piece in long:
            del known[piece]
        return out

    def _learn(self, pieces: list[str]) -> list[str]:
        """Encode pieces; those returned are too long to be remembered."""
        long = []
        rows: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode("utf-8")
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[piece] = self.packed[rank]
            elif len(data) > SHORT:
                self.known[piece] = np.array(self.merge_long(data), np.int32).tobytes()
                long.append(piece)
            else:
                rows.setdefault(max(4, 1 << (len(data) - 1).bit_length()), []).append((piece, data))
        for width, found in rows.items():
            for i in range(0, len(found), ROWS):
                part = found[i : i + ROWS]
                self.known.update(zip([p for p, _ in part], self.merge_short([d for _, d in part], width)))
        return long

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, -1 where they do not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def merge_short(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Merge pieces of up to ``width`` bytes, a power of two; row i of ``tree`` is the tree of piece i."""
        n = len(pieces)
        sizes = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        ids = self.of_byte[data]
        place = np.arange(width)
        alive = place < sizes[:, None]
        after = np.where(place + 1 < sizes[:, None], place + 1, -1)
        before = np.broadcast_to(place - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, np.int64)
        ranks = self._pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        tree[:, width : 2 * width - 1] = np.where(alive[:, 1:] & (ranks >= 0), ranks * width + place[:-1], NONE)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        flat, ids_, after_, before_, alive_ = (a.reshape(-1) for a in (tree, ids, after, before, alive))
        row = np.nonzero(tree[:, 1] < NONE)[0]
        while len(row):
            root = flat[row * 2 * width + 1]
            at, base = root % width, row * width
            gone = after_[base + at]
            ids_[base + at] = root // width
            alive_[base + gone] = False
            follows = after_[base + gone]
            after_[base + at] = follows
            has = follows >= 0
            before_[(base + follows)[has]] = at[has]
            prior = before_[base + at]
            trees = row * 2 * width + width
            flat[trees + gone] = NONE
            flat[trees + at] = NONE
            self._set(flat, trees[has], at[has], ids_, base[has], follows[has], width)
            had = prior >= 0
            self._set(flat, trees[had], prior[had], ids_, base[had], at[had], width)
            for place_, rows_ in ((gone, row), (at, row), (prior[had], row[had])):
                node = (place_ + width) >> 1
                top = rows_ * 2 * width
                for _ in range(width.bit_length() - 1):
                    flat[top + node] = np.minimum(flat[top + 2 * node], flat[top + 2 * node + 1])
                    node >>= 1
            row = row[flat[row * 2 * width + 1] < NONE]
        tokens = ids[alive].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(alive.sum(1))).tolist()
        return [tokens[b:e] for b, e in zip([0, *ends], ends)]

    def _set(self, flat, trees, place, ids, base, right, width) -> None:
        """Store the pair (place, right) of each row in the leaf of ``place``."""
        rank = self._pair_ranks(ids[base + place], ids[base + right])
        flat[trees + place] = np.where(rank >= 0, rank * width + place, NONE)

    def merge_long(self, data: bytes) -> list[int]:
        """Merge one piece of any length."""
        n = len(data)
        width = 1 << (n - 1).bit_length()
        ids = [self.ranks[bytes([b])] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        after[-1] = -1
        merges, none = self.merges.get, NONE
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = merges(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(place: int, key: int) -> None:
            node = place + width
            tree[node] = key
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    return
                tree[node] = low

        def pair(left: int, right: int) -> int:
            rank = merges(ids[left] << 32 | ids[right])
            return none if rank is None else rank * width + left

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            follows, prior = after[gone], before[at]
            ids[at], ids[gone] = rank, -1
            after[at] = follows
            put(gone, none)
            if follows >= 0:
                before[follows] = at
                put(at, pair(at, follows))
            else:
                put(at, none)
            if prior >= 0:
                put(prior, pair(prior, at))
        return [i for i in ids if i >= 0]


def encode(docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the token ids of ``text``."""
    ranks = docs.sparkSession.sparkContext.broadcast(rank_file)

    def step(texts: pa.Array) -> list[pa.Array]:
        return [_encoded(once(ranks, lambda data: Encoder(data, pattern)), texts)]

    return map_rows(docs, [StructField(into, ArrayType(IntegerType()))], text, step)


def decode(docs: DataFrame, rank_file: bytes, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that ``ids`` stand for; null ids are empty."""
    ranks = docs.sparkSession.sparkContext.broadcast(rank_file)

    def step(found: pa.Array) -> list[pa.Array]:
        return [_decoded(once(ranks, lambda data: token_table(parse_ranks(data))), found)]

    return map_rows(docs, [StructField(into, BinaryType())], ids, step)


def round_trip(docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` and, decoded from them, ``decoded``; one Python worker does both."""
    ranks = docs.sparkSession.sparkContext.broadcast(rank_file)

    def step(texts: pa.Array) -> list[pa.Array]:
        encoder = once(ranks, lambda data: Encoder(data, pattern))
        ids = _encoded(encoder, texts)
        return [ids, _decoded(encoder.tokens, ids)]

    return map_rows(docs, [StructField("ids", ArrayType(IntegerType())), StructField("decoded", BinaryType())], text, step)


def _encoded(encoder: Encoder, texts: pa.Array) -> pa.Array:
    packed = encoder.encode_texts(texts.to_pylist())
    ends = np.cumsum([0, *map(len, packed)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _decoded(tokens: pa.BinaryArray, found: pa.Array) -> pa.Array:
    """The bytes of each list of ids: tokens are laid out one after the other, then cut at the ends of the lists."""
    laid = tokens.take(found.flatten())
    ends = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)))
    _, offsets, data = laid.buffers()
    places = np.frombuffer(offsets, np.int32, len(laid) + 1, 4 * laid.offset) if len(laid) else np.zeros(1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(places[ends].tobytes()), data])


def digests(docs: DataFrame, rank_file: bytes, pattern: str, keep: list[str]) -> DataFrame:
    """``keep``, then number and SHA-256 of the ids of ``text`` and the SHA-256 of the bytes they decode to."""
    coded = round_trip(docs.select(*keep, "text"), rank_file, pattern)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
