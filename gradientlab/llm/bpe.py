"""Byte-level BPE over a rank file: encoding and decoding.

Within a piece, merging takes the leftmost pair of lowest rank until no pair
has a rank.  A segment tree over the byte positions of the piece holds, per
live position, the rank of the pair that starts there joined with the position;
its root is the leftmost minimum.  A merge changes three leaves (the pair at the
merged position, the pair before it, and the position that dies), so a piece of
n bytes takes O(n log n) steps, whatever it looks like.  Pieces met before are
not merged again.

Null texts count as empty and get an empty id list.  Very long texts are
encoded whole.  Rows are independent of each other: repeated rows give repeated
results, an empty table gives an empty table, and other columns pass through
(columns named like an added one are replaced).
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import add_columns, gather
from .pieces import RUN, Memo

_NONE = 1 << 62


class Vocabulary:
    """Ranks of a file with one base64 token and its rank per line."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.longest = max(map(len, self.ranks))
        self.lengths = np.zeros(max(self.ranks.values()) + 1, dtype=np.int64)
        for token, rank in self.ranks.items():
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        by_rank = sorted((rank, token) for token, rank in self.ranks.items())
        self.data = np.frombuffer(b"".join(token for _, token in by_rank), dtype=np.uint8)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ranks, longest = self.ranks.get, self.longest
        whole = ranks(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        bits = max(n - 2, 0).bit_length()
        size = 1 << bits
        mask = size - 1
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            rank = ranks(piece[i : i + 2])
            if rank is not None:
                tree[size + i] = rank << bits | i
        for i in range(mask, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        following, before = [*range(1, n + 1), n], [*range(-1, n)]
        while (best := tree[1]) < _NONE:
            at = best & mask
            gone = following[at]
            end = following[gone]
            following[at], before[end] = end, at
            for i, stop in ((gone, 0), (at, following[end] if end < n else 0), (before[at], end)):
                if not 0 <= i < size:
                    continue
                value = _NONE
                if 0 < stop - i <= longest:
                    rank = ranks(piece[i:stop])
                    if rank is not None:
                        value = rank << bits | i
                i += size
                if tree[i] == value:
                    continue
                tree[i] = value
                i >>= 1
                while i:
                    a, b = tree[2 * i], tree[2 * i + 1]
                    if b < a:
                        a = b
                    if tree[i] == a:
                        break
                    tree[i] = a
                    i >>= 1
        ids, i = [], 0
        while i < n:
            end = following[i]
            ids.append(self.ranks[piece[i:end]])
            i = end
        return ids

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, offset before each id); ``RUN`` ids at a time, as finding the bytes takes 16 times their memory."""
        ends = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(self.lengths[ids], out=ends[1:])
        out = np.empty(ends[-1], dtype=np.uint8)
        for k in range(0, len(ids), RUN):
            part = ids[k : k + RUN]
            out[ends[k] : ends[k + len(part)]] = gather(part, self.starts, self.lengths, self.data)[0]
        return out, ends


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _memo(path: str) -> Memo:
    merge = vocabulary(path).merge
    return Memo(lambda pieces: [merge(p.encode()) for p in pieces])


def encode_texts(texts: list[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets of the texts in them)."""
    return _memo(path).lookup(texts)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array<int>): the token ids of the whole text."""

    def run(column: pa.Array) -> list[pa.Array]:
        values, offsets = encode_texts(column.to_pylist(), path)
        return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))]

    return add_columns(df, text, f"`{ids}` array<int>", run)


def decode(df: DataFrame, path: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Add ``data`` (binary): the bytes that the ids stand for; a null list gives no bytes."""

    def run(column: pa.Array) -> list[pa.Array]:
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        out, ends = vocabulary(path).decode(values)
        bounds = np.zeros(len(column) + 1, dtype=np.int64)
        np.cumsum(lengths, out=bounds[1:])
        whole = out.tobytes()
        cut = ends[bounds]
        return [pa.array([whole[a:b] for a, b in zip(cut[:-1], cut[1:])], type=pa.binary())]

    return add_columns(df, ids, f"`{data}` binary", run)


def encode_and_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", data: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass, so that a task needs one Python worker."""

    def run(column: pa.Array) -> list[pa.Array]:
        values, offsets = encode_texts(column.to_pylist(), path)
        out, ends = vocabulary(path).decode(values)
        whole, cut = out.tobytes(), ends[offsets]
        return [
            pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values)),
            pa.array([whole[a:b] for a, b in zip(cut[:-1], cut[1:])], type=pa.binary()),
        ]

    return add_columns(df, text, f"`{ids}` array<int>, `{data}` binary", run)
