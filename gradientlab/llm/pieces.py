"""Splitting texts into the pieces within which byte-level BPE merges, and a memory of pieces.

Whole batches are split at once: characters are classed, and the borders between
pieces follow from the classes of neighbours.  The borders are those of the
matches of ``PATTERN``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import regex

from .common import gather
from .ngrams import slice_hashes

#: Fixed value: the pattern that the rank files presuppose.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTER, _NUMBER, _OTHER, _BLANK = range(4)
#: Texts are split in runs of about so many characters, which bounds the arrays.
RUN = 1 << 16
_CUT = re.compile(r"(?<=[a-z]) (?=[a-z])")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = np.full(sys.maxunicode + 1, _OTHER, dtype=np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_BLANK, r"\s+")):
        for found in regex.finditer(pattern, everything):
            run = found.group()
            # the characters of a match follow each other but for the gap of the surrogates
            kinds[np.frombuffer(run.encode("utf-32-le"), dtype="<u4")] = kind
    return kinds


def borders(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each character whether a piece begins there; ``first`` marks the first ones of texts."""
    kind = _classes()[codes]
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    solid = kind != _BLANK
    meets = np.zeros(len(codes), dtype=bool)  # of a blank whether a text goes on behind it with something else
    meets[:-1] = ~solid[:-1] & solid[1:] & ~first[1:]
    begins |= meets
    taken = np.flatnonzero(meets & (codes == 32)) + 1  # these have a blank in front
    begins[taken] = False
    for i in np.flatnonzero((codes == 39) & begins).tolist():
        rest = codes[i + 1 : i + 3].tolist()
        stop = i + 1
        while stop < len(first) and stop < i + 3 and not first[stop]:
            stop += 1
        rest = "".join(map(chr, rest[: stop - i - 1]))
        length = 2 if rest[:1] in tuple("stmd") else 3 if rest in ("re", "ve", "ll") else 0
        if length:
            begins[i + 1 : i + length] = False
            if i + length < len(begins):
                begins[i + length] = True
    return begins


def _runs(texts: list[str]) -> Iterator[tuple[str, list[int], list[int]]]:
    """(joined parts of texts, length of each part, number of its text)."""
    parts: list[str] = []
    numbers: list[int] = []
    size = 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text):
            # a blank between small letters always begins a piece, so a text may be cut there
            cut = _CUT.search(text, at + RUN) if len(text) - at > 2 * RUN else None
            end = cut.start() if cut else len(text)
            if parts and size + end - at > RUN:
                yield "".join(parts), list(map(len, parts)), numbers
                parts, numbers, size = [], [], 0
            parts.append(text[at:end])
            numbers.append(k)
            size += end - at
            at = end
    if parts:
        yield "".join(parts), list(map(len, parts)), numbers


def split(text: str) -> list[str]:
    """The pieces of one text."""
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    first = np.zeros(len(codes), dtype=bool)
    first[0] = True
    starts = np.flatnonzero(borders(codes, first)).tolist()
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def _with_room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or a copy of its first ``used`` values, with places for ``more`` behind them."""
    if used + more <= len(array):
        return array
    out = np.empty((used + more) * 5 // 4, dtype=array.dtype)
    out[:used] = array[:used]
    return out


class Memo:
    """Ids of pieces seen before, found by a 64-bit hash and compared byte by byte; emptied when full.

    ``encode`` is asked only for pieces that are new, or whose hash another piece holds.  A worker keeps its memo, so that is
    bounded in pieces (half of 2 to the ``bits``) and in the bytes that spell them (``most``, or one run, if longer), and packed:
    pieces follow each other, so that one offset each gives start and length, and the table of hashes has numbers alone.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], bits: int = 21, most: int = 1 << 24):
        self.encode, self.bits, self.most = encode, bits, most
        self._clear()

    def _clear(self) -> None:
        self.place = np.full(1 << self.bits, -1, dtype=np.int32)
        self.hashes = np.zeros(1, dtype=np.uint64)
        self.values = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.uint32)  # of each piece's ids, and the end of the last
        self.spelling = np.zeros(0, dtype=np.uint8)
        self.spelling_starts = np.zeros(1, dtype=np.uint32)
        self.count = self.used = self.spelled = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each piece, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        mask = (1 << self.bits) - 1
        todo, at = np.arange(len(hashes)), (hashes & np.uint64(mask)).astype(np.int64)
        while len(todo):
            number = self.place[at]
            taken = number >= 0
            hit = taken & (self.hashes[number] == hashes[todo])
            out[todo[hit]] = number[hit]
            on = taken & ~hit
            todo, at = todo[on], (at[on] + 1) & mask
        return out

    def _add(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids, spelled = self.encode(pieces), [p.encode() for p in pieces]
        flat = np.fromiter((i for x in ids for i in x), dtype=np.int32)
        data = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        old, n = self.count, len(ids)
        self.values = _with_room(self.values, self.used, len(flat))
        self.values[self.used : self.used + len(flat)] = flat
        self.spelling = _with_room(self.spelling, self.spelled, len(data))
        self.spelling[self.spelled : self.spelled + len(data)] = data
        self.hashes = _with_room(self.hashes, old, n)
        self.hashes[old : old + n] = hashes
        self.starts, self.spelling_starts = (_with_room(x, old + 1, n) for x in (self.starts, self.spelling_starts))
        self.starts[old + 1 : old + n + 1] = self.used + np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=n))
        self.spelling_starts[old + 1 : old + n + 1] = self.spelled + np.cumsum(np.fromiter(map(len, spelled), dtype=np.int64, count=n))
        place, mask = self.place, (1 << self.bits) - 1
        for number, h in enumerate(hashes.tolist(), old):
            at = h & mask
            while place[at] >= 0:
                at = at + 1 & mask
            place[at] = number
        self.count += n
        self.used += len(flat)
        self.spelled += len(data)

    @staticmethod
    def _slices(numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) for each number."""
        first = starts[numbers].astype(np.int64)
        return first, starts[numbers + 1] - first

    def _others(self, numbers: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The pieces that aren't the remembered ones of their number: another piece has their hash."""
        first, length = self._slices(numbers, self.spelling_starts)
        other = length != ends - starts
        same = np.flatnonzero(~other)
        spelled, bounds = gather(same, first, length, self.spelling)
        if len(same) == len(numbers):  # the pieces make up the whole text
            own = data
        else:
            own, _ = gather(same, starts, ends - starts, data)
        wrong = np.flatnonzero(spelled != own)
        other[same[np.searchsorted(bounds, wrong, side="right") - 1]] = True
        return np.flatnonzero(other)

    def _run(self, text: str, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each part)."""
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        first = np.zeros(len(codes), dtype=bool)
        heads = np.cumsum([0, *lengths[:-1]])
        first[heads] = True
        begins = borders(codes, first)
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(codes))
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        bounds = np.append(starts, len(codes))  # in bytes
        if len(data) > len(codes):
            width = (1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)).astype(np.int64)
            bounds = np.append(0, np.cumsum(width))[bounds]
        hashes = slice_hashes(codes.view(np.uint8), 4 * starts, 4 * ends)
        numbers = self._find(hashes)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new, index = np.unique(hashes[missing], return_index=True)
            spelled = int(np.diff(bounds)[missing[index]].sum())
            if self.count + len(new) > 1 << self.bits - 1 or self.spelled + spelled > self.most:
                self._clear()
                new, index = np.unique(hashes, return_index=True)
                missing = np.arange(len(hashes))
            while len(new) > 1 << self.bits - 1:
                self.bits += 1
                self._clear()
            at = missing[index]
            self._add(new, [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            numbers[missing] = self._find(hashes[missing])
        each, sizes = self._slices(numbers, self.starts)
        ids, offsets = gather(np.arange(len(numbers)), each, sizes, self.values)
        others = self._others(numbers, data, bounds[:-1], bounds[1:])
        if len(others):
            found = self.encode([text[a:b] for a, b in zip(starts[others].tolist(), ends[others].tolist())])
            each = np.split(ids, offsets[1:-1])
            for i, own in zip(others.tolist(), found):
                each[i] = np.array(own, dtype=np.int32)
            ids = np.concatenate(each)
            offsets = np.cumsum([0, *map(len, each)])
        pieces_before = np.searchsorted(starts, np.append(heads, len(codes)))
        return ids, np.diff(offsets[pieces_before])

    def lookup(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts in them)."""
        counts, found = np.zeros(len(texts), dtype=np.int64), [np.zeros(0, dtype=np.int32)]
        for joined, lengths, numbers in _runs([t or "" for t in texts]):
            ids, sizes = self._run(joined, lengths)
            found.append(ids)
            np.add.at(counts, numbers, sizes)
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(counts, out=offsets[1:])
        return np.concatenate(found), offsets
