"""Hashed n-grams of a text as numpy arrays."""

from __future__ import annotations

import hashlib
import sys
from functools import lru_cache

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
#: For each number of bytes left, up to eight, the bits that belong to them.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Slices of more bytes are hashed one by one.
LONG = 128


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


@lru_cache(maxsize=1)
def shapes() -> np.ndarray:
    """For each code point its kind: upper case, other letter, digit, blank, or the character itself (from 16)."""
    kinds = np.arange(16, sys.maxunicode + 17, dtype=np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            kinds[i] = 1 if c.isupper() else 2
        elif c.isspace():
            kinds[i] = 4
        elif c.isnumeric():
            kinds[i] = 3
    return kinds


def mixed(values: np.ndarray, salt: int, bits: int) -> np.ndarray:
    """The top ``bits`` bits of a multiplicative hash."""
    h = (values + np.uint64(salt * 0x632BE59BD9B4E019 & (1 << 64) - 1)) * _MULT
    h ^= h >> np.uint64(29)
    h *= _STEP
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def windows(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """For n = 1 to ``longest`` one value for each run of n codes."""
    out, value = [], codes
    for n in range(1, longest + 1):
        if n > 1:
            if len(codes) < n:
                break
            value = value[:-1] * _STEP + codes[n - 1 :]
        out.append(value)
    return out


def distinct(hashes: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """The different values, in order of their last place; ``scratch`` has a place for every value."""
    place = np.arange(len(hashes), dtype=scratch.dtype)
    scratch[hashes] = place
    return hashes[scratch[hashes] == place]


def scrambled(values: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit values."""
    h = values ^ (values >> np.uint64(32))
    h = h * _STEP
    h ^= h >> np.uint64(32)
    h *= _STEP
    return h ^ (h >> np.uint64(32))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of ``data`` (uint8), the same wherever the slice stands.

    Eight bytes at a time are mixed into all slices that have so many; as mixing isn't linear, no pattern of letters
    cancels out.  Slices above ``LONG`` bytes are hashed by BLAKE2.
    """
    length = (ends - starts).astype(np.int64)
    out = scrambled((length.astype(np.uint64) + np.uint64(1)) * _MULT)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))  # the eight bytes from each place on
    todo = np.flatnonzero((length > 0) & (length <= LONG))
    at, left = starts[todo], length[todo]
    while len(todo):
        chunk = words[at] & _KEEP[np.minimum(left, 8)]
        out[todo] = scrambled((out[todo] ^ chunk) * _BASE + _STEP)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > LONG).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.uint64(int.from_bytes(digest, "little"))
    return out
