"""Fill-in-the-middle documents, cut at unit ends found word by word in UTF-8 bytes.

A unit is a run of the letters A-Z and a-z, or any other single code point.  Texts
of a batch stand in one byte buffer, each followed by a zero byte, which is read
as 64-bit words of eight bytes.  In each word arithmetic on all eight bytes at
once marks those that end a unit: every byte but one in front of a continuation
byte, and one between two letters.  ``bitwise_count`` gives the units of a word;
the running total of those finds the word in which the k-th unit of a text ends,
and taking its lowest marks away finds the byte.  So no text is split into units.

A document is cut at two of its n + 1 places between units, drawn from a hash of
its id, into prefix, middle and suffix.  Its form is ``plain`` (unchanged) if it is
empty, holds one of the sentinels or is drawn to stay so; else ``psm`` (prefix,
suffix, middle) or ``spm`` (suffix, prefix, middle), each part behind its
sentinel.  Texts without sentinels can't form one across a cut, so the output
together with its form gives back the exact text (``restore``).

Draws are the first four 8-digit groups of the hex sha256 of ``<seed>:`` and the
decimal id: cuts at the first two modulo n + 1, plain if the third modulo 100 is
at least ``percent``, spm if the fourth modulo 100 is below ``spm_percent``.

Null texts count as empty, a null id as ''.  Very long texts are cut whole; a run
of texts is bounded by bytes, or is one text.  Rows are independent: repeated rows
give repeated results, an empty table an empty one; other columns pass through
(columns named like an added one are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, replace_columns

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ADDED = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored string"
#: Bytes of text that are marked at a time (or one text, if longer).
RUN = 1 << 20
#: Words that are marked at a time.
SPAN = 1 << 16

_ONES = 0x0101010101010101
_TOP = np.uint64(0x80 * _ONES)
_LOW = np.uint64(0x7F * _ONES)
_CASE = np.uint64(0x20 * _ONES)
_FROM_A = np.uint64((0x80 - ord("a")) * _ONES)
_PAST_Z = np.uint64((0x80 - ord("z") - 1) * _ONES)
_BYTE, _LAST = np.uint64(8), np.uint64(56)


def _following(marks: np.ndarray, after: np.uint64) -> np.ndarray:
    """For each byte the mark of the next byte; ``after`` is the word behind the last."""
    out = marks >> _BYTE
    out[:-1] |= marks[1:] << _LAST
    out[-1] |= after << _LAST
    return out


def _letters(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that is a letter from A to Z, of either case."""
    folded = words | _CASE
    seven = folded & _LOW
    return (seven + _FROM_A) & ~(seven + _PAST_Z) & ~folded & _TOP


def _continuations(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte of the form 10xxxxxx."""
    return words & ~(words << np.uint64(1)) & _TOP


def unit_ends(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marks of the bytes that end a unit, marks of those that end a code point), in the top bit of each byte."""
    units, points = np.empty_like(words), np.empty_like(words)
    for a in range(0, len(words), SPAN):
        part = words[a : a + SPAN + 1]
        letters, inner = _letters(part), _continuations(part)
        more = len(part) > SPAN
        here = slice(0, SPAN if more else len(part))
        after = (letters[-1], inner[-1]) if more else (np.uint64(0), np.uint64(0))
        in_point = _following(inner[here], after[1])
        points[a : a + SPAN] = _TOP & ~in_point
        units[a : a + SPAN] = _TOP & ~in_point & ~(letters[here] & _following(letters[here], after[0]))
    return units, points


class Marks:
    """Marked bytes with their running total: rank and select."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of marks in front of each byte."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = self.marks[np.minimum(word, len(self.marks) - 1)] & ((np.uint64(1) << (byte * _BYTE)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, number: np.ndarray) -> np.ndarray:
        """Place of the byte with each number (from 0) among the marked ones."""
        word = np.searchsorted(self.before, number, side="right") - 1
        left, marks = number - self.before[word], self.marks[word]
        for _ in range(7):
            drop = left > 0
            if not drop.any():
                break
            marks = np.where(drop, marks & (marks - np.uint64(1)), marks)
            left = left - drop
        lowest = marks & (~marks + np.uint64(1))
        return word * 8 + (np.bitwise_count(lowest - np.uint64(1)) >> 3)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(words of all texts, each with a zero byte behind it; start of each text and the end of all)."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    data = b"\0".join([*texts, b"\0" * (8 - int(starts[-1]) % 8)])
    return np.frombuffer(data, dtype="<u8", count=len(data) // 8), starts


def cuts(texts: list[bytes], one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: number of units, the two cuts as places in its bytes, and as numbers of its code points.

    ``one`` and ``two`` modulo the number of units and one more are the units in front of either cut.
    """
    words, starts = joined(texts)
    unit_marks, point_marks = (Marks(m) for m in unit_ends(words))
    first = unit_marks.rank(starts[:-1])
    n = unit_marks.rank(starts[1:]) - first - 1  # the zero byte behind it is one, too
    places = np.sort(np.stack([one % (n + 1), two % (n + 1)]), axis=0)
    at = [np.where(k > 0, unit_marks.select(first + np.maximum(k, 1) - 1) + 1, starts[:-1]) for k in places]
    points = point_marks.rank(starts[:-1])
    return n, np.stack(at) - starts[:-1], np.stack([point_marks.rank(a) - points for a in at]), starts


def rendered(text: bytes, form: str, a: int, b: int) -> bytes:
    """The output of a text that is cut at bytes ``a`` and ``b``."""
    if form == PLAIN:
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == PSM:
        return b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    return b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])


def restore(output: bytes, form: str) -> bytes:
    """The text that an output of this form was made of."""
    if form == PLAIN:
        return output
    opened, turned = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    if not output.startswith(opened):
        raise ValueError(f"an output of form {form} begins with {opened.decode()}")
    one, found_turn, rest = output[len(opened) :].partition(turned)
    two, found_middle, middle = rest.partition(MIDDLE)
    if not found_turn or not found_middle:
        raise ValueError(f"an output of form {form} holds every sentinel")
    prefix, suffix = (one, two) if form == PSM else (two, one)
    return prefix + middle + suffix


def _runs(texts: list[bytes]) -> Iterator[slice]:
    a, size = 0, 0
    for b, text in enumerate(texts):
        if b > a and size + len(text) > RUN:
            yield slice(a, b)
            a, size = b, 0
        size += len(text)
    if a < len(texts):
        yield slice(a, len(texts))


def transform_texts(texts: list[str | None], draws: np.ndarray, percent: int = 90, spm_percent: int = 20) -> list[tuple]:
    """n, form, prefix_chars, middle_chars, output and restored text of each text; ``draws`` has four rows."""
    encoded, out = [(t or "").encode() for t in texts], []
    for run in _runs(encoded):
        part, drawn = encoded[run], draws[:, run]
        n, at, points, _ = cuts(part, drawn[0], drawn[1])
        for k, text in enumerate(part):
            plain = not text or int(drawn[2, k]) % 100 >= percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE))
            form = PLAIN if plain else SPM if int(drawn[3, k]) % 100 < spm_percent else PSM
            output = rendered(text, form, int(at[0, k]), int(at[1, k]))
            chars = (None, None) if plain else (int(points[0, k]), int(points[1, k] - points[0, k]))
            out.append((int(n[k]), form, *chars, output, restore(output, form)))
    return out


def draws_of(key: Column, seed: int = 1) -> Column:
    """Four unsigned 32-bit numbers as array<bigint>."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)])


def fill_in_middle(
    df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, percent: int = 90, spm_percent: int = 20,
) -> DataFrame:
    """Add n (units), form, prefix_chars, middle_chars (code points; null if plain), output and restored.

    ``restored`` is what ``restore`` makes of the output.
    """
    drawn, source = fresh(df, "__draws", "__source")
    df = df.withColumns({drawn: draws_of(F.col(f"`{key}`"), seed), source: F.col(f"`{text}`")})
    work, schema = replace_columns(df, ADDED)
    kept = [i for i, c in enumerate(work.columns) if c not in (drawn, source)]
    schema = T.StructType([f for f in schema.fields if f.name not in (drawn, source)])
    at_draws, at_text = work.columns.index(drawn), work.columns.index(source)
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = batch.column(at_draws).flatten().to_numpy().reshape(-1, 4).T
            found = transform_texts(batch.column(at_text).to_pylist(), draws, percent, spm_percent)
            added = [pa.array([row[k] for row in found], type=kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *added], names=schema.names)

    return work.mapInArrow(run, schema)
