"""Text and date expressions used by the survey cleaners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import ColumnLike, as_col, to_number


def extract(c: ColumnLike, pattern: str, group: int = 0) -> Column:
    """Regex group, NULL (not an empty text) when the pattern does not match."""
    c = as_col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def replace_first(c: ColumnLike, pattern: str, plain: str = "") -> Column:
    """Replace only the first match of ``pattern`` by a plain text."""
    return F.regexp_replace(as_col(c), r"(?s)^(.*?)(?:" + pattern + ")", "$1" + plain)


def part(c: ColumnLike, sep: str, n: int) -> Column:
    """The n-th piece (from 1) of a text split at a regex, NULL when absent."""
    return F.try_element_at(F.split(as_col(c), sep), F.lit(n))


def word(c: ColumnLike, n: int) -> Column:
    """The n-th blank-separated word, NULL when absent."""
    return part(c, " ", n)


def genus(c: ColumnLike) -> Column:
    """First word of a taxon name."""
    return F.split(as_col(c), " ", 2).getItem(0)


def two_words(c: ColumnLike) -> Column:
    """First two words of a taxon name; one-word names are kept."""
    return F.regexp_replace(as_col(c), r"(?s)^(\S*\s+\S+).*", "$1")


def sp_suffix(c: ColumnLike) -> Column:
    """Append ``sp.`` to a name that has no second word."""
    c = as_col(c)
    return F.when(word(c, 2).isNull(), F.concat(c, F.lit(" sp."))).otherwise(c)


def between(c: ColumnLike, start: int, stop: int) -> Column:
    """Characters ``start`` to ``stop`` inclusive, counted from 1."""
    return F.substring(as_col(c), start, stop - start + 1)


def tail(c: ColumnLike, start: int) -> Column:
    """Everything from character ``start`` (counted from 1) on."""
    return F.substr(as_col(c), F.lit(start))


def from_end(c: ColumnLike, back: int, n: int = 1) -> Column:
    """``n`` characters starting ``back`` places before the last one."""
    c = as_col(c)
    return F.substring(c, F.length(c) - F.lit(back), F.lit(n))


def zero_pad2(c: ColumnLike) -> Column:
    """Put a zero before one-character codes."""
    c = as_col(c).cast("string")
    return F.when(F.length(c) == 1, F.concat(F.lit("0"), c)).otherwise(c)


def squish(c: ColumnLike) -> Column:
    """Trim and collapse every kind of blank, no-break spaces included."""
    return F.trim(F.regexp_replace(as_col(c), r"[\s\u00a0\u2007\u202f]+", " "))


def numeric_chars(c: ColumnLike) -> Column:
    """Keep digits, points and minus signs only."""
    return F.regexp_replace(as_col(c).cast("string"), r"[^0-9.\-]", "")


def clean_number(c: ColumnLike) -> Column:
    """Number out of a text with thousands commas, units or other junk."""
    text = F.regexp_replace(numeric_chars(c), r"\.{2,}", ".")
    return to_number(text)


def comma_number(c: ColumnLike) -> Column:
    """Number out of a text with thousands commas and nothing else around it."""
    return to_number(F.translate(as_col(c).cast("string"), ",", ""))


def decimal_comma(c: ColumnLike) -> Column:
    """Number out of a text with a decimal comma."""
    return to_number(F.translate(as_col(c).cast("string"), ",", "."))


def mixed_date(c: ColumnLike) -> Column:
    """Date out of a spreadsheet serial, ``m/d/yyyy``, ``m/d/yy`` or ISO text."""
    c = as_col(c).cast("string")
    # Two-digit years follow the POSIX pivot: 69-99 are 1969-1999, 00-68 are 2000-2068.
    m, d, y = (part(c, "/", i).try_cast("int") for i in (1, 2, 3))
    year = F.when(y >= 69, y + 1900).otherwise(y + 2000)
    short = F.format_string("%04d-%02d-%02d", year, m, d)
    return (
        F.when(c.rlike(r"^\d+$"), F.date_add(F.lit("1899-12-30").cast("date"), c.try_cast("int")))
        .when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, "M/d/yyyy"))
        .when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), F.try_to_date(short, "yyyy-MM-dd"))
        .when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))
    )


def leading_year(c: ColumnLike) -> Column:
    """Year out of a harvest title such as ``2017.1 peak``."""
    return F.regexp_replace(part(c, " ", 1), r"\..*", "").try_cast("int")


def two_digit_year(c: ColumnLike) -> Column:
    """Year out of a code that ends in two digits."""
    return F.right(as_col(c), F.lit(2)).try_cast("int") + F.lit(2000)
