"""Text normalisation as JVM column expressions."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from balcao import vocab

WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())

def strip(text: Column) -> Column:
    """Drop leading and trailing blanks of any kind, not only spaces.

    Trimming a set of characters costs a microsecond a value, so text that
    starts and ends in a visible ASCII character skips it.
    """
    ends = [F.substring(text, 1, 1), F.substring(text, -1, 1)]
    settled = ends[0].between("!", "~") & ends[1].between("!", "~")
    return F.when(settled, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


@functools.cache
def _accent_tables() -> tuple[str, str]:
    """(characters to change, their bases); characters past the bases are dropped.

    Covers every character whose canonical decomposition keeps one base once
    the nonspacing marks are gone, and the marks themselves.
    """
    chars, bases, marks = [], [], []
    for char in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        base = "".join(
            c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"
        )
        if len(base) == 1 and base != char:
            chars.append(char)
            bases.append(base)
    return "".join(chars + marks), "".join(bases)


def strip_accents(text: Column) -> Column:
    """Canonical decomposition with the combining marks dropped.

    One ``translate`` in generated code; text of single-byte characters passes
    through. Characters that decompose into several bases (Hangul syllables and
    some Indic vowel signs, which carry no accent) stay composed.
    """
    chars, bases = _accent_tables()
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(F.translate(text, chars, bases))


def sentence_case(text: Column) -> Column:
    """First letter up, all others down (not word by word)."""
    return F.concat(F.initcap(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2**31 - 1)))


def category_of(bare: Column) -> Column:
    """Category from stripped text without accents."""
    return F.when(bare != "", sentence_case(bare))


def status_of(bare: Column) -> Column:
    """Status from stripped text without accents; NULL outside the domain."""
    status = sentence_case(bare)
    return F.when(status.isin(vocab.STATUSES), status)


def normalize_category(text: Column) -> Column:
    return category_of(strip_accents(strip(text)))


def normalize_status(text: Column) -> Column:
    return status_of(strip_accents(strip(text)))


def location_parts(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "/")


def location_of(parts: Column) -> Column:
    """City, state and country from the parts of a location text."""
    city, state, country = (strip(F.get(parts, F.lit(i))) for i in range(3))
    whole = (F.size(parts) == 3) & (city != "") & (state != "") & (country != "")

    def place(*values: Column) -> Column:
        return F.struct(*[v.alias(n) for v, n in zip(values, ("city", "state", "country"))])

    return F.when(whole, place(city, state, country)).otherwise(
        place(*map(F.lit, vocab.UNKNOWN_LOCATION))
    )


def parse_location(text: Column) -> Column:
    """``City/State/Country`` as a struct; anything else is the unknown place."""
    return location_of(location_parts(text))


def quantity_of(bare: Column) -> Column:
    """A whole number with optional sign; ``3.0`` is not one."""
    return F.when(bare.rlike(r"^[+-]?\d+$"), bare.try_cast("int"))


def parse_quantity(text: Column) -> Column:
    return quantity_of(strip(text))
