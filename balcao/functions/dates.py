"""Dates in three written forms, and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as tx

_YEAR = r"((?!0000)\d{4})"
_MONTH = r"(1[0-2]|0?[1-9])"
# A blank may stand in for the zero of a one-digit day.
_DAY = r"(3[01]|[12]\d|0[1-9]| ?[1-9])"
ISO_TEXT = rf"^{_YEAR}-{_MONTH}-{_DAY}$"
SLASH_TEXT = rf"^{_DAY}/{_MONTH}/{_YEAR}$"
DASH_TEXT = rf"^{_DAY}-{_MONTH}-{_YEAR}$"


def date_of(bare: Column) -> Column:
    """Date from stripped text; see ``parse_date``.

    Every form is rewritten to ISO text and cast once, which stays in generated
    code and rejects days such as 31 February.
    """
    iso = (
        F.when(bare.rlike(ISO_TEXT), bare)
        .when(bare.rlike(SLASH_TEXT), F.regexp_replace(bare, SLASH_TEXT, "$3-$2-$1"))
        .when(bare.rlike(DASH_TEXT), F.regexp_replace(bare, DASH_TEXT, "$3-$2-$1"))
    )
    return F.translate(iso, " ", "").try_cast("date")


def parse_date(text: Column) -> Column:
    """ISO, d/m/y or d-m-y naming a day that exists; NULL otherwise."""
    return date_of(tx.strip(text))


def date_form(text: Column) -> Column:
    """Which written form a date text has."""
    bare = tx.strip(text)
    return (
        F.when(tx.is_blank(text), vocab.NULL_FORM)
        .when(parse_date(text).isNull(), vocab.INVALID_FORM)
        .when(bare.rlike(r"^\d{4}.*-"), vocab.DATE_ISO)
        .when(bare.contains("/"), vocab.DATE_SLASH)
        .otherwise(vocab.DATE_DASH)
    )


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "MM")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two dates."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
