"""Money text in the Brazilian and the plain form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as tx

PRICE = "decimal(12,2)"
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def bare_amount(text: Column) -> Column:
    """Price text without the currency sign and outer blanks."""
    return tx.strip(F.replace(text, F.lit("R$"), F.lit("")))


def plain_number(bare: Column) -> Column:
    """The amount as plain digits with a decimal dot, NULL when it is none.

    A comma makes the comma the decimal mark and every dot a thousands mark.
    """
    dotted = F.when(bare.contains(","), F.translate(bare, ",.", ".")).otherwise(bare)
    return F.when(dotted.rlike(PLAIN_NUMBER), dotted)


def price_of(plain: Column) -> Column:
    """Price to two places, half up; NULL when too wide."""
    return plain.try_cast(PRICE)


def negative_of(plain: Column) -> Column:
    """True below zero, even where two places round it to zero."""
    return plain.startswith("-") & plain.rlike("[1-9]")


def parse_money(text: Column) -> Column:
    return price_of(plain_number(bare_amount(text)))


def money_form(text: Column) -> Column:
    """Which written form a price text has."""
    bare = tx.strip(text)
    return (
        F.when(tx.is_blank(text), vocab.NULL_FORM)
        .when(parse_money(text).isNull(), vocab.INVALID_FORM)
        .when(bare.startswith("R$"), vocab.MONEY_SYMBOL)
        .when(bare.contains(","), vocab.MONEY_COMMA)
        .otherwise(vocab.MONEY_DOT)
    )
