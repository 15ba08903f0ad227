"""Parsing and normalisation of single values."""

import datetime as dt
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from balcao.functions import dates, money
from balcao.functions import text as tx

SPACES = "  "


def evaluate(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


MONEY = {
    "R$ 1.234,56": "1234.56", "1.234,56": "1234.56", "1234.56": "1234.56", "222,79": "222.79",
    "R$ 89,90": "89.90", "R$ 12.345.678,90": "12345678.90", " R$\t5 ": "5.00", "R$ -5,00": "-5.00",
    "0.125": "0.13", ".5": "0.50", "7.": "7.00", "R$ ???": None, "gratis": None, "1,2,3": None, "": None,
    None: None, "nan": None, "inf": None, "1e3": None, "1_000": None, "99999999999.00": None,
}


def test_money(spark):
    got = evaluate(spark, money.parse_money, MONEY)
    assert got == [None if v is None else Decimal(v) for v in MONEY.values()]


def test_negative_price_below_a_cent(spark):
    assert evaluate(spark, lambda c: money.negative_of(money.plain_number(money.bare_amount(c))),
                    ["-0.001", "-0", "0.001", "R$ -1,00"]) == [True, False, False, True]


DATES = {
    "2025-03-07": dt.date(2025, 3, 7), "07/03/2025": dt.date(2025, 3, 7), "07-03-2025": dt.date(2025, 3, 7),
    " 7/3/2025 ": dt.date(2025, 3, 7), "2024-02-29": dt.date(2024, 2, 29), "2025-3- 7": dt.date(2025, 3, 7),
    "31/02/2025": None, "2025-13-07": None, "00/00/0000": None, "0000-01-01": None, "sem data": None,
    "29/02/2025": None, "2025-03-07 10:00": None, "2025-03- 7": dt.date(2025, 3, 7), "2025-03- 07": None,
    "2025-03- 31": None, "31/ 3/2025": None, "07/03/25": None, "": None, None: None,
}


def test_dates(spark):
    assert evaluate(spark, dates.parse_date, DATES) == list(DATES.values())


def test_forms(spark):
    values = ["2025-03-07", "07/03/2025", "07-03-2025", "31/02/2025", "  ", None]
    assert evaluate(spark, dates.date_form, values) == [
        "iso (aaaa-mm-dd)", "dd/mm/aaaa", "dd-mm-aaaa", "invalido", "nulo", "nulo"]
    values = ["R$ 1.234,56", " 1.234,56", "1234.56", "gratis", "", None]
    assert evaluate(spark, money.money_form, values) == [
        "R$ 1.234,56", "1.234,56", "1234.56", "invalido", "nulo", "nulo"]


def test_categories(spark):
    values = ["ELETRONICOS", "eletronicos", "Eletrônicos", "  Eletrônicos ", "éxito", "casa e jardim", "", " ", None]
    assert evaluate(spark, tx.normalize_category, values) == [
        "Eletronicos", "Eletronicos", "Eletronicos", "Eletronicos", "Exito", "Casa e jardim", None, None, None]


def test_statuses(spark):
    values = ["ENTREGUE", " entregue ", "Devolvido", "Em analise", "Extraviado", "", None]
    assert evaluate(spark, tx.normalize_status, values) == ["Entregue", "Entregue", "Devolvido", None, None, None, None]


def test_strip_matches_unicode_blanks(spark):
    values = ["a", " a ", f"{SPACES}a b{SPACES}\n", "\tÁgua", "", " ", "é ", "x\x1f"]
    assert evaluate(spark, tx.strip, values) == [v.strip() for v in values]


def test_strip_accents_over_the_latin_and_greek_ranges(spark):
    values = [chr(c) for c in [*range(0x20, 0x900), *range(0x1E00, 0x2000)] if chr(c).isprintable()]
    want = ["".join(c for c in unicodedata.normalize("NFD", v) if unicodedata.category(c) != "Mn") for v in values]
    assert evaluate(spark, tx.strip_accents, values) == want


def test_locations(spark):
    unknown = ("Desconhecida", "ND", "Brasil")
    values = ["Rio/RJ/Brasil", " Rio / RJ / Brasil ", "Rio/RJ", "a/b/c/d", "a//c", " / / ", "", None]
    got = evaluate(spark, tx.parse_location, values)
    assert [tuple(p) for p in got] == [("Rio", "RJ", "Brasil")] * 2 + [unknown] * 6


@pytest.mark.parametrize(
    "value, want", [("3", 3), (" 3 ", 3), ("+3", 3), ("-2", -2), ("3.0", None), ("x", None), ("", None),
                    (None, None), ("2147483648", None)])
def test_quantity(spark, value, want):
    assert evaluate(spark, tx.parse_quantity, [value]) == [want]
