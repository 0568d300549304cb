"""Column functions: parsing, repair and classification."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tenderlake.contracts import STATES
from tenderlake.contracts import AMOUNT
from tenderlake.functions import columns as X


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_money_with_thousands_and_without(spark):
    got = apply(spark, X.parse_brl, ["1.234,56", "10,00", "0,00", None, "-3,5"])
    assert got == [Decimal("1234.5600"), Decimal("10.0000"), Decimal(0), None, Decimal("-3.5000")]


def test_money_with_decimal_dot_is_read_as_thousands(spark):
    assert apply(spark, X.parse_brl, ["1234.56"]) == [Decimal("123456.0000")]


def test_amounts_are_not_rounded_before_they_are_judged(spark):
    assert apply(spark, X.parse_brl, ["-0,001", "1,00005"]) == [Decimal("-0.001"), Decimal("1.00005")]
    assert apply(spark, lambda c: X.is_negative(X.parse_brl(c)), ["-0,001", "0,001"]) == [True, False]
    assert apply(spark, X.parse_number, ["0.00004", "123456789012345"]) == [Decimal("0.00004"), Decimal(123456789012345)]
    with pytest.raises(PySparkException, match="number out of range: 1e30"):
        apply(spark, X.parse_number, ["1e30"])


def test_money_that_is_no_number_stops_the_job(spark):
    with pytest.raises(PySparkException, match="not a monetary value: dez"):
        apply(spark, X.parse_brl, ["dez"])


def test_dates(spark):
    got = apply(spark, X.parse_date_br, ["31/01/2024", "1/2/2024", "31/02/2024", "ontem", "2024-01-01", None])
    assert got == [date(2024, 1, 31), date(2024, 2, 1), None, None, None, None]


def test_text_is_single_spaced_and_trimmed(spark):
    got = apply(spark, X.normalize_text, ["  a  b ", "a  b", "\x85a\x1c\tb\n", "", None])
    assert got == ["a b", "a b", "a b", "", None]


def test_strip_keeps_inner_blanks(spark):
    assert apply(spark, X.strip, ["  a  b \x1f"]) == ["a  b"]


def test_state_domain(spark):
    got = apply(spark, lambda c: X.null_if_not_in(X.upper_trim(c), STATES), [" df ", "-3", "", None, "ZZ"])
    assert got == ["DF", None, None, None, None]
    flags = apply(spark, lambda c: X.outside_domain(X.upper_trim(c), STATES), [" df ", "-3", None])
    assert flags == [False, True, True]


def test_quantity_is_not_locale_parsed(spark):
    got = apply(spark, X.parse_number, ["10", "10,5", "1.234", "1e2", "1d", "1f", "NaN", "x", " 7 ", ".5", None])
    assert got == [Decimal(10), None, Decimal("1.234"), Decimal(100), None, None, None, None, Decimal(7), Decimal("0.5"), None]


def test_document_classes(spark):
    codes = ["1" * 14, "1" * 11, "ESTRANG0032850", "estrang1", "123", "-11", None]
    assert apply(spark, X.classify_doc, codes) == [
        "CNPJ", "CPF", "ESTRANGEIRO", "ESTRANGEIRO", "OUTRO", "OUTRO", "DESCONHECIDO",
    ]
    # The item side looks at the length only.
    assert apply(spark, X.classify_winner_doc, codes)[2:4] == ["CNPJ", "OUTRO"]


def test_participant_codes(spark):
    got = apply(spark, X.repair_participant_code, [" 123 ", "-11", "ESTRANG0032850", "Estrang1", "12a", "", None])
    assert got == ["123", None, "ESTRANG0032850", "Estrang1", None, None, None]


def test_flag(spark):
    assert apply(spark, lambda c: X.flag_is(c, "SIM"), ["SIM", " sim\t", "NÃO", "", None]) == [
        True, True, False, False, False,
    ]


def test_unit_price_only_for_positive_quantities(spark):
    df = spark.createDataFrame(
        [(1, "10", "4"), (2, "10", "0"), (3, "10", None), (4, None, "2"), (5, "1", "3"), (6, "10", "-2"), (7, "1", "0.00004"), (8, "1", "0.33333")],
        "i int, v string, q string",
    )
    price = X.unit_price(F.col("v").cast(AMOUNT), F.col("q").cast(AMOUNT))
    got = [r.p for r in df.select("i", price.alias("p")).orderBy("i").collect()]
    assert got == [Decimal("2.5000"), None, None, None, Decimal("0.3333"), None, Decimal("25000.0000"), Decimal("3.0000")]


def test_score_without_deviation_is_unknown(spark):
    df = spark.createDataFrame([(10.0, 4.0, 2.0), (10.0, 10.0, 0.0)], "x double, m double, s double")
    got = [r.z for r in df.select(X.zscore(F.col("x"), F.col("m"), F.col("s")).alias("z")).collect()]
    assert got == [Decimal("3.00"), None]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 3, 9),)], "data date")
    row = X.calendar_attributes(df, "data").first()
    assert (row.ano, row.mes, row.trimestre, row.nome_mes) == (2024, 3, 1, "Março")


def test_negatives_go_and_unknown_amounts_stay(spark, rows):
    df = spark.createDataFrame([(1, -1.0), (2, None), (3, 0.0), (4, 2.0)], "i int, v double")
    assert rows(X.drop_negative(df, "v"), "i") == [(2,), (3,), (4,)]


def test_period_tokens(spark):
    assert apply(spark, lambda c: X.parse_period(c, "compact"), ["20240131", "2024-01-31", "20240231"]) == [
        date(2024, 1, 31), None, None,
    ]
    assert apply(spark, lambda c: X.parse_period(c, "slashed"), ["31/01/2024"]) == [date(2024, 1, 31)]
    with pytest.raises(ValueError):
        X.parse_period(F.lit(""), "other")


def test_column_names_with_any_character(spark):
    df = spark.createDataFrame([(1, 2)], ["Valor Empenho (R$)", "a.b`c"])
    assert tuple(df.select(X.named("Valor Empenho (R$)"), X.named("a.b`c")).first()) == (1, 2)
