"""Column expressions: text repair, parsing, classification, calendar and price arithmetic.

All of them are built-in expressions, so they stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.contracts import AMOUNT, MONEY, MONTH_NAMES, NULL_TOKENS

# \s alone misses the four ASCII separators that Unicode-aware trimming removes.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"
#: The same blanks one by one, for trimming without a pattern.
_EDGE_BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def named(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_tokens(c: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def normalize_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_EDGE_BLANKS))


def upper_trim(c: Column) -> Column:
    return F.upper(strip(c))


def null_if_not_in(c: Column, domain: Iterable[str]) -> Column:
    return F.when(c.isin(*domain), c)


def outside_domain(c: Column, domain: Iterable[str]) -> Column:
    """True for a value outside ``domain`` and for a missing value."""
    return ~F.coalesce(c.isin(*domain), F.lit(False))


def parse_brl(c: Column, to: T.DecimalType = AMOUNT) -> Column:
    """``1.234,56`` to a decimal. Text that is no number stops the job, as it has no safe reading.

    All places that are written are kept; rounding is left to the load.
    """
    plain = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    parsed = plain.try_cast(to)
    broken = c.isNotNull() & parsed.isNull()
    return F.when(
        broken, F.raise_error(F.concat(F.lit("not a monetary value: "), c)).cast(to)
    ).otherwise(parsed)


def parse_date_br(c: Column) -> Column:
    return F.try_to_date(c, "d/M/yyyy")


def parse_number(c: Column, to: T.DecimalType = AMOUNT) -> Column:
    """A plain number to a decimal; other text is missing. A number too large to hold stops the job."""
    text = F.trim(c)
    parsed = text.try_cast(to)
    too_large = F.raise_error(F.concat(F.lit("number out of range: "), c)).cast(to)
    return F.when(text.rlike(_NUMBER), F.when(parsed.isNull(), too_large).otherwise(parsed))


def parse_period(c: Column, layout: str) -> Column:
    """Period token of a page dump: ``compact`` is ``AAAAMMDD``, ``slashed`` is ``DD/MM/AAAA``."""
    if layout == "compact":
        return F.when(c.rlike("^[0-9]{8}$"), F.try_to_date(c, "yyyyMMdd"))
    if layout == "slashed":
        return parse_date_br(c)
    raise ValueError(f"unknown period layout: {layout}")


def is_negative(c: Column) -> Column:
    """Null counts as not negative, so unknown amounts survive a filter on this."""
    return F.coalesce(c < 0, F.lit(False))


def drop_negative(df: DataFrame, name: str) -> DataFrame:
    return df.filter(~is_negative(named(name)))


def not_null(df: DataFrame, *names: str) -> DataFrame:
    return df.dropna(subset=list(names))


def is_numeric_code(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?U)\A\d+\z"), F.lit(False))


def is_foreign_code(c: Column) -> Column:
    return F.coalesce(F.upper(c).startswith("ESTRANG"), F.lit(False))


def repair_participant_code(c: Column) -> Column:
    code = strip(c)
    return F.when(is_numeric_code(code) | is_foreign_code(code), code)


def classify_winner_doc(c: Column) -> Column:
    return (
        F.when(c.isNull(), "DESCONHECIDO")
        .when(F.length(c) == 14, "CNPJ")
        .when(F.length(c) == 11, "CPF")
        .otherwise("OUTRO")
    )


def classify_doc(c: Column) -> Column:
    return F.when(is_foreign_code(c), "ESTRANGEIRO").otherwise(classify_winner_doc(c))


def flag_is(c: Column, word: str) -> Column:
    return F.coalesce(upper_trim(c) == word, F.lit(False))


def missing_code(code: Column, ordinal: Column) -> Column:
    return F.coalesce(code, F.concat(F.lit("SEM_CODIGO_"), ordinal.cast("string")))


def fill_missing_code(df: DataFrame, code: str, ordinal: str, marker: str) -> DataFrame:
    """Give rows without a code one made of their ordinal, and mark them."""
    return df.withColumns(
        {marker: named(code).isNull(), code: missing_code(named(code), named(ordinal))}
    )


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), month.cast("int"))


def calendar_attributes(df: DataFrame, name: str) -> DataFrame:
    day = named(name).cast("date")
    return df.withColumns(
        {
            name: day,
            "ano": F.year(day).cast("short"),
            "mes": F.month(day).cast("short"),
            "trimestre": F.quarter(day).cast("short"),
            "nome_mes": month_name(F.month(day)),
        }
    )


def unit_price(value: Column, quantity: Column) -> Column:
    """Value per unit, rounded once, to the places of the load.

    Amounts of at most the load's places divide exactly; more places than that are left to
    floating point, as a decimal quotient of such operands keeps six places only.
    """
    v, q = value.try_cast(MONEY), quantity.try_cast(MONEY)
    exact = F.when(quantity > 0, v / F.nullif(q, F.lit(0).cast(MONEY))).cast(MONEY)
    near = F.when(quantity > 0, value.cast("double") / quantity.cast("double")).cast("string").cast(MONEY)
    return F.when((v == value) & (q == quantity), exact).otherwise(near)


def zscore(x: Column, mean: Column, deviation: Column) -> Column:
    distance = x.cast("double") - mean.cast("double")
    score = distance / F.nullif(deviation.cast("double"), F.lit(0.0))
    return F.round(score.cast("decimal(18,6)"), 2).cast("decimal(18,2)")


def project_star(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the columns named by ``mapping`` (source to target), in its order."""
    return df.select(*[named(source).alias(target) for source, target in mapping.items()])
