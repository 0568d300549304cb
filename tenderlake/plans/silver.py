"""Cleaning of the four source tables, with every quality count kept in the data.

A cleaner returns *marked* rows: one per distinct cleaned content, carrying how many
source rows stand behind it and how many cells of those rows each repair touched. The
accepted rows and the quality report are both read off the marked rows, so counting needs
no second cleaning, and a task that runs twice after an executor loss cannot count twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.functions import columns as X
from tenderlake.functions.columns import named
from tenderlake.operators.keys import split_repeated
from tenderlake.plans.versions import set_path
from tenderlake.session import PACKED, fine_splits

COPIES, STATE = "_linhas", "situacao_linha"
ACCEPTED, NEGATIVE = "aceita", "valor_negativo"
_TOUCHED = "_tocadas_"

# Repairs counted on source rows, and the report they go into.
REPAIRS = (
    "uf_invalida_corrigida", "participante_invalido_corrigido", "participante_estrangeiro",
    "datas_invalidas",
)
REPORT = (
    "linhas_entrada", "linhas_saida", "duplicados_removidos", "valores_negativos_removidos",
    "uf_invalida_corrigida", "codigo_item_gerado", "participante_invalido_corrigido",
    "participante_estrangeiro", "datas_invalidas",
)
QUALITY = "relatorio_qualidade"
# Columns that tell rows apart, of which cleaning touches none but participants' codes.
TELLING = (C.YEAR_PART, C.MONTH_PART, *C.TENDER_KEY, "Código Item Compra", "Código Participante", "Código Empenho")
_QUALITY_SCHEMA = ", ".join(["dataset string", *[f"{c} long" for c in REPORT]])


def _bad_date(raw: Column) -> Column:
    return (raw.isNotNull() & X.parse_date_br(raw).isNull()).cast("int")


def _texts(*names: str) -> dict[str, Column]:
    return {name: X.normalize_text(named(name)) for name in names}


def _touched(**repairs: Column) -> dict[str, Column]:
    return {_TOUCHED + name: c.cast("int") for name, c in repairs.items()}


def _collapse(
    df: DataFrame, cleaning: dict[str, Column], money: str | None = None, without: Sequence[str] = ()
) -> DataFrame:
    """Clean rows, merge equal ones and add the state, the row count and the repair counts.

    Equal rows agree in the ``TELLING`` columns. A row that agrees with no other in these stays where it lies; only the
    others are shuffled to be compared whole.
    """
    split = split_repeated(df, [cleaning.get(c, named(c)) for c in TELLING if c in df.columns])
    apart, near = (raw.withColumns(cleaning).drop(*without) for raw in split)
    touched = [_TOUCHED + r for r in REPAIRS]
    content = [named(c) for c in apart.columns if c != C.ROW_ORD and c not in touched]
    counted = [c for c in touched if c in cleaning]
    state = F.lit(ACCEPTED)
    if money:
        state = F.when(X.is_negative(named(money)), NEGATIVE).otherwise(ACCEPTED)
    absent = {c: F.lit(0).cast("long") for c in touched if c not in cleaning}
    single = apart.select(
        *content, C.ROW_ORD, F.lit(1).cast("long").alias(COPIES), *[F.col(c).cast("long").alias(c) for c in counted]
    )
    merged = near.groupBy(*content).agg(
        F.min(C.ROW_ORD).alias(C.ROW_ORD), F.count(F.lit(1)).alias(COPIES), *[F.sum(c).alias(c) for c in counted]
    )
    return single.unionByName(merged).withColumns({STATE: state, **absent})


def mark_tenders(df: DataFrame) -> DataFrame:
    state_code = X.upper_trim(named("UF"))
    opened, decided = named("Data Abertura"), named("Data Resultado Compra")
    cleaning = (
        _texts(*C.TENDER_TEXT)
        | {
            "UF": X.null_if_not_in(state_code, C.STATES),
            "Valor Licitação": X.parse_brl(named("Valor Licitação")),
            "Data Resultado Compra": X.parse_date_br(decided),
            "Data Abertura": X.parse_date_br(opened),
        }
        | _touched(
            uf_invalida_corrigida=X.outside_domain(state_code, C.STATES),
            datas_invalidas=_bad_date(opened) + _bad_date(decided),
        )
    )
    return _collapse(df, cleaning, "Valor Licitação")


def mark_items(df: DataFrame) -> DataFrame:
    winner = X.strip(named("Código Vencedor"))
    cleaning = _texts("Descrição", "Nome Vencedor") | {
        "Valor Item": X.parse_brl(named("Valor Item")),
        "Quantidade Item": X.parse_number(named("Quantidade Item")),
        "Código Vencedor": winner,
    }
    # What follows from other columns is added after equal rows have met.
    marked = _collapse(df, cleaning, "Valor Item").withColumn(
        "tipo_documento_vencedor", X.classify_winner_doc(named("Código Vencedor"))
    )
    return X.fill_missing_code(marked, "Código Item Compra", C.ROW_ORD, "codigo_item_gerado")


def mark_bids(df: DataFrame) -> DataFrame:
    code = X.strip(named("Código Participante"))
    foreign = X.is_foreign_code(code)
    cleaning = (
        _texts("Nome Participante")
        | {
            "Código Participante": X.repair_participant_code(code),
            "flag_vencedor": X.flag_is(named("Flag Vencedor"), "SIM"),
        }
        | _touched(
            participante_invalido_corrigido=~(X.is_numeric_code(code) | foreign),
            participante_estrangeiro=foreign,
        )
    )
    return _collapse(df, cleaning, without=["Flag Vencedor"])


def mark_commitments(df: DataFrame) -> DataFrame:
    issued = named("Data Emissão Empenho")
    cleaning = {
        "Valor Empenho (R$)": X.parse_brl(named("Valor Empenho (R$)")),
        "Data Emissão Empenho": X.parse_date_br(issued),
    } | _touched(datas_invalidas=_bad_date(issued))
    return _collapse(df, cleaning)


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    C.TENDERS: mark_tenders,
    C.ITEMS: mark_items,
    C.BIDS: mark_bids,
    C.COMMITMENTS: mark_commitments,
}


def accepted(marked: DataFrame) -> DataFrame:
    """The clean table: accepted rows without the counting columns."""
    technical = [c for c in marked.columns if c.startswith(_TOUCHED)] + [COPIES, STATE]
    return marked.filter(F.col(STATE) == ACCEPTED).drop(*technical)


def quality_of(marked: DataFrame, dataset: str) -> DataFrame:
    """The quality-report row of one dataset."""
    kept = F.col(STATE) == ACCEPTED
    generated = F.lit(False)
    if "codigo_item_gerado" in marked.columns:
        generated = kept & F.col("codigo_item_gerado")

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("long")

    measures = {
        "linhas_entrada": total(F.col(COPIES)),
        "linhas_saida": F.count_if(kept),
        "duplicados_removidos": total(F.when(kept, F.col(COPIES) - 1)),
        "valores_negativos_removidos": total(F.when(~kept, F.col(COPIES))),
        "codigo_item_gerado": F.count_if(generated),
    } | {r: total(F.col(_TOUCHED + r)) for r in REPAIRS}
    return marked.agg(*[measures[name].alias(name) for name in REPORT]).select(
        F.lit(dataset).alias("dataset"), *REPORT
    )


def quality_report(marked: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [quality_of(df, name) for name, df in marked.items()])


def _cleaner(mark: Callable[[DataFrame], DataFrame], dataset: str):
    def clean(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = mark(df)
        return accepted(marked), quality_of(marked, dataset)

    clean.__doc__ = f"Clean rows of ``{dataset}`` and their quality-report row."
    return clean


clean_tenders = _cleaner(mark_tenders, C.TENDERS)
clean_items = _cleaner(mark_items, C.ITEMS)
clean_participants = _cleaner(mark_bids, C.BIDS)
clean_commitments = _cleaner(mark_commitments, C.COMMITMENTS)


def domain_samples(df: DataFrame, name: str, domain, limit: int = 5) -> DataFrame:
    """Up to ``limit`` of the texts that fall outside a domain, for the operator's eye."""
    code = X.upper_trim(named(name))
    outside = df.filter(X.outside_domain(code, domain)).select(code.alias(name)).distinct()
    return outside.orderBy(F.col(f"`{name}`").asc_nulls_first()).limit(limit)


def write_silver(marked: DataFrame, folder: str, name: str) -> None:
    """Write one silver table to the folder of a set; rejected rows stay in it, flagged, for the report."""
    with fine_splits(marked.sparkSession):
        marked.write.options(**PACKED).parquet(f"{folder}/{name}")


def write_quality(report: DataFrame, folder: str) -> None:
    report.coalesce(1).write.json(f"{folder}/{QUALITY}")


def read_marked(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The three clean tables of the current set, which the star is built from; a missing one is an error."""
    return {name: accepted(spark.read.parquet(set_path(spark, root, name))) for name in (C.TENDERS, C.ITEMS, C.BIDS)}


def read_quality(spark: SparkSession, root: str) -> DataFrame:
    """The quality report of the current set."""
    return spark.read.schema(_QUALITY_SCHEMA).json(set_path(spark, root, QUALITY))
