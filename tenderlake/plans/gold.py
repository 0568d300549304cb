"""The star: five dimensions and two facts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.functions import columns as X
from tenderlake.functions.columns import named
from tenderlake.operators.aggregates import attribute_drift
from tenderlake.operators.joins import (
    BROADCAST_BYTES,
    ROWS_PER_TASK,
    hot_keys,
    lookup,
    lookup_key,
    measured_bytes,
    orphan_count,
)
from tenderlake.operators.keys import (
    assign_dense_key,
    distinct_values,
    first_by_key,
    union_ranked,
)
from tenderlake.session import side_by_side, staged

# Source columns and the star columns they become.
_UNIT = {
    "Código UG": "codigo_ug",
    "Nome UG": "nome_ug",
    "Código Órgão": "codigo_orgao",
    "Nome Órgão": "nome_orgao",
    "Código Órgão Superior": "codigo_orgao_superior",
    "Nome Órgão Superior": "nome_orgao_superior",
    "UF": "uf",
    "Município": "municipio",
}
_TENDER = {
    "Número Licitação": "numero_licitacao",
    "Código UG": "codigo_ug",
    "Código Modalidade Compra": "codigo_modalidade_compra",
    "Número Processo": "numero_processo",
    "Modalidade Compra": "modalidade_compra",
    "Situação Licitação": "situacao_licitacao",
    "Objeto": "objeto",
    "Valor Licitação": "valor_licitacao",
}
_TENDER_KEY = tuple(zip(C.TENDER_KEY, ("numero_licitacao", "codigo_ug", "codigo_modalidade_compra")))


@dataclass(frozen=True)
class Star:
    dim_tempo: DataFrame
    dim_orgao: DataFrame
    dim_fornecedor: DataFrame
    dim_produto: DataFrame
    dim_licitacao: DataFrame
    fato_item_licitacao: DataFrame
    fato_participacao: DataFrame
    #: Number of won items without a tender, which are not in the star.
    itens_sem_licitacao: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {t.name: getattr(self, t.name) for t in C.WAREHOUSE}


def _kept_first(
    df: DataFrame, mapping: dict[str, str], keys: list[str], repetitive: bool
) -> DataFrame:
    """First row per key under its star names, with the ordinal it was chosen by."""
    rows = X.project_star(df, mapping | {C.ROW_ORD: "_primeiro"})
    return first_by_key(rows, keys, "_primeiro", repetitive)


def date_rows(tenders: DataFrame) -> DataFrame:
    days = distinct_values(tenders.dropna(subset=["Data Resultado Compra"]), "Data Resultado Compra")
    return X.calendar_attributes(days.withColumnRenamed("Data Resultado Compra", "data"), "data")


def unit_rows(tenders: DataFrame) -> DataFrame:
    return _kept_first(tenders, _UNIT, ["codigo_ug"], repetitive=True)


def supplier_rows(items: DataFrame, participants: DataFrame) -> DataFrame:
    """First appearance of each supplier; winners come before all participants."""
    winners = items.select(
        named("Código Vencedor").alias("codigo_fornecedor"),
        named("Nome Vencedor").alias("nome_fornecedor"),
        named("tipo_documento_vencedor").alias("tipo_documento"),
        C.ROW_ORD,
    )
    bidders = participants.select(
        named("Código Participante").alias("codigo_fornecedor"),
        named("Nome Participante").alias("nome_fornecedor"),
        X.classify_doc(named("Código Participante")).alias("tipo_documento"),
        C.ROW_ORD,
    )
    both = union_ranked([winners, bidders]).dropna(subset=["codigo_fornecedor"])
    same = {c: c for c in ("codigo_fornecedor", "nome_fornecedor", "tipo_documento")}
    return _kept_first(both, same, ["codigo_fornecedor"], repetitive=True)


def product_rows(items: DataFrame, participants: DataFrame) -> DataFrame:
    """Distinct descriptions of both sides; a missing description is a product of its own."""
    sold = items.select(named("Descrição").alias("descricao_item"), C.ROW_ORD)
    sought = participants.select(named("Descrição Item Compra").alias("descricao_item"), C.ROW_ORD)
    both = union_ranked([sold, sought])
    return both.groupBy("descricao_item").agg(F.min(C.ROW_ORD).alias("_primeiro"))


def tender_rows(tenders: DataFrame) -> DataFrame:
    return _kept_first(tenders, _TENDER, list(_TENDER.values())[:3], repetitive=False)


def _numbered(rows: DataFrame, sk: str, table: C.Table) -> DataFrame:
    return assign_dense_key(rows, sk, order=["_primeiro"]).select(*table.names)


def build_dim_date(tenders: DataFrame) -> DataFrame:
    return assign_dense_key(date_rows(tenders), "sk_tempo", order=["data"]).select(
        *C.DIM_TEMPO.names
    )


def build_dim_unit(tenders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The buying units, and those that appear under more than one name."""
    dim = _numbered(unit_rows(tenders), "sk_orgao", C.DIM_ORGAO)
    return dim, attribute_drift(tenders, "Código UG", "Nome UG", "nomes_distintos")


def build_dim_supplier(items: DataFrame, participants: DataFrame) -> DataFrame:
    return _numbered(supplier_rows(items, participants), "sk_fornecedor", C.DIM_FORNECEDOR)


def build_dim_product(items: DataFrame, participants: DataFrame) -> DataFrame:
    return _numbered(product_rows(items, participants), "sk_produto", C.DIM_PRODUTO)


def build_dim_tender(tenders: DataFrame) -> DataFrame:
    return _numbered(tender_rows(tenders), "sk_licitacao", C.DIM_LICITACAO)


def tender_context(
    tenders: DataFrame, dim_tempo: DataFrame, dim_orgao: DataFrame, dim_licitacao: DataFrame, date_key: int = 2
) -> DataFrame:
    """Date and unit keys per tender, resolved here once instead of once per item, and under ``_numeros`` its keys.

    The last part of a tender's key need not be part of the context's, so the tenders of a context are a list, at
    most one entry per purchase mode; items meet date, unit and tender in one join.
    """
    keys = [named(k) for k in C.TENDER_KEY[:date_key]]
    said = tenders.select(*keys, named("Data Resultado Compra").alias("_data"), C.ROW_ORD, F.lit(1).alias("_dita"))
    number = F.struct(F.col("codigo_modalidade_compra").alias("modalidade"), F.col("sk_licitacao").alias("sk")).alias("_numero")
    known = dim_licitacao.select(*[named(b).alias(a) for a, b in _TENDER_KEY[:date_key]], number)
    met = said.unionByName(known, allowMissingColumns=True).groupBy(*keys).agg(
        F.min_by("_data", C.ROW_ORD).alias("_data"), F.collect_list("_numero").alias("_numeros"), F.count("_dita").alias("_ditas")
    )
    first = met.filter("_ditas > 0").drop("_ditas")
    dated = lookup_key(first, dim_tempo, [("_data", "data")], "sk_tempo")
    return lookup_key(
        dated, dim_orgao, [("Código UG", "codigo_ug")], "sk_orgao", null_safe=True
    ).drop("_data")


def staged_context(tenders: DataFrame, dims: dict[str, DataFrame], date_key: int = 2) -> DataFrame:
    return staged(tender_context(tenders, dims["dim_tempo"], dims["dim_orgao"], dims["dim_licitacao"], date_key))


def _spreader(source: DataFrame, rows_per_task: int, broadcast_bytes: int):
    """Spread arguments for a lookup; keys are counted on the source, not on join results."""

    def spread(keys: Sequence[str]) -> dict:
        hot = hot_keys(source, keys, rows_per_task)
        return {"spread_by": C.ROW_ORD, "hot": hot, "broadcast_bytes": broadcast_bytes}

    return spread


def build_fact_item(
    items: DataFrame,
    tenders: DataFrame,
    dims: dict[str, DataFrame],
    date_key: int = 2,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
    keep: Sequence[str] = (),
    context: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Won items with their five keys, and the number of items without a tender.

    The date follows the first tender of (number, unit), as in the published star;
    ``date_key=3`` uses the full tender key instead. ``keep`` names columns of the items to carry along; ``context`` is
    the tenders' written context, where it is known from other items.
    """
    if context is None:
        context = staged_context(tenders, dims, date_key)
    context_key = list(C.TENDER_KEY[:date_key])
    slim = items.select(
        *[named(k) for k in C.TENDER_KEY],
        named("Código Vencedor"),
        named("Descrição"),
        named("Quantidade Item").alias("quantidade_item"),
        named("Valor Item").alias("valor_item"),
        C.ROW_ORD,
        *keep,
    )
    spread = _spreader(slim, rows_per_task, broadcast_bytes)
    # The long text goes first: once it is a key, no later shuffle carries it.
    fact = lookup_key(
        slim, dims["dim_produto"], [("Descrição", "descricao_item")], "sk_produto",
        null_safe=True, **spread(["Descrição"]),
    )
    fact = lookup_key(
        fact, dims["dim_fornecedor"], [("Código Vencedor", "codigo_fornecedor")],
        "sk_fornecedor", **spread(["Código Vencedor"]),
    )
    listed = dims["dim_licitacao"].select("codigo_modalidade_compra", "sk_licitacao")
    fact = lookup(
        fact, context, [(k, k) for k in context_key], ["sk_tempo", "sk_orgao", "_numeros"], "inner", null_safe=True,
        dim_bytes=measured_bytes(context.drop("_numeros")) + measured_bytes(listed), **spread(context_key),
    )
    mode = named(C.TENDER_KEY[2])
    mine = F.transform(F.filter("_numeros", lambda n: n["modalidade"].eqNullSafe(mode)), lambda n: n["sk"])
    fact = fact.withColumn("sk_licitacao", F.explode_outer(mine)).drop("_numeros")
    price = X.unit_price(F.col("valor_item"), F.col("quantidade_item"))
    named_fact = fact.withColumn("valor_unitario_item", price).select(
        C.ROW_ORD, *[c for c in C.FATO_ITEM.names if c != "sk_fato_item"], *keep
    )
    return named_fact, orphan_count(slim, context, context_key, null_safe=True)


def build_fact_bid(
    participants: DataFrame,
    dims: dict[str, DataFrame],
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bids with tender, product and supplier keys; unresolved keys stay null. ``keep`` names columns to carry along."""
    slim = participants.select(
        *[named(k) for k in C.TENDER_KEY],
        named("Código Participante"),
        named("Descrição Item Compra"),
        "flag_vencedor",
        C.ROW_ORD,
        *keep,
    )
    spread = _spreader(slim, rows_per_task, broadcast_bytes)
    fact = lookup_key(
        slim, dims["dim_produto"], [("Descrição Item Compra", "descricao_item")], "sk_produto",
        null_safe=True, **spread(["Descrição Item Compra"]),
    )
    fact = lookup_key(
        fact, dims["dim_fornecedor"], [("Código Participante", "codigo_fornecedor")],
        "sk_fornecedor", **spread(["Código Participante"]),
    )
    fact = lookup_key(
        fact, dims["dim_licitacao"], list(_TENDER_KEY), "sk_licitacao",
        null_safe=True, **spread(C.TENDER_KEY),
    )
    return fact.select(C.ROW_ORD, "sk_licitacao", "sk_produto", "sk_fornecedor", "flag_vencedor", *keep)


def build_dimensions(
    tenders: DataFrame, items: DataFrame, participants: DataFrame
) -> dict[str, DataFrame]:
    """The five dimensions, written, so that fact lookups know their sizes."""
    builders = {
        "dim_tempo": lambda: build_dim_date(tenders),
        "dim_orgao": lambda: build_dim_unit(tenders)[0],
        "dim_fornecedor": lambda: build_dim_supplier(items, participants),
        "dim_produto": lambda: build_dim_product(items, participants),
        "dim_licitacao": lambda: build_dim_tender(tenders),
    }
    return side_by_side(
        tenders.sparkSession, {name: lambda b=b: staged(b()) for name, b in builders.items()}
    )


def price_apart(fact: DataFrame, number: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``number`` a fact without its unit price, which two of its columns give: it is neither shuffled nor staged with them."""
    price = "valor_unitario_item"
    if price not in fact.columns:
        return number(fact)
    return number(fact.drop(price)).withColumn(price, X.unit_price(F.col("valor_item"), F.col("quantidade_item")))


def number_fact(fact: DataFrame, table: C.Table, ordered: bool = False) -> DataFrame:
    """Dense load key of a fact.

    Rows are numbered as they are loaded, which takes no shuffle and evaluates the fact
    once. ``ordered=True`` numbers them in source order, at the price of a range shuffle.
    """
    key = table.primary_key[0]
    order = [C.ROW_ORD] if ordered else []
    fact = fact if ordered else fact.drop(C.ROW_ORD)
    return price_apart(fact, lambda rows: assign_dense_key(rows, key, order=order, key_type="bigint")).select(*table.names)


def build_star(
    tenders: DataFrame, items: DataFrame, participants: DataFrame, ordered: bool = False
) -> Star:
    """All seven tables; ``ordered`` numbers the facts in source order."""
    dims = build_dimensions(tenders, items, participants)

    def won() -> tuple[DataFrame, DataFrame]:
        fact, orphans = build_fact_item(items, tenders, dims)
        return number_fact(fact, C.FATO_ITEM, ordered), orphans

    built = side_by_side(
        tenders.sparkSession,
        {"items": won, "bids": lambda: number_fact(build_fact_bid(participants, dims), C.FATO_PARTICIPACAO, ordered)},
    )
    fact, orphans = built["items"]
    return Star(**dims, fato_item_licitacao=fact, fato_participacao=built["bids"], itens_sem_licitacao=orphans)
