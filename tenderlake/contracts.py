"""Names, domains and table contracts of the procurement data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Source data sets, their logical names and required columns.


@dataclass(frozen=True)
class DatasetSpec:
    source: str
    logical: str
    required: tuple[str, ...]


DATASETS = (
    DatasetSpec(
        "Licitação",
        "licitacoes",
        ("Número Licitação", "Código UG", "Código Órgão", "UF", "Valor Licitação"),
    ),
    DatasetSpec(
        "ItemLicitação",
        "itens_licitacao",
        ("Número Licitação", "Código Item Compra", "Valor Item", "Código Vencedor"),
    ),
    DatasetSpec(
        "ParticipantesLicitação",
        "participantes_licitacao",
        ("Número Licitação", "Código Item Compra", "Código Participante", "Flag Vencedor"),
    ),
    DatasetSpec(
        "EmpenhosRelacionados",
        "empenhos_relacionados",
        ("Número Licitação", "Código Empenho", "Valor Empenho (R$)"),
    ),
)

TENDERS, ITEMS, BIDS, COMMITMENTS = (spec.logical for spec in DATASETS)

# Delimited text format of the landing files.
SOURCE_ENCODING = "ISO-8859-1"
SOURCE_SEPARATOR = ";"
FILE_NAME_PATTERN = r"^(\d{4})(\d{2})_(.+)\.csv$"

# Cell texts that mean "missing" in the landing files.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The 26 states and the federal district.
STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)

# Month names in calendar order.
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)

# Outcome and run states.
OK, EMPTY, INVALID, BAD_ENCODING = "sucesso", "vazio", "erro_validacao", "erro_encoding"
STARTED, FAILED = "iniciado", "falha"

# Amounts as they are read: wide enough to test, compare and divide before anything is rounded.
AMOUNT = T.DecimalType(38, 18)
MONEY = T.DecimalType(18, 4)
TENDER_MONEY = T.DecimalType(18, 2)

ROW_ORD = "_row_ord"
YEAR_PART, MONTH_PART = "_ano_particao", "_mes_particao"

# Key, text and commitment columns of the source.
TENDER_KEY = ("Número Licitação", "Código UG", "Código Modalidade Compra")
TENDER_DATE_KEY = TENDER_KEY[:2]

TENDER_TEXT = (
    "Nome UG", "Modalidade Compra", "Objeto", "Situação Licitação",
    "Nome Órgão Superior", "Nome Órgão", "Município",
)

COMMITMENT_COLUMNS = (
    "Número Licitação", "Código Empenho", "Valor Empenho (R$)", "Data Emissão Empenho",
)


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    nullable: bool = True
    max_length: int | None = None
    references: tuple[str, str] | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def _key(name: str, kind: T.DataType = T.IntegerType()) -> Column:
    return Column(name, kind, nullable=False)


def _ref(name: str, table: str) -> Column:
    return Column(name, T.IntegerType(), references=(table, name))


def _text(name: str, length: int | None = None, nullable: bool = True) -> Column:
    return Column(name, T.StringType(), nullable, length)


# Names, types and rules of the published tables.
DIM_TEMPO = Table(
    "dim_tempo",
    (
        _key("sk_tempo"),
        Column("data", T.DateType(), nullable=False),
        Column("ano", T.ShortType(), nullable=False),
        Column("mes", T.ShortType(), nullable=False),
        Column("trimestre", T.ShortType(), nullable=False),
        _text("nome_mes", 20, nullable=False),
    ),
    ("sk_tempo",),
    (("data",),),
)

DIM_ORGAO = Table(
    "dim_orgao",
    (
        _key("sk_orgao"),
        _text("codigo_ug", 20, nullable=False),
        _text("nome_ug", 200),
        _text("codigo_orgao", 20),
        _text("nome_orgao", 200),
        _text("codigo_orgao_superior", 20),
        _text("nome_orgao_superior", 200),
        _text("uf", 2),
        _text("municipio", 120),
    ),
    ("sk_orgao",),
    (("codigo_ug",),),
)

DIM_FORNECEDOR = Table(
    "dim_fornecedor",
    (
        _key("sk_fornecedor"),
        _text("codigo_fornecedor", 20, nullable=False),
        _text("nome_fornecedor", 200),
        _text("tipo_documento", 20),
    ),
    ("sk_fornecedor",),
    (("codigo_fornecedor",),),
)

DIM_PRODUTO = Table(
    "dim_produto",
    (_key("sk_produto"), _text("descricao_item", nullable=False)),
    ("sk_produto",),
)

DIM_LICITACAO = Table(
    "dim_licitacao",
    (
        _key("sk_licitacao"),
        _text("numero_licitacao", 30, nullable=False),
        _text("codigo_ug", 20, nullable=False),
        _text("codigo_modalidade_compra", 10, nullable=False),
        _text("numero_processo", 50),
        _text("modalidade_compra", 60),
        _text("situacao_licitacao", 60),
        _text("objeto"),
        Column("valor_licitacao", TENDER_MONEY),
    ),
    ("sk_licitacao",),
    (("numero_licitacao", "codigo_ug", "codigo_modalidade_compra"),),
)

FATO_ITEM = Table(
    "fato_item_licitacao",
    (
        _key("sk_fato_item", T.LongType()),
        _ref("sk_tempo", "dim_tempo"),
        _ref("sk_orgao", "dim_orgao"),
        _ref("sk_fornecedor", "dim_fornecedor"),
        _ref("sk_produto", "dim_produto"),
        _ref("sk_licitacao", "dim_licitacao"),
        Column("quantidade_item", MONEY),
        Column("valor_item", MONEY),
        Column("valor_unitario_item", MONEY),
    ),
    ("sk_fato_item",),
)

FATO_PARTICIPACAO = Table(
    "fato_participacao",
    (
        _key("sk_fato_participacao", T.LongType()),
        _ref("sk_licitacao", "dim_licitacao"),
        _ref("sk_produto", "dim_produto"),
        _ref("sk_fornecedor", "dim_fornecedor"),
        Column("flag_vencedor", T.BooleanType()),
    ),
    ("sk_fato_participacao",),
)

DIMENSIONS = (DIM_TEMPO, DIM_ORGAO, DIM_FORNECEDOR, DIM_PRODUTO, DIM_LICITACAO)
FACTS = (FATO_ITEM, FATO_PARTICIPACAO)
WAREHOUSE = DIMENSIONS + FACTS
