"""Procurement roles played by the driver tables.

Orders are tenders, customers buying units, suppliers suppliers, parts products, and line
items both the items won and the bids. The roles are written once per session as silver
frames, built into a star by the package, published, and read back by the reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.functions.columns import named
from tenderlake.plans.gold import Star, build_star
from tenderlake.plans.publish import load_warehouse, read_version
from tenderlake.session import new_folder, staged

_silver: dict[tuple[str, str], dict[str, DataFrame]] = {}
_published: dict[tuple[str, str], tuple[str, dict[str, int]]] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def content_ord(df: DataFrame) -> Column:
    """An ordinal from the row's content: the tables carry no row order of their own."""
    return F.xxhash64(*[named(c) for c in df.columns]).bitwiseAND(F.lit((1 << 55) - 1))


def line_ord() -> Column:
    """The same for line items, from their keys, so that SQL can say it too."""
    line = F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber")
    return (line * 65536 + F.col("l_partkey")) * 4096 + F.col("l_suppkey")


LINE_ORD = "((CAST(l_orderkey AS BIGINT) * 8 + l_linenumber) * 65536 + l_partkey) * 4096 + l_suppkey"


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def order_date() -> Column:
    """Result date of a tender; every fiftieth has none."""
    return F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate").cast("date"))


def state() -> Column:
    """Two-character state of a nation; every ninth has none."""
    return F.when(F.col("n_nationkey") % 9 != 0, F.lpad(text("n_nationkey"), 2, "0"))


def product_text() -> Column:
    return F.concat_ws(" ", "p_name", text("l_partkey"))


def units(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )


def tenders(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer, nation, region = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    # one table after the other: the size of a join of small tables is guessed too high to be broadcast
    placed = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    priority = F.col("o_orderpriority")
    return placed.select(
        text("o_orderkey").alias("Número Licitação"),
        text("o_custkey").alias("Código UG"),
        F.left(priority, F.lit(1)).alias("Código Modalidade Compra"),
        F.concat(F.lit("P"), text("o_orderkey")).alias("Número Processo"),
        priority.alias("Modalidade Compra"),
        F.col("o_orderstatus").alias("Situação Licitação"),
        F.concat_ws(" ", "c_mktsegment", "o_orderpriority").alias("Objeto"),
        F.col("o_totalprice").cast(C.TENDER_MONEY).alias("Valor Licitação"),
        F.col("c_name").alias("Nome UG"),
        F.left("c_mktsegment", F.lit(3)).alias("Código Órgão"),
        F.col("c_mktsegment").alias("Nome Órgão"),
        text("r_regionkey").alias("Código Órgão Superior"),
        F.col("r_name").alias("Nome Órgão Superior"),
        state().alias("UF"),
        F.col("n_name").alias("Município"),
        order_date().alias("Data Resultado Compra"),
        F.col("o_orderkey").alias(C.ROW_ORD),
    )


def placed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with what the roles need of their orders, in their types before they meet, as doubles are wide."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.left("o_orderpriority", F.lit(1)).alias("_modalidade"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", quantity().alias("_quantidade"),
        F.col("l_extendedprice").cast(C.MONEY).alias("_valor"), (F.col("l_returnflag") == "R").alias("_vence"),
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def named_lines(spark: SparkSession, sf: str, placed: DataFrame) -> DataFrame:
    """Placed lines with the names of their products and suppliers."""
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    joined = placed.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.drop("p_partkey", "s_suppkey")


def _line_key() -> list[Column]:
    return [
        text("l_orderkey").alias("Número Licitação"),
        text("o_custkey").alias("Código UG"),
        F.col("_modalidade").alias("Código Modalidade Compra"),
    ]


def document_type() -> Column:
    kinds = F.array(*[F.lit(k) for k in ("CNPJ", "CPF", "ESTRANGEIRO", "OUTRO")])
    return F.element_at(kinds, (F.col("l_suppkey") % 4 + 1).cast("int"))


def quantity() -> Column:
    return F.when(F.col("l_linenumber") == 7, 0).otherwise(F.col("l_quantity")).cast(C.MONEY)


def items(lines: DataFrame) -> DataFrame:
    return lines.select(
        *_line_key(),
        text("l_linenumber").alias("Código Item Compra"),
        product_text().alias("Descrição"),
        F.col("_quantidade").alias("Quantidade Item"),
        F.col("_valor").alias("Valor Item"),
        text("l_suppkey").alias("Código Vencedor"),
        F.col("s_name").alias("Nome Vencedor"),
        document_type().alias("tipo_documento_vencedor"),
        line_ord().alias(C.ROW_ORD),
    )


def participants(lines: DataFrame) -> DataFrame:
    return lines.select(
        *_line_key(),
        text("l_linenumber").alias("Código Item Compra"),
        product_text().alias("Descrição Item Compra"),
        F.when(F.col("l_suppkey") % 40 != 0, text("l_suppkey")).alias("Código Participante"),
        F.col("s_name").alias("Nome Participante"),
        F.col("_vence").alias("flag_vencedor"),
        line_ord().alias(C.ROW_ORD),
    )


def silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The silver frames on written tables, the form the star is built from.

    Items and bids are the same lines, which meet their orders and names once and are written once, narrow; their texts
    and ordinals are said from the keys as they are read.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _silver:
        lines = staged(named_lines(spark, sf, placed_lines(spark, sf)))
        _silver[key] = {C.TENDERS: staged(tenders(spark, sf)), C.ITEMS: items(lines), C.BIDS: participants(lines)}
    return _silver[key]


def build(spark: SparkSession, sf: str) -> Star:
    tables = silver(spark, sf)
    return build_star(tables[C.TENDERS], tables[C.ITEMS], tables[C.BIDS])


def publish_star(spark: SparkSession, sf: str) -> tuple[str, dict[str, int]]:
    """Build, check and publish the star of a scale factor; returns its folder and row counts."""
    root = new_folder(spark, "warehouse")
    return root, load_warehouse(spark, build(spark, sf), root)


def published(spark: SparkSession, sf: str) -> tuple[str, dict[str, int]]:
    """The published star of this session: reports read a warehouse, they do not rebuild it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _published:
        _published[key] = publish_star(spark, sf)
    return _published[key]


def use_published(spark: SparkSession, sf: str, root: str, counts: dict[str, int]) -> None:
    """Let the reports read a star that was published before."""
    _published[(spark.sparkContext.applicationId, sf)] = root, counts


def star(spark: SparkSession, sf: str) -> Star:
    return read_version(spark, published(spark, sf)[0])


# SQL counterpart of the roles. Prices are whole numbers (cents, or 1/10000 for unit prices)
# so that means and roundings are exact.
FATO = """
WITH fato AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, o_custkey,
         CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) END AS data,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS centavos,
         CASE WHEN l_linenumber <> 7 THEN
           (CAST(round(l_extendedprice * 100) AS BIGINT) * 200 + CAST(l_quantity AS BIGINT))
           // (2 * CAST(l_quantity AS BIGINT)) END AS unidade
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
orgao AS (
  SELECT c_custkey, c_name, c_mktsegment AS nome_orgao, r_name AS nome_orgao_superior,
         CASE WHEN n_nationkey % 9 <> 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS uf
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
produto AS (SELECT p_partkey, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS descricao_item FROM part),
fornecedor AS (
  SELECT s_suppkey, s_name AS nome_fornecedor, CAST(s_suppkey AS VARCHAR) AS codigo_fornecedor,
         ['CNPJ', 'CPF', 'ESTRANGEIRO', 'OUTRO'][s_suppkey % 4 + 1] AS tipo_documento FROM supplier)
"""

# Mean of unit prices at eight decimals, rounded half up.
MEAN = "CAST((2 * SUM(unidade) * 10000 + COUNT(unidade)) // (2 * COUNT(unidade)) AS DOUBLE) / 1e8"

STATS = (
    FATO
    + f""",
estatisticas AS (
  SELECT l_partkey AS chave, {MEAN} AS media, STDDEV_SAMP(unidade / 1e4) AS desvio, COUNT(*) AS n
  FROM fato WHERE unidade IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 5),
anomalia AS (
  SELECT f.*, media,
         CAST(ROUND(CAST((unidade / 1e4 - media) / NULLIF(desvio, 0) AS DECIMAL(18,6)), 2) AS DOUBLE)
           AS desvios
  FROM fato f JOIN estatisticas ON l_partkey = chave
  WHERE unidade / 1e4 > media + 2 * desvio)
"""
)
