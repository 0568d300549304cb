"""Silver and gold builders, typed loading, contract checks and publication."""

from contextlib import suppress
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.operators import checks as K
from tenderlake.plans import gold, publish
from tenderlake.plans.versions import current_version, replaced_set, set_path
from tenderlake.plans import silver as S
from tenderlake.plans.marts import reconcile_months
from tenderlake.session import new_folder
from workload.adapters import (
    FATO, LINE_ORD, MEAN, line_ord, published, silver, star, table, text, units,
)
from workload.registry import SQL, query

_MONTH_LIST = "[" + ",".join(f"'{m}'" for m in C.MONTH_NAMES) + "]"
_PAD = "  "


def _twice(df: DataFrame, again) -> DataFrame:
    """Repeat some rows, the copies with larger ordinals."""
    copies = df.filter(again).withColumn(C.ROW_ORD, F.col(C.ROW_ORD) + (1 << 55))
    return df.unionByName(copies)


def _brl(amount, negative):
    shown = F.translate(F.format_number(amount, 2), ",.", ".,")
    return F.when(negative, F.concat(F.lit("-"), shown)).otherwise(shown)


def _padded(name):
    return F.concat(F.lit(_PAD), F.replace(name, F.lit(" "), F.lit("   ")), F.lit("\t"))


def _raw_tenders(spark, sf):
    placed = table(spark, sf, "orders").join(
        units(spark, sf), F.col("o_custkey") == F.col("c_custkey")
    )
    key = F.col("o_orderkey")
    states = F.element_at(F.array(*[F.lit(s) for s in C.STATES]), F.col("c_nationkey") + 1)
    decided = F.when(key % 31 == 0, "32/01/2024").otherwise(F.date_format("o_orderdate", "d/M/yyyy"))
    raw = placed.select(
        text("o_orderkey").alias("Número Licitação"),
        text("o_custkey").alias("Código UG"),
        F.left("o_orderpriority", F.lit(1)).alias("Código Modalidade Compra"),
        text("o_orderkey").alias("Número Processo"),
        _padded(F.col("o_orderpriority")).alias("Modalidade Compra"),
        _padded(F.col("o_orderstatus")).alias("Situação Licitação"),
        _padded(F.col("c_mktsegment")).alias("Objeto"),
        _brl(F.col("o_totalprice"), key % 23 == 0).alias("Valor Licitação"),
        _padded(F.col("c_name")).alias("Nome UG"),
        F.left("c_mktsegment", F.lit(3)).alias("Código Órgão"),
        _padded(F.col("c_mktsegment")).alias("Nome Órgão"),
        text("r_regionkey").alias("Código Órgão Superior"),
        _padded(F.col("r_name")).alias("Nome Órgão Superior"),
        F.when(key % 11 == 0, "-3").otherwise(F.lower(states)).alias("UF"),
        _padded(F.col("n_name")).alias("Município"),
        decided.alias("Data Resultado Compra"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Data Abertura"),
        key.alias(C.ROW_ORD),
    )
    return _twice(raw, F.col(C.ROW_ORD) % 7 == 0)


def _raw_lines(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    rest = F.concat_ws("|", *[text(c) for c in lineitem.columns])
    key = [
        text("l_orderkey").alias("Número Licitação"),
        text("l_partkey").alias("Código UG"),
        F.lit("5").alias("Código Modalidade Compra"),
        F.when(F.col("l_linenumber") != 5, text("l_linenumber")).alias("Código Item Compra"),
        rest.alias("Resto"),
        line_ord().alias(C.ROW_ORD),
    ]
    return lineitem, key


def _raw_items(spark, sf):
    lineitem, key = _raw_lines(spark, sf)
    line = F.col("l_linenumber")
    code = F.lpad(text("l_suppkey"), 14, "0")
    raw = lineitem.select(
        *key,
        F.concat(F.lit(" Peça  "), text("l_partkey")).alias("Descrição"),
        F.when(line == 7, "sem").when(line == 3, text(F.col("l_quantity").cast("long") + 100_000_000_000_000))
        .when(line == 2, "0.00004").otherwise(text(F.col("l_quantity").cast("long"))).alias("Quantidade Item"),
        # Places behind the fourth: they tell rows apart, and an amount below zero stays below.
        F.when(line == 6, "-0,001").when(line == 1, F.concat(_brl(F.col("l_extendedprice"), F.lit(False)), F.lit("004")))
        .otherwise(_brl(F.col("l_extendedprice"), F.lit(False))).alias("Valor Item"),
        F.when(line == 4, None).when(line == 3, "-11").otherwise(F.concat(code, F.lit(" "))).alias("Código Vencedor"),
        F.concat(F.lit("Forn. "), text("l_suppkey")).alias("Nome Vencedor"),
    )
    return _twice(raw, F.col("Código Item Compra").isin("2", "6") | F.col("Código Item Compra").isNull())


def _raw_bids(spark, sf):
    lineitem, key = _raw_lines(spark, sf)
    supplier = F.col("l_suppkey") % 40
    raw = lineitem.select(
        *key,
        F.concat(F.lit(" Peça  "), text("l_partkey")).alias("Descrição Item Compra"),
        F.when(supplier == 0, "-11")
        .when(supplier == 1, F.concat(F.lit(" Estrang"), text("l_suppkey")))
        .when(supplier != 2, text("l_suppkey")).alias("Código Participante"),
        F.concat(F.lit("Forn.  "), text("l_suppkey")).alias("Nome Participante"),
        F.when(F.col("l_returnflag") == "R", "sim ").when(F.col("l_returnflag") == "A", "NÃO").alias("Flag Vencedor"),
    )
    return _twice(raw, F.col("Código Item Compra") == "3")


def _raw_commitments(spark, sf):
    key = F.col("o_orderkey")
    raw = table(spark, sf, "orders").select(
        text("o_custkey").alias("Número Licitação"),
        text("o_orderkey").alias("Código Empenho"),
        _brl(F.col("o_totalprice"), key % 5 == 0).alias("Valor Empenho (R$)"),
        F.when(key % 9 == 0, "hoje").otherwise(F.date_format("o_orderdate", "d/M/yyyy")).alias("Data Emissão Empenho"),
        key.alias(C.ROW_ORD),
    )
    return _twice(raw, F.col(C.ROW_ORD) % 3 == 0)


_RAW = {
    C.TENDERS: _raw_tenders, C.ITEMS: _raw_items, C.BIDS: _raw_bids, C.COMMITMENTS: _raw_commitments,
}


def _marked(spark, sf, name):
    """Clean, write and read back one silver table."""
    root = new_folder(spark, "silver")
    S.write_silver(S.CLEANERS[name](_RAW[name](spark, sf)), root, name)
    return S.read_marked(spark, root, name)


@query(
    "b1_clean_tenders",
    """
SELECT o_orderkey AS numero, o_orderkey AS ordem, o_orderpriority AS modalidade, c_name AS nome_ug,
  n_name AS municipio, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor,
  CASE WHEN o_orderkey % 11 <> 0 THEN ['AC','AL','AM','AP','BA','CE','DF','ES','GO','MA','MG','MS',
    'MT','PA','PB','PE','PI','PR','RJ','RN','RO','RR','RS','SC','SE','SP','TO'][c_nationkey + 1] END AS uf,
  CASE WHEN o_orderkey % 31 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS resultado
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderkey % 23 <> 0""",
)
def b1(spark, sf):
    return S.accepted(_marked(spark, sf, C.TENDERS)).select(
        F.col("Número Licitação").cast("long").alias("numero"),
        F.col(C.ROW_ORD).alias("ordem"),
        F.col("Modalidade Compra").alias("modalidade"),
        F.col("Nome UG").alias("nome_ug"),
        F.col("Município").alias("municipio"),
        F.col("Valor Licitação").alias("valor"),
        F.col("UF").alias("uf"),
        F.col("Data Resultado Compra").alias("resultado"),
    )


@query(
    "b2_clean_items",
    f"""
SELECT l_orderkey AS numero, l_linenumber = 5 AS gerado,
  CASE WHEN l_linenumber = 5 THEN 'SEM_CODIGO_' || ({LINE_ORD}) ELSE CAST(l_linenumber AS VARCHAR) END AS codigo,
  'Peça ' || l_partkey AS descricao, CAST(CAST(round(l_extendedprice, 2) AS DECIMAL(18,2))
    + CASE l_linenumber WHEN 1 THEN 0.00004 ELSE 0 END AS DOUBLE) AS valor,
  CASE l_linenumber WHEN 7 THEN NULL WHEN 3 THEN 100000000000000 + l_quantity WHEN 2 THEN 0.00004 ELSE l_quantity END AS quantidade,
  CASE l_linenumber WHEN 4 THEN 'DESCONHECIDO' WHEN 3 THEN 'OUTRO' ELSE 'CNPJ' END AS tipo
FROM lineitem WHERE l_linenumber <> 6""",
)
def b2(spark, sf):
    return S.accepted(_marked(spark, sf, C.ITEMS)).select(
        F.col("Número Licitação").cast("long").alias("numero"),
        F.col("codigo_item_gerado").alias("gerado"),
        F.col("Código Item Compra").alias("codigo"),
        F.col("Descrição").alias("descricao"),
        F.col("Valor Item").alias("valor"),
        F.col("Quantidade Item").alias("quantidade"),
        F.col("tipo_documento_vencedor").alias("tipo"),
    )


@query(
    "b3_clean_participants",
    """
SELECT l_orderkey AS numero, ' Peça  ' || l_partkey AS descricao, 'Forn. ' || l_suppkey AS nome,
  CASE l_suppkey % 40 WHEN 0 THEN NULL WHEN 2 THEN NULL WHEN 1 THEN 'Estrang' || l_suppkey
    ELSE CAST(l_suppkey AS VARCHAR) END AS codigo, l_returnflag = 'R' AS venceu
FROM lineitem""",
)
def b3(spark, sf):
    return S.accepted(_marked(spark, sf, C.BIDS)).select(
        F.col("Número Licitação").cast("long").alias("numero"),
        F.col("Descrição Item Compra").alias("descricao"),
        F.col("Nome Participante").alias("nome"),
        F.col("Código Participante").alias("codigo"),
        F.col("flag_vencedor").alias("venceu"),
    )


@query(
    "b4_clean_commitments",
    """
SELECT o_orderkey AS empenho, CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE 1 END
    * CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS emissao
FROM orders""",
)
def b4(spark, sf):
    return S.accepted(_marked(spark, sf, C.COMMITMENTS)).select(
        F.col("Código Empenho").cast("long").alias("empenho"),
        F.col("Valor Empenho (R$)").alias("valor"),
        F.col("Data Emissão Empenho").alias("emissao"),
    )


@query(
    "b12_quality_report",
    """
SELECT 'licitacoes' AS dataset, SUM(c) AS linhas_entrada, COUNT(*) FILTER (k % 23 <> 0) AS linhas_saida,
  SUM(c - 1) FILTER (k % 23 <> 0) AS duplicados_removidos,
  SUM(c) FILTER (k % 23 = 0) AS valores_negativos_removidos,
  SUM(c) FILTER (k % 11 = 0) AS uf_invalida_corrigida, 0 AS codigo_item_gerado,
  0 AS participante_invalido_corrigido, 0 AS participante_estrangeiro,
  SUM(c) FILTER (k % 31 = 0) AS datas_invalidas
FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS c FROM orders)
UNION ALL
SELECT 'itens_licitacao', SUM(c), COUNT(*) FILTER (n <> 6), SUM(c - 1) FILTER (n <> 6),
  SUM(c) FILTER (n = 6), 0, COUNT(*) FILTER (n = 5), 0, 0, 0
FROM (SELECT l_linenumber AS n, CASE WHEN l_linenumber IN (2, 5, 6) THEN 2 ELSE 1 END AS c FROM lineitem)
UNION ALL
SELECT 'participantes_licitacao', SUM(c), COUNT(*), SUM(c - 1), 0, 0, 0,
  SUM(c) FILTER (s IN (0, 2)), SUM(c) FILTER (s = 1), 0
FROM (SELECT l_suppkey % 40 AS s, CASE WHEN l_linenumber = 3 THEN 2 ELSE 1 END AS c FROM lineitem)
UNION ALL
SELECT 'empenhos_relacionados', SUM(c), COUNT(*), SUM(c - 1), 0, 0, 0, 0, 0, SUM(c) FILTER (k % 9 = 0)
FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS c FROM orders)""",
    longs=S.REPORT,
)
def b12(spark, sf):
    report = S.quality_report({name: _marked(spark, sf, name) for name in _RAW})
    root = new_folder(spark, "silver")
    S.write_quality(report, root)
    return spark.read.schema(report.schema).json(f"{root}/relatorio_qualidade")


# Star builders


@query(
    "b5_dim_tempo",
    f"""
SELECT row_number() OVER (ORDER BY d) AS sk_tempo, CAST(d AS VARCHAR) AS data, year(d) AS ano,
  month(d) AS mes, quarter(d) AS trimestre, {_MONTH_LIST}[month(d)] AS nome_mes
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 50 <> 0)""",
)
def b5(spark, sf):
    return gold.build_dim_date(silver(spark, sf)[C.TENDERS])


@query(
    "b6_dim_orgao",
    """
SELECT row_number() OVER (ORDER BY primeiro) AS sk_orgao, CAST(c_custkey AS VARCHAR) AS codigo_ug,
  c_name AS nome_ug, left(c_mktsegment, 3) AS codigo_orgao, c_mktsegment AS nome_orgao,
  CAST(r_regionkey AS VARCHAR) AS codigo_orgao_superior, r_name AS nome_orgao_superior,
  CASE WHEN n_nationkey % 9 <> 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS uf,
  n_name AS municipio
FROM (SELECT o_custkey, MIN(o_orderkey) AS primeiro FROM orders GROUP BY 1)
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
)
def b6(spark, sf):
    return gold.build_dim_unit(silver(spark, sf)[C.TENDERS])[0]


@query(
    "b7_dim_fornecedor",
    FATO + f"""
SELECT row_number() OVER (ORDER BY primeiro) AS sk_fornecedor, codigo_fornecedor, nome_fornecedor, tipo_documento
FROM fornecedor JOIN (SELECT l_suppkey, MIN({LINE_ORD}) AS primeiro FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey""",
)
def b7(spark, sf):
    tables = silver(spark, sf)
    return gold.build_dim_supplier(tables[C.ITEMS], tables[C.BIDS])


@query(
    "b8_dim_produto",
    FATO + f"""
SELECT row_number() OVER (ORDER BY primeiro) AS sk_produto, descricao_item
FROM produto JOIN (SELECT l_partkey, MIN({LINE_ORD}) AS primeiro FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""",
)
def b8(spark, sf):
    tables = silver(spark, sf)
    return gold.build_dim_product(tables[C.ITEMS], tables[C.BIDS])


@query(
    "b9_dim_licitacao",
    """
SELECT row_number() OVER (ORDER BY o_orderkey) AS sk_licitacao,
  CAST(o_orderkey AS VARCHAR) AS numero_licitacao, CAST(o_custkey AS VARCHAR) AS codigo_ug,
  left(o_orderpriority, 1) AS codigo_modalidade_compra, 'P' || o_orderkey AS numero_processo,
  o_orderpriority AS modalidade_compra, o_orderstatus AS situacao_licitacao,
  c_mktsegment || ' ' || o_orderpriority AS objeto,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor_licitacao
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def b9(spark, sf):
    return gold.build_dim_tender(silver(spark, sf)[C.TENDERS])


def _named_items(s):
    """Fact rows under their natural keys."""
    return (
        s.fato_item_licitacao.join(s.dim_tempo, "sk_tempo", "left")
        .join(s.dim_orgao.select("sk_orgao", "codigo_ug"), "sk_orgao")
        .join(s.dim_fornecedor, "sk_fornecedor")
        .join(s.dim_produto, "sk_produto")
        .join(s.dim_licitacao.select("sk_licitacao", "numero_licitacao"), "sk_licitacao")
    )


@query(
    "b10_fato_item",
    FATO + """
SELECT CAST(data AS VARCHAR) AS data, CAST(o_custkey AS VARCHAR) AS codigo_ug, codigo_fornecedor,
  descricao_item, CAST(l_orderkey AS VARCHAR) AS numero_licitacao, centavos / 100.0 AS valor_item,
  unidade / 1e4 AS valor_unitario_item
FROM fato JOIN fornecedor ON l_suppkey = s_suppkey JOIN produto ON l_partkey = p_partkey""",
)
def b10(spark, sf):
    return _named_items(star(spark, sf)).select(
        "data", "codigo_ug", "codigo_fornecedor", "descricao_item", "numero_licitacao",
        "valor_item", "valor_unitario_item",
    )


@query(
    "b10_fato_item_spread_with_orphans",
    FATO + """
SELECT CAST(data AS VARCHAR) AS data, CAST(l_orderkey AS VARCHAR) AS numero_licitacao,
  codigo_fornecedor, descricao_item, unidade / 1e4 AS valor_unitario_item,
  (SELECT COUNT(*) FROM fato WHERE l_orderkey % 10 = 0) AS orfaos
FROM fato JOIN fornecedor ON l_suppkey = s_suppkey JOIN produto ON l_partkey = p_partkey
WHERE l_orderkey % 10 <> 0""",
)
def b10_spread(spark, sf):
    """A tenth of the tenders is missing; every lookup takes the shuffled, spread form."""
    tables = silver(spark, sf)
    kept = tables[C.TENDERS].filter(F.col(C.ROW_ORD) % 10 != 0)
    dims = gold.build_dimensions(kept, tables[C.ITEMS], tables[C.BIDS])
    fact, orphans = gold.build_fact_item(
        tables[C.ITEMS], kept, dims, rows_per_task=500, broadcast_bytes=0
    )
    s = gold.Star(**dims, fato_item_licitacao=fact, fato_participacao=fact)
    return _named_items(s).select(
        "data", "numero_licitacao", "codigo_fornecedor", "descricao_item", "valor_unitario_item",
        orphans.scalar().alias("orfaos"),
    )


@query(
    "b11_fato_participacao",
    FATO + """
SELECT CAST(l_orderkey AS VARCHAR) AS numero_licitacao, descricao_item,
  CASE WHEN l_suppkey % 40 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS codigo_fornecedor,
  l_returnflag = 'R' AS flag_vencedor
FROM fato JOIN produto ON l_partkey = p_partkey""",
)
def b11(spark, sf):
    s = star(spark, sf)
    rows = (
        s.fato_participacao.join(s.dim_fornecedor, "sk_fornecedor", "left")
        .join(s.dim_produto, "sk_produto")
        .join(s.dim_licitacao, "sk_licitacao")
    )
    return rows.select("numero_licitacao", "descricao_item", "codigo_fornecedor", "flag_vencedor")


# Loading and checks

_COUNTS = """
SELECT 'dim_tempo' AS tabela, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS linhas FROM orders
  WHERE o_orderkey % 50 <> 0
UNION ALL SELECT 'dim_orgao', COUNT(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'dim_fornecedor', COUNT(DISTINCT l_suppkey) FROM lineitem
UNION ALL SELECT 'dim_produto', COUNT(DISTINCT l_partkey) FROM lineitem
UNION ALL SELECT 'dim_licitacao', COUNT(*) FROM orders
UNION ALL SELECT 'fato_item_licitacao', COUNT(*) FROM lineitem
UNION ALL SELECT 'fato_participacao', COUNT(*) FROM lineitem"""


def _counts(tables):
    parts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(n).alias("tabela"), "linhas")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("k3_gold_write", _COUNTS)
def k3(spark, sf):
    root = new_folder(spark, "gold")
    publish.write_gold(star(spark, sf).tables(), root)
    return _counts(publish.read_star(spark, root).tables())


@query("k4_load_warehouse", _COUNTS)
def k4(spark, sf):
    """Two full reloads in a row; readers see the second, with nothing doubled."""
    root = new_folder(spark, "warehouse")
    for _ in range(2):
        publish.load_warehouse(spark, star(spark, sf), root)
    return _counts(publish.read_version(spark, root).tables())


@query(
    "i8_publish_version",
    "SELECT COUNT(*) FILTER (l_linenumber = 1) AS antes, COUNT(*) AS depois FROM lineitem",
)
def i8(spark, sf):
    """A staged version is invisible until the pointer moves to it."""
    root = new_folder(spark, "warehouse")
    tables = star(spark, sf).tables()
    fact = tables["fato_item_licitacao"]
    numbers = star(spark, sf).dim_licitacao.select("sk_licitacao", "numero_licitacao")
    first = table(spark, sf, "lineitem").filter("l_linenumber = 1").select(text("l_orderkey").alias("numero_licitacao"))
    part = first.join(numbers, "numero_licitacao").select("sk_licitacao")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "sk_licitacao" else F.col(f.name) for f in fact.schema.fields]
    old = publish.stage_version(spark, {**tables, "fato_item_licitacao": part.select(*columns)}, root)
    publish.publish_version(spark, root, old)
    new = publish.stage_version(spark, tables, root)
    before = publish.read_version(spark, root).fato_item_licitacao.agg(F.count(F.lit(1)).alias("antes"))
    publish.publish_version(spark, root, new)
    after = publish.read_version(spark, root).fato_item_licitacao.agg(F.count(F.lit(1)))
    return before.select("antes", after.scalar().alias("depois"))


@query(
    "k5_conform",
    """
SELECT CAST(l_orderkey AS BIGINT) AS sk_fato_item, l_suppkey AS sk_fornecedor,
  CAST(round(l_extendedprice * 100) AS BIGINT) / 100.0 AS valor_item,
  ((CAST(round(l_extendedprice * 100) AS BIGINT) * 125 + 5) // 10) / 1e4 AS valor_unitario_item
FROM lineitem""",
)
def k5(spark, sf):
    """Text and wide decimals into the fact's types; rounding is half up."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    null = F.lit("")
    raw = table(spark, sf, "lineitem").select(
        text("l_orderkey").alias("sk_fato_item"),
        text("l_suppkey").alias("sk_fornecedor"),
        *[null.alias(c) for c in ("sk_tempo", "sk_orgao", "sk_produto", "sk_licitacao", "quantidade_item")],
        text(price).alias("valor_item"),
        (price * F.lit("0.125").cast("decimal(4,3)")).alias("valor_unitario_item"),
    )
    return publish.conform(raw, C.FATO_ITEM).select(
        "sk_fato_item", "sk_fornecedor", "valor_item", "valor_unitario_item"
    )


def _broken(spark, sf):
    """Tables with lost suppliers, repeated tenders and undated days."""
    s = star(spark, sf)
    number = F.col("numero_licitacao").cast("long")
    day = F.when(F.dayofmonth("data") != 13, F.col("data"))
    return s.tables() | {
        "dim_fornecedor": s.dim_fornecedor.filter("codigo_fornecedor % 10 <> 0"),
        "dim_licitacao": s.dim_licitacao.unionByName(s.dim_licitacao.filter(number % 7 == 0)),
        "dim_tempo": s.dim_tempo.withColumn("data", day),
    }


_VIOLATIONS = """
SELECT * FROM (SELECT 'fato_item_licitacao' AS tabela, 'foreign_key' AS regra, 'sk_fornecedor' AS coluna,
  COUNT(*) AS violacoes FROM lineitem WHERE l_suppkey % 10 = 0
UNION ALL SELECT 'fato_participacao', 'foreign_key', 'sk_fornecedor', COUNT(*) FROM lineitem
  WHERE l_suppkey % 10 = 0 AND l_suppkey % 40 <> 0
UNION ALL SELECT 'dim_licitacao', 'primary_key', 'sk_licitacao', COUNT(*) FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT 'dim_licitacao', 'unique', 'numero_licitacao,codigo_ug,codigo_modalidade_compra',
  COUNT(*) FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT 'dim_tempo', 'not_null', 'data', COUNT(DISTINCT CAST(o_orderdate AS DATE)) FROM orders
  WHERE o_orderkey % 50 <> 0 AND day(o_orderdate) = 13) WHERE violacoes > 0"""


@query("k6_check_contract", _VIOLATIONS)
def k6(spark, sf):
    return K.check_contract(_broken(spark, sf), C.WAREHOUSE).filter("violacoes > 0")


@query("g1_gate_stops_publication", _VIOLATIONS)
def g1(spark, sf):
    """The gate raises its violations, and nothing becomes visible."""
    root = new_folder(spark, "warehouse")
    try:
        publish.publish_if_clean(spark, _broken(spark, sf), root)
    except K.GateClosed as closed:
        if current_version(spark, root) is not None:
            raise
        return spark.createDataFrame(
            closed.violations, "tabela string, regra string, coluna string, violacoes long"
        )
    raise AssertionError("the gate let broken tables through")


@query(
    "k8_dense_fact_key",
    "SELECT 1 AS menor, COUNT(*) AS maior, COUNT(*) AS distintas FROM lineitem",
    longs=("menor",),
)
def k8(spark, sf):
    key = "sk_fato_item"
    return star(spark, sf).fato_item_licitacao.agg(
        F.min(key).alias("menor"), F.max(key).alias("maior"), F.count_distinct(key).alias("distintas")
    )


@query(
    "g2_orphan_keys",
    """
SELECT l_orderkey, COUNT(*) AS linhas FROM lineitem WHERE l_orderkey % 10 = 0 GROUP BY 1""",
)
def g2(spark, sf):
    kept = table(spark, sf, "orders").filter("o_orderkey % 10 <> 0")
    return K.orphan_keys(table(spark, sf, "lineitem"), kept, "l_orderkey", "o_orderkey")


@query(
    "g2_null_keys",
    FATO + """
SELECT COUNT(*) FILTER (data IS NULL) AS sk_tempo, 0 AS sk_orgao, 0 AS sk_fornecedor,
  0 AS sk_produto, 0 AS sk_licitacao FROM fato""",
    longs=("sk_orgao", "sk_fornecedor", "sk_produto", "sk_licitacao"),
)
def g2_nulls(spark, sf):
    keys = ["sk_tempo", "sk_orgao", "sk_fornecedor", "sk_produto", "sk_licitacao"]
    return K.null_keys(star(spark, sf).fato_item_licitacao, keys)


@query(
    "g3_reconcile",
    FATO + """
SELECT 'valor_total' AS medida, SUM(centavos) / 100.0 AS soma_partes, SUM(centavos) / 100.0 AS total,
  true AS confere FROM fato""",
)
def g3(spark, sf):
    return reconcile_months(star(spark, sf))


@query(
    "g3_row_balance",
    "SELECT dataset, true AS confere FROM (" + SQL["b12_quality_report"] + ")",
)
def g3_balance(spark, sf):
    report = S.quality_report({name: _marked(spark, sf, name) for name in _RAW})
    unbalanced = K.row_balance(report).select("dataset", F.lit(False).alias("confere"))
    return report.select("dataset").join(unbalanced, "dataset", "left").select(
        "dataset", F.coalesce("confere", F.lit(True)).alias("confere")
    )


@query(
    "s11_read_silver",
    "SELECT dataset, linhas_saida AS linhas FROM (" + SQL["b12_quality_report"]
    + ") WHERE dataset <> 'empenhos_relacionados'",
)
def s11(spark, sf):
    """Three written tables, read back without their rejected rows."""
    root = new_folder(spark, "silver")
    with replaced_set(spark, root) as folder:
        for name in (C.TENDERS, C.ITEMS, C.BIDS):
            S.write_silver(S.CLEANERS[name](_RAW[name](spark, sf)), folder, name)
    return _counts(S.read_silver(spark, root)).withColumnRenamed("tabela", "dataset")


@query(
    "k1_silver_write",
    """
SELECT CASE WHEN o_orderkey % 23 = 0 THEN 'valor_negativo' ELSE 'aceita' END AS situacao_linha,
  COUNT(*) AS linhas FROM orders GROUP BY 1""",
)
def k1(spark, sf):
    """Writing a set again replaces it; one that breaks off after its table does not."""
    root = new_folder(spark, "silver")
    marked = S.CLEANERS[C.TENDERS](_raw_tenders(spark, sf))
    for broken in (False, False, True):
        with suppress(InterruptedError), replaced_set(spark, root) as folder:
            S.write_silver(marked.limit(0) if broken else marked, folder, C.TENDERS)
            if broken:
                raise InterruptedError
    return spark.read.parquet(set_path(spark, root, C.TENDERS)).groupBy(S.STATE).agg(F.count(F.lit(1)).alias("linhas"))
