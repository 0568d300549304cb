"""Column functions on dirty text derived from typed columns; the SQL states the clean value."""

from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.functions import columns as X
from tenderlake.operators.aggregates import above_threshold, group_stats
from tenderlake.operators.keys import dedup_exact
from tenderlake.plans.marts import top_categories
from workload.adapters import FATO, MEAN, quantity, star, table, text
from workload.registry import query

_NBSP = "\u00a0"
_STATE_LIST = "[" + ", ".join(f"'{s}'" for s in C.STATES) + "]"


def _states():
    return F.element_at(F.array(*[F.lit(s) for s in C.STATES]), F.col("c_nationkey") + 1)


@query(
    "p1_normalize_text",
    "SELECT c_custkey, c_mktsegment || ' ' || c_name AS nome FROM customer",
)
def p1(spark, sf):
    dirty = F.concat(F.lit("\t \x1c"), "c_mktsegment", F.lit(f"{_NBSP} \x85 "), "c_name", F.lit(" \n"))
    return table(spark, sf, "customer").select("c_custkey", X.normalize_text(dirty).alias("nome"))


@query("p2_upper_trim", "SELECT c_custkey, c_mktsegment AS segmento FROM customer")
def p2(spark, sf):
    dirty = F.concat(F.lit(f"{_NBSP}\x1f "), F.lower("c_mktsegment"), F.lit(" \t"))
    return table(spark, sf, "customer").select("c_custkey", X.upper_trim(dirty).alias("segmento"))


@query(
    "p3_null_if_not_in",
    f"""
SELECT c_custkey,
  CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN {_STATE_LIST}[c_nationkey + 1] END AS uf,
  c_custkey % 7 = 0 OR c_custkey % 11 = 0 AS invalida
FROM customer""",
)
def p3(spark, sf):
    raw = F.when(F.col("c_custkey") % 7 == 0, "-3").when(F.col("c_custkey") % 11 != 0, _states())
    rows = table(spark, sf, "customer").select("c_custkey", raw.alias("bruta"))
    return rows.select(
        "c_custkey",
        X.null_if_not_in(F.col("bruta"), C.STATES).alias("uf"),
        X.outside_domain(F.col("bruta"), C.STATES).alias("invalida"),
    )


@query(
    "p4_parse_brl",
    """
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 3 THEN NULL WHEN 1 THEN -0.00001
  WHEN 5 THEN CAST(CAST(round(l_extendedprice, 2) AS DECIMAL(18,2)) + 0.00007 AS DOUBLE)
  ELSE round(l_extendedprice, 2) END AS valor FROM lineitem""",
    longs=("l_linenumber",),
)
def p4(spark, sf):
    """Grouped and plain amounts; five places, and one that is barely below zero."""
    grouped = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    plain = F.replace(grouped, F.lit("."), F.lit(""))
    line = F.col("l_linenumber")
    raw = F.when(line == 3, None).when(line == 1, "-0,00001").when(line % 2 == 0, plain)
    raw = raw.when(line == 5, F.concat(grouped, F.lit("007")))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", X.parse_brl(raw.otherwise(grouped)).alias("valor")
    )


@query(
    "p5_drop_negative",
    """
SELECT c_custkey, CASE WHEN c_custkey % 13 <> 0 THEN c_acctbal END AS saldo FROM customer
WHERE c_custkey % 13 = 0 OR c_acctbal >= 0""",
)
def p5(spark, sf):
    balance = F.when(F.col("c_custkey") % 13 != 0, F.col("c_acctbal"))
    rows = table(spark, sf, "customer").select("c_custkey", balance.alias("saldo"))
    return X.drop_negative(rows, "saldo")


@query(
    "p6_parse_date_br",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0
  THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS data FROM orders""",
)
def p6(spark, sf):
    key = F.col("o_orderkey")
    raw = (
        F.when(key % 17 == 0, F.when(key % 2 == 0, "31/02/2024").otherwise("sem data"))
        .when(key % 19 == 0, None)
        .when(key % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    return table(spark, sf, "orders").select("o_orderkey", X.parse_date_br(raw).alias("data"))


@query(
    "p7_parse_number",
    """
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN l_quantity / 1000
    WHEN 6 THEN 100000000000000 + l_quantity WHEN 7 THEN 0.00004 ELSE l_quantity END AS quantidade FROM lineitem""",
    longs=("l_linenumber",),
)
def p7(spark, sf):
    whole = text(F.col("l_quantity").cast("long"))
    line = F.col("l_linenumber")
    raw = (
        F.when(line == 1, F.concat(whole, F.lit(",5")))
        .when(line == 2, F.concat(whole, F.lit("d")))
        .when(line == 3, F.format_string("%.3f", F.col("l_quantity") / 1000))
        .when(line == 4, F.concat(F.lit("  "), whole, F.lit(" ")))
        .when(line == 5, F.concat(whole, F.lit("e0")))
        .when(line == 6, text(F.col("l_quantity").cast("long") + 100_000_000_000_000))
        .when(line == 7, ".00004")
        .otherwise(F.concat(F.lit("+"), whole, F.lit(".0")))
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", X.parse_number(raw).alias("quantidade")
    )


def _codes():
    """14, 11 and 8 digits, two spellings of the foreign prefix, and a missing code."""
    kind = F.col("c_custkey") % 6
    return (
        F.when(kind == 0, F.lpad(text("c_custkey"), 14, "1"))
        .when(kind == 1, F.lpad(text("c_custkey"), 11, "1"))
        .when(kind == 2, F.lpad(text("c_custkey"), 8, "1"))
        .when(kind == 3, F.concat(F.lit("ESTRANG"), F.lpad(text("c_custkey"), 7, "0")))
        .when(kind == 4, F.concat(F.lit("estrang"), text("c_custkey")))
    )


@query(
    "p8_classify_winner_doc",
    """
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'CNPJ' WHEN 1 THEN 'CPF' WHEN 2 THEN 'OUTRO'
  WHEN 3 THEN 'CNPJ' WHEN 5 THEN 'DESCONHECIDO'
  ELSE CASE length(CAST(c_custkey AS VARCHAR)) WHEN 4 THEN 'CPF' WHEN 7 THEN 'CNPJ' ELSE 'OUTRO' END
  END AS tipo FROM customer""",
)
def p8(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.classify_winner_doc(_codes()).alias("tipo"))


@query(
    "p9_classify_doc",
    """
SELECT c_custkey, ['CNPJ', 'CPF', 'OUTRO', 'ESTRANGEIRO', 'ESTRANGEIRO', 'DESCONHECIDO']
  [c_custkey % 6 + 1] AS tipo FROM customer""",
)
def p9(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.classify_doc(_codes()).alias("tipo"))


@query(
    "p10_code_formats",
    """
SELECT c_custkey, c_custkey % 6 IN (0, 1, 2) AS numerico, c_custkey % 6 IN (3, 4) AS estrangeiro
FROM customer""",
)
def p10(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", _codes().alias("codigo"))
    return rows.select(
        "c_custkey",
        X.is_numeric_code(F.col("codigo")).alias("numerico"),
        X.is_foreign_code(F.col("codigo")).alias("estrangeiro"),
    )


@query(
    "p11_repair_participant_code",
    """
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(s_suppkey AS VARCHAR)
  WHEN 2 THEN 'Estrang' || s_suppkey ELSE NULL END AS codigo FROM supplier""",
)
def p11(spark, sf):
    kind = F.col("s_suppkey") % 4
    raw = (
        F.when(kind == 0, F.concat(F.lit("-"), text("s_suppkey")))
        .when(kind == 1, F.concat(F.lit(_NBSP), text("s_suppkey"), F.lit(" ")))
        .when(kind == 2, F.concat(F.lit(" Estrang"), text("s_suppkey")))
    )
    return table(spark, sf, "supplier").select(
        "s_suppkey", X.repair_participant_code(raw).alias("codigo")
    )


@query(
    "p12_flag_is",
    "SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS venceu FROM lineitem",
    longs=("l_linenumber",),
)
def p12(spark, sf):
    raw = F.when(F.col("l_returnflag") == "R", " Sim\t").when(F.col("l_returnflag") == "A", "NÃO")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", X.flag_is(raw, "SIM").alias("venceu")
    )


@query(
    "p13_fill_missing_code",
    """
SELECT o_custkey, CASE WHEN o_custkey % 7 = 0 THEN 'SEM_CODIGO_' || MIN(o_orderkey)
  ELSE CAST(o_custkey AS VARCHAR) END AS codigo, o_custkey % 7 = 0 AS gerado
FROM orders GROUP BY o_custkey""",
)
def p13(spark, sf):
    """Equal rows merge first, so one buyer's uncoded rows share one generated code."""
    code = F.when(F.col("o_custkey") % 7 != 0, text("o_custkey"))
    rows = table(spark, sf, "orders").select(
        "o_custkey", code.alias("codigo"), F.col("o_orderkey").alias(C.ROW_ORD)
    )
    return X.fill_missing_code(dedup_exact(rows), "codigo", C.ROW_ORD, "gerado").drop(C.ROW_ORD)


@query(
    "p14_project_star",
    """
SELECT c_custkey AS codigo_ug, c_name AS nome_ug, c_mktsegment AS nome_orgao FROM customer""",
)
def p14(spark, sf):
    names = {"c_custkey": "codigo_ug", "c_name": "nome_ug", "c_mktsegment": "nome_orgao"}
    return X.project_star(table(spark, sf, "customer"), names)


@query(
    "p15_calendar_attributes",
    """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  year(o_orderdate) AS ano, month(o_orderdate) AS mes, quarter(o_orderdate) AS trimestre,
  ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro',
   'Novembro','Dezembro'][month(o_orderdate)] AS nome_mes FROM orders""",
)
def p15(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return X.calendar_attributes(rows, "o_orderdate")


@query(
    "p16_unit_price",
    FATO + """
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN centavos * 250.0 WHEN 2 THEN 3.0
  ELSE unidade / 1e4 END AS preco FROM fato""",
    longs=("l_linenumber",),
)
def p16(spark, sf):
    """Whole quantities, 0.00004, and 1 for 0.33333, which rounds to 3.0000."""
    line = F.col("l_linenumber")
    value = F.when(line == 2, 1).otherwise(F.col("l_extendedprice")).cast(C.AMOUNT)
    amount = F.when(line == 1, "0.00004").when(line == 2, "0.33333").otherwise(quantity().cast("string"))
    price = X.unit_price(value, X.parse_number(amount))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", price.alias("preco"))


@query(
    "p17_not_null",
    "SELECT o_orderkey FROM orders WHERE o_orderkey % 50 <> 0 AND o_custkey % 9 <> 0",
)
def p17(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate")).alias("data"),
        F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey")).alias("comprador"),
    )
    return X.not_null(rows, "data", "comprador").select("o_orderkey")


_PRODUCT_STATS = FATO + f""",
e AS (SELECT l_partkey, {MEAN} AS media, STDDEV_SAMP(unidade / 1e4) AS desvio,
        MAX(unidade) / 1e4 AS maior, COUNT(*) AS n
      FROM fato WHERE unidade IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 5)
"""


def _product_stats(spark, sf):
    price = X.unit_price(F.col("l_extendedprice").cast(C.MONEY), quantity())
    rows = table(spark, sf, "lineitem").select("l_partkey", price.alias("preco"))
    return group_stats(rows, ["l_partkey"], "preco")


@query(
    "p18_column_threshold",
    _PRODUCT_STATS + "SELECT l_partkey, maior FROM e WHERE maior > media + 2 * desvio",
)
def p18(spark, sf):
    beyond = above_threshold(F.col("maior"), F.col("media"), F.col("desvio_padrao"), 2)
    return _product_stats(spark, sf).filter(beyond).select("l_partkey", "maior")


@query(
    "p19_zscore",
    _PRODUCT_STATS + """
SELECT l_partkey, CAST(ROUND(CAST((maior - media) / NULLIF(desvio, 0) AS DECIMAL(18,6)), 2) AS DOUBLE)
  AS escore FROM e""",
)
def p19(spark, sf):
    score = X.zscore(F.col("maior"), F.col("media"), F.col("desvio_padrao"))
    return _product_stats(spark, sf).select("l_partkey", score.alias("escore"))


@query(
    "p20_relabel_measure",
    FATO + """
SELECT descricao_item AS categoria_aproximada, SUM(centavos) / 100.0 AS valor_total
FROM fato JOIN produto ON l_partkey = p_partkey
GROUP BY 1 ORDER BY SUM(centavos) DESC NULLS FIRST, 1 LIMIT 50""",
)
def p20(spark, sf):
    return top_categories(star(spark, sf), k=50)


@query(
    "p21_parse_period",
    """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS compacto,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS barras FROM orders""",
)
def p21(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        X.parse_period(F.date_format("o_orderdate", "yyyyMMdd"), "compact").alias("compacto"),
        X.parse_period(F.date_format("o_orderdate", "dd/MM/yyyy"), "slashed").alias("barras"),
    )
