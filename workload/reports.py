"""Business questions, the anomaly view and the report pages."""

from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.operators.aggregates import distinct_by
from tenderlake.operators.states import merge_sketches, presence_states, sketch_states
from tenderlake.plans import marts as M
from tenderlake.plans.anomalies import read_outliers, update_outliers
from tenderlake.plans.versions import Part, publish_parts
from tenderlake.session import PACKED, new_folder, staged
from workload.adapters import FATO, MEAN, STATS, star, table
from workload.registry import query

_TOP_PRODUCTS = FATO + """
SELECT descricao_item, SUM(centavos) / 100.0 AS valor_total, COUNT(*) AS quantidade_itens
FROM fato JOIN produto ON l_partkey = p_partkey
GROUP BY 1 ORDER BY SUM(centavos) DESC NULLS FIRST, 1 LIMIT 10"""

_TOP_SUPPLIERS = FATO + """
SELECT nome_fornecedor, codigo_fornecedor, tipo_documento, SUM(centavos) / 100.0 AS valor_total
FROM fato JOIN fornecedor ON l_suppkey = s_suppkey
GROUP BY 1, 2, 3 ORDER BY SUM(centavos) DESC NULLS FIRST, 2 LIMIT 10"""

_BY_STATE = FATO + """
SELECT uf, SUM(centavos) / 100.0 AS valor_total
FROM fato JOIN orgao ON o_custkey = c_custkey WHERE uf IS NOT NULL GROUP BY 1"""

_ANOMALY_ROWS = """
SELECT nome_fornecedor, descricao_item, unidade / 1e4 AS valor_unitario_item,
       media AS preco_medio_produto, desvios AS desvios_acima_da_media
FROM anomalia JOIN fornecedor ON l_suppkey = s_suppkey JOIN produto ON l_partkey = p_partkey"""


@query("q1_top_products", _TOP_PRODUCTS)
def q1(spark, sf):
    return M.top_products(star(spark, sf))


@query("q2_top_suppliers", _TOP_SUPPLIERS)
def q2(spark, sf):
    return M.top_suppliers(star(spark, sf))


@query("q3_value_by_state", _BY_STATE)
def q3(spark, sf):
    return M.value_by_state(star(spark, sf))


@query(
    "q4_value_by_month",
    FATO + """
SELECT CAST(year(data) AS BIGINT) AS ano, CAST(month(data) AS BIGINT) AS mes,
  ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro',
   'Novembro','Dezembro'][month(data)] AS nome_mes,
  SUM(centavos) / 100.0 AS valor_total, COUNT(*) AS quantidade_itens
FROM fato WHERE data IS NOT NULL GROUP BY 1, 2, 3""",
)
def q4(spark, sf):
    return M.value_by_month(star(spark, sf))


@query("q5a_mean_price", FATO + f"SELECT {MEAN} AS preco_medio_geral FROM fato")
def q5a(spark, sf):
    return M.mean_price(star(spark, sf))


@query(
    "q5b_price_stats",
    FATO + f"""
SELECT descricao_item, COUNT(*) AS quantidade_ocorrencias, {MEAN} AS preco_medio,
       CAST(CAST(STDDEV_SAMP(unidade / 1e4) AS DECIMAL(18,4)) AS DOUBLE) AS desvio_padrao
FROM fato JOIN produto ON l_partkey = p_partkey WHERE unidade IS NOT NULL
GROUP BY 1 HAVING COUNT(*) >= 5 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def q5b(spark, sf):
    stats = M.price_stats(star(spark, sf))
    return stats.withColumn("desvio_padrao", stats.desvio_padrao.cast("decimal(18,4)"))


@query(
    "q6_top_agencies",
    FATO + """
SELECT nome_orgao, nome_orgao_superior, uf, SUM(centavos) / 100.0 AS valor_total
FROM fato JOIN orgao ON o_custkey = c_custkey GROUP BY 1, 2, 3
ORDER BY SUM(centavos) DESC NULLS FIRST, 1, 2, 3 LIMIT 10""",
)
def q6(spark, sf):
    return M.top_agencies(star(spark, sf))


@query(
    "q7_top_categories",
    FATO + """
SELECT descricao_item AS categoria_aproximada, SUM(centavos) / 100.0 AS valor_total
FROM fato JOIN produto ON l_partkey = p_partkey
GROUP BY 1 ORDER BY SUM(centavos) DESC NULLS FIRST, 1 LIMIT 10""",
)
def q7(spark, sf):
    return M.top_categories(star(spark, sf))


@query(
    "q8_overpriced_suppliers",
    STATS + _ANOMALY_ROWS + """
ORDER BY desvios DESC NULLS FIRST, unidade DESC, l_orderkey LIMIT 30""",
)
def q8(spark, sf):
    return M.overpriced_suppliers(star(spark, sf))


@query(
    "q9_bidders_by_state",
    FATO + """
SELECT uf, COUNT(DISTINCT CASE WHEN l_suppkey % 40 <> 0 THEN l_suppkey END)
         AS quantidade_fornecedores_distintos
FROM fato JOIN orgao ON o_custkey = c_custkey WHERE uf IS NOT NULL GROUP BY 1""",
)
def q9(spark, sf):
    return M.bidders_by_state(star(spark, sf))


@query(
    "q10_price_anomalies",
    STATS + """
SELECT CAST(data AS VARCHAR) AS data, nome_orgao, uf, nome_fornecedor, descricao_item,
       unidade / 1e4 AS valor_unitario_item, media AS preco_medio_produto,
       desvios AS desvios_acima_da_media
FROM anomalia JOIN fornecedor ON l_suppkey = s_suppkey JOIN produto ON l_partkey = p_partkey
  JOIN orgao ON o_custkey = c_custkey
ORDER BY desvios DESC NULLS FIRST, unidade DESC, l_orderkey LIMIT 20""",
)
def q10(spark, sf):
    return M.price_anomalies(star(spark, sf))


@query("v1_anomaly_view", STATS + _ANOMALY_ROWS)
def v1(spark, sf):
    return M.anomaly_view(star(spark, sf))


@query("v1_view_kept_by_period", STATS + _ANOMALY_ROWS)
def v1_kept(spark, sf):
    """Three periods; one of them loses half its rows, and gets them back. After each step only what changed is judged again."""
    warehouse, root = new_folder(spark, "warehouse"), new_folder(spark, "anomalias")
    fact, key = star(spark, sf).fato_item_licitacao, F.col("sk_fato_item")

    def written(name, rows):
        path = f"{warehouse}/{name}"
        rows.write.options(**PACKED).parquet(path)
        return path

    paths = {str(k): written(str(k), fact.filter(key % 3 == k)) for k in range(3)}
    half = written("metade", fact.filter((key % 3 == 1) & (F.col("sk_produto") % 2 == 0)))
    for turn, change in enumerate(({}, {"1": half}, {})):
        parts = [Part(C.FATO_ITEM.name, p, period) for period, p in (paths | change).items()]
        publish_parts(spark, warehouse, str(turn), parts)
        done = update_outliers(spark, warehouse, root)
        if done != (["1"] if turn else ["0", "1", "2"]) or update_outliers(spark, warehouse, root):
            raise AssertionError(f"computed anew: {done}")
    return M.anomaly_view(star(spark, sf), outliers=read_outliers(spark, root))


@query(
    "a4_distinct_from_states",
    """
SELECT month(o_orderdate) AS mes, COUNT(DISTINCT o_custkey) AS exatos, true AS estimativa_perto FROM orders GROUP BY 1""",
)
def a4_states(spark, sf):
    """Buyers per month of the year, from what was kept for each single month; estimates within five per cent."""
    orders = table(spark, sf, "orders").withColumns({"mes": F.month("o_orderdate"), "ano": F.year("o_orderdate")})
    present = staged(presence_states(orders, ["ano", "mes"], "o_custkey"))
    exact = distinct_by(present, ["mes"], "o_custkey", "exatos")
    estimated = merge_sketches(staged(sketch_states(orders, ["ano", "mes"], "o_custkey")), ["mes"], "estimados")
    near = (F.abs(F.col("estimados") - F.col("exatos")) <= 0.05 * F.col("exatos")).alias("estimativa_perto")
    return exact.join(estimated, "mes").select("mes", "exatos", near)


@query("k7_published_view", STATS + _ANOMALY_ROWS)
def k7(spark, sf):
    M.publish_views(spark, star(spark, sf))
    return spark.sql(f"SELECT * FROM {M.ANOMALY_VIEW}")


_KPIS = FATO + f"""
SELECT SUM(centavos) / 100.0 AS valor_total, {MEAN} AS preco_medio_unitario,
       COUNT(DISTINCT l_partkey) AS quantidade_produtos,
       COUNT(DISTINCT l_suppkey) AS quantidade_fornecedores,
       TENDERS AS quantidade_licitacoes
FROM fato"""


@query("r1_kpis", _KPIS.replace("TENDERS", "(SELECT COUNT(*) FROM orders)"))
def r1(spark, sf):
    return M.kpis(star(spark, sf))


@query("a7_kpis_counted_in_fact", _KPIS.replace("TENDERS", "COUNT(DISTINCT l_orderkey)"))
def a7(spark, sf):
    return M.kpis(star(spark, sf), counted_in="fact")


@query(
    "r2_value_by_day",
    FATO + """
SELECT CAST(data AS VARCHAR) AS data, SUM(centavos) / 100.0 AS valor_total
FROM fato WHERE data IS NOT NULL GROUP BY 1""",
)
def r2(spark, sf):
    return M.value_by_day(star(spark, sf))


@query("r3_value_by_state", _BY_STATE)
def r3(spark, sf):
    return M.value_by_state(star(spark, sf))


@query("r4_top_suppliers", _TOP_SUPPLIERS)
def r4_suppliers(spark, sf):
    return M.top_suppliers(star(spark, sf))


@query("r4_top_products", _TOP_PRODUCTS)
def r4_products(spark, sf):
    return M.top_products(star(spark, sf))


_LOOKUP = FATO + """
SELECT descricao_item, nome_fornecedor, unidade / 1e4 AS valor_unitario_item
FROM fato JOIN fornecedor ON l_suppkey = s_suppkey JOIN produto ON l_partkey = p_partkey"""


@query("r5_price_lookup", _LOOKUP)
def r5(spark, sf):
    return M.price_lookup(star(spark, sf))


@query("r5_price_lookup_one_supplier", _LOOKUP + " WHERE nome_fornecedor = 'Supplier#000000003'")
def r5_filtered(spark, sf):
    return M.price_lookup(star(spark, sf), supplier="Supplier#000000003")


@query("r6_anomaly_table", STATS + _ANOMALY_ROWS)
def r6(spark, sf):
    return M.anomaly_view(star(spark, sf))
