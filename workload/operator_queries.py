"""Keys, unions, joins, aggregates and rankings on the driver tables."""

from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.operators import aggregates as A
from tenderlake.operators import joins as J
from tenderlake.operators import keys as K
from tenderlake.operators import ranking as R
from tenderlake.plans.marts import price_outliers
from workload.adapters import FATO, MEAN, STATS, content_ord, star, table
from workload.registry import query


def _with_ord(df):
    return df.withColumn("_id", content_ord(df))


# Deduplication, keys and unions


@query(
    "d1_dedup_exact",
    """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey AS _row_ord,
  CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS copias FROM orders""",
    longs=("copias",),
)
def d1(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderkey").alias(C.ROW_ORD)
    )
    again = orders.filter("o_orderkey % 7 = 0").withColumn(C.ROW_ORD, F.col(C.ROW_ORD) + 10**9)
    return K.dedup_exact(again.unionByName(orders), copies="copias")


@query(
    "d2_first_by_key",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_extendedprice, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n = 1""",
    longs=("l_linenumber",),
)
def d2(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    order = F.struct("l_extendedprice", "l_partkey", "l_suppkey")
    return K.first_by_key(rows, ["l_orderkey", "l_linenumber"], order)


@query("d3_distinct_values", "SELECT DISTINCT p_name FROM part")
def d3(spark, sf):
    return K.distinct_values(table(spark, sf, "part"), "p_name")


@query(
    "e1_dense_key",
    """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS sk, o_orderkey FROM orders""",
)
def e1(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    keyed = K.assign_dense_key(rows, "sk", order=["o_orderdate", "o_orderkey"], key_type="bigint")
    return keyed.select("sk", "o_orderkey")


@query(
    "e2_dense_key_by_value",
    """
SELECT row_number() OVER (ORDER BY data) AS sk_tempo, CAST(data AS VARCHAR) AS data
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS data FROM orders)""",
)
def e2(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("data"))
    return K.assign_dense_key(K.distinct_values(days, "data"), "sk_tempo", order=["data"])


_GROWN = """
WITH antigos AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS sk
                 FROM customer WHERE c_custkey % 3 <> 0),
novos AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey)
            + (SELECT MAX(sk) FROM antigos) AS sk FROM customer WHERE c_custkey % 3 = 0)
SELECT sk, c_custkey FROM antigos UNION ALL SELECT sk, c_custkey FROM novos"""


def _grown(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    first = customers.filter("c_custkey % 3 <> 0")
    mapping = K.assign_dense_key(first, "sk", order=["c_custkey"], key_type="bigint")
    return mapping, K.get_or_create_key(mapping, customers, ["c_custkey"], "sk")


@query("e3_get_or_create_key", _GROWN)
def e3(spark, sf):
    return _grown(spark, sf)[1]


@query("i5_stable_keys", _GROWN)
def i5(spark, sf):
    """A second batch of known keys leaves the mapping as it was."""
    grown = _grown(spark, sf)[1]
    again = table(spark, sf, "customer").select("c_custkey").filter("c_custkey % 2 = 0")
    return K.get_or_create_key(grown, again, ["c_custkey"], "sk")


@query(
    "u1_union_periods",
    """
SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) % 2 = 0 THEN o_orderpriority END
  AS o_orderpriority FROM orders""",
)
def u1(spark, sf):
    """Odd years lack one column and order the others differently."""
    orders = table(spark, sf, "orders")
    even = orders.filter("year(o_orderdate) % 2 = 0")
    odd = orders.filter("year(o_orderdate) % 2 <> 0")
    return K.union_periods(
        [
            even.select("o_orderkey", "o_totalprice", "o_orderpriority"),
            odd.select("o_totalprice", "o_orderkey"),
        ]
    )


@query(
    "u2_union_first_by_code",
    """
SELECT codigo, nome FROM (
  SELECT codigo, nome, row_number() OVER (PARTITION BY codigo ORDER BY fonte, codigo) AS n FROM (
    SELECT c_custkey AS codigo, c_name AS nome, 0 AS fonte FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier WHERE s_suppkey % 5 <> 0)) WHERE n = 1""",
)
def u2(spark, sf):
    """Two renamed sources; the first one wins and missing codes drop out."""
    buyers = table(spark, sf, "customer").filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("codigo"), F.col("c_name").alias("nome"),
        F.col("c_custkey").alias(C.ROW_ORD),
    )
    code = F.when(F.col("s_suppkey") % 5 != 0, F.col("s_suppkey"))
    sellers = table(spark, sf, "supplier").select(
        code.alias("codigo"), F.col("s_name").alias("nome"), F.col("s_suppkey").alias(C.ROW_ORD)
    )
    both = K.union_ranked([buyers, sellers]).dropna(subset=["codigo"])
    return K.first_by_key(both, ["codigo"], C.ROW_ORD).drop(C.ROW_ORD)


@query(
    "u3_union_distinct",
    "SELECT p_name AS texto FROM part UNION SELECT p_brand FROM part UNION SELECT p_type FROM part",
)
def u3(spark, sf):
    part = table(spark, sf, "part")
    return K.union_distinct(
        [part.select(F.col(c).alias("texto")) for c in ("p_name", "p_brand", "p_type")]
    )


# Joins


def _kept_orders(spark, sf):
    return table(spark, sf, "orders").filter("o_orderkey % 10 <> 0")


@query(
    "j1_inner_with_orphans",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey,
  (SELECT COUNT(*) FROM lineitem WHERE l_orderkey % 10 = 0) AS orfaos
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 10 <> 0""",
    longs=("l_linenumber",),
)
def j1(spark, sf):
    lines = _with_ord(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    )
    kept = _kept_orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    matched, orphans = J.inner_with_orphans(lines, kept, ["l_orderkey"], ["o_custkey"], "_id")
    return matched.drop("_id").withColumn("orfaos", orphans.scalar())


@query(
    "j2_lookup_single_key",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 3 <> 0 THEN s_suppkey * 10 END AS sk
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    longs=("l_linenumber",),
)
def j2(spark, sf):
    """A third of the suppliers is not in the dimension: their lines keep a null key."""
    dim = table(spark, sf, "supplier").filter("s_suppkey % 3 <> 0").select(
        "s_suppkey", (F.col("s_suppkey") * 10).alias("sk")
    )
    lines = _with_ord(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"))
    return J.lookup_key(lines, dim, [("l_suppkey", "s_suppkey")], "sk", spread_by="_id").select(
        "l_orderkey", "l_linenumber", "sk"
    )


@query(
    "j2_lookup_spread_over_tasks",
    "SELECT l_orderkey, l_linenumber, l_suppkey + 1 AS sk FROM lineitem",
    longs=("l_linenumber",),
)
def j2_spread(spark, sf):
    """The shuffled form, with every supplier treated as too large for one task."""
    dim = table(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") + 1).alias("sk"))
    lines = _with_ord(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"))
    return J.lookup_key(
        lines, dim, [("l_suppkey", "s_suppkey")], "sk",
        spread_by="_id", rows_per_task=100, broadcast_bytes=0,
    ).select("l_orderkey", "l_linenumber", "sk")


@query(
    "j3_lookup_composite_key",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey + 1 END AS sk
FROM lineitem""",
    longs=("l_linenumber",),
)
def j3(spark, sf):
    """Three-part key in which one part may be missing on both sides."""
    part_3 = F.when(F.col("o_custkey") % 4 != 0, F.col("o_orderpriority"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", part_3.alias("modalidade"))
    dim = orders.filter("o_orderkey % 10 <> 0").select(
        F.col("o_orderkey").alias("numero"), F.col("o_custkey").alias("ug"), "modalidade",
        (F.col("o_orderkey") + 1).alias("sk"),
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    fact = _with_ord(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    on = [("o_orderkey", "numero"), ("o_custkey", "ug"), ("modalidade", "modalidade")]
    return J.lookup_key(fact, dim, on, "sk", null_safe=True, spread_by="_id").select(
        "l_orderkey", "l_linenumber", "sk"
    )


@query(
    "j4_lookup_null_safe",
    """
WITH textos AS (SELECT DISTINCT CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS texto FROM part),
dim AS (SELECT texto, row_number() OVER (ORDER BY texto NULLS FIRST) AS sk FROM textos)
SELECT l_orderkey, l_linenumber, sk FROM lineitem JOIN part ON l_partkey = p_partkey
LEFT JOIN dim ON texto IS NOT DISTINCT FROM (CASE WHEN p_partkey % 9 <> 0 THEN p_name END)""",
    longs=("l_linenumber",),
)
def j4(spark, sf):
    words = F.when(F.col("p_partkey") % 9 != 0, F.col("p_name"))
    part = table(spark, sf, "part").select("p_partkey", words.alias("texto"))
    dim = K.assign_dense_key(part.select("texto").distinct(), "sk", order=["texto"])
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    fact = _with_ord(lines.join(part, F.col("l_partkey") == F.col("p_partkey")))
    return J.lookup_key(
        fact, dim, [("texto", "texto")], "sk", null_safe=True, spread_by="_id"
    ).select("l_orderkey", "l_linenumber", "sk")


@query(
    "j5_inner_star_join",
    FATO + """
SELECT uf, tipo_documento, year(data) AS ano, SUM(centavos) / 100.0 AS valor_total, COUNT(*) AS itens
FROM fato JOIN orgao ON o_custkey = c_custkey JOIN fornecedor ON l_suppkey = s_suppkey
WHERE data IS NOT NULL GROUP BY 1, 2, 3""",
)
def j5(spark, sf):
    s = star(spark, sf)
    dims = [
        (s.dim_orgao, "sk_orgao"), (s.dim_fornecedor, "sk_fornecedor"), (s.dim_tempo, "sk_tempo")
    ]
    return A.sum_count_by_attributes(
        s.fato_item_licitacao, dims, ["uf", "tipo_documento", "ano"], "valor_item", count="itens"
    )


@query(
    "j6_left_star_join",
    FATO + """
SELECT year(data) AS ano, COUNT(*) AS itens, SUM(centavos) / 100.0 AS valor_total
FROM fato GROUP BY 1""",
)
def j6(spark, sf):
    s = star(spark, sf)
    by_day = A.sum_count_by(s.fato_item_licitacao, ["sk_tempo"], "valor_item", count="itens")
    dated = by_day.join(s.dim_tempo, "sk_tempo", "left")
    return dated.groupBy("ano").agg(
        F.sum("itens").alias("itens"), F.sum("valor_total").alias("valor_total")
    )


@query(
    "j7_join_own_statistics",
    STATS + """
SELECT CAST(l_partkey AS VARCHAR) AS produto, unidade / 1e4 AS preco, media, desvios FROM anomalia""",
)
def j7(spark, sf):
    s = star(spark, sf)
    rows = price_outliers(s).join(s.dim_produto, "sk_produto")
    return rows.select(
        F.element_at(F.split("descricao_item", " "), -1).alias("produto"),
        F.col("valor_unitario_item").alias("preco"),
        F.col("preco_medio_produto").alias("media"),
        F.col("desvios_acima_da_media").alias("desvios"),
    )


@query(
    "j7_join_own_statistics_spread",
    """
WITH e AS (SELECT c_nationkey AS k, AVG(c_acctbal) AS m, STDDEV_SAMP(c_acctbal) AS s
           FROM customer GROUP BY 1 HAVING COUNT(*) >= 5)
SELECT c_custkey FROM customer JOIN e ON c_nationkey = k WHERE c_acctbal > m + 1.5 * s""",
)
def j7_spread(spark, sf):
    """The shuffled form, with every group treated as too large for one task."""
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").cast(C.MONEY).alias("saldo")
    )
    return A.flag_outliers(
        rows, "c_nationkey", "saldo", "c_custkey", sigmas=1.5, rows_per_task=10
    ).select("c_custkey")


@query(
    "j8_join_by_natural_key",
    """
SELECT o_orderkey, o_orderstatus, n_name FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 9 <> 0""",
)
def j8(spark, sf):
    s = star(spark, sf)
    units = s.dim_orgao.filter("uf IS NOT NULL").select("codigo_ug", "municipio")
    return s.dim_licitacao.join(units, "codigo_ug").select(
        F.col("numero_licitacao").cast("long").alias("o_orderkey"),
        F.col("situacao_licitacao").alias("o_orderstatus"),
        F.col("municipio").alias("n_name"),
    )


# Aggregates


@query(
    "a1_sum_count",
    """
SELECT l_returnflag, l_linestatus, l_linenumber,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS valor_total, COUNT(*) AS linhas
FROM lineitem GROUP BY 1, 2, 3""",
    longs=("l_linenumber",),
)
def a1(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("valor", F.col("l_extendedprice").cast(C.MONEY))
    return A.sum_count_by(
        rows, ["l_returnflag", "l_linestatus", "l_linenumber"], "valor", count="linhas"
    )


@query("a2_global_mean", FATO + f"SELECT {MEAN} AS media FROM fato")
def a2(spark, sf):
    return A.mean_of(star(spark, sf).fato_item_licitacao, "valor_unitario_item", "media")


@query(
    "a3_group_stats",
    FATO + f"""
SELECT CAST(l_partkey AS VARCHAR) AS produto, {MEAN} AS media,
  CAST(CAST(STDDEV_SAMP(unidade / 1e4) AS DECIMAL(18,4)) AS DOUBLE) AS desvio_padrao, COUNT(*) AS n
FROM fato WHERE unidade IS NOT NULL GROUP BY l_partkey HAVING COUNT(*) >= 25""",
)
def a3(spark, sf):
    s = star(spark, sf)
    stats = A.group_stats(s.fato_item_licitacao, ["sk_produto"], "valor_unitario_item", 25)
    return stats.join(s.dim_produto, "sk_produto").select(
        F.element_at(F.split("descricao_item", " "), -1).alias("produto"),
        "media",
        F.col("desvio_padrao").cast("decimal(18,4)").alias("desvio_padrao"),
        F.col("quantidade_ocorrencias").alias("n"),
    )


@query(
    "a4_count_distinct",
    """
SELECT l_partkey, COUNT(DISTINCT CASE WHEN l_suppkey % 40 <> 0 THEN l_suppkey END) AS fornecedores
FROM lineitem GROUP BY 1""",
)
def a4(spark, sf):
    bidder = F.when(F.col("l_suppkey") % 40 != 0, F.col("l_suppkey"))
    rows = table(spark, sf, "lineitem").select("l_partkey", bidder.alias("fornecedor"))
    return A.distinct_by(rows, ["l_partkey"], "fornecedor", "fornecedores")


@query(
    "a5_attribute_drift",
    """
SELECT o_custkey, COUNT(DISTINCT o_orderpriority) AS valores FROM orders
WHERE o_orderkey % 3 <> 0 GROUP BY 1 HAVING COUNT(DISTINCT o_orderpriority) > 1""",
)
def a5(spark, sf):
    name = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    rows = table(spark, sf, "orders").select("o_custkey", name.alias("nome"))
    return A.attribute_drift(rows, "o_custkey", "nome", "valores")


@query(
    "a6_count_where",
    """
SELECT COUNT(*) FILTER (c_acctbal < 0) AS negativos, COUNT(*) FILTER (c_nationkey = 3) AS nacao_3,
  COUNT(*) FILTER (c_mktsegment IS NULL) AS sem_segmento FROM customer""",
)
def a6(spark, sf):
    return A.count_where(
        table(spark, sf, "customer"),
        {
            "negativos": F.col("c_acctbal") < 0,
            "nacao_3": F.col("c_nationkey") == 3,
            "sem_segmento": F.col("c_mktsegment").isNull(),
        },
    )


# Rankings


def _totals(spark, sf):
    """Totals per buyer; buyers divisible by 100 have none."""
    known = F.when(F.col("o_custkey") % 100 != 0, F.col("o_totalprice").cast(C.TENDER_MONEY))
    rows = table(spark, sf, "orders").select("o_custkey", known.alias("valor"))
    return A.sum_count_by(rows, ["o_custkey"], "valor")


_TOTALS = """
SELECT o_custkey, CAST(SUM(CASE WHEN o_custkey % 100 <> 0 THEN
  CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS valor_total FROM orders GROUP BY 1"""


@query("t1_top_k", _TOTALS + " ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 30")
def t1(spark, sf):
    return R.top_k(_totals(spark, sf), 30, "valor_total", ["o_custkey"])


@query("t2_full_ranking", _TOTALS)
def t2(spark, sf):
    return R.rank_all(_totals(spark, sf), "valor_total", ["o_custkey"])


_MONTHS = """
SELECT year(o_orderdate) AS ano, month(o_orderdate) AS mes, COUNT(*) AS n FROM orders GROUP BY 1, 2"""


@query("t3_order_by_period", _MONTHS)
def t3(spark, sf):
    months = table(spark, sf, "orders").groupBy(
        F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes")
    )
    return R.order_by_period(months.agg(F.count(F.lit(1)).alias("n")))


@query(
    "t4_sorted_unique_dates",
    "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data FROM orders",
)
def t4(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("data"))
    return R.order_by_period(K.distinct_values(days, "data"), "data")
