"""Business questions and report pages over a published star.

Facts are reduced by surrogate key before they meet a dimension, so joins and their skew
are those of dimension-sized data. A published star has passed the contract checks; the
top-k anomaly reports rely on that and look names up after the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators.aggregates import distinct_by, flag_outliers, mean_of, sum_count_by_attributes
from tenderlake.operators.checks import reconcile
from tenderlake.operators.joins import hot_keys, lookup, measured_bytes
from tenderlake.operators.ranking import order_by_period, rank_all, top_k
from tenderlake.plans.gold import Star

ANOMALY_VIEW = "vw_anomalias_preco"

_FEW = 10_000

_ANOMALY = (
    "nome_fornecedor", "descricao_item", "valor_unitario_item", "preco_medio_produto",
    "desvios_acima_da_media",
)


def _value_by(
    star: Star, dim: DataFrame, sk: str, keys: Sequence[str], count: str | None = None
) -> DataFrame:
    fact = star.fato_item_licitacao.select(sk, "valor_item")
    return sum_count_by_attributes(fact, [(dim, sk)], keys, "valor_item", count=count)


def top_products(star: Star, k: int = 10) -> DataFrame:
    by = _value_by(star, star.dim_produto, "sk_produto", ["descricao_item"], "quantidade_itens")
    return top_k(by, k, "valor_total", ["descricao_item"])


def top_suppliers(star: Star, k: int = 10) -> DataFrame:
    keys = ["nome_fornecedor", "codigo_fornecedor", "tipo_documento"]
    by = _value_by(star, star.dim_fornecedor, "sk_fornecedor", keys)
    return top_k(by, k, "valor_total", ["codigo_fornecedor"])


def value_by_state(star: Star) -> DataFrame:
    known = star.dim_orgao.filter("uf IS NOT NULL")
    return rank_all(_value_by(star, known, "sk_orgao", ["uf"]), "valor_total", ["uf"])


def value_by_month(star: Star) -> DataFrame:
    keys = ["ano", "mes", "nome_mes"]
    return order_by_period(_value_by(star, star.dim_tempo, "sk_tempo", keys, "quantidade_itens"))


def value_by_day(star: Star) -> DataFrame:
    return order_by_period(_value_by(star, star.dim_tempo, "sk_tempo", ["data"]), "data")


def mean_price(star: Star) -> DataFrame:
    return mean_of(star.fato_item_licitacao, "valor_unitario_item", "preco_medio_geral")


def price_stats(star: Star, min_count: int = 5, k: int = 20) -> DataFrame:
    """Mean and deviation of the unit price per product text, most frequent first.

    Moments are taken per surrogate key and merged per text: the squares within each key
    plus those of the keys' means around the common mean (zero where a text has one key).
    """
    price = F.col("valor_unitario_item")
    moments = (
        star.fato_item_licitacao.filter(price.isNotNull())
        .groupBy("sk_produto")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(price).alias("s"),
            F.var_pop(price.cast("double")).alias("v"),
        )
        .join(star.dim_produto, "sk_produto")
        .select("descricao_item", "n", "s", "v")
    )
    whole = moments.groupBy("descricao_item").agg(
        F.sum("n").alias("quantidade_ocorrencias"), F.sum("s").alias("soma")
    ).filter(F.col("quantidade_ocorrencias") >= min_count)
    own_mean = F.col("s").cast("double") / F.col("n")
    mean = F.col("soma").cast("double") / F.col("quantidade_ocorrencias")
    squares = F.sum(F.col("n") * (F.col("v") + F.pow(own_mean - mean, F.lit(2.0))))
    merged = lookup(
        moments, whole, [("descricao_item",) * 2], ["quantidade_ocorrencias", "soma"], "inner",
        null_safe=True, dim_bytes=measured_bytes(star.dim_produto),
    ).groupBy("descricao_item", "quantidade_ocorrencias", "soma").agg(squares.alias("q"))
    size = F.col("quantidade_ocorrencias")
    stats = merged.select(
        "descricao_item",
        size,
        (F.col("soma").cast("decimal(28,4)") / size).cast("decimal(22,8)").alias("preco_medio"),
        F.sqrt(F.col("q") / F.nullif(size - 1, F.lit(0))).alias("desvio_padrao"),
    )
    return top_k(stats, k, "quantidade_ocorrencias", ["descricao_item"])


def top_agencies(star: Star, k: int = 10) -> DataFrame:
    keys = ["nome_orgao", "nome_orgao_superior", "uf"]
    return top_k(_value_by(star, star.dim_orgao, "sk_orgao", keys), k, "valor_total", keys)


def top_categories(star: Star, k: int = 10) -> DataFrame:
    """The source has no catalogue of categories; the product text stands in for it."""
    return top_products(star, k).select(
        F.col("descricao_item").alias("categoria_aproximada"), "valor_total"
    )


def price_outliers(star: Star, sigmas: float = 2, min_count: int = 5) -> DataFrame:
    """Fact rows priced far above their product's mean, with mean and score."""
    fact = star.fato_item_licitacao.select(
        "sk_fato_item", "sk_tempo", "sk_orgao", "sk_fornecedor", "sk_produto", "sk_licitacao",
        "valor_unitario_item",
    )
    return flag_outliers(
        fact, "sk_produto", "valor_unitario_item", "sk_fato_item", sigmas, min_count,
        groups=star.dim_produto.count(),
    ).withColumnRenamed("media", "preco_medio_produto")


def _most_extreme(rows: DataFrame, k: int) -> DataFrame:
    order = ("desvios_acima_da_media", "valor_unitario_item")
    ties = ("sk_licitacao", "sk_fato_item")
    return rows.orderBy(
        *[F.col(c).desc_nulls_first() for c in order], *[F.col(c).asc_nulls_first() for c in ties]
    ).limit(k)


def _named(rows: DataFrame, k: int, dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Look up names of at most ``k`` rows: the rows go to the dimensions, not the reverse."""
    for dim, sk in dims:
        rows = (F.broadcast(rows) if k <= _FEW else rows).join(dim, sk)
    return rows


def overpriced_suppliers(
    star: Star, sigmas: float = 2, min_count: int = 5, k: int = 30
) -> DataFrame:
    """The k most extreme prices with supplier and product."""
    rows = price_outliers(star, sigmas, min_count).filter("sk_fornecedor IS NOT NULL")
    named = _named(
        _most_extreme(rows, k),
        k,
        [(star.dim_fornecedor, "sk_fornecedor"), (star.dim_produto, "sk_produto")],
    )
    return _most_extreme(named, k).select(*_ANOMALY)


def price_anomalies(star: Star, sigmas: float = 2, min_count: int = 5, k: int = 20) -> DataFrame:
    """The k most extreme prices with date (if known), agency, supplier and product."""
    rows = price_outliers(star, sigmas, min_count).filter(
        "sk_fornecedor IS NOT NULL AND sk_orgao IS NOT NULL"
    )
    named = _named(
        _most_extreme(rows, k),
        k,
        [
            (star.dim_fornecedor, "sk_fornecedor"),
            (star.dim_produto, "sk_produto"),
            (star.dim_orgao, "sk_orgao"),
        ],
    )
    dated = named.join(star.dim_tempo, "sk_tempo", "left")
    return _most_extreme(dated, k).select("data", "nome_orgao", "uf", *_ANOMALY)


def _with_names(star: Star, rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Inner joins with supplier and product; rows of a hot supplier or product are spread."""
    for key, name in (("sk_fornecedor", "nome_fornecedor"), ("sk_produto", "descricao_item")):
        hot = hot_keys(star.fato_item_licitacao, [key])
        rows = lookup(
            rows, dims[key], [(key, key)], [name], "inner", spread_by="sk_fato_item", hot=hot
        )
    return rows


def anomaly_view(star: Star, sigmas: float = 2, min_count: int = 5, outliers: DataFrame | None = None) -> DataFrame:
    """All anomalies with supplier and product, most extreme first; ``outliers`` are those kept up to date, if any."""
    dims = {"sk_fornecedor": star.dim_fornecedor, "sk_produto": star.dim_produto}
    found = price_outliers(star, sigmas, min_count) if outliers is None else outliers
    rows = _with_names(star, found, dims).select(*_ANOMALY)
    return rank_all(
        rows, "desvios_acima_da_media", ["descricao_item", "nome_fornecedor", "valor_unitario_item"]
    )


def bidders_by_state(star: Star) -> DataFrame:
    """Distinct bidders per state of the buying unit, winners or not.

    Repeated bids of one supplier in one tender collapse before the join, so a huge tender
    brings at most one row per supplier.
    """
    states = star.dim_orgao.filter("uf IS NOT NULL")
    tenders = lookup(
        star.dim_licitacao.select("sk_licitacao", "codigo_ug"), states,
        [("codigo_ug", "codigo_ug")], ["uf"], "inner", spread_by="sk_licitacao",
    )
    pairs = star.fato_participacao.select("sk_licitacao", "sk_fornecedor").distinct()
    pairs = pairs.withColumn("_id", F.xxhash64("sk_licitacao", "sk_fornecedor"))
    placed = lookup(
        pairs, tenders, [("sk_licitacao", "sk_licitacao")], ["uf"], "inner", spread_by="_id",
        dim_bytes=measured_bytes(star.dim_licitacao.select("sk_licitacao", "codigo_ug")),
    )
    name = "quantidade_fornecedores_distintos"
    return rank_all(distinct_by(placed, ["uf"], "sk_fornecedor", name), name, ["uf"])


def kpis(star: Star, counted_in: str = "dimension") -> DataFrame:
    """Total value, mean unit price and the numbers of products, suppliers and tenders.

    Products, suppliers and tenders are counted as dimension rows, or, with
    ``counted_in="fact"``, as distinct keys of the item fact.
    """
    fact = star.fato_item_licitacao
    money = [
        F.sum("valor_item").alias("valor_total"),
        F.avg("valor_unitario_item").alias("preco_medio_unitario"),
    ]
    counted = {
        "quantidade_produtos": (star.dim_produto, "sk_produto"),
        "quantidade_fornecedores": (star.dim_fornecedor, "sk_fornecedor"),
        "quantidade_licitacoes": (star.dim_licitacao, "sk_licitacao"),
    }
    if counted_in == "fact":
        sizes = [
            fact.select(sk).dropna().distinct().agg(F.count(F.lit(1))).scalar().alias(name)
            for name, (_, sk) in counted.items()
        ]
    else:
        sizes = [dim.agg(F.count(F.lit(1))).scalar().alias(n) for n, (dim, _) in counted.items()]
    return fact.agg(*money).select("valor_total", "preco_medio_unitario", *sizes)


def price_lookup(star: Star, product: str | None = None, supplier: str | None = None) -> DataFrame:
    """Unit price of every purchase, optionally of one product or supplier."""
    products, suppliers = star.dim_produto, star.dim_fornecedor
    if product is not None:
        products = products.filter(F.col("descricao_item") == product)
    if supplier is not None:
        suppliers = suppliers.filter(F.col("nome_fornecedor") == supplier)
    rows = star.fato_item_licitacao.select(
        "sk_fato_item", "sk_produto", "sk_fornecedor", "valor_unitario_item"
    )
    dims = {"sk_fornecedor": suppliers, "sk_produto": products}
    return _with_names(star, rows, dims).select(
        "descricao_item", "nome_fornecedor", "valor_unitario_item"
    )


def reconcile_months(star: Star) -> DataFrame:
    """Monthly values plus undated ones against the total of the report's first card."""
    undated = star.fato_item_licitacao.filter("sk_tempo IS NULL").agg(
        F.sum("valor_item").alias("valor_total")
    )
    parts = value_by_month(star).select("valor_total").unionByName(undated)
    return reconcile(parts, kpis(star).select("valor_total"), ["valor_total"])


def publish_views(spark: SparkSession, star: Star) -> None:
    """Make the tables and the one definition of a price anomaly available to SQL users."""
    for name, table in star.tables().items():
        table.createOrReplaceTempView(name)
    anomaly_view(star).createOrReplaceTempView(ANOMALY_VIEW)
