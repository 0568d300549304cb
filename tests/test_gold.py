"""Dimensions and facts."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.functions import columns as X
from tenderlake.operators.checks import check_contract
from tenderlake.operators.keys import first_by_key
from tenderlake.plans import gold as G
from tenderlake.plans.publish import conform_all

TENDER_SCHEMA = (
    "`Número Licitação` string, `Código UG` string, `Código Modalidade Compra` string, `Nome UG` string, "
    f"`Data Resultado Compra` date, `UF` string, {C.ROW_ORD} long"
)
ITEM_SCHEMA = (
    "`Número Licitação` string, `Código UG` string, `Código Modalidade Compra` string, `Descrição` string, "
    "`Código Vencedor` string, `Nome Vencedor` string, tipo_documento_vencedor string, "
    f"`Quantidade Item` decimal(18,4), `Valor Item` decimal(18,4), {C.ROW_ORD} long"
)
BID_SCHEMA = (
    "`Número Licitação` string, `Código UG` string, `Código Modalidade Compra` string, "
    "`Descrição Item Compra` string, `Código Participante` string, `Nome Participante` string, "
    f"flag_vencedor boolean, {C.ROW_ORD} long"
)
CNPJ, CPF = "1" * 14, "2" * 11
D1, D2 = date(2024, 1, 15), date(2024, 2, 20)


def tenders(spark, *data):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], TENDER_SCHEMA)
    blank = {
        c: F.lit(None).cast("string")
        for c in ("Número Processo", "Modalidade Compra", "Situação Licitação", "Objeto", "Município",
                  "Código Órgão", "Nome Órgão", "Código Órgão Superior", "Nome Órgão Superior")
    }
    return df.withColumns({**blank, "Valor Licitação": F.lit(1).cast(C.TENDER_MONEY)})


def items(spark, *data):
    full = [(*r[:7], Decimal(r[7]) if r[7] is not None else None, Decimal(r[8]), i) for i, r in enumerate(data)]
    return spark.createDataFrame(full, ITEM_SCHEMA)


def bids(spark, *data):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], BID_SCHEMA)


def item(number="1", unit="10", kind="5", text="caneta", code=CNPJ, name="ACME", doc="CNPJ", quantity="2", value="10"):
    return (number, unit, kind, text, code, name, doc, quantity, value)


def bid(number="1", unit="10", kind="5", text="caneta", code=CNPJ, name="ACME", won=True):
    return (number, unit, kind, text, code, name, won)


def tender(number="1", unit="10", kind="5", name="UG", day=D1, state="DF"):
    return (number, unit, kind, name, day, state)


def test_dates_are_distinct_and_numbered_in_order(spark):
    got = G.build_dim_date(tenders(spark, tender(day=D2), tender(day=D1), tender(day=D2), tender(day=None)))
    assert [(r.sk_tempo, r.data, r.nome_mes, r.trimestre) for r in got.orderBy("sk_tempo").collect()] == [
        (1, D1, "Janeiro", 1), (2, D2, "Fevereiro", 1),
    ]


def test_unit_keeps_its_first_name_and_reports_others(spark, rows):
    dim, drift = G.build_dim_unit(
        tenders(spark, tender(unit="20", name="B"), tender(name="A", state="SP"), tender(name="A2"))
    )
    assert [(r.sk_orgao, r.codigo_ug, r.nome_ug, r.uf) for r in dim.orderBy("sk_orgao").collect()] == [
        (1, "20", "B", "DF"), (2, "10", "A", "SP"),
    ]
    assert rows(drift) == [("10", 2)]


def test_reused_number_in_two_modalities_is_two_tenders(spark):
    got = G.build_dim_tender(tenders(spark, tender(kind="5"), tender(kind="6"), tender(kind="5")))
    assert [(r.sk_licitacao, r.codigo_modalidade_compra) for r in got.orderBy("sk_licitacao").collect()] == [
        (1, "5"), (2, "6"),
    ]


def test_suppliers_winners_first_and_missing_codes_out(spark):
    got = G.build_dim_supplier(
        items(spark, item(code="ESTRANG1", doc="OUTRO", name="Won"), item(code=None, doc="DESCONHECIDO")),
        bids(spark, bid(code="ESTRANG2"), bid(code="ESTRANG1", name="Bid"), bid(code=CPF), bid(code=None)),
    )
    assert [tuple(r) for r in got.orderBy("sk_fornecedor").collect()] == [
        (1, "ESTRANG1", "Won", "OUTRO"), (2, "ESTRANG2", "ACME", "ESTRANGEIRO"), (3, CPF, "ACME", "CPF"),
    ]


def test_products_of_both_sides(spark):
    got = G.build_dim_product(
        items(spark, item(text="lápis"), item(text="caneta azul")),
        bids(spark, bid(text="caneta  azul"), bid(text="lápis"), bid(text=None)),
    )
    assert [tuple(r) for r in got.orderBy("sk_produto").collect()] == [
        (1, "lápis"), (2, "caneta azul"), (3, "caneta  azul"), (4, None),
    ]


FORMS = [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "rows_per_task": 1}]


@pytest.mark.parametrize("form", FORMS)
def test_item_fact(spark, form):
    t = tenders(spark, tender(day=None, kind="6"), tender(kind="5"), tender("2", "20", day=D2), tender("3", None))
    won = items(
        spark, item(), item(quantity="0"), item("2", "20", code=None, quantity=None),
        item("9"), item("3", None, text="lápis", quantity="3"), item(kind="7"),
    )
    bid_rows = bids(spark, bid())
    dims = G.build_dimensions(t, won, bid_rows)
    fact, orphans = G.build_fact_item(won, t, dims, **form)
    got = {r[C.ROW_ORD]: r for r in fact.collect()}
    assert orphans.first()[0] == 1
    assert sorted(got) == [0, 1, 2, 4, 5]
    # The date follows the first tender of the number and unit, which has none.
    assert [got[i].sk_tempo for i in (0, 1, 5)] == [None, None, None]
    assert got[2].sk_tempo == 2
    assert (got[0].sk_licitacao, got[5].sk_licitacao) == (2, None)
    assert (got[4].sk_licitacao, got[4].sk_orgao) == (4, 3)
    assert (got[0].sk_fornecedor, got[2].sk_fornecedor) == (1, None)
    assert [got[i].valor_unitario_item for i in (0, 1, 2, 4)] == [Decimal(5), None, None, Decimal("3.3333")]
    exact, _ = G.build_fact_item(won, t, dims, date_key=3, **form)
    # By the full key the first item's tender has a date, and the unknown modality is an orphan.
    by_ord = {r[C.ROW_ORD]: r for r in exact.collect()}
    assert by_ord[0].sk_tempo == 1 and 5 not in by_ord


@pytest.mark.parametrize("form", FORMS)
def test_items_meet_context_and_tender_in_one_join(spark, form):
    """Tenders that share number and unit are told apart by mode, a missing mode included; a key held twice gives both."""
    t = tenders(spark, tender(kind="5"), tender(kind="6"), tender(kind=None))
    won = items(spark, item(kind="5"), item(kind="6"), item(kind=None), item(kind="7"))
    dims = G.build_dimensions(t, won, bids(spark, bid()))
    twice = dims["dim_licitacao"].filter("codigo_modalidade_compra = '6'")
    dims["dim_licitacao"] = dims["dim_licitacao"].unionByName(twice.withColumn("sk_licitacao", twice.sk_licitacao + 10))
    fact, _ = G.build_fact_item(won, t, dims, **form)
    got = sorted((r[C.ROW_ORD], r.sk_licitacao or 0) for r in fact.collect())
    assert got == [(0, 1), (1, 2), (1, 12), (2, 3), (3, 0)]
    if not form:
        assert fact._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2


@pytest.mark.parametrize("form", FORMS)
def test_bid_fact_keeps_unresolved_keys_null(spark, form):
    t = tenders(spark, tender())
    won = items(spark, item())
    bid_rows = bids(spark, bid(), bid(code=None, won=False), bid("9"), bid(text=None, won=False))
    dims = G.build_dimensions(t, won, bid_rows)
    got = {r[C.ROW_ORD]: r for r in G.build_fact_bid(bid_rows, dims, **form).collect()}
    assert len(got) == 4
    assert [got[i].sk_fornecedor for i in range(4)] == [1, None, 1, 1]
    assert [got[i].sk_licitacao for i in range(4)] == [1, 1, None, 1]
    # A missing description finds the product row of missing descriptions.
    assert got[3].sk_produto == 2


def test_consistent_data_gives_no_missing_key_and_meets_the_contract(spark):
    t = tenders(spark, tender(), tender("2"))
    won = items(spark, item(), item("2"))
    star = G.build_star(t, won, bids(spark, bid()))
    fact = star.fato_item_licitacao.orderBy("sk_fato_item").collect()
    assert [r.sk_fato_item for r in fact] == [1, 2]
    assert all(v is not None for r in fact for v in r)
    results = check_contract(conform_all(star.tables()), C.WAREHOUSE)
    assert results.filter("violacoes > 0").isEmpty()


def test_facts_numbered_as_loaded_have_no_gap(spark):
    won = items(spark, *[item(text=f"p{i}") for i in range(50)])
    star = G.build_star(tenders(spark, tender()), won.repartition(6), bids(spark, bid()))
    assert sorted(r[0] for r in star.fato_item_licitacao.select("sk_fato_item").collect()) == list(range(1, 51))


def test_repetitive_sources_pick_the_same_first_row(spark, rows):
    df = spark.createDataFrame(
        [("a", "x", 3), ("a", "y", 1), ("a", "x", 0), ("b", None, 9), (None, "n", 4)], "k string, v string, o long"
    )
    assert rows(first_by_key(df, ["k"], "o", repetitive=True)) == rows(first_by_key(df, ["k"], "o"))
    assert ("a", "x", 0) in rows(first_by_key(df, ["k"], "o", repetitive=True))


@pytest.mark.parametrize("partitions", [1, 7])
def test_star_does_not_depend_on_partitioning(spark, partitions, rows):
    data = [tender(str(i % 40), str(i % 9), str(i % 3), f"UG {i % 11}") for i in range(120)]
    won = [item(str(i % 45), str(i % 9), text=f"p{i % 13}", code=str(i % 17)) for i in range(200)]
    offered = [bid(str(i % 45), str(i % 9), text=f"p{i % 19}", code=str(i % 23)) for i in range(200)]

    def build(n):
        return G.build_star(
            tenders(spark, *data).repartition(n), items(spark, *won).repartition(n),
            bids(spark, *offered).repartition(n), ordered=True,
        )

    one, other = build(3), build(partitions)
    for name, table in one.tables().items():
        assert rows(table) == rows(other.tables()[name]), name


def test_unit_prices_are_not_staged_with_the_fact(spark):
    cells = "sk_tempo int, sk_orgao int, sk_fornecedor int, sk_produto int, sk_licitacao int, quantidade_item decimal(18,4), valor_item decimal(18,4)"
    data = [(1, 1, 1, 1, 1, Decimal(3), Decimal(10)), (1, 1, 1, 1, 1, Decimal(0), Decimal(10)), (1, 1, 1, 1, 1, None, Decimal(1))]
    fact = spark.createDataFrame(data, cells).withColumn("valor_unitario_item", X.unit_price(F.col("valor_item"), F.col("quantidade_item")))
    numbered = G.number_fact(fact.withColumn(C.ROW_ORD, F.lit(1)), C.FATO_ITEM)
    assert numbered.columns == list(C.FATO_ITEM.names) and numbered.schema["valor_unitario_item"].dataType == fact.schema["valor_unitario_item"].dataType
    scans = [s for s in numbered._jdf.queryExecution().analyzed().toString().splitlines() if "Relation" in s]
    assert scans and not any("valor_unitario_item" in s for s in scans)
    asked = ["valor_item", "quantidade_item", "valor_unitario_item"]
    assert sorted(map(str, numbered.select(asked).collect())) == sorted(map(str, fact.select(asked).collect()))
