"""Questions over a hand-computed miniature star."""

import dataclasses
from datetime import date
from decimal import Decimal
from random import Random

import pytest

from tenderlake import contracts as C
from tenderlake.operators.aggregates import distinct_by, group_stats
from tenderlake.operators.states import gathered_moments, merge_moments, merge_sketches, moment_states, presence_states, sketch_states
from tenderlake.plans import anomalies as A
from tenderlake.plans import marts as M
from tenderlake.plans import versions as V
from tenderlake.plans.gold import Star
from tenderlake.plans.publish import conform, read_tables

D = Decimal
JAN, FEB = date(2024, 1, 5), date(2024, 2, 6)


@pytest.fixture(scope="module")
def star(spark):
    """Products: 1 an outlier, 2 one constant price, 3 only four prices, 4 only unknown values,
    5 and 6 texts that differ in blanks with equal totals."""
    facts = []

    def add(product, value, quantity, day=1, unit=1, supplier=1, tender=1):
        value = None if value is None else D(value)
        price = None if value is None or quantity in (None, "0") else (value / D(quantity)).quantize(D("0.0001"))
        facts.append((len(facts) + 1, day, unit, supplier, product, tender, None if quantity is None else D(quantity), value, price))

    for _ in range(9):
        add(1, "10", "1", unit=1)
    add(1, "1000", "1", day=None, unit=3, supplier=2, tender=2)
    for _ in range(6):
        add(2, "0.3", "3", day=2, unit=2, supplier=2)
    for value in ("1", "1", "1", "900"):
        add(3, value, "1", day=2, unit=3, supplier=3, tender=2)
    add(4, None, "1", day=2, unit=2, supplier=None)
    add(4, None, None, day=2, unit=2, supplier=None)
    add(5, "50", "0", supplier=3)
    add(6, "50", None, supplier=3)
    frame = spark.createDataFrame
    return Star(
        dim_tempo=frame([(1, JAN, 2024, 1, 1, "Janeiro"), (2, FEB, 2024, 2, 1, "Fevereiro")],
                        "sk_tempo int, data date, ano short, mes short, trimestre short, nome_mes string"),
        dim_orgao=frame([(1, "u1", "Org A", "Sup", "DF"), (2, "u2", "Org B", "Sup", "RJ"), (3, "u3", "Org A", "Sup", None)],
                        "sk_orgao int, codigo_ug string, nome_orgao string, nome_orgao_superior string, uf string"),
        dim_fornecedor=frame([(1, "c1", "Um", "CNPJ"), (2, "c2", "Dois", "CPF"), (3, "c3", "Um", "CNPJ"), (4, "c4", "Quatro", "OUTRO")],
                             "sk_fornecedor int, codigo_fornecedor string, nome_fornecedor string, tipo_documento string"),
        dim_produto=frame([(1, "tubo"), (2, "lápis"), (3, "raro"), (4, "sem valor"), (5, "a b"), (6, "a  b"), (7, "só lance")],
                          "sk_produto int, descricao_item string"),
        dim_licitacao=frame([(1, "n1", "u1"), (2, "n2", "u3"), (3, "n3", "u2"), (4, "n4", "u9")],
                            "sk_licitacao int, numero_licitacao string, codigo_ug string"),
        fato_item_licitacao=frame(
            facts,
            "sk_fato_item long, sk_tempo int, sk_orgao int, sk_fornecedor int, sk_produto int, sk_licitacao int, "
            "quantidade_item decimal(18,4), valor_item decimal(18,4), valor_unitario_item decimal(18,4)",
        ),
        fato_participacao=frame(
            [(1, 1, 1, 1, True), (2, 1, 1, 1, False), (3, 1, 2, 2, False), (4, 1, 2, None, False), (5, 2, 1, 3, True),
             (6, 3, 1, None, False), (7, 4, 1, 4, True), (8, None, 1, 4, True)],
            "sk_fato_participacao long, sk_licitacao int, sk_produto int, sk_fornecedor int, flag_vencedor boolean",
        ),
    )


def tuples(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_top_products_unknown_total_first_and_ties_by_text(star):
    assert tuples(M.top_products(star)) == [
        ("sem valor", None, 2), ("tubo", D("1090"), 10), ("raro", D("903"), 4),
        ("a  b", D("50"), 1), ("a b", D("50"), 1), ("lápis", D("1.8"), 6),
    ]
    assert len(tuples(M.top_products(star, k=2))) == 2


def test_top_suppliers_by_code_not_name(star):
    assert tuples(M.top_suppliers(star)) == [
        ("Um", "c3", "CNPJ", D("1003")), ("Dois", "c2", "CPF", D("1001.8")), ("Um", "c1", "CNPJ", D("90")),
    ]


def test_states_without_the_unknown_one(star):
    assert tuples(M.value_by_state(star)) == [("DF", D("190")), ("RJ", D("1.8"))]


def test_months_and_days_leave_undated_items_out(star):
    assert tuples(M.value_by_month(star)) == [
        (2024, 1, "Janeiro", D("190"), 11), (2024, 2, "Fevereiro", D("904.8"), 12),
    ]
    assert tuples(M.value_by_day(star)) == [(JAN, D("190")), (FEB, D("904.8"))]


def test_mean_price(star):
    assert tuples(M.mean_price(star)) == [(D("99.68000000"),)]


def test_price_stats(star):
    (tubo, lapis) = M.price_stats(star).collect()
    assert (tubo.descricao_item, tubo.quantidade_ocorrencias, tubo.preco_medio) == ("tubo", 10, D("109"))
    assert tubo.desvio_padrao == pytest.approx(313.0654, abs=1e-4)
    assert (lapis.descricao_item, lapis.preco_medio, lapis.desvio_padrao) == ("lápis", D("0.1"), 0.0)


def test_price_stats_merge_keys_with_one_text(spark, star):
    """The constant and the outlier product under one text equal one product of all prices."""
    merged = Star(**{**star.tables(), "dim_produto": spark.createDataFrame(
        [(1, "x"), (2, "x"), (3, "x")], "sk_produto int, descricao_item string")})
    (row,) = M.price_stats(merged).collect()
    prices = [10.0] * 9 + [1000.0] + [0.1] * 6 + [1.0] * 3 + [900.0]
    mean = sum(prices) / len(prices)
    deviation = (sum((p - mean) ** 2 for p in prices) / (len(prices) - 1)) ** 0.5
    assert row.quantidade_ocorrencias == 20
    assert float(row.preco_medio) == pytest.approx(mean)
    assert row.desvio_padrao == pytest.approx(deviation)


def test_top_agencies_keep_the_unknown_state(star):
    assert tuples(M.top_agencies(star)) == [
        ("Org A", "Sup", None, D("1903")), ("Org A", "Sup", "DF", D("190")), ("Org B", "Sup", "RJ", D("1.8")),
    ]


def test_categories_are_products_relabelled(star):
    assert M.top_categories(star, 1).columns == ["categoria_aproximada", "valor_total"]


def test_anomalies(star):
    row = ("Dois", "tubo", D("1000"), D("109"), D("2.85"))
    assert tuples(M.anomaly_view(star)) == [row]
    assert tuples(M.overpriced_suppliers(star)) == [row]
    # The record without a date stays, without a date.
    assert tuples(M.price_anomalies(star)) == [(None, "Org A", None, *row)]
    assert tuples(M.anomaly_view(star, sigmas=3)) == []
    assert {r.descricao_item for r in M.anomaly_view(star, sigmas=1, min_count=4).collect()} == {"tubo", "raro"}


def test_anomaly_without_a_known_supplier_is_left_out(spark, star):
    fact = star.fato_item_licitacao.selectExpr(
        "* EXCEPT (sk_fornecedor)", "IF(sk_produto = 1, NULL, sk_fornecedor) AS sk_fornecedor"
    )
    cut = Star(**{**star.tables(), "fato_item_licitacao": fact})
    assert tuples(M.anomaly_view(cut)) == tuples(M.overpriced_suppliers(cut)) == []


def test_bidders_by_state(star):
    # RJ has only a bidder without a code: it counts, with zero.
    assert tuples(M.bidders_by_state(star)) == [("DF", 2), ("RJ", 0)]


def test_kpis(star):
    (row,) = tuples(M.kpis(star))
    assert row == (D("2094.8"), D("99.68"), 7, 4, 4)
    (used,) = tuples(M.kpis(star, counted_in="fact"))
    assert used == (D("2094.8"), D("99.68"), 6, 3, 2)


def test_price_lookup(star):
    assert len(tuples(M.price_lookup(star))) == 22
    assert tuples(M.price_lookup(star, product="lápis", supplier="Dois")) == [("lápis", "Dois", D("0.1"))] * 6
    assert tuples(M.price_lookup(star, product="lápis", supplier="Um")) == []


def test_months_reconcile_with_the_total(star):
    assert tuples(M.reconcile_months(star), "confere") == [(True,)]


def test_views(spark, star):
    M.publish_views(spark, star)
    assert spark.sql("SELECT count(*) FROM fato_item_licitacao").first()[0] == 24
    assert spark.sql("SELECT descricao_item FROM vw_anomalias_preco").first()[0] == "tubo"


def test_moments_merge_to_the_statistics_of_all_rows(spark):
    random = Random(3)
    data = [(g, p, None if random.random() < 0.1 else D(random.randint(1, 99999)) / 100) for g in range(6) for p in range(g + 1) for _ in range(12)]
    data += [(9, p, D("0.1")) for p in range(4) for _ in range(3)] + [(10, 0, D(1)), (11, 0, None)]
    df = spark.createDataFrame(data, "g int, p int, v decimal(18,4)")
    want = {r.g: r for r in group_stats(df, ["g"], "v").collect()}
    merged = merge_moments(moment_states(df, ["g", "p"], "v"), ["g"])
    got = {r.g: r for r in merged.collect()}
    assert merged.schema["media"].dataType == group_stats(df, ["g"], "v").schema["media"].dataType
    assert got.keys() == want.keys() == {*range(6), 9}
    for g, w in want.items():
        assert (got[g].media, got[g].quantidade_ocorrencias, got[g].maior) == (w.media, w.quantidade_ocorrencias, w.maior)
        assert got[g].desvio_padrao == pytest.approx(w.desvio_padrao, rel=1e-12, abs=1e-12)
    assert got[9].desvio_padrao == 0


def test_distinct_states(spark):
    df = spark.range(60000).selectExpr("id % 3 as g", "id % 7 as p", "if(id % 10 = 0, null, id % 20000) as v")
    exact = distinct_by(presence_states(df, ["g", "p"], "v"), ["g"], "v", "n")
    estimated = {r.g: r.n for r in merge_sketches(sketch_states(df, ["g", "p"], "v"), ["g"], "n").collect()}
    found = {r.g: r.n for r in exact.collect()}
    assert found == {r.g: r.n for r in distinct_by(df, ["g"], "v", "n").collect()}
    assert all(abs(estimated[g] - n) <= 0.05 * n for g, n in found.items())


def test_kept_anomalies_follow_the_star(spark, star, tmp_path, rows):
    """After every step the kept rows equal those of the whole fact, and only changed periods are computed."""
    warehouse, root = str(tmp_path / "w"), str(tmp_path / "a")
    with pytest.raises(FileNotFoundError):
        A.read_outliers(spark, root)
    assert A.update_outliers(spark, warehouse, root) == [] and A.read_outliers(spark, root).isEmpty()
    fact = conform(star.fato_item_licitacao, C.FATO_ITEM)
    steps = [{"1": "sk_fato_item <= 6", "2": "sk_fato_item > 6"}, {"1": "sk_fato_item <= 6", "2": "sk_fato_item > 9"},
             {"1": "sk_fato_item <= 6", "2": "sk_fato_item > 6 and sk_produto <> 2", "3": "false"}, {"2": "sk_fato_item > 6"}]
    paths = {}
    for turn, (step, changed) in enumerate(zip(steps, (["1", "2"], ["2"], ["2", "3"], ["2"]))):
        for period, condition in step.items():
            if (period, condition) not in paths:
                paths[period, condition] = f"{warehouse}/{len(paths)}"
                fact.filter(condition).write.parquet(paths[period, condition])
        parts = [V.Part(C.FATO_ITEM.name, paths[k], k[0]) for k in step.items()]
        V.publish_parts(spark, warehouse, str(turn), parts)
        assert A.update_outliers(spark, warehouse, root) == (changed if turn else ["1", "2"])
        assert A.update_outliers(spark, warehouse, root) == []
        now = dataclasses.replace(star, fato_item_licitacao=read_tables(spark, parts, [C.FATO_ITEM])[C.FATO_ITEM.name])
        columns = ("sk_fato_item", "preco_medio_produto", "quantidade_ocorrencias", "desvios_acima_da_media")
        assert rows(A.read_outliers(spark, root), *columns) == rows(M.price_outliers(now), *columns)
        assert rows(M.anomaly_view(now, outliers=A.read_outliers(spark, root))) == rows(M.anomaly_view(now))


@pytest.mark.parametrize("limit, hot", [(5_000_000, False), (2, True)])
def test_values_of_many_small_groups_meet_before_they_are_aggregated(spark, rows, limit, hot):
    data = [(i % 50 if i % 60 else None, "ab"[i % 2], Decimal(i * 37 % 101)) for i in range(120)] + [(1, "a", None)]
    df = spark.createDataFrame(data, "g int, p string, v decimal(18,4)").repartition(8)
    found = gathered_moments(df, "g", ["g", "p"], "v", rows_per_task=limit)
    assert rows(found.select("g", "p", "n", "soma", "maior")) == rows(moment_states(df, ["g", "p"], "v").select("g", "p", "n", "soma", "maior"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and ("LeftAnti" in plan) == hot


def test_few_groups_are_aggregated_as_they_lie(spark):
    df = spark.range(4000).selectExpr("cast(id % 2 as int) g", "'a' p", "cast(id as decimal(18,4)) v").coalesce(2)
    found = gathered_moments(df, "g", ["g", "p"], "v")
    assert "REPARTITION_BY_COL" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.n for r in found.collect()) == [2000, 2000]
