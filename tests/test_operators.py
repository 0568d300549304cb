"""Keys, joins, aggregates, ranking and checks on small frames."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenderlake.contracts import ROW_ORD, Column, Table
from tenderlake.operators import aggregates as A
from tenderlake.operators import checks as K
from tenderlake.operators import joins as J
from tenderlake.operators import keys as E
from tenderlake.operators import ranking as R
from pyspark.sql import types as T


def test_dedup_counts_copies_and_treats_nulls_as_equal(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 0), ("a", None, 1), ("b", 1, 2)], f"x string, y int, {ROW_ORD} long"
    )
    assert rows(E.dedup_exact(df, copies="n")) == [("a", None, 0, 2), ("b", 1, 2, 1)]


def test_first_by_key_takes_whole_rows(spark, rows):
    df = spark.createDataFrame(
        [("k", "late", None, 5), ("k", None, "early", 1), (None, "x", "y", 3), (None, "p", "q", 2)],
        "k string, a string, b string, o int",
    )
    assert rows(E.first_by_key(df, ["k"], "o")) == [(None, "p", "q", 2), ("k", None, "early", 1)]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dense_key_follows_order_over_any_partitioning(spark, partitions):
    df = spark.range(1000).withColumn("o", (F.col("id") * 7919) % 1000).repartition(partitions)
    keyed = E.assign_dense_key(df, "sk", order=["o"], start=5)
    assert keyed.filter("sk <> o + 5").count() == 0
    assert keyed.count() == 1000


def test_dense_key_without_order_has_no_gap(spark):
    df = spark.range(500).repartition(7)
    keyed = E.assign_dense_key(df, "sk").agg(
        F.min("sk"), F.max("sk"), F.count_distinct("sk")
    ).first()
    assert tuple(keyed) == (1, 500, 500)


def test_dense_key_of_nothing(spark):
    assert E.assign_dense_key(spark.range(0), "sk", order=["id"]).count() == 0


def test_mapping_only_grows(spark, rows):
    old = spark.createDataFrame([(1, "b"), (2, "d")], "sk int, k string")
    batch = spark.createDataFrame([("d",), ("a",), ("c",), ("a",), (None,)], "k string")
    grown = E.get_or_create_key(old, batch, ["k"], "sk")
    assert rows(grown) == [(1, "b"), (2, "d"), (3, "a"), (4, "c")]
    assert rows(E.get_or_create_key(grown, batch, ["k"], "sk")) == rows(grown)


def test_first_mapping_starts_at_one(spark, rows):
    empty = spark.createDataFrame([], "sk int, k string")
    batch = spark.createDataFrame([("z",), ("y",)], "k string")
    assert rows(E.get_or_create_key(empty, batch, ["k"], "sk")) == [(1, "y"), (2, "z")]


def test_union_ranked_prefers_the_earlier_source(spark, rows):
    first = spark.createDataFrame([("a", "item", 9)], f"k string, v string, {ROW_ORD} long")
    second = spark.createDataFrame([("a", "bid", 0), ("b", "bid", 1)], f"k string, v string, {ROW_ORD} long")
    kept = E.first_by_key(E.union_ranked([first, second]), ["k"], ROW_ORD)
    assert rows(kept, "k", "v") == [("a", "item"), ("b", "bid")]


# Joins: the broadcast and the spread form must agree, whatever the keys look like.

FACT = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 5}") for i in range(300)]
FORMS = [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "rows_per_task": 7}]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_with_hot_and_missing_keys(spark, form, null_safe):
    fact = spark.createDataFrame(FACT, "id int, k string")
    dim = spark.createDataFrame([(1, "hot"), (2, None), (3, "k1"), (4, "k2")], "sk int, kk string")
    got = J.lookup_key(fact, dim, [("k", "kk")], "sk", null_safe=null_safe, spread_by="id", **form)
    keys = {"hot": 1, None: 2 if null_safe else None, "k1": 3, "k2": 4}
    assert {(r.id, r.k): r.sk for r in got.collect()} == {f: keys.get(f[1]) for f in FACT}
    assert got.count() == len(FACT)


@pytest.mark.parametrize("form", FORMS)
def test_orphans_are_counted_and_dropped(spark, form):
    fact = spark.createDataFrame(FACT, "id int, k string")
    right = spark.createDataFrame([("hot",), ("k1",)], "k string")
    matched, orphans = J.inner_with_orphans(fact, right, ["k"], spread_by="id", **form)
    expected = [f for f in FACT if f[1] in ("hot", "k1")]
    assert sorted((r.id, r.k) for r in matched.collect()) == sorted(expected)
    assert orphans.first()[0] == len(FACT) - len(expected)


def test_measuring_counts_texts(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2), ("ç" * 100, 3)], "t string, i int")
    assert J.measured_bytes(df) == J.rows_bytes(3, 2) + 2 + 200


def test_large_dimension_is_not_broadcast(spark):
    fact = spark.createDataFrame(FACT, "id int, k string")
    dim = spark.createDataFrame([(1, "hot"), (2, "k1")], "sk int, kk string")

    def broadcasts(**form):
        plan = J.lookup_key(fact, dim, [("k", "kk")], "sk", **form)._jdf.queryExecution().analyzed().toString()
        return "strategy=broadcast" in plan

    assert broadcasts()
    assert not broadcasts(broadcast_bytes=10)


def test_hot_keys_include_the_missing_key(spark, rows):
    fact = spark.createDataFrame(FACT, "id int, k string")
    assert rows(J.hot_keys(fact, ["k"], 60)) == [(None, 2), ("hot", 2)]


@pytest.mark.parametrize("classes", [1, 2, 1 << 16])
def test_hot_keys_are_counted_in_full_classes_only(spark, rows, monkeypatch, classes):
    monkeypatch.setattr(J, "HASHES", classes)
    fact = spark.createDataFrame(FACT, "id int, k string")
    assert rows(J.hot_keys(fact, ["k"], 60)) == [(None, 2), ("hot", 2)]
    assert rows(J.hot_keys(fact, ["k"], 10_000)) == []


@pytest.mark.parametrize("form", [{"groups": 5}, {}, {"rows_per_task": 3}])
def test_outliers(spark, form):
    prices = [("clear", 1.0)] * 9 + [("clear", 100.0)]
    prices += [("constant", 0.1)] * 7 + [("few", 1.0)] * 3 + [("few", 99.0)]
    prices += [("unknown", None)] * 6 + [(None, 5.0)] * 9 + [(None, 500.0)]
    df = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(prices)], "id int, g string, v double"
    ).withColumn("v", F.col("v").cast("decimal(18,4)"))
    found = A.flag_outliers(df, "g", "v", "id", **form).collect()
    assert [(r.id, r.g, r.media, r.desvios_acima_da_media) for r in found] == [
        (9, "clear", Decimal("10.90000000"), Decimal("2.85"))
    ]


def test_stats_need_a_minimum_of_known_values(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0)] * 5 + [("b", 1.0)] * 4 + [("b", None)], "g string, v double"
    ).withColumn("v", F.col("v").cast("decimal(18,4)"))
    assert rows(A.group_stats(df, ["g"], "v"), "g", "quantidade_ocorrencias") == [("a", 5)]


def test_drift_ignores_missing_keys_and_values(spark, rows):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", None), ("b", "x"), ("b", None), (None, "x"), (None, "y")],
        "k string, v string",
    )
    assert rows(A.attribute_drift(df, "k", "v")) == [("a", 2)]


def test_count_distinct_ignores_missing(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", None)], "k string, v int")
    assert rows(A.distinct_by(df, ["k"], "v", "n")) == [("a", 1), ("b", 0)]


def test_sum_by_attributes_merges_keys_with_one_text(spark, rows):
    fact = spark.createDataFrame([(1, 10), (1, 5), (2, 1), (3, 7), (None, 99)], "sk int, v int")
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "sk int, text string")
    got = A.sum_count_by_attributes(fact, [(dim, "sk")], ["text"], "v", count="n")
    assert rows(got) == [(None, 7, 1), ("a", 16, 3)]


def test_ranking_puts_unknown_first_and_breaks_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", None), ("d", 9)], "k string, v int")
    assert [r.k for r in R.rank_all(df, "v", ["k"]).collect()] == ["c", "d", "a", "b"]
    assert [r.k for r in R.top_k(df, 3, "v", ["k"]).collect()] == ["c", "d", "a"]


# Contract checks

PARENT = Table("parent", (Column("id", T.IntegerType(), nullable=False), Column("code", T.StringType(), False, 3)), ("id",), (("code",),))
CHILD = Table("child", (Column("pk", T.LongType(), nullable=False), Column("id", T.IntegerType(), references=("parent", "id"))), ("pk",))


def violations(spark, parent, child):
    tables = {
        "parent": spark.createDataFrame(parent, "id int, code string"),
        "child": spark.createDataFrame(child, "pk long, id int"),
    }
    result = K.check_contract(tables, (PARENT, CHILD))
    return {(r.tabela, r.regra, r.coluna): r.violacoes for r in result.collect()}


def test_clean_tables_show_every_rule_with_zero(spark):
    found = violations(spark, [(1, "a"), (2, "b")], [(1, 1), (2, None)])
    assert set(found.values()) == {0}
    assert len(found) == 8


def test_each_kind_of_violation_is_counted(spark):
    found = violations(
        spark, [(1, "a"), (1, "long"), (None, "a"), (4, None)], [(1, 9), (1, 9), (2, 1), (3, None)]
    )
    assert found == {
        ("parent", "not_null", "id"): 1,
        ("parent", "not_null", "code"): 1,
        ("parent", "length", "code"): 1,
        ("parent", "primary_key", "id"): 1,
        ("parent", "unique", "code"): 1,
        ("child", "not_null", "pk"): 0,
        ("child", "primary_key", "pk"): 1,
        ("child", "foreign_key", "id"): 2,
    }


@pytest.mark.parametrize("step", [1, 1000])
def test_surplus_rows_of_dense_and_sparse_keys(spark, step):
    """Dense keys are counted by bitmaps, sparse ones by value; both exactly."""
    ids = [i * step for i in range(-40000, 40000, 7 if step == 1 else 101)]
    repeated = ids[::50] + ids[::50] + [None, None]
    df = spark.createDataFrame([(i,) for i in ids + repeated], "id int").withColumn("code", F.lit("a"))
    child = spark.createDataFrame([], "pk long, id int")
    found = K.check_contract({"parent": df, "child": child}, (PARENT, CHILD)).collect()
    surplus = {(r.tabela, r.regra): r.violacoes for r in found}
    assert surplus["parent", "primary_key"] == 2 * len(ids[::50])
    assert surplus["child", "primary_key"] == 0
    seen = K._summaries({"parent": df, "child": child}, (PARENT, CHILD))
    assert K._is_dense(seen["parent"]) == (step == 1) and not K._is_dense(seen["child"])


@pytest.mark.parametrize("ids, range_of", [([1, 2, 3], (1, 3)), ([1, 2, 3, 3], (1, 3)), ([1, 3], None), ([1, 1, 3], None), ([], None)])
def test_keys_without_a_gap_need_no_lookup(spark, ids, range_of):
    """Rows outside the range of such a key point nowhere; a repeated value does not stand for a missing one."""
    parent = spark.createDataFrame([(i, str(i)) for i in ids], "id int, code string")
    child = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, 2), (5, 4), (6, None)], "pk long, id int")
    tables = {"parent": parent, "child": child}
    found = K._gapless(tables, (PARENT, CHILD), K._summaries(tables, (PARENT, CHILD)))
    assert found.get(("parent", "id")) == range_of
    lost = {(r.tabela, r.regra): r.violacoes for r in K.check_contract(tables, (PARENT, CHILD)).collect()}
    assert lost["child", "foreign_key"] == sum(i not in ids for i in (0, 1, 2, 2, 4))


def test_gate(spark):
    clean = spark.createDataFrame([("t", "r", "c", 0)], "tabela string, regra string, coluna string, violacoes long")
    K.open_gate(clean)
    with pytest.raises(K.GateClosed, match="t.c r: 3"):
        K.open_gate(clean.withColumn("violacoes", F.lit(3)))


def test_reconcile(spark, rows):
    parts = spark.createDataFrame([(1.5,), (2.5,)], "v double")
    whole = spark.createDataFrame([(4.0,)], "v double")
    assert [r.confere for r in K.reconcile(parts, whole, ["v"]).collect()] == [True]
    off = spark.createDataFrame([(4.1,)], "v double")
    assert [r.confere for r in K.reconcile(parts, off, ["v"]).collect()] == [False]


def test_first_by_key_leaves_rows_of_single_keys_where_they_lie(spark, rows):
    data = [("a", None, "x", 3), ("a", None, "y", 1), ("a", None, "y", 1), ("b", "z", "w", 2), (None, None, "v", None), (None, None, "u", 9), ("c", "c", "t", None), ("c", "c", "s", None)]
    df = spark.createDataFrame(data, "k string, l string, t string, o long")
    found = E.first_by_key(df, ["k", "l"], "o")
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    want = [(None, None, "u", 9), ("a", None, "y", 1), ("a", None, "y", 1), ("b", "z", "w", 2), ("c", "c", "s", None), ("c", "c", "t", None)]
    assert rows(found) == rows(spark.createDataFrame(want, df.schema))
    assert rows(E.first_by_key(df, ["k", "l"], "o", broadcast_bytes=0)) == rows(found)
    assert rows(E.first_by_key(df.limit(0), ["k", "l"], "o")) == []


def test_rows_below_every_threshold_of_their_class_are_left_out(spark):
    data = [(i, f"g{i % 40}", float(1 + i % 40 + (500 if i % 97 == 0 else i % 7))) for i in range(4000)]
    df = spark.createDataFrame(data, "id long, g string, v double")
    limits = df.groupBy("g").agg((F.avg("v") + 2 * F.stddev("v")).alias("_limiar"))
    above = {r.id for r in df.join(limits, "g").filter("v > _limiar").collect()}
    for size in (A.rows_bytes(1, 1), 1 << 20):
        kept = A.may_exceed(df, "g", "v", limits, broadcast_bytes=size)
        found = {r.id for r in kept.collect()}
        assert above <= found and len(found) < len(data)
    assert found == above  # a class for every group
    # statistics by a text are not broadcast: the same rows are flagged, and others are not shuffled
    assert {r.id for r in A.flag_outliers(df, "g", "v", "id").collect()} == above
    assert "_limiar" in A.flag_outliers(df, "g", "v", "id")._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_a_copy_are_split_off(spark, rows):
    """Copies, those of missing values too, are all in the rest; hardly any row without a copy is."""
    df = spark.range(4000).selectExpr("id", "if(id % 1000 = 7, null, cast(id % 3000 as string)) AS a", "cast(id % 2 AS decimal(38,6)) AS b")
    apart, rest = E.split_repeated(df, [F.col("a"), F.col("b")])
    seen = {r.id for r in rest.collect()}
    assert {i for i in range(4000) if i % 3000 < 1000 or i % 1000 == 7} <= seen
    assert len(seen) < 2010
    assert sorted(r.id for r in apart.collect()) == [i for i in range(4000) if i not in seen]
    assert rows(apart.limit(0)) == [] and E.split_repeated(df.limit(0), [F.col("a")])[1].count() == 0
