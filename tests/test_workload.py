"""Every named query next to its SQL counterpart, at the smallest scale factor."""

import math
from datetime import date
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tenderlake import contracts as C
from tenderlake.sources import landing
from workload import adapters, source_queries

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.10g}"
    return str(value)


def normal(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, str(FOLDER))
    mine = normal(df.columns, df.collect())
    assert mine[1], "no rows"
    if name in oracle_sql():
        result = duck.execute(oracle_sql()[name])
        assert mine == normal([d[0] for d in result.description], result.fetchall())


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 20


def test_landing_files_do_not_grow_with_the_files_of_the_table(spark, tmp_path):
    cells = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
    data = [(i, i % 3, "FOP"[i % 3], i + 0.25, date(1996, 1 + i % 2, 3), "1-URGENT") for i in range(120)]
    orders = spark.createDataFrame(data, cells)
    orders.repartition(5).write.parquet(str(tmp_path / "orders.parquet"))
    files = source_queries._landing(spark, str(tmp_path))
    groups = {(d.month, state, i % 2 if state == "F" else 0) for i, _, state, _, d, _ in data}
    found = landing.listing(spark, files).collect()
    assert len(found) == len(groups)
    read = landing.read_landing_csv(spark, [r.path for r in found], ["Chave", "Comprador", "Texto", "Total"])
    assert sorted(int(r.Chave) for r in read.collect()) == list(range(120))


def test_lines_are_written_once_for_items_and_bids(spark, tmp_path):
    tables = {
        "nation": [(1, "N", 1)], "region": [(1, "R")], "customer": [(5, "C", 1, "AUTO")], "supplier": [(40, "S"), (41, "T")],
        "part": [(7, "lata")], "orders": [(3, 5, "O", 9.5, date(2024, 1, 2), "1-URGENT")],
        "lineitem": [(3, 7, 40, 1, 2.0, 10.5, "R"), (3, 7, 41, 7, 3.0, 1.25, "N"), (4, 7, 41, 1, 1.0, 1.0, "N")],
    }
    schemas = {
        "nation": "n_nationkey int, n_name string, n_regionkey int", "region": "r_regionkey int, r_name string",
        "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", "supplier": "s_suppkey long, s_name string",
        "part": "p_partkey long, p_name string",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string",
    }
    for name, data in tables.items():
        spark.createDataFrame(data, schemas[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    found = adapters.silver(spark, str(tmp_path))
    items, bids = found[C.ITEMS], found[C.BIDS]
    assert sorted(items.inputFiles()) == sorted(bids.inputFiles())
    said = items.select("Número Licitação", "Código UG", "Código Modalidade Compra", "Descrição", "Quantidade Item", "Valor Item", "Nome Vencedor", "tipo_documento_vencedor")
    assert sorted(map(tuple, said.collect()), key=str) == sorted([
        ("3", "5", "1", "lata 7", Decimal(2), Decimal("10.5"), "S", "CNPJ"), ("3", "5", "1", "lata 7", Decimal(0), Decimal("1.25"), "T", "CPF"),
    ], key=str)
    assert sorted(map(tuple, bids.select("Código Participante", "flag_vencedor").collect()), key=str) == [("41", False), (None, True)]
