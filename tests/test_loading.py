"""Publication, incremental loading and the whole batch job."""

from datetime import datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.operators.checks import GateClosed, key_ranges
from tenderlake.operators.keys import assign_key_by_group
from tenderlake.plans import incremental as I
from tenderlake.plans import period_load as L
from tenderlake.plans import publish as P
from tenderlake.plans import silver as S
from tenderlake.plans import versions as V
from tenderlake.plans.occurrences import read_occurrences
from tenderlake.plans.period_load import drop_period
from tenderlake.plans import refresh as R
from tenderlake.plans.refresh import refresh, refresh_changes, refresh_period
from tenderlake.session import path_exists, scratch, shared_dir, side_by_side, size_shuffles, sized_shuffles, staged
from tenderlake.sources.landing import ingest_folder

TABLE = C.Table(
    "t", (C.Column("id", C.T.IntegerType(), False), C.Column("nome", C.T.StringType(), True, 3), C.Column("v", C.MONEY)), ("id",)
)


def test_conform_rounds_types_and_empties(spark):
    df = spark.createDataFrame([("1", "", 1.00005), (None, "abc", None)], "id string, nome string, v double")
    got = P.conform(df, TABLE)
    assert got.schema["id"].dataType == C.T.IntegerType()
    assert [tuple(r) for r in got.collect()] == [(1, None, Decimal("1.0001")), (None, "abc", None)]


def test_conform_refuses_what_does_not_fit(spark):
    df = spark.createDataFrame([("99999999999", "a", 1.0)], "id string, nome string, v double")
    with pytest.raises(Exception, match="CAST_"):
        P.conform(df, TABLE).collect()


def test_gate_keeps_the_published_version(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, nome string, v double")
    assert P.publish_if_clean(spark, {"t": good}, root, (TABLE,)) == {"t": 2}
    first = V.current_version(spark, root)
    bad = good.withColumn("nome", F.lit("comprido"))
    with pytest.raises(GateClosed, match="t.nome length: 2"):
        P.publish_if_clean(spark, {"t": bad}, root, (TABLE,))
    assert V.current_version(spark, root) == first
    assert [p.name for p in (tmp_path / "versoes").iterdir()] == [first]
    assert P.publish_if_clean(spark, {"t": good.limit(1)}, root, (TABLE,)) == {"t": 1}
    assert V.current_version(spark, root) != first


def test_expired_versions_go_and_used_folders_stay(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.createDataFrame([(1, "a", 1.0)], "id int, nome string, v double")
    for _ in range(4):
        P.publish_if_clean(spark, {"t": frame}, root, (TABLE,))
    # A publication that carries the current folder over by name.
    V.publish_parts(spark, root, V.new_version(), V.current_parts(spark, root))
    assert len(V.expire_versions(spark, root, keep=2)) == 3
    assert P.read_tables(spark, V.current_parts(spark, root), (TABLE,))["t"].count() == 1
    assert V.expire_versions(spark, root, keep=2) == []


def test_writers_that_take_the_same_place(spark, tmp_path, monkeypatch):
    """Both have read the list before; the place after it is given once."""
    root = str(tmp_path)
    V.publish_parts(spark, root, "a", [V.Part("t", f"{root}/x")])
    real = V._create_list

    def second(name, base):
        monkeypatch.setattr(V, "_create_list", real)
        V.publish_parts(spark, root, name, [V.Part("t", f"{root}/{name}")], base)

    def overtaken(*args):
        second("b", "a")
        return real(*args)

    monkeypatch.setattr(V, "_create_list", overtaken)
    with pytest.raises(V.VersionMoved):
        V.publish_parts(spark, root, "c", [V.Part("t", f"{root}/c")], "a")
    assert V.current_version(spark, root) == "b"
    # without a base the later one comes after the other, and none is lost

    def overtaken_again(*args):
        second("d", V.ANY)
        return real(*args)

    monkeypatch.setattr(V, "_create_list", overtaken_again)
    V.publish_parts(spark, root, "e", [V.Part("t", f"{root}/e")])
    assert V.current_version(spark, root) == "e" and V._orders(spark, root) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="published already"):
        V.publish_parts(spark, root, "e", [])


def test_parallel_writers_lose_nothing(spark, tmp_path):
    """Every writer adds a folder to the list it read; those that are told so try again."""
    root = str(tmp_path)

    def add(name):
        while True:
            base, parts = V.base_and_parts(spark, root)
            try:
                return V.publish_parts(spark, root, name, [*parts, V.Part("t", f"{root}/{name}")], base)
            except V.VersionMoved:
                continue

    names = [f"w{i}" for i in range(6)]
    side_by_side(spark, {n: lambda n=n: add(n) for n in names})
    assert sorted(p.path for p in V.current_parts(spark, root)) == [f"{root}/{n}" for n in names]
    assert V._orders(spark, root) == list(range(1, 7))


def test_a_set_of_tables_is_switched_as_one(spark, tmp_path, rows):
    root = str(tmp_path / "set")
    frames = {n: spark.createDataFrame([(n, 1)], "nome string, v int") for n in ("a", "b")}
    V.write_set(spark, frames, root)
    broken = {"a": frames["a"].withColumn("v", F.lit(2)), "b": frames["b"].withColumn("v", F.raise_error(F.lit("killed")).cast("int"))}
    with pytest.raises(Exception, match="killed"):
        V.write_set(spark, broken, root)
    with pytest.raises(KeyboardInterrupt), V.replaced_set(spark, root) as folder:  # between two tables
        broken["a"].write.parquet(f"{folder}/a")
        raise KeyboardInterrupt
    assert [rows(spark.read.parquet(V.set_path(spark, root, n))) for n in ("a", "b")] == [[("a", 1)], [("b", 1)]]
    V.write_set(spark, {n: df.withColumn("v", F.lit(3)) for n, df in frames.items()}, root)
    assert [spark.read.parquet(V.set_path(spark, root, n)).first().v for n in ("a", "b")] == [3, 3]
    with pytest.raises(FileNotFoundError):
        V.set_path(spark, root, "c")


def test_a_crashed_silver_run_leaves_the_old_set(spark, tmp_path, landing, monkeypatch):
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def clean():
        ingest_folder(spark, landing.folder, bronze)
        with scratch(spark), V.replaced_set(spark, root) as folder:
            R.bronze_to_silver(spark, bronze, folder)
        return {n: df.count() for n, df in S.read_silver(spark, root).items()}

    before = clean()
    landing("202403_Licitação.csv", TENDER_HEADER, tender("3", "20/03/2024"))
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        real = S.write_silver

        def breaks(marked, folder, name):
            if name == C.ITEMS:
                raise RuntimeError("driver lost")
            real(marked, folder, name)

        patch.setattr(S, "write_silver", breaks)
        clean()
    assert {n: df.count() for n, df in S.read_silver(spark, root).items()} == before
    assert clean()[C.TENDERS] == before[C.TENDERS] + 1


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        P.read_version(spark, str(tmp_path))


# Run control


def test_control_table(spark, tmp_path, rows):
    control = str(tmp_path / "c")
    assert I.read_control(spark, control).isEmpty()

    def job(period):
        if period == "2024-02":
            raise ValueError("broken")
        return 7

    available = spark.createDataFrame([(f"2024-0{m}",) for m in (1, 2, 3)], "periodo string")
    with pytest.raises(ValueError):
        I.catch_up(spark, control, available, "2024-03", job)
    states = {r.periodo: (r.status, r.linhas) for r in I.run_states(I.read_control(spark, control)).collect()}
    assert states == {"2024-01": (C.OK, 7), "2024-02": (C.FAILED, None)}
    pending = I.pending_periods(I.read_control(spark, control), available, "2024-02")
    assert rows(pending) == [("2024-02",)]
    assert I.catch_up(spark, control, available, "2024-03", lambda p: 1) == {"2024-02": 1, "2024-03": 1}
    assert I.catch_up(spark, control, available, "2024-03", lambda p: 1) == {}
    assert I.backfill(spark, control, ["2024-01"], lambda p: 2) == {"2024-01": 2}


def test_stuck_periods(spark, tmp_path, rows):
    control = str(tmp_path / "c")
    now = datetime.now(timezone.utc)
    I.record_run(spark, control, "a", C.STARTED, started=now - timedelta(hours=5))
    I.record_run(spark, control, "b", C.STARTED, started=now)
    I.record_run(spark, control, "c", C.FAILED)
    I.record_run(spark, control, "d", C.STARTED, started=now - timedelta(hours=5))
    I.record_run(spark, control, "d", C.OK, 1)
    stuck = I.stuck_periods(I.read_control(spark, control), now - timedelta(hours=1))
    assert rows(stuck, "periodo") == [("a",), ("c",)]


# Merges


def test_merge_updates_and_inserts(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, None)], "k int, v string")
    assert rows(I.merge_by_key(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, None)]


def test_merge_by_version_keeps_the_newest(spark, rows):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 1)], "k int, v string, n int")
    new = spark.createDataFrame([(1, "late", 3), (2, "B", 2)], "k int, v string, n int")
    assert rows(I.merge_by_key(old, new, ["k"], "n"), "k", "v") == [(1, "a"), (2, "B")]


def test_merge_into_periods_moves_a_row_and_empties_its_old_period(spark, tmp_path, rows):
    root, schema = str(tmp_path / "t"), "k int, v string, mes string"
    I.merge_into_periods(spark, root, spark.createDataFrame([(1, "a", "01"), (2, "b", "02"), (3, "c", "03")], schema), ["k"], ["mes"])
    kept = {p.period: p.path for p in V.current_parts(spark, root)}
    touched = I.merge_into_periods(spark, root, spark.createDataFrame([(1, "A", "02"), (4, "d", "04")], schema), ["k"], ["mes"])
    assert touched == [("01",), ("02",), ("04",)]
    assert rows(I.read_period_table(spark, root, schema), "k", "v", "mes") == [
        (1, "A", "02"), (2, "b", "02"), (3, "c", "03"), (4, "d", "04"),
    ]
    now = {p.period: p.path for p in V.current_parts(spark, root)}
    assert sorted(now) == ['{"mes":"02"}', '{"mes":"03"}', '{"mes":"04"}'] and now['{"mes":"03"}'] == kept['{"mes":"03"}']


def test_merge_keeps_rows_without_period_or_key(spark, tmp_path, rows):
    root, schema = str(tmp_path / "t"), "k int, v string, mes string"
    first = [(1, "a", None), (2, "b", None), (None, "x", "01"), (None, "y", "01"), (3, "c", "01")]
    I.write_period_table(spark, root, spark.createDataFrame(first, schema), ["mes"])
    batch = spark.createDataFrame([(1, "A", None), (3, "C", None), (None, "z", "01")], schema)
    assert I.merge_into_periods(spark, root, batch, ["k"], ["mes"]) == [(None,), ("01",)]
    assert rows(I.read_period_table(spark, root, schema), "k", "v", "mes") == rows(
        spark.createDataFrame([(1, "A", None), (2, "b", None), (3, "C", None), (None, "x", "01"), (None, "y", "01"), (None, "z", "01")], schema)
    )


def test_empty_batches_and_tables(spark, tmp_path, rows):
    root, schema = str(tmp_path / "t"), "k int, v string, mes string"
    none = spark.createDataFrame([], schema)
    assert I.read_period_table(spark, root, schema).isEmpty()
    assert I.merge_into_periods(spark, root, none, ["k"], ["mes"]) == []
    I.merge_into_periods(spark, root, spark.createDataFrame([(1, "a", "01")], schema), ["k"], ["mes"])
    assert I.merge_into_periods(spark, root, none, ["k"], ["mes"]) == []
    assert rows(I.read_period_table(spark, root, schema)) == [(1, "a", "01")]


@pytest.mark.parametrize("broken", ["_write_parts", "publish_parts", "staged"])
def test_a_merge_that_breaks_off_leaves_the_old_table(spark, tmp_path, rows, monkeypatch, broken):
    root, schema = str(tmp_path / "t"), "k int, v string, mes string"
    old = [(1, "a", "01"), (2, "b", "02")]
    I.write_period_table(spark, root, spark.createDataFrame(old, schema), ["mes"])
    folders = sorted(p.name for p in (tmp_path / "t/versoes").iterdir())
    batch = spark.createDataFrame([(1, "A", "02")], schema)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        real, calls = getattr(I, broken), []

        def breaks(*args):
            calls.append(args)
            if broken == "_write_parts":
                real(*args)  # all files of the new version are there, its list is not
            if broken != "staged" or len(calls) == 3:
                raise RuntimeError("driver lost")
            return real(*args)

        patch.setattr(I, broken, breaks)
        I.merge_into_periods(spark, root, batch, ["k"], ["mes"])
    assert rows(I.read_period_table(spark, root, schema), "k", "v", "mes") == old
    assert sorted(p.name for p in (tmp_path / "t/versoes").iterdir()) == folders
    I.merge_into_periods(spark, root, batch, ["k"], ["mes"])
    assert rows(I.read_period_table(spark, root, schema), "k", "v", "mes") == [(1, "A", "02"), (2, "b", "02")]


def test_of_two_merges_one_is_told_that_the_table_moved(spark, tmp_path, rows, monkeypatch):
    root, schema = str(tmp_path / "t"), "k int, v string, mes string"
    I.write_period_table(spark, root, spark.createDataFrame([(1, "a", "01"), (2, "b", "02")], schema), ["mes"])
    real = I._write_parts

    def overtaken(*args):
        monkeypatch.setattr(I, "_write_parts", real)
        I.merge_into_periods(spark, root, spark.createDataFrame([(2, "B", "02")], schema), ["k"], ["mes"])
        return real(*args)

    monkeypatch.setattr(I, "_write_parts", overtaken)
    mine = spark.createDataFrame([(1, "A", "01")], schema)
    with pytest.raises(V.VersionMoved):
        I.merge_into_periods(spark, root, mine, ["k"], ["mes"])
    assert rows(I.read_period_table(spark, root, schema), "k", "v", "mes") == [(1, "a", "01"), (2, "B", "02")]
    I.merge_into_periods(spark, root, mine, ["k"], ["mes"])
    assert rows(I.read_period_table(spark, root, schema), "k", "v", "mes") == [(1, "A", "01"), (2, "B", "02")]


def test_merge_refuses_a_batch_that_contradicts_itself(spark, rows):
    old = spark.createDataFrame([(1, "a", 1)], "k int, v string, n int")
    new = spark.createDataFrame([(1, "b", 2), (1, "c", 2)], "k int, v string, n int")
    with pytest.raises(ValueError, match="1 keys stand more than once"):
        I.merge_by_key(old, new, ["k"])
    once = rows(I.merge_by_key(old, new, ["k"], "n"))
    assert len(once) == 1 and once == rows(I.merge_by_key(old, new.orderBy("v", ascending=False), ["k"], "n"))


def test_files_per_period_do_not_grow_with_tasks(spark, tmp_path):
    many = spark.range(4000).repartition(16).selectExpr("id", "cast(id % 20 as string) as mes")
    I.write_periods(many, str(tmp_path / "t"), ["mes"])
    files = list((tmp_path / "t").glob("mes=*/*.parquet"))
    assert 20 <= len(files) <= 40


def test_replace_period(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "k int, ano string, mes string"
    I.write_periods(spark.createDataFrame([(1, "2024", "01"), (2, "2024", "02")], schema), path, ["ano", "mes"])
    january = {"ano": "2024", "mes": "01"}
    for _ in range(2):
        I.replace_period(spark, path, spark.createDataFrame([(9, "2024", "01")], schema), january)
    back = spark.read.schema(schema).parquet(path)
    assert rows(back, "k", "mes") == [(2, "02"), (9, "01")]
    with pytest.raises(ValueError):
        I.replace_period(spark, path, spark.createDataFrame([(9, "2024", "03")], schema), january)
    I.replace_period(spark, path, spark.createDataFrame([], schema), january)
    assert rows(spark.read.schema(schema).parquet(path), "k") == [(2,)]


def test_upsert_keeps_keys(spark, rows):
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "sk int, k string, v string")
    batch = spark.createDataFrame([("b", "Y"), ("c", "z"), (None, "n")], "k string, v string")
    once = I.upsert_dimension(dim, batch, ["k"], "sk")
    assert rows(once) == [(1, "a", "x"), (2, "b", "Y"), (3, "c", "z")]
    assert rows(I.upsert_dimension(once, batch, ["k"], "sk")) == rows(once)


# The whole job

TENDER_HEADER = (
    "Número Licitação", "Código UG", "Nome UG", "Código Modalidade Compra", "Modalidade Compra", "Número Processo",
    "Objeto", "Situação Licitação", "Código Órgão Superior", "Nome Órgão Superior", "Código Órgão", "Nome Órgão",
    "UF", "Município", "Data Resultado Compra", "Data Abertura", "Valor Licitação",
)
ITEM_HEADER = (
    "Número Licitação", "Código UG", "Código Modalidade Compra", "Código Item Compra", "Descrição", "Quantidade Item",
    "Valor Item", "Código Vencedor", "Nome Vencedor",
)
BID_HEADER = (
    "Número Licitação", "Código UG", "Código Modalidade Compra", "Código Item Compra", "Descrição Item Compra",
    "Código Participante", "Nome Participante", "Flag Vencedor",
)


def tender(number, day, name="Unidade"):
    return (number, "10", name, "5", "Pregão", f"P{number}", "Obras", "Encerrada", "1", "Sup", "2", "Órgão", "DF", "Brasília", day, day, "1.000,00")


def item(number, code, value="10,50"):
    return (number, "10", "5", code, "Caneta", "3", value, "1" * 14, "ACME")


def offer(number, code, supplier="1" * 14, flag="SIM"):
    return (number, "10", "5", code, "Caneta", supplier, "ACME", flag)


@pytest.fixture
def landing(write_csv):
    write_csv("202401_Licitação.csv", TENDER_HEADER, tender("1", "15/01/2024"), tender("1", "15/01/2024"))
    write_csv("202402_Licitação.csv", TENDER_HEADER, tender("2", "20/02/2024"))
    write_csv("202401_ItemLicitação.csv", ITEM_HEADER, item("1", "7"), item("1", ""), item("1", "8", "-1,00"), item("9", "1"))
    write_csv("202402_ItemLicitação.csv", ITEM_HEADER, item("2", "7"))
    write_csv("202401_ParticipantesLicitação.csv", BID_HEADER, offer("1", "7"), offer("1", "7", "-11", "NÃO"))
    write_csv("202401_EmpenhosRelacionados.csv", C.COMMITMENT_COLUMNS)
    return write_csv


def test_refresh_end_to_end(spark, tmp_path, landing, rows):
    root = str(tmp_path / "lake")
    expected = {
        "dim_tempo": 2, "dim_orgao": 1, "dim_fornecedor": 1, "dim_produto": 1, "dim_licitacao": 2,
        "fato_item_licitacao": 3, "fato_participacao": 2,
    }
    assert refresh(spark, landing.folder, root) == expected
    star = P.read_version(spark, f"{root}/warehouse")
    assert {(r.valor_item, r.valor_unitario_item) for r in star.fato_item_licitacao.collect()} == {
        (Decimal("10.5"), Decimal("3.5"))
    }
    report = {r.dataset: r for r in S.read_quality(spark, f"{root}/silver").collect()}
    assert (report[C.TENDERS].duplicados_removidos, report[C.ITEMS].valores_negativos_removidos) == (1, 1)
    assert (report[C.ITEMS].codigo_item_gerado, report[C.BIDS].participante_invalido_corrigido) == (1, 1)
    assert report[C.COMMITMENTS].linhas_entrada == 0
    # The load key numbers rows as they come; all else repeats exactly.
    load_keys = ("sk_fato_item", "sk_fato_participacao")
    before = {n: rows(t.drop(*load_keys)) for n, t in star.tables().items()}
    assert refresh(spark, landing.folder, root) == expected
    again = P.read_version(spark, f"{root}/warehouse").tables()
    assert {n: rows(t.drop(*load_keys)) for n, t in again.items()} == before


def test_month_by_month_equals_full_rebuild(spark, tmp_path, landing, rows):
    landing("202402_ParticipantesLicitação.csv", BID_HEADER, offer("2", "7", "3" * 11))
    root, whole = str(tmp_path / "lake"), str(tmp_path / "whole")
    refresh(spark, landing.folder, whole)
    ingest_folder(spark, landing.folder, f"{root}/bronze")
    refresh_period(spark, root, "2024", "01")
    first = P.read_version(spark, f"{root}/warehouse")
    keys = {r.codigo_fornecedor: r.sk_fornecedor for r in first.dim_fornecedor.collect()}
    refresh_period(spark, root, "2024", "02")

    def by_natural_key(path):
        star = P.read_version(spark, path)
        joined = (
            star.fato_item_licitacao.join(star.dim_tempo, "sk_tempo").join(star.dim_fornecedor, "sk_fornecedor")
            .join(star.dim_produto, "sk_produto").join(star.dim_licitacao, "sk_licitacao")
        )
        won = rows(joined, "data", "codigo_fornecedor", "descricao_item", "numero_licitacao", "valor_item")
        bids = star.fato_participacao.join(star.dim_licitacao, "sk_licitacao").join(star.dim_fornecedor, "sk_fornecedor", "left")
        return won, rows(bids, "numero_licitacao", "codigo_fornecedor", "flag_vencedor")

    lake = f"{root}/warehouse"
    assert by_natural_key(lake) == by_natural_key(f"{whole}/warehouse")
    star = P.read_version(spark, lake)
    grown = {r.codigo_fornecedor: r.sk_fornecedor for r in star.dim_fornecedor.collect()}
    assert keys.items() <= grown.items() and len(grown) == 2
    assert rows(star.fato_item_licitacao, "sk_fato_item") == [(1,), (2,), (3,)]
    # Loading a month again replaces it; taking it out leaves the other.
    before = by_natural_key(lake)
    refresh_period(spark, root, "2024", "01")
    assert by_natural_key(lake) == before
    drop_period(spark, lake, "2024-01")
    left = P.read_version(spark, lake)
    assert (left.fato_item_licitacao.count(), left.dim_tempo.count()) == (1, 2)


@pytest.mark.parametrize("order", [("01", "02"), ("02", "01"), ("01", "02", "01")])
def test_items_and_tenders_of_different_months_meet(spark, tmp_path, write_csv, rows, order):
    """Items of either month belong to tenders of the other; one tender stands in both; one item has none."""
    write_csv("202401_Licitação.csv", TENDER_HEADER, tender("1", "15/01/2024"), tender("3", "16/01/2024"))
    write_csv("202402_Licitação.csv", TENDER_HEADER, tender("2", "20/02/2024"), tender("3", "21/02/2024"))
    write_csv("202401_ItemLicitação.csv", ITEM_HEADER, item("1", "7"), item("2", "8"), item("3", "9"), item("77", "1"))
    write_csv("202402_ItemLicitação.csv", ITEM_HEADER, item("1", "5"), item("2", "6"), item("3", "4"))
    write_csv("202401_ParticipantesLicitação.csv", BID_HEADER, offer("2", "8"))
    write_csv("202402_ParticipantesLicitação.csv", BID_HEADER, offer("1", "5"))
    root, whole = str(tmp_path / "lake"), str(tmp_path / "whole")
    refresh(spark, write_csv.folder, whole)
    ingest_folder(spark, write_csv.folder, f"{root}/bronze")
    for month in order:
        refresh_period(spark, root, "2024", month)

    def facts(path):
        star = P.read_version(spark, path)
        won = star.fato_item_licitacao.join(star.dim_tempo, "sk_tempo").join(star.dim_licitacao, "sk_licitacao")
        bids = star.fato_participacao.join(star.dim_licitacao, "sk_licitacao", "left")
        return rows(won, "data", "numero_licitacao", "valor_item"), rows(bids, "numero_licitacao", "flag_vencedor")

    lake = f"{root}/warehouse"
    assert facts(lake) == facts(f"{whole}/warehouse") and len(facts(lake)[0]) == 6
    assert P.read_version(spark, lake).fato_item_licitacao.select("sk_fato_item").distinct().count() == 6
    lost = read_occurrences(spark, f"{root}/silver_periodos/2024-01").filter("regra = 'item_sem_licitacao'").first()
    # What has no tender is counted when the month is loaded: the first load of January cannot know February's tenders.
    assert lost.linhas == (2 if order == ("01", "02") else 1)
    assert read_occurrences(spark, f"{whole}/silver").filter("regra = 'item_sem_licitacao'").first().linhas == 1


def test_a_load_that_concerns_two_periods_makes_their_context_once(spark, tmp_path, write_csv, monkeypatch):
    write_csv("202401_Licitação.csv", TENDER_HEADER, tender("1", "15/01/2024"))
    write_csv("202402_Licitação.csv", TENDER_HEADER, tender("2", "20/02/2024"))
    write_csv("202401_ItemLicitação.csv", ITEM_HEADER, item("1", "7"), item("2", "8"))
    write_csv("202402_ItemLicitação.csv", ITEM_HEADER, item("1", "5"), item("2", "6"))
    write_csv("202401_ParticipantesLicitação.csv", BID_HEADER, offer("2", "8"))
    write_csv("202402_ParticipantesLicitação.csv", BID_HEADER, offer("1", "5"))
    root, made, context = str(tmp_path / "lake"), [], L.gold.tender_context
    ingest_folder(spark, write_csv.folder, f"{root}/bronze")
    refresh_period(spark, root, "2024", "01")
    monkeypatch.setattr(L.gold, "tender_context", lambda *a: made.append(1) or context(*a))
    refresh_period(spark, root, "2024", "02")
    assert len(made) == 1
    assert P.read_version(spark, f"{root}/warehouse").fato_item_licitacao.count() == 4


def won_and_offered(spark, path, rows):
    """The star's facts by natural keys."""
    star = P.read_version(spark, path)
    won = (
        star.fato_item_licitacao.join(star.dim_tempo, "sk_tempo", "left").join(star.dim_licitacao, "sk_licitacao", "left")
        .join(star.dim_produto, "sk_produto").join(star.dim_fornecedor, "sk_fornecedor", "left")
    )
    bids = star.fato_participacao.join(star.dim_licitacao, "sk_licitacao", "left").join(star.dim_fornecedor, "sk_fornecedor", "left")
    return (
        rows(won, "data", "numero_licitacao", "descricao_item", "codigo_fornecedor", "valor_item"),
        rows(bids, "numero_licitacao", "codigo_fornecedor", "flag_vencedor"),
    )


@pytest.fixture
def three_months(write_csv):
    """Tenders, items and bids of three months; some items and bids of February belong to tenders of January and March."""
    for month, numbers in (("01", "12"), ("02", "34"), ("03", "56")):
        write_csv(f"2024{month}_Licitação.csv", TENDER_HEADER, *[tender(n, f"15/{month}/2024") for n in numbers])
        write_csv(f"2024{month}_ItemLicitação.csv", ITEM_HEADER, *[item(n, "7") for n in numbers])
        write_csv(f"2024{month}_ParticipantesLicitação.csv", BID_HEADER, *[offer(n, "7") for n in numbers])
    write_csv("202402_ItemLicitação.csv", ITEM_HEADER, item("3", "7"), item("4", "7"), item("1", "8", "99,00"), item("6", "8", "98,00"))
    write_csv("202401_EmpenhosRelacionados.csv", C.COMMITMENT_COLUMNS)
    return write_csv


def test_a_load_reads_what_the_postings_name_and_writes_what_changed(spark, tmp_path, three_months, rows, monkeypatch):
    monkeypatch.setattr(L, "MOST_CHANGED", 10)
    root = str(tmp_path / "lake")
    three_months("202404_Licitação.csv", TENDER_HEADER, tender("8", "15/04/2024"))
    three_months("202404_ItemLicitação.csv", ITEM_HEADER, item("8", "7"))
    refresh(spark, three_months.folder, root)
    before = rows(P.read_version(spark, f"{root}/warehouse").dim_licitacao)
    seen, real = {}, L._read

    def noted(spark, parts, like):
        for p in parts:
            seen.setdefault(p.table, set()).add(p.period)
        return real(spark, parts, like)

    def load(month, *tenders):
        seen.clear()
        three_months(f"2024{month}_Licitação.csv", TENDER_HEADER, *tenders)
        ingest_folder(spark, three_months.folder, f"{root}/bronze")
        refresh_period(spark, root, "2024", month)
        return P.read_version(spark, f"{root}/warehouse"), {p.table: p.rows for p in V.current_parts(spark, f"{root}/warehouse") if p.delta}

    monkeypatch.setattr(L, "_read", noted)
    star, deltas = load("03", tender("5", "15/03/2024", "Outro nome"), tender("6", "30/03/2024", "Outro nome"), tender("7", "15/03/2024", "Outro nome"))
    # tender 6 has an item in February, and that month's other items have tenders in January: April is left alone
    assert seen[L.ITEMS] == {"2024-03", "2024-02"} == seen[L.BIDS]
    assert seen[L.CONTEXT] == {"2024-03", "2024-02", "2024-01"}
    assert seen[L.POSTINGS] == {"2024-01", "2024-02", "2024-03", "2024-04"}
    # one new tender, one new day and one unit with another name are written; all keys stay
    assert deltas == {"dim_orgao": 1, "dim_licitacao": 1, "dim_tempo": 1}
    assert [r.nome_ug for r in star.dim_orgao.collect()] == ["Outro nome"]
    after = rows(star.dim_licitacao)
    assert set(before) < set(after) and len(after) == len(before) + 1
    # nothing new about any member: no folder is added
    star, deltas = load("04", tender("8", "15/04/2024", "Outro nome"))
    assert seen[L.ITEMS] == seen[L.BIDS] == seen[L.CONTEXT] == {"2024-04"}
    assert deltas == {"dim_orgao": 1, "dim_licitacao": 1, "dim_tempo": 1} and rows(star.dim_licitacao) == after
    # too many folders become one
    monkeypatch.setattr(L, "MOST_FOLDERS", 0)
    star, deltas = load("04", tender("8", "15/04/2024"))
    assert deltas == {"dim_licitacao": 1, "dim_tempo": 1} and rows(star.dim_licitacao) == after
    assert [r.nome_ug for r in star.dim_orgao.collect()] == ["Unidade"]


def test_months_corrected_after_a_full_refresh(spark, tmp_path, three_months, rows, monkeypatch):
    """Only changed files are read, only their months are loaded, and the star equals one built from scratch."""
    root, whole = str(tmp_path / "lake"), str(tmp_path / "whole")
    assert refresh_changes(spark, three_months.folder, root) == ["2024-01", "2024-02", "2024-03"]
    keys = {r.numero_licitacao: r.sk_licitacao for r in P.read_version(spark, f"{root}/warehouse").dim_licitacao.collect()}
    three_months("202401_Licitação.csv", TENDER_HEADER, tender("1", "16/01/2024"), tender("2", "15/01/2024"), tender("9", "17/01/2024"))
    three_months("202401_ItemLicitação.csv", ITEM_HEADER, item("9", "7"), item("2", "7"))
    path = Path(three_months.folder) / "202403_Licitação.csv"
    path.write_bytes(path.read_bytes())  # the same content again: compared, and nothing is loaded
    ingested, cleaned = [], []
    real_ingest, real_clean = R.ingest_files, R.bronze_to_silver
    monkeypatch.setattr(R, "ingest_files", lambda s, f, b: ingested.extend(r.nome for r in f.collect()) or real_ingest(s, f, b))
    monkeypatch.setattr(R, "bronze_to_silver", lambda s, b, f, p=None: cleaned.append(p) or real_clean(s, b, f, p))
    assert refresh_changes(spark, three_months.folder, root) == ["2024-01"]
    assert sorted(ingested) == ["202401_ItemLicitação.csv", "202401_Licitação.csv"] and cleaned == [[("2024", "01")]]
    refresh(spark, three_months.folder, whole)
    assert won_and_offered(spark, f"{root}/warehouse", rows) == won_and_offered(spark, f"{whole}/warehouse", rows)
    grown = {r.numero_licitacao: r.sk_licitacao for r in P.read_version(spark, f"{root}/warehouse").dim_licitacao.collect()}
    assert keys.items() <= grown.items() and grown["9"] == max(grown.values()) == len(grown)
    facts = P.read_version(spark, f"{root}/warehouse").fato_item_licitacao
    assert facts.select("sk_fato_item").distinct().count() == facts.count() == 8
    assert refresh_changes(spark, three_months.folder, root) == []


def test_dimension_changes_by_hand(spark, rows):
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (5, "e", None)], "sk int, k string, v string")
    batch = spark.createDataFrame([("b", "Y"), ("a", "x"), ("d", "z"), ("c", None), ("e", None), (None, "n")], "k string, v string")
    assert rows(I.dimension_changes(dim, batch, ["k"], "sk")) == [(2, "b", "Y"), (6, "c", None), (7, "d", "z")]
    assert rows(I.dimension_changes(dim, batch, ["k"], "sk", last=9), "sk") == [(10,), (11,), (2,)]
    with pytest.raises(ValueError, match="1 members"):
        I.dimension_changes(dim, batch.union(batch.filter("k = 'a'")), ["k"], "sk")


def test_overlapping_key_ranges_close_the_gate(spark):
    parts = [V.Part(C.FATO_ITEM.name, "x", "1", 10, 1), V.Part(C.FATO_ITEM.name, "y", "2", 20, 11), V.Part(C.FATO_ITEM.name, "z", "3")]
    assert [r.violacoes for r in key_ranges(spark, C.FACTS, parts).collect()] == [0, 0]
    parts.append(V.Part(C.FATO_ITEM.name, "w", "4", 30, 20))
    with pytest.raises(GateClosed, match="key_ranges: 1"):
        P.gate(key_ranges(spark, C.FACTS, parts))


def test_groups_are_numbered_one_after_the_other(spark, rows):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'a', cast(id % 40 as string)) as g").repartition(7)
    ends = assign_key_by_group(df, "n", "g", start=11).groupBy("g").agg(F.min("n").alias("a"), F.max("n").alias("z"), F.count("n").alias("c"))
    found = sorted((r.a, r.z, r.c, r.g) for r in ends.collect())
    assert [a for a, *_ in found] == [11, *[z + 1 for _, z, _, _ in found[:-1]]] and all(z - a + 1 == c for a, z, c, _ in found)
    assert [g for *_, g in found] == sorted(g for *_, g in found) and found[-1][1] == 5010


def test_oddities_are_reported(spark, tmp_path, landing):
    landing("202403_Licitação.csv", TENDER_HEADER, (*tender("4", "01/03/2024", "Outro nome")[:12], "xx", *tender("4", "01/03/2024")[13:]))
    root = str(tmp_path / "lake")
    refresh(spark, landing.folder, root)
    found = {(r.regra, r.valor, r.linhas) for r in read_occurrences(spark, f"{root}/silver").collect()}
    assert found == {("uf_invalida", "XX", None), ("unidade_com_varios_nomes", "10", 2), ("item_sem_licitacao", None, 1)}


def test_a_load_built_on_an_older_version_is_refused(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.createDataFrame([(1, "a", 1.0)], "id int, nome string, v double")
    P.publish_if_clean(spark, {"t": frame}, root, (TABLE,))
    base, parts = V.current_version(spark, root), V.current_parts(spark, root)
    P.publish_if_clean(spark, {"t": frame}, root, (TABLE,))
    with pytest.raises(V.VersionMoved):
        V.publish_parts(spark, root, V.new_version(), parts, base)


def test_failed_period_load_leaves_no_folder(spark, tmp_path, landing, monkeypatch):
    root = str(tmp_path / "lake")
    ingest_folder(spark, landing.folder, f"{root}/bronze")
    refresh_period(spark, root, "2024", "01")
    before = sorted(p.name for p in (tmp_path / "lake/warehouse/versoes").iterdir())

    def breaks(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr("tenderlake.plans.period_load.check_contract", breaks)
    with pytest.raises(RuntimeError):
        refresh_period(spark, root, "2024", "02")
    assert sorted(p.name for p in (tmp_path / "lake/warehouse/versoes").iterdir()) == before


def test_shuffle_setting_comes_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 100 << 40) as partitions:
        assert partitions == 102400
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_refresh_stops_at_the_gate(spark, tmp_path, landing, rows):
    root = str(tmp_path / "lake")
    refresh(spark, landing.folder, root)
    version = V.current_version(spark, f"{root}/warehouse")
    landing("202403_Licitação.csv", TENDER_HEADER, (tender("3", "01/03/2024")[0], "20", "x" * 201, *tender("3", "01/03/2024")[3:]))
    with pytest.raises(GateClosed, match="dim_orgao.nome_ug length: 1"):
        refresh(spark, landing.folder, root)
    assert V.current_version(spark, f"{root}/warehouse") == version


def test_period_with_a_missing_natural_key_is_refused(spark, tmp_path, landing):
    root = str(tmp_path / "lake")
    landing("202402_ParticipantesLicitação.csv", BID_HEADER, ("2", "10", "5", "7", "", "1" * 14, "ACME", "SIM"))
    ingest_folder(spark, landing.folder, f"{root}/bronze")
    with pytest.raises(GateClosed, match="dim_produto.descricao_item not_null: 1"):
        refresh_period(spark, root, "2024", "02")
    assert V.current_version(spark, f"{root}/warehouse") is None


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 0) == int(before)
        assert size_shuffles(spark, 100 << 40) == 102400
        assert size_shuffles(spark, 1) == 102400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_staged_tables_go_with_their_job(spark):
    paths = []

    def stage():
        table = staged(spark.range(3))
        paths.extend(table.inputFiles())
        return table.count()

    with pytest.raises(ValueError), scratch(spark):
        assert side_by_side(spark, {"a": stage, "b": stage}) == {"a": 3, "b": 3}
        assert all(path_exists(spark, p) for p in paths)
        raise ValueError
    assert paths and not any(path_exists(spark, p) for p in paths)
    stage()
    assert path_exists(spark, paths[-1])


class Settings:
    """Stands in for a session: only its settings are asked for."""

    def __init__(self, **values):
        self.conf = self
        self.values = {k.replace("__", "."): v for k, v in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_shared_folder_comes_from_the_session():
    assert shared_dir(Settings(spark__checkpoint__dir="/some/folder/")) == "/some/folder"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Settings(spark__master="spark://host:7077"))
