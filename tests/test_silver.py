"""Cleaning rules and quality counts."""

from datetime import date
from decimal import Decimal

import pytest

from tenderlake import contracts as C
from tenderlake.operators.keys import split_repeated
from tenderlake.plans import silver as S
from tenderlake.plans.versions import replaced_set
from tenderlake.session import SPLIT_BYTES, fine_splits

PARTS = {C.YEAR_PART: "2024", C.MONTH_PART: "01"}

TENDER = {
    "Número Licitação": "1", "Código UG": "10", "Nome UG": "  UG   Um ", "Código Modalidade Compra": "5",
    "Modalidade Compra": "Pregão", "Número Processo": "P1", "Objeto": "obj", "Situação Licitação": "ok",
    "Código Órgão Superior": "1", "Nome Órgão Superior": "Sup", "Código Órgão": "2", "Nome Órgão": "Org",
    "UF": "DF", "Município": "Brasília", "Data Resultado Compra": "15/01/2024", "Data Abertura": "10/01/2024",
    "Valor Licitação": "1.000,00",
}
ITEM = {
    "Número Licitação": "1", "Código UG": "10", "Código Modalidade Compra": "5", "Código Item Compra": "7",
    "Descrição": "Caneta  azul", "Quantidade Item": "4", "Valor Item": "10,00",
    "Código Vencedor": "1" * 14, "Nome Vencedor": "ACME",
}
BID = {
    "Número Licitação": "1", "Código UG": "10", "Código Modalidade Compra": "5", "Código Item Compra": "7",
    "Descrição Item Compra": "Caneta  azul", "Código Participante": "1" * 14, "Nome Participante": "A  B",
    "Flag Vencedor": "SIM",
}
COMMITMENT = {
    "Número Licitação": "1", "Código Empenho": "E1", "Valor Empenho (R$)": "-5,00", "Data Emissão Empenho": "1/2/2024",
}


def frame(spark, base, *changes):
    records = [{**base, **PARTS, **change, C.ROW_ORD: i} for i, change in enumerate(changes)]
    names = [*base, *PARTS, C.ROW_ORD]
    kinds = ", ".join(f"`{n}` {'long' if n == C.ROW_ORD else 'string'}" for n in names)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in records], kinds)


def run(clean, df):
    out, report = clean(df)
    return out.orderBy(C.ROW_ORD).collect(), report.first().asDict()


def test_tender_types_and_texts(spark):
    (row,), report = run(S.clean_tenders, frame(spark, TENDER, {}))
    assert row["Nome UG"] == "UG Um"
    assert row["Valor Licitação"] == Decimal("1000.00")
    assert row["Data Resultado Compra"] == date(2024, 1, 15)
    assert (report["linhas_entrada"], report["linhas_saida"]) == (1, 1)


def test_bad_state_is_emptied_and_counted(spark):
    out, report = run(S.clean_tenders, frame(spark, TENDER, {"UF": "-3"}, {"UF": " sp "}, {"UF": None, "Objeto": "x"}))
    assert [r["UF"] for r in out] == [None, "SP", None]
    assert report["uf_invalida_corrigida"] == 2


def test_negative_tender_is_dropped_and_unknown_value_kept(spark):
    out, report = run(
        S.clean_tenders, frame(spark, TENDER, {"Valor Licitação": "-1,00"}, {"Valor Licitação": None}, {"UF": "-3", "Valor Licitação": "-1,00"})
    )
    assert [r["Valor Licitação"] for r in out] == [None]
    assert report["valores_negativos_removidos"] == 2
    # States are counted before negative rows go.
    assert report["uf_invalida_corrigida"] == 1


def test_equal_rows_merge_and_the_first_ordinal_stays(spark):
    out, report = run(S.clean_tenders, frame(spark, TENDER, {}, {"Nome UG": "UG Um"}, {"Objeto": "outro"}))
    assert [r[C.ROW_ORD] for r in out] == [0, 2]
    assert report["duplicados_removidos"] == 1


def test_same_row_in_two_months_is_no_duplicate(spark):
    out, _ = run(S.clean_tenders, frame(spark, TENDER, {}, {C.MONTH_PART: "02"}))
    assert len(out) == 2


def test_bad_dates_are_emptied_and_counted(spark):
    out, report = run(
        S.clean_tenders, frame(spark, TENDER, {"Data Abertura": "32/01/2024"}, {"Data Abertura": "x", "Data Resultado Compra": "y"}, {"Data Abertura": None, "Objeto": "x"})
    )
    assert [r["Data Abertura"] for r in out] == [None, None, None]
    assert report["datas_invalidas"] == 3


def test_missing_item_code_gets_its_ordinal(spark):
    out, report = run(S.clean_items, frame(spark, ITEM, {}, {"Código Item Compra": None}))
    assert [(r["Código Item Compra"], r["codigo_item_gerado"]) for r in out] == [("7", False), ("SEM_CODIGO_1", True)]
    assert report["codigo_item_gerado"] == 1


def test_equal_items_without_code_merge_before_codes_are_made(spark):
    change = {"Código Item Compra": None}
    out, report = run(S.clean_items, frame(spark, ITEM, {}, change, change))
    assert [r["Código Item Compra"] for r in out] == ["7", "SEM_CODIGO_1"]
    assert (report["duplicados_removidos"], report["codigo_item_gerado"]) == (1, 1)


def test_negative_item_is_dropped(spark):
    out, report = run(S.clean_items, frame(spark, ITEM, {"Valor Item": "-0,01", "Código Item Compra": None}, {}))
    assert len(out) == 1
    assert (report["valores_negativos_removidos"], report["codigo_item_gerado"]) == (1, 0)


@pytest.mark.parametrize(
    "code,kind", [("1" * 14, "CNPJ"), (" " + "1" * 11 + " ", "CPF"), ("-11", "OUTRO"), ("ESTRANG1", "OUTRO"), (None, "DESCONHECIDO")]
)
def test_winner_document(spark, code, kind):
    (row,), _ = run(S.clean_items, frame(spark, ITEM, {"Código Vencedor": code}))
    assert row["tipo_documento_vencedor"] == kind
    assert row["Código Vencedor"] == (code.strip() if code else None)


def test_participant_codes(spark):
    out, report = run(
        S.clean_participants,
        frame(spark, BID, {"Código Participante": "-11"}, {"Código Participante": "ESTRANG0032850"}, {"Código Participante": None}, {}),
    )
    assert [r["Código Participante"] for r in out] == [None, "ESTRANG0032850", "1" * 14]
    assert (report["participante_invalido_corrigido"], report["participante_estrangeiro"]) == (2, 1)
    # The two emptied rows are equal now, so they merge.
    assert report["duplicados_removidos"] == 1


def test_winner_flag_and_raw_description(spark):
    out, _ = run(S.clean_participants, frame(spark, BID, {}, {"Flag Vencedor": "NÃO"}, {"Flag Vencedor": None, "Nome Participante": "C"}))
    assert [r["flag_vencedor"] for r in out] == [True, False, False]
    assert "Flag Vencedor" not in out[0].asDict()
    assert out[0]["Descrição Item Compra"] == "Caneta  azul"
    assert out[0]["Nome Participante"] == "A B"


def test_commitments_keep_negatives(spark):
    (row,), report = run(S.clean_commitments, frame(spark, COMMITMENT, {}, {}))
    assert row["Valor Empenho (R$)"] == Decimal("-5.00")
    assert row["Data Emissão Empenho"] == date(2024, 2, 1)
    assert (report["linhas_entrada"], report["duplicados_removidos"]) == (2, 1)


def test_report_of_an_empty_data_set(spark):
    out, report = run(S.clean_commitments, frame(spark, COMMITMENT).limit(0))
    assert out == []
    assert {v for k, v in report.items() if k != "dataset"} == {0}


def test_extra_columns_pass_through(spark):
    df = frame(spark, {**ITEM, "Observação": " x "}, {})
    (row,), _ = run(S.clean_items, df)
    assert row["Observação"] == " x "


def test_silver_round_trip_and_missing_table(spark, tmp_path):
    root = str(tmp_path)
    with replaced_set(spark, root) as folder:
        for name, mark, base in (
            (C.TENDERS, S.mark_tenders, TENDER), (C.ITEMS, S.mark_items, ITEM), (C.BIDS, S.mark_bids, BID)
        ):
            S.write_silver(mark(frame(spark, base, {}, {})), folder, name)
    clean = S.read_silver(spark, root)
    assert {n: df.count() for n, df in clean.items()} == {C.TENDERS: 1, C.ITEMS: 1, C.BIDS: 1}
    with pytest.raises(FileNotFoundError):
        S.read_silver(spark, str(tmp_path / "nada"))


def test_samples_of_bad_states(spark):
    df = frame(spark, TENDER, *[{"UF": v} for v in ("-3", "-3", "df", "x1", None)])
    assert [r.UF for r in S.domain_samples(df, "UF", C.STATES).collect()] == [None, "-3", "X1"]


def test_cleaning_reads_fine_splits_and_packs_what_it_writes(spark, tmp_path):
    """The setting holds while blocks overlap, is never raised, and comes back; the table is written under it."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with fine_splits(spark):
        with fine_splits(spark):
            assert spark.conf.get(name) == f"{SPLIT_BYTES}b"
        assert spark.conf.get(name) == f"{SPLIT_BYTES}b"
    assert spark.conf.get(name) == before
    spark.conf.set(name, "64k")
    try:
        with fine_splits(spark):
            assert spark.conf.get(name) == "65536b"
        assert spark.conf.get(name) == "64k"
    finally:
        spark.conf.set(name, before)
    S.write_silver(S.mark_items(frame(spark, ITEM, {}, {})), str(tmp_path), C.ITEMS)
    files = [p.name for p in (tmp_path / C.ITEMS).glob("part-*")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


@pytest.mark.parametrize("clean,base,change", [
    (S.mark_tenders, TENDER, {"Nome UG": "UG Um"}), (S.mark_items, ITEM, {"Descrição": "Caneta azul"}),
    (S.mark_bids, BID, {"Código Participante": " " + "1" * 14 + " "}), (S.mark_commitments, COMMITMENT, {"Valor Empenho (R$)": "-5,0"}),
])
def test_only_rows_that_may_have_copies_are_shuffled(spark, monkeypatch, clean, base, change):
    """A row and one equal to it after cleaning meet; a row of another tender is kept where it lies, with the same counts."""
    taken = []

    def split(*args):
        taken.extend(split_repeated(*args))
        return taken[-2:]

    monkeypatch.setattr(S, "split_repeated", split)
    found = clean(frame(spark, base, {}, change, {"Número Licitação": "2"})).orderBy(C.ROW_ORD).collect()
    assert [(r[C.ROW_ORD], r[S.COPIES], r["Número Licitação"]) for r in found] == [(0, 2, "1"), (2, 1, "2")]
    assert [df.count() for df in taken] == [1, 2]
