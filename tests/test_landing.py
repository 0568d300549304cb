"""Landing files to bronze tables."""

import csv
import io
from pathlib import Path
from random import Random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.sources import landing as L
from tenderlake.sources import records as R
from tenderlake.sources.bronze import load_bronze
from tenderlake.sources.records import count_records
from tenderlake.streaming.landing_stream import land_continuously

TENDER = C.DATASETS[0].required
ROW = ("1", "10", "20", "DF", "10,00")


def states(outcomes):
    return {r.nome: r.status for r in outcomes.collect()}


@pytest.mark.parametrize(
    "name,taken",
    [
        ("202401_Licitação.csv", True),
        ("202412_ItemLicitação.csv", True),
        ("202499_Licitação.csv", True),
        ("Licitação.csv", False),
        ("202401_Licitação.txt", False),
        ("2024_Licitação.csv", False),
        ("202401_Outro.csv", False),
    ],
)
def test_file_names(spark, name, taken):
    files = spark.createDataFrame([(f"/x/{name}", 1)], "path string, bytes long")
    row = L.recognise(files).first()
    assert row.aceito == taken
    if taken:
        assert (row.ano, row.mes) == (name[:4], name[4:6])
    else:
        assert row.motivo in ("nome_fora_do_padrao", "dataset_desconhecido")


@pytest.mark.parametrize(
    "header,lacking",
    [
        ([*TENDER, "Extra"], []),
        ([c for c in TENDER if c != "UF"], ["UF"]),
        (["UF"], [c for c in TENDER if c != "UF"]),
    ],
)
def test_missing_columns_in_declared_order(spark, header, lacking):
    df = spark.createDataFrame([(header, list(TENDER))], "h array<string>, r array<string>")
    assert df.select(L.missing_columns(F.col("h"), F.col("r"))).first()[0] == lacking


@pytest.mark.parametrize("split", [7, 64, 1 << 20])
def test_fingerprint_follows_content_and_order_however_files_are_split(spark, tmp_path, split):
    lines = [f"{i};é" for i in range(40)]
    swapped = [*lines[:3], lines[30], *lines[4:30], lines[3], *lines[31:]]
    texts = {"a": "\n".join(lines), "b": "\n".join(lines), "c": "\n".join(swapped), "d": "\r\n".join(lines),
             "e": "\n".join(lines[:-1]), "f": "", "g": "\n".join([*lines, "", ""])}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode("latin-1"))
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {Path(r.path).stem: r.impressao for r in L.fingerprint_files(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    whole = {Path(r.path).stem: r.impressao for r in L.fingerprint_files(spark, str(tmp_path)).collect()}
    assert got == whole and got["a"] == got["b"]
    assert len(set(got.values())) == 6 and all(len(v) == 64 for v in got.values())


def test_promotion_and_manifest(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", TENDER, ROW, ("2", "10", "20", "SP", "1.234,56"))
    bronze = str(tmp_path / "bronze")
    outcomes = L.ingest_folder(spark, folder, bronze)
    assert states(outcomes) == {"202401_Licitação.csv": C.OK}
    assert (tmp_path / "bronze/licitacoes/ano=2024/mes=01/arquivo=202401_Licitação.csv").is_dir()
    entry = L.read_manifest(spark, bronze).first()
    assert (entry.arquivo_origem, entry.dataset_logico, entry.ano, entry.mes) == (
        "202401_Licitação.csv", "licitacoes", "2024", "01",
    )
    assert (entry.linhas, entry.colunas, entry.status) == (2, list(TENDER), C.OK)
    assert (entry.encoding_original, entry.separador_original) == ("ISO-8859-1", ";")
    assert entry.impressao == L.fingerprint_files(spark, folder).first().impressao
    got = load_bronze(spark, bronze, C.TENDERS).orderBy(C.ROW_ORD).collect()
    assert [(r["UF"], r[C.ROW_ORD], r[C.YEAR_PART], r[C.MONTH_PART]) for r in got] == [
        ("DF", 0, "2024", "01"), ("SP", 1, "2024", "01"),
    ]


def test_rejected_files_leave_no_trace(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", [c for c in TENDER if c != "UF"], ("1", "2", "3", "4"))
    (Path(folder) / "202402_Licitação.csv").write_text("")
    bronze = str(tmp_path / "bronze")
    outcomes = L.ingest_folder(spark, folder, bronze)
    assert set(states(outcomes).values()) == {C.INVALID}
    assert {tuple(r.faltando) for r in outcomes.collect()} == {("UF",), TENDER}
    assert not (tmp_path / "bronze/licitacoes").exists()
    assert L.read_manifest(spark, bronze).count() == 0
    assert load_bronze(spark, bronze, C.TENDERS) is None
    summary = {r.status: (r.arquivos, r.linhas) for r in L.outcome_summary(outcomes).collect()}
    assert summary == {C.INVALID: (2, 1)}


def test_repeated_ingestion_replaces(spark, tmp_path, write_csv, rows):
    folder = write_csv("202401_Licitação.csv", TENDER, ROW, ROW, ROW)
    bronze = str(tmp_path / "bronze")
    for _ in range(2):
        L.ingest_folder(spark, folder, bronze)
    assert load_bronze(spark, bronze, C.TENDERS).count() == 3
    assert L.read_manifest(spark, bronze).count() == 1
    assert L.read_manifest(spark, bronze, history=True).count() == 2


SEVERAL = (C.DatasetSpec("Licitação-1", C.TENDERS, TENDER), C.DatasetSpec("Licitação-2", C.TENDERS, TENDER))


def test_files_of_one_period_stand_side_by_side(spark, tmp_path, write_csv):
    """A file replaces itself only, whether the other one came before, together with it, or not at all."""
    bronze = str(tmp_path / "bronze")
    folder = write_csv("202401_Licitação-1.csv", TENDER, ROW, ROW)
    L.ingest_folder(spark, folder, bronze, SEVERAL)
    (Path(folder) / "202401_Licitação-1.csv").unlink()
    write_csv("202401_Licitação-2.csv", TENDER, ROW)
    L.ingest_folder(spark, folder, bronze, SEVERAL)
    assert load_bronze(spark, bronze, C.TENDERS).count() == 3
    write_csv("202401_Licitação-2.csv", TENDER)
    L.ingest_folder(spark, folder, bronze, SEVERAL)
    assert load_bronze(spark, bronze, C.TENDERS).count() == 2
    manifest = L.read_manifest(spark, bronze).collect()
    assert {(r.arquivo_origem, r.linhas) for r in manifest} == {("202401_Licitação-1.csv", 2), ("202401_Licitação-2.csv", 0)}


@pytest.mark.parametrize("files", [1, 1000])
def test_stream_batches_do_not_erase_each_other(spark, tmp_path, write_csv, files):
    folder = write_csv("202401_Licitação-1.csv", TENDER, ROW, ROW)
    write_csv("202401_Licitação-2.csv", TENDER, ROW)
    bronze = str(tmp_path / "bronze")
    land_continuously(spark, folder, bronze, str(tmp_path / "check"), files_per_batch=files, specs=SEVERAL).awaitTermination()
    assert load_bronze(spark, bronze, C.TENDERS).count() == 3 == sum(r.linhas for r in L.read_manifest(spark, bronze).collect())


def test_header_only_file_empties_its_period(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", TENDER, ROW)
    bronze = str(tmp_path / "bronze")
    L.ingest_folder(spark, folder, bronze)
    write_csv("202401_Licitação.csv", TENDER)
    write_csv("202402_Licitação.csv", TENDER, ROW)
    outcomes = L.ingest_folder(spark, folder, bronze)
    assert states(outcomes) == {"202401_Licitação.csv": C.EMPTY, "202402_Licitação.csv": C.OK}
    got = load_bronze(spark, bronze, C.TENDERS).collect()
    assert [(r[C.MONTH_PART], r[C.ROW_ORD]) for r in got] == [("02", 0)]


def test_changed_content_under_a_known_name(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", TENDER, ROW)
    write_csv("202402_Licitação.csv", TENDER, ROW)
    bronze = str(tmp_path / "bronze")
    L.ingest_folder(spark, folder, bronze)
    write_csv("202402_Licitação.csv", TENDER, ROW, ROW)
    found = L.changed_files(L.fingerprint_files(spark, folder), L.read_manifest(spark, bronze))
    assert [r.arquivo_origem for r in found.collect()] == ["202402_Licitação.csv"]


def test_headers_meet_by_name(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", TENDER, ROW)
    write_csv("202402_Licitação.csv", ["Novo", *reversed(TENDER)], ("x", *reversed(ROW)))
    bronze = str(tmp_path / "bronze")
    L.ingest_folder(spark, folder, bronze)
    got = load_bronze(spark, bronze, C.TENDERS).orderBy(C.ROW_ORD).collect()
    assert [tuple(r[c] for c in TENDER) for r in got] == [ROW, ROW]
    assert [r["Novo"] for r in got] == [None, "x"]


def test_quotes_blank_lines_missing_markers_and_short_records(spark, tmp_path, write_csv):
    text = ";".join(TENDER) + '\n1;"a;b";"diz ""oi""";DF;1,0\n\n2;NA;;"";nan\n3\n'
    folder = Path(write_csv.folder)
    (folder / "202401_Licitação.csv").write_text(text, encoding="latin-1")
    bronze = str(tmp_path / "bronze")
    outcome = L.ingest_folder(spark, str(folder), bronze).first()
    assert (outcome.linhas, outcome.divisivel) == (3, True)
    got = load_bronze(spark, bronze, C.TENDERS).orderBy(C.ROW_ORD).collect()
    assert [tuple(r[c] for c in TENDER) for r in got] == [
        ("1", "a;b", 'diz "oi"', "DF", "1,0"),
        ("2", None, None, None, None),
        ("3", None, None, None, None),
    ]


def test_records_that_span_lines(spark, tmp_path, write_csv):
    text = ";".join(TENDER) + '\n1;"duas\nlinhas";c;DF;1,0\n2;b;c;SP;2,0\n'
    folder = Path(write_csv.folder)
    (folder / "202401_Licitação.csv").write_text(text, encoding="latin-1")
    bronze = str(tmp_path / "bronze")
    outcome = L.ingest_folder(spark, str(folder), bronze).first()
    assert (outcome.linhas, outcome.divisivel) == (2, False)
    got = load_bronze(spark, bronze, C.TENDERS).orderBy(C.ROW_ORD).collect()
    assert [r["Código UG"] for r in got] == ["duas\nlinhas", "b"]


@pytest.mark.parametrize(
    "line,is_open",
    [
        ('a;"b";c', False), ('"a;b"', False), ('"a""b";c', False), ('"";""', False), ("a;b", False),
        ('a;"b', True), ('b";c', True), ('5";"foo', True), ('bar";6"', True), ('a;5" cano;c', True),
    ],
)
def test_open_quotes(spark, line, is_open):
    df = spark.createDataFrame([(line,)], "l string")
    assert df.select(L.has_open_quote(F.col("l"))).first()[0] == is_open


def test_lines_called_whole_are_whole_records(spark):
    """Random lines, against the csv module: a whole line never swallows the next one."""
    random = Random(7)
    lines = ["".join(random.choices('";a ', k=random.randint(1, 12))) for _ in range(4000)]
    df = spark.createDataFrame([(line,) for line in lines], "l string")
    found = df.select("l", L.has_open_quote(F.col("l")).alias("o")).collect()
    whole = [r.l for r in found if not r.o]
    assert 200 < len(whole) < 3800
    for line in whole:
        assert len(list(csv.reader([line + "\n", "zz\n"], delimiter=";"))) == 2, line


def test_random_files_read_like_a_reference_parser(spark, tmp_path, write_csv):
    """Random cells with quotes, separators, line ends, accents and missing markers."""
    random = Random(11)
    pieces = ["a", "ç", '"', ";", "\n", " ", "\u00a0", "NA", "1,5", "nan", ""]
    cells = [["".join(random.choices(pieces, k=random.randint(0, 4))) for _ in TENDER] for _ in range(300)]
    cells = [[str(i), *row[1:]] for i, row in enumerate(cells)]
    for month, plain in (("01", False), ("02", True)):
        path = Path(write_csv.folder) / f"2024{month}_Licitação.csv"
        with path.open("w", encoding="latin-1", newline="") as out:
            writer = csv.writer(out, delimiter=";", lineterminator="\n", quoting=csv.QUOTE_ALL if plain else csv.QUOTE_MINIMAL)
            writer.writerow(TENDER)
            writer.writerows([c.replace("\n", "|") for c in row] if plain else row for row in cells)
    bronze = str(tmp_path / "bronze")
    outcomes = {r.mes: r for r in L.ingest_folder(spark, write_csv.folder, bronze).collect()}
    assert {m: (r.linhas, r.divisivel) for m, r in outcomes.items()} == {"01": (300, False), "02": (300, True)}
    got = load_bronze(spark, bronze, C.TENDERS).orderBy(C.ROW_ORD).collect()
    for month in ("01", "02"):
        expected = pd.read_csv(f"{write_csv.folder}/2024{month}_Licitação.csv", sep=";", encoding="latin-1", dtype=str)
        expected = [[None if pd.isna(v) else v for v in row] for row in expected.values.tolist()]
        assert [[r[c] for c in TENDER] for r in got if r[C.MONTH_PART] == month] == expected


def spanning_file(random, header, rows, end, quoting):
    """Random cells with quotes, separators and line ends, the latter as the file's own."""
    pieces = ["a", "ç", '"', ";", end, " ", "1,5", "", "lon" * 30]
    cells = [[str(i), *["".join(random.choices(pieces, k=random.randint(0, 4))) for _ in header[1:]]] for i in range(rows)]
    out = io.StringIO(newline="")
    writer = csv.writer(out, delimiter=";", lineterminator=end, quoting=quoting)
    writer.writerow(header)
    for row in cells:
        writer.writerow(row)
        if random.random() < 0.1:
            out.write(end)
    return out.getvalue()


@pytest.mark.parametrize("split", [300])
def test_records_in_splits_equal_the_parser_on_whole_files(spark, tmp_path, split):
    random = Random(split)
    header, two_lines = ["n", "b", "c"], ["n", "b\nb", "c"]
    texts = {
        "a": spanning_file(random, header, 30, "\n", csv.QUOTE_MINIMAL), "b": spanning_file(random, header, 30, "\n", csv.QUOTE_ALL),
        "c": spanning_file(random, header, 20, "\r\n", csv.QUOTE_MINIMAL), "d": spanning_file(random, two_lines, 15, "\n", csv.QUOTE_MINIMAL),
        "e": 'n;b;c\n1;"' + "x;\n" * 300 + '";2\n3;4;5',  # one record over many splits, no last line end
        "f": '\n\nn;b;c\n\n"1";"a\n\nb";""\n\n',
    }
    for name, content in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(content.encode("latin-1"))
    paths = [str(tmp_path / f"{name}.csv") for name in texts]
    whole = L.read_landing_csv(spark, paths, header, splittable=False, provenance=True)
    want = {}
    for r in whole.orderBy(L.FILE, L.LINE_ID).collect():
        want.setdefault(r[L.FILE], []).append((r.n, r.b, r.c))
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        counted = {r.path: (r.correto, r.registros - 1) for r in count_records(spark, paths, L.source_path()).collect()}
        found = L.read_spanning_csv(spark, paths, header, provenance=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    got, places = {}, {}
    for r in sorted(found, key=lambda r: (r[L.FILE], r[L.BLOCK], r[L.LINE_ID])):
        got.setdefault(r[L.FILE], []).append((r.n, r.b, r.c))
        places.setdefault((r[L.FILE], r[L.BLOCK]), []).append(r[L.LINE_ID])
    assert got == want
    assert counted == {p: (True, len(rows)) for p, rows in want.items()}
    assert all(ids == list(range(ids[0], ids[0] + len(ids))) for ids in places.values())
    assert len(places) > 2 * len(paths)  # several tasks had a part of a file


def test_files_that_do_not_quote_properly_are_told(spark, tmp_path):
    proper = {"a": 'n;b\n1;"x\ny"\n', "b": "n;b\n1;2\n", "c": 'n;b\r\n1;"x\r\ny"\r\n', "d": 'n;b\n"1""";""""\n'}
    improper = {"e": 'n;b\n1;5" cano\n2;"x\ny"\n', "f": 'n;b\n1;"x\ny"z\n', "g": 'n;b\n1;"x\ny\n', "h": 'n;b\r\n1;"x\ny\nz"\r\n2;3\r\n', "i": 'n;b\n1;"x\ry"\n',
                "j": 'n;b\n1;a"b\n2;c"d\n'}
    for name, content in (proper | improper).items():
        (tmp_path / f"{name}.csv").write_bytes(content.encode())
    paths = [str(tmp_path / f"{name}.csv") for name in proper | improper]
    found = {Path(r.path).stem: r.correto for r in count_records(spark, paths, L.source_path()).collect()}
    assert found == dict.fromkeys(proper, True) | dict.fromkeys(improper, False)
    with pytest.raises(ValueError, match="not properly quoted"):
        L.read_spanning_csv(spark, paths, ["n", "b"])


def test_improper_files_are_still_read(spark, tmp_path, write_csv):
    text = ";".join(TENDER) + '\n1;5" cano;c;DF;1,0\n2;"duas\nlinhas";c;SP;2,0\n'
    (Path(write_csv.folder) / "202401_Licitação.csv").write_text(text, encoding="latin-1")
    outcome = L.ingest_folder(spark, write_csv.folder, str(tmp_path / "bronze")).first()
    assert (outcome.linhas, outcome.leitura) == (2, L.WHOLE_FILE)
    got = load_bronze(spark, str(tmp_path / "bronze"), C.TENDERS).orderBy(C.ROW_ORD).collect()
    assert [r["Código UG"] for r in got] == ['5" cano', "duas\nlinhas"]


def test_record_longer_than_header_stops(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", TENDER, (*ROW, "a mais"))
    with pytest.raises(PySparkException, match="record longer than header"):
        L.ingest_folder(spark, folder, str(tmp_path / "bronze"))


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_row_ordinal_over_split_files(spark, tmp_path, write_csv, split):
    """Small splits cut each file into many blocks; the order of lines must not change."""
    expected = []
    for month in ("01", "02", "03"):
        lines = [(f"{month}-{i}", "10", "20", "DF", "1,0") for i in range(200)]
        expected += [line[0] for line in lines]
        folder = write_csv(f"2024{month}_Licitação.csv", TENDER, *lines)
    bronze = str(tmp_path / "bronze")
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        L.ingest_folder(spark, folder, bronze)
        got = load_bronze(spark, bronze, C.TENDERS).orderBy(C.ROW_ORD).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    assert [r["Número Licitação"] for r in got] == expected
    assert [r[C.ROW_ORD] for r in got] == list(range(600))


def test_missing_data_set(spark, tmp_path):
    root = str(tmp_path / "bronze")
    assert load_bronze(spark, root, C.ITEMS) is None
    empty = load_bronze(spark, root, C.COMMITMENTS, allow_empty=True)
    assert empty.count() == 0
    assert set(C.COMMITMENT_COLUMNS) <= set(empty.columns)


def test_period_restriction_reads_only_those_partitions(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", TENDER, ROW)
    write_csv("202402_Licitação.csv", TENDER, ROW, ROW)
    bronze = str(tmp_path / "bronze")
    L.ingest_folder(spark, folder, bronze)
    got = load_bronze(spark, bronze, C.TENDERS, periods=[("2024", "02")])
    assert [r[C.MONTH_PART] for r in got.collect()] == ["02", "02"]


def test_stream_ingests_new_files_once(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", TENDER, ROW)
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "check")
    seen = []

    def run():
        def note(outcomes, batch):
            seen.append(sorted(r.nome for r in outcomes.collect()))

        land_continuously(spark, folder, bronze, checkpoint, note).awaitTermination()

    run()
    run()
    write_csv("202402_Licitação.csv", TENDER, ROW, ROW)
    write_csv("lixo.csv", TENDER, ROW)
    run()
    assert seen == [["202401_Licitação.csv"], ["202402_Licitação.csv"]]
    batch = str(tmp_path / "batch")
    L.ingest_folder(spark, folder, batch)
    streamed, whole = (load_bronze(spark, r, C.TENDERS) for r in (bronze, batch))
    assert streamed.exceptAll(whole).isEmpty() and whole.exceptAll(streamed).isEmpty()


def test_stream_replaces_rewritten_files_and_leaves_the_others(spark, tmp_path, write_csv):
    folder = write_csv("202401_Licitação.csv", TENDER, ROW)
    write_csv("202402_Licitação.csv", TENDER, ROW, ROW)
    bronze, checkpoint, seen, read = str(tmp_path / "bronze"), str(tmp_path / "check"), [], []

    def run():
        seen.clear()
        land_continuously(spark, folder, bronze, checkpoint, lambda out, n: seen.extend((n, r.nome) for r in out.collect())).awaitTermination()

    run()
    write_csv("202401_Licitação.csv", TENDER, ROW, ROW, ROW)
    same = Path(folder) / "202402_Licitação.csv"
    same.write_bytes(same.read_bytes())
    run()
    assert seen == [(-1, "202401_Licitação.csv")]
    assert load_bronze(spark, bronze, C.TENDERS).count() == 5
    # what was only touched has been noted, and is not compared again
    files = L.discover_landing(spark, folder)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(L, "scan_lines", lambda *a: read.append(a))
        assert L.unseen_files(spark, files, bronze).isEmpty() and not read
    # a rewritten file and a new one in the same batch
    write_csv("202402_Licitação.csv", TENDER, ROW)
    write_csv("202403_Licitação.csv", TENDER, ROW)
    run()
    assert sorted(name for _, name in seen) == ["202402_Licitação.csv", "202403_Licitação.csv"]
    assert load_bronze(spark, bronze, C.TENDERS).count() == 5


def test_small_splits_share_tasks(spark, tmp_path):
    text = "a;b\n" + "".join(f'{i};"x\n;{i}"\n' for i in range(4000))
    path = str(tmp_path / "202401_A.csv")
    Path(path).write_bytes(text.encode("latin-1"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = {r.path: r.impressao for r in L.scan_lines(spark, [path]).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        lines = R._lines(spark, [path], L.source_path(), C.SOURCE_ENCODING)
        splits = lines.select("bloco").distinct().count()
        assert splits > 40 and lines.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert {r.path: r.impressao for r in L.scan_lines(spark, [path]).collect()} == whole
        assert [(r.linhas, r.leitura) for r in L.profile_files(spark, [path]).collect()] == [(4000, L.BY_RECORD)]
        got = sorted((int(r.a), r.b) for r in L.read_spanning_csv(spark, [path], ["a", "b"]).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, f"x\n;{i}") for i in range(4000)]
