"""Dumped API pages."""

import json

import pytest
from pyspark.errors import PySparkException

from tenderlake.sources import pages as P


@pytest.fixture
def dumps(tmp_path):
    for page, rows in ((1, 3), (2, 1)):
        body = {"data": [{"id": page * 10 + i, "b": {"x": i}} for i in range(rows)], "totalRegistros": 4, "totalPaginas": 2}
        (tmp_path / f"modalidade_6_pagina_{page}.json").write_text(json.dumps(body, indent=2))
    (tmp_path / "modalidade_8_pagina_1.json").write_text(
        json.dumps({"data": [{"id": 1, "a": None}], "totalRegistros": 9, "totalPaginas": 3})
    )
    (tmp_path / "orgao_26000_pagina_1.json").write_text(json.dumps([{"id": i, "ç": "é"} for i in range(15)]))
    (tmp_path / "orgao_26000_pagina_2.json").write_text(json.dumps([{"id": 99}]))
    (tmp_path / "orgao_1_pagina_1.json").write_text("[]")
    (tmp_path / "outro.json").write_text("[1]")
    return str(tmp_path)


def test_enveloped_records(spark, dumps, rows):
    got = P.read_page_dumps(spark, dumps, "envelope", "id long, b struct<x: long>")
    assert rows(got, "origem", "pagina", "posicao", "id") == [
        (6, 1, 0, 10), (6, 1, 1, 11), (6, 1, 2, 12), (6, 2, 0, 20), (8, 1, 0, 1),
    ]


def test_array_records(spark, dumps, rows):
    got = P.read_page_dumps(spark, dumps, "array")
    assert got.count() == 16
    assert json.loads(got.filter("pagina = 1 AND posicao = 0").first().registro) == {"id": 0, "ç": "é"}


def test_profiles(spark, dumps):
    by_origin = {r.origem: r for r in P.profile_pages(P.read_pages(spark, dumps, "envelope")).collect()}
    assert (by_origin[6].registros_lidos, by_origin[6].paginas_lidas, by_origin[6].completo) == (4, 2, True)
    assert (by_origin[8].registros_lidos, by_origin[8].chegou_ao_fim, by_origin[8].completo) == (1, False, False)
    arrays = {r.origem: r for r in P.profile_pages(P.read_pages(spark, dumps, "array")).collect()}
    assert (arrays[26000].registros_lidos, arrays[26000].completo) == (16, True)
    assert (arrays[1].registros_lidos, arrays[1].completo) == (0, True)


def test_field_inventory(spark, dumps):
    rows = P.read_page_dumps(spark, dumps, "envelope").filter("origem = 6")
    assert [r.campo for r in P.field_inventory(rows).collect()] == ["b", "id"]
    every = P.read_page_dumps(spark, dumps, "envelope")
    assert {(r.campo, r.registros) for r in P.field_inventory(every, scope="all").collect()} == {
        ("a", 1), ("b", 4), ("id", 5),
    }
    with pytest.raises(ValueError):
        P.field_inventory(every, scope="some")


def test_unreadable_pages_are_told_and_never_complete(spark, tmp_path, rows):
    for name, text in {
        "modalidade_1_pagina_1.json": '{"data": [{"id": 1}, {"i', "modalidade_2_pagina_1.json": "gateway error",
        "modalidade_3_pagina_1.json": '{"data": {"id": 1}, "totalPaginas": 1}', "modalidade_4_pagina_1.json": '{"totalRegistros": 0, "totalPaginas": 1}',
        "modalidade_5_pagina_1.json": '{"data": [{"id": 5}], "totalRegistros": 1, "totalPaginas": 1}',
        "orgao_1_pagina_1.json": '[{"id": 1}, {"i', "orgao_2_pagina_1.json": "", "orgao_3_pagina_1.json": '{"erro": 1}', "orgao_4_pagina_1.json": ' [{"id": 4}]',
    }.items():
        (tmp_path / name).write_text(text)
    folder = str(tmp_path)
    profiles = {layout: {r.origem: (r.paginas_ilegiveis, r.completo) for r in P.profile_pages(P.read_pages(spark, folder, layout)).collect()}
                for layout in ("envelope", "array")}
    assert profiles["envelope"] == {1: (1, False), 2: (1, False), 3: (1, False), 4: (0, True), 5: (0, True)}
    assert profiles["array"] == {1: (1, False), 2: (1, False), 3: (1, False), 4: (0, True)}
    for layout in ("envelope", "array"):
        with pytest.raises(PySparkException, match="unreadable page: 1/1"):
            P.read_page_dumps(spark, folder, layout).filter("origem = 1").collect()
        assert rows(P.read_page_dumps(spark, folder, layout, "id long", skip_unreadable=True), "origem", "id") == [
            {"envelope": (5, 5), "array": (4, 4)}[layout]
        ]
