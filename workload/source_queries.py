"""Landing files, bronze tables, page dumps and the landing stream, on data of the driver tables."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.functions.columns import parse_brl
from tenderlake.operators.joins import orphan_count
from tenderlake.plans import occurrences
from tenderlake.plans.versions import replaced_set
from tenderlake.session import new_folder, staged
from tenderlake.sources import landing as L
from tenderlake.sources import pages as P
from tenderlake.sources.bronze import load_bronze
from tenderlake.streaming.landing_stream import land_continuously
from workload.adapters import silver, table, text
from workload.registry import query

_HEADER = ("Chave", "Comprador", "Texto", "Total")
_landed: dict[tuple[str, str], str] = {}
_ingested: dict[tuple[str, str], tuple[str, DataFrame]] = {}

# What the landing files hold: quotes, separators, markers of missing values and accents.
_TEXT = """CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'a;"b"; ' || o_orderkey
  WHEN 2 THEN 'Licitação nº ' || o_orderkey ELSE o_orderpriority END"""


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("o_orderkey") % 5
    words = (
        F.when(kind == 0, "NA")
        .when(kind == 1, F.concat(F.lit('a;"b"; '), text("o_orderkey")))
        .when(kind == 2, F.concat(F.lit("Licitação nº "), text("o_orderkey")))
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("periodo"),
        F.col("o_orderstatus").alias("estado"),
        text("o_orderkey").alias("Chave"),
        text("o_custkey").alias("Comprador"),
        words.alias("Texto"),
        F.translate(F.format_number("o_totalprice", 2), ",.", ".,").alias("Total"),
    )


def _landing(spark: SparkSession, sf: str) -> str:
    """Orders as landing files ``AAAAMM_Pedidos<state>-<n>.csv``, a month's rows brought together first, as a source delivers them.

    Filled orders of a month stand in two files, which bronze has to hold side by side. Files grow with the table, their number does not.
    Spark names its output files itself, so each is renamed to the name the source would use.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in _landed:
        return _landed[key]
    written, folder = new_folder(spark, "escrita"), new_folder(spark, "entrada")
    half = F.when(F.col("estado") == "F", F.col("Chave").cast("long") % 2).otherwise(0)
    months = ["periodo", "estado", "metade"]
    _rows(spark, sf).withColumn("metade", half).repartition(*months).write.partitionBy(*months).options(
        header=True, sep=C.SOURCE_SEPARATOR, encoding=C.SOURCE_ENCODING, escape='"'
    ).csv(written)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    seen: dict[str, int] = {}
    for status in files.globStatus(hadoop.Path(f"{written}/*/*/*/*.csv")):
        parts = dict(p.split("=") for p in status.getPath().toString().split("/")[-4:-1])
        stem = f"{parts['periodo']}_Pedidos{parts['estado']}"
        seen[stem] = seen.get(stem, 0) + 1
        files.rename(status.getPath(), hadoop.Path(f"{folder}/{stem}-{seen[stem]}.csv"))
    _landed[key] = folder
    return folder


def _specs(spark: SparkSession, folder: str) -> list[C.DatasetSpec]:
    """One specification per file series; open orders lack a column, finished ones are unknown."""
    names = {r.fonte for r in L.discover_landing(spark, folder).select("fonte").collect()}
    return [
        C.DatasetSpec(n, "pedidos", ("Chave", "Total") + (("Prazo",) if "PedidosP" in n else ()))
        for n in sorted(names)
        if n and "PedidosO" not in n
    ]


def _bronze(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ingested:
        folder, root = _landing(spark, sf), new_folder(spark, "bronze")
        _ingested[key] = root, L.ingest_folder(spark, folder, root, _specs(spark, folder))
    return _ingested[key]


def _state(name: str):
    return F.regexp_extract(name, r"_Pedidos(.)-", 1)


@query(
    "s1_discover_landing",
    """
SELECT DISTINCT strftime(o_orderdate, '%Y') AS ano, strftime(o_orderdate, '%m') AS mes,
  o_orderstatus AS estado, o_orderstatus <> 'O' AS aceito,
  CASE WHEN o_orderstatus = 'O' THEN 'dataset_desconhecido' END AS motivo FROM orders""",
)
def s1(spark, sf):
    folder = _landing(spark, sf)
    found = L.discover_landing(spark, folder, _specs(spark, folder))
    return found.select("ano", "mes", _state("nome").alias("estado"), "aceito", "motivo").distinct()


@query(
    "s2_read_landing_csv",
    """
SELECT s_suppkey, CASE WHEN s_suppkey % 6 <> 0 THEN 'Nº "' || s_name || '"; São ' || s_suppkey END
  AS nome, s_acctbal FROM supplier""",
)
def s2(spark, sf):
    """Suppliers to Latin-1 text with quotes and separators, and back."""
    folder = new_folder(spark, "texto")
    name = F.concat(F.lit('Nº "'), "s_name", F.lit('"; São '), text("s_suppkey"))
    table(spark, sf, "supplier").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 6 == 0, "N/A").otherwise(name).alias("nome"), "s_acctbal"
    ).write.options(
        header=True, sep=C.SOURCE_SEPARATOR, encoding=C.SOURCE_ENCODING, escape='"'
    ).csv(folder)
    back = L.read_landing_csv(spark, [folder], ["s_suppkey", "nome", "s_acctbal"])
    return back.select(
        F.col("s_suppkey").cast("long"), "nome", F.col("s_acctbal").cast("double")
    )


@query(
    "s2_records_over_lines",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority || chr(10) || 'nº "' || o_orderkey || '";' || chr(10) || chr(10) || 'fim' END
  AS texto, o_totalprice FROM orders""",
)
def s2_spanning(spark, sf):
    """Cells with line ends, quotes and separators, read in splits of 64 KiB by the parallel reader."""
    folder, key = new_folder(spark, "texto"), text("o_orderkey")
    words = F.concat(F.col("o_orderpriority"), F.lit('\nnº "'), key, F.lit('";\n\nfim'))
    table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 6 == 0, "N/A").otherwise(words).alias("texto"), "o_totalprice"
    ).coalesce(2).write.options(header=True, sep=C.SOURCE_SEPARATOR, encoding=C.SOURCE_ENCODING, escape='"').csv(folder)
    paths = [r.path for r in L.listing(spark, folder).collect()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        if not L.profile_files(spark, paths).filter(F.col("leitura") != L.BY_RECORD).isEmpty():
            raise AssertionError("the files should be read in splits")
        back = L.read_spanning_csv(spark, paths, ["o_orderkey", "texto", "o_totalprice"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return back.select(F.col("o_orderkey").cast("long"), "texto", F.col("o_totalprice").cast("double"))


@query(
    "s3_load_bronze",
    """
WITH meses AS (
  SELECT strftime(o_orderdate, '%Y') AS ano, strftime(o_orderdate, '%m') AS mes, COUNT(*) AS linhas
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT ano, mes, linhas,
  CAST(COALESCE(SUM(linhas) OVER (ORDER BY ano, mes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS primeira,
  CAST(SUM(linhas) OVER (ORDER BY ano, mes) - 1 AS BIGINT) AS ultima, linhas AS distintas
FROM meses""",
)
def s3(spark, sf):
    """All periods with a row ordinal that runs through them without a gap."""
    rows = load_bronze(spark, _bronze(spark, sf)[0], "pedidos")
    return rows.groupBy(
        F.col(C.YEAR_PART).alias("ano"), F.col(C.MONTH_PART).alias("mes")
    ).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.min(C.ROW_ORD).alias("primeira"),
        F.max(C.ROW_ORD).alias("ultima"),
        F.count_distinct(C.ROW_ORD).alias("distintas"),
    )


@query(
    "s4_profile_files",
    """
SELECT strftime(o_orderdate, '%Y%m') AS periodo, o_orderstatus AS estado, COUNT(*) AS linhas,
  'Chave,Comprador,Texto,Total' AS colunas, true AS divisivel
FROM orders GROUP BY 1, 2""",
)
def s4(spark, sf):
    folder = _landing(spark, sf)
    paths = [r.path for r in L.listing(spark, folder).collect()]
    profile = L.profile_files(spark, paths).withColumn("nome", L.file_name(F.col("path")))
    return profile.groupBy(
        F.left("nome", F.lit(6)).alias("periodo"), _state("nome").alias("estado")
    ).agg(
        F.sum("linhas").alias("linhas"),
        F.max(F.array_join("colunas", ",")).alias("colunas"),
        F.min("divisivel").alias("divisivel"),
    )


@query(
    "s5_missing_columns",
    """
SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS periodo, o_orderstatus AS estado,
  CASE WHEN o_orderstatus = 'P' THEN 'Prazo' ELSE '' END AS faltando
FROM orders WHERE o_orderstatus <> 'O'""",
)
def s5(spark, sf):
    outcomes = _bronze(spark, sf)[1]
    return outcomes.select(
        F.concat("ano", "mes").alias("periodo"), _state("nome").alias("estado"),
        F.array_join("faltando", ",").alias("faltando"),
    ).distinct()


@query(
    "s6_fingerprint_files",
    """
SELECT strftime(o_orderdate, '%Y%m') AS arquivo, true AS igual_a_copia, COUNT(*) < 2 AS igual_com_linhas_trocadas
FROM orders GROUP BY 1""",
)
def s6(spark, sf):
    """Each month's orders as a file, as a copy of it, and as a copy with its first two lines swapped."""
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("arquivo"), F.concat_ws(";", "o_orderkey", "o_totalprice").alias("value"),
        "o_orderkey", F.xxhash64("o_orderkey", "o_totalprice", "o_custkey").alias("resto"),
    )
    in_file = Window.partitionBy("arquivo").orderBy("o_orderkey", "resto")
    rows = staged(rows.withColumn("posicao", F.row_number().over(in_file)))
    swapped = F.when(F.col("posicao") == 1, 2).when(F.col("posicao") == 2, 1).otherwise(F.col("posicao"))
    prints = []
    for name, position in (("original", F.col("posicao")), ("copia", F.col("posicao")), ("trocado", swapped)):
        folder = new_folder(spark, "arquivos")
        placed = rows.withColumn("posicao", position).repartition("arquivo").sortWithinPartitions("arquivo", "posicao")
        placed.select("arquivo", "value").write.partitionBy("arquivo").text(folder)
        found = L.fingerprint_files(spark, folder, "*/*.txt")
        prints.append(found.select(F.regexp_extract("path", "arquivo=([0-9]+)/", 1).alias("arquivo"), F.col("impressao").alias(name)))
    return prints[0].join(prints[1], "arquivo").join(prints[2], "arquivo").select(
        "arquivo", (F.col("original") == F.col("copia")).alias("igual_a_copia"),
        (F.col("original") == F.col("trocado")).alias("igual_com_linhas_trocadas"),
    )


@query(
    "s6_changed_files",
    """
SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS periodo FROM orders
WHERE o_orderstatus = 'F' AND month(o_orderdate) % 2 = 0""",
)
def s6_changed(spark, sf):
    """Against a manifest with other fingerprints for even months, the files of those months count as changed."""
    manifest = L.read_manifest(spark, _bronze(spark, sf)[0])
    other = F.when(F.col("mes").cast("int") % 2 == 0, F.reverse("impressao")).otherwise(F.col("impressao"))
    altered = manifest.withColumn("impressao", other)
    found = L.changed_files(L.fingerprint_files(spark, _landing(spark, sf)), altered)
    return found.select(F.left("arquivo_origem", F.lit(6)).alias("periodo")).distinct()


_PROMOTED = f"""
SELECT o_orderkey AS chave, strftime(o_orderdate, '%Y') AS ano, strftime(o_orderdate, '%m') AS mes,
  {_TEXT} AS texto, round(o_totalprice, 2) AS total FROM orders WHERE o_orderstatus = 'F'"""


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("Chave").cast("long").alias("chave"),
        F.col(C.YEAR_PART).alias("ano"),
        F.col(C.MONTH_PART).alias("mes"),
        F.col("Texto").alias("texto"),
        parse_brl(F.col("Total")).alias("total"),
    )


@query("s7_promote", _PROMOTED)
def s7(spark, sf):
    """Accepted files twice promoted; rejected and unknown ones leave no trace."""
    root, outcomes = _bronze(spark, sf)
    L.promote(outcomes, root)
    return _typed(load_bronze(spark, root, "pedidos"))


@query(
    "s8_manifest",
    """
SELECT 'pedidos' AS dataset, strftime(o_orderdate, '%Y') AS ano, strftime(o_orderdate, '%m') AS mes,
  COUNT(*) AS linhas, 'Chave,Comprador,Texto,Total' AS colunas, 'ISO-8859-1' AS codificacao,
  ';' AS separador, 'sucesso' AS status
FROM orders WHERE o_orderstatus = 'F' GROUP BY 2, 3""",
)
def s8(spark, sf):
    return L.read_manifest(spark, _bronze(spark, sf)[0]).groupBy(
        F.col("dataset_logico").alias("dataset"), "ano", "mes",
        F.array_join("colunas", ",").alias("colunas"),
        F.col("encoding_original").alias("codificacao"),
        F.col("separador_original").alias("separador"), "status",
    ).agg(F.sum("linhas").alias("linhas"))


@query(
    "s9_outcome_summary",
    """
SELECT CASE o_orderstatus WHEN 'F' THEN 'sucesso' ELSE 'erro_validacao' END AS status,
  COUNT(*) AS linhas FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1""",
)
def s9(spark, sf):
    return L.outcome_summary(_bronze(spark, sf)[1]).drop("arquivos")


@query("i12_land_continuously", _PROMOTED)
def i12(spark, sf):
    """The stream ingests what is there, a period's files in different batches, and finds nothing new when asked again."""
    folder, root = _landing(spark, sf), new_folder(spark, "bronze")
    checkpoint = new_folder(spark, "fluxo")
    specs = _specs(spark, folder)
    batches = []
    for _ in range(2):
        stream = land_continuously(
            spark, folder, root, checkpoint, lambda out, n: batches.append(n), files_per_batch=100, specs=specs
        )
        stream.awaitTermination()
    if batches != list(range(len(batches))):
        raise AssertionError(f"batches ran twice: {batches}")
    return _typed(load_bronze(spark, root, "pedidos"))


def _land(spark: SparkSession, rows: DataFrame, folder: str) -> None:
    """Finished orders as one file a month, replacing those of the same name."""
    written = new_folder(spark, "escrita")
    rows.drop("estado").repartition("periodo").write.partitionBy("periodo").options(
        header=True, sep=C.SOURCE_SEPARATOR, encoding=C.SOURCE_ENCODING, escape='"'
    ).csv(written)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    for status in files.globStatus(hadoop.Path(f"{written}/*/*.csv")):
        target = hadoop.Path(f"{folder}/{status.getPath().getParent().getName().split('=')[1]}_Pedidos.csv")
        files.delete(target, False)
        files.rename(status.getPath(), target)


@query(
    "i12_rewritten_files",
    f"SELECT * REPLACE (CASE WHEN CAST(mes AS INTEGER) % 6 = 0 THEN 'novo' ELSE texto END AS texto) FROM ({_PROMOTED})",
)
def i12_rewritten(spark, sf):
    """Files of two months a year are written again with another text; the others are not read again."""
    folder, root, checkpoint = (new_folder(spark, n) for n in ("entrada", "bronze", "fluxo"))
    specs = [C.DatasetSpec("Pedidos", "pedidos", ("Chave", "Total"))]
    rows = _rows(spark, sf).filter("estado = 'F'")
    again = rows.filter("cast(right(periodo, 2) AS int) % 6 = 0")
    ingested = []
    for landed in (rows, again.withColumn("Texto", F.lit("novo")), None):
        if landed is not None:
            _land(spark, landed, folder)
        ingested.append(0)

        def note(outcomes, batch):
            ingested[-1] += outcomes.count()

        land_continuously(spark, folder, root, checkpoint, note, specs=specs).awaitTermination()
    months = again.select("periodo").distinct().count()
    if ingested[1:] != [months, 0]:
        raise AssertionError(f"files ingested: {ingested}, rewritten: {months}")
    return _typed(load_bronze(spark, root, "pedidos"))


# Page dumps

_PAGE = 500


def _page_documents(spark: SparkSession, sf: str, layout: str) -> DataFrame:
    """Customers as page documents: one origin per nation, at most 500 records a page."""
    prefix = {"envelope": "modalidade", "array": "orgao"}[layout]
    record = F.to_json(F.struct("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")))
    paged = table(spark, sf, "customer").withColumn("bloco", F.floor(F.col("c_custkey") / _PAGE))
    pages = paged.groupBy("c_nationkey", "bloco").agg(F.array_sort(F.collect_list(record)).alias("r"))
    totals = paged.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("total"), (F.max("bloco") + 1).alias("paginas")
    )
    items = F.concat(F.lit("["), F.array_join("r", ","), F.lit("]"))
    envelope = F.concat(
        F.lit('{"data":'), items, F.lit(',"totalRegistros":'), text("total"),
        F.lit(',"totalPaginas":'), text("paginas"), F.lit("}"),
    )
    name = F.concat_ws("_", F.lit(prefix), text("c_nationkey"), F.lit("pagina"), text(F.col("bloco") + 1))
    value = envelope if layout == "envelope" else items
    return pages.join(totals, "c_nationkey").select(
        F.concat(name, F.lit(".json")).alias("arquivo"),
        # The first page of every tenth nation was cut short when it was dumped.
        F.when((F.col("c_nationkey") % 10 == 3) & (F.col("bloco") == 0), F.left(value, F.length(value) - 9)).otherwise(value).alias("value"),
    )


def _page_dumps(spark: SparkSession, sf: str, layout: str) -> str:
    """The documents as files under their own names."""
    written, folder = new_folder(spark, "escrita"), new_folder(spark, "paginas")
    _page_documents(spark, sf, layout).write.partitionBy("arquivo").text(written)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    for status in files.globStatus(hadoop.Path(f"{written}/*/*.txt")):
        name = status.getPath().getParent().getName().removeprefix("arquivo=")
        files.rename(status.getPath(), hadoop.Path(f"{folder}/{name}"))
    return folder


_RECORDS = """
SELECT c_nationkey AS origem, c_custkey // 500 + 1 AS pagina, c_custkey, c_name,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer
WHERE NOT (c_nationkey % 10 = 3 AND c_custkey // 500 = 0)"""


@query("s12_page_dumps_envelope", _RECORDS, longs=("origem",))
def s12_envelope(spark, sf):
    schema = "c_custkey long, c_name string, c_acctbal double"
    rows = P.read_page_dumps(spark, _page_dumps(spark, sf, "envelope"), "envelope", schema, skip_unreadable=True)
    return rows.drop("posicao")


@query("s12_page_dumps_array", _RECORDS, longs=("origem",))
def s12_array(spark, sf):
    schema = "c_custkey long, c_name string, c_acctbal double"
    rows = P.read_page_dumps(spark, _page_dumps(spark, sf, "array"), "array", schema, skip_unreadable=True)
    return rows.drop("posicao")


@query(
    "s13_profile_pages",
    """
WITH p AS (SELECT c_nationkey AS n, c_custkey // 500 AS b, c_nationkey % 10 = 3 AND c_custkey // 500 = 0 AS cortada FROM customer)
SELECT n AS origem, COUNT(DISTINCT b) AS paginas_lidas, COUNT(*) FILTER (NOT cortada) AS registros_lidos,
  CASE WHEN bool_or(NOT cortada) THEN COUNT(*) END AS total_registros,
  CASE WHEN bool_or(NOT cortada) THEN MAX(b) + 1 END AS total_paginas, MAX(b) + 1 AS maior_pagina,
  bool_or(b > 0 OR NOT cortada) AS chegou_ao_fim, COUNT(DISTINCT b) FILTER (cortada) AS paginas_ilegiveis,
  COUNT(DISTINCT b) = MAX(b) + 1 AND NOT bool_or(cortada) AS completo
FROM p GROUP BY 1""",
    longs=("origem",),
)
def s13(spark, sf):
    return P.profile_pages(P.read_pages(spark, _page_dumps(spark, sf, "envelope"), "envelope"))


@query(
    "s14_field_inventory",
    """
SELECT 'o_orderkey' AS campo, COUNT(*) AS registros FROM orders
UNION ALL SELECT 'status', COUNT(*) FILTER (o_orderstatus = 'F') FROM orders
UNION ALL SELECT 'total', COUNT(*) FILTER (o_orderkey % 50 <> 0) FROM orders""",
)
def s14(spark, sf):
    """Missing values leave no field behind, so field sets differ from record to record."""
    record = F.struct(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "F").alias("status"),
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")).alias("total"),
    )
    rows = table(spark, sf, "orders").select(F.to_json(record).alias("registro"))
    return P.field_inventory(rows, scope="all")


@query(
    "s14_field_inventory_events",
    "SELECT unnest(json_keys(props)) AS campo, COUNT(*) AS registros FROM events GROUP BY 1",
)
def s14_events(spark, sf):
    return P.field_inventory(table(spark, sf, "events"), record="props", scope="all")


@query(
    "s14_field_inventory_first",
    "SELECT unnest(json_keys(props)) AS campo FROM (SELECT arg_min(props, event_id) AS props FROM events)",
)
def s14_first(spark, sf):
    return P.field_inventory(table(spark, sf, "events"), record="props", order=["event_id"])


@query(
    "s10_empty_dataset",
    """
SELECT 'pedidos' AS dataset, COUNT(*) AS linhas, 7 AS colunas FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'empenhos_relacionados', 0, 7""",
    longs=("linhas", "colunas"),
)
def s10(spark, sf):
    """A data set without files is an empty table of known columns where that is allowed."""
    root = _bronze(spark, sf)[0]
    if load_bronze(spark, root, C.ITEMS) is not None:
        raise AssertionError("a data set without files must be skipped")
    tables = {
        "pedidos": load_bronze(spark, root, "pedidos"),
        C.COMMITMENTS: load_bronze(spark, root, C.COMMITMENTS, allow_empty=True),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(name).alias("dataset"), "linhas", F.lit(len(df.columns)).alias("colunas")
        )
        for name, df in tables.items()
    ]
    return counts[0].unionByName(counts[1])


@query(
    "j1_reported_occurrences",
    """
SELECT 'licitacoes' AS dataset, 'unidade_com_varios_nomes' AS regra, CAST(o_custkey AS VARCHAR) AS valor, COUNT(DISTINCT nome) AS linhas
FROM (SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'A' ELSE 'B' END AS nome FROM orders WHERE o_orderkey % 10 <> 0)
GROUP BY o_custkey HAVING COUNT(DISTINCT nome) > 1
UNION ALL SELECT 'itens_licitacao', 'item_sem_licitacao', NULL, COUNT(*) FROM lineitem WHERE l_orderkey % 10 = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'licitacoes', 'uf_invalida', uf, NULL FROM (
  SELECT DISTINCT '?' || (o_orderkey % 3) AS uf FROM orders WHERE o_orderkey % 10 <> 0)""",
)
def j1_reported(spark, sf):
    """A tenth of the tenders is missing, units have two names, and no state is one: all of it can be read back."""
    tables = silver(spark, sf)
    key = F.col(C.ROW_ORD)
    kept = tables[C.TENDERS].filter(key % 10 != 0).withColumns(
        {"Nome UG": F.when(key % 3 == 0, "A").otherwise("B"), "UF": F.concat(F.lit("?"), text(key % 3))}
    )
    known = kept.select(*C.TENDER_DATE_KEY).distinct()
    orphans = orphan_count(tables[C.ITEMS], known, list(C.TENDER_DATE_KEY), null_safe=True)
    root = new_folder(spark, "silver")
    found = [occurrences.invalid_states(kept), occurrences.units_with_several_names(kept), occurrences.items_without_tender(orphans)]
    with replaced_set(spark, root) as folder:
        occurrences.write_occurrences(found, folder)
    return occurrences.read_occurrences(spark, root)
