"""Landing files: discovery, validation, fingerprints, promotion to bronze and the manifest.

A file is a row here. Tables about files hold one row per file and are the only thing that
reaches the driver; file contents are read by tasks, cut into splits wherever that is safe.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake import contracts as C
from tenderlake.functions.columns import named, null_tokens
from tenderlake.operators.keys import latest_by_key, union_periods
from tenderlake.session import delete_path, in_few_tasks, path_exists
from tenderlake.sources.records import QUOTED_CELL, count_records, records

FILE, BLOCK, LINE_ID = "_arquivo", "_bloco", "_id_linha"
FILE_PART = "arquivo"
MANIFEST = "manifesto"

MANIFEST_SCHEMA = (
    "arquivo_origem string, dataset_logico string, ano string, mes string, linhas long, "
    "colunas array<string>, impressao string, encoding_original string, "
    "separador_original string, data_ingestao_utc timestamp, status string, bytes long, modificado timestamp"
)

#: How the records of a file are found: every line is one, they are put together from splits, or one task reads the file.
BY_LINE, BY_RECORD, WHOLE_FILE = "linhas", "registros", "arquivo"
_BAD_RECORD = "_registro_ruim"


def _plain_path(path: Column) -> Column:
    """One spelling for ``file:/x``, ``file:///x`` and ``/x``."""
    return F.regexp_replace(path, r"^file:/+", "/")


def source_path() -> Column:
    """Path of the file a row came from, decoded to the form listings use."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return _plain_path(F.url_decode(encoded))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def listing(spark: SparkSession, folder: str, names: str = "*.csv") -> DataFrame:
    """Files of a folder with size and time of change, empty ones included; contents are not read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{names}")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
    rows = [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found if s.isFile()]
    files = spark.createDataFrame(rows, "path string, bytes long, modificado long")
    return files.withColumns({"path": _plain_path(F.col("path")), "modificado": F.timestamp_millis("modificado")})


def recognise(files: DataFrame, specs: Sequence[C.DatasetSpec] = C.DATASETS) -> DataFrame:
    """Read period and data set off file names, and say why a file is not taken."""
    known = files.sparkSession.createDataFrame(
        [(s.source, s.logical, list(s.required)) for s in specs],
        "fonte string, dataset string, obrigatorias array<string>",
    )
    files = files.withColumn("path", _plain_path(F.col("path")))
    read = files.withColumn("nome", file_name(F.col("path")))
    read = read.withColumns(
        {"_casa": F.col("nome").rlike(C.FILE_NAME_PATTERN)}
        | {
            name: F.nullif(F.regexp_extract("nome", C.FILE_NAME_PATTERN, i), F.lit(""))
            for i, name in enumerate(("ano", "mes", "fonte"), start=1)
        }
    )
    reason = F.when(~F.col("_casa"), "nome_fora_do_padrao").when(
        F.col("dataset").isNull(), "dataset_desconhecido"
    )
    if "modificado" not in files.columns:
        read = read.withColumn("modificado", F.lit(None).cast("timestamp"))
    # The specification has one row per known data set.
    return read.join(F.broadcast(known), "fonte", "left").select(
        "path", "nome", "bytes", "modificado", "ano", "mes", "fonte", "dataset", "obrigatorias",
        reason.isNull().alias("aceito"), reason.alias("motivo"),
    )


def discover_landing(
    spark: SparkSession, folder: str, specs: Sequence[C.DatasetSpec] = C.DATASETS
) -> DataFrame:
    """Every CSV of the landing folder with period, data set and, if skipped, the reason."""
    return recognise(listing(spark, folder), specs)


def missing_columns(header: Column, required: Column) -> Column:
    """Required columns the header lacks, in declared order."""
    return F.array_except(required, header)


def has_open_quote(line: Column) -> Column:
    """True if a quote is left once whole quoted cells are removed: the record may go on."""
    rest = F.regexp_replace(line, QUOTED_CELL, "$1")
    return F.contains(line, F.lit('"')) & F.contains(rest, F.lit('"'))


# Four hash words of a line, each 31 bits, so that sums over any file fit a decimal.
_WORDS = 4


def _line_words() -> list[Column]:
    halves = []
    for seed in range(_WORDS // 2):
        h = F.xxhash64(F.lit(seed), F.col("value"))
        halves += [h.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftrightunsigned(h, 33)]
    return halves


def scan_lines(spark: SparkSession, paths: Sequence[str], encoding: str = C.SOURCE_ENCODING) -> DataFrame:
    """What one pass over the lines tells of each file that has any.

    ``primeira`` is the first filled line, ``preenchidas`` the number of filled lines, ``divisivel`` says that every
    line is a whole record, and ``impressao`` is a digest of the lines and their order. The digest
    sums each line's hash words, plain and times the line's number. Splits add up whatever their
    borders: a split's numbers start anew, and its sums are moved to its place by the lines before it.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("decimal(38,0)")
    words = _line_words()
    read = spark.read.text(list(paths)).select(source_path().alias("path"), F.col("_metadata.file_block_start").alias("bloco"), "value")
    lines = in_few_tasks(read).select(
        "path", "bloco", "value",
        F.decode(F.col("value").cast("binary"), encoding).alias("linha"), position.alias("posicao"),
        *[w.cast("decimal(38,0)").alias(f"w{k}") for k, w in enumerate(words)],
    )
    filled = F.length(F.trim("linha")) > 0
    blocks = lines.groupBy("path", "bloco").agg(
        F.count(F.lit(1)).cast("decimal(38,0)").alias("n"), F.min("posicao").alias("inicio"), F.count_if(filled).alias("preenchidas"),
        F.count_if(filled & has_open_quote(F.col("linha"))).alias("abertas"),
        F.min(F.when(filled, F.struct("posicao", "linha"))).alias("primeira"),
        *[F.sum(f"w{k}").alias(f"s{k}") for k in range(_WORDS)],
        *[F.sum(F.col("posicao") * F.col(f"w{k}")).alias(f"m{k}") for k in range(_WORDS)],
    )
    before = Window.partitionBy("path").orderBy("bloco").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_desloca", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("inicio"))
    moments = [F.sum(F.col(f"m{k}") + F.col("_desloca") * F.col(f"s{k}")) for k in range(_WORDS)]
    sums = [F.sum(f"s{k}") for k in range(_WORDS)]
    digest = F.sha2(F.concat_ws(":", F.sum("n"), *[c.cast("decimal(38,0)") for c in (*sums, *moments)]), 256)
    return placed.groupBy("path").agg(
        F.min(F.when(F.col("primeira").isNotNull(), F.struct("bloco", F.col("primeira.linha").alias("linha"))))["linha"].alias("primeira"),
        F.sum("preenchidas").alias("preenchidas"), (F.sum("abertas") == 0).alias("divisivel"), digest.alias("impressao"),
    )


def _header_cells(line: str | None) -> list[str]:
    return next(csv.reader([line], delimiter=C.SOURCE_SEPARATOR)) if line else []


def profile_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Header, record count, way of reading and digest of each file (one row per file).

    Blank lines are no records. Files whose records may span lines are looked at once more, in splits; only
    those that do not quote properly are counted by the parser, as a whole file per task.
    """
    paths = list(paths)
    seen = {r.path: r for r in scan_lines(spark, paths).collect()}
    headers = {p: _header_cells(seen[p].primeira) if p in seen else [] for p in paths}
    counts = {path: max(found.preenchidas - 1, 0) for path, found in seen.items()}
    ways = dict.fromkeys(paths, BY_LINE)
    spanning = sorted(path for path, found in seen.items() if not found.divisivel)
    whole: dict[tuple[str, ...], list[str]] = {}
    for r in count_records(spark, spanning, source_path()).collect() if spanning else []:
        ways[r.path] = BY_RECORD if r.correto else WHOLE_FILE
        counts[r.path] = max(r.registros - 1, 0)
        if not r.correto:
            whole.setdefault(tuple(headers[r.path]), []).append(r.path)
    for header, files in whole.items():
        parsed = read_landing_csv(spark, files, header, splittable=False, provenance=True)
        counts |= dict.fromkeys(files, 0)
        counts |= {r[FILE]: r["count"] for r in parsed.groupBy(FILE).count().collect()}
    rows = [
        (p, headers[p], counts.get(p, 0), ways[p] == BY_LINE, ways[p], seen[p].impressao if p in seen else None) for p in paths
    ]
    return spark.createDataFrame(
        rows, "path string, colunas array<string>, linhas long, divisivel boolean, leitura string, impressao string"
    )


def _unique_names(header: Sequence[str]) -> list[str]:
    """Header names, a repeated one with a numbered suffix."""
    names, used = [], {}
    for cell in header:
        n = used.get(cell, 0)
        names.append(cell if n == 0 else f"{cell}.{n}")
        used[cell] = n + 1
    return names


def _record_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, _BAD_RECORD)])


_PARSER = {
    "sep": C.SOURCE_SEPARATOR, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_RECORD,
}


def _cells(names: Sequence[str]) -> list[Column]:
    """Cells of parsed records, missing markers as null; a record longer than its header stops the job."""
    cells = F.size(F.split(F.regexp_replace(_BAD_RECORD, QUOTED_CELL, "$1"), C.SOURCE_SEPARATOR))
    too_long = F.col(_BAD_RECORD).isNotNull() & (cells > len(names))
    first = F.when(
        too_long, F.raise_error(F.concat(F.lit("record longer than header: "), _BAD_RECORD)).cast("string")
    ).otherwise(null_tokens(named(names[0])))
    return [first.alias(names[0]), *[null_tokens(named(n)).alias(n) for n in names[1:]]]


def read_landing_csv(
    spark: SparkSession,
    paths: Sequence[str],
    header: Sequence[str],
    splittable: bool = True,
    provenance: bool = False,
) -> DataFrame:
    """Rows of files that share a header, every column as text, missing markers as null.

    Short records are padded with null; a record longer than the header stops the job,
    because dropping its tail would lose data. ``provenance`` adds file, block and a row
    identifier that grows along each block.
    """
    names = _unique_names(header)
    rows = (
        spark.read.schema(_record_schema(names))
        .options(header=True, encoding=C.SOURCE_ENCODING, multiLine=not splittable, enforceSchema=True, **_PARSER)
        .csv(list(paths))
    )
    columns = _cells(names)
    if provenance:
        columns += [
            source_path().alias(FILE),
            F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(LINE_ID),
        ]
    return rows.select(*columns)


def read_spanning_csv(spark: SparkSession, paths: Sequence[str], header: Sequence[str], provenance: bool = False) -> DataFrame:
    """The same for files whose records span lines, in splits; they have to be properly quoted."""
    names = _unique_names(header)
    parsed = F.from_csv("texto", _record_schema(names).toDDL(), {**_PARSER, "multiLine": "true"})
    rows = records(spark, paths, source_path()).select("path", "bloco", "id", parsed.alias("r")).select("path", "bloco", "id", "r.*")
    where = [F.col("path").alias(FILE), F.col("bloco").alias(BLOCK), F.col("id").alias(LINE_ID)] if provenance else []
    return rows.select(*_cells(names), *where)


_READERS = {
    BY_LINE: lambda spark, paths, header: read_landing_csv(spark, paths, header, splittable=True, provenance=True),
    BY_RECORD: lambda spark, paths, header: read_spanning_csv(spark, paths, header, provenance=True),
    WHOLE_FILE: lambda spark, paths, header: read_landing_csv(spark, paths, header, splittable=False, provenance=True),
}


def with_size(files: DataFrame) -> DataFrame:
    """Complete the digest of the lines by the file's size, so that other line ends show too."""
    return files.withColumn("impressao", F.sha2(F.concat_ws(":", "bytes", F.coalesce("impressao", F.lit(""))), 256))


def fingerprint_paths(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Content fingerprint of listed files, one rule for every size: lines in order, and bytes.

    Files are read in splits, and the split borders do not matter.
    """
    listed = files.select(_plain_path(F.col("path")).alias("path"), "bytes")
    filled = [f.path for f in listed.filter("bytes > 0").collect()]
    if not filled:
        return with_size(listed.withColumn("impressao", F.lit(None).cast("string"))).select("path", "impressao")
    found = scan_lines(spark, filled).select("path", "impressao")
    return with_size(listed.join(found, "path", "left")).select("path", "impressao")


def fingerprint_files(spark: SparkSession, folder: str, names: str = "*.csv") -> DataFrame:
    """Content fingerprint per file of a folder."""
    return fingerprint_paths(spark, listing(spark, folder, names))


def ingest_outcome(files: DataFrame) -> DataFrame:
    """Add missing columns and the outcome to recognised, profiled files."""
    lacking = missing_columns(F.coalesce("colunas", F.array().cast("array<string>")), F.col("obrigatorias"))
    return files.withColumn("faltando", lacking).withColumn(
        "status",
        F.when(F.size("faltando") > 0, C.INVALID)
        .when(F.coalesce("linhas", F.lit(0)) == 0, C.EMPTY)
        .otherwise(C.OK),
    )


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(
        F.count(F.lit(1)).alias("arquivos"), F.sum("linhas").alias("linhas")
    )


def build_manifest(outcomes: DataFrame) -> DataFrame:
    """Manifest rows of the promoted files."""
    return outcomes.filter(F.col("status").isin(C.OK, C.EMPTY)).select(
        F.col("nome").alias("arquivo_origem"),
        F.col("dataset").alias("dataset_logico"),
        "ano", "mes", "linhas", "colunas", "impressao",
        F.lit(C.SOURCE_ENCODING).alias("encoding_original"),
        F.lit(C.SOURCE_SEPARATOR).alias("separador_original"),
        F.current_timestamp().alias("data_ingestao_utc"),
        "status", "bytes", "modificado",
    )


def read_manifest(spark: SparkSession, bronze_root: str, history: bool = False) -> DataFrame:
    """Manifest of the bronze tables; by default only the last entry of each file."""
    path = f"{bronze_root}/{MANIFEST}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    entries = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    if history:
        return entries
    return latest_by_key(entries, ["dataset_logico", "arquivo_origem"], "data_ingestao_utc")


def changed_files(fingerprints: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that carry a known name but other content than at their last ingestion."""
    now = fingerprints.select(file_name(F.col("path")).alias("arquivo_origem"), "impressao")
    before = manifest.select("arquivo_origem", F.col("impressao").alias("impressao_anterior"))
    return now.join(before, "arquivo_origem").filter("impressao <> impressao_anterior")


def unseen_files(spark: SparkSession, files: DataFrame, bronze_root: str) -> DataFrame:
    """Recognised files that are new, or have other content than at their last ingestion.

    A file whose name, size and time of change stand in the manifest is not read. Where only the name is known, the
    contents are compared by fingerprint; a file that turns out the same is noted with its new time, so that it is
    read this once.
    """
    manifest = read_manifest(spark, bronze_root)
    known = manifest.select(
        F.col("arquivo_origem").alias("nome"), *[F.col(c).alias(f"_antes_{c}") for c in ("bytes", "modificado", "impressao")]
    )
    untouched = (F.col("bytes") == F.col("_antes_bytes")) & (F.col("modificado") == F.col("_antes_modificado"))
    suspects = files.join(known, "nome", "left").filter(~F.coalesce(untouched, F.lit(False)))
    suspects = spark.createDataFrame(suspects.collect(), suspects.schema)
    renewed = suspects.filter("_antes_impressao is not null")
    now = fingerprint_paths(spark, renewed).withColumnRenamed("impressao", "_agora")
    compared = suspects.join(now, "path", "left").withColumn("_igual", F.coalesce(F.col("_agora") == F.col("_antes_impressao"), F.lit(False)))
    compared = spark.createDataFrame(compared.collect(), compared.schema)
    same = compared.filter("_igual").select(F.col("nome").alias("arquivo_origem"), F.col("bytes").alias("_b"), F.col("modificado").alias("_m"))
    if not same.isEmpty():
        noted = manifest.join(same, "arquivo_origem").withColumns(
            {"bytes": F.col("_b"), "modificado": F.col("_m"), "data_ingestao_utc": F.current_timestamp()}
        )
        rows = noted.select(*manifest.columns).collect()
        spark.createDataFrame(rows, manifest.schema).write.mode("append").parquet(f"{bronze_root}/{MANIFEST}")
    return compared.filter("not _igual").select(*files.columns)


def _folder_of(spark: SparkSession, name: str) -> str:
    """Folder of a file's rows, spelled as Spark spells partition values."""
    spell = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{FILE_PART}={spell(name)}"


def promote(outcomes: DataFrame, bronze_root: str) -> None:
    """Write the rows of accepted files to ``<dataset>/ano=/mes=/arquivo=``; a file replaces itself only.

    Files are parsed once, grouped by header so that columns meet by name. Tasks write the
    splits they read, without a shuffle. An accepted file without rows empties its own folder;
    other files of its period stay. Rejected files are not read.
    """
    spark = outcomes.sparkSession
    files = outcomes.filter(F.col("status").isin(C.OK, C.EMPTY)).collect()
    for dataset in sorted({f.dataset for f in files}):
        target = f"{bronze_root}/{dataset}"
        mine = [f for f in files if f.dataset == dataset]
        for f in mine:
            if f.status == C.EMPTY:
                delete_path(spark, f"{target}/ano={f.ano}/mes={f.mes}/{_folder_of(spark, f.nome)}")
        groups: dict[tuple, list[str]] = {}
        for f in mine:
            if f.status == C.OK:
                groups.setdefault((tuple(f.colunas), f.leitura), []).append(f.path)
        parts = [_READERS[way](spark, paths, header) for (header, way), paths in groups.items()]
        if not parts:
            continue
        rows = union_periods(parts)
        name = file_name(F.col(FILE))
        (
            rows.withColumns(
                {
                    "ano": F.regexp_extract(name, C.FILE_NAME_PATTERN, 1),
                    "mes": F.regexp_extract(name, C.FILE_NAME_PATTERN, 2),
                    FILE_PART: name,
                }
            )
            .drop(FILE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ano", "mes", FILE_PART)
            .parquet(target)
        )


def ingest_files(spark: SparkSession, files: DataFrame, bronze_root: str) -> DataFrame:
    """Validate recognised files, promote the good ones and record them; returns outcomes."""
    taken = files.filter("aceito").collect()
    if not taken:
        empty = spark.createDataFrame([], files.schema).withColumns(
            {"colunas": F.array().cast("array<string>"), "linhas": F.lit(0).cast("long"),
             "divisivel": F.lit(True), "leitura": F.lit(BY_LINE), "impressao": F.lit("")}
        )
        return ingest_outcome(empty)
    profile = profile_files(spark, sorted(r.path for r in taken))
    recognised = spark.createDataFrame(taken, files.schema)
    outcomes = ingest_outcome(with_size(recognised.join(profile, "path", "left")))
    # One row per file: fixed here so that the promoted files are those the manifest names.
    outcomes = spark.createDataFrame(outcomes.collect(), outcomes.schema)
    promote(outcomes, bronze_root)
    build_manifest(outcomes).write.mode("append").parquet(f"{bronze_root}/{MANIFEST}")
    return outcomes


def ingest_folder(
    spark: SparkSession, folder: str, bronze_root: str, specs: Sequence[C.DatasetSpec] = C.DATASETS
) -> DataFrame:
    return ingest_files(spark, discover_landing(spark, folder, specs), bronze_root)
