"""Dumped API pages: enveloped pages and bare arrays, as rows with provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.sources.landing import file_name, listing, source_path

# Dump file names, envelope fields and the page size of the array layout.
LAYOUTS = {
    "envelope": r"^modalidade_(\d+)_pagina_(\d+)\.json$",
    "array": r"^orgao_(\d+)_pagina_(\d+)\.json$",
}
ENVELOPE = "data array<string>, totalRegistros long, totalPaginas long"
ARRAY_PAGE_SIZE = 15


def parse_pages(documents: DataFrame, layout: str) -> DataFrame:
    """Documents (``arquivo``, ``value``) to one row per page: origin code, page number,
    declared totals, raw records, and whether the page could be read. Files with other names are left out.

    A page is unreadable when it is not the JSON of its layout, as a dump cut short is; an envelope
    without records is readable and empty.
    """
    pattern = LAYOUTS[layout]
    numbered = [
        F.regexp_extract("arquivo", pattern, i).cast("long").alias(n)
        for i, n in ((1, "origem"), (2, "pagina"))
    ]
    if layout == "envelope":
        body = F.from_json("value", ENVELOPE)
        records, total, last = body["data"], body["totalRegistros"], body["totalPaginas"]
        keys = F.json_object_keys("value")
        named_records = F.array_contains(keys, "data") & (F.get_json_object("value", "$.data").isNotNull())
        unreadable = keys.isNull() | F.coalesce(named_records & records.isNull(), F.lit(False))
    else:
        records = F.from_json("value", "array<string>")
        total = last = F.lit(None).cast("long")
        unreadable = records.isNull() | ~F.ltrim("value").startswith("[")
    return documents.filter(F.col("arquivo").rlike(pattern)).select(
        *numbered,
        F.coalesce(F.when(~unreadable, records), F.array().cast("array<string>")).alias("registros"),
        total.alias("total_registros"),
        last.alias("total_paginas"),
        F.coalesce(unreadable, F.lit(True)).alias("ilegivel"),
    )


def read_pages(spark: SparkSession, folder: str, layout: str) -> DataFrame:
    """Pages of a dump folder. A page has a bounded size and is read whole; pages spread over tasks.

    Files without a byte, which readers pass over, are unreadable pages too.
    """
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    filled = files.select(file_name(source_path()).alias("arquivo"), "value")
    empty = listing(spark, folder, "*.json").filter("bytes = 0")
    return parse_pages(filled.unionByName(empty.select(file_name(F.col("path")).alias("arquivo"), F.lit("").alias("value"))), layout)


def page_records(pages: DataFrame, schema: str | None = None) -> DataFrame:
    """One row per record, as JSON text in ``registro`` or, given a schema, as columns."""
    place = ("origem", "pagina", "posicao")
    rows = pages.select("origem", "pagina", F.posexplode("registros").alias("posicao", "registro"))
    if schema is None:
        return rows
    return rows.select(*place, F.from_json("registro", schema).alias("r")).select(*place, "r.*")


def read_page_dumps(
    spark: SparkSession, folder: str, layout: str, schema: str | None = None, skip_unreadable: bool = False
) -> DataFrame:
    """Records of every page in a dump folder. An unreadable page stops the job unless it is to be skipped."""
    pages = read_pages(spark, folder, layout)
    if skip_unreadable:
        return page_records(pages.filter(~F.col("ilegivel")), schema)
    where = F.concat(F.lit("unreadable page: "), F.concat_ws("/", F.col("origem"), F.col("pagina")))
    checked = F.when(F.col("ilegivel"), F.raise_error(where).cast("array<string>")).otherwise(F.col("registros"))
    return page_records(pages.withColumn("registros", checked), schema)


def page_counts(pages: DataFrame) -> DataFrame:
    """Rows of each page, declared totals, and whether it is the last page of its origin."""
    found = F.size("registros")
    last = F.when(
        F.col("total_paginas").isNotNull(), F.col("pagina") >= F.col("total_paginas")
    ).otherwise(found < ARRAY_PAGE_SIZE)
    return pages.select(
        "origem", "pagina", "total_registros", "total_paginas",
        found.alias("quantidade_nesta_pagina"), (last & ~F.col("ilegivel")).alias("ultima"), "ilegivel",
    )


def profile_pages(pages: DataFrame) -> DataFrame:
    """Pages and rows per origin against the declared totals."""
    counted = page_counts(pages).groupBy("origem").agg(
        F.count_distinct("pagina").alias("paginas_lidas"),
        F.sum("quantidade_nesta_pagina").alias("registros_lidos"),
        F.max("total_registros").alias("total_registros"),
        F.max("total_paginas").alias("total_paginas"),
        F.max("pagina").alias("maior_pagina"),
        F.max("ultima").alias("chegou_ao_fim"),
        F.count_if("ilegivel").alias("paginas_ilegiveis"),
    )
    whole = F.col("chegou_ao_fim") & (F.col("paginas_lidas") == F.col("maior_pagina"))
    declared = F.coalesce(F.col("registros_lidos") == F.col("total_registros"), F.lit(True))
    return counted.withColumn("completo", whole & declared & (F.col("paginas_ilegiveis") == 0))


def field_inventory(df: DataFrame, record: str = "registro", scope: str = "first", order=None) -> DataFrame:
    """Top-level field names of JSON records: of the first record, or of all with counts."""
    if scope == "first":
        first = df.filter(F.col(record).isNotNull()).orderBy(*(order or ["origem", "pagina", "posicao"])).limit(1)
        return first.select(F.explode(F.array_sort(F.json_object_keys(record))).alias("campo"))
    if scope == "all":
        names = df.select(F.explode(F.json_object_keys(record)).alias("campo"))
        return names.groupBy("campo").agg(F.count(F.lit(1)).alias("registros"))
    raise ValueError(f"unknown scope: {scope}")
