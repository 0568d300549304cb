"""Bronze tables: all periods of a data set with lineage and a dense row ordinal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake import contracts as C
from tenderlake.functions.columns import named
from tenderlake.operators.joins import BROADCAST_BYTES, matching, measured_bytes
from tenderlake.session import path_exists, staged
from tenderlake.sources.landing import BLOCK, FILE_PART, LINE_ID, read_manifest


def with_row_ord(
    df: DataFrame,
    file: Sequence[str],
    block: str = BLOCK,
    line_id: str = LINE_ID,
    name: str = C.ROW_ORD,
) -> DataFrame:
    """0-based position of each row in the concatenation of all files, in file order.

    A row's position is the rows of earlier files, plus those of earlier blocks of its
    file, plus its place in its block. Only row counts per block are aggregated; ``df``
    must be a written table, as the identifiers must not change between the two readings.
    """
    keys = [*file, block]
    blocks = df.groupBy(*[named(k) for k in keys]).agg(
        F.min(named(line_id)).alias("_primeiro"), F.count(F.lit(1)).alias("_n")
    )
    before = (Window.unboundedPreceding, -1)
    in_file = Window.partitionBy(*file).orderBy(block).rowsBetween(*before)
    blocks = staged(blocks.withColumn("_no_arquivo", F.coalesce(F.sum("_n").over(in_file), F.lit(0))))
    # One row per file goes through this window, not the data.
    across = Window.orderBy(*[named(k) for k in file]).rowsBetween(*before)
    files = (
        blocks.groupBy(*[named(k) for k in file])
        .agg(F.sum("_n").alias("_total"))
        .withColumn("_antes", F.coalesce(F.sum("_total").over(across), F.lit(0)))
        .drop("_total")
    )
    offsets = blocks.join(files, list(file)).select(
        *[named(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        (F.col("_antes") + F.col("_no_arquivo") - F.col("_primeiro")).alias("_base"),
    )
    if measured_bytes(offsets) <= BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    pairs = [(k, f"_k{i}") for i, k in enumerate(keys)]
    return (
        df.join(offsets, matching(df, offsets, pairs, null_safe=False))
        .withColumn(name, F.col("_base") + named(line_id))
        .drop("_base", *[b for _, b in pairs])
    )


def _schema(columns: Sequence[str]) -> T.StructType:
    text = [T.StructField(c, T.StringType()) for c in columns]
    return T.StructType(
        [
            *text,
            T.StructField(BLOCK, T.LongType()),
            T.StructField(LINE_ID, T.LongType()),
            T.StructField("ano", T.StringType()),
            T.StructField("mes", T.StringType()),
            T.StructField(FILE_PART, T.StringType()),
        ]
    )


def bronze_columns(spark: SparkSession, root: str, dataset: str) -> list[str]:
    """Columns over all periods, in order of first appearance (one manifest row per file)."""
    entries = (
        read_manifest(spark, root)
        .filter(F.col("dataset_logico") == dataset)
        .orderBy("ano", "mes", "arquivo_origem")
        .select("colunas")
        .collect()
    )
    return list(dict.fromkeys(c for e in entries for c in e.colunas))


def load_bronze(
    spark: SparkSession,
    root: str,
    dataset: str,
    allow_empty: bool = False,
    empty_columns: Sequence[str] = C.COMMITMENT_COLUMNS,
    periods: Sequence[tuple[str, str]] | None = None,
) -> DataFrame | None:
    """All periods of a data set as text, with period columns and ``_row_ord``.

    Without rows the result is None, or an empty table of ``empty_columns`` where that is
    allowed. ``periods`` restricts the scan to some (year, month) partitions.
    """
    path = f"{root}/{dataset}"
    columns = bronze_columns(spark, root, dataset)
    parts = {C.YEAR_PART: F.col("ano"), C.MONTH_PART: F.col("mes")}
    if not columns or not path_exists(spark, path):
        if not allow_empty:
            return None
        rows = spark.createDataFrame([], _schema(columns or empty_columns))
        return rows.withColumns(parts | {C.ROW_ORD: F.lit(None).cast("long")}).drop(
            BLOCK, LINE_ID, "ano", "mes", FILE_PART
        )
    rows = spark.read.schema(_schema(columns)).parquet(path)
    if periods is not None:
        wanted = F.lit(False)
        for year, month in periods:
            wanted = wanted | ((F.col("ano") == year) & (F.col("mes") == month))
        rows = rows.filter(wanted)
    rows = with_row_ord(rows, ["ano", "mes", FILE_PART])
    return rows.withColumns(parts).drop(BLOCK, LINE_ID, "ano", "mes", FILE_PART)
