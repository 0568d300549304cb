"""The ordered batch job: landing to bronze, silver, gold, checks, publication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.operators.checks import open_gate, row_balance
from tenderlake.operators.joins import orphan_count
from tenderlake.plans import occurrences, silver
from tenderlake.plans.period_load import ORPHANS, POSTINGS, build_by_period, load_period, loaded_inputs
from tenderlake.plans.versions import current_parts, replaced_set
from tenderlake.session import path_bytes, scratch, sized_shuffles
from tenderlake.sources.bronze import load_bronze
from tenderlake.sources.landing import discover_landing, ingest_files, ingest_folder, read_manifest, unseen_files

#: Text that a byte of a compressed bronze table stands for, about.
_TEXT_PER_BYTE = 5


def bronze_to_silver(
    spark: SparkSession,
    bronze_root: str,
    folder: str,
    periods: Sequence[tuple[str, str]] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Clean every data set that has rows, in all or some periods, into the folder of a new set.

    Returns the marked tables and the quality report, both as written.
    """
    marked = {}
    for name, mark in silver.CLEANERS.items():
        raw = load_bronze(
            spark, bronze_root, name, allow_empty=name == C.COMMITMENTS, periods=periods
        )
        if raw is None:
            continue
        silver.write_silver(mark(raw), folder, name)
        marked[name] = silver.read_marked(spark, folder, name)
    report = silver.quality_report(marked)
    silver.write_quality(report, folder)
    missing = [name for name in (C.TENDERS, C.ITEMS, C.BIDS) if name not in marked]
    if missing:
        raise FileNotFoundError(f"no rows of {', '.join(missing)} below {bronze_root}")
    return marked, spark.read.schema(report.schema).json(f"{folder}/{silver.QUALITY}")


def balance_check(report: DataFrame) -> DataFrame:
    """Row balance of the quality report, in the shape of the contract check."""
    return row_balance(report).agg(F.count(F.lit(1)).alias("violacoes")).select(
        F.lit("relatorio_qualidade").alias("tabela"), F.lit("balanco").alias("regra"),
        F.lit("linhas").alias("coluna"), "violacoes",
    )


def _oddities(
    spark: SparkSession, root: str, clean: dict[str, DataFrame], periods: Sequence[tuple[str, str]] | None = None
) -> list[DataFrame]:
    """Samples of invalid states, and units with several names."""
    raw = load_bronze(spark, f"{root}/bronze", C.TENDERS, periods=periods)
    samples = [occurrences.invalid_states(raw)] if raw is not None else []
    return [*samples, occurrences.units_with_several_names(clean[C.TENDERS])]


def period_inputs(manifest: DataFrame) -> dict[str, str]:
    """Of each ingested period a fingerprint of its files (one driver row per period)."""
    file = F.concat_ws("|", "dataset_logico", "arquivo_origem", "impressao")
    found = manifest.groupBy(F.concat_ws("-", "ano", "mes").alias("periodo")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(file)), "\n"), 256).alias("impressao")
    )
    return {r.periodo: r.impressao for r in found.collect()}


def refresh(spark: SparkSession, landing: str, root: str) -> dict[str, int]:
    """Run all steps in order. Any failure leaves the published version as it was.

    What was dropped or found odd is left in ``silver/ocorrencias``. The star is kept by period, so that
    :func:`refresh_period` and :func:`refresh_changes` can go on from it.
    """
    ingest_folder(spark, landing, f"{root}/bronze")
    return rebuild(spark, root)


def rebuild(spark: SparkSession, root: str) -> dict[str, int]:
    """Silver and star anew from all bronze tables."""
    inputs = period_inputs(read_manifest(spark, f"{root}/bronze"))
    read = path_bytes(spark, f"{root}/bronze") * _TEXT_PER_BYTE
    with sized_shuffles(spark, read), scratch(spark):
        with replaced_set(spark, f"{root}/silver") as folder:
            marked, report = bronze_to_silver(spark, f"{root}/bronze", folder)
            clean = {name: silver.accepted(df) for name, df in marked.items()}
            tables = [clean[name] for name in (C.TENDERS, C.ITEMS, C.BIDS)]
            lost = orphan_count(clean[C.ITEMS], clean[C.TENDERS], list(C.TENDER_DATE_KEY), null_safe=True)
            occurrences.write_occurrences([*_oddities(spark, root, clean), occurrences.items_without_tender(lost)], folder)
        return build_by_period(spark, f"{root}/warehouse", *tables, [balance_check(report)], inputs)


def refresh_period(spark: SparkSession, root: str, year: str, month: str) -> dict[str, int]:
    """Clean one ingested month and load it into the star.

    Other months are left alone, but for items and bids of a tender that this month brings or changes.
    """
    silver_root, period = f"{root}/silver_periodos/{year}-{month}", f"{year}-{month}"
    inputs = period_inputs(read_manifest(spark, f"{root}/bronze").filter((F.col("ano") == year) & (F.col("mes") == month)))
    read = sum(path_bytes(spark, f"{root}/bronze/{d}/ano={year}/mes={month}") for d in silver.CLEANERS) * _TEXT_PER_BYTE
    with sized_shuffles(spark, read), scratch(spark), replaced_set(spark, silver_root) as folder:
        marked, report = bronze_to_silver(spark, f"{root}/bronze", folder, [(year, month)])
        open_gate(balance_check(report))
        clean = {name: silver.accepted(df) for name, df in marked.items()}
        counts = load_period(
            spark, f"{root}/warehouse", period, clean[C.TENDERS], clean[C.ITEMS], clean[C.BIDS], inputs.get(period)
        )
        orphans = spark.createDataFrame([(counts.pop(ORPHANS),)], "orfaos long")
        lost = occurrences.items_without_tender(orphans)
        occurrences.write_occurrences([*_oddities(spark, root, clean, [(year, month)]), lost], folder)
        return counts


def refresh_changes(spark: SparkSession, landing: str, root: str) -> list[str]:
    """Ingest the files that are new or have other content, and load only the periods they belong to.

    A published star says of each period what files it was made of; periods for which that differs from the manifest are
    loaded one after the other. Without a star kept by period, everything is built. Returns
    the periods loaded. A file that has gone from the landing folder takes nothing away.
    """
    ingest_files(spark, unseen_files(spark, discover_landing(spark, landing), f"{root}/bronze"), f"{root}/bronze")
    wanted = period_inputs(read_manifest(spark, f"{root}/bronze"))
    parts = current_parts(spark, f"{root}/warehouse")
    if not any(p.table == POSTINGS for p in parts):
        rebuild(spark, root)
        return sorted(wanted)
    loaded = loaded_inputs(parts)
    stale = sorted(period for period, found in wanted.items() if loaded.get(period) != found)
    for period in stale:
        refresh_period(spark, root, *period.split("-"))
    return stale
