"""What a load dropped or found odd, kept as a table next to the quality report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.operators.aggregates import attribute_drift
from tenderlake.plans.silver import domain_samples
from tenderlake.plans.versions import set_path

OCCURRENCES = "ocorrencias"
SCHEMA = "dataset string, regra string, valor string, linhas long"
INVALID_STATE, SEVERAL_NAMES, WITHOUT_TENDER = "uf_invalida", "unidade_com_varios_nomes", "item_sem_licitacao"


def _rows(df: DataFrame, dataset: str, rule: str, value, count) -> DataFrame:
    return df.select(
        F.lit(dataset).alias("dataset"), F.lit(rule).alias("regra"), value.cast("string").alias("valor"),
        count.cast("long").alias("linhas"),
    )


def invalid_states(raw_tenders: DataFrame) -> DataFrame:
    """Samples of the states that were repaired away; a missing one has no text to show."""
    found = domain_samples(raw_tenders, "UF", C.STATES)
    return _rows(found, C.TENDERS, INVALID_STATE, F.col("UF"), F.lit(None))


def units_with_several_names(tenders: DataFrame) -> DataFrame:
    """Buying units that appear under more than one name; the first one went into the star."""
    drift = attribute_drift(tenders, "Código UG", "Nome UG", "nomes")
    return _rows(drift, C.TENDERS, SEVERAL_NAMES, F.col("`Código UG`"), F.col("nomes"))


def items_without_tender(orphans: DataFrame) -> DataFrame:
    """Items left out because no tender has their number and unit."""
    return _rows(orphans.filter("orfaos > 0"), C.ITEMS, WITHOUT_TENDER, F.lit(None), F.col("orfaos"))


def write_occurrences(parts: list[DataFrame], folder: str) -> None:
    """Write the table of one load to the folder of its set; it holds a few rows, or one per unit at most."""
    reduce(DataFrame.unionByName, parts).coalesce(1).write.json(f"{folder}/{OCCURRENCES}")


def read_occurrences(spark: SparkSession, root: str) -> DataFrame:
    """The occurrences of the current set."""
    return spark.read.schema(SCHEMA).json(set_path(spark, root, OCCURRENCES))
