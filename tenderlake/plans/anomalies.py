"""Price anomalies kept up to date: only products of changed periods are judged again.

Next to the flagged rows, the moments of each product's prices are kept by period, with the folder of the fact they were
computed from. When folders of the published star differ from these, their moments are computed anew, and
those of all periods merge into the statistics of every product concerned. The thresholds of all other products
are where they were, and so are their flagged rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.operators.aggregates import flag_outliers
from tenderlake.operators.joins import BROADCAST_BYTES, matching, measured_bytes, rows_with_keys
from tenderlake.operators.states import gathered_moments, merge_moments
from tenderlake.plans.publish import table_schema
from tenderlake.plans.versions import (
    Part,
    base_and_parts,
    current_parts,
    new_version,
    publish_parts,
    removed_on_failure,
    version_path,
)
from tenderlake.session import PACKED, staged

MOMENTS, FLAGGED = "momentos_de_preco", "precos_anomalos"
_PRODUCT, _PRICE, _PERIOD, _FOLDER = "sk_produto", "valor_unitario_item", "periodo", "_pasta"
_ROW = ("sk_fato_item", "sk_tempo", "sk_orgao", "sk_fornecedor", _PRODUCT, "sk_licitacao", _PRICE)
_STATE = f"{_PRODUCT} int, n long, soma decimal(28,4), centro double, quadrados double, maior decimal(18,4), {_PERIOD} string"


def _facts(spark: SparkSession, parts: Sequence[Part]) -> DataFrame:
    """Prices of some periods, each row with its period."""
    schema = table_schema(C.FATO_ITEM)
    rows = [spark.read.schema(schema).parquet(p.path).select(*_ROW, F.lit(p.period).alias(_PERIOD)) for p in parts]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], schema).select(*_ROW, F.lit("").alias(_PERIOD))


def _read(spark: SparkSession, parts: Sequence[Part]) -> DataFrame:
    paths = [p.path for p in parts]
    return spark.read.schema(_STATE).parquet(*paths) if paths else spark.createDataFrame([], _STATE)


def update_outliers(spark: SparkSession, warehouse: str, root: str, sigmas: float = 2, min_count: int = 5) -> list[str]:
    """Bring the flagged rows below ``root`` up to the star published below ``warehouse``; returns the periods computed anew.

    The limits have to be the same from update to update. Another update in the meantime makes this one fail.
    """
    facts = {p.period or "": p._replace(period=p.period or "") for p in current_parts(spark, warehouse) if p.table == C.FATO_ITEM.name}
    base, before = base_and_parts(spark, root)
    states = {p.period: p for p in before if p.table == MOMENTS}
    changed = sorted(k for k, p in facts.items() if k not in states or states[k].inputs != p.path)
    gone = sorted(states.keys() - facts.keys())
    if base is not None and not changed and not gone:
        return []
    version = new_version()
    with removed_on_failure(spark, root, version):
        folder = version_path(root, version, MOMENTS)
        made = gathered_moments(_facts(spark, [facts[k] for k in changed]), _PRODUCT, [_PRODUCT, _PERIOD], _PRICE)
        made = made.select(_PRODUCT, "n", F.col("soma").cast("decimal(28,4)").alias("soma"), "centro", "quadrados", "maior", _PERIOD)
        made.withColumn(_FOLDER, F.md5(F.col(_PERIOD).cast("binary"))).hint("rebalance", _FOLDER).write.partitionBy(_FOLDER).options(**PACKED).parquet(folder)
        found = spark.read.schema(_STATE).parquet(folder)
        filled = {r[0]: r[1] for r in found.select(_PERIOD, F.md5(F.col(_PERIOD).cast("binary"))).distinct().collect()}
        empty = f"{folder}/vazio"
        if len(filled) < len(changed):
            spark.createDataFrame([], _STATE).write.parquet(empty)
        fresh = [
            Part(MOMENTS, f"{folder}/{_FOLDER}={filled[k]}" if k in filled else empty, k, inputs=facts[k].path) for k in changed
        ]
        kept = [p for k, p in states.items() if k not in changed and k not in gone]
        now = _read(spark, [*kept, *fresh])
        stale = _read(spark, [states[k] for k in (*changed, *gone) if k in states])
        touched = staged(stale.select(_PRODUCT).unionByName(found.select(_PRODUCT)).dropna().distinct())
        mine = staged(rows_with_keys(now, touched, [(_PRODUCT, _PRODUCT)]))
        periods = {r[0] for r in mine.select(_PERIOD).distinct().collect()}
        rows = _facts(spark, [facts[k] for k in sorted(periods)]).drop(_PERIOD)
        stats = merge_moments(mine, [_PRODUCT], min_count)
        flagged = flag_outliers(rows, _PRODUCT, _PRICE, "sk_fato_item", sigmas, min_count, groups=touched.count(), stats=stats)
        old = [p for p in before if p.table == FLAGGED]
        if old:
            others = spark.read.schema(flagged.schema).parquet(old[0].path)
            done = F.broadcast(touched) if measured_bytes(touched) <= BROADCAST_BYTES else touched
            flagged = flagged.unionByName(others.join(done, matching(others, done, [(_PRODUCT, _PRODUCT)], null_safe=False), "left_anti"))
        path = version_path(root, version, FLAGGED)
        flagged.write.options(**PACKED).parquet(path)
        publish_parts(spark, root, version, [*kept, *fresh, Part(FLAGGED, path)], base)
    return changed


def read_outliers(spark: SparkSession, root: str) -> DataFrame:
    """Flagged rows as last updated, in the shape of ``marts.price_outliers``."""
    for part in current_parts(spark, root):
        if part.table == FLAGGED:
            return spark.read.parquet(part.path).withColumnRenamed("media", "preco_medio_produto")
    raise FileNotFoundError(f"no anomalies below {root}")
