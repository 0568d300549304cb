"""Grouped sums, means, deviations, distinct counts and conditional counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.functions.columns import named, zscore
from tenderlake.operators.joins import BROADCAST_BYTES, ROWS_PER_TASK, lookup, parts_for, rows_bytes
from tenderlake.session import staged


def sum_count_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    total: str = "valor_total",
    count: str | None = None,
) -> DataFrame:
    measures = [F.sum(named(value)).alias(total)]
    if count:
        measures.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*[named(k) for k in keys]).agg(*measures)


def sum_count_by_attributes(
    fact: DataFrame,
    lookups: Sequence[tuple[DataFrame, str]],
    keys: Sequence[str],
    value: str,
    total: str = "valor_total",
    count: str | None = None,
) -> DataFrame:
    """Sum a fact by dimension attributes, joining after a first sum by surrogate key.

    The fact is reduced to one row per combination of surrogate keys before any join. With
    one key the joins move dimension-sized data and a hot key weighs no more than any other;
    with several, a key that is still hot is spread.
    """
    sks = [sk for _, sk in lookups]
    reduced = fact.groupBy(*sks).agg(F.sum(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    several = len(sks) > 1
    if several:
        reduced = reduced.withColumn("_id", F.xxhash64(*sks))
    for dim, sk in lookups:
        wanted = [k for k in keys if k in dim.columns]
        spread = {"spread_by": "_id"} if several else {}
        reduced = lookup(reduced, dim, [(sk, sk)], wanted, "inner", **spread)
    measures = [F.sum("_v").alias(total)]
    if count:
        measures.append(F.sum("_n").alias(count))
    return reduced.groupBy(*keys).agg(*measures)


def mean_of(df: DataFrame, name: str, alias: str) -> DataFrame:
    return df.agg(F.avg(named(name)).alias(alias))


def group_stats(
    df: DataFrame, keys: Sequence[str], value: str, min_count: int = 5
) -> DataFrame:
    """Mean, sample deviation and count of the known values, for groups of a minimum size."""
    return (
        df.filter(named(value).isNotNull())
        .groupBy(*[named(k) for k in keys])
        .agg(
            F.avg(named(value)).alias("media"),
            F.stddev_samp(named(value).cast("double")).alias("desvio_padrao"),
            F.count(F.lit(1)).alias("quantidade_ocorrencias"),
            F.max(named(value)).alias("maior"),
        )
        .filter(F.col("quantidade_ocorrencias") >= min_count)
    )


def above_threshold(x: Column, mean: Column, deviation: Column, sigmas: float) -> Column:
    return x.cast("double") > mean.cast("double") + F.lit(float(sigmas)) * deviation


def may_exceed(df: DataFrame, group: str, value: str, thresholds: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows above the least threshold (``_limiar``) of all groups that share their group's class.

    Classes are by hash, as many as may be broadcast however many groups there are; more groups per class let more
    rows through, and never hold back one that is above its own group's threshold. No row is shuffled.
    """
    classes = max(broadcast_bytes // rows_bytes(1, 1), 1)
    of = F.pmod(F.xxhash64(named(group)), F.lit(classes))
    least = thresholds.groupBy(of.alias("_classe")).agg(F.min("_limiar").alias("_limiar"))
    reached = (of == F.col("_classe")) & (named(value).cast("double") > F.col("_limiar"))
    return df.join(F.broadcast(least), reached, "left_semi")


def flag_outliers(
    df: DataFrame,
    group: str,
    value: str,
    row_id: str,
    sigmas: float = 2,
    min_count: int = 5,
    rows_per_task: int = ROWS_PER_TASK,
    groups: int | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Rows whose value lies more than ``sigmas`` deviations above their group's mean.

    Group statistics are partially aggregated. Groups whose maximum stays below the
    threshold never reach the join. A group too large for one task is dealt to several,
    using the count the statistics already hold; statistics that cannot be broadcast are
    written, so that they are computed once, and rows below the least threshold of a class of groups are
    left out before the others are shuffled. Where ``groups``, an upper bound on the number
    of groups, allows it, the statistics are broadcast and the rows are not shuffled at all. ``stats``
    replaces the statistics, where they are known from elsewhere.
    """
    known = df.filter(named(value).isNotNull() & named(group).isNotNull())
    if stats is None:
        stats = group_stats(known, [group], value, min_count)
    size = F.col("quantidade_ocorrencias")
    reachable = above_threshold(F.col("maior"), F.col("media"), F.col("desvio_padrao"), sigmas)
    parts = F.when(reachable, parts_for(size, rows_per_task)).otherwise(0)
    bounded = groups is not None and not isinstance(df.schema[group].dataType, T.StringType)
    if not (bounded and rows_bytes(groups, 5) <= BROADCAST_BYTES):
        stats = staged(stats)  # hot groups, thresholds and the join each read them
        limit = F.col("media").cast("double") + F.lit(float(sigmas)) * F.col("desvio_padrao")
        known = may_exceed(known, group, value, stats.filter(reachable).select(named(group), limit.alias("_limiar")))
    flagged = lookup(
        known,
        stats.filter(reachable),
        [(group, group)],
        ["media", "desvio_padrao", "quantidade_ocorrencias"],
        how="inner",
        spread_by=row_id,
        hot=stats.filter(size > rows_per_task).select(named(group), parts.alias("_partes")),
        parts=parts,
        broadcast_bytes=BROADCAST_BYTES if bounded else 0,
        dim_bytes=rows_bytes(groups, 5) if bounded else None,
        residual=lambda rows, side: above_threshold(
            rows[f"`{value}`"], side["_v_media"], side["_v_desvio_padrao"], sigmas
        ),
    )
    score = zscore(named(value), F.col("media"), F.col("desvio_padrao"))
    return flagged.withColumn("desvios_acima_da_media", score)


def distinct_by(
    df: DataFrame, keys: Sequence[str], name: str, alias: str, approximate: bool = False
) -> DataFrame:
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*[named(k) for k in keys]).agg(counter(named(name)).alias(alias))


def attribute_drift(
    df: DataFrame, key: str, attribute: str, alias: str = "valores_distintos"
) -> DataFrame:
    """Keys carrying more than one value of an attribute; missing keys and values are ignored."""
    pairs = df.select(named(key), named(attribute)).dropna().distinct()
    counted = pairs.groupBy(named(key)).agg(F.count(F.lit(1)).alias(alias))
    return counted.filter(F.col(alias) > 1)


def count_where(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row counting how often each condition holds, in a single pass."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
