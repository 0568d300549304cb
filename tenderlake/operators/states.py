"""Aggregates kept as states: small tables per group and period that merge into the aggregate of all periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.functions.columns import named
from tenderlake.operators.joins import ROWS_PER_TASK, hot_keys, matching
from tenderlake.session import staged

#: Size of a distinct-count sketch: 2 ** 12 registers, a relative standard error of about 1.6 %.
SKETCH_BITS = 12


def moment_states(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per group: number, exact sum, mean, squared deviations and largest of the known values."""
    x = named(value).cast("double")
    return df.filter(named(value).isNotNull()).groupBy(*[named(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.sum(named(value)).alias("soma"), F.avg(x).alias("centro"),
        (F.var_pop(x) * F.count(F.lit(1))).alias("quadrados"), F.max(named(value)).alias("maior"),
    )


def gathered_moments(df: DataFrame, group: str, keys: Sequence[str], value: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """:func:`moment_states`; where groups are so many that tasks would hand on a state for every few rows, the rows of a group meet first.

    ``group`` is one of the keys. A state is some four times as wide as a row. Groups with more rows than one task should
    take are aggregated as they lie.
    """
    known = df.filter(named(value).isNotNull()).select(*[named(k) for k in keys], named(value))
    rows, groups = known.agg(F.count(F.lit(1)), F.approx_count_distinct(named(group))).first()
    if rows >= 4 * groups * known.rdd.getNumPartitions():
        return moment_states(known, keys, value)
    hot = staged(hot_keys(known, [group], rows_per_task).select(named(group).alias("_quente")))
    if hot.isEmpty():
        return moment_states(known.repartition(named(group)), keys, value)
    hot = F.broadcast(hot)
    on = matching(known, hot, [(group, "_quente")], null_safe=True)
    small = moment_states(known.join(hot, on, "left_anti").repartition(named(group)), keys, value)
    return small.unionByName(moment_states(known.join(hot, on, "left_semi"), keys, value))


def _joined(a: Column, b: Column) -> Column:
    """Moments of two groups as one (Chan's formula)."""
    n, step = a.n + b.n, b.centro - a.centro
    return F.struct(
        n.alias("n"), (a.centro + step * b.n / n).alias("centro"),
        (a.quadrados + b.quadrados + step * step * a.n * b.n / n).alias("quadrados"),
    )


def merge_moments(states: DataFrame, keys: Sequence[str], min_count: int = 5) -> DataFrame:
    """What ``group_stats`` gives for all rows behind the states. A group has one state per period, so its list is short."""
    state = F.struct(F.col("n").cast("double").alias("n"), "centro", "quadrados")
    total = F.sum("n")
    kind = states.schema["soma"].dataType
    mean = F.sum("soma") / total
    if isinstance(kind, T.DecimalType):
        # the type and places that an average of the values has
        places = min(kind.scale + 4, 38)
        mean = (F.sum("soma").cast(f"decimal(28,{kind.scale})") / total.cast("decimal(19,0)")).cast(f"decimal(22,{places})")
    merged = states.groupBy(*[named(k) for k in keys]).agg(
        mean.alias("media"), total.alias("quantidade_ocorrencias"), F.max("maior").alias("maior"), F.array_sort(F.collect_list(state)).alias("_partes"),
    ).filter(F.col("quantidade_ocorrencias") >= min_count)
    first, rest = F.element_at("_partes", 1), F.slice("_partes", 2, F.greatest(F.size("_partes") - 1, F.lit(0)))
    squares = F.aggregate(rest, first, _joined)["quadrados"]
    count = F.col("quantidade_ocorrencias")
    deviation = F.when(count > 1, F.sqrt(squares / F.nullif(count - 1, F.lit(0))))
    return merged.withColumn("desvio_padrao", deviation).select(*keys, "media", "desvio_padrao", "quantidade_ocorrencias", "maior")


def presence_states(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Which values each group has: rows that say the same more than once are one. Exact, as large as what is distinct."""
    return df.select(*[named(k) for k in keys], named(name)).filter(named(name).isNotNull()).distinct()


def sketch_states(df: DataFrame, keys: Sequence[str], name: str, bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of each group's values: a few kilobytes, however many there are. Estimates merge, counts could not."""
    return df.groupBy(*[named(k) for k in keys]).agg(F.hll_sketch_agg(named(name), bits).alias("esboco"))


def merge_sketches(states: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """Estimated number of distinct values over all states of a group."""
    return states.groupBy(*[named(k) for k in keys]).agg(F.hll_sketch_estimate(F.hll_union_agg("esboco")).alias(alias))
