"""Bounded samples of labelled rows for fitting; everything else reads all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.session import staged

#: Counts of at most this many labels are broadcast; counts of more are joined as Spark sees fit.
FEW_LABELS = 10_000


def sample_per_label(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of each label: those whose key has the smallest hash.

    Rows are thinned by hash before they are ranked, so the ranking sees about ``2 * most`` rows
    of a label however many there are. The same rows give the same sample.
    """
    share = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = staged(rows.groupBy(label).agg(F.count("*").alias("__rows")))
    if counts.count() <= FEW_LABELS:
        counts = F.broadcast(counts)
    order = Window.partitionBy(label).orderBy("__share", key, *[c for c in rows.columns if c not in (label, key)])
    return (
        rows.withColumn("__share", share).join(counts, label)
        .where(F.col("__share") * F.col("__rows") <= 2 * most)
        .withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= most)
        .drop("__share", "__rows", "__rank")
    )
