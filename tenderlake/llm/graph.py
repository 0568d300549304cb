"""Connected components of an edge list, and membership filters built from columns of ids."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.columns import named
from tenderlake.llm.arrays import Bloom
from tenderlake.session import staged


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(id, component)`` for every id on an edge; component is the smallest id reachable.

    Alternating large-star and small-star steps: every step replaces edges by edges to smaller
    ids, so a step never makes more edges than it was given, and a hub costs one row per
    neighbour. The edges of each step are written to the shared folder. Empty edges give an
    empty result; loops and repeated edges change nothing; ids must not be null.
    """
    e = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        before, mark = mark, _mark(e)
        if mark == before:
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def bloom_of(ids: DataFrame, column: str) -> Bloom:
    """Filter that holds all values of a column of longs; built in tasks, merged by bits.

    The number of bits follows the number of ids up to a bound, so what travels to the driver
    and to the tasks is bounded; a crowded filter accepts more strangers, never fewer members.
    """
    count = ids.count()
    bloom = Bloom(count)

    def partial(frames):
        own = Bloom(count)
        for pdf in frames:
            own.add(pdf[column].to_numpy(np.int64))
        step = 1 << 20
        for at in range(0, len(own.bits), step):
            if (piece := own.bits[at : at + step]).any():
                yield pd.DataFrame({"at": [at], "piece": [piece.tobytes()]})

    def merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["piece"].iloc[0], np.uint8).copy()
        for piece in pdf["piece"].iloc[1:]:
            total |= np.frombuffer(piece, np.uint8)
        return pd.DataFrame({"at": [key[0]], "piece": [total.tobytes()]})

    tasks = max(1, min(64, count // 200_000))
    parts = ids.select(column).coalesce(tasks).mapInPandas(partial, "at long, piece binary")
    for row in parts.groupBy("at").applyInPandas(merged, "at long, piece binary").toLocalIterator():
        piece = np.frombuffer(row.piece, np.uint8)
        bloom.bits[row.at : row.at + len(piece)] = piece
    return bloom


def whole_row(rows: DataFrame) -> Column:
    """All columns as one struct named ``row``: helper columns beside it cannot meet a column of the input."""
    return F.struct(*map(named, rows.columns)).alias("row")


def crc_remainder(column: str, modulus: int) -> Column:
    """Remainder of the CRC-32 of a column as text; -1 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(-1))
