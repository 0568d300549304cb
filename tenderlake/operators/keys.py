"""Deduplication, first-per-key selection, unions and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.contracts import ROW_ORD
from tenderlake.functions.columns import named
from tenderlake.operators.joins import BROADCAST_BYTES, measured_bytes
from tenderlake.session import staged

# monotonically_increasing_id keeps the row position in its low 33 bits.
_POSITION_BITS = (1 << 33) - 1
_SOURCE_SHIFT = 56


def dedup_exact(df: DataFrame, order: str = ROW_ORD, copies: str | None = None) -> DataFrame:
    """One row per distinct content, keeping the smallest ordinal.

    Copies collapse before the shuffle, so a row repeated a billion times costs one
    row per map task. ``copies`` names a column counting the rows behind each survivor.
    """
    content = [named(c) for c in df.columns if c != order]
    measures = [F.min(named(order)).alias(order)]
    if copies:
        measures.append(F.count(F.lit(1)).alias(copies))
    return df.groupBy(*content).agg(*measures)


def split_repeated(df: DataFrame, content: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``content`` no other row has, which need not be shuffled to meet their copies, and the rest.

    Contents are counted by 40 bits of a hash; the first 29 are the class of a content, and a class with a hash that stands
    more than once sets its bit in bitmaps that are broadcast. Copies are always in the rest, with rows that merely
    share a class, so the rest must still be compared. Whatever the table's size, a hash of each row is shuffled
    and at most 64 MB are broadcast. Both sides read ``df`` again.
    """
    hashed = F.shiftrightunsigned(F.xxhash64(*content), 24)
    low = hashed.bitwiseAND(F.lit((1 << 26) - 1)).cast("int")
    hashes = df.select(F.shiftright(hashed, 26).cast("int").alias("_mapa"), low.alias("_resto"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = hashes.repartition(partitions, "_mapa").groupBy("_mapa", "_resto").agg(F.count(F.lit(1)).alias("_n"))
    place = F.shiftright("_resto", 11).cast("long")
    maps = staged(counted.filter("_n > 1").groupBy("_mapa").agg(F.bitmap_construct_agg(place).alias("_bits")))
    # a row reads the whole piece its bit is in, so bitmaps of 4 KiB are cut in eight
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.struct((F.col("_mapa") * 8 + i).alias("_pedaco"), F.substring("_bits", i * 512 + 1, F.lit(512)).alias("_bits")),
    )
    bits = F.broadcast(maps.select(F.inline(pieces)))
    bit = F.shiftright(low, 11).bitwiseAND(F.lit(4095))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = (F.shiftright(hashed, 23).cast("int") == F.col("_pedaco")) & (F.getbit(byte, bit.bitwiseAND(F.lit(7))) == 1)
    return df.join(bits, found, "left_anti"), df.join(bits, found, "left_semi")


def _picked_by_key(df: DataFrame, keys: Sequence[str], pick, order: str | Column) -> DataFrame:
    rank = named(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = pick(F.struct(*[named(c).alias(c) for c in rest]), rank).alias("_row")
    grouped = df.groupBy(*[named(k) for k in keys]).agg(row)
    return grouped.select(
        *[named(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def first_by_key(
    df: DataFrame, keys: Sequence[str], order: str | Column, repetitive: bool = False, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The row with the smallest ``order`` for each key; missing keys form one group.

    Each map task keeps one row per key, so a hot key is one row per task in the shuffle.
    ``repetitive`` is for tables that say the same about a key over and over (the name of a
    supplier on each of its items): equal statements first merge in a hash aggregation that
    holds only their smallest ordinal, and the picking sees one row per distinct statement.
    ``order`` must then be a column name.

    By a named order, which has to tell a key's rows apart, the smallest ordinal of each key is found by a hash
    aggregation of fixed-width numbers, and rows are matched to it; picking whole rows would make Spark sort them.
    A row whose key no other row has is first anyway: if the keys that stand more than once may be broadcast, their
    later rows are taken out where they lie and whole rows are not shuffled.
    """
    if repetitive:
        said = [named(c) for c in df.columns if c != order]
        df = df.groupBy(*said).agg(F.min(named(order)).alias(order)).select(
            *[named(c) for c in df.columns]
        )
    if not isinstance(order, str):
        return _picked_by_key(df, keys, F.min_by, order)
    by_key = df.groupBy(*[named(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    least = F.min(named(order)).alias("_melhor")
    same = [named(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    at_best = named(order).eqNullSafe(F.col("_melhor"))
    if not repetitive:
        repeated = staged(by_key.agg(least, F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
        if measured_bytes(repeated) <= broadcast_bytes:
            return df.join(F.broadcast(repeated), reduce(Column.__and__, [*same, ~at_best]), "left_anti")
    return df.join(by_key.agg(least), reduce(Column.__and__, [*same, at_best]), "left_semi")


def latest_by_key(df: DataFrame, keys: Sequence[str], version: str | Column) -> DataFrame:
    """The row with the largest ``version`` for each key."""
    return _picked_by_key(df, keys, F.max_by, version)


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(named(name)).distinct()


def union_periods(parts: Sequence[DataFrame]) -> DataFrame:
    """Union period files by column name; a column one period lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_ranked(parts: Sequence[DataFrame], order: str = ROW_ORD) -> DataFrame:
    """Union same-shaped sources; every row of an earlier source sorts before a later one's.

    Source rank and ordinal (at most 56 bits) share one long, which keeps keep-first
    aggregation on fixed-width buffers.
    """
    ranked = [
        p.withColumn(order, F.lit(i << _SOURCE_SHIFT).cast("long") + named(order))
        for i, p in enumerate(parts)
    ]
    return reduce(DataFrame.unionByName, ranked)


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).distinct()


def assign_dense_key(
    df: DataFrame,
    name: str,
    order: Sequence[str] = (),
    start: int = 1,
    key_type: str = "int",
) -> DataFrame:
    """Number the rows ``start, start+1, …`` without a gap.

    With ``order`` (which must identify a row) the numbers follow it: one range shuffle
    and a local sort. Without it they follow the rows as they lie, with no shuffle at all.
    The placed rows are written once with their partition and position, so a lost
    executor cannot renumber them; only one offset per partition is then broadcast,
    which is bounded by the number of shuffle partitions or input splits.
    """
    placed = df
    if order:
        by = [named(c) for c in order]
        placed = df.repartitionByRange(*by).sortWithinPartitions(*by)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
    rows = staged(
        placed.select("*", F.spark_partition_id().alias("_part"), position.alias("_pos"))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    number = (F.col("_offset") + F.col("_pos") + F.lit(start)).cast(key_type)
    return rows.join(F.broadcast(offsets), "_part").select(
        number.alias(name), *[named(c) for c in df.columns if c != name]
    )


def assign_key_by_group(df: DataFrame, name: str, group: str, start: int = 1, key_type: str = "bigint") -> DataFrame:
    """Number the rows without a gap so that those of one group get consecutive numbers, groups in their order.

    Rows are rebalanced by group: small groups share a task, a large one is dealt to several. As in
    :func:`assign_dense_key` they are written once with their place; one offset per group and partition is broadcast.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
    placed = df.hint("rebalance", group).sortWithinPartitions(group)
    rows = staged(placed.select("*", F.spark_partition_id().alias("_part"), position.alias("_pos")))
    before = Window.orderBy("_grupo", "_bloco").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(named(group).alias("_grupo"), F.col("_part").alias("_bloco"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_primeira"))
        .select("_grupo", "_bloco", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_primeira")).alias("_offset"))
    )
    number = (F.col("_offset") + F.col("_pos") + F.lit(start)).cast(key_type)
    same = named(group).eqNullSafe(F.col("_grupo")) & (F.col("_part") == F.col("_bloco"))
    return rows.join(F.broadcast(offsets), same).select(number.alias(name), *[named(c) for c in df.columns if c != name])


def get_or_create_key(
    mapping: DataFrame, batch: DataFrame, natural_key: Sequence[str], sk: str
) -> DataFrame:
    """Grow a natural-to-surrogate mapping by the unseen keys of a batch.

    Known keys keep their number. Unseen ones follow the largest number in use, in
    natural-key order, so repeating the batch adds nothing.
    """
    keys = list(natural_key)
    unseen = (
        batch.select(*[named(k) for k in keys])
        .dropna(subset=keys)
        .distinct()
        .join(mapping.select(*[named(k) for k in keys]), keys, "left_anti")
    )
    last = mapping.agg(F.coalesce(F.max(named(sk)), F.lit(0))).first()[0]
    kind = mapping.schema[sk].dataType.simpleString()
    added = assign_dense_key(unseen, sk, order=keys, start=last + 1, key_type=kind)
    return mapping.select(named(sk), *[named(k) for k in keys]).unionByName(added)
