"""Lookups from large tables into dimensions, safe against hot keys.

A dimension is broadcast only after its columns have been measured. Beyond the limit the
join is shuffled, and keys with too many rows for one task are dealt to several. The list
of such keys, at most (rows of the large side) / (rows per task) entries, is measured too.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.functions.columns import named
from tenderlake.session import staged

ROWS_PER_TASK = 5_000_000
BROADCAST_BYTES = 100 << 20
_ROW_BYTES, _CELL_BYTES = 32, 16
#: Classes of keys in which rows are counted before keys are.
HASHES = 1 << 16

_SHARES, _SHARE = "_partes", "_parte"


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Keys holding more rows than one task should take, with the number of parts to use.

    A missing key counts as a key, since all its rows would meet in one task too. Rows are counted by a hash
    of the key in ``HASHES`` classes first; a key can be hot only in a class that has as many rows, and
    single keys are counted in such classes alone. Without hot keys no key is shuffled.
    """
    hashed = F.pmod(F.xxhash64(*[named(k) for k in keys]), F.lit(HASHES))
    classes = df.groupBy(hashed.alias("_classe")).agg(F.count(F.lit(1)).alias("_n"))
    full = classes.filter(F.col("_n") > rows_per_task).select("_classe")
    df = df.join(F.broadcast(full), hashed == full["_classe"], "left_semi")
    counted = df.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return counted.filter(F.col("_n") > rows_per_task).select(
        *[named(k) for k in keys], parts_for(F.col("_n"), rows_per_task).alias(_SHARES)
    )


def parts_for(rows: Column, rows_per_task: int = ROWS_PER_TASK) -> Column:
    return F.ceil(rows / rows_per_task).cast("int")


def matching(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], null_safe: bool):
    def pair(a: str, b: str) -> Column:
        mine, theirs = left[f"`{a}`"], right[f"`{b}`"]
        return mine.eqNullSafe(theirs) if null_safe else mine == theirs

    return reduce(lambda x, y: x & y, [pair(a, b) for a, b in on])


def rows_bytes(rows: int, columns: int) -> int:
    """Memory that rows of fixed-width columns take as a hashed join side, about."""
    return rows * (_ROW_BYTES + columns * _CELL_BYTES)


def measured_bytes(df: DataFrame) -> int:
    """The same for any table: its rows are counted and its texts measured, in one pass."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = [F.coalesce(F.sum(F.octet_length(named(c))), F.lit(0)) for c in texts]
    row = df.agg(F.count(F.lit(1)), *lengths).first()
    return rows_bytes(row[0], len(df.columns)) + sum(row[1:])


def _with_shares(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    renamed = hot.select(*[named(k).alias(f"_hot_{k}") for k in keys], _SHARES)
    if measured_bytes(renamed) <= BROADCAST_BYTES:
        renamed = F.broadcast(renamed)
    on = [(k, f"_hot_{k}") for k in keys]
    joined = df.join(renamed, matching(df, renamed, on, null_safe=True), "left")
    return joined.drop(*[f"_hot_{k}" for k in keys])


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    take: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    spread_by: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
    parts: Column | None = None,
    residual=None,
    dim_bytes: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``fact`` to a dimension unique on its key and add the columns ``take``.

    ``on`` pairs fact columns with dimension columns. A dimension of at most
    ``broadcast_bytes`` is broadcast; ``dim_bytes`` saves the measuring where a bound is
    known. Beyond that, with ``spread_by`` (a column that differs from row to row), the rows
    of a hot key are dealt to several tasks by hash and the matching dimension row is
    repeated for each of them; other keys are untouched.
    ``hot`` and ``parts`` (the number of repeats as an expression over ``dim``) replace
    the counting pass where counts are known; zero parts in ``hot`` says that the key has
    no partner, and an inner join drops its rows before the shuffle. ``residual`` builds
    a further condition from (fact, dimension).
    """
    fact_keys = [a for a, _ in on]
    repeats = [parts.alias(_SHARES)] if parts is not None else []
    side = dim.select(
        *[named(b).alias(f"_k{i}") for i, (_, b) in enumerate(on)],
        *[named(c).alias(f"_v_{c}") for c in take],
        *repeats,
    )
    pairs = [(a, f"_k{i}") for i, (a, _) in enumerate(on)]
    kept = fact.columns
    if dim_bytes is None and broadcast_bytes:
        dim_bytes = measured_bytes(side)
    if broadcast_bytes and dim_bytes <= broadcast_bytes:
        side, spread_by = F.broadcast(side), None
    if spread_by:
        if hot is None:
            hot = hot_keys(fact, fact_keys, rows_per_task)
        hot = staged(hot)
        fact = _with_shares(fact, fact_keys, hot)
        if how == "inner":
            fact = fact.filter(F.coalesce(F.col(_SHARES), F.lit(1)) > 0)
        dealt = F.pmod(F.xxhash64(named(spread_by)), F.coalesce(F.col(_SHARES), F.lit(1)))
        fact = fact.withColumn(_SHARE, dealt.cast("int")).drop(_SHARES)
        if parts is None:
            side_keys = [f"_k{i}" for i in range(len(on))]
            side_hot = hot.select(
                *[named(k).alias(i) for k, i in zip(fact_keys, side_keys)], _SHARES
            )
            side = _with_shares(side, side_keys, side_hot)
        copies = F.sequence(F.lit(0), F.coalesce(F.col(_SHARES), F.lit(1)) - 1)
        side = side.withColumn("_kparte", F.explode(copies)).drop(_SHARES)
    condition = matching(fact, side, pairs, null_safe)
    if spread_by:
        condition = condition & (fact[_SHARE] == side["_kparte"])
    if residual is not None:
        condition = condition & residual(fact, side)
    joined = fact.join(side, condition, how)
    return joined.select(
        *[fact[f"`{c}`"] for c in kept], *[side[f"`_v_{c}`"].alias(c) for c in take]
    )


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    key: str,
    null_safe: bool = False,
    spread_by: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
    **sizes: int,
) -> DataFrame:
    """Add the surrogate key of the matching dimension row, or null."""
    return lookup(
        fact, dim, on, [key], "left", null_safe, spread_by, rows_per_task, hot, **sizes
    )


def rows_with_keys(
    df: DataFrame, keys: DataFrame, on: Sequence[tuple[str, str]], null_safe: bool = False, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of a large table whose key stands in ``keys``; ``on`` pairs columns of both.

    The keys are measured, so they should be a written table: up to ``broadcast_bytes`` they are broadcast and
    the large table is not shuffled.
    """
    if measured_bytes(keys) <= broadcast_bytes:
        keys = F.broadcast(keys)
    return df.join(keys, matching(df, keys, on, null_safe), "left_semi")


def mark_matches(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    take: Sequence[str] = (),
    spread_by: str | None = None,
    marker: str = "_encontrado",
    **sizes: int,
) -> DataFrame:
    """Left join that also tells whether the row found a partner."""
    found = right.withColumn(marker, F.lit(True))
    on = [(k, k) for k in keys]
    joined = lookup(left, found, on, [*take, marker], spread_by=spread_by, **sizes)
    return joined.withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))


def orphan_count(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of ``left`` without a partner, as one number.

    Rows are counted per key before the anti join, so only distinct keys are shuffled.
    """
    per_key = left.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    known = right.select(*[named(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    on = [(k, f"_k{i}") for i, k in enumerate(keys)]
    lost = per_key.join(known, matching(per_key, known, on, null_safe), "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orfaos"))


def inner_with_orphans(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    take: Sequence[str] = (),
    spread_by: str | None = None,
    **sizes: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``left`` with a partner, and the number of those without one."""
    marked = mark_matches(left, right, keys, take, spread_by, **sizes)
    matched = marked.filter("_encontrado").drop("_encontrado")
    return matched, orphan_count(left, right, keys)
