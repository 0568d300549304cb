"""Typed, checked, all-or-nothing publication of the star.

A published star is a version (see :mod:`tenderlake.plans.versions`): a list of folders, one per fact and period, and
one or several per dimension. A dimension's later folders hold the members that a load brought or changed;
readers take the newest row of each key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake import contracts as C
from tenderlake.functions.columns import named
from tenderlake.operators.checks import check_contract, open_gate
from tenderlake.operators.joins import BROADCAST_BYTES, rows_bytes
from tenderlake.operators.keys import latest_by_key
from tenderlake.plans.gold import Star
from tenderlake.plans.versions import (
    Part,
    current_parts,
    new_version,
    publish_parts,
    removed_on_failure,
    set_path,
    version_path,
    write_set,
)
from tenderlake.session import PACKED, side_by_side


def conform(df: DataFrame, table: C.Table, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of the contract in their types, and those to ``keep``; empty text is missing, money is rounded.

    A value that does not fit its type stops the job. Lengths are left as they are and
    reported by the contract check, so that no text is cut silently.
    """
    cells = []
    for column in table.columns:
        cell = named(column.name)
        if isinstance(df.schema[column.name].dataType, T.StringType):
            cell = F.nullif(cell, F.lit(""))
        cells.append(cell.cast(column.type).alias(column.name))
    return df.select(*cells, *keep)


def conform_all(
    tables: dict[str, DataFrame], contract: Sequence[C.Table] = C.WAREHOUSE
) -> dict[str, DataFrame]:
    return {t.name: conform(tables[t.name], t) for t in contract}


def table_schema(table: C.Table) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.type) for c in table.columns])


def write_gold(tables: dict[str, DataFrame], root: str) -> None:
    """Replace all tables of the star together; until the last one is written readers see the old ones."""
    write_set(next(iter(tables.values())).sparkSession, tables, root)


def read_star(spark: SparkSession, root: str) -> Star:
    return Star(**{t.name: spark.read.parquet(set_path(spark, root, t.name)) for t in C.WAREHOUSE})


def stage_version(
    spark: SparkSession, tables: dict[str, DataFrame], root: str, version: str | None = None
) -> str:
    """Write tables under a new version that no reader sees yet."""
    version = version or new_version()

    def write(name: str, df: DataFrame) -> Callable[[], None]:
        return lambda: df.write.options(**PACKED).parquet(version_path(root, version, name))

    side_by_side(spark, {name: write(name, df) for name, df in tables.items()})
    return version


def publish_version(
    spark: SparkSession, root: str, version: str, contract: Sequence[C.Table] = C.WAREHOUSE
) -> None:
    """Switch readers to a staged version in which every table is one folder."""
    parts = [Part(t.name, version_path(root, version, t.name)) for t in contract]
    publish_parts(spark, root, version, parts)


def _newest(spark: SparkSession, table: C.Table, parts: Sequence[Part]) -> DataFrame:
    """Members of a dimension kept in several folders: of each key the row of the last folder that has it.

    The first folder, the large one, is not shuffled as long as the keys of the others may be broadcast.
    """
    schema, key = table_schema(table), table.primary_key[0]
    first, *later = parts
    turns = [spark.read.schema(schema).parquet(p.path).withColumn("_vez", F.lit(i)) for i, p in enumerate(later)]
    changes = reduce(DataFrame.unionByName, turns)
    if len(later) > 1:
        changes = latest_by_key(changes, [key], "_vez")
    changes = changes.drop("_vez")
    known = changes.select(key)
    rows = [p.rows for p in later]
    if None not in rows and rows_bytes(sum(rows), 1) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    return spark.read.schema(schema).parquet(first.path).join(known, key, "left_anti").unionByName(changes)


def read_tables(
    spark: SparkSession, parts: Sequence[Part], contract: Sequence[C.Table] = C.WAREHOUSE
) -> dict[str, DataFrame]:
    """Tables of a list of folders; a table without a folder is empty."""
    tables = {}
    for table in contract:
        schema = table_schema(table)
        mine = [p for p in parts if p.table == table.name]
        if any(p.delta for p in mine):
            tables[table.name] = _newest(spark, table, mine)
        elif mine:
            tables[table.name] = spark.read.schema(schema).parquet(*[p.path for p in mine])
        else:
            tables[table.name] = spark.createDataFrame([], schema)
    return tables


def read_version(spark: SparkSession, root: str) -> Star:
    parts = current_parts(spark, root)
    if not parts:
        raise FileNotFoundError(f"nothing published below {root}")
    return Star(**read_tables(spark, parts))


def row_counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tabela"), "n")
        for name, df in tables.items()
    ]
    return {r.tabela: r.n for r in reduce(DataFrame.unionByName, counts).collect()}


def publish_if_clean(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    contract: Sequence[C.Table] = C.WAREHOUSE,
    more_checks: Sequence[DataFrame] = (),
) -> dict[str, int]:
    """Stage, check and publish; violations leave the published version untouched.

    The checks read the staged files, that is, exactly what would be published.
    ``more_checks`` are further results in the shape of the contract check.
    """
    version = new_version()
    with removed_on_failure(spark, root, version):
        stage_version(spark, conform_all(tables, contract), root, version)
        staged = [Part(t.name, version_path(root, version, t.name)) for t in contract]
        written = read_tables(spark, staged, contract)
        gate(check_contract(written, contract), more_checks)
        publish_parts(spark, root, version, staged)
    return row_counts(written)


def gate(results: DataFrame, more_checks: Sequence[DataFrame] = ()) -> None:
    """Raise if the contract check, or a further check of its shape, found violations."""
    open_gate(reduce(DataFrame.unionByName, more_checks, results))


def load_warehouse(spark: SparkSession, star: Star, root: str) -> dict[str, int]:
    """Full reload: the new tables replace the old ones in one step. Returns rows per table."""
    return publish_if_clean(spark, star.tables(), root)
