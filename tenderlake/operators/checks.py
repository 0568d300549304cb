"""Table contracts, referential integrity and reconciliation, as counts of violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.contracts import Table
from tenderlake.functions.columns import named
from tenderlake.session import side_by_side

_RESULT = ("tabela", "regra", "coluna", "violacoes")


def _line(counted: DataFrame, table: str, rule: str, column: str) -> DataFrame:
    return counted.select(
        F.lit(table).alias("tabela"),
        F.lit(rule).alias("regra"),
        F.lit(column).alias("coluna"),
        F.col("n").cast("long").alias("violacoes"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; keys with a missing part do not count."""
    names = list(keys)
    known = df.select(*[named(k) for k in names]).dropna(subset=names)
    return known.groupBy(*names).agg(F.count(F.lit(1)).alias("linhas")).filter("linhas > 1")


def _surplus(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key value, as one number."""
    return duplicate_keys(df, keys).agg(
        F.coalesce(F.sum(F.col("linhas") - 1), F.lit(0)).alias("n")
    )


def _surplus_of_dense(df: DataFrame, key: str) -> DataFrame:
    """The same for a densely numbered key, exactly, by bitmaps.

    A unique key gains nothing from counting per value: every value would be shuffled. A
    bitmap holds 32,768 neighbouring values in 4 KiB, so a bit per row is shuffled instead.
    """
    value = named(key)
    buckets = (
        df.filter(value.isNotNull())
        .groupBy(F.bitmap_bucket_number(value).alias("b"))
        .agg(
            F.count(F.lit(1)).alias("linhas"),
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(value))).alias("valores"),
        )
    )
    return buckets.agg(F.coalesce(F.sum(F.col("linhas") - F.col("valores")), F.lit(0)).alias("n"))


def _summaries(tables: dict[str, DataFrame], contract: Sequence[Table]) -> dict[str, Row]:
    """One row per table from one pass each: offending cells of every rule, and the extent of an integral key."""

    def summary(table: Table) -> Row:
        df = tables[table.name]
        counted = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(_cell_rules(table).values())]
        if len(table.primary_key) == 1 and isinstance(df.schema[table.primary_key[0]].dataType, T.IntegralType):
            key = named(table.primary_key[0]).cast("long")
            counted += [F.min(key).alias("a"), F.max(key).alias("z"), F.count(key).alias("n")]
        return df.agg(F.count(F.lit(1)).alias("linhas"), *counted).first()

    spark = tables[contract[0].name].sparkSession
    return side_by_side(spark, {t.name: lambda t=t: summary(t) for t in contract})


def _is_dense(row: Row) -> bool:
    """Whether an integral key leaves few gaps: at most 64 values of range per row."""
    return "n" in row and bool(row.n) and row.z - row.a < 64 * row.n


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Non-null fact keys without a dimension row, with the fact rows behind each."""
    counted = (
        fact.filter(named(key).isNotNull())
        .groupBy(named(key))
        .agg(F.count(F.lit(1)).alias("linhas"))
    )
    known = dim.select(named(dim_key or key).alias(key))
    return counted.join(known, key, "left_anti")


def null_keys(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of missing values of each key column."""
    return fact.agg(*[F.count_if(named(k).isNull()).alias(k) for k in keys])


def _cell_rules(table: Table) -> dict[tuple[str, str], Column]:
    """NOT NULL and length rules of a table, as conditions on the offending cell."""
    rules: dict[tuple[str, str], Column] = {}
    for column in table.columns:
        if not column.nullable:
            rules["not_null", column.name] = named(column.name).isNull()
        if column.max_length:
            rules["length", column.name] = F.length(named(column.name)) > column.max_length
    return rules


def _gapless(tables: dict[str, DataFrame], contract: Sequence[Table], summaries: dict[str, Row]) -> dict[tuple[str, str], tuple[int, int]]:
    """First and last value of the keys that hold every value in between: where n values are counted, none is missing."""
    keys = {t.name: t.primary_key[0] for t in contract if _is_dense(summaries[t.name])}
    keys = {t: k for t, k in keys.items() if summaries[t].z - summaries[t].a < summaries[t].n}
    if not keys:
        return {}
    jobs = {t: lambda t=t, k=k: _surplus_of_dense(tables[t], k).first()[0] for t, k in keys.items()}
    surplus = side_by_side(tables[contract[0].name].sparkSession, jobs)
    rows = {t: summaries[t] for t in keys}
    return {(t, keys[t]): (r.a, r.z) for t, r in rows.items() if r.z - r.a + 1 == r.n - surplus[t]}


def _outside(df: DataFrame, table: Table, gapless: dict[tuple[str, str], tuple[int, int]]) -> DataFrame | None:
    """Rows pointing nowhere per foreign key whose targets have no gap: those outside their range, counted without a shuffle."""
    columns = [c for c in table.columns if c.references in gapless]
    if not columns:
        return None
    lost = [F.count_if(~named(c.name).cast("long").between(*gapless[c.references])).cast("long") for c in columns]
    cells = [F.struct(F.lit(c.name).alias("coluna"), n.alias("violacoes")) for c, n in zip(columns, lost)]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c")).select(
        F.lit(table.name).alias("tabela"), F.lit("foreign_key").alias("regra"), "coluna", "violacoes"
    )


def _foreign_keys(
    df: DataFrame, tables: dict[str, DataFrame], table: Table, gapless: dict[tuple[str, str], tuple[int, int]]
) -> DataFrame | None:
    """Rows pointing nowhere per foreign key into a key with gaps, from one scan and one shuffle of distinct keys."""
    columns = [c for c in table.columns if c.references and c.references not in gapless]
    if not columns:
        return None
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("fk"), named(c.name).cast("long").alias("chave"))
            for i, c in enumerate(columns)
        ]
    )
    used = (
        df.select(F.inline(cells))
        .filter("chave IS NOT NULL")
        .groupBy("fk", "chave")
        .agg(F.count(F.lit(1)).alias("linhas"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            tables[c.references[0]].select(
                F.lit(i).alias("fk"), named(c.references[1]).cast("long").alias("chave")
            )
            for i, c in enumerate(columns)
        ],
    )
    lost = used.join(known, ["fk", "chave"], "left_anti").groupBy("fk").agg(
        F.sum("linhas").alias("n")
    )
    rules = df.sparkSession.createDataFrame(
        [(i, c.name) for i, c in enumerate(columns)], "fk int, coluna string"
    )
    return rules.join(F.broadcast(lost), "fk", "left").select(
        F.lit(table.name).alias("tabela"),
        F.lit("foreign_key").alias("regra"),
        "coluna",
        F.coalesce("n", F.lit(0)).cast("long").alias("violacoes"),
    )


def check_contract(tables: dict[str, DataFrame], contract: Sequence[Table]) -> DataFrame:
    """One row per rule of the contract with the number of violations, zero included.

    Primary and unique keys count surplus rows; foreign keys count rows pointing nowhere
    (a missing key is allowed); cell rules count offending cells. Cells and key extents are
    counted at once, in one pass over each table.
    """
    if not contract:
        raise ValueError("the contract names no table")
    spark = tables[contract[0].name].sparkSession
    summaries = _summaries(tables, contract)
    cells = [
        (t.name, rule, column, summaries[t.name][f"c{i}"]) for t in contract for i, (rule, column) in enumerate(_cell_rules(t))
    ]
    results = [spark.createDataFrame(cells, "tabela string, regra string, coluna string, violacoes long")]
    gapless = _gapless(tables, contract, summaries)
    for table in contract:
        df, key = tables[table.name], table.primary_key
        dense = _is_dense(summaries[table.name])
        surplus = _surplus_of_dense(df, key[0]) if dense else _surplus(df, key)
        results += [
            _outside(df, table, gapless),
            _foreign_keys(df, tables, table, gapless),
            _line(surplus, table.name, "primary_key", ",".join(key)),
            *[_line(_surplus(df, u), table.name, "unique", ",".join(u)) for u in table.unique],
        ]
    return reduce(DataFrame.unionByName, [r.select(*_RESULT) for r in results if r is not None])


def key_ranges(spark: SparkSession, tables: Sequence[Table], parts: Sequence) -> DataFrame:
    """Whether the folders of a table share keys, from the first and last key of each (``table``, ``first_key``, ``last_key``).

    Disjoint ranges prove that keys unique in every folder are unique in the table, without reading a folder. One
    row per table in the shape of the contract check: the number of folders that begin before an earlier one ends.
    """
    rows = []
    for table in tables:
        ranges = sorted((p.first_key, p.last_key) for p in parts if p.table == table.name and p.first_key is not None)
        end, overlaps = None, 0
        for first, last in ranges:
            overlaps += end is not None and first <= end
            end = last if end is None else max(end, last)
        rows.append((table.name, "key_ranges", ",".join(table.primary_key), overlaps))
    return spark.createDataFrame(rows, "tabela string, regra string, coluna string, violacoes long").select(*_RESULT)


def reconcile(
    parts: DataFrame, whole: DataFrame, measures: Sequence[str], name: str = "total"
) -> DataFrame:
    """Compare the sums of ``parts`` with the single row ``whole``, measure by measure."""
    lines = []
    for measure in measures:
        left = parts.agg(F.sum(named(measure)).alias("v")).select(
            F.lit(measure).alias("medida"), F.col("v").cast("decimal(38,4)").alias("soma_partes")
        )
        right = whole.select(
            F.lit(measure).alias("medida"), named(measure).cast("decimal(38,4)").alias(name)
        )
        lines.append(left.join(right, "medida"))
    out = reduce(DataFrame.unionByName, lines)
    return out.withColumn("confere", F.col("soma_partes").eqNullSafe(F.col(name)))


def row_balance(report: DataFrame) -> DataFrame:
    """Quality-report rows in which rows in, dropped and out do not add up."""
    expected = (
        F.col("linhas_entrada")
        - F.col("valores_negativos_removidos")
        - F.col("duplicados_removidos")
    )
    return report.filter(expected != F.col("linhas_saida"))


class GateClosed(RuntimeError):
    """Publication stopped because checks found violations."""

    def __init__(self, violations: list):
        self.violations = violations
        super().__init__("; ".join(f"{v.tabela}.{v.coluna} {v.regra}: {v.violacoes}" for v in violations))


def open_gate(results: DataFrame) -> None:
    """Raise :class:`GateClosed` if any rule has violations; one row per rule reaches the driver."""
    broken = results.filter(F.col("violacoes") > 0).collect()
    if broken:
        raise GateClosed(broken)
