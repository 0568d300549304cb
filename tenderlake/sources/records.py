"""Records of delimited files whose cells may span lines, read in splits.

Where a record begins cannot be seen from a line alone: it depends on whether the line lies inside a quoted cell.
In a file that quotes properly a quote opens or closes a cell, or stands doubled inside one, so a line lies
inside a cell exactly when an odd number of quotes stands before it. Quotes are counted per split, the counts
are summed up over the splits of a file, and every split starts at its first line that begins a record. The lines
before it belong to the last record of an earlier split; only such pieces are brought together.

Files that quote in other ways (a quote inside an unquoted cell, text after a closing quote, a cell that
never closes, mixed line ends) are found by the same pass and have to be read as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake import contracts as C
from tenderlake.session import in_few_tasks, staged

QUOTED_CELL = r'(^|;)"[^"]*+(?:""[^"]*+)*+"(?=;|$)'
#: A line that begins outside a cell: what remains without whole quoted cells has no quote, or one cell that goes on.
_OPENS = r'^(?:[^"]*;)?"[^"]*+(?:""[^"]*+)*+$'
#: The end of a cell that an earlier line opened, and a line that lies inside one altogether.
_CLOSES = r'^[^"]*+(?:""[^"]*+)*+"(?=;|$)'
_INSIDE = r'^[^"]*+(?:""[^"]*+)*+$'

#: Pieces of a record, in the order in which they stand in a split.
_WHOLE, _GOES_ON, _BEGINS = 0, 1, 2

_COUNTS = ("improprias_fora", "improprias_dentro", "linhas", "com_cr", "cr_dentro", "inicios_fora", "inicios_dentro")
_SUMS = pa.schema([("path", pa.string()), ("bloco", pa.int64()), ("vira", pa.bool_()), *[(c, pa.int64()) for c in _COUNTS]])
_SUMS_TEXT = "path string, bloco long, vira boolean, " + ", ".join(f"{c} long" for c in _COUNTS)
_PIECES = pa.schema([("path", pa.string()), ("bloco", pa.int64()), ("id", pa.int64()), ("tipo", pa.int32()), ("texto", pa.string())])
_PIECES_TEXT = "path string, bloco long, id long, tipo int, texto string"


def _proper_outside(line: Column) -> Column:
    rest = F.regexp_replace(line, QUOTED_CELL, "$1")
    return ~F.contains(rest, F.lit('"')) | rest.rlike(_OPENS)


def _proper_inside(line: Column) -> Column:
    rest = F.regexp_replace(line, _CLOSES, "")
    return line.rlike(_INSIDE) | (line.rlike(_CLOSES) & _proper_outside(rest))


def _lines(spark: SparkSession, paths: Sequence[str], source_path: Column, encoding: str) -> DataFrame:
    """Lines cut at line feeds only, with file and split, in the order of each split."""
    text = F.decode(F.col("value").cast("binary"), encoding)
    return in_few_tasks(spark.read.option("lineSep", "\n").text(list(paths)).select(
        source_path.alias("path"), F.col("_metadata.file_block_start").alias("bloco"), text.alias("linha"),
    ))


def split_states(lines: DataFrame) -> DataFrame:
    """Per file and split: whether it begins inside a cell, how many records begin in it, and whether the file is properly quoted.

    A line is judged both as beginning inside and as beginning outside a cell; which of the two counts follows
    from the quotes before it. That needs lines in order, so it runs within the tasks that read them.
    """
    body = F.regexp_replace("linha", "\r$", "")
    judged = lines.select(
        "path", "bloco", (F.regexp_count("linha", F.lit('"')) % 2 == 1).alias("vira"), _proper_outside(body).alias("fora"),
        _proper_inside(body).alias("dentro"), F.endswith("linha", F.lit("\r")).alias("cr"), F.contains(body, F.lit("\r")).alias("cr_dentro"),
        (body != "").alias("cheia"),
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, list] = {}
        for batch in batches:
            rows = batch.to_pandas()
            for (path, block), part in rows.groupby(["path", "bloco"], sort=False):
                # odd quotes so far; improper lines and beginnings of records if the split begins outside a cell, and if inside
                seen = totals.setdefault((path, block), [False, 0, 0, 0, 0, 0, 0, 0])
                odd = part["vira"].to_numpy(bool).cumsum() % 2 == 1
                before = (odd ^ part["vira"].to_numpy(bool)) ^ seen[0]
                outside, inside, filled = (part[c].to_numpy(bool) for c in ("fora", "dentro", "cheia"))
                seen[1] += int((~outside[~before]).sum() + (~inside[before]).sum())
                seen[2] += int((~outside[before]).sum() + (~inside[~before]).sum())
                seen[0] = bool(seen[0] ^ odd[-1])
                seen[3] += len(part)
                seen[4] += int(part["cr"].sum())
                seen[5] += int(part["cr_dentro"].sum())
                seen[6] += int(filled[~before].sum())
                seen[7] += int(filled[before].sum())
        rows = [dict(zip(_SUMS.names, (*key, *value))) for key, value in totals.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=_SUMS)

    found = staged(judged.mapInArrow(summed, _SUMS_TEXT))
    order = Window.partitionBy("path").orderBy("bloco").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum(F.col("vira").cast("int")).over(order), F.lit(0)) % 2 == 1
    placed = found.withColumn("dentro", begins)
    bad = F.when(F.col("dentro"), F.col("improprias_dentro")).otherwise(F.col("improprias_fora"))
    # carriage returns: on no line, or on every line but those inside cells, which cannot be told here: all or none
    whole = Window.partitionBy("path")
    proper = (
        (F.sum(bad).over(whole) == 0) & (F.sum(F.col("vira").cast("int")).over(whole) % 2 == 0) & (F.sum("cr_dentro").over(whole) == 0)
        & ((F.sum("com_cr").over(whole) == 0) | (F.sum("com_cr").over(whole) >= F.sum("linhas").over(whole) - 1))
    )
    begun = F.when(F.col("dentro"), F.col("inicios_dentro")).otherwise(F.col("inicios_fora"))
    return placed.select(
        "path", "bloco", "dentro", proper.alias("correto"), (F.sum("com_cr").over(whole) > 0).alias("cr"), begun.alias("inicios")
    )


def _pieces(batches: Iterator[pa.RecordBatch], begins: dict[tuple[str, int], bool]) -> Iterator[pa.RecordBatch]:
    """Records of the splits of a task, and pieces of records that cross the border of a split."""
    here: tuple[str, int] | None = None
    inside, number, held, first = False, 0, [], True

    def close() -> list[tuple]:
        """What is left at the end of a split: lines of a record that goes on behind it."""
        return [(*here, number, _GOES_ON if first else _BEGINS, "\n".join(held))] if held else []

    for batch in batches:
        out: list[tuple] = []
        paths, blocks = batch.column("path"), batch.column("bloco").to_pylist()
        lines = batch.column("linha").to_pylist()
        odd = pc.equal(pc.bit_wise_and(pc.count_substring(batch.column("linha"), '"'), 1), 1).to_pylist()
        names = paths.to_pylist()
        for path, block, line, turns in zip(names, blocks, lines, odd):
            if (path, block) != here:
                if here is not None:
                    out += close()
                here = (path, block)
                if here not in begins:
                    raise RuntimeError(f"split {block} of {path} has not been counted: splits changed while the file was read")
                inside = begins[here]
                # a split that begins outside a cell has no piece of an earlier record
                number, held, first = 0, [], inside
            if not inside and not turns:
                if line and line != "\r":  # empty lines are no records
                    out.append((*here, number, _WHOLE, line))
                    number += 1
                continue
            held.append(line)
            if turns:
                inside = not inside
                if not inside:
                    out.append((*here, number, _GOES_ON if first else _WHOLE, "\n".join(held)))
                    number += not first
                    held, first = [], False
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)
    if here is not None and (out := close()):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)


def count_records(spark: SparkSession, paths: Sequence[str], source_path: Column, encoding: str = C.SOURCE_ENCODING) -> DataFrame:
    """``path, correto, registros`` of files: whether they can be read in splits, and their records, the header included."""
    return split_states(_lines(spark, paths, source_path, encoding)).groupBy("path").agg(
        F.bool_and("correto").alias("correto"), F.sum("inicios").alias("registros")
    )


def records(spark: SparkSession, paths: Sequence[str], source_path: Column, encoding: str = C.SOURCE_ENCODING) -> DataFrame:
    """``path, bloco, id, texto``: the records of properly quoted files, headers left out.

    ``bloco`` is the split in which a record begins and ``id`` its place among those of the split, without
    a gap. The states of the splits (one entry for each split of these files) are broadcast.
    """
    lines = _lines(spark, paths, source_path, encoding)
    rows = split_states(lines).collect()
    lost = sorted({r.path for r in rows if not r.correto})
    if lost:
        raise ValueError(f"not properly quoted: {', '.join(lost)}")
    begins = spark.sparkContext.broadcast({(r.path, r.bloco): r.dentro for r in rows})
    parts = staged(lines.mapInArrow(lambda batches: _pieces(batches, begins.value), _PIECES_TEXT))
    whole = parts.filter(F.col("tipo") == _WHOLE).select("path", "bloco", "id", "texto")
    # a record that crosses splits: its beginning, then pieces without one, up to the piece in which it ends
    cut = parts.filter(F.col("tipo") != _WHOLE)
    so_far = Window.partitionBy("path").orderBy("bloco", "tipo").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.last(F.when(F.col("tipo") == _BEGINS, F.struct("bloco", "id")), ignorenulls=True)
    stitched = cut.withColumn("dono", begun.over(so_far)).groupBy("path", "dono").agg(
        F.array_sort(F.collect_list(F.struct("bloco", "tipo", "texto"))).alias("p")
    )
    texts = F.array_join(F.col("p.texto"), "\n").alias("texto")
    found = whole.unionByName(stitched.select("path", F.col("dono.bloco").alias("bloco"), F.col("dono.id").alias("id"), texts))
    returns = sorted({r.path for r in rows if r.cr})
    if returns:
        # line ends inside cells become line feeds, as the parser has it
        trimmed = F.replace(F.regexp_replace("texto", "\r$", ""), F.lit("\r\n"), F.lit("\n"))
        found = found.withColumn("texto", F.when(F.col("path").isin(returns), trimmed).otherwise(F.col("texto")))
    header = found.groupBy("path").agg(F.min(F.struct("bloco", "id")).alias("cabecalho"))
    return found.join(F.broadcast(header), "path").filter(F.struct("bloco", "id") != F.col("cabecalho")).drop("cabecalho")
