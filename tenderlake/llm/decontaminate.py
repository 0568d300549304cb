"""Benchmark decontamination: find windows of benchmark words in documents.

The hashed windows of the benchmark are broadcast in blocks of bounded size; every block is
looked up in one scan of the documents, hits are verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.llm.arrays import ALPHANUMERIC, chunks, split_words, window_hashes
from tenderlake.llm.graph import whole_row
from tenderlake.session import staged

WINDOW = 10
BLOCK_WINDOWS = 250_000
_FILTER_BITS = 22

_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("stop", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """Every window of every item: ``item, n (its words), words (joined by a space), hash``."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at, part in chunks(pdf["text"]):
                words = split_words(part, ALPHANUMERIC)
                for i in range(len(part)):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    n = min(width, b - a)
                    if not n:
                        continue
                    hashes = window_hashes(words.hashes[a:b], n)
                    yield pd.DataFrame({
                        "item": pdf["item"].iloc[at + i],
                        "n": n,
                        "words": [words.text(p, p + n) for p in range(a, b - n + 1)],
                        "hash": hashes.view(np.int64),
                    })

    source = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return source.mapInPandas(cut, "item string, n int, words binary, hash long").distinct()


class _Block:
    """One bounded block of windows, prepared for lookups."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.items: dict[bytes, list] = {}
        for words, item in zip(rows["words"], rows["item"]):
            self.items.setdefault(bytes(words), []).append(item)
        self.lookups = []
        for n, part in rows.groupby("n"):
            hashes = np.unique(part["hash"].to_numpy(np.int64).view(np.uint64))
            quick = np.zeros(1 << _FILTER_BITS, bool)
            quick[hashes & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.lookups.append((int(n), hashes, quick))

    def find(self, texts: pd.Series) -> Iterator[tuple[int, list, set]]:
        """Per text: number of words, hit spans (in words), items."""
        for _, part in chunks(texts):
            words = split_words(part, ALPHANUMERIC)
            found: dict[int, tuple[list, set]] = {}
            for n, hashes, quick in self.lookups:
                own = window_hashes(words.hashes, n)
                at = np.flatnonzero(quick[own & np.uint64((1 << _FILTER_BITS) - 1)])
                at = at[hashes[np.minimum(np.searchsorted(hashes, own[at]), len(hashes) - 1)] == own[at]]
                owner = np.searchsorted(words.first, at, side="right") - 1
                for p, i in zip(at.tolist(), owner.tolist()):
                    if p + n > words.first[i + 1]:
                        continue
                    items = self.items.get(words.text(p, p + n))
                    if items is None:
                        continue
                    spans, names = found.setdefault(i, ([], set()))
                    begin = p - int(words.first[i])
                    if spans and spans[-1][1] >= begin >= spans[-1][0]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], begin + n))
                    else:
                        spans.append((begin, begin + n))
                    names.update(items)
            for i in range(len(part)):
                yield int(words.first[i + 1] - words.first[i]), *found.get(i, ([], set()))


def _finder(spark, rows: pd.DataFrame):
    block = spark.sparkContext.broadcast(rows)
    prepared: list[_Block] = []

    @F.pandas_udf(_FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        if not prepared:
            prepared.append(_Block(block.value))
        found = list(prepared[0].find(texts))
        return pd.DataFrame({
            "n_words": [n for n, _, _ in found],
            "spans": [[{"begin": a, "stop": b} for a, b in spans] for _, spans, _ in found],
            "items": [list(items) for _, _, items in found],
        })

    return find


def _union_of_spans(spans: Column) -> Column:
    """Overlapping or touching spans become one."""
    last = lambda done: F.element_at(done, -1)
    none = F.array().cast("array<struct<begin:long,stop:long>>")

    def add(done: Column, span: Column) -> Column:
        joined = F.struct(last(done).begin.alias("begin"), F.greatest(last(done).stop, span.stop).alias("stop"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)).stop >= span.begin)
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.when(F.size(spans) < 2, spans).otherwise(F.aggregate(F.array_sort(spans), none, add))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                       benchmark_text: str = "text", width: int = WINDOW,
                       block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Add ``contamination``: struct of ``n_words``, merged ``spans`` and ``items`` of each document.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters. A window is
    ``width`` consecutive words of an item; a shorter item is one window. Spans count words from
    0, their ends are excluded. Items are the names (as text) of the items with a window in the
    document, without repeats.

    Up to ``block_windows`` windows with their items are broadcast at once. Beyond that distinct windows are dealt to blocks
    by hash, however many items share them; the documents, written once with a number, are scanned once
    per block, and a scan returns hits only. Windows with the same items carry one number for them, which is joined to the items in the end.

    Null and empty texts have no words and no hits. An item without a name hits but is not named.
    Repeated documents and items are judged alike; empty tables give empty or clean results;
    further columns, whatever their names, pass through, except that ``contamination`` is replaced.
    """
    windows = staged(benchmark_windows(benchmark, item, benchmark_text, width))
    rows = docs.select(whole_row(docs.drop("contamination")))
    source = F.col("row").getField(text)
    if windows.count() <= block_windows:
        found = _finder(docs.sparkSession, windows.toPandas())(source)
        judged = rows.select("row", found.alias("found"))
        spans, items = F.col("found.spans"), F.array_distinct("found.items")
    else:
        judged = _found_in_blocks(staged(rows.withColumn("number", F.monotonically_increasing_id())), source, windows, block_windows)
        spans, items = F.col("found.spans"), F.coalesce("items", F.array().cast("array<string>"))
    contamination = F.struct(F.col("found.n_words").alias("n_words"), _union_of_spans(spans).alias("spans"), items.alias("items"))
    return judged.select("row.*", contamination.alias("contamination"))


def _found_in_blocks(rows: DataFrame, text: Column, windows: DataFrame, block_windows: int) -> DataFrame:
    """``row, found, items`` of numbered rows, with bounded broadcasts of distinct windows."""
    spark = rows.sparkSession
    name = F.xxhash64(F.lit("name"), "item")
    alike = F.xxhash64(F.count("*"), F.bit_xor(F.xxhash64("item")), F.bit_xor(name), F.sum(F.xxhash64("item").cast("decimal(38,0)")))
    kinds = staged(windows.groupBy("hash", "n", "words").agg(alike.cast("string").alias("item")))
    blocks = -(-kinds.count() // block_windows)
    hits = []
    for b in range(blocks):
        block = kinds.where(F.pmod("hash", F.lit(blocks)) == b).toPandas()
        scan = rows.select("number", _finder(spark, block)(text).alias("found")).select("number", "found.*")
        hits.append(staged(scan if b == 0 else scan.where(F.size("spans") > 0)))
    hits = reduce(DataFrame.unionByName, hits)
    together = hits.groupBy("number").agg(
        F.struct(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans")).alias("found")
    )
    one = F.min(F.struct("hash", "n", "words"))
    example = kinds.groupBy("item").agg(one.alias("w")).select(F.col("item").alias("kind"), "w.*")
    items_of = windows.where("item is not null").join(example, ["hash", "n", "words"]).select("kind", "item")
    met = hits.select("number", F.explode("items").alias("kind")).distinct().join(items_of, "kind")
    named_items = met.groupBy("number").agg(F.collect_set("item").alias("items"))
    return rows.join(together, "number").join(named_items, "number", "left").select("row", "found", "items")


def hit_words(found: Column) -> Column:
    """Number of words inside spans."""
    return F.aggregate(found.spans, F.lit(0).cast("long"), lambda n, s: n + s.stop - s.begin)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """The documents without any benchmark window, unchanged."""
    found = find_contamination(docs, benchmark, **names)
    return found.where(F.size("contamination.spans") == 0).drop("contamination")


def cut_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """All documents; hit words and what separates them from the next word are cut out of the texts."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for value, hits in zip(texts, spans):
            if value is None or hits is None or not len(hits):
                out.append(value)
                continue
            raw = value.encode("utf-8", "replace")
            words = split_words([raw], ALPHANUMERIC)
            kept, at = [], 0
            for hit in hits:
                begin, stop = int(hit["begin"]), int(hit["stop"])
                kept.append(raw[at : words.start[begin]])
                at = int(words.start[stop]) if stop < len(words.start) else len(raw)
            out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "replace"))
        return pd.Series(out, dtype=object)

    found = find_contamination(docs, benchmark, text=text, **names)
    return found.withColumn(text, cut(F.col(text), F.col("contamination.spans"))).drop("contamination")
