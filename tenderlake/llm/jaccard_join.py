"""Exact Jaccard self-join of documents on word n-grams, by prefix index and set relations.

A set's n-grams are put in one global order: those of few documents first. Two sets that reach
the threshold share an n-gram in the prefixes of both (prefix filter), so an index over the
prefixes holds all candidates, with the size of a set and the position of the n-gram in its order. Two relations then skip work:

* between lists: a list is ordered by set size and cut into blocks of sizes that may link. If an n-gram is the
  first one that two sets share, all n-grams before it are in one of them only, which bounds what they have in common by
  size and position. Members that reach this bound with no size in their block are skipped, and so are pairs
  that do not reach it. Equal member lists, which near copies produce by the hundred, count once;
* between answers: a block's members are first compared with one member only, the one in whose
  order the n-gram stands first, as it has the fewest n-grams of its own and is most like the others. Members that
  link with it are one class and need no comparison among each other; only pairs
  from different classes are compared afterwards. So n near copies that link with one of them cost about n
  comparisons, not n * n; a group that one member does not hold together costs more. No link between classes is lost.

N-grams are compared by the upper 48 bits of their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.arrays import (
    BLANK_SEPARATED, chunks, pack, pack_sorted, split_words, unpack, unpack_sorted, window_hashes,
)
from tenderlake.llm.graph import bloom_of, components, whole_row
from tenderlake.session import staged

WIDTH = 5
PERCENT = 75
#: Bound of the broadcast list of n-grams that stand last in the order.
MOST_FREQUENT = 1 << 22
#: An n-gram of more documents than this may stand last.
FREQUENT = 32
_FLUSH = 1 << 19
_UNPACKED = 4
#: Texts that a Python worker holds at a time.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Send at most ``rows`` rows at a time to Python in the jobs run inside; the setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Shared:
    """Broadcasts of one join, which are taken from the executors when it is done."""

    def __init__(self, spark: SparkSession) -> None:
        self.context, self.held = spark.sparkContext, []

    def __call__(self, value):
        self.held.append(self.context.broadcast(value))
        return self.held[-1]

    def __enter__(self) -> Shared:
        return self

    def __exit__(self, *_) -> None:
        for held in self.held:
            held.destroy()


def ngram_sets(texts: pd.Series, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Per text: ascending distinct 64-bit hashes of its word n-grams; fewer words make one n-gram."""
    for _, part in chunks(texts):
        words = split_words(part, BLANK_SEPARATED)
        grams = window_hashes(words.hashes, width)
        for i in range(len(part)):
            a, b = int(words.first[i]), int(words.first[i + 1])
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                yield window_hashes(words.hashes[a:b], b - a)
            else:
                yield np.empty(0, np.uint64)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _edges_of(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.flatnonzero(np.diff(sorted_buckets, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(sorted_buckets)]):
        yield int(sorted_buckets[a]), a, b


def frequent_ngrams(docs: DataFrame, width: int, buckets: int, first, share: Shared, most: int = MOST_FREQUENT) -> np.ndarray:
    """High halves of the hashes of n-grams in many texts, ascending; at most ``most``.

    Counts cover all different texts. The limit rises with the occurrences so that the result stays
    bounded; it only decides the order, never the result of the join.
    """
    chosen = share(first)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush() -> pd.DataFrame:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = [
                (k, pack_sorted(values[a:b]), pack(counts[a:b].astype(np.uint32)))
                for k, a, b in _edges_of(_bucket(values << np.uint64(32), buckets).astype(np.int64))
            ]
            return pd.DataFrame(rows, columns=["bucket", "hashes", "counts"])

        for pdf in frames:
            pdf = pdf[chosen.value.holds(pdf["id"].to_numpy(np.int64))]
            for grams in ngram_sets(pdf["text"], width):
                held.append(grams >> np.uint64(32))
                size += len(grams)
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.concatenate([unpack_sorted(b) for b in pdf["hashes"]])
        counts = np.concatenate([unpack(b, np.uint32) for b in pdf["counts"]])
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order].astype(np.int64)
        cuts = np.flatnonzero(np.diff(values, prepend=values[0] + np.uint64(1)))
        counts, values = np.add.reduceat(counts, cuts), values[cuts]
        keep = counts > FREQUENT
        return pd.DataFrame({"hash": values[keep].astype(np.int64), "n": counts[keep]})

    counted = docs.select("id", "text").mapInPandas(count, "bucket long, hashes binary, counts binary")
    found = staged(counted.groupBy("bucket").applyInPandas(merge, "hash long, n long"))
    limit = (found.agg(F.sum("n")).first()[0] or 0) // most
    rows = found.where(F.col("n") > limit).select("hash").toPandas()
    return np.sort(rows["hash"].to_numpy(np.int64).astype(np.uint64))


def _prefix(grams: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The part of a set that must meet the part of any set it links with."""
    n = len(grams)
    length = n - -(-percent * n // 100) + 1
    if len(frequent):
        high = grams >> np.uint64(32)
        common = frequent[np.minimum(np.searchsorted(frequent, high), len(frequent) - 1)] == high
        grams = np.concatenate([grams[~common], grams[common]])
    return grams[:length]


def candidate_lists(docs: DataFrame, frequent: np.ndarray, width: int, percent: int, buckets: int, first, share: Shared) -> DataFrame:
    """``members, sizes, positions``: documents of one index block, ascending by size, each list once."""
    common, chosen = share(frequent), share(first)

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush() -> pd.DataFrame:
            hashes = np.concatenate([h for h, _, _ in held])
            lengths = [len(h) for h, _, _ in held]
            ids = np.repeat(np.array([i for _, i, _ in held], np.int64), lengths)
            sizes = np.repeat(np.array([s for _, _, s in held], np.uint32), lengths)
            positions = np.concatenate([np.arange(n, dtype=np.uint32) for n in lengths])
            order = np.argsort(hashes, kind="stable")
            hashes, ids, sizes, positions = hashes[order], ids[order], sizes[order], positions[order]
            rows = [
                (k, pack_sorted(hashes[a:b] >> np.uint64(16)), pack(ids[a:b]), pack(sizes[a:b]), pack(positions[a:b]))
                for k, a, b in _edges_of(_bucket(hashes, buckets).astype(np.int64))
            ]
            return pd.DataFrame(rows, columns=["bucket", "hashes", "ids", "sizes", "positions"])

        for pdf in frames:
            pdf = pdf[chosen.value.holds(pdf["id"].to_numpy(np.int64))]
            for doc, grams in zip(pdf["id"].tolist(), ngram_sets(pdf["text"], width)):
                if len(grams):
                    held.append((_prefix(grams, common.value, percent), doc, len(grams)))
                    size += len(held[-1][0])
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def blocks(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = np.concatenate([unpack_sorted(b) for b in pdf["hashes"]])
        ids = np.concatenate([unpack(b, np.int64) for b in pdf["ids"]])
        sizes, positions = (np.concatenate([unpack(b, np.uint32) for b in pdf[c]]).astype(np.int64) for c in ("sizes", "positions"))
        order = np.lexsort((ids, sizes, hashes))
        hashes, ids, sizes, positions = hashes[order], ids[order], sizes[order], positions[order]
        # a block: sizes that chain without a gap too wide for any link
        new = np.append(True, (np.diff(hashes) != 0) | (sizes[:-1] * 100 < percent * sizes[1:]))
        cuts = np.flatnonzero(new)
        ends = np.append(cuts[1:], len(hashes))
        # the smallest size of a block, and the members that may reach the bound with a set of that size
        least = np.repeat(sizes[cuts], ends - cuts)
        kept = _largest_partner(sizes, positions, percent) >= np.maximum(least, -(-percent * sizes // 100))
        counts = np.add.reduceat(kept, cuts) if len(cuts) else kept
        found: dict[bytes, list[np.ndarray]] = {}
        for a, b in zip(cuts[counts > 1].tolist(), ends[counts > 1].tolist()):
            use = kept[a:b]
            members = ids[a:b][use]
            held = found.setdefault(members.tobytes(), [sizes[a:b][use], positions[a:b][use]])
            # lists of equal members are one; of its positions the smallest excludes least
            held[1] = np.minimum(held[1], positions[a:b][use])
        return pd.DataFrame({
            "members": pd.Series([np.frombuffer(k, np.int64) for k in found], dtype=object),
            "sizes": pd.Series([v[0] for v in found.values()], dtype=object),
            "positions": pd.Series([v[1] for v in found.values()], dtype=object),
        })

    schema = "bucket long, hashes binary, ids binary, sizes binary, positions binary"
    lists = docs.select("id", "text").mapInPandas(index, schema).groupBy("bucket").applyInPandas(
        blocks, "members array<long>, sizes array<long>, positions array<long>"
    )
    smallest = F.aggregate(
        F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), F.element_at("p", 1), lambda x, y: F.zip_with(x, y, lambda a, b: F.least(a, b))
    )
    return lists.groupBy("members", "sizes").agg(F.collect_set("positions").alias("p")).select("members", "sizes", smallest.alias("positions"))


def _largest_partner(sizes: np.ndarray, positions: np.ndarray, percent: int) -> np.ndarray:
    """The largest size of a set that a member may link with if its n-gram is the first they share.

    What two sets have in common is at most what a member has from the position on, and must be ``percent`` of
    what both hold together.
    """
    return (100 + percent) * (sizes - positions) // percent - sizes


def _pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pd.DataFrame:
    """Different ids as pairs ``a < b``, each once."""
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})[a != b].drop_duplicates()


def _star_pairs(frames: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """In each run of sizes that may link, every member with the one whose position is the smallest."""
    for pdf in frames:
        left, right = [], []
        for members, sizes, positions in zip(pdf["members"], pdf["sizes"], pdf["positions"]):
            reach, at = _largest_partner(sizes, positions, percent), 0
            while at < len(members):
                stop = int(np.searchsorted(sizes, sizes[at] * 100 // percent, side="right"))
                pivot = at + int(np.lexsort((members[at:stop], positions[at:stop]))[0])
                near = np.flatnonzero((sizes[at:stop] <= reach[pivot]) & (reach[at:stop] >= sizes[pivot])) + at
                left.append(np.repeat(members[pivot], len(near)))
                right.append(members[near])
                at = stop
        yield _pairs(left, right)


def _open_pairs(frames: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Pairs of members of different classes whose sizes and positions let them link.

    The members of a list's largest class are not taken one by one: the others look for them.
    """
    for pdf in frames:
        for members, sizes, positions, classes in zip(pdf["members"], pdf["sizes"], pdf["positions"], pdf["classes"]):
            left, right, held = [], [], 0
            reach = _largest_partner(sizes, positions, percent)
            names, which, counts = np.unique(classes, return_inverse=True, return_counts=True)
            largest = which == counts.argmax()
            for i in np.flatnonzero(~largest).tolist():
                low = np.searchsorted(sizes, -(-percent * sizes[i] // 100))
                high = np.searchsorted(sizes, min(sizes[i] * 100 // percent, reach[i]), side="right")
                some = slice(low, max(low, high))
                other = (which[some] != which[i]) & (reach[some] >= sizes[i]) & (largest[some] | (np.arange(some.start, some.stop) > i))
                found = np.flatnonzero(other) + low
                left.append(np.repeat(members[i], len(found)))
                right.append(members[found])
                held += len(found)
                if held >= _FLUSH:
                    yield _pairs(left, right)
                    left, right, held = [], [], 0
            yield _pairs(left, right)


def _links(pairs: DataFrame, docs: DataFrame, width: int, percent: int, share: Shared) -> DataFrame:
    """The pairs that reach the threshold, by their whole sets."""
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    chosen = share(bloom_of(needed, "id"))

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf = pdf[chosen.value.holds(pdf["id"].to_numpy(np.int64))]
            packed = [pack_sorted(g >> np.uint64(16)) for g in ngram_sets(pdf["text"], width)]
            yield pd.DataFrame({"id": pdf["id"], "grams": packed})

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        unpacked = lru_cache(_UNPACKED)(unpack_sorted)  # one side of consecutive pairs is often the same
        for x, y in zip(left, right):
            x, y = unpacked(x), unpacked(y)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    found = docs.select("id", "text").mapInPandas(sets, "id long, grams binary")
    left = found.select(F.col("id").alias("a"), F.col("grams").alias("left"))
    right = found.select(F.col("id").alias("b"), F.col("grams").alias("right"))
    return pairs.join(left, "a").join(right, "b").where(linked("left", "right")).select("a", "b")


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                    percent: int = PERCENT) -> DataFrame:
    """``id, component``: classes of documents that are linked, directly or over others.

    The set of a document: distinct n-grams of ``width`` blank-separated words, A-Z lower-cased;
    a shorter text is one n-gram. Documents link when ``100 * both >= percent * either``.
    Documents without a link are not in the result. Null and empty texts have no set and no link.
    Equal texts are one class from the start; rows with one id are one document, whose texts are
    all linked; rows without id are left out. Empty tables give an empty result. Columns other
    than the two named are not read.
    """
    with small_batches(docs.sparkSession), Shared(docs.sparkSession) as share:
        return _classes(docs, doc_id, text, width, percent, share)


def _classes(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, share: Shared) -> DataFrame:
    """The classes, as a written table."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.where(F.col("id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    texts = staged(rows.select("id", F.unhex(F.md5("text")).alias("digest")))
    of_text = texts.groupBy("digest").agg(F.min("id").alias("first"))
    copies = texts.join(of_text, "digest").where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    first = bloom_of(of_text.select("first"), "first")
    buckets = 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    frequent = frequent_ngrams(rows, width, buckets, first, share)
    lists = staged(candidate_lists(rows, frequent, width, percent, buckets, first, share))
    stars = staged(
        lists.mapInPandas(lambda f: _star_pairs(f, percent), "a long, b long").distinct().join(copies, ["a", "b"], "left_anti")
    )
    links = staged(_links(stars, rows, width, percent, share))
    classes = components(links.unionByName(copies), "a", "b")
    numbered = lists.withColumn("list", F.monotonically_increasing_id())  # before the lists are taken apart
    member = numbered.select("list", F.posexplode(F.arrays_zip("members", "sizes", "positions")).alias("at", "m"))
    member = member.select("list", "at", F.col("m.members").alias("id"), F.col("m.sizes").alias("size"), F.col("m.positions").alias("position"))
    member = member.join(classes, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = member.groupBy("list").agg(
        F.array_sort(F.collect_list(F.struct("at", "id", "size", "position", "component"))).alias("m"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).where("low <> high")
    open_lists = split.select(
        F.col("m.id").alias("members"), F.col("m.size").alias("sizes"), F.col("m.position").alias("positions"), F.col("m.component").alias("classes")
    )
    pairs = staged(
        open_lists.mapInPandas(lambda f: _open_pairs(f, percent), "a long, b long").distinct().join(stars, ["a", "b"], "left_anti")
    )
    if pairs.isEmpty():
        return classes
    more = _links(pairs, rows, width, percent, share)
    return components(classes.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(more), "a", "b")


def count_ngrams(text: str = "text", width: int = WIDTH) -> Column:
    """Size of the set of a text; 0 for null."""
    @F.pandas_udf("long")
    def size(texts: pd.Series) -> pd.Series:
        return pd.Series([len(g) for g in ngram_sets(texts, width)], dtype="int64")

    return size(F.col(text))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, the one with the smallest id; documents without a link stay.

    Of several rows with the id of a kept document the smallest (by all columns) stays. Rows without id stay.
    Columns pass whatever their names.
    """
    classes = jaccard_classes(docs, doc_id, text)
    rows = docs.select(F.col(doc_id).alias("id"), whole_row(docs))
    lost = classes.where("id <> component").select("id")
    twice = staged(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 and id is not null").select("id"))
    once = rows.join(lost.unionByName(twice).distinct(), "id", "left_anti").select("row.*")
    if twice.isEmpty():
        return once
    first = rows.join(twice.join(lost, "id", "left_anti"), "id", "left_semi").groupBy("id").agg(F.min("row").alias("row"))
    return once.unionByName(first.select("row.*"))
