"""Nearest vectors by inner product with multi-index hashing.

Vectors get binary codes: signs of learned rotations. An inner product is an angle once every vector is moved to the mean and
lengthened by one axis to the longest of them, so near vectors have codes of small Hamming distance. Vectors are
written in blocks; a code is split into substrings, and a block holds one table per substring, from values to
vectors. A code within radius ``r`` of a query's code must, by the pigeonhole principle, be near in at least one of ``m`` substrings: within
``r // m`` in one of the first ``r % m + 1``, or within ``r // m - 1`` in another. Probing those
finds every code within the radius; the codes found are compared whole, and the vectors that remain
are scored exactly.

The radius is not fixed. It follows, for each query, from the score of its k-th best vector so far and a table, fitted on a bounded
sample, of the Hamming distances that inner products of that size have. It shrinks as better vectors are found.

Queries come in blocks of bounded size, each broadcast to all tasks; every vector is indexed. Equal
vectors are one entry of the index with their smallest ids, which are all that can be among the nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm.jaccard_join import small_batches
from tenderlake.session import staged

NEAREST = 20
BITS = 128
SUBSTRING = 16
#: Bound of the sample that the rotations and the table of distances are fitted on; everything else reads all rows.
SAMPLE_ROWS = 8192
#: Share of pairs of one inner product whose codes lie within the radius given for it.
KEPT = 0.92
#: Vectors in one block of the index.
BLOCK = 4096
#: Bytes of query vectors broadcast at a time.
QUERY_BYTES = 32 << 20
_ROUNDS = 30
_SEED = 5
_GROUP = 64
_STEPS = 200
_SCORED = 1 << 15
_WORD = 64
_ONES = np.bitwise_count(np.arange(1 << SUBSTRING, dtype=np.uint32))
#: Values in balls of radius 0, 1, ...
_BALLS = np.cumsum(np.bincount(_ONES))


def learned_rotation(x: np.ndarray, seed: int) -> np.ndarray:
    """An orthogonal matrix that brings the rows of ``x`` near to corners of a cube (iterative quantisation)."""
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1], x.shape[1])))
    for _ in range(_ROUNDS):
        left, _, right = np.linalg.svd(x.T @ np.where(x @ rotation >= 0, 1.0, -1.0))
        rotation = left @ right
    return rotation


@dataclass
class Coder:
    """Codes for vectors of one length, and the radius that an inner product calls for."""

    mean: np.ndarray
    longest: float
    turn: np.ndarray
    radii: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, longest_around, bits: int = BITS) -> Coder:
        """``longest_around`` gives the largest distance of any vector from a point."""
        mean = sample.mean(axis=0)
        coder = cls(mean, float(longest_around(mean)), np.empty((0, 0)), np.empty(0))
        rows = coder.lengthened(sample)
        rows = rows / max(coder.longest, 1e-300)
        _, axes = np.linalg.eigh(rows.T @ rows)
        axes = axes[:, ::-1][:, :bits]
        times = -(-bits // axes.shape[1])
        coder.turn = np.hstack([axes @ learned_rotation(rows @ axes, _SEED + k) for k in range(times)])[:, :bits]
        coder.radii = coder._radii(sample[:: max(1, len(sample) // 512)], sample)
        return coder

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        """Around the mean, with an axis that makes all equally long."""
        centred = x - self.mean
        rest = self.longest**2 - np.einsum("ij,ij->i", centred, centred)
        return np.column_stack([centred, np.sqrt(np.maximum(rest, 0.0))])

    def _signs(self, turned: np.ndarray) -> np.ndarray:
        """Rows of 0 and 1, packed to 64-bit words."""
        raw = np.packbits(turned >= 0, axis=1)
        return np.ascontiguousarray(raw).view(np.uint64)

    def codes(self, x: np.ndarray) -> np.ndarray:
        return self._signs(self.lengthened(x) @ self.turn)

    def query_codes(self, x: np.ndarray) -> np.ndarray:
        return self._signs(x @ self.turn[:-1])

    def angles(self, x: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Cosine, to a vector lengthened as above, that a score of a query means."""
        size = np.linalg.norm(x, axis=1) * self.longest
        with np.errstate(invalid="ignore"):
            return np.where(size > 0, (scores - x @ self.mean) / np.where(size > 0, size, 1.0), -np.inf)

    def _radii(self, queries: np.ndarray, sample: np.ndarray) -> np.ndarray:
        """For each step of the cosine, a Hamming radius that few pairs of this cosine or more exceed."""
        bits = self.turn.shape[1]
        step = np.linspace(-1, 1, _STEPS + 1)
        flips = np.arccos(np.clip(step, -1, 1)) / np.pi
        # by the angle alone, for steps that the sample has too few pairs of
        radii = np.ceil(bits * flips + 2.2 * np.sqrt(bits * flips * (1 - flips)) + 0.02 * bits)
        counts = np.zeros((_STEPS + 1, bits + 1), np.int64)
        codes, theirs = self.codes(sample), self.query_codes(queries)
        for query, code in zip(queries, theirs):
            cosine = self.angles(query[None], (sample @ query)[None])[0]
            at = np.clip(np.floor((cosine + 1) * _STEPS / 2), 0, _STEPS)
            at = np.where(np.isfinite(at), at, 0).astype(np.int64)
            np.add.at(counts, (at, distances(codes, code)), 1)
        seen = counts.sum(axis=1)
        within = np.cumsum(counts, axis=1) >= KEPT * seen[:, None]
        radii = np.where(seen >= 200, np.argmax(within, axis=1), radii)
        return np.minimum(np.maximum.accumulate(radii[::-1])[::-1], bits).astype(np.int64)

    def radius(self, cosine: np.ndarray) -> np.ndarray:
        """The whole space where no score is known yet."""
        at = np.clip(np.floor((np.maximum(cosine, -1) + 1) * _STEPS / 2), 0, _STEPS).astype(np.int64)
        return np.where(cosine > -1, self.radii[at], self.turn.shape[1])


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hamming distances of packed codes."""
    return np.bitwise_count(codes ^ code).sum(axis=-1, dtype=np.int64)


def ball(radius: int) -> np.ndarray:
    """All values of a substring with at most ``radius`` ones."""
    return np.flatnonzero(_ONES <= radius).astype(np.uint16)


@dataclass
class Block:
    """Some vectors with their codes, and for each substring a table from its values to the vectors."""

    vectors: np.ndarray
    codes: np.ndarray
    order: np.ndarray

    @cached_property
    def parts(self) -> np.ndarray:
        return self.codes.view(np.uint16)

    @cached_property
    def tables(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per substring: its different values, ascending, where the vectors of each begin in ``order``, and each vector's value."""
        found = []
        for j, order in enumerate(self.order):
            values = self.parts[order, j]
            new = np.append(True, values[1:] != values[:-1])
            first = np.flatnonzero(new)
            place = np.empty(len(order), np.intp)
            place[order] = np.cumsum(new) - 1
            found.append((values[first], np.append(first, len(values)), place))
        return found

    def probe(self, codes: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """For each query code, which vectors are near enough in one substring to lie within the radius."""
        found = np.zeros((len(codes), len(self.codes)), bool)
        parts = np.ascontiguousarray(codes).view(np.uint16)
        m = parts.shape[1]
        for j, (values, first, place) in enumerate(self.tables):
            reach = np.minimum(radii // m - (j > radii % m), SUBSTRING)
            # a ball of fewer values than the table has is listed and looked up; otherwise all values are compared
            listed = (reach >= 0) & (_BALLS[np.maximum(reach, 0)] < len(values))
            compared = np.flatnonzero((reach >= 0) & ~listed)
            if len(compared):
                apart = np.bitwise_count(parts[compared, j][:, None] ^ values)
                found[compared] |= (apart <= reach[compared][:, None]).take(place, axis=1)
            for r in np.unique(reach[listed]).tolist():
                rows = np.flatnonzero(listed & (reach == r))
                near = parts[rows, j][:, None] ^ ball(r)
                at = np.minimum(np.searchsorted(values, near), len(values) - 1)
                who, which = np.nonzero(values[at] == near)
                bucket = at[who, which]
                sizes = first[bucket + 1] - first[bucket]
                inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                found[np.repeat(rows[who], sizes), self.order[j][np.repeat(first[bucket], sizes) + inside]] = True
        return found

    def within(self, codes: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a query code and a vector whose codes differ in at most the radius."""
        probed = self.probe(codes, radii)
        if np.count_nonzero(probed) * 8 > probed.size:  # comparing all is cheaper than picking that many
            apart = np.zeros(probed.shape, np.uint16)
            for word in range(codes.shape[1]):
                apart += np.bitwise_count(codes[:, word][:, None] ^ self.codes[:, word])
            return np.nonzero(probed & (apart <= radii[:, None]))
        who, row = np.nonzero(probed)
        close = distances(self.codes[row], codes[who]) <= radii[who]
        return who[close], row[close]


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products row by row, in double precision, each summed in the same order."""
    out = np.empty(len(queries))
    for at in range(0, len(queries), _SCORED):
        out[at : at + _SCORED] = (queries[at : at + _SCORED].astype(np.float64) * vectors[at : at + _SCORED].astype(np.float64)).sum(axis=1)
    return out


class Best:
    """The ``k`` best vectors of each query so far: by score, then by smallest id."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.rows: np.ndarray = np.full((queries, k), -1)

    def add(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Offer vectors to queries; ``who`` ascends."""
        better = (scores > self.scores[who, -1]) | ((scores == self.scores[who, -1]) & (ids < self.ids[who, -1]))
        who, scores, ids, rows = who[better], scores[better], ids[better], rows[better]
        if not len(who):
            return
        mine = np.unique(who)
        all_who = np.concatenate([np.repeat(mine, self.k), who])
        all_scores, all_ids, all_rows = (
            np.concatenate([held[mine].ravel(), new]) for held, new in ((self.scores, scores), (self.ids, ids), (self.rows, rows))
        )
        order = np.lexsort((all_ids, -all_scores, all_who))
        first = np.searchsorted(all_who[order], mine)
        pick = order[first[:, None] + np.arange(self.k)]
        self.scores[mine], self.ids[mine], self.rows[mine] = all_scores[pick], all_ids[pick], all_rows[pick]


def _vector(column: pd.Series, dtype: type) -> np.ndarray:
    return np.array(column.tolist(), dtype=dtype)


def _search(frames: Iterator[pd.DataFrame], coder: Coder, queries: np.ndarray, reps: np.ndarray, k: int, dtype: type) -> Iterator[pd.DataFrame]:
    """The best vectors of one task for every query, with their ids."""
    codes = coder.query_codes(queries)
    best, held, base = Best(len(queries), k), {}, 0
    for pdf in frames:
        for row in pdf.itertuples(index=False):
            vectors = np.frombuffer(row.vectors, dtype).reshape(-1, queries.shape[1])
            n = len(vectors)
            block = Block(vectors, np.frombuffer(row.codes, np.uint64).reshape(n, -1), np.frombuffer(row.tables, np.uint16).reshape(-1, n))
            firsts = np.array([i[0] for i in row.ids], np.int64)
            for at in range(0, len(queries), _GROUP):
                mine = slice(at, at + _GROUP)
                x, own = queries[mine], codes[mine]
                empty = np.flatnonzero(~np.isfinite(best.scores[mine, -1]))
                if len(empty):  # nothing to go by yet: the nearest codes of this block give a first score
                    apart = np.bitwise_count(own[empty][:, None] ^ block.codes).sum(axis=2, dtype=np.int64)
                    near = np.sort(np.argpartition(apart, min(4 * k, n) - 1, axis=1)[:, : min(4 * k, n)], axis=1)
                    who, rows = np.repeat(empty, near.shape[1]), near.ravel()
                    first = exact_scores(x[who], vectors[rows]).reshape(len(empty), -1)
                    floor = np.full(len(x), -np.inf)
                    if n >= k:
                        floor[empty] = np.sort(first, axis=1)[:, -min(k, first.shape[1])]
                    floor = np.maximum(floor, best.scores[mine, -1])
                else:
                    floor = best.scores[mine, -1]
                who, rows = block.within(own, coder.radius(coder.angles(x, floor)))
                scores = exact_scores(x[who], vectors[rows])
                best.add(who + at, scores, firsts[rows], rows + base)
            # only the ids of vectors that are among the best are kept
            for r in np.unique(best.rows[best.rows >= base]).tolist():
                held[r] = np.asarray(row.ids[r - base], np.int64)
            base += n
            if len(held) > 4 * best.rows.size:
                held = {r: held[r] for r in np.unique(best.rows[best.rows >= 0]).tolist()}
    for at in range(0, len(queries), _GROUP):
        out = []
        for q in range(at, min(at + _GROUP, len(queries))):
            rows = [(reps[q], -s, i) for s, r in zip(best.scores[q], best.rows[q]) if r >= 0 for i in held[r].tolist()]
            out += sorted(rows)[:k]
        if out:
            yield pd.DataFrame(out, columns=["rep", "less", "id"])


def _fingerprint() -> list[Column]:
    """128 bits that stand for a vector."""
    return [F.xxhash64(F.lit(seed), "embedding").alias(f"h{seed}") for seed in (1, 2)]


def _index(points: DataFrame, coder: Coder, dtype: type) -> DataFrame:
    """Blocks of the index: ids, vectors, codes, and the tables of all substrings as orders of the vectors."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def block(part: pd.DataFrame) -> pd.DataFrame:
            x = _vector(part["embedding"], dtype)
            codes = coder.codes(x.astype(np.float64))
            order = np.argsort(codes.view(np.uint16), axis=0, kind="stable").T.astype(np.uint16)
            return pd.DataFrame({"ids": [part["ids"].tolist()], "vectors": [x.tobytes()], "codes": [codes.tobytes()],
                                 "tables": [np.ascontiguousarray(order).tobytes()]})

        held: list[pd.DataFrame] = []
        for pdf in frames:
            held.append(pdf)
            while sum(map(len, held)) >= BLOCK:
                rows = pd.concat(held, ignore_index=True)
                held = [rows.iloc[BLOCK:]]
                yield block(rows.iloc[:BLOCK])
        rows = pd.concat(held, ignore_index=True) if held else pd.DataFrame()
        if len(rows):
            yield block(rows)

    return staged(points.select("ids", "embedding").mapInPandas(build, "ids array<array<long>>, vectors binary, codes binary, tables binary"))


def _fit(points: DataFrame, count: int, sample_rows: int) -> Coder:
    """Rotations and radii from the vectors with the smallest fingerprints."""
    share = F.pmod("h1", F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = points.where(share * count <= 2 * sample_rows).orderBy("h1", "h2").limit(sample_rows).select("embedding").toPandas()
    sample = _vector(some["embedding"], np.float64)

    def longest_around(mean: np.ndarray) -> float:
        def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            longest = 0.0
            for pdf in frames:
                if len(pdf):
                    longest = max(longest, float(np.linalg.norm(_vector(pdf["embedding"], np.float64) - mean, axis=1).max()))
            yield pd.DataFrame({"longest": [longest]})

        return points.select("embedding").mapInPandas(task, "longest double").agg(F.max("longest")).first()[0]

    return Coder.fit(sample, longest_around)


def nearest_vectors(vectors: DataFrame, queries: str, vec_id: str = "vec_id", embedding: str = "embedding", k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``queries`` (SQL on ``vec_id``) selects, its ``k`` nearest.

    Nearness is the inner product in double precision; ties go to the smaller id. A row is not its own
    neighbour. Fewer than ``k`` other rows are all listed. Rows with a null id, and vectors that are null, empty, zero or hold null or non-finite
    components take no part, neither as queries nor as candidates. Vectors meet those of
    their own length only. Repeated rows are one row; rows of one id with different vectors are candidates each, and queries
    each, with a list of their own. An empty table gives an empty result. Further columns are not read.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    dtype = np.float32 if kind == "float" else np.float64
    values = F.col(embedding) if kind == "float" else F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda v: v != 0))
    good = staged(rows.select("vec_id", *_fingerprint(), F.size("embedding").alias("dims"), "embedding"))
    same = ["dims", "h1", "h2"]
    # the smallest ids of equal vectors, one more than are asked for; each task cuts its own before they meet
    listed = good.select("vec_id", *same).distinct()
    first = listed.withColumn("place", F.row_number().over(Window.partitionBy(*same).orderBy("vec_id"))).where(F.col("place") <= k + 1)
    ids = first.groupBy(*same).agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    one = good.groupBy(*same).agg(F.any_value("embedding").alias("embedding"))
    points = staged(one.join(ids, same))
    asked = good.where(queries)
    found = None
    for dims, count in sorted(tuple(r) for r in points.groupBy("dims").count().collect()):
        own = points.where(F.col("dims") == dims)
        coder = _fit(own, count, SAMPLE_ROWS)
        with small_batches(spark, BLOCK):
            blocks = _index(own, coder, dtype)
        part = _answers(own, asked.where(F.col("dims") == dims), blocks, coder, dims, k, dtype)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found


def _answers(points: DataFrame, asked: DataFrame, blocks: DataFrame, coder: Coder, dims: int, k: int, dtype: type) -> DataFrame:
    """All answers over one index, a bounded number of different query vectors at a time."""
    spark = points.sparkSession
    members = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    # equal query vectors are one query; the smallest id of all equal vectors stands for it
    reps = staged(points.join(members.select("h1", "h2").distinct(), ["h1", "h2"]).select("h1", "h2", F.col("ids")[0].alias("rep"), "embedding"))
    members = members.join(reps.select("h1", "h2", "rep"), ["h1", "h2"]).select("query_id", "rep")
    turns = max(1, -(-reps.count() * dims * 8 // QUERY_BYTES))
    lists = None
    for turn in range(turns):
        some = reps.where(F.pmod(F.col("h2"), F.lit(turns)) == turn).select("rep", "embedding").toPandas()
        if not len(some):
            continue
        held = spark.sparkContext.broadcast((coder, _vector(some["embedding"], np.float64), some["rep"].to_numpy(np.int64)))
        with small_batches(spark, 1):
            near = blocks.mapInPandas(lambda f, held=held: _search(f, *held.value, k + 1, dtype), "rep long, less double, id long")
            part = staged(near.groupBy("rep").agg(F.slice(F.array_sort(F.collect_list(F.struct("less", "id"))), 1, k + 1).alias("near")))
        held.destroy()
        lists = part if lists is None else lists.unionByName(part)
    if lists is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    ranked = members.join(lists, "rep").select("query_id", F.posexplode(others).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.less")).alias("score"))
