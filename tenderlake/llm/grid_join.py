"""Near-duplicate vectors by epsilon grid order join.

Unit vectors are turned to principal axes, which keeps distances, and sorted by the cells of a grid of
width epsilon on the leading axes. Consecutive vectors form blocks. Two blocks whose boxes are
farther apart than epsilon hold no link and are never brought together; inside a pair of blocks
the sequences are halved recursively and halves that are too far apart are skipped too. Equal vectors
are one point with a count, and a pair of blocks reports counts and a spanning forest of its links,
so a group of n near copies makes about n rows, not n * n.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.graph import components
from tenderlake.session import staged

COSINE = 0.98
AXES = 6
BLOCK = 1024
_LEAF = 128


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def principal_axes(points: DataFrame, dims: int, axes: int) -> np.ndarray:
    """The leading eigenvectors of the covariance of all unit vectors, as columns."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims + 1, dims + 1))
        for pdf in frames:
            if len(pdf):
                x = _matrix(pdf["embedding"])
                x = np.column_stack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones(len(x))])
                total += x.T @ x
        yield pd.DataFrame({"place": np.arange(total.size), "value": total.ravel()})

    found = points.select("embedding").mapInPandas(sums, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros((dims + 1) * (dims + 1))
    for r in found.collect():
        total[r.place] = r.value
    total = total.reshape(dims + 1, dims + 1)
    n = max(total[dims, dims], 1.0)
    mean = total[dims, :dims] / n
    _, vectors = np.linalg.eigh(total[:dims, :dims] / n - np.outer(mean, mean))
    return np.ascontiguousarray(vectors[:, ::-1][:, :axes])


def _blocks(points: DataFrame, axes: np.ndarray, width: float) -> DataFrame:
    """Sorted points cut into blocks with their boxes."""
    lead = axes.shape[1]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                x = _matrix(pdf["embedding"])
                turned = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes
                yield pdf.assign(turned=list(turned), cells=list(np.floor(turned / width).astype(np.int32)))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def block(part: pd.DataFrame) -> dict:
            turned = _matrix(part["turned"])
            return {
                "label": part["label"].iloc[0], "ids": part["first"].to_numpy(np.int64), "counts": part["copies"].to_numpy(np.int64),
                "vectors": _matrix(part["embedding"]).tobytes(), "turned": turned.tobytes(),
                "low": turned.min(axis=0), "high": turned.max(axis=0),
            }

        def ready(rows: pd.DataFrame, last: bool) -> tuple[list[dict], pd.DataFrame | None]:
            out = []
            change = np.flatnonzero(rows["label"].to_numpy()[1:] != rows["label"].to_numpy()[:-1]) + 1
            edges = [0, *change.tolist(), len(rows)]
            for a, b in zip(edges, edges[1:]):
                closed = last or b < len(rows)
                while b - a >= BLOCK or (closed and b > a):
                    out.append(block(rows.iloc[a : min(a + BLOCK, b)]))
                    a = min(a + BLOCK, b)
            return out, rows.iloc[a:] if a < len(rows) else None

        for pdf in frames:
            if len(pdf):
                out, held = ready(pdf if held is None else pd.concat([held, pdf], ignore_index=True), False)
                if out:
                    yield pd.DataFrame(out)
        if held is not None:
            yield pd.DataFrame(ready(held, True)[0])

    placed = points.mapInPandas(
        place, "label string, embedding array<double>, first long, copies long, turned array<double>, cells array<int>"
    )
    ordered = placed.orderBy("label", *[F.col("cells")[k] for k in range(lead)], "first")
    kind = "label string, ids array<long>, counts array<long>, vectors binary, turned binary, low array<double>, high array<double>"
    return staged(ordered.mapInPandas(cut, kind)).withColumn("block", F.monotonically_increasing_id())


def _near_blocks(blocks: DataFrame, width: float, lead: int) -> DataFrame:
    """Pairs ``a <= b`` of blocks of one label whose boxes are within epsilon.

    Blocks meet over the cells of the first two axes that they or their neighbours cover.
    """
    axes = range(min(2, lead))
    boxes = blocks.select("block", "label", "low", "high")

    def spread(frame: DataFrame, by: int) -> DataFrame:
        for k in axes:
            first = F.floor(F.col("low")[k] / width) - by
            frame = frame.withColumn(f"cell{k}", F.explode(F.sequence(first, F.floor(F.col("high")[k] / width) + by)))
        return frame

    a, b = (spread(boxes, by).select(*[F.col(c).alias(f"{s}_{c}") for c in boxes.columns], *[f"cell{k}" for k in axes])
            for s, by in (("a", 0), ("b", 1)))
    met = a.join(b, (F.col("a_label") == F.col("b_label")) & reduce(lambda x, y: x & y, [a[f"cell{k}"] == b[f"cell{k}"] for k in axes]))
    gaps = F.zip_with(
        F.arrays_zip(F.col("a_low").alias("low"), F.col("a_high").alias("high")), F.arrays_zip(F.col("b_low").alias("low"), F.col("b_high").alias("high")),
        lambda x, y: F.pow(F.greatest(F.lit(0.0), x["low"] - y["high"], y["low"] - x["high"]), F.lit(2.0)),
    )
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g) <= width * width
    return met.where((F.col("a_block") <= F.col("b_block")) & near).select("a_block", "b_block").distinct()


def _search(frames: Iterator[pd.DataFrame], dims: int, lead: int, cosine: float, width: float) -> Iterator[pd.DataFrame]:
    """For each pair of blocks: per point the number of linked vectors, and a smaller point of its tree."""
    for pdf in frames:
        for row in pdf.itertuples(index=False):
            same = row.a_block == row.b_block
            x, y = (np.frombuffer(v).reshape(-1, dims) for v in (row.a_vectors, row.b_vectors))
            p, q = (np.frombuffer(v).reshape(-1, lead) for v in (row.a_turned, row.b_turned))
            nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            linked = np.zeros((len(x), len(y)), bool)
            todo = [(0, len(x), 0, len(y))]
            while todo:
                a, b, c, d = todo.pop()
                if same and c >= b:
                    continue
                gap = np.maximum(np.maximum(p[a:b].min(0) - q[c:d].max(0), q[c:d].min(0) - p[a:b].max(0)), 0)
                if gap @ gap > width * width:
                    continue
                if b - a <= _LEAF and d - c <= _LEAF:
                    linked[a:b, c:d] = (x[a:b] @ y[c:d].T) / np.outer(nx[a:b], ny[c:d]) >= cosine
                elif b - a >= d - c:
                    todo += [(a, (a + b) // 2, c, d), ((a + b) // 2, b, c, d)]
                else:
                    todo += [(a, b, c, (c + d) // 2), (a, b, (c + d) // 2, d)]
            ids_a, ids_b = np.asarray(row.a_ids), np.asarray(row.b_ids)
            if same:
                linked |= linked.T
                np.fill_diagonal(linked, False)
            at, to = np.nonzero(linked)
            if not len(at):
                continue
            found = {"id": ids_a, "n": linked @ np.asarray(row.b_counts)}
            if not same:
                found = {"id": np.concatenate([ids_a, ids_b]), "n": np.concatenate([found["n"], linked.T @ np.asarray(row.a_counts)])}
            nodes, tree = np.unique(np.concatenate([ids_a, ids_b]), return_inverse=True)
            u, v = tree[: len(ids_a)][at], tree[len(ids_a) :][to]
            root = np.arange(len(nodes))
            while True:
                low = root.copy()
                np.minimum.at(low, u, root[v])
                np.minimum.at(low, v, root[u])
                low = low[low]
                if (low == root).all():
                    break
                root = low
            found["root"] = nodes[root[np.searchsorted(nodes, found["id"])]]
            out = pd.DataFrame(found)
            yield out[out["n"] > 0]


def vector_classes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                   cosine: float = COSINE, axes: int = AXES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Only vectors with equal labels and lengths are compared, by cosine in double precision; a link needs
    ``cosine`` or more. A null id, label or vector, a zero vector, and one with null or
    non-finite components link with nothing; such a row is its own component (null if its id is).
    Repeated rows are one vector and get equal results; rows of one id with different vectors count the
    links of each, as one member. Empty tables give an empty result; further columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda v: v != 0)
    good = staged(rows.where(usable).distinct())
    points = staged(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")))
    width = float(np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6)
    found = None
    for dims in sorted(r[0] for r in points.select(F.size("embedding")).distinct().collect()):
        own = points.where(F.size("embedding") == dims)
        lead = min(axes, dims)
        blocks = _blocks(own, principal_axes(own, dims, lead), width)
        pairs = _near_blocks(blocks, width, lead)
        sides = [blocks.select(F.col("block").alias(f"{s}_block"), *[F.col(c).alias(f"{s}_{c}") for c in ("ids", "counts", "vectors", "turned")]) for s in "ab"]
        joined = pairs.join(sides[0], "a_block").join(sides[1], "b_block")
        part = joined.mapInPandas(lambda f, dims=dims, lead=lead: _search(f, dims, lead, cosine, width), "id long, n long, root long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "id long, n long, root long")
    found = staged(found.groupBy("id", "root").agg(F.sum("n").alias("n")))
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    classes = components(found.where("id <> root"), "id", "root").withColumnRenamed("id", "c_id")
    member = good.join(points, ["label", "embedding"]).select("vec_id", "first", "copies")
    judged = member.join(links, F.col("first") == F.col("id"), "left").join(classes, F.col("first") == F.col("c_id"), "left")
    judged = judged.select(
        "vec_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component_id")
    ).groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id").join(judged, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
