"""Move documents from old shards into new ones with the fewest bytes.

Bytes of the old shards are supplies, capacities of the new ones demands, and staying costs
nothing: a minimum-cost flow between shards, a graph whose size is the number of shards, says how many bytes go where.
The rows of an old shard are ordered by a hash and cut into blocks along the flow, so a row's new
shard follows from its hash and a few cuts, and is found without moving it. Only documents that are
large compared with a shard are fitted into the transfers of the flow one by one; their number is bounded by that
comparison, and the flow is solved again for what the others leave. Then the files of shards that lose or gain rows are written anew.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.functions.columns import named
from tenderlake.llm.graph import whole_row
from tenderlake.session import new_folder, staged

SHARDS = 24
OLD_SHARDS = 16
#: A document is fitted alone into the flow when it has more than this part of a shard, as a cut would tear the
#: transfer by more; there are at most ``LARGE_PARTS`` times as many such documents as shards.
LARGE_PARTS = 256
BLOCK_ROWS = 4096
LAW = "bytes"


def minimum_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Units from every supply to every demand at the least cost, by successive shortest paths.

    Demands together must be at least the supplies. ``cost[i][j]`` is per unit and not negative.
    """
    m, n = len(supply), len(demand)
    source, sink = m + n, m + n + 1
    graph: list[list[int]] = [[] for _ in range(m + n + 2)]
    edges: list[list[int]] = []

    def connect(u: int, v: int, room: int, price: int) -> int:
        graph[u].append(len(edges))
        edges.append([v, room, price])
        graph[v].append(len(edges))
        edges.append([u, 0, -price])
        return len(edges) - 2

    for i, s in enumerate(supply):
        connect(source, i, s, 0)
    flow = [[connect(i, m + j, supply[i], cost[i][j]) for j in range(n)] for i in range(m)]
    for j, d in enumerate(demand):
        connect(m + j, sink, d, 0)
    left = sum(supply)
    while left:
        price, via = {source: 0}, {}
        queue, queued = deque([source]), {source}
        while queue:
            u = queue.popleft()
            queued.discard(u)
            for e in graph[u]:
                v, room, step = edges[e]
                if room and price[u] + step < price.get(v, 1 << 62):
                    price[v], via[v] = price[u] + step, e
                    if v not in queued:
                        queue.append(v)
                        queued.add(v)
        if sink not in via:
            raise ValueError("the demands hold less than the supplies")
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = edges[via[v] ^ 1][0]
        amount = min(left, *(edges[e][1] for e in path))
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
        left -= amount
    return [[edges[flow[i][j] ^ 1][1] for j in range(n)] for i in range(m)]


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def document_bytes(text: str) -> Column:
    """UTF-8 bytes of a text (none for null) and 8 for the id."""
    return (F.coalesce(F.octet_length(named(text)), F.lit(0)) + 8).cast("long")


def _level(fixed: list[int], total: int) -> list[int]:
    """Capacities left beside what is fixed, so that ``total`` more units make the fullest least full."""
    low, high = 0, max([0, *fixed]) + total + 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if sum(max(0, middle - f) for f in fixed) >= total else (middle + 1, high)
    rooms = [max(0, low - f) for f in fixed]
    excess = sum(rooms) - total
    for j, room in enumerate(rooms):
        cut = min(excess, 1 if room else 0)
        rooms[j], excess = room - cut, excess - cut
    return rooms


def fit_into_transfers(documents: list[tuple[int, int]], transfers: list[list[int]], wanted: list[int]) -> list[int]:
    """New shard of each large document, given as ``(old shard, bytes)``, largest first.

    A document takes the place its shard's transfers have for it: staying if that has room, else the transfer it
    fills best. One that no transfer holds stays while its shard has room, and else goes where most room is.
    """
    room = [list(out) for out in transfers]
    filled, found = [0] * len(wanted), []
    for i, size in documents:
        fitting = [(j != i, room[i][j], j) for j in range(len(wanted)) if room[i][j] >= size and filled[j] + size <= wanted[j]]
        if fitting:
            j = min(fitting)[2]
        elif i < len(wanted) and filled[i] + size <= wanted[i]:
            j = i
        else:
            j = max(range(len(wanted)), key=lambda x: (wanted[x] - filled[x], -x))
        room[i][j] = max(0, room[i][j] - size)
        filled[j] += size
        found.append(j)
    return found


@dataclass
class Plan:
    """``cuts``: old shard, hash from, hash below, new shard. ``large``: documents placed alone.

    ``least_bytes`` is the optimum of the flow, which no plan of whole documents with equal shards can go below;
    ``moved_bytes`` is what this plan moves.
    """

    cuts: DataFrame
    large: DataFrame
    affected: list[int]
    moved_bytes: int
    least_bytes: int
    shards: int
    key: str
    text: str
    old: str
    blocks: int

    def assign(self, rows: DataFrame) -> DataFrame:
        """Add ``size`` and ``shard`` (int) to rows; each row is judged by itself."""
        return self.place(rows, rows.drop("size", "shard")).select("row.*", "size", "shard")

    def place(self, rows: DataFrame, kept: DataFrame) -> DataFrame:
        """``row`` (the columns that are kept), ``key, hash, size`` and ``shard``."""
        sized = rows.select(
            whole_row(kept), named(self.key).alias("key"), _hash(self.key).alias("hash"),
            document_bytes(self.text).alias("size"), F.expr(self.old).alias("old"),
        )
        single = sized.join(
            F.broadcast(self.large), (F.col("hash") == F.col("l_hash")) & (F.col("size") == F.col("l_size")) & (F.col("old") == F.col("l_old")), "left",
        )
        cut = single.join(
            F.broadcast(self.cuts),
            F.col("l_shard").isNull() & (F.col("old") == F.col("c_old")) & (F.col("hash") >= F.col("c_from")) & (F.col("hash") < F.col("c_below")), "left",
        )
        return cut.select("row", "key", "hash", "size", F.coalesce("l_shard", "c_shard").cast("int").alias("shard"))


def _hash(key: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("block"), named(key)), 2)


_HASHES = 1 << 62


def old_shard(key: str, shards: int = OLD_SHARDS) -> str:
    """SQL of the layout in which a row's shard follows from the hash of its id."""
    return f"cast(pmod(xxhash64({key}), {shards}) as int)"


def plan_resharding(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text",
                    old: str | None = None, old_shards: int = OLD_SHARDS) -> Plan:
    """Find where every document goes; ``old`` is SQL for the old shard, 0 to ``old_shards - 1``.

    Old shard i and new shard i are the same place. New shards get equal capacities. Rows with equal
    ids and sizes stay together. Null texts have no bytes; null ids hash like any value. An empty table gives an empty plan.
    """
    spark = docs.sparkSession
    old = old or old_shard(key, old_shards)
    rows = docs.select(F.expr(old).alias("old"), _hash(key).alias("hash"), document_bytes(text).alias("size"))
    units = staged(rows.groupBy("old", "hash", "size").agg(F.count("*").alias("n")).withColumn("bytes", F.col("n") * F.col("size")))
    count, total = units.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    is_large = F.col("bytes") > total // (shards * LARGE_PARTS)
    wanted, cost = even_capacities(total, shards), [[int(i != j) for j in range(shards)] for i in range(old_shards)]
    transfers = minimum_cost_flow(_bytes_by_old(units, old_shards), wanted, cost)
    least = sum(b for i, out in enumerate(transfers) for j, b in enumerate(out) if j != i)
    alone = units.where(is_large).orderBy(F.col("bytes").desc(), "old", "hash", "size").collect()
    targets = fit_into_transfers([(r.old, r.bytes) for r in alone], transfers, wanted)
    placed = [(r["hash"], r["size"], r.old, j) for r, j in zip(alone, targets)]
    filled = [0] * shards
    for r, j in zip(alone, targets):
        filled[j] += r.bytes
    moved = sum(r.bytes for r, j in zip(alone, targets) if r.old != j)
    small = units.where(~is_large)
    blocks = max(1, -(-count // (BLOCK_ROWS * max(old_shards, 1))))
    block = (F.col("hash") * F.lit(1.0) / F.lit(float(_HASHES)) * blocks).cast("long")
    small = small.withColumn("block", F.least(block, F.lit(blocks - 1)))
    supply = _bytes_by_old(small, old_shards)
    flow = minimum_cost_flow(supply, _level(filled, sum(supply)), cost)
    positions, order = [], {}
    for i, out in enumerate(flow):
        at = 0
        order[i] = [j for j in sorted(range(shards), key=lambda j: (j != i, j)) if out[j]]
        for j in order[i][:-1]:
            at += out[j]
            positions.append((i, j, at))
        moved += sum(b for j, b in enumerate(out) if j != i)
    below = _cut_hashes(small, positions)
    cuts = []
    for i, targets in order.items():
        start = 0
        for j in targets:
            stop = below.get((i, j), _HASHES) if j != targets[-1] else _HASHES
            cuts.append((i, start, stop, j))
            start = stop
    lost_or_gained = {o for _, _, o, j in placed if o != j} | {j for _, _, o, j in placed if o != j}
    lost_or_gained |= {x for i, out in enumerate(flow) for j, b in enumerate(out) if b and i != j for x in (i, j)}
    return Plan(
        spark.createDataFrame(cuts, "c_old int, c_from long, c_below long, c_shard int"),
        spark.createDataFrame(placed, "l_hash long, l_size long, l_old int, l_shard int"),
        sorted(lost_or_gained), moved, least, shards, key, text, old, blocks,
    )


def _bytes_by_old(units: DataFrame, old_shards: int) -> list[int]:
    found = dict(units.groupBy("old").agg(F.sum("bytes")).collect())
    return [found.get(i, 0) for i in range(old_shards)]


def _cut_hashes(small: DataFrame, positions: list[tuple[int, int, int]]) -> dict[tuple[int, int], int]:
    """For (old shard, new shard, byte position): the hash from which rows lie behind the position."""
    if not positions:
        return {}
    spark = small.sparkSession
    wanted = F.broadcast(spark.createDataFrame(positions, "p_old int, p_new int, position long"))
    upto = Window.partitionBy("old").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = small.groupBy("old", "block").agg(F.sum("bytes").alias("bytes"))
    sums = sums.withColumn("stop", F.sum("bytes").over(upto)).withColumn("start", F.col("stop") - F.col("bytes"))
    hit = sums.join(wanted, (F.col("old") == F.col("p_old")) & (F.col("position") > F.col("start")) & (F.col("position") <= F.col("stop")))
    hit = hit.select("p_old", "p_new", "position", "start", F.col("block").alias("p_block"))
    inside = small.join(F.broadcast(hit), (F.col("old") == F.col("p_old")) & (F.col("block") == F.col("p_block")))
    running = Window.partitionBy("p_old", "p_new").orderBy("hash", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("start") + F.sum("bytes").over(running) - F.col("bytes") / 2
    behind = inside.withColumn("middle", middle)
    # rows of one hash stay together: the cut lies at a hash
    found = behind.groupBy("p_old", "p_new").agg(
        F.min(F.when(F.col("middle") >= F.col("position"), F.col("hash"))).alias("cut"), F.max("hash").alias("last")
    ).collect()
    return {(r.p_old, r.p_new): r.cut if r.cut is not None else r["last"] + 1 for r in found}


def rewrite(docs: DataFrame, plan: Plan, path: str) -> DataFrame:
    """Write the rows of affected shards below ``path``, a folder per shard; returns all rows with
    ``size, shard, slot``, rewritten ones read back from the files.

    Slots count a shard's rows from 0 without gaps, in the order of hash blocks, so no task sorts
    a whole shard. Columns of the input that have one of these names are replaced.
    """
    kept = docs.drop("size", "shard", "slot")
    rows = plan.place(docs, kept)
    block = F.least((F.col("hash") * F.lit(1.0) / F.lit(float(_HASHES)) * plan.blocks * 4).cast("long"), F.lit(plan.blocks * 4 - 1))
    rows = rows.withColumn("block", block)
    counts = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("shard", "block").orderBy("hash", "key", "size", F.xxhash64(F.col("row").getField(plan.text)))
    slot = (F.col("before") + F.row_number().over(within) - 1).cast("long")
    numbered = rows.join(offsets, ["shard", "block"]).select("row.*", "size", "shard", slot.alias("slot"))
    moved = F.col("shard").isin(plan.affected)
    numbered.where(moved).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    schema = numbered.schema
    written = docs.sparkSession.read.schema(schema).parquet(path).select(*map(named, numbered.columns))
    stays = len(plan.affected) < plan.shards
    return written.unionByName(numbered.where(~moved)) if stays else written


def reshard(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text",
            old: str | None = None, old_shards: int = OLD_SHARDS, path: str | None = None) -> DataFrame:
    """Plan and rewrite; ``path`` defaults to a new folder below the shared one.

    All columns and rows are kept, repeated rows too, each with a slot of its own. Empty tables
    give an empty result. Equal texts are not held together: a group may be larger than a shard.
    """
    plan = plan_resharding(docs, shards, key, text, old, old_shards)
    return rewrite(docs, plan, path or new_folder(docs.sparkSession, "shards"))
