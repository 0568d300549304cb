"""Mix sources to target weights by entropy balancing.

Among all document rates that give every source its target number of words, the rates closest to 1
(least relative entropy, rates at most ``MOST_COPIES``) are exponential in a document's words,
``least(MOST_COPIES, exp(multiplier * words / mean words))``. The multipliers minimise the
convex dual, one per source, found by Newton steps on counts of (source, words). Rates are then
rounded to copies: a document gets one copy more when its hash, divided by the fraction of its
rate, stays below a threshold of its source, which is set so that the source's words meet the target;
one document beyond it is added when that brings them nearer.

Everything here is DataFrame work; no step collects documents or sources.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.functions.columns import named
from tenderlake.llm.graph import whole_row
from tenderlake.session import staged

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
_STEPS = 40
_CLOSE = 1e-9
_BINS = 4096
_LEVELS = 3


def words_of(text: str) -> Column:
    """Number of blank-separated words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, docs, source_size, target`` from one row per source.

    Sources in code point order, null last, take the weights in turn; all targets together are
    all words. A target stops at ``most`` times its source's words; what is left over goes to the others by weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double")
    limit = (F.col("source_size") * most).cast("double")
    ranked = sizes.withColumn("weight", weight).withColumn("limit", limit)
    # filling to a common level, the sources with the lowest limit per weight stop first
    order = [F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    reached = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct(order[0].alias("at"), "level"))
    filled = ranked.withColumn("level", level).withColumn("level", F.min(reached).over(everything)["level"])
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return filled.select("source", "docs", "source_size", target.alias("target"))


def _rate(multiplier: Column, words: Column, mean: Column, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(multiplier * words / mean, F.lit(50.0))))


def balance(counts: DataFrame, targets: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Add ``mean`` and ``multiplier`` to the targets; ``counts`` has ``source, size, n``.

    Newton steps on the dual of each source, kept inside a bracket that halves when a step
    would leave it. A source without words, or whose target is its limit, needs no step.
    """
    mean = F.col("source_size") / F.greatest("docs", F.lit(1))
    state = targets.withColumn("mean", F.greatest(mean, F.lit(1e-9))).withColumns({
        "multiplier": F.lit(0.0), "low": F.lit(-1e6), "high": F.lit(1e6),
        "open": (F.col("source_size") > 0) & (F.col("target") < most * F.col("source_size") * (1 - 1e-12)),
    })
    state = staged(state)
    same = F.col("c.source").eqNullSafe(F.col("s.source"))
    for _ in range(_STEPS):
        if state.where("open").isEmpty():
            break
        rate = _rate(F.col("s.multiplier"), F.col("c.size"), F.col("s.mean"), most)
        words = F.col("c.n") * F.col("c.size")
        slope = F.when(rate < most, words * rate * F.col("c.size") / F.col("s.mean")).otherwise(0.0)
        taken = (
            counts.alias("c").join(state.where("open").alias("s"), same)
            .groupBy(F.col("s.source").alias("source")).agg(F.sum(words * rate).alias("taken"), F.sum(slope).alias("slope"))
        )
        x, miss = F.col("s.multiplier"), F.col("t.taken") - F.col("s.target")
        low = F.when(miss < 0, F.greatest("s.low", x)).otherwise(F.col("s.low"))
        high = F.when(miss > 0, F.least("s.high", x)).otherwise(F.col("s.high"))
        newton = F.when(F.col("t.slope") > 0, x - miss / F.nullif(F.col("t.slope"), F.lit(0.0)))
        inside = (newton > low) & (newton < high)
        unbounded = F.when(low <= -1e6, F.least(high, F.lit(0.0)) * 2 - 1).when(high >= 1e6, F.greatest(low, F.lit(0.0)) * 2 + 1)
        moved = F.when(inside & (F.abs(newton - x) < 20), newton).otherwise(F.coalesce(unbounded, (low + high) / 2))
        done = (F.abs(miss) <= _CLOSE * F.greatest("s.target", F.lit(1.0))) | (high - low < 1e-13)
        stepping = F.col("s.open") & F.col("t.taken").isNotNull()
        state = staged(
            state.alias("s").join(taken.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")), "left").select(
                *[f"s.{c}" for c in ("source", "docs", "source_size", "target", "mean")],
                F.when(stepping & ~done, moved).otherwise(x).alias("multiplier"),
                F.when(stepping, low).otherwise(F.col("s.low")).alias("low"),
                F.when(stepping, high).otherwise(F.col("s.high")).alias("high"),
                (stepping & ~done).alias("open"),
            )
        )
    full = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    return state.withColumn("full", full).drop("open", "low", "high")


def _place(key: str) -> Column:
    """A number in [0, 1) that depends on the document's key only."""
    return (F.pmod(F.xxhash64(F.lit("copies"), F.col(key)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))


@dataclass
class Mix:
    """What decides the copies: one row per source, joined to the documents."""

    state: DataFrame
    key: str
    source: str
    text: str
    most: int

    def copies(self, docs: DataFrame) -> DataFrame:
        """Add ``size, source_size, target, copies``; columns with these names are replaced, all others pass."""
        added = ("size", "source_size", "target", "copies")
        return self._judged(docs, docs.drop(*added)).select("row.*", *added)

    def take(self, docs: DataFrame) -> DataFrame:
        """Every document as often as it has copies."""
        kept = self._judged(docs, docs).where("copies > 0")
        return kept.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")

    def _judged(self, docs: DataFrame, kept: DataFrame) -> DataFrame:
        """Copies of each document beside ``row``, the columns that are kept."""
        rows = docs.select(whole_row(kept), named(self.key).alias("key"), named(self.source).alias("source"), words_of(self.text).alias("size"))
        return _with_copies(rows, self.state, "key", "source", self.most)


def _with_copies(rows: DataFrame, state: DataFrame, key: str, source: str, most: int) -> DataFrame:
    s = state.select(*[F.col(c).alias(f"__s_{c}") for c in state.columns])
    joined = rows.join(s, rows[source].eqNullSafe(s["__s_source"]), "left")
    rate = F.when(F.col("__s_full"), F.lit(float(most))).otherwise(
        _rate(F.col("__s_multiplier"), F.col("size"), F.col("__s_mean"), most)
    )
    whole = F.floor(rate)
    share = F.nullif(rate - whole, F.lit(0.0))
    ratio = _place(key) / share
    priority = ratio / (1 + ratio)
    extra = F.lit(False)
    if "threshold" in state.columns:
        last = (priority == F.col("__s_last_priority")) & (F.col("size") == F.col("__s_last_size"))
        extra = F.coalesce(priority < F.col("__s_threshold"), F.lit(False)) | F.coalesce(last, F.lit(False))
    return joined.withColumns({
        "source_size": F.col("__s_source_size"), "target": F.col("__s_target"),
        "copies": (whole + extra.cast("long")).cast("int"), "__priority": priority,
    }).drop(*s.columns)


def plan_mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
             weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> Mix:
    """Find the copies of all documents.

    A size is the number of blank-separated words, 0 for a null or empty text. A null source is a
    source of its own. Documents without words are taken once. Documents of a source with equal keys
    and sizes are treated alike, so repeated rows get equal copies. An empty table gives an empty
    mix. Further columns are not read. The same table gives the same copies, however it is stored.
    """
    rows = staged(docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), words_of(text).alias("size")))
    counts = staged(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    sizes = counts.groupBy("source").agg(F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("size")).alias("source_size"))
    state = staged(balance(counts, source_targets(sizes, weights, most), most))
    judged = staged(_with_copies(rows, state, "key", "source", most).select("source", "size", "target", "copies", F.col("__priority").alias("priority")))
    # the threshold of a source: narrowed down level by level to the bin where the words meet the target
    bounds = judged.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("need"),
        F.lit(0.0).alias("low"), F.lit(1.0).alias("width"),
    )
    first, up_to = Window.partitionBy("source").orderBy("bin"), Window.partitionBy("source").orderBy("bin")
    up_to = up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for _ in range(_LEVELS):
        same = F.col("r.source").eqNullSafe(F.col("b.source"))
        at = (F.col("r.priority") - F.col("b.low")) / F.col("b.width")
        inside = judged.where("priority is not null and size > 0").alias("r").join(bounds.alias("b"), same).where((at >= 0) & (at < 1))
        bins = inside.groupBy(F.col("b.source").alias("source"), F.floor(at * _BINS).alias("bin")).agg(
            F.sum("r.size").alias("words"), F.first("b.need").alias("need"), F.first("b.low").alias("low"), F.first("b.width").alias("width"),
        )
        summed = bins.withColumn("sum", F.sum("words").over(up_to))
        crossing = summed.where("sum >= need").withColumn("__n", F.row_number().over(first)).where("__n = 1")
        met = crossing.select(
            F.col("source").alias("source"), (F.col("need") - F.col("sum") + F.col("words")).alias("need"),
            (F.col("low") + F.col("bin") * F.col("width") / _BINS).alias("low"), (F.col("width") / _BINS).alias("width"),
        )
        # where all bins together stay below the need, everything inside is taken
        bounds = staged(
            bounds.alias("b").join(met.alias("m"), F.col("b.source").eqNullSafe(F.col("m.source")), "left").select(
                F.col("b.source").alias("source"),
                F.coalesce(F.col("m.need"), F.col("b.need")).alias("need"),
                F.when(F.col("m.width").isNull(), F.col("b.low") + F.col("b.width")).otherwise(F.col("m.low")).alias("low"),
                F.when(F.col("m.width").isNull(), F.lit(1e-300)).otherwise(F.col("m.width")).alias("width"),
            )
        )
    # one document more, beyond the threshold, when it brings the words nearer to the target
    beyond = judged.where("priority is not null and size > 0").alias("r").join(
        bounds.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source"))
    ).where("r.priority >= b.low and abs(r.size - b.need) < b.need")
    nearest = F.min(F.struct(F.abs(F.col("r.size") - F.col("b.need")), F.col("r.priority").alias("p"), F.col("r.size").alias("s")))
    last = beyond.groupBy(F.col("b.source").alias("source")).agg(nearest.alias("last"))
    cut = bounds.alias("b").join(last.alias("l"), F.col("b.source").eqNullSafe(F.col("l.source")), "left").select(
        F.col("b.source").alias("__s"), F.col("b.low").alias("threshold"),
        F.col("last.p").alias("last_priority"), F.col("last.s").alias("last_size"),
    )
    final = state.join(cut, state["source"].eqNullSafe(F.col("__s")), "left").drop("__s")
    return Mix(staged(final), key, source, text, most)
