"""Language identification by prediction by partial matching.

Every language has the statistics of a byte context tree with contexts of up to ``ORDER`` bytes. The
code length of a byte is taken from the longest context that has seen it; every shorter step
costs the escape probability of the context left (method C, without exclusions). Statistics are
frozen after fitting; no context of the sample is left out. Each language has sorted tables of its own, so they
grow with what was seen, and a chunk of texts looks up every different byte with its context once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.columns import named
from tenderlake.llm.arrays import chunks
from tenderlake.llm.graph import whole_row
from tenderlake.llm.sampling import sample_per_label
from tenderlake.session import staged

ORDER = 4
#: Bound of the training sample, in documents of each language.
SAMPLE_ROWS = 400
#: Contexts seen less often are left out: none.
LEAST_SEEN = 1
UNKNOWN = "und"
_BREAK = 0xFF
_BODY = (1 << 56) - 1
_UNIT = 1024  # code lengths are whole numbers of 1/1024 bit, so that sums do not depend on their order


@dataclass
class Tree:
    """A language's sequences with the code length of their last byte, and its contexts with that of an escape, both sorted."""

    grams: np.ndarray
    own: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


def _values(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted keys, -1 where there is none."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], -1.0)


@dataclass
class Model:
    """The context tree of each language."""

    languages: list[str]
    trees: list[Tree]
    order: int

    def _costs(self, tree: Tree, grams: np.ndarray) -> np.ndarray:
        """Code lengths of the last bytes of sequences, sorted and as long as their contexts reach."""
        length, body = grams >> 56, grams & _BODY
        cost = np.full(len(grams), 8.0)
        for size in range(self.order + 1):
            at = np.flatnonzero(length > size)
            last = body[at] & ((1 << 8 * (size + 1)) - 1)
            own = _values(tree.grams, tree.own, last | ((size + 1) << 56))
            escape = _values(tree.contexts, tree.escape, (last >> 8) | (size << 56))
            cost[at] = np.where(own >= 0, own, cost[at] + np.maximum(escape, 0.0))
        return np.rint(cost * _UNIT).astype(np.int32)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """``len(texts) x languages`` code lengths in units of 1/1024 bit."""
        raw = np.frombuffer(bytes([_BREAK]) + b"".join(t + bytes([_BREAK]) for t in texts), np.uint8)
        ends = raw == _BREAK
        starts = np.flatnonzero(ends)[:-1]
        place = np.arange(len(raw))
        reach = np.minimum(place - np.maximum.accumulate(np.where(ends, place, 0)), self.order + 1)
        gram = raw.astype(np.int64)
        for back in range(1, self.order + 1):
            gram[back:] |= np.where(reach[back:] > back, raw[:-back].astype(np.int64) << 8 * back, 0)
        gram |= reach << 56
        gram[ends] = 0
        different, which = np.unique(gram, return_inverse=True)
        sums = np.empty((len(starts), len(self.trees)), np.int64)
        for i, tree in enumerate(self.trees):
            cost = self._costs(tree, different)
            cost[different == 0] = 0
            sums[:, i] = np.add.reduceat(cost[which], starts, dtype=np.int64)
        return sums


def _gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """``lang, gram, n``: byte sequences of 1 to ``order + 1`` bytes, length in the top byte."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for lang, part in pdf.groupby("lang"):
                for _, texts in chunks([t.lower() for t in part["text"]]):
                    raw = np.frombuffer(bytes([_BREAK]).join([b"", *texts, b""]), np.uint8).astype(np.int64)
                    gram = np.zeros(len(raw), np.int64)
                    whole = np.ones(len(raw), bool)
                    for k in range(order + 1):
                        gram = (gram << 8) | raw[k:] if k == 0 else (gram[:-1] << 8) | raw[k:]
                        whole = (raw[k:] != _BREAK) if k == 0 else whole[:-1] & (raw[k:] != _BREAK)
                        found, n = np.unique(gram[whole], return_counts=True)
                        yield pd.DataFrame({"lang": lang, "gram": found | ((k + 1) << 56), "n": n})

    grams = sample.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _tree(gram: np.ndarray, n: np.ndarray) -> Tree:
    order = np.argsort(gram)
    gram, n = gram[order], n[order]
    contexts, place, kinds = np.unique(((gram & _BODY) >> 8) | (((gram >> 56) - 1) << 56), return_inverse=True, return_counts=True)
    total = np.bincount(place, weights=n)
    whole = total + kinds
    own, escape = -np.log2(n / whole[place]), -np.log2(kinds / whole)
    held = total >= LEAST_SEEN
    return Tree(gram[held[place]], own[held[place]], contexts[held], escape[held])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        order: int = ORDER, rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on a bounded sample of the rows with a text and a language; None if there are none.

    The sample holds at most ``rows`` documents of each language, chosen by the hash of ``key``.
    """
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"))
    labelled = labelled.where("text is not null and lang is not null")
    grams = staged(_gram_counts(sample_per_label(labelled, "lang", "key", rows), order))
    languages = sorted(r.lang for r in grams.select("lang").distinct().collect())
    trees = []
    for name in languages:
        counts = grams.where(F.col("lang") == name).select("gram", "n").toPandas()
        trees.append(_tree(counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)))
    return Model(languages, trees, order) if languages else None


def predict_language(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``.

    ``lang_pred`` is the language in which the whole text has the shortest code, the first name
    of a tie; ``score`` is its share of all languages' probabilities of the text. A text that is
    null or has no letter, and every text under a model without languages, is ``und`` with score 0.
    Repeated rows get equal results; an empty table stays empty; further columns pass through,
    except that columns with the two names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        best, score = [], []
        for _, part in chunks([t.lower() if t is not None else "" for t in texts]):
            bits = shared.value.code_lengths(part) / _UNIT
            low = bits.min(axis=1)
            best.append(bits.argmin(axis=1))
            score.append(1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(axis=1))
        names = np.array(shared.value.languages, dtype=object)
        if not best:
            return pd.DataFrame({"lang_pred": [], "score": []})
        return pd.DataFrame({"lang_pred": names[np.concatenate(best)], "score": np.concatenate(score)})

    readable = F.coalesce(named(text).rlike(r"\p{L}"), F.lit(False))
    found = predict(F.when(readable, named(text)))
    out = docs.select(whole_row(docs), readable.alias("readable"), found.alias("best"))
    return out.select(
        "row.*", F.when(F.col("readable"), F.col("best.lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("readable"), F.col("best.score")).otherwise(0.0).alias("score"),
    )


def keep_known(docs: DataFrame, held_out: str = "false", doc_id: str = "doc_id", text: str = "text",
               lang: str = "lang") -> DataFrame:
    """The documents whose language is recognised, unchanged; fitted on the rows not held out."""
    model = fit(docs.where(f"not ({held_out})"), text, lang, doc_id)
    found = predict_language(docs.select(whole_row(docs), named(text).alias("text")), model)
    return found.where(F.col("lang_pred") != UNKNOWN).select("row.*")
