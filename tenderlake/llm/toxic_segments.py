"""Toxic passages by maximum-scoring segment search.

Every word has a log-odds score: how much likelier it is in toxic than in clean texts, under Dirichlet
priors that hand down the odds of a word's beginnings to the word. A drift makes scores negative on
average in clean text. One pass over the scores finds all maximal-scoring segments; extreme-value
statistics, fitted to the best segments of clean texts, say how surprising a segment is
in a text of that length, sum statistics how surprising the best segments are together, and a logistic curve fitted on other labelled rows turns that into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.sampling import sample_per_label

#: Bounds of the samples of labelled documents, per label: for word scores, and for calibration.
WORD_ROWS = 4000
CALIBRATION_ROWS = 2000
PREFIX_LENGTHS = range(3, 9)
PRIOR_STRENGTH = 4.0
#: A feature of fewer toxic documents keeps the odds of its shorter prefix.
LEAST_DOCUMENTS = 3
DRIFT = 0.7
LOWEST, HIGHEST = -2.0, 6.0
#: Segments expected less often than this in a clean text of the same length are reported.
SIGNIFICANT = 0.05
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_CACHED = 300_000


def features(word: str) -> list[str]:
    """A word's prefixes, from short to long, then the word itself."""
    return [f"{word[:k]}*" for k in PREFIX_LENGTHS if k < len(word)] + [word]


class _Scores(dict):
    """Word to score, filled on first use and emptied when it grows large."""

    def __init__(self, odds: dict[str, float]) -> None:
        self.odds = odds

    def __missing__(self, word: str) -> float:
        score = 0.0
        for feature in features(word):
            if feature not in self.odds:
                break
            score = self.odds[feature]
        if len(self) >= _CACHED:
            self.clear()
        self[word] = score = min(max(score, LOWEST), HIGHEST) - DRIFT
        return score


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(begin, stop, score)`` of a sequence, in linear time.

    Disjoint, in order; each has the highest score among the segments that overlap it.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    # candidates: begin, stop, sum before, sum after, index of the last earlier one with a lower sum before
    held: list[tuple[int, int, float, float, int]] = []
    for p in positive.tolist():
        begin, stop, low, high = p, p + 1, float(sums[p]), float(sums[p + 1])
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                held.append((begin, stop, low, high, j))
                break
            begin, low = held[j][0], held[j][2]
            del held[j:]
    return [(b, s, high - low) for b, s, low, high, _ in held]


@dataclass
class Model:
    """Odds of features, extreme-value parameters, and the calibration curve."""

    odds: dict[str, float]
    rate: float = 1.0
    scale: float = 1.0
    curve: tuple[float, float] = (0.0, 0.0)
    base: float = 0.0
    _scores: _Scores | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_scores": None}

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, int, int, float]]]:
        """Number of words, and the maximal segments as words and characters ``begin, stop`` and score."""
        if self._scores is None:
            self._scores = _Scores(self.odds)
        table = self._scores
        words = _WORD.findall(text.lower())
        scores = np.array([table[w] for w in words])
        return len(words), maximal_segments(scores)

    def surprise(self, words: int, score: float) -> float:
        """Minus the logarithm of how many such segments a clean text of that length has."""
        return self.rate * score - math.log(self.scale * max(words, 1))

    def evidence(self, words: int, scores: list[float]) -> float:
        """Minus the logarithm of the chance of the best segments together, for the number of them that surprises most.

        The tail of Karlin and Altschul's sum of the ``r`` best, with the chance of each further one halved for
        trying several ``r``; one segment alone counts as in ``surprise``.
        """
        total, most = 0.0, -math.inf
        for r, score in enumerate(sorted(scores, reverse=True), 1):
            total += self.surprise(words, score)
            if r == 1:
                most = total
            elif total > r - 1:
                most = max(most, total - (r - 1) * math.log(2 * total) + math.lgamma(r + 1) + math.lgamma(r))
        return most

    def probability(self, evidence: float) -> float:
        x = self.curve[0] + self.curve[1] * evidence
        return 1 / (1 + math.exp(-min(max(x, -500), 500)))

    def judge(self, text: str | None) -> tuple[float, list[dict]]:
        words, found = self.segments(text or "")
        significant = []
        for begin, stop, score in found:
            expected = math.exp(-self.surprise(words, score))
            if expected <= SIGNIFICANT:
                significant.append({"begin": begin, "stop": stop, "score": score, "expected": expected})
        return self.probability(self.evidence(words, [s for _, _, s in found]) if found else self.base), significant


def _feature_counts(sample: DataFrame, wanted: dict | None) -> DataFrame:
    """Occurrences and documents of every feature, or of the wanted ones."""
    shared = sample.sparkSession.sparkContext.broadcast(wanted)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            n, docs, words = Counter(), Counter(), 0
            for text in pdf["text"]:
                own: Counter = Counter()
                for word, k in Counter(_WORD.findall(text.lower())).items():
                    words += k
                    for f in features(word):
                        if shared.value is None or f in shared.value:
                            own[f] += k
                n.update(own)
                docs.update(own.keys())
            yield pd.DataFrame({"feature": list(n), "n": list(n.values()), "docs": [docs[f] for f in n]})
            yield pd.DataFrame({"feature": [""], "n": [words], "docs": [len(pdf)]})

    rows = sample.select("text").mapInPandas(count, "feature string, n long, docs long")
    return rows.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _log_odds(sample: DataFrame) -> dict[str, float]:
    toxic = _feature_counts(sample.where("toxic = 1"), None).where(
        (F.col("docs") >= LEAST_DOCUMENTS) | (F.col("feature") == "")
    ).toPandas().set_index("feature")["n"].to_dict()
    if toxic.get("", 0) == 0:
        return {}
    clean = _feature_counts(sample.where("toxic = 0"), toxic).toPandas().set_index("feature")["n"].to_dict()
    weight = toxic[""] / max(clean.get("", 0), 1)
    share: dict[str, float] = {}
    for f in sorted((f for f in toxic if f), key=lambda f: (len(f.rstrip("*")), not f.endswith("*"))):
        stem = f[:-1] if f.endswith("*") else f
        shorter = [f"{stem[:k]}*" for k in PREFIX_LENGTHS if k < len(stem)]
        prior = share.get(shorter[-1], 0.5) if shorter else 0.5
        a, b = toxic[f], clean.get(f, 0) * weight
        share[f] = (a + PRIOR_STRENGTH * prior) / (a + b + PRIOR_STRENGTH)
    return {f: math.log(q / (1 - q)) if q < 1 else HIGHEST for f, q in share.items()}


def _positive_root(scores: np.ndarray) -> float:
    """The rate at which the mean of ``exp(rate * score)`` is 1; scores have a negative mean."""
    low, high = 0.0, 1.0
    grows = lambda x: np.mean(np.exp(np.minimum(x * scores, 500))) > 1
    if not (scores > 0).any() or scores.mean() >= 0:
        return 1.0
    while not grows(high):
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if grows(middle) else (middle, high)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic curve by Newton steps, with a weak pull of the slope to 0."""
    center, spread = x.mean(), max(x.std(), 1e-9)
    design = np.column_stack([np.ones(len(x)), (x - center) / spread])
    beta = np.zeros(2)
    ridge = np.diag([1e-6, 1e-3 * weight.sum()])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] - beta[1] * center / spread), float(beta[1] / spread)


def fit(docs: DataFrame, labels: DataFrame, fold: str, doc_id: str = "doc_id", text: str = "text",
        toxic: str = "toxic") -> Model:
    """Fit on labelled documents; of those, rows with ``fold`` true calibrate, the others give word scores.

    Both samples are bounded per label (``WORD_ROWS``, ``CALIBRATION_ROWS``) and chosen by the hash of
    the id. Of several labels of one id the highest counts; null labels and texts are left out.
    Without toxic or without clean rows all texts score the share of toxic rows.
    """
    known = labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(F.when(F.col(toxic) > 0, 1).otherwise(0)).alias("toxic"))
    known = known.withColumn("calibrates", F.expr(fold))
    counts = {(r.calibrates, r.toxic): r["count"] for r in known.groupBy("calibrates", "toxic").count().collect()}
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null")

    def sample(calibrates: bool, rows: int) -> DataFrame:
        chosen = sample_per_label(known.where(F.col("calibrates") == calibrates).select("id", "toxic"), "toxic", "id", rows)
        return texts.join(F.broadcast(chosen), "id")

    model = Model(_log_odds(sample(False, WORD_ROWS)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for toxic, text in zip(pdf["toxic"], pdf["text"]):
                words, found = shared.value.segments(text)
                table = shared.value._scores
                kinds = Counter(round(table[w], 2) for w in _WORD.findall(text.lower())) if not toxic else {}
                rows.append((toxic, words, [s for _, _, s in found], list(kinds), list(kinds.values())))
            yield pd.DataFrame(rows, columns=["toxic", "words", "scores", "kinds", "times"])

    schema = "toxic int, words long, scores array<double>, kinds array<double>, times array<long>"
    seen = sample(True, CALIBRATION_ROWS).select("toxic", "text").mapInPandas(search, schema).toPandas()
    seen["best"] = [max(s, default=0.0) for s in seen["scores"]]
    total = counts.get((True, 0), 0) + counts.get((True, 1), 0)
    share = (counts.get((True, 1), 0) + 0.5) / (total + 1)
    model.curve = (math.log(share / (1 - share)), 0.0)
    clean, bad = seen[seen["toxic"] == 0], seen[seen["toxic"] == 1]
    if clean.empty or bad.empty or not model.odds:
        return model
    times: Counter = Counter()
    for kinds, n in zip(clean["kinds"], clean["times"]):
        for k, m in zip(kinds, n):
            times[k] += m
    if times:
        values = np.array(list(times))
        model.rate = _positive_root(np.repeat(values, np.maximum(1, np.array(list(times.values())) * 10_000 // sum(times.values()))))
    found = clean[clean["best"] > 0]
    if len(found):
        tail = found["words"].clip(lower=1) * np.exp(-model.rate * found["best"])
        model.scale = float(1 / max(tail.mean(), 1e-300))
    evidence = np.array([model.evidence(w, list(s)) if len(s) else np.nan for w, s in zip(seen["words"], seen["scores"])])
    model.base = float(np.nanmin(evidence)) if not np.isnan(evidence).all() else 0.0
    evidence = np.where(np.isnan(evidence), model.base, evidence)
    is_toxic = seen["toxic"].to_numpy(float)
    weight = np.where(is_toxic == 1, counts[(True, 1)] / len(bad), counts[(True, 0)] / len(clean))
    model.curve = _logistic(evidence, is_toxic, weight)
    return model


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``toxicity``: struct of ``score`` (0 to 1) and ``segments``, the significant passages.

    A segment has its first word and the word after its last (counted from 0), its score, and how
    many segments as good a clean text of that length has. Null and empty texts have no segment and the lowest score. Repeated
    rows get equal results; an empty table stays empty; further columns pass through, except
    that ``toxicity`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "score double, segments array<struct<begin:long,stop:long,score:double,expected:double>>"

    @F.pandas_udf(kind)
    def judge(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.judge(t) for t in texts]
        return pd.DataFrame({"score": [s for s, _ in found], "segments": [x for _, x in found]})

    return docs.withColumn("toxicity", judge(F.col(text)))
