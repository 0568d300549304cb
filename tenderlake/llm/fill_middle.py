"""Fill-in-the-middle rearrangement with a learned rank index over the boundaries of a text.

A text is cut into lines. The offsets of all boundaries between lines rise with their rank, so a
text carries a rank index: straight segments that predict the offset of a boundary from its rank with a
bounded error, and the residual of every boundary as a small integer. A cut after ``r`` lines is
looked up by finding the segment of ``r``, predicting, and adding the stored residual, which gives the exact
offset. Prefix and middle end at two such cuts, chosen by hashes of the document's id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Largest error of a prediction, in code points; residuals then fit one byte.
ERROR = 100
RATE = 100
SPM_RATE = 50
_NEWLINE = 10
_SHAPE = (
    "n long, form string, prefix_chars long, middle_chars long, output string, "
    "index struct<ranks: array<long>, offsets: array<long>, slopes: array<double>, residuals: binary>"
)


@dataclass
class RankIndex:
    """Offsets of boundaries by rank: segment starts, slopes, and one residual per boundary."""

    ranks: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    @classmethod
    def fit(cls, values: np.ndarray, error: int = ERROR) -> RankIndex:
        """Segments, each as long as one line through its first point can stay within ``error`` (at most 120).

        The slopes that keep the points seen so far within the error form an interval; it
        narrows from point to point, and the segment ends before the point that would empty it.
        """
        ranks, offsets, slopes = [], [], []
        n, at = len(values), 0
        while at < n:
            low, high, stop, span = -np.inf, np.inf, at + 1, 16
            while stop < n:
                x = np.arange(stop - at, min(stop + span, n) - at, dtype=np.float64)
                y = (values[stop : stop + len(x)] - values[at]).astype(np.float64)
                lows = np.maximum(np.maximum.accumulate((y - error) / x), low)
                highs = np.minimum(np.minimum.accumulate((y + error) / x), high)
                fits = int(np.count_nonzero(lows <= highs))  # once empty, the interval stays empty
                if fits:
                    low, high, stop = float(lows[fits - 1]), float(highs[fits - 1]), stop + fits
                if fits < len(x):
                    break
                span *= 2
            ranks.append(at)
            offsets.append(int(values[at]))
            slopes.append((low + high) / 2 if stop > at + 1 else 0.0)
            at = stop
        found = cls(np.array(ranks, np.int64), np.array(offsets, np.int64), np.array(slopes, np.float64), np.empty(0, np.int8))
        found.residuals = (values - found.predict(np.arange(n))).astype(np.int8)
        return found

    def predict(self, rank: np.ndarray) -> np.ndarray:
        """Predicted offsets; off by at most the error the segments were fitted with, plus rounding."""
        segment = np.searchsorted(self.ranks, rank, side="right") - 1
        return self.offsets[segment] + np.rint(self.slopes[segment] * (rank - self.ranks[segment])).astype(np.int64)

    def offset(self, rank: int) -> int:
        """The exact offset of a boundary."""
        return int(self.predict(np.array([rank]))[0]) + int(self.residuals[rank])


def boundaries(text: str) -> np.ndarray:
    """Offsets, in code points, of the beginning and of the end of every line ``[^\\n]*\\n|[^\\n]+``."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == _NEWLINE) + 1
    last = [len(text)] if text and (not len(ends) or ends[-1] < len(text)) else []
    return np.concatenate([[0], ends, last]).astype(np.int64)


def choices(doc_id: int | None) -> list[int]:
    """Four unsigned 32-bit numbers that depend on the id only; a null id counts as empty."""
    key = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def rearrange(text: str, doc_id: int | None, rate: int, spm_rate: int) -> tuple:
    """``n, form, prefix_chars, middle_chars, output, index`` of one text."""
    at = boundaries(text)
    n = len(at) - 1
    index = RankIndex.fit(at)
    stored = (index.ranks, index.offsets, index.slopes, index.residuals.tobytes())
    h1, h2, h3, h4 = choices(doc_id)
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= rate:
        return n, "plain", None, None, text, stored
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = index.offset(first), index.offset(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", stored
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", stored


def fill_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Every row with one column more, ``fim``: ``n, form, prefix_chars, middle_chars, output, index``.

    ``form`` is plain for an empty text, a text that holds a mark, and for ``100 - rate`` percent of the ids;
    lengths are null there and the output is the text. Null counts as empty. A column named ``fim``
    is replaced; all others pass, whatever their names. Rows are treated alone, so repeated
    rows give equal results, texts of any length are handled whole, and an empty table gives an empty result.
    """

    def compute(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for key, value in zip(ids, texts):
            n, form, a, b, output, stored = rearrange(value or "", None if pd.isna(key) else int(key), rate, spm_rate)
            rows.append((n, form, a, b, output, dict(zip(("ranks", "offsets", "slopes", "residuals"), stored))))
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output", "index"])
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    made = F.pandas_udf(compute, _SHAPE)
    # a decimal id as text keeps ids beyond 2^53 exact where some are null
    return docs.withColumn("fim", made(F.col(doc_id).cast("long").cast("string"), F.col(text)))


def _restored(output: str, form: str) -> str:
    if form == "plain":
        return output
    head, tail = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, rest = output[len(head) :].split(tail, 1)
    two, middle = rest.split(MIDDLE, 1)
    return one + middle + two if form == "psm" else two + middle + one


def restore(rows: DataFrame, output: str = "fim.output", form: str = "fim.form") -> DataFrame:
    """Add ``restored``: the text rebuilt from the output and its form alone. Nulls give null.

    A rearranged text holds no mark, so the first occurrence of each is the one that was put in.
    """

    @F.pandas_udf("string")
    def rebuild(outputs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for output, kind in outputs:
            yield pd.Series([None if o is None or k is None else _restored(o, k) for o, k in zip(output, kind)], dtype=object)

    return rows.withColumn("restored", rebuild(F.col(output), F.col(form)))
