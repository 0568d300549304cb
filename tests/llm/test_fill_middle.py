"""Fill-in-the-middle against a rearrangement by hand, and the rank index against the offsets."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tenderlake.llm import fill_middle as M


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 900), max_size=400), st.sampled_from([0, 1, 7, 100]))
def test_rank_index_gives_every_offset(steps, error):
    values = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)]).astype(np.int64)
    index = M.RankIndex.fit(values, error)
    assert [index.offset(r) for r in range(len(values))] == values.tolist()
    assert np.abs(index.residuals.astype(int)).max() <= error + 1
    assert index.ranks[0] == 0 and (np.diff(index.ranks) > 0).all()


def test_even_lines_need_one_segment():
    assert len(M.RankIndex.fit(np.arange(0, 5_000_000, 50)).ranks) == 1


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab\n<PSM>é😀\r", max_size=60))
def test_boundaries_are_those_of_the_pattern(text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert M.boundaries(text).tolist() == np.cumsum([0] + [len(u) for u in units]).tolist()


def by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "\n", "one line", "a\nb\nc\n", "a\r\n\r\nb", "x <P> y", "<S", "S><M", "é😀\n" * 50, "lang\n" * 40_000 + "end", "<" * 7 + "\n" + ">" * 9, " "]


def test_rows_equal_the_rearrangement_by_hand(spark):
    rows = [(i, t, "old") for i, t in enumerate(TEXTS * 3)] + [(None, "no id\nat all", "old"), (1 << 60, "big\nid\nhere", "old"), (3, "one line", "old")]
    table = spark.createDataFrame(rows, "doc_id long, text string, fim string")
    made = M.restore(M.fill_middle(table)).select("doc_id", "text", "fim", "restored").collect()
    assert len(made) == len(rows) and {"spm", "psm", "plain"} == {r.fim.form for r in made}
    for r in made:
        assert (r.fim.n, r.fim.form, r.fim.prefix_chars, r.fim.middle_chars, r.fim.output) == by_hand(r.doc_id, r.text)
        assert r.restored == (r.text or "")


def test_rates_and_empty_tables(spark):
    table = spark.createDataFrame([(i, "a\nb\nc") for i in range(200)], "doc_id int, text string")
    forms = [r[0] for r in M.fill_middle(table, rate=30, spm_rate=100).select("fim.form").collect()]
    assert set(forms) == {"plain", "spm"} and 30 < forms.count("spm") < 90
    assert M.restore(M.fill_middle(table.limit(0))).count() == 0
    nulls = spark.createDataFrame([(None, None), ("x", None)], "output string, form string")
    assert [r.restored for r in M.restore(nulls, "output", "form").collect()] == [None, None]
