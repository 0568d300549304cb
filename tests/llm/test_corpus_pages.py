"""Main text, URL judgements and archives."""

import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenderlake.llm import html_wrappers as H
from tenderlake.llm import url_templates as U
from tenderlake.llm import warc


def plain(source):
    return H.main_text(source, None, [], 0)


@pytest.mark.parametrize(("source", "want"), [
    (None, ""), ("", ""), ("just words", "just words"), ("<p>a<p>b<br>c", "a\n\nb c"),
    ("<article><h1>T &amp; x</h1><p>One\n <b>t</b>wo<script>var p='</p>'</script> &eacute;&#33;</article><footer>f</footer>", "T & x\n\nOne two é!"),
    ("<nav>n</nav><header>h</header><main><p>a</p><aside>s</aside><div class='comments'>c</div></main>", "a"),
    ("<article><p>a</p><section id=comments><article class=comment>zz</article></section></article>", "a"),
    ("<body><div class='cookie-notice'>ok?</div><form><p>f</p></form><div>text<p hidden>h</p></div>", "text"),
    ("<div>body text here</div><div><a>l1</a> <a>l2</a></div>", "body text here"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\n\nb\n\nc d\n\ne"),
    ("<article><p>cut <b>off", "cut off"), ("<p title='x>y'>a</p><!-- <p>no</p> -->b", "a\n\nb"), ("<article><p>x < y &am</p>", "x < y &am"),
])
def test_main_text(source, want):
    assert plain(source) == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/ab p\"'=!-&;#1", max_size=60))
def test_any_source_is_read(source):
    assert isinstance(plain(source), str)


def test_trees_align_by_simple_matching():
    a, b = H.Page("<div><h1>x</h1><p>y</p></div><ul><li>z</ul>"), H.Page("<div><p>y</p></div><section>q</section><ul><li>z</ul>")
    to = H.align(a.skeleton(), b.skeleton())
    names = {a.labels[i]: b.labels[j] for i, j in enumerate(to) if j >= 0}
    assert names == {"": "", "div": "div", "p": "p", "ul": "ul", "li": "li"}
    assert to[a.labels.index("h1")] == -1


def test_wrapper_finds_template_and_slots(spark):
    page = "<div class=x><p>{}</p><h5>Subscribe now</h5></div><section><h4>Write to us</h4></section>"
    rows = [(i, f"http://h.org/{i}", page.format(f"story number {i} " * 9), "old") for i in range(6)]
    rows += [(7, "http://h.org/7", None, ""), (8, None, "<p>alone</p>", ""), (9, "http://one.org/", page.format("single"), ""),
             (10, "http://h.org/0", page.format("story number 0 " * 9), "")]
    rows += [(20 + i, "http://copies.org/", "<article><p>the same article</p></article>", "") for i in range(5)]
    found = H.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    got = {r.page_id: r.text for r in found.collect()}
    assert all(got[i] == " ".join([f"story number {i}"] * 9) for i in range(6))
    assert got[7] == "" and got[8] == "alone" and got[10] == got[0]
    assert got[9] == "single\n\nSubscribe now\n\nWrite to us"  # one page shows no template
    assert got[20] == got[24] == "the same article"
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert H.extract_main_text(none).count() == 0


@pytest.mark.parametrize(("source", "want"), [
    ("<div class='layout has-sidebar'><article><p>a</p></article></div>", "a"), ("<article class='post comments-open'><p>a</p></article>", "a"),
    ("<div class=sidebar><article><p>a</p></article></div>", "a"), ("<form id=page><main><p>a</p></main></form>", "a"),
    ("<div class=widget><p>a</p></div>", "a"), ("<div><p>one two</p><p><a>linked</a></p></div>", "one two\n\nlinked"),
])
def test_names_never_drop_an_article(source, want):
    assert plain(source) == want


def test_the_aligned_tree_chooses(spark):
    words = lambda i: " ".join(f"word{i}x{k}" for k in range(30))
    rows = [(i, "http://a.org/", f"<article><h1>t{i}</h1><p>{words(i)}</p><p>Read our paper</p><p>{words(i + 50)}</p></article>") for i in range(6)]
    rows += [(10 + i, "http://b.org/", f"<article><h1>title {i}</h1><p>{words(0)}</p></article>") for i in range(4)]
    rows += [(20 + i, "http://c.org/", f"<article><p>teaser</p></article><div class=text><h2>t{i}</h2><p>{words(i)}</p></div>") for i in range(6)]
    rows += [(30 + i, "http://c.org/", f"<table class=y><tr><td>menu</table><section><section class=z><p>{words(i + 9)}</p></section></section>") for i in range(5)]
    got = {r.page_id: r.text for r in H.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"t{i}\n\n{words(i)}\n\n{words(i + 50)}" for i in range(6))  # a constant among varying siblings
    assert all(got[10 + i] == f"title {i}\n\n{words(0)}" for i in range(4))  # copies under other titles
    assert all(got[20 + i] == f"t{i}\n\n{words(i)}" for i in range(6))  # the slots, not the tag
    assert all(got[30 + i] == words(i + 9) for i in range(5))  # a second wrapper of the host


def test_a_very_long_page(spark):
    body = "".join(f"<p>paragraph {i}" for i in range(20_000))
    assert plain(f"<article>{body}</article>").count("\n\n") == 19_999


def judged(spark, urls, **more):
    rows = [(i, u, "keep", "old") for i, u in enumerate(urls)]
    found = U.judge_urls(spark.createDataFrame(rows, "page_id long, url string, first string, verdict string"), **more)
    return {r.page_id: r for r in found.collect()}


def test_rules_hosts_and_paths(spark):
    urls = ["HTTP://A.Example.NET/en/x", "http://example.net", "http://xexample.net/de/", "http://a.example.com/de/1?q=/x", "http://example.com/De/1",
            "https://w.org/fr/#a", "no scheme", None, "http://org?/fr/", "http://example.net#x/en/", "http://example.net/en/"]
    got = judged(spark, urls)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "", None, "allow"), ("xexample.net", "/de/", "net/", "block"),
        ("a.example.com", "/de/1", "example.com/de/", "block"), ("example.com", "/De/1", None, "allow"), ("w.org", "/fr/", "org/fr/", "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("org", "", None, "allow"), ("example.net", "", None, "allow"), ("example.net", "/en/", "example.net/en/", "allow"),
    ]


def test_labelled_templates_carry_over_and_unlabelled_ones_do_not(spark):
    users = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]
    urls = [f"http://h.io/u/{u}/shop/{i}" for i, u in enumerate(users)] + [f"http://h.io/u/{u}/about" for u in users]
    rules = {f"h.io/u/{u}/shop": "block" for u in users[:50]} | {f"h.io/u/{u}/about": "allow" for u in users[:50]}
    got = judged(spark, urls, rules=rules)
    assert {got[i].template for i in range(60)} == {"/u/*/shop/#"} and {got[i].template for i in range(60, 120)} == {"/u/*/about"}
    assert {got[i].verdict for i in range(60)} == {"block"} and {got[i].verdict for i in range(60, 120)} == {"allow"}
    assert [got[i].rule is None for i in (49, 50)] == [False, True]
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_purity_by_hand(spark):
    urls = [f"http://q.io/a/{i}" for i in range(10)] + [f"http://q.io/b/{i}" for i in range(3)]
    rules = {f"q.io/a/{i}": "block" for i in (2, 3, 4)}
    got = judged(spark, urls, rules=rules)
    want = (3 + 4 * 0.1) / (3 + 0.1 * 7 + 4)
    assert got[0].purity == pytest.approx(want) and got[0].verdict == "allow"
    assert got[12].purity == pytest.approx((4 * 0.1) / (0.1 * 3 + 4))


def test_branches_merge_under_every_parent(spark):
    kinds = {"red": range(100), "blue": range(65), "green": range(30)}
    urls = [f"http://h.io/shop/{c}/{i}" for c, n in kinds.items() for i in n]
    rules = {f"h.io/shop/red/{i}": "block" for i in range(100)} | {f"h.io/shop/blue/{i}": "block" for i in (50, 51, 52, 53, 54)} | {"h.io/shop/green": "allow"}
    got = judged(spark, urls, rules=rules)
    named = sum(any(u[len("http://"):].startswith(r) for r in rules if "blue" in r) for u in urls)
    assert [u for u in urls if "/red/" in u and "h.io/shop/red/" + u.rsplit("/", 1)[1] not in rules] == []
    want = (100 + named + 4 * 0.1) / (100 + named + 0.1 * (65 - named) + 4)
    assert got[0].purity == pytest.approx(want) and got[160].purity == pytest.approx(want)
    assert got[160].rule is None and {got[i].verdict for i in range(165)} == {"block"}
    assert {got[i].verdict for i in range(165, 195)} == {"allow"} and got[170].purity == pytest.approx(0.4 / 34)


def test_variable_segments_nested_at_any_depth(spark):
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(30)]
    urls = ["http://n.io/a/" + "/".join(f"{level}{n}" for level in "uvwxy") + "/end" for n in names]
    assert {r.template for r in judged(spark, urls).values()} == {"/a/*/*/*/*/*/end"}


def test_archives_round_trip(spark, rows):
    nasty = "a WARC/1.1\r\nb\r\n\r\nWARC/1.1\r\n é \r\n"
    data = [(1, "http://a/?q#f", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, None, None), (4, "x\ny", ""), (5, "http://c", nasty),
            (6, "http://c", nasty), (6, "http://c", nasty), (None, "http://d", nasty), (None, "http://e", "one"), (8, "http://long", "L" * 300_000)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    captures = warc.round_trip(pages).collect()
    largest = {}
    for i, _, h in data:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in data:
        raw, owner = (h or "").encode(), largest[h or ""]
        response = owner in (i, -1)
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if response else "revisit", None if response else owner))
    got = [(r.metadata.page_id, r.response.payload_bytes if r.type == "response" else r.original.payload_bytes,
            r.response.payload_digest, r.type, r.original.page_id if r.original else None) for r in captures]
    assert sorted(map(str, got)) == sorted(map(str, want))
    first = next(r for r in captures if r.metadata.page_id == 2)
    assert bytes(first.response.payload).decode() == "<p>é</p>" and first.response.http.startswith("HTTP/1.1 200 OK")
    assert first.request.http.startswith("GET / HTTP/1.1") and first.target_uri == "http://b/"
    assert next(r for r in captures if r.metadata.page_id == 4).target_uri == "x%0Ay"


def test_small_payloads_and_no_pages(spark):
    data = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbb"), (4, "u", "bbb")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r.metadata.page_id: r.type for r in warc.round_trip(pages, least_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_payloads_that_nobody_asks_for_are_not_joined(spark):
    data = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbb")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    asked = warc.round_trip(pages).select(
        "metadata.page_id", "type", "response.payload_digest", F.coalesce("response.payload_bytes", "original.payload_bytes").alias("n"), F.col("original.page_id").alias("first")
    )
    scans = [line for line in asked._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    captures = [line.split("DataFilters")[0] for line in scans if "revisit" in line]
    assert captures and not any("payload#" in line or "http#" in line for line in captures)
    got = {r.page_id: (r.type, r.n, r.first) for r in asked.collect()}
    assert got == {1: ("revisit", 2, 2), 2: ("response", 2, None), 3: ("response", 3, None)}
