"""Main-text extraction by wrapper induction.

A page is read as a tree of its block elements in which equally labelled siblings are one node (a
repeated pattern). The trees of a host fall into clusters: the commonest is a wrapper, what simple tree
matching aligns with it well belongs to it, and the commonest of the rest is the next wrapper. A text that
a wrapper's node has on nearly all different pages is template, all others fill slots, each sibling for
itself; the smallest subtree with nearly all slot text is the content root. On each page the content is
what the aligned root holds without the template; an article or main element only helps to find the root.
What elements say of themselves (navigation, forms, adverts, ...) is left out, but nothing around an article is.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.columns import named
from tenderlake.llm.graph import whole_row
from tenderlake.llm.url_templates import host_and_path
from tenderlake.session import staged

#: A node is template when it has text on this many different pages and this share of them agree.
LEAST_PAGES = 3
SAME_SHARE = 0.9
#: The content root holds this share of the slot text, or this one if it is an article or main element.
ROOT_SHARE = 0.8
NAMED_SHARE = 0.3
#: Trees with a larger share of aligned nodes share a wrapper; after so many wrappers of a host, equal trees do.
ALIKE = 0.5
MOST_WRAPPERS = 16
#: Outside a named article, a block with a larger share of linked characters is no content, unless it is a paragraph or heading.
LINK_SHARE = 0.5

# Element names of HTML, and the names that pages give to what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes template svg select object".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCKS - {"body", "html", "head", "tbody", "tfoot", "thead", "tr"}
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl article section main body div td th".split())
#: Elements that hold a text, not an article.
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup pre blockquote ul ol li dl dt dd figure figcaption table thead tbody tfoot tr address details summary".split())
FLOWING = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote dt dd figcaption summary".split())
NO_CONTENT = frozenset("head nav footer aside button dialog menu label fieldset datalist canvas audio video".split())
NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar form".split())
NO_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice popup modal overlay newsletter subscribe subscription sidebar sidenav widget widgets menu nav navbar navigation"
    " breadcrumb breadcrumbs footer masthead topbar comment comments disqus reply replies respond share sharing social"
    " related recommended recommendations pagination pager toolbar login signin signup".split()
)

SIDES = frozenset("left right top bottom".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|([^>]*)(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Blocks of text of a page, and its tree of labelled block elements (parents before children)."""

    def __init__(self, source: str) -> None:
        self.labels: list[str] = []
        self.parents: list[int] = []
        #: (tree node, text, linked characters, inside an article or main element), without dropped blocks
        self.blocks: list[tuple[int, str, int, bool]] = []
        self._children: dict[tuple[int, str], int] = {}
        # elements whose names say that they are no content: the one around, and whether that holds
        self._named: list[tuple[int, bool]] = []
        self._found: list[tuple[int, str, int, bool, int]] = []
        # open elements: name, tree node, dropped, inside a link, inside an article or main element, innermost named one
        self._open: list[tuple[str, int, bool, bool, bool, int]] = [("", self._node(-1, ""), False, False, False, -1)]
        self._text: list[str] = []
        self._linked = 0
        self._read(source)
        out: list[bool] = []
        for around, holds in self._named:
            out.append(holds or (around >= 0 and out[around]))
        self.blocks = [b[:4] for b in self._found if b[4] < 0 or not out[b[4]]] or [b[:4] for b in self._found if self._only(b[4])]

    def _only(self, named: int) -> bool:
        """On a page without other text, the text of named elements that are not in another one."""
        return named < 0 or self._named[named][0] < 0

    def _node(self, parent: int, label: str) -> int:
        node = self._children.setdefault((parent, label), len(self.labels))
        if node == len(self.labels):
            self.labels.append(label)
            self.parents.append(parent)
        return node

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                _, node, _, _, article, named = self._open[-1]
                self._found.append((node, text, self._linked, article, named))
            self._text, self._linked = [], 0

    def _say(self, text: str) -> None:
        _, _, dropped, linked, *_ = self._open[-1]
        if text and not dropped:
            if "&" in text:
                text = entities.unescape(text)
            self._text.append(text)
            if linked:
                self._linked += len("".join(text.split()))

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            tag = _TAG.search(source, at)
            if tag is None:
                self._say(source[at:])
                break
            if tag.start() > at:
                self._say(source[at : tag.start()])
            at = tag.end()
            name = tag[2]
            if name is None:
                continue
            name = name.lower()
            if tag[1]:
                self._close(name)
                continue
            rest = tag[3] if tag[3] is not None else tag[4] or ""
            if name in RAW:
                if not rest.endswith("/") or name not in ("svg", "object"):
                    stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                    at = stop.end() if stop else end
                continue
            self._start(name, rest)
        self._flush()

    def _start(self, name: str, rest: str) -> None:
        if name in ("br", "td", "th", "img"):
            self._say(" ")
        if name in CLOSES_P and any(e[0] == "p" for e in self._open[-6:]):
            self._close("p")
        if name in SAME_KIND:
            for i in range(len(self._open) - 1, 0, -1):
                if self._open[i][0] in SAME_KIND[name]:
                    self._close(self._open[i][0])
                    break
                if self._open[i][0] in SCOPES:
                    break
        if name in VOID:
            if name == "hr":
                self._flush()
            return
        _, node, dropped, linked, article, named = self._open[-1]
        names, label = self._attributes(name, rest) if rest.strip(" /\n\t\r") else (frozenset(), name)
        if name in BLOCKS:
            self._flush()
        if name in NO_CONTENT or "__hidden" in names or (name == "header" and not article):
            dropped = True
        is_article = name in ("article", "main") or "__article" in names or "__main" in names
        if name == "article" and names & {"comment", "comments", "reply"}:
            is_article = False
        spoken = "__named" in names and name not in ("html", "body") and not is_article
        if spoken or name == "form" or (not article and names == {"header"} and name not in ("html", "body") and not is_article):
            self._named.append((named, True))
            named = len(self._named) - 1
        if is_article and not dropped and not article:
            around = named
            while around >= 0 and self._named[around][1]:
                self._named[around] = (self._named[around][0], False)
                around = self._named[around][0]
        if name in BLOCKS:
            node = self._node(node, label)
        self._open.append((name, node, dropped, linked or name == "a", article or (is_article and not dropped), named))

    @staticmethod
    def _attributes(name: str, rest: str) -> tuple[frozenset, str]:
        names: set[str] = set()
        classes = ""
        for key, a, b, c in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), (a or b or c)
            if key in ("class", "id"):
                value = entities.unescape(value).lower()
                for part in value.split():
                    words = set(_NAME.findall(part))
                    names |= {part} if part in ("header", "comment", "comments", "reply") else {"__other"}
                    if words & NO_CONTENT_NAMES and all(w in NO_CONTENT_NAMES or w in SIDES or w.isdigit() for w in words):
                        names.add("__named")
                if key == "class":
                    classes = ".".join(sorted(re.sub(r"[0-9]+", "#", v) for v in value.split()))
            elif key == "role":
                value = value.lower().strip()
                if value in NO_CONTENT_ROLES:
                    names.add("__hidden")
                elif value in ("main", "article"):
                    names.add(f"__{value}")
            elif key == "itemprop" and value.lower() == "articlebody":
                names.add("__article")
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
                names.add("__hidden")
        return frozenset(names), re.sub(r"[()|]", "", f"{name}.{classes}" if classes else name)

    def _close(self, name: str) -> None:
        if name == "p" and not any(e[0] == "p" for e in self._open):
            return
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == name:
                if name in BLOCKS or any(e[0] in BLOCKS for e in self._open[i:]):
                    self._flush()
                del self._open[i:]
                return
            if self._open[i][0] in SCOPES and name in ("p", "li", "a", "b", "i", "span", "em", "strong"):
                return

    def skeleton(self) -> str:
        """The tree as text: label and parent of every node."""
        return "|".join(f"{label}({parent}" for label, parent in zip(self.labels, self.parents))


@lru_cache(maxsize=4096)
def _tree(skeleton: str) -> tuple[list[str], list[list[int]]]:
    labels, children = [], []
    for i, part in enumerate(skeleton.split("|")):
        label, _, parent = part.rpartition("(")
        labels.append(label)
        children.append([])
        if int(parent) >= 0:
            children[int(parent)].append(i)
    return labels, children


@lru_cache(maxsize=4096)
def align(skeleton: str, wrapper: str) -> tuple[int, ...]:
    """For every node of a tree the wrapper's node, or -1, by simple tree matching: the ordered
    matching of children with the most equally labelled nodes below equally labelled parents."""
    labels, below = _tree(skeleton)
    other, beside = _tree(wrapper)
    sizes: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[list[int]]] = {}
    todo = [(0, 0, False)]
    while todo:
        a, b, ready = todo.pop()
        if labels[a] != other[b]:
            sizes[a, b] = 0
            continue
        if not ready:
            todo.append((a, b, True))
            todo.extend((x, y, False) for x in below[a] for y in beside[b])
            continue
        table = [[0] * (len(beside[b]) + 1)]
        for x in below[a]:
            row = [0]
            for j, y in enumerate(beside[b]):
                row.append(max(row[j], table[-1][j + 1], table[-1][j] + sizes[x, y]))
            table.append(row)
        tables[a, b] = table
        sizes[a, b] = table[-1][-1] + 1
    found = [-1] * len(labels)
    pairs = [(0, 0)] if sizes[0, 0] else []
    while pairs:
        a, b = pairs.pop()
        found[a] = b
        table, i, j = tables[a, b], len(below[a]), len(beside[b])
        while i and j:
            x, y = below[a][i - 1], beside[b][j - 1]
            if sizes[x, y] and table[i][j] == table[i - 1][j - 1] + sizes[x, y]:
                pairs.append((x, y))
                i, j = i - 1, j - 1
            elif table[i][j] == table[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return tuple(found)


def likeness(skeleton: str, wrapper: str) -> float:
    """Share of aligned nodes among the nodes of both trees."""
    to = align(skeleton, wrapper)
    return 2 * sum(t >= 0 for t in to) / (len(to) + len(_tree(wrapper)[0]))


def content_root(wrapper: str, mass: dict[int, float]) -> int:
    """The lowest wrapper node that can hold an article and has nearly all the slot text, but none below a named article."""
    labels, children = _tree(wrapper)
    total = [0.0] * len(children)
    for node in range(len(children) - 1, -1, -1):
        total[node] = mass.get(node, 0.0) + sum(total[c] for c in children[node])
    kinds = [label.partition(".")[0] for label in labels]
    for kind in ("article", "main"):
        best = max((n for n in range(len(kinds)) if kinds[n] == kind), key=lambda n: total[n], default=0)
        if best and total[best] and total[best] >= NAMED_SHARE * total[0]:
            return best
    node = 0
    while below := [c for c in children[node] if kinds[c] not in TEXTS]:
        best = max(below, key=lambda c: total[c])
        if total[best] < ROOT_SHARE * total[0] or not total[best]:
            break
        node = best
    return node


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def main_text(source: str | None, wrapper: str | None, template: list[tuple[int, int]], root: int) -> str:
    """The blocks of a page that are content, joined by an empty line; without a wrapper the page is its own."""
    page = Page(source or "")
    skeleton = page.skeleton()
    to = align(skeleton, wrapper) if wrapper else tuple(range(len(page.labels)))

    def below(top: int, places: tuple[int, ...]) -> list[tuple[int, str, int, bool]]:
        inside = [False] * len(places)
        for node, parent in enumerate(page.parents):
            inside[node] = places[node] == top or (parent >= 0 and inside[parent])
        return [b for b in page.blocks if inside[b[0]]]

    kept = below(root, to) if wrapper else []
    if not kept:
        mass: dict[int, float] = {}
        for node, text, *_ in page.blocks:
            mass[node] = mass.get(node, 0.0) + len(text)
        kept = below(content_root(skeleton, mass), tuple(range(len(to))))
    if wrapper and template:
        constant = set(template)
        kept = [b for b in kept if (to[b[0]], _digest(b[1])) not in constant] or kept
    size: dict[int, int] = {}
    links: dict[int, int] = {}
    for node, text, linked, _ in kept:
        size[node] = size.get(node, 0) + len(text.replace(" ", ""))
        links[node] = links.get(node, 0) + linked

    def content(block: tuple[int, str, int, bool]) -> bool:
        node, text, linked, article = block
        kind = page.labels[node].partition(".")[0]
        if article or kind in FLOWING:
            return True
        if kind in TEXTS:
            return links[node] <= LINK_SHARE * size[node]
        return linked <= LINK_SHARE * len(text.replace(" ", ""))

    return "\n\n".join(b[1] for b in kept if content(b))


def _clusters(kinds: DataFrame) -> DataFrame:
    """``host, skeleton, wrapper`` from ``host, skeleton, n``: every tree has one wrapper."""

    @F.pandas_udf("boolean")
    def alike(skeletons: pd.Series, wrappers: pd.Series) -> pd.Series:
        return pd.Series([likeness(s, w) > ALIKE for s, w in zip(skeletons, wrappers)], dtype=bool)

    done, rest = [], kinds
    for _ in range(MOST_WRAPPERS):
        first = rest.groupBy("host").agg(F.max_by("skeleton", F.struct("n", "skeleton")).alias("wrapper"))
        tried = staged(rest.join(first, "host").withColumn("alike", (F.col("skeleton") == F.col("wrapper")) | alike("skeleton", "wrapper")))
        done.append(tried.where("alike").select("host", "skeleton", "wrapper"))
        rest = tried.where("not alike").select("host", "skeleton", "n")
        if rest.isEmpty():
            break
    else:
        done.append(rest.select("host", "skeleton", F.col("skeleton").alias("wrapper")))
    return reduce(DataFrame.unionByName, done)


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """``host, tree, wrapper, template, root`` from ``host, html``, over all pages; ``tree`` is the hash of a skeleton.

    Pages with equal content text count once, so copies of a page make no template. Pages that hold mostly what
    the others hold too are copies of one article under other titles; they show no template either.
    """
    kind = "skeleton string, slots array<struct<node:int,hash:long,chars:long>>"

    @F.pandas_udf(kind)
    def profile(sources: pd.Series) -> pd.DataFrame:
        rows = []
        for source in sources:
            page = Page(source or "")
            slots: dict[tuple[int, int], int] = {}
            for node, text, *_ in page.blocks:
                key = node, _digest(text)
                slots[key] = slots.get(key, 0) + len(text)
            rows.append((page.skeleton(), [{"node": node, "hash": h, "chars": n} for (node, h), n in slots.items()]))
        return pd.DataFrame(rows, columns=["skeleton", "slots"])

    @F.pandas_udf("array<int>")
    def aligned(skeletons: pd.Series, wrappers: pd.Series) -> pd.Series:
        return pd.Series([list(align(s, w)) for s, w in zip(skeletons, wrappers)], dtype=object)

    @F.pandas_udf("int")
    def root_of(wrappers: pd.Series, masses: pd.Series) -> pd.Series:
        return pd.Series([content_root(w, {m["node"]: m["chars"] for m in ms}) for w, ms in zip(wrappers, masses)], dtype="int32")

    tree = lambda c: F.xxhash64(c)
    profiles = staged(pages.select("host", profile("html").alias("p")).select("host", "p.skeleton", "p.slots").distinct())
    kinds = profiles.groupBy("host", "skeleton").agg(F.count("*").alias("n"))
    mapped = staged(_clusters(kinds).select("host", "skeleton", "wrapper", tree("wrapper").alias("w"), aligned("skeleton", "wrapper").alias("to")))
    of_page = profiles.join(mapped.drop("wrapper"), ["host", "skeleton"]).select("host", "w", "to", "slots", F.xxhash64("skeleton", "slots").alias("page"))
    slots = of_page.select("host", "w", "page", "to", F.explode("slots").alias("slot"))
    slots = slots.select("host", "w", "page", F.element_at("to", F.col("slot.node") + 1).alias("node"), "slot.hash", "slot.chars").where("node >= 0")
    held = of_page.select("host", "w", F.explode(F.array_distinct(F.transform("slots", lambda s: F.element_at("to", s["node"] + 1)))).alias("node"))
    held = held.where("node >= 0").groupBy("host", "w", "node").agg(F.count("*").alias("pages"))
    texts = slots.groupBy("host", "w", "node", "hash").agg(F.count_distinct("page").alias("n"))
    same = staged(texts.where(F.col("n") >= LEAST_PAGES).join(held, ["host", "w", "node"]).where(F.col("n") >= SAME_SHARE * F.col("pages")).select("host", "w", "node", "hash"))
    marked = slots.join(same.withColumn("same", F.lit(True)), ["host", "w", "node", "hash"], "left").withColumn("same", F.coalesce("same", F.lit(False)))
    chars = lambda c: F.sum(F.when(c, F.col("chars")).otherwise(0))
    articles = marked.groupBy("host", "w", "page").agg(chars(F.col("same")).alias("constant"), chars(~F.col("same")).alias("own"))
    differ = articles.where("own >= constant").groupBy("host", "w").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES).select("host", "w")
    template = same.join(differ, ["host", "w"])
    template = staged(template.groupBy("host", "w").agg(F.array_sort(F.collect_list(F.struct("node", "hash"))).alias("template")))
    shown = template.select("host", "w", F.lit(True).alias("shown"))
    mass = marked.groupBy("host", "w", "node", "same").agg(F.sum("chars").alias("chars")).join(shown, ["host", "w"], "left")
    mass = mass.where("not same or shown is null").groupBy("host", "w", "node").agg(F.sum("chars").cast("double").alias("chars"))
    mass = mass.groupBy("host", "w").agg(F.collect_list(F.struct("node", "chars")).alias("mass"))
    wrappers = mapped.select("host", "wrapper", "w").distinct().join(mass, ["host", "w"]).join(template, ["host", "w"], "left")
    wrappers = wrappers.select("host", "w", "wrapper", "template", root_of("wrapper", "mass").alias("root"))
    return staged(mapped.select("host", "w", tree("skeleton").alias("tree")).join(wrappers, ["host", "w"]).drop("w"))


def extract_main_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``text``: the article of each page, blocks joined by an empty line, white space inside a block one space.

    Pages of one host and like trees share a wrapper, whose content root holds the content; pages without a host
    (null URL) are as of one host. Null and empty pages, and pages without content, have an empty text. Repeated
    rows get equal texts; an empty table stays empty; further columns pass through whatever their names, except that
    ``text`` is replaced.
    """
    rows = pages.select(whole_row(pages.drop("text")), host_and_path(named(url))[0].alias("host"))
    source = F.col("row").getField(html)
    wrappers = induce_wrappers(rows.select("host", source.alias("html")))

    @F.pandas_udf("string")
    def skeleton(sources: pd.Series) -> pd.Series:
        return pd.Series([Page(s or "").skeleton() for s in sources], dtype=object)

    @F.pandas_udf("string")
    def extract(sources: pd.Series, trees: pd.Series, templates: pd.Series, roots: pd.Series) -> pd.Series:
        found = (
            main_text(s, w, [] if t is None else [(m["node"], m["hash"]) for m in t], 0 if pd.isna(r) else int(r))
            for s, w, t, r in zip(sources, trees, templates, roots)
        )
        return pd.Series(list(found), dtype=object)

    joined = rows.withColumn("tree", F.xxhash64(skeleton(source))).join(wrappers, ["host", "tree"], "left")
    return joined.select("row.*", extract(source, "wrapper", "template", "root").alias("text"))
