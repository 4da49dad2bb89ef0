"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read once into its element tree and its blocks (text between block
level tags, white space folded, character references decoded). Every block gets

* a classifier cost: the markup it stands in (``article`` and ``main`` speak for
  content; menus, footers, forms, sidebars, adverts, notices, comments and their
  usual class names against it; outside an existing article is against it too)
  plus log odds of its own text (words, share of links, end of sentence, kind of
  tag). These log odds are learned here: blocks whose markup is plain label
  themselves, and Spark counts their features over ``TRAIN_PAGES`` pages;
* smoothness edges: to the next block of the page, the stronger the nearer the
  two are in the tree, and to the next block of the same parent element.

Costs are the capacities from and to the terminals. A maximum flow separates
content from boilerplate with the least total cost; what could go either way is
kept. Each page is a graph of its own (Dinic's algorithm, three edges a block),
so pages are spread by Spark's partitions alone; the learned table has a fixed
number of rows.

An advert inside an article stays out and a one-word paragraph between long
ones stays in, though their texts alone look the other way round.

Defined results: null or empty html gives an empty text, as does a page without
text; unclosed tags, comments and scripts run to where HTML ends them, at worst
the end of the page; an unclosed tag at the very end is dropped; bytes that are
not UTF-8 are read as replacement signs; very long pages are read whole; repeated
rows are rows of their own; an empty table gives an empty one, with the default
log odds. Input columns are kept in ``row``, so their names clash with nothing.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, table

TRAIN_PAGES = 20_000

# Elements of HTML by what they do to text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
NO_TEXT = set("head script style template noscript svg math select button datalist object canvas audio video iframe".split())
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
            "tbody td tfoot th thead tr ul caption".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSES_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
               "th": ("tr", "table")}
#: markup that speaks against content wherever it stands, and only outside the article
AGAINST_TAGS = set("nav aside footer form dialog menu search".split())
AGAINST_ROLES = set("navigation contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
AGAINST_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar widget widgets footer cookie cookies consent gdpr notice notices notification popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "trending comment comments commentlist disqus reply replies respond pagination pager copyright toolbar search searchform "
    "skip".split())
HEAD_WORDS = set("header masthead topbar".split())
FOR_WORDS = set("article articlebody entry post story content maincontent".split())

FOR, AGAINST, OUTSIDE = 9.0, 16.0, -3.0
ODDS_LIMIT = 1.0  # of one feature, so that text alone never outweighs plain markup
NEXT, SIBLING, FAR, CLIMB = 3.0, 1.0, 0.25, 4
SCALE = 1000  # capacities are whole numbers

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_SENTENCE_END = tuple(".!?…。！？:;\"'”’)")


class Page:
    """Elements (parent, tag, hints) and blocks (text, link letters, element) of one page."""

    def __init__(self, html: str):
        self.parent, self.tag, self.hint = [-1], ["#page"], [""]
        self.blocks: list[tuple[str, int, int]] = []
        self._read(html)
        self._mark()

    # -- reading ------------------------------------------------------------------

    def _read(self, html: str) -> None:
        self.stack, self.open, self.block_at, self.mute, self.links = [0], {}, [0], 0, 0
        self.pieces: list[str] = []
        self.link_letters = 0
        at, n = 0, len(html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                self._text(html[at:lt])
            if lt >= n:
                break
            after = html[lt + 1:lt + 2]
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 2)
                at = n if end < 0 else end + 3
            elif after in ("!", "?"):
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            elif after == "/" and not html[lt + 2:lt + 3].isalpha():
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            elif after != "/" and not (after.isascii() and after.isalpha()):
                self._text("<")
                at = lt + 1
            else:
                found = _TAG.match(html, lt)
                if not found:  # an unclosed tag runs to the end of the page
                    break
                at = found.end()
                name = found[2].lower()
                if found[1]:
                    self._end(name)
                    continue
                self._start(name, found[3])
                if name in RAW:
                    end = _RAW_END[name].search(html, at)
                    at = end.start() if end else n
        self._flush()

    def _text(self, raw: str) -> None:
        if not self.mute:
            text = unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            if self.links:
                self.link_letters += len(text.strip())

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((text, self.link_letters, self.stack[self.block_at[-1]]))
            self.pieces, self.link_letters = [], 0

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self._flush()
            if self.tag[self.stack[self.block_at[-1]]] == "p":
                self._pop(self.block_at[-1])
            if name in CLOSES_SAME:
                places = [p[-1] for t in ((name,) if name in ("li", "tr") else ("dt", "dd") if name in ("dt", "dd") else ("td", "th"))
                          if (p := self.open.get(t))]
                within = max((self.open[t][-1] for t in CLOSES_SAME[name] if self.open.get(t)), default=-1)
                if places and max(places) > within:
                    self._pop(max(places))
        if name == "br":
            if not self.mute:
                self.pieces.append(" ")
        if name in VOID:
            return
        node = len(self.tag)
        self.parent.append(self.stack[-1])
        self.tag.append(name)
        self.hint.append(_hint(name, attributes))
        self.open.setdefault(name, []).append(len(self.stack))
        if name in BLOCK:
            self.block_at.append(len(self.stack))
        self.stack.append(node)
        self.mute += name in NO_TEXT or self.hint[-1] == "hidden"
        self.links += name == "a"

    def _end(self, name: str) -> None:
        block = name in BLOCK
        if block:
            self._flush()
        places = self.open.get(name)
        if places and (block or name in NO_TEXT or places[-1] > self.block_at[-1]):
            self._pop(places[-1])

    def _pop(self, place: int) -> None:
        """Close the open elements from ``place`` on."""
        if self.block_at[-1] >= place:
            self._flush()
        while len(self.stack) > place:
            node = self.stack.pop()
            name = self.tag[node]
            self.open[name].pop()
            if self.block_at[-1] == len(self.stack):
                self.block_at.pop()
            self.mute -= name in NO_TEXT or self.hint[node] == "hidden"
            self.links -= name == "a"

    # -- markup -------------------------------------------------------------------

    def _mark(self) -> None:
        """``state`` per element: 1 in content markup, -1 in boilerplate markup, 0 outside an article, None unknown."""
        n = len(self.tag)
        anchor = self._anchor()
        self.anchored = anchor > 0 and self.hint[anchor] in ("main", "article")
        around = set()
        while anchor > 0:  # an element around the article is no sidebar, whatever its names
            around.add(anchor)
            anchor = self.parent[anchor]
        self.state: list = [0 if self.anchored else None] * n
        for k in range(1, n):
            state, hint = self.state[self.parent[k]], self.hint[k]
            if state != -1:
                if hint in ("main", "article") or hint == "for" and (not self.anchored or state == 1):
                    state = 1
                elif hint == "against" and k not in around:
                    state = -1
                elif hint == "head" and k not in around and state != 1:
                    state = -1
            self.state[k] = state

    def _anchor(self) -> int:
        """The element of the main text: the first ``main``, else the article with the least markup against it and
        the most text, else the first ``h1``; 0 if there is none."""
        n = len(self.tag)
        first = next((k for k in range(n) if self.hint[k] == "main"), 0)
        if first:
            return first
        letters, against = [0] * n, [0] * n
        for text, links, node in self.blocks:
            letters[node] += max(0, len(text) - links)
        for k in range(n - 1, 0, -1):  # parents come before their children
            letters[self.parent[k]] += letters[k]
        for k in range(1, n):
            against[k] = against[self.parent[k]] + (self.hint[k] == "against")
        articles = [k for k in range(n) if self.hint[k] == "article"]
        if articles:
            return min(articles, key=lambda k: (against[k], -letters[k], k))
        return next((k for k in range(n) if self.tag[k] == "h1"), 0)

    def features(self) -> list[list[str]]:
        """Of each block: the features of its own text."""
        out = []
        for text, links, node in self.blocks:
            words = text.count(" ") + 1
            share = links / len(text)
            kind = self.tag[node]
            out.append([f"words{min(words.bit_length(), 7)}", f"links{0 if share < .2 else 1 if share < .5 else 2}",
                        f"end{int(text.endswith(_SENTENCE_END))}",
                        "kind-" + ("heading" if kind in HEADINGS else kind if kind in ("p", "li", "td") else "other")])
        return out

    def labels(self) -> list[bool | None]:
        """Content or boilerplate where the markup is plain, else None."""
        return [{1: True, -1: False}.get(self.state[node]) for _, _, node in self.blocks]

    # -- the graph ----------------------------------------------------------------

    def costs(self, odds: dict[str, float]) -> list[int]:
        """Of each block: what calling it boilerplate costs more than calling it content."""
        markup = {1: FOR, -1: -AGAINST, 0: OUTSIDE, None: 0.0}
        return [round(SCALE * (markup[self.state[node]] + sum(odds.get(f, 0.0) for f in own)))
                for own, (_, _, node) in zip(self.features(), self.blocks)]

    def edges(self) -> list[tuple[int, int, int]]:
        """Smoothness edges (block, later block, capacity)."""
        out, last = [], {}
        for k, (_, _, node) in enumerate(self.blocks):
            if k:
                out.append((k - 1, k, round(SCALE * self._nearness(self.blocks[k - 1][2], node))))
            home = self.parent[node]
            if home in last and last[home] < k - 1:
                out.append((last[home], k, round(SCALE * SIBLING)))
            last[home] = k
        return out

    def _nearness(self, a: int, b: int) -> float:
        """``NEXT`` / steps between two elements by the tree, ``FAR`` beyond a climb of ``CLIMB``."""
        ups: dict[int, int] = {}
        for step in range(CLIMB + 1):
            if a < 0:
                break
            ups[a] = step
            a = self.parent[a]
        for step in range(CLIMB + 1):
            if b < 0:
                break
            if b in ups:
                return NEXT / max(1, step + ups[b])
            b = self.parent[b]
        return FAR

    def text(self, odds: dict[str, float]) -> str:
        """The blocks on the content side of the minimum cut, one a line."""
        if not self.blocks:
            return ""
        keep = minimum_cut(self.costs(odds), self.edges())
        return "\n".join([b[0] for b, k in zip(self.blocks, keep) if k])


def _hint(name: str, attributes: str) -> str:
    words: set[str] = set()
    role = ""
    if attributes and not attributes.isspace():
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id"):
                words.update(t.lower() for t in _TOKEN.findall(value))
            elif key == "role":
                role = value.strip().lower()
            elif (key == "hidden" or key == "aria-hidden" and value.lower() == "true"
                  or key == "style" and "display:none" in value.replace(" ", "").lower()):
                return "hidden"
            elif key == "itemprop" and value == "articleBody":
                role = role or "article"
    if name in ("html", "body"):  # their classes list what the page has
        return ""
    if name in AGAINST_TAGS or role in AGAINST_ROLES or words & AGAINST_WORDS:
        return "against"
    for kind in ("main", "article"):
        if kind in (name, role):
            return kind
    if name == "header" or role == "banner" or words & HEAD_WORDS:
        return "head"
    return "for" if words & FOR_WORDS else ""


def minimum_cut(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for every node on the source side (the largest one, if several cuts are minimal).

    A positive cost is the capacity from the source, a negative one to the sink;
    an edge costs its capacity when its ends are on different sides. Dinic's
    algorithm: shortest paths by levels, blocking flows by a walk with one
    pointer per node.
    """
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a, b, there, back):
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, cost in enumerate(costs):
        if cost > 0:
            connect(source, k, cost, 0)
        elif cost < 0:
            connect(k, sink, -cost, 0)
    for a, b, capacity in edges:
        connect(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)  # steps to the sink, so that what cannot reach it is known at the end
        level[sink] = 0
        queue = deque([sink])
        while queue:
            b = queue.popleft()
            for e in out[b]:
                a = to[e]
                if level[a] < 0 and room[e ^ 1]:
                    level[a] = level[b] + 1
                    queue.append(a)
        if level[source] < 0:
            return [x < 0 for x in level[:n]]
        pointer = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                cut = 0
                for k in range(len(path) - 1, -1, -1):
                    room[path[k]] -= flow
                    room[path[k] ^ 1] += flow
                    if not room[path[k]]:
                        cut = k
                node = to[path[cut] ^ 1]
                del path[cut:]
            edges_here = out[node]
            k = pointer[node]
            while k < len(edges_here) and not (room[edges_here[k]] and level[to[edges_here[k]]] == level[node] - 1):
                k += 1
            pointer[node] = k
            if k < len(edges_here):
                path.append(edges_here[k])
                node = to[edges_here[k]]
            elif path:  # a dead end
                e = path.pop()
                node = to[e ^ 1]
                pointer[node] += 1
            else:
                break


#: log odds of content used before and beside what the pages teach
DEFAULT_ODDS = {"words1": -.8, "words2": -.6, "words3": -.2, "words4": .3, "words5": .7, "words6": 1., "words7": 1.,
                "links0": .2, "links1": -.6, "links2": -1., "end0": -.3, "end1": .4,
                "kind-p": .4, "kind-li": -.3, "kind-heading": .6, "kind-td": -.2, "kind-other": -.2}
PRIOR = 50.0  # blocks that the default counts as


def _page(html: bytes | None) -> Page:
    return Page((html or b"").decode("utf-8", "replace"))


def learn_odds(pages: DataFrame, html: str = "html", train_pages: int = TRAIN_PAGES) -> dict[str, float]:
    """Log odds of content by feature, from the blocks whose markup is plain, on about ``train_pages`` pages.

    The pages are chosen by a hash of their html. At most as many rows are
    collected as there are features.
    """
    total = pages.count()
    if not total:
        return dict(DEFAULT_ODDS)
    share = min(1.0, train_pages / total)
    bucket = F.pmod(F.xxhash64(F.col(f"`{html}`")), F.lit(1 << 20))
    some = pages if share == 1 else pages.where(bucket < round(share * (1 << 20)))

    def make():
        def count(htmls):
            found = []
            for h in htmls:
                page, counts = _page(h), {}
                for label, own in zip(page.labels(), page.features()):
                    if label is not None:
                        for f in (*own, ""):
                            counts.setdefault(f, [0, 0])[label] += 1
                found.append([{"f": f, "against": a, "content": c} for f, (a, c) in counts.items()])
            return (found,)
        return count

    counted = map_text(some.select(F.col(f"`{html}`").alias("html")), "html", [], make,
                       "found array<struct<f:string,against:long,content:long>>")
    rows = counted.select(F.inline("found")).groupBy("f").agg(F.sum("against").alias("a"), F.sum("content").alias("c")).collect()
    counts = {r.f: (r.a, r.c) for r in rows}
    against, content = counts.pop("", (0, 0))
    odds = dict(DEFAULT_ODDS)
    for f, (a, c) in counts.items():
        given = PRIOR * (1 if f not in odds else 2.718281828 ** odds[f])
        value = log((c + given) / (content + PRIOR * 10)) - log((a + PRIOR) / (against + PRIOR * 10))
        odds[f] = max(-ODDS_LIMIT, min(ODDS_LIMIT, value))
    return odds


def extract_text(pages: DataFrame, keep: list[str], odds: dict[str, float], html: str = "html") -> DataFrame:
    """``row`` (kept columns) and the main text ``main_text`` of every page."""
    def make():
        return lambda htmls: ([_page(h).text(odds) for h in htmls],)

    return map_text(pages, html, keep, make, "main_text string")


def q_op13_html_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract_text(pages, ["page_id", "url"], learn_odds(pages))
    return found.select("row.page_id", "row.url", F.col("main_text").alias("text"),
                        F.length("main_text").cast("long").alias("n_chars"))


#: for pages as the given tables have them: one article of headings and paragraphs, two kinds of references
OP13_SQL = r"""
WITH body AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS a FROM pages),
line AS (
  SELECT page_id, url, list_transform(
    string_split(regexp_replace(regexp_replace(regexp_replace(a, '</?(h[1-6]|p)>', chr(1), 'g'), '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), chr(1)),
    lambda x: trim(regexp_replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
                                  '[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS xs
  FROM body)
SELECT page_id, url, array_to_string(list_filter(xs, lambda x: x <> ''), chr(10)) AS text,
       CAST(length(array_to_string(list_filter(xs, lambda x: x <> ''), chr(10))) AS BIGINT) AS n_chars
FROM line
"""
