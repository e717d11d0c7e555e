"""Operator 4: main text of HTML pages by minimum-cut labelling of blocks.

A page is cut into blocks of text at block elements. Each block gets two costs from a classifier with
fixed weights: that of calling it content and that of calling it boilerplate, from its elements (navigation,
header, footer and the like), class and id names of what it is in, share of links outside an article, length and punctuation.
Names count as whole words of a class, alone or with the name of a place or a holder, as in site-footer or share-box. These
are the capacities of its edges to the two ends of a flow network. Neighbours in the page and blocks
that are near in the tree are joined by smoothness edges. The minimum cut separates content from
boilerplate at the least total cost; it is found as a maximum flow.

Text of scripts, styles, controls of forms, templates and comments is no block; text in a form costs as boilerplate, the
less the more text the form has, as a form may be around the whole page. A head ends at the first element that cannot be in one. Character references are decoded,
white space in a block becomes one space, blocks without text go, and blocks called content are
joined by a line feed in page order. Broken markup is taken as it comes: unclosed elements end with
their parents. A null or empty page, or one without content, gives an empty text. Null ids and
repeated rows are kept as they are. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import deque
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
SILENT = frozenset("script style noscript template head title svg iframe object canvas audio video select textarea button "
                   "label datalist annotation annotation-xml".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BOILER = frozenset("nav header footer aside menu dialog search".split())
CONTENT = frozenset("article main".split())
# Whole class, id and role names of what is no article.
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promotion promotions "
    "banner banners cookie cookies consent gdpr notice notices popup modal overlay nav navs navbar navigation menu menus menubar "
    "breadcrumb breadcrumbs sidebar sidebars side-bar widget widgets footer footers header headers masthead share sharing social "
    "subscribe subscription newsletter login signin signup search searchbox pagination pager toolbar copyright legal complementary "
    "contentinfo".split())
#: What an article inside still belongs to: it does not start afresh there.
BAD_FOR_ARTICLES = frozenset(
    "comment comments commentlist disqus disqus_thread respond responses reply replies related recommended recommendation "
    "recommendations outbrain taboola".split())
# With these before or after, joined by a hyphen or underscore, a bad name is still one.
PLACES = frozenset("site page main top bottom left right primary secondary global mobile sub user reader js wp".split())
HOLDERS = frozenset(
    "bar bars box list links link block blocks wrap wrapper container area section panel panels inner outer row item items button "
    "buttons icons form widget banner menu nav header footer thread body slot unit left right top bottom main primary secondary "
    "1 2 3".split())
#: Names that hide an element; others such as overflow-hidden do not.
HIDING = frozenset("hidden visually-hidden d-none".split())
# Whole names of what holds an article.
GOOD_NAMES = frozenset(
    "article article-body article-content article-text post-body post-content post-text postbody entry entry-content entry-body "
    "entry-text main main-content maincontent content page-content story story-body story-content story-text body-text bodytext "
    "prose".split())

# After a tag's name: attributes with values in quotes, in which a tag does not end.
_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*'|(?!["'])))*+>""")
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HIDES = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)(?![\w-])", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_STOPS = re.compile(r"[.!?;:,](?:\s|$)")

# Fixed weights of the classifier, in log odds of content.
W_BOILER, W_BAD_NAME, W_CONTENT, W_GOOD_NAME = -7.0, -6.0, 3.5, 2.0
W_LINKS, W_LENGTH, W_STOP, W_HEADING, BIAS = -5.0, 0.5, 0.4, 1.0, -1.2
#: Of a form without text, halved at so many characters outside links, and less by the square of more.
W_FORM, FORM_CHARS = -3.0, 300
#: Smoothness: neighbours in the page, and more for each step that their elements are nearer.
S_NEXT, S_NEAR = 0.4, 0.8


def _is_named(name: str, names: frozenset[str]) -> bool:
    """Whether a class name is one of ``names``, alone or with the name of a place or a holder."""
    if name in names:
        return True
    parts = re.split("[-_]+", name)
    return len(parts) == 2 and (parts[1] in names and (parts[0] in PLACES or parts[0] in names)
                                or parts[0] in names and parts[1] in HOLDERS)


@lru_cache(maxsize=65536)
def _name_costs(names: str) -> tuple[float, float, float]:
    """Lasting cost, cost up to the next article, and gain of the value of a class, id or role."""
    lasting = passing = gain = 0.0
    for name in names.lower().split():
        if name in HIDING:
            lasting = min(lasting, W_BOILER)
        elif _is_named(name, BAD_FOR_ARTICLES):
            lasting = min(lasting, W_BAD_NAME)
        elif name in GOOD_NAMES:
            gain = W_GOOD_NAME
        elif _is_named(name, BAD_NAMES):
            passing = W_BAD_NAME
    return lasting, passing, gain


class _Block:
    __slots__ = ("parts", "linked", "depth", "shared", "parent", "boiler", "good", "heading", "text", "form")

    def __init__(self, depth: int, shared: int, parent: int, boiler: float, good: float, heading: bool, form: int):
        #: Block elements around it, those it shares with the block before, and the number of the one around its own.
        self.parts, self.linked, self.depth, self.shared, self.parent = [], 0, depth, shared, parent
        self.boiler, self.good, self.heading, self.text = boiler, good, heading, ""
        self.form: float = form  # the number of the form, then its cost


def _tags(page: str):
    """(text, closing, name, attributes) of the page's tags, each with the text before it; the name is null at the end.

    The page is read once. A quote that is never closed makes quotes mean nothing from there on, and
    tags that are never closed are text. What scripts and the like hold is skipped.
    """
    at, since, end, quotes = 0, 0, len(page), True
    unclosed: set[str] = set()
    while True:
        at = page.find("<", at)
        if at < 0:
            break
        if page.startswith("<!--", at):
            yield page[since:at], False, None, ""
            close = page.find("-->", at + 4)
            at = since = end if close < 0 else close + 3
        elif page.startswith("<![CDATA[", at):
            close = page.find("]]>", at)
            close = end if close < 0 else close
            yield page[since:at] + page[at + 9:close].replace("&", "&amp;"), False, None, ""
            at = since = min(end, close + 3)
        elif page.startswith(("<!", "<?"), at):
            yield page[since:at], False, None, ""
            close = page.find(">", at)
            at = since = end if close < 0 else close + 1
        elif (name := _NAME.match(page, at + 1)) is None:
            at += 1
        else:
            rest = _REST.match(page, name.end()) if quotes else None
            if rest is None:
                quotes = False
            close = page.find(">", name.end()) if rest is None else rest.end() - 1
            if close < 0:
                break
            kind, closing = name[1].lower(), page[at + 1] == "/"
            yield page[since:at], closing, kind, page[name.end():close]
            at = since = close + 1
            if kind in RAW and not closing:
                done = None if kind in unclosed else re.compile(rf"</{kind}(?=[\s/>])", re.IGNORECASE).search(page, at)
                if done is not None:
                    at = since = done.start()
                elif kind not in ("title", "textarea"):
                    at = since = end
                else:
                    unclosed.add(kind)
    yield page[since:], False, None, ""


def page_blocks(page: str) -> list[_Block]:
    """Blocks with text, in page order."""
    blocks: list[_Block] = []
    # open elements: name, number, lasting cost of boilerplate, gain of content names, cost of names up to the next article
    stack: list[tuple[str, int, float, float, float]] = []
    around: list[int] = []  # places of block elements on the stack
    forms: list[int] = []
    number, silent, link, block, shared = 0, 0, 0, None, 0
    open_names: dict[str, int] = {}

    def text(raw: str) -> None:
        nonlocal block, shared
        if silent and raw and stack[-1][0] == "head" and not raw.isspace():
            close(len(stack) - 1)
        if silent or not raw:
            return
        if block is None:
            if raw.isspace():
                return
            heading = any(e[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for e in stack[-3:])
            top = stack[-1] if stack else ("", 0, 0.0, 0.0, 0.0)
            parent = stack[around[-2]][1] if len(around) > 1 else 0
            block = _Block(len(around), shared, parent, min(top[2], top[4]), top[3], heading, forms[-1] if forms else 0)
            blocks.append(block)
            shared = len(around)
        raw = unescape(raw)
        block.parts.append(raw)
        if link:
            block.linked += len(raw)

    def close(upto: int) -> None:
        nonlocal silent, link, block, shared
        while len(stack) > upto:
            name = stack.pop()[0]
            open_names[name] -= 1
            silent -= name in SILENT
            link -= name == "a"
            if name == "form":
                forms.pop()
            if name in BLOCK:
                block = None
                around.pop()
                shared = min(shared, len(around))

    for before, closing, name, attributes in _tags(page):
        text(before)
        if name is None:
            continue
        if closing:
            if open_names.get(name):
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                close(k)
            elif name in BLOCK:
                block = None
            continue
        if open_names.get("head") and name not in IN_HEAD:
            k = next(i for i, e in enumerate(stack) if e[0] == "head")
            if name == "body" or not any(e[0] in SILENT for e in stack[k + 1:]):
                close(k)
        if name == "br":
            text(" ") if block is not None else None
            continue
        if name in BLOCK:
            block = None
            # A paragraph, item or cell ends where the next one, or a block, begins.
            if around and stack[around[-1]][0] == "p":
                close(around[-1])
            elif name in ("li", "option", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] == name:
                close(len(stack) - 1)
        if name in VOID or attributes.endswith("/") and name in ("path", "use", "circle", "rect"):
            continue
        number += 1
        _, _, boiler, good, passing = stack[-1] if stack else ("", 0, 0.0, 0.0, 0.0)
        if name in BOILER and not (name == "header" and open_names.get("article")):
            boiler = min(boiler, W_BOILER)
        elif name in CONTENT:
            good = max(good, W_CONTENT)
            # An article inside another may be a comment or a teaser.
            if name == "main" or not open_names.get("article"):
                passing = 0.0
        if attributes:
            gain, bad = 0.0, False
            for key, *values in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), values[0] or values[1] or values[2]
                if key in ("class", "id", "role") and name not in ("body", "html"):
                    costs = _name_costs(value)
                    bad = bad or min(costs[:2]) < 0
                    boiler, passing, gain = min(boiler, costs[0]), min(passing, costs[1]), max(gain, costs[2])
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDES.search(value):
                    boiler = min(boiler, W_BOILER)
            if not bad:
                good = max(good, gain)
        if name in BLOCK:
            around.append(len(stack))
        if name == "form":
            forms.append(number)
        stack.append((name, number, boiler, good, passing))
        open_names[name] = open_names.get(name, 0) + 1
        link += name == "a"
        silent += name in SILENT
    in_form: dict[int, int] = {}
    for b in blocks:
        b.text = _SPACE.sub(" ", "".join(b.parts)).strip()
        in_form[b.form] = in_form.get(b.form, 0) + max(0, len(b.text) - b.linked)
    for b in blocks:
        b.form = W_FORM / (1 + (in_form[b.form] / FORM_CHARS) ** 2) if b.form else 0.0
    kept, passed = [], len(stack) + number
    for b in blocks:
        passed = min(passed, b.shared)
        if b.text:
            b.shared, passed = passed, b.depth
            kept.append(b)
    return kept


def log_odds(block: _Block) -> float:
    """The classifier: log odds that a block is content."""
    n = len(block.text)
    good = 0.0 if block.boiler else block.good
    # In an article, a line that is mostly a link is a line of it.
    share = 0.0 if good else min(1.0, block.linked / n)
    return (BIAS + block.boiler + block.form + good + W_LINKS * share + W_LENGTH * math.log1p(n / 20)
            + W_STOP * min(3, len(_STOPS.findall(block.text))) + W_HEADING * block.heading)


def minimum_cut(content: list[float], boiler: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (true: content) of least total cost.

    ``content[i]`` and ``boiler[i]`` are the costs of either label, an edge (i, j, c) costs c if its ends
    differ. Augments along shortest paths, a whole level graph at a time.
    """
    n = len(content)
    source, sink = n, n + 1
    to: list[int] = []
    left: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        left.append(there)
        out[b].append(len(to))
        to.append(a)
        left.append(back)

    for i, (c, b) in enumerate(zip(content, boiler, strict=True)):
        if c < b:  # what both labels cost is paid in any case
            edge(source, i, b - c, 0.0)
        elif b < c:
            edge(i, sink, c - b, 0.0)
    for i, j, c in edges:
        edge(i, j, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue and level[sink] < 0:
            a = queue.popleft()
            for e in out[a]:
                if left[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(left[e] for e in path)
                for k, e in enumerate(path):
                    left[e] -= flow
                    left[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if left[e] <= tiny)
                node = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[node] < len(out[node]):
                e = out[node][turn[node]]
                if left[e] > tiny and level[to[e]] == level[node] + 1:
                    break
                turn[node] += 1
            else:
                if node == source:
                    break
                level[node] = -1
                node = to[path.pop() ^ 1]
                continue
            path.append(e)
            node = to[e]


def extract_text(page: str | None) -> str:
    """The main text of a page."""
    blocks = page_blocks(page) if page else []
    if not blocks:
        return ""
    odds = [log_odds(b) for b in blocks]
    edges = []
    last_in: dict[int, int] = {}  # the block before in each parent
    for i, b in enumerate(blocks):
        if i:
            steps = blocks[i - 1].depth + b.depth - 2 * b.shared
            edges.append((i - 1, i, S_NEXT + S_NEAR / (1 + steps)))
        sibling = last_in.get(b.parent)
        if sibling is not None and sibling != i - 1:
            edges.append((sibling, i, S_NEAR / 3))
        last_in[b.parent] = i
    labels = minimum_cut([max(0.0, -o) for o in odds], [max(0.0, o) for o in odds], edges)
    return "\n".join(b.text for b, content in zip(blocks, labels, strict=True) if content)


def _extract(id_type: pa.DataType, url_type: pa.DataType):
    def run(batches):
        for batch in batches:
            texts = [extract_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), batch.column(1).cast(url_type), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["id", "url", "text", "n_chars"])

    return run


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for each row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    schema = T.StructType([rows.schema["id"], rows.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    types = (to_arrow_type(rows.schema[c].dataType) for c in ("id", "url"))
    return rows.mapInArrow(_extract(*types), schema).withColumnsRenamed({"id": id_col, "url": url_col})
