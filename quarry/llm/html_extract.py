"""Main text of web pages by minimum-cut labelling.

A page is split into blocks of text.  A classifier's costs of calling a block
content or boilerplate become capacities to the two terminals; neighbours in
the page and blocks of one container are tied by smoothness edges.  A maximum
flow finds the labelling of least total cost, and the content blocks are
joined in page order.  Blocks whose own cost outweighs all edges that are
still open have only one best label and are settled first (this is exact);
the flow runs on what remains.

Pages are independent: one scan, Arrow batches, no shuffle; time is linear in
the page but for the flow among undecided blocks.

Defined results: null or empty html, and pages without content, give an empty
text; unclosed tags, quotes and comments end with the page; null ids, nulls in
other columns and repeated rows pass through row by row; an empty table gives
an empty result; input columns ``text`` and ``blocks`` are replaced.
"""

from __future__ import annotations

import html as html_references
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without an end, elements that start a block,
# elements whose inside is no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
SKIPPED = frozenset("head noscript template svg annotation annotation-xml canvas object audio video select datalist button map".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What the start of an element closes, up to the nearest of its containers.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

#: Weights of the classifier, in log odds of being content.
WEIGHTS = {
    "bias": -0.4, "container": 2.5, "boilerplate": -9.0, "words": 0.9, "sentence": 1.2, "heading": 0.8, "list_item": -0.4,
    "links": -4.0, "legal": -3.0, "prompt": -1.5, "symbols": -0.5,
}
#: Smoothness: next in the page, next in the same container.
ADJACENT, SAME_CONTAINER = 0.6, 0.9

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_DELIMITER = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s"'>/=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>"'][^\s>]*)))?""")
# Words of class names and ids that say boilerplate: always, or only as a whole name, its last word or beside words of GENERIC.
_HARD = re.compile(
    r"(?:nav(?:s|bar|igation|list|links?|menu)?|menu\w*|breadcrumbs?|sidebar|aside|footer|masthead|cookies?|consent|gdpr|"
    r"banners?|ads?|adverts?\w*|sponsor\w*|promo\w*|comments?|disqus|sharing|related|recommend\w*|"
    r"login|signin|signup|subscri\w*|newsletter|popup|modal|overlay|widget|toolbar|pagination|pager|copyright|disclaimer)")
_SOFT = re.compile(r"(?:side|foot|header|notices?|alerts?|replies|reply|responses?|share|social|more|dialog|tags|search|form|legal|skip)")
_GENERIC = re.compile(
    r"(?:\d+|left|right|top|bottom|area|wrap|wrapper|container|box|list|section|inner|outer|block|items?|group|bar|links?|buttons?|icons?|"
    r"primary|secondary|site|media|stories|posts|results|to)")
#: Words that name a part of a thing, or its look, beside a word that says boilerplate.
_PIECES = re.compile(
    r"(?:body|content|contents|text|title|heading|headline|slot|unit|card|row|col|column|grid|panel|pane|tabs?|image|img|picture|label|message|"
    r"info|meta|author|date|time|count|number|id|articles?|news|main|page|desktop|mobile|sticky|fixed|floating|large|small|wide|new|old|"
    r"dark|light|default|custom|policy|settings|preferences|trail|thread|tree|input|field|cta|close|toggle|trigger|app|web|global|local)")
_COMMENTS = re.compile(r"(?:comments?|disqus|reply|replies|responses?)")
_PARTS = re.compile(r"[_-]+")
#: Names that tell of a page what it has, is or is about: those that begin with such a word, end with a state, or name a layout.
MODIFIERS = frozenset("has no not with without is hide show tag category cat type format status layout template theme topic term".split())
STATES = frozenset("open opened closed active inactive visible hidden enabled disabled collapsed expanded accepted loaded ready on off".split())
LAYOUTS = frozenset("layout template theme page".split())
ROLES = frozenset("navigation complementary contentinfo banner search form menu menubar toolbar dialog alert alertdialog".split())
#: Evidence of a name that says boilerplate in part, as a share of ``boilerplate``.
WEAK = 1 / 6
_MAIN = re.compile(r"(?:^|[\s_-])(?:article\w*|main|content|post|entry|story|text|body|page)(?:$|[\s_-])", re.I)
_MAIN_NAME = re.compile(r"article|main|content|post|entry|story", re.I)
_ARTICLE = re.compile(r"<article(?=[\s/>])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_LEGAL = re.compile(r"©|\(c\)\s|copyright|all rights reserved|privacy policy|terms of (?:use|service)", re.I)
_PROMPT = re.compile(r"^(?:advertisement|sponsored|subscribe|sign (?:in|up)|log ?in|share (?:this|on)|read more|click here|accept|"
                     r"leave a (?:comment|reply)|\d+ comments?)\b", re.I)


class Block(NamedTuple):
    text: str
    place: int  # of the container that holds it
    tag: str
    content: bool  # inside a container of the main text
    side: float  # evidence, 0 to 1, of being inside a container of something else
    linked: float  # share of characters in links


class _Open(NamedTuple):
    tag: str
    place: int
    content: bool
    side: float
    skipped: bool
    fixed: bool = False  # inside an element, not only names, of something else
    comments: bool = False  # inside a container of reader comments
    article: int = -1  # blocks of the page before the article that holds it; -1: in none


def _tag_end(page: str, p: int, last: dict[str, int]) -> int:
    """Place of the ``>`` that ends a tag; quotes count after ``=`` only."""
    while m := _DELIMITER.search(page, p):
        at, c = m.start(), m[0]
        if c == ">":
            return at
        p = at + 1
        if at < last[c] and page[max(0, at - 8):at].rstrip().endswith("="):
            p = page.find(c, at + 1) + 1
    return len(page)


def _side_of(name: str) -> float:
    """Evidence, 0 to 1, of one class name or id that its element is boilerplate."""
    parts = [x for x in _PARTS.split(name.lower().split("--")[0]) if x]
    if not parts or parts[0] in MODIFIERS or "by" in parts or (len(parts) > 1 and parts[-1] in STATES):
        return 0.0
    at = next((i for i, x in enumerate(parts) if x in ("has", "no", "with", "without")), len(parts))
    parts = parts[:at]  # what stands before "with" is the thing itself
    hard = [bool(_HARD.fullmatch(x)) for x in parts]
    if any(hard):
        if len(parts) > 1 and parts[-1] in LAYOUTS:
            return WEAK
        # the thing itself, or a part of it; a word beside something else ("modal-verbs") only modifies
        known = (h or any(r.fullmatch(x) for r in (_SOFT, _GENERIC, _PIECES)) for h, x in zip(hard, parts))
        return 1.0 if hard[-1] or all(known) else WEAK
    soft = [bool(_SOFT.fullmatch(x)) for x in parts]
    if not any(soft):
        return 0.0
    if all(x or _GENERIC.fullmatch(y) for x, y in zip(soft, parts)):
        return 1.0
    return 1.0 if soft[-1] and not any(_MAIN.search(x) for x in parts) else WEAK


@lru_cache(maxsize=4096)
def _named(names: str) -> tuple[float, bool, bool]:
    """Evidence of boilerplate of class names or an id, whether one says main
    text, and whether one names a container of comments."""
    all_names = names.split()
    sides = [_side_of(x) for x in all_names]
    side = max(sides, default=0.0)
    if side and any(_MAIN_NAME.fullmatch(x) for x in all_names) and not any(
            s == 1.0 and any(_HARD.fullmatch(y) for y in _PARTS.split(x.lower())) for s, x in zip(sides, all_names)):
        side = WEAK  # names that contradict each other
    comments = any(s == 1.0 and any(_COMMENTS.fullmatch(y) for y in _PARTS.split(x.lower())) for s, x in zip(sides, all_names))
    return side, side < 1.0 and any(not s and _MAIN.search(x) for s, x in zip(sides, all_names)), comments


def _flags(tag: str, attributes: str, parent: _Open, n_blocks: int, only_article: bool) -> tuple[bool, float, bool, bool, bool, int]:
    """content, side, skipped, fixed, comments, article of an element that
    starts after ``n_blocks`` blocks of the page."""
    content, side, skipped, fixed = parent.content, parent.side, parent.skipped or tag in SKIPPED, parent.fixed
    comments, article = parent.comments, parent.article
    own, roles = 0.0, ""
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "role":
                roles = value.strip().lower()
            elif name in ("class", "id"):
                found, main, said = _named(value)
                own = max(own, found)
                content = content or main
                comments = comments or said
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
                skipped = True
    if tag in ("body", "html"):
        own, comments = 0.0, parent.comments
    elif tag == "main" or roles == "main":
        # main text, whatever it stands in and is called
        return True, 0.0, skipped, False, False, article
    elif tag == "article" or roles == "article":
        if not only_article and (parent.comments or 0 <= parent.article < n_blocks):
            # within comments, or after text of an article it stands in: a reader's article, not the page's
            return content, 1.0, skipped, True, True, n_blocks
        # begins anew below names; what they said of the outside remains as weak evidence
        content, comments, article = True, comments and own == 1.0, n_blocks
        if not fixed:
            side = 0.0 if side < 1.0 else WEAK
        own = own if own == 1.0 else 0.0
    if tag in ("nav", "aside", "footer", "dialog", "menu") or (tag == "header" and not parent.content) or roles in ROLES:
        side, fixed = 1.0, tag != "header" or fixed
    elif tag == "form":
        side = 1.0
    return content, max(side, own), skipped, fixed, comments, article


def read_blocks(page: str) -> list[Block]:
    """Blocks of a page in order, white space and references resolved."""
    last = {'"': page.rfind('"'), "'": page.rfind("'")}
    root = _Open("", 0, False, 0.0, False)
    only_article = len(_ARTICLE.findall(page)) == 1
    stack, opened, places = [root], Counter(), 0
    blocks: list[Block] = []
    parts: list[str] = []
    links = linked = 0
    p, n = 0, len(page)

    def flush():
        nonlocal linked
        if parts:
            raw = "".join(parts)
            parts.clear()
            text = " ".join((html_references.unescape(raw) if "&" in raw else raw).split())
            if text:
                holder = next((e for e in reversed(stack) if e.tag in BLOCK), root)
                blocks.append(Block(text, holder.place if holder.tag not in LEAVES else above(holder), holder.tag,
                                    holder.content, holder.side, min(1.0, linked / len(raw))))
        linked = 0

    def above(holder):
        at = len(stack) - 1
        while stack[at] is not holder:
            at -= 1
        while at and (stack[at].tag in LEAVES or stack[at].tag not in BLOCK):
            at -= 1
        return stack[at].place

    def close(at):
        nonlocal links
        for e in stack[at:]:
            opened[e.tag] -= 1
            links -= e.tag == "a"
        del stack[at:]

    while p < n:
        lt = page.find("<", p)
        if lt < 0:
            lt = n
        if lt > p and not stack[-1].skipped:
            parts.append(page[p:lt])
            if links:
                linked += lt - p
        if lt == n:
            break
        after = page[lt + 1:lt + 2]
        if after == "!" or after == "?":
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                p = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                p = n if end < 0 else end + 1
            continue
        closing = after == "/"
        m = _NAME.match(page, lt + 1 + closing)
        if not m:
            if closing:
                end = page.find(">", lt)
                p = n if end < 0 else end + 1
            else:
                parts.append("<")
                p = lt + 1
            continue
        tag = m[0].lower()
        end = _tag_end(page, m.end(), last)
        p = end + 1
        if closing:
            if tag in BLOCK:
                flush()
            if opened[tag] > 0:
                at = len(stack) - 1
                while stack[at].tag != tag:
                    at -= 1
                close(at)
            continue
        if tag in RAW:
            stop = re.compile(f"</{tag}(?![a-zA-Z0-9])", re.I).search(page, p)
            p = n if not stop else stop.start()
            if stop:
                end = page.find(">", p)
                p = n if end < 0 else end + 1
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK:
            flush()
            if opened["p"] > 0:
                at = len(stack) - 1
                while stack[at].tag != "p":
                    at -= 1
                if not any(e.tag in BLOCK for e in stack[at + 1:]):
                    close(at)
            if tag in CLOSES:
                same, bounds = CLOSES[tag]
                at = len(stack) - 1
                while at and stack[at].tag not in bounds and stack[at].tag not in same:
                    at -= 1
                if stack[at].tag in same:
                    close(at)
        if tag not in VOID and not page.startswith("/", end - 1):
            places += 1
            stack.append(_Open(tag, places, *_flags(tag, page[m.end():end], stack[-1], len(blocks), only_article)))
            opened[tag] += 1
            links += tag == "a"
    flush()
    return blocks


#: Block elements that hold text rather than other blocks.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre figcaption summary".split())


def log_odds(b: Block, weights: dict[str, float] = WEIGHTS) -> float:
    """Classifier: log odds that a block is content."""
    n = b.text.count(" ") + 1
    z = weights["bias"] + weights["words"] * math.log1p(min(n, 40)) - weights["words"]
    z += weights["links"] * b.linked
    if b.content:
        z += weights["container"]
    z += weights["boilerplate"] * b.side
    if b.text[-1] in ".!?…。»\"”:" and n > 3:
        z += weights["sentence"]
    if b.tag in HEADINGS:
        z += weights["heading"]
    if b.tag in ("li", "td", "th"):
        z += weights["list_item"]
    if n < 40 and _LEGAL.search(b.text):
        z += weights["legal"]
    if n < 12 and _PROMPT.search(b.text):
        z += weights["prompt"]
    if "|" in b.text and n < 12:
        z += weights["symbols"]
    return z


def edges_of(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness edges: next block of the page, next block of a container."""
    out: dict[tuple[int, int], float] = {}
    before: dict[int, int] = {}
    for i, b in enumerate(blocks):
        # ties run within content and within boilerplate containers, weaker across
        if i:
            same = blocks[i - 1].side == b.side
            out[(i - 1, i)] = ADJACENT if same else ADJACENT / 4
        if b.place in before and b.place:
            e = (before[b.place], i)
            out[e] = out.get(e, 0.0) + SAME_CONTAINER
        before[b.place] = i
    return out


def minimum_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Labels (content or not) of least total cost: calling a block of log
    odds z boilerplate costs log(1 + e**z), content log(1 + e**-z) (their
    difference is z), and each edge between unlike labels its weight."""
    n = len(odds)
    excess = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in edges.items():
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    open_weight = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:
        i = waiting.popleft()
        if label[i] is not None or abs(excess[i]) < open_weight[i]:
            continue
        label[i] = excess[i] >= 0
        for j, w in near[i].items():
            if label[j] is None:
                excess[j] += w if label[i] else -w
                open_weight[j] -= w
                waiting.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, content in zip(rest, _flow(rest, excess, near)):
            label[i] = content
    return [bool(x) for x in label]


def _flow(nodes: list[int], excess: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Source side of a minimum cut, by maximum flow along shortest paths in
    levels (blocking flows)."""
    index = {v: k for k, v in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    capacity: list[dict[int, float]] = [{} for _ in range(len(nodes) + 2)]
    for v, k in index.items():
        if excess[v] > 0:
            capacity[source][k], capacity[k][source] = excess[v], 0.0
        else:
            capacity[k][sink], capacity[sink][k] = -excess[v], 0.0
        for u, w in near[v].items():
            if u in index:
                capacity[k][index[u]] = w
    tiny = 1e-12
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for u, c in capacity[v].items():
                if c > tiny and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        if sink not in level:
            return [index[v] in level for v in nodes]
        todo = {v: iter(list(capacity[v])) for v in level}
        path = [source]
        while path:
            v = path[-1]
            if v == sink:
                amount = min(capacity[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    capacity[a][b] -= amount
                    capacity[b][a] = capacity[b].get(a, 0.0) + amount
                first = next(i for i, (a, b) in enumerate(zip(path, path[1:])) if capacity[a][b] <= tiny)
                for a in path[:first + 1]:
                    if a not in todo:
                        todo[a] = iter(list(capacity[a]))
                del path[first + 1:]
                continue
            for u in todo[v]:
                if capacity[v][u] > tiny and level.get(u) == level[v] + 1:
                    path.append(u)
                    break
            else:
                path.pop()
                if path:
                    level[v] = -1


def main_text(page: str | None, weights: dict[str, float] = WEIGHTS) -> tuple[str, list[tuple[str, float, bool]]]:
    """Main text of a page, and all its blocks as (text, log odds, content)."""
    blocks = read_blocks(page or "")
    if not blocks:
        return "", []
    odds = [log_odds(b, weights) for b in blocks]
    labels = minimum_cut(odds, edges_of(blocks))
    return "\n\n".join(b.text for b, x in zip(blocks, labels) if x), [(b.text, z, x) for b, z, x in zip(blocks, odds, labels)]


def extract(df: DataFrame, html_col: str = "html", with_blocks: bool = False, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """``df`` with ``text``, the main text of each page, and, on request,
    ``blocks`` (array<struct<text, log_odds, content>>)."""
    @F.arrow_udf("string")
    def text_of(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in pages:
            yield pa.array([main_text(x.as_py(), weights)[0] for x in batch], pa.string())

    @F.arrow_udf("struct<text:string,blocks:array<struct<text:string,log_odds:double,content:boolean>>>")
    def all_of(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("log_odds", pa.float64()), ("content", pa.bool_())]))
        for batch in pages:
            found = [main_text(x.as_py(), weights) for x in batch]
            rows = [[dict(zip(("text", "log_odds", "content"), b)) for b in blocks] for _, blocks in found]
            yield pa.StructArray.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array(rows, kind)], ["text", "blocks"])

    names = [f"`{c}`" for c in df.columns if c.lower() not in ("text", "blocks") or c == html_col]
    page = F.col(f"`{html_col}`")
    if not with_blocks:
        return df.select(*names, text_of(page).alias("text"))
    return df.select(*names, all_of(page).alias("__found")).select(*names, "__found.text", "__found.blocks")
