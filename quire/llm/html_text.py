"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to the elements around them, fewer with each
level; an element's points are discounted by the share of its characters that are links. The best
element is kept with those of its siblings that look like parts of the same text.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*>",
    re.S,
)
#: A tag that the page's end cuts off.
OPEN_END = re.compile(r"<[a-zA-Z/!?]")
# Names of HTML elements.
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set(
    "nav footer aside form button select option optgroup textarea input script style noscript template iframe svg canvas object audio video"
    " head title menu dialog search xmp noembed noframes annotation annotation-xml".split()
)
NEVER_DROPPED = {"html", "body", "article", "main"}
#: Elements that an equal one (or another of the group) closes, unless an element of the second set is nearer.
CLOSES = {
    **dict.fromkeys(["li"], ({"li"}, {"ul", "ol", "menu", "dir"})),
    **dict.fromkeys(["dt", "dd"], ({"dt", "dd"}, {"dl"})),
    **dict.fromkeys(["tr"], ({"tr", "td", "th"}, {"table"})),
    **dict.fromkeys(["td", "th"], ({"td", "th"}, {"tr", "table"})),
    **dict.fromkeys(["thead", "tbody", "tfoot"], ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})),
    **dict.fromkeys(["option", "optgroup"], ({"option"}, {"select"})),
}
PARAGRAPHS = {"p", "pre", "td", "blockquote", "li", "dd"}
HEADINGS = {"h1", "h2", "h3"}
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adsbygoogle|advert\w*|sponsor\w*|promo\w*|banner|cookies?\w*|consent|gdpr|notices?|alert|newsletter|subscri\w+|popup|modal|overlay"
    r"|sidebar|sidenav|menu\w*|nav|navbar|navigation|breadcrumbs?|footer|foot|colophon|comments?|commentlist|disqus|respond|replies|share|sharing|social"
    r"|related|recommend\w*|widgets?|toolbar|pagination|pager|login|signup|skip|complementary|contentinfo)(?:$|[\s_-])", re.I)
#: Characters of paragraphs that an element holds before it can be the page's text against a part of its class.
MAIN_CHARS = 250
#: Words that name reader comments wherever they stand in a class.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|replies)(?:$|[\s_-])", re.I)
PAGE_HEAD = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?:$|[\s_-])", re.I)
GOOD = re.compile(r"article|body|content|entry|main|page|post|text|blog|story", re.I)


def main_text(page: str) -> str:
    """The page's main text; blocks in page order, joined by one space."""
    tags, parents, dropped, weights, within = ["#"], [-1], [False], [0.0], [False]
    doubtful: list[int] = []  # elements that a part of a class names as no text
    blocks: list[list] = []  # element, text, characters within links
    parts: list[str] = []
    linked = 0
    stack = [0]
    links = 0

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            owner = next((x for x in reversed(stack) if tags[x] in BLOCK), 0)
            blocks.append([owner, text, min(linked, len(text))])
        parts.clear()
        linked = 0

    def close(depth):
        nonlocal links
        links -= sum(tags[x] == "a" for x in stack[depth:])
        del stack[depth:]

    def text(piece):
        nonlocal linked
        if piece and not dropped[stack[-1]]:
            parts.append(piece)
            if links:
                linked += len(piece)

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            cut = OPEN_END.search(page, at)
            text(page[at:cut.start() if cut else len(page)])
            break
        text(page[at:found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        block = tag in BLOCK
        if block or tag == "br":
            if not block:
                parts.append(" ")
            else:
                flush()
        if found["end"] or found["end2"]:
            for depth in range(len(stack) - 1, 0, -1):
                if tags[stack[depth]] == tag:
                    close(depth)
                    break
                if not block and tags[stack[depth]] in BLOCK:
                    break
            continue
        attrs = found["attrs"] or found["attrs2"] or ""
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if block:
            _close_open(tag, tags, stack, close)
        if tag in VOID:
            continue
        above = stack[-1]
        name = " ".join(a or b or c for a, b, c in NAMES.findall(attrs)) if attrs else ""
        inside = within[above]
        gone = dropped[above] or tag in DROPPED or bool(attrs and HIDDEN.search(attrs))
        if not gone and tag not in NEVER_DROPPED:
            gone = not inside and tag == "header"
            if not gone and name and (BOILERPLATE.search(name) or not inside and PAGE_HEAD.search(name)):
                # A whole class, id or role says what an element is; a part of one may say what it has ("with-sidebar").
                gone = bool(COMMENTS.search(name)) or any(BOILERPLATE.fullmatch(x) or not inside and PAGE_HEAD.fullmatch(x) for x in name.split())
                if not gone:
                    doubtful.append(len(tags))
        tags.append(tag)
        parents.append(above)
        dropped.append(gone)
        within.append(inside or tag in ("article", "main"))
        weights.append((25.0 if tag in ("article", "main") else 0.0) + (10.0 if name and GOOD.search(name) and tag not in ("html", "body") else 0.0))
        stack.append(len(tags) - 1)
        links += tag == "a"
    flush()
    return _select(tags, parents, weights, _without(doubtful, tags, parents, blocks))


def _worth(text: str, linked: int) -> float:
    """Points of a paragraph: for its length and commas, less the share of its characters that are links."""
    return (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))


def _without(doubtful, tags, parents, blocks):
    """The blocks without those in doubtful elements, unless one holds most of the page's paragraph points.

    It takes some text for that: on a page that has hardly any, a notice may be most of it.
    """
    if not doubtful:
        return blocks
    points, chars = [0.0] * len(tags), [0] * len(tags)
    for owner, text, linked in blocks:
        if tags[owner] in PARAGRAPHS:
            points[owner] += _worth(text, linked)
            chars[owner] += len(text) - linked
    for i in range(len(tags) - 1, 0, -1):
        points[parents[i]] += points[i]
        chars[parents[i]] += chars[i]
    gone = [False] * len(tags)
    for i in doubtful:
        gone[i] = 2 * points[i] <= points[0] or chars[i] < MAIN_CHARS
    for i in range(1, len(tags)):
        gone[i] |= gone[parents[i]]
    return [b for b in blocks if not gone[b[0]]]


def _close_open(tag, tags, stack, close):
    """End the elements that the start of a block implies to be over: paragraphs, and list or table items."""
    for depth in range(len(stack) - 1, 0, -1):
        if tags[stack[depth]] == "p":
            close(depth)
            break
        if tags[stack[depth]] in BLOCK:
            break
    closed, limit = CLOSES.get(tag, ((), ()))
    if closed:
        reached = None
        for depth in range(len(stack) - 1, 0, -1):
            if tags[stack[depth]] in limit:
                break
            if tags[stack[depth]] in closed:
                reached = depth
        if reached is not None:
            close(reached)


def _select(tags, parents, weights, blocks):
    if not blocks:
        return ""
    n = len(tags)
    points, chars, in_links = [0.0] * n, [0] * n, [0] * n
    for owner, text, linked in blocks:
        chars[owner] += len(text)
        in_links[owner] += linked
        if tags[owner] in PARAGRAPHS or tags[owner] not in ("h1", "h2", "h3", "h4", "h5", "h6"):
            worth = _worth(text, linked)
            up = parents[owner] if tags[owner] in PARAGRAPHS else owner
            for level in range(5):
                if up < 0:
                    break
                points[up] += worth / (1, 2, 6, 9, 12)[level]
                up = parents[up]
    for i in range(n - 1, 0, -1):
        chars[parents[i]] += chars[i]
        in_links[parents[i]] += in_links[i]
    score = [(points[i] + weights[i]) * (1 - in_links[i] / chars[i]) if points[i] and chars[i] else 0.0 for i in range(n)]
    best = max(range(n), key=lambda i: (score[i], -i))
    if not score[best]:
        best = 0
    while tags[best] == "#" or tags[best] in PARAGRAPHS:
        if parents[best] < 0:
            break
        best = parents[best]
    floor = max(10.0, 0.2 * score[best])
    kept = [False] * n
    for i in range(n):
        if i and kept[parents[i]] or i == best:
            kept[i] = True
        elif i and parents[i] == parents[best] and chars[i]:
            density = in_links[i] / chars[i]
            kept[i] = score[i] >= floor or tags[i] in HEADINGS and density < 0.25 or tags[i] == "p" and density < 0.25 and chars[i] > 80
    return " ".join(text for owner, text, _ in blocks if kept[owner])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: page_id, url, text and n_chars (its code points).

    Pages are parsed whole. Null or empty html and pages without text give an empty text; repeated
    rows are handled apart; other columns are ignored. Menus, page headers, footers, side bars,
    notices, adverts, forms and reader comments are left out by element or by class, id and role.
    """

    def extract(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
