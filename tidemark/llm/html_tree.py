"""Main text of web pages by tree scoring."""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import slices

# Element names of HTML, and the words by which pages name their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas select xmp noembed".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead tr ul""".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li td th dd dt pre blockquote figcaption caption summary".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
          "tfoot": {"thead", "tbody", "tr", "td", "th"}}
SCOPE = frozenset("table ul ol dl body html article section div main td th button".split())
ASIDE_TAGS = frozenset("nav footer aside form button dialog menu head".split())
ASIDE_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
ASIDE_WORDS = frozenset("""ad ads adv advert advertisement advertising adsense adbox adslot sponsor sponsored promo
promotion banner sidebar sidenav rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie
cookies consent gdpr notice notices alert popup modal overlay comment comments commentlist disqus respond replies
discussion share sharing social related recommended newsletter subscribe subscription signup login search widget
widgets pager pagination toolbar skip hidden teaser teasers trending""".split())
#: Words that say nothing beside others: a name of these and of ASIDE_WORDS alone is plain, any other only a hint.
LAYOUT_WORDS = frozenset("""list box wrap wrapper container bar area block item items section inner outer left right top
bottom link links row col column grid panel form thread button buttons icons icon""".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies discussion".split())
MAIN_WORDS = frozenset("article content entry main post story text body blog page".split())
CONTAINER_BONUS = {"article": 25.0, "main": 15.0, "section": 3.0, "div": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0,
                   "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "dd": -3.0, "dt": -3.0, "address": -3.0, "th": -5.0}

_TAG = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_TAG_END = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WRAPPED = re.compile(r"<(?:article|main|section|div|p|h[1-6]|ul|ol|dl|table|blockquote)[\s/>]", re.I)
_CLOSING = re.compile(r"</([a-zA-Z][^\s/>]*)")

#: Share of link text from which a list, table or box with several links is a menu, and from which a sibling of the
#: best container is left out; share of an article's score from which a sibling of it is kept.
MENU_DENSITY, SIBLING_DENSITY, SIBLING_SHARE = 0.66, 0.5, 0.2
#: Share of the container's points that a sibling of an element around it needs.
LEVEL_SHARE = 0.3
#: Points that an element whose name only hints at something beside the article needs to stay.
HINT_POINTS = 3.0
#: What a name says: nothing, beside the article, comments, or a hint.
PLAIN, BESIDE, COMMENTS, HINT = 0, 1, 2, 3


class _Page:
    """Elements in page order (parents before children) and the blocks of text outside dropped elements."""

    def __init__(self):
        self.tag, self.parent, self.bonus, self.links, self.named = ["#root"], [-1], [0.0], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []  # owner, text, characters inside links

    def add(self, tag: str, parent: int, bonus: float, named: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.bonus.append(bonus)
        self.links.append(0)
        self.named.append(named)
        return len(self.tag) - 1


def _judge(tag: str, attrs: str, inside_article: bool) -> tuple[bool, float, int]:
    """Whether an element is beside the article, the bonus of its tag and name, and what the name says."""
    bonus = CONTAINER_BONUS.get(tag, 0.0)
    if tag in ASIDE_TAGS or (tag == "header" and not inside_article):
        return True, bonus, 0
    if not attrs or tag in ("body", "html"):
        return False, bonus, 0
    words: set[str] = set()
    named_main, plain = tag == "main", False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, bonus, 0
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, bonus, 0
        if name == "role" and value.lower() in ASIDE_ROLES:
            return True, bonus, 0
        if name in ("class", "id"):
            for part in value.split():
                own = {w.lower() for w in _WORD.findall(part)}
                words |= own
                plain = plain or bool(own & ASIDE_WORDS - {"skip"} and own <= ASIDE_WORDS | LAYOUT_WORDS)
                named_main = named_main or bool(own & MAIN_WORDS and not own & ASIDE_WORDS)
    main = words & MAIN_WORDS
    if words & ASIDE_WORDS and not named_main and not (tag == "article" and main):
        return False, bonus - 10.0, COMMENTS if words & COMMENT_WORDS else BESIDE if plain else HINT
    return False, bonus + (10.0 if main else 0.0), PLAIN


class _Ahead:
    """What stands further on in a page, found in one pass when it is first asked for."""

    def __init__(self, html: str):
        self.html, self.blocks, self.closes = html, None, {}

    def holds_blocks(self, at: int, tag: str) -> bool:
        """Whether a block element begins before the next closing tag of this name."""
        if self.blocks is None:
            self.blocks = [m.start() for m in _WRAPPED.finditer(self.html)]
            for m in _CLOSING.finditer(self.html):
                self.closes.setdefault(m[1].lower(), []).append(m.start())
        i = bisect_left(self.blocks, at)
        closes = self.closes.get(tag, ())
        j = bisect_left(closes, at)
        return i < len(self.blocks) and (j == len(closes) or self.blocks[i] < closes[j])


class _Open:
    """The open elements: tag, nearest block element's number, dropped, inside an article, inside a link. The depths of
    every tag, of scopes and of blocks are at hand, so no question walks down the stack."""

    def __init__(self):
        self.stack = [("#root", 0, False, False, False)]
        self.depths: dict[str, list[int]] = {}
        self.scopes, self.blocks = [0], [0]

    def push(self, entry: tuple) -> None:
        depth, tag = len(self.stack), entry[0]
        self.stack.append(entry)
        self.depths.setdefault(tag, []).append(depth)
        if tag in SCOPE:
            self.scopes.append(depth)
        if tag in BLOCK:
            self.blocks.append(depth)

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop()[0]
            self.depths[tag].pop()
            if tag in SCOPE:
                self.scopes.pop()
            if tag in BLOCK:
                self.blocks.pop()

    def nearest(self, tags) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)


def _parse(html: str) -> _Page:
    """One forward scan. A tag whose quotes never close ends at the next `>`, and from there on quotes do not count."""
    page, open_, ahead = _Page(), _Open(), _Ahead(html)
    stack = open_.stack
    pieces: list[str] = []
    linked, quotes = 0, True

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                page.blocks.append((stack[-1][1], text, min(linked, len(text))))
            pieces.clear()
            linked = 0

    def pop_to(depth: int):
        if stack[-1][1] != stack[depth - 1][1] or open_.blocks[-1] >= depth:
            flush()
        open_.pop_to(depth)

    def say(text: str):
        nonlocal linked
        if text and not stack[-1][2]:
            pieces.append(text)
            if stack[-1][4]:
                linked += len(unescape(text).strip())

    at, end = 0, len(html)
    while at < end:
        less = html.find("<", at)
        if less < 0:
            say(html[at:])
            break
        say(html[at:less])
        sign = html[less + 1:less + 2]
        if html.startswith("<!--", less):
            close = html.find("-->", less + 4)
            at = close + 3 if close >= 0 else end
            continue
        m = _TAG.match(html, less + 1)
        if not m:
            if sign in ("!", "?", "/") and sign:
                close = html.find(">", less)
                at = close + 1 if close >= 0 else end
            else:
                say("<")
                at = less + 1
            continue
        rest = _TAG_END.match(html, m.end()) if quotes else None
        if rest:
            attrs, at = rest[1], rest.end()
        else:
            close = html.find(">", m.end())
            if close < 0:  # a tag that the page's end cuts off
                break
            quotes, attrs, at = False, html[m.end():close], close + 1
        tag = m[1].lower()
        if sign == "/":
            depth = open_.nearest((tag,))
            if depth and (tag in BLOCK or depth > open_.blocks[-1]):
                pop_to(depth)
            continue
        if tag in VOID:
            if tag == "br":
                say(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in RAW:
            if not attrs.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                at = html.find(">", close.start()) + 1 or end if close else end
            continue
        shut = ({"p"} if tag in BLOCK else set()) | CLOSES.get(tag, set())
        while (depth := open_.nearest(shut)) and depth >= open_.scopes[-1]:
            pop_to(depth)
        _, owner, dropped, inside, link = stack[-1]
        beside, bonus, named = _judge(tag, attrs, inside)
        wraps = tag in BLOCK
        if named and not wraps:  # inside a line there is nothing to weigh, unless blocks stand in it
            wraps = ahead.holds_blocks(at, tag)
            beside = not wraps and named != HINT
        if wraps:
            flush()
            if not dropped and not beside:
                owner = page.add(tag, owner, bonus, named)
        if tag == "a" and not dropped:
            page.links[owner] += 1
        open_.push((tag, owner, dropped or beside, inside or tag in ("article", "main"), link or tag == "a"))
    flush()
    return page


def _share(text: str) -> float:
    """A paragraph's points: for being one, its commas and its length."""
    return 1.0 + text.count(",") + min(len(text) / 100, 3.0)


def _drop_named(page: _Page) -> None:
    """Takes out the elements that by their names are beside the article, unless they hold it.

    One whose name only hints at that stays if its paragraphs have points enough. One that holds most of the text of all
    article and main elements stays. So does one that holds most of the page's
    text, unless it names comments and a tenth of the text is elsewhere, or stands outside article and main elements
    that hold a quarter of the text.
    """
    if not any(page.named):
        return
    n = len(page.tag)
    inside = [False] * n  # an article or main element that is not named itself, or in one
    for i in range(1, n):
        inside[i] = inside[page.parent[i]] or (page.tag[i] in ("article", "main") and not page.named[i])
    size, own = [0] * n, [0] * n  # text outside links, and the part of it in article or main elements below
    whole, points = [0] * n, [0.0] * n
    for owner, text, in_links in page.blocks:
        size[owner] += len(text) - in_links
        whole[owner] += len(text)
        points[owner] += _share(text)
    for i in range(n - 1, 0, -1):
        if page.tag[i] in ("article", "main") and not page.named[i]:
            own[i] = size[i]
        for sums in (size, own, whole, points):
            sums[page.parent[i]] += sums[i]
    drop = [False] * n
    for i in range(1, n):
        drop[i] = drop[page.parent[i]]
        if page.named[i] and not drop[i]:
            holds = own[i] > 0 and 2 * own[i] >= own[0]
            most = 2 * size[i] > size[0]
            if page.named[i] == HINT and (points[i] - HINT_POINTS) * size[i] > 0:
                most = most or 4 * size[i] > 3 * whole[i]
            elif page.named[i] == COMMENTS:
                most = most and 10 * (size[0] - size[i]) < size[0]
            elif not inside[i]:
                most = most and 4 * (own[0] - own[i]) < size[0]
            drop[i] = not (holds or most)
    page.blocks = [b for b in page.blocks if not drop[b[0]]]
    page.links = [0 if d else x for d, x in zip(drop, page.links)]


def _within(page: _Page, i: int, top: int) -> bool:
    while i > top:
        i = page.parent[i]
    return i == top


def main_text(html: str | None) -> str:
    """The article's blocks, joined by line ends; empty where a page has no text."""
    page = _parse(html or "")
    _drop_named(page)
    if not page.blocks:
        return ""
    n = len(page.tag)
    points, prose_in, size, linked = [0.0] * n, [0.0] * n, [0] * n, [0] * n
    links = page.links[:]
    scored = [False] * n
    for owner, text, in_links in page.blocks:
        size[owner] += len(text)
        linked[owner] += in_links
        share = _share(text)
        prose_in[owner] += share
        up = page.parent[owner] if page.tag[owner] in PARAGRAPH and owner else owner
        for level in range(6):
            points[up] += share / (1 if level == 0 else 2 if level == 1 else 3 * level)
            scored[up] = True
            if (up := page.parent[up]) < 0:
                break
    for i in range(n - 1, 0, -1):
        size[page.parent[i]] += size[i]
        prose_in[page.parent[i]] += prose_in[i]
        linked[page.parent[i]] += linked[i]
        links[page.parent[i]] += links[i]

    def density(i: int) -> float:
        return linked[i] / size[i] if size[i] else 0.0

    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[page.parent[i]].append(i)
    score = [(points[i] + page.bonus[i]) * (1 - density(i)) if scored[i] else 0.0 for i in range(n)]
    best = max((i for i in range(n) if scored[i]), key=lambda i: (score[i], i))
    up = best
    while up > 0:  # an article or main element around the best container is the container
        if page.tag[up] in ("article", "main"):
            best = up
        up = page.parent[up]

    keep = [False] * n
    keep[best] = True
    marked = page.tag[best] in ("article", "main")
    level, path = 0, best
    while path > 0:  # the container and each element around it, with their siblings
        least = max(10.0, SIBLING_SHARE * score[best])
        for i in children[page.parent[path]]:
            if i == path or not size[i] or page.tag[i] in ("html", "body"):
                continue
            if marked:
                plain = page.tag[i] == "p" and density(i) < 0.25 and size[i] > 80
                alike = score[i] >= least and page.tag[i] not in ("ul", "ol")
                keep[i] = keep[i] or level == 0 and (page.tag[i] == "h1" or plain or alike)
            else:
                alike = level == 0 or prose_in[i] * (1 - density(i)) >= LEVEL_SHARE * prose_in[best]
                keep[i] = density(i) < SIBLING_DENSITY and page.named[i] in (PLAIN, HINT) and alike
        path, level = page.parent[path], level + 1
    if marked:  # a headline that stands before an article without one
        heads = [k for k, (owner, _, _) in enumerate(page.blocks) if page.tag[owner] == "h1"]
        inside = set(heads) & {k for k, (owner, _, _) in enumerate(page.blocks) if _within(page, owner, best)}
        before = [page.blocks[k][0] for k in heads if page.blocks[k][0] < best]
        if before and not inside:
            keep[before[-1]] = True
    menu = [False] * n
    article = [False] * n  # the best container and all in it, unless it is the page itself
    article[best] = page.tag[best] not in ("#root", "html", "body")
    for i in range(1, n):
        up = page.parent[i]
        keep[i] = keep[i] or keep[up]
        article[i] = article[i] or article[up]
    # A container that no article or main element marks may begin with a menu; after its first prose none is taken for one.
    prose = best if page.tag[best] in ("article", "main") else min(
        (owner for owner, text, in_links in page.blocks
         if article[owner] and 2 * in_links < len(text) and (page.tag[owner] == "p" or len(text) > 80)), default=best)
    for i in range(1, n):
        up = page.parent[i]
        menu[i] = menu[up] or (not (article[i] and i >= prose) and page.tag[i] not in PARAGRAPH and i != best
                               and links[i] > 1 and density(i) > MENU_DENSITY)
    return "\n".join(text for owner, text, _ in page.blocks if keep[owner] and not menu[owner])


def _extracted(batches):
    for batch in slices(batches, 2):
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                         ["page_id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    Paragraphs give points for their length and commas to the elements around them, less with each level; an element's
    score is what it gathers and what its name says, times the share of its text outside links. The best container is
    kept (an article or main element around it, if there is one). Of its siblings all stay that are less than half
    links, and of the siblings of the elements around it those with alike points; beside an article or main element only
    siblings that score alike, and the last headline before one that has none. Menus outside the container or before its
    prose, page headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles are left out wherever
    they are. An element that only its class or id calls so stays if it holds the article or most of the page's text, or,
    where that name has other words as well, if its paragraphs have points enough.
    Character references are decoded, white space inside a block becomes one space, blocks are joined by one line end in
    page order. The time for a page grows with its length, whatever it holds.

    Null html counts as empty; a page without text gives an empty text. Null identifiers and addresses are kept, each
    row gives a row. Whole pages of any length are read. Other columns are not. No rows give no rows.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return (rows.mapInArrow(_extracted, "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
