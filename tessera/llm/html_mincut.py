"""Main text of web pages by minimum-cut labelling.

A page is read into blocks of text. A classifier, trained here on pages that a
rule lays out, gives each block the cost of being called boilerplate or
content; these costs are its capacities to source and sink. Blocks that follow
each other, and blocks of one parent, are tied by smoothness edges whose
capacity falls with their distance in the tree. The maximum flow separates
content from boilerplate at the least total cost.
"""

from __future__ import annotations

import html
import random
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Markup tokens: comments, declarations, tags (quoted values may hold ``>``),
#: tags with an open quote, text, and a single ``<``.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no text of the page.
SKIPPED = frozenset("script style template noscript iframe textarea select title head "
                    "audio video canvas map datalist".split())
#: Elements that may stand in a head; any other closes it, as its end tag may
#: be left out.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark "
                   "q s samp small span strike strong sub sup time tt u var wbr label math semantics mrow mi mn mo "
                   "ms mtext mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

FLAGS = ("link", "nav", "header", "footer", "aside", "form", "advert", "notice", "comment", "share",
         "main", "named_main", "heading", "paragraph", "item", "control", "hidden", "quote")
BIT = {name: 1 << n for n, name in enumerate(FLAGS)}
BY_TAG = {"a": "link", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer",
          "aside": "aside", "form": "form", "button": "control", "label": "control",
          "legend": "control", "fieldset": "form", "dialog": "notice", "article": "main",
          "main": "main", "p": "paragraph", "li": "item", "dt": "item", "dd": "item",
          "blockquote": "quote", "pre": "quote", **{f"h{n}": "heading" for n in range(1, 7)}}
BY_ROLE = {"navigation": "nav", "menu": "nav", "menubar": "nav", "banner": "header", "alert": "notice",
           "contentinfo": "footer", "complementary": "aside", "search": "form", "form": "form",
           "dialog": "notice", "alertdialog": "notice", "main": "main", "article": "main"}
#: Words of class and id values.
BY_WORD = {
    "nav": "nav navbar navigation menu menus breadcrumb breadcrumbs topbar pagination pager toc tabs",
    "header": "header masthead banner sitehead logo branding",
    "footer": "footer foot colophon copyright legal imprint",
    "aside": "sidebar aside rail widget widgets related recommended recommendations trending popular "
             "more teaser teasers",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
              "promoted adsense dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
              "subscribe subscription paywall warning disclaimer announcement",
    "comment": "comment comments commentlist reply replies respond disqus discussion responses "
               "guestbook",
    "share": "share sharing social meta byline tags taglist toolbar print rating author",
    "form": "form login signup signin register search searchbox",
    "hidden": "hidden invisible offscreen",
    "named_main": "article content post entry story body text main maincontent articlebody page",
}
WORD_FLAG = {w: BIT[flag] for flag, words in BY_WORD.items() for w in words.split()}
SPLIT_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
BOILERPLATE = re.compile(r"©|\(c\) ?\d{4}|copyright|all rights reserved|cookie|privacy policy|terms of "
                         r"(?:use|service)|subscribe|sign (?:in|up)|log ?in|newsletter|advertis|read more|"
                         r"share this|follow us|click here|leave a (?:reply|comment)", re.I)
#: Smoothness of blocks that follow each other, and of one parent's blocks.
ADJACENT, SIBLING = 1.0, 0.6
MAX_COST, UNIT = 8.0, 1000


class Place:
    """A block element among those around it."""

    __slots__ = ("parent", "depth")

    def __init__(self, parent: Place | None):
        self.parent, self.depth = (parent, parent.depth + 1) if parent else (self, 0)

    def steps_to(self, other: Place) -> int:
        """Elements to leave and to enter on the way; between blocks that follow
        each other no more than the page has tags there."""
        a, b, steps = self, other, 0
        while a is not b:
            steps += 1
            if a.depth >= b.depth:
                a = a.parent
            else:
                b = b.parent
        return steps


class Block:
    __slots__ = ("text", "linked", "flags", "place")

    def __init__(self, text: str, linked: int, flags: int, place: Place):
        self.text, self.linked, self.flags, self.place = text, linked, flags, place


def _own_flags(tag: str, attributes: str) -> int:
    flags = BIT[BY_TAG[tag]] if tag in BY_TAG else 0
    if not attributes or tag in ("html", "body"):
        return flags
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            for word in SPLIT_NAME.findall(value):
                flags |= WORD_FLAG.get(word.lower(), 0)
        elif name == "role":
            flags |= BIT[BY_ROLE[value.lower()]] if value.lower() in BY_ROLE else 0
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or \
                name == "style" and "display:none" in value.replace(" ", "").lower():
            flags |= BIT["hidden"]
    return flags


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order. Character references are decoded
    and white space in a block is one space; elements left open are closed
    where their parents end."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []          # tag, flags with those of parents
    place = top = Place(None)                  # the innermost open block element
    open_tags: dict[str, int] = {}
    parts: list[str] = []
    linked = flags = at = 0
    where, said = top, False                   # of the block; whether it has any text so far

    def flush() -> None:
        nonlocal linked, said
        said = False
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, min(linked, len(text)), flags, where))
            parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal place
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        if tag not in INLINE:
            place = place.parent

    scan = TOKEN.scanner(page).match
    while (m := scan()) is not None:
        token = m[0]
        if token[0] != "<" or token == "<":
            if stack and stack[-1][1] & SKIP_BIT:
                continue
            text = html.unescape(token) if "&" in token else token
            now = stack[-1][1] if stack else 0
            if not said:
                flags, where, said = now & ~BIT["link"], place, bool(text.strip())
            parts.append(text)
            if now & BIT["link"]:
                linked += len(text.strip())
            continue
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if open_tags.get("head") and not closing and tag not in IN_HEAD and stack[-1][0] == "head":
            pop()
        if closing:
            if open_tags.get(tag):
                if tag not in INLINE:
                    flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag == "p":
                flush()
            continue
        if tag in ("br", "wbr", "img", "hr", "input") or tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
            drop = CLOSES.get(tag, ())
            k = len(stack)
            while k and (stack[k - 1][0] in INLINE or stack[k - 1][0] == "p" or stack[k - 1][0] in drop):
                k -= 1
                if stack[k][0] == "p" or stack[k][0] in drop:
                    while len(stack) > k:
                        pop()
        above = stack[-1][1] if stack else 0
        own = _own_flags(tag, attributes)
        if own & BIT["header"] and above & (BIT["main"] | BIT["named_main"]):
            own &= ~BIT["header"]
        if tag in SKIPPED:
            own |= SKIP_BIT
        if not attributes.endswith("/"):
            stack.append((tag, above | own))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            if tag not in INLINE:
                place = Place(place)
        if tag in RAW:
            end = re.compile(rf"</{tag}", re.I).search(page, m.end())
            at = end.start() if end else len(page)
            scan = TOKEN.scanner(page, at).match
    flush()
    return out


SKIP_BIT = 1 << len(FLAGS)
#: Flags that say where a block stands; of ``form`` and the like.
PLACES = tuple(f for f in FLAGS if f != "link")


def features(block: Block) -> list[float]:
    text, n = block.text, len(block.text)
    return [1.0, min(np.log1p(n), 7.0) / 5, block.linked / n, float(text[-1] in ".!?…。»”\"'"),
            min(sum(text.count(c) for c in ",.;:") / n * 20, 2.0), float(n < 25),
            float(BOILERPLATE.search(text) is not None and n < 300),
            *[float(bool(block.flags & BIT[f])) for f in PLACES]]


def seed_pages(n: int = 160, seed: int = 7) -> Iterator[tuple[str, list[str]]]:
    """Pages laid out by a rule, with the texts of their content: the same
    parts as tags, roles, class names or without any name, in many mixtures."""
    rnd = random.Random(seed)

    def sentence(low: int, high: int) -> str:
        words = ["".join(rnd.choice("bcdfglmnprstv") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))
                 for _ in range(rnd.randint(low, high))]
        if len(words) > 6 and rnd.random() < 0.6:
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + rnd.choice(["."] * 8 + ["", "!"])

    def links(k: int) -> str:
        return "".join(f'<li><a href="#">{sentence(1, 3)[:-1]}</a></li>' for _ in range(k))

    def wrap(choices: list[str], inner: str) -> str:
        opening = rnd.choice(choices)
        return f"<{opening}>{inner}</{opening.split()[0]}>"

    for _ in range(n):
        content: list[str] = []
        body = []
        if rnd.random() < 0.9:
            content.append(sentence(3, 9))
            body.append(f"<h1>{content[-1]}</h1>")
        for _ in range(rnd.randint(1, 9)):
            content.append(" ".join(sentence(1 if rnd.random() < 0.2 else 5, 16)
                                    for _ in range(rnd.randint(1, 6))))
            kind = rnd.choice(["p"] * 8 + ["h2", "li", "blockquote", "div"])
            if rnd.random() < 0.15:
                k = content[-1].split()
                body.append(f"<{kind}>{k[0]} <a href='#'>{' '.join(k[1:3])}</a> {' '.join(k[3:])}</{kind}>")
                content[-1] = " ".join(k)
            else:
                body.append(f"<{kind}>{content[-1]}</{kind}>")
            if rnd.random() < 0.12:
                items = [sentence(1, 5) for _ in range(rnd.randint(2, 6))]
                content += items
                body.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
            if rnd.random() < 0.06:
                body.append(wrap(['div class="share-bar"', 'div class="byline"', 'div style="display:none"',
                                  "p hidden"], sentence(2, 10)))
            if rnd.random() < 0.12:
                body.append(wrap(['div class="ad"', "aside", 'div class="related"', 'div class="promo-box"'],
                                 f"<p>{sentence(2, 12)}</p>"))
        comments = "".join(f"<div class='comment'><p>{sentence(3, 25)}</p></div>"
                           for _ in range(rnd.randint(1, 4))) if rnd.random() < 0.4 else ""
        comments = comments and wrap(['section id="comments"', 'div class="comment-list"'], comments)
        inside = rnd.random() < 0.5
        top = [wrap(["nav", 'div class="menu"', 'ul id="navbar"', 'div role="navigation"', "div"],
                    f"<ul>{links(rnd.randint(3, 8))}</ul>")]
        if rnd.random() < 0.6:
            top.insert(0, wrap(["header", 'div id="header"', "div class='masthead'"], f"<p>{sentence(1, 6)}</p>"))
        if rnd.random() < 0.6:
            top.append(wrap(['div class="ad"', 'div class="sponsored"', 'div id="ads-top"'], sentence(2, 15)))
        if rnd.random() < 0.4:
            top.append(wrap(['div class="cookie-notice"', 'div role="dialog"', 'div class="alert"'],
                            f"<p>{sentence(5, 20)}</p><button>{sentence(1, 2)}</button>"))
        end = [wrap(["footer", 'div class="footer"', 'div role="contentinfo"'],
                    rnd.choice(["&copy; ", "", "Copyright "]) + sentence(2, 14))]
        if rnd.random() < 0.5:
            end.insert(0, wrap(["aside", 'div class="sidebar"', 'div role="complementary"'],
                               f"<h3>{sentence(1, 3)}</h3><p>{sentence(4, 20)}</p><ul>{links(4)}</ul>"))
        if rnd.random() < 0.4:
            end.insert(0, wrap(["form", 'form class="search"', 'div class="newsletter"'],
                               f"<label>{sentence(1, 3)}</label><p>{sentence(3, 10)}</p><input>"))
        main = wrap(["article", "main", 'div class="content"', 'div id="article-body"', "div", "div"],
                    "".join(body) + (comments if inside else ""))
        page = "".join(top) + main + ("" if inside else comments) + "".join(end)
        yield f"<html><head><title>x</title></head><body>{page}</body></html>", content


def train() -> np.ndarray:
    """Weights of a logistic regression on the seed pages' blocks."""
    x, y = [], []
    for page, content in seed_pages():
        held = set(content)
        for block in blocks_of(page):
            x.append(features(block))
            y.append(float(block.text in held))
    x, y = np.array(x), np.array(y)
    w, ridge = np.zeros(x.shape[1]), 0.3 * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
    return w


def edges_of(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges ``(i, j, capacity)``."""
    out, last = [], {}
    for j, b in enumerate(blocks):
        if j:
            steps = max(blocks[j - 1].place.steps_to(b.place) - 2, 0)  # 0: blocks of one parent
            out.append((j - 1, j, round(UNIT * ADJACENT / (1 + steps))))
        parent = b.place.parent
        i = last.get(parent)
        if i is not None and i != j - 1:
            out.append((i, j, round(UNIT * SIBLING)))
        last[parent] = j
    return out


def min_cut(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source. ``costs``: capacity from the source
    if positive, to the sink if negative; edges hold both ways. Maximum flow
    by shortest augmenting phases over level graphs."""
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def tie(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(costs):
        if c > 0:
            tie(source, i, c, 0)
        elif c < 0:
            tie(i, sink, -c, 0)
    for a, b, c in edges:
        tie(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        nth = [0] * (n + 2)
        way: list[int] = []
        a = source
        while True:
            if a == sink:
                push = min(room[e] for e in way)
                for e in way:
                    room[e] -= push
                    room[e ^ 1] += push
                full = next(k for k, e in enumerate(way) if not room[e])
                a = to[way[full] ^ 1]  # on from before the first full edge
                del way[full:]
                continue
            while nth[a] < len(out[a]):
                e = out[a][nth[a]]
                if room[e] > 0 and level[to[e]] == level[a] + 1:
                    way.append(e)
                    a = to[e]
                    break
                nth[a] += 1
            else:
                if a == source:
                    break
                e = way.pop()
                a = to[e ^ 1]
                nth[a] += 1


def main_text(page: str | None, weights: np.ndarray) -> str:
    """Content blocks of a page, one a line (null or no content: empty)."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    logits = np.clip(np.array([features(b) for b in blocks]) @ weights, -MAX_COST, MAX_COST)
    costs = np.rint(logits * UNIT).astype(int).tolist()
    if min(costs) >= 0 or max(costs) <= 0:
        kept = [c > 0 for c in costs]
    else:
        kept = min_cut(costs, edges_of(blocks))
    return "\n".join(b.text for b, k in zip(blocks, kept) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Rows ``(page_id, url, text)``, one for each row of ``pages``.

    Null, empty and malformed pages give what text their content has, or the
    empty text; null ids and urls stay null; repeated rows each come back;
    pages are read whole; other columns are not read.
    """
    weights = train()

    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(x, weights) for x in batch], dtype=object)

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.pandas_udf(text, "string")(F.col(html_col)).alias("text"))
