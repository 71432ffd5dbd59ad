"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded as a hierarchy.

A page is read into its block elements; text runs between block tags are the blocks.
Each element gets features of its subtree (text, link and sentence density, share and
place in the page), its attribute tokens, tag, depth and siblings.  Boosted regression
trees give the log-odds that it holds article text.  The decoding then picks the best
consistent choice for the whole tree: an element that is dropped drops all it contains,
one that is kept is inside kept ones only; so an advert inside the article goes, and a
long paragraph inside a comment box goes with the box.

The trees are trained on generated pages (``training_pages``), whose layouts, tags and
attribute names vary and whose article parts are known; nothing is read from the data.
Their number and the number of pages are parameters, so the model's size is bounded.

NULL and empty pages, and pages without text, give ''; broken markup is read tolerantly;
repeated rows give repeated results; other columns are ignored.  The content of scripts, styles, templates,
titles and form controls is never text; that of formulas, objects, drawings, frames and noscript is judged as any other.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from bisect import bisect
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import rows_of

PAGES = 1200           # generated training pages
TREES = 80
DEPTH = 4
RATE = 0.2
BINS = 16
TOKENS = 96            # attribute tokens that are features

_BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
             "summary table tbody td tfoot th thead tr ul".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never text of the page.
_SKIP = set("script style template title textarea select button".split())
#: Elements of their own between blocks, part of the text inside one.
_EMBEDDED = set("noscript iframe object svg canvas audio video".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}}
_STOPS = {"ul", "ol", "menu", "dl", "table"}
_TAGS = ["nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "li", "ul", "ol",
         "dl", "table", "td", "figure", "figcaption", "blockquote", "pre", "body"]

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_REST = re.compile(r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
_QUOTED = re.compile(r""""[^"]*(?:"|$)|'[^']*(?:'|$)""")
_ATTR = re.compile(r"""(class|id|role|aria-label|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SENTENCE = re.compile(r"[.!?…。！？](?=\s|$|[\"'»”])")


@dataclass
class Page:
    """Block elements in page order (an element comes before what it contains), and blocks."""
    parent: list = field(default_factory=list)
    tag: list = field(default_factory=list)
    attrs: list = field(default_factory=list)
    controls: list = field(default_factory=list)      # form controls directly inside
    inline: list = field(default_factory=list)        # inline tags directly inside
    blocks: list = field(default_factory=list)        # (element, text, characters in links)


def read_page(source: str) -> Page:
    page = Page()
    parent, tags, attrs = page.parent, page.tag, page.attrs

    def open_(tag, rest):
        parent.append(stack[-1] if stack else -1)
        tags.append(tag)
        attrs.append(rest)
        page.controls.append(0)
        page.inline.append(0)
        stack.append(len(tags) - 1)

    stack: list[int] = []
    open_("html", "")
    parts: list[str] = []
    linked = 0
    in_link = False

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                page.blocks.append((stack[-1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    at, n = 0, len(source)
    quoted: list[list[int]] = []  # starts and ends of the quoted strings after a tag that never ends outside them
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            parts.append(source[at:lt])
            if in_link:
                linked += lt - at
        if lt == n:
            break
        nxt = source[lt + 1:lt + 2]
        if nxt == "!" or nxt == "?":
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = source.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        closing = nxt == "/"
        name = _NAME.match(source, lt + 1 + closing)
        if name is None:
            parts.append("<")
            at = lt + 1
            continue
        # a tag outside those strings doesn't end either, and needn't be read to the page's end again
        lost = any(bisect(q, name.end()) % 2 == 0 for q in quoted)
        rest = None if lost else _REST.match(source, name.end())
        if rest is None:
            if not lost:
                quoted.append([x for m in _QUOTED.finditer(source, name.end()) for x in m.span()])
            end = source.find(">", name.end())        # its quotes don't match: it ends at the first >
            end = n if end < 0 else end + 1
        else:
            end = rest.end()
        tag, inside, at = name.group().lower(), source[name.end():max(name.end(), end - 1)], end
        if tag in _SKIP:
            if closing or inside.endswith("/"):
                continue
            if tag in ("textarea", "select", "button"):
                page.controls[stack[-1]] += 1
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
            if close:
                end = source.find(">", close.end())
                at = n if end < 0 else end + 1
            elif tag not in ("select", "button"):
                at = n
            parts.append(" ")
            continue
        alone = tag in _EMBEDDED and (any(tags[k] == tag for k in stack) if closing else tags[stack[-1]] != "p" and not any(map(str.strip, parts)))
        if tag not in _BLOCK and not alone:
            if tag == "a":
                in_link = not closing
            elif tag == "br":
                parts.append(" ")
            elif tag == "input":
                page.controls[stack[-1]] += 1
            if not closing:
                page.inline[stack[-1]] += 1
            continue
        flush()
        in_link = False
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]] == tag:
                    del stack[k:]
                    break
            continue
        if tag in ("html", "body") and tag in tags:
            if tag == "html":
                continue
        if tags[stack[-1]] == "p":
            stack.pop()
        ends = _ENDS.get(tag)
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                t = tags[stack[k]]
                if t in ends:
                    del stack[k:]
                    break
                if t in _STOPS:
                    break
        open_(tag, inside)
        if tag in _VOID or (inside.endswith("/") and (alone or tag == "hr")):
            stack.pop()
    flush()
    return page


def attribute_tokens(attrs: str) -> set[str]:
    if "=" not in attrs:
        return set()
    out = set()
    for _, value in _ATTR.findall(attrs):
        out.update(_PART.findall(_CAMEL.sub(r"\1 \2", value).lower()))
    return out


# --- features ------------------------------------------------------------------------------

NUMERIC = 22


def features(page: Page, vocabulary: dict[str, int]) -> np.ndarray:
    """A row for each element."""
    n = len(page.tag)
    parent, tag = page.parent, page.tag
    depth, kids, place = [0] * n, [0] * n, [0] * n
    same: list[Counter] = [Counter() for _ in range(n)]
    for k in range(1, n):
        p = parent[k]
        depth[k] = depth[p] + 1
        place[k] = kids[p]
        kids[p] += 1
        same[p][tag[k]] += 1
    chars, links, sents, words, blocks, own = ([0] * n for _ in range(6))
    items, paras = [int(t == "li") for t in tag], [int(t == "p") for t in tag]
    controls, markup = list(page.controls), [1 + x for x in page.inline]
    first, last = [math.inf] * n, [0] * n
    in_text, in_rest = [0] * n, [0] * n              # article or main above; nav, aside, footer, header or form above
    for k in range(1, n):
        p = parent[k]
        in_text[k] = in_text[p] or int(tag[p] in ("article", "main"))
        in_rest[k] = in_rest[p] or int(tag[p] in ("nav", "aside", "footer", "header", "form"))
    at = 0
    for e, text, linked in page.blocks:
        m = len(text)
        chars[e] += m
        own[e] += m
        links[e] += linked
        sents[e] += len(_SENTENCE.findall(text))
        words[e] += text.count(" ") + 1
        blocks[e] += 1
        first[e] = min(first[e], at)
        at += m
        last[e] = at
    for k in range(n - 1, 0, -1):
        p = parent[k]
        for x in (chars, links, sents, words, blocks, items, paras, controls, markup):
            x[p] += x[k]
        if first[k] < first[p]:
            first[p] = first[k]
        if last[k] > last[p]:
            last[p] = last[k]
    total = max(1, at)
    out = np.zeros((n, NUMERIC + len(_TAGS) + len(vocabulary)), dtype=np.float32)
    for k in range(n):
        p, c, w, b = max(parent[k], 0), chars[k], words[k], max(1, blocks[k])
        out[k, :NUMERIC] = (
            depth[k], place[k], kids[p] if k else 1, place[k] / max(1, kids[p]), math.log1p(c), links[k] / max(1, c),
            c / markup[k], w / b, sents[k] / max(1, w), c / total, (first[k] if c else 0) / total, last[k] / total,
            math.log1p(own[k]), items[k] / b, math.log1p(paras[k]), controls[k],
            int(tag[k][1]) if len(tag[k]) == 2 and tag[k][0] == "h" and tag[k] != "hr" else 0,
            same[p][tag[k]] / max(1, kids[p]), math.log1p((chars[p] - c) / max(1, kids[p] - 1)), chars[p] / total,
            in_text[k], in_rest[k])
        if tag[k] in _TAG_AT:
            out[k, NUMERIC + _TAG_AT[tag[k]]] = 1
        for t in attribute_tokens(page.attrs[k]):
            if t in vocabulary:
                out[k, NUMERIC + len(_TAGS) + vocabulary[t]] = 1
    return out


_TAG_AT = {t: k for k, t in enumerate(_TAGS)}


# --- boosted trees -------------------------------------------------------------------------

class Trees:
    """Gradient-boosted regression trees for the log-odds of a label, on binned features."""

    def __init__(self, base, trees):
        self.base, self.trees = base, trees

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees=TREES, depth=DEPTH, rate=RATE, bins=BINS):
        rng, edges = np.random.default_rng(0), []
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            if len(values) > bins:
                values = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)))
            edges.append((values[1:] + values[:-1]) / 2)
        binned = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)
        mean = np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3)
        score, out = np.full(len(y), math.log(mean / (1 - mean))), []
        base = float(score[0])
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (y - p), weight * p * (1 - p) + 1e-6
            feature, cut, value = np.zeros(2 ** depth - 1, int), np.full(2 ** depth - 1, 10 ** 6), np.zeros(2 ** depth)
            node, columns = np.zeros(len(y), int), np.flatnonzero(rng.random(x.shape[1]) < 0.5)
            for level in range(depth):
                width = 2 ** level
                best, pick = np.full(width, 1e-3), [(0, 10 ** 6)] * width
                for j in columns:
                    m = len(edges[j]) + 1
                    if m < 2:
                        continue
                    cell = node * m + binned[:, j]
                    gs = np.bincount(cell, g, width * m).reshape(width, m).cumsum(1)
                    hs = np.bincount(cell, h, width * m).reshape(width, m).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = (gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1))[:, :-1]
                    at = gain.argmax(1)
                    for q in range(width):
                        if gain[q, at[q]] > best[q]:
                            best[q], pick[q] = gain[q, at[q]], (j, at[q])
                for q, (j, c) in enumerate(pick):
                    feature[width - 1 + q], cut[width - 1 + q] = j, c
                j, c = feature[width - 1 + node], cut[width - 1 + node]
                node = 2 * node + (binned[np.arange(len(y)), j] > c)
            gs, hs = np.bincount(node, g, 2 ** depth), np.bincount(node, h, 2 ** depth)
            value = rate * gs / (hs + 1)
            score = score + value[node]
            # a cut between bins c and c + 1 is the edge c itself: x >= edges[c] goes right
            value_cut = np.array([edges[j][c] if c < len(edges[j]) else np.inf for j, c in zip(feature, cut)])
            out.append((feature, value_cut, value))
        return cls(base, out)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node, width = np.zeros(len(x), int), 1
            while width < len(value):
                k = width - 1 + node
                node = 2 * node + (x[rows, feature[k]] >= cut[k])
                width *= 2
            out += value[node]
        return out


# --- training pages ------------------------------------------------------------------------

#: Names that page layouts use for their parts (fixed values of the generator).
PARTS = {
    "menu": "nav menu navbar navigation topnav mainmenu links breadcrumb breadcrumbs pagination pager",
    "header": "header masthead top topbar banner branding site logo",
    "footer": "footer bottom colophon copyright legal siteinfo",
    "side": "sidebar side aside widget widgets rail related recommended popular trending tags archive toc",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adbox adslot banner outbrain",
    "notice": "cookie cookies consent gdpr notice alert privacy popup modal overlay newsletter subscribe paywall",
    "form": "form search login signup subscribe contact newsletter",
    "share": "share social sharing follow meta byline tools",
    "comments": "comments comment respond replies reply discussion thread disqus feedback reviews",
    "article": "article post content entry story main body text page hentry blog news",
}


def _words(rnd: random.Random, n: int) -> str:
    return " ".join("".join(rnd.choice("bcdfglmnprstv") + rnd.choice("aeiouéä") for _ in range(rnd.randint(1, 4)))
                    for _ in range(n))


def _prose(rnd: random.Random, sentences: int) -> str:
    return " ".join(_words(rnd, rnd.randint(2, 18)).capitalize() + rnd.choice("...!?") for _ in range(sentences))


def _attr(rnd: random.Random, part: str) -> str:
    if rnd.random() < 0.25:
        return ""
    names = PARTS[part].split()
    value = rnd.choice(names)
    if rnd.random() < 0.5:
        value += rnd.choice("- _") + rnd.choice([*names, "box", "wrap", "inner", "list", "area", "block", "section"])
    return f' {rnd.choice(["class", "class", "id"])}="{value}"'


def _inline(rnd: random.Random, text: str) -> str:
    words = text.split(" ")
    if len(words) > 6 and rnd.random() < 0.3:
        k = rnd.randrange(len(words) - 3)
        mark = rnd.choice(['a href="/x"', "b", "em", "span", "strong"])
        words[k:k + 2] = [f"<{mark}>{words[k]} {words[k + 1]}</{mark.split(' ')[0]}>"]
    return " ".join(words)


def _boilerplate(rnd: random.Random, part: str) -> str:
    a = _attr(rnd, part)
    link = lambda n: f'<a href="/{rnd.randrange(999)}">{_words(rnd, rnd.randint(1, n)).capitalize()}</a>'
    if part == "menu":
        tag = rnd.choice(["nav", "nav", "div", "ul"])
        inner = "".join(f"<li>{link(2)}</li>" for _ in range(rnd.randint(3, 12)))
        return f"<{tag}{a}>{inner if tag == 'ul' else f'<ul>{inner}</ul>'}</{tag}>"
    if part == "header":
        tag = rnd.choice(["header", "div"])
        return f"<{tag}{a}><a href='/'>{_words(rnd, 2)}</a><p>{_words(rnd, rnd.randint(2, 8))}</p></{tag}>"
    if part == "footer":
        tag = rnd.choice(["footer", "footer", "div"])
        text = f"&copy; {_words(rnd, 2)} &middot; {_prose(rnd, rnd.randint(1, 3))}"
        return f"<{tag}{a}>{text if rnd.random() < 0.5 else f'<p>{text}</p><p>{link(2)} {link(2)}</p>'}</{tag}>"
    if part == "side":
        tag = rnd.choice(["aside", "div", "section"])
        inner = "".join(f"<li>{link(8)}</li>" if rnd.random() < 0.6 else f"<p>{_prose(rnd, 1)}</p>" for _ in range(rnd.randint(2, 8)))
        return f"<{tag}{a}><h3>{_words(rnd, 2).capitalize()}</h3><ul>{inner}</ul></{tag}>"
    if part == "ad":
        return f"<div{a or ' class=ad'}>{_prose(rnd, rnd.randint(1, 3)) if rnd.random() < 0.7 else link(6)}</div>"
    if part == "notice":
        text = _prose(rnd, rnd.randint(1, 3))
        return f"<div{a or ' class=notice'}>{text if rnd.random() < 0.5 else f'<p>{text}</p>'}{'<button>OK</button>' if rnd.random() < 0.6 else ''}</div>"
    if part == "form":
        return (f"<form{a}><label>{_words(rnd, 2)}</label><input type=text>"
                f"{f'<p>{_prose(rnd, 1)}</p>' if rnd.random() < 0.5 else ''}<button>{_words(rnd, 1)}</button></form>")
    if part == "share":
        return f"<div{a or ' class=share'}>{' '.join(link(1) for _ in range(rnd.randint(2, 5)))} {_words(rnd, 3)}</div>"
    tag = rnd.choice(["section", "div", "ol"])
    name = rnd.choice(PARTS["comments"].split())
    row = "li" if tag == "ol" else rnd.choice(["div", "article", "div"])
    inner = "".join(f'<{row}{_attr(rnd, "comments")}><b>{_words(rnd, 1)}</b><p>{_prose(rnd, rnd.randint(1, 6))}</p></{row}>'
                    for _ in range(rnd.randint(1, 6)))
    head = f"<h3>{_words(rnd, 2).capitalize()}</h3>" if tag != "ol" else ""
    return f'<{tag} {rnd.choice(["class", "id"])}="{name}">{head}{inner}</{tag}>'


def training_page(rnd: random.Random) -> str:
    """A page; elements with article text carry the attribute data-main."""
    main = " data-main"
    body = []
    if rnd.random() < 0.85:
        body.append(f"<h{rnd.choice('112')}{main}>{_words(rnd, rnd.randint(2, 12)).capitalize()}</h1>")
    for _ in range(int(2 ** rnd.uniform(0, 5.5)) if rnd.random() < 0.8 else rnd.randint(0, 3)):
        r = rnd.random()
        if r < 0.72:
            body.append(f"<p{main}>{_inline(rnd, _prose(rnd, rnd.randint(1, 9)) if rnd.random() < 0.75 else _words(rnd, rnd.randint(1, 5)).capitalize() + rnd.choice([".", ""]))}{rnd.choice(['</p>', '</p>', '</p>', '<br>', ''])}")
        elif r < 0.80:
            body.append(f"<h{rnd.choice('234')}{main}>{_words(rnd, rnd.randint(1, 6)).capitalize()}</h2>")
        elif r < 0.86:
            rows = "".join(f"<li{main}>{_prose(rnd, 1)}</li>" for _ in range(rnd.randint(2, 6)))
            body.append(f"<ul>{rows}</ul>")
        elif r < 0.90:
            body.append(f"<blockquote><p{main}>{_prose(rnd, rnd.randint(1, 3))}</p></blockquote>")
        elif r < 0.92:
            body.append(f"<pre{main}>{_words(rnd, 12)}</pre>")
        elif r < 0.94:
            body.append("<table>" + "".join(f"<tr><td{main}>{_words(rnd, 2)}</td><td{main}>{_words(rnd, 2)}</td></tr>" for _ in range(rnd.randint(1, 4))) + "</table>")
        elif r < 0.96:
            body.append(f"<figure><img src=x><figcaption{main}>{_prose(rnd, 1)}</figcaption></figure>")
        else:
            body.append(_boilerplate(rnd, rnd.choice(["ad", "ad", "side", "share", "notice", "form"])))
    tag = rnd.choice(["article", "article", "article", "main", "div", "div", "section", ""])
    inner = "".join(body)
    if rnd.random() < 0.25:
        inner = f"<div{_attr(rnd, 'article')}>{inner}</div>"
    if tag:
        attr = _attr(rnd, "article") if tag == "div" or rnd.random() < 0.5 else ""
        inner = f"<{tag}{attr}>{inner}</{tag}>"
    before = [p for p, q in (("notice", .3), ("header", .5), ("menu", .85), ("ad", .45), ("menu", .2), ("form", .2)) if rnd.random() < q]
    after = [p for p, q in (("share", .3), ("comments", .45), ("side", .5), ("ad", .3), ("notice", .25), ("form", .2), ("footer", .85)) if rnd.random() < q]
    if rnd.random() < 0.5:
        rnd.shuffle(before)
    parts = [_boilerplate(rnd, p) for p in before] + [inner] + [_boilerplate(rnd, p) for p in after]
    page = "".join(parts)
    if rnd.random() < 0.3:
        page = f'<div class="{rnd.choice(["wrapper", "container", "page", "site", "layout"])}">{page}</div>'
    return f"<!DOCTYPE html><html><head><title>{_words(rnd, 3)}</title><script>x()</script></head><body>{page}</body></html>"


def training_pages(n: int = PAGES, seed: int = 7) -> list[str]:
    rnd = random.Random(seed)
    return [training_page(rnd) for _ in range(n)]


def labels_of(page: Page) -> np.ndarray:
    """1 for elements that hold article text somewhere below."""
    y = np.array([" data-main" in f" {a}" for a in page.attrs], dtype=float)
    for k in range(len(y) - 1, 0, -1):
        if y[k]:
            y[page.parent[k]] = 1
    return y


@dataclass
class Model:
    vocabulary: dict[str, int]
    trees: Trees


@lru_cache(2)
def train(pages: int = PAGES, seed: int = 7) -> Model:
    read = [read_page(s) for s in training_pages(pages, seed)]
    seen = Counter(t for p in read for a in p.attrs for t in attribute_tokens(a))
    vocabulary = {t: k for k, (t, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:TOKENS])}
    x = np.concatenate([features(p, vocabulary) for p in read])
    y = np.concatenate([labels_of(p) for p in read])
    return Model(vocabulary, Trees.fit(x, y, np.ones(len(y))))


# --- decoding ------------------------------------------------------------------------------

def decode(page: Page, scores) -> list[bool]:
    """Of all choices in which a dropped element drops its descendants, the likeliest."""
    n = len(page.tag)
    keep_below, drop_all = [0.0] * n, [0.0] * n      # log-likelihoods of subtrees, without a common constant
    for k in range(n - 1, -1, -1):
        s = min(8.0, max(-8.0, scores[k]))
        keep = s / 2 + keep_below[k]
        drop_all[k] -= s / 2
        if k:
            p = page.parent[k]
            keep_below[p] += max(keep, drop_all[k])
            drop_all[p] += drop_all[k]
        keep_below[k] = keep
    kept = [False] * n
    for k in range(n):
        kept[k] = (k == 0 or kept[page.parent[k]]) and keep_below[k] >= drop_all[k]
    return kept


def main_text(page: Page, scores) -> str:
    kept = decode(page, scores)
    return "\n".join(text for e, text, _ in page.blocks if kept[e])


def extract_all(sources: list[str], model: Model) -> list[str]:
    pages = [read_page(s) for s in sources]
    if not pages:
        return []
    sizes = [len(p.tag) for p in pages]
    scores = model.trees.scores(np.concatenate([features(p, model.vocabulary) for p in pages]))
    out, at = [], 0
    for p, n in zip(pages, sizes):
        out.append(main_text(p, scores[at:at + n].tolist()))
        at += n
    return out


def main_texts(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text) of each row of ``pages`` (page_id, url, html)."""
    shipped = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(batches):
        model = shipped.value
        for b in batches:
            sources = [s or "" for s in rows_of(b)["html"]]
            texts = []
            for k in range(0, len(sources), 64):
                texts += extract_all(sources[k:k + 64], model)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")
