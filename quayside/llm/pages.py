"""Main text of web pages by a tree-structured graphical model.

Block elements of a page are nodes with two states, content or not. A node's
potential comes from its tag, names, text and links; an edge potential ties
child to parent. Sum-product messages go up and down the tree once and give
each node's marginal, and the text of content nodes is the page's text. The
weights are fitted by the exact likelihood of labelled pages.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import hash_sample

#: About so many pages at most are labelled by their own markup, chosen by hash; so many are laid out from their words.
SAMPLE_PAGES, LAID_OUT = 200, 120
STEPS, RATE, RIDGE = 200, 1.0, 0.0002

#: Elements by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp template svg select canvas".split())
#: Of these, those that often lack their end: without it they end at the next block.
UNCLOSED = set("svg canvas select template noscript".split())
BLOCK = set("""html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption
    blockquote pre figure figcaption nav header footer aside form fieldset address details summary center button label dialog menu hgroup""".split())
ENDS_P = BLOCK - {"button", "label", "caption", "td", "th", "tr", "thead", "tbody", "tfoot"}
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
          "td": ("td th", {"table", "tr"}), "th": ("td th", {"table", "tr"})}
OUTER = set("nav header footer aside form button label dialog menu fieldset".split())
INNER = set("article main".split())
TEXTUAL = set("p h1 h2 h3 h4 h5 h6 blockquote pre li td figcaption dd".split())

#: Words in class, id and role that hint at what an element is for.
HINTS = {
    "content": r"article|content|post|entry|story|main|text|body",
    "menu": r"nav|menu|breadcrumb|toc|pagination|pager|tabs",
    "edge": r"header|masthead|banner|footer|foot|copyright|top-?bar|bottom",
    "side": r"side|aside|widget|related|recommend|teaser|trending|popular|more-",
    "sales": r"(^|[\s_-])ads?([\s_-]|$)|advert|sponsor|promo|subscribe|newsletter|paywall|offer",
    "notice": r"cookie|consent|notice|alert|popup|modal|gdpr|warning|message",
    "talk": r"comment|reply|replies|discuss|disqus|respon|review|feedback",
    "tools": r"share|social|login|signup|search|form|tool|button|tags?|meta|byline|author",
}
_HINTS = {k: re.compile(v) for k, v in HINTS.items()}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    names: str = ""
    hidden: bool = False
    mark: str | None = None
    own: list[str] = field(default_factory=list)  # text runs of its own, in order
    places: list[int] = field(default_factory=list)  # their places in the page
    linked: int = 0  # characters of them inside links


def parse(page: str | None) -> list[Node]:
    """Block elements in page order, a parent before its children; each holds the text runs between its child blocks.

    Missing and stray end tags are closed and ignored as browsers do for these
    elements. Text inside scripts, styles, drawings and the like is left out;
    formulas and the fallback of objects are text of their block. A drawing
    that is never closed ends at the next tag of a block.
    """
    page = page or ""
    nodes = [Node("html", -1, 0)]
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements, each with the block that holds its text
    run: list[str] = []
    state = {"linked": 0, "place": 0}

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            node = nodes[stack[-1][1]]
            node.own.append(text)
            node.places.append(state["place"])
            node.linked += state["linked"]
            state["place"] += 1
        run.clear()
        state["linked"] = 0

    def close(at: int) -> None:
        if any(t in BLOCK for t, _ in stack[at:]):
            flush()
        del stack[at:]

    def add(text: str) -> None:
        if text:
            text = html.unescape(text)
            run.append(text)
            if any(t == "a" for t, _ in stack):
                state["linked"] += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        slash, tag, attributes = found.group(1), found.group(2), found.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if stack[k][0] in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot") and tag in BLOCK:
                    break
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if stop:
                at = stop.end()
            else:
                block = _BLOCK_TAG.search(page, at) if tag in UNCLOSED else None
                at = block.start() if block else end
            if tag in BLOCK or tag == "textarea":
                flush()
            continue
        if tag in VOID:
            run.append(" ")
            continue
        if tag == "html":
            continue
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        if tag in CLOSES:
            mates, fence = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in fence and stack[k][0] not in mates.split():
                    break
                if stack[k][0] in mates.split():
                    close(k)
                    break
        owner = stack[-1][1]
        if tag in BLOCK:
            flush()
            values = {a.lower(): (b or c or d or "") for a, b, c, d in _ATTR.findall(attributes)}
            node = Node(tag, owner, nodes[owner].depth + 1, " ".join(values.get(k, "") for k in ("class", "id", "role")).lower().strip())
            style = values.get("style", "").replace(" ", "").lower()
            node.hidden = "hidden" in values or "display:none" in style or values.get("aria-hidden") == "true" or nodes[owner].hidden
            node.mark = values.get("y", nodes[owner].mark)
            nodes.append(node)
            owner = len(nodes) - 1
        if not attributes.rstrip().endswith("/") or tag in BLOCK:
            stack.append((tag, owner))
    flush()
    return nodes


FEATURES = ["one", "outer", "inner", "textual", "heading", "item", "division", *HINTS, "chars", "linked", "marks", "under", "links_under", "first", "last", "empty", "hidden"]


def node_features(nodes: list[Node]) -> np.ndarray:
    """A row of bounded numbers for each node."""
    n = len(nodes)
    own = np.array([sum(map(len, x.own)) for x in nodes], float)
    linked = np.array([x.linked for x in nodes], float)
    under, links_under = own.copy(), linked.copy()
    for k in range(n - 1, 0, -1):
        under[nodes[k].parent] += under[k]
        links_under[nodes[k].parent] += links_under[k]
    out = np.zeros((n, len(FEATURES)))
    for k, x in enumerate(nodes):
        marks = sum(t.count(".") + t.count(",") for t in x.own)
        out[k] = [
            1, x.tag in OUTER, x.tag in INNER, x.tag in TEXTUAL, x.tag[0] == "h" and x.tag[1:].isdigit(), x.tag in ("li", "td", "dd", "dt"),
            x.tag in ("div", "section"), *[bool(p.search(x.names)) if x.names else 0 for p in _HINTS.values()],
            min(math.log1p(own[k]) / 6, 1.5), linked[k] / own[k] if own[k] else 0, min(marks / 5, 2), min(math.log1p(under[k]) / 8, 1.5),
            links_under[k] / under[k] if under[k] else 0, k / n < 0.1, k / n > 0.9, own[k] == 0, x.hidden]
    return out


#: Edge potentials: one table for an ordinary child, one for a child that is an outer element or has a telling name.
def edge_kinds(nodes: list[Node], x: np.ndarray) -> np.ndarray:
    hint = FEATURES.index("menu")
    telling = x[:, FEATURES.index("outer")] + x[:, hint:hint + len(HINTS) - 1].sum(1)
    return (telling > 0).astype(int)


def marginals(parents: list[int], unary: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sum-product on a tree, parents before children.

    unary[k]: log-potential of content for node k, against 0. edges[k, p, c]:
    log-potential of node k's state c under its parent's state p. Gives each
    node's marginal of content, the joint marginals of (parent, node), and the
    log of the normaliser.
    """
    n = len(parents)
    up = np.zeros((n, 2))  # product of the messages from the children
    message = np.zeros((n, 2))
    own = np.zeros((n, 2))
    own[:, 1] = unary
    for k in range(n - 1, 0, -1):
        a0, a1 = own[k, 0] + up[k, 0], own[k, 1] + up[k, 1]
        for p in (0, 1):
            x, y = a0 + edges[k, p, 0], a1 + edges[k, p, 1]
            m = x if x > y else y
            message[k, p] = m + math.log(math.exp(x - m) + math.exp(y - m))
        up[parents[k]] += message[k]
    top = own[0] + up[0]
    m = top.max()
    norm = m + math.log(np.exp(top - m).sum())
    belief = np.zeros((n, 2))
    belief[0] = np.exp(top - norm)
    pair = np.zeros((n, 2, 2))
    for k in range(1, n):
        p0, p1 = belief[parents[k]]
        for p, share in ((0, p0), (1, p1)):
            x, y = own[k, 0] + up[k, 0] + edges[k, p, 0], own[k, 1] + up[k, 1] + edges[k, p, 1]
            q = 1 / (1 + math.exp(min(max(x - y, -500), 500)))
            pair[k, p, 0], pair[k, p, 1] = share * (1 - q), share * q
        belief[k] = pair[k].sum(0)
    return belief[:, 1], pair, norm


@dataclass(frozen=True)
class PageModel:
    weights: np.ndarray
    tables: np.ndarray  # kind of edge x parent state x own state

    def text(self, page: str | None) -> str:
        """Runs of the nodes whose marginal of content is 0.5 at least, in page order, joined by a line feed."""
        nodes = parse(page)
        if not any(n.own for n in nodes):
            return ""
        x = node_features(nodes)
        content, _, _ = marginals([n.parent for n in nodes], x @ self.weights, self.tables[edge_kinds(nodes, x)])
        runs = [(at, t) for n, p in zip(nodes, content) if p >= 0.5 for at, t in zip(n.places, n.own)]
        return "\n".join(t for _, t in sorted(runs))


def fit(pages: list[tuple[list[Node], np.ndarray]]) -> PageModel:
    """Gradient ascent on the likelihood of the labels, with the exact expectations of the messages."""
    data = []
    for nodes, y in pages:
        x = node_features(nodes)
        data.append(([n.parent for n in nodes], x, edge_kinds(nodes, x), y.astype(int)))
    w, tables = np.zeros(len(FEATURES)), np.zeros((2, 2, 2))
    total = max(1, sum(len(y) for *_, y in data))
    speed_w, speed_t = np.zeros_like(w), np.zeros_like(tables)
    for _ in range(STEPS):
        gw, gt = -RIDGE * total * w, -RIDGE * total * tables
        for parents, x, kinds, y in data:
            p, pair, _ = marginals(parents, x @ w, tables[kinds])
            gw += x.T @ (y - p)
            seen = np.zeros((len(y), 2, 2))
            if len(y) > 1:
                seen[np.arange(1, len(y)), y[np.array(parents[1:])], y[1:]] = 1
            np.add.at(gt, kinds[1:], (seen - pair)[1:])
        speed_w, speed_t = 0.9 * speed_w + gw / total, 0.9 * speed_t + gt / total
        w, tables = w + RATE * speed_w, tables + RATE * speed_t
    return PageModel(w, tables)


def own_labels(nodes: list[Node]) -> np.ndarray | None:
    """Labels from a page's own article element: content is what lies in it outside of outer elements; None without one."""
    if not any(n.tag in INNER for n in nodes):
        return None
    y = np.zeros(len(nodes), int)
    for k, n in enumerate(nodes):
        above = y[n.parent] if n.parent >= 0 else 0
        y[k] = 0 if n.tag in OUTER else 1 if n.tag in INNER else above
    return y


def laid_out(words: list[str], rng: random.Random) -> str:
    """A page of a common layout, its blocks labelled by the attribute y; its text is made of the given words."""
    say = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b)))
    sentence = lambda: ". ".join(say(6, 14) for _ in range(rng.randint(1, 6))) + "."
    links = lambda n: "".join(f'<li><a href="#">{say(1, 3)}</a></li>' for _ in range(n))
    named = lambda *c: rng.choice([f'class="{rng.choice(c)}"', f'id="{rng.choice(c)}"'])
    paragraphs = lambda n: "".join(f"<p>{sentence()}</p>" for _ in range(n))
    junk = [
        lambda: f"<nav><ul>{links(rng.randint(3, 8))}</ul></nav>", lambda: f'<div {named("menu", "navbar", "main-nav")}><ul>{links(6)}</ul></div>',
        lambda: f"<header><h1>{say(1, 4)}</h1><p>{say(3, 8)}</p></header>", lambda: f'<div {named("header", "masthead", "site-header")}><h2>{say(1, 3)}</h2></div>',
        lambda: f"<aside><h3>{say(1, 3)}</h3>{paragraphs(rng.randint(1, 2))}<ul>{links(4)}</ul></aside>",
        lambda: f'<div {named("sidebar", "widget", "related-posts")}><h4>{say(1, 3)}</h4><ul>{links(5)}</ul><p>{sentence()}</p></div>',
        lambda: f'<div {named("ad", "ads", "advert", "sponsored", "promo")}>{say(4, 15)}.</div>', lambda: f'<div {named("ad-banner", "advertisement")}><p>{sentence()}</p></div>',
        lambda: f'<div {named("cookie-notice", "consent", "alert", "popup", "notice")}><p>{sentence()}</p><button>{say(1, 2)}</button></div>',
        lambda: f'<form action="/"><label>{say(1, 3)}</label><input><p>{say(4, 9)}</p><button>{say(1, 2)}</button></form>',
        lambda: f'<div {named("newsletter", "subscribe", "login")}><p>{sentence()}</p></div>', lambda: f'<div {named("share", "social", "tags")}><ul>{links(4)}</ul></div>',
    ]
    talk = lambda: f'<{(t := rng.choice(["div", "section"]))} {named("comments", "comment-list", "replies", "discussion")}><h3>{say(1, 2)}</h3>' + "".join(
        f'<div class="comment"><p>{sentence()}</p></div>' for _ in range(rng.randint(1, 4))) + f"</{t}>"
    foot = lambda: rng.choice([f"<footer>{say(3, 10)}.</footer>", f'<div {named("footer", "site-footer")}><p>{say(3, 9)}</p></div>'])
    zero = lambda s: re.sub(r"^<(\w+)", r'<\1 y="0"', s)
    extra = [f"<h2>{say(2, 6)}</h2>", f"<ul>{''.join(f'<li>{sentence()}</li>' for _ in range(3))}</ul>", f"<blockquote><p>{sentence()}</p></blockquote>",
             f"<table><tr><td>{say(2, 6)}</td><td>{say(2, 6)}</td></tr></table>", f"<pre>{say(3, 12)}</pre>", f"<div>{sentence()}</div>", f"<p>{say(1, 3)}</p>",
             f"<figure><figcaption>{say(3, 9)}</figcaption></figure>", f'<p><a href="#">{say(2, 5)}</a> {sentence()}</p>', f"<p>{say(1, 1)}.</p>"]
    inside = [f"<h1>{say(2, 8)}</h1>", *(paragraphs(1) for _ in range(rng.randint(1, 7))), *rng.sample(extra, rng.randint(0, 5))]
    shy = lambda: rng.choice(["hidden", 'style="display: none"', 'aria-hidden="true"'])
    if rng.random() < 0.15:  # hidden parts of an article are its text, hidden boxes around it are not
        inside.append(f"<{(t := rng.choice(['p', 'div', 'section']))} {shy()}>{sentence()}</{t}>")
    for _ in range(rng.randint(0, 2)):
        inside.insert(rng.randint(1, len(inside)), zero(rng.choice(junk[4:])()))
    if rng.random() < 0.3:
        inside.append(zero(talk()))
    tag, name = rng.choice([("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' class="content"'), ("div", ' id="main"'),
                            ("div", ' class="article-body"'), ("section", ' class="entry"'), ("div", ' class="post-text"'), ("article", "")])
    body = [zero(rng.choice(junk)()) for _ in range(rng.randint(1, 4))] + [f'<{tag}{name} y="1">{"".join(inside)}</{tag}>']
    body += [zero(rng.choice(junk)()) for _ in range(rng.randint(0, 2))] + ([zero(talk())] if rng.random() < 0.3 else []) + [zero(foot())] * (rng.random() < 0.9)
    if rng.random() < 0.15:
        body.insert(rng.randint(0, len(body)), f'<div y="0" {shy()} {named("popup", "modal", "menu", "drawer")}><p>{sentence()}</p></div>')
    inner = "".join(body)
    if rng.random() < 0.4:
        inner = f'<div {named("wrapper", "page", "container", "site")} y="0">{inner}</div>'
    return f'<html><head><title>{say(2, 5)}</title></head><body y="0">{inner}</body></html>'


def train(pages: DataFrame) -> PageModel:
    """Fit on about SAMPLE_PAGES pages labelled by their own article element and LAID_OUT labelled layouts with their words."""
    some = hash_sample(pages.select(pages["page_id"].alias("page_id"), pages["html"].alias("html")), "page_id", SAMPLE_PAGES)
    rows = [parse(r["html"]) for r in some.orderBy("page_id", "html").collect()]  # about SAMPLE_PAGES rows
    data = [(nodes, y) for nodes in rows if (y := own_labels(nodes)) is not None]
    words = sorted({w.strip(".,") for nodes in rows for n in nodes for t in n.own for w in t.split()[:50]} - {""})[:5000] or ["word", "text", "page"]
    rng = random.Random(11)
    for _ in range(LAID_OUT):
        nodes = parse(laid_out(words, rng))
        data.append((nodes, np.array([n.mark == "1" for n in nodes], int)))
    return fit(data)


def main_text(pages: DataFrame, model: PageModel) -> DataFrame:
    """One row per page row: page_id, url, text, n_chars.

    A null or empty page, and one without content, has the empty text. White
    space inside a block is one space; blocks are joined by a line feed in page
    order. Repeated rows and null ids each come back; further columns are
    ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [model.text(h) for h in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": text, "n_chars": [len(t) for t in text]})

    own = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].alias("html"))
    return own.mapInPandas(run, "page_id long, url string, text string, n_chars long").select("page_id", "url", "text", F.col("n_chars"))
