"""HTML on the standard library's parser: Markdown conversion and forum posts, as Arrow-batched functions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import patterns

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style head template noscript".split())
BLOCK = frozenset("p div section article header footer main aside figure table tr ul ol dl form fieldset address".split())


class Node:
    """An element with its attributes and its children, elements or strings."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def walk(self) -> Iterator[Node]:
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find(self, tag: str = "", *classes: str, **attrs: str) -> Node | None:
        return next((n for n in self.walk() if (not tag or n.tag == tag) and n.classes().issuperset(classes) and all(n.attrs.get(k) == v for k, v in attrs.items())), None)

    def text(self) -> str:
        out, stack = [], list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                out.append(c)
            else:
                stack.extend(reversed(c.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("p", "li") and self.now.tag == tag:
            self.now = self.now.parent or self.root
        node = Node(tag, {k: v or "" for k, v in attrs}, self.now)
        self.now.children.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.now.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.now))

    def handle_endtag(self, tag: str) -> None:
        n = self.now
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.now = n.parent

    def handle_data(self, data: str) -> None:
        self.now.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def _children(node: Node, pre: bool = False, depth: int = 0) -> str:
    return "".join(_markdown(c, pre, depth) for c in node.children)


def _wrap(mark: str, body: str) -> str:
    inner = body.strip()
    if not inner:
        return body
    return body[: len(body) - len(body.lstrip())] + mark + inner + mark + body[len(body.rstrip()) :]


def _markdown(node: Node | str, pre: bool, depth: int) -> str:
    if isinstance(node, str):
        return node if pre else re.sub(r"\s+", " ", node)
    t = node.tag
    if t in HIDDEN:
        return ""
    if depth > 200:  # pathological nesting: keep the text
        return node.text()
    if t == "br":
        return "  \n"
    if t == "hr":
        return "\n\n---\n\n"
    if t == "img":
        return f"![{node.attrs.get('alt', '')}]({node.attrs.get('src', '')})"
    body = _children(node, pre or t == "pre", depth + 1)
    if t in ("b", "strong"):
        return _wrap("**", body)
    if t in ("i", "em"):
        return _wrap("*", body)
    if t in ("s", "del", "strike"):
        return _wrap("~~", body)
    if t == "code":
        return body if pre else _wrap("`", body)
    if t == "pre":
        return f"\n\n```\n{body.strip(chr(10))}\n```\n\n"
    if t == "a":
        to = node.attrs.get("href", "")
        return f"[{body.strip()}]({to})" if to and body.strip() else body
    if re.fullmatch(r"h[1-6]", t):
        return f"\n\n{'#' * int(t[1])} {body.strip()}\n\n"
    if t == "blockquote":
        return "\n\n" + "\n".join(("> " + x).rstrip() for x in _tidy(body).split("\n")) + "\n\n"
    if t == "li":
        ordered = node.parent is not None and node.parent.tag == "ol"
        place = 1 + sum(1 for c in node.parent.children[: node.parent.children.index(node)] if isinstance(c, Node) and c.tag == "li") if ordered else 0
        mark = f"{place}. " if ordered else "* "
        return "\n" + mark + _tidy(body).replace("\n", "\n" + " " * len(mark))
    if t in ("td", "th"):
        return body.strip() + " | "
    return f"\n\n{body}\n\n" if t in BLOCK else body


def _tidy(text: str) -> str:
    lines = [x if x.endswith("  ") and x.strip() else x.rstrip() for x in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def to_markdown(html: str | None) -> str | None:
    """Markdown of an HTML fragment; null stays null, plain text keeps its words."""
    return None if html is None else _tidy(_children(parse(html)))


@F.pandas_udf(T.StringType())
def html_to_markdown(texts: pd.Series) -> pd.Series:
    return texts.map(to_markdown, na_action="ignore")


POST_FIELDS = ("post_id", "post_url", "thread_id", "thread_slug", "thread_url", "thread_title", "author_id", "author", "timestamp", "text")
POST = T.StructType([T.StructField("post_index", T.IntegerType()), *(T.StructField(n, T.StringType()) for n in POST_FIELDS)])
_THREAD = re.compile(patterns.THREAD_URL)


def _first(*values: str | None) -> str:
    return next((v for v in values if v), "")


def _number(pattern: str, value: str | None) -> str:
    m = re.search(pattern, value or "")
    return m[1] if m else ""


def _source(node: Node | str) -> str:
    if isinstance(node, str):
        return node.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    attrs = "".join(f' {k}="{v}"' for k, v in node.attrs.items())
    return f"<{node.tag}{attrs}/>" if node.tag in VOID else f"<{node.tag}{attrs}>{''.join(map(_source, node.children))}</{node.tag}>"


def posts(html: str | None) -> list[dict]:
    """The posts of a forum page. Posts without an id, a thread or a body are left out."""
    if not html or not html.strip():
        return []
    from urllib.parse import unquote

    root = parse(html)
    heading = root.find("h1", "p-title-value") or root.find("title")
    title = heading.text().strip() if heading else ""
    out = []
    for i, post in enumerate(n for n in root.walk() if n.tag == "article" and {"message", "message--post"} <= n.classes()):
        # what the post says about itself stands outside of its body, where anyone may be quoted
        written = next((n for n in post.walk() if n is not post and n.classes() & {"message-userContent", "message-body", "bbWrapper"}), None)
        inside = set(map(id, written.walk())) if written else set()
        own = [n for n in post.walk() if id(n) not in inside]
        links = [n.attrs.get("href", "") for n in own if n.tag == "a"]
        href = next((h for h in links if re.search(patterns.POST_URL, h)), "")
        post_id = _first(_number(patterns.POST_DATA, post.attrs.get("data-content")), _number(patterns.POST_ELEMENT, post.attrs.get("id")), next((x for x in (_number(patterns.POST_LINK, h) for h in links) if x), ""))
        parent = next((n for n in own if n.tag == "meta" and n.attrs.get("itemprop") == "parentItem"), None)
        thread_url = re.sub(r"/?post-\d+/?$", "", _first(parent.attrs.get("itemid") if parent else "", next((h for h in links if re.search(patterns.THREAD_URL, h)), "")))
        m = _THREAD.search(thread_url if thread_url.endswith("/") else thread_url + "/")
        body = post.find("div", "message-userContent")
        body = body.find("article", "message-body") or body.find("div", "bbWrapper") or body if body else post.find("article", "message-body") or post.find("div", "bbWrapper")
        inner = body.find("div", "bbWrapper") or body if body else None
        text = "".join(map(_source, inner.children)).strip() if inner else ""
        if not (post_id and m and text):
            continue
        user = next((n for n in own if n.tag == "a" and n.attrs.get("data-user-id")), None)
        time = next((n for n in own if n.tag == "time"), None)
        out.append(
            {
                "post_index": i + 1,
                "post_id": post_id,
                "post_url": href,
                "thread_id": m[2],
                "thread_slug": unquote(m[1]),
                "thread_url": thread_url,
                "thread_title": title,
                "author_id": user.attrs.get("data-user-id", "") if user else "",
                "author": _first(post.attrs.get("data-author"), user.text().strip() if user else ""),
                "timestamp": time.attrs.get("datetime", "") if time else "",
                "text": text,
            }
        )
    return out


@F.pandas_udf(T.ArrayType(POST))
def extract_posts(pages: pd.Series) -> pd.Series:
    return pages.map(posts)
