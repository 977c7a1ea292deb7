"""Markdown of the main content of HTML pages, by a parser.

Tags become a tree with the end tags that HTML implies.  What is navigation,
advertising or machinery goes; of the rest the block is taken that has most text
outside links for its share of the page.  Under 200 characters, the whole page is
rendered instead.  A page is one row's work; nesting beyond 200 levels is flattened.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: tags whose content is never text of a page, and those that surround it
_MACHINERY = frozenset("script style head noscript template iframe svg canvas button select textarea".split())
_AROUND = frozenset("nav footer aside form".split())
_AROUND_WORDS = re.compile(r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|cookies?|footer|menu|nav\w*|newsletter|promo|related|share|sidebar|social)(?:$|[\s_-])")
#: which open tags an opening one ends (None: it ends the nearest of its own group up to the list or table around it)
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}, "option": {"option"}}
_WITHIN = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
_DEEPEST, _LEAST = 200, 200


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def all(self) -> Iterator[Node]:
        yield self
        for c in self.children:
            if isinstance(c, Node):
                yield from c.all()

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _ENDS:
            self._end(_ENDS[tag], _WITHIN[tag])
        elif tag in _BLOCKS and any(n.tag == "p" for n in self.open):
            self._end({"p"}, {"td", "th", "li", "blockquote"})
        if tag in ("html", "body") and len(self.open) == 1:
            return
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID and len(self.open) < _DEEPEST:
            self.open.append(node)

    def _end(self, tags: set[str], within: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in within:
                return
            if self.open[i].tag in tags:
                del self.open[i:]
                if tags & {n.tag for n in self.open}:
                    self._end(tags, within)
                return

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def _pruned(node: Node, around: bool) -> Node:
    """node without machinery and, if asked, without what only surrounds a page's content."""
    kept = []
    for c in node.children:
        if isinstance(c, Node):
            marks = f"{c.attrs.get('class', '')} {c.attrs.get('id', '')}"
            if c.tag in _MACHINERY or around and (c.tag in _AROUND or c.tag == "header" and node.tag not in ("article", "main", "section") or c.tag in ("div", "section", "ul", "p", "span") and _AROUND_WORDS.search(marks)):
                continue
            c = _pruned(c, around)
        kept.append(c)
    return Node(node.tag, node.attrs, kept)


def _weight(node: Node) -> int:
    """Characters of a node's text outside links."""
    return sum(len(c.strip()) if isinstance(c, str) else 0 if c.tag == "a" else _weight(c) for c in node.children)


def _main(page: Node) -> Node:
    """The smallest of articles, mains, sections and divs that has most of the page's text outside links; the page if none has."""
    whole = _weight(page)
    for named in (("main", "article"), ("section", "div")):
        found = [(w, n) for n in page.all() if n.tag in named and 2 * (w := _weight(n)) > whole]
        if found:
            return min(found, key=lambda x: (x[0], len(x[1].text())))[1]
    return page


def _inline(node: Node) -> str:
    out = []
    for c in node.children:
        if isinstance(c, str):
            out.append(re.sub(r"\s+", " ", c))
            continue
        inner = _inline(c)
        bare = inner.strip()
        lead, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :] if bare else ""
        if c.tag == "br":
            out.append("\n")
        elif c.tag == "img":
            out.append(f"![{c.attrs.get('alt', '')}]({c.attrs['src']})" if c.attrs.get("src") else c.attrs.get("alt", ""))
        elif not bare:
            out.append(inner)
        elif c.tag == "a" and c.attrs.get("href"):
            out.append(f"{lead}[{bare}]({c.attrs['href']}){tail}")
        elif c.tag in ("b", "strong", "em", "i", "code", "kbd", "samp"):
            mark = "**" if c.tag in ("b", "strong") else "*" if c.tag in ("em", "i") else "`"
            out.append(f"{lead}{mark}{bare}{mark}{tail}")
        else:
            out.append(inner)
    return "".join(out)


def _tidy(text: str) -> str:
    return "\n".join(re.sub(r" {2,}", " ", x).strip() for x in text.strip().split("\n"))


def _indented(text: str, first: str, rest: str) -> str:
    head, *lines = text.split("\n")
    return "\n".join([first + head, *((rest + x).rstrip() for x in lines)])


def _table(node: Node) -> str:
    rows = [[_tidy(_inline(cell)).replace("\n", " ").replace("|", "\\|") for cell in r.children if isinstance(cell, Node) and cell.tag in ("td", "th")] for r in node.all() if r.tag == "tr"]
    rows = [r for r in rows if r]
    if not rows:
        return ""
    wide = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (wide - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "|" + " --- |" * wide, *lines[1:]])


def _blocks(node: Node) -> list[str]:
    """The blocks of a node; runs of inline content between blocks are paragraphs."""
    out, run = [], Node("p")

    def close() -> None:
        nonlocal run
        if text := _tidy(_inline(run)):
            out.append(text)
        run = Node("p")

    for c in node.children:
        if isinstance(c, str) or c.tag not in _BLOCKS and not any(n.tag in _BLOCKS for n in c.all()):
            run.children.append(c)
            continue
        close()
        if c.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            if text := _tidy(_inline(c)).replace("\n", " "):
                out.append("#" * int(c.tag[1]) + " " + text)
        elif c.tag == "pre":
            out.append("```\n" + c.text().strip("\n") + "\n```")
        elif c.tag == "hr":
            out.append("---")
        elif c.tag == "blockquote":
            if inner := "\n\n".join(_blocks(c)):
                out.append(_indented(inner, "> ", "> "))
        elif c.tag in ("ul", "ol"):
            items, n = [], 0
            for item in c.children:
                if parts := _blocks(item if isinstance(item, Node) and item.tag == "li" else Node("li", {}, [item])):
                    n += 1
                    mark = f"{n}. " if c.tag == "ol" else "- "
                    # a list inside an item follows its line at once
                    body = parts[0] + "".join(("\n" if re.match(r"(?:- |[0-9]+\. )", p) else "\n\n") + p for p in parts[1:])
                    items.append(_indented(body, mark, " " * len(mark)))
            out += ["\n".join(items)] if items else []
        elif c.tag == "table":
            out += [t] if (t := _table(c)) else []
        else:
            out += _blocks(c)
    close()
    return out


def markdown_of(html: str | None) -> str:
    """Markdown of a page's main content, ended by a line break; of a null or empty page just that."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    text = "\n\n".join(_blocks(_main(_pruned(tree.root, True))))
    if len(text) < _LEAST:
        text = max(text, "\n\n".join(_blocks(_pruned(tree.root, False))), key=len)
    return re.sub(r"\n{3,}", "\n\n", text).strip() + "\n"


@F.pandas_udf(StringType())
def _rendered(pages: pd.Series) -> pd.Series:
    return pages.map(markdown_of, na_action=None)


def html_to_markdown(html: Column) -> Column:
    """markdown_of as a column."""
    return _rendered(html)
