"""HTML: features of raw pages, and normalised pages, on a small tree built by the standard parser."""

from __future__ import annotations

import gzip
import html as entities
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.batches import pieces
from corpusloom.functions.text import output_path

#: Elements without an end tag, and elements that a following sibling ends.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ENDED_BY = {"p": {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "footer", "nav", "section"}, "li": {"li"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
#: The content element, the category box, and what is removed from a page.
CONTENT_ID, CATEGORY_BOX = "mw-content-text", "mw-normal-catlinks"
DISAMBIGUATION = {"dmbox", "dmbox-disambig"}
STUB = {"stub", "stub-article"}
REMOVED_CLASSES = {
    "ambox", "mbox-small", "tmbox", "ombox", "cmbox", "fmbox", "navbox", "navbox-inner", "navbox-list", "navbox-title", "sistersitebox", "noprint",
    "mw-editsection", "mw-editsection-bracket", "hatnote", "stub", "stub-article", "printfooter", "mw-authority-control", "dmbox", "dmbox-disambig",
}
REMOVED_IDS = {"catlinks", "footer", "mw-navigation", "mw-head", "mw-head-base", "mw-page-base", "coordinates", "mw-panel", "siteSub", "contentSub", "jump-to-nav", "toc"}
KEPT_LINKS = ("http://", "https://", "//", "mailto:", "#")
STYLE = "../assets/style.css"


class Node:
    """An element: tag, attributes and children, which are elements, strings, or raw markup (a tuple of one string)."""

    def __init__(self, tag: str, attrs: dict | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs or {}, parent, []

    def add(self, child) -> None:
        self.children.append(child)

    def all(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def by_id(self, value: str) -> Node | None:
        return next((n for n in self.all() if n.attrs.get("id") == value), None)

    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif isinstance(node, Node):
                stack.extend(reversed(node.children))
        return "".join(out)

    def remove(self) -> None:
        self.parent.children.remove(self)

    def replace(self, new) -> None:
        at = self.parent.children.index(self)
        self.parent.children[at] = new

    def markup(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                out.append(node[0])
            elif isinstance(node, str):
                out.append(entities.escape(node, quote=False))
            else:
                inner = list(node.children)
                if node.tag:
                    out.append("<" + node.tag + "".join(f' {k}="{entities.escape(v or "")}"' for k, v in node.attrs.items()) + ">")
                    if node.tag not in VOID:
                        inner.append((f"</{node.tag}>",))
                stack.extend(reversed(inner))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        while self.at.parent is not None and tag in ENDED_BY.get(self.at.tag, ()):
            self.at = self.at.parent
        node = Node(tag, dict(attrs), self.at)
        self.at.add(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.add(data)

    def handle_comment(self, data):
        self.at.add((f"<!--{data}-->",))


def parse(source: str) -> Node:
    builder = _Builder()
    builder.feed(source)
    builder.close()
    return builder.root


def features(source: str, content_id: str | None = CONTENT_ID) -> tuple[int, int, int, list[str], list[str]]:
    """(text_chars, is_disambig, is_stub, categories, hrefs). Links count only inside the content element; with content_id None the whole page is content."""
    root = parse(source)
    seen = set().union(*(n.classes() for n in root.all()))
    content = root.by_id(content_id) if content_id else root
    box = root.by_id(CATEGORY_BOX)
    names = [c.strip().lower() for a in (box.all() if box else ()) if a.tag == "a" for c in a.children if isinstance(c, str)]
    hrefs = [a.attrs["href"] for a in content.all() if a.tag == "a" and a.attrs.get("href") is not None] if content else []
    return len((content or root).text()), int(bool(seen & DISAMBIGUATION)), int(bool(seen & STUB)), [c for c in names if c], hrefs


def page_features(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", content_id: str | None = CONTENT_ID) -> DataFrame:
    """(id, text_chars, is_disambig, is_stub, categories, hrefs); a page that cannot be parsed has zeros and empty lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.list_(pa.string())
        for part in pieces(batches, "h"):
            rows = []
            for h in part.column("h").to_pylist():
                try:
                    rows.append(features(h or "", content_id))
                except Exception:  # noqa: BLE001 - any fault of a page is the page's own
                    rows.append((0, 0, 0, [], []))
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), words, words))]
            yield pa.RecordBatch.from_arrays([part.column("id"), *columns], ["id", "text_chars", "is_disambig", "is_stub", "categories", "hrefs"])

    source = pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("h"))
    return source.mapInArrow(run, "id long, text_chars int, is_disambig int, is_stub int, categories array<string>, hrefs array<string>")


def strip_page(root: Node) -> None:
    """Remove boxes, navigation, images, styles and scripts; SVG stays."""
    for node in list(root.all()):
        if node.parent is not None and (node.classes() & REMOVED_CLASSES or node.attrs.get("id") in REMOVED_IDS or node.tag in ("img", "style", "script")):
            if node in node.parent.children:
                node.remove()


def rewrite_links(content: Node, targets: dict[str, str]) -> None:
    """Links to kept articles become relative, with href and title only; other internal links become dead-link spans; external ones stay."""
    for a in [n for n in content.all() if n.tag == "a" and n.attrs.get("href") is not None]:
        href = a.attrs["href"].strip()
        if href.startswith(KEPT_LINKS):
            continue
        href, mark, fragment = href.partition("#")
        if not href:
            continue
        try:
            path = unquote_to_bytes(href).decode("utf-8").lstrip("./")
        except UnicodeDecodeError:
            a.replace(a.text())
            continue
        if path in targets:
            a.attrs = {k: v for k, v in a.attrs.items() if k in ("href", "title")} | {"href": "../" + targets[path] + (mark + fragment if fragment else "")}
        else:
            span = Node("span", {"class": "mw-deadlink"}, a.parent)
            span.add(a.text())
            a.replace(span)


def contents(content: Node) -> str:
    """A table of contents from h2 and h3, which get ids; under three headings none."""
    headings = [n for n in content.all() if n.tag in ("h2", "h3")]
    if len(headings) < 3:
        return ""
    top = Node("ol")
    nested, major, minor = None, 0, 0
    for h in headings:
        h.attrs["id"] = h.attrs.get("id") or re.sub(r"\W+", "_", h.text()).strip("_")
        if h.tag == "h2":
            major, minor, into, label = major + 1, 0, top, f"{major + 1}. "
        elif nested is None:
            continue
        else:
            minor, into, label = minor + 1, nested, f"{major}.{minor + 1} "
        item = Node("li", {"class": f"toc-{h.tag}"}, into)
        link = Node("a", {"href": "#" + h.attrs["id"]}, item)
        link.add(label + h.text().strip())
        item.add(link)
        into.add(item)
        if h.tag == "h2":
            nested = Node("ol", {}, item)
            item.add(nested)
    return f'<nav id="toc" class="toc"><div class="toc-title">Contents</div>{top.markup()}</nav>'


def page_of(title: str, toc: str, body: str) -> str:
    name = entities.escape(title, quote=False).replace('"', "&quot;")
    head = f'<head>\n<meta charset="utf-8">\n<meta name="viewport" content="width=device-width,initial-scale=1">\n<title>{name}</title>\n<link rel="stylesheet" href="{STYLE}">\n</head>'
    return f'<!DOCTYPE html>\n<html lang="en">\n{head}\n<body>\n<article class="mw-body">\n<h1 class="firstHeading">{name}</h1>\n{toc}\n{body}\n</article>\n</body>\n</html>\n'


def normalise(source: str, title: str, targets: dict[str, str]) -> str:
    root = parse(source)
    strip_page(root)
    content = root.by_id(CONTENT_ID) or next((n for n in root.all() if n.tag == "body"), root)
    rewrite_links(content, targets)
    toc = contents(content)
    return page_of(title, toc, content.markup())


def normalised_pages(pages: DataFrame, targets: DataFrame) -> DataFrame:
    """pages (id, path, title, domain, kss, html) with output_path, normalised html and its gzip_size; both null where a page failed.

    targets: (source_id, target, output_path) of every link to a kept article. Each page gets its own targets by a join, so no
    table of all paths is sent to the tasks.
    """
    own = targets.groupBy(F.col("source_id").alias("id")).agg(F.collect_list(F.struct("target", "output_path")).alias("targets"))
    rows = pages.withColumn("output_path", output_path(F.col("domain"), F.col("path"))).join(own, "id", "left")
    kept = [c for c in rows.columns if c not in ("html", "targets")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "html"):
            out, sizes = [], []
            for h, title, pairs in zip(part.column("html"), part.column("title"), part.column("targets")):
                try:
                    h, title, table = h.as_py(), title.as_py(), {p["target"]: p["output_path"] for p in pairs.as_py() or ()}
                    page = normalise(h, title, table)
                    out.append(page)
                    sizes.append(len(gzip.compress(page.encode("utf-8"), 6)))
                except Exception:  # noqa: BLE001 - a page that fails is counted, not fatal
                    out.append(None)
                    sizes.append(None)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(out, pa.string()), pa.array(sizes, pa.int64())], [*kept, "html", "gzip_size"])

    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in rows.schema if c.name in kept) + ", html string, gzip_size long"
    return rows.select(*kept, "html", "targets").mapInArrow(run, schema)
