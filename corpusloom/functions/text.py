"""Column functions on paths, links and titles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Links that are not to articles, and paths that are not articles.
SKIP_LINK_PREFIXES = (
    "http://", "https://", "//", "mailto:", "#", "Category:", "Wikipedia:", "Help:", "File:", "Portal:",
    "Template:", "Special:", "Talk:", "User:", "Draft:",
)
NON_ARTICLE_PREFIXES = (
    "Category:", "Wikipedia:", "Help:", "Portal:", "File:", "Template:", "MediaWiki:", "Module:", "Special:", "Talk:", "User:", "User_talk:", "Draft:",
)
#: Characters of a slug.
SLUG_CHARS = 200
BROKEN = "�"


def any_prefix(c: Column, prefixes) -> Column:
    return reduce(lambda a, b: a | b, (c.startswith(p) for p in prefixes))


def is_article_path(path: Column, new_scheme: bool = True) -> Column:
    return ~any_prefix(path, NON_ARTICLE_PREFIXES) if new_scheme else path.startswith("A/")


def article_path(path: Column, new_scheme: bool = True) -> Column:
    return path if new_scheme else F.regexp_replace(path, "^A/", "")


def is_html(mime: Column) -> Column:
    return F.lower(mime).contains("html")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def decoded(href: Column) -> Column:
    """Percent-decoded; null where the bytes are not UTF-8. A plus sign and a stray percent sign are themselves."""
    safe = F.regexp_replace(F.regexp_replace(href, r"\+", "%2B"), "%(?![0-9A-Fa-f]{2})", "%25")
    out = F.try_url_decode(safe)
    meant = href.contains(BROKEN) | F.lower(href).contains("%ef%bf%bd")
    return F.when(out.contains(BROKEN) & ~meant, F.lit(None)).otherwise(out)


def link_target(href: Column) -> Column:
    """Path that an href leads to: cut at the first #, decoded, leading dots and slashes dropped; null if there is none."""
    cut = F.substring_index(href, "#", 1)
    path = F.ltrim(decoded(cut), F.lit("./"))
    return F.when((cut != "") & (path != ""), path)


def article_links(hrefs: Column) -> Column:
    """Different article paths among hrefs, in the order first seen."""
    kept = F.filter(F.transform(hrefs, strip), lambda h: (h != "") & ~any_prefix(h, SKIP_LINK_PREFIXES))
    return F.array_distinct(F.filter(F.transform(kept, link_target), lambda t: t.isNotNull()))


def slug(path: Column) -> Column:
    return F.left(F.regexp_replace(F.replace(path, F.lit(" "), F.lit("_")), r"(?U)[^\w\-.]", "_"), F.lit(SLUG_CHARS))


def output_path(domain: Column, path: Column) -> Column:
    return F.concat(domain, F.lit("/"), slug(path), F.lit(".html"))


def relative_path(out: Column) -> Column:
    return F.concat(F.lit("../"), out)


def html_escape(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def contains_any(c: Column, anchors) -> Column:
    """Whether any anchor is a substring; no anchors: false."""
    return reduce(lambda a, b: a | b, (c.contains(a) for a in dict.fromkeys(anchors)), F.lit(False))
