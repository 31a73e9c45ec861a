"""HTML pages to titles, bodies, links and Markdown, as Column expressions.

A ``HtmlProfile`` holds the patterns of one page layout. ``MEDIAWIKI`` is the
layout of wiki exports; ``ARTICLE`` that of plain pages with an <article>.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions import fixed

Str = Callable[[Column], Column]


def let(value: Column, fn: Str) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def replace_each(text: Column, pattern: str, fn: Str) -> Column:
    """Every match of ``pattern`` (without groups) replaced by ``fn`` of it."""

    def run(t: Column) -> Column:
        hits = F.concat(F.transform(F.regexp_extract_all(t, F.lit(f"({pattern})"), 1), fn), F.array(F.lit("")))
        joined = F.array_join(F.zip_with(F.split(t, pattern, -1), hits, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
        return F.when(t.rlike(pattern), joined).otherwise(t)

    return let(text, run)


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


@dataclass(frozen=True)
class HtmlProfile:
    titles: tuple[str, ...]
    title_suffix: str | None
    bodies: tuple[str, ...]
    link: str
    link_scope: str | None
    page_suffix: str
    category_scope: str | None
    category: str | None
    subcategory_scope: str | None
    member_scope: str | None


MEDIAWIKI = HtmlProfile(
    titles=(r'(?s)<span class="mw-page-title-main">(.*?)</span>', r"(?s)<title>(.*?)</title>"),
    title_suffix=r" - [^-]*Wiki$",
    bodies=(r'(?s)<div class="mw-parser-output">(.*?)<div (?:id="catlinks"|class="printfooter")', r'(?s)<div class="mw-parser-output">(.*?)</div>\s*</div>', r'(?s)<div class="mw-parser-output">(.*?)</div>\s*<script'),
    link=r'href="([^"]*)"',
    link_scope=None,
    page_suffix=".html",
    category_scope=r'(?s)<div id="mw-normal-catlinks"[^>]*>(.*?)</div>',
    category=r'title="Category:([^"]+)"',
    subcategory_scope=r'(?s)<div id="mw-subcategories">(.*?)</div>\s*(?:<div id="mw-pages"|$)',
    member_scope=r'(?s)<div id="mw-pages">(.*?)</div>\s*$',
)
ARTICLE = HtmlProfile(
    titles=(r"(?s)<title>(.*?)</title>",),
    title_suffix=None,
    bodies=(r"(?s)<article>(.*?)</article>",),
    link=r'href="(/[^"]*)"',
    link_scope=r"(?s)<nav>(.*?)</nav>",
    page_suffix="",
    category_scope=r"(?s)<nav>(.*?)</nav>",
    category=r'<a href="[^"]*">([^<]*)</a>',
    subcategory_scope=None,
    member_scope=None,
)


def _first(html: Column, patterns: tuple[str, ...]) -> Column:
    return F.coalesce(*[blank_to_null(F.regexp_extract(html, p, 1)) for p in patterns], F.lit(""))


def title(html: Column, page_name: Column, p: HtmlProfile = MEDIAWIKI) -> Column:
    """Page title; the name with blanks for underscores if the page has none."""
    t = F.trim(_first(html, p.titles))
    if p.title_suffix:
        t = F.trim(F.regexp_replace(t, p.title_suffix, ""))
    return F.coalesce(blank_to_null(t), F.trim(F.replace(page_name, F.lit("_"), F.lit(" "))))


def body_html(html: Column, p: HtmlProfile = MEDIAWIKI) -> Column:
    """The first of the profile's body patterns that gives something, else ''."""
    return _first(html, p.bodies)


def _hrefs(scope: Column, p: HtmlProfile) -> Column:
    return F.regexp_extract_all(scope, F.lit(p.link), 1)


def links(html: Column, p: HtmlProfile = MEDIAWIKI) -> Column:
    """Distinct internal link targets in order of first appearance, page suffix removed."""
    scope = F.regexp_extract(html, p.link_scope, 1) if p.link_scope else body_html(html, p)

    def internal(x: Column) -> Column:
        ok = F.lit(True)
        for pre in fixed.LINK_PREFIXES_DROPPED:
            ok = ok & ~x.startswith(pre)
        for part in fixed.LINK_PARTS_DROPPED:
            ok = ok & ~x.contains(part)
        return ok & x.endswith(p.page_suffix) if p.page_suffix else ok

    own = F.filter(_hrefs(scope, p), internal)
    if p.page_suffix:
        own = F.transform(own, lambda x: F.replace(x, F.lit(p.page_suffix), F.lit("")))
    else:
        own = F.transform(own, lambda x: F.regexp_replace(x, "^/", ""))
    return F.array_distinct(own)


def categories(html: Column, p: HtmlProfile = MEDIAWIKI) -> Column:
    """Category names, trimmed, without empty ones."""
    if not p.category_scope:
        return F.array().cast("array<string>")
    found = F.regexp_extract_all(F.regexp_extract(html, p.category_scope, 1), F.lit(p.category), 1)
    return F.filter(F.transform(found, lambda c: F.trim(c)), lambda c: c != "")


def subcategories(html: Column, p: HtmlProfile = MEDIAWIKI) -> Column:
    if not p.subcategory_scope:
        return F.array().cast("array<string>")
    found = F.regexp_extract_all(F.regexp_extract(html, p.subcategory_scope, 1), F.lit(r'href="([^"]+)\.html"'), 1)
    return F.array_distinct(found)


def members(html: Column, p: HtmlProfile = MEDIAWIKI) -> Column:
    """Member pages of a category page, without categories, special and talk pages."""
    if not p.member_scope:
        return F.array().cast("array<string>")
    found = F.regexp_extract_all(F.regexp_extract(html, p.member_scope, 1), F.lit(r'href="([^"]+)\.html"'), 1)
    return F.array_distinct(F.filter(found, lambda x: ~x.rlike("^(Category_|Special_|Talk_)")))


def decode_entities(text: Column) -> Column:
    """Character references to characters: the no-break space first, then decimal and
    hexadecimal ones, then five named ones; other named ones become a blank. Numbers
    that are no code point stay as they are."""

    def char(code: Column, raw: Column) -> Column:
        ok = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(raw)

    t = F.replace(text, F.lit("&#160;"), F.lit(" "))
    t = replace_each(t, "&#[0-9]{1,7};", lambda m: char(F.regexp_extract(m, "([0-9]+)", 1).cast("long"), m))
    t = replace_each(t, "&#[xX][0-9a-fA-F]{1,6};", lambda m: char(F.conv(F.regexp_extract(m, "[xX]([0-9a-fA-F]+)", 1), 16, 10).cast("long"), m))
    for name, c in (("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'")):
        t = F.replace(t, F.lit(f"&{name};"), F.lit(c))
    return F.regexp_replace(t, "&[a-z]+;", " ")


def to_markdown(html: Column) -> Column:
    """Ordered rewrites of a body to Markdown. Tag names are matched whole, so that
    <br> is no <b> and <pre> no <p>."""
    t = html
    t = F.regexp_replace(t, r'(?s)<span class="mwe-math-element">.*?<annotation[^>]*>(.*?)</annotation>.*?</span>', r"\$$1\$")
    t = F.regexp_replace(t, r"<img\b[^>]*/?>", "")
    for tag, sign in (("h2", "##"), ("h3", "###"), ("h4", "####")):
        t = F.regexp_replace(t, rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", f"\n{sign} $1\n")
    for tag, sign in (("b", "**"), ("strong", "**"), ("i", "*"), ("em", "*"), ("code", "`")):
        t = F.regexp_replace(t, rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", f"{sign}$1{sign}")
    t = F.regexp_replace(t, r"(?s)<pre\b[^>]*>(.*?)</pre>", "\n```\n$1\n```\n")
    t = F.regexp_replace(t, r"<br\s*/?>", "\n")
    t = F.regexp_replace(t, r"<hr\s*/?>", "\n---\n")
    t = F.regexp_replace(t, r"(?s)<li\b[^>]*>(.*?)</li>", "- $1\n")
    t = F.regexp_replace(t, r'(?s)<a\b[^>]*class="mw-selflink"[^>]*>(.*?)</a>', "$1")
    link = r'(?s)<a\b[^>]*href="[^"]+\.html"[^>]*>.*?</a>'
    target = lambda m: F.replace(F.regexp_extract(m, r'href="([^"]+\.html)"', 1), F.lit(".html"), F.lit(""))
    label = lambda m: F.regexp_replace(F.regexp_extract(m, r"(?s)<a\b[^>]*>(.*?)</a>", 1), "<[^>]+>", "")
    t = replace_each(t, link, lambda m: F.concat(F.lit("[["), target(m), F.lit("|"), label(m), F.lit("]]")))
    t = F.regexp_replace(t, r"(?s)<p\b[^>]*>(.*?)</p>", "\n$1\n")
    for kind, name in (("warning", "Warning"), ("important", "Important")):
        t = F.regexp_replace(t, rf'(?s)<div[^>]*class="[^"]*{kind}[^"]*"[^>]*>(.*?)</div>', f"\n> **{name}:** $1\n")
    t = F.regexp_replace(t, "<[^>]+>", " ")
    return squeeze(decode_entities(t))


def squeeze(text: Column) -> Column:
    """At most one empty line and one blank in a row, none around line ends."""
    t = F.regexp_replace(text, "\n{3,}", "\n\n")
    t = F.regexp_replace(t, "[ \t]{2,}", " ")
    t = F.regexp_replace(t, " *\n *", "\n")
    return F.regexp_replace(t, r"^\s+|\s+$", "")
