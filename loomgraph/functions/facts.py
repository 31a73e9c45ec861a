"""Structured facts from parameter pages, as Column expressions.

A page reads ``TAG = <type or values> Default: <...> Description: <...> --- body``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions import fixed
from loomgraph.functions.markup import blank_to_null
from loomgraph.functions.text import shorten, strip

TYPES = ("real", "integer", "logical", "string", "complex")


def _plain(content: Column) -> Column:
    return F.replace(strip(content), F.lit("**"), F.lit(""))


def _body(plain: Column) -> Column:
    """What follows the first rule."""
    return F.regexp_extract(plain, "(?s)^.*?---(.*)$", 1)


def fact_type(content: Column) -> Column:
    """Type in brackets, else a bare keyword after '=', else what the value list suggests."""
    t = _plain(content)
    names = "|".join(x for k in TYPES for x in (k, k.capitalize()))
    bracket = F.lower(F.regexp_extract(t, rf"[=≤]\s*\[([^\]]*(?:{names})[^\]]*)\]", 1))
    out = F.when(F.lit(False), "")
    for k in TYPES:
        out = out.when(bracket.contains(k), k)
    for k in ("real", "logical", "integer", "string", "complex"):
        out = out.when((bracket == "") & t.rlike(rf"(?i)=\s*{k}\b"), k)
    values = F.regexp_extract(t, r"=\s*(.+?)\s+Default:", 1)
    out = out.when(t.rlike(r"=\s*\.TRUE\.\s*\|\s*\.FALSE\."), "logical").when(t.rlike(r"=\s*-?\d+\s*\|\s*-?\d+"), "integer enum")
    return out.when(values.contains("|"), F.when(F.length(strip(values)) < 80, "enum").otherwise("string")).otherwise("unknown")


def fact_default(content: Column) -> Column:
    t = _plain(content)
    d = strip(F.regexp_extract(t, r"Default:\s*(?:[A-Z_]+ = )?(.+?)(?:\s*Description:|\s*$)", 1))
    d = strip(F.regexp_replace(shorten(d, 120, "..."), r"\s*\{[^}]*\}\s*", ""))
    return F.coalesce(blank_to_null(d), F.lit("(see description)"))


def definition(content: Column) -> Column:
    """First sentence after 'Description:'."""
    return strip(F.regexp_extract(_plain(content), r"Description:\s*(.+?)(?:\.\s|\.$|\s*---)", 1))


def options(content: Column) -> Column:
    """Values of the list before 'Default:' with what the body says of each; null unless there are two."""
    t = _plain(content)
    head, body = F.regexp_extract(t, "(?s)^(.*?)(?:---.*)?$", 1), _body(t)
    tag = F.regexp_extract(t, r"^([A-Z][A-Z_0-9]+)\s*=", 1)
    listed = strip(F.regexp_extract(head, r"=\s*(.+?)(?:\s+Default:)", 1))
    values = F.filter(F.transform(F.split(listed, r"\|", -1), strip), lambda v: (v != "") & (v != "..."))

    def described(v: Column) -> Column:
        pattern = F.concat(F.lit(r"(?im)(?:^|\n)\s*(?:-\s*)?\Q"), tag, F.lit(r"\E\s*=\s*\Q"), v, F.lit(r"\E[^\S\n]*(.*?)(?=\n|$)"))
        return F.struct(v.alias("value"), strip(F.call_function("regexp_extract", body, pattern, F.lit(1))).alias("description"))

    return F.when(~listed.rlike(r"^\[.*\]$") & (F.size(values) > 1), F.transform(values, described))


def warnings(content: Column) -> Column:
    """Distinct sentences of the body, of 30 to 400 characters, that warn; null if none."""
    parts = F.transform(F.split(_body(_plain(content)), r"(?<=[.!])\s+", -1), strip)
    return _warned(parts)


def _warned(parts: Column) -> Column:
    words = "(?i)" + "|".join(fixed.WARNING_WORDS)
    own = F.array_distinct(F.filter(parts, lambda s: F.length(s).between(30, 400) & s.rlike(words)))
    return F.when(F.size(own) > 0, own)


def warning_sentences(text: Column) -> Column:
    """Warning sentences of a whole text, an empty list if none."""
    return F.coalesce(_warned(F.transform(F.split(text, r"(?<=[.!])\s+", -1), strip)), F.array().cast("array<string>"))


def facts(content: Column) -> Column:
    """All facts of a page as a struct; null for texts known to be no parameter page."""
    raw, t = strip(content), _plain(content)
    tag = F.regexp_extract(t, r"^([A-Z][A-Z_0-9]+)\s*=", 1)
    other = F.lit(False)
    for s in fixed.FACT_FREE_STARTS:
        other = other | t.startswith(s)
    skip = (tag == "") & (other | t.rlike(r"^\d+\.\d+\.\d+"))
    described = strip(F.regexp_extract(raw, r"(?s)Description:\s*(.+)", 1))
    text = F.when(described != "", F.when(F.length(described) > 1500, F.regexp_replace(F.left(described, F.lit(1500)), "(?s) [^ ]*$", "")).otherwise(described)).otherwise(raw)
    quick = F.struct(F.coalesce(blank_to_null(tag), F.lit("?")).alias("tag"), fact_type(content).alias("type"), fact_default(content).alias("default"), text.alias("raw_description"))
    return F.when(~skip, F.struct(quick.alias("quick_facts"), definition(content).alias("definition"), options(content).alias("options"), warnings(content).alias("warnings")))
