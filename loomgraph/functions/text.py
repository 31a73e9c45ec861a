"""Summaries, slugs, names and other short texts, as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_EDGE = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE, "")


def at_word(text: Column, n: int) -> Column:
    """The first ``n`` characters, cut back to before the last blank among them."""
    return F.regexp_replace(F.left(text, F.lit(n)), "(?s) [^ ]*$", "")


def shorten(text: Column, n: int, suffix: str = "") -> Column:
    """``text`` if it has at most ``n`` characters, else cut at a word, with ``suffix``."""
    return F.when(F.length(text) > n, F.concat(at_word(text, n), F.lit(suffix))).otherwise(text)


def first_sentence(text: Column, n: int = 100) -> Column:
    """Up to the first full stop followed by a blank or line end, if it is after the
    tenth and before the ``n``-th character; else cut at a word."""
    t = F.coalesce(text, F.lit(""))
    out = F.when(t == "", "")
    for sep in (". ", ".\n", ".\r"):
        at = F.instr(t, sep) - 1
        out = out.when((at > 10) & (at < n), strip(F.left(t, at + 1)))
    return out.when(F.length(t) > n, F.concat(at_word(t, n), F.lit("…"))).otherwise(strip(t))


def link_context(content: Column) -> Column:
    """First sentence of more than ten characters among the first 300, cut to 120; null if none."""
    parts = F.transform(F.split(F.left(content, F.lit(300)), r"(?<=[.!])\s+", -1), strip)
    good = F.filter(parts, lambda s: F.length(s) > 10)
    return F.when(F.size(good) > 0, F.left(F.get(good, F.lit(0)), F.lit(120)))


def file_name(name: Column) -> Column:
    """Characters that file systems reserve become underscores; at most 100 characters."""
    return F.left(F.translate(name, '<>:"/\\|?*', "_________"), F.lit(100))


def ascii_fold(c: Column) -> Column:
    """Compatibility decomposition without what is not ASCII; no built-in does that.

    Texts go to Python in Arrow batches."""

    @F.pandas_udf(StringType())
    def fold(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")

    return fold(c)


def slug(title: Column) -> Column:
    """Lower-case ASCII words joined by hyphens; 'entry' if nothing is left."""
    t = F.regexp_replace(F.regexp_replace(F.lower(ascii_fold(title)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(t == "", "entry").otherwise(t)


def display_name(name: Column) -> Column:
    return F.trim(F.replace(name, F.lit("_"), F.lit(" ")))


def unlink(text: Column, plain: bool = False) -> Column:
    """[[a|b]] becomes b, [[a]] becomes a; with ``plain``, ** and $ go as well."""
    t = F.regexp_replace(F.regexp_replace(text, r"\[\[[^\]|]*\|([^\]]*)\]\]", "$1"), r"\[\[([^\]]*)\]\]", "$1")
    return F.replace(F.replace(t, F.lit("**"), F.lit("")), F.lit("$"), F.lit("")) if plain else t


def split_reply(reply: Column) -> Column:
    """'a:b' as struct(a, b); without a colon both are the reply."""
    parts = F.split(reply, ":", 2)
    return F.struct(F.lower(strip(parts[0])).alias("entry_type"), F.lower(strip(F.coalesce(F.get(parts, F.lit(1)), reply))).alias("subtype"))


def unfence(reply: Column) -> Column:
    """A reply without the Markdown fences around its JSON."""
    return strip(F.regexp_replace(reply, "(?m)^\\s*```(?:json)?\\s*$", ""))


def prompt(title: Column, content: Column, n: int, template: str = "Title: %s\n\nContent: %s") -> Column:
    return F.format_string(template, title, F.left(content, F.lit(n)))


def lookup(key: Column, table: dict[str, str], default: str) -> Column:
    """Value of a small constant table, or the default."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key), F.lit(default))
