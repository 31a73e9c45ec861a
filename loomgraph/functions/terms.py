"""Tokens, stems and query terms, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions import fixed

#: No suffix comes before a longer one that ends in it, so the lazy match takes the first of the list.
ONE_STRIP = "^(.{3,}?)(?:" + "|".join(fixed.STEM_SUFFIXES) + ")$"
STRIPS = 8


def stem_once(word: Column) -> Column:
    """The word without its first suffix of the list that leaves three letters."""
    return F.regexp_replace(F.lower(word), ONE_STRIP, "$1")


def stem(word: Column, strips: int = STRIPS) -> Column:
    """Suffixes stripped until none fits; ``strips`` passes reach that for all but absurd words."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(strips)), F.lower(word), lambda w, _: F.regexp_replace(w, ONE_STRIP, "$1"))


def no_stop(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(*fixed.STOP_WORDS))  # becomes a look-up in a hash set


def index_text(title: Column, content: Column) -> Column:
    """What the tokens of a page are taken from: the title three times, then the content."""
    return F.lower(F.concat(F.repeat(F.concat(F.coalesce(title, F.lit("")), F.lit(" ")), F.lit(3)), F.coalesce(content, F.lit(""))))


def index_tokens(title: Column, content: Column) -> Column:
    """Tokens of a page in order, the title three times first, without stop words."""
    return no_stop(F.regexp_extract_all(index_text(title, content), F.lit("([a-z0-9]{2,})"), 1))


class Stems(dict):
    """Stems of words of ASCII letters and digits, as bytes, for loops over tokens in Python: as ``stem``,
    and None for stop words. What has been looked up is kept, up to ``most`` words.

    ``fresh`` gathers the raw words in what had to be looked up: tokens contain all raw words of a text."""

    _strip = re.compile(ONE_STRIP.encode()).match
    _raw = re.compile(rb"[a-z]{4,}").findall

    def __init__(self, most: int = 1 << 18):
        self.most = most
        self.stop = {w.encode() for w in fixed.STOP_WORDS}
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> bytes | None:
        if len(self) >= self.most:
            self.clear()
        out = None if word in self.stop else word
        for _ in range(STRIPS if out is not None else 0):
            m = self._strip(out)
            if m is None:
                break
            out = m[1]
        self[word] = out
        self.fresh += [w for w in self._raw(word) if w not in self.stop]
        return out


def query_tokens(query: Column) -> Column:
    return no_stop(F.regexp_extract_all(F.lower(query), F.lit("([a-z0-9]{2,})"), 1))


def raw_words(text: Column) -> Column:
    """Words for the spelling vocabulary."""
    return F.array_distinct(no_stop(F.regexp_extract_all(F.lower(text), F.lit("([a-z]{4,})"), 1)))


def index_terms(title: Column, definition: Column, content: Column) -> Column:
    """Up to 30 stems of four letters or more that differ from their words, in order."""
    text = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(definition, F.lit("")), F.left(F.coalesce(content, F.lit("")), F.lit(2000)))
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("([a-z]{4,})"), 1))
    pairs = F.filter(F.transform(words, lambda w: F.struct(w.alias("w"), stem_once(w).alias("s"))), lambda p: (p["w"] != p["s"]) & (F.length(p["s"]) >= 4))
    return F.slice(F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["s"]))), 1, 30)


def merge_tags(tags: Column, stems: Column) -> Column:
    """Eight tags and up to five stems that are no tag, ten in all; without stems ten tags."""
    fresh = F.slice(F.array_except(stems, F.slice(tags, 1, 8)), 1, 5)
    return F.when(F.size(stems) == 0, F.slice(tags, 1, 10)).otherwise(F.slice(F.concat(F.slice(tags, 1, 8), fresh), 1, 10))


def _arrays(table: dict[str, list[str]]) -> Column:
    return F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])


def expand(query: Column, most: int = 20) -> Column:
    """A query's tokens and their compounds, variants, concepts and plain stems, in order, distinct."""
    empty = F.array().cast("array<string>")
    own = F.filter(no_stop(F.regexp_extract_all(F.lower(query), F.lit("([a-zA-Z0-9_-]+)"), 1)), lambda t: F.length(t) > 1)
    flat = F.translate(F.lower(query), "_-", "  ")
    # patterns are given the same form as the query
    compounds = F.array_compact(F.array(*[F.when(flat.contains(k.replace("-", " ")), v) for k, v in fixed.COMPOUNDS.items()]))
    base = F.concat(own, F.array_except(compounds, own))
    morph, concept = _arrays(fixed.MORPH_VARIANTS), _arrays(fixed.CONCEPTS)

    def more(t: Column) -> Column:
        s = F.regexp_replace(t, "(s|tion|ing|ed|al|ic|ity|ize)$", "")
        plain = F.when((F.length(s) > 3) & (s != t), F.array(s)).otherwise(empty)
        return F.concat(F.coalesce(F.element_at(morph, t), empty), F.coalesce(F.element_at(concept, t), empty), plain)

    return F.slice(F.array_distinct(F.concat(base, F.flatten(F.transform(base, more)))), 1, most)
