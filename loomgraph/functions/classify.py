"""Page classification by name, tags and text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions import fixed


def _any(text: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | text.contains(p)
    return out


def by_name(name: Column) -> Column:
    """Subtype that a page name suggests, or null; the first rule that holds decides."""
    low = F.lower(F.replace(name, F.lit("_"), F.lit(" ")))
    return (
        F.when(name.startswith("Category_"), "domain")
        .when(name.rlike("^[A-Z][A-Z_0-9]+$") & (F.length(name) < 50), "parameter")
        .when(_any(low, fixed.TUTORIAL_NAMES), "tutorial")
        .when(_any(low, fixed.PRACTICE_NAMES), "best_practice")
        .when(_any(low, fixed.PITFALL_NAMES), "pitfall")
    )


def by_page(name: Column, tags: Column) -> Column:
    """``struct(entry_type, subtype)``: tags first, then the name, else generic."""
    low = F.transform(F.coalesce(tags, F.array().cast("array<string>")), F.lower)
    joined = F.array_join(low, " ")
    kind = lambda e, s: F.struct(F.lit(e).alias("entry_type"), F.lit(s).alias("subtype"))
    named = by_name(name)
    return (
        F.when(name.startswith("Category_"), kind("capability", "domain"))
        .when(F.exists(low, lambda c: c.contains("incar")), kind("capability", "parameter"))
        .when(F.exists(low, lambda c: c.isin(*fixed.TUTORIAL_TAGS)), kind("procedure", "tutorial"))
        .when(F.exists(low, lambda c: c.contains("theory")), kind("capability", "domain"))
        .when(_any(joined, fixed.PITFALL_TAGS), kind("constraint", "pitfall"))
        .when(_any(joined, fixed.FILE_TAGS), kind("procedure", "tutorial"))
        .when(_any(joined, fixed.DOMAIN_TOPICS), kind("capability", "domain"))
        .when((named == "parameter") & ((joined == "") | _any(joined, ("incar", "potcar"))), kind("capability", "parameter"))
        .when(named == "tutorial", kind("procedure", "tutorial"))
        .when(named == "best_practice", kind("heuristic", "best_practice"))
        .when(named == "pitfall", kind("constraint", "pitfall"))
        .otherwise(kind("capability", "generic"))
    )


def from_store(entry_type: Column, content: Column, metadata_json: Column) -> Column:
    """Subtype of a stored entry; one named in its metadata wins, even if empty."""
    named = F.get_json_object(metadata_json, "$.custom.subtype")
    derived = (
        F.when(entry_type == "constraint", "pitfall")
        .when(entry_type == "heuristic", "best_practice")
        .when(entry_type == "procedure", "tutorial")
        .when(entry_type == "capability", F.when(content.contains("## Quick Facts"), "parameter").otherwise("domain"))
        .otherwise("generic")
    )
    return F.coalesce(named, derived)


def excluded(name: Column) -> Column:
    """Whether the name is in a namespace that is no content."""
    return name.rlike("^(" + "|".join(fixed.EXCLUDED_PREFIXES) + ")")


def empty_page(body: Column, stub: bool = True) -> Column:
    """Whether the text says that there is none; with ``stub``, also if it is a short stub notice."""
    low = F.lower(body)
    out = low.startswith(fixed.EMPTY_PAGE)
    return out | (low.contains(fixed.EMPTY_CATEGORY) & (F.length(body) < 80)) if stub else out
