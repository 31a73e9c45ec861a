"""Removal of navigation residue and LaTeX from page texts, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions import fixed
from loomgraph.functions.markup import let


def cut_navigation(text: Column) -> Column:
    """Cut at each navigation marker that starts after two fifths of what is left."""
    t = text
    for marker in fixed.NAV_MARKERS:
        t = let(t, _cut_at(marker))
    return t


def _cut_at(marker: str):
    def cut(x: Column) -> Column:
        before = F.regexp_extract(x, f"(?is)^(.*?){marker}", 1)
        late = let(before, lambda y: F.when(F.length(y) > 0.4 * F.length(x), F.regexp_replace(y, r"^\s+|\s+$", "")).otherwise(x))
        return F.when(x.rlike(f"(?i){marker}"), late).otherwise(x)

    return cut


def _symbols(t: Column) -> Column:
    for command, sign in fixed.LATEX_SYMBOLS.items():
        t = F.replace(t, F.lit(command), F.lit(sign))
    t = F.regexp_replace(t, r"\\[a-zA-Z]+", "")
    for _ in range(3):
        t = F.regexp_replace(t, r"\{([^{}]*)\}", "$1")
    return t


def clean_latex(text: Column) -> Column:
    """LaTeX outside of formulae: fonts, fractions, scripts, symbols, braces."""
    t = F.regexp_replace(text, r"\{\\displaystyle\s+(.+)\}", "$1")
    for font in ("mathrm", "textrm", "text", "mathit"):
        t = F.regexp_replace(t, rf"\{{\\{font}\{{([^}}]+)\}}\}}", "$1")
    t = F.regexp_replace(t, r"\{\\mathbf\{([^}]+)\}\}", r"\*\*$1\*\*")
    for font in ("mathrm", "mathbf", "textrm", "text", "mathit", "displaystyle"):
        t = F.regexp_replace(F.regexp_replace(t, rf"\\{font}\{{([^}}]+)\}}", "$1"), rf"\\{font}\b", "")
    t = F.regexp_replace(t, r"\\frac\{([^{}]*)\}\{([^{}]*)\}", "($1)/($2)")
    t = F.regexp_replace(t, r"\^\{([^{}]+)\}", "^$1")
    t = F.regexp_replace(t, r"_\{([^{}]+)\}", "_$1")
    return _symbols(t)


def clean_formula(latex: Column) -> Column:
    """LaTeX between dollar signs."""
    t = F.regexp_replace(latex, r"\{\\displaystyle\s+(.+)\}", "$1")
    for font in ("mathrm", "mathbf", "textrm", "text"):
        t = F.regexp_replace(t, rf"\\{font}\{{([^{{}}]+)\}}", "$1")
    return _symbols(F.regexp_replace(t, r"\\frac\{([^{}]*)\}\{([^{}]*)\}", "($1)/($2)"))


def whitespace(text: Column, glue: bool = True) -> Column:
    """Blanks and line ends squeezed; with ``glue``, none on either side of a dollar sign."""
    t = F.regexp_replace(F.regexp_replace(text, r"\$\s+", r"\$"), r"\s+\$", r"\$") if glue else text
    t = F.regexp_replace(F.regexp_replace(t, "[ \t]+", " "), " *\n *", "\n")
    return F.regexp_replace(F.regexp_replace(t, "\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def clean_text(text: Column, glue: bool = True) -> Column:
    """Navigation cut, LaTeX cleaned outside and inside of formulae, blanks squeezed."""
    formula = r"\$[^$]+\$"

    def run(t: Column) -> Column:
        outside = F.transform(F.split(t, formula, -1), clean_latex)
        inside = F.transform(F.regexp_extract_all(t, F.lit(f"({formula})"), 1), lambda m: F.concat(F.lit("$"), clean_formula(F.substr(m, F.lit(2), F.length(m) - 2)), F.lit("$")))
        return F.array_join(F.zip_with(outside, F.concat(inside, F.array(F.lit(""))), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")

    return whitespace(let(cut_navigation(text), run), glue)
