"""Column functions on literals: one row each, exact results."""

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import classify, cleaning, facts, fixed, markup, terms, text


@pytest.fixture(scope="module")
def value(spark):
    def run(c):
        return spark.range(1).select(c.alias("v")).first().v

    return run


@pytest.mark.parametrize(
    ("name", "tags", "expected"),
    [
        ("ENCUT", ["INCAR tag"], ("capability", "parameter")),
        ("Anything", ["Examples"], ("procedure", "tutorial")),
        ("Anything", ["Known issues"], ("constraint", "pitfall")),
        ("Anything", ["Theory"], ("capability", "domain")),
        ("Category_Magnetism", ["Examples"], ("capability", "domain")),
        ("Page", ["Magnetism"], ("capability", "domain")),
        ("NPAR", [], ("capability", "parameter")),
        ("A" * 60, [], ("capability", "generic")),
        ("NPAR", ["other"], ("capability", "generic")),
        ("How_To_relax", [], ("procedure", "tutorial")),
        ("Recommended_choice", [], ("heuristic", "best_practice")),
        ("Be_careful_here", [], ("constraint", "pitfall")),
        ("Plain", None, ("capability", "generic")),
    ],
)
def test_classify_page(value, name, tags, expected):
    arr = F.array(*[F.lit(t) for t in tags]) if tags else (F.array().cast("array<string>") if tags == [] else F.lit(None).cast("array<string>"))
    assert tuple(value(classify.by_page(F.lit(name), arr))) == expected


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        (r"\frac{a}{b}", "(a)/(b)"),
        (r"\sigma and \leq", "σ and ≤"),
        (r"{\displaystyle x}", "x"),
        (r"x^{2} y_{i}", "x^2 y_i"),
        (r"a \unknown b", "a b"),
        ("plain sentence stays.", "plain sentence stays."),
        ("a  b \n\n\n\n c", "a b\n\nc"),
        ("see $\\alpha$", "see$α$"),
        ("Long enough prose before the marker to be cut. Retrieved from here", "Long enough prose before the marker to be cut."),
        ("Retrieved from the start, so it is kept as it is here", "Retrieved from the start, so it is kept as it is here"),
    ],
)
def test_clean_text(value, raw, clean):
    assert value(cleaning.clean_text(F.lit(raw))) == clean


def test_markdown_and_entities(value):
    html = '<h2 class="x">T</h2><p>a <b>bold</b><br>c &amp; d &#228; &#x3b1; &copy; &#9999999;</p><a class="k" href="Other_page.html"><i>label</i></a>'
    assert value(markup.to_markdown(F.lit(html))) == "## T\n\na **bold**\nc & d ä α &#9999999;\n[[Other_page|*label*]]"
    assert value(markup.decode_entities(F.lit("&#55296; &#65;"))) == "&#55296; A"


def test_mediawiki_parts(value):
    html = (
        '<title>Name - The Wiki</title><div class="mw-parser-output"><a href="A.html">a</a><a href="http://x/B.html">b</a><a href="Talk:C.html">c</a><a href="A.html">a</a>'
        '<div id="catlinks"><div id="mw-normal-catlinks"><a title="Category: Files ">f</a></div></div>'
    )
    assert value(markup.title(F.lit(html), F.lit("N_x"))) == "Name"
    assert value(markup.title(F.lit(""), F.lit("N_x"))) == "N x"
    assert value(markup.links(F.lit(html))) == ["A"]
    assert value(markup.categories(F.lit(html))) == ["Files"]


@pytest.mark.parametrize(
    ("page", "kind"),
    [
        ("X = [integer or real] Default: 1", "real"),
        ("X = logical Default: a", "logical"),
        ("X = .TRUE. | .FALSE. Default: .TRUE.", "logical"),
        ("X = 1 | 2 Default: 1", "integer enum"),
        ("X = Fast | Slow Default: Fast", "enum"),
        ("X = something Default: Fast", "unknown"),
    ],
)
def test_fact_type(value, page, kind):
    assert value(facts.fact_type(F.lit(page))) == kind


def test_facts(value):
    page = "MODE = A | B Default: A Description: Chooses the mode. More.\n---\n- MODE = A the first\nMODE = B the second\nThis is deprecated and will go away soon, take care."
    f = value(facts.facts(F.lit(page)))
    assert f.quick_facts.tag == "MODE" and f.quick_facts.default == "A" and f.definition == "Chooses the mode"
    assert [(o.value, o.description) for o in f.options] == [("A", "the first"), ("B", "the second")]
    assert len(f.warnings) == 1 and "deprecated" in f.warnings[0]
    assert value(facts.facts(F.lit("The INCAR file is central."))) is None
    assert value(facts.facts(F.lit("6.4.1 changes"))) is None


@pytest.mark.parametrize(("n", "hit"), [(29, False), (30, True), (400, True), (401, False)])
def test_warning_length(value, n, hit):
    s = "Warning " + "x" * (n - 8)
    assert bool(value(facts.warning_sentences(F.lit(s)))) is hit


def test_short_texts(value):
    assert value(text.first_sentence(F.lit("A first sentence. And more."))) == "A first sentence."
    assert value(text.first_sentence(F.lit("word " * 40))).endswith("word…")
    assert value(text.first_sentence(F.lit(None).cast("string"))) == ""
    assert value(text.slug(F.lit("Élan & Co."))) == "elan-co" and value(text.slug(F.lit("!!"))) == "entry"
    assert value(text.unlink(F.lit("[[a|b]] [[c]]"))) == "b c"
    assert value(text.link_context(F.lit("Hi. This one is long enough."))) == "This one is long enough."
    assert value(text.link_context(F.lit("Hi."))) is None
    assert value(text.file_name(F.lit("a/b:c"))) == "a_b_c"


def _stem(w):
    changed = True
    while changed:
        changed = False
        for s in fixed.STEM_SUFFIXES:
            if w.endswith(s) and len(w) - len(s) >= 3:
                w, changed = w[: -len(s)], True
                break
    return w


def test_stem_is_fixed_point(spark):
    words = ["magnetization", "calculations", "relaxing", "convergences", "realisticallyness", "is", "ness", "organizational"]
    got = {r.w: (r.s, r.t) for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", terms.stem(F.col("w")).alias("s"), terms.stem(terms.stem(F.col("w"))).alias("t")).collect()}
    assert got == {w: (_stem(w), _stem(w)) for w in words}


def test_expansion_and_tags(value):
    out = value(terms.expand(F.lit("magnetic k-point setup")))
    assert out[:4] == ["magnetic", "k-point", "setup", "kpoints"] and "spin" in out and len(out) == len(set(out)) <= 20
    assert value(terms.expand(F.lit("the of"))) == []
    tags = F.array(*[F.lit(str(i)) for i in range(12)])
    assert value(terms.merge_tags(tags, F.array().cast("array<string>"))) == [str(i) for i in range(10)]
    assert value(terms.merge_tags(tags, F.array(F.lit("x"), F.lit("0"), F.lit("y"), F.lit("z")))) == [*map(str, range(8)), "x", "y"]
