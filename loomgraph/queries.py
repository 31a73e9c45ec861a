"""The engine's operators applied to the test tables, each with DuckDB SQL where SQL can express it.

Concepts of a document graph map to the tables so: ``pages`` are pages in the ARTICLE
layout; the star schema is a typed graph (regions contain nations, customers and
suppliers belong to nations, suppliers have parts, parts link to the next one of
their brand, customers link to orders, which are no nodes and so dangle);
``documents`` are the search corpus and ``benchmark`` the queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.functions import classify, cleaning, facts, fixed, markup, terms, text
from loomgraph.operators import graph, iterative
from loomgraph.plans import build, publish, search
from loomgraph.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- inputs ---------------------------------------------------------------------------


def pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(F.concat(F.lit("Page_"), F.col("page_id").cast("string")).alias("id"), "html", F.col("page_id").alias("ord"))


PAGES = "SELECT 'Page_' || page_id AS id, html, page_id AS ord FROM pages"
TITLE = r"regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
NAV = r"regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"
BODY = r"regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"


def star_nodes(spark: SparkSession, d: str) -> DataFrame:
    def part(name: str, letter: str, key: str, title: str, subtype: str, at: int, content) -> DataFrame:
        return table(spark, d, name).select(
            F.concat(F.lit(f"{letter}:"), F.col(key).cast("string")).alias("id"), F.col(title).alias("title"), F.lit(subtype).alias("subtype"),
            (F.lit(at * 10**9) + F.col(key)).cast("long").alias("ord"), content.alias("content"), F.lit(name).alias("category"),
        )

    out = part("region", "R", "r_regionkey", "r_name", "domain", 0, F.lit(""))
    out = out.unionAll(part("nation", "N", "n_nationkey", "n_name", "tutorial", 1, F.lit("")))
    out = out.unionAll(part("customer", "C", "c_custkey", "c_name", "generic", 2, F.col("c_mktsegment")))
    out = out.unionAll(part("supplier", "S", "s_suppkey", "s_name", "best_practice", 3, F.lit("")))
    out = out.unionAll(part("part", "P", "p_partkey", "p_name", "parameter", 4, F.concat_ws(" ", "p_brand", "p_type")))
    return out.withColumn("tags", F.array("category")).withColumn("aliases", F.array().cast("array<string>")).withColumn("entry_type", F.lit("capability"))


NODES = """nodes AS (
  SELECT 'R:' || r_regionkey AS id, r_name AS title, 'domain' AS subtype, r_regionkey::BIGINT AS ord, '' AS content, 'region' AS category FROM region
  UNION ALL SELECT 'N:' || n_nationkey, n_name, 'tutorial', 1000000000 + n_nationkey, '', 'nation' FROM nation
  UNION ALL SELECT 'C:' || c_custkey, c_name, 'generic', 2000000000 + c_custkey, c_mktsegment, 'customer' FROM customer
  UNION ALL SELECT 'S:' || s_suppkey, s_name, 'best_practice', 3000000000 + s_suppkey, '', 'supplier' FROM supplier
  UNION ALL SELECT 'P:' || p_partkey, p_name, 'parameter', 4000000000 + p_partkey, p_brand || ' ' || p_type, 'part' FROM part)"""


def star_edges(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    ref = lambda letter, col: F.concat(F.lit(f"{letter}:"), F.col(col).cast("string"))

    def e(df: DataFrame, source, target, relation: str, family: int, order) -> DataFrame:
        return df.select(source.alias("source"), target.alias("target"), F.lit(relation).alias("relation"), (F.lit(family * 10**14) + order).cast("long").alias("ord"))

    following = F.lead("p_partkey").over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    sold = iterative.dealt(t("lineitem").select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey").distinct()
    orders = iterative.dealt(t("orders").select("o_custkey", "o_orderkey"), "o_orderkey")
    out = e(t("nation"), ref("R", "n_regionkey"), ref("N", "n_nationkey"), "contains", 0, F.col("n_nationkey"))
    out = out.unionAll(e(t("nation"), ref("N", "n_nationkey"), ref("R", "n_regionkey"), "belongs_to", 1, F.col("n_nationkey")))
    out = out.unionAll(e(t("customer"), ref("C", "c_custkey"), ref("N", "c_nationkey"), "belongs_to", 2, F.col("c_custkey")))
    out = out.unionAll(e(t("supplier"), ref("S", "s_suppkey"), ref("N", "s_nationkey"), "belongs_to", 3, F.col("s_suppkey")))
    out = out.unionAll(e(sold, ref("S", "l_suppkey"), ref("P", "l_partkey"), "has_subcategory", 4, F.col("l_suppkey") * 10**7 + F.col("l_partkey")))
    out = out.unionAll(e(t("part").withColumn("f", following).where("f is not null"), ref("P", "p_partkey"), ref("P", "f"), "wikilink", 5, F.col("p_partkey")))
    return out.unionAll(e(orders, ref("C", "o_custkey"), ref("O", "o_orderkey"), "wikilink", 6, F.col("o_orderkey")))


EDGES = """edges AS (
  SELECT 'R:' || n_regionkey AS source, 'N:' || n_nationkey AS target, 'contains' AS relation, n_nationkey::BIGINT AS ord FROM nation
  UNION ALL SELECT 'N:' || n_nationkey, 'R:' || n_regionkey, 'belongs_to', 100000000000000 + n_nationkey FROM nation
  UNION ALL SELECT 'C:' || c_custkey, 'N:' || c_nationkey, 'belongs_to', 200000000000000 + c_custkey FROM customer
  UNION ALL SELECT 'S:' || s_suppkey, 'N:' || s_nationkey, 'belongs_to', 300000000000000 + s_suppkey FROM supplier
  UNION ALL SELECT 'S:' || l_suppkey, 'P:' || l_partkey, 'has_subcategory', 400000000000000 + l_suppkey * 10000000 + l_partkey FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
  UNION ALL SELECT 'P:' || p_partkey, 'P:' || f, 'wikilink', 500000000000000 + p_partkey FROM (SELECT p_partkey, lead(p_partkey) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS f FROM part) WHERE f IS NOT NULL
  UNION ALL SELECT 'C:' || o_custkey, 'O:' || o_orderkey, 'wikilink', 600000000000000 + o_orderkey FROM orders)"""
INTERNAL = "inner_edges AS (SELECT e.* FROM edges e SEMI JOIN nodes s ON e.source = s.id SEMI JOIN nodes t ON e.target = t.id)"
G = f"WITH {NODES}, {EDGES}, {INTERNAL}"
DEGREE = "deg AS (SELECT id, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree, (sum(o) + sum(i))::BIGINT AS degree FROM (SELECT source AS id, 1 AS o, 0 AS i FROM {0} UNION ALL SELECT target, 0, 1 FROM {0}) GROUP BY id)"

HEAD = "array_to_string(list_slice(string_split_regex(text, '[ \\n]+'), 1, 3), ' ')"


def corpus(spark: SparkSession, d: str) -> DataFrame:
    """documents as nodes: the title is the first three words, the type follows the language."""
    head = F.array_join(F.slice(F.split("text", "[ \n]+", 4), 1, 3), " ")
    kind = F.when(F.col("lang") == "en", "tutorial").when(F.col("lang") == "de", "parameter").when(F.col("lang") == "fr", "domain").otherwise("generic")
    return table(spark, d, "documents").select(F.concat(F.lit("D:"), F.col("doc_id").cast("string")).alias("id"), F.col("doc_id").alias("ord"), head.alias("title"), F.col("text").alias("content"), kind.alias("subtype"), F.col("source").alias("category"))


CORPUS = f"""corpus AS (
  SELECT 'D:' || doc_id AS id, doc_id AS ord, {HEAD} AS title, text AS content, source AS category,
         CASE lang WHEN 'en' THEN 'tutorial' WHEN 'de' THEN 'parameter' WHEN 'fr' THEN 'domain' ELSE 'generic' END AS subtype
  FROM documents)"""


def asked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("qid"), F.col("text").alias("query"))


def doc_edges(nodes: DataFrame) -> DataFrame:
    """Documents of one source link to the next one of it."""
    following = F.lead("id").over(Window.partitionBy("category").orderBy("ord"))
    return nodes.select(F.col("id").alias("source"), following.alias("target"), F.lit("wikilink").alias("relation"), "ord").where("target is not null")


def golden(spark: SparkSession, d: str, nodes: DataFrame) -> DataFrame:
    """``qid, expected``: titles of the documents that contain the first 60 characters of a query's text.

    Such a document has all that stands between two blanks of the start between blanks
    too. The longest such part of each start is looked up among the document's; only starts
    without one are looked for in all documents."""
    b = table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("qid"), F.left("text", F.lit(60)).alias("start"))
    parts = F.split("start", " ", -1)
    inner = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    b = b.withColumn("part", F.array_max(F.transform(inner, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"])
    every = b.where("part is not null").agg(F.collect_set("part").alias("every"))
    has = nodes.crossJoin(F.broadcast(every)).select("title", "content", F.explode(F.array_intersect(F.split("content", " ", -1), "every")).alias("part"))  # one row
    rare = has.join(b, "part").where(F.col("content").contains(F.col("start")))
    other = nodes.join(b.where("part is null"), F.col("content").contains(F.col("start")))
    return rare.select("qid", "title").unionAll(other.select("qid", "title")).groupBy("qid").agg(F.collect_set("title").alias("expected"))


DOC_EDGES = "doc_edges AS (SELECT * FROM (SELECT id AS source, lead(id) OVER (PARTITION BY category ORDER BY ord) AS target, 'wikilink' AS relation, ord FROM corpus) WHERE target IS NOT NULL)"

STOP = "[" + ", ".join(f"'{w}'" for w in fixed.STOP_WORDS) + "]"
STRIP = terms.ONE_STRIP.replace("'", "''")


def sql_stem(word: str, times: int = terms.STRIPS) -> str:
    out = f"lower({word})"
    for _ in range(times):
        out = f"regexp_replace({out}, '{STRIP}', '\\1')"
    return out


TOKENS = f"""words AS (
  SELECT id, list_filter(regexp_extract_all(lower(repeat(title || ' ', 3) || content), '[a-z0-9]{{2,}}'), lambda w: NOT list_contains({STOP}, w)) AS ws FROM corpus),
tokens AS (SELECT id, unnest(ws) AS word, unnest(range(0, len(ws))) AS pos FROM words),
vocab AS (SELECT word, {sql_stem('word')} AS stem FROM (SELECT DISTINCT word FROM tokens)),
postings AS (SELECT stem, id, count(*)::INTEGER AS tf, list(pos ORDER BY pos) AS positions FROM tokens JOIN vocab USING (word) GROUP BY stem, id),
lengths AS (SELECT id, len(ws) AS length FROM words),
stats AS (SELECT count(*) AS n, sum(length) / greatest(count(*), 1) AS avgdl FROM lengths),
stems AS (SELECT stem, count(*) AS df, ln((any_value(n) - count(*) + 0.5) / (count(*) + 0.5) + 1) AS idf FROM postings, stats GROUP BY stem),
raw_vocab AS (SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_extract_all(lower(title || ' ' || content), '[a-z]{{4,}}')) AS w FROM corpus) WHERE NOT list_contains({STOP}, w))"""
ASKED = f"""qwords AS (SELECT DISTINCT item_id::VARCHAR AS qid, unnest(list_filter(regexp_extract_all(lower(text), '[a-z0-9]{{2,}}'), lambda w: NOT list_contains({STOP}, w))) AS word FROM benchmark),
unknown AS (SELECT DISTINCT word FROM qwords WHERE len(word) >= 4 AND word NOT IN (SELECT word FROM raw_vocab) AND word NOT IN (SELECT stem FROM stems) AND {sql_stem('word')} NOT IN (SELECT stem FROM stems)),
fixes AS (SELECT u.word, min({{'d': levenshtein(u.word, v.word), 'c': v.word}}) AS m FROM unknown u JOIN raw_vocab v ON left(u.word, 2) = left(v.word, 2) AND abs(len(u.word) - len(v.word)) <= 3 WHERE levenshtein(u.word, v.word) <= 2 GROUP BY u.word),
qfixed AS (SELECT qid, coalesce(m.c, qwords.word) AS word FROM qwords LEFT JOIN fixes ON qwords.word = fixes.word),
qstems AS (SELECT DISTINCT qid, {sql_stem('word')} AS stem FROM qfixed)"""
BM25 = """hits AS (SELECT q.qid, p.id, p.stem, p.positions, s.idf * p.tf * 2.5 / (p.tf + 1.5 * (0.25 + 0.75 * l.length / stats.avgdl)) AS part
  FROM qstems q JOIN stems s USING (stem) JOIN postings p USING (stem) JOIN lengths l USING (id), stats),
raw AS (SELECT qid, id, sum(part) AS raw FROM hits GROUP BY qid, id),
spots AS (SELECT qid, id, stem, unnest(positions) AS pos FROM hits),
steps AS (SELECT qid, id, stem, pos,
   lag(pos) OVER w AS p1, lag(stem) OVER w AS s1, lead(pos) OVER w AS p2, lead(stem) OVER w AS s2 FROM spots WINDOW w AS (PARTITION BY qid, id ORDER BY pos)),
near AS (SELECT qid, id, count(DISTINCT stem) AS n_near FROM steps WHERE (s1 <> stem AND pos - p1 <= 30) OR (s2 <> stem AND p2 - pos <= 30) GROUP BY qid, id),
scored AS (SELECT qid, id, coalesce(n_near, 0)::INTEGER AS n_near, round(CASE WHEN coalesce(n_near, 0) >= 2 THEN raw * (1 + 0.3 * (n_near - 1)) ELSE raw END, 9) AS score FROM raw LEFT JOIN near USING (qid, id)),
ranked AS (SELECT s.*, c.ord, row_number() OVER (PARTITION BY qid ORDER BY score DESC, c.ord)::INTEGER AS rank FROM scored s JOIN corpus c USING (id))"""


# -- text -----------------------------------------------------------------------------


@query(f"SELECT id, coalesce(nullif(trim({TITLE}), ''), replace(id, '_', ' ')) AS title, {BODY} AS body FROM ({PAGES})")
def html_title_body(spark, d):
    p = pages(spark, d)
    return p.select("id", markup.title(F.col("html"), F.col("id"), markup.ARTICLE).alias("title"), markup.body_html(F.col("html"), markup.ARTICLE).alias("body"))


@query(f"""SELECT id, target FROM (SELECT id, unnest(list_distinct(list_transform(list_filter(regexp_extract_all({NAV}, 'href="(/[^"]*)"', 1),
  lambda x: NOT contains(x, 'Special:') AND NOT contains(x, 'Talk:') AND NOT contains(x, 'File:')), lambda x: x[2:]))) AS target FROM ({PAGES}))""")
def html_links(spark, d):
    return pages(spark, d).select("id", F.explode(markup.links(F.col("html"), markup.ARTICLE)).alias("target"))


@query(f"""SELECT id, array_to_string(list_filter(list_transform(regexp_extract_all({NAV}, '<a href="[^"]*">([^<]*)</a>', 1), lambda c: trim(c)), lambda c: c <> ''), '|') AS categories FROM ({PAGES})""")
def html_categories(spark, d):
    return pages(spark, d).select("id", F.array_join(markup.categories(F.col("html"), markup.ARTICLE), "|").alias("categories"))


_MD = f"regexp_replace({BODY}, '<img\\b[^>]*/?>', '', 'g')"
for _a, _b in (("<h([234])\\b[^>]*>(.*?)</h[234]>", "\\2"), ("<b\\b[^>]*>(.*?)</b>", "**\\1**"), ("<br\\s*/?>", "\n"), ("<li\\b[^>]*>(.*?)</li>", "- \\1\n"), ("<p\\b[^>]*>(.*?)</p>", "\n\\1\n"), ("<[^>]+>", " ")):
    _MD = f"regexp_replace({_MD}, '(?s){_a}', '{_b}', 'g')"
for _a, _b in (("&#160;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''")):
    _MD = f"replace({_MD}, '{_a}', '{_b}')"
for _a, _b in (("&[a-z]+;", " "), ("\n{3,}", "\n\n"), ("[ \t]{2,}", " "), (" *\n *", "\n"), ("^\\s+|\\s+$", "")):
    _MD = f"regexp_replace({_MD}, '{_a}', '{_b}', 'g')"


@query(f"SELECT id, {_MD} AS markdown FROM ({PAGES})")
def html_to_markdown(spark, d):
    return pages(spark, d).select("id", markup.to_markdown(markup.body_html(F.col("html"), markup.ARTICLE)).alias("markdown"))


@query("""SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(replace(
  regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1), '&#160;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&[a-z]+;', ' ', 'g') AS decoded FROM pages""")
def entity_decode(spark, d):
    return table(spark, d, "pages").select("page_id", markup.decode_entities(F.regexp_extract("html", "(?s)<footer>(.*?)</footer>", 1)).alias("decoded"))


@query()
def entity_decode_all(spark, d):
    """The whole of each page."""
    return table(spark, d, "pages").select("page_id", markup.decode_entities(F.col("html")).alias("decoded"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)\\bSubcategories\\b') AND len(regexp_extract(text, '(?is)^(.*?)\\bSubcategories\\b', 1)) > 0.4 * len(text)
  THEN regexp_replace(regexp_extract(text, '(?is)^(.*?)\\bSubcategories\\b', 1), '^\\s+|\\s+$', '', 'g') ELSE text END AS cut FROM (SELECT doc_id, text || ' Subcategories ' || doc_id AS text FROM documents)""")
def nav_cut(spark, d):
    t = F.concat("text", F.lit(" Subcategories "), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select("doc_id", cleaning.cut_navigation(t).alias("cut"))


@query("SELECT doc_id, '(' || doc_id || ')/(' || n_chars || ') ≤ σ_' || doc_id || ' x' AS cleaned FROM documents")
def latex_clean(spark, d):
    t = F.format_string("\\frac{%d}{%d} \\leq \\sigma_{%d} \\mathrm{x}\\unknown", "doc_id", "n_chars", "doc_id")
    return table(spark, d, "documents").select("doc_id", cleaning.clean_text(t).alias("cleaned"))


_FS = "regexp_replace(left(text, 100), '(?s) [^ ]*$', '')"
_AT = lambda sep: f"instr(text, '{sep}') - 1"
_STRIP = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


@query(f"""SELECT doc_id, CASE WHEN text = '' THEN ''
  WHEN {_AT('. ')} > 10 AND {_AT('. ')} < 100 THEN {_STRIP(f"left(text, ({_AT('. ')} + 1)::BIGINT)")}
  WHEN instr(text, '.' || chr(10)) - 1 > 10 AND instr(text, '.' || chr(10)) - 1 < 100 THEN {_STRIP("left(text, instr(text, '.' || chr(10))::BIGINT)")}
  WHEN len(text) > 100 THEN {_FS} || '…' ELSE {_STRIP('text')} END AS summary FROM documents""")
def first_sentence(spark, d):
    return table(spark, d, "documents").select("doc_id", text.first_sentence(F.col("text")).alias("summary"))


_SPLIT = lambda x: f"string_split(regexp_replace({x}, '([.!])\\s+', '\\1' || chr(1), 'g'), chr(1))"


@query(f"SELECT * FROM (SELECT doc_id, left(list_filter(list_transform({_SPLIT('left(text, 300)')}, lambda s: {_STRIP('s')}), lambda s: len(s) > 10)[1], 120) AS ctx FROM documents) WHERE ctx IS NOT NULL")
def link_context(spark, d):
    return table(spark, d, "documents").select("doc_id", text.link_context(F.col("text")).alias("ctx")).where("ctx is not null")


_WARN = "(?i)" + "|".join(fixed.WARNING_WORDS)
_NOTED = "text || ' This is Important for item ' || doc_id || ', take care of it. It is not supported'"


@query(f"SELECT doc_id, array_to_string(list_distinct_ordered, '|') AS warnings FROM (SELECT doc_id, list_filter(list_transform({_SPLIT(_NOTED)}, lambda s: {_STRIP('s')}), lambda s: len(s) BETWEEN 30 AND 400 AND regexp_matches(s, '{_WARN}')) AS list_distinct_ordered FROM documents)")
def warnings_extract(spark, d):
    t = F.concat("text", F.lit(" This is Important for item "), F.col("doc_id").cast("string"), F.lit(", take care of it. It is not supported"))
    return table(spark, d, "documents").select("doc_id", F.array_join(facts.warning_sentences(t), "|").alias("warnings"))


@query("""SELECT p_partkey, 'PART_' || p_partkey AS tag, CASE p_size % 4 WHEN 0 THEN 'real' WHEN 1 THEN 'logical' WHEN 2 THEN 'integer enum' ELSE 'enum' END AS type,
  p_size::VARCHAR AS "default", 'The ' || p_name || ' part' AS definition, CASE WHEN p_size % 4 = 0 THEN 0 ELSE 2 END AS n_options FROM part""")
def param_facts(spark, d):
    size = F.col("p_size") % 4
    kind = F.when(size == 0, "[real]").when(size == 1, ".TRUE. | .FALSE.").when(size == 2, "1 | 2").otherwise("Fast | Slow")
    t = F.concat(F.lit("PART_"), F.col("p_partkey").cast("string"), F.lit(" = "), kind, F.lit(" Default: "), F.col("p_size").cast("string"), F.lit(" Description: The "), F.col("p_name"), F.lit(" part. More of it.\n--- body"))
    f = table(spark, d, "part").select("p_partkey", facts.facts(t).alias("f"))
    return f.select("p_partkey", "f.quick_facts.tag", "f.quick_facts.type", "f.quick_facts.default", "f.definition", F.coalesce(F.size("f.options"), F.lit(0)).alias("n_options"))


@query("SELECT id, translate(title, '<>:\"/\\|?*', '_________')[:100] AS file, coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(title), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'entry') AS slug FROM (SELECT 'D:' || doc_id AS id, " + HEAD + " AS title FROM documents)")
def slugify(spark, d):
    return corpus(spark, d).select("id", text.file_name(F.col("title")).alias("file"), text.slug(F.col("title")).alias("slug"))


_TERMS = f"list_slice(list_sort(list_distinct(list_filter(list_transform(list_filter(list_distinct(regexp_extract_all(lower(title || '  ' || left(content, 2000)), '[a-z]{{4,}}')), lambda w: {sql_stem('w', 1)} <> w), lambda w: {sql_stem('w', 1)}), lambda s: len(s) >= 4))), 1, 30)"


@query(f"WITH {CORPUS} SELECT id, array_to_string({_TERMS}, ' ') AS terms FROM corpus")
def index_terms(spark, d):
    return corpus(spark, d).select("id", F.array_join(terms.index_terms(F.col("title"), F.lit(""), F.col("content")), " ").alias("terms"))


@query(f"WITH {CORPUS}, t AS (SELECT id, {_TERMS} AS stems, [category, subtype] AS tags FROM corpus) SELECT id, array_to_string(CASE WHEN len(stems) = 0 THEN tags ELSE list_slice(tags || list_slice(list_filter(stems, lambda s: NOT list_contains(tags, s)), 1, 5), 1, 10) END, ',') AS tags FROM t")
def tag_merge(spark, d):
    c = corpus(spark, d)
    return c.select("id", F.array_join(terms.merge_tags(F.array("category", "subtype"), terms.index_terms(F.col("title"), F.lit(""), F.col("content"))), ",").alias("tags"))


@query(f"WITH {CORPUS}, {TOKENS} SELECT word, stem, {sql_stem('word', 1)} AS stem1 FROM vocab")
def stem_vocab(spark, d):
    w = search.positions(corpus(spark, d)).select("word").distinct()
    return w.select("word", terms.stem(F.col("word")).alias("stem"), terms.stem_once(F.col("word")).alias("stem1"))


@query(f"WITH {CORPUS}, {TOKENS} SELECT id, word, pos::INTEGER AS pos FROM tokens")
def tokenise_positions(spark, d):
    return search.positions(corpus(spark, d))


@query()
def expand_queries(spark, d):
    return asked(spark, d).select("qid", F.array_join(terms.expand(F.concat("query", F.lit(" magnetic k-point relaxation"))), "|").alias("terms"))


@query("SELECT page_id, regexp_replace(title, '\\[\\[([^\\]|]*\\|)?([^\\]]*)\\]\\]', '\\2', 'g') AS plain FROM (SELECT page_id, '[[a|' || page_id || ']] and [[b]]' AS title FROM pages)")
def wikilink_unwrap(spark, d):
    t = F.concat(F.lit("[[a|"), F.col("page_id").cast("string"), F.lit("]] and [[b]]"))
    return table(spark, d, "pages").select("page_id", text.unlink(t).alias("plain"))


@query("SELECT conv_id, turn, lower(trim(string_split(role || ':x', ':')[1])) AS entry_type, 'x' AS subtype, left('Title: ' || role || chr(10) || chr(10) || 'Content: ' || left(text, 600), 80) AS prompt FROM conversations")
def replies_and_prompts(spark, d):
    t = table(spark, d, "conversations").withColumn("r", text.split_reply(F.concat("role", F.lit(":x"))))
    return t.select("conv_id", "turn", "r.entry_type", "r.subtype", F.left(text.prompt(F.col("role"), F.col("text"), 600), F.lit(80)).alias("prompt"))


@query()
def prompts_all(spark, d):
    """Prompts with all that the limit of 600 characters leaves."""
    return table(spark, d, "conversations").select("conv_id", "turn", text.prompt(F.col("role"), F.col("text"), 600).alias("prompt"))


# -- classification ---------------------------------------------------------------------


@query("""SELECT p_partkey, name, CASE WHEN name LIKE 'Category\\_%' ESCAPE '\\' THEN 'domain' WHEN regexp_matches(name, '^[A-Z][A-Z_0-9]+$') AND len(name) < 50 THEN 'parameter'
  WHEN name LIKE 'How%' THEN 'tutorial' ELSE NULL END AS subtype FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Category_' || p_brand WHEN 1 THEN 'PART_' || p_partkey WHEN 2 THEN 'How_To_' || p_partkey ELSE lower(p_brand) END AS name FROM part)""")
def classify_name(spark, d):
    s, k = F.col("p_size") % 4, F.col("p_partkey").cast("string")
    name = F.when(s == 0, F.concat(F.lit("Category_"), "p_brand")).when(s == 1, F.concat(F.lit("PART_"), k)).when(s == 2, F.concat(F.lit("How_To_"), k)).otherwise(F.lower("p_brand"))
    return table(spark, d, "part").select("p_partkey", name.alias("name")).withColumn("subtype", classify.by_name(F.col("name")))


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'capability' WHEN 'AUTOMOBILE' THEN 'procedure' WHEN 'MACHINERY' THEN 'constraint' ELSE 'capability' END AS entry_type,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'parameter' WHEN 'AUTOMOBILE' THEN 'tutorial' WHEN 'MACHINERY' THEN 'pitfall' WHEN 'HOUSEHOLD' THEN 'domain' ELSE 'generic' END AS subtype FROM customer""")
def classify_page(spark, d):
    m = F.col("c_mktsegment")
    tag = F.when(m == "BUILDING", "INCAR tag").when(m == "AUTOMOBILE", "Howto").when(m == "MACHINERY", "Known issues").when(m == "HOUSEHOLD", "Theory").otherwise("other")
    kind = classify.by_page(F.lower("c_name"), F.array(tag))
    return table(spark, d, "customer").withColumn("k", kind).select("c_custkey", "k.entry_type", "k.subtype")


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN '' WHEN o_orderstatus = 'F' THEN 'pitfall' WHEN o_orderstatus = 'O' THEN 'parameter' ELSE 'generic' END AS subtype FROM orders""")
def subtype_infer(spark, d):
    s = F.col("o_orderstatus")
    e = F.when(s == "F", "constraint").when(s == "O", "capability").otherwise("memory")
    meta = F.when(F.col("o_orderpriority").startswith("1"), F.lit('{"custom":{"subtype":""}}')).otherwise(F.lit("{}"))
    return table(spark, d, "orders").select("o_orderkey", classify.from_store(e, F.lit("## Quick Facts"), meta).alias("subtype"))


@query("SELECT event_type, count(*) AS n FROM events WHERE NOT regexp_matches(event_type || '_x', '^(Special_|Talk_)') GROUP BY event_type")
def page_filters(spark, d):
    e = table(spark, d, "events").where(~classify.excluded(F.concat("event_type", F.lit("_x"))) & ~classify.empty_page(F.col("event_type")))
    return e.groupBy("event_type").agg(F.count("*").alias("n"))


# -- graph --------------------------------------------------------------------------------


def _page_graph(spark, d):
    parsed = build.parse(pages(spark, d), markup.ARTICLE)
    return build.nodes_of(parsed), build.edges_of(parsed)


@query(f"""WITH p AS (SELECT id, ord, list_filter(list_transform(regexp_extract_all({NAV}, '<a href="[^"]*">([^<]*)</a>', 1), lambda c: trim(c)), lambda c: c <> '') AS cats,
  list_distinct(list_transform(regexp_extract_all({NAV}, 'href="(/[^"]*)"', 1), lambda x: x[2:])) AS links FROM ({PAGES}))
  SELECT DISTINCT id AS source, 'Category_' || replace(c, ' ', '_') AS target, 'belongs_to' AS relation FROM (SELECT id, unnest(cats) AS c FROM p)
  UNION SELECT id, l, 'wikilink' FROM (SELECT id, unnest(links) AS l FROM p)""")
def build_edges(spark, d):
    return _page_graph(spark, d)[1].select("source", "target", "relation")


@query(f"""WITH p AS (SELECT id, ord, coalesce(nullif(trim({TITLE}), ''), id) AS title, len({BODY}) AS n FROM ({PAGES})),
  k AS (SELECT *, trim(regexp_replace(replace(regexp_replace(lower(trim(title)), '^category:\\s*', ''), '_', ' '), '\\s+', ' ', 'g')) AS key FROM p)
  SELECT key, arg_max(id, {{'a': n, 'b': -ord}}) AS id, count(*) AS n_merged FROM k GROUP BY key""")
def node_dedup(spark, d):
    p = pages(spark, d)
    n = p.select("id", "ord", markup.title(F.col("html"), F.col("id"), markup.ARTICLE).alias("title"), markup.body_html(F.col("html"), markup.ARTICLE).alias("content"))
    n = n.withColumn("tags", F.array().cast("array<string>")).withColumn("aliases", F.array().cast("array<string>"))
    kept = graph.dedup_nodes(n)
    return kept.select(graph.title_key(F.col("id"), F.col("title")).alias("key"), "id", "n_merged")


@query(f"""WITH {NODES}, {EDGES},
  k AS (SELECT *, CASE WHEN starts_with(id, 'Category_') THEN 'cat:' ELSE '' END || trim(regexp_replace(replace(lower(trim(title)), '_', ' '), '\\s+', ' ', 'g')) AS key FROM nodes),
  best AS (SELECT key, arg_max(id, {{'a': len(content), 'b': -ord}}) AS new_id FROM k GROUP BY key),
  m AS (SELECT id, new_id FROM k JOIN best USING (key))
  SELECT DISTINCT coalesce(s.new_id, e.source) AS source, coalesce(t.new_id, e.target) AS target, relation FROM edges e LEFT JOIN m s ON e.source = s.id LEFT JOIN m t ON e.target = t.id
  WHERE coalesce(s.new_id, e.source) <> coalesce(t.new_id, e.target)""")
def edge_remap(spark, d):
    return build.canonical(star_nodes(spark, d), star_edges(spark, d))[1].select("source", "target", "relation")


@query(f"{G} SELECT source, target, relation, min(ord) AS ord FROM (SELECT * FROM edges UNION ALL SELECT source, target, relation, ord + 1 FROM edges) GROUP BY ALL")
def edge_dedup(spark, d):
    e = star_edges(spark, d)
    return graph.dedup_edges(e.unionAll(e.withColumn("ord", F.col("ord") + 1))).select("source", "target", "relation", "ord")


@query(f"{G} SELECT source, target, relation, ord FROM inner_edges")
def internal_edges(spark, d):
    return graph.internal_edges(star_edges(spark, d), star_nodes(spark, d))


@query(f"{G} SELECT source, target, relation, ord FROM edges WHERE source NOT IN (SELECT id FROM nodes) OR target NOT IN (SELECT id FROM nodes)")
def dangling_edges(spark, d):
    return graph.dangling_edges(star_edges(spark, d), star_nodes(spark, d))


@query(f"{G}, {DEGREE.format('inner_edges')} SELECT id, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree, coalesce(degree, 0) AS degree FROM nodes LEFT JOIN deg USING (id)")
def degree(spark, d):
    n = star_nodes(spark, d)
    return graph.degrees(graph.internal_edges(star_edges(spark, d), n), n)


@query(f"{G}, {DEGREE.format('edges')} SELECT id, round(degree / max(degree) OVER (), 9) AS centrality FROM deg")
def degree_centrality(spark, d):
    return graph.centrality(star_edges(spark, d))


@query(f"{G}, {DEGREE.format('inner_edges')} SELECT id, title, subtype, out_degree, in_degree, degree FROM nodes JOIN deg USING (id) ORDER BY degree DESC, ord LIMIT 30")
def hubs_topk(spark, d):
    return graph.hubs(star_edges(spark, d), star_nodes(spark, d))


@query(f"{G} SELECT relation, count(*) AS n_edges, count(DISTINCT source) AS n_sources, count(DISTINCT target) AS n_targets FROM edges GROUP BY relation")
def relation_stats(spark, d):
    return graph.relation_stats(star_edges(spark, d))


for _end in ("source", "target"):

    def _tops(spark, d, end=_end):
        return graph.relation_tops(star_edges(spark, d), end)

    _tops.__name__ = f"relation_top_{_end}s"
    query(f"{G} SELECT * FROM (SELECT relation, {_end} AS id, count(*) AS n_edges, row_number() OVER (PARTITION BY relation ORDER BY count(*) DESC, min(ord), {_end})::INTEGER AS rank FROM edges GROUP BY relation, {_end}) WHERE rank <= 10")(_tops)


@query(f"{G} SELECT g.t AS source_type, " + ", ".join(f"count(*) FILTER (WHERE x.tt = '{s}') AS {s}" for s in fixed.SUBTYPES) + " FROM (SELECT unnest([" + ", ".join(f"'{s}'" for s in fixed.SUBTYPES) + "]) AS t) g LEFT JOIN (SELECT s.subtype AS st, t.subtype AS tt FROM edges e JOIN nodes s ON e.source = s.id JOIN nodes t ON e.target = t.id) x ON x.st = g.t GROUP BY g.t")
def type_matrix(spark, d):
    return graph.type_matrix(star_edges(spark, d), star_nodes(spark, d))


@query(f"{G} SELECT id, title, subtype FROM nodes WHERE id NOT IN (SELECT target FROM inner_edges)")
def orphans(spark, d):
    return graph.orphans(star_edges(spark, d), star_nodes(spark, d))


@query(f"{G} SELECT * FROM (SELECT target, source, count(*) AS n_links, row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, source)::INTEGER AS rank, count(*) OVER (PARTITION BY target) AS n_referrers FROM inner_edges GROUP BY target, source) WHERE rank <= 10")
def top_referrers(spark, d):
    return graph.referrers(star_edges(spark, d), star_nodes(spark, d))


@query(f"{G} SELECT * FROM (SELECT target, source, count(*) AS n_links, row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, min(ord), source)::INTEGER AS rank, count(*) OVER (PARTITION BY target) AS n_referrers FROM inner_edges GROUP BY target, source) WHERE rank <= 10")
def top_referrers_by_order(spark, d):
    return graph.referrers(star_edges(spark, d), star_nodes(spark, d), by_ord=True)


@query(f"{G} SELECT * FROM (SELECT source, target, arg_min(relation, ord) AS relation, min(ord) AS ord, row_number() OVER (PARTITION BY source ORDER BY min(ord))::INTEGER AS rank FROM edges GROUP BY source, target) WHERE rank <= 15")
def first_outgoing(spark, d):
    return graph.first_links(star_edges(spark, d), 15)


@query(f"{G} SELECT id, count(*) AS n_neighbors FROM (SELECT source AS id, target AS n FROM edges UNION SELECT target, source FROM edges) GROUP BY id")
def neighbor_sets(spark, d):
    return graph.neighbor_counts(star_edges(spark, d))


@query(f"{G} SELECT id FROM nodes WHERE subtype = 'domain' UNION SELECT target FROM edges WHERE source IN (SELECT id FROM nodes WHERE subtype = 'domain') UNION SELECT source FROM edges WHERE target IN (SELECT id FROM nodes WHERE subtype = 'domain')")
def one_hop_closure(spark, d):
    return graph.closure(star_edges(spark, d), star_nodes(spark, d).where("subtype = 'domain'"))


@query(f"""{G}, m AS (SELECT id, CASE WHEN lower(id) = 'asia' OR lower(title) = 'asia' THEN 1 WHEN list_contains(string_split(lower(id), '_'), 'asia') OR list_contains(string_split(lower(replace(title, ' ', '_')), '_'), 'asia') THEN 2
  WHEN contains(lower(content), 'asia') THEN 3 END AS tier FROM nodes) SELECT id, tier FROM m WHERE tier = (SELECT min(tier) FROM m) AND (tier < 3 OR (SELECT count(*) FROM m WHERE tier = 3) <= 10)""")
def tiered_match(spark, d):
    return graph.tiered_match(star_nodes(spark, d), "asia")


@query(f"""WITH RECURSIVE {NODES}, {EDGES}, step AS (SELECT DISTINCT source, target FROM edges),
  reach(id, level) AS (SELECT id, 0 FROM nodes WHERE subtype = 'domain' UNION SELECT target, level + 1 FROM reach JOIN step ON reach.id = step.source WHERE level < 6)
  SELECT id, min(level)::INTEGER AS level FROM reach GROUP BY id""")
def bfs_levels(spark, d):
    return iterative.bfs_levels(star_edges(spark, d), star_nodes(spark, d).where("subtype = 'domain'"), depth=6)


def _pagerank_sql(edges: str, rounds: int) -> str:
    out = f"""e AS (SELECT DISTINCT source, target FROM {edges}), v AS (SELECT source AS id FROM e UNION SELECT target FROM e), nv AS (SELECT count(*)::DOUBLE AS n FROM v),
  fan AS (SELECT source, count(*) AS k FROM e GROUP BY source), r0 AS (SELECT id, 1 / n AS s FROM v, nv)"""
    for i in range(rounds):
        out += f""",
  l{i} AS MATERIALIZED (SELECT coalesce(sum(s), 0) AS lost FROM r{i} WHERE id NOT IN (SELECT source FROM fan)),
  g{i} AS MATERIALIZED (SELECT e.target AS id, sum(s / k) AS got FROM e JOIN r{i} ON e.source = r{i}.id JOIN fan USING (source) GROUP BY e.target),
  r{i + 1} AS MATERIALIZED (SELECT v.id, 0.15 / n + 0.85 * lost / n + 0.85 * coalesce(got, 0) AS s FROM v LEFT JOIN g{i} USING (id), l{i}, nv)"""
    return out


@query(f"WITH {NODES}, {EDGES}, {_pagerank_sql('edges', 10)} SELECT id, round(s / max(s) OVER (), 9) AS score FROM r10")
def pagerank_10(spark, d):
    r = iterative.pagerank(star_edges(spark, d), rounds=10, tolerance=None)
    return r.select("id", F.round("score", 9).alias("score"))


@query(f"{G}, p AS (SELECT id FROM nodes WHERE subtype IN ('domain', 'tutorial')), x AS (SELECT source AS id, count(*) FILTER (WHERE relation = 'contains') AS a, count(*) FILTER (WHERE relation <> 'contains') AS b FROM edges WHERE source IN (SELECT id FROM p) AND target IN (SELECT id FROM p) GROUP BY source) SELECT id, a - 2 * b AS score FROM x WHERE a > 0 ORDER BY score DESC, id DESC LIMIT 5")
def seed_scores(spark, d):
    return graph.seed_scores(star_edges(spark, d), star_nodes(spark, d).where("subtype in ('domain', 'tutorial')"))


@query(f"""{G}, {DEGREE.format('inner_edges')}, dg AS (SELECT id, ord, coalesce(degree, 0) AS degree FROM nodes LEFT JOIN deg USING (id)),
  top AS (SELECT id FROM dg ORDER BY degree DESC, ord LIMIT 100),
  pr AS (SELECT source AS id, target AS nb FROM inner_edges WHERE relation <> 'wikilink' UNION SELECT target, source FROM inner_edges WHERE relation <> 'wikilink'),
  alone AS (SELECT id FROM pr WHERE id IN (SELECT id FROM top) GROUP BY id HAVING count(*) FILTER (WHERE nb IN (SELECT id FROM top)) = 0),
  best AS (SELECT pr.id, arg_max(nb, {{'d': d.degree, 'n': nb}}) AS nb, max(d.degree) AS degree FROM pr JOIN dg d ON pr.nb = d.id WHERE pr.id IN (SELECT id FROM alone) GROUP BY pr.id),
  extra AS (SELECT nb FROM best GROUP BY nb ORDER BY max(degree) DESC, nb LIMIT 3)
  SELECT id, false AS added FROM top UNION ALL SELECT nb, true FROM extra""")
def graph_top_n_repair(spark, d):
    return graph.repaired_top(star_edges(spark, d), star_nodes(spark, d), 100)


@query(f"{G} SELECT subtype, count(*) AS n FROM nodes GROUP BY subtype")
def count_by_subtype(spark, d):
    return graph.count_by(star_nodes(spark, d), "subtype")


# -- search -------------------------------------------------------------------------------


@query(f"WITH {CORPUS}, {TOKENS} SELECT stem, df, round(idf, 9) AS idf FROM stems")
def term_stats(spark, d):
    return search.build(corpus(spark, d)).stems.select("stem", "df", F.round("idf", 9).alias("idf"))


@query(f"WITH {CORPUS}, {TOKENS} SELECT id, length::INTEGER AS length, round(avgdl, 9) AS avgdl FROM lengths, stats")
def doc_stats(spark, d):
    i = search.build(corpus(spark, d))
    return i.docs.select("id", "length").crossJoin(F.broadcast(i.corpus.select(F.round("avgdl", 9).alias("avgdl"))))  # one row


@query(f"WITH {CORPUS}, {TOKENS} SELECT stem, id, tf, array_to_string(positions, ' ') AS positions FROM postings")
def postings(spark, d):
    return search.build(corpus(spark, d)).postings.select("stem", "id", "tf", F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"))


@query(f"WITH {CORPUS}, {TOKENS}, {ASKED}, {BM25} SELECT qid, id, round(score, 6) AS score, n_near, rank FROM ranked WHERE rank <= 200")
def bm25_topk(spark, d):
    return search.bm25(search.build(corpus(spark, d), iterative.stored), asked(spark, d)).select("qid", "id", F.round("score", 6).alias("score"), "n_near", "rank")


@query(f"WITH {CORPUS}, {TOKENS}, u AS (SELECT DISTINCT word || 'q' AS word FROM raw_vocab WHERE len(word) BETWEEN 5 AND 6), odd AS (SELECT word FROM u WHERE word NOT IN (SELECT word FROM raw_vocab) AND word NOT IN (SELECT stem FROM stems)), m AS (SELECT o.word, min({{'d': levenshtein(o.word, v.word), 'c': v.word}}) AS m FROM odd o JOIN raw_vocab v ON left(o.word, 2) = left(v.word, 2) AND abs(len(o.word) - len(v.word)) <= 3 WHERE levenshtein(o.word, v.word) <= 2 GROUP BY o.word) SELECT word, m.c AS correction, m.d::INTEGER AS distance FROM m")
def spell_correct(spark, d):
    i = search.build(corpus(spark, d), iterative.stored)
    odd = i.vocabulary.where("length(word) between 5 and 6").select(F.concat("word", F.lit("q")).alias("word"))
    return search.corrections(i, odd)


@query()
def spell_correct_all(spark, d):
    """Misspellings of the whole vocabulary."""
    i = search.build(corpus(spark, d), iterative.stored)
    return search.corrections(i, i.vocabulary.select(F.concat("word", F.lit("q")).alias("word")))


def _index(spark, d):
    n = corpus(spark, d)
    e = doc_edges(n)
    return search.build(n, iterative.stored), graph.neighbor_pairs(e), iterative.pagerank(iterative.stored(e), rounds=10, tolerance=None)


@query()
def fused_scores(spark, d):
    return search.fused(search.build(corpus(spark, d), iterative.stored), asked(spark, d), keep=iterative.stored).drop("ord")


@query(f"WITH {CORPUS}, {TOKENS}, {ASKED}, {BM25}, {DOC_EDGES}, hot AS (SELECT qid, id FROM ranked WHERE rank <= 40), np AS (SELECT source AS id, target AS nb FROM doc_edges UNION SELECT target, source FROM doc_edges), s AS (SELECT qid, id FROM ranked WHERE rank <= 200) SELECT s.qid, s.id, count(*) AS votes FROM s JOIN np USING (id) JOIN hot ON hot.qid = s.qid AND hot.id = np.nb GROUP BY s.qid, s.id")
def neighbor_vote(spark, d):
    n = corpus(spark, d)
    s = search.bm25(search.build(n, iterative.stored), asked(spark, d)).drop("rank")
    return search.neighbor_votes(s, graph.neighbor_pairs(doc_edges(n)))


@query()
def rerank_topk(spark, d):
    i, pairs, ranks = _index(spark, d)
    return search.search(i, asked(spark, d), pairs, ranks)


@query()
def subtype_filtered_search(spark, d):
    i, pairs, ranks = _index(spark, d)
    return search.search(i, asked(spark, d), pairs, ranks, subtype="tutorial")


@query(f"WITH {CORPUS}, {DOC_EDGES}, {_pagerank_sql('doc_edges', 10)} SELECT row_number() OVER (ORDER BY pr DESC, ord)::INTEGER AS rank, id, title, subtype, pr AS score FROM (SELECT c.*, round(coalesce(s / (SELECT max(s) FROM r10), 0), 6) AS pr FROM corpus c LEFT JOIN r10 USING (id)) ORDER BY pr DESC, ord LIMIT 10")
def fallback_topk(spark, d):
    n = corpus(spark, d).drop("content")
    ranks = iterative.pagerank(doc_edges(n), rounds=10, tolerance=None)
    return search.fallback(n, ranks.withColumn("score", F.round("score", 6)))


@query(f"""WITH {CORPUS}, {TOKENS}, {ASKED}, {BM25}, want AS (SELECT DISTINCT b.item_id::VARCHAR AS qid, c.title FROM benchmark b JOIN documents d ON contains(d.text, left(b.text, 60)) JOIN corpus c ON c.ord = d.doc_id),
  hit AS (SELECT r.qid, count(*) AS hits FROM ranked r JOIN corpus c USING (id) WHERE r.rank <= 5 AND (r.qid, c.title) IN (SELECT qid, title FROM want) GROUP BY r.qid)
  SELECT w.qid, coalesce(hits, 0) AS hits, coalesce(hits, 0) / 5 AS precision FROM (SELECT DISTINCT qid FROM want) w LEFT JOIN hit USING (qid)""")
def precision_at_k(spark, d):
    n = corpus(spark, d)
    i = search.build(n, iterative.stored)
    r = search.bm25(i, asked(spark, d), limit=5).join(i.docs.select("id", "title"), "id")
    return search.precision(r, golden(spark, d, n))


@query()
def sweep_best(spark, d):
    """One-at-a-time sweep of k1, b and window over the golden set."""
    n = corpus(spark, d)
    index = search.build(n, iterative.stored)
    runs = [search.scan.Run(*x) for x in [(1.5, 0.75, 30), (1.2, 0.75, 30), (2.0, 0.75, 30), (1.5, 0.5, 30), (1.5, 0.9, 30), (1.5, 0.75, 10), (1.5, 0.75, 50)]]
    want = iterative.stored(golden(spark, d, n))
    found = iterative.stored(search.bm25_runs(index, asked(spark, d), runs, limit=5).join(index.docs.select("id", "title"), "id"))
    every = None
    for i, r in enumerate(runs):
        p = search.precision(found.where(F.col("run") == i), want).select(F.lit(f"k1={r.k1} b={r.b} window={r.window}").alias("config"), F.lit(i).alias("ord"), "qid", "precision")
        every = p if every is None else every.unionAll(p)
    return search.best_of(every)


# -- publishing -----------------------------------------------------------------------------


@query(f"""{G}, one AS (SELECT source, target, arg_min(relation, ord) AS relation, min(ord) AS ord FROM inner_edges GROUP BY source, target),
  links AS (SELECT source AS id, string_agg('- [[' || target || '|' || n.title || ']] (' || relation || ')', chr(10) ORDER BY one.ord) AS links FROM one JOIN nodes n ON one.target = n.id GROUP BY source),
  rf AS (SELECT target, source, count(*) AS k, row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, source) AS rank, count(*) OVER (PARTITION BY target) AS n FROM inner_edges GROUP BY target, source),
  refs AS (SELECT target AS id, string_agg('- [[' || source || ']] ×' || k, chr(10) ORDER BY rank) || CASE WHEN max(n) > 10 THEN chr(10) || '- … and ' || (max(n) - 10) || ' more' ELSE '' END AS refs FROM rf WHERE rank <= 10 GROUP BY target)
  SELECT id, translate(id, '<>:"/\\|?*', '_________') || '.md' AS file, '---' || chr(10) || 'id: ' || id || chr(10) || 'title: ' || title || chr(10) || 'type: ' || subtype || chr(10) || 'tags: [' || category || ']' || chr(10) || '---' || chr(10) || chr(10) || '# ' || title || chr(10) || chr(10)
   || '**' || CASE subtype WHEN 'best_practice' THEN 'Best Practice' ELSE upper(subtype[1]) || subtype[2:] END || '**' || CASE WHEN content <> '' THEN chr(10) || chr(10) || '## Content' || chr(10) || chr(10) || content ELSE '' END
   || coalesce(chr(10) || chr(10) || '## Links' || chr(10) || chr(10) || links, '') || coalesce(chr(10) || chr(10) || '## Referenced by' || chr(10) || chr(10) || refs, '') AS markdown
  FROM nodes LEFT JOIN links USING (id) LEFT JOIN refs USING (id)""")
def page_markdown(spark, d):
    return publish.pages_markdown(star_nodes(spark, d), star_edges(spark, d))


@query(f"{G} SELECT category, subtype, count(*) AS n, string_agg('- ' || title || ': ' || content, chr(10) ORDER BY title, ord, content) AS listing FROM nodes GROUP BY category, subtype")
def category_index(spark, d):
    return publish.category_index(star_nodes(spark, d))


@query(f"{G} SELECT list_position([" + ", ".join(f"'{s}'" for s in fixed.SUBTYPES) + "], subtype)::INTEGER - 1 AS rank, subtype, category, count(*) AS n, string_agg(title, '; ' ORDER BY lower(title), ord) AS titles FROM nodes GROUP BY subtype, category")
def master_index(spark, d):
    return publish.master_index(star_nodes(spark, d))


@query(f"{G} SELECT category, count(*) AS n, string_agg(id, ' ' ORDER BY id) AS ids FROM nodes GROUP BY category")
def group_lists(spark, d):
    return graph.lists_by(star_nodes(spark, d), "category")


@query(f"{G} SELECT count(*) AS total_nodes, " + ", ".join(f"count(*) FILTER (WHERE subtype = '{s}') AS n_{s}" for s in fixed.SUBTYPES) + ", (SELECT count(*) FROM edges) AS total_edges FROM nodes")
def json_kb_meta(spark, d):
    return publish.kb_meta(star_nodes(spark, d), star_edges(spark, d))


@query(f"{G} SELECT source, target, relation, n.title, n.subtype, '' AS context FROM inner_edges e JOIN nodes n ON e.target = n.id")
def json_kb_links(spark, d):
    return publish.kb_links(star_nodes(spark, d), star_edges(spark, d))


@query()
def json_kb_pages(spark, d):
    return publish.kb_pages(star_nodes(spark, d), star_edges(spark, d))


@query(f"WITH {CORPUS} SELECT id, left(title, 50) AS label, CASE subtype " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in publish.NODE_COLOURS.items()) + " END AS colour, left(content, 2000) AS content, category AS tags FROM corpus")
def vis_nodes(spark, d):
    return publish.vis_nodes(corpus(spark, d).withColumn("tags", F.array("category")))


@query(f"{G} SELECT DISTINCT source, target, relation, CASE relation " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in publish.EDGE_COLOURS.items()) + " END AS colour, relation <> 'wikilink' AS arrow FROM inner_edges WHERE relation <> 'wikilink'")
def vis_edges(spark, d):
    return publish.vis_edges(star_edges(spark, d), star_nodes(spark, d), structural=True)


@query(f"""WITH {CORPUS}, t AS (SELECT id, ord, title, {_TERMS} AS stems, category, replace(content, '\\', '') AS content,
  coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(title), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'entry') AS s FROM corpus)
  SELECT id, title, CASE WHEN row_number() OVER (PARTITION BY s ORDER BY ord) > 1 THEN s || '-' || ord ELSE s END AS slug, 'capability' AS entry_type,
   array_to_string(CASE WHEN len(stems) = 0 THEN [category] ELSE list_slice([category] || list_slice(list_filter(stems, lambda x: x <> category), 1, 5), 1, 10) END, ',') AS tags, array_to_string(stems, ' ') AS stems, content FROM t""")
def store_entries(spark, d):
    n = corpus(spark, d).withColumn("tags", F.array("category")).withColumn("entry_type", F.lit("capability"))
    return publish.store_entries(n)


@query(f"{G} SELECT source, target, CASE WHEN relation IN ('contains', 'has_subcategory') THEN 'decomposes_to' ELSE 'wikilink' END AS relation, 1.0::DOUBLE AS weight FROM inner_edges")
def store_edges(spark, d):
    return publish.store_edges(star_edges(spark, d), star_nodes(spark, d))


@query("""WITH r AS (SELECT DISTINCT c_mktsegment AS name FROM customer UNION SELECT n_name FROM nation UNION SELECT 'an'), s AS (SELECT name, string_agg(n, ',' ORDER BY n) AS sug FROM (SELECT r.name, r_name AS n, row_number() OVER (PARTITION BY r.name ORDER BY r_name) AS k FROM r JOIN region ON contains(lower(r_name), lower(r.name)) WHERE r.name NOT IN (SELECT r_name FROM region) AND r.name NOT IN (SELECT n_name FROM nation)) WHERE k <= 5 GROUP BY name)
  SELECT name, CASE WHEN name IN (SELECT r_name FROM region) THEN 'kb' WHEN name IN (SELECT n_name FROM nation) THEN 'wiki' ELSE 'not_found' END AS source,
  CASE WHEN name IN (SELECT r_name FROM region) OR name IN (SELECT n_name FROM nation) THEN name END AS title, coalesce(sug, '') AS suggestions FROM r LEFT JOIN s USING (name)""")
def lookup_pages(spark, d):
    t = lambda n, c: table(spark, d, n).select(F.col(c).alias("name"))
    requests = t("customer", "c_mktsegment").union(t("nation", "n_name")).union(spark.range(1).select(F.lit("an")))
    named = lambda df: df.select(F.col("name").alias("id"), F.col("name").alias("title"))
    return publish.lookup_pages(requests, named(t("region", "r_name")), named(t("nation", "n_name")))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_candidates(spark, d):
    n = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", F.lit("generic").alias("subtype"))
    return build.candidates(n, table(spark, d, "labels").select(F.col("doc_id").alias("id"))).select(F.col("id").alias("doc_id"), "lang")


@query("SELECT doc_id, CASE WHEN quality IS NULL THEN 'generic' WHEN quality = 1 THEN 'domain' ELSE 'pitfall' END AS subtype, quality IS NOT NULL AS llm_classified FROM documents LEFT JOIN labels USING (doc_id)")
def apply_labels(spark, d):
    n = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("generic").alias("entry_type"), F.lit("generic").alias("subtype"))
    c = table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.lit("capability").alias("entry_type"), F.when(F.col("quality") == 1, "domain").otherwise("pitfall").alias("subtype"))
    return build.apply_classes(n, c).select(F.col("id").alias("doc_id"), "subtype", "llm_classified")


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    return ingest.event_counts(table(spark, d, "events"))
