"""Operator 3: mixing sources to target weights by Poisson replication.

The target repetition rate of a source is its target share of the budget over
its own mass. Every document draws its number of copies from a Poisson
distribution with that mean, by inverting the distribution function at a uniform
number hashed from the seed, the doc_id and the text; documents are exploded by
their counts and shuffled globally by a hashed key. All is DataFrame code:
counts need no state, so a lost task is repeated with the same outcome, and a
hot source is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm._shared import Stash, documents, partitions

SEED = "mix-1"
#: Default targets: shares in proportion to a source's mass to this power.
TEMPERATURE = 0.7


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", text: str = "text", temperature: float = TEMPERATURE, budget: float = 1.0) -> DataFrame:
    """``source_key, no_source, rate, cdf``: one row for each source.

    Mass is characters plus one for each document. Without ``weights`` the
    target shares are mass to the power ``temperature``; sources that ``weights``
    does not name get none. ``budget`` is the mass of the mixture over that of
    the input. ``cdf`` holds P(copies <= k) for k = 0, 1, ... until it is flat.
    """
    mass = F.sum(F.coalesce(F.length(text), F.lit(0)).cast("long") + 1)
    s = docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source_key"), F.col(source).isNull().alias("no_source")).agg(mass.alias("mass"))
    if weights is None:
        s = s.withColumn("weight", F.pow(F.col("mass").cast("double"), F.lit(temperature)))
    else:
        table = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))]) if weights else None
        s = s.withColumn("weight", F.when(F.col("no_source") | F.lit(table is None), F.lit(0.0)).otherwise(F.coalesce(F.element_at(table, F.col("source_key")) if table is not None else F.lit(0.0), F.lit(0.0))))
    total = s.agg(F.sum("mass").cast("double").alias("all_mass"), F.sum("weight").alias("all_weight"))
    s = s.crossJoin(F.broadcast(total))  # one row
    # a rounded rate, so that the order of summation does not matter
    rate = F.round(F.lit(float(budget)) * F.col("weight") * F.col("all_mass") / (F.col("all_weight") * F.col("mass")), 9)
    s = s.withColumn("rate", F.when(F.col("all_weight") > 0, rate).otherwise(F.lit(0.0)))
    return s.select("source_key", "no_source", "rate", distribution(F.col("rate")).alias("cdf"))


def distribution(rate: Column) -> Column:
    """Poisson distribution function at 0, 1, ... ; log-space, so that large means do not underflow."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    zero = F.struct((-rate).alias("l"), F.array(F.exp(-rate)).alias("c"))

    def step(acc, k):
        lg = acc["l"] + F.log(rate / k)
        return F.struct(lg.alias("l"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + F.exp(lg))).alias("c"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), zero, step)["c"]).otherwise(F.array(F.lit(1.0)))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED, doc_id: str = "doc_id", source: str = "source", text: str = "text", temperature: float = TEMPERATURE, budget: float = 1.0, extras: bool = False) -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, in a global random order.

    A null source is a source of its own; null text has the mass of an empty
    one. Rows that repeat one another get equal counts, for the draw depends on
    doc_id and text only; a null doc_id draws by its text. With ``extras`` the
    columns ``copy`` (from 1) and ``shuffle_key`` follow, and clashing columns of
    ``docs`` give way. An empty table gives no rows.
    """
    spark = docs.sparkSession
    # the rates are written first, so that their known size decides how they are joined
    table = Stash(spark, "mixing").put(rates(docs, weights, source, text, temperature, budget), "rates")
    own = [c for c in docs.columns if not extras or c not in ("copy", "shuffle_key")]
    d = docs.select(F.struct(*own).alias("row"))
    at = lambda c: F.col("row").getField(c)
    name = F.concat_ws(":", F.lit(seed), F.coalesce(at(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(at(text).cast("string"), F.lit("")).cast("binary")))
    d = d.select("row", F.coalesce(at(source).cast("string"), F.lit("")).alias("source_key"), at(source).isNull().alias("no_source"), name.alias("name"))
    d = d.join(table, ["source_key", "no_source"]).withColumn("u", uniform(F.lit("count"), F.col("name")))
    n = F.size(F.filter("cdf", lambda c: c <= F.col("u")))
    d = d.withColumn("n", n).where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    d = d.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit("order"), "name", F.col("copy").cast("string"))))
    p = partitions(spark)
    d = d.repartition(p, "shuffle_key").sortWithinPartitions("shuffle_key", "copy")
    return d.select("row.*", *(["copy", "shuffle_key"] if extras else []))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated to tempered source shares, with their texts, in a random order."""
    return mix(documents(spark, sf_dir), extras=True)


ORACLE = f"""
WITH RECURSIVE s AS (
  SELECT coalesce(source, '') AS source_key, source IS NULL AS no_source,
         sum(coalesce(length(text), 0) + 1) AS mass
  FROM documents GROUP BY ALL
), t AS (
  SELECT *, pow(mass::DOUBLE, {TEMPERATURE}) AS weight FROM s
), r AS (
  SELECT source_key, no_source,
         round(1.0 * weight * (sum(mass) OVER ())::DOUBLE / ((sum(weight) OVER ()) * mass), 9) AS rate
  FROM t
), u AS (
  SELECT d.*, r.rate,
         '{SEED}:' || coalesce(d.doc_id::VARCHAR, '') || ':' || md5(coalesce(d.text, '')) AS name
  FROM documents d JOIN r ON coalesce(d.source, '') = r.source_key AND (d.source IS NULL) = r.no_source
), v AS (
  SELECT *, ('0x' || substr(md5('count:' || name), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS x FROM u
), cdf(source_key, no_source, rate, k, l, c) AS (
  SELECT source_key, no_source, rate, 0, -rate, exp(-rate) FROM r
  UNION ALL
  SELECT source_key, no_source, rate, k + 1, l + ln(rate / (k + 1)), c + exp(l + ln(rate / (k + 1)))
  FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate) + 40)
), counted AS (
  SELECT v.doc_id, v.text, v.lang, v.source, v.n_chars, v.name, count(*) FILTER (WHERE cdf.c <= v.x) AS n
  FROM v JOIN cdf ON coalesce(v.source, '') = cdf.source_key AND (v.source IS NULL) = cdf.no_source
  GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
       md5('order:' || name || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted WHERE n > 0)
"""
