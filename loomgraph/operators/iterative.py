"""Graph algorithms that iterate: breadth-first levels and PageRank.

Each round is a declarative plan; its result is checkpointed to the folder that
executors share, so the lineage stays short and a lost executor costs a re-read.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` or of the session; a temporary one only in a local process."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="loom-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read from reliable storage from now on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, so that later reads skip columns and row groups."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bfs_levels(edges: DataFrame, seeds: DataFrame, depth: int | None = None) -> DataFrame:
    """``id, level`` of all that is reachable from ``seeds(id)`` along edges."""
    step = edges.select(F.col("source").alias("id"), "target").distinct()
    step = stored(step)
    frontier = seen = stored(seeds.select("id").distinct().withColumn("level", F.lit(0)))
    level = 0
    while depth is None or level < depth:
        level += 1
        fresh = frontier.join(step, "id").select(F.col("target").alias("id")).distinct().join(seen, "id", "left_anti")
        frontier = stored(fresh.withColumn("level", F.lit(level)))  # each level is written once; what has been seen is their union
        if frontier.isEmpty():
            break
        seen = seen.unionAll(frontier)
    return seen


#: Bytes of the input's files for one task of a join or aggregate; tables of less than ``SMALL`` are left to Spark. For
#: more than ``FEW`` tasks shares are up to ``MORE`` times as large: tasks that write for more than these sort what they write.
SHARE, SMALL, FEW, MORE = 4 << 20, 32 << 20, 200, 4


def dealt(df: DataFrame, *columns: str, like: DataFrame | None = None) -> DataFrame:
    """``df`` dealt by ``columns`` to as many tasks as its input (or that of ``like``) has shares, so that what one task
    holds does not grow with the input. Left to itself, Spark joins partitions up to some size on disk, of which
    rows of short strings take many times as much in memory."""
    leaves = (df if like is None else like)._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(x for x in sizes if x < 1 << 50)  # more stands for unknown
    if size < SMALL:
        return df
    return df.repartition(max(min(size // SHARE, FEW), size // (SHARE * MORE), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))), *columns)


def _numbered(edges: DataFrame) -> tuple[DataFrame, int, int]:
    """``id, v`` of all ends of edges, with a hash that no two of them share; their count and the hash's seed."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id"))
    ids, n, seed = stored(dealt(ends, "id", like=edges).distinct()), None, 0
    while True:
        v = F.when(F.col("id").isNotNull(), F.xxhash64("id", F.lit(seed)))
        named = ids.select("id", v.alias("v"))
        n = ids.count() if n is None else n
        if named.select(F.coalesce("v", F.lit(seed))).distinct().count() == n:
            return named, n, seed
        seed += 1


def pagerank(edges: DataFrame, alpha: float = 0.85, rounds: int = 100, tolerance: float | None = 1e-6, normalise: bool = True) -> DataFrame:
    """``id, score`` over the simple digraph of ``edges``: parallel relations count once.

    What sinks hold is spread evenly. Stops after ``rounds``, or before when scores
    move by less than ``tolerance`` a vertex in all. ``normalise`` divides by the top.

    Rounds go over hashes of the ids. How much the sinks hold follows from how many of
    its edges lead from each vertex to sinks, so without a ``tolerance`` their
    scores are worked out in the last round only.
    """
    ids, n, seed = _numbered(edges)
    if not n:
        return ids.select("id", F.lit(0.0).alias("score"))
    number = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(c, F.lit(seed)))
    e = stored(dealt(edges.select(number("source").alias("s"), number("target").alias("t")), "s", "t", like=edges).distinct())
    goes_on = e.select(F.col("s").alias("t")).distinct().withColumn("on", F.lit(True))
    e = stored(e.join(goes_on, "t", "left").select("s", "t", F.col("on").isNotNull().alias("on")))
    fan = e.where("s is not null").groupBy(F.col("s").alias("v")).agg(F.count("*").alias("fan"), F.count_if(~F.col("on") & F.col("t").isNotNull()).alias("n_sinks"))
    if tolerance is not None:
        fan = ids.where("v is not null").select("v").join(fan, "v", "left")
    # the ends of a vertex's edges in a few rows: what moves in each round is hardly more than they
    ends = stored(e.where("s is not null").groupBy("s", F.pmod("t", F.lit(16)).alias("part"), "on").agg(F.collect_list("t").alias("ts")).select(F.col("s").alias("v"), "ts", "on"))
    n_sinks = ids.where("v is not null").join(goes_on.select(F.col("t").alias("v")), "v", "left_anti").count()
    rank = stored(fan.withColumn("score", F.lit(1.0 / n)))
    lost = n_sinks / n

    def gathered(state: DataFrame, links: DataFrame) -> DataFrame:
        share = state.where("fan is not null").select("v", (F.col("score") / F.col("fan")).alias("share"))
        return links.join(share, "v").select(F.explode("ts").alias("v"), "share").groupBy("v").agg(F.sum("share").alias("got"))

    steps = rounds if tolerance is not None else max(0, rounds - 1)
    for _ in range(steps):
        base = (1 - alpha) / n + alpha * lost / n
        got = gathered(rank, ends if tolerance is not None else ends.where("on"))
        fresh = rank.join(got, "v", "left").select("v", "fan", "n_sinks", (F.lit(base) + alpha * F.coalesce("got", F.lit(0.0))).alias("score"), F.col("score").alias("before"))
        out = F.coalesce(F.sum(F.col("before") / F.col("fan") * F.col("n_sinks")), F.lit(0.0))
        fresh = stored(fresh)
        to_sinks, moved = fresh.agg(out, F.sum(F.abs(F.col("score") - F.col("before")))).first()
        lost = n_sinks * base + alpha * to_sinks
        rank = fresh.drop("before")
        if tolerance is not None and moved < n * tolerance:
            break
    if tolerance is not None:
        rank = ids.join(rank.select("v", "score"), "v", "left").select("id", F.coalesce("score", F.lit((1 - alpha) / n + alpha * lost / n)).alias("score"))
    elif rounds:
        base = (1 - alpha) / n + alpha * lost / n
        rank = ids.join(gathered(rank, ends), "v", "left").select("id", (F.lit(base) + alpha * F.coalesce("got", F.lit(0.0))).alias("score"))
    else:
        rank = ids.select("id", F.lit(1.0 / n).alias("score"))
    if not normalise:
        return rank
    rank = stored(rank)
    top = rank.agg(F.max("score")).first()[0]
    return rank.select("id", (F.col("score") / top).alias("score"))
