"""Incremental ingest: a landing folder of pages, parsed by the stateless batch transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomgraph.functions import markup
from loomgraph.plans import build


def page_stream(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    """Pages that land in ``folder`` as Parquet with columns id, html, ord."""
    return spark.readStream.schema("id string, html string, ord long").option("maxFilesPerTrigger", per_trigger).parquet(folder)


def ingest(pages: DataFrame, out: str, checkpoint: str, profile: markup.HtmlProfile = markup.MEDIAWIKI, once: bool = True) -> StreamingQuery:
    """Appends nodes and edges of each batch under ``out``, tagged with the batch; a batch that
    is repeated after a failure overwrites its own part, so none counts twice."""

    def write(batch: DataFrame, n: int) -> None:
        parsed = build.parse(batch, profile).persist()
        build.nodes_of(parsed).write.mode("overwrite").parquet(f"{out}/nodes/batch={n}")
        build.edges_of(parsed).write.mode("overwrite").parquet(f"{out}/edges/batch={n}")
        parsed.unpersist()

    w = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def latest(spark: SparkSession, out: str) -> DataFrame:
    """Nodes of all batches, the latest version of each."""
    n = spark.read.parquet(f"{out}/nodes")
    newest = n.groupBy("id").agg(F.max("batch").alias("batch"))
    return n.join(newest, ["id", "batch"]).drop("batch")


def event_counts(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and sums of events by window and type; batch or stream, late rows dropped after ``late``."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    g = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
