"""Sinks: JSON arrays, Markdown files, the single-file knowledge base, the graph view, stores."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.plans import publish
from loomgraph.sources.pages import SqliteSource


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line; distributed."""
    df.write.mode("overwrite").json(path)


def json_text(df: DataFrame, sort: str = "ord") -> str:
    """A small table as one JSON array, in order; for files of the reference's form."""
    rows = df.orderBy(sort).select(F.to_json(F.struct(*df.columns)).alias("j")).toLocalIterator()
    return "[\n" + ",\n".join(r.j for r in rows) + "\n]\n"


def write_pages(pages: DataFrame, folder: str) -> int:
    """pages(file, markdown) as files in a folder that all executors reach; their number."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.makedirs(folder, exist_ok=True)
        for pdf in it:
            for name, body in zip(pdf["file"], pdf["markdown"]):
                with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
                    f.write(body)
            yield pd.DataFrame({"n": [len(pdf)]})

    return pages.select("file", "markdown").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_single(nodes: DataFrame, pages: DataFrame, path: str) -> None:
    """All pages as text in their order: by type, then lower-case title; files sort by name."""
    n = nodes.select("id", publish.type_rank(F.col("subtype")).alias("r"), F.lower("title").alias("t"), "ord")
    pages.join(n, "id").orderBy("r", "t", "ord").select("markdown").write.mode("overwrite").option("lineSep", "\n\n").text(path)


def graph_html(nodes: DataFrame, edges: DataFrame, limit: int = 2000) -> str:
    """A page with the graph's records as JSON; ``limit`` top nodes, as a browser shows no more."""
    from loomgraph.operators import graph

    top = graph.repaired_top(edges, nodes, limit).select("id")
    own = nodes.join(top, "id", "left_semi")
    safe = lambda j: j.replace("</", "<\\/")  # noqa: E731  no text may end the script
    n = json_text(publish.vis_nodes(own), "id")
    e = json_text(publish.vis_edges(edges, own), "source")
    return f'<!doctype html><meta charset="utf-8"><title>Graph</title><div id="view"></div><script>const nodes={safe(n)};const edges={safe(e)};</script>'


def write_store(entries: DataFrame, edges: DataFrame, path: str) -> None:
    """Appends to the tables of a SQLite store, a thousand rows a statement."""
    spark = entries.sparkSession
    spark.dataSource.register(SqliteSource)
    for df, table in ((entries, "entries"), (edges, "edges")):
        df.coalesce(1).write.format("sqlite").options(path=path, table=table, batchsize="1000").mode("append").save()
