"""Scans: HTML files, node and edge JSON, sidecars, SQLite stores."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

NODE_SCHEMA = (
    "id string, title string, entry_type string, subtype string, content string, raw_html string, tags array<string>, aliases array<string>, category string, "
    "structured struct<quick_facts:struct<tag:string,type:string,default:string,raw_description:string>,definition:string,options:array<struct<value:string,description:string>>,warnings:array<string>,tutorial_summary:string>"
)
EDGE_SCHEMA = "source string, target string, relation string"


def html_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """``id, html, ord`` of *.html files: the name without suffix, bytes decoded as UTF-8 with
    replacement, order by path. Order is a hash of the path, so no global sort is needed."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", "*.html")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    name = F.regexp_extract("path", r"([^/]+)\.html$", 1)
    return r.load(path).select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("id"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"), F.abs(F.xxhash64("path") % 1_000_000_000).alias("ord"))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A pretty-printed JSON array of objects."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def sidecar(spark: SparkSession, path: str) -> DataFrame:
    """``id, ctx`` of a {id: text} JSON object; empty if the file does not exist."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], "id string, ctx string")
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("id", "ctx"))


class SqliteSource(DataSource):
    """``format("sqlite")``: options ``path`` and ``table``, read in ranges of rowid; writes append."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            kinds = {"INTEGER": "bigint", "REAL": "double"}
            return ", ".join(f"`{c[1]}` {kinds.get((c[2] or '').upper(), 'string')}" for c in db.execute(f"pragma table_info({self.options['table']})"))

    def reader(self, schema) -> DataSourceReader:
        return _SqliteReader(self.options, schema.names)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _SqliteWriter(self.options, schema.names)


class _SqliteReader(DataSourceReader):
    def __init__(self, options, names):
        self.path, self.table, self.names = options["path"], options["table"], names
        self.parts = int(options.get("numPartitions", "1"))

    def partitions(self):
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            lo, hi = db.execute(f"select coalesce(min(rowid), 0), coalesce(max(rowid), -1) from {self.table}").fetchone()
        step = max(1, -(-(hi - lo + 1) // self.parts))
        return [InputPartition((a, a + step)) for a in range(lo, hi + 1, step)]

    def read(self, partition) -> Iterator[tuple]:
        a, b = partition.value
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            cols = ", ".join(f'"{c}"' for c in self.names)
            yield from db.execute(f"select {cols} from {self.table} where rowid >= ? and rowid < ?", (a, b))


class _SqliteWriter(DataSourceWriter):
    def __init__(self, options, names):
        self.path, self.table, self.names, self.batch = options["path"], options["table"], names, int(options.get("batchsize", "1000"))

    def write(self, iterator) -> WriterCommitMessage:
        sql = f"insert into {self.table} ({', '.join(self.names)}) values ({', '.join('?' * len(self.names))})"
        with sqlite3.connect(self.path, timeout=60) as db:
            rows = []
            for r in iterator:
                rows.append(tuple(json.dumps(x) if isinstance(x, (list, dict)) else x for x in r))
                if len(rows) >= self.batch:
                    db.executemany(sql, rows)
                    rows = []
            db.executemany(sql, rows)
        return WriterCommitMessage()


def sqlite_table(spark: SparkSession, path: str, table: str, partitions: int = 1) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").options(path=path, table=table, numPartitions=str(partitions)).load()


def store_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a store as nodes; bad JSON gives empty tags, subtypes are derived."""
    from loomgraph.functions import classify

    e = sqlite_table(spark, path, "entries")
    tags = F.coalesce(F.from_json("tags", "array<string>"), F.array().cast("array<string>"))
    meta = F.coalesce("metadata_json", F.lit("{}"))
    return e.select("id", "title", "entry_type", classify.from_store(F.col("entry_type"), F.coalesce("content", F.lit("")), meta).alias("subtype"), F.coalesce("content", F.lit("")).alias("content"), tags.alias("tags"))


def store_links(spark: SparkSession, path: str) -> DataFrame:
    return sqlite_table(spark, path, "edges").select(F.col("source_id").alias("source"), F.col("target_id").alias("target"), "relation")
