"""Readers of JSON lines, Parquet shards, access logs, XML and paged services."""

from __future__ import annotations

import importlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def jsonl(spark: SparkSession, paths: list[str] | str, schema: str) -> DataFrame:
    """Rows of JSON lines with ``_file``, and ``_bad`` for a line that is none."""
    df = spark.read.schema(schema + ", _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(paths)
    return df.withColumn("_file", F.input_file_name())


def by_priority(df: DataFrame, key: str, mirror: str = "/es_") -> DataFrame:
    """The first row of each key: direct shards before mirrored ones, then by file; malformed lines and rows without key are left out."""
    rank = F.struct(F.col("_file").contains(mirror).alias("m"), F.col("_file"))
    columns = [c for c in df.columns if not c.startswith("_")]
    return df.where(F.col("_bad").isNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*columns), rank).alias("r")).select("r.*")


def parquet_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All shards of a folder with merged schemas; unreadable files are skipped."""
    return spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").parquet(folder)


LOG_LINE = r"^(\S+) (\S+) (\S+) ([A-Z]+) (\d{3}) ([0-9.]+|-) (\d+|-) ([0-9a-f]{8}|-)$"


def access_log(spark: SparkSession, paths: list[str] | str, day: str | None = None) -> DataFrame:
    """ts, client, endpoint, method, status, latency_ms, bytes, cohort of text or gzip logs.

    Latency is at most 60,000 ms, a dash is no bytes; a line that doesn't match
    is a row of nulls. ``day`` drops other lines before they are parsed.
    """
    raw = spark.read.text(paths)
    if day:
        raw = raw.where(F.col("value").startswith(day))
    g = lambda i: F.regexp_extract("value", LOG_LINE, i)
    return raw.withColumn("value", F.when(F.col("value").rlike(LOG_LINE), F.col("value"))).select(
        g(1).try_cast("timestamp_ntz").alias("ts"), g(2).alias("client"), g(3).alias("endpoint"), g(4).alias("method"), g(5).cast("int").alias("status"),
        F.when(g(6).try_cast("double").isNotNull(), F.least(F.lit(60_000), F.round(g(6).try_cast("double") * 1000))).cast("int").alias("latency_ms"), F.when(g(7).isNotNull(), F.coalesce(g(7).try_cast("bigint"), F.lit(0))).alias("bytes"), F.nullif(g(8), F.lit("-")).alias("cohort"),
    )


def xml_articles(spark: SparkSession, paths: list[str] | str, tag: str = "article") -> DataFrame:
    """number, heading, text of each ``tag`` of law texts."""
    schema = "_eId string, num string, heading string, paragraph array<struct<num:string, content:struct<p:array<string>>>>"
    df = spark.read.schema(schema).option("rowTag", tag).xml(paths)
    text = F.array_join(F.flatten(F.transform("paragraph", lambda p: F.coalesce(p["content"]["p"], F.array().cast("array<string>")))), "\n")
    number = F.coalesce(F.nullif(F.trim(F.regexp_replace("num", r"(?i)^art\.?\s*", "")), F.lit("")), F.regexp_extract("_eId", r"art_(\w+)", 1))
    return df.select(number.alias("number"), F.trim("heading").alias("heading"), text.alias("text"))


def goldens(spark: SparkSession, paths: list[str]) -> DataFrame:
    """query_id, query, doc, grade of golden query files; an id that an earlier file has gets the suffix __2."""
    from functools import reduce

    from pyspark.sql.window import Window

    schema = "queries array<struct<id:string, query:string, tags:array<string>, relevant:array<struct<decision_id:string, grade:int>>>>"
    files = [spark.read.schema(schema).option("multiLine", "true").json(p).withColumn("n", F.lit(i)) for i, p in enumerate(paths)]
    rows = reduce(DataFrame.unionByName, files).select("n", F.posexplode("queries").alias("k", "q"))
    seen = F.row_number().over(Window.partitionBy("q.id").orderBy("n", "k"))
    named = rows.withColumn("query_id", F.concat(F.col("q.id"), F.when(seen > 1, F.concat(F.lit("__"), seen)).otherwise(F.lit(""))))
    return named.select("query_id", F.col("q.query").alias("query"), F.explode("q.relevant").alias("r")).select("query_id", "query", F.col("r.decision_id").alias("doc"), F.col("r.grade").alias("grade"))


class _Page(InputPartition):
    def __init__(self, value: object) -> None:
        super().__init__(value)


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def _service(self):
        module, _, name = self.options["service"].partition(":")
        return getattr(importlib.import_module(module), name)(dict(self.options))

    def partitions(self) -> list[InputPartition]:
        return [_Page(p) for p in self._service().pages()]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        service, attempts = self._service(), int(self.options.get("attempts", "2"))
        if getattr(service, "steady", False):
            yield from service.fetch(partition.value)
            return
        for n in range(attempts):
            try:
                yield from list(service.fetch(partition.value))
                return
            except OSError:
                if n + 1 == attempts:
                    raise


class PagedSource(DataSource):
    """A service that answers in pages, one partition for each.

    The option ``service`` names a class, ``module:Class``, that takes the
    options and has ``pages()`` and ``fetch(page)`` (rows as tuples); a page
    that fails with an OSError is asked for again. The rows of a page are held
    until it has come whole, but for a service that is ``steady``: it deals with
    failures itself, and its rows are passed on as they come.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options["columns"]

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


def register_paged(spark: SparkSession) -> None:
    """Makes ``spark.read.format("paged")`` known."""
    spark.dataSource.register(PagedSource)


def corpus(spark: SparkSession, path: str, courts: list[str] | None = None) -> DataFrame:
    """The table at ``path``, of ``courts`` only (in any case) if given."""
    df = spark.read.parquet(path)
    return df.where(F.lower("court").isin([x.lower() for x in courts])) if courts else df


def table_else_jsonl(spark: SparkSession, path: str, folder: str, schema: str) -> tuple[DataFrame, str]:
    """(rows, 'table') of the Parquet table at ``path`` if there is one, else (rows, 'jsonl') of the JSON lines in ``folder``."""
    from tessera.session import exists

    return (spark.read.parquet(path), "table") if exists(spark, path) else (jsonl(spark, folder, schema), "jsonl")


def recent(df: DataFrame, key: str, day: str, today: str, days: int = 14) -> DataFrame:
    """key, day of the rows of the last ``days`` up to ``today`` (ISO days), each key once with its first day."""
    inside = F.col(day).try_cast("date").between(F.date_sub(F.lit(today).cast("date"), days), F.lit(today).cast("date"))
    return df.where(inside).groupBy(key).agg(F.min(day).alias(day))


def cohorts(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """day, client_class, cohort of a log of visitors; lines of another form are left out."""
    p = r"^(\d{4}-\d{2}-\d{2}) (\S+) ([0-9a-f]{8})$"
    g = lambda i: F.regexp_extract("value", p, i)
    return spark.read.text(paths).where(F.col("value").rlike(p)).select(g(1).alias("day"), g(2).alias("client_class"), g(3).alias("cohort"))


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """path, line (from 1), value, bytes before the line, of every file of ``folder``; a file is one row of at most 2 GB on the way."""
    files = spark.read.format("binaryFile").load(folder)

    @F.pandas_udf("array<struct<line:bigint, start:bigint, value:string>>")
    def cut(blobs: pd.Series) -> pd.Series:
        def lines(blob: bytes) -> list[dict]:
            out, start = [], 0
            for n, line in enumerate(blob.split(b"\n"), 1):
                out.append({"line": n, "start": start, "value": line.decode("utf-8", "replace")})
                start += len(line) + 1
            return out[:-1] if out and out[-1]["value"] == "" else out

        return blobs.map(lines)

    return files.select("path", F.explode(cut("content")).alias("l")).select("path", "l.line", "l.value", "l.start")


def bad_json(spark: SparkSession, folder: str) -> DataFrame:
    """path, line, value of the lines that are no JSON objects; blank ones don't count."""
    rows = numbered_lines(spark, folder).where(F.trim("value") != "")
    return rows.where(F.try_parse_json("value").isNull() | ~F.trim("value").startswith("{")).select("path", "line", "value")


def grown_lines(spark: SparkSession, folder: str, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(path and value of the lines that are new, the next state) of a folder whose files grow.

    ``state``: path, size as of the last time. Files of the same size are
    skipped, grown ones read from there, shrunk ones anew; a last line without
    its end waits.
    """
    files = spark.read.format("binaryFile").load(folder)
    if state is None:
        state = spark.createDataFrame([], "path string, size bigint")
    changed = files.join(state, "path", "left").where(F.col("size").isNull() | (F.col("size") != F.col("length")))

    @F.pandas_udf("struct<size:bigint, lines:array<string>>")
    def fresh(blobs: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        out = []
        for blob, size in zip(blobs, sizes):
            at = int(size) if pd.notna(size) and size <= len(blob) else 0
            end = blob.rfind(b"\n") + 1
            out.append((max(end, at), blob[at:end].decode("utf-8", "replace").split("\n")[:-1] if end > at else []))
        return pd.DataFrame(out, columns=["size", "lines"])

    from tessera.session import materialize

    read = materialize(changed.select("path", fresh("content", "size").alias("x")).select("path", "x.size", "x.lines"), "grown")
    now = read.select("path", "size").unionByName(state.join(read.select("path"), "path", "left_anti"))
    return read.select("path", F.explode("lines").alias("value")), now
