"""Writers: partitioned exports, versioned snapshots behind gates, shards, citations formats and feeds."""

from __future__ import annotations

import json
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.quality import group_gate, row_gate
from tessera.session import write_atomically


#: Most rows of a dashboard's panel, which the driver holds.
PANEL = 10_000


def by_partition(df: DataFrame, path: str, column: str) -> None:
    """One folder for each value, zstd, replacing what was there.

    Rows are brought together by the column; adaptive execution splits a value
    that holds most rows into files of the advised size.
    """
    df.hint("rebalance", column).write.partitionBy(column).option("compression", "zstd").mode("overwrite").parquet(path)


def replace_rows(spark: SparkSession, path: str, fresh: DataFrame, key: str, out: str) -> None:
    """``path`` with the rows of ``fresh`` in place of those with the same key, written to ``out``."""
    old = spark.read.parquet(path)
    old.join(fresh.select(key), key, "left_anti").unionByName(fresh).write.option("compression", "zstd").mode("overwrite").parquet(out)


def monthly(df: DataFrame, path: str, at: str) -> None:
    """Daily rows compacted into a folder for each month."""
    df.withColumn("month", F.date_format(at, "yyyy-MM")).hint("rebalance", "month").write.partitionBy("month").option("compression", "zstd").mode("overwrite").parquet(path)


def snapshot(df: DataFrame, root: str, version: int, by: str, least: int = 500) -> str:
    """Writes ``root/v=<version>``, checks it against the last version and points ``root/current`` at it.

    Raises ValueError, leaving the pointer alone, if rows or a group of at
    least ``least`` rows have shrunk too far.
    """
    spark = df.sparkSession
    path, pointer = f"{root}/v={version}", f"{root}/current"
    df.write.option("compression", "zstd").mode("overwrite").parquet(path)
    new = spark.read.parquet(path)
    last = current(spark, root)
    if last is not None:
        if not row_gate(new.count(), last.count()):
            raise ValueError("the new snapshot has too few rows")
        shrunk = group_gate(new, last, by, least=least)
        if not shrunk.isEmpty():
            raise ValueError(f"groups have shrunk: {[r[by] for r in shrunk.limit(20).collect()]}")
    write_atomically(spark, pointer, json.dumps({"path": path}))
    return path


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The snapshot that the pointer names; None if there is none."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema("path string").json(f"{root}/current").first()
    except AnalysisException:
        return None
    return spark.read.parquet(row["path"]) if row else None


def bibtex(c: dict[str, Column]) -> Column:
    """One @misc entry; columns id, court, docket, date, url."""
    e = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"([{}%&$#_])", r"\\$1")
    return F.concat(F.lit("@misc{"), c["id"], F.lit(",\n  title = {"), e(c["docket"]), F.lit("},\n  author = {"), e(c["court"]), F.lit("},\n  date = {"), F.coalesce(c["date"], F.lit("")), F.lit("},\n  url = {"), F.coalesce(c["url"], F.lit("")), F.lit("}\n}"))


def ris(c: dict[str, Column]) -> Column:
    """One TY - CASE record; columns court, docket, date, url."""
    lines = [F.lit("TY  - CASE")] + [F.when(F.coalesce(c[k], F.lit("")) != "", F.concat(F.lit(f"{tag}  - "), c[k])) for tag, k in (("TI", "docket"), ("AU", "court"), ("DA", "date"), ("UR", "url"))] + [F.lit("ER  - ")]
    return F.concat_ws("\n", *lines)


def rss(rows: list[dict], title: str, link: str) -> str:
    """An RSS document of at most a page of rows with title, link, date."""
    items = "".join(f"<item><title>{escape(r['title'] or '')}</title><link>{escape(r['link'] or '')}</link><pubDate>{escape(r['date'] or '')}</pubDate></item>" for r in rows)
    return f'<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>{escape(title)}</title><link>{escape(link)}</link>{items}</channel></rss>'


def atom(rows: list[dict], title: str, link: str) -> str:
    """An Atom document of at most a page of rows with title, link, date."""
    items = "".join(f"<entry><title>{escape(r['title'] or '')}</title><id>{escape(r['link'] or '')}</id><link href=\"{escape(r['link'] or '')}\"/><updated>{escape(r['date'] or '')}</updated></entry>" for r in rows)
    return f'<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>{escape(title)}</title><id>{escape(link)}</id>{items}</feed>'


def dashboard(parts: dict[str, DataFrame]) -> str:
    """One JSON object of small aggregates, by name; an aggregate of more than ``PANEL`` rows is no panel and raises ValueError."""
    out = {}
    for name, df in parts.items():
        rows = df.limit(PANEL + 1).collect()
        if len(rows) > PANEL:
            raise ValueError(f"{name} has more than {PANEL} rows")
        out[name] = [r.asDict() for r in rows]
    return json.dumps(out, ensure_ascii=False, default=str, sort_keys=True)


def query_to_parquet(spark: SparkSession, sql: str, path: str) -> None:
    """The result of ``sql``, with booleans as 0 and 1."""
    df = spark.sql(sql)
    df.select(*[F.col(n).cast("int").alias(n) if k == "boolean" else F.col(n) for n, k in df.dtypes]).write.mode("overwrite").option("compression", "zstd").parquet(path)


def report(df: DataFrame, folder: str, day: str) -> None:
    """A report of checks as JSON lines under ``latest`` and under its day."""
    for name in (day, "latest"):
        df.coalesce(1).write.mode("overwrite").json(f"{folder}/{name}")
