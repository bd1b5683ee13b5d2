"""Publishing what has changed: deltas in a stated vocabulary, snapshots with a manifest, guards, histories."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.aggregates import merkle_root
from tessera.session import exists, files_of, write_atomically

# The delta's names for the columns of a decision.
VOCABULARY = {
    "id": "decision_id", "court": "court", "canton": "canton", "chamber": "chamber", "docket": "docket_number", "docket_2": "docket_number_2", "date": "decision_date", "published": "publication_date", "lang": "language", "title": "title",
    "area": "legal_area", "headnote": "regeste", "text": "full_text", "kind": "decision_type", "outcome": "outcome", "url": "source_url", "pdf": "pdf_url", "source": "source",
}


def to_vocabulary(df: DataFrame) -> DataFrame:
    """Rows of decisions under the delta's names, with ``hash``: the stored one, else SHA-256 of the text."""
    return df.select(*[F.col(old).alias(new) for new, old in VOCABULARY.items()], F.coalesce("content_hash", F.sha2("full_text", 256)).alias("hash"))


def export(df: DataFrame, ids: DataFrame, key: str, path: str, strings: bool = False, order: list[str] | None = None) -> None:
    """The rows of ``ids`` in the schema of ``df``, or all as strings, sorted within files, to ``path``."""
    rows = df.join(ids.select(key).distinct(), key, "left_semi")
    out = rows.select(*[F.col(c).cast("string").alias(c) if strings else F.col(c) for c in df.columns])
    (out.repartitionByRange(*order).sortWithinPartitions(*order) if order else out).write.mode("overwrite").option("compression", "zstd").parquet(path)


@contextmanager
def unchanged(df: DataFrame) -> Iterator[None]:
    """Raises RuntimeError at its end if a file that ``df`` reads has been changed meanwhile."""
    before = files_of(df)
    yield
    if files_of(df) != before:
        raise RuntimeError("the source has changed while it was read")


def snapshot_artifact(df: DataFrame, key: str, path: str, required: list[str], least: int = 1) -> dict:
    """Writes ``df`` and a manifest of its rows, columns and Merkle root; returns the manifest.

    Raises ValueError for missing columns or too few rows, and RuntimeError if
    the source changes while it is read; the manifest comes last.
    """
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    with unchanged(df):
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/rows")
    manifest = _measured(df.sparkSession, f"{path}/rows", key)
    if manifest["rows"] < least:
        raise ValueError(f"only {manifest['rows']} rows")
    write_atomically(df.sparkSession, f"{path}/manifest.json", json.dumps(manifest))
    return manifest


def _measured(spark: SparkSession, path: str, key: str) -> dict:
    rows = spark.read.parquet(path)
    leaf = F.to_json(F.struct(*sorted(rows.columns)))
    root = merkle_root(rows, key, F.concat_ws("|", F.col(key), F.sha2(leaf, 256))).first()
    return {"rows": root["n"] if root else 0, "columns": sorted(rows.columns), "root": root["root"] if root else None}


def intact(spark: SparkSession, path: str, key: str) -> bool:
    """Whether a snapshot artifact is as its manifest says."""
    if not exists(spark, f"{path}/manifest.json"):
        return False
    told = json.loads(spark.read.text(f"{path}/manifest.json").first()["value"])
    return told == _measured(spark, f"{path}/rows", key)


def diff_base(states: DataFrame, version: str) -> DataFrame:
    """``states`` (with ``version``) and ``mode``: diff where an earlier run's extractor had this version, else full."""
    return states.withColumn("mode", F.when(F.col("version").eqNullSafe(F.lit(version)), "diff").otherwise("full"))


def refreshed(done: DataFrame, done_hashes: DataFrame, documents: DataFrame, key: str, digest: Column, extract: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``extract`` gives for ``documents``, taking ``done`` over for those whose digest is as in ``done_hashes`` (key, digest).

    Only new and changed documents are extracted; results of changed and deleted ones go.
    """
    now = documents.select(key, digest.alias("_now"))
    same = now.join(done_hashes.select(key, F.col("digest").alias("_was")), key).where(F.col("_now").eqNullSafe(F.col("_was"))).select(key)
    return done.join(same, key, "left_semi").unionByName(extract(documents.join(same, key, "left_anti")))


def quick_publish(spark: SparkSession, root: str, fresh: DataFrame, key: str) -> int:
    """Adds the rows of ``fresh`` whose key the current snapshot lacks as a new generation and points ``root/current`` at it; returns the generation.

    Snapshots are folders of generations, so that only what is new is written.
    Another publisher at work (``root/lock``) raises RuntimeError.
    """
    from tessera.session import _path

    fs, lock = _path(spark, f"{root}/lock")
    fs.mkdirs(lock.getParent())
    if not fs.createNewFile(lock):
        raise RuntimeError("another publisher is at work")
    try:
        paths = published_paths(spark, root)
        new = fresh.dropDuplicates([key])
        if paths:
            new = new.join(spark.read.parquet(*paths).select(key), key, "left_anti")
        generation = len(paths) + 1
        path = f"{root}/generation={generation:06d}"
        new.write.mode("overwrite").option("compression", "zstd").parquet(path)
        write_atomically(spark, f"{root}/current.json", json.dumps({"paths": [*paths, path]}))
        return generation
    finally:
        fs.delete(lock, False)


def published_paths(spark: SparkSession, root: str) -> list[str]:
    """The folders that make up the current snapshot."""
    if not exists(spark, f"{root}/current.json"):
        return []
    return json.loads(spark.read.text(f"{root}/current.json").first()["value"])["paths"]


def upsert(history: DataFrame | None, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """``history`` with the rows of ``fresh`` in place of those with the same keys."""
    return fresh if history is None else history.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)


def claimed_twice(links: DataFrame, member: str, owner: str) -> DataFrame:
    """member, n: members that several owners claim; a manifest of links must have none."""
    return links.groupBy(member).agg(F.countDistinct(owner).alias("n")).where("n > 1")
