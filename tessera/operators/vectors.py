"""Vectors of texts by an injected encoder: batches, resumption, shards, packing, hybrid ranking, pinpoints.

An encoder is a function from a list of texts to an array of their vectors; it
runs in Arrow batches on the executors. There is none here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import search as S

Encoder = Callable[[list[str]], np.ndarray]


def encode(df: DataFrame, id_column: str, text: str, encoder: Encoder, batch: int = 32) -> DataFrame:
    """id_column, vector (array<float>) of every text that is not blank.

    Texts of one Arrow batch are encoded by length, so that a sub-batch is padded
    little, and come out in their own order.
    """
    kind = dict(df.dtypes)[id_column]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            order = np.argsort([len(t) for t in part["text"]], kind="stable")
            vectors: list = [None] * len(part)
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                for k, v in zip(some, np.asarray(encoder([part["text"].iloc[k] for k in some]), dtype=np.float32)):
                    vectors[k] = v
            yield pd.DataFrame({"id": part["id"], "vector": vectors})

    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text")).where(F.length(F.trim("text")) > 0)
    return rows.mapInPandas(run, f"id {kind}, vector array<float>").withColumnRenamed("id", id_column)


def build(df: DataFrame, id_column: str, text: str, encoder: Encoder, done: DataFrame | None = None, shard: tuple[int, int] | None = None, batch: int = 32) -> DataFrame:
    """One vector for each id that ``done`` lacks, of shard (k, n) of them if given.

    A repeated id has the greatest of its texts' vectors, which is the one where
    its texts are equal; vectors are compared, no text is moved.
    """
    rows = df.where(F.pmod(F.xxhash64(id_column), F.lit(shard[1])) == shard[0]) if shard else df
    if done is not None:
        rows = rows.join(done.select(id_column), id_column, "left_anti")
    return encode(rows, id_column, text, encoder, batch).groupBy(id_column).agg(F.max("vector").alias("vector"))


def pack(vector: Column) -> Column:
    """The vector as little-endian 32-bit floats."""

    @F.pandas_udf("binary")
    def run(vectors: pd.Series) -> pd.Series:
        return vectors.map(lambda v: np.asarray(v, dtype="<f4").tobytes(), na_action="ignore")

    return run(vector)


def unpack(packed: Column) -> Column:
    @F.pandas_udf("array<float>")
    def run(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: np.frombuffer(b, dtype="<f4"), na_action="ignore")

    return run(packed)


def quantised(vector: Column) -> Column:
    """struct<scale, codes>: the vector as whole numbers from -127 to 127 times a scale; a zero vector has scale 0."""
    most = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    codes = F.transform(vector, lambda x: F.when(most > 0, F.bround(x.cast("double") / most * 127)).otherwise(0.0).cast("tinyint"))
    return F.struct((most / 127).alias("scale"), codes.alias("codes"))


def hybrid(lexical: DataFrame, dense: DataFrame, mode: str, lexical_weight: float = 1.5, dense_weight: float = 1.0, inject: int = 10, injected_weight: float = 0.3, k: int = 60) -> DataFrame:
    """doc, score of lexical (doc, rank) and dense (doc, rank) candidates.

    ``signal``: the dense rank only adds to documents that the lexical search has
    found. ``inject``: at most ``inject`` of the best other ones come in, too, with
    a lower weight.
    """
    both = lexical.select("doc", F.col("rank").alias("l")).join(dense.select("doc", F.col("rank").alias("v")), "doc", "full")
    found = both.where(F.col("l").isNotNull()).select("doc", (lexical_weight / (k + F.col("l")) + F.coalesce(dense_weight / (k + F.col("v")), F.lit(0.0))).alias("score"))
    if mode == "signal":
        return found
    new = both.where(F.col("l").isNull()).orderBy("v", "doc").limit(inject).select("doc", (injected_weight / (k + F.col("v"))).alias("score"))
    return found.unionByName(new)


def pinpoints(paragraphs: DataFrame, words: list[str], query: list[float], vector: str | None = "vector") -> DataFrame:
    """doc, number, method, confidence: of each document the paragraph that answers best.

    ``paragraphs``: doc, number, text and, if ``vector`` is given, a vector. The
    lexical choice has the most different words of the query, then most of all;
    the other one the greatest cosine. Where both agree the confidence is raised;
    where they don't, or there is no vector, the lexical choice stands.
    """
    asked = F.array(*[F.lit(w) for w in words])
    found = F.filter(S.terms(F.col("text")), lambda t: F.array_contains(asked, t))
    scored = paragraphs.withColumn("_hits", F.size(F.array_distinct(found)) * 1000 + F.least(F.size(found), F.lit(999)))
    last = F.col("number")
    picks = [F.max_by("number", F.struct(F.col("_hits"), (-last).alias("n"))).alias("number"), F.max("_hits").alias("_most")]
    if vector:
        picks.append(F.max_by("number", F.struct(F.coalesce(S.cosine(F.col(vector), query), F.lit(-2.0)).alias("c"), (-last).alias("n"))).alias("_semantic"))
    best = scored.groupBy("doc").agg(*picks).where("_most > 0")
    share = F.floor(F.col("_most") / 1000) / len(words)
    if not vector:
        return best.select("doc", "number", F.lit("lexical").alias("method"), F.round(0.6 * share, 4).alias("confidence"))
    agree = F.col("number") == F.col("_semantic")
    return best.select("doc", "number", F.when(agree, "both").otherwise("lexical").alias("method"), F.round(F.when(agree, F.least(F.lit(1.0), 0.6 * share + 0.3)).otherwise(0.6 * share), 4).alias("confidence"))
