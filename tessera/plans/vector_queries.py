"""Queries of vectors and of hybrid retrieval."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import search as S
from tessera.operators import vectors as V
from tessera.plans.registry import Registry
from tessera.plans.search_queries import _BM25, WORDS, _index
from tessera.session import scratch
from tessera.sources.tables import table

R = Registry()
c = F.col
_COS = "list_dot_product(embedding::DOUBLE[], e::DOUBLE[]) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(e::DOUBLE[], e::DOUBLE[]))"
_SHAPE = "[length(text), length(text) - length(replace(text, ' ', '')), length(text) - length(replace(text, 'e', '')), 1]"


def shape(texts: list[str]) -> np.ndarray:
    """An encoder for want of a model: characters, blanks, letters e, and one."""
    return np.array([[len(t), t.count(" "), t.count("e"), 1] for t in texts], dtype=np.float32)


def _documents(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text", *columns)


def _numbers(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, *[c("vector")[k].cast("bigint").alias(f"v{k}") for k in range(4)])


_ENCODED = f"SELECT doc_id, v[1]::BIGINT AS v0, v[2]::BIGINT AS v1, v[3]::BIGINT AS v2, v[4]::BIGINT AS v3 FROM (SELECT doc_id, {_SHAPE} AS v FROM documents WHERE length(trim(text, ' ')) > 0)"


@R.add(_ENCODED)
def fts_20_encoded_batches(s: SparkSession, d: str) -> DataFrame:
    return _numbers(V.encode(_documents(s, d), "doc_id", "text", shape), "doc_id")


@R.add(_ENCODED)
def fts_21_vector_build(s: SparkSession, d: str) -> DataFrame:
    """Three shards of a table with repeated ids, put together."""
    docs = _documents(s, d)
    rows = docs.unionByName(docs.where("doc_id % 10 = 0"))
    shards = [V.build(rows, "doc_id", "text", shape, shard=(k, 3)) for k in range(3)]
    return _numbers(shards[0].unionByName(shards[1]).unionByName(shards[2]), "doc_id")


@R.add("SELECT coalesce(lang, '') AS lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents WHERE length(trim(text, ' ')) > 0 GROUP BY 1")
def fts_18_vectors_by_language(s: SparkSession, d: str) -> DataFrame:
    """Vectors written into a folder for each language, and read back."""
    out = scratch(s, "io")
    rows = V.encode(_documents(s, d), "doc_id", "text", shape).join(table(s, d, "documents", "doc_id", "lang"), "doc_id").withColumn("folder", F.concat(F.lit("l-"), F.coalesce("lang", F.lit(""))))
    rows.select("doc_id", "vector", "folder").hint("rebalance", "folder").write.partitionBy("folder").parquet(out)
    return s.read.parquet(out).groupBy(F.regexp_replace("folder", "^l-", "").alias("lang")).agg(F.count("*").alias("n"), F.sum(c("vector")[0].cast("bigint")).alias("chars"))


@R.add("""SELECT doc_id, generate_subscripts(p, 1) - 1 AS n, length(unnest(p)) AS n_chars FROM (SELECT doc_id, list_filter(string_split(text, E'\\n\\n'), lambda x: length(x) >= 20 AND length(trim(x, ' ')) > 0) AS p FROM documents WHERE text IS NOT NULL)""".replace("\\\\", "\\"))
def fts_22_paragraph_vectors_resumed(s: SparkSession, d: str) -> DataFrame:
    """Vectors of all paragraphs, of which an earlier run had those of every second document."""
    parts = F.filter(F.split("text", "\n\n"), lambda x: (F.length(x) >= 20) & (F.length(F.trim(x)) > 0))
    p = _documents(s, d).where(c("text").isNotNull()).select("doc_id", F.posexplode(parts).alias("n", "text")).withColumn("key", F.concat_ws("#", "doc_id", "n"))
    done = V.build(p.where("doc_id % 2 = 0"), "key", "text", shape)
    every = done.unionByName(V.build(p, "key", "text", shape, done=done))
    return every.select(F.split("key", "#")[0].cast("bigint").alias("doc_id"), F.split("key", "#")[1].cast("bigint").alias("n"), c("vector")[0].cast("bigint").alias("n_chars"))


@R.add("SELECT vec_id, 4 * len(embedding) AS n_bytes, true AS same FROM embeddings")
def scl_63_packed_vectors(s: SparkSession, d: str) -> DataFrame:
    """Vectors as bytes, and whether they come back as they were."""
    packed = table(s, d, "embeddings", "vec_id", "embedding").withColumn("b", V.pack(c("embedding")))
    return packed.select("vec_id", F.length("b").cast("bigint").alias("n_bytes"), (V.unpack(c("b")) == c("embedding").cast("array<float>")).alias("same"))


@R.add("SELECT vec_id, round(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))) / 127, 8) AS scale FROM embeddings")
def fts_21_quantised(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "embeddings", "vec_id", "embedding").select("vec_id", F.round(V.quantised(c("embedding"))["scale"], 8).alias("scale"))


@R.add(_BM25 + f""", one AS (SELECT doc, row_number() OVER (ORDER BY score, doc) AS l FROM scored ORDER BY 2 LIMIT 100), q AS (SELECT embedding AS e FROM embeddings ORDER BY vec_id LIMIT 1),
two AS (SELECT vec_id AS doc, row_number() OVER (ORDER BY {_COS} DESC, vec_id) AS v FROM embeddings, q ORDER BY 2 LIMIT 50), both_lists AS (SELECT doc, l, v FROM one FULL JOIN two USING (doc)),
found AS (SELECT doc, 1.5 / (60 + l) + coalesce(1.0 / (60 + v), 0) AS score FROM both_lists WHERE l IS NOT NULL), new AS (SELECT doc, 0.3 / (60 + v) AS score FROM both_lists WHERE l IS NULL ORDER BY v, doc LIMIT 10)
SELECT 'signal' AS mode, doc, round(score, 8) AS score FROM found UNION ALL SELECT 'inject', doc, round(score, 8) FROM found UNION ALL SELECT 'inject', doc, round(score, 8) FROM new""")
def fts_23_hybrid_modes(s: SparkSession, d: str) -> DataFrame:
    lexical = S.ranked(S.bm25(_index(s, d), WORDS), c("score"), 100)
    e = table(s, d, "embeddings", "vec_id", "embedding")
    near = S.nearest(e, "vec_id", "embedding", list(e.orderBy("vec_id").first()["embedding"]), 50).select(c("vec_id").alias("doc"), "score")
    dense = S.ranked(near, -c("score"), 50)
    parts = [V.hybrid(lexical, dense, mode).select(F.lit(mode).alias("mode"), "doc", F.round("score", 8).alias("score")) for mode in ("signal", "inject")]
    return parts[0].unionByName(parts[1])


@R.add()
def fts_24_pinpoints(s: SparkSession, d: str) -> DataFrame:
    """The paragraph of each document that answers a query best, by its words and by its vector."""
    parts = F.filter(F.split("text", "\n\n"), lambda x: F.length(F.trim(x)) > 0)
    p = _documents(s, d).where(c("text").isNotNull()).select(c("doc_id").alias("doc"), F.posexplode(parts).alias("number", "text")).withColumn("key", F.concat_ws("#", "doc", "number"))
    vectors = V.encode(p, "key", "text", shape)
    return V.pinpoints(p.join(vectors, "key"), ["mangel", "frist", "kundigung"], [300.0, 45.0, 40.0, 1.0])
