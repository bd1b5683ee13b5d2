"""Queries of retrieval."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import search as S
from tessera.plans.registry import Registry
from tessera.sources.tables import table

R = Registry()
c = F.col
WORDS = ["beschwerde", "gericht", "mangel"]
_TERMS = "list_filter(string_split_regex(translate(lower(coalesce({0}, '')), 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ', 'aaaaaaceeeeiiiinoooooouuuuyy'), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')".replace("\\\\", "\\")
_POSTINGS = f"""WITH docs AS (SELECT doc_id AS doc, {_TERMS.format("text")} AS w FROM documents), tok AS (SELECT doc, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS place FROM docs), p AS (SELECT doc, term, count(*) AS tf FROM tok GROUP BY 1, 2), sizes AS (SELECT doc, len(w) AS len FROM docs)
"""
_BM25 = _POSTINGS.rstrip() + """, st AS (SELECT count(*) AS n, avg(len) AS a FROM sizes), df AS (SELECT term, count(*) AS k FROM p WHERE term IN ('beschwerde', 'gericht', 'mangel') GROUP BY 1),
scored AS (SELECT doc, -sum(greatest(1e-6, ln((n - k + 0.5) / (k + 0.5))) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a))) AS score FROM p JOIN df USING (term) JOIN sizes USING (doc), st GROUP BY 1)
"""


def _docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text", "lang")


def _index(s: SparkSession, d: str) -> S.Index:
    return S.kept_index(_docs(s, d), "documents", "doc_id", ["text"])


@R.add(_POSTINGS + "SELECT term, count(*) AS docs, sum(tf)::BIGINT AS tf FROM p GROUP BY 1")
def fts_01_postings(s: SparkSession, d: str) -> DataFrame:
    return _index(s, d).terms.where("field = ''").select("term", c("df").alias("docs"), "tf")


@R.add(_POSTINGS + "SELECT count(*) AS postings, count(DISTINCT term) AS terms, sum(tf)::BIGINT AS words, (SELECT count(*) FROM sizes) AS docs FROM p")
def fts_06_optimised_index(s: SparkSession, d: str) -> DataFrame:
    """Builds the index anew, merged and in order, and counts what it holds."""
    from tessera.session import scratch

    path = scratch(s, "index")
    S.build_index(_docs(s, d), "doc_id", ["text"], path)
    index = S.open_index(s, path)
    return index.postings.agg(F.count("*").alias("postings"), F.countDistinct("term").alias("terms"), F.sum("tf").alias("words"), F.lit(index.n).alias("docs"))


@R.add(_POSTINGS + """SELECT doc FROM (SELECT doc FROM p WHERE term IN ('beschwerde', 'gericht') GROUP BY 1 HAVING count(*) = 2) WHERE doc NOT IN (SELECT doc FROM p WHERE term = 'mangel') AND doc IN (SELECT doc FROM p WHERE starts_with(term, 'kind')) AND doc IN (SELECT a.doc FROM tok a JOIN tok b ON a.doc = b.doc AND b.place = a.place + 1 WHERE a.term = 'das' AND b.term = 'gericht')""")
def fts_02_match(s: SparkSession, d: str) -> DataFrame:
    return S.match(_index(s, d), S.parse('Beschwerde Gericht kind* "das Gericht" NOT Mangel'))


@R.add(_BM25 + "SELECT doc, round(score, 6) AS score FROM scored ORDER BY scored.score, doc LIMIT 50")
def fts_03_bm25(s: SparkSession, d: str) -> DataFrame:
    index = _index(s, d)
    return S.bm25(index, WORDS).orderBy("score", "doc").limit(50).select("doc", F.round("score", 6).alias("score"))


_FIELDS = ["title", "regeste", "full_text"]


def decisions_index(s: SparkSession, d: str) -> S.Index:
    """The index of the first version of each decision."""
    rows = table(s, d, "decisions").select("decision_id", "scraped_at", c("_metadata.row_index").alias("row"), "docket_number", *_FIELDS)
    return S.kept_index(rows, "decisions", "decision_id", ["docket_number", *_FIELDS], ["scraped_at", "row"])


@R.add()
def fts_04_bm25_columns(s: SparkSession, d: str) -> DataFrame:
    return S.bm25(decisions_index(s, d), ["mietvertrag", "kundigung"], S.COLUMN_WEIGHTS).orderBy("score", "doc").limit(50)


@R.add(_POSTINGS + "SELECT count(DISTINCT doc) AS total, least(count(DISTINCT doc), 100) AS capped FROM p WHERE term IN ('beschwerde', 'gericht', 'mangel')")
def fts_05_total(s: SparkSession, d: str) -> DataFrame:
    hits = S.match(_index(s, d), S.Query(may=WORDS))
    return hits.agg(F.count("*").alias("total"), F.least(F.count("*"), F.lit(100)).alias("capped"))


@R.add(f"""SELECT doc, field, term, count(*) AS tf FROM (SELECT bge_reference AS doc, field, unnest({_TERMS.format("x")}) AS term FROM (SELECT bge_reference, unnest(['bge_reference', 'decision_id', 'docket_number_2', 'decision_date']) AS field, unnest([bge_reference, decision_id, docket_number_2, decision_date]) AS x FROM bge_register)) GROUP BY 1, 2, 3""")
def fts_07_postings_of_any_table(s: SparkSession, d: str) -> DataFrame:
    fields = ["bge_reference", "decision_id", "docket_number_2", "decision_date"]
    return S.postings(table(s, d, "bge_register", *fields), "bge_reference", fields).select("doc", "field", "term", "tf")


@R.add()
def fts_08_sanitised_queries(s: SparkSession, d: str) -> DataFrame:
    """Every reference once recorded as unresolved, read as a query."""
    schema = "must array<string>, may array<string>, never array<string>, phrases array<string>"

    @F.pandas_udf(schema)
    def read(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(q.must, q.may, q.never, [" ".join(p) for p in q.phrases]) for q in map(S.parse, texts)], columns=["must", "may", "never", "phrases"])

    rows = table(s, d, "citation_gaps", "target_ref").where(c("target_ref").isNotNull())
    return rows.select("target_ref", read("target_ref").alias("q")).select("target_ref", *[F.array_join(f"q.{k}", " ").alias(k) for k in ("must", "may", "never", "phrases")])


@R.add(_BM25 + """, one AS (SELECT doc, row_number() OVER (ORDER BY score, doc) AS rank FROM scored ORDER BY 2 LIMIT 100), two AS (SELECT doc, row_number() OVER (ORDER BY doc) AS rank FROM (SELECT DISTINCT doc FROM p WHERE term = 'mangel') ORDER BY 2 LIMIT 100)
SELECT doc, round(sum(s), 8) AS score, count(*) AS hits FROM (SELECT doc, 1.5 / (60 + rank) AS s FROM one UNION ALL SELECT doc, 1.0 / (60 + rank) FROM two) GROUP BY 1""")
def fts_10_reciprocal_rank_fusion(s: SparkSession, d: str) -> DataFrame:
    index = _index(s, d)
    one = S.ranked(S.bm25(index, WORDS), c("score"), 100)
    two = S.ranked(S.match(index, S.Query(must=["mangel"])), c("doc"), 100)
    return S.fuse([(one, 1.5), (two, 1.0)]).select("doc", F.round("score", 8).alias("score"), "hits")


@R.add(_BM25 + """, one AS (SELECT doc, row_number() OVER (ORDER BY score, doc) AS rank FROM scored ORDER BY 2 LIMIT 200), f AS (SELECT doc, 1.5 / (60 + rank) AS rrf FROM one)
SELECT doc, round(32 * rrf + CASE WHEN lower(text) LIKE '%mangel sofort%' THEN 1.8 ELSE 0 END + CASE WHEN lang = 'de' THEN 0.5 ELSE 0 END, 6) AS score FROM f JOIN documents ON doc_id = doc ORDER BY 32 * rrf + CASE WHEN lower(text) LIKE '%mangel sofort%' THEN 1.8 ELSE 0 END + CASE WHEN lang = 'de' THEN 0.5 ELSE 0 END DESC, doc LIMIT 30""")
def fts_11_signal_rerank(s: SparkSession, d: str) -> DataFrame:
    index = _index(s, d)
    f = S.fuse([(S.ranked(S.bm25(index, WORDS), c("score"), 200), 1.5)]).select("doc", c("score").alias("rrf"))
    docs = _docs(s, d)
    signals = 32 * c("rrf") + F.when(F.lower("text").contains("mangel sofort"), 1.8).otherwise(0.0) + F.when(c("lang") == "de", 0.5).otherwise(0.0)
    return docs.join(F.broadcast(f), c("doc_id") == c("doc")).select("doc", signals.alias("raw")).orderBy(c("raw").desc(), "doc").limit(30).select("doc", F.round("raw", 6).alias("score"))


@R.add(_BM25 + "SELECT doc FROM (SELECT doc FROM scored ORDER BY score, doc LIMIT 200) JOIN documents ON doc_id = doc WHERE lang = 'de'")
def fts_14_candidate_filter(s: SparkSession, d: str) -> DataFrame:
    index = _index(s, d)
    top = S.bm25(index, WORDS).orderBy("score", "doc").limit(200)
    return _docs(s, d).where("lang = 'de'").select(c("doc_id").alias("doc")).join(F.broadcast(top.select("doc")), "doc", "left_semi")


@R.add(_POSTINGS + "SELECT doc, round(sum(tf::DOUBLE / len * CASE term WHEN 'mangel' THEN 1.0 ELSE 0.5 END), 6) AS score FROM p JOIN sizes USING (doc) WHERE term IN ('mangel', 'gericht') AND tf::DOUBLE / len > 0.01 GROUP BY 1")
def fts_16_sparse(s: SparkSession, d: str) -> DataFrame:
    weights = _index(s, d).postings.where(c("term").isin("mangel", "gericht")).select("doc", c("term").alias("token"), (c("tf").cast("double") / c("len")).alias("weight"))
    return S.sparse(weights, {"mangel": 1.0, "gericht": 0.5}).select("doc", F.round("score", 6).alias("score"))


@R.add("""WITH q AS (SELECT embedding AS e FROM embeddings ORDER BY vec_id LIMIT 1) SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], e::DOUBLE[]) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(e::DOUBLE[], e::DOUBLE[])), 5) AS score FROM embeddings, q ORDER BY list_dot_product(embedding::DOUBLE[], e::DOUBLE[]) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(e::DOUBLE[], e::DOUBLE[])) DESC, vec_id LIMIT 20""")
def fts_17_nearest(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings", "vec_id", "embedding")
    query = list(e.orderBy("vec_id").first()["embedding"])
    return S.nearest(e, "vec_id", "embedding", query, 20).select("vec_id", F.round("score", 5).alias("score"))


@R.add("""WITH q AS (SELECT embedding AS e FROM embeddings ORDER BY vec_id LIMIT 1) SELECT label, round(max(list_dot_product(embedding::DOUBLE[], e::DOUBLE[]) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(e::DOUBLE[], e::DOUBLE[]))), 5) AS best FROM embeddings, q GROUP BY 1""")
def fts_19_best_chunk(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings", "vec_id", "embedding", "label")
    query = list(e.orderBy("vec_id").first()["embedding"])
    return e.groupBy("label").agg(F.round(F.max(S.cosine(c("embedding"), query)), 5).alias("best"))


@R.add("""SELECT DISTINCT decision_id FROM decisions WHERE decision_id = 'gr_gerichte_SR2_02_588' OR docket_number = 'D-5722/2009'""")
def fts_26_lookup(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "docket_number").where((c("decision_id") == "gr_gerichte_SR2_02_588") | (c("docket_number") == "D-5722/2009")).select("decision_id").distinct()
