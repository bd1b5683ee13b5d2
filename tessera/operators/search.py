"""Ranked full-text, sparse and dense retrieval.

Texts become an index that is written once and kept (``build_index``): postings
(doc, field, term, tf, places, len) in runs sorted by term. A query is parsed
on the driver and reads the postings of its few terms, so that only those
travel. Fusion and reranking work on the candidates.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

K1, B = 1.2, 0.75
#: Version of what an index holds; one of another version is built anew.
FORMAT = 3
#: Words whose postings are made at once, texts of a batch, bytes of a row group and rows of a page of the postings.
PIECE, TEXTS, GROUP_BYTES, PAGE_ROWS = 1_000_000, 2_000, 8 << 20, 5_000
#: Letters with marks and what they fold to.
FOLD = ("àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ", "aaaaaaceeeeiiiinoooooouuuuyy")
#: Weights of a hit in a column of the hosted ranking.
COLUMN_WEIGHTS = {"decision_id": 0.8, "court": 0.8, "canton": 0.8, "docket_number": 2.0, "language": 0.8, "title": 6.0, "regeste": 5.0, "full_text": 1.2}


def terms(c: Column) -> Column:
    """The words of a text, in lower case and without marks; null gives none."""
    folded = F.translate(F.lower(F.coalesce(c, F.lit(""))), *FOLD)
    return F.filter(F.split(folded, r"[^\p{L}\p{N}]+"), lambda t: t != "")


_MADE = "field string, term string, tf bigint, places array<int>, len bigint, first boolean"


def _per_row(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The postings of each row by itself, from _words (the words of each of ``columns``); the other columns go with them."""
    n = len(columns)
    for whole in batches:
        at = 0
        sizes = np.concatenate([[0], np.cumsum(pc.list_value_length(whole.column("_words").flatten()).to_numpy(zero_copy_only=False).reshape(-1, n).sum(axis=1))])
        while at < whole.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + PIECE, side="right")) - 1)
            batch = whole.slice(at, end - at)
            at = end
            texts = batch.column("_words").flatten()
            lengths = pc.list_value_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            words = texts.flatten().dictionary_encode()
            unlike = max(1, len(words.dictionary))
            text = np.repeat(np.arange(len(lengths)), lengths)
            group = text * unlike + words.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(group, kind="stable")
            places = (np.arange(len(group)) - (np.cumsum(lengths) - lengths)[text])[order].astype(np.int32)
            group = group[order]
            starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, dtype=np.int64)
            ends = np.append(starts[1:], len(group))[: len(starts)]
            group = group[starts]
            row, field, word = group // unlike // n, group // unlike % n, group % unlike
            first = np.zeros(len(group), dtype=bool)
            first[np.unique(row * unlike + word, return_index=True)[1]] = True
            # in the order of the index
            ranks = [np.argsort(pc.sort_indices(x).to_numpy()) for x in (words.dictionary, batch.column("doc"))]
            by = np.lexsort((ranks[1][row], ranks[0][word]))
            row, field, word, first, starts, ends = (x[by] for x in (row, field, word, first, starts, ends))
            sizes_of = ends - starts
            offsets = np.concatenate([[0], np.cumsum(sizes_of)])
            places = places[np.arange(len(places)) + np.repeat(starts - offsets[:-1], sizes_of)]
            made = {
                "field": pa.array(columns, pa.string()).take(pa.array(field)),
                "term": words.dictionary.take(pa.array(word)),
                "tf": pa.array(sizes_of, pa.int64()),
                "places": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(places, pa.int32())),
                "len": pa.array(lengths.reshape(-1, n).sum(axis=1)[row], pa.int64()),
                "first": pa.array(first),
            }
            kept = {c: batch.column(c).take(pa.array(row)) for c in batch.schema.names if c != "_words"}
            yield pa.RecordBatch.from_pydict(kept | made)


def _flagged(df: DataFrame, id_column: str, columns: list[str], version: list[str] | None = None) -> DataFrame:
    """``postings``, with ``first``: true for one of a document's fields that hold the term.

    A row's postings are made where it is read and stay there. Only those of
    documents that have several rows meet by a shuffle; a Bloom filter tells them.
    """
    from tessera.operators.bloom import Bloom
    from tessera.session import materialize

    key = F.struct(*version).alias("version") if version else F.lit(0).alias("version")
    rows = df.select(F.col(id_column).alias("doc"), key, *columns)
    repeated = materialize(rows.groupBy("doc").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("doc").isNull()).select("doc"), "repeated")
    several = repeated.count()

    def made(some: DataFrame, *keys: str) -> DataFrame:
        split = some.select(*keys, F.array(*[terms(F.col(c)) for c in columns]).alias("_words"))
        head = [f for f in split.schema if f.name in keys]
        return split.mapInArrow(lambda batches: _per_row(batches, columns), StructType(head + StructType.fromDDL(_MADE).fields))

    if not several:
        return made(rows, "doc")
    told = rows.withColumn("_several", F.coalesce(Bloom(repeated, "doc", several).might_hold(F.col("doc")), F.lit(True)))
    alone = made(told.where(~F.col("_several")), "doc")
    merged = made(told.where("_several"), "doc", "version").groupBy("doc", "version", "field", "term").agg(F.sum("tf").alias("tf"), F.array_sort(F.flatten(F.collect_list("places"))).alias("places"), F.max("len").alias("len"))
    if version:
        least = told.where("_several").groupBy("doc").agg(F.min("version").alias("version"))
        merged = merged.join(least, ["doc", "version"], "left_semi")
    merged = merged.withColumn("first", F.row_number().over(Window.partitionBy("doc", "term").orderBy("field")) == 1)
    return alone.unionByName(merged.drop("version").sortWithinPartitions("term", "doc"))


def postings(df: DataFrame, id_column: str, columns: list[str], version: list[str] | None = None) -> DataFrame:
    """doc, field, term, tf, places (sorted positions), len (words of the document): one row for each document, field and term.

    With ``version``, several rows of one document count as the one whose
    ``version`` columns are least; without it they are taken together, and
    ``len`` is that of the longest. Words travel, whole texts don't.
    """
    return _flagged(df, id_column, columns, version).drop("first")


@dataclass
class Index:
    """A kept index: postings in the order of their terms, the frequency of each term, and the corpus's size."""

    postings: DataFrame  # doc, field, term, tf, places, len
    terms: DataFrame  # field ("" for all together), term, df, tf
    n: int
    average: float


_TERMS = "field string, term string, df bigint, tf bigint"


def build_index(df: DataFrame, id_column: str, columns: list[str], path: str, version: list[str] | None = None, partitions: int | None = None) -> None:
    """Write an index of ``columns`` to ``path``, in place of any that is there.

    The texts are read once. The postings carry their document's length and
    stay in the partition of their text, as runs of up to ``TEXTS`` texts or
    ``PIECE`` words that are sorted by term, so that a query's filter on its
    terms reads the pages of those terms alone; a term in very many documents
    is spread over the runs. Of documents with one row nothing but counts of
    terms is shuffled, and no second copy is written. ``partitions`` are those
    of the terms. The last thing written is ``meta``, without which there is no
    index.
    """
    from tessera.session import materialize

    spark = df.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, str(TEXTS))
    try:
        _flagged(df, id_column, columns, version).write.mode("overwrite").options(**{"compression": "zstd", "parquet.block.size": str(GROUP_BYTES), "parquet.page.row.count.limit": str(PAGE_ROWS)}).parquet(f"{path}/postings")
    finally:
        spark.conf.set(batch, before)
    rows = spark.read.parquet(f"{path}/postings")
    by_field = materialize(rows.groupBy("field", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"), F.count_if("first").alias("docs")), "terms")
    everywhere = by_field.groupBy("term").agg(F.sum("docs").alias("df"), F.sum("tf").alias("tf")).select(F.lit("").alias("field"), "term", "df", "tf")
    both = by_field.drop("docs").unionByName(everywhere)
    both.repartitionByRange(n, "term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")
    held = df.select(F.count_distinct(F.col(id_column)).alias("n")).first()["n"]
    words = spark.read.schema(_TERMS).parquet(f"{path}/terms").where("field = ''").agg(F.sum("tf")).first()[0] or 0
    spark.createDataFrame([(held, words / held if held else 0.0)], "n bigint, average double").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def open_index(spark: SparkSession, path: str) -> Index:
    """The index that ``build_index`` wrote to ``path``."""
    meta = spark.read.schema("n bigint, average double").parquet(f"{path}/meta").first()
    return Index(spark.read.parquet(f"{path}/postings").drop("first"), spark.read.schema(_TERMS).parquet(f"{path}/terms"), meta["n"], meta["average"])


def kept_index(df: DataFrame, name: str, id_column: str, columns: list[str], version: list[str] | None = None) -> Index:
    """The index of ``df``, kept in the shared folder and built where there is none yet for the files that ``df`` reads as they now are."""
    from tessera.session import exists, files_of, rename, scratch, shared_dir

    spark = df.sparkSession
    mark = hashlib.md5(repr((FORMAT, name, id_column, columns, version, files_of(df))).encode()).hexdigest()[:16]
    path = f"{shared_dir(spark)}/index-{name}-{mark}"
    if not exists(spark, f"{path}/meta/_SUCCESS"):
        fresh = scratch(spark, "index")
        build_index(df, id_column, columns, fresh, version)
        if not rename(spark, fresh, path) and not exists(spark, f"{path}/meta/_SUCCESS"):
            return open_index(spark, fresh)
    return open_index(spark, path)


@dataclass
class Query:
    """Words that must, may or must not occur, phrases, prefixes and the fields that count."""

    must: list[str] = field(default_factory=list)
    may: list[str] = field(default_factory=list)
    never: list[str] = field(default_factory=list)
    phrases: list[list[str]] = field(default_factory=list)
    prefixes: list[str] = field(default_factory=list)
    focus: str | None = None


def _fold(word: str) -> str:
    return word.lower().translate(str.maketrans(*FOLD))


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[^\w]+|_", _fold(text)) if w]


def parse(text: str) -> Query:
    """A query of words, OR between two of them, NOT, "phrases", prefix* and field:.

    Operators without two operands are ordinary words, and so are hyphens, dots
    and unbalanced quotes; an empty query matches nothing.
    """
    q = Query()
    m = re.match(r"^\s*(\w+):(?!\s*$)", text)
    if m:
        q.focus, text = m.group(1), text[m.end() :]
    tokens = re.findall(r'"[^"]*"|\S+', text)
    i, either = 0, False
    while i < len(tokens):
        t = tokens[i]
        last = i + 1 >= len(tokens)
        if t == "OR" and i and not last and re.search(r"\w", tokens[i + 1]):
            either = True
            if q.must and not q.may:
                q.may.append(q.must.pop())
        elif t == "NOT" and not last:
            q.never += _words(tokens[i + 1])
            i += 1
        elif t == "AND" and i and not last:
            pass
        elif t.startswith('"') and t.endswith('"') and len(t) > 1:
            if words := _words(t):
                q.phrases.append(words)
        elif t.endswith("*") and _words(t):
            q.prefixes.append(_words(t)[-1])
            q.must += _words(t)[:-1]
        else:
            (q.may if either else q.must).extend(_words(t))
            either = False
        i += 1
    return q


def match(index: Index, q: Query) -> DataFrame:
    """doc of every document that the query matches."""
    rows = index.postings.where(F.col("field") == q.focus) if q.focus else index.postings
    need: list[DataFrame] = []
    if q.must:
        hit = rows.where(F.col("term").isin(q.must)).groupBy("doc").agg(F.countDistinct("term").alias("n"))
        need.append(hit.where(F.col("n") == len(set(q.must))).select("doc"))
    if q.may:
        need.append(rows.where(F.col("term").isin(q.may)).select("doc").distinct())
    need += [rows.where(F.col("term").startswith(p)).select("doc").distinct() for p in q.prefixes]
    for phrase in q.phrases:
        first = rows.where(F.col("term") == phrase[0]).select("doc", "field", F.explode("places").alias("place"))
        for n, word in enumerate(phrase[1:], 1):
            nxt = rows.where(F.col("term") == word).select("doc", "field", F.explode(F.transform("places", lambda x: x - n)).alias("place"))
            first = first.join(nxt, ["doc", "field", "place"])
        need.append(first.select("doc").distinct())
    if not need:
        return index.postings.select("doc").limit(0)
    out = need[0]
    for other in need[1:]:
        out = out.join(other, "doc", "left_semi")
    if q.never:
        out = out.join(rows.where(F.col("term").isin(q.never)).select("doc"), "doc", "left_anti")
    return out


def bm25(index: Index, words: list[str], weights: dict[str, float] | None = None, focus: str | None = None) -> DataFrame:
    """doc, score of every document with one of ``words``; smaller is better, as with a rank.

    A column's weight multiplies its term frequencies. The statistics are those
    of all documents; of the postings only those of the words are read.
    """
    asked = sorted(set(words))
    df = {r["term"]: r["df"] for r in index.terms.where(F.col("term").isin(asked) & (F.col("field") == (focus or ""))).collect()}
    weight = F.coalesce(*[F.when(F.col("field") == f, F.lit(float(w))) for f, w in (weights or {}).items()], F.lit(1.0))
    rows = index.postings.where(F.col("term").isin(asked))
    tf = (rows.where(F.col("field") == focus) if focus else rows).groupBy("doc", "term", "len").agg(F.sum(F.col("tf") * weight).alias("tf"))
    idf = F.coalesce(*[F.when(F.col("term") == t, F.lit(max(1e-6, log((index.n - k + 0.5) / (k + 0.5))))) for t, k in df.items()], F.lit(0.0))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / (index.average or 1.0)))
    return tf.groupBy("doc").agg((-F.sum(part)).alias("score"))


def fuse(lists: list[tuple[DataFrame, float]], k: int = 60) -> DataFrame:
    """doc, score, hits: reciprocal rank fusion of (doc, rank) lists with weights."""
    every = None
    for ranked, weight in lists:
        one = ranked.select("doc", (F.lit(weight) / (k + F.col("rank"))).alias("s"))
        every = one if every is None else every.unionByName(one)
    return every.groupBy("doc").agg(F.sum("s").alias("score"), F.count("*").alias("hits"))


def ranked(scored: DataFrame, by: Column, top: int) -> DataFrame:
    """doc, rank of the best ``top``; ties go to the smallest doc."""
    best = scored.orderBy(by, "doc").limit(top)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(by, "doc")))


def interleaved(lists: dict[str, DataFrame], top: int) -> DataFrame:
    """corpus, rank, doc: the ``top`` best of each (doc, score; smaller is better), by rank and then by corpus; ties go to the smallest doc."""
    every = None
    for name, scored in lists.items():
        one = ranked(scored, F.col("score"), top).select(F.lit(name).alias("corpus"), "rank", "doc")
        every = one if every is None else every.unionByName(one)
    return every.orderBy("rank", "corpus")


def sparse(index: DataFrame, query: dict[str, float], least: float = 0.01) -> DataFrame:
    """doc, score: inner products with a sparse query over (doc, token, weight)."""
    w = F.coalesce(*[F.when(F.col("token") == t, F.lit(float(x))) for t, x in query.items()], F.lit(0.0))
    return index.where((F.col("weight") > least) & F.col("token").isin(list(query))).groupBy("doc").agg(F.sum(F.col("weight") * w).alias("score"))


def cosine(vector: Column, query: list[float]) -> Column:
    """Cosine of an array column and a vector; null for a null or zero vector, or another width."""
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(vector, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    size = sum(x * x for x in query) ** 0.5
    return F.when((F.size(vector) == len(query)) & (norm > 0) & F.lit(size > 0), dot / (norm * F.lit(size or 1.0)))


def nearest(df: DataFrame, id_column: str, vector: str, query: list[float], top: int, partition: str | None = None, value=None) -> DataFrame:
    """id_column, score: the ``top`` nearest by cosine, exactly; a partition column is pruned first."""
    rows = df.where(F.col(partition) == value) if partition else df
    return rows.select(id_column, cosine(F.col(vector), query).alias("score")).where(F.col("score").isNotNull()).orderBy(F.col("score").desc(), id_column).limit(top)


def tuned(index: Index, asked: list[tuple[str, str]], grid: list[dict[str, float]], k: int = 10) -> DataFrame:
    """weights, mrr of each of ``grid``, the best first: how high the documents of ``asked`` (query, doc) stand. One small job for each query and weights."""
    out = []
    for weights in grid:
        total = 0.0
        for text, doc in asked:
            found = [r["doc"] for r in bm25(index, _words(text), weights).orderBy("score", "doc").limit(k).collect()]
            total += 1 / (found.index(doc) + 1) if doc in found else 0.0
        out.append((",".join(f"{f}={w}" for f, w in sorted(weights.items())), total / max(1, len(asked))))
    return index.postings.sparkSession.createDataFrame(sorted(out, key=lambda x: (-x[1], x[0])), "weights string, mrr double")


def condense(text: str, most: int = 250) -> str:
    """A long text as a query: its references first, then its commonest longer words."""
    refs = re.findall(r"(?:BGE|ATF|DTF) \d+ [IVX]+ \d+|\d[A-Z][_.]\d+/\d{4}|[Aa]rt\. \d+\w* [A-Z]\w+", text)
    seen: dict[str, int] = {}
    for w in _words(text):
        if len(w) > 5:
            seen[w] = seen.get(w, 0) + 1
    out: list[str] = []
    for part in [*dict.fromkeys(refs), *sorted(seen, key=lambda w: (-seen[w], w))]:
        if len(" ".join([*out, part])) > most:
            break
        out.append(part)
    return " ".join(out)


#: A docket and nothing else.
DOCKET_INTENT = r"^\s*(?:\d[A-Z][_. ]\d{1,5}/\d{4}|[A-F]-\d{1,5}/\d{4}|[A-Z]{2}[. ]\d{4}[. ]\d{1,5})\s*$"


def docket_intent(text: str) -> bool:
    """True if a query is a docket and nothing else."""
    return re.match(DOCKET_INTENT, text) is not None
