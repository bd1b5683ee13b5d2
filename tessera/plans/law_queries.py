"""Queries of law texts, dispatches, harvests and the stores made of them. Their inputs are written from the driver's tables first."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tessera.functions import extract as E
from tessera.plans.registry import Registry
from tessera.session import scratch
from tessera.sources import laws as L
from tessera.sources import readers
from tessera.sources.tables import table

R = Registry()
c = F.col


def _folder(s: SparkSession) -> str:
    return scratch(s, "io")


def _rows(*names: str) -> ArrayType:
    return ArrayType(StructType([StructField(n, StringType()) for n in names]))


@R.add("SELECT p_partkey, p_name || ' ' || p_type AS text FROM part")
def src_16_xml_text(s: SparkSession, d: str) -> DataFrame:
    """The text of XML without its notes."""
    xml = F.concat(F.lit("<article><num>"), c("p_name"), F.lit("<footnote>a note</footnote> </num><p>"), c("p_type"), F.lit("</p></article>"))
    return table(s, d, "part", "p_partkey", "p_name", "p_type").select("p_partkey", E.as_udf(L.xml_text, StringType())(xml).alias("text"))


@R.add("""SELECT r_name || ' / Art. ' || n_nationkey || ' ' || n_name AS path, n_nationkey::VARCHAR AS anchor, 'On ' || n_name AS text FROM nation JOIN region ON n_regionkey = r_regionkey""")
def src_17_dispatch_paragraphs(s: SparkSession, d: str) -> DataFrame:
    """Paragraphs of dispatches, one for each region, with the headings above them."""
    out = _folder(s)
    section = F.concat(F.lit("<section><heading>Art. "), c("n_nationkey").cast("string"), F.lit(" "), c("n_name"), F.lit("</heading><p>On "), c("n_name"), F.lit("<authorialNote>x</authorialNote></p></section>"))
    n = table(s, d, "nation", "n_nationkey", "n_name", "n_regionkey").join(table(s, d, "region", "r_regionkey", "r_name"), c("n_regionkey") == c("r_regionkey"))
    n.groupBy("r_name").agg(F.array_join(F.collect_list(section), "").alias("x")).select(F.concat(F.lit("<doc><heading>"), c("r_name"), F.lit("</heading>"), c("x"), F.lit("</doc>")).alias("value")).repartition(5).write.text(out)
    docs = s.read.option("wholetext", "true").text(out).where(F.length("value") > 0).select(F.explode(F.split("value", r"(?<=</doc>)\n")).alias("x")).where(F.length(F.trim("x")) > 0)
    return docs.select(F.explode(E.as_udf(L.dispatch_paragraphs, _rows("path", "anchor", "text"))(c("x"))).alias("p")).select("p.*")


@R.add("SELECT volume, first_page::VARCHAR AS number, division AS heading, 'Page ' || first_page || ' of ' || decision_id || '.' AS text FROM bge_register")
def src_32_segmented_laws(s: SparkSession, d: str) -> DataFrame:
    """Plain law texts, one for each volume of the register, cut into articles."""
    article = F.concat(F.lit("Art. "), c("first_page").cast("string"), F.lit(" "), c("division"), F.lit("\nPage "), c("first_page").cast("string"), F.lit(" of "), c("decision_id"), F.lit("."))
    texts = table(s, d, "bge_register", "volume", "division", "first_page", "decision_id").groupBy("volume").agg(F.array_join(F.array_sort(F.collect_list(article)), "\n").alias("t"))
    return texts.select("volume", F.explode(E.as_udf(L.segmented, _rows("number", "heading", "text"))(c("t"))).alias("a")).select("volume", "a.*")


@R.add("SELECT bge_reference, 'Text of ' || decision_id AS text FROM bge_register")
def src_33_html_articles(s: SparkSession, d: str) -> DataFrame:
    """One article cut out of the page of its volume."""
    register = table(s, d, "bge_register", "bge_reference", "volume", "division", "first_page", "decision_id").withColumn("number", F.concat_ws("_", "division", "first_page"))
    part = F.concat(F.lit('<article id="art_'), c("number"), F.lit('"><b>Text</b> of '), c("decision_id"), F.lit("</article>"))
    pages = register.groupBy("volume").agg(F.concat(F.lit("<html>"), F.array_join(F.collect_list(part), "\n"), F.lit("</html>")).alias("page"))

    @F.pandas_udf("string")
    def cut(page: pd.Series, number: pd.Series) -> pd.Series:
        return pd.Series([L.html_article(p, n) for p, n in zip(page, number)])

    return register.join(pages, "volume").select("bge_reference", cut("page", "number").alias("text"))


@R.add("""WITH n AS (SELECT canton, count(*) FILTER (WHERE source = 'federal_feed') AS a, count(*) FILTER (WHERE coalesce(source, '') <> 'federal_feed') AS b FROM decisions GROUP BY 1) SELECT canton, count(*) AS n, a > 0 AND a * 5.0 < b AS suspect FROM decisions JOIN n USING (canton) WHERE a = 0 OR source = 'federal_feed' GROUP BY ALL""")
def src_31_source_override(s: SparkSession, d: str) -> DataFrame:
    """A canton with any record of the first source keeps only those."""
    rows = table(s, d, "decisions", "decision_id", "canton", "source")
    return L.overridden(rows, "canton", F.coalesce(c("source") == "federal_feed", F.lit(False))).groupBy("canton", "suspect").agg(F.count("*").alias("n"))


_KEYS = """SELECT DISTINCT decision_id AS id, unnest([CASE WHEN decision_id <> '' THEN 'id:' || decision_id END, CASE WHEN court <> '' AND source_id <> '' THEN 's:' || court || '|' || source_id END, CASE WHEN court <> '' AND docket_number <> '' AND decision_date <> '' THEN 'd:' || court || '|' || docket_number || '|' || decision_date END, CASE WHEN coalesce(decision_date, '') = '' AND court <> '' AND docket_number <> '' THEN 'u:' || court || '|' || docket_number END]) AS key FROM decisions WHERE """
_EARLY = "scraped_at < TIMESTAMP '2023-12-01'"


@R.add(f"SELECT count(*) AS n, count(DISTINCT key) AS keys FROM ({_KEYS} true) WHERE key IS NOT NULL")
def src_30_known_keys(s: SparkSession, d: str) -> DataFrame:
    return L.known_keys(_keyed(s, d)).agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))


def _keyed(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "court", "source_id", "docket_number", "decision_date", "scraped_at").toDF("id", "court", "source_id", "docket", "day", "scraped_at")


@R.add(f"WITH e AS ({_KEYS} {_EARLY}), i AS ({_KEYS} NOT ({_EARLY})) SELECT DISTINCT id FROM i WHERE id NOT IN (SELECT id FROM i WHERE key IN (SELECT key FROM e WHERE key IS NOT NULL))")
def src_29_unseen_records(s: SparkSession, d: str) -> DataFrame:
    """Records of a later archive that no source has brought before."""
    rows = _keyed(s, d)
    early = c("scraped_at") < F.lit("2023-12-01").cast("timestamp_ntz")
    return L.unseen(rows.where(~early), rows.where(early))


class SupplierHarvest:
    """A harvest of the supplier table: sets by nation, pages of five, every tenth record deleted, a control character in each name."""

    def __init__(self, options: dict[str, str]) -> None:
        import pyarrow.parquet as pq

        self.rows = pq.read_table(options["file"], columns=["s_suppkey", "s_name", "s_nationkey"]).to_pylist()

    def sets(self) -> list:
        return sorted({r["s_nationkey"] for r in self.rows})

    def page(self, one_set: object, token: str | None) -> str:
        own = [r for r in self.rows if r["s_nationkey"] == one_set]
        at = int(token or 0)
        body = "".join(
            f"<record><header{' status=\"deleted\"' if r['s_suppkey'] % 10 == 0 else ''}><identifier>{r['s_suppkey']}</identifier></header><metadata><dc xmlns='urn:dc'><title>{r['s_name']}\x0b</title></dc></metadata></record>"
            for r in own[at : at + 5]
        )
        more = f"<resumptionToken>{at + 5}</resumptionToken>" if at + 5 < len(own) else "<resumptionToken/>"
        return f"<OAI-PMH><ListRecords>{body}{more}</ListRecords></OAI-PMH>"


@R.add("SELECT s_suppkey::VARCHAR AS identifier, s_name AS title FROM supplier WHERE s_suppkey % 10 <> 0")
def src_24_harvest(s: SparkSession, d: str) -> DataFrame:
    """Records harvested by set and resumption token; deleted ones are left out."""
    readers.register_paged(s)
    reader = s.read.format("paged").option("service", "tessera.sources.laws:Harvest").option("client", "tessera.plans.law_queries:SupplierHarvest")
    return reader.option("columns", "identifier string, title string").option("fields", "identifier,title").option("file", f"{d}/supplier.parquet").load()


class OrderBindings:
    """Query results over the orders table: pages of fifty for each year, in the order of the keys.

    The file is read in batches; what is held are the keys of the year whose
    pages are asked for. Unknown values are left out of a binding.
    """

    size = 50

    def __init__(self, options: dict[str, str]) -> None:
        self.file = options["file"]
        self.held: tuple[object, pa.Array] | None = None

    def _batches(self, *columns: str) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        return ds.dataset(self.file).scanner(columns=list(columns), batch_size=1 << 16, batch_readahead=1, fragment_readahead=1).to_batches()

    def years(self) -> list:
        seen: set = set()
        for batch in self._batches("o_orderdate"):
            seen.update(pc.unique(pc.year(batch.column("o_orderdate"))).to_pylist())
        return sorted(seen, key=lambda y: (y is None, y))

    def _keys(self, year: object) -> pa.Array:
        if self.held is None or self.held[0] != year:
            parts = []
            for batch in self._batches("o_orderkey", "o_orderdate"):
                of = pc.year(batch.column("o_orderdate"))
                parts.append(batch.column("o_orderkey").filter(pc.is_null(of) if year is None else pc.equal(of, year)))
            keys = pa.chunked_array(parts, parts[0].type).combine_chunks() if parts else pa.array([], pa.int64())
            self.held = (year, keys.take(pc.sort_indices(keys)))
        return self.held[1]

    def page(self, year: object, offset: int) -> str:
        of = {} if year is None else {"year": {"value": str(year)}}
        own = self._keys(year).slice(offset, self.size).to_pylist()
        return json.dumps({"results": {"bindings": [({} if k is None else {"key": {"value": str(k)}}) | of for k in own]}})


@R.add("SELECT o_orderkey::VARCHAR AS key, year(o_orderdate)::VARCHAR AS year FROM orders")
def src_23_pages_by_year(s: SparkSession, d: str) -> DataFrame:
    """Query bindings, year by year, until a short page."""
    readers.register_paged(s)
    reader = s.read.format("paged").option("service", "tessera.sources.laws:YearlyBindings").option("client", "tessera.plans.law_queries:OrderBindings")
    return reader.option("columns", "key string, year string").option("fields", "key,year").option("file", f"{d}/orders.parquet").load()


@R.add("SELECT n_nationkey, n_name || chr(10) || n_nationkey AS text FROM nation")
def src_18_pdf_pages(s: SparkSession, d: str) -> DataFrame:
    """Pages of PDF files, one file for each nation."""
    import zlib

    from tessera.session import _path

    out = _folder(s)
    # a fixed table of a few rows
    for r in table(s, d, "nation", "n_nationkey", "n_name").collect():
        body = zlib.compress(f"BT /F1 12 Tf ({r['n_name']}) Tj T* [({r['n_nationkey']})] TJ ET".encode("latin-1"))
        pdf = b"%PDF-1.4\n1 0 obj\n<< /Length " + str(len(body)).encode() + b" /Filter /FlateDecode >>\nstream\n" + body + b"\nendstream\nendobj\n%%EOF"
        fs, p = _path(s, f"{out}/{r['n_nationkey']}.pdf")
        stream = fs.create(p)
        stream.write(bytearray(pdf))
        stream.close()
    files = s.read.format("binaryFile").load(out)
    pages = E.as_udf(L.pdf_pages, ArrayType(StringType()))
    return files.select(F.regexp_extract("path", r"(\d+)\.pdf$", 1).cast("int").alias("n_nationkey"), F.explode(pages(c("content"))).alias("text"))


@R.add("SELECT b.volume, division, first_page, n FROM bge_register b LEFT JOIN (SELECT volume, count(*) AS n FROM bge_register WHERE division <> 'V' GROUP BY 1) l USING (volume)")
def snk_25_legislation_export(s: SparkSession, d: str) -> DataFrame:
    """Articles with their law's facts, also those of laws that are missing, as Parquet."""
    out = _folder(s)
    articles = table(s, d, "bge_register", "volume", "division", "first_page")
    law = articles.where("division <> 'V'").groupBy("volume").agg(F.count("*").alias("n"))
    articles.join(law, "volume", "left").write.option("compression", "zstd").parquet(out)
    return s.read.parquet(out)


@R.add("""WITH f AS (SELECT decision_id, max(scraped_at) AS t FROM decisions WHERE decision_id IS NOT NULL GROUP BY 1), l AS (SELECT d.decision_id, max(source) AS source, max(scraped_at) AS t FROM decisions d JOIN f ON f.decision_id = d.decision_id AND f.t IS NOT DISTINCT FROM d.scraped_at GROUP BY 1) SELECT coalesce(source, '') AS source, count(*) AS n, strftime(max(t), '%Y-%m-%d') AS newest FROM l GROUP BY 1""")
def snk_31_store_with_catalog(s: SparkSession, d: str) -> DataFrame:
    """A store in which the last write of a record wins, and its catalog by source."""
    out = _folder(s)
    rows = table(s, d, "decisions", "decision_id", "source", "scraped_at").where(c("decision_id").isNotNull())
    rows.groupBy("decision_id").agg(F.max(F.struct("scraped_at", "source")).alias("l")).select("decision_id", "l.*").write.parquet(out)
    return s.read.parquet(out).groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"), F.date_format(F.max("scraped_at"), "yyyy-MM-dd").alias("newest"))


@R.add("SELECT doc_id, min(kind) AS kind FROM (SELECT doc_id, CASE WHEN doc_kind = 'headnote' THEN 1 ELSE 2 END AS kind FROM documents UNION ALL SELECT vec_id, 3 FROM embeddings) GROUP BY 1")
def snk_33_union_store(s: SparkSession, d: str) -> DataFrame:
    """Sources in their order; the first that has a record gives it."""
    from tessera.operators.joins import key_index

    docs, more = table(s, d, "documents", "doc_id", "doc_kind"), table(s, d, "embeddings", "vec_id").toDF("doc_id")
    parts = [docs.where("doc_kind = 'headnote'"), docs.where("doc_kind <> 'headnote' or doc_kind is null"), more]
    keyed = [p.select(c("doc_id").cast("string").alias("k"), F.lit("").alias("v")) for p in parts]
    return key_index(keyed, "k", "v").select(c("key").cast("bigint").alias("doc_id"), (c("rank") + 1).alias("kind"))


@R.add("SELECT count(*) AS rows, count(DISTINCT volume) AS laws, count(*) FILTER (WHERE division = 'I') AS first FROM bge_register")
def snk_35_statute_store(s: SparkSession, d: str) -> DataFrame:
    """Laws in XML read into a store of articles."""
    out = _folder(s)
    article = F.concat(F.lit('<article eId="x"><num>Art. '), c("first_page").cast("string"), F.lit("</num><heading>"), c("division"), F.lit("</heading><paragraph><num>1</num><content><p>"), c("volume").cast("string"), F.lit("</p></content></paragraph></article>"))
    # the register is of a fixed size, so that it makes one document
    table(s, d, "bge_register", "volume", "division", "first_page").agg(F.array_join(F.collect_list(article), "").alias("x")).select(F.concat(F.lit("<law>"), c("x"), F.lit("</law>")).alias("value")).write.text(f"{out}/xml")
    readers.xml_articles(s, f"{out}/xml").write.parquet(f"{out}/store")
    return s.read.parquet(f"{out}/store").agg(F.count("*").alias("rows"), F.countDistinct("text").alias("laws"), F.count_if(c("heading") == "I").alias("first"))


@R.add("SELECT target_ref FROM citation_gaps WHERE starts_with(target_ref, 'BGE ') AND target_ref NOT IN (SELECT bge_reference FROM bge_register)")
def join_26_missing_documents(s: SparkSession, d: str) -> DataFrame:
    gaps = table(s, d, "citation_gaps", "target_ref").where(c("target_ref").startswith("BGE "))
    return gaps.join(table(s, d, "bge_register", "bge_reference").toDF("target_ref"), "target_ref", "left_anti")
