"""Queries that write driver tables with a sink and read them back with a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import extract_queries
from tessera.plans.registry import Registry
from tessera.session import scratch
from tessera.sources import readers, writers
from tessera.sources.tables import table

R = Registry()
c = F.col


def _folder(s: SparkSession) -> str:
    return scratch(s, "io")


@R.add("""SELECT doc_id, lang, n_chars FROM documents""")
def src_01_jsonl_scan(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    table(s, d, "documents", "doc_id", "lang", "n_chars").write.json(out)
    return readers.jsonl(s, out, "doc_id bigint, lang string, n_chars bigint").where("_bad is null").select("doc_id", "lang", "n_chars")


@R.add("""SELECT c_custkey, c_name FROM customer""")
def src_02_parquet_shards(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    df = table(s, d, "customer", "c_custkey", "c_name")
    df.where("c_custkey % 2 = 0").write.parquet(f"{out}/a")
    df.where("c_custkey % 2 = 1").write.parquet(f"{out}/b")
    return readers.parquet_shards(s, out)


@R.add("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'direct' ELSE 'mirror' END AS shard FROM documents""")
def src_08_first_source_wins(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    df = table(s, d, "documents", "doc_id")
    df.where("doc_id % 2 = 0").withColumn("shard", F.lit("direct")).write.json(f"{out}/direct")
    df.withColumn("shard", F.lit("mirror")).write.json(f"{out}/es_mirror")
    return readers.by_priority(readers.jsonl(s, [f"{out}/direct", f"{out}/es_mirror"], "doc_id bigint, shard string"), "doc_id")


@R.add("""SELECT event_type AS endpoint, count(*) AS n, sum(event_id % 1000)::BIGINT AS bytes, max(least(60000, round(round(value, 3) * 1000)))::INT AS slowest FROM events WHERE ts::DATE = DATE '2024-01-15' AND value >= 0 GROUP BY 1""")
def src_11_access_log(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), c("user_id").cast("string"), c("event_type"), F.lit("GET"), F.lit("200"), F.round("value", 3).cast("decimal(20,3)").cast("string"), (c("event_id") % 1000).cast("string"), F.substring(F.sha2(c("user_id").cast("string"), 256), 1, 8))
    table(s, d, "events").where("value >= 0").select(line.alias("value")).write.option("compression", "gzip").text(out)
    return readers.access_log(s, out, "2024-01-15").where(c("endpoint").isNotNull()).groupBy("endpoint").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.max("latency_ms").alias("slowest"))


@R.add("""SELECT bge_reference AS number, 'Heading ' || volume AS heading, 'Page ' || first_page AS text FROM bge_register""")
def src_14_xml_articles(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    xml = F.concat(F.lit("<article eId=\"x\"><num>Art. "), c("bge_reference"), F.lit("</num><heading>Heading "), c("volume").cast("string"), F.lit("</heading><paragraph><num>1</num><content><p>Page "), c("first_page").cast("string"), F.lit("</p></content></paragraph></article>"))
    # the register is of a fixed size, so that it makes one document
    articles = F.array_join(F.collect_list(xml), "")
    table(s, d, "bge_register").agg(F.concat(F.lit("<law>"), articles, F.lit("</law>")).alias("value")).write.text(out)
    return readers.xml_articles(s, out)


@R.add("""SELECT court, count(*) AS n FROM decisions GROUP BY 1""")
def snk_01_by_court(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    writers.by_partition(table(s, d, "decisions", "decision_id", "court", "title"), out, "court")
    return s.read.parquet(out).groupBy("court").agg(F.count("*").alias("n"))


@R.add("""SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN upper(n_name) || '*' ELSE n_name END AS n_name FROM nation""")
def snk_07_append_with_replace(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    df = table(s, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    fresh = df.where("n_regionkey = 1").select("n_nationkey", F.concat(F.upper("n_name"), F.lit("*")).alias("n_name"))
    df.select("n_nationkey", "n_name").write.parquet(f"{out}/day")
    writers.replace_rows(s, f"{out}/day", fresh, "n_nationkey", f"{out}/next")
    return s.read.parquet(f"{out}/next")


@R.add("""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1""")
def snk_08_monthly_compaction(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    writers.monthly(table(s, d, "orders", "o_orderkey", "o_orderdate"), out, "o_orderdate")
    return s.read.schema("o_orderkey bigint, o_orderdate timestamp_ntz, month string").parquet(out).groupBy("month").agg(F.count("*").alias("n"))


@R.add("""SELECT s_suppkey, s_name FROM supplier""")
def snk_15_versioned_snapshot(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    df = table(s, d, "supplier", "s_suppkey", "s_name")
    writers.snapshot(df.where("s_suppkey > 1"), out, 1, "s_name")
    writers.snapshot(df, out, 2, "s_name")
    return writers.current(s, out)


@R.add()
def snk_21_bibtex_and_ris(s: SparkSession, d: str) -> DataFrame:
    cols = {"id": c("decision_id"), "court": c("court"), "docket": c("docket_number"), "date": c("decision_date"), "url": c("source_url")}
    return table(s, d, "decisions", "decision_id", "court", "docket_number", "decision_date", "source_url").select("decision_id", writers.bibtex(cols).alias("bibtex"), writers.ris(cols).alias("ris"))


@R.add("""SELECT source_decision_id AS source, target_ref AS ref, sum(mention_count)::BIGINT AS mentions FROM decision_citations WHERE target_ref IS NOT NULL AND source_decision_id IS NOT NULL GROUP BY 1, 2""")
def snk_05_graph_export(s: SparkSession, d: str) -> DataFrame:
    from tessera.operators import graph

    out = _folder(s)
    graph.edges(table(s, d, "decision_citations").where("target_ref is not null and source_decision_id is not null")).write.option("compression", "zstd").parquet(f"{out}/edges")
    return s.read.parquet(f"{out}/edges").select("source", "ref", "mentions")


@R.add()
def snk_06_structure_export(s: SparkSession, d: str) -> DataFrame:
    from tessera.functions import extract

    out = _folder(s)
    found = table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull()).select("doc_id", extract.sections_udf()(c("text")).alias("s"))
    found.select("doc_id", *[F.coalesce(c(f"s.{k}") != "", F.lit(False)).alias(f"has_{k}") for k in ("facts", "reasons", "orders")], "s.method").write.option("compression", "zstd").parquet(out)
    return s.read.parquet(out)


@R.add("""SELECT decision_id, decision_date FROM (SELECT DISTINCT decision_id, decision_date FROM decisions) WHERE decision_id NOT IN (SELECT decision_id FROM decisions WHERE scraped_at < TIMESTAMP '2023-12-01')""")
def snk_10_delta_bundle(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    rows = table(s, d, "decisions", "decision_id", "decision_date", "scraped_at")
    old = rows.where(c("scraped_at") < F.lit("2023-12-01").cast("timestamp_ntz")).select("decision_id")
    rows.select("decision_id", "decision_date").distinct().join(old, "decision_id", "left_anti").sortWithinPartitions("decision_date", "decision_id").write.option("compression", "zstd").parquet(out)
    return s.read.parquet(out)


@R.add("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 30""")
def snk_19_feed(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "orders", "o_orderkey", "o_totalprice", "o_orderdate").orderBy(c("o_orderdate").desc(), c("o_orderkey").desc()).limit(30)
    page = [{"title": str(r["o_totalprice"]), "link": f"https://example.org/{r['o_orderkey']}", "date": str(r["o_orderdate"])} for r in rows.collect()]
    for made in (writers.rss(page, "Orders", "https://example.org"), writers.atom(page, "Orders", "https://example.org")):
        if made.count("https://example.org/") < len(page):
            raise ValueError("a feed lacks entries")
    return rows.select("o_orderkey", "o_totalprice")


@R.add()
def snk_18_dashboard(s: SparkSession, d: str) -> DataFrame:
    by_court = table(s, d, "decisions", "court").groupBy("court").agg(F.count("*").alias("n")).orderBy("court")
    by_type = table(s, d, "events", "event_type").groupBy("event_type").agg(F.count("*").alias("n")).orderBy("event_type")
    return s.createDataFrame([(writers.dashboard({"courts": by_court, "events": by_type}),)], "json string")


@R.add("""SELECT 'q1' AS query_id, 'Miete' AS query, 'a' AS doc, 2 AS grade UNION ALL SELECT 'q1__2', 'Pacht', 'b', 1""")
def src_36_golden_queries(s: SparkSession, d: str) -> DataFrame:
    out = _folder(s)
    for n, (query, doc, grade) in enumerate((("Miete", "a", 2), ("Pacht", "b", 1))):
        body = f'{{"queries": [{{"id": "q1", "query": "{query}", "tags": [], "relevant": [{{"decision_id": "{doc}", "grade": {grade}}}]}}]}}'
        s.createDataFrame([(body,)], "value string").write.text(f"{out}/{n}")
    return readers.goldens(s, [f"{out}/0", f"{out}/1"])


class NationPages:
    """A service over the nation table: one page for each region, as query bindings; the first answer of each page fails."""

    def __init__(self, options: dict[str, str]) -> None:
        import pyarrow.parquet as pq

        self.rows = pq.read_table(options["file"], columns=["n_regionkey", "n_nationkey", "n_name"]).to_pylist()
        self.asked: set[int] = set()

    def pages(self) -> list[int]:
        return sorted({r["n_regionkey"] for r in self.rows})

    def fetch(self, page: int):
        if page not in self.asked:
            self.asked.add(page)
            raise OSError("try again")
        bindings = [{"key": {"value": r["n_nationkey"]}, "name": {"value": r["n_name"]}} for r in self.rows if r["n_regionkey"] == page]
        return [(page, b["key"]["value"], b["name"]["value"]) for b in bindings]


@R.add("""SELECT n_regionkey AS page, n_nationkey AS k, n_name AS name FROM nation""")
def src_21_paged_service(s: SparkSession, d: str) -> DataFrame:
    readers.register_paged(s)
    reader = s.read.format("paged").option("service", "tessera.plans.source_queries:NationPages")
    return reader.option("columns", "page int, k int, name string").option("file", f"{d}/nation.parquet").load()


@R.add("""SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 7 = 0) AS unmatched FROM events""")
def src_12_log_lines(s: SparkSession, d: str) -> DataFrame:
    """Lines of a log, of which those of another form are rows of nulls."""
    out = _folder(s)
    good = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), c("user_id").cast("string"), "event_type", F.lit("GET 200 0.5 -"), F.lit("0123abcd"))
    table(s, d, "events").select(F.when(c("event_id") % 7 == 0, F.lit("another line")).otherwise(good).alias("value")).write.text(out)
    return readers.access_log(s, out).agg(F.count("*").alias("n"), F.count_if(c("client").isNull()).alias("unmatched"))


@R.add("""SELECT n_nationkey + 1 AS line FROM nation WHERE n_nationkey % 4 = 3""")
def src_03_bad_lines(s: SparkSession, d: str) -> DataFrame:
    """Where a shard of JSON lines is none."""
    out = _folder(s)
    line = F.when(c("n_nationkey") % 4 == 3, F.concat(F.lit('{"broken": '), "n_name")).otherwise(F.to_json(F.struct("n_nationkey", "n_name")))
    table(s, d, "nation", "n_nationkey", "n_name").orderBy("n_nationkey").coalesce(1).select(line.alias("value")).write.text(out)
    return readers.bad_json(s, f"{out}/*.txt").select("line")


@R.add("""SELECT n_nationkey AS k, 1 AS times FROM nation UNION ALL SELECT r_regionkey + 100, 1 FROM region""")
def src_01_grown_shards(s: SparkSession, d: str) -> DataFrame:
    """Shards read, grown and read again from where they ended: every line once."""
    from tessera.session import _path

    out = _folder(s)

    def write(name: str, rows: list[int], last: str = "\n") -> None:
        fs, p = _path(s, f"{out}/{name}")
        stream = fs.create(p)
        stream.write(bytearray(("\n".join(f'{{"k": {k}}}' for k in rows) + last).encode()))
        stream.close()

    # two fixed tables of a few rows
    nations = sorted(r[0] for r in table(s, d, "nation", "n_nationkey").collect())
    regions = sorted(r[0] + 100 for r in table(s, d, "region", "r_regionkey").collect())
    write("a.jsonl", nations[:10], "\n{\"k\": ")
    write("b.jsonl", regions)
    first, state = readers.grown_lines(s, out, None)
    write("a.jsonl", nations)
    second, _ = readers.grown_lines(s, out, state)
    return first.unionByName(second).select(F.get_json_object("value", "$.k").cast("int").alias("k")).groupBy("k").agg(F.count("*").cast("int").alias("times"))


@R.add("SELECT doc_id, count(*) AS n, count(DISTINCT law) AS laws FROM (" + extract_queries.R.sql["tvf_01_statutes"] + ") GROUP BY 1")
def snk_05_statute_export(s: SparkSession, d: str) -> DataFrame:
    """The provisions that each document cites, exported beside the graph's edges."""
    from tessera.functions import extract

    out = _folder(s)
    found = table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull()).select("doc_id", F.explode(extract.statutes(c("text"))).alias("r")).select("doc_id", "r.law", "r.normalised")
    found.write.option("compression", "zstd").parquet(out)
    return s.read.parquet(out).groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("law").alias("laws"))


@R.add()
def snk_06_paragraph_export(s: SparkSession, d: str) -> DataFrame:
    """Numbered paragraphs with their text, and how many of each document come back."""
    from tessera.functions import extract

    out = _folder(s)
    table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull()).select("doc_id", F.explode(extract.paragraphs_udf()(c("text"))).alias("p")).select("doc_id", "p.*").write.option("compression", "zstd").parquet(out)
    return s.read.parquet(out).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("depth").alias("deepest"))


@R.add("""WITH m AS (SELECT member_decision_id AS id, min(canonical_decision_id) AS canonical FROM decision_representations WHERE member_decision_id IS NOT NULL GROUP BY 1) SELECT coalesce(canonical, decision_id) AS id, count(DISTINCT decision_id) AS n FROM decisions LEFT JOIN m ON m.id = decision_id GROUP BY 1""")
def snk_10_remapped_ids(s: SparkSession, d: str) -> DataFrame:
    """A delta's rows under the canonical ids."""
    m = table(s, d, "decision_representations", "member_decision_id", "canonical_decision_id").where(c("member_decision_id").isNotNull()).groupBy(c("member_decision_id").alias("decision_id")).agg(F.min("canonical_decision_id").alias("canonical"))
    return table(s, d, "decisions", "decision_id").join(m, "decision_id", "left").groupBy(F.coalesce("canonical", "decision_id").alias("id")).agg(F.countDistinct("decision_id").alias("n"))
