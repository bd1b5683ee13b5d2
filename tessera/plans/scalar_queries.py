"""Queries of projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.plans.registry import Registry
from tessera.sources.tables import table

R = Registry()
c = F.col


_CLEAN = r"regexp_replace(regexp_replace(full_text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '<[^<>]+>', ' ', 'g')"
for _entity, _text in T.ENTITIES.items():
    _CLEAN = f"replace({_CLEAN}, '{_entity}', '{_text.replace(chr(39), chr(39) * 2)}')".replace("'&#39;'", "'&#39;'")


@R.add(rf"""SELECT DISTINCT decision_id, md5(trim(regexp_replace({_CLEAN}, '[ \t]+', ' ', 'g'), ' ')) AS cleaned FROM decisions""")
def scl_01_clean_text(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "full_text").select("decision_id", F.md5(T.clean_text(c("full_text"))).alias("cleaned")).distinct()


@R.add()
def scl_02_mojibake(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "documents", "doc_id", "text").where(c("text").contains("Ã"))
    return df.select("doc_id", T.repair_mojibake(c("text")).alias("text"))


@R.add("""SELECT doc_id, md5(left(regexp_replace(lower(regexp_replace(left(text, 8000), '<[^>]+>', ' ', 'g')), '[^a-z0-9]+', '', 'g'), 4000)) AS signature FROM documents WHERE text IS NOT NULL""")
def scl_03_dedup_signature(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull()).select("doc_id", F.md5(T.dedup_signature(c("text"))).alias("signature"))


@R.add(r"""SELECT DISTINCT decision_id, trim(regexp_replace(docket_number, '[\n\r\t ]+', ' ', 'g'), ' ') AS docket FROM decisions""")
def scl_04_docket_spaces(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "docket_number").select("decision_id", T.docket_spaces(c("docket_number")).alias("docket")).distinct()


@R.add("""SELECT DISTINCT decision_id, CASE WHEN starts_with(u, 'http') THEN u WHEN trim(u) = '' THEN u WHEN starts_with(u, '/') THEN 'https://court.example' || u ELSE 'https://court.example/' || u END AS url FROM (SELECT decision_id, replace(source_url, 'https://', '/') AS u FROM decisions)""")
def scl_05_with_host(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "decision_id", "source_url").withColumn("u", F.replace("source_url", F.lit("https://"), F.lit("/")))
    return df.select("decision_id", T.with_host(c("u"), F.lit("https://court.example")).alias("url")).distinct()


@R.add("""SELECT DISTINCT decision_id, CASE WHEN starts_with(decision_date, '0000') OR (regexp_matches(decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND (decision_date < '1700-01-01' OR decision_date > '2025-12-31')) THEN NULL ELSE decision_date END AS sane FROM decisions""")
def scl_06_sane_date(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "decision_date").select("decision_id", T.sane_date(c("decision_date"), "2024-12-31").alias("sane")).distinct()


@R.add("""SELECT DISTINCT decision_id, CASE WHEN datediff('day', try_cast(decision_date AS DATE), try_cast(publication_date AS DATE)) < -31 THEN NULL ELSE publication_date END AS published FROM (SELECT * FROM decisions WHERE regexp_matches(decision_date, '^\\d{4}-\\d{2}-\\d{2}$') AND regexp_matches(publication_date, '^\\d{4}-\\d{2}-\\d{2}$'))""".replace("\\\\", "\\"))
def scl_07_date_inversion(s: SparkSession, d: str) -> DataFrame:
    iso = r"^\d{4}-\d{2}-\d{2}$"
    df = table(s, d, "decisions", "decision_id", "decision_date", "publication_date").where(c("decision_date").rlike(iso) & c("publication_date").rlike(iso))
    return df.select("decision_id", T.not_before(c("publication_date"), c("decision_date")).alias("published")).distinct()


@R.add()
def scl_08_parse_dates(s: SparkSession, d: str) -> DataFrame:
    from tessera.operators.timestamps import interpretations

    df = table(s, d, "decisions", "decision_id", "decision_date").withColumn("r", interpretations(c("decision_date")))
    return df.where(F.size("r") > 0).select("decision_id", F.substring(c("r")[0]["form"], 1, 10).alias("day")).distinct()


@R.add(r"""SELECT DISTINCT decision_id, CASE WHEN y BETWEEN 1800 AND 2100 THEN y END AS docket_year FROM (SELECT decision_id, coalesce(nullif(regexp_extract(docket_number, '[/_. ](\d{4})$', 1), ''), nullif(regexp_extract(docket_number, '^[A-Z]{1,6}[._ ](\d{4})[._ ]', 1), ''))::INT AS y FROM decisions)""")
def scl_11_docket_year(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "docket_number").select("decision_id", T.docket_year(c("docket_number")).alias("docket_year")).distinct()


@R.add("""SELECT DISTINCT decision_id, coalesce(decision_date = '' OR ends_with(decision_date, '-01-01'), true) AS synthetic FROM decisions""")
def scl_16_synthetic_date(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "decision_date").select("decision_id", T.synthetic_date(c("decision_date")).alias("synthetic")).distinct()


@R.add("""SELECT DISTINCT decision_id, sha256(coalesce(regeste, '') || coalesce(full_text, '')) AS hash FROM decisions""")
def scl_20_content_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "regeste", "full_text").select("decision_id", T.content_hash(c("regeste"), c("full_text")).alias("hash")).distinct()


@R.add("""SELECT DISTINCT decision_id, sha256(concat_ws('|', coalesce(court, ''), coalesce(canton, ''), coalesce(docket_number, ''), coalesce(decision_date, ''), coalesce(language, ''), coalesce(title, ''), coalesce(regeste, ''), coalesce(full_text, ''), coalesce(source_url, ''))) AS hash FROM decisions""")
def scl_21_extractor_hash(s: SparkSession, d: str) -> DataFrame:
    names = ["court", "canton", "docket_number", "decision_date", "language", "title", "regeste", "full_text", "source_url"]
    return table(s, d, "decisions", "decision_id", *names).select("decision_id", T.joined_hash(*map(c, names)).alias("hash")).distinct()


@R.add("""SELECT DISTINCT decision_id, concat_ws('|', court, CASE WHEN court = 'bge' THEN regexp_replace(b, '^(?:CH)?(?:BGE|ATF|DTF)', '') ELSE b END, left(replace(coalesce(decision_date, ''), '-', ''), 8)) AS key FROM (SELECT *, regexp_replace(upper(coalesce(docket_number, '')), '[^A-Z0-9]', '', 'g') AS b FROM decisions)""")
def scl_22_canonical_key(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "court", "docket_number", "decision_date").select("decision_id", T.canonical_key(c("court"), c("docket_number"), c("decision_date")).alias("key")).distinct()


@R.add(r"""SELECT DISTINCT decision_id, regexp_replace(trim(docket_number), '[/\\]', '_', 'g') AS docket FROM decisions""")
def scl_23_id_docket(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "docket_number").select("decision_id", T.id_docket(c("docket_number")).alias("docket")).distinct()


GRAPH_SQL = r"""CASE WHEN regexp_matches({u}, '^(BGE|ATF|DTF)\s+(\d{{1,3}})\s+([IVX]{{1,4}})\s+(\d{{1,4}})$') THEN regexp_replace({u}, '\s+', ' ', 'g')
  WHEN regexp_matches({o}, '^\d{{1,3}}_[IVX]{{1,4}}_\d{{1,4}}$') THEN replace({o}, '_', ' ') ELSE {o} END"""
_U = "upper(trim({0}))"
_O = "regexp_replace(regexp_replace(regexp_replace(upper(trim({0})), '[-./ ]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g')"


def graph_docket_sql(column: str) -> str:
    return GRAPH_SQL.format(u=_U.format(column), o=_O.format(column))


@R.add(f"""SELECT DISTINCT target_ref, coalesce({graph_docket_sql("target_ref")}, '') AS docket FROM decision_citations""")
def scl_24_graph_docket(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "target_ref").distinct().select("target_ref", T.graph_docket(c("target_ref")).alias("docket"))


@R.add(r"""SELECT DISTINCT target_ref, CASE WHEN regexp_matches(b, '^\d{1,3} [IVX]{1,4} \d{1,4}$') THEN b ELSE regexp_replace(regexp_replace(regexp_replace(u, '[-./]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') END AS docket FROM (SELECT target_ref, upper(trim(target_ref)) AS u, regexp_replace(upper(trim(target_ref)), '\s+', ' ', 'g') AS b FROM decision_citations)""")
def scl_25_token_docket(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "target_ref").distinct().select("target_ref", T.token_docket(c("target_ref")).alias("docket"))


@R.add(r"""SELECT DISTINCT target_ref, CASE WHEN f <> '' THEN regexp_replace(f, '[. ]', '_', 'g') END AS key FROM (SELECT target_ref, regexp_extract(upper(target_ref), '(\d[A-Z])[_. ](\d{1,5})/(\d{4})', 0) AS f FROM decision_citations)""")
def scl_26_docket_key(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "target_ref").distinct().select("target_ref", T.docket_key(c("target_ref")).alias("key"))


@R.add(r"""SELECT DISTINCT target_ref, CASE WHEN len(t) <> 3 THEN NULL WHEN regexp_matches(k, '^\d{1,3}:[IVX]{1,4}:\d{1,4}$') THEN 'bge:' || k ELSE 'd:' || k END AS key FROM (SELECT target_ref, t, array_to_string(t, ':') AS k FROM (SELECT target_ref, list_filter(string_split_regex(regexp_replace(upper(target_ref), '^(?:BGE|ATF|DTF)[^A-Z0-9]+', ''), '[^A-Z0-9]+'), lambda x: x <> '') AS t FROM decision_citations))""")
def scl_27_reference_tokens(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decision_citations", "target_ref").distinct().select("target_ref", T.reference_tokens(c("target_ref")).alias("key"))


COURT_SQL = r"""CASE WHEN regexp_matches({0}, '^[1-9][A-Z]_\d') THEN 'bger' WHEN regexp_matches({0}, '^[A-F]_\d{{1,6}}_\d{{4}}$') THEN 'bvger' WHEN regexp_matches({0}, '^(?:BB|BG|BH|BK|BN|BP|CA|CB|CR|RR|SK|SN|SP|TP)_') THEN 'bstger' END"""


@R.add(f"""SELECT DISTINCT docket_number, {COURT_SQL.format("k")} AS court FROM (SELECT docket_number, {graph_docket_sql("docket_number")} AS k FROM decisions)""")
def scl_28_court_of_docket(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "docket_number").distinct().select("docket_number", T.court_of_docket(T.graph_docket(c("docket_number"))).alias("court"))


@R.add("""SELECT decision_id, lang FROM (
  SELECT decision_id, CASE WHEN de >= fr AND de >= it THEN 'de' WHEN fr >= it THEN 'fr' ELSE 'it' END AS lang FROM (
    SELECT DISTINCT decision_id,
      len(list_filter(w, lambda x: list_contains(['der','die','das','ein','eine','einer','er','sie','ihn','hat','hatte','hätte','ist','war','sind'], x))) AS de,
      len(list_filter(w, lambda x: list_contains(['le','lui','elle','je','on','vous','nous','leur','qui','quand','parce','que','faire','sont','vont'], x))) AS fr,
      len(list_filter(w, lambda x: list_contains(['della','del','di','casi','una','al','questa','più','primo','grado','che','diritto','leggi','corte'], x))) AS it
    FROM (SELECT decision_id, regexp_extract_all(lower(left(full_text, 5000)), '[\\p{L}\\p{N}_]+') AS w FROM decisions WHERE full_text IS NOT NULL)))""".replace("\\\\", "\\"))
def scl_30_language(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "full_text").where(c("full_text").isNotNull()).select("decision_id", T.language_of(c("full_text")).alias("lang")).distinct()


@R.add("""SELECT DISTINCT decision_id, CASE WHEN y IS NOT NULL THEN concat_ws(':', 'ECLI:CH', upper(regexp_replace(court, '[^A-Za-z0-9]', '', 'g')), y::VARCHAR, upper(regexp_replace(docket_number, '[^A-Za-z0-9]+', '.', 'g'))) END AS ecli FROM (SELECT *, try_cast(nullif(regexp_extract(decision_date, '^([0-9]{4})-', 1), '') AS INT) AS y FROM decisions)""")
def scl_37_ecli(s: SparkSession, d: str) -> DataFrame:
    year = F.nullif(F.regexp_extract("decision_date", "^([0-9]{4})-", 1), F.lit("")).cast("int")
    return table(s, d, "decisions", "decision_id", "court", "docket_number", "decision_date").select("decision_id", T.ecli(c("court"), year, c("docket_number")).alias("ecli")).distinct()


@R.add("""SELECT DISTINCT decision_id, 'cli:ch:' || lower(court) || ':' || regexp_replace(lower(trim(docket_number)), '[^a-z0-9]+', '-', 'g') AS cli FROM decisions""")
def scl_38_national_id(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "court", "docket_number").select("decision_id", T.national_id(c("court"), c("docket_number")).alias("cli")).distinct()


@R.add("""SELECT DISTINCT decision_id, court AS parsed_court, regexp_replace(lower(trim(docket_number)), '[^a-z0-9]+', '-', 'g') AS parsed_docket, '2' AS version FROM decisions WHERE regexp_matches(lower(trim(docket_number)), '[a-z0-9]')""")
def scl_39_parse_national_id(s: SparkSession, d: str) -> DataFrame:
    p = T.parse_national_id(F.concat(T.national_id(c("court"), c("docket_number")), F.lit("@2?lang=de#E.1")))
    return table(s, d, "decisions", "decision_id", "court", "docket_number").where(F.lower("docket_number").rlike("[a-z0-9]")).select("decision_id", p["court"].alias("parsed_court"), p["docket"].alias("parsed_docket"), p["version"].alias("version")).distinct()


@R.add("""SELECT event_id, left(sha256(user_id::VARCHAR || '|' || props || '|' || strftime(ts, '%Y-%m')), 8) AS cohort FROM events""")
def scl_42_cohort(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_id", "user_id", "ts", "props").select("event_id", T.cohort(c("user_id").cast("string"), c("ts"), c("props")).alias("cohort"))


@R.add("""SELECT event_id, strftime(ts, '%G-W%V') AS week, strftime(ts, '%Y-%m') AS month FROM events""")
def scl_43_iso_week(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_id", "ts").select("event_id", T.iso_week(c("ts")).alias("week"), T.window_key(c("ts"), "month").alias("month"))


@R.add(r"""SELECT decision_id, CASE WHEN length(f) > 220 THEN rtrim(left(f, 219), ' ') || '…' ELSE f END AS clipped FROM (SELECT DISTINCT decision_id, trim(regexp_replace(regeste, '\s+', ' ', 'g'), ' ') AS f FROM decisions)""")
def scl_45_clip(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "regeste").select("decision_id", T.clip(c("regeste")).alias("clipped")).distinct()


@R.add(r"""SELECT doc_id, length(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) AS kept FROM documents""")
def scl_46_xml_legal(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text").select("doc_id", F.length(T.xml_legal(c("text"))).cast("bigint").alias("kept"))


@R.add("""SELECT doc_id, CASE WHEN st > 1 THEN '...' ELSE '' END || substring(text, st, 300) || CASE WHEN st + 300 <= length(text) THEN '...' ELSE '' END AS snippet FROM (
  SELECT doc_id, text, CASE WHEN pos > 0 THEN greatest(1, pos - 100) ELSE 1 END AS st FROM (SELECT doc_id, text, instr(lower(text), 'mietvertrag') AS pos FROM documents WHERE text IS NOT NULL))""")
def scl_47_snippet(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "documents", "doc_id", "text").where(c("text").isNotNull())
    return df.select("doc_id", T.snippet(c("text"), F.lit("Mietvertrag")).alias("snippet"))


@R.add("""SELECT decision_id, ('0x' || left(sha1(decision_id), 12))::BIGINT AS stable_id FROM (SELECT DISTINCT decision_id FROM decisions)""")
def scl_54_stable_id(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id").distinct().select("decision_id", T.stable_id(c("decision_id")).alias("stable_id"))


@R.add("""SELECT decision_id, ref FROM (SELECT DISTINCT decision_id, unnest(from_json(cited_decisions, '["VARCHAR"]')) AS ref FROM decisions WHERE cited_decisions IS NOT NULL)""")
def scl_55_json_list(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "cited_decisions").select("decision_id", F.explode(F.from_json("cited_decisions", "array<string>")).alias("ref")).distinct()


@R.add("""SELECT DISTINCT decision_id, len(list_distinct(from_json(cited_decisions, '["VARCHAR"]'))) AS n_distinct FROM decisions WHERE cited_decisions IS NOT NULL""")
def scl_56_array_distinct(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "cited_decisions").where(c("cited_decisions").isNotNull()).select("decision_id", F.size(F.array_distinct(F.from_json("cited_decisions", "array<string>"))).cast("bigint").alias("n_distinct")).distinct()


@R.add("""SELECT decision_id, court, canton FROM decisions WHERE court IN ('bger', 'bvger', 'zh_obergericht') AND canton IN ('CH', 'ZH') AND decision_date >= '2010-01-01' AND decision_date <= '2019-12-31' AND language = 'de'""")
def prj_01_search_filters(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions").where(c("court").isin("bger", "bvger", "zh_obergericht") & c("canton").isin("CH", "ZH") & c("decision_date").between("2010-01-01", "2019-12-31") & (c("language") == "de")).select("decision_id", "court", "canton")


@R.add("""SELECT decision_id, coalesce(nullif(court, ''), 'unknown') AS court, coalesce(nullif(canton, ''), 'XX') AS canton, coalesce(nullif(trim(language), ''), 'de') AS language, CASE WHEN decision_date = '1970-01-01' THEN NULL ELSE decision_date END AS decision_date,
 length(coalesce(full_text, '')) >= 1 AS has_text, length(coalesce(full_text, '')) AS n_chars FROM decisions""")
def prj_02_export_row(s: SparkSession, d: str) -> DataFrame:
    df = table(s, d, "decisions", "decision_id", "court", "canton", "language", "decision_date", "full_text")
    fill = lambda x, v: F.coalesce(F.nullif(x, F.lit("")), F.lit(v))
    n = F.length(F.coalesce("full_text", F.lit("")))
    return df.select("decision_id", fill(c("court"), "unknown").alias("court"), fill(c("canton"), "XX").alias("canton"), fill(F.trim("language"), "de").alias("language"), F.when(c("decision_date") == "1970-01-01", None).otherwise(c("decision_date")).alias("decision_date"), (n >= 1).alias("has_text"), n.cast("bigint").alias("n_chars"))


@R.add("""SELECT event_id, CASE WHEN v IS NULL OR v = '' THEN NULL ELSE CAST(lower(trim(v)) IN ('1', 'true', 't', 'yes') AS VARCHAR) END AS flag FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN NULL WHEN 3 THEN ' Yes' WHEN 4 THEN '' ELSE 'no' END AS v FROM events)""")
def prj_03_as_boolean(s: SparkSession, d: str) -> DataFrame:
    v = F.get(F.array(F.lit("1"), F.lit("0"), F.lit(None).cast("string"), F.lit(" Yes"), F.lit(""), F.lit("no")), (c("event_id") % 6).cast("int"))
    return table(s, d, "events", "event_id").select("event_id", T.as_boolean(v).cast("string").alias("flag"))


@R.add("""SELECT DISTINCT court, canton, CASE WHEN court IN ('bger','bvger','bstger','bpatger','bge','emark') THEN 'federal' WHEN coalesce(canton, '') = '' THEN 'federal' ELSE 'cantonal' END AS level, CASE WHEN upper(canton) = 'CH' THEN NULL ELSE upper(canton) END AS shown FROM decisions""")
def prj_05_level(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "court", "canton").distinct().select("court", "canton", T.level(c("court"), c("canton")).alias("level"), F.when(F.upper("canton") == "CH", None).otherwise(F.upper("canton")).alias("shown"))


@R.add("""SELECT decision_id FROM decisions WHERE coalesce(court, '') <> '' AND coalesce(canton, '') <> '' AND coalesce(docket_number, '') <> '' AND coalesce(language, '') <> ''""")
def prj_07_required_fields(s: SparkSession, d: str) -> DataFrame:
    need = [F.coalesce(F.col(x), F.lit("")) != "" for x in ("court", "canton", "docket_number", "language")]
    return table(s, d, "decisions").where(need[0] & need[1] & need[2] & need[3]).select("decision_id")


@R.add("""SELECT decision_id FROM decisions WHERE NOT (length(coalesce(full_text, '')) < 10 AND length(coalesce(regeste, '')) < 10)""")
def prj_08_no_stubs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "full_text", "regeste").where(~((F.length(F.coalesce("full_text", F.lit(""))) < 10) & (F.length(F.coalesce("regeste", F.lit(""))) < 10))).select("decision_id")


@R.add("""SELECT decision_id FROM decisions WHERE court NOT IN ('ti_gerichte', 'gr_gerichte')""")
def prj_09_excluded_courts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "court").where(~c("court").isin("ti_gerichte", "gr_gerichte")).select("decision_id")


@R.add("""SELECT decision_id, CASE WHEN m THEN full_text ELSE regeste END AS regeste, CASE WHEN m THEN NULL ELSE length(full_text) END AS text_chars FROM (SELECT *, coalesce(length(full_text) BETWEEN 10 AND 99 AND coalesce(trim(regeste), '') = '', false) AS m FROM decisions)""")
def prj_10_short_text_to_headnote(s: SparkSession, d: str) -> DataFrame:
    move = F.coalesce(F.length("full_text").between(10, 99) & (F.coalesce(F.trim("regeste"), F.lit("")) == ""), F.lit(False))
    return table(s, d, "decisions", "decision_id", "full_text", "regeste").select("decision_id", F.when(move, c("full_text")).otherwise(c("regeste")).alias("regeste"), F.when(~move, F.length("full_text")).cast("bigint").alias("text_chars"))


@R.add("""SELECT decision_id AS old_id, regexp_replace(decision_id, '^bge_', 'leading_') AS new_id FROM bge_register""")
def prj_11_remap_ids(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "bge_register", "decision_id").select(c("decision_id").alias("old_id"), F.regexp_replace("decision_id", "^bge_", "leading_").alias("new_id"))


@R.add("""SELECT event_id, CASE WHEN st BETWEEN 200 AND 299 THEN '2xx' WHEN st BETWEEN 300 AND 399 THEN '3xx' WHEN st = 404 THEN '404' WHEN st = 429 THEN '429' WHEN st BETWEEN 400 AND 499 THEN '4xx' WHEN st BETWEEN 500 AND 599 THEN '5xx' ELSE 'other' END AS bucket FROM (SELECT event_id, 100 + (event_id * 37) % 600 AS st FROM events)""")
def prj_12_status_bucket(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_id").select("event_id", T.status_bucket(100 + (c("event_id") * 37) % 600).alias("bucket"))


@R.add("""SELECT DISTINCT docket_number, CASE WHEN regexp_matches(docket_number, '^[1-9][A-F]_') THEN 'federal' WHEN regexp_matches(docket_number, '^[A-F]-') THEN 'administrative' WHEN regexp_matches(docket_number, '^[A-Z]{2}[.]') THEN 'dotted' WHEN regexp_matches(docket_number, '/') THEN 'slashed' ELSE 'other' END AS shape FROM decisions""")
def prj_13_first_match(s: SparkSession, d: str) -> DataFrame:
    x = c("docket_number")
    rules = [("^[1-9][A-F]_", "federal"), ("^[A-F]-", "administrative"), ("^[A-Z]{2}[.]", "dotted"), ("/", "slashed")]
    return table(s, d, "decisions", "docket_number").distinct().select("docket_number", F.coalesce(*[F.when(x.rlike(p), F.lit(label)) for p, label in rules], F.lit("other")).alias("shape"))


@R.add("""SELECT decision_id FROM decisions WHERE regexp_matches(decision_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND decision_date > '2015-06-30' AND title ILIKE '%miet%'""")
def prj_14_like_and_glob(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "decisions", "decision_id", "decision_date", "title").where(c("decision_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & (c("decision_date") > "2015-06-30") & c("title").ilike("%miet%")).select("decision_id")


@R.add("""SELECT event_type, count(*) AS total, count(*) FILTER (WHERE user_id % 10 <> 0) AS humans FROM events GROUP BY 1""")
def prj_15_bots_counted_apart(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_type", "user_id").groupBy("event_type").agg(F.count("*").alias("total"), F.count_if(c("user_id") % 10 != 0).alias("humans"))


@R.add("""SELECT target_ref FROM citation_gaps WHERE classification IS NULL OR lower(replace(classification, '-', '_')) NOT IN ('missing', 'resolution_bug', 'noise')""")
def prj_16_check_constraint(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "citation_gaps", "target_ref", "classification").where(c("classification").isNull() | ~F.lower(F.replace("classification", F.lit("-"), F.lit("_"))).isin("missing", "resolution_bug", "noise")).select("target_ref")
