"""Facts read from the heads of documents: dates, head-notes, classes, appealed decisions, identifiers, changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import court_of_docket, graph_docket

# Months by their beginnings, as in the timestamp grammars.
MONTH_WORDS = {
    "januar": 1, "februar": 2, "märz": 3, "april": 4, "mai": 5, "juni": 6, "juli": 7, "august": 8, "september": 9, "oktober": 10, "november": 11, "dezember": 12,
    "janvier": 1, "février": 2, "mars": 3, "avril": 4, "juin": 6, "juillet": 7, "août": 8, "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12,
    "gennaio": 1, "febbraio": 2, "marzo": 3, "aprile": 4, "maggio": 5, "giugno": 6, "luglio": 7, "agosto": 8, "settembre": 9, "ottobre": 10, "dicembre": 12,
}
_WORDS = "|".join(sorted(MONTH_WORDS, key=len, reverse=True))
DATE = rf"(?i)(\d{{1,2}})(?:\.|er|°)?\s+({_WORDS})\s+(\d{{4}})|\b(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})\b|\b(\d{{4}})-(\d{{2}})-(\d{{2}})\b"
HEADER_DATE = rf"(?i)(?:urteil|entscheid|beschluss|verfügung|arrêt|décision|jugement|sentenza|decisione|judgment)\D{{0,60}}?(?:vom|du|del|of)\s+(?:{DATE.removeprefix('(?i)')})"
BODY_MARKS = ["Sachverhalt", "Erwägung", "Faits", "Considérant", "Fatti", "Considerando", "Das Gericht", "A. "]


def _bound(column: Column, use: Callable[[Column], Column]) -> Column:
    """``use(column)``, where ``column`` is worked out once however often it is used."""
    return F.transform(F.array(column), use)[0]


def _day(text: Column, pattern: str, first: int) -> Column:
    """The day that the first match of ``pattern`` tells; its parts are read from the match alone."""
    return _bound(F.regexp_extract(text, pattern, 0), lambda match: _day_of(match, pattern, first))


def _day_of(match: Column, pattern: str, first: int) -> Column:
    g = lambda i: F.regexp_extract(match, pattern, first + i)
    month = F.coalesce(*[F.when(F.lower(g(1)) == w, F.lit(n)) for w, n in MONTH_WORDS.items()])
    named = F.format_string("%04d-%02d-%02d", g(2).try_cast("int"), month, g(0).try_cast("int"))
    dotted = F.format_string("%04d-%02d-%02d", g(5).try_cast("int"), g(4).try_cast("int"), g(3).try_cast("int"))
    iso = F.concat_ws("-", g(6), g(7), g(8))
    text = F.when(g(1) != "", named).when(g(4) != "", dotted).when(g(6) != "", iso)
    return F.date_format(text.try_cast("date"), "yyyy-MM-dd")


def first_date(c: Column) -> Column:
    """The first date of a text in words, dots or ISO form, as yyyy-MM-dd; null for none or an impossible one."""
    return _day(c, DATE, 1)


def header_date(c: Column, read: int = 1500) -> Column:
    """struct<day, method>: the date after a decision's title, else the first date of the head, else null."""
    head = F.substring(c, 1, read)
    typed = _day(head, HEADER_DATE, 1)
    bare = first_date(F.substring(c, 1, 500))
    return F.struct(F.coalesce(typed, bare).alias("day"), F.when(typed.isNotNull(), "title").when(bare.isNotNull(), "head").alias("method"))


def not_before_docket(day: Column, docket_year: Column, tolerance: int = 3) -> Column:
    """``day`` unless its year lies more than ``tolerance`` before the docket's."""
    return F.when(F.substring(day, 1, 4).try_cast("int") < docket_year - tolerance, None).otherwise(day)


def best_date(stored: Column, read: Column) -> Column:
    """struct<day, method>: the stored day unless it is missing or a first of January, else the one read, else the stored one marked synthetic."""
    firm = F.coalesce(stored.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False)) & ~F.coalesce(stored.endswith("-01-01"), F.lit(False))
    return F.when(firm, F.struct(stored.alias("day"), F.lit("stored").alias("method"))).when(read.isNotNull(), F.struct(read.alias("day"), F.lit("text").alias("method"))).otherwise(F.struct(stored.alias("day"), F.lit("synthetic").alias("method")))


def headnote(c: Column) -> Column:
    """The text between a head-note's heading and the body, of 20 to 5,000 characters; else null."""
    found = F.trim(F.regexp_extract(c, r"(?s)(?:Regeste|Leitsatz|Régeste|Chapeau|Regesto)\s*:?\s*\n(.{20,5000}?)\n\s*(?:" + "|".join(BODY_MARKS) + ")", 1))
    return F.when(F.length(found).between(20, 5000), found)


def cut_headnote(note: Column, body: Column) -> Column:
    """An oversized head-note (over 8,000 characters, nearly the whole text) up to the first body mark, else 5,000 characters."""
    ends = F.array_min(F.filter(F.array(*[F.instr(note, m) for m in BODY_MARKS]), lambda x: x > 1))
    long = (F.length(note) > 8000) & (F.length(body) >= 1000) & (F.length(note) >= 0.9 * F.length(body))
    return F.when(long, F.when(ends.isNotNull(), F.rtrim(F.substring(note, F.lit(1), ends - 1))).otherwise(F.substring(note, 1, 5000))).otherwise(note)


# Classes of law by word; the first that fits counts.
BRANCHES = [("criminal", "straf|pénal|penal"), ("social_security", "sozialversicherung|assurances? sociales?|assicurazioni sociali|invalid"), ("tax", "steuer|fiscal|impôt|tassazione"), ("migration", "migration|ausländer|étranger|stranier|asyl"), ("private", "zivil|civil|miet|kauf|famil|erb")]


def branch(court: Column, docket: Column, words: Column) -> Column:
    """The class of law by docket, else by words of chamber or subject; null rather than a guess."""
    by_docket = F.when(docket.rlike(r"^[67][A-Z][_.]") | court.isin("bstger"), "criminal").when(docket.rlike(r"^[89]C[_.]"), "social_security").when(docket.rlike(r"^[45][A-Z][_.]"), "private")
    low = F.lower(F.coalesce(words, F.lit("")))
    return F.coalesce(by_docket, *[F.when(low.rlike(p), F.lit(n)) for n, p in BRANCHES])


def chamber(docket: Column) -> Column:
    """The register or series code at a docket's beginning; null for none."""
    code = F.regexp_extract(F.upper(F.trim(docket)), r"^([A-Z]{1,4}\d?|\d[A-Z])(?=[ ._/-]|\d{4,})", 1)
    return F.when((code != "") & ~code.isin("NR", "NO", "N"), code)


def proceeding(docket: Column, year: Column) -> Column:
    """The kind of federal proceeding by letter; before 2007 dots tell another series."""
    letter = F.regexp_extract(docket, r"^\d([A-Z])[_.]", 1)
    return F.when((letter == "") | letter.isNull(), None).when(docket.contains(".") | (year < 2007), F.concat(F.lit("old_"), F.lower(letter))).when(letter == "A", "civil_or_public").when(letter == "B", "criminal").when(letter == "C", "public").when(letter == "D", "constitutional").otherwise("other")


def appealed(c: Column) -> Column:
    """struct<court, docket> of the decision appealed against, from the head; null for none."""
    head = F.substring(c, 1, 3000)
    p = r"(?si)(?:gegen (?:das|den) (?:urteil|entscheid|beschluss) (?:des|der)|contre (?:l['’]arrêt|la décision|le jugement) (?:de la|du|de l['’])|contro la (?:sentenza|decisione) (?:del|della|dell['’]))\s*(.{5,160}?)(?:\s+(?:vom|du|del)\s[^(]{4,40})?\s*(?:\(([^)]{3,60})\)|[.,])"
    court, docket = F.trim(F.regexp_replace(F.regexp_extract(head, p, 1), r"\s+", " ")), F.nullif(F.trim(F.regexp_extract(head, p, 2)), F.lit(""))
    return F.when(court != "", F.struct(court.alias("court"), docket.alias("docket")))


def ecli_of_national_id(c: Column, year: Column) -> Column:
    """The ECLI of a national identifier; null for another string or no year."""
    p = r"^cli:ch:([a-z_]+):([a-z0-9-]+)"
    return F.when(c.rlike(p) & year.isNotNull(), F.concat_ws(":", F.lit("ECLI:CH"), F.upper(F.replace(F.regexp_extract(c, p, 1), F.lit("_"))), year.cast("string"), F.upper(F.replace(F.regexp_extract(c, p, 2), F.lit("-"), F.lit(".")))))


def url_of_national_id(c: Column, host: str = "https://example.org") -> Column:
    return F.when(c.startswith("cli:ch:"), F.concat(F.lit(f"{host}/"), F.replace(F.substring(c, 8, 1000), F.lit(":"), F.lit("/"))))


def citation_snippet(c: Column, needle: Column, around: int = 60, most: int = 140) -> Column:
    """The words around the first occurrence of ``needle``; null if there is none."""
    at = F.instr(c, needle)
    piece = F.substring(c, F.greatest(F.lit(1), at - around), F.length(needle) + 2 * around)
    return F.when(at > 0, F.substring(F.trim(F.regexp_replace(piece, r"\s+", " ")), 1, most))


def change_kind(old: Column, new: Column) -> Column:
    """citation, anonymisation, substantive or metadata: what tells two versions of a text apart."""
    refs = lambda x: F.array_sort(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"(?:BGE|ATF|DTF) \d+ [IVX]+ \d+|\d[A-Z]_\d+/\d{4}"), F.lit(0)))
    masks = lambda x: F.size(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"[A-Z]\.____+"), F.lit(0)))
    flat = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"[\W_]+", "")
    return F.when(refs(old) != refs(new), "citation").when(masks(old) != masks(new), "anonymisation").when(flat(old) != flat(new), "substantive").otherwise("metadata")


# Shapes that a request must not contain.
GUARDS = {"EMAIL": r"[\w.+-]+@[\w-]+\.[A-Za-z]{2,}", "AHV": r"756[. ]?\d{4}[. ]?\d{4}[. ]?\d{2}", "IBAN": r"\bCH\d{2}[ \d]{15,22}\b", "CHE": r"CHE-\d{3}\.\d{3}\.\d{3}", "PHONE": r"(?:\+41|0041)[ \d]{9,13}"}


def guard(c: Column) -> Column:
    """The kinds of personal data that a text plainly shows."""
    return F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(k)) for k, p in GUARDS.items()]))


def compatible(a: Column, b: Column) -> Column:
    """Whether two dates may be the same: equal, missing, or a placeholder of 1905."""
    return a.isNull() | b.isNull() | (a == b) | a.startswith("1905-") | b.startswith("1905-")


def parser_family(ref: Column) -> Column:
    """The grammar that a reference belongs to."""
    k = graph_docket(ref)
    return F.when(k.rlike(r"^(?:BGE|ATF|DTF) "), "series").when(k.rlike(r"^\d{1,3} [IVX]+ \d+$"), "bare_series").when(court_of_docket(k).isNotNull(), court_of_docket(k)).when(k.rlike(r"\d{4}"), "docket").otherwise("other")


def embedding_text(note: Column, body: Column) -> Column:
    """What stands for a record in a vector index: the head-note, else the head of the text."""
    return F.when(F.length(F.trim(note)) >= 20, note).otherwise(F.substring(body, 1, 500))


def fold_name(c: Column) -> Column:
    """A law's abbreviation as a key."""
    return F.regexp_replace(F.replace(F.lower(F.trim(c)), F.lit("ß"), F.lit("ss")), r"[\s.]+", "")


def headnote_language(c: Column) -> Column:
    """de, fr or it by marker words; null if short or unclear."""
    low = F.lower(c)
    n = {k: F.size(F.regexp_extract_all(low, F.lit(rf"(?U)\b(?:{p})\b"), F.lit(0))) for k, p in {"de": "der|die|das|und|nicht", "fr": "le|les|des|et|pas|une", "it": "il|di|che|della|non"}.items()}
    most, total = F.greatest(*n.values()), sum(n.values(), F.lit(0))
    out = F.when(n["de"] == most, "de").when(n["fr"] == most, "fr").otherwise("it")
    return F.when((F.length(c) >= 40) & (most > 0) & (most * 2 > total), out)


_DOCKET_DATE = rf"(?i)(\d[A-Z]{{1,3}}[._ ]\d{{1,5}}/\d{{4}})\s*,?\s*(?:vom|du|del|of)\s+(?:{DATE.removeprefix('(?i)')})"


def docket_date(c: Column, read: int = 2500) -> Column:
    """struct<docket, day> of the head's first docket with a date right behind it; the day is null if its year is before the docket's."""
    head = F.substring(c, 1, read)
    docket = F.regexp_replace(F.regexp_extract(head, _DOCKET_DATE, 1), r"^(\w+)[._ ]", "$1_")
    day = _day(head, _DOCKET_DATE, 2)
    sane = F.substring(day, 1, 4).try_cast("int") >= F.regexp_extract(docket, r"/(\d{4})$", 1).try_cast("int")
    return F.when(docket != "", F.struct(docket.alias("docket"), F.when(sane, day).alias("day")))


def demux_dates(decided: Column, published: Column, read: Column) -> Column:
    """struct<decided, published, origin>: a decision date that is a first of January is a volume's year, hence a publication.

    ``read`` is the day found in the text. A stored publication stays; the
    decision's day is then the one read, or none.
    """
    synthetic = F.coalesce(decided.rlike(r"^\d{4}-01-01$"), F.lit(False))
    day = F.when(synthetic | decided.isNull(), read).otherwise(decided)
    out = F.when(published.isNotNull(), published).when(synthetic, decided)
    origin = F.when(published.isNotNull(), "stored").when(synthetic, "volume_year")
    return F.struct(day.alias("decided"), out.alias("published"), origin.alias("origin"))


# Words of the place and day that end a decision, and words by which a date is one of a law.
_SIGNED = rf"(?i)(?:^|\n)\s*[A-ZÀ-Ý][\w. -]{{2,30}},\s+(?:den|le|il|li|ils)?\s*(?:{DATE.removeprefix('(?i)')})"
_OF_LAW = r"(?i)(?:gesetz|verordnung|loi|ordonnance|legge|ordinanza|SR \d|RS \d)"


def decision_day(c: Column, stored: Column) -> Column:
    """struct<day, method, confidence, category> of the day a decision was taken.

    The date after the title in the first 1,500 characters, else the first date
    of the first 500 that is no law's, else the last signature in the last 1,500.
    ``category`` compares it with the stored day: same, different, only_text,
    only_stored or none.
    """
    typed = _day(F.substring(c, 1, 1500), HEADER_DATE, 1)
    plain = F.filter(F.regexp_extract_all(F.substring(c, 1, 500), F.lit(rf"(?is).{{0,30}}?(?:{DATE.removeprefix('(?i)')})"), F.lit(0)), lambda x: ~x.rlike(_OF_LAW))
    bare = first_date(F.get(plain, F.lit(0)))
    ends = F.regexp_extract_all(F.substring(c, -1500, 1500), F.lit(_SIGNED), F.lit(0))
    signed = first_date(F.element_at(F.when(F.size(ends) > 0, ends), -1))
    iso = F.when(stored.rlike(r"^\d{4}-\d{2}-\d{2}$"), stored)

    def told(x: Column) -> Column:
        day = F.coalesce(x["typed"], x["bare"], x["signed"])
        method = F.when(x["typed"].isNotNull(), "title").when(x["bare"].isNotNull(), "head").when(x["signed"].isNotNull(), "signature")
        confidence = F.when(x["typed"].isNotNull(), 0.95).when(x["bare"].isNotNull(), 0.7).when(x["signed"].isNotNull(), 0.8).otherwise(0.0)
        category = F.when(day.isNull() & iso.isNull(), "none").when(day.isNull(), "only_stored").when(iso.isNull(), "only_text").when(day == iso, "same").otherwise("different")
        return F.struct(day.alias("day"), method.alias("method"), confidence.alias("confidence"), category.alias("category"))

    return _bound(F.struct(typed.alias("typed"), bare.alias("bare"), signed.alias("signed")), told)


# Words of a remedy in the head, the most particular first.
REMEDIES = [("enforcement", "rechtsöffnung|mainlevée|rigetto dell"), ("appeal", "berufung|appel|appello|appellazione"), ("revision", "revisionsgesuch|revision|révision|revisione"), ("recourse", "rekurs"), ("objection", "einsprache|opposition|opposizione"), ("complaint", "beschwerde|recours|ricorso"), ("action", "klage|demande|azione")]


def remedy(c: Column, read: int = 2000) -> Column:
    """The kind of remedy that the head of a text names, before its facts; null for none."""
    head = F.lower(F.regexp_extract(F.substring(c, 1, read), r"(?is)^(.*?)(?:\b(?:Sachverhalt|Faits|Fatti|Erwägung|Considérant|Considerando)\b|\z)", 1))
    return F.coalesce(*[F.when(head.rlike(rf"(?U)\b(?:{p})"), F.lit(n)) for n, p in REMEDIES])


def source_kind(module: Column) -> Column:
    """The kind of source that a module's dotted name tells."""
    return F.when(module.contains(".cantonal."), "cantonal_court").when(module.startswith("scrapers."), "federal_or_authority").otherwise("unknown")


def representation_role(docket: Column) -> Column:
    """publication_page for a record under a plain case number, else judgment."""
    return F.when(F.coalesce(F.trim(docket).rlike(r"^\d{2,3}[ .]\d{4}[ .]\d{1,5}$"), F.lit(False)), "publication_page").otherwise("judgment")


def regroup_key(court: Column, docket: Column, day: Column) -> Column:
    """The key of one decision: of the series its place, which no date can break; of all others court, docket and day."""
    place = r"(?i)^\s*(?:BGE\s+)?(\d{1,3})\s+([IVX]{1,4}[ab]?)\s+(\d{1,4})\s*$"
    of_series = F.coalesce(docket.rlike(place) & court.startswith("bge"), F.lit(False))
    bare = F.regexp_replace(F.upper(F.coalesce(docket, F.lit(""))), "[^0-9A-Z]", "")
    empty = lambda x: F.coalesce(F.nullif(x, F.lit("")), F.lit("?"))
    return F.when(of_series, F.concat_ws("|", F.lit("bge"), F.regexp_extract(docket, place, 1), F.upper(F.regexp_extract(docket, place, 2)), F.regexp_extract(docket, place, 3))).otherwise(F.concat_ws("|", empty(court), bare, empty(day)))


def docket_behind(c: Column, day: Column, read: int = 4000) -> Column:
    """The first federal docket in the head of a published decision whose year lies within three before and one after ``day``'s; null for none."""
    p = r"\b(\d[A-Z])[._ ](\d+)/(\d{4})\b"
    year = F.nullif(F.regexp_extract(day, r"^\d{4}", 0), F.lit("")).cast("int")
    near = lambda x: year.isNull() | F.regexp_extract(x, p, 3).cast("int").between(year - 3, year + 1)
    first = F.get(F.filter(F.regexp_extract_all(F.substring(c, 1, read), F.lit(p), F.lit(0)), near), F.lit(0))
    return F.regexp_replace(first, r"^(\d[A-Z])[._ ]", "$1_")


def topic_score(topic: str, title: Column, note: Column, area: Column) -> Column:
    """How well a record fits a topic: 3 for the topic in its title, 2 in its head-note, 1 for each of its longer words in either or in the subject."""
    words = [w for w in topic.lower().split() if len(w) > 3]
    low = [F.lower(F.coalesce(x, F.lit(""))) for x in (title, note, area)]
    whole = F.lit(topic.lower())
    hit = lambda x: F.when(x, 1).otherwise(0)
    return 3 * hit(low[0].contains(whole)) + 2 * hit(low[1].contains(whole)) + sum((hit(low[0].contains(w) | low[1].contains(w) | low[2].contains(w)) for w in words), F.lit(0))
