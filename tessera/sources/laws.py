"""Law texts, dispatches and harvested records: XML, HTML and plain text into rows; services that answer in pages."""

from __future__ import annotations

import html
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _parsed(xml: str | bytes | None) -> ET.Element | None:
    """The root of ``xml``; forbidden control characters are taken out for a second try; None for what is no XML."""
    if not xml:
        return None
    text = xml.decode("utf-8", "replace") if isinstance(xml, bytes) else xml
    for body in (text, _CONTROL.sub("", text)):
        try:
            return ET.fromstring(body)
        except ET.ParseError:
            continue
    return None


def _name(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def _texts(e: ET.Element, skip: frozenset[str]) -> Iterable[str]:
    if _name(e) not in skip:
        yield e.text or ""
        for child in e:
            yield from _texts(child, skip)
            yield child.tail or ""


def xml_text(xml: str | None, skip: Iterable[str] = ("authorialNote", "footnote")) -> str | None:
    """The text of all elements but those named, blanks squeezed; null for null or broken XML."""
    root = _parsed(xml)
    return None if root is None else " ".join("".join(_texts(root, frozenset(skip))).split())


def dispatch_paragraphs(xml: str | None, skip: Iterable[str] = ("authorialNote",)) -> list[dict]:
    """path, anchor, text of each paragraph of a dispatch: the headings above it and the article that the last of them names."""
    root = _parsed(xml)
    out: list[dict] = []

    def walk(e: ET.Element, path: list[str]) -> None:
        heading = next((" ".join("".join(_texts(x, frozenset())).split()) for x in e if _name(x) == "heading"), None)
        here = [*path, heading] if heading else path
        for child in e:
            if _name(child) == "p":
                text = " ".join("".join(_texts(child, frozenset(skip))).split())
                if text:
                    anchor = next((m.group(1) for h in reversed(here) if (m := re.search(r"\bArt\.\s*(\d+[a-z]?)", h))), None)
                    out.append({"path": " / ".join(here), "anchor": anchor, "text": text})
            elif _name(child) != "heading":
                walk(child, here)

    if root is not None:
        walk(root, [])
    return out


# What begins an article of a plain law text, and Latin ordinals behind its number.
_ARTICLE = re.compile(r"(?m)^[ \t]*(?:Art\.|§)\s*(\d+(?:bis|ter|quater|quinquies|sexies|septies|[a-z])?)\b\.?[ \t]*")


def segmented(text: str | None) -> list[dict]:
    """number, heading, text of each article of a plain law text.

    The rest of the first line is the heading if it begins with a capital, has
    no closing sign and at most 120 characters; text before the first article is left out.
    """
    body = (text or "").replace(" ", " ").replace("‑", "-")
    marks = list(_ARTICLE.finditer(body))
    out = []
    for k, m in enumerate(marks):
        first, _, rest = body[m.end() : marks[k + 1].start() if k + 1 < len(marks) else len(body)].partition("\n")
        first = first.strip()
        titled = 0 < len(first) <= 120 and first[0].isupper() and first[-1] not in ".:;,"
        out.append({"number": m.group(1), "heading": first if titled else None, "text": (rest if titled else f"{first}\n{rest}").strip()})
    return out


def html_article(page: str | None, number: str | None) -> str | None:
    """The plain text of the element with the id ``art_<number>``; null if the page has none."""
    if not page or not number:
        return None
    m = re.search(rf"""(?is)<(\w+)[^>]*\bid=["']art_{re.escape(number)}["'][^>]*>(.*?)</\1>""", page)
    return " ".join(html.unescape(re.sub(r"<[^>]+>", " ", m.group(2))).split()) if m else None


def overridden(df: DataFrame, by: str, direct: Column, few: float = 5.0) -> DataFrame:
    """``df`` where a group (``by``) that has any direct row keeps only those; ``suspect`` marks a group whose direct rows are ``few`` times fewer."""
    n = df.groupBy(by).agg(F.count_if(direct).alias("_d"), F.count_if(~direct).alias("_o"))
    joined = df.join(n, by).where((F.col("_d") == 0) | direct)
    return joined.withColumn("suspect", (F.col("_d") > 0) & (F.col("_d") * few < F.col("_o"))).drop("_d", "_o")


def known_keys(df: DataFrame) -> DataFrame:
    """key of all records in four forms: id, court and source's id, court with docket and date, court and docket if there is no date.

    df: id, court, source_id, docket, day. Empty parts make no key.
    """
    full = lambda *xs: F.when(sum((F.when(F.coalesce(x, F.lit("")) == "", 1).otherwise(0) for x in xs), F.lit(0)) == 0, F.concat_ws("|", *xs))
    col = F.col
    undated = F.when(F.coalesce(col("day"), F.lit("")) == "", full(col("court"), col("docket")))
    forms = F.array(F.concat(F.lit("id:"), full(col("id"))), F.concat(F.lit("s:"), full(col("court"), col("source_id"))), F.concat(F.lit("d:"), full(col("court"), col("docket"), col("day"))), F.concat(F.lit("u:"), undated))
    return df.select("id", F.explode(F.array_compact(forms)).alias("key")).distinct()


def unseen(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """id of the incoming records of which no key is known yet."""
    keys = known_keys(incoming)
    met = keys.join(known_keys(existing).select("key").distinct(), "key", "left_semi").select("id").distinct()
    return incoming.select("id").distinct().join(met, "id", "left_anti")


def oai_records(xml: str) -> tuple[list[dict], str | None, int]:
    """(records, resumption token, number of deleted ones) of one page of a harvest."""
    root = _parsed(xml)
    records, deleted, token = [], 0, None
    for e in root.iter() if root is not None else ():
        if _name(e) == "resumptionToken":
            token = (e.text or "").strip() or None
        if _name(e) != "record":
            continue
        header = next((x for x in e if _name(x) == "header"), None)
        if header is not None and header.get("status") == "deleted":
            deleted += 1
            continue
        fields: dict[str, list[str]] = {}
        for x in e.iter():
            if x.text and x.text.strip() and not len(x):
                fields.setdefault(_name(x), []).append(x.text.strip())
        records.append({k: "; ".join(v) for k, v in fields.items()})
    return records, token, deleted


class Harvest:
    """A service for the paged source: one partition for each set, whose pages follow by resumption token.

    The option ``client`` names a class with ``sets()`` and ``page(set, token)``
    (XML); ``fields`` the record's fields that make a row.
    """

    def __init__(self, options: dict[str, str]) -> None:
        import importlib

        module, _, name = options["client"].partition(":")
        self.client, self.fields = getattr(importlib.import_module(module), name)(options), options["fields"].split(",")

    def pages(self) -> list:
        return self.client.sets()

    def fetch(self, one_set: object) -> Iterable[tuple]:
        token = None
        while True:
            records, token, _ = oai_records(self.client.page(one_set, token))
            yield from (tuple(r.get(f) for f in self.fields) for r in records)
            if token is None:
                return


class YearlyBindings:
    """A service for the paged source: one partition for each year, whose pages end with a short one.

    The option ``client`` names a class with ``years()``, ``size`` and
    ``page(year, offset)`` (JSON of query bindings); a page that fails ends its year.
    """

    steady = True

    def __init__(self, options: dict[str, str]) -> None:
        import importlib

        module, _, name = options["client"].partition(":")
        self.client, self.fields = getattr(importlib.import_module(module), name)(options), options["fields"].split(",")

    def pages(self) -> list:
        return self.client.years()

    def fetch(self, year: object) -> Iterable[tuple]:
        offset = 0
        while True:
            try:
                bindings = json.loads(self.client.page(year, offset))["results"]["bindings"]
            except (OSError, ValueError):
                return
            yield from (tuple(b.get(f, {}).get("value") for f in self.fields) for b in bindings)
            if len(bindings) < self.client.size:
                return
            offset += self.client.size


_STREAM = re.compile(rb"(?s)<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream")
_SHOWN = re.compile(rb"\(((?:\\.|[^\\()])*)\)\s*(?:Tj|')|\[((?:\((?:\\.|[^\\()])*\)|[^\]])*)\]\s*TJ|(T\*|Td|TD|BT)")


def pdf_pages(blob: bytes | None) -> list[str]:
    """The texts of a PDF's content streams, one for each page; simple encodings only, broken streams are left out.

    Text shown by Tj, ' and TJ counts; moves to a new line break it.
    """
    import zlib

    out = []
    for m in _STREAM.finditer(blob or b""):
        body = m.group(2)
        if b"FlateDecode" in m.group(1):
            try:
                body = zlib.decompress(body)
            except zlib.error:
                continue
        if b"BT" not in body:
            continue
        lines: list[bytes] = [b""]
        for x in _SHOWN.finditer(body):
            if x.group(3):
                lines.append(b"")
            else:
                lines[-1] += x.group(1) if x.group(1) is not None else b"".join(re.findall(rb"\(((?:\\.|[^\\()])*)\)", x.group(2)))
        plain = [re.sub(rb"\\([()\\])", rb"\1", line).decode("latin-1").strip() for line in lines]
        out.append("\n".join(line for line in plain if line))
    return out
