"""Personal information in free text.

One Aho-Corasick pass finds anchors: at-signs, dialling prefixes, identifier
and street words, given names. Local parsers then expand each anchor to the
whole email address, number, street address or name and check it (check digit,
top-level domain, boundaries). Names are also anchored by titles, initials,
address blocks and signatures. Which words are given names and which can be no
family name is learned from where they stand in all texts (``learn``), on top of a
public list of given names. Texts are read whole, in Arrow batches.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common given names of the five languages, as any public list of names has them.
GIVEN = (
    "Adrian Alain Albert Alessandro Alexander Alexandra Alfred Alice Andrea Andreas Angela Anita Anna Anne Annemarie Anton Antonio Arnold Barbara Beat Beatrice Bernard "
    "Bernhard Bettina Brigitte Bruno Carla Carlo Carmen Caroline Catherine Chantal Charles Chiara Christian Christina Christine Christoph Claude Claudia Claudio Corinne "
    "Cornelia Daniel Daniela Daniele David Denise Diego Dieter Dominique Doris Edith Eduard Elena Elisabeth Emma Enrico Eric Erika Ernst Esther Eva Fabio Felix Ferdinand Florian "
    "Francesca Francesco François Françoise Franz Friedrich Fritz Gabriel Gabriela Georg Georges Gerhard Gian Giovanna Giovanni Giuseppe Guido Hans Hansruedi Heidi Heinrich "
    "Helena Helene Henri Hermann Hugo Irene Isabelle Jacqueline Jacques James Jean Jeanne Johann Johannes John Josef Julia Julien Jürg Karin Karl Katharina Klaus Kurt Laura Laurent Lea "
    "Leo Luca Lucia Lukas Madeleine Manuela Marc Marco Margrit Maria Marianne Marie Mario Markus Martha Martin Martina Mary Matthias Max Michael Michel Michele Monika "
    "Nadia Nicolas Nicole Oliver Olivier Oskar Paolo Pascal Patricia Patrick Paul Peter Philippe Pia Pierre Rahel Regula Reto Richard Robert Roberto Roland Rolf Rosa Ruth "
    "Samuel Sandra Sara Silvia Simon Sophie Stefan Stéphane Susanne Sylvie Theresia Thierry Thomas Ueli Urs Ursina Ursula Verena Walter Werner William Yves"
).split()
# Titles and parts in a case before the full name of a private person.
TITLES = (
    "Herr Herrn Frau Zeuge Zeugen Zeugin Mme Madame Monsieur Mlle témoin témoins signora signor Signora Signor sig. sig.ra Sig. Sig.ra teste testimone Mr Mr. Mrs Mrs. Ms Ms. Miss "
    "witness Witness signur signura Signur Signura perditga Dr. Prof. Beschwerdeführer Beschwerdeführerin Kläger Klägerin Beklagte Beklagter Beklagten Versicherte Versicherter Patientin Patient recourant recourante "
    "ricorrente demandeur demanderesse attore attrice plaintiff defendant"
).split()
# Offices before a family name that stands alone.
OFFICES = (
    "Richter Richterin Bundesrichter Bundesrichterin Oberrichter Oberrichterin Einzelrichter Einzelrichterin Präsident Präsidentin Gerichtsschreiber Gerichtsschreiberin Referent Referentin "
    "juge Juge greffier greffière président présidente giudice cancelliere cancelliera segretario segretaria presidente derschader derschadra actuar actuara judge Judge clerk"
).split()
# Words with a capital that are no part of a name.
STOP = frozenset(
    "Der Die Das Den Dem Des Ein Eine Einen Einer Eines Er Sie Es Wir Im Am Zum Zur Vom Beim Mit Nach Vor Auf Aus Bei Für Von Zu An In Um Als Wie Wenn Da Dass Gemäss Laut Soweit Gegen Und Oder "
    "Nicht Auch Dieser Diese Dieses Art Abs Der Le La Les Un Une Des Du Au Aux Il Elle Ils Elles On Par Pour Dans Sur Selon Avec Sans Et Ou Que Ce Cette Ces Lo Gli Una Uno Del Della Dei "
    "Nel Nella Con Per Da Di Secondo Ed Che Questo Questa Igl Ina In Tenor Cun Per The A An Of By With According And Or He She It They "
    "Januar Februar März April Mai Juni Juli August September Oktober November Dezember Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag "
    "Recht Gericht Urteil Kammer Abteilung Kanton Gemeinde Staat Bund Schweiz Suisse Svizzera Switzerland Rechtsanwalt Rechtsanwältin Fürsprecher Advokat Advokatin Avvocato Avocat Avocate Maître Avv "
    "Doktor Professor Direktor Direktorin Gutachter Gutachterin Rechnung Zeuge Herr Frau Treuhand Partner Kommentar Bundesgericht Obergericht Kantonsgericht Verwaltungsgericht Tribunal Tribunale Cour Corte Court "
    "AG SA GmbH Sàrl Sagl KG Ltd Inc BGE ATF DTF ZGB OR StGB CC CO CP LTF BGG".split()
)
STOP |= {o.capitalize() for o in OFFICES} | {t.rstrip(".").capitalize() for t in TITLES}
# Words that make the name before them one of a firm.
_FIRM = r" (?:&|AG\b|SA\b|GmbH\b|Sàrl\b|Sagl\b|KG\b|Ltd\b|Inc\b|Treuhand\b|Partner\b)"
# The last words of closings of letters, the line after which a name signs.
CLOSINGS = "Grüsse Grüssen Gruss Hochachtungsvoll salutations distinguées cordialement saluti ossequi regards sincerely faithfully salids".split()
#: Share and least count of a word that is told by its uses; share of its uses as a given name or beside one; words of a partial count.
WORD_SHARE, WORD_LEAST, AS_GIVEN, AS_FAMILY, FLUSH = 1e-6, 4, 0.2, 0.05, 200_000
# Words of streets, in compounds and alone.
STREET_ENDS = "strasse straße gasse weg platz rain halde allee ring graben quai steig hof matte".split()
STREET_WORDS = (
    "rue avenue chemin route place impasse ruelle sentier quai boulevard allée passage montée esplanade "
    "via piazza strada salita vicolo viale contrada largo piazzetta"
).split()
# Words after which an identity document's number stands.
PAPER_CUES = ["Reisepass", "Ausweis", "Identitätskarte", "passeport", "passaporto", "'identit", "identità", "Passeport", "Passaporto", "passport", "Pass Nr", "identity card", "pass da viadi"]

_UP = "A-ZÀ-ÖØ-Þ"
_CAPITALS = [c for c in map(chr, range(65, 223)) if re.match(f"[{_UP}]", c)]
_SURNAME = rf"[{_UP}][\w'’]*[^\W\d_](?:-[{_UP}][\w'’]*[^\W\d_])?"
_PART = r"(?:(?:von|van|de|di|du|del|della|dal|da|des|zur|zum|la|le|der|den)\s){1,3}|d['’]"
_CAP = rf"[{_UP}][\w’']*[^\W\d_](?:-[{_UP}][\w’']*[^\W\d_])*"
_FORWARD = re.compile(rf"(\s)({_PART})?({_SURNAME})(?![\w@])")
_BACK_WORD = re.compile(rf"(?<![\w.@'’-])((?:{_PART})?({_SURNAME}))(,?\s)")
_AFTER_INITIAL = re.compile(rf"(\s)(?:{_PART})?({_SURNAME})(?![\w@])")
_PAIR = re.compile(rf"({_CAP})(,?)\s(?:{_PART})?({_SURNAME})(?![\w@])")
_ALONE = re.compile(rf"({_CAP})(?!\s[{_UP}]|\w)")
_LINE = re.compile(rf"\n({_CAP})(,?) (?:{_PART})?({_SURNAME})(?=\n[^\n]*\d ?[a-z]?\n(?:[A-Z]{{1,2}}-)?\d{{4,5}} )")
_SIGNED = re.compile(rf"[^\n\w]*\n+({_CAP})(,?) (?:{_PART})?({_SURNAME})(?=[\n»]|$)")
_WORD = re.compile(rf"(?<![\w@.])[{_UP}][\w’'-]*[^\W\d_]")
_FIRM_AFTER, _HOUSED = re.compile(_FIRM), re.compile(r"\s\d")
_FIRST_INITIALS = frozenset(f"{c}." for c in _CAPITALS)
# Particles of family names.
_PARTICLES = frozenset("von van de di du del della dal da des zur zum la le der den".split())
_PHONE = re.compile(r"(?:(?:\+|00)\d{2}[ ./-]?(?:\(0\))?[ ./-]?\d{2}|0\d{2})(?:[./-]|\s)?\d{3}(?:[./-]|\s)?\d{2}(?:[./-]|\s)?\d{2}(?!\d)")
_NEW_AHV = re.compile(r"756([ .-]?)\d{4}\1\d{4}\1\d{2}(?![\d.-]?\d)")
_OLD_AHV = re.compile(r"\.\d{2}\.\d{3}\.\d{3}(?![\d.]?\d)")
_PAPER = re.compile(rf"(?<![\w-])[A-Z](?:\d{{7}}|\d{{3}}[A-Z]\d{{4}})(?![\w-])")
_LOCAL_SIGNS = "_.%+-"
_DOMAIN = re.compile(r" ?([A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,})(?![\w-])")
_HOUSE = r"\d{1,4} ?[a-z]?(?![\w'’.]*\d)(?!\w)"
_COMPOUND = re.compile(rf"(?:strasse|straße|gasse|weg|platz|rain|halde|allee|ring|graben|quai|steig|hof|matte|str\.)\s({_HOUSE})", re.I)
# Adjectives that begin a street's name.
_ADJECTIVE = r"(?:Alt|Neu|Hinter|Vorder|Ober|Unter|Lang|Kurz|Gross|Groß|Klein|Inner|Äusser|Mittler|Breit|Eng|Hoh|Tief|Schmal)e[rnms]?"
_ADJECTIVE_BEFORE = re.compile(rf"(?<![\w@._-]){_ADJECTIVE}\s")
_STREET_AFTER = re.compile(
    rf"(?:\s(?:de la|de l['’]|des|de|du|della|dell['’]|delle|degli|dei|dal|dalla|del|di|da|al|alla|ai|alle|la|le|les|d['’]|l['’]))?(?:\s|(?<=['’]))[{_UP}][\w'’-]*(?:\s[{_UP}][\w'’-]*){{0,3}}(?:\s({_HOUSE}))?"
)
_PLACED = re.compile(rf"(?:Im|Am|Zum|Zur|(?:Unter|Auf|In|An|Hinter|Ob|Bei|Vor) de[rmn]) (?!Jahr|Verfahren|Fall|Umfang|Band|Monat)[{_UP}][\w-]+ \d{{1,3}}[a-z]?(?=,? (?:in |à |a )?\d{{4}} [{_UP}]|\n\d{{4}} [{_UP}]| in [{_UP}]| ist | war )")
_HOUSE_BEFORE = re.compile(r"(?<![\w.'’-])(\d{1,4} ?[a-z]?),?\s$")  # a house number has four digits and a letter at most
_BLOCK = re.compile(rf"\n([{_UP}][^\n@,;:]+\s\d{{1,3}}[a-z]?)\n(?=\d{{4}} [{_UP}])")


class Names:
    """Given names and common words, as ``learn`` finds them in the corpus; without it, the fixed lists alone."""

    def __init__(self, given: Iterable[str] = (), common: Iterable[str] = ()) -> None:
        self.given = frozenset(GIVEN) | frozenset(given)
        self.common = frozenset(common) - self.given
        self.machine = _automaton(self.given)

    def __reduce__(self) -> tuple:
        return Names, (sorted(self.given), sorted(self.common))

    def family(self, word: str) -> bool:
        """Whether ``word`` may be a family name: no word of the language, alone or in any of its joined parts."""
        if len(word) < 3:
            return False
        for part in _spelled(word).split("-"):
            if part in STOP or part in self.common or part in self.given and "-" not in word:
                return False
        return True


def _spelled(word: str) -> str:
    return word.title() if word.isupper() else word


def _automaton(given: Iterable[str]) -> ahocorasick.Automaton:
    words: dict[str, set[str]] = {}

    def add(kind: str, *values: str) -> None:
        for v in values:
            words.setdefault(v, set()).add(kind)

    add("email", "@", "(at)", "[at]", "(AT)", "[AT]", "(At)", "[At]", " at ")
    add("phone", "+", *[f"0{n:02d}" for n in range(10, 100)], "00")
    add("paper", *PAPER_CUES)
    add("compound", *[f"{w}{s}" for w in [*STREET_ENDS, "str."] for s in " \n"], *[f"{w.capitalize()}{s}" for w in STREET_ENDS for s in " \n"])
    add("street", *[f"{w}{s}" for w in STREET_WORDS for s in " \n"], *[f"{w.capitalize()}{s}" for w in STREET_WORDS for s in " \n"])
    add("placed", "Im ", "Am ", "Zum ", "Zur ", *[f"{p} de{e} " for p in ("Unter", "Auf", "In", "An", "Hinter", "Ob", "Bei", "Vor") for e in "rmn"])
    add("given", *given)
    add("number", "756")
    add("titled", *[f"{t}{s}" for t in TITLES for s in " \n"])
    add("office", *[f"{o}{s}" for o in OFFICES for s in " \n"])
    add("signed", *CLOSINGS)
    add("initial", *[f"{c}.{s}" for c in _CAPITALS for s in " \n"])
    machine = ahocorasick.Automaton()
    for word, kinds in words.items():
        machine.add_word(word, (len(word), tuple(sorted(kinds))))
    machine.make_automaton()
    return machine


def _checked(digits: str) -> bool:
    return len(digits) == 13 and sum(int(c) * (3 if i % 2 else 1) for i, c in enumerate(digits)) % 10 == 0


def _back(t: str, at: int, signs: str) -> int:
    """Where the run of letters, digits and ``signs`` that ends before ``at`` begins."""
    while at and (t[at - 1].isalnum() or t[at - 1] in signs):
        at -= 1
    return at


def _email(t: str, start: int, end: int) -> tuple[int, int] | None:
    stop = start - 1 if t[start - 1 : start] == " " else start
    at, domain = _back(t, stop, _LOCAL_SIGNS), _DOMAIN.match(t, end)
    if not domain or not any(c.isalnum() for c in t[at:stop]):
        return None
    if t[start:end] == " at " and " " in t[start - 1 : start]:
        return None
    while t[at] in ".+-%":
        at += 1
    return at, domain.end()


def _phone(t: str, start: int) -> tuple[int, int] | None:
    if start and (t[start - 1].isalnum() or t[start - 1] in "_+.-/'’"):
        return None
    m = _PHONE.match(t, start)
    return m.span() if m else None


def _street(t: str, start: int, end: int) -> tuple[int, int] | None:
    if start and (t[start - 1].isalnum() or t[start - 1] in "-'’@._"):
        return None
    m = _STREET_AFTER.match(t, end - 1)
    if not m:
        return None
    if m.group(1):
        return start, m.end(1)
    before = _HOUSE_BEFORE.search(t, max(0, start - 8), start)
    return (before.start(1), m.end()) if before else None


def _word_before(t: str, at: int) -> int:
    """Where the word that ends with the blank before ``at`` begins."""
    return _back(t, at - 1, "'’-.") if at and t[at - 1].isspace() else at


def _compound(t: str, start: int, end: int) -> tuple[int, int] | None:
    m = _COMPOUND.match(t, start)
    if not m:
        return None
    at = _back(t, start, "_.-")
    if at == start and not t[start].isupper():
        return None
    left = _word_before(t, at)
    if left < at and _ADJECTIVE_BEFORE.fullmatch(t, left, at):
        at = left
    if at and (t[at - 1].isalnum() or t[at - 1] in "-@._"):
        return None
    if not t[at].isupper():
        return None
    return at, m.end(1)


def _back_name(t: str, start: int) -> re.Match | None:
    """The family name, with its particles, right before ``start``."""
    first = at = _word_before(t, start - 1 if t[start - 2 : start - 1] == "," else start)
    if t[start - 2 : start - 1] == ",":
        first = at = _back(t, start - 2, "'’-.")
    while at and t[at - 1].isspace():
        word = _word_before(t, at)
        if word == at or t[word : at - 1] not in _PARTICLES:
            break
        at = word
    return _BACK_WORD.fullmatch(t, at, start) or _BACK_WORD.fullmatch(t, first, start)


def _name(t: str, start: int, end: int, names: Names) -> tuple[int, int] | None:
    if start and (t[start - 1].isalnum() or t[start - 1] in "-@._"):
        return None
    if end < len(t) and (t[end].isalnum() or t[end] in "@_+" or (t[end] == "-" and t[end + 1 : end + 2].isupper()) or (t[end] == "." and t[end + 1 : end + 2].isalnum())):
        return None
    after = _FORWARD.match(t, end)
    if after and (after.group(1) != " " or not names.family(after.group(3))):
        after = None
    if after and after.group(3).isupper():
        return start, after.end(3)
    before = _back_name(t, start) if start and t[start - 1].isspace() else None
    if before and not names.family(before.group(2)):
        before = None
    if after and _FIRM_AFTER.match(t, after.end(3)):
        return None
    if after and _HOUSED.match(t, after.end(3)):
        after = None
    if before and (before.group(2).isupper() or not after):
        return before.start(1), end
    return (start, after.end(3)) if after else None


def _initial(t: str, last: int, names: Names | None) -> tuple[int, int, str] | None:
    """(start, end, family) of the name whose (last) initial's point stands at ``last``; before or behind it the family name.

    An initial at a text's start, or at a paragraph's with more words or nothing
    behind, is rather the letter of a paragraph.
    """
    at = last - 1
    for first in (at - 2, at - 3):
        # another initial before it, with or without a blank or hyphen between
        if first >= 0 and t[first : first + 2] in _FIRST_INITIALS and t[first + 2 : at] in ("", " ", "-") and not (first and (t[first - 1].isalnum() or t[first - 1] in "_.'’@-")):
            at = first
            break
    if at and (t[at - 1].isalnum() or t[at - 1] in "_.'’@-"):
        return None
    m = _AFTER_INITIAL.match(t, last + 1)
    if m and (names is None or names.family(m.group(2))):
        if at == 0 or _FIRM_AFTER.match(t, m.end()):
            return None
        if t[at - 1] == "\n":
            # where nothing is learned about words, the end of a sentence counts as that of a paragraph
            opens = t[at - 2 : at - 1] in ("", "\n") or not (names and names.common) and t[at - 2] in ".!?:;"
            stop = t.find("\n", m.end())
            if opens and (stop < 0 and m.end() == len(t) or any(map(str.isalnum, t[m.end() : len(t) if stop < 0 else stop]))):
                return None
        return at, m.end(), m.group(2)
    if names is not None and t[at - 2 : at] == ", " and t[at:last] != "M":  # M. is a title, too
        before = _back_name(t, at)
        if before and names.family(before.group(2)):
            return before.start(1), last + 1, before.group(2)
    return None


def _titled(t: str, start: int, end: int) -> re.Match | None:
    return None if start and (t[start - 1].isalnum() or t[start - 1] in "._-") else _PAIR.match(t, end)


def _pair(m: re.Match | None, names: Names) -> bool:
    """Whether the two words of ``m`` may be a given and a family name."""
    return m is not None and names.family(m.group(3)) and (names.family(m.group(1)) or _spelled(m.group(1)) in names.given) and not _FIRM_AFTER.match(m.string, m.end(3))


def find(text: str | None, names: Names | None = None) -> list[tuple[int, int, str]]:
    """(start, end, type) of each piece of personal data, in order, without overlaps.

    Null and empty texts hold none. Where two pieces overlap, an email wins
    over an address, number or name; otherwise the earlier and longer one wins.
    """
    if not text:
        return []
    names = names or _plain()
    found: set[tuple[int, int, int, str]] = set()
    cues: list[int] = []
    for last, (size, kinds) in names.machine.iter(text):
        start, end = last - size + 1, last + 1
        for kind in kinds:
            if kind == "phone":
                span, rank, name = _phone(text, start), 1, "phone"
            elif kind == "given":
                span, rank, name = _name(text, start, end, names), 3, "name"
            elif kind == "email":
                span, rank, name = _email(text, start, end), 0, "email"
            elif kind == "street":
                span, rank, name = _street(text, start, end), 2, "address"
            elif kind == "compound":
                span, rank, name = _compound(text, start, end), 2, "address"
            elif kind == "placed":
                m = _PLACED.match(text, start)
                span, rank, name = m and m.span(), 2, "address"
            elif kind == "initial":
                span, rank, name = _initial(text, end - 2, names), 3, "name"
                span = span and span[:2]
            elif kind == "titled":
                m = _titled(text, start, end)
                span, rank, name = _pair(m, names) and m.span(), 3, "name"
            elif kind == "signed":
                m = _SIGNED.match(text, end)
                span, rank, name = _pair(m, names) and (m.start(1), m.end(3)), 3, "name"
            elif kind == "number":
                m = _NEW_AHV.match(text, start)
                good = m and not text[start - 1 : start].isalnum() and _checked(re.sub(r"\D", "", m.group()))
                span, rank, name = good and m.span(), 1, "id_number"
            elif kind == "paper":
                cues.append(end)
                continue
            else:
                continue
            if span:
                found.add((rank, *span, name))
    if cues:
        # a cue holds for its paragraph
        reach = at = 0
        for cue in cues:
            if cue < reach:
                continue
            at, reach = max(reach, text.rfind("\n\n", 0, cue)), text.find("\n\n", cue)
            reach = len(text) if reach < 0 else reach
            found.update((1, m.start(), m.end(), "id_number") for m in _PAPER.finditer(text, at, reach))
    for m in _OLD_AHV.finditer(text):
        at = m.start() - 3
        if at >= 0 and text[at : at + 3].isdigit() and not (at and (text[at - 1].isdigit() or text[at - 1] == ".")):
            found.add((1, at, m.end(), "id_number"))
    if "\n" in text:
        for m in _BLOCK.finditer(text):
            found.add((2, m.start(1), m.end(1), "address"))
        found.update((3, m.start(1), m.end(3), "name") for m in _LINE.finditer(text) if _pair(m, names))
    starts: list[int] = []
    kept: list[tuple[int, int, str]] = []
    for _, start, end, kind in sorted(found, key=lambda x: (x[0], x[1], -x[2])):
        at = bisect_left(starts, start)
        if (at == len(kept) or kept[at][0] >= end) and (at == 0 or kept[at - 1][1] <= start):
            starts.insert(at, start)
            kept.insert(at, (start, end, kind))
    return kept


@lru_cache(maxsize=1)
def _plain() -> Names:
    return Names()


def redact(text: str | None, names: Names | None = None, numbered: bool = False) -> str | None:
    """``text`` with ``[EMAIL]``, ``[PHONE]``, ``[ID_NUMBER]``, ``[ADDRESS]`` or ``[NAME]`` for each piece; null stays null.

    ``numbered`` placeholders (``[NAME_1]``, ``[NAME_2]``) tell the different
    pieces of one kind apart: the same piece has the same number throughout.
    """
    if text is None:
        return None
    out, at = [], 0
    numbers: dict[str, dict[str, int]] = {}
    for start, end, kind in find(text, names):
        own = numbers.setdefault(kind, {})
        number = f"_{own.setdefault(text[start:end], len(own) + 1)}" if numbered else ""
        out += [text[at:start], f"[{kind.upper()}{number}]"]
        at = end
    return "".join([*out, text[at:]])


def _uses(text: str, machine: ahocorasick.Automaton, given: Counter, family: Counter) -> None:
    """Counts the words of ``text`` in the places of a given and of a family name."""

    def pair(m: re.Match | None) -> None:
        if m:
            one, comma, two = m.groups()
            first, last = (two, one) if comma or one.isupper() and not two.isupper() else (one, two)
            given[_spelled(first)] += 1
            family.update(_spelled(last).split("-"))

    for last, (size, kinds) in machine.iter(text):
        start, end = last - size + 1, last + 1
        for kind in kinds:
            if kind == "titled":
                pair(_titled(text, start, end))
            elif kind == "signed":
                pair(_SIGNED.match(text, end))
            elif kind == "office":
                m = not text[start - 1 : start].isalpha() and _ALONE.match(text, end)
                if m:
                    family.update(_spelled(m.group(1)).split("-"))
            elif kind == "initial":
                hit = _initial(text, end - 2, None)
                if hit:
                    family.update(_spelled(hit[2]).split("-"))
            elif kind == "given" and text[end : end + 1] == " " and not (text[start - 1 : start].isalpha() or text[start - 1 : start] == "-"):
                m = _AFTER_INITIAL.match(text, end)
                if m:
                    family.update(_spelled(m.group(2)).split("-"))
    if "\n" in text:
        for m in _LINE.finditer(text):
            pair(m)


def learn(df: DataFrame, text_column: str) -> Names:
    """Given names and common words of all texts, by where they stand.

    Every word with a capital is counted, and how often it stands as a given
    name (after a title, in an address block, under a letter) or as a family
    name (there, after an office, an initial or a known given name). A word that
    mostly stands as a given name is one; one that hardly ever stands as a
    family name is a common word. Only words above a least share of all words
    are told, which bounds both lists whatever the corpus (``WORD_SHARE``: 1e6
    words at most, and by Zipf's law far fewer); a rarer word may be a name.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens: Counter = Counter()
        given: Counter = Counter()
        family: Counter = Counter()
        machine = _plain().machine

        def out() -> pd.DataFrame:
            words: Counter = Counter()
            for token, n in tokens.items():
                for w in _WORD.findall(token):
                    words[_spelled(w)] += n
                    if "-" in w:
                        for part in _spelled(w).split("-"):
                            words[part] += n
            keys = list(words.keys() | given.keys() | family.keys())
            return pd.DataFrame({"word": pd.Series(keys, dtype=object), "n": [words[k] for k in keys], "g": [given[k] for k in keys], "f": [family[k] for k in keys]})

        for batch in batches:
            for text in batch["text"]:
                tokens.update(text.split())
                _uses(text, machine, given, family)
            if len(tokens) > FLUSH:
                yield out()
                tokens.clear()
                given.clear()
                family.clear()
        yield out()

    from tessera.session import materialize

    counted = df.select(F.col(text_column).alias("text")).where(F.length("text") > 0).mapInPandas(count, "word string, n bigint, g bigint, f bigint")
    table = materialize(counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in "ngf"]), "names")
    total = table.agg(F.sum("n")).first()[0] or 0
    least = max(WORD_LEAST, int(total * WORD_SHARE))
    known = table.where(F.col("n") >= least)
    given = [r["word"] for r in known.where((F.col("g") >= 2) & (F.col("g") >= AS_GIVEN * F.col("n"))).select("word").collect()]
    common = [r["word"] for r in known.where(F.col("f") < AS_FAMILY * F.col("n")).select("word").collect()]
    return Names([w for w in given if w not in STOP and len(w) > 2], common)


def find_all(df: DataFrame, id_column: str, text_column: str, names: Names | None = None) -> DataFrame:
    """id_column, pii_type, pii_text: one row for each different piece of each id."""
    shared = df.sparkSession.sparkContext.broadcast(names or Names())

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = {(i, kind, text[a:b]) for i, text in zip(batch["id"], batch["text"]) if text for a, b, kind in find(text, shared.value)}
            yield pd.DataFrame(list(rows), columns=["id", "pii_type", "pii_text"])

    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(F.length("text") > 0)
    kind = dict(source.dtypes)["id"]
    return source.mapInPandas(scan, f"id {kind}, pii_type string, pii_text string").distinct().withColumnRenamed("id", id_column)


def redact_all(df: DataFrame, text_column: str, names: Names | None = None, numbered: bool = False) -> DataFrame:
    """``df`` with ``text_column`` redacted; all other columns and rows as they are."""
    shared = df.sparkSession.sparkContext.broadcast(names or Names())

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: redact(text, shared.value, numbered), na_action="ignore")

    return df.withColumn(text_column, clean(F.col(text_column)))
