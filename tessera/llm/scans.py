"""Repairing text from scanned pages.

Two passes. The first counts words and neighbouring words over the whole
corpus: partial counts leave each task, and only words above a least share of
all words form the lexicon, which bounds its size whatever the corpus. The
second repairs every text: page numbers and running headers go, divided words
are joined where the lexicon says that the sign is no part of them, misread
letters are put right, lines become paragraphs.

Correction candidates come from a symmetric-delete index: a lexicon word with
one confusable group of letters deleted meets a token with one look-alike
deleted at the same place. Weighted edit distance over the confusion pairs,
the words' frequencies and their neighbours pick the repair.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a letter is misread as, and how dear that is.
CONFUSIONS = {
    ("e", "c"): 1.0, ("t", "f"): 1.0, ("i", "1"): 0.8, ("s", "5"): 0.8, ("o", "0"): 0.8, ("u", "ii"): 1.2, ("l", "1"): 1.0, ("g", "9"): 0.8, ("m", "rn"): 1.0, ("h", "li"): 1.2, ("é", "6"): 0.8,
    ("ü", "ii"): 1.6, ("B", "8"): 0.8, ("ä", "a"): 1.6, ("ö", "o"): 1.6, ("ü", "u"): 1.6, ("S", "5"): 0.8, ("O", "0"): 0.8, ("I", "1"): 0.9, ("I", "l"): 1.4, ("f", "l"): 1.6, ("rn", "m"): 1.2, ("nn", "im"): 1.4, ("l", "I"): 1.2, ("w", "vv"): 1.2, ("b", "6"): 1.0, ("z", "2"): 1.0, ("G", "6"): 1.0, ("Z", "2"): 1.0,
    ("c", "e"): 1.6, ("f", "t"): 1.8, ("n", "ri"): 1.6, ("h", "b"): 1.8, ("è", "6"): 1.2, ("è", "e"): 1.8, ("é", "e"): 1.8, ("à", "a"): 1.8,
}
# Words after a hyphen that stands for a left-out part.
SUSPENDED = {"und", "oder", "sowie", "bzw.", "bis", "et", "ou", "e", "ed", "o", "u", "and", "or", "resp."}
#: Least share of all words and least count of a lexicon word and of a pair; how many times commoner a repair is; words of a partial count.
SHARE, LEAST, COMMONER, FLUSH = 1e-6, 4, 20, 1_500_000
#: Tokens a worker remembers, weight of neighbours, dearest repair (of two misread letters), least look-alikes and their least share of a text that make it a scan.
REMEMBERED, NEIGHBOURS, DEAREST, LOOKALIKES, LOOKALIKE_SHARE = 500_000, 1.0, 3.4, 3, 0.005
#: Least number and share of texts of a running header's part.
HEAD_LEAST, HEAD_SHARE, HEAD_CHARS, PAGE_CHARS = 4, 1e-6, 120, 120

_PAGE = re.compile(r"^\s*(?:[-–—] ?\d{1,4} ?[-–—]|(?:Seite|Page|Pagina|Pag\.|S\.|page|pagina|seite) ?\d{1,4}(?: ?(?:von|sur|di|da|of|/) ?\d{1,4})?|p(?:ag|g)?\. ?\d{1,4}|\[\d{1,4}\]|\d{1,4} ?/ ?\d{1,4}|\d{1,3})\s*$")
#: Marks the counts of header parts among those of pairs.
HEAD = "\0header"
_EDGE = ".,;:!?()[]«»„“”\"'’‹›…"
_DIVIDED = re.compile(r"([^\W\d_])([-¬­‐])\s*$")
_GAP = re.compile(r"\s{2,}|\s[-–—|·]\s")
#: A page line that is more than a number.
_DECORATED = re.compile(r"[^\d\s]")


def core(token: str) -> str:
    """The token without punctuation around it."""
    return token.strip(_EDGE)


def is_page(line: str) -> bool:
    return len(line) < PAGE_CHARS and _PAGE.match(line) is not None


def _parted(line: str) -> bool:
    """Whether a line may have several parts."""
    return "  " in line or "\t" in line or " - " in line or " – " in line or " — " in line or " | " in line or " · " in line


def parts(line: str) -> tuple[list[str], bool]:
    """The parts of a line between gaps and dashes, folded, without page numbers; and whether there were such."""
    low = line.strip().casefold()
    if not _parted(low):
        return ([low], False) if low else ([], False)
    split = [p for p in map(str.strip, _GAP.split(low)) if p]
    kept = [p for p in split if not _PAGE.match(p)]
    return kept, len(kept) < len(split)


def running(lines: list[str], pages: set[int]) -> set[str]:
    """Parts of short lines that stand beside a line of ``pages``, or in one line with a page number, twice or more and on half of the pages."""
    beside: Counter = Counter()
    shown = len(pages)
    near = {j for i in pages for j in (i - 1, i + 1) if 0 <= j < len(lines)} - pages
    for i, line in enumerate(lines):
        if i not in near and "  " not in line and "\t" not in line or i in pages or not 2 < len(line.strip()) <= HEAD_CHARS or line.rstrip().endswith((".", ",", ";", ":", "-", "¬")):
            continue
        own, number = parts(line)
        shown += number
        if i in near or number:
            beside.update({p for p in own if len(p) > 2})
    return {p for p, n in beside.items() if n > 1 and 2 * n >= shown}


def statistics(df: DataFrame, columns: list[str]) -> tuple[dict[str, int], dict[tuple[str, str], int], int, set[str]]:
    """Words and pairs of neighbours above the least share, the least count, and the parts of running headers of ``columns``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        pairs: Counter = Counter()
        heads: Counter = Counter()

        def out() -> pd.DataFrame:
            clean: Counter = Counter()
            for w, n in words.items():
                clean[core(w)] += n
            both: Counter = Counter()
            for (a, b), n in pairs.items():
                both[(core(a), core(b))] += n
            rows = [(w, "", n) for w, n in clean.items() if w] + [(a, b, n) for (a, b), n in both.items() if a and b]
            return pd.DataFrame(rows + [(h, HEAD, n) for h, n in heads.items()], columns=["a", "b", "n"])

        for batch in batches:
            for c in columns:
                for text in batch[c]:
                    if text:
                        tokens = text.split()
                        words.update(tokens)
                        pairs.update(zip(tokens, tokens[1:]))
                        heads[""] += 1
                        if "\n" in text:
                            lines = text.split("\n")
                            heads.update(running(lines, {i for i, line in enumerate(lines) if is_page(line)}))
            if len(pairs) > FLUSH:
                yield out()
                words.clear()
                pairs.clear()
                heads.clear()
        yield out()

    table = df.select(*columns).mapInPandas(count, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    from tessera.session import materialize

    # what the least count leaves out can't be in the lexicon of any corpus
    table = materialize(table.where((F.col("n") >= LEAST) | (F.col("b") == "") | ((F.col("b") == HEAD) & (F.col("a") == ""))), "words")
    total = table.where("b = ''").agg(F.sum("n")).first()[0] or 0
    floor = max(LEAST, int(total * SHARE))
    texts = table.where((F.col("b") == HEAD) & (F.col("a") == "")).agg(F.sum("n")).first()[0] or 0
    heads = {r["a"] for r in table.where((F.col("b") == HEAD) & (F.col("a") != "") & (F.col("n") >= max(HEAD_LEAST, int(texts * HEAD_SHARE)))).select("a").collect()}
    kept = table.where((F.col("n") >= floor) & (F.col("b") != HEAD)).toPandas()
    singles = kept[kept["b"] == ""]
    words = dict(zip(singles["a"], singles["n"].astype(int)))
    doubles = kept[kept["b"] != ""]
    pairs = {(a, b): int(n) for a, b, n in zip(doubles["a"], doubles["b"], doubles["n"]) if a in words and b in words}
    return words, pairs, floor, heads


def counts(df: DataFrame, columns: list[str]) -> tuple[dict[str, int], dict[tuple[str, str], int], int]:
    """``statistics`` without the headers."""
    return statistics(df, columns)[:3]


class Lexicon:
    """Frequent words, pairs of neighbours and the symmetric-delete index."""

    def __init__(self, words: dict[str, int], pairs: dict[tuple[str, str], int], floor: int, heads: Iterable[str] = ()) -> None:
        self.words, self.pairs, self.floor, self.heads = words, pairs, floor, frozenset(heads)
        #: A word below the least count counts as a quarter of it: a repair by letters alone then needs the same share of all words at every size.
        self.unknown = max(1, floor // LEAST)
        self.by_look: dict[str, list[tuple[str, float]]] = defaultdict(list)
        for (right, look), cost in CONFUSIONS.items():
            self.by_look[look].append((right, cost))
        rights = sorted({r for r, _ in CONFUSIONS})
        self.index: dict[str, list[tuple[str, str]]] = defaultdict(list)
        for word, n in words.items():
            if n >= COMMONER and len(word) > 1 and not any(c.isdigit() for c in word):
                for right in rights:
                    at = word.find(right)
                    while at >= 0:
                        self.index[f"{word[:at]}\0{word[at + len(right):]}"].append((right, word))
                        at = word.find(right, at + 1)

    def _one(self, token: str) -> Iterator[tuple[str, float]]:
        for look, rights in self.by_look.items():
            at = token.find(look)
            while at >= 0:
                held = self.index.get(f"{token[:at]}\0{token[at + len(look):]}")
                if held:
                    costs = dict(rights)
                    for right, word in held:
                        if right in costs:
                            yield word, costs[right]
                at = token.find(look, at + 1)

    def candidates(self, token: str) -> list[tuple[str, float]]:
        """Lexicon words that ``token`` may be a misreading of, with their scores; none if it is a good word itself."""
        if len(token) < 2 or not any(c.isalpha() for c in token) or token.isupper() and not any(c.isdigit() for c in token):
            return []
        own = self.words.get(token, self.unknown)
        found: dict[str, float] = {}

        def offer(word: str, cost: float) -> None:
            if word != token and cost < found.get(word, DEAREST):
                found[word] = cost

        for word, cost in self._one(token):
            offer(word, cost)
        if not found and len(token) > 4:
            # two misreadings: undo one, look up the other
            for look, rights in self.by_look.items():
                at = token.find(look)
                while at >= 0:
                    for right, cost in rights:
                        for word, more in self._one(token[:at] + right + token[at + len(look) :]):
                            offer(word, cost + more)
                    at = token.find(look, at + 1)
        odd = any(c.isdigit() for c in token)
        least = COMMONER * own if not odd else max(LEAST, own)
        scored = [(w, log(self.words[w]) - 2.5 * c) for w, c in found.items() if self.words[w] >= least and (odd or c < 1.5 or len(token) > 4)]
        if not scored and ("'" in token or "’" in token):
            cut = max(token.rfind("'"), token.rfind("’")) + 1
            if 0 < cut < len(token) - 2 and token[cut:] not in self.words:
                return [(token[:cut] + w, s) for w, s in self.candidates(token[cut:])]
        return sorted(scored, key=lambda x: (-x[1], x[0]))

    def divided(self, left: str, sign: str, right: str) -> bool:
        """Whether ``sign`` at a line end divides a word and is no part of its spelling."""
        if sign in "¬­":
            return True
        if right.lower() in SUSPENDED or right.rstrip(",;.").lower() in SUSPENDED:
            whole = self.words.get(core(left + right), 0)
            return whole > 0 and whole >= self.words.get(core(f"{left}-"), 0)
        joined, spelled = self.words.get(core(left + right), 0), self.words.get(core(f"{left}-{right}"), 0)
        if right[:1].isupper():
            return joined > spelled
        return joined >= spelled


class _Odd(dict):
    """token -> whether it is unknown and looks like a word of the lexicon. Filled as tokens come."""

    def __init__(self, repairer: Repairer) -> None:
        self.repairer = repairer

    def __missing__(self, token: str) -> bool:
        if len(self) > REMEMBERED:
            self.clear()
        lexicon = self.repairer.lexicon
        self[token] = found = lexicon.words.get(core(token), 0) <= lexicon.unknown and bool(self.repairer._choices(token))
        return found


class Repairer:
    """Repairs texts by a lexicon; remembers what it decided on each token."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.known: dict[str, list[tuple[str, float]]] = {}
        self.odd = _Odd(self)

    def _choices(self, token: str) -> list[tuple[str, float]]:
        found = self.known.get(token)
        if found is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            word = core(token)
            found = self.known[token] = self.lexicon.candidates(word) if word else []
        return found

    def frames(self, lines: list[str], docket: str | None) -> dict[int, str]:
        """line number -> 'page' or 'header', for the lines of a text that shows the pages of a scan.

        Header parts are the docket, what the corpus has learned and what comes
        back in this text. A text shows pages by two lines with page numbers, by one
        at a page's edge (the text's first or last line, or beside a header), or by a
        header that comes back.
        """
        pages = [i for i, line in enumerate(lines) if is_page(line)]
        names = self.lexicon.heads | running(lines, set(pages))
        if docket and docket.strip():
            names |= {docket.strip().casefold()}
        named: list[int] = []
        back: Counter = Counter()
        longest = max(map(len, names), default=0)
        numbered: list[int] = []
        for i, line in enumerate(lines):
            if len(line) > longest and not _parted(line) and len(line.strip()) > longest or len(line) > HEAD_CHARS and len(line.strip()) > HEAD_CHARS:
                continue
            own, number = parts(line)
            if own and names.issuperset(own):
                if number:
                    numbered.append(i)
                else:
                    named.append(i)
                back.update(set(own))
        if len(pages) + len(numbered) < 2 and max(back.values(), default=0) < 2:
            shown = [i for i, line in enumerate(lines) if line.strip()]
            edges = {shown[0], shown[-1]} if shown else set()
            if not any(i - 1 in named or i + 1 in named or i in edges and _DECORATED.search(lines[i]) for i in pages) and not edges & set(numbered):
                return {}
        frames = {i: "page" for i in pages} | {i: "header" for i in [*named, *numbered]}
        # other lines that come back beside page numbers
        beside: dict[str, list[int]] = defaultdict(list)
        for i in pages:
            for j in (i - 1, i + 1):
                if 0 <= j < len(lines) and j not in frames and 3 < len(lines[j].strip()) < 80 and not lines[j].strip().endswith((".", ",", "-")):
                    beside[re.sub(r"\d+", "9", lines[j].strip().casefold())].append(j)
        for same in beside.values():
            if len(same) > 2 and len(same) * 2 > len(pages):
                frames |= {j: "header" for j in same}
        return frames

    def misread(self, text: str) -> bool:
        """Whether so many of the text's words look like misread ones that it comes from a scan."""
        tokens = text.split()
        odd = self.odd
        alike = [t for t in tokens if odd[t]]
        return len(alike) >= LOOKALIKE_SHARE * len(tokens) and len(set(alike)) >= LOOKALIKES

    def repair(self, text: str | None, docket: str | None = None) -> tuple[str | None, list[tuple[str, str]]]:
        """The text as continuous paragraphs, and (kind, item) of each repair. Null stays null, an empty text empty."""
        if not text:
            return text, []
        lines = text.split("\n")
        frames = self.frames(lines, docket)
        items: list[tuple[str, str]] = [(kind, lines[i].strip()) for i, kind in frames.items()]
        paragraphs: list[list[str]] = [[]]
        open_word: tuple[str, str] | None = None
        for i, line in enumerate(lines):
            if i in frames:
                continue
            tokens = line.split()
            if not tokens:
                # a page break inside a paragraph leaves a blank line beside the number; any other one ends it
                if open_word is None and not (frames and ((i + 1) in frames or (i - 1) in frames) and paragraphs[-1] and paragraphs[-1][-1][-1:].isalnum()):
                    paragraphs.append([])
                continue
            if open_word is not None:
                left, sign = open_word
                right = tokens[0]
                if right[:1].isalpha() and self.lexicon.divided(left, sign, right):
                    tokens[0] = left + right
                    items.append(("hyphen", left + right))
                else:
                    tokens[0] = f"{left}{sign}{right}" if not (right.rstrip(",;.").lower() in SUSPENDED) else f"{left}{sign} {right}"
                open_word = None
            m = _DIVIDED.search(tokens[-1])
            if m and len(tokens[-1]) > 1:
                open_word = (tokens.pop()[:-1], m.group(2))
            paragraphs[-1] += tokens
        if open_word is not None:
            paragraphs[-1].append("".join(open_word))
        read = bool(frames) or self.misread(text)
        out = []
        for words in paragraphs:
            if not words:
                continue
            if read:
                for k, token in enumerate(words):
                    choices = self._choices(token)
                    if choices:
                        best = self._best(choices, words, k)
                        word = core(token)
                        if best != word:
                            items.append(("char", best))
                            words[k] = token.replace(word, best, 1)
            out.append(" ".join(words))
        fixed = []
        for kind, item in items:
            if kind == "hyphen":
                item = core(item)
                choices = self._choices(item) if read else []
                item = choices[0][0] if choices else item
            if item:
                fixed.append((kind, item))
        return "\n\n".join(out), fixed

    def _best(self, choices: list[tuple[str, float]], words: list[str], k: int) -> str:
        if len(choices) == 1:
            return choices[0][0]
        before, after = core(words[k - 1]) if k else "", core(words[k + 1]) if k + 1 < len(words) else ""
        pairs = self.lexicon.pairs
        return max(choices, key=lambda c: (c[1] + NEIGHBOURS * (log(1 + pairs.get((before, c[0]), 0)) + log(1 + pairs.get((c[0], after), 0))), c[0]))[0]


def lexicon(df: DataFrame, columns: list[str]) -> Lexicon:
    """The lexicon of all texts of ``columns``."""
    return Lexicon(*statistics(df, columns))


#: The last broadcast value and its repairer, kept for the worker's next tasks.
_KEPT: list = [None, None]


def _repairer(value: tuple) -> Repairer:
    if _KEPT[0] is not value:
        _KEPT[:] = [value, Repairer(Lexicon(*value))]
    return _KEPT[1]


def repairs(df: DataFrame, id_column: str, docket_column: str, columns: list[str], lex: Lexicon, texts: bool = False) -> DataFrame:
    """id_column, field_name, kind, item of each different repair; with ``texts``, id_column, field_name, text of each row instead.

    Null and empty texts give no row. Rows with the same id are repaired each
    and give the same items once.
    """
    shared = df.sparkSession.sparkContext.broadcast((lex.words, lex.pairs, lex.floor, lex.heads))
    kind = dict(df.dtypes)[id_column]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repairer = _repairer(shared.value)
        for batch in batches:
            rows: dict[tuple, None] = {}
            for c in columns:
                for i, docket, text in zip(batch["id"], batch["docket"], batch[c]):
                    if text:
                        whole, items = repairer.repair(text, docket)
                        if texts:
                            rows[(i, c, whole)] = None
                        else:
                            rows |= {(i, c, k, item): None for k, item in items}
            yield pd.DataFrame(list(rows), columns=["id", "field_name", "text"] if texts else ["id", "field_name", "kind", "item"])

    source = df.select(F.col(id_column).alias("id"), F.col(docket_column).alias("docket"), *columns)
    schema = f"id {kind}, field_name string, text string" if texts else f"id {kind}, field_name string, kind string, item string"
    found = source.mapInPandas(scan, schema)
    # whole texts are not moved to look for equal ones
    return (found if texts else found.distinct()).withColumnRenamed("id", id_column)
