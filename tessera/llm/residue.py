"""Template residue, filler, error pages and script notices in place of text.

Trusted records (most of their words are unfilled slots, fillers or the words
of an error page or notice) and unlabelled ones train a naive Bayes model by
expectation-maximisation on a bounded sample. Every passage (line) of every
text is then scored; a record is residue if the odds of all its passages
together say so and at least one of them is residue beyond doubt.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: The bound of the training sample: trusted and unlabelled records; characters of each that are used to train.
TRUSTED, UNLABELLED, SAMPLE_CHARS = 1_000, 1_500, 2_000
#: Only shorter records can be trusted to be residue; longer ones are judged by the model alone.
TRUSTED_CHARS = 1_500
#: Rounds, pseudo-count, share of residue among unlabelled passages, most odds of a word and, for each word, of a passage, odds beyond doubt.
ROUNDS, PSEUDO, PRIOR, WORD_ODDS, PASSAGE_ODDS, DOUBT = 5, 0.3, 0.03, 4.0, 2.0, 0.1
#: Words in the model, least words and greatest share of different ones of a passage that repeats itself, tokens a worker remembers.
KNOWN, REPEAT_WORDS, REPEAT_SHARE, REMEMBERED = 4096, 8, 0.4, 300_000

# Shapes of unfilled slots, as one Java and Python regular expression each.
SLOTS = [
    r"\{\{[^{}\n]{0,40}\}\}", r"\$\{[^{}\n]{0,40}\}", r"<%=?[^%\n]{0,40}%>", r"\[\[[^\[\]\n]{0,40}\]\]", r"\[(?:insérer|inserire|insert|inserir)\s[^\[\]\n]{0,40}\]", r"\[[^\[\]\n]{1,40}\s(?:einfügen|einsetzen|here)\]",
    r"@@\w{1,40}@@", r"%[A-Za-z_]{3,40}%", r"#[A-Za-z_]{3,40}\d?#", r"__[A-Za-z]\w{1,38}__", r"XX[A-Za-z]\w{1,38}XX", r"«[A-Z_]{3,40}»", r"<[A-Z_0-9]{3,40}>", r"<<[^<>\n]{1,40}>>", r"\{%[^{}%\n]{0,40}%\}", r"\{[a-z_0-9]{2,40}\}",
]
# Words that hardly stand at the head of a court text, but on error pages, notices and in fillers.
CUES = [
    r"\b(?:error|erreur|errore|fehler|http status)\s*(?:code\s*)?:?\s*[45]\d\d\b", r"\b[45]\d\d\b\s*[-–:]?\s*(?:not found|forbidden|bad gateway|internal server error|service unavailable|gone|too many requests)", r"\bnot found \(404\)",
    r"\bjavascript\b", r"\bcookies?\b", r"<noscript>", r"\bskripte?\b", r"\bscripts?\b", r"\blorem\b", r"\bipsum\b", r"\b(?:todo\W+todo|tbd|xxxx+\W+xxxx+)\b", r"\bblindtext\b", r"\bplatzhaltertext\b", r"\bfülltext\b", r"\btexte à compléter\b",
    r"\bqui andrà il testo\b", r"\bcoming soon\b", r"\bpage introuvable\b", r"\bpagina inesistente\b", r"\bseite nicht gefunden\b", r"\bsession (?:a expiré|expired)\b", r"\bsitzung ist abgelaufen\b", r"\bschiefgelaufen\b", r"\bkeine treffer\b", r"\bpanne technique\b", r"\bunexpected failure\b", r"\btraceback\b",
    r"\berreur inattendue\b", r"\bsi è verificato un problema\b", r"\bsiamo spiacenti\b", r"\bhoppla\b", r"\boops\b", r"\bnoscript\b", r"\bzugriff verweigert\b", r"\bkein zugriff\b", r"\baccès refusé\b", r"\baccesso negato\b", r"\bmaintenance\b", r"\bwartung\b", r"\bgewartet\b",
    r"\bmanutenzione\b", r"\baccess denied\b", r"\brechargez la page\b", r"\bnicht unterstützt\b", r"\bdésolés?\b", r"\bsorry\b", r"\bun problème est survenu\b", r"\bnessun risultato\b", r"\baucun résultat\b", r"\bno results\b", r"\bcaptcha\b",
]
#: (Half of the cues left out, the model finds 0.96 of the records of sf0.1 that it finds with all, and no other ones.)
#: A slot outweighs the words of a real heading around it.
SLOT_WORDS = " " + "‹slot› " * 6
_SLOT = re.compile("|".join(SLOTS))
_HEX = re.compile(r"^(?=.*\d)[0-9a-f]{5,}$")
_TRIM = "\"'’.,;:!?()[]«»„“”<>|·*…-–"


def trusted(text: Column) -> Column:
    """True for records that are residue beyond doubt.

    Made of slots; a repetition of few words; many words of the usual filler; a
    very short text with a cue; a line that begins with an error's number in a
    short text. Court texts that quote or carry such words are none of these.
    """
    words = F.split(F.lower(text), r"\s+")
    slots = F.length(text) - F.length(F.regexp_replace(text, "|".join(SLOTS), ""))
    cue = F.lower(text).rlike("|".join(CUES))
    repeats = (F.size(words) >= REPEAT_WORDS) & (F.size(F.array_distinct(words)) < F.size(words) * 0.3)
    filler = F.size(F.filter(words, lambda w: w.rlike(r"^(?:lorem|ipsum|dolor|amet)\W*$"))) >= 4
    error = text.rlike(r"(?im)^\W*(?:(?:error|erreur|errore|fehler|http status)\W*[45]\d\d\b|[45]\d\d\W+(?:not found|forbidden|bad gateway|gone|too many))")
    told = (slots * 3 > F.length(text)) | repeats | filler | ((F.length(text) < 170) & cue) | ((F.length(text) < 350) & error)
    return F.coalesce(F.when(F.length(text) < TRUSTED_CHARS, told), F.lit(False))


def _plain(token: str) -> str:
    low = token.strip(_TRIM).lower()
    if _HEX.match(low):
        return "‹hex›"
    return re.sub(r"\d+", "9", low)


_MAYBE = re.compile(r"[%#][A-Za-z_]{3}|__[A-Za-z]|«[A-Z_]{3}")


def _slotted(text: str) -> str:
    """``text`` with a word, six times, for every unfilled slot."""
    if any(x in text for x in ("{", "<", "[", "@@", "XX")) or (any(x in text for x in "%#_«") and _MAYBE.search(text)):
        return _SLOT.sub(SLOT_WORDS, text)
    return text


def passages(text: str) -> list[list[str]]:
    """The words of each line; a line that repeats itself gets a word for that."""
    out = []
    for line in _slotted(text).split("\n"):
        tokens = line.split()
        words = [w for w in map(_plain, tokens) if w]
        if len(tokens) >= REPEAT_WORDS and len(set(tokens)) < len(tokens) * REPEAT_SHARE:
            words += ["‹repeat›"] * (len(tokens) // 2)
        if words:
            out.append(words)
    return out


class Model:
    """Odds of words and of pairs of words; positive speaks for residue.

    ``words`` maps the ``KNOWN`` commonest words to rows; row 0 is any other word.
    """

    def __init__(self, words: dict[str, float], pairs: dict[tuple[str, str], float]) -> None:
        self.ids = {w: n for n, w in enumerate(words, 1)}
        self.single = np.array([0.0, *words.values()], dtype=np.float32)
        size = len(self.single)
        known = [(self.ids[a] * size + self.ids[b], o) for (a, b), o in pairs.items() if a in self.ids and b in self.ids]
        known.sort()
        self.keys, self.pair = np.array([k for k, _ in known], dtype=np.int64), np.array([o for _, o in known], dtype=np.float32)

    def odds(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of each passage: ``ids`` of all words, ``starts`` of the passages."""
        sums = np.add.reduceat(self.single[ids], starts)
        if len(self.keys) and len(ids) > 1:
            keys = ids[:-1].astype(np.int64) * len(self.single) + ids[1:]
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            pairs = np.where(self.keys[place] == keys, self.pair[place], 0)
            pairs = np.append(pairs, 0)
            pairs[starts[1:] - 1] = 0
            sums = sums + np.add.reduceat(pairs, starts)
        sizes = np.diff(np.append(starts, len(ids)))
        return np.clip(sums, -PASSAGE_ODDS * sizes, PASSAGE_ODDS * sizes)

    def residue(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The decision on each text and its odds. Null, empty and blank texts are none; so is a text without any known word."""
        return Reader(self).read(texts)


class Reader(dict):
    """token -> row of its word in a model; -1 for a token without a word. Filled as tokens come."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.repeat = model.ids.get("‹repeat›", 0)

    def __missing__(self, token: str) -> int:
        word = _plain(token)
        row = self.model.ids.get(word, 0) if word else -1
        self[token] = row
        return row

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[int] = []
        starts, owners = [], []
        for n, text in enumerate(texts):
            if not text:
                continue
            for line in _slotted(text).split("\n"):
                tokens = line.split()
                if not tokens:
                    continue
                starts.append(len(ids))
                owners.append(n)
                ids += map(self.__getitem__, tokens)
                if len(tokens) >= REPEAT_WORDS and len(set(tokens)) < len(tokens) * REPEAT_SHARE:
                    ids += [self.repeat] * (len(tokens) // 2)
        total = np.zeros(len(texts))
        most = np.zeros(len(texts))
        if starts:
            odds = self.model.odds(np.maximum(np.array(ids, dtype=np.int64), 0), np.array(starts)).astype(float)
            total = np.bincount(owners, odds, len(texts))
            np.maximum.at(most, owners, odds)
        return (total > 0) & (most > DOUBT), total


def _log_ratio(one: Counter, two: Counter, bound: float) -> dict:
    a, b, size = sum(one.values()), sum(two.values()), len(one.keys() | two.keys())
    return {x: max(-bound, min(bound, float(np.log((one[x] + PSEUDO) / (a + PSEUDO * size)) - np.log((two[x] + PSEUDO) / (b + PSEUDO * size))))) for x in one.keys() | two.keys() if one[x] + two[x] > 1}


def train(sure: list[str], rest: list[str]) -> Model:
    """Positive-unlabelled naive Bayes by expectation-maximisation.

    Passages of trusted records begin as residue, all others as text. Each
    round counts words by the passages' chances and reads every passage anew,
    leaning on its record's other passages; passages that hold a slot or a cue
    in a trusted record stay residue. Without trusted records nothing is residue.
    """
    cue = re.compile("|".join(f"(?:{c})" for c in CUES), re.I)
    rows: list[tuple[list[str], int, bool]] = []
    for n, text in enumerate(sure + rest):
        for line in text.split("\n"):
            for words in passages(line):
                rows.append((words, n, n < len(sure) and ("‹slot›" in words or "‹repeat›" in words or bool(cue.search(line)))))
    if not sure or not rows:
        return Model({}, {})
    chance = np.array([1.0 if n < len(sure) else 0.0 for _, n, _ in rows])
    owner = np.array([n for _, n, _ in rows])
    fixed = np.array([f for *_, f in rows])
    model = Model({}, {})
    for _ in range(ROUNDS):
        counts = [Counter(), Counter(), Counter(), Counter()]
        for (words, *_), c in zip(rows, chance):
            for k, weight in ((0, c), (1, 1 - c)):
                if weight > 0.01:
                    for x in words:
                        counts[k][x] += weight
                    for x in zip(words, words[1:]):
                        counts[2 + k][x] += weight
        single = _log_ratio(counts[0], counts[1], WORD_ODDS)
        common = sorted(single, key=lambda w: (-(counts[0][w] + counts[1][w]) * abs(single[w]), w))[:KNOWN]
        model = Model({w: single[w] for w in common}, _log_ratio(counts[2], counts[3], WORD_ODDS))
        ids = np.array([model.ids.get(w, 0) for words, *_ in rows for w in words], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum([len(words) for words, *_ in rows])[:-1]]).astype(np.int64)
        odds = model.odds(ids, starts)
        whole = np.bincount(owner, odds)
        lean = np.clip(whole[owner] - odds, -30, 30) * 0.25
        prior = np.where(owner < len(sure), np.log(0.7 / 0.3), np.log(PRIOR / (1 - PRIOR)))
        chance = np.where(fixed, 1.0, 1 / (1 + np.exp(-np.clip(odds + lean + prior, -50, 50))))
    return model


def fit(df: DataFrame, id_column: str, text_column: str) -> Model:
    """A model trained on at most ``TRUSTED`` and ``UNLABELLED`` records, drawn by the hash of their id from all rows."""
    from tessera.session import materialize

    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(F.trim("text") != "")
    # the marks are worked out once; only ids, marks and hashes are kept
    marked = materialize(rows.select("id", trusted(F.col("text")).alias("sure"), F.xxhash64("id").alias("h")), "marks")
    sure = marked.where("sure").orderBy("h", "id").limit(TRUSTED)
    rest = marked.where("not sure").orderBy("h", "id").limit(UNLABELLED)
    chosen = {r["id"]: r["sure"] for r in sure.unionByName(rest).collect()}
    if not chosen:
        return Model({}, {})
    ids = df.sparkSession.createDataFrame([(i,) for i in chosen], f"id {dict(rows.dtypes)['id']}")
    drawn = rows.select("id", F.substring("text", 1, SAMPLE_CHARS).alias("text")).join(F.broadcast(ids), "id", "left_semi").collect()
    drawn.sort(key=lambda r: str(r["id"]))
    return train([r["text"] for r in drawn if chosen[r["id"]]], [r["text"] for r in drawn if not chosen[r["id"]]])


def score(df: DataFrame, id_column: str, text_column: str, model: Model) -> DataFrame:
    """id_column, residue, odds: the decision on each row's whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for batch in batches:
            if len(reader) > REMEMBERED:
                reader = Reader(shared.value)
            residue, odds = reader.read(batch["text"].tolist())
            yield pd.DataFrame({"id": batch["id"], "residue": residue, "odds": odds})

    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInPandas(scan, f"id {dict(rows.dtypes)['id']}, residue boolean, odds double").withColumnRenamed("id", id_column)


def keep(df: DataFrame, text_column: str, model: Model) -> DataFrame:
    """The rows of ``df`` whose text is no residue, in one pass and without moving a text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(BooleanType())
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(shared.value)
        for texts in batches:
            if len(reader) > REMEMBERED:
                reader = Reader(shared.value)
            yield pd.Series(reader.read(texts.tolist())[0])

    return df.where(~found(F.col(text_column)))
