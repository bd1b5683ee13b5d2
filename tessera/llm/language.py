"""Language of documents and of single paragraphs, with a confidence value.

A text is the average of the embeddings of its hashed subwords; a linear
softmax on top tells the language. Both are trained by stochastic gradient
descent in numpy on a bounded sample of labelled rows. As all of it is linear,
a bucket's embedding times the softmax weights is one row of ``buckets x
languages``, so that each word is scored once per worker and a paragraph is a
sum of cached rows. A temperature, fitted on held-out paragraphs, calibrates
the confidence; below ``REJECT`` no language is given.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("de", "fr", "it", "rm", "en")
#: Notations of the labels, besides the two-letter ones.
NOTATIONS = {"deu": "de", "ger": "de", "deutsch": "de", "german": "de", "fra": "fr", "fre": "fr", "français": "fr", "french": "fr", "ita": "it", "italiano": "it", "italian": "it", "roh": "rm", "rumantsch": "rm", "romansh": "rm", "eng": "en", "english": "en"}
#: The bound of the training sample: labelled documents of each language; paragraphs, their least characters, their words, and characters of each document.
PER_LANGUAGE, PARAGRAPHS, PARAGRAPH_CHARS, PARAGRAPH_WORDS, SAMPLE_CHARS = 250, 4, 80, 40, 6000
#: Range of the hashes that the sample is drawn by, and how many times as many as are kept are drawn.
HASHES, OVERDRAWN = 1 << 40, 4
BUCKETS, WIDTH, EPOCHS, RATE, BATCH = 1 << 16, 16, 4, 0.5, 64
#: Least letters of a text or paragraph, least confidence, words a worker remembers.
LEAST_LETTERS, REJECT, REMEMBERED = 40, 0.6, 300_000
#: Share of words in lower case that makes running text, and a lower one that does so where the language is sure
#: (blocks of names and addresses have few such words and no sure language; German nouns are capitals).
RUNNING, RUNNING_IF_SURE, SURE = 0.55, 0.28, 0.97
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def label(column: Column) -> Column:
    """The two-letter language that a label names; null for none, blank or any other word."""
    low = F.lower(F.regexp_extract(F.trim(column), r"^([\p{L}]+)", 1))
    out = F.when(low.isin(*LANGUAGES), low)
    for name, code in NOTATIONS.items():
        out = out.when(low == name, F.lit(code))
    return out


def subwords(word: str) -> list[int]:
    """Buckets of a word: itself and its pieces of two to five letters, marked at its ends."""
    marked = f"<{word.lower()}>"
    pieces = {marked, *(marked[i : i + n] for n in (2, 3, 4, 5) for i in range(len(marked) - n + 1))}
    return [zlib.crc32(p.encode()) % BUCKETS for p in sorted(pieces)]


class Model:
    """Scores of each bucket and language, the bias and the temperature."""

    def __init__(self, scores: np.ndarray, bias: np.ndarray, temperature: float) -> None:
        self.scores, self.bias, self.temperature = scores.astype(np.float32), bias, temperature

    def chances(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        logits = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


class Words(dict):
    """word -> row of ``table``: scores, subwords, letters, 1 if it runs in lower case, 1. Filled as words come."""

    def __init__(self, model: Model) -> None:
        self.model, self.rows = model, []
        self.table = np.zeros((1024, len(LANGUAGES) + 4), dtype=np.float32)

    def __missing__(self, token: str) -> int:
        n = len(self)
        if n == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        row = self.table[n]
        k = len(LANGUAGES)
        for word in _WORD.findall(token):
            if len(word) > 1 and not word.isupper():
                ids = subwords(word)
                row[:k] += self.model.scores[ids].sum(axis=0)
                row[k] += len(ids)
            row[k + 1] += sum(map(str.isalpha, word))
        row[k + 2] = float(token[:1].islower())
        row[k + 3] = 1
        self[token] = n
        return n


def _train(texts: list[list[int]], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    k = len(LANGUAGES)
    embedding, weights, bias = rng.normal(0, 0.1, (BUCKETS, WIDTH)), rng.normal(0, 0.3, (WIDTH, k)), np.zeros(k)
    shares = np.bincount(labels, minlength=k) + 1.0
    heft = (shares.sum() / k / shares)[labels]
    arrays = [np.array(t) for t in texts]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(arrays))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            sizes = np.array([len(arrays[i]) for i in rows])
            ids, owner = np.concatenate([arrays[i] for i in rows]), np.repeat(np.arange(len(rows)), sizes)
            mean = np.add.reduceat(embedding[ids], np.concatenate([[0], np.cumsum(sizes)[:-1]])) / sizes[:, None]
            logits = mean @ weights + bias
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = e / e.sum(axis=1, keepdims=True)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error *= heft[rows][:, None] / len(rows)
            back = (error @ weights.T) / sizes[:, None] * BATCH
            weights -= rate * mean.T @ error * 4
            bias -= rate * error.sum(axis=0)
            touched, place = np.unique(ids, return_inverse=True)
            for c in range(WIDTH):
                embedding[touched, c] -= rate * np.bincount(place, back[owner, c], len(touched))
    return embedding @ weights, bias


def fit(df: DataFrame, id_column: str, label_column: str, text_column: str) -> Model:
    """A model fitted on at most ``PER_LANGUAGE`` labelled documents of each language.

    Labels may be wrong now and then: after a first round, paragraphs that it
    reads otherwise leave the sample. With no usable label the model rejects all.
    """
    marked = df.select(F.col(id_column).alias("id"), label(F.col(label_column)).alias("lang"), F.pmod(F.xxhash64(id_column), F.lit(HASHES)).alias("h")).where(F.col("lang").isNotNull() & F.col("id").isNotNull())
    # the smallest hashes of each language: those below a cut of its own, of which enough are kept
    cuts = {r["lang"]: int(HASHES * min(1.0, OVERDRAWN * PER_LANGUAGE / r["n"])) for r in marked.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    below = F.lit(False)
    for code, cut in cuts.items():
        below = below | ((F.col("lang") == code) & (F.col("h") <= cut))
    drawn = marked.where(below).distinct().collect()
    kept: dict[str, dict[str, None]] = {c: {} for c in LANGUAGES}
    for r in sorted(drawn, key=lambda r: (r["h"], str(r["id"]))):
        if len(kept[r["lang"]]) < PER_LANGUAGE:
            kept[r["lang"]][r["id"]] = None
    chosen = df.sparkSession.createDataFrame([(i, c) for c, ids in kept.items() for i in ids], f"id {dict(marked.dtypes)['id']}, lang string")
    rows = df.select(F.col(id_column).alias("id"), F.substring(text_column, 1, SAMPLE_CHARS).alias("text")).join(F.broadcast(chosen), "id").where(F.length("text") >= LEAST_LETTERS).dropDuplicates(["id"]).collect()
    texts, labels = [], []
    for r in sorted(rows, key=lambda r: zlib.crc32(str(r["id"]).encode())):
        for p in [p for p in r["text"].split("\n\n") if len(p) > PARAGRAPH_CHARS][:PARAGRAPHS]:
            ids = [b for w in _WORD.findall(p)[:PARAGRAPH_WORDS] if len(w) > 1 and not w.isupper() for b in subwords(w)]
            if ids:
                texts.append(ids)
                labels.append(LANGUAGES.index(r["lang"]))
    k = len(LANGUAGES)
    if not texts:
        return Model(np.zeros((BUCKETS, k)), np.zeros(k), 1.0)
    y = np.array(labels)

    def logits(scores: np.ndarray, bias: np.ndarray, some: list[list[int]]) -> np.ndarray:
        return np.array([scores[t].mean(axis=0) for t in some]) + bias

    scores, bias = _train(texts, y)
    good = logits(scores, bias, texts).argmax(axis=1) == y
    texts, y = [t for t, g in zip(texts, good) if g], y[good]
    if not len(texts):
        return Model(np.zeros((BUCKETS, k)), np.zeros(k), 1.0)
    held = np.arange(len(texts)) % 5 == 0
    scores, bias = _train([t for t, h in zip(texts, held) if not h] or texts, y[~held] if (~held).any() else y)
    z = logits(scores, bias, [t for t, h in zip(texts, held) if h])
    # the temperature that makes the held-out paragraphs likeliest, against targets smoothed as if one more had been wrong
    target = np.full(z.shape, 1 / (len(z) + 2) / (k - 1))
    target[np.arange(len(z)), y[held]] = (len(z) + 1) / (len(z) + 2)
    losses = {}
    for temperature in np.geomspace(0.02, 5, 60):
        s = z / temperature
        chance = s - s.max(axis=1, keepdims=True)
        chance -= np.log(np.exp(chance).sum(axis=1, keepdims=True))
        losses[temperature] = float(-(target * chance).sum(axis=1).mean())
    return Model(scores, bias, min(losses, key=losses.get))


def segments(df: DataFrame, id_column: str, label_column: str, text_column: str, model: Model) -> DataFrame:
    """id, seg, lang, confidence, named: a row for each text (seg -1) and each paragraph of running text.

    ``named`` is the label's language. A text's language is that of most of its
    letters; ``lang`` is null where the confidence is below ``REJECT``. Texts
    with under ``LEAST_LETTERS`` letters, null and empty ones give no row.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    k = len(LANGUAGES)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(shared.value)
        for batch in batches:
            if len(words) > REMEMBERED:
                words = Words(shared.value)
            ids, owners, numbers, sizes = [], [], [], []
            look = words.__getitem__
            for at, text in enumerate(batch["text"]):
                for n, paragraph in enumerate(text.split("\n\n")):
                    tokens = paragraph.split()
                    if tokens:
                        ids += map(look, tokens)
                        owners.append(at)
                        numbers.append(n)
                        sizes.append(len(tokens))
            if not sizes:
                continue
            sums = np.add.reduceat(words.table[np.array(ids)], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0).astype(float)
            owner, number = np.array(owners), np.array(numbers)
            chances = shared.value.chances(sums[:, :k], sums[:, k])
            letters = sums[:, k + 1]
            by_text = np.zeros((len(batch), k))
            np.add.at(by_text, owner, chances * letters[:, None])
            total = np.bincount(owner, letters, len(batch))
            whole = np.stack([np.bincount(owner, sums[:, c], len(batch)) for c in range(k)], axis=1)
            sure = shared.value.chances(whole, np.bincount(owner, sums[:, k], len(batch)))
            main = by_text.argmax(axis=1)
            main_sure = np.maximum(sure[np.arange(len(batch)), main], by_text.max(axis=1) / np.maximum(total, 1))
            big = total >= LEAST_LETTERS
            best, conf = chances.argmax(axis=1), chances.max(axis=1)
            small = sums[:, k + 2] / np.maximum(sums[:, k + 3], 1)
            running = big[owner] & (letters >= LEAST_LETTERS) & ((small >= RUNNING) | ((small >= RUNNING_IF_SURE) & (conf >= SURE)))
            names = np.array(LANGUAGES, dtype=object)
            texts = pd.DataFrame({"id": batch["id"], "seg": -1, "lang": np.where(main_sure >= REJECT, names[main], None), "confidence": main_sure, "main": names[main], "named": batch["named"]})[big]
            parts = pd.DataFrame({"id": batch["id"].to_numpy()[owner], "seg": number, "lang": np.where(conf >= REJECT, names[best], None), "confidence": conf, "main": names[main[owner]], "named": batch["named"].to_numpy()[owner]})[running]
            yield pd.concat([texts, parts], ignore_index=True)

    source = df.select(F.col(id_column).alias("id"), label(F.col(label_column)).alias("named"), F.col(text_column).alias("text")).where(F.length("text") >= LEAST_LETTERS)
    return source.mapInPandas(scan, f"id {dict(source.dtypes)['id']}, seg int, lang string, confidence double, main string, named string")


def corrections(found: DataFrame) -> DataFrame:
    """Of ``segments``: texts whose label is missing or names another language, and paragraphs in another language than their text.

    A text or paragraph whose language is rejected (null) corrects nothing.
    """
    wrong = (F.col("seg") < 0) & F.col("lang").isNotNull() & (F.col("named").isNull() | (F.col("named") != F.col("main")))
    other = (F.col("seg") >= 0) & (F.col("lang") != F.col("main"))
    return found.where(wrong | other).select("id", "seg", F.when(F.col("seg") < 0, F.col("main")).otherwise(F.col("lang")).alias("lang"), "confidence")
