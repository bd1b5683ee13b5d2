"""Encoding a corpus with a public tokenizer.

Short texts are encoded as they are. Long ones are cut into halves of halves,
the leaves are encoded in parallel, and a tree of joins puts them together: a
window around each join is encoded anew and grows until it begins as the left
side ends and ends as the right side begins, so that the ids are exactly those
of the whole text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files are, characters of a leaf, and of the first window.
FOLDER, LEAF, WINDOW = "/opt/tokenizers", 8192, 64
TOKENIZER = "byte_bpe_50k"
#: Fixed value: the pattern that splits a text before byte pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A blank after a non-blank always starts a new piece under PATTERN, whatever stands further left.
_SEAM = re.compile(r"(?<=\S)[^\S\x1c-\x1f](?=\S)")


@lru_cache(maxsize=4)
def encoder(folder: str = FOLDER, name: str = TOKENIZER):
    """The byte-level encoder of ``name``; loaded once by each worker."""
    import tiktoken

    with open(f"{folder}/{name}.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def halves(length: int, leaf: int) -> list[tuple[int, int]]:
    """The leaves of ``length`` characters cut into halves of halves, in order."""
    if length <= leaf:
        return [(0, length)]
    spans, size = [(0, length)], length
    while size > leaf:
        spans = [x for a, b in spans for x in ((a, (a + b) // 2), ((a + b) // 2, b))]
        size = (size + 1) // 2
    return spans


def joined(left: tuple[str, list[int]], right: tuple[str, list[int]], encode, window: int = WINDOW) -> tuple[str, list[int]]:
    """The text of both sides and its ids."""
    (a, a_ids), (b, b_ids) = left, right
    while True:
        tail, head = a[-window:], b[:window]
        begins = next((m.start() for m in _SEAM.finditer(tail)), None) if len(tail) < len(a) else 0
        ends = max((m.start() for m in _SEAM.finditer(head)), default=None) if len(head) < len(b) else len(head)
        if begins is not None and ends is not None:
            tail, head = tail[begins:], head[:ends]
            one, two = encode(tail), encode(head)
            if a_ids[len(a_ids) - len(one) :] == one and b_ids[: len(two)] == two:
                return a + b, a_ids[: len(a_ids) - len(one)] + encode(tail + head) + b_ids[len(two) :]
        if window >= len(a) and window >= len(b):
            return a + b, encode(a + b)
        window *= 2


def concatenated(leaves: list[tuple[str, list[int]]], encode) -> list[int]:
    """The ids of all leaves, joined as a tree."""
    while len(leaves) > 1:
        leaves = [joined(leaves[i], leaves[i + 1], encode) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0][1]


def _encoded(batches: Iterator[pa.RecordBatch], names: list[str], folder: str, name: str) -> Iterator[pa.RecordBatch]:
    bpe = encoder(folder, name)
    for batch in batches:
        parts = [bpe.encode_ordinary(t) if t else [] for t in batch.column("text").to_pylist()]
        offsets = np.zeros(len(parts) + 1, dtype=np.int32)
        np.cumsum([len(p) for p in parts], out=offsets[1:])
        flat = np.fromiter((i for p in parts for i in p), dtype=np.int32, count=int(offsets[-1]))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], [*names, "ids"])


def encode(df: DataFrame, id_column: str, text_column: str, folder: str = FOLDER, name: str = TOKENIZER, leaf: int = LEAF) -> DataFrame:
    """id_column, ids: array<int> of each text, without special tokens.

    Null and empty texts have no ids (an empty array). Ids that occur several
    times come out as often.
    """
    rows = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    short = rows.where(F.length("text") <= leaf).mapInArrow(lambda b: _encoded(b, ["id"], folder, name), f"id {kind}, ids array<int>")

    @F.pandas_udf("array<struct<at:int,text:string>>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"at": n, "text": t[a:b]} for n, (a, b) in enumerate(halves(len(t), leaf))])

    pieces = rows.where(F.length("text") > leaf).withColumn("row", F.monotonically_increasing_id()).select("id", "row", F.explode(cut("text")).alias("p")).select("id", "row", "p.at", "p.text")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, ["id", "row", "at", "text"], folder, name)

    spread = pieces.repartition("row", "at").mapInArrow(leaves, f"id {kind}, row bigint, at int, text string, ids array<int>")
    whole = spread.groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("at", "text", "ids"))).alias("leaves"))

    def tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(folder, name)
        for batch in batches:
            ids = [concatenated([(x["text"], x["ids"]) for x in row], bpe.encode_ordinary) for row in batch.column("leaves").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    return short.unionByName(whole.select("id", "leaves").mapInArrow(tree, f"id {kind}, ids array<int>")).withColumnRenamed("id", id_column)


def counts(df: DataFrame, keep: list[str], text_column: str, folder: str = FOLDER, name: str = TOKENIZER) -> DataFrame:
    """``keep`` and n_tokens, the number of ids of each text; 0 for null and empty ones."""
    rows = df.select(*keep, F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    fields = ", ".join(f"{n} {k}" for n, k in rows.dtypes if n != "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(folder, name)
        for batch in batches:
            sizes = [len(bpe.encode_ordinary(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(sizes, pa.int32())], [*keep, "n_tokens"])

    return rows.mapInArrow(count, f"{fields}, n_tokens int")
