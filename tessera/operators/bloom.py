"""A Bloom filter built and probed with DataFrames.

Bits are set by ``bitmap_construct_agg``, which combines map-side, and reach the
driver as at most ``MAX_BITS / 32768`` rows of 4 KB. The filter's size is thus
bounded whatever the number of keys; beyond the bound it only lets more keys
through to the exact check behind it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, hash positions of each key, and the bound of the filter (32 MB).
BITS_PER_KEY, HASHES, MAX_BITS, PAGE = 12, 4, 1 << 28, 32768


def _positions(key: Column, bits: int) -> list[Column]:
    small = F.lit((1 << 30) - 1).cast("bigint")
    one, two = F.xxhash64(key).bitwiseAND(small), F.xxhash64(key, F.lit(7)).bitwiseAND(small)
    return [F.pmod(one + two * F.lit(i).cast("bigint"), F.lit(bits).cast("bigint")) for i in range(HASHES)]


class Bloom:
    """``Bloom(df, column)``: null keys are left out; an empty table gives a filter that holds nothing."""

    def __init__(self, keys: DataFrame, column: str, expected: int | None = None) -> None:
        self.spark = keys.sparkSession
        count = expected if expected is not None else keys.count()
        self.bits = PAGE
        while self.bits < min(MAX_BITS, count * BITS_PER_KEY):
            self.bits *= 2
        pages = (
            keys.where(F.col(column).isNotNull())
            .select(F.explode(F.array(*_positions(F.col(column), self.bits))).alias("p"))
            .groupBy(F.bitmap_bucket_number(F.col("p") + 1).alias("page"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("map"))
        )
        words = np.zeros(self.bits // 8, dtype=np.uint8)
        for row in pages.collect():  # at most MAX_BITS / PAGE rows of 4 KB
            at = (row["page"] - 1) * (PAGE // 8)
            words[at : at + PAGE // 8] = np.frombuffer(row["map"], dtype=np.uint8)
        self._shared = self.spark.sparkContext.broadcast(words)

    def might_hold(self, key: Column) -> Column:
        """False only for keys that were not put in; null for null."""
        shared = self._shared

        @F.pandas_udf("boolean")
        def probe(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
            words = shared.value
            found = np.ones(len(a), dtype=bool)
            for part in (a, b, c, d):
                p = part.to_numpy(dtype=np.int64)
                found &= (words[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
            return pd.Series(found)

        return F.when(key.isNotNull(), probe(*[F.coalesce(p, F.lit(0)) for p in _positions(key, self.bits)]))
