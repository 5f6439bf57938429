"""Bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE = 1 << 30


def thinned(df: DataFrame, key: Column, most: int) -> DataFrame:
    """The rows whose key has a small hash, about `most` of them, or all if there are no more.

    What sorts and cuts a sample afterwards then gets about `most` rows from all tasks together, whatever the corpus.
    """
    n = df.count()
    return df if n <= most else df.where(F.pmod(F.xxhash64(key), F.lit(WHOLE)) < int(WHOLE * most / n))
