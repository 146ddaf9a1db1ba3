"""Bounded samples by hash, for fitting: tasks send about what is asked for, however many they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_SPREAD = 1 << 30
#: Rows kept for each row asked for, so that chance seldom leaves too few.
_SPARE = 1.5


def thinned(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows or somewhat more, by hash of the key; all of df if it has no more than twice as many.

    Rows of one key stay or go together; a null key is a key.
    """
    total = df.count()
    if total <= 2 * rows:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(_SPREAD)) < int(_SPREAD * _SPARE * rows / total) + 1)


def sampled(df: DataFrame, key: str, rows: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """At most ``rows`` rows, of the smallest hashes of the key, then by key and ties."""
    return thinned(df, key, rows).orderBy(F.pmod(F.xxhash64(key), F.lit(_SPREAD)), key, *ties).limit(rows)
