"""Columns of another table by an equal value, kept apart by chromosome and strand."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..functions.coords import KEYS


def merge_columns(left: DataFrame, right: DataFrame, on: str, cols: Sequence[str], how: str = "left", by: Sequence[str] = KEYS, suffixes: tuple[str, str] = ("", "_b")) -> DataFrame:
    """left with right's cols where both agree in ``by`` and ``on``; null values of on agree too.

    Columns of both get the suffixes.  With how ``inner`` rows without a match go, save those of keys that
    right has no row of at all: there nothing can be looked up, so they stay, with nulls of right's
    types, as all rows do if right is empty.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how is left or inner, not {how!r}")
    cols, keys = [c for c in dict.fromkeys(cols) if c != on and c not in by], [*by, on]
    ours = {c: c + suffixes[0] if c in cols else c for c in left.columns}
    theirs = {c: c + suffixes[1] if c in left.columns else c for c in cols}
    other = right.select(*(F.col(c).alias(f"_k_{i}") for i, c in enumerate(keys)), *(F.col(c).alias(f"_v_{c}") for c in cols), F.lit(True).alias("_met"))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(keys)))
    out = left.join(other, same, "left")
    if how == "inner":
        known = right.select(*(F.col(c).alias(f"_b_{i}") for i, c in enumerate(by))).distinct().withColumn("_known", F.lit(True))
        out = out.join(known, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_b_{i}")) for i, c in enumerate(by))), "left").where("_met is not null or _known is null")
    return out.select(*(F.col(c).alias(n) for c, n in ours.items()), *(F.col(f"_v_{c}").alias(n) for c, n in theirs.items()))
