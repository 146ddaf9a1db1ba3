"""Left joins with a table of counted keys, safe for keys that hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with more than one part in so many of all rows is hot; so there are never more hot keys than this.
HOT_PARTS = 2000


def join_counted(left: DataFrame, right: DataFrame, key: str, count: str, total: int, spread: str) -> DataFrame:
    """left with right's columns, nulls where right lacks the key.

    right has one row a key, a string, and in ``count`` the number of left's rows that have it;
    ``total`` is the sum of these.  Hot keys, at most HOT_PARTS, are broadcast; the others meet by
    a shuffle, where the rows of hot and of null keys are dealt out by the hash of ``spread``.
    """
    more = [c for c in right.columns if c != key]
    many = F.col(count) > total / HOT_PARTS
    hot = right.where(many).select(F.col(key), F.lit(True).alias("_hot"), *(F.col(c).alias(f"_h_{c}") for c in more))
    rest = right.where(~many).select(F.concat(F.lit("k"), F.col(key)).alias("_key"), *(F.col(c).alias(f"_r_{c}") for c in more))
    dealt = F.concat(F.lit("s"), F.pmod(F.xxhash64(spread), F.lit(4096)).cast("string"))
    both = left.join(F.broadcast(hot), key, "left").withColumn("_key", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), dealt).otherwise(F.concat(F.lit("k"), F.col(key))))
    return both.join(rest, "_key", "left").select(*left.columns, *(F.when(F.col("_hot").isNotNull(), F.col(f"_h_{c}")).otherwise(F.col(f"_r_{c}")).alias(c) for c in more))
