"""Strand-aware coordinates. Intervals are 0-based and half-open; strand is + or -."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEYS = ("chrom", "strand")


def on_plus(strand: str = "strand") -> Column:
    return F.col(strand) == "+"


def five_end(start: str = "start", end: str = "end", strand: str = "strand") -> Column:
    """The outer coordinate of the 5' end: start on +, end on -."""
    return F.when(on_plus(strand), F.col(start)).otherwise(F.col(end))


def three_end(start: str = "start", end: str = "end", strand: str = "strand") -> Column:
    """The outer coordinate of the 3' end: end on +, start on -."""
    return F.when(on_plus(strand), F.col(end)).otherwise(F.col(start))


def terminal_window(df: DataFrame, inside: int = 1, outside: int = 0) -> DataFrame:
    """Each row's start and end become the last ``inside`` bases and ``outside`` more past the 3' end."""
    start = F.when(on_plus(), F.col("end") - inside).otherwise(F.col("start") - outside)
    end = F.when(on_plus(), F.col("end") + outside).otherwise(F.col("start") + inside)
    return df.withColumns({"start": F.greatest(start, F.lit(0)), "end": end})


def three_end_base(df: DataFrame) -> DataFrame:
    """The last base of each interval as an interval of length 1."""
    return terminal_window(df)


def forward(df: DataFrame) -> DataFrame:
    """Adds fs and fe, the interval on an axis that runs 5' to 3' on either strand."""
    return df.withColumns({"fs": F.when(on_plus(), F.col("start")).otherwise(-F.col("end")), "fe": F.when(on_plus(), F.col("end")).otherwise(-F.col("start"))})


def stranded(df: DataFrame) -> DataFrame:
    """Rows whose strand is known."""
    return df.where(F.col("strand").isin("+", "-"))


def with_length(df: DataFrame) -> DataFrame:
    """Rows that cover at least one base."""
    return df.where("end > start")


def rows_by_suffix(df: DataFrame, keep: tuple[str, ...], suffix: str) -> DataFrame:
    """All columns but the kept ones renamed with a suffix."""
    return df.select(*(F.col(c) if c in keep else F.col(c).alias(c + suffix) for c in df.columns))
