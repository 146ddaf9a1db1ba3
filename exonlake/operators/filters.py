"""Row filters from declared rules, as predicates that reach the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def number(col: str) -> Column:
    """The column as a number; NA and other text is null."""
    return F.expr(f"try_cast(nullif(cast(`{col}` as string), 'NA') as double)")


def rule(col: str, op: str, value) -> Column:
    """One predicate; nulls fail it, except where something is excluded."""
    c = F.col(col)
    if op == "eq":
        return F.coalesce(c == value, F.lit(False))
    if op == "ne":
        return F.coalesce(c != value, F.lit(True))
    if op == "le":
        return F.coalesce(number(col) <= value, F.lit(False))
    if op == "ge":
        return F.coalesce(number(col) >= value, F.lit(False))
    if op == "in":
        return F.coalesce(c.isin(*value), F.lit(False))
    if op == "not_in":
        return ~F.coalesce(c.isin(*value), F.lit(False))
    pattern = "|".join(value) if not isinstance(value, str) else value
    if op == "contains":
        return F.coalesce(c.rlike(pattern), F.lit(False))
    if op == "not_contains":
        return ~F.coalesce(c.rlike(pattern), F.lit(False))
    raise ValueError(f"no such rule: {op}")


def all_of(rules: Sequence[tuple]) -> Column:
    """All rules together."""
    return reduce(lambda a, b: a & b, (rule(*r) for r in rules), F.lit(True))


def apply_rules(df: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    return df.where(all_of(rules))


def by_group(col: str, groups: Sequence[str], more: Mapping[str, Sequence[tuple]]) -> Column:
    """Rows of the listed groups; a group with further rules has to pass them, the others need not."""
    if unknown := set(more) - set(groups):
        raise ValueError(f"rules for groups that are not listed: {sorted(unknown)}")
    return reduce(lambda a, b: a | b, ((F.coalesce(F.col(col) == g, F.lit(False)) & all_of(more.get(g, ()))) for g in groups), F.lit(False))


def annotation_rules(min_tsl: int | None = None, include: Mapping[str, Sequence[str] | str] | None = None, exclude: Mapping[str, Sequence[str] | str] | None = None, tag_include: Sequence[str] = (), tag_exclude: Sequence[str] = ()) -> list[tuple]:
    """The rules that the options of an annotation filter stand for; all of them hold together."""
    rules: list[tuple] = []
    if min_tsl is not None:
        rules.append(("transcript_support_level", "le", min_tsl))
    for col, values in (include or {}).items():
        rules.append((col, "eq", values) if isinstance(values, str) else (col, "in", list(values)))
    for col, values in (exclude or {}).items():
        rules.append((col, "ne", values) if isinstance(values, str) else (col, "not_in", list(values)))
    if tag_include:
        rules.append(("tag", "contains", list(tag_include)))
    if tag_exclude:
        rules.append(("tag", "not_contains", list(tag_exclude)))
    return rules
