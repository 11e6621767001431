"""Text predicates and recodings, all as built-in column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: Column | str) -> Column:
    """True for a key that is neither NULL nor empty."""
    c = column(c)
    return c.isNotNull() & (c != "")


def is_test_name(c: Column | str) -> Column:
    """True where the name contains "test" in any case; a NULL name is not a test."""
    return F.lower(F.coalesce(column(c), F.lit(""))).contains("test")


def exclude_test(df: DataFrame, name: Column | str) -> DataFrame:
    return df.where(~is_test_name(name))


def strip_prefix(c: Column | str, prefix: str, start: int) -> Column:
    """Text from the 1-based position ``start`` where it begins with ``prefix``, else the text as it is."""
    c = column(c)
    return F.when(c.startswith(prefix), F.substring(c, start, 2**31 - 1)).otherwise(c)


def contains_any(c: Column | str, tokens: Iterable[str]) -> Column:
    c = column(c)
    found = F.lit(False)
    for token in tokens:
        found = found | c.contains(token)
    return found


def classify(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first rule that holds; NULL predicates do not hold."""
    (first, label), *rest = rules
    out = F.when(first, F.lit(label))
    for predicate, label in rest:
        out = out.when(predicate, F.lit(label))
    return out if default is None else out.otherwise(F.lit(default))


def recode(c: Column | str, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Label from a fixed lookup; values outside it become ``default`` (a literal text, a column or NULL)."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    out = F.create_map(*pairs)[column(c)]
    if default is None:
        return out
    return F.coalesce(out, default if isinstance(default, Column) else F.lit(default))
