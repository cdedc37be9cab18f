"""Names, keys, projections: the table contract every other operator relies on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratascore.functions.columns import quoted


def clean_columns(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def drop_columns(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Drop the listed columns. Missing ones are ignored, or an error if ``strict``."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if strict and missing:
        raise KeyError(f"columns not in table: {missing}")
    gone = set(columns)
    return df.select(*[quoted(c) for c in df.columns if c not in gone])


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """The key columns, then the features in the order given; an error if one is missing."""
    present = set(df.columns)
    missing = [c for c in (*keep, *features) if c not in present]
    if missing:
        raise KeyError(f"columns not in table: {missing}")
    return df.select(*[quoted(c) for c in (*keep, *features)])


def split_roles(df: DataFrame, key: str = "id", label: str = "label",
                other: Sequence[str] = ()) -> tuple[str, str, list[str]]:
    """Key, target and the remaining feature names."""
    taken = {key, label, *other}
    return key, label, [c for c in df.columns if c not in taken]


def filter_class(df: DataFrame, value: int = 1, label: str = "label") -> DataFrame:
    return df.filter(F.col(label) == value)


def attach_labels(features: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Bring target and features together by key, never by row order."""
    return features.join(labels, key, "inner")


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return list(df.dtypes)


def preview(df: DataFrame, n: int = 10, key: str = "id") -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(key).limit(n)


def rounded(col: Column, places: int = 6) -> Column:
    return F.round(col, places)
