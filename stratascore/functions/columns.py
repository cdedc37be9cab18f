"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME_BREAK = "\x1f"  # a character no column name holds


def sql_name(name: str) -> str:
    """The name as it must stand in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_double(value: float) -> str:
    """A double literal in SQL text."""
    return f"({float(value)!r}D)"


def sql_doubles(values: Sequence[float]) -> str:
    return "array(" + ", ".join(sql_double(v) for v in values) + ")"


def quoted(name: str) -> Column:
    """A column by exact name, whatever characters the name holds."""
    return F.col(sql_name(name))


def known(value: Column) -> Column:
    """The value, or null if it is null or NaN: both mean 'missing'."""
    return F.nanvl(value, F.lit(None).cast("double"))


def is_missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def safe_divide(num: Column, den: Column, empty: float | None = None) -> Column:
    """``num / den``; ``empty`` where the denominator is zero."""
    return F.when(den != 0, num / den).otherwise(F.lit(empty).cast("double"))


def neg_log10(p: Column, floor: float = 1e-300) -> Column:
    return -F.log10(F.greatest(p, F.lit(floor)))


def name_at(names: Sequence[str], pos: Column) -> Column:
    """The feature name for a position; used on small results only, after aggregation."""
    return F.split(F.lit(NAME_BREAK.join(names)), NAME_BREAK)[pos]


def to_long(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, feature): ``pos`` and ``value``, missing values as null.

    ``posexplode`` of one double array feeds a hash aggregate inside one codegen stage. For a wide
    table this beats one aggregate with several expressions per column, which leaves whole-stage
    codegen behind (see README, "Measured"). The array is built as SQL text: one call to the JVM
    instead of several per column.
    """
    items = ", ".join(f"nanvl(cast({sql_name(f)} as double), cast(null as double))" for f in features)
    values = F.expr(f"array({items})")
    return df.select(*[quoted(k) for k in keep], F.posexplode(values).alias("pos", "value"))


def yeo_johnson(x: Column, lam: Column | float) -> Column:
    """Yeo and Johnson (2000) power transform of one column."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    two = F.lit(2.0)
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    neg = F.when(F.abs(lam - two) < 1e-12, -F.log1p(-x)).otherwise(
        -(F.pow(1 - x, two - lam) - 1) / (two - lam)
    )
    return F.when(x >= 0, pos).otherwise(neg)
