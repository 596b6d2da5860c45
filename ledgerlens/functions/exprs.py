"""Column-expression helpers. All are built-in Spark expressions (codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c: str | Column, digits: int = 6) -> Column:
    """Round floats so results do not depend on summation order."""
    return F.round(col(c), digits)


def pct(c: str | Column) -> Column:
    return col(c) * F.lit(100.0)


def isclose(a: str | Column, b: str | Column | float = 0.0, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """NumPy `isclose`: |a - b| <= atol + rtol * |b|."""
    bb = b if isinstance(b, Column) else (F.col(b) if isinstance(b, str) else F.lit(float(b)))
    return F.abs(col(a) - bb) <= F.lit(atol) + F.lit(rtol) * F.abs(bb)


def strip_upper(c: str | Column) -> Column:
    """Python `str.strip().upper()`: strips all leading/trailing whitespace, not only spaces."""
    return F.upper(F.regexp_replace(col(c), r"^\s+|\s+$", ""))


def safe_div(a: str | Column, b: str | Column) -> Column:
    """Division that is NULL (not an error, not NaN) when the divisor is 0."""
    return F.try_divide(col(a), col(b))


def div0(a: str | Column, b: str | Column) -> Column:
    """Division with 0 on zero division (scikit-learn `zero_division=0`)."""
    return F.coalesce(F.try_divide(col(a), col(b)), F.lit(0.0))


def flag(cond: Column) -> Column:
    """Boolean condition as a 0/1 int; NULL compares as False (pandas semantics)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def number(c: str | Column) -> Column:
    """A numeric column as double with NaN read as NULL (Spark orders NaN above every number)."""
    return F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def round_doubles(df, digits: int = 6):
    """Round every double column (for order-independent comparison of results)."""
    from pyspark.sql.types import DoubleType, FloatType

    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def one_row(*dfs):
    """Place several one-row aggregates side by side without a join.

    Each input has one row and distinct columns; they are unioned with the
    other columns NULL and collapsed by `first(ignorenulls)` in one aggregate.
    """
    cols = [c for d in dfs for c in d.columns]
    types = {f.name: f.dataType for d in dfs for f in d.schema.fields}
    parts = [d.select(*[F.col(f"`{c}`") if c in d.columns else F.lit(None).cast(types[c]).alias(c) for c in cols]) for d in dfs]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in cols])
