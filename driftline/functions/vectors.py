"""Column expressions on feature vectors (``array<double>``).  All of them stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vectorize(columns: Sequence[str], on_null: str = "error") -> Column:
    """Dense double vector of the named columns.  A null attribute fails the job, or stays null with 'keep'."""
    if on_null not in ("error", "keep"):
        raise ValueError(f"on_null: required 'error' or 'keep' but found {on_null!r}")

    def item(name: str) -> Column:
        value = F.col(name).cast("double")
        if on_null == "keep":
            return value
        return F.coalesce(value, F.raise_error(F.lit(f"null attribute {name}")).cast("double"))

    return F.array(*[item(c) for c in columns])


def double_text(v: float) -> str:
    v = float(v)
    return f"{v!r}D" if math.isfinite(v) else f"double('{v}')"


def doubles(values: Sequence[float]) -> Column:
    """Literal ``array<double>``; constant folding turns it into one array object per task."""
    return F.expr(f"array({', '.join(double_text(v) for v in values)})") if len(values) else F.expr(
        "cast(array() as array<double>)"
    )


def double_rows(rows: Sequence[Sequence[float]]) -> Column:
    """Literal ``array<array<double>>``."""
    inner = ("array(" + ", ".join(double_text(v) for v in r) + ")" for r in rows)
    return F.expr(f"array({', '.join(inner)})")


def argmax_votes(votes: str | Column) -> Column:
    """Index of the largest vote; ties go to the lowest index and an empty vote list gives 0."""
    v = _col(votes)
    return F.when(F.size(v) == 0, 0).otherwise(F.array_position(v, F.array_max(v)) - 1).cast("int")


def center_format(vector: str | Column) -> Column:
    """``[v0,v1,...]`` without spaces."""
    text = F.transform(_col(vector), lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(text, ","), F.lit("]"))


def dot(a: str | Column, b: str | Column) -> Column:
    prod = F.zip_with(_col(a), _col(b), lambda x, y: x * y)
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def nan_ratio(num: Column, den: Column) -> Column:
    """num / den with 0/0 = NaN instead of an error."""
    return F.when(den == 0, F.lit(float("nan"))).otherwise(num / den)
