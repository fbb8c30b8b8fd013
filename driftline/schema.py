"""Plan-time checks and row roles.  Everything here looks at ``df.schema`` only; no job is started."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Markers of rows that ask for a prediction, and the encoded label of such a row.
PREDICT_LABEL = "?"
PREDICT_TARGET_TEXT = "-0.0"
PREDICT_INDEX = -1

TRAIN, PREDICT = "train", "predict"

NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)


def require_int(name: str, value, at_least: int | None = None) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{name}: required int but found {type(value).__name__}")
    if at_least is not None and value < at_least:
        raise ValueError(f"{name}: required at least {at_least} but found {value}")
    return value


def require_columns(df: DataFrame, names: Sequence[str], types: tuple[type, ...], what: str) -> None:
    """Each name exists and has one of the given Spark types; otherwise a ValueError names expected and found."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name in names:
        if name not in fields:
            raise ValueError(f"{what} column '{name}' not found; available: {sorted(fields)}")
        if types and not isinstance(fields[name], types):
            wanted = " or ".join(t.typeName() for t in types)
            raise ValueError(f"{what} column '{name}': required {wanted} but found {fields[name].simpleString()}")


def require_numeric(df: DataFrame, names: Sequence[str], what: str = "numeric") -> None:
    require_columns(df, names, NUMERIC_TYPES, what)


def parse_cardinalities(text: str | Sequence[int] | Mapping[str, int], names: Sequence[str]) -> dict[str, int]:
    """Declared number of values per nominal column, from ``"3,5,4"``, a list or a mapping."""
    if isinstance(text, Mapping):
        missing = [n for n in names if n not in text]
        if missing:
            raise ValueError(f"nominal columns without a declared cardinality: {missing}")
        return {n: require_int(n, text[n], 1) for n in names}
    parts = [p for p in text.split(",") if p.strip()] if isinstance(text, str) else list(text)
    if names and len(parts) != len(names):
        raise ValueError(f"required {len(names)} nominal cardinalities but found {len(parts)}")
    return {n: require_int(n, int(p), 1) for n, p in zip(names, parts)}


def role_of_label(label: str | Column) -> Column:
    """'predict' for the label ``?``, else 'train'.  The label may have any type: its text is compared."""
    col = F.col(label) if isinstance(label, str) else label
    return F.when(col.cast("string") == PREDICT_LABEL, PREDICT).otherwise(TRAIN)


def role_of_target(target: str | Column) -> Column:
    """'predict' for negative zero, else 'train' (positive zero trains).

    ``-0.0 = 0.0`` is true in SQL, so the sign is read from the text form.
    """
    col = F.col(target) if isinstance(target, str) else target
    return F.when(col.cast("double").cast("string") == PREDICT_TARGET_TEXT, PREDICT).otherwise(TRAIN)


def known_target(target: str) -> Column:
    """The target as a double; null where it is missing, NaN or marked for prediction."""
    y = F.col(target).cast("double")
    return F.when((role_of_target(target) == TRAIN) & ~F.isnan(y), y)


def predict_target() -> Column:
    """The negative-zero literal that marks a regression row for prediction."""
    return F.lit("-0.0").cast("double")
