"""Arrival order at scale: numbering, limits, previous value, running aggregates.

No operator here sorts a whole table in one task.  Rows are split into buckets that follow the order, each bucket is
handled by its own task, and only one small row per bucket crosses bucket borders.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.vectors import double_text
from driftline.session import cut_lineage

BUCKET_ROWS = 1_000_000
# Order buckets per shuffle partition: several, so that hashing bucket numbers to tasks evens out.
BUCKETS_PER_PARTITION = 2


def _comparable(df: DataFrame, name: str) -> Column:
    """The key in a form with the same order whose values can be written as literals."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int").cast("bigint")
    if isinstance(kind, T.FloatType):
        return F.col(name).cast("double")
    return F.col(name)


def _literal(value, kind: str) -> str:
    """SQL text of a key value of the given type."""
    if value is None:
        return f"cast(NULL AS {kind})"
    if kind == "bigint":
        return f"{value}L"
    if kind == "double":
        return double_text(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{value.hex()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'" if kind == "string" else f"cast('{text}' AS {kind})"


def bucket_of(keys: Sequence[Column], bounds: Sequence[tuple], kinds: Sequence[str] = ("bigint",)) -> Column:
    """Number of bounds that are <= the row's key: a binary search over a literal array.

    ``kinds`` are the SQL types of the keys.
    """
    if not bounds:
        return F.lit(0)
    key = keys[0] if len(keys) == 1 else F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    texts = [[_literal(v, kind) for v, kind in zip(b, kinds)] for b in bounds]
    if len(keys) == 1:
        rows = [row[0] for row in texts]
    else:
        rows = ["named_struct(" + ", ".join(f"'k{i}', {t}" for i, t in enumerate(row)) + ")" for row in texts]
    table = F.expr(f"array({', '.join(rows)})")
    steps = [1 << i for i in reversed(range(max(1, math.ceil(math.log2(len(bounds) + 1)))))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda pos, s: F.when(F.get(table, pos + s - 1) <= key, pos + s).otherwise(pos),
    )


def order_buckets(df: DataFrame, keys: Sequence[str], buckets: int) -> tuple[list[tuple], list[int], int]:
    """Lower bounds of buckets 1.., the number of rows before each bucket, and the total.

    One range shuffle of the key columns alone; one row per bucket reaches the driver.  Equal keys always share a
    range partition, so the counts hold for any later pass that splits the rows at the same bounds.
    """
    names = [f"k{i}" for i in range(len(keys))]
    ranged = df.select(*[_comparable(df, k).alias(n) for k, n in zip(keys, names)]).repartitionByRange(buckets, *names)
    low = F.min(names[0]) if len(keys) == 1 else F.min(F.struct(*names))
    rows = (
        ranged.groupBy(F.spark_partition_id().alias("part"))
        .agg(low.alias("low"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    rows = sorted(rows, key=lambda r: r["part"])
    bounds = [(r["low"],) if len(keys) == 1 else tuple(r["low"]) for r in rows[1:]]
    before, total = [], 0
    for r in rows:
        before.append(total)
        total += r["n"]
    return bounds, before or [0], total


def order_keys(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


def number_rows(
    df: DataFrame, order_by: str | Sequence[str], name: str = "seq", buckets: int | None = None
) -> tuple[DataFrame, int]:
    """The rows numbered 1, 2, 3, ... in the order of ``order_by``, and how many there are."""
    keys = order_keys(order_by)
    buckets = buckets or BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = df.columns
    # Tied rows have no order of their own: a hash of the row gives them one that is the same on every evaluation, and
    # lets a hot tie be split between buckets.
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    df = df.withColumn("__tie", F.xxhash64(*hashed))
    keys = [*keys, "__tie"]
    bounds, before, total = order_buckets(df, keys, buckets)
    offsets = F.expr(f"array({', '.join(f'{b}L' for b in before)})")
    window = Window.partitionBy("__bucket").orderBy(*keys)
    forms = [_comparable(df, k) for k in keys]
    kinds = [f.dataType.simpleString() for f in df.select(*forms).schema.fields]
    numbered = df.withColumn("__bucket", bucket_of(forms, bounds, kinds)).withColumn(
        name, F.row_number().over(window) + F.get(offsets, F.col("__bucket"))
    )
    return numbered.drop("__bucket", "__tie"), total


def with_seq(df: DataFrame, order_by: str | Sequence[str], name: str = "seq", buckets: int | None = None) -> DataFrame:
    """Number rows 1, 2, 3, ... in the order of ``order_by``.

    Pass as many key columns as make the order unique; they also decide how finely a hot first key can be split.
    The input must be stable (a table, not a random sample), since it is read twice: keys only, then the rows.
    """
    return number_rows(df, order_by, name, buckets)[0]


def limit_instances(df: DataFrame, n: int, order_by: str | Sequence[str] | None = None, seq: str = "seq") -> DataFrame:
    """The first ``n`` rows in arrival order, train and predict rows alike; -1 keeps all rows."""
    if n < -1:
        raise ValueError(f"max_instances: required -1 or more but found {n}")
    if n == -1:
        return df
    if seq in df.columns:
        return df.filter(F.col(seq) <= n)
    if order_by is None:
        raise ValueError("limit_instances needs a sequence column or order_by")
    keys = order_keys(order_by)
    return with_seq(df, keys, seq).filter(F.col(seq) <= n).drop(seq)


def with_previous(
    df: DataFrame, value: str, name: str, default=None, seq: str = "seq", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Value of the row before, for a table numbered 1..N without gaps (see :func:`with_seq`).

    Buckets are ranges of ``seq``.  The last row of each bucket is also sent to the next bucket, where it only serves
    as the previous row, so one shuffle is enough and no bucket has to look into another one.
    """
    own = F.floor((F.col(seq) - 1) / F.lit(bucket_rows))
    targets = F.when(F.col(seq) % bucket_rows == 0, F.array(own, own + 1)).otherwise(F.array(own))
    window = Window.partitionBy("__bucket").orderBy(seq)
    return (
        df.withColumn("__bucket", F.explode(targets))
        .withColumn(name, F.lag(value, 1, default).over(window))
        .filter(F.col("__bucket") == own)
        .drop("__bucket")
    )


def with_block(df: DataFrame, position: str = "seq", span: int = BUCKET_ROWS, name: str = "__block") -> DataFrame:
    return df.withColumn(name, F.floor(F.col(position) / F.lit(span)))


_RUNNING = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def running(
    df: DataFrame,
    specs: Mapping[str, tuple[str, str]],
    position: str = "seq",
    keys: Sequence[str] = (),
    span: int = BUCKET_ROWS,
    exclusive: Sequence[str] = (),
    block: str | None = None,
    settle: bool = False,
) -> DataFrame:
    """Running aggregates in order of ``position`` within ``keys``; ``specs`` maps output to (function, column).

    Two levels: running values inside blocks of ``span`` positions, plus the running totals of the blocks before.
    A single key may hold any share of the rows, because its blocks are spread over tasks.  Outputs named in
    ``exclusive`` leave the current row out.  Several passes can share one shuffle: name an existing ``block`` column
    (see :func:`with_block`), which is then kept.  ``settle`` checkpoints the totals carried between blocks, one small
    row per block, so that a pass stacked on this one does not plan the passes below it twice.
    """
    keys = list(keys)
    at = block or "__block"
    rows = df if block else with_block(df, position, span, at)
    blocks = [*keys, at]
    inner = Window.partitionBy(*blocks).orderBy(position)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)

    local = rows.withColumns(
        {out: _RUNNING[fn](c).over(before if out in exclusive else upto) for out, (fn, c) in specs.items()}
    )
    totals = rows.groupBy(*blocks).agg(*[_RUNNING[fn](c).alias(f"__t_{out}") for out, (fn, c) in specs.items()])
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    merge = {"count": F.sum}
    carried = totals.select(
        *blocks,
        *[merge.get(fn, _RUNNING[fn])(f"__t_{out}").over(across).alias(f"__c_{out}") for out, (fn, _) in specs.items()],
    )

    if settle:
        carried = cut_lineage(carried)
    joined = local.join(carried, blocks)
    result = {}
    for out, (fn, _) in specs.items():
        here, earlier = F.col(out), F.col(f"__c_{out}")
        if fn in ("sum", "count"):
            result[out] = F.coalesce(here + earlier, here, earlier)
        else:
            result[out] = (F.least if fn == "min" else F.greatest)(here, earlier)
    return joined.withColumns(result).drop(*([] if block else [at]), *[f"__c_{out}" for out in specs])


def batch_starts(total: int, first: int, growth: float) -> list[int]:
    """First sequence numbers of the micro-batches: ``first`` rows, then ``growth`` times more each time.

    With growth 2 a table of N rows needs about log2(N / first) learning rounds and is still read once in total.
    """
    if first < 1 or growth < 1.0:
        raise ValueError(f"required first >= 1 and growth >= 1 but found {first} and {growth}")
    starts, size, at = [1], float(first), 1
    while at + int(size) <= total:
        at += int(size)
        starts.append(at)
        size *= growth
    return starts


def runs_of(starts: Sequence[int], total: int, rows: int, longest: int | None = None) -> list[tuple[int, int]]:
    """First and last of the batches that one task takes in order: as many as hold ``rows`` rows together, or one longer.

    A batch of more than ``longest`` rows is a run of its own as well.
    """
    runs, first, alone = [], 0, False
    for b in range(len(starts) if total else 0):
        end = starts[b + 1] if b + 1 < len(starts) else total + 1
        long = longest is not None and end - starts[b] > longest
        if b > first and (alone or long or end - starts[first] > rows):
            runs.append((first, b - 1))
            first = b
        alone = long
    return [*runs, (first, len(starts) - 1)] if total else []


def with_batch(df: DataFrame, starts: Sequence[int], seq: str = "seq", name: str = "batch_id") -> DataFrame:
    """Number of the micro-batch of a row.  Batches of one size are counted off, so that there may be any number of them."""
    steps = {b - a for a, b in itertools.pairwise(starts)}
    if len(steps) == 1:
        place = F.floor((F.col(seq) - starts[0]) / F.lit(steps.pop()))
        return df.withColumn(name, F.greatest(F.lit(0), F.least(F.lit(len(starts) - 1), place)).cast("int"))
    return df.withColumn(name, bucket_of([F.col(seq).cast("bigint")], [(int(s),) for s in starts[1:]]).cast("int"))


def sliding_batches(df: DataFrame, size: int, shift: int, seq: str = "seq", name: str = "batch") -> DataFrame:
    """Every row once per batch that covers it; batch b holds sequence numbers b·shift+1 .. b·shift+size."""
    if size < 1 or shift < 1:
        raise ValueError(f"required size >= 1 and shift >= 1 but found {size} and {shift}")
    zero = F.col(seq) - 1
    last = F.floor(zero / F.lit(shift)).cast("bigint")
    first = F.greatest(F.lit(0), F.floor((zero - size) / F.lit(shift)) + 1).cast("bigint")
    covering = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(name, F.explode(covering))
