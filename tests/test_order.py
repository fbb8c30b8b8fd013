import itertools

import pytest
from pyspark.sql import functions as F

from driftline.operators.order import (
    batch_starts,
    bucket_of,
    limit_instances,
    running,
    sliding_batches,
    with_batch,
    with_previous,
    with_seq,
)
from driftline.operators.kmeans_stream import batch_totals


def test_with_seq_follows_a_composite_key_with_a_hot_first_value(spark):
    rows = [(7 if i % 3 else i, (i * 37) % 1000) for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = {(r.a, r.b): r.seq for r in with_seq(df, ["a", "b"]).collect()}
    want = {k: i + 1 for i, k in enumerate(sorted(set(rows)))}
    assert len(set(rows)) == 600 and got == want


def test_with_seq_splits_a_hot_first_value_over_buckets(spark):
    from driftline.operators.order import order_buckets

    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("a"), "id")
    bounds, before, total = order_buckets(df, ["a", "id"], 16)
    sizes = [b - a for a, b in itertools.pairwise([*before, total])]
    assert total == 3000 and max(sizes) < 3000 / 3


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_with_seq_on_strings_nulls_and_few_rows(spark, buckets):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("c",)], "k string")
    got = [r.k for r in with_seq(df, "k", buckets=buckets).orderBy("seq").collect()]
    assert got == [None, "a", "b", "c"]


@pytest.mark.parametrize(
    "key",
    ["timestamp_millis(id * 1000 + 7)", "date_add(date'2024-01-01', cast(id AS int))", "cast(id AS decimal(10,2))",
     "id / 7.0D", "cast(id / 7.0D AS float)", "concat('it''s \\\\ ', lpad(cast(id AS string), 4, '0'))", "id % 2 = 1"],
)
def test_with_seq_on_every_key_type(spark, key):
    df = spark.range(100).selectExpr(f"{key} AS k", "id")
    rows = with_seq(df, ["k", "id"], buckets=9).collect()
    want = [r.id for r in df.orderBy("k", "id").collect()]
    assert [r.id for r in sorted(rows, key=lambda r: r.seq)] == want
    if "%" not in key:
        assert {r.id: r.seq for r in with_seq(df, "k", buckets=9).collect()} == {i: n for n, i in enumerate(want, 1)}


def test_hot_ties_are_split_by_the_row_itself(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    rows = with_seq(df, "k", buckets=64).orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(1, 2001))
    assert [r.k for r in rows] == sorted(r.k for r in rows) and len({r.id for r in rows}) == 2000
    assert rows[0].asDict().keys() == {"k", "id", "seq"}


def test_with_seq_of_an_empty_table(spark):
    assert with_seq(spark.range(0), "id").count() == 0


def test_bucket_of_is_a_binary_search(spark):
    for n in (1, 2, 3, 7, 8, 9):
        bounds = [(10 * i,) for i in range(n)]
        got = {r.id: r.b for r in spark.range(-5, 100).withColumn("b", bucket_of([F.col("id")], bounds)).collect()}
        assert got == {v: sum(b[0] <= v for b in bounds) for v in range(-5, 100)}


def test_limit_counts_all_rows_and_minus_one_keeps_them(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    assert sorted(r.k for r in limit_instances(df, 10, "k").collect()) == list(range(10))
    assert limit_instances(df, -1, "k").count() == 100
    with pytest.raises(ValueError):
        limit_instances(df, -2, "k")


def test_limits_follow_the_numbering_on_ties(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("k"), "id")
    order = {r.id: r.seq for r in with_seq(df, "k").collect()}
    for n in (1, 7, 20, 59):
        assert {r.id for r in limit_instances(df, n, "k").collect()} == {i for i, s in order.items() if s <= n}
    assert {r.id: r.seq for r in with_seq(df.repartition(5), "k", buckets=3).collect()} == order
    plan = limit_instances(df, 20, "k")._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan


@pytest.mark.parametrize("bucket_rows", [1, 7, 100])
def test_with_previous_crosses_bucket_borders(spark, bucket_rows):
    df = spark.range(1, 31).select(F.col("id").alias("seq"), (F.col("id") * 3).alias("v"))
    got = {r.seq: r.p for r in with_previous(df, "v", "p", 0, bucket_rows=bucket_rows).collect()}
    assert got == {i: (i - 1) * 3 for i in range(1, 31)}


@pytest.mark.parametrize("span", [1, 10, 1000])
def test_running_matches_a_plain_loop_with_a_hot_key(spark, span):
    rows = [("hot" if i % 3 else f"k{i % 5}", i, (i * 31) % 17 - 8) for i in range(1, 201)]
    df = spark.createDataFrame(rows, "k string, seq int, v int")
    specs = {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "c": ("count", "v"), "before": ("sum", "v")}
    got = running(df, specs, "seq", ["k"], span, exclusive=("before",)).collect()
    seen = {}
    want = {}
    for k, i, v in rows:
        earlier = seen.setdefault(k, [])
        before = sum(earlier) if earlier else None
        earlier.append(v)
        want[i] = (sum(earlier), min(earlier), max(earlier), len(earlier), before)
    assert {r.seq: (r.s, r.lo, r.hi, r.c, r.before) for r in got} == want


def test_running_without_keys(spark):
    df = spark.range(1, 51).withColumnRenamed("id", "seq")
    got = {r.seq: r.s for r in running(df, {"s": ("sum", "seq")}, span=8).collect()}
    assert got == {i: i * (i + 1) // 2 for i in range(1, 51)}


def test_batches_grow_and_cover_every_row(spark):
    assert batch_starts(10_000, 1000, 2.0) == [1, 1001, 3001, 7001]
    assert batch_starts(30, 10, 1.0) == [1, 11, 21]
    assert batch_starts(5, 10, 2.0) == [1]
    df = with_batch(spark.range(1, 10_001).withColumnRenamed("id", "seq"), batch_starts(10_000, 1000, 2.0))
    assert [r["count"] for r in df.groupBy("batch_id").count().orderBy("batch_id").collect()] == [1000, 2000, 4000, 3000]


@pytest.mark.parametrize("size,shift", [(10, 10), (10, 5), (7, 3), (3, 5)])
def test_sliding_batches_and_pane_totals(spark, size, shift):
    df = spark.range(1, 61).select(F.col("id").alias("seq"), F.col("id").alias("v"))
    want = {}
    for s in range(1, 61):
        for b in range(0, 60):
            if b * shift < s <= b * shift + size:
                n, t = want.get(b, (0, 0))
                want[b] = (n + 1, t + s)
    rows = sliding_batches(df, size, shift).groupBy("batch").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    assert {r.batch: (r.n, r.v) for r in rows.collect()} == want
    assert {r.batch: (r.n, r.v) for r in batch_totals(df, size, shift, ["v"]).collect()} == want
