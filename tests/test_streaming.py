import random

import pytest

from driftline.operators.tree import numeric_stats
from driftline.session import fresh_path
from driftline.sources.replay import import_stream, replay_csv, stream_csv, stream_parquet
from driftline.sources.sinks import callback, export_stream, insert_into
from driftline.streaming.keyed import dictionary_entries, dictionary_state
from driftline.streaming.incremental import accumulate, dictionary_stream, latest_dictionary, total
from driftline.streaming.learners import ClassifierStream, ClusterStream, RegressorStream
from driftline.streaming.store import ModelStore

SCHEMA = "k long, x double, z double, label string"


def flowers(n=600):
    rng = random.Random(6)
    return [(i, rng.gauss(4 * (i % 2), 0.6), rng.random(), "?" if i % 30 == 29 else "ab"[i % 2]) for i in range(n)]


def add_file(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def drain(learner, spark, path, schema=SCHEMA):
    frame = spark.createDataFrame([], schema)
    learner.start(stream_parquet(spark, path, frame.schema, files_per_trigger=1)).awaitTermination()


def nodes(learner, spark):
    return sorted(map(tuple, (r.asDict().values() for r in learner.model().nodes(spark).drop("counts", "start").collect())))


def test_csv_replay_batch_and_stream(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([(1.5, "a"), (2.0, "?")], "x double, label string").write.csv(path)
    assert {tuple(r) for r in replay_csv(spark, path, "x double, label string").collect()} == {(1.5, "a"), (2.0, "?")}
    out = fresh_path(spark, "out")
    stream = stream_csv(spark, path, "x double, label string", files_per_trigger=1)
    insert_into(stream, out + "/rows", out + "/checkpoint").awaitTermination()
    assert spark.read.parquet(out + "/rows").count() == 2


def test_malformed_line_fails(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("oops,a",)], "line string").write.text(path)
    with pytest.raises(Exception, match="(?i)malformed"):
        replay_csv(spark, path, "x double, label string").collect()


def test_named_tables_and_callback(spark):
    spark.sql("DROP TABLE IF EXISTS driftline_in")
    spark.sql("DROP TABLE IF EXISTS driftline_out")
    folder = fresh_path(spark, "tables")
    spark.range(10).write.option("path", folder + "/in").format("parquet").saveAsTable("driftline_in")
    spark.sql(f"CREATE TABLE driftline_out (id bigint) USING parquet LOCATION '{folder}/out'")
    export_stream(import_stream(spark, "driftline_in"), "driftline_out", folder + "/c1").awaitTermination()
    assert spark.table("driftline_out").count() == 10
    seen = []
    callback(import_stream(spark, "driftline_in"), lambda b, rows: seen.append((b, rows.count())), folder + "/c2").awaitTermination()
    assert seen == [(0, 10)]
    spark.sql("DROP TABLE driftline_in")
    spark.sql("DROP TABLE driftline_out")


def test_statistics_over_micro_batches_equal_one_batch(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "stats")
    rows = [(i, [float(i % 7), float(i % 11)], i % 2, 0) for i in range(90)]
    schema = "k long, features array<double>, label int, leaf int"
    for lo in (0, 30, 60):
        add_file(spark, path, rows[lo : lo + 30], schema)
    frame = spark.createDataFrame(rows, schema)
    accumulate(stream_parquet(spark, path, frame.schema, files_per_trigger=1), lambda b: numeric_stats(b, 2), out).awaitTermination()
    merged = total(spark, out, ["leaf", "label", "attr"], n="sum", s="sum", q="sum", lo="min", hi="max")
    key = lambda r: (r.leaf, r.label, r.attr, r.n, r.s, r.q, r.lo, r.hi)
    assert sorted(map(key, merged.collect())) == sorted(map(key, numeric_stats(frame, 2).collect()))


def test_dictionary_stream(spark):
    path, out = fresh_path(spark, "in"), fresh_path(spark, "dict")
    for part in ([(1, "b"), (2, "a")], [(3, "c"), (4, "a")], [(5, "d"), (6, "b")]):
        add_file(spark, path, part, "k long, v string")
    stream = stream_parquet(spark, path, spark.createDataFrame([], "k long, v string").schema, files_per_trigger=1)
    dictionary_stream(stream, ["v"], "k", out).awaitTermination()
    got = {r.value: (r.idx, r.first_seq, r.n_rows) for r in latest_dictionary(spark, out).collect()}
    assert got == {"b": (0, 1, 2), "a": (1, 2, 2), "c": (2, 3, 1), "d": (3, 5, 1)}


def classifier(spark, name, **more):
    return ClassifierStream(spark, fresh_path(spark, name), "k", numeric=["x", "z"], label="label", n_classes=2, **more)


def test_restart_equals_an_uninterrupted_run(spark):
    rows = flowers()
    path_a, path_b = fresh_path(spark, "a"), fresh_path(spark, "b")
    once, twice = classifier(spark, "once"), classifier(spark, "twice")
    for lo in (0, 200, 400):
        add_file(spark, path_a, rows[lo : lo + 200])
        add_file(spark, path_b, rows[lo : lo + 200])
        if lo == 200:
            drain(twice, spark, path_b)
    drain(once, spark, path_a)
    again = ClassifierStream(spark, twice.path, "k", numeric=["x", "z"], label="label", n_classes=2)
    drain(again, spark, path_b)
    assert nodes(once, spark) == nodes(again, spark) and len(nodes(once, spark)) > 1
    a, b = (sorted(map(tuple, l.outputs("predictions").drop("batch_id").collect())) for l in (once, again))
    assert a == b and len(a) == 20
    late = [r for r in a if r[0] > 400]
    assert all(r[-1] == ("a" if r[1] < 2 else "b") for r in late)
    assert again.outputs("pairs").count() == 580


def test_replayed_batch_overwrites_its_version(spark):
    learner = classifier(spark, "replay")
    rows = flowers(400)
    first, second = (spark.createDataFrame(rows[lo : lo + 200], SCHEMA) for lo in (0, 200))
    learner.step(first, 0)
    learner.step(second, 1)
    before = nodes(learner, spark), learner.outputs("pairs").count()
    learner.step(second, 1)
    assert (nodes(learner, spark), learner.outputs("pairs").count()) == before
    assert learner.store.latest_before()[1]["seen"] == 400


def test_limit_runs_across_batches(spark):
    learner = classifier(spark, "limit", max_instances=250)
    for b, lo in enumerate((0, 200)):
        learner.step(spark.createDataFrame(flowers()[lo : lo + 200], SCHEMA), b)
    assert learner.outputs("pairs").count() + learner.outputs("predictions").count() == 250


def test_regressor_stream(spark):
    rng = random.Random(1)
    rows = [(i, rng.uniform(0, 10)) for i in range(300)]
    rows = [(i, x, -0.0 if i % 50 == 49 else 3 * x + 7) for i, x in rows]
    learner = RegressorStream(spark, fresh_path(spark, "reg"), "k", features=["x"], target="y")
    for b, lo in enumerate((0, 100, 200)):
        learner.step(spark.createDataFrame(rows[lo : lo + 100], "k long, x double, y double"), b)
    out = [r for r in learner.outputs("predictions").collect() if r.seq > 100]
    assert len(out) == 4 and all(r.prediction == pytest.approx(3 * r.x + 7, abs=1e-6) for r in out)


def test_cluster_stream(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(50 * (i % 2), 1)) for i in range(200)]
    learner = ClusterStream(spark, fresh_path(spark, "cl"), "k", features=["x"], k=2)
    for b, lo in enumerate((0, 100)):
        learner.step(spark.createDataFrame(rows[lo : lo + 100], "k long, x double"), b)
    last = learner.outputs("centers").filter("batch_id = 1").first()
    assert abs(float(last.center0.strip("[]"))) < 1 and abs(float(last.center1.strip("[]")) - 50) < 1
    assert sum(k[0] for k in learner.model().kernels) == pytest.approx(200)


def test_empty_store(spark):
    assert ModelStore(spark, fresh_path(spark, "none")).latest_before() is None


def test_summary_and_processing_time_trigger(spark):
    from driftline.streaming.progress import summary

    path, out = fresh_path(spark, "in"), fresh_path(spark, "timed")
    add_file(spark, path, [(1, "a"), (2, "b")], "k long, v string")
    stream = stream_parquet(spark, path, spark.createDataFrame([], "k long, v string").schema)
    query = insert_into(stream, out + "/rows", out + "/checkpoint", {"processingTime": "100 milliseconds"})
    query.processAllAvailable()
    got = summary(query)
    query.stop()
    assert (got["instances"], got["batches"]) == (2, 1) and got["seconds"] > 0


def test_keyed_state_holds_dictionaries_over_restarts(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice("abcdefg") if i % 3 else "hot", None if i % 7 == 0 else f"n{rng.randint(0, 40)}") for i in range(1, 601)]
    path, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    schema = spark.createDataFrame([], "k long, kind string, name string").schema
    want = {}
    for part in range(3):  # each part is a new query on the same checkpoint
        own = rows[part * 200 : (part + 1) * 200]
        rng.shuffle(own)
        add_file(spark, path, own, schema)
        dictionary_state(stream_parquet(spark, path, schema), ["kind", "name"], "k", out).awaitTermination()
        for i, *values in own:
            for attr, value in zip(("kind", "name"), values):
                if value is not None:
                    first, n = want.get((attr, value), (i, 0))
                    want[(attr, value)] = (min(first, i), n + 1)
        found = dictionary_entries(spark, out).collect()
        assert {(r.attr, r.value): (r.first_seq, r.n_rows) for r in found} == want
    for attr in ("kind", "name"):
        order = [r.value for r in sorted(found, key=lambda r: r.idx) if r.attr == attr]
        assert order == [v for _, v in sorted((f, v) for (a, v), (f, _) in want.items() if a == attr)]
