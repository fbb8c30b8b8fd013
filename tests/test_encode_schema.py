import pytest
from pyspark.sql import functions as F

import driftline
from driftline.functions.vectors import argmax_votes, center_format, doubles, vectorize
from driftline.operators import encode
from driftline.schema import parse_cardinalities, predict_target, role_of_label, role_of_target


def labelled(spark, values):
    return spark.createDataFrame(list(enumerate(values, 1)), "seq long, label string")


def codes(spark, values, n, overflow):
    df = labelled(spark, values)
    out = encode.encode_label(df, "label", encode.label_dictionary(df, "label"), n, overflow)
    return [r.label_idx for r in out.orderBy("seq").collect()]


def test_index_by_first_appearance_with_predict_marker_first(spark):
    assert codes(spark, ["?", "b", "a", "b", "c"], 3, "error") == [-1, 0, 1, 0, 2]
    assert codes(spark, ["?", "?"], 2, "error") == [-1, -1]


def test_class_cap(spark):
    values = ["b", "a", "b", "c", "?"]
    with pytest.raises(ValueError, match="2 classes"):
        codes(spark, values, 2, "error")
    assert codes(spark, values, 2, "first") == [0, 1, 0, 0, -1]
    assert codes(spark, values, 2, "skip") == [0, 1, 0, -1]


@pytest.mark.parametrize("limit", [100_000, 3])
def test_large_dictionaries_give_the_same_result(spark, monkeypatch, limit):
    """Below the limit everything is broadcast; above it hot values are broadcast and the rest is joined by shuffle."""
    monkeypatch.setattr(encode, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(encode, "HOT_ENTRIES", 4)
    values = ["hot" if i % 3 == 0 else f"v{(i * 7) % 40}" for i in range(300)] + [None]
    df = labelled(spark, values).withColumn("other", F.reverse("label"))
    dictionary = encode.first_seen_dictionary(df, ["label", "other"])
    coded = encode.encode_nominal(df, ["label", "other"], dictionary)
    first = list(dict.fromkeys(v for v in values if v is not None))
    got = [(r.label_idx, r.other_idx) for r in coded.orderBy("seq").collect()]
    assert got == [(None, None) if v is None else (first.index(v), first.index(v)) for v in values]
    back = encode.decode(coded, "label_idx", dictionary, "label", "back").orderBy("seq").collect()
    assert [r.back for r in back] == values


def test_dictionary_grows_over_batches(spark):
    a, b = labelled(spark, ["x", "y", "x"]), labelled(spark, ["z", "y", "w"]).withColumn("seq", F.col("seq") + 3)
    first = encode.number_entries(encode.value_counts(a, ["label"]))
    both = encode.extend_dictionary(first, encode.value_counts(b, ["label"]))
    assert {r.value: (r.idx, r.n_rows) for r in both.collect()} == {"x": (0, 2), "y": (1, 2), "z": (2, 1), "w": (3, 1)}


def test_unseen_index_decodes_to_null(spark):
    df = labelled(spark, ["a"]).withColumn("i", F.lit(5))
    assert encode.decode(df, "i", encode.label_dictionary(df, "label"), "label", "p").first().p is None


def test_negative_zero_asks_for_a_prediction(spark):
    df = spark.range(1).select(
        role_of_target(predict_target()).alias("neg"), role_of_target(F.lit(0.0)).alias("pos"),
        role_of_target(F.lit(-1.5)).alias("other"), role_of_label(F.lit("?")).alias("q"), role_of_label(F.lit(3)).alias("t"),
    )
    assert tuple(df.first()) == ("predict", "train", "train", "predict", "train")


def test_vector_expressions(spark):
    df = spark.range(1).select(
        argmax_votes(doubles([1.0, 3.0, 3.0])).alias("tie"), argmax_votes(doubles([])).alias("empty"),
        center_format(doubles([1.5, 2.0])).alias("text"),
    )
    assert tuple(df.first()) == (1, 0, "[1.5,2.0]")


def test_null_attribute_fails_or_is_kept(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert df.select(vectorize(["a", "b"], "keep").alias("v")).first().v == [1.0, None]
    with pytest.raises(Exception, match="null attribute b"):
        df.select(vectorize(["a", "b"])).collect()


def test_cardinalities():
    assert parse_cardinalities("3,5", ["a", "b"]) == {"a": 3, "b": 5}
    with pytest.raises(ValueError, match="required 2 nominal cardinalities but found 1"):
        parse_cardinalities("3", ["a", "b"])


@pytest.mark.parametrize(
    "options,message",
    [
        ({"n_classes": "3"}, "n_classes: required int but found str"),
        ({"n_classes": 0}, "n_classes: required at least 1"),
        ({"interval": 0}, "interval"),
        ({"parallelism": 0}, "parallelism"),
        ({"bagging": -1}, "bagging"),
        ({"max_instances": -2}, "max_instances"),
        ({"numeric": ["label"]}, "numeric column 'label': required .* but found string"),
        ({"numeric": ["nope"]}, "column 'nope' not found"),
        ({"label": "nope"}, "label column"),
        ({"order_by": "nope"}, "order column"),
        ({"nominal": ["label"], "nominal_values": "3,4"}, "required 1 nominal"),
        ({"overflow": "drop"}, "overflow"),
    ],
)
def test_classifier_parameters_are_checked_before_any_job(spark, options, message):
    df = labelled(spark, ["a"]).withColumn("x", F.lit(1.0))
    base = {"numeric": ["x"], "label": "label", "n_classes": 2, "order_by": "seq"}
    with pytest.raises(ValueError, match=message):
        driftline.hoeffding_classifier(df, **{**base, **options})


def test_other_learners_check_parameters(spark):
    df = spark.createDataFrame([(1, 1.0, "s")], "k long, x double, s string")
    with pytest.raises(ValueError, match="k: required at least 2"):
        driftline.microcluster_kmeans(df, ["x"], 1, "k")
    with pytest.raises(ValueError, match="target column 's'"):
        driftline.rules_regressor(df, ["x"], "s", "k")
    with pytest.raises(ValueError, match="at least one attribute"):
        driftline.rules_regressor(df, [], "x", "k")
    with pytest.raises(ValueError, match="reserved"):
        driftline.rules_regressor(df.withColumn("pred", F.lit(1.0)), ["x"], "x", "k")
