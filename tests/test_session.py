import os

from pyspark.sql import functions as F

from driftline.session import fresh_path, scratch, stored


def test_scratch_removes_what_was_stored_inside(spark):
    out = fresh_path(spark, "out")
    inside = []
    with scratch(spark):
        rows = stored(spark.range(100), "inner")
        inside += rows.inputFiles()
        with scratch(spark):
            nested = stored(spark.range(5), "nested")
            inside += nested.inputFiles()
            assert nested.count() == 5
        assert not os.path.exists(inside[-1].removeprefix("file://"))
        rows.agg(F.sum("id").alias("s")).write.parquet(out)
    assert inside and not any(os.path.exists(f.removeprefix("file://")) for f in inside)
    assert spark.read.parquet(out).first().s == 4950
