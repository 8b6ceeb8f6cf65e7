import pytest
from pyspark.sql import functions as F

from pergamon.operators import skew, tracking


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows have one key, a sixth have none; one key is hot on the right too."""
    left = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 6 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"),
        F.col("id").alias("value"),
    )
    right = spark.range(300).select(
        F.when(F.col("id") == 0, F.lit("hot")).when(F.col("id") == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        F.col("id").alias("extra"),
    )
    return left.cache(), right.cache()


@pytest.mark.parametrize("keep", [True, False])
def test_key_filter_takes_repeated_keys_once(sides, keep):
    left, right = sides
    how = "left_semi" if keep else "left_anti"
    plain = sorted(map(tuple, left.join(right, ["key"], how).collect()), key=repr)
    keys = right.unionByName(right).unionByName(right.where("key = 'hot'"))
    found = skew.key_filter(left, keys, ["key"], keep)
    assert sorted(map(tuple, found.collect()), key=repr) == plain


@pytest.mark.parametrize("how", ["inner", "left"])
def test_keyed_join_orders_columns(sides, how):
    left, right = sides
    joined = skew.keyed_join(left, right, ["key"], how)
    assert joined.columns == ["key", "value", "extra"]
    plain = left.join(right, ["key"], how).select("key", "value", "extra")
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_nothing_runs_while_joins_are_built(spark, sides):
    left, right = sides
    spark.sparkContext.setJobGroup("building", "no job may run")
    try:
        skew.key_filter(left, right, ["key"])
        skew.keyed_join(left, right, ["key"])
        paths = left.select(F.col("key").alias("path"))
        tracking.flatten_manifest(paths, "/flat")
        tracking.work_gate(one=left, two=right)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_work_gate_counts_empty_stages(spark, sides):
    left, right = sides
    counts = tracking.work_gate(one=left, none=right.where("false"))
    assert sorted(map(tuple, counts.collect())) == [("none", 0), ("one", 6000)]


def test_set_difference_treats_null_as_equal(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "path string")
    right = spark.createDataFrame([("b",), ("c",)], "path string")
    assert {r[0] for r in tracking.paths_except(left, right).collect()} == {"a", None}
    assert tracking.paths_except(left, right).count() == 2
    with_null = right.unionByName(spark.createDataFrame([(None,)], "path string"))
    assert [r[0] for r in tracking.paths_except(left, with_null).collect()] == ["a"]


def test_manifest_of_a_hot_base_name(spark):
    paths = spark.range(3000).select(
        F.concat(F.lit("/d"), "id", F.lit("/"),
                 F.when(F.col("id") % 3 == 0, F.lit("README.md"))
                 .otherwise(F.concat(F.lit("f"), "id"))).alias("path")
    )
    rows = tracking.flatten_manifest(paths, "/flat").collect()
    assert len(rows) == 3000
    readme = [r for r in rows if r["target_path"] == "/flat/README.md"]
    assert len(readme) == 1000 and all(r["collides"] for r in readme)
    assert [r["source_path"] for r in readme if r["stays"]] == [
        max(r["source_path"] for r in readme)
    ]
