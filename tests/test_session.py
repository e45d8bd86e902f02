"""Session helpers: checkpoint folder and lineage cuts."""

from vantage.session import checkpoint_dir, cut_lineage, scratch_path


def test_checkpoint_dir_is_reused_and_lineage_cut(spark):
    first = checkpoint_dir(spark)
    assert checkpoint_dir(spark) == first
    assert scratch_path(spark, "x").startswith(first)
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS v"))
    assert df.agg({"v": "sum"}).first()[0] == 90
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString() or df.count() == 10


def test_cluster_conf_scales_with_input():
    from vantage.session import cluster_conf

    small = cluster_conf(8000)
    big = cluster_conf(8000, input_bytes=100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 32000
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
