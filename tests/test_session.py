"""The settings of a job while it runs."""

from pyspark.sql import functions as F

from conftest import plan_of
from lakemart.operators.joins import matching
from lakemart.session import AS_MEASURED, BY_FILES, job_settings


def test_many_keys_in_a_small_file_are_not_broadcast(spark, tmp_path):
    """Their files are below the threshold, the keys themselves are not."""
    keys = spark.range(0, 1_500_000, 1, 4).select((F.col("id") % 1_500_000).alias("k"))
    keys.write.parquet(str(tmp_path / "keys"))
    assert sum(f.stat().st_size for f in (tmp_path / "keys").glob("*.parquet")) < 10 << 20
    ids = spark.read.parquet(str(tmp_path / "keys"))
    with job_settings(spark):
        found = matching(spark.range(3_000_000).select(F.col("id").alias("k")), ids, "k")
        assert len(found.select(F.count(F.lit(1)).alias("n")).where("n = 1500000").collect()) == 1
        assert "Broadcast" not in plan_of(found)
        # What is measured to be small still is.
        small = matching(spark.range(3_000_000).select(F.col("id").alias("k")), ids.where("k < 10"), "k")
        assert small.count() == 10
        adaptive = small.groupBy().count()
        adaptive.collect()
        assert "BroadcastHashJoin" in plan_of(adaptive)


def test_a_job_within_a_job_keeps_the_threshold_of_the_session(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="1234")
    with job_settings(spark), job_settings(spark):
        assert spark.conf.get(AS_MEASURED) == "1234" and spark.conf.get(BY_FILES) == "-1"
    assert spark.conf.get(BY_FILES) == "1234" and spark.conf.get(AS_MEASURED, None) is None
