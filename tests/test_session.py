"""Write-once reuse is keyed by the input files; broadcasts are size-checked."""

import os
import time

import pandas as pd
from pyspark.sql import functions as F

from likeness.session import bounded_broadcast, input_fingerprint, input_parallelism, written


def test_written_table_is_reused_until_the_input_changes(spark, tmp_path):
    src = tmp_path / "t.parquet"
    pd.DataFrame({"x": [1, 2, 3]}).to_parquet(src)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(str(src)).agg(F.sum("x").alias("s"))

    a = written(spark, "sum_t", [str(src)], (), build)
    b = written(spark, "sum_t", [str(src)], (), build)
    assert a.first()["s"] == 6 and b.first()["s"] == 6 and len(calls) == 1
    time.sleep(1.1)
    pd.DataFrame({"x": [10, 20]}).to_parquet(src)
    os.utime(src, None)
    c = written(spark, "sum_t", [str(src)], (), build)
    assert c.first()["s"] == 30 and len(calls) == 2
    d = written(spark, "sum_t", [str(src)], ("other params",), build)
    assert d.first()["s"] == 30 and len(calls) == 3


def test_bounded_broadcast_falls_back_to_shuffle(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(5).withColumnRenamed("id", "k")
    j1 = big.join(bounded_broadcast(small, max_rows=10), "k")
    j2 = big.join(bounded_broadcast(big.select("k"), max_rows=10), "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p1 = j1._jdf.queryExecution().executedPlan().toString()
        p2 = j2._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in p1
    assert "BroadcastHashJoin" not in p2


def test_input_parallelism_only_for_narrow_scans(spark):
    wide = spark.range(0, 100, numPartitions=spark.sparkContext.defaultParallelism)
    assert input_parallelism(wide) is wide
    narrow = spark.range(0, 100, numPartitions=1)
    assert input_parallelism(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_a_file_replaced_in_a_partition_folder_is_seen(spark, tmp_path):
    folder = tmp_path / "t.parquet" / "k=1"
    folder.mkdir(parents=True)
    pd.DataFrame({"x": [1]}).to_parquet(folder / "a.parquet")
    before = input_fingerprint(spark, str(tmp_path / "t.parquet"))
    pd.DataFrame({"x": [1, 2, 3]}).to_parquet(folder / "a.parquet")
    assert input_fingerprint(spark, str(tmp_path / "t.parquet")) != before


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest

    from likeness.session import ensure_checkpoint_dir

    bare = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
                           conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(bare)
