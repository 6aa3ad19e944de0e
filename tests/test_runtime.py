from types import SimpleNamespace

import pytest

from textassay import runtime


def session(master, folder=None, app="app-1"):
    conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=app))


def test_shared_folder_comes_first():
    assert runtime.scratch_dir(session("yarn", "hdfs://x/check/")) == "hdfs://x/check/textassay/app-1"
    assert runtime.scratch_dir(session("local[2]", "/shared")) == "/shared/textassay/app-1"


def test_local_folder_only_in_local_sessions():
    folder = runtime.scratch_dir(session("local[2]", app="app-2"))
    assert folder == runtime.scratch_dir(session("local[2]", app="app-2"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.scratch_dir(session("spark://host:7077"))


def test_materialize_keeps_the_schema(spark):
    df = spark.createDataFrame([(1, [1, 2], None)], "a long, b array<int>, c string")
    kept = runtime.materialize(df, "t")
    assert kept.schema == df.schema and kept.collect() == df.collect()
    assert runtime.materialize(df.where("false"), "t").count() == 0


def test_spread_leaves_wide_frames_alone(spark):
    wide = spark.range(100, numPartitions=9)
    assert runtime.spread(wide) is wide
    assert runtime.spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == 8
