import types

import pytest

from mergewell import storage


def _session(master, conf=None, on_context=None):
    option = types.SimpleNamespace(isDefined=lambda: on_context is not None, get=lambda: on_context)
    sc = types.SimpleNamespace(getCheckpointDir=lambda: option)
    context = types.SimpleNamespace(master=master, _jsc=types.SimpleNamespace(sc=lambda: sc))
    return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d=None: conf or d), sparkContext=context)


def test_the_shared_folder():
    assert storage.shared_dir(_session("spark://a:1", "hdfs:/c/", "hdfs:/x")) == "hdfs:/c"
    assert storage.shared_dir(_session("spark://a:1", None, "hdfs:/x/y")) == "hdfs:/x/y"
    assert storage.shared_dir(_session("local[4]")) == storage.LOCAL_CHECKPOINTS
    with pytest.raises(RuntimeError):
        storage.shared_dir(_session("yarn"))


def test_tables_are_written_and_deleted(spark):
    a = storage.materialize(spark.range(3), "t")
    b = storage.materialize(spark.range(4), "t")
    assert a.count() + b.count() == 7
    storage.drop_materialized(a, b, spark.range(1))
    with pytest.raises(Exception):
        spark.read.parquet(a._mergewell_path).count()


def test_free_names(spark):
    df = spark.range(1).selectExpr("id", "id AS Rest", "id AS rest_")
    assert storage.free_name("rest", df) == "rest__" and storage.free_name("x", df) == "x"
