"""Settings and the scratch folder."""

from types import SimpleNamespace

import pytest

from tillmart.session import RUNTIME_CONF, configure, scratch_dir


def stub(**settings):
    values = {key.replace("_", "."): value for key, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=values.get))


def test_scratch_is_below_the_shared_folder():
    spark = stub(spark_checkpoint_dir="hdfs:///shared", spark_master="yarn")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(stub(spark_master="spark://host:7077"), "x")
    assert scratch_dir(stub(spark_master="local[4]"), "x").startswith("/tmp/run-")


def test_configure(spark):
    configure(spark)
    assert all(spark.conf.get(key) == value for key, value in RUNTIME_CONF.items())
