import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marginfold.sources.layers import replace_table
from marginfold.sources.scratch import discard, scratch_folder, shared_base, shuffles_freed, written


def _session(setting=None, checkpoint=None, master="local[2]"):
    context = SimpleNamespace(applicationId=f"app-{master}", master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context)


def test_setting_comes_first():
    assert shared_base(_session("hdfs:///shared", "file:/other")) == "hdfs:///shared"


def test_checkpoint_folder_of_the_context():
    assert shared_base(_session(None, "file:/other", "spark://host:1")) == "file:/other"


@pytest.mark.parametrize("master", ["spark://host:1", "yarn", "local-cluster[2,1,512]"])
def test_cluster_without_shared_folder_raises(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_base(_session(master=master))


def test_local_session_gets_one_folder():
    assert shared_base(_session()) == shared_base(_session())


def test_written_and_discarded(spark):
    path = scratch_folder(spark)
    assert written(spark.range(3), path).count() == 3
    discard(spark, path)
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(path).count()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {name for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("write", [lambda frame, path: written(frame, path), replace_table])
def test_a_write_deletes_its_shuffles(spark, tmp_path, write):
    before = _shuffle_files(spark)
    write(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), f"{tmp_path}/t")
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before


@pytest.mark.parametrize("setting", ["false", "true"])
def test_the_setting_is_back_after_the_last_write(spark, setting):
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, setting)
    try:
        with pytest.raises(KeyError), shuffles_freed(spark):
            with shuffles_freed(spark):
                pass
            assert spark.conf.get(_CLEANUP) == "true"
            raise KeyError
        assert spark.conf.get(_CLEANUP) == setting
    finally:
        spark.conf.set(_CLEANUP, before)
