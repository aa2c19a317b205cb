import os

from tessera import scratch


def test_tables_are_written_and_cleared(spark):
    df, path = scratch.stored(spark.range(5), "numbers")
    assert path.startswith(scratch.shared_folder(spark))
    assert df.count() == 5
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    scratch.clear(spark)
    assert not os.path.exists(local)


def test_folder_of_the_session_comes_first(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    named = before or spark.sparkContext.getCheckpointDir()
    assert named is None or scratch.shared_folder(spark) == named
    assert scratch.new_path(spark, "x").startswith(scratch.shared_folder(spark))
