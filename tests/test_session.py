import pytest

from tillwork.session import build_session, settings_for, shared_folder


class Session:
    """Only what shared_folder asks a session for; its folder is fixed once it runs."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_task_sizes_grow_with_the_input():
    def sizes(n):
        s = settings_for(n)
        split = int(s["spark.sql.files.maxPartitionBytes"])
        return split // 2**20, int(s["spark.sql.shuffle.partitions"])

    assert sizes(2**30) == (128, 200)
    assert sizes(2**40) == (128, 2048)
    assert sizes(100 * 2**40) == (512, 40_000)


def test_shared_folder_is_new_for_each_run():
    session = Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    first, second = shared_folder(session), shared_folder(session)
    assert first != second
    assert first.startswith("hdfs:///shared/") and "//" not in first.removeprefix("hdfs:///")


def test_only_a_local_session_may_lack_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark_master="yarn"))
    assert "/_staging/" in shared_folder(Session(spark_master="local[2]"))
    given = shared_folder(Session(spark_master="yarn"), "s3a://work/")
    assert given.startswith("s3a://work/")


def test_build_session_keeps_the_running_one(spark):
    again = build_session("again", settings={"spark.sql.shuffle.partitions": "8"})
    assert again.sparkContext is spark.sparkContext
