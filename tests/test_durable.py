"""Where intermediates are written."""

import pytest

from marquee import durable, session


class Bare:
    """A session without the setting, seen through the calls the library makes."""

    def __init__(self, master, named=None, context=None):
        self.conf, self.sparkContext, self.master, self.folder = self, self, master, context
        self.named = named

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_no_folder_is_an_error_that_says_what_to_set():
    for master in ("local[4]", "yarn", "spark://host:7077"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            durable.durable_dir(Bare(master))


def test_named_folders_are_taken():
    assert durable.durable_dir(Bare("yarn", "hdfs://x/y")) == "hdfs://x/y"
    assert durable.durable_dir(Bare("yarn", None, "hdfs://z")) == "hdfs://z"


def test_a_local_session_names_a_folder_only_where_none_is():
    bare = Bare("local[2]")
    session.name_scratch(bare)
    assert "marquee-scratch-" in durable.durable_dir(bare)
    for other in (Bare("local[2]", "/named"), Bare("yarn"), Bare("local-cluster[2,1,1024]")):
        session.name_scratch(other)
        assert other.folder is None


def test_written_tables_stand_in_the_folder(spark):
    df = durable.written(spark.range(3), "small")
    assert df.count() == 3 and all(durable.durable_dir(spark).removeprefix("file:") in f for f in df.inputFiles())
