"""Where intermediate tables go."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from tidemark import TidemarkError
from tidemark.staging import JOB_SETTINGS, Stage, job_session, shared_folder


class Session:
    """A session on some master, with or without a named folder."""

    def __init__(self, master, named=None):
        self.sparkContext, self.conf = self, self
        self.master, self.named, self.context_folder = master, named, None

    def get(self, key, default):
        return self.named or default

    def getCheckpointDir(self):
        return self.context_folder

    def setCheckpointDir(self, folder):
        self.context_folder = folder


def test_the_named_folder_is_used(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    stage = Stage(spark)
    assert stage.path("rows").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert Stage(spark).root != stage.root


def test_a_cluster_needs_a_shared_folder():
    assert shared_folder(Session("yarn", "hdfs://cp")) == "hdfs://cp"
    with pytest.raises(TidemarkError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))


def test_a_local_session_gets_one_folder_of_its_own():
    session = Session("local[2]")
    assert shared_folder(session) == shared_folder(session) == session.context_folder


def test_a_job_has_settings_of_its_own(spark):
    before = {key: spark.conf.get(key) for key in JOB_SETTINGS}
    session = job_session(spark)
    assert {key: session.conf.get(key) for key in JOB_SETTINGS} == JOB_SETTINGS
    assert {key: spark.conf.get(key) for key in JOB_SETTINGS} == before
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.checkpoint.dir"):
        assert session.conf.get(key) == spark.conf.get(key)


def test_a_stage_can_be_removed(spark):
    stage = Stage(spark)
    assert stage.write(spark.range(3), "rows").count() == 3
    stage.remove()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(stage.path("rows"))


def test_a_folder_that_may_be_local_is_pointed_out():
    with pytest.warns(UserWarning, match="all executors share"):
        assert shared_folder(Session("spark://host:7077", "file:/mnt/cp")) == "file:/mnt/cp"
