from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from brooktext.sources.workspace import SHUFFLE_CLEANUP, discard, exists, materialize, release, shared_root


def session_without_setting(master):
    conf = SimpleNamespace(get=lambda name, default: default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_a_local_session_without_the_setting_gets_one_folder():
    local = session_without_setting("local[2]")
    assert shared_root(local) == shared_root(local)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_root(session_without_setting("spark://host:7077"))


def test_staged_copies_can_be_deleted(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    first, second = (materialize(spark.range(10).groupBy(F.col("id") % 3).count(), "copy") for _ in range(2))
    assert first.count() == 3 and exists(spark, first.staged_path)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    discard(first)
    assert not exists(spark, first.staged_path) and exists(spark, second.staged_path)
    release(spark)
    assert not exists(spark, second.staged_path)
