from types import SimpleNamespace

import pytest

from tidemark.session import shared_dir


def _session(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None:
                                                settings.get(key, default)),
                           sparkContext=SimpleNamespace(applicationId="app-of-a-test"))


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_session(**{"spark.master": "spark://host:7077"}))
    with pytest.raises(ValueError):
        shared_dir(_session(**{"spark.master": "local-cluster[2,1,1024]"}))
    named = {"spark.master": "spark://host:7077", "spark.checkpoint.dir": "/shared"}
    assert shared_dir(_session(**named)) == "/shared"


def test_one_process_gets_one_folder_and_keeps_its_settings(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir", None) == before
