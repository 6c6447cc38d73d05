from types import SimpleNamespace

import pytest

from tierline import work_folder


def fake(master, folder):
    conf = SimpleNamespace(get=lambda name, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_folder_is_below_the_shared_folder():
    first, second = (work_folder(fake("spark://host", "hdfs://shared/"), "x") for _ in range(2))
    assert first.startswith("hdfs://shared/tierline-x-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(fake("spark://host", None), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(fake("local-cluster[3,2,1024]", None), "x")
    assert work_folder(fake("local[8]", None), "x") and work_folder(fake("local", None), "x")
