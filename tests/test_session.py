from types import SimpleNamespace

import pytest

from adtally.session import cut_lineage, shared_root, shuffle_conf, working_dir


def test_shuffle_width():
    assert shuffle_conf(0)["spark.sql.shuffle.partitions"] == "200"
    assert shuffle_conf(10**12)["spark.sql.shuffle.partitions"] == "7451"
    assert shuffle_conf(10**18)["spark.sql.shuffle.partitions"] == str(-(-(10**18) // (128 << 20)))


def session_with(folder, master="spark://host:7077"):
    context = SimpleNamespace(master=master, folder=None)
    context.getCheckpointDir = lambda: context.folder
    context.setCheckpointDir = lambda path: setattr(context, "folder", path)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    named = session_with("/shared/somewhere/")
    assert shared_root(named) == "/shared/somewhere"
    assert working_dir(named, "x").startswith("/shared/somewhere/adtally/x-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session_with(None))
    alone = session_with(None, "local[2]")
    assert shared_root(alone) == shared_root(alone)


def test_cut_lineage_is_reliable(spark):
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS n"))
    assert df.selectExpr("sum(n)").first()[0] == 90
    assert spark.sparkContext.getCheckpointDir() is not None
