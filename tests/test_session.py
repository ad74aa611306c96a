"""Scratch locations and path resolution."""

from types import SimpleNamespace

import pytest

from trawl import session


def test_no_machine_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        session.checkpoint_root(SimpleNamespace(conf=conf, sparkContext=context))
    context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.checkpoint_root(SimpleNamespace(conf=conf, sparkContext=context))


def test_paths_resolve_through_the_default_file_system(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert session.fs_uri(spark, "/tmp/x") == "file:///tmp/x"
    assert session.fs_uri(spark, "file:/tmp/x") == "file:///tmp/x"
    conf.set("fs.viewfs.mounttable.store.link./in", "file:///tmp")
    old = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://store")
    try:
        assert session.fs_uri(spark, "/in/x") == "viewfs://store/in/x"
    finally:
        conf.set("fs.defaultFS", old)


def test_literal_rows(spark):
    df = session.literal_rows(spark, [(1, "a"), (None, "b")], "x bigint, y string")
    assert [tuple(r) for r in df.collect()] == [(1, "a"), (None, "b")]
    assert df.schema.simpleString() == "struct<x:bigint,y:string>"
    assert session.literal_rows(spark, [], "x bigint, y string").count() == 0
