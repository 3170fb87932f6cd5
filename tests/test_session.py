import os

import pytest

from contestry import session


class Stub:
    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_shared_folder_comes_from_the_session():
    assert session.shared_folder(Stub(spark_checkpoint_dir="s3://bucket/cp/")) == "s3://bucket/cp"


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "local-cluster[3,2,1024]", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_folder(Stub(spark_master=master))


def test_a_scope_deletes_what_was_stored_in_it(spark):
    outside = session.materialize(spark.range(3), "outside")
    with session.scope(spark):
        inside = session.materialize(spark.range(5), "inside")
        files = inside.inputFiles()
        assert inside.count() == 5 and files
    assert outside.count() == 3
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_a_local_master_may_use_a_temporary_folder():
    folder = session.shared_folder(Stub(spark_master="local[2]"))
    assert os.path.isdir(folder) and folder == session.shared_folder(Stub(spark_master="local[2]"))


def test_materialized_partitions_are_pruned(spark):
    df = spark.range(100).selectExpr("id", "id % 4 AS part")
    stored = session.materialize(df, "parts", partition_by="part")
    assert stored.columns == ["id", "part"] and stored.count() == 100
    one = stored.filter("part = 2")
    assert one.count() == 25
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
