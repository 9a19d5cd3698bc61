import pytest

from pairmill import session
from pairmill.sources import files

PARTITIONS = session.INITIAL_PARTITIONS


def test_scratch_paths_are_new_and_below_the_shared_folder(spark):
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert one != two and (root is None or one.startswith(root))


def test_a_cluster_must_name_its_shared_folder():
    class Unset:
        @staticmethod
        def get(key, default):
            return default

    class Cluster:
        conf = Unset
        sparkContext = type("Context", (), {"master": "yarn", "applicationId": "a"})

    class Local(Cluster):
        sparkContext = type("Context", (), {"master": "local[2]", "applicationId": "a"})

    class SeveralProcesses(Cluster):
        sparkContext = type("Context", (), {"master": "local-cluster[2,1,1024]"})

    with pytest.raises(ValueError):
        session.scratch_path(Cluster, "x")
    with pytest.raises(ValueError):
        session.scratch_path(SeveralProcesses, "x")
    assert session.scratch_path(Local, "x").startswith(session._local_scratch[0])


def test_shuffles_are_sized_by_the_input(spark, folder, monkeypatch):
    spark.range(10_000).write.parquet(folder)
    rows = spark.read.parquet(folder)
    size = session.input_bytes(rows.join(rows, "id"))
    assert size == 2 * session.input_bytes(rows) > 0
    before = spark.conf.get(PARTITIONS, None)
    with session.sized_shuffles(rows):
        assert spark.conf.get(PARTITIONS, None) == before
    monkeypatch.setattr(session, "SHUFFLE_BYTES", session.input_bytes(rows) // 50)
    with session.sized_shuffles(rows):
        assert 50 <= int(spark.conf.get(PARTITIONS)) <= 51
    assert spark.conf.get(PARTITIONS, None) == before


def test_an_input_of_unknown_size_gets_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(session, "input_bytes", lambda rows: None)
    with session.sized_shuffles(spark.range(1)):
        assert int(spark.conf.get(PARTITIONS)) == session.UNKNOWN_PARTITIONS


def test_scratch_can_be_cleared(spark):
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    assert not files.exists(spark, path)
