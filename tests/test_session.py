import os
import types
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from peerscore import session


def on_disk(uri):
    return os.path.exists(urlparse(uri).path)


def fake(master, checkpoint=None):
    """A session without spark.checkpoint.dir, and the folders it was given."""
    given = []
    sc = types.SimpleNamespace(
        master=master, getCheckpointDir=lambda: checkpoint, setCheckpointDir=given.append
    )
    conf = types.SimpleNamespace(get=lambda key, default: default)
    return types.SimpleNamespace(sparkContext=sc, conf=conf), given


def test_the_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_root(spark) == named
    first, second = (session.scratch_path(spark, "t") for _ in range(2))
    assert first != second and first.startswith(named)


def test_a_scope_removes_what_was_staged_within(spark):
    df = spark.range(3).toDF("n")
    outside = session.stage(df, "outside")
    with session.scratch_scope(spark):
        first = session.stage(df, "first").inputFiles()
        with pytest.raises(ValueError, match="stop"), session.scratch_scope(spark):
            second = session.stage(df, "second").inputFiles()
            raise ValueError("stop")
        third = session.stage(df, "third").inputFiles()
        assert not any(map(on_disk, second)) and all(map(on_disk, first + third))
    assert not any(map(on_disk, first + third)) and outside.count() == 3


def test_a_cluster_must_name_a_shared_folder():
    cluster, _ = fake("spark://host:7077")
    with pytest.raises(RuntimeError, match="shared by all executors"):
        session.scratch_root(cluster)
    named, made = fake("spark://host:7077", checkpoint="hdfs://shared")
    assert session.scratch_root(named) == "hdfs://shared" and made == []


def test_a_local_session_gets_its_own_folder():
    local, made = fake("local[2]")
    root = session.scratch_root(local)
    assert made == [root]


def test_settling_measures_on_the_way(spark):
    df = spark.createDataFrame([("ab", 1), ("c", 2), (None, 3)], "s string, n int")
    settled, seen = session.settle(df, F.max("n").alias("most"))
    assert seen == {"rows": 3, "bytes": 3 * 32 + 3, "most": 3}
    assert sorted(map(tuple, settled.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_size_counts_the_text_of_other_types(spark):
    df = spark.createDataFrame([([1] * 100,)], "a array<int>")
    assert session.settle(df)[1]["bytes"] > 300


@pytest.mark.parametrize(("rows", "size", "small"), [
    (1, 1, True), (session.BROADCAST_ROWS + 1, 1, False), (1, session.BROADCAST_BYTES + 1, False),
])
def test_both_bounds_hold(rows, size, small):
    assert session.is_small({"rows": rows, "bytes": size}) is small
