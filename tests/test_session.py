"""Checkpoint folder handling: the session's folder is used, never replaced."""

from ridelens.session import checkpoint_dir, ensure_checkpoint_dir
from ridelens.sources import checkpoint_table


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == configured
    assert ensure_checkpoint_dir(spark) == configured
    assert spark.sparkContext.getCheckpointDir() is not None


def test_checkpoint_tables_live_under_it(spark):
    df = spark.range(5)
    copy = checkpoint_table(df, "session_test")
    files = copy.inputFiles()
    root = checkpoint_dir(spark).replace("file:", "")
    assert files and all(root in f for f in files)
    assert copy.count() == 5


def test_one_copy_per_input_and_none_after_clearing(spark):
    import os
    from urllib.parse import urlparse

    from ridelens import session
    from ridelens.plans.catalog import QUERIES

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    session.clear_scratch()
    for key in ("narrow_types", "analysis_rides", "frequency", "od_rollup", "histogram"):
        QUERIES[key](spark, sf).count()
    own = sorted(session._SCRATCH)
    assert len([p for p in own if "rides_narrow" in p]) == 1
    assert all(os.path.isdir(urlparse(p).path) for p in own)
    assert session.clear_scratch() == len(own)
    assert not any(os.path.exists(urlparse(p).path) for p in own)
    assert QUERIES["frequency"](spark, sf).count() > 0  # written anew
