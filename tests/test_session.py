"""The shared folder comes from the session; a local one is made only when unset."""

from constella.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_kept_and_scratch_lives_under_it(spark):
    first = ensure_checkpoint_dir(spark)
    assert first == spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == first
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(first) and b.startswith(first) and a != b
