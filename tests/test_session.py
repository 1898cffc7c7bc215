"""Work folders and their removal."""

from roadpulse.session import mark, release, workspace
from roadpulse.streaming import files


def test_work_folders_are_removed_from_a_mark_on(spark):
    def made(label):
        path = workspace(spark, label)
        spark.range(3).write.parquet(path)
        return path

    before = made("before")
    start = mark()
    first, second, third = (made("after") for _ in range(3))
    assert release(spark, start, but_last=1) == 2
    assert [files.exists(spark, p) for p in (before, first, second, third)] == [True, False, False, True]
    assert spark.read.parquet(third).count() == 3
    assert release(spark, start) == 1 and release(spark, start) == 0
    assert not files.exists(spark, third) and files.exists(spark, before)
    # a folder that was never written is no obstacle
    workspace(spark, "unwritten")
    assert release(spark, start) == 1
