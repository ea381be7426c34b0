from gradientlab.session import clear_run, scratch_path, stage_table


def test_staging_same_name_twice_keeps_both(spark):
    a = stage_table(spark.range(3), "x/y")
    b = stage_table(spark.range(5), "x/y")
    c = stage_table(a, "x/y")
    assert (a.count(), b.count(), c.count()) == (3, 5, 3)
    assert scratch_path(spark, "z") != scratch_path(spark, "z")


def test_clear_run_removes_the_run_folder(spark):
    stage_table(spark.range(2), "gone")
    assert clear_run(spark)
    assert not clear_run(spark)
