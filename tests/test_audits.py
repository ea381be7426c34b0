"""Audits taken in the pass that writes."""

from helpers import frame, rows
from pyspark.sql import functions as F

from gradientlab.operators import quality as Q


def jobs(spark, run):
    """The result of ``run`` and the number of jobs that it started."""
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = run()
    return out, len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before)


def test_audits_come_from_the_write(spark, tmp_path):
    df = frame(spark, "a int, b string", (1, None), (None, None), (3, "x"))
    df.write.parquet(str(tmp_path / "in"))
    stored = spark.read.parquet(str(tmp_path / "in"))
    audits = {**Q.null_audits(["a", "b"]), "rows": F.count(F.lit(1))}
    out, outside = jobs(spark, lambda: Q.audited_write(stored, lambda d: d.write.parquet(str(tmp_path / "out")), audits))
    assert outside == 0  # no job beside those of the write
    assert rows(out, "audit", "n") == [("a", 1), ("b", 2), ("rows", 3)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_growth_counts_every_step_and_runs_each_once(spark, tmp_path):
    calls = []

    def doubled(d):
        calls.append("doubled")
        return d.union(d)

    source = spark.range(10).withColumn("k", F.col("id") % 2)
    steps = [("even", lambda d: d.filter("k = 0")), ("doubled", doubled), ("grouped", lambda d: d.groupBy("id").count())]
    out = Q.growth_of(source, steps, lambda d: d.write.parquet(str(tmp_path / "end")), staged=["even"])
    assert rows(out, "step", "name", "n") == [(0, "even", 5), (1, "doubled", 10), (2, "grouped", 5)]
    assert calls == ["doubled"]


def test_empty_frames_and_a_stage_that_ran_again(spark, tmp_path, monkeypatch):
    empty = frame(spark, "a int, b string", (1, "x")).limit(0)
    out = Q.audited_write(empty, lambda d: d.write.parquet(str(tmp_path / "none")), Q.null_audits(["a"]))
    assert rows(out, "audit", "n") == [("a", 0)]
    steps = [("none", lambda d: d.filter("false")), ("joined", lambda d: d.join(d.select("a"), "a"))]
    out = Q.growth_of(empty, steps, lambda d: d.write.parquet(str(tmp_path / "nothing")))
    assert rows(out, "step", "n") == [(0, 0), (1, 0)]
    monkeypatch.setattr(Q.Watch, "_ran_again", lambda self, group: True)
    out = Q.growth_of(spark.range(7), [("all", lambda d: d), ("odd", lambda d: d.filter("id % 2 = 1"))],
                      lambda d: d.write.parquet(str(tmp_path / "again")))
    assert rows(out, "name", "n") == [("all", 7), ("odd", 3)]


def test_the_caller_keeps_its_job_group(spark, tmp_path):
    spark.sparkContext.setJobGroup("mine", "my jobs")
    try:
        Q.audited_write(spark.range(3), lambda d: d.write.parquet(str(tmp_path / "o")), {"rows": F.count(F.lit(1))})
        assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "mine"
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(key, None)
