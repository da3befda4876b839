import glob
import os

from pyspark import TaskContext
from pyspark.sql import functions as F

from tablekit.operators import file_merge
from tablekit.operators.aggregate import latest_per_key
from tablekit.plans.io_queries import file_layout
from tablekit.sinks.layout import _ends, file_count, write_clustered
from tablekit.streaming.latest_stream import batch_merger, start_latest_stream


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def _events(spark, low, high):
    return spark.range(low, high).selectExpr("id % 37 AS k", "(id * 7919) % 1000 AS at", "id", "concat('v', id) AS v")


def test_replayed_batches_give_the_latest_rows(spark, tmp):
    events = _events(spark, 0, 2000)
    for k in range(4):      # the last file repeats the first one's rows
        _events(spark, 0 if k == 3 else k * 700, 700 if k == 3 else min(2000, (k + 1) * 700)).coalesce(1).write.parquet(f"{tmp}/in/{k}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in/*")
    start_latest_stream(stream, f"{tmp}/t", f"{tmp}/c", "k", ["at", "id"], files=3).awaitTermination()
    got = file_merge.read(spark, f"{tmp}/t").select(*events.columns)
    assert _rows(got) == _rows(latest_per_key(events, "k", ["at", "id"]).select(*events.columns))
    assert len(file_merge.versions(spark, f"{tmp}/t")) == 4


def test_a_batch_run_twice_and_late_rows_change_nothing(spark, tmp):
    write = batch_merger(f"{tmp}/t", "k", ["at", "id"], 2)
    late, now = _events(spark, 0, 300).withColumn("at", F.lit(-1).cast("long")), _events(spark, 300, 900)
    write(now, 0)
    want = _rows(file_merge.read(spark, f"{tmp}/t").select("k", "at", "id", "v"))
    write(now, 0)
    write(late, 1)
    assert _rows(file_merge.read(spark, f"{tmp}/t").select("k", "at", "id", "v")) == want


def test_file_count_follows_the_bytes(spark, tmp):
    df = spark.range(60_000).selectExpr("id", "rand(3) AS x", "CASE WHEN id % 5 > 0 THEN rand(4) END AS `y z`", "current_timestamp() AS t")
    few, many = file_count(df, 1 << 20, sample_rows=5000), file_count(df, 1 << 17, sample_rows=5000)
    assert 4 <= many / max(1, few) <= 12 and file_count(df.limit(0), 1000) == 1
    n = write_clustered(df, f"{tmp}/t", "x", "y z", 1 << 17)
    written = spark.read.parquet(f"{tmp}/t")
    assert n == many or abs(n - many) <= 1
    assert written.columns == df.columns and written.count() == 60_000
    for c in ("x", "y z"):
        hit = written.where(F.col(f"`{c}`").between(0.30, 0.33)).select(F.col("_metadata.file_path")).distinct().count()
        assert hit <= n / 2


def test_the_sample_is_drawn_by_every_task(spark, tmp):
    def seen(batches):
        for batch in batches:
            with open(f"{tmp}/{TaskContext.get().taskAttemptId()}", "a") as f:
                f.write("." * batch.num_rows)
            yield batch

    rows = spark.range(0, 40_000, numPartitions=8).mapInArrow(seen, "id long")
    assert file_count(rows, 1 << 20, sample_rows=1000) == 1
    assert max(map(os.path.getsize, glob.glob(f"{tmp}/*"))) <= 5000


def test_files_end_with_blocks_of_the_curve():
    assert _ends([(p, 10) for p in range(64)], 4) == [16, 32, 48]
    assert _ends([(p, 10 + p % 3) for p in range(64)], 4) == [16, 32, 48]
    assert _ends([(0, 1000), *((p, 10) for p in range(1, 64))], 4) is None


def _lineitem(spark, n):
    return spark.range(n).selectExpr("id AS l_orderkey", "id % 97 AS l_partkey", "concat('x', id) AS l_comment")


def test_merging_reads_the_files_not_the_rows_again(spark, tmp):
    _lineitem(spark, 20_000).write.parquet(f"{tmp}/lineitem.parquet")
    spark.sparkContext.setJobGroup("file_layout", "")
    try:
        got = _rows(file_layout(spark, tmp))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == [str(("coalesce", 20_000, True, 5)), str(("repartition", 20_000, True, 10))]
    # The five tasks that merge ten partitions are a stage without a shuffle before it.
    tracker = spark.sparkContext.statusTracker()
    merging = [j for i in tracker.getJobIdsForGroup("file_layout") if (j := tracker.getJobInfo(i))
               and any((s := tracker.getStageInfo(k)) and s.numTasks == 5 for k in j.stageIds)]
    assert merging and all(len(j.stageIds) == 1 for j in merging)


def test_fewer_rows_than_files(spark, tmp):
    _lineitem(spark, 3).write.parquet(f"{tmp}/lineitem.parquet")
    assert _rows(file_layout(spark, tmp)) == [str(("coalesce", 3, True, 5)), str(("repartition", 3, False, 10))]
