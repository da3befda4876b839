import os

import pytest

from pyspark.sql import functions as F

from tablekit.operators.ingest import audit_ingest, ingest_to, read_csv_dir
from tablekit.streaming.audit_stream import start_audit_stream

SCHEMA = "id long, name string"


def _landing(base, sizes):
    os.makedirs(base, exist_ok=True)
    start = 0
    for i, n in enumerate(sizes):
        with open(f"{base}/f{i}.csv", "w") as f:
            f.write("id,name\n")
            for j in range(n):
                f.write(f"{start + j},n{start + j}\n")
        start += n
    with open(f"{base}/notes.txt", "w") as f:
        f.write("not a csv\n")
    open(f"{base}/empty.csv", "w").close()
    return base


def _check(rows, sizes):
    by_file = {}
    for r in rows:
        by_file.setdefault(os.path.basename(r.source_file), []).append((r.seq_id, r.id))
    assert sorted(by_file) == [f"f{i}.csv" for i, n in enumerate(sizes) if n]
    for name, pairs in by_file.items():
        pairs.sort()
        assert [s for s, _ in pairs] == list(range(1, len(pairs) + 1))
        ids = [i for _, i in pairs]
        assert ids == sorted(ids)  # file order


def test_seq_ids_contiguous_per_file(spark, tmp):
    sizes = [5, 1200, 0, 37]
    src = _landing(f"{tmp}/in", sizes)
    out = audit_ingest(spark, src, schema=SCHEMA, job_id="job-1")
    rows = out.collect()
    assert len(rows) == sum(sizes)
    assert {r.job_id for r in rows} == {"job-1"}
    _check(rows, sizes)


def test_seq_ids_when_files_are_split(spark, tmp):
    sizes = [4000, 2500]
    src = _landing(f"{tmp}/in", sizes)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = audit_ingest(spark, src, schema=SCHEMA)
        assert read_csv_dir(spark, src, schema=SCHEMA).select("__tk_block").distinct().count() > 2
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == sum(sizes)
    _check(rows, sizes)


def test_inferred_schema_and_skip_done(spark, tmp):
    src = _landing(f"{tmp}/in", [3, 4])
    first = audit_ingest(spark, src)
    assert dict(first.dtypes)["id"] == "int"
    done = first.where(F.col("source_file").endswith("f0.csv"))
    again = audit_ingest(spark, src, skip_files=done)
    assert again.count() == 4


def test_streaming_ingest_skips_seen_files(spark, tmp):
    src = _landing(f"{tmp}/in", [3, 250])
    out, ckpt = f"{tmp}/out", f"{tmp}/ckpt"
    q = start_audit_stream(spark, src, out, ckpt, SCHEMA, job_id="run-1")
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 253
    _check(rows, [3, 250])
    # New file arrives; a second run ingests only it.
    with open(f"{src}/late.csv", "w") as f:
        f.write("id,name\n900,a\n901,b\n")
    q = start_audit_stream(spark, src, out, ckpt, SCHEMA, job_id="run-2")
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 255
    late = sorted((r.seq_id, r.job_id) for r in rows if r.source_file.endswith("late.csv"))
    assert late == [(1, "run-2"), (2, "run-2")]


def test_retried_batch_replaces_its_output(spark, tmp):
    from tablekit.streaming.audit_stream import batch_writer
    src = _landing(f"{tmp}/in", [7, 3])
    write = batch_writer(f"{tmp}/out", "job-x")
    batch = read_csv_dir(spark, src, schema=SCHEMA)
    write(batch, 0)
    write(batch, 0)  # a retry of the same micro-batch
    rows = spark.read.parquet(f"{tmp}/out").collect()
    assert len(rows) == 10 and {r.batch_id for r in rows} == {0}
    _check(rows, [7, 3])


def _landing_with_bad_rows(base):
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/m.csv", "w") as f:
        f.write("id,name\n")
        for j in range(3000):
            f.write(f"x{j},bad\n" if j % 7 == 3 else f"{j},n{j}\n")
    return base


@pytest.mark.parametrize("mode", ["PERMISSIVE", "DROPMALFORMED"])
def test_malformed_rows_keep_ids_contiguous(spark, tmp, mode):
    src = _landing_with_bad_rows(f"{tmp}/in")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = audit_ingest(spark, src, schema=SCHEMA, mode=mode).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = 3000 if mode == "PERMISSIVE" else 3000 - len([j for j in range(3000) if j % 7 == 3])
    assert len(rows) == expected
    assert sorted(r.seq_id for r in rows) == list(range(1, expected + 1))


def test_failfast_raises_on_malformed(spark, tmp):
    src = _landing_with_bad_rows(f"{tmp}/in")
    with pytest.raises(Exception):
        audit_ingest(spark, src, schema=SCHEMA, mode="FAILFAST").collect()


class _Conf:
    """Sets session settings for a block."""

    def __init__(self, spark, **conf):
        self.spark, self.conf = spark, {k.replace("__", "."): v for k, v in conf.items()}

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.conf}
        for k, v in self.conf.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def _parallel(spark, n):
    return _Conf(spark, spark__sql__leafNodeDefaultParallelism=n, spark__sql__files__openCostInBytes="2048",
                 spark__sql__files__minPartitionNum=n)


@pytest.mark.parametrize("build,run", [("4", "64"), ("64", "4")])
def test_ids_do_not_depend_on_the_scan_parallelism(spark, tmp, build, run):
    sizes = [30000, 9000, 300]
    src = _landing(f"{tmp}/in", sizes)
    with _parallel(spark, build):
        df = audit_ingest(spark, src, schema=SCHEMA)
    with _parallel(spark, run):
        rows = df.collect()
    assert len(rows) == sum(sizes)
    _check(rows, sizes)


@pytest.mark.parametrize("mode,left", [("PERMISSIVE", 3000), ("DROPMALFORMED", 2571)])
def test_every_projection_sees_the_same_rows(spark, tmp, mode, left):
    src = _landing_with_bad_rows(f"{tmp}/in")
    df = audit_ingest(spark, src, schema=SCHEMA, mode=mode)
    assert df.count() == left
    for columns in (["seq_id"], ["id"], ["name", "seq_id"], df.columns):
        rows = df.select(*columns).collect()
        assert len(rows) == left
        if "seq_id" in columns:
            assert sorted(r.seq_id for r in rows) == list(range(1, left + 1))


def test_staged_rows_are_removed_after_use(spark, tmp):
    from tablekit.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    src = _landing(f"{tmp}/in", [50, 20])
    before = set(os.listdir(base))
    ingest_to(spark, src, f"{tmp}/out", fmt="parquet", schema=SCHEMA)
    q = start_audit_stream(spark, src, f"{tmp}/stream", f"{tmp}/ckpt", SCHEMA)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp}/out").count() == spark.read.parquet(f"{tmp}/stream").count() == 70
    assert {n for n in os.listdir(base) if n.startswith("ingest")} <= before
