import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("absent", ["regex", "xxhash", "public_tokenizers", "tablekit.llm", "corpus_pipeline"])
def test_table_queries_need_no_optional_library(absent):
    code = (f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; q = e.queries(); "
            "print(sum(not n.startswith('op') and n != 'pipeline' for n in q), set(e.oracle_sql()) <= set(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    n, known = out.stdout.split()
    assert int(n) >= 115 and known == "True"


def test_nothing_is_left_after_remove_scratch(spark):
    from tablekit.plans import io_queries
    from tablekit.session import ensure_checkpoint_dir, remove_scratch
    from tests.conftest import SF_SMALL
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    remove_scratch(spark)
    before, databases = set(os.listdir(base)), {d.name for d in spark.catalog.listDatabases()}
    for query in (io_queries.json_quarantine, io_queries.warehouse_tables, io_queries.ingest_rerun, io_queries.save_modes):
        assert query(spark, SF_SMALL).count()
    assert set(os.listdir(base)) > before and {d.name for d in spark.catalog.listDatabases()} > databases
    remove_scratch(spark)
    assert set(os.listdir(base)) <= before and {d.name for d in spark.catalog.listDatabases()} == databases


def test_bench_removes_what_queries_leave():
    with open(os.path.join(ROOT, "bench.py")) as f:
        assert "remove_scratch(spark)" in f.read()
