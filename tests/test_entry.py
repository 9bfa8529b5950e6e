"""The registered queries: they import without a session, and agree with their SQL on the smallest tables."""

from __future__ import annotations

import glob
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from docledger.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_imports_without_a_session():
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 0)"], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("True"), done.stderr[-500:]


def test_imports_without_the_training_subpackage(tmp_path):
    for name in ("docledger", "__spark_entry__.py"):
        os.symlink(f"{ROOT}/{name}", tmp_path / name) if name.endswith(".py") else subprocess.run(["cp", "-r", f"{ROOT}/{name}", str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "docledger" / "llm")], check=True)
    code = "import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert done.stdout.strip().endswith("True"), done.stdout + done.stderr[-500:]


def _plain(value) -> str:
    if value is None or value != value:
        return "null"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")
@pytest.mark.parametrize("name", ["intake_hash_dedup", "intake_crossbatch", "parse_invoice", "parse_items_desc_first", "validate_fields", "upsert_docs", "upsert_failed", "report_invoices", "nested_json", "free_names_taken", "log_final_status", "process_and_validate", "ocr_paths", "log_window"])
def test_agrees_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    expected = con.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    assert sorted(tuple(map(_plain, r)) for r in got.select(*columns).collect()) == sorted(tuple(_plain(r[k]) for k in order) for r in expected.fetchall())
