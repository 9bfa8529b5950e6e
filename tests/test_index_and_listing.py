"""Search by postings, deep pages, folders as a source, files in chunks, names in any case."""

from __future__ import annotations

import hashlib
import os
import re
import subprocess

import pytest
from pyspark.sql import functions as F

from docledger.operators import dashboard, intake, merge, pages, search
from docledger.operators.store import Store
from docledger.plans import batch
from docledger.plans import queries as Q
from docledger.sources.files import examined, list_files
from docledger.sources.listing import contents, digests, listing

from .test_batch import Plain, invoice
from .test_store import _documents, now, scans

SF = "/root/testdata/sf0.001"


def _named(spark, rows):
    frame = spark.createDataFrame(rows, "document_id long, invoice_number string, vendor_name string, processed_at string")
    return Q._as(frame.withColumns({"file_name": F.concat(F.lit("f"), F.col("document_id").cast("string")), "status": F.lit("success")}), "invoice_documents")


def test_trigrams(spark):
    rows = spark.createDataFrame([("ABCabc",), ("ab",), ("",), (None,), ("aaaa",), ("ÄÖü",)], "x string").select("x", search.trigrams(F.col("x")).alias("t"))
    assert {r.x: sorted(r.t or []) for r in rows.collect()} == {"ABCabc": ["abc", "bca", "cab"], "ab": [], "": [], None: [], "aaaa": ["aaa"], "ÄÖü": ["äöü"]}


def test_search_equals_a_scan(spark, tmp_path):
    rows = [(k, f"INV-{k}", f"Vendor {k % 7} é{k * 37 % 11}", f"2024-{k % 3 + 1:02d}-01 10:00:00" if k % 5 else None) for k in range(300)]
    rows += [(900, None, "O'Neil %_ \\ (x)", "2024-01-01 00:00:00"), (901, "ab", None, None), (902, None, None, None)]
    store = Store(spark, f"file://{tmp_path}/s", period="month", buckets=4)
    documents = _named(spark, rows)
    store.put_documents("one", documents.where("1 = 0"), documents, set())
    # A later merge gives some documents another number; the old number finds them no more.
    new = documents.where("document_id in (17, 18)").drop("document_id", "processed_at").withColumn("invoice_number", F.lit("Changed-1"))
    store.put_documents("two", *store.merged(new, None, now()))
    for term in ("INV-17", "VENDOR 3 é", "changed", "nothing", "", "%_", "\\ (x", "inv-17x"):
        expected = {r.document_id for r in dashboard.search(store.table("invoice_documents"), term).collect()}
        assert {r.document_id for r in store.search(term).collect()} == expected, term
    found = store.search("INV-299")
    assert [r.document_id for r in found.collect()] == [299]
    (scan,) = [s for s in scans(found) if "vendor_name" in s["schema"]]
    assert "dynamicpruning" in scan["filters"] and scan["numPartitions"] == 1


def test_pages(spark, tmp_path):
    order = (F.desc_nulls_last("processed_at"), F.col("document_id"))
    rows = _named(spark, [(k, f"n{k}", "v", f"2024-01-{k % 9 + 1:02d} 00:00:00" if k % 10 else None) for k in range(503)]).select("document_id", "processed_at")
    folder = f"file://{tmp_path}/p"
    pages.write_pages(rows.repartition(5), folder, *order, range_rows=40)
    every = [r.document_id for r in rows.orderBy(*order).collect()]
    for number, size in ((1, 10), (2, 10), (5, 10), (50, 10), (51, 10), (52, 10), (1, 100), (6, 100), (1, 1000)):
        got = pages.read_page(spark, folder, number, *order, size=size)
        assert [r.document_id for r in got.collect()] == every[(number - 1) * size : number * size], number
    last = pages.read_page(spark, folder, 0, *order)
    assert [r.document_id for r in last.collect()] == every[500:]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and not re.search(r"(?<!TakeOrdered)\bSort \[", plan)
    assert all("range" in s["filters"] and s["numPartitions"] <= 2 for s in scans(last))
    pages.write_pages(rows.limit(0), f"{folder}0", *order)
    assert pages.read_page(spark, f"{folder}0", 1, *order).collect() == []


def test_pages_of_few_rows_take_few_tasks(spark, tmp_path):
    """Ranges are tasks and folders; how finely a page is read adds none of them."""
    rows = spark.range(503).select(F.col("id").alias("document_id"))
    for name, task_rows, n in (("one", pages.TASK_ROWS, 1), ("many", 100, 6)):
        pages.write_pages(rows.repartition(3), f"file://{tmp_path}/{name}", "document_id", range_rows=5, task_rows=task_rows)
        assert len([d for d in os.listdir(tmp_path / name / "rows") if d.startswith("range=")]) == n
        for number, size in ((1, 10), (9, 10), (10, 10), (11, 10), (51, 10), (52, 10), (2, 150), (1, 1000)):
            got = pages.read_page(spark, f"file://{tmp_path}/{name}", number, "document_id", size=size).collect()
            assert [r.document_id for r in got] == list(range(503))[(number - 1) * size : number * size], (name, number)


def test_search_lists_a_common_trigram_in_few_rows(spark, tmp_path):
    """A row of the index is a list of documents, not one; ids of every size come back."""
    ids = [*range(2000), -5, (1 << 31) - 1, 1 << 31, (1 << 40) + 7]
    store = Store(spark, f"file://{tmp_path}/s", period="year", buckets=1)
    documents = _named(spark, [(k, f"INV-{k}", "Same vendor", "2024-01-01 10:00:00") for k in ids]).coalesce(1)
    store.put_documents("one", documents.where("1 = 0"), documents, set())
    assert store.table("document_trigrams").where("trigram = 'ven'").count() < 20
    for term in ("vendor", "inv--5", "2147483648", "1099511627783", "inv-12"):
        expected = {r.document_id for r in dashboard.search(store.table("invoice_documents"), term).collect()}
        assert expected and {r.document_id for r in store.search(term).collect()} == expected, term


def test_listing_of_many_files(spark, tmp_path):
    """20,000 files at four depths; the driver makes partitions of folders only."""
    root = tmp_path / "many"
    made = 0
    for a in range(4):
        for b in range(5):
            d = root / f"a{a}" / f"b {b}" / "c+%20é"
            d.mkdir(parents=True)
            for at in (root / f"a{a}", d.parent, d):
                for k in range(333):
                    open(at / f"f{b}-{k}.pdf", "wb").close()
    (root / "top file.pdf").write_bytes(b"12345")
    made = sum(len(f) for _, _, f in os.walk(root))
    assert made > 15000
    (root / "deep" / "er" / "and" / "deeper").mkdir(parents=True)
    for k in range(20001 - made):
        open(root / "deep" / "er" / "and" / "deeper" / f"{k}", "wb").close()
    rows = listing(spark, f"file://{root}")
    assert rows.rdd.getNumPartitions() == 1 + 5 + 21
    expected = {"file:" + os.path.join(d, f) for d, _, names in os.walk(root) for f in names}
    got = rows.collect()
    assert len(got) == len(expected) == 20001 and {r.path for r in got} == expected
    (top,) = [r for r in got if r.file_name == "top file.pdf"]
    assert top.length == 5 and top.modified is not None and {r.length for r in got} == {0, 5}
    assert listing(spark, str(root), depth=0).count() == 20001
    assert listing(spark, f"{tmp_path}/absent").count() == 0


def _peak_mb(pids) -> int:
    out = 0
    for pid in pids:
        try:
            text = open(f"/proc/{pid}/status").read()
        except OSError:
            continue
        out = max(out, *(int(m) // 1024 for m in re.findall(r"VmHWM:\s+(\d+)", text)), 0)
    return out


def _workers() -> list[int]:
    out = subprocess.run(["ps", "-eo", "pid,ppid,args"], capture_output=True, text=True).stdout
    children: dict[int, list[tuple[int, str]]] = {}
    for line in out.splitlines()[1:]:
        pid, parent, args = line.split(None, 2)
        children.setdefault(int(parent), []).append((int(pid), args))
    found, todo = [], [os.getpid()]
    while todo:
        for pid, args in children.get(todo.pop(), []):
            todo.append(pid)
            if "pyspark.daemon" in args or "pyspark/daemon" in args:
                found.append(pid)
    return found


def test_large_files_are_hashed_in_chunks(spark, tmp_path):
    size = 3 << 30
    with open(tmp_path / "large.pdf", "wb") as f:
        f.write(b"%PDF-1.4")
        f.truncate(size)
    (tmp_path / "small.pdf").write_bytes(b"%PDF-" + b"x" * 100)
    (tmp_path / "empty.pdf").write_bytes(b"")
    rows = {r.file_name: r for r in examined(list_files(spark, str(tmp_path), with_content=False)).collect()}
    expected, zeros = hashlib.sha256(b"%PDF-1.4" + bytes((1 << 20) - 8)), bytes(1 << 20)
    for _ in range(size // (1 << 20) - 1):
        expected.update(zeros)
    assert rows["large.pdf"].file_hash == expected.hexdigest() and rows["large.pdf"].invalid_reason is None
    assert rows["small.pdf"].file_hash == hashlib.sha256(b"%PDF-" + b"x" * 100).hexdigest()
    assert rows["empty.pdf"].file_hash is None and rows["empty.pdf"].invalid_reason == "File is empty"
    assert 0 < _peak_mb(_workers()) < 300
    # Contents of that size are no rows.
    assert {r.file_name: r.content is None for r in contents(listing(spark, str(tmp_path))).collect()} == {"large.pdf": True, "small.pdf": False, "empty.pdf": False}


def test_both_ways_of_examining_agree(spark, tmp_path):
    for name, data in {"a.png": invoice(1), "b.png": b"broken", "c.pdf": b"%PDF-1", "d.pdf": b"no", "e.png": b"", "f.txt": b"x", ".gitkeep": b"", "g.PNG": invoice(2)[:-5]}.items():
        (tmp_path / name).write_bytes(data)
    ways = [sorted(map(tuple, examined(list_files(spark, str(tmp_path), with_content=w)).collect())) for w in (True, False)]
    assert ways[0] == ways[1] and len(ways[0]) == 7
    gone = spark.createDataFrame([(f"file:{tmp_path}/absent.png", "absent.png", 5)], "path string, file_name string, length long")
    assert digests(gone).collect()[0].file_hash is None and contents(gone).collect()[0].content is None


def test_batch_without_contents(spark, tmp_path):
    d = tmp_path / "in" / "sub"
    d.mkdir(parents=True)
    (d / "a.png").write_bytes(invoice(1))
    (d / "b.png").write_bytes(invoice(1))
    store = Store(spark, f"file://{tmp_path}/store")
    assert batch.run(list_files(spark, str(tmp_path / "in"), with_content=False), store, "one", backend=Plain())
    assert [(r.file_name, r.status, r.invoice_number) for r in store.table("invoice_documents").collect()] == [("a.png", "success", "INV-1")]
    assert store.table("duplicate_files").count() == 1 and not (tmp_path / "store" / "_work" / "one").exists()


def test_names_in_any_case(spark, tmp_path):
    documents = _documents(spark, [(1, "a.pdf", "h1", "success", "1.00", "USD", "2024-01-01"), (2, "Ä.pdf", "h2", "success", "1.00", "USD", "2024-01-01")])
    new = spark.createDataFrame([("A.PDF", "n1", "success"), ("ä.PDF", "n2", "success"), ("New.pdf", "n3", "success"), ("NEW.pdf", "n4", "success")], "file_name string, file_hash string, status string")
    for any_case, names in ((True, ["NEW.pdf", "a.pdf", "Ä.pdf"]), (False, ["A.PDF", "NEW.pdf", "New.pdf", "a.pdf", "Ä.pdf", "ä.PDF"])):
        store = Store(spark, f"file://{tmp_path}/s{any_case}", any_case=any_case)
        store.put_documents("one", documents.where("1 = 0"), documents, set())
        before, after, touched = store.merged(new, None, now())
        assert sorted(r.file_name for r in after.collect()) == sorted(names if touched else [n for n in names if n not in ("a.pdf", "Ä.pdf")])
        assert bool(touched) == any_case
    files = spark.createDataFrame([("p1", "A.pdf", "0123456789", None)], "path string, file_name string, file_hash string, invalid_reason string")
    assert [intake.decide(files, documents, c).collect()[0].target_name for c in (None, merge.ANY_CASE)] == ["A.pdf", "A_01234567.pdf"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")
@pytest.mark.parametrize("name", ["search_indexed", "deep_pages", "upsert_any_case"])
def test_agrees_with_sql(spark, name):
    from .test_entry import test_agrees_with_sql as check

    check(spark, name)
