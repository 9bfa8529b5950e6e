"""The batch over real folders: invariants of intake, merges, reports and exports."""

from __future__ import annotations

import json
import re
import struct
import sys
import zipfile
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from docledger.operators import dashboard, intake, merge, report
from docledger.operators import store as stores
from docledger.plans import batch
from docledger.sources import extractors, images, sinks
from docledger.sources.config import Config
from docledger.sources.files import examined, list_files
from docledger.sources.ocr import recognise
from docledger.sources.tables import broken_keys, missing_columns, query, sample_invoices
from docledger.streaming.ingest import file_stream, ingest, log_rates

# Workers cannot import this module, so what it defines is sent whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Plain:
    """Takes what an image says about itself as its text."""

    def pages(self, content, extension):
        at = content.index(b"tEXt") + 4
        (size,) = struct.unpack(">I", content[at - 8 : at - 4])
        return [content[at : at + size].split(b"\0", 1)[1].decode()]

    def read(self, page):
        return page


def png(text: bytes) -> bytes:
    """A small image that carries a text."""
    plain, body = images.write_png(np.zeros((2, 2), np.uint8)), b"Text\0" + text
    chunk = struct.pack(">I", len(body)) + b"tEXt" + body + struct.pack(">I", zlib.crc32(b"tEXt" + body))
    return plain[:33] + chunk + plain[33:]


def invoice(number: int, total: str = "10.00") -> bytes:
    return png(f"From: Acme {number}\nInvoice No: INV-{number}\nDate: 2024-01-15\n2   Widget   $5.00   ${total}\nTotal: ${total}".encode())


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "input"
    (d / "sub").mkdir(parents=True)
    (d / "a.png").write_bytes(invoice(1))
    (d / "b.png").write_bytes(invoice(1))
    (d / "sub" / "c.png").write_bytes(invoice(2, "20.00"))
    (d / "broken.png").write_bytes(b"not a real image at all")
    (d / "empty one.png").write_bytes(b"")
    (d / "empty.txt").write_bytes(b"")
    (d / ".gitkeep").write_bytes(b"")
    return d


def _store(spark, tmp_path):
    store = stores.Store(spark, f"file://{tmp_path}/store")
    store.migrate()
    return store


def test_listing_has_empty_files(spark, folder):
    rows = {r.file_name: r for r in examined(list_files(spark, str(folder))).collect()}
    assert set(rows) == {"a.png", "b.png", "c.png", "broken.png", "empty one.png", "empty.txt"}
    assert rows["empty one.png"].file_hash is None and rows["empty one.png"].invalid_reason == "File is empty"
    assert "Unsupported" in rows["empty.txt"].invalid_reason
    assert "readable image" in rows["broken.png"].invalid_reason and len(rows["broken.png"].file_hash) == 64
    assert rows["a.png"].invalid_reason is None and rows["a.png"].file_hash == rows["b.png"].file_hash


def test_batch_and_rerun(spark, folder, tmp_path):
    store = _store(spark, tmp_path)
    files = list_files(spark, str(folder))
    assert batch.run(files, store, "one", backend=Plain())
    assert not batch.run(files, store, "one", backend=Plain())
    docs = {r.file_name: r for r in store.table("invoice_documents").collect()}
    assert {n: r.status for n, r in docs.items()} == {"a.png": "success", "c.png": "success", "broken.png": "failed", "empty one.png": "failed", "empty.txt": "failed"}
    assert docs["c.png"].invoice_number == "INV-2" and docs["broken.png"].file_hash and docs["empty one.png"].file_hash is None
    assert len({r.document_id for r in docs.values()}) == 5
    dup = store.table("duplicate_files").collect()
    assert [(d.file_name, d.original_file) for d in dup] == [("b.png", "a.png")]
    logs = {r.file_name: r for r in store.table("processing_logs").collect()}
    assert len(logs) == 6 and {n: r.status for n, r in logs.items()} == {"a.png": "success", "b.png": "duplicate_skipped", "c.png": "success", "broken.png": "failed", "empty one.png": "failed", "empty.txt": "failed"}
    assert all(r.start_time <= r.end_time for r in logs.values())
    paths = {r.ocr_text_path: r for r in store.table("ocr_texts").collect()}
    assert docs["c.png"].ocr_text_path in paths and "INV-2" in paths[docs["c.png"].ocr_text_path].text
    assert re.fullmatch(r"ocr_output/c_\d{8}_\d{6}\.txt", docs["c.png"].ocr_text_path) and docs["broken.png"].ocr_text_path is None
    tables = {n: store.table(n) for n in ("invoice_documents", "invoice_line_items", "processing_logs", "duplicate_files", "ocr_texts")}
    assert broken_keys(tables) == {} and broken_keys({**tables, "invoice_documents": tables["invoice_documents"].where("file_name <> 'c.png'")}) == {"invoice_line_items.document_id": 1}
    assert merge.orphans(store.table("invoice_line_items"), store.table("invoice_documents")).isEmpty()
    # The same files again are duplicates of what is stored; failed ones are tried again.
    assert batch.run(files, store, "two", backend=Plain())
    assert store.table("duplicate_files").count() == 4 and store.table("invoice_documents").count() == 5


def test_retry_after_failure(spark, tmp_path):
    store, d = _store(spark, tmp_path), tmp_path / "in"
    d.mkdir()
    (d / "x.png").write_bytes(b"broken")
    batch.run(list_files(spark, str(d)), store, "1", backend=Plain())
    (d / "x.png").write_bytes(invoice(7))
    batch.run(list_files(spark, str(d)), store, "2", backend=Plain())
    (row,) = store.table("invoice_documents").collect()
    assert row.status == "success" and row.failure_reason is None and row.invoice_number == "INV-7"


def test_name_taken_is_renamed(spark, tmp_path):
    store, d = _store(spark, tmp_path), tmp_path / "in"
    d.mkdir()
    (d / "x.png").write_bytes(invoice(1))
    batch.run(list_files(spark, str(d)), store, "1", backend=Plain())
    (d / "x.png").write_bytes(invoice(2))
    batch.run(list_files(spark, str(d)), store, "2", backend=Plain())
    names = sorted(r.file_name for r in store.table("invoice_documents").collect())
    assert len(names) == 2 and "x.png" in names and names[1].startswith("x_") and len(names[1]) == len("x_12345678.png")


def test_exports(spark, folder, tmp_path):
    store = _store(spark, tmp_path)
    batch.run(list_files(spark, str(folder)), store, "one", backend=Plain())
    docs, items = store.table("invoice_documents"), store.table("invoice_line_items")
    r = report.report(docs, items, store.table("processing_logs"), store.table("duplicate_files"), F.lit("2000-01-01").cast("timestamp"), F.lit("2100-01-01").cast("timestamp"))
    assert r.counters.head().asDict() == {"total": 6, "success": 2, "needs_review": 0, "failed": 3, "duplicates": 1, "adds_up": True}
    page = report.to_html(r, "2000-01-01", "2100-01-01", mock=True)
    assert "2000-01-01 to 2100-01-01, made with the mock extractor" in page and "<td>6</td><td>2</td>" in page and "<td>all</td><td>5</td><td>30.00</td>" in page
    assert "<td>success</td><td>USD</td><td>2</td><td>30.00</td>" in page and "<td>b.png</td><td>a.png</td>" in page and "File is not a readable image" in page
    sinks.report_workbook(r, str(tmp_path / "r.xlsx"))
    with zipfile.ZipFile(tmp_path / "r.xlsx") as z:
        assert b"INV-2" in z.read("xl/worksheets/sheet1.xml") and z.testzip() is None
    sinks.write_dashboard(docs, items, f"file://{tmp_path}/dash")
    whole = json.loads("".join(p.read_text() for p in (tmp_path / "dash").glob("part-*")))
    assert len(whole["documents"]) == 5 and any(x["line_items"] for x in whole["documents"])
    sinks.write_json(docs, items, f"file://{tmp_path}/json")
    lines = [json.loads(x) for p in (tmp_path / "json").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(x["name"] for x in lines) == [f"invoice_{k:03d}" for k in range(1, 6)]
    assert sinks.write_json_files(docs, items, f"file://{tmp_path}/files") == 5
    assert json.loads((tmp_path / "files" / "invoice_001.json").read_text())["document_id"] == 1
    at = [x["processed_at"] for x in whole["documents"]]
    assert at == sorted(at, reverse=True)


class Blind(Plain):
    """Reads nothing in some files."""

    def read(self, page):
        return "" if "INV-2" in page else page


def test_logs_tell_what_became_of_a_file(spark, folder, tmp_path):
    store = _store(spark, tmp_path)
    assert batch.run(list_files(spark, str(folder)), store, "one", backend=Blind(), processed_dir=f"{tmp_path}/done", failed_dir=f"{tmp_path}/bad")
    logs = {r.file_name: (r.status, r.error_message) for r in store.table("processing_logs").collect()}
    assert logs["a.png"] == ("success", None) and logs["c.png"] == ("failed", "no text was found")
    docs = {r.file_name: r.status for r in store.table("invoice_documents").collect()}
    assert docs["c.png"] == "failed"
    # Files move by what became of them; duplicates and files that are no part of the batch stay.
    assert {p.name for p in (tmp_path / "done").iterdir()} == {"a.png"}
    assert {p.name for p in (tmp_path / "bad").iterdir()} == {"c.png", "broken.png", "empty one.png", "empty.txt"}
    assert {p.name for p in folder.iterdir()} == {"b.png", "sub", ".gitkeep"}
    assert not batch.run(list_files(spark, str(folder)), store, "one", backend=Blind(), processed_dir=f"{tmp_path}/done")


def test_moved_files_get_free_names(spark, tmp_path):
    (tmp_path / "in" / "x").mkdir(parents=True)
    (tmp_path / "to").mkdir()
    for p in ("in/f.a", "in/x/f.a", "in/f_1.a", "to/f.a", "to/f_2.a"):
        (tmp_path / p).write_text(p)
    rows = spark.createDataFrame([(f"file://{tmp_path}/{p}",) for p in ("in/f.a", "in/x/f.a", "in/f_1.a", "in/gone.a")], "path string")
    assert sinks.move_files(rows, f"file://{tmp_path}/to") == 3
    assert {p.name: p.read_text() for p in (tmp_path / "to").iterdir()} == {"f.a": "to/f.a", "f_2.a": "to/f_2.a", "f_1.a": "in/f_1.a", "f_3.a": "in/f.a", "f_4.a": "in/x/f.a"}
    assert sinks.move_files(rows, f"file://{tmp_path}/to") == 0


def test_added_rows_stay_in_folders_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "FOLDERS", 3)
    store = _store(spark, tmp_path)
    for k in range(5):
        rows = spark.createDataFrame([(f"p{k}", f"f{k}", "t")], "ocr_text_path string, file_name string, text string")
        assert store.commit(f"b{k}", add={"ocr_texts": rows}) and not store.commit(f"b{k}", add={"ocr_texts": rows})
        assert {r.file_name for r in store.table("ocr_texts").collect()} == {f"f{j}" for j in range(k + 1)}
        assert len(store.live("ocr_texts")) <= 2


def test_process_and_validate(spark):
    text = "From: Acme\nInvoice No: INV-1\nDate: 2024-01-15\nTotal: $5.00"
    rows = spark.createDataFrame([("a.png", "h", text), ("b.png", "h", "Total: 3.00"), ("c.png", None, text)], "file_name string, file_hash string, text string")
    got = {r.file_name: r for r in batch.process_and_validate(rows).collect()}
    assert got["a.png"].is_valid and got["a.png"].record.total_amount == 5.0 and got["a.png"].status == "needs_review"
    assert got["b.png"].error == "invoice_number, invoice_date" and got["b.png"].record.total_amount == 3.0 and got["b.png"].record.status == "needs_review"
    assert got["c.png"].error == "file_hash"


def test_empty_window(spark):
    docs = spark.createDataFrame([], "document_id long, status string, total_amount decimal(10,2), processed_at timestamp")
    dups = spark.createDataFrame([], "duplicate_id long, skipped_at timestamp")
    assert report.counters(docs, dups).head().asDict() == {"total": 0, "success": 0, "needs_review": 0, "failed": 0, "duplicates": 0, "adds_up": True}
    assert report.invoiced_amount(docs).head()[0] == 0
    assert dashboard.page_count(docs).head()[0] == 1


def test_stream(spark, folder, tmp_path):
    store = _store(spark, tmp_path)
    for _ in range(2):
        ingest(file_stream(spark, f"file://{folder}", 2), store, f"{tmp_path}/cp", backend=Plain()).awaitTermination()
    rows = {r.file_name: r.status for r in store.table("invoice_documents").collect()}
    assert sum(s == "success" for s in rows.values()) == 2 and rows["broken.png"] == "failed"
    assert store.table("duplicate_files").count() == 1


def test_log_rates(spark):
    logs = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:10:00", "b")], "ts string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted((r.event_type, r.n) for r in log_rates(logs).collect()) == [("a", 2), ("b", 1)]


def test_mock_and_client(spark):
    rows = spark.range(100).withColumn("m", extractors.mock(F.col("id"))).groupBy("m.confidence", "m.vendor_name").count().collect()
    assert {(r.confidence, r.vendor_name): r["count"] for r in rows} == {("high", "Mock Stationery"): 90, ("low", "Mock Stationery"): 5, ("low", "Mock Fail"): 5}
    texts = spark.createDataFrame([("f", "good"), ("g", "bad")], "file_name string, text string")
    got = {r.file_name: r for r in extractors.extract(texts, lambda _, t: '{"invoice_number": "N1", "total_amount": 3}' if t == "good" else "no json").collect()}
    assert got["f"].parsed.invoice_number == "N1" and got["g"].parsed is None and got["g"].error


def test_small_parts(spark, tmp_path):
    assert Config.from_mapping({"SMTP_PORT": "25", "MOCK_EXTRACTOR": "true"}) == Config(smtp_port=25, mock_extractor=True)
    assert recognise(Plain(), b"", ".png")[0] is False
    assert sample_invoices(spark, 3).count() == 3
    assert missing_columns({})["schema_version"] == {"version", "applied_at"}
    assert query(spark, "SELECT count(*) AS n FROM {t} WHERE id >= :lo", {"lo": 3}, t=spark.range(5)).head().n == 2
    (tmp_path / "f.txt").write_text("x")
    (tmp_path / "to").mkdir()
    (tmp_path / "to" / "f.txt").write_text("y")
    assert sinks.move_file(str(tmp_path / "f.txt"), str(tmp_path / "to")).endswith("f_1.txt")
    names = spark.createDataFrame([("p1", "a.x"), ("p2", "a.x")], "path string, file_name string")
    assert sorted(r.free_name for r in intake.free_names(names).collect()) == ["a.x", "a_1.x"]
    names = spark.createDataFrame([("p1", "b.x"), ("p2", "b.x"), ("p3", "b_1.x"), ("p4", "a.x"), ("p5", "b_1.x")], "path string, file_name string")
    taken = spark.createDataFrame([("a.x",), ("a_1.x",), ("a_01.x",)], "file_name string")
    assert {r.path: r.free_name for r in intake.free_names(names, taken).collect()} == {"p1": "b.x", "p2": "b_2.x", "p3": "b_1.x", "p4": "a_2.x", "p5": "b_1_1.x"}


def test_mail(tmp_path):
    sent = []

    class Server:
        def __init__(self, *a):
            pass

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def starttls(self):
            sent.append("tls")

        def login(self, *a):
            sent.append("login")

        def send_message(self, m):
            sent.append(m["Subject"])

    book = tmp_path / "b.xlsx"
    book.write_bytes(b"x")
    config = Config(smtp_host="h", smtp_user="u", mail_from="a@b", mail_to="c@d")
    assert sinks.Mailer(config, smtp=Server).send("S", "<p/>", str(book), str(tmp_path / "f.html")) and sent == ["tls", "login", "S"]
    assert not sinks.Mailer(config, dry_run=True, smtp=Server).send("S", "", str(book), "")

    class Down(Server):
        def send_message(self, m):
            raise OSError

    assert not sinks.Mailer(config, smtp=Down).send("S", "<p>x</p>", str(book), str(tmp_path / "f.html"))
    assert (tmp_path / "f.html").read_text() == "<p>x</p>"
