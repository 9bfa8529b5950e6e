"""The store in parts: small merges write little, lookups and windows read little, and figures and keys follow every change."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docledger.operators import merge
from docledger.operators import store as stores
from docledger.operators.store import Store
from docledger.plans import queries as Q

SF = "/root/testdata/sf0.01"


def now():
    return F.lit("2030-01-01 00:00:00").cast("timestamp")


needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the tables")


def scans(frame) -> list[dict]:
    """Of each file scan that ran: what it read, its partition filters, and its counters."""
    out, todo = [], [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "FileSourceScanExec":
            counters = {k: node.metrics().get(k).get().value() for k in ("numFiles", "numPartitions") if node.metrics().get(k).isDefined()}
            out.append(counters | {"filters": node.metadata().get("PartitionFilters").get(), "schema": node.requiredSchema().simpleString()})
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return out


def files_of(root: str, version: str = "") -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and version in d)


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """15,000 documents with their items, in months."""
    root = str(tmp_path_factory.mktemp("large"))
    store = Store(spark, f"file://{root}", period="month", buckets=4)
    documents = Q._invoices(spark, SF)
    rows = Q._as(documents, "invoice_documents")
    items = Q._rows(spark, SF, Q.ITEMS).select(F.col("line").cast("long").alias("line_item_id"), "document_id", "description", "line_total")
    items = items.join(documents.select("document_id", F.trunc("processed_at", "month").alias("period")), "document_id").withColumns({"quantity": F.lit(None).cast("decimal(18,4)"), "unit_price": F.lit(None).cast("decimal(10,2)")})
    store.put_documents("first", rows.where(F.lit(False)), rows, set(), {"invoice_line_items": items})
    return store, root


@needs_tables
def test_a_small_merge_writes_little(spark, large):
    store, root = large
    before = files_of(root)
    new = store.table("invoice_documents").where("document_id % 1500 = 7").drop("document_id", "processed_at").withColumn("invoice_number", F.lit("again"))
    assert new.count() == 10
    parts = store.merged(new, None, now())
    assert 0 < len(parts[2]) <= 10
    assert store.put_documents("second", *parts)
    version = [v for v, _ in store.live("invoice_documents") if v.startswith("00000002")][0]
    assert 0 < files_of(root, f"v={version}") < 0.05 * before
    assert store.table("invoice_documents").count() == 15000 and store.table("invoice_documents").where("invoice_number = 'again'").count() == 10


@needs_tables
def test_lookups_read_the_parts_of_their_digits(spark, large):
    store, _ = large
    wanted = spark.createDataFrame([("file_77.pdf", None), ("no such file", None)], "file_name string, file_hash string")
    found = store.candidates(wanted)
    assert [(r.document_id, r.file_name) for r in found.collect()] == [(77, "file_77.pdf")]
    (scan,) = [s for s in scans(found) if "key" in s["schema"]]
    parts = len({p for _, p in store.live("document_keys")})
    assert "dynamicpruning" in scan["filters"] and scan["numPartitions"] <= 4 < parts / 10


@needs_tables
def test_windows_read_their_months(spark, large):
    store, _ = large
    since, until = F.lit("1995-03-10").cast("timestamp"), F.lit("1995-04-02 12:00:00").cast("timestamp")
    documents = store.window("invoice_documents", since, until)
    expected = Q._invoices(spark, SF).where("processed_at between timestamp'1995-03-10' and timestamp'1995-04-02 12:00:00'")
    assert sorted(r.document_id for r in documents.collect()) == sorted(r.document_id for r in expected.collect())
    (scan,) = scans(documents)
    months = {p.split("/")[0] for _, p in store.live("invoice_documents")}
    assert "period" in scan["filters"] and scan["numPartitions"] <= 2 * (4 + 1) < len(months) / 4
    items = store.window_items(since, until)
    lines = Q._rows(spark, SF, Q.ITEMS).join(expected.select("document_id"), "document_id", "left_semi").count()
    assert len(items.collect()) == lines and all("period" in s["filters"] and s["numPartitions"] <= 10 for s in scans(items))


def _documents(spark, rows):
    return Q._as(spark.createDataFrame(rows, "document_id long, file_name string, file_hash string, status string, total_amount string, currency string, processed_at string"), "invoice_documents")


def test_keys_and_figures_follow_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "FOLDERS", 3)
    store = Store(spark, f"file://{tmp_path}/s", period="day", buckets=2, digits=1)
    first = _documents(spark, [(1, "a", "h1", "success", "5.00", "USD", "2024-01-01 10:00:00"), (2, "b", "h2", "failed", None, None, "2024-01-02 10:00:00"), (3, "c", None, "success", "7.50", None, None)])
    assert store.put_documents("one", first.where("1 = 0"), first, set()) and not store.put_documents("one", first.where("1 = 0"), first, set())

    def ids(name=None, hash_=None):
        return {r.document_id for r in store.candidates(spark.createDataFrame([(name, hash_)], "file_name string, file_hash string")).collect()}

    def agrees():
        key = lambda r: tuple(map(str, r))
        all_ = store.table("invoice_documents").groupBy(stores.day_of(F.col("processed_at")).alias("day"), "status", "currency").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("total_amount", F.lit(0))).cast("decimal(38,2)").alias("t"))
        assert sorted(map(key, store.cells().collect())) == sorted(map(key, all_.collect()))

    assert ids("a") == ids(None, "h1") == {1} and ids("c") == {3} and ids("x", "h2") == {2} and ids("", "") == set()
    agrees()
    # A failure changes the hash; a success pays more; both come again and again.
    for k in range(2):
        failed = spark.createDataFrame([("a", f"g{k}", "failed", "broken")], "file_name string, file_hash string, status string, failure_reason string")
        good = spark.createDataFrame([("b", "h2", "success", f"{k}.25", "EUR"), (f"new{k}", f"n{k}", "success", "1.00", "EUR")], "file_name string, file_hash string, status string, total_amount string, currency string").withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
        assert store.put_documents(f"more{k}", *store.merged(good, failed, now()))
        assert ids(None, "h1") == set() and ids(None, f"g{k}") == {1} and (k == 0 or ids(None, f"g{k - 1}") == set()) and ids(f"new{k}") == {4 + k}
        assert {r.status for r in store.candidates(spark.createDataFrame([("a", None)], "file_name string, file_hash string")).collect()} == {"failed"}
        agrees()
    again = Store(spark, f"file://{tmp_path}/s")
    assert (again.period, again.buckets, again.digits) == ("day", 2, 1) and again.top("invoice_documents") == 5 and again.table("invoice_documents").count() == 5
    assert len(store.live("document_cells")) <= 3
    # Figures of a day and a state equal those of a look at documents.
    assert store.cells().where("day = '2030-01-01'").select("n", "total_amount").collect()[0] == (2, Decimal("2.00"))


def test_nothing_wanted_and_empty_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    none = spark.createDataFrame([], "file_name string, file_hash string")
    assert store.candidates(none).collect() == [] and store.table("invoice_documents").collect() == [] and store.cells().collect() == []
    assert store.window("invoice_documents", now(), now()).collect() == [] and store.merged(none.withColumn("status", F.lit("success")), None, now())[1].collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the small tables")
@pytest.mark.parametrize("name", ["merge_parts", "key_probe", "window_parts", "kept_figures", "migrate_store", "daily_batch", "key_audit"])
def test_agrees_with_sql(spark, name):
    from .test_entry import test_agrees_with_sql as check

    check(spark, name)


def test_matches_of_a_part_are_those_of_the_whole(spark):
    stored = _documents(spark, [(k, f"f{k}", f"h{k}", "success", "1.00", "USD", "2024-01-01") for k in range(20)])
    new = spark.createDataFrame([("f3", "h9"), ("x", "h5"), ("y", None)], "file_name string, file_hash string")
    part = stored.where("document_id in (3, 5, 9)")
    assert sorted(merge.matches(stored, new).collect()) == sorted(merge.matches(part, new).collect())


def test_an_empty_part_is_known_to_be_empty(spark, tmp_path):
    """Joins with a table that has no folders go before anything runs; keys do not repeat the name or hash they are."""
    store = Store(spark, f"file://{tmp_path}/s", period="year", buckets=1)
    asked = spark.range(5).select(F.concat(F.lit("f"), "id").alias("file_name"), F.concat(F.lit("h"), "id").alias("file_hash"))
    plan = asked.join(store.candidates(asked), ["file_name"], "left")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    rows = Q._as(asked.withColumns({"document_id": F.substring("file_name", 2, 1).cast("long"), "status": F.lit("success")}), "invoice_documents")
    store.put_documents("one", rows.where(F.lit(False)), rows, set())
    keys = store.table("document_keys")
    assert keys.where("kind = 'name' and file_name is not null or kind = 'hash' and file_hash is not null").count() == 0 < keys.count()
    wanted = asked.where("file_name = 'f1'").select("file_name", F.lit("h3").alias("file_hash"))
    assert sorted((r.document_id, r.file_name, r.file_hash) for r in store.candidates(wanted).collect()) == [(1, "f1", "h1"), (3, "f3", "h3")]


def test_hashes_are_packed_on_their_way_and_come_back(spark):
    values = [None, "", "h1", "é", "a" * 32, "0f" * 32, "0F" * 32, "0f" * 32 + "\n", "\1" + "0f" * 32, "0f" * 31]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, file_hash string")
    got = merge.carried(rows, lambda packed: packed.withColumn("size", F.length("file_hash")).repartition(3)).orderBy("k").collect()
    assert [r.file_hash for r in got] == values and got[5]["size"] == 33
    packed = rows.select(merge.packed(F.col("file_hash")).alias("p")).where("p is not null")
    assert packed.distinct().count() == len(values) - 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the small tables")
def test_a_batch_shuffles_few_bytes_of_a_file(spark):
    """Joins by shuffles, as they are of large tables: hashes go as bytes, what nothing meets stays, and no step is taken twice."""
    sf, kept = "/root/testdata/sf0.001", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def shuffled() -> int:
        executors = spark._jsc.sc().statusStore().executorList(True)
        return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled()
        Q.daily_batch(spark, sf)
        n = Q._rows(spark, sf, "SELECT * FROM {orders}").count()
        assert (shuffled() - before) / n < 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
