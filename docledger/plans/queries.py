"""The registered queries over the driver's tables, and the SQL each must agree with.

The tables hold no invoices, so inputs are rendered from orders, customers and items by SQL that both engines read; the
expected values of the extraction queries follow from how a text was rendered, not from patterns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import basic
from ..functions import extract as X
from ..functions import validate as V
from ..operators import dashboard, intake, merge, pages, report
from ..operators.store import Store
from ..sources.extractors import mock
from ..sources.tables import column_gaps, key_checks, shared_folder
from ..streaming import runs
from . import batch

_AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)"
_ISO = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_KEY = "CAST(o_orderkey AS STRING)"

#: One text for each order. Labels, date shapes, vendors and totals turn with the key.
RENDERED = f"""
SELECT o_orderkey AS doc_key,
  CASE o_orderkey % 3 WHEN 0 THEN 'From: ' || c_name WHEN 1 THEN c_name ELSE 'Vendor: ' || c_name || ',' END || chr(10)
  || CASE o_orderkey % 4 WHEN 0 THEN 'Invoice No: INV-' || {_KEY} WHEN 1 THEN 'Ref # R-' || {_KEY} WHEN 2 THEN 'Bill No B-' || {_KEY} ELSE 'Paper without a label' END || chr(10)
  || CASE o_orderkey % 5
     WHEN 0 THEN 'Date: ' || {_ISO}
     WHEN 1 THEN 'Billing Date: ' || substr({_ISO}, 9, 2) || '/' || substr({_ISO}, 6, 2) || '/' || substr({_ISO}, 1, 4)
     WHEN 2 THEN 'Date: ' || substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(substr({_ISO}, 6, 2) AS INT) - 2, 3) || ' ' || substr({_ISO}, 9, 2) || ', ' || substr({_ISO}, 1, 4)
     WHEN 3 THEN 'Dated ' || substr({_ISO}, 9, 2) || ' ' || substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(substr({_ISO}, 6, 2) AS INT) - 2, 3) || ' ' || substr({_ISO}, 1, 4)
     ELSE 'undated paper' END || chr(10)
  || CASE o_orderkey % 7
     WHEN 0 THEN 'Subtotal: $1.00' || chr(10) || 'Total: $' || {_AMOUNT}
     WHEN 1 THEN 'Grand Total: EUR ' || {_AMOUNT}
     WHEN 2 THEN 'Total Due £' || {_AMOUNT}
     WHEN 3 THEN 'Amount Due: ' || {_AMOUNT} || ' CAD'
     WHEN 4 THEN 'Balance Due ' || {_AMOUNT}
     WHEN 5 THEN 'Total: 7.00' || chr(10) || 'Total Amount INR ' || {_AMOUNT}
     ELSE 'nothing to pay' END AS text,
  c_name, {_ISO} AS iso, CAST(o_totalprice AS DECIMAL(12,2)) AS amount
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""

_NUMBER_SQL = "CASE doc_key % 4 WHEN 0 THEN 'INV-' || CAST(doc_key AS STRING) WHEN 1 THEN 'R-' || CAST(doc_key AS STRING) WHEN 2 THEN 'B-' || CAST(doc_key AS STRING) END"
_DATE_SQL = "CASE doc_key % 5 WHEN 4 THEN NULL WHEN 1 THEN CASE WHEN CAST(substr(iso, 9, 2) AS INT) > 12 THEN iso ELSE substr(iso, 1, 4) || '-' || substr(iso, 9, 2) || '-' || substr(iso, 6, 2) END ELSE iso END"
_TOTAL_SQL = "CASE WHEN doc_key % 7 <> 6 THEN CAST(amount AS DOUBLE) END"
_CURRENCY_SQL = "CASE doc_key % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CAD' WHEN 4 THEN 'USD' WHEN 5 THEN 'INR' END"
_FIELDS_SQL = f"(CASE WHEN {_NUMBER_SQL} IS NULL THEN 0 ELSE 1 END + CASE WHEN {_DATE_SQL} IS NULL THEN 0 ELSE 1 END + 1 + CASE WHEN {_TOTAL_SQL} IS NULL THEN 0 ELSE 1 END)"
_CONFIDENCE_SQL = f"CASE WHEN {_FIELDS_SQL} >= 3 THEN 'high' WHEN {_FIELDS_SQL} = 2 THEN 'medium' ELSE 'low' END"

#: Rows of items as text. Quantities have two digits at most; descriptions are words.
ITEM_TEXT = """
SELECT l_orderkey AS doc_key, l_linenumber AS line, l_partkey AS part, l_quantity AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
  'Part No ' || CAST(l_partkey AS STRING) || 'x' AS description,
  CAST(CAST(l_quantity AS INT) AS STRING) AS qty_text, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS price_text
FROM {lineitem}
"""

#: Documents as files: some are empty, some have a kind that is not taken.
FILES = """
SELECT doc_id, 'in/' || lpad(CAST(doc_id AS STRING), 10, '0') AS path,
  source || '-' || CAST(doc_id AS STRING) || CASE doc_id % 8 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PNG' WHEN 2 THEN '.jpg' WHEN 3 THEN '.jpeg' WHEN 4 THEN '.tiff' WHEN 5 THEN '.tif' WHEN 6 THEN '.docx' ELSE '' END AS file_name,
  CASE WHEN doc_id % 17 = 0 THEN 0 ELSE length(text) END AS length, text
FROM {documents}
"""

#: Orders as stored invoice documents.
INVOICES = """
SELECT o_orderkey AS document_id, 'file_' || CAST(o_orderkey AS STRING) || '.pdf' AS file_name,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'h' || CAST(o_orderkey AS STRING) END AS file_hash,
  'INV-' || CAST(o_orderkey AS STRING) AS invoice_number, CAST(o_orderdate AS DATE) AS invoice_date, c_name AS vendor_name,
  CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount, CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' END AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' ELSE 'needs_review' END AS status,
  CAST(o_orderdate AS TIMESTAMP) AS processed_at,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'low' END AS review_reason,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'unreadable' END AS failure_reason
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""
ITEMS = "SELECT l_orderkey AS document_id, l_linenumber AS line, 'Part ' || CAST(l_partkey AS STRING) AS description, CAST(l_extendedprice AS DECIMAL(10,2)) AS line_total FROM {lineitem}"
DUPLICATES = "SELECT event_id AS duplicate_id, event_type AS file_name, CAST(ts AS TIMESTAMP) AS skipped_at FROM {events}"
SINCE, UNTIL = "1995-01-01", "1996-12-31"
_SEARCH_SQL = f"SELECT document_id, invoice_number, vendor_name FROM ({INVOICES}) WHERE lower(invoice_number) LIKE '%inv-1%' OR lower(vendor_name) LIKE '%inv-1%' ORDER BY processed_at DESC, document_id LIMIT 10 OFFSET 10"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_NAMES = ("orders", "customer", "lineitem", "documents", "events")


def _oracle(text: str) -> str:
    for n in _NAMES:
        text = text.replace("{" + n + "}", n)
    return text


def _rows(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    for n in _NAMES:
        text = text.replace("{" + n + "}", f"parquet.`{sf_dir}/{n}.parquet`")
    return spark.sql(text)


def _query(sql: str):
    """Registers a query under its own name with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = _oracle(sql)
        return f

    return keep


# Intake


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with hash and reason. Texts leave the plan here; only narrow columns are shuffled."""
    rows = _rows(spark, sf_dir, FILES)
    return rows.select("doc_id", "path", "file_name", "length", intake.file_hash(F.col("text").cast("binary"), F.col("length")).alias("file_hash"), intake.invalid_reason(F.col("file_name"), F.col("length")).alias("invalid_reason"))


_REASON_SQL = "CASE WHEN doc_id % 8 = 6 THEN 'Unsupported file extension: .docx' WHEN doc_id % 8 = 7 THEN 'Unsupported file extension: ' WHEN length = 0 THEN 'File is empty' END"
_FILES_SQL = f"SELECT doc_id, path, file_name, CASE WHEN length > 0 THEN sha256(text) END AS file_hash, {_REASON_SQL} AS invalid_reason FROM ({FILES})"


@_query(f"SELECT path, file_name, file_hash, invalid_reason FROM ({_FILES_SQL})")
def intake_validate(spark, sf_dir):
    return _files(spark, sf_dir).select("path", "file_name", "file_hash", "invalid_reason")


@_query(
    f"""WITH f AS ({_FILES_SQL}), v AS (SELECT *, row_number() OVER w AS nth, first_value(file_name) OVER w AS winner FROM f WHERE invalid_reason IS NULL WINDOW w AS (PARTITION BY file_hash ORDER BY path))
SELECT f.path, CASE WHEN f.invalid_reason IS NOT NULL THEN 'failed' WHEN nth > 1 THEN 'duplicate_skipped' ELSE 'ready' END AS status, CASE WHEN nth > 1 THEN winner END AS original_file
FROM f LEFT JOIN v ON f.path = v.path"""
)
def intake_hash_dedup(spark, sf_dir):
    return intake.decide(_files(spark, sf_dir)).select("path", "status", "original_file")


@_query(f"SELECT file_hash, count(*) AS n_files FROM ({_FILES_SQL}) GROUP BY file_hash HAVING count(*) > 1")
def intake_dup_audit(spark, sf_dir):
    return intake.duplicate_audit(_files(spark, sf_dir))


def _stored_files(spark, sf_dir):
    rows = _files(spark, sf_dir).where("doc_id % 2 = 0")
    return rows.select(F.col("doc_id").alias("document_id"), "file_name", "file_hash", F.when(F.col("invalid_reason").isNull(), "success").otherwise("failed").alias("status"))


@_query(
    f"""WITH f AS ({_FILES_SQL}), s AS (SELECT file_hash, min(doc_id) AS d FROM f WHERE doc_id % 2 = 0 AND invalid_reason IS NULL GROUP BY file_hash),
n AS (SELECT f.*, o.file_name AS stored, min(f.path) OVER (PARTITION BY f.file_hash, f.invalid_reason IS NULL) AS lead_path FROM f LEFT JOIN s ON s.file_hash = f.file_hash LEFT JOIN f o ON o.doc_id = s.d WHERE f.doc_id % 2 = 1)
SELECT n.path, CASE WHEN n.invalid_reason IS NOT NULL THEN 'failed' WHEN stored IS NOT NULL OR n.path <> lead_path THEN 'duplicate_skipped' ELSE 'ready' END AS status,
CASE WHEN n.invalid_reason IS NOT NULL THEN n.invalid_reason WHEN stored IS NOT NULL THEN '{intake.STORED}' WHEN n.path <> lead_path THEN '{intake.SAME_BATCH}' END AS reason,
CASE WHEN n.invalid_reason IS NOT NULL THEN NULL WHEN stored IS NOT NULL THEN stored WHEN n.path <> lead_path THEN l.file_name END AS original_file
FROM n LEFT JOIN f l ON l.path = lead_path"""
)
def intake_crossbatch(spark, sf_dir):
    new = _files(spark, sf_dir).where("doc_id % 2 = 1")
    return intake.decide(new, _stored_files(spark, sf_dir)).select("path", "status", "reason", "original_file")


@_query(
    """WITH f AS (SELECT doc_id, source || '.png' AS file_name, sha256(text) AS h FROM {documents}), s AS (SELECT DISTINCT file_name FROM f WHERE doc_id % 2 = 0), n AS (SELECT h, min(doc_id) AS doc_id FROM f WHERE doc_id % 2 = 1 GROUP BY h)
SELECT f.doc_id, CASE WHEN s.file_name IS NULL THEN f.file_name ELSE substr(f.file_name, 1, length(f.file_name) - 4) || '_' || substr(f.h, 1, 8) || '.png' END AS target_name
FROM n JOIN f ON n.doc_id = f.doc_id LEFT JOIN s ON f.file_name = s.file_name WHERE f.h NOT IN (SELECT h FROM f WHERE doc_id % 2 = 0)"""
)
def intake_rename(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT doc_id, lpad(CAST(doc_id AS STRING), 12, '0') AS path, source || '.png' AS file_name, sha2(text, 256) AS file_hash, CAST(NULL AS STRING) AS invalid_reason FROM {documents}")
    stored = rows.where("doc_id % 2 = 0").select(F.col("doc_id").alias("document_id"), "file_name", "file_hash", F.lit("success").alias("status"))
    return intake.ready(intake.decide(rows.where("doc_id % 2 = 1"), stored)).select(F.col("path").cast("long").alias("doc_id"), "target_name")


@_query(
    """SELECT doc_id, CASE WHEN nth = 1 THEN source || '.txt' ELSE source || '_' || CAST(nth - 1 AS STRING) || '.txt' END AS free_name
FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM {documents})"""
)
def intake_free_names(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT lpad(CAST(doc_id AS STRING), 12, '0') AS path, source || '.txt' AS file_name FROM {documents}")
    return intake.free_names(rows).select(F.col("path").cast("long").alias("doc_id"), "free_name")


#: Names that clash in every way, and names that are taken.
_BATCH_NAMES = "SELECT doc_id, source || CASE doc_id % 5 WHEN 0 THEN '_' || CAST(doc_id % 7 + 1 AS STRING) ELSE '' END || '.txt' AS file_name FROM {documents}"
_TAKEN_NAMES = "SELECT DISTINCT source || CASE doc_id % 2 WHEN 0 THEN '_' || CAST(doc_id % 13 AS STRING) ELSE '' END || '.txt' AS file_name FROM {documents} WHERE doc_id % 3 = 0"


@_query(
    f"""WITH b AS ({_BATCH_NAMES}), t AS ({_TAKEN_NAMES}), r AS (SELECT b.*, row_number() OVER (PARTITION BY b.file_name ORDER BY doc_id) + CASE WHEN t.file_name IS NULL THEN 0 ELSE 1 END AS nth FROM b LEFT JOIN t ON b.file_name = t.file_name),
need AS (SELECT file_name, max(nth) AS n FROM r WHERE nth > 1 GROUP BY file_name), used AS (SELECT file_name FROM b UNION SELECT file_name FROM t),
tries AS (SELECT file_name, unnest(range(1, n + (SELECT count(*) FROM used) + 1)) AS k FROM need),
free AS (SELECT file_name, k, row_number() OVER (PARTITION BY file_name ORDER BY k) AS j FROM tries WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.file_name = substr(tries.file_name, 1, length(tries.file_name) - 4) || '_' || CAST(k AS STRING) || '.txt'))
SELECT r.doc_id, CASE WHEN nth = 1 THEN r.file_name ELSE substr(r.file_name, 1, length(r.file_name) - 4) || '_' || CAST(k AS STRING) || '.txt' END AS free_name FROM r LEFT JOIN free ON r.file_name = free.file_name AND free.j = r.nth - 1"""
)
def free_names_taken(spark, sf_dir):
    names = _rows(spark, sf_dir, f"SELECT lpad(CAST(doc_id AS STRING), 12, '0') AS path, file_name FROM ({_BATCH_NAMES})")
    return intake.free_names(names, _rows(spark, sf_dir, _TAKEN_NAMES)).select(F.col("path").cast("long").alias("doc_id"), "free_name")


_DECIDED_SQL = f"""WITH f AS ({_FILES_SQL}), v AS (SELECT *, row_number() OVER w AS nth, first_value(file_name) OVER w AS winner FROM f WHERE invalid_reason IS NULL WINDOW w AS (PARTITION BY file_hash ORDER BY path)),
d AS (SELECT f.doc_id, f.file_name, f.file_hash, f.invalid_reason, CASE WHEN f.invalid_reason IS NOT NULL THEN 'failed' WHEN nth > 1 THEN 'duplicate_skipped' ELSE 'ready' END AS status, CASE WHEN nth > 1 THEN winner END AS original_file FROM f LEFT JOIN v ON f.path = v.path)
"""


@_query(
    _DECIDED_SQL
    + f"""SELECT file_name, CASE WHEN status = 'ready' THEN CASE WHEN doc_id % 10 = 3 OR doc_id % 4 = 1 THEN 'failed' ELSE 'success' END ELSE status END AS status,
CASE status WHEN 'ready' THEN CASE WHEN doc_id % 10 = 3 THEN 'File was not processed' WHEN doc_id % 4 = 1 THEN 'no text was found' END WHEN 'failed' THEN invalid_reason ELSE '{intake.SAME_BATCH}' END AS error_message,
2030 AS started, 2031 AS ended FROM d"""
)
def log_final_status(spark, sf_dir):
    decided = intake.decide(_files(spark, sf_dir))
    key = F.regexp_extract("target_name", r"-(\d+)", 1).cast("long")
    results = intake.ready(decided).where(key % 10 != 3).select("target_name", (key % 4 != 1).alias("success"), F.when(key % 4 == 1, "no text was found").alias("error"))
    logs = intake.run_logs(decided, results, _now(), F.lit("2031-01-01 00:00:00").cast("timestamp"))
    return logs.select("file_name", "status", "error_message", F.year("start_time").alias("started"), F.year("end_time").alias("ended"))


@_query(_DECIDED_SQL + "SELECT file_name, file_hash, original_file FROM d WHERE status = 'duplicate_skipped'")
def store_duplicates(spark, sf_dir):
    return intake.decide(_files(spark, sf_dir)).where("status = 'duplicate_skipped'").select("file_name", "file_hash", "original_file")


_MAGIC = "SELECT doc_id, CASE doc_id % 2 WHEN 0 THEN 'x.pdf' ELSE 'x.PDF' END AS file_name, CASE doc_id % 3 WHEN 0 THEN '%PDF-1.4 ' || text WHEN 1 THEN 'a' || text ELSE '' END AS body FROM {documents}"


@_query(f"SELECT doc_id, CASE WHEN body = '' THEN 'File is empty' WHEN NOT starts_with(body, '%PDF-') THEN 'File is not a readable PDF' END AS reason FROM ({_MAGIC})")
def intake_magic(spark, sf_dir):
    body = F.col("body").cast("binary")
    return _rows(spark, sf_dir, _MAGIC).select("doc_id", intake.invalid_reason(F.col("file_name"), F.length(body), body).alias("reason"))


@_query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang || '/' || source ELSE '/other/' || source END AS below FROM {documents}")
def relative_paths(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '/data/store/' || lang ELSE '/other' END || '/' || source AS path FROM {documents}")
    return rows.select("doc_id", basic.relative_path(F.col("path"), "/data/store/").alias("below"))


@_query("SELECT doc_id, 'ocr_output/' || source || '.v1_' || CASE WHEN doc_id % 2 = 0 THEN '20240115_053000' ELSE '20240116_001500' END || '.txt' AS ocr_text_path FROM {documents}")
def ocr_paths(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT doc_id, source || '.v1.pdf' AS file_name, CASE WHEN doc_id % 2 = 0 THEN '2024-01-15T00:00:00Z' ELSE '2024-01-15T18:45:00Z' END AS at FROM {documents}")
    return rows.select("doc_id", basic.ocr_text_path(F.col("file_name"), F.col("at").cast("timestamp")).alias("ocr_text_path"))


@_query("SELECT doc_id, 'a_b_' || source || '.x_y.png' AS clean FROM {documents}")
def clean_names(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT doc_id, '..a/b|' || source || '...x?y.png' AS raw FROM {documents}")
    return rows.select("doc_id", basic.clean_file_name(F.col("raw")).alias("clean"))


# Extraction


def _spread(rows: DataFrame, sf_dir: str, name: str) -> DataFrame:
    """Rows for work that is heavy beside the reading: dealt over all cores if the table comes in fewer splits than there are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.sparkSession.read.parquet(f"{sf_dir}/{name}.parquet").rdd.getNumPartitions() < cores else rows


def _texts(spark, sf_dir):
    return _spread(_rows(spark, sf_dir, RENDERED), sf_dir, "orders")


@_query(f"SELECT doc_key, {_NUMBER_SQL} AS invoice_number FROM ({RENDERED})")
def parse_number(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_key", X.invoice_number(F.col("text")).alias("invoice_number"))


@_query(f"SELECT doc_key, {_DATE_SQL} AS invoice_date FROM ({RENDERED})")
def parse_date(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_key", X.invoice_date(F.col("text")).alias("invoice_date"))


@_query(f"SELECT doc_key, c_name AS vendor_name FROM ({RENDERED})")
def parse_vendor(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_key", X.vendor_name(F.col("text")).alias("vendor_name"))


@_query(f"SELECT doc_key, {_TOTAL_SQL} AS total_amount, {_CURRENCY_SQL} AS currency FROM ({RENDERED})")
def parse_total(spark, sf_dir):
    rows = _texts(spark, sf_dir).select("doc_key", X.last_total(F.col("text")).alias("t"))
    return rows.select("doc_key", X.total_amount(F.col("t")).alias("total_amount"), X.total_currency(F.col("t")).alias("currency"))


def _parsed(spark, sf_dir):
    return batch.validate(batch.parse(_texts(spark, sf_dir)))


@_query(f"SELECT doc_key, {_NUMBER_SQL} AS invoice_number, {_DATE_SQL} AS invoice_date, c_name AS vendor_name, {_TOTAL_SQL} AS total_amount, {_CURRENCY_SQL} AS currency, {_CONFIDENCE_SQL} AS confidence, CASE WHEN {_CONFIDENCE_SQL} = 'high' THEN 'success' ELSE 'needs_review' END AS status FROM ({RENDERED})")
def parse_invoice(spark, sf_dir):
    return _parsed(spark, sf_dir).select("doc_key", "invoice_number", "invoice_date", "vendor_name", "total_amount", "currency", "confidence", "status")


@_query(f"SELECT CASE WHEN {_CONFIDENCE_SQL} = 'high' THEN 'success' ELSE 'needs_review' END AS status, {_CONFIDENCE_SQL} AS confidence, count(*) AS n, sum(CAST({_TOTAL_SQL} AS DECIMAL(12,2)))::DOUBLE AS total_amount FROM ({RENDERED}) GROUP BY 1, 2")
def parse_status(spark, sf_dir):
    """The flagship: text to fields to status, summed up."""
    amount = F.sum(F.col("total_amount").cast("decimal(12,2)")).cast("double")
    return _parsed(spark, sf_dir).groupBy("status", "confidence").agg(F.count(F.lit(1)).alias("n"), amount.alias("total_amount"))


_BROKEN_SQL = f"concat_ws(', ', CASE WHEN {_NUMBER_SQL} IS NULL THEN 'invoice_number' END, CASE WHEN {_DATE_SQL} IS NULL THEN 'invoice_date' END, CASE WHEN {_TOTAL_SQL} IS NULL THEN 'total_amount' END)"


@_query(f"SELECT doc_key, {_BROKEN_SQL} = '' AS is_valid, nullif({_BROKEN_SQL}, '') AS error, 'needs_review' AS status, {_NUMBER_SQL} AS invoice_number, {_DATE_SQL} AS invoice_date, {_CURRENCY_SQL} AS currency, {_TOTAL_SQL} AS total_amount FROM ({RENDERED})")
def process_and_validate(spark, sf_dir):
    rows = _texts(spark, sf_dir).select(F.col("doc_key").cast("string").alias("file_name"), F.lit("h").alias("file_hash"), "text")
    out = batch.process_and_validate(rows)
    return out.select(F.col("file_name").cast("long").alias("doc_key"), "is_valid", "error", "record.status", "record.invoice_number", F.col("record.invoice_date").cast("string").alias("invoice_date"), "record.currency", "record.total_amount")


def _item_texts(spark, sf_dir, line: str):
    rows = _rows(spark, sf_dir, ITEM_TEXT)
    return rows.groupBy("doc_key").agg(F.concat(F.lit("Item list\n"), F.array_join(F.array_sort(F.collect_list(F.expr(line))), "\n"), F.lit("\nTax   $1.00\nTotal   $9.99\n")).alias("text"))


def _exploded(rows, items):
    return rows.select("doc_key", F.explode(items).alias("x")).select("doc_key", "x.description", "x.quantity", "x.unit_price", "x.line_total")


_FOUR_SQL = f"SELECT doc_key, description, CAST(qty_text AS DOUBLE) AS quantity, CAST(price_text AS DOUBLE) AS unit_price, CAST(price_text AS DOUBLE) AS line_total FROM ({ITEM_TEXT})"


@_query(_FOUR_SQL)
def parse_items_qty_first(spark, sf_dir):
    rows = _item_texts(spark, sf_dir, "qty_text || '   ' || description || '   $' || price_text || '  $' || price_text")
    return _exploded(rows, X.items_qty_first(F.col("text")))


@_query(_FOUR_SQL)
def parse_items_desc_first(spark, sf_dir):
    rows = _item_texts(spark, sf_dir, "description || '   ' || qty_text || '   ' || price_text || '   ' || price_text")
    return _exploded(rows, X.line_items(F.regexp_replace("text", "Item list\n", "")))


@_query(f"SELECT doc_key, description, CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS DOUBLE) AS unit_price, CAST(price_text AS DOUBLE) AS line_total FROM ({ITEM_TEXT})")
def parse_items_two_columns(spark, sf_dir):
    rows = _item_texts(spark, sf_dir, "description || '     $' || price_text")
    return _exploded(rows, X.items_two_columns(F.regexp_replace("text", "Item list\n", "")))


@_query("SELECT doc_id, '--- Page 1 ---' || chr(10) || lang || chr(10) || chr(10) || '--- Page 2 ---' || chr(10) || source AS text FROM {documents}")
def join_pages(spark, sf_dir):
    return _rows(spark, sf_dir, "SELECT doc_id, array(lang, source) AS pages FROM {documents}").select("doc_id", X.join_pages(F.col("pages")).alias("text"))


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 100 < 90 THEN 'high' ELSE 'low' END AS confidence, CASE WHEN o_orderkey % 100 < 95 THEN 'Mock Stationery' ELSE 'Mock Fail' END AS vendor_name, CASE WHEN o_orderkey % 100 < 90 THEN 2000.0::DOUBLE WHEN o_orderkey % 100 >= 95 THEN 500.0::DOUBLE END AS total_amount, CASE WHEN o_orderkey % 100 < 95 THEN 2000.0::DOUBLE ELSE 400.0::DOUBLE END AS items_total FROM {orders}")
def mock_mix(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT o_orderkey FROM {orders}").withColumn("m", mock(F.col("o_orderkey")))
    return rows.select("o_orderkey", "m.confidence", "m.vendor_name", "m.total_amount", V.items_sum(F.col("m.line_items")).alias("items_total"))


# Validation


@_query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'INV-' || CAST(o_orderkey AS STRING) END AS invoice_number,
CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS invoice_date, substr(c_name, 1, 200) AS vendor_name,
CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS total_amount,
CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' END AS currency FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
)
def validate_fields(spark, sf_dir):
    rows = _rows(
        spark,
        sf_dir,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '   ' ELSE '  INV-' || CAST(o_orderkey AS STRING) || chr(9) END AS number,
CASE WHEN o_orderkey % 7 = 0 THEN '2024-02-30' ELSE ' ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ' ' END AS date, c_name || chr(10) AS vendor,
CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE '' END || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) AS total,
CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN ' eur ' WHEN 2 THEN 'US' ELSE 'U$D' END AS currency FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    )
    return rows.select(
        "o_orderkey",
        V.valid_number(F.col("number")).alias("invoice_number"),
        V.valid_date(F.col("date")).alias("invoice_date"),
        V.valid_vendor(F.col("vendor")).alias("vendor_name"),
        V.valid_amount(F.col("total"), "string").alias("total_amount"),
        V.valid_currency(F.col("currency")).alias("currency"),
    )


_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 6 = 0 THEN -l_quantity ELSE l_quantity END AS quantity, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) END AS price FROM {lineitem}"


@_query(f"SELECT l_orderkey, 'Part ' || CAST(l_partkey AS STRING) AS description, CASE WHEN quantity >= 0 THEN quantity END AS quantity, price AS unit_price, CASE WHEN l_partkey % 9 <> 0 THEN price END AS line_total FROM ({_LINES}) WHERE l_partkey % 5 <> 0")
def validate_items(spark, sf_dir):
    rows = _rows(spark, sf_dir, f"SELECT l_orderkey, array(named_struct('description', CASE WHEN l_partkey % 5 = 0 THEN '  ' ELSE ' Part ' || CAST(l_partkey AS STRING) END, 'quantity', quantity, 'unit_price', price, 'line_total', CASE WHEN l_partkey % 9 = 0 THEN -price ELSE price END)) AS items FROM ({_LINES})")
    rows = _spread(rows, sf_dir, "lineitem")
    return rows.select("l_orderkey", F.explode(V.valid_items(F.col("items"))).alias("x")).select("l_orderkey", "x.*")


@_query(
    """WITH s AS (SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total FROM {lineitem} GROUP BY 1)
SELECT k, k % 3 <> 1 AS subtotal_ok, CASE WHEN k % 5 = 0 THEN NULL ELSE k % 4 <> 2 END AS total_ok FROM s"""
)
def totals_check(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS s, array_agg(named_struct('line_total', CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE))) AS items FROM {lineitem} GROUP BY 1")
    total = F.col("s").cast("double")
    rows = rows.select("k", "items", F.when(F.col("k") % 3 == 1, total + 1).otherwise(total).alias("subtotal"), F.when(F.col("k") % 5 != 0, F.lit(5.0)).alias("tax"), total.alias("s"))
    paid = F.when(F.col("k") % 4 == 2, F.col("subtotal") + 7).otherwise(F.col("subtotal") + 5)
    return rows.select("k", V.subtotal_matches(F.col("subtotal"), F.col("items")).alias("subtotal_ok"), V.total_matches(F.col("subtotal"), F.col("tax"), paid).alias("total_ok"))


@_query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 2 = 0 THEN 1.5::DOUBLE ELSE l_quantity * 2 END AS line_total FROM {lineitem}")
def item_totals(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_partkey % 2 = 0 THEN CAST(1.5 AS DOUBLE) END AS stated FROM {lineitem}")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", V.item_total(F.col("l_quantity"), F.lit(2.0), F.col("stated")).alias("line_total"))


@_query("SELECT o_orderkey, o_orderkey % 6 <> 0 AND o_orderkey % 10 <> 0 AS is_valid, CASE WHEN o_orderkey % 6 = 0 AND o_orderkey % 10 = 0 THEN 'invoice_number, total_amount' WHEN o_orderkey % 6 = 0 THEN 'invoice_number' WHEN o_orderkey % 10 = 0 THEN 'total_amount' END AS error FROM {orders}")
def validate_model(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN 'N' || CAST(o_orderkey AS STRING) END AS n, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE 5 END AS t FROM {orders}")
    m = V.model_record(F.col("n"), F.col("d"), F.lit("v"), F.col("t"), F.lit("f"), F.lit("h"))
    return rows.withColumn("m", m).select("o_orderkey", "m.is_valid", "m.error")


# Merges


def _invoices(spark, sf_dir):
    return _rows(spark, sf_dir, INVOICES)


def _merge_inputs(spark, sf_dir):
    stored = _invoices(spark, sf_dir).where("document_id % 3 <> 0")
    new = _invoices(spark, sf_dir).where("document_id % 2 = 0")
    # Some new files have another name but a stored hash.
    name = F.when((F.col("document_id") % 10 == 4) & F.col("file_hash").isNotNull(), F.concat(F.lit("copy_"), "file_name")).otherwise(F.col("file_name"))
    return stored, new.withColumn("file_name", name).drop("document_id", "processed_at")


def _now():
    return F.lit("2030-01-01 00:00:00").cast("timestamp")


_MERGE_SQL = f"""WITH i AS ({INVOICES}), top AS (SELECT max(document_id) AS t FROM i WHERE document_id % 3 <> 0),
n AS (SELECT *, CASE WHEN document_id % 10 = 4 AND file_hash IS NOT NULL THEN 'copy_' || file_name ELSE file_name END AS new_name FROM i WHERE document_id % 2 = 0),
fresh AS (SELECT *, t + row_number() OVER (ORDER BY md5(new_name), new_name) AS new_id FROM n, top WHERE document_id % 3 = 0)
"""


@_query(
    _MERGE_SQL
    + """SELECT document_id, file_name, file_hash, CASE WHEN document_id % 2 = 0 THEN 'merged' ELSE invoice_number END AS invoice_number, status, CASE WHEN document_id % 2 = 0 THEN NULL ELSE failure_reason END AS failure_reason, year(processed_at) AS processed_year FROM i WHERE document_id % 3 <> 0
UNION ALL SELECT new_id, new_name, file_hash, 'merged', status, failure_reason, 2030 FROM fresh"""
)
def upsert_docs(spark, sf_dir):
    stored, new = _merge_inputs(spark, sf_dir)
    out = merge.upsert_success(stored, new.withColumn("invoice_number", F.lit("merged")), _now())
    return out.select("document_id", "file_name", "file_hash", "invoice_number", "status", "failure_reason", F.year("processed_at").cast("long").alias("processed_year"))


_COPY_SQL = "document_id % 10 = 4 AND file_hash IS NOT NULL"


@_query(
    _MERGE_SQL
    + f"""SELECT document_id, file_name, CASE WHEN hit THEN 'x' || file_hash ELSE file_hash END AS file_hash, invoice_number, CASE WHEN hit THEN 'failed' ELSE status END AS status, CASE WHEN hit THEN 'gone' ELSE failure_reason END AS failure_reason, year(processed_at) AS processed_year
FROM (SELECT *, document_id % 2 = 0 AND NOT coalesce({_COPY_SQL}, FALSE) AS hit FROM i WHERE document_id % 3 <> 0)
UNION ALL SELECT t + row_number() OVER (ORDER BY md5(new_name), new_name), new_name, 'x' || file_hash, NULL, 'failed', 'gone', 2030 FROM n, top WHERE document_id % 3 = 0 OR ({_COPY_SQL})"""
)
def upsert_failed(spark, sf_dir):
    stored, new = _merge_inputs(spark, sf_dir)
    new = new.select("file_name", F.concat(F.lit("x"), "file_hash").alias("file_hash"), F.lit("failed").alias("status"), F.lit("gone").alias("failure_reason"))
    out = merge.upsert_failed(stored, new, _now())
    return out.select("document_id", "file_name", "file_hash", "invoice_number", "status", "failure_reason", F.year("processed_at").cast("long").alias("processed_year"))


# The store in parts


def _as(rows: DataFrame, name: str) -> DataFrame:
    """Rows with all columns of a stored table; those that are absent are null."""
    fields = rows.sparkSession.createDataFrame([], schemas.TABLES[name]).schema
    return rows.select(*((F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields))


def _store(documents: DataFrame, **add: DataFrame) -> Store:
    """A new store with documents and other rows."""
    store = Store(documents.sparkSession, shared_folder(documents.sparkSession, "store"), period="year", buckets=4, digits=1)
    rows = _as(documents, "invoice_documents")
    store.put_documents("first", rows.where(F.lit(False)), rows, set(), add)
    return store


@_query(ORACLES["upsert_docs"])
def merge_parts(spark, sf_dir):
    """The same merge as upsert_docs, read from and written to the parts it touches."""
    stored, new = _merge_inputs(spark, sf_dir)
    store = _store(stored)
    store.put_documents("second", *store.merged(new.withColumn("invoice_number", F.lit("merged")), None, _now()))
    out = store.table("invoice_documents")
    return out.select("document_id", "file_name", "file_hash", "invoice_number", "status", "failure_reason", F.year("processed_at").cast("long").alias("processed_year"))


@_query(ORACLES["intake_crossbatch"])
def key_probe(spark, sf_dir):
    """The same decisions as intake_crossbatch, from the key table."""
    store = _store(_stored_files(spark, sf_dir))
    new = _files(spark, sf_dir).where("doc_id % 2 = 1")
    return intake.decide(new, store.candidates(new)).select("path", "status", "reason", "original_file")


#: Rendered texts as files: some are empty, some come a second time under another name.
_BATCH = f"""
SELECT doc_key, iso, c_name, amount, 'a/' || lpad(CAST(doc_key AS STRING), 10, '0') || '.pdf' AS path, lpad(CAST(doc_key AS STRING), 10, '0') || '.pdf' AS file_name,
  CASE WHEN doc_key % 17 = 0 THEN '' ELSE '%PDF-' || chr(10) || text || chr(10) || 'k' || CAST(doc_key AS STRING) END AS body FROM ({RENDERED}) r
UNION ALL SELECT doc_key, iso, c_name, amount, 'b/copy_' || CAST(doc_key AS STRING) || '.pdf', 'copy_' || CAST(doc_key AS STRING) || '.pdf', '%PDF-' || chr(10) || text || chr(10) || 'k' || CAST(doc_key AS STRING) FROM ({RENDERED}) r WHERE doc_key % 50 = 1 AND doc_key % 17 <> 0
"""
_PAPER_SQL = f"CASE WHEN {_CONFIDENCE_SQL} = 'high' THEN 'success' ELSE 'needs_review' END"


@_query(
    f"""WITH f AS (SELECT * FROM ({RENDERED})), e AS (SELECT *, doc_key % 17 = 0 AS empty, lpad(CAST(doc_key AS STRING), 10, '0') || '.pdf' AS file_name FROM f)
SELECT 'document' AS kind, file_name, CASE WHEN empty THEN 'failed' ELSE {_PAPER_SQL} END AS status, CASE WHEN NOT empty THEN {_NUMBER_SQL} END AS invoice_number, CASE WHEN NOT empty THEN {_DATE_SQL} END AS invoice_date,
  CASE WHEN NOT empty THEN CASE doc_key % 3 WHEN 1 THEN '--- Page 1 ---' ELSE c_name END END AS vendor_name, CASE WHEN NOT empty THEN {_TOTAL_SQL} END AS total_amount, CASE WHEN NOT empty THEN {_CURRENCY_SQL} END AS currency,
  CASE WHEN empty THEN 'File is empty' END AS reason FROM e
UNION ALL SELECT 'log', file_name, CASE WHEN empty THEN 'failed' ELSE 'success' END, NULL, NULL, NULL, NULL, NULL, CASE WHEN empty THEN 'File is empty' END FROM e
UNION ALL SELECT 'log', 'copy_' || CAST(doc_key AS STRING) || '.pdf', 'duplicate_skipped', NULL, NULL, NULL, NULL, NULL, '{intake.SAME_BATCH}' FROM e WHERE doc_key % 50 = 1 AND NOT empty
UNION ALL SELECT 'duplicate', 'copy_' || CAST(doc_key AS STRING) || '.pdf', NULL, NULL, NULL, NULL, NULL, NULL, file_name FROM e WHERE doc_key % 50 = 1 AND NOT empty"""
)
def daily_batch(spark, sf_dir):
    """A whole batch over files in the plan: documents, run logs and duplicates as the store has them afterwards."""
    files = _rows(spark, sf_dir, _BATCH).select("path", "file_name", F.encode("body", "UTF-8").alias("content"), F.octet_length("body").cast("long").alias("length"))
    store = Store(spark, shared_folder(spark, "store"), period="year", buckets=4, digits=1)
    batch.run(files, store, "one", now=_now())
    empty = {c: F.lit(None).cast(t) for c, t in (("invoice_number", "string"), ("invoice_date", "string"), ("vendor_name", "string"), ("total_amount", "double"), ("currency", "string"))}
    documents = store.table("invoice_documents").select(F.lit("document").alias("kind"), "file_name", "status", "invoice_number", F.col("invoice_date").cast("string").alias("invoice_date"), "vendor_name", F.col("total_amount").cast("double").alias("total_amount"), "currency", F.col("failure_reason").alias("reason"))
    logs = store.table("processing_logs").select(F.lit("log").alias("kind"), "file_name", "status", F.col("error_message").alias("reason")).withColumns(empty)
    copies = store.table("duplicate_files").select(F.lit("duplicate").alias("kind"), "file_name", F.lit(None).cast("string").alias("status"), F.col("original_file").alias("reason")).withColumns(empty)
    return documents.unionByName(logs).unionByName(copies)


def _window_store(spark, sf_dir):
    """Documents and items; an item lies in the period of its document."""
    documents = _invoices(spark, sf_dir)
    items = _rows(spark, sf_dir, ITEMS).select(F.col("line").cast("long").alias("line_item_id"), "document_id", "description", "line_total")
    periods = documents.select("document_id", F.trunc("processed_at", "year").alias("period"))
    items = items.join(periods, "document_id").withColumns({"quantity": F.lit(None).cast("decimal(18,4)"), "unit_price": F.lit(None).cast("decimal(10,2)")})
    return _store(documents, invoice_line_items=items)


@_query(f"SELECT i.document_id, i.status, CAST(i.total_amount AS DOUBLE) AS total_amount, CAST((SELECT sum(t.line_total) FROM ({ITEMS}) t WHERE t.document_id = i.document_id) AS DOUBLE) AS items_total FROM ({INVOICES}) i WHERE processed_at BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}'")
def window_parts(spark, sf_dir):
    """The report's documents and their sums, from the folders of the window's months only."""
    store, (since, until) = _window_store(spark, sf_dir), _window()
    out = report.invoices(store.window("invoice_documents", since, until), store.window_items(since, until), since, until)
    return out.select("document_id", "status", F.col("total_amount").cast("double").alias("total_amount"), F.col("items_total").cast("double").alias("items_total"))


#: Documents after a batch of successes that pay one more, and a batch of failures.
_TWICE_SQL = f"""WITH i AS ({INVOICES}), f AS (SELECT *, document_id % 3 <> 0 AS stored, document_id % 2 = 0 AS good, document_id % 5 = 0 AS bad FROM i),
d AS (SELECT CASE WHEN stored THEN year(processed_at) ELSE 2030 END AS year, CASE WHEN bad THEN 'failed' ELSE status END AS status, CASE WHEN stored OR good THEN currency END AS currency,
  CASE WHEN good THEN total_amount + 1 WHEN stored THEN total_amount END AS total_amount FROM f WHERE stored OR good OR bad)
"""


@_query(_TWICE_SQL + "SELECT CAST(year AS BIGINT) AS year, status, currency, count(*) AS n, CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_amount FROM d GROUP BY 1, 2, 3")
def kept_figures(spark, sf_dir):
    """Counts and sums that two merges kept up, without a look at documents."""
    rows = _invoices(spark, sf_dir)
    store = _store(rows.where("document_id % 3 <> 0"))
    new = rows.drop("document_id", "processed_at").withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(10,2)"))
    store.put_documents("second", *store.merged(new.where(rows["document_id"] % 2 == 0), None, _now()))
    failed = rows.where("document_id % 5 = 0").select("file_name", "file_hash", F.lit("failed").alias("status"), F.lit("gone").alias("failure_reason"))
    store.put_documents("third", *store.merged(None, failed, _now()))
    sums = store.cells().groupBy(F.year("day").cast("long").alias("year"), "status", "currency")
    return sums.agg(F.sum("n").alias("n"), F.sum("total_amount").cast("double").alias("total_amount"))


@_query(_SEARCH_SQL)
def search_indexed(spark, sf_dir):
    """The same page as search_page, through the store's trigrams."""
    found = _store(_invoices(spark, sf_dir)).search("INV-1")
    return dashboard.page(found, 2, F.desc_nulls_last("processed_at"), F.col("document_id")).select("document_id", "invoice_number", "vendor_name")


@_query(f"WITH i AS ({INVOICES}), n AS (SELECT count(*) AS n FROM i), o AS (SELECT *, row_number() OVER (ORDER BY processed_at DESC, document_id) AS nth FROM i) SELECT document_id, file_name FROM o, n WHERE nth > 10 * CAST(ceil(n / 10.0) - 1 AS BIGINT) OR nth <= 10")
def deep_pages(spark, sf_dir):
    """The first and the last page of all documents."""
    folder, order = shared_folder(spark, "pages"), (F.desc_nulls_last("processed_at"), F.col("document_id"))
    pages.write_pages(_invoices(spark, sf_dir).select("processed_at", "document_id", "file_name"), folder, *order, range_rows=1000)
    first, last = (pages.read_page(spark, folder, k, *order).select("document_id", "file_name") for k in (1, 0))
    return first.unionByName(last)


_UPPER_SQL = f"WITH i AS ({INVOICES}), n AS (SELECT * FROM i WHERE document_id % 4 = 0), top AS (SELECT max(document_id) AS t FROM i WHERE document_id % 3 <> 0)"


@_query(
    _UPPER_SQL
    + """SELECT document_id, file_name, CASE WHEN document_id % 4 = 0 THEN 'merged' ELSE invoice_number END AS invoice_number FROM i WHERE document_id % 3 <> 0
UNION ALL SELECT t + row_number() OVER (ORDER BY md5(upper(file_name)), upper(file_name)), upper(file_name), 'merged' FROM n, top WHERE document_id % 3 = 0"""
)
def upsert_any_case(spark, sf_dir):
    """New names in capitals meet stored ones in small letters."""
    rows = _invoices(spark, sf_dir)
    new = rows.where("document_id % 4 = 0").drop("document_id", "processed_at", "file_hash").withColumns({"file_name": F.upper("file_name"), "invoice_number": F.lit("merged"), "file_hash": F.lit(None).cast("string")})
    out = merge.upsert_success(rows.where("document_id % 3 <> 0"), new, _now(), collation=merge.ANY_CASE)
    return out.select("document_id", "file_name", "invoice_number")


_RUNS = "SELECT CAST(user_id AS STRING) AS run, event_id AS id, event_id % 2 = 0 AS start, CASE WHEN event_type = 'error' THEN 'broken' END AS error, CAST(ts AS TIMESTAMP) AS moment FROM {events}"


@_query(
    f"""WITH e AS (SELECT *, lead(start) OVER w AS next_start, lead(error) OVER w AS next_error, lead(moment) OVER w AS next_at FROM ({_RUNS}) WINDOW w AS (PARTITION BY run ORDER BY moment, id)),
s AS (SELECT run, moment, coalesce(next_at <= moment + INTERVAL 1 HOUR, FALSE) AS soon, next_start, next_error, next_at FROM e WHERE start)
SELECT run, epoch_us(moment) AS start_us, epoch_us(CASE WHEN soon THEN next_at ELSE moment + INTERVAL 1 HOUR END) AS end_us, CASE WHEN soon AND NOT next_start AND next_error IS NULL THEN 'success' ELSE 'failed' END AS status,
CASE WHEN NOT soon THEN '{runs.TIMED_OUT}' WHEN next_start THEN '{runs.NOT_ENDED}' ELSE next_error END AS error_message FROM s"""
)
def run_stream(spark, sf_dir):
    """Starts and ends that come in three batches, and a last one that lets all time pass."""
    events = _rows(spark, sf_dir, _RUNS).withColumnRenamed("moment", "at")
    cut = [F.lit(t).cast("timestamp") for t in ("2024-01-10", "2024-01-20")]
    last = events.agg((F.max("at") + F.expr("INTERVAL 2 HOURS")).alias("at")).select(F.lit("").alias("run"), F.lit(-1).cast("long").alias("id"), F.lit(False).alias("start"), F.lit(None).cast("string").alias("error"), "at")
    batches = [events.where(F.col("at") < cut[0]), events.where((F.col("at") >= cut[0]) & (F.col("at") < cut[1])), events.where(F.col("at") >= cut[1]), last]
    logs = runs.replay(events, batches, shared_folder(spark, "runs"), lambda s: runs.run_logs(s, 3600))
    return logs.select("run", F.unix_micros("start_time").alias("start_us"), F.unix_micros("end_time").alias("end_us"), "status", "error_message")


_STREAM_FILES = "SELECT CAST(ts AS TIMESTAMP) AS modified, {sha}(event_type || CAST(user_id % 40 AS STRING){bits}) AS file_hash FROM {events}"


@_query("SELECT DISTINCT sha256(event_type || CAST(user_id % 40 AS STRING)) AS file_hash FROM {events}")
def stream_distinct(spark, sf_dir):
    """Files of three batches, each hash once."""
    files = _rows(spark, sf_dir, _STREAM_FILES.replace("{sha}", "sha2").replace("{bits}", ", 256"))
    days = F.dayofmonth("modified")
    batches = [files.where(days <= 10), files.where((days > 10) & (days <= 20)), files.where(days > 20)]
    return runs.replay(files, batches, shared_folder(spark, "distinct"), lambda s: runs.distinct_files(s, "90 days")).select("file_hash")


@_query("SELECT 'documents' AS kind, count(*) AS n FROM {orders} WHERE o_orderkey % 5 <> 0 UNION ALL SELECT 'items', count(*) FROM {lineitem} WHERE l_orderkey % 5 <> 0")
def cascade_delete(spark, sf_dir):
    documents, items = _invoices(spark, sf_dir), _rows(spark, sf_dir, ITEMS)
    documents, items = merge.delete_documents(documents, items, documents.where("document_id % 5 = 0").select("document_id"))
    counts = [x.agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("n")) for k, x in (("documents", documents), ("items", items))]
    return counts[0].unionByName(counts[1])


@_query("SELECT CAST(coalesce(max(o_orderkey), 0) AS BIGINT) AS version FROM {orders}")
def schema_version(spark, sf_dir):
    return merge.current_version(_rows(spark, sf_dir, "SELECT o_orderkey AS version FROM {orders}")).select(F.col("version").cast("long").alias("version"))


@_query("WITH i AS (SELECT l_orderkey AS document_id, count(*) AS n FROM {lineitem} GROUP BY 1) SELECT document_id, CASE WHEN document_id % 2 = 0 THEN 2 * n ELSE n END AS n_items FROM i")
def append_items(spark, sf_dir):
    items = _rows(spark, sf_dir, ITEMS).select(F.xxhash64("document_id", "line", "description").alias("line_item_id"), "document_id", "description", "line_total")
    both = merge.append_items(items, items.where("document_id % 2 = 0").drop("line_item_id"))
    return both.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_items"))


@_query("SELECT o_orderkey AS document_id, 'kept' AS place FROM {orders} WHERE o_orderkey % 4 <> 0 UNION ALL SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 8 = 0 THEN 'orig' END, 'unknown') FROM {orders} WHERE o_orderkey % 4 = 0 AND o_orderkey % 11 <> 0")
def migrate_dups(spark, sf_dir):
    rows = _invoices(spark, sf_dir).withColumn("status", F.when(F.col("document_id") % 4 == 0, "duplicate_skipped").otherwise(F.col("status"))).withColumn("original_file", F.when(F.col("document_id") % 8 == 0, "orig"))
    kept, moved = merge.move_legacy_duplicates(rows)
    number = F.regexp_extract("file_name", r"(\d+)", 1).cast("long")
    return kept.select("document_id", F.lit("kept").alias("place")).unionByName(moved.select(number.alias("document_id"), F.col("original_file").alias("place")))


@_query(
    """SELECT 'invoice_documents' AS name, (SELECT count(*) FROM (SELECT o_custkey FROM {orders} GROUP BY 1 HAVING count(*) > 1)) AS n
UNION ALL SELECT 'invoice_line_items', (SELECT count(*) FROM (SELECT l_orderkey * 10 + l_linenumber FROM {lineitem} GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'invoice_line_items.document_id', (SELECT count(*) FROM {lineitem} WHERE l_orderkey NOT IN (SELECT o_custkey FROM {orders}))"""
)
def key_audit(spark, sf_dir):
    """Keys that come twice and references that lead nowhere, with customers' ids for those of documents."""
    documents = _rows(spark, sf_dir, "SELECT o_custkey AS document_id FROM {orders}")
    items = _rows(spark, sf_dir, "SELECT l_orderkey * 10 + l_linenumber AS line_item_id, l_orderkey AS document_id FROM {lineitem}")
    return key_checks({"invoice_documents": documents, "invoice_line_items": items})


_GAPS = ("document_id", "file_name", "file_hash", "invoice_number", "invoice_date", "vendor_name", "total_amount", "currency", "status", "ocr_text_path", "processed_at", "review_reason", "failure_reason", "original_file", "updated_at")
_ABSENT = ("ocr_text_path", "original_file", "updated_at")


@_query(f"WITH i AS ({INVOICES}) " + " UNION ALL ".join(f"SELECT '{c}' AS column, {str(c in _ABSENT).upper()} AS missing, {'0' if c in _ABSENT else f'(SELECT count({c}) FROM i)'} AS n_values" for c in _GAPS))
def column_audit(spark, sf_dir):
    return column_gaps(_invoices(spark, sf_dir), "invoice_documents")


@_query(ORACLES["migrate_dups"])
def migrate_store(spark, sf_dir):
    """The same as migrate_dups, by the migrations of a store that has such rows."""
    rows = _invoices(spark, sf_dir).withColumn("status", F.when(F.col("document_id") % 4 == 0, "duplicate_skipped").otherwise(F.col("status"))).withColumn("original_file", F.when(F.col("document_id") % 8 == 0, "orig"))
    store = _store(rows)
    store.migrate()
    number = F.regexp_extract("file_name", r"(\d+)", 1).cast("long")
    moved = store.table("duplicate_files").select(number.alias("document_id"), F.col("original_file").alias("place"))
    return store.table("invoice_documents").select("document_id", F.lit("kept").alias("place")).unionByName(moved)


@_query("SELECT l_orderkey AS document_id, l_linenumber AS line, count(*) AS n FROM {lineitem} WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {orders} WHERE o_orderkey % 9 <> 0) GROUP BY 1, 2")
def orphan_items(spark, sf_dir):
    return merge.orphans(_rows(spark, sf_dir, ITEMS), _invoices(spark, sf_dir).where("document_id % 9 <> 0")).groupBy("document_id", "line").agg(F.count(F.lit(1)).alias("n"))


# Reports

_WINDOW_SQL = f"processed_at BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}'"


def _window():
    return F.lit(SINCE).cast("timestamp"), F.lit(UNTIL).cast("timestamp")


@_query(f"SELECT i.document_id, i.vendor_name, i.status, CAST(i.total_amount AS DOUBLE) AS total_amount, CAST((SELECT sum(t.line_total) FROM ({ITEMS}) t WHERE t.document_id = i.document_id) AS DOUBLE) AS items_total FROM ({INVOICES}) i WHERE {_WINDOW_SQL}")
def report_invoices(spark, sf_dir):
    out = report.invoices(_invoices(spark, sf_dir), _rows(spark, sf_dir, ITEMS), *_window())
    return out.select("document_id", "vendor_name", "status", F.col("total_amount").cast("double").alias("total_amount"), F.col("items_total").cast("double").alias("items_total"))


@_query(f"SELECT t.document_id, t.line, t.description, CAST(t.line_total AS DOUBLE) AS line_total FROM ({ITEMS}) t JOIN ({INVOICES}) i ON t.document_id = i.document_id WHERE {_WINDOW_SQL}")
def report_items(spark, sf_dir):
    return report.window_items(_invoices(spark, sf_dir), _rows(spark, sf_dir, ITEMS), *_window()).select("document_id", "line", "description", F.col("line_total").cast("double").alias("line_total"))


@_query(f"WITH i AS (SELECT status FROM ({INVOICES}) WHERE {_WINDOW_SQL}), d AS (SELECT count(*) AS n FROM {{events}}) SELECT (SELECT count(*) FROM i) + d.n AS total, (SELECT count(*) FROM i WHERE status = 'success') AS success, (SELECT count(*) FROM i WHERE status = 'needs_review') AS needs_review, (SELECT count(*) FROM i WHERE status = 'failed') AS failed, d.n AS duplicates, TRUE AS adds_up FROM d")
def report_counts(spark, sf_dir):
    rows = _invoices(spark, sf_dir).where(report.in_window("processed_at", *_window()))
    return report.counters(rows, _rows(spark, sf_dir, DUPLICATES))


@_query(f"SELECT status, count(*) AS n FROM ({INVOICES}) GROUP BY status")
def status_counts(spark, sf_dir):
    return report.status_counts(_invoices(spark, sf_dir))


@_query(f"SELECT CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_amount FROM ({INVOICES}) WHERE {_WINDOW_SQL}")
def report_financial(spark, sf_dir):
    rows = _invoices(spark, sf_dir).where(report.in_window("processed_at", *_window()))
    return report.invoiced_amount(rows).select(F.col("total_amount").cast("double").alias("total_amount"))


@_query(f"SELECT currency, CAST(sum(total_amount) AS DOUBLE) AS total_amount, count(*) AS n FROM ({INVOICES}) GROUP BY currency")
def report_currencies(spark, sf_dir):
    return report.amount_by_currency(_invoices(spark, sf_dir)).select("currency", F.col("total_amount").cast("double").alias("total_amount"), "n")


@_query(f"SELECT document_id, file_name FROM ({INVOICES}) WHERE status = 'failed' ORDER BY processed_at DESC, document_id LIMIT 20")
def report_top20(spark, sf_dir):
    return report.first_rows(_invoices(spark, sf_dir), "failed").select("document_id", "file_name")


@_query(f"SELECT count(*) AS n FROM ({INVOICES}) WHERE status IN ('failed', 'needs_review') AND review_reason IS NULL AND failure_reason IS NULL")
def reason_audit(spark, sf_dir):
    return report.missing_reasons(_invoices(spark, sf_dir))


@_query("SELECT event_type AS kind, count(*) AS n, count(*) FILTER (WHERE user_id % 2 = 0) AS n_even FROM {events} WHERE ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-20' GROUP BY event_type")
def log_window(spark, sf_dir):
    rows = _rows(spark, sf_dir, "SELECT event_type AS kind, user_id, CAST(ts AS TIMESTAMP) AS start_time FROM {events}")
    rows = rows.where(report.in_window("start_time", F.lit("2024-01-08").cast("timestamp"), F.lit("2024-01-20").cast("timestamp")))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("user_id") % 2 == 0).alias("n_even"))


# Dashboard


@_query(f"SELECT i.document_id, coalesce(string_agg(CAST(t.line AS STRING) || ':' || t.description || ':' || CAST(t.line_total AS STRING), '|' ORDER BY t.line, t.description, t.line_total), '') AS listed FROM ({INVOICES}) i LEFT JOIN ({ITEMS}) t ON t.document_id = i.document_id GROUP BY i.document_id")
def nested_json(spark, sf_dir):
    rows = dashboard.nested(_invoices(spark, sf_dir).select("document_id"), _rows(spark, sf_dir, ITEMS))
    cells = F.transform("line_items", lambda x: F.concat_ws(":", x["line"].cast("string"), x["description"], x["line_total"].cast("string")))
    return rows.select("document_id", F.array_join(cells, "|").alias("listed"))


@_query(_SEARCH_SQL)
def search_page(spark, sf_dir):
    found = dashboard.search(_invoices(spark, sf_dir), "INV-1")
    return dashboard.page(found, 2, F.desc_nulls_last("processed_at"), F.col("document_id")).select("document_id", "invoice_number", "vendor_name")


@_query(f"SELECT greatest(1, CAST(ceil(count(*) / 10.0) AS BIGINT)) AS pages FROM ({INVOICES})")
def page_count(spark, sf_dir):
    return dashboard.page_count(_invoices(spark, sf_dir))


@_query(f"SELECT count(*) AS n_documents, CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_amount, count(*) FILTER (WHERE status = 'success') AS n_done FROM ({INVOICES})")
def kpis(spark, sf_dir):
    return dashboard.key_figures(_invoices(spark, sf_dir)).withColumn("total_amount", F.col("total_amount").cast("double"))


@_query(f"SELECT invoice_number, CAST(total_amount AS DOUBLE) AS total_amount FROM ({INVOICES})")
def chart(spark, sf_dir):
    return dashboard.chart(_invoices(spark, sf_dir)).withColumn("total_amount", F.col("total_amount").cast("double"))


@_query(f"SELECT document_id, invoice_number, CAST(total_amount AS STRING) AS total_amount FROM ({INVOICES}) WHERE document_id IN (1, 2, 3, 32)")
def lookup_by_id(spark, sf_dir):
    rows = dashboard.as_json(dashboard.nested(_invoices(spark, sf_dir).where("document_id in (1, 2, 3, 32)").select("document_id", "invoice_number", "total_amount"), _rows(spark, sf_dir, ITEMS)))
    return rows.select("document_id", F.get_json_object("json", "$.invoice_number").alias("invoice_number"), F.get_json_object("json", "$.total_amount").alias("total_amount"))
