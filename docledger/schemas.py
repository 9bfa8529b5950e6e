"""Schemas of the stored tables and of the records between operators."""

from __future__ import annotations

ITEM = "struct<description:string,quantity:double,unit_price:double,line_total:double>"
PARSED = f"invoice_number string, invoice_date string, vendor_name string, total_amount double, currency string, line_items array<{ITEM}>, confidence string"

DOCUMENTS = (
    "document_id long, file_name string, file_hash string, invoice_number string, invoice_date date, vendor_name string, "
    "total_amount decimal(10,2), currency string, status string, ocr_text_path string, processed_at timestamp, "
    "review_reason string, failure_reason string, original_file string, updated_at timestamp"
)
LINE_ITEMS = "line_item_id long, document_id long, description string, quantity decimal(18,4), unit_price decimal(10,2), line_total decimal(10,2)"
LOGS = "log_id long, file_name string, start_time timestamp, end_time timestamp, status string, error_message string"
DUPLICATES = "duplicate_id long, file_name string, file_hash string, original_file string, skipped_at timestamp"
OCR_TEXTS = "ocr_text_path string, file_name string, text string"
VERSIONS = "version int, applied_at timestamp"

TABLES = {
    "invoice_documents": DOCUMENTS,
    "invoice_line_items": LINE_ITEMS,
    "processing_logs": LOGS,
    "duplicate_files": DUPLICATES,
    "ocr_texts": OCR_TEXTS,
    "schema_version": VERSIONS,
}
#: Tables that a store derives from documents: where a name or a hash is, which documents hold three letters, and sums by day, status and currency.
DERIVED = {
    "document_keys": "kind string, key string, document_id long, file_name string, file_hash string, status string, period date, bucket int, alive boolean",
    "document_trigrams": "trigram string, high long, period date, bucket int, low array<int>",
    "document_cells": "day date, status string, currency string, n long, total_amount decimal(38,2)",
}
#: How a table is cut into parts: by what, in the order of folders. ``period`` is the first day of the store's unit of time.
LAYOUT = {
    "invoice_documents": "period date, bucket int",
    "invoice_line_items": "period date, bucket int",
    "processing_logs": "period date",
    "duplicate_files": "period date",
    "document_keys": "prefix string",
    "document_trigrams": "slot int",
}
#: What rows are looked up by; files are sorted by it, so that their statistics keep others out.
SOUGHT = {"document_keys": "key", "document_trigrams": "trigram"}
#: The time that decides a row's period; an item has the period of its document.
TIMES = {"invoice_documents": "processed_at", "processing_logs": "start_time", "duplicate_files": "skipped_at"}
SCHEMA_VERSION = 4

#: The key of each table, and what its columns refer to.
KEYS = {
    "invoice_documents": ("document_id",),
    "invoice_line_items": ("line_item_id",),
    "processing_logs": ("log_id",),
    "duplicate_files": ("duplicate_id",),
    "ocr_texts": ("ocr_text_path", "file_name"),
    "schema_version": ("version",),
}
#: Ids that a store numbers itself.
IDS = {"invoice_documents": "document_id", "invoice_line_items": "line_item_id", "processing_logs": "log_id", "duplicate_files": "duplicate_id"}
REFERENCES = {("invoice_line_items", "document_id"): ("invoice_documents", "document_id")}
