"""Exports: JSON by document, the dashboard's file, workbooks, mail, files moved after a commit."""

from __future__ import annotations

import os
import shutil
import smtplib
import zipfile
from collections.abc import Iterator
from email.message import EmailMessage
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.basic import base_name
from ..operators import dashboard, intake


def write_json(documents: DataFrame, items: DataFrame, folder: str) -> None:
    """One JSON line for each document, named ``invoice_001`` and so on in its key ``name``; as many files as Spark has tasks.

    ``write_json_files`` makes a file for each document.
    """
    rows = dashboard.as_json(dashboard.nested(documents, items))
    named = F.concat(F.lit('{"name":"'), F.format_string("invoice_%03d", "document_id"), F.lit('","document":'), "json", F.lit("}"))
    rows.select(named.alias("value")).write.mode("overwrite").text(folder)


def write_json_files(documents: DataFrame, items: DataFrame, folder: str) -> int:
    """A file ``invoice_001.json`` for each document, written by the executors. Returns how many."""
    rows = dashboard.as_json(dashboard.nested(documents, items)).select(F.format_string("invoice_%03d.json", "document_id").alias("name"), F.col("json").alias("text"))
    return write_text_files(rows, folder)


def write_text_files(rows: DataFrame, folder: str) -> int:
    """A file for each row of name and text, names relative to the folder. A file that is there is replaced. Returns how many."""

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        n = 0
        for batch in stream:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{base}/{name}"
                fs.create_dir(os.path.dirname(path), recursive=True)
                with fs.open_output_stream(path) as f:
                    f.write((text or "").encode("utf-8"))
                n += 1
        yield pa.record_batch({"n": pa.array([n], pa.int64())})

    return rows.select("name", "text").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]


def write_dashboard(documents: DataFrame, items: DataFrame, folder: str) -> None:
    """The dashboard's single file: all documents, newest first. Rows are sorted over the cluster and written by one task as they come."""
    rows = dashboard.as_json(dashboard.nested(documents, items)).join(documents.select("document_id", "processed_at"), "document_id")
    order = [F.desc_nulls_last("processed_at"), F.desc("document_id")]
    lines = rows.select(F.lit(1).alias("part"), "processed_at", "document_id", "json").repartitionByRange(*order).sortWithinPartitions(*order).select("json")

    def joined(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = '{"documents":['
        for batch in stream:
            for text in batch.column(0).to_pylist():
                yield pa.record_batch({"value": pa.array([lead + text])})
                lead = ","
        yield pa.record_batch({"value": pa.array([("" if lead == "," else lead) + "]}"])})

    # Ranges are read in order by the one task that writes the file.
    lines.coalesce(1).mapInArrow(joined, "value string").write.mode("overwrite").option("lineSep", "\n").text(folder)


def write_workbook(sheets: dict[str, DataFrame], path: str) -> None:
    """A workbook with one sheet for each table. Rows stream through the driver, a sheet at a time."""
    names = list(sheets)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        out.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{parts}</Types>')
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        out.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        listed = "".join(f'<sheet name="{escape(n[:31])}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        out.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        out.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}">{rels}</Relationships>')
        for k, n in enumerate(names, 1):
            with out.open(f"xl/worksheets/sheet{k}.xml", "w") as f:
                f.write(f'{head}<worksheet xmlns="{main}"><sheetData>'.encode())
                f.write(_row(sheets[n].columns))
                for r in sheets[n].toLocalIterator():
                    f.write(_row(r))
                f.write(b"</sheetData></worksheet>")


def _row(values) -> bytes:
    cells = []
    for v in values:
        if v is None:
            cells.append("<c/>")
        elif isinstance(v, (int, float)) and not isinstance(v, bool):
            cells.append(f"<c><v>{v}</v></c>")
        else:
            text = "".join(ch for ch in str(v) if ch >= " " or ch in "\n\t")
            cells.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
    return f"<row>{''.join(cells)}</row>".encode()


def export_workbook(documents: DataFrame, items: DataFrame, path: str) -> None:
    write_workbook({"Invoices": documents, "Line Items": items, "Needs Review": documents.where("status = 'needs_review'")}, path)


def report_workbook(report, path: str) -> None:
    rows = report.invoices
    write_workbook({"invoices": rows, "line_items": report.line_items, "needs_review": rows.where("status = 'needs_review'"), "failed": rows.where("status = 'failed'"), "duplicates": report.duplicates}, path)


class Mailer:
    """Sends the daily summary. With ``dry_run`` nothing is sent; if sending fails the page is saved beside the workbook."""

    def __init__(self, config, dry_run: bool = False, smtp=smtplib.SMTP):
        self.config, self.dry_run, self.smtp = config, dry_run, smtp

    def send(self, subject: str, page: str, workbook: str, fallback: str) -> bool:
        if self.dry_run:
            return False
        message = EmailMessage()
        message["Subject"], message["From"], message["To"] = subject, self.config.mail_from or "", self.config.mail_to or ""
        message.set_content("The report is in the HTML part.")
        message.add_alternative(page, subtype="html")
        with open(workbook, "rb") as f:
            message.add_attachment(f.read(), maintype="application", subtype="vnd.openxmlformats-officedocument.spreadsheetml.sheet", filename=os.path.basename(workbook))
        try:
            with self.smtp(self.config.smtp_host, self.config.smtp_port) as server:
                server.starttls()
                if self.config.smtp_user:
                    server.login(self.config.smtp_user, self.config.smtp_password or "")
                server.send_message(message)
            return True
        except Exception:
            with open(fallback, "w", encoding="utf-8") as f:
                f.write(page)
            return False


def move_file(path: str, folder: str) -> str:
    """Moves a local file after a commit; a name that is taken gets _1, _2 and so on."""
    os.makedirs(folder, exist_ok=True)
    name, ext = os.path.splitext(os.path.basename(path))
    target, k = os.path.join(folder, name + ext), 0
    while os.path.exists(target):
        k += 1
        target = os.path.join(folder, f"{name}_{k}{ext}")
    return shutil.move(path, target)


def file_system(uri: str):
    """The file system of a path or URI, and the path in it; names may hold any character."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    scheme, _, rest = uri.partition("://")
    authority, _, path = rest.partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{path}"


def move_files(files: DataFrame, folder: str) -> int:
    """Moves the files named in ``path`` into a folder, under names that are free there; the executors move them.

    A file that is gone already is left out, so the call can be repeated. Returns how many were moved.
    """
    spark = files.sparkSession
    system, base = file_system(folder)
    system.create_dir(base, recursive=True)
    there = spark.createDataFrame([(x.base_name,) for x in system.get_file_info(fs.FileSelector(base))], "file_name string")
    names = intake.free_names(files.select("path", base_name(F.col("path")).alias("file_name")), there).select("path", "free_name")

    def move(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, target = file_system(folder)
        n = 0
        for batch in stream:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, at = file_system(path)
                if source.get_file_info(at).type == fs.FileType.NotFound:
                    continue
                if source.type_name == to.type_name:
                    to.move(at, f"{target}/{name}")
                else:
                    fs.copy_files(at, f"{target}/{name}", source_filesystem=source, destination_filesystem=to)
                    source.delete_file(at)
                n += 1
        yield pa.record_batch({"n": pa.array([n], pa.int64())})

    return names.mapInArrow(move, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
