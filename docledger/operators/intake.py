"""Intake of files: hashes, validity, duplicates within a batch and against what is stored, name clashes.

A batch is a table with path, file_name, length and either content (binary) or file_hash.  The decision for each file is
one row with its status (ready, failed or duplicate_skipped) and reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.basic import blank_to_null, stem, suffix
from .merge import carried, collated, packed, unpacked

# Accepted extensions, the first bytes of each kind, and the reasons.
EXTENSIONS = (".pdf", ".png", ".jpg", ".jpeg", ".tiff", ".tif")
MAGIC = {
    ".pdf": ("255044462D",),
    ".png": ("89504E470D0A1A0A",),
    ".jpg": ("FFD8FF",),
    ".jpeg": ("FFD8FF",),
    ".tiff": ("49492A00", "4D4D002A"),
    ".tif": ("49492A00", "4D4D002A"),
}
SAME_BATCH = "Duplicate file (hash already seen in current batch)"
STORED = "Duplicate file (hash already stored)"


def file_hash(content: Column, length: Column) -> Column:
    """SHA-256 in hex; an empty file has none."""
    return F.when(length > 0, F.sha2(content, 256))


def invalid_reason(name: Column, length: Column, content: Column | None = None, exists: Column | None = None) -> Column:
    """Why a file is refused, null if it is not. Extension comes before size, size before content."""
    ext = F.lower(suffix(name))
    reason = F.when(~exists, F.lit("File does not exist")).when(F.lit(False), "") if exists is not None else F.when(F.lit(False), "")
    reason = reason.when(~ext.isin(*EXTENSIONS), F.concat(F.lit("Unsupported file extension: "), ext)).when(length == 0, F.lit("File is empty"))
    if content is not None:
        head = F.hex(F.substring(content, 1, 8))
        known = F.lit(False)
        for e, starts in MAGIC.items():
            for s in starts:
                known = known | ((ext == e) & head.startswith(s))
        reason = reason.when(~known, F.when(ext == ".pdf", "File is not a readable PDF").otherwise("File is not a readable image"))
    return blank_to_null(reason)


def renamed(name: Column, hash_: Column) -> Column:
    """The name with eight digits of its hash before the extension."""
    return F.concat(stem(name), F.lit("_"), F.left(hash_, F.lit(8)), suffix(name))


def active(documents: DataFrame) -> DataFrame:
    """Stored documents that count when duplicates are looked for."""
    return documents.where("status <> 'failed'")


def stored_names(documents: DataFrame) -> DataFrame:
    """file_hash and the file name stored first under it."""
    return active(documents).where("file_hash is not null").groupBy("file_hash").agg(F.min_by("file_name", "document_id").alias("stored_name"))


def decide(files: DataFrame, documents: DataFrame | None = None, collation: str | None = None) -> DataFrame:
    """Adds status, reason, original_file and target_name to path, file_name, file_hash and invalid_reason.

    Only valid files take part in duplicate search.  The first path of a hash wins; a hash that is stored already makes
    every file of the batch a duplicate of the stored one.  Rows of one hash meet in one task, so the rows dealt are only
    the narrow ones of this table; contents stay behind.  Names are compared under ``collation``, byte for byte without one.
    """
    # Hashes go through every shuffle packed.
    rows = files.select("path", "file_name", "invalid_reason", packed(F.col("file_hash")).alias("digest"), (F.col("invalid_reason").isNull() & F.col("file_hash").isNotNull()).alias("valid"))
    # The winner of each hash by aggregation, which combines before the shuffle, however many copies there are.
    winners = rows.where("valid").groupBy("digest").agg(F.min(F.struct("path", "file_name")).alias("winner"))
    rows = rows.join(winners, "digest", "left")
    if documents is not None:
        rows = rows.join(stored_names(documents).select(packed(F.col("file_hash")).alias("digest"), "stored_name"), "digest", "left")
        taken = active(documents).select(collated(F.col("file_name"), collation).alias("taken_name"), F.lit(True).alias("name_taken")).distinct()
        rows = rows.join(taken, collated(F.col("file_name"), collation) == F.col("taken_name"), "left").drop("taken_name")
    else:
        rows = rows.withColumns({"stored_name": F.lit(None).cast("string"), "name_taken": F.lit(None).cast("boolean")})
    rows = rows.withColumn("file_hash", unpacked(F.col("digest")))
    is_stored = F.col("valid") & F.col("stored_name").isNotNull()
    is_copy = F.col("valid") & (F.col("path") != F.col("winner.path"))
    status = F.when(~F.col("valid"), "failed").when(is_stored | is_copy, "duplicate_skipped").otherwise("ready")
    reason = (
        F.when(F.col("invalid_reason").isNotNull(), F.col("invalid_reason"))
        .when(~F.col("valid"), "Could not compute file hash")
        .when(is_stored, STORED)
        .when(is_copy, SAME_BATCH)
    )
    original = F.when(is_stored, F.col("stored_name")).when(is_copy, F.col("winner.file_name"))
    target = F.when(F.coalesce("name_taken", F.lit(False)), renamed(F.col("file_name"), F.col("file_hash"))).otherwise(F.col("file_name"))
    return rows.select(
        "path",
        "file_name",
        "file_hash",
        status.alias("status"),
        reason.alias("reason"),
        original.alias("original_file"),
        F.when(status == "ready", target).alias("target_name"),
    )


def ready(decided: DataFrame) -> DataFrame:
    return decided.where("status = 'ready'")


def last_of_name(decided: DataFrame) -> DataFrame:
    """Of ready files with one target name the one with the last path stays."""
    w = Window.partitionBy("target_name").orderBy(F.col("path").desc())
    return carried(decided, lambda rows: rows.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth"))


def run_logs(decided: DataFrame, results: DataFrame, started: Column, ended: Column) -> DataFrame:
    """One finished log row for each file: what intake decided, for a ready file what became of it.

    ``results`` has target_name, success and error of the files that were processed.
    """
    done = results.groupBy("target_name").agg(F.max(F.struct(~F.col("success"), "error")).alias("r"))
    failed, error = F.col("r.col1"), F.col("r.error")
    rows = decided.join(done, "target_name", "left")
    ready = F.col("status") == "ready"
    return rows.select(
        "file_name",
        started.alias("start_time"),
        ended.alias("end_time"),
        F.when(ready & F.coalesce(failed, F.lit(True)), "failed").when(ready, "success").otherwise(F.col("status")).alias("status"),
        F.when(ready, F.when(F.col("r").isNull(), "File was not processed").otherwise(F.when(failed, error))).otherwise(F.col("reason")).alias("error_message"),
    )


def duplicate_audit(files: DataFrame) -> DataFrame:
    """Hashes that more than one file has; files without a hash form one group."""
    return files.groupBy("file_hash").agg(F.count(F.lit(1)).alias("n_files")).where("n_files > 1")


def free_names(names: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Gives every path a name nobody has: path, file_name, free_name.

    In path order the first file of a name keeps it, unless the name is in ``taken``. The others get ``stem_1``, ``stem_2`` and so
    on; a number is left out if that name is taken or is a name of the batch itself. The j-th file in need gets the j-th free
    number: with the numbers in use in order, u1 < u2 < ..., there are u_i - i free ones before u_i, so one running count over
    both kinds of rows finds it.
    """
    w = Window.partitionBy("file_name").orderBy("path")
    rows = names.select("path", "file_name", (F.row_number().over(w)).alias("nth"))
    used = names.select("file_name")
    if taken is not None:
        mark = taken.select("file_name").distinct().withColumn("used", F.lit(1))
        rows = rows.join(mark, "file_name", "left").withColumn("nth", F.col("nth") + F.coalesce("used", F.lit(0))).drop("used")
        used = used.unionByName(taken.select("file_name"))
    waiting = rows.where("nth > 1").select("path", "file_name", (F.col("nth") - 1).cast("long").alias("j"))
    # Names in use that end in a number, by the name they would be made of.
    shape = r"(?s)\A(.*)_([1-9][0-9]{0,17})\z"
    root, number = F.regexp_extract(stem(F.col("file_name")), shape, 1), F.regexp_extract(stem(F.col("file_name")), shape, 2)
    numbers = used.distinct().where(stem(F.col("file_name")).rlike(shape)).select(F.concat(root, suffix(F.col("file_name"))).alias("file_name"), number.cast("long").alias("u"))
    numbers = numbers.join(waiting.select("file_name").distinct(), "file_name", "left_semi")
    before = numbers.select("file_name", (F.col("u") - F.row_number().over(Window.partitionBy("file_name").orderBy("u"))).alias("j"), F.lit(1).alias("in_use"), F.lit(None).cast("string").alias("path"))
    # A key of its own makes the engine deal the rows anew: both sides are dealt by name, and taken together part by part,
    # after adaptive execution has joined parts of one side, names would be torn apart.
    both = waiting.select("file_name", "j", F.lit(0).alias("in_use"), "path").unionByName(before).withColumn("key", F.concat("file_name", F.lit("")))
    # A number in use counts for the files with a larger j only.
    count = F.coalesce(F.sum("in_use").over(Window.partitionBy("key").orderBy("j").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = both.withColumn("k", F.col("j") + count).where("in_use = 0").select("path", "file_name", "k")
    name = F.col("file_name")
    made = F.concat(stem(name), F.lit("_"), F.col("k").cast("string"), suffix(name))
    first = rows.where("nth = 1").select("path", "file_name", name.alias("free_name"))
    return first.unionByName(found.select("path", "file_name", made.alias("free_name")))
