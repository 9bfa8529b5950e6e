"""Folders as tables of files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.basic import suffix
from ..operators.intake import EXTENSIONS, file_hash, invalid_reason
from .images import verify
from .listing import contents, digests, listing

SKIP = ".gitkeep"


def list_files(spark: SparkSession, folder: str, with_content: bool = True) -> DataFrame:
    """path, file_name, length, modified and content of every file below a folder, at any depth, empty ones too.

    Tasks list folders and read contents.  Without content, ``examined`` reads files in chunks, and a batch reads the content of
    those files only that it recognises.
    """
    rows = listing(spark, folder).where(F.col("file_name") != SKIP)
    return contents(rows) if with_content else rows


def whole_image(content: Column, name: Column) -> Column:
    """Whether an image can be read to its end; null for other files and for those without content."""

    @F.pandas_udf("boolean")
    def check(data: pd.Series, extension: pd.Series) -> pd.Series:
        return pd.Series([verify(d, e) for d, e in zip(data, extension, strict=True)])

    extension = F.lower(suffix(name))
    return F.when(extension.isin(*EXTENSIONS) & (extension != ".pdf") & content.isNotNull(), check(content, extension))


def _image(content: bytes | None, extension: str) -> bool | None:
    """Whether an image is whole, null for other files; of no content only whether it would be looked at."""
    if extension not in EXTENSIONS or extension == ".pdf":
        return None
    return True if content is None else verify(content, extension)


def examined(files: DataFrame, decode: bool = True) -> DataFrame:
    """Adds file_hash and invalid_reason, and drops the content, so that only narrow rows move on.

    With ``decode`` an image must be whole; else its first bytes decide.  Files without a content column are read here, in chunks.
    """
    if "content" in files.columns:
        rows = files.withColumn("whole", whole_image(F.col("content"), F.col("file_name")) if decode else F.lit(None).cast("boolean"))
        rows = rows.withColumns({"file_hash": file_hash(F.col("content"), F.col("length")), "head": F.col("content")})
    else:
        rows = digests(files, _image if decode else None)
    reason = invalid_reason(F.col("file_name"), F.col("length"), F.col("head"))
    damaged = F.when(~F.coalesce("whole", F.lit(True)), "File is not a readable image")
    return rows.select("path", "file_name", "length", "file_hash", F.coalesce(reason, damaged).alias("invalid_reason"))
