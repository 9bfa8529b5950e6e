"""Text recognition and image preparation behind an interface.

A backend is any object with ``pages(content, extension)`` and ``read(page)``.  ``ImageBackend`` reads images, prepares them by
``sources.images`` and hands each to a recogniser; with pytesseract installed that is the default.  PDFs need pdf2image.
``SidecarBackend`` takes the content itself as text, which is what tests and text-only batches use.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.basic import suffix
from . import images

RESULT = "struct<success:boolean,text:string,error:string>"
#: Resolution of the pages of a PDF.
DPI = 300


class Backend(Protocol):
    def pages(self, content: bytes, extension: str) -> list: ...

    def read(self, page) -> str: ...


def _tesseract(image: np.ndarray) -> str:
    import pytesseract
    from PIL import Image

    return pytesseract.image_to_string(Image.fromarray(image), lang="eng")


class ImageBackend:
    """Images as arrays; each is prepared and recognised."""

    def __init__(self, recognise: Callable[[np.ndarray], str] = _tesseract, prepare: Callable[[np.ndarray], np.ndarray] = images.prepare):
        self.recognise, self.prepare = recognise, prepare

    def pages(self, content: bytes, extension: str) -> list[np.ndarray]:
        if extension == ".pdf":
            try:
                from pdf2image import convert_from_bytes
            except ImportError:
                return []
            return [np.array(page) for page in convert_from_bytes(content, dpi=DPI)]
        if extension == ".png":
            return [images.read_png(content)]
        if content[:2] in (b"P5", b"P6"):
            return [images.read_pnm(content)]
        import io

        from PIL import Image

        return [np.array(Image.open(io.BytesIO(content)).convert("RGB"))]

    def read(self, page: np.ndarray) -> str:
        return self.recognise(self.prepare(page)).strip()


class SidecarBackend:
    """Form feeds separate pages."""

    def pages(self, content: bytes, extension: str) -> list[str]:
        return content.decode("utf-8", "replace").split("\f")

    def read(self, page: str) -> str:
        return page.strip()


def recognise(backend: Backend, content: bytes | None, extension: str) -> tuple[bool, str | None, str | None]:
    """Success, text and error of one file; never raises."""
    try:
        pages = backend.pages(content or b"", extension)
        if not pages:
            return False, None, "no page could be read"
        texts = []
        for page in pages:
            texts.append(backend.read(page))
        if extension == ".pdf":
            texts = [f"--- Page {k} ---\n{t}" for k, t in enumerate(texts, 1)]
        text = "\n\n".join(texts)
        return (True, text, None) if text.strip() else (False, None, "no text was found")
    except Exception as e:  # a damaged file must not end the batch
        return False, None, f"{type(e).__name__}: {e}"


def ocr(files: DataFrame, backend: Backend | None = None) -> DataFrame:
    """Adds ocr (success, text, error) to files with content and file_name, and drops the content."""
    backend = backend or SidecarBackend()

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for content, extension in batches:
            yield pd.DataFrame([recognise(backend, c, e) for c, e in zip(content, extension, strict=True)], columns=["success", "text", "error"])

    udf = F.pandas_udf(run, RESULT)
    return files.withColumn("ocr", udf("content", F.lower(suffix(F.col("file_name"))))).drop("content")
