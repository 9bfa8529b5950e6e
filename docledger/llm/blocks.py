"""Blocks of documents, and the two-way exchange between blocks and content buckets.

Exact matching over a whole corpus needs every equal piece of text to meet somewhere, and the verdict to come back to
the document.  Shipping one row per piece would move several times the corpus.  Here documents are first dealt into
blocks of a few MB.  A block reduces its pieces to its *distinct* keys, packs those of one bucket into one binary row and
sends it to that bucket.  The bucket answers with one bit per key in the same order.  The block recomputes its keys and
reads the bits.  The exchange that deals documents into blocks appears several times in one plan and is run once.

Copies inside a block collapse before the shuffle, so a passage that a third of all documents hold costs one key per
block, and no task ever holds all of its occurrences.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import numbered

#: Bytes of text in a block, about.
BLOCK_BYTES = 8 << 20
#: Bytes of text handled at once inside a block.
CHUNK_BYTES = 1 << 20


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text)).alias("n")).head()["n"] or 0


def parts(docs: DataFrame, total: int, each: int) -> int:
    """How many parts of about ``each`` bytes; as many as there are cores at least."""
    return max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(total / each))


def in_blocks(docs: DataFrame, n_blocks: int, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns block, doc_id, text and those in ``keep``. Rows that share a doc_id, or have none, are spread by their texts."""
    block = F.pmod(F.xxhash64("doc_id", F.col(text)), F.lit(n_blocks)).cast("int")
    return numbered(docs, keep, block.alias("block"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).repartition(n_blocks, "block")


def by_doc_id(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """A block in ascending doc_id order, and the ids (null: the smallest long)."""
    ids = table.column("doc_id").fill_null(-(2**63)).to_numpy()
    order = np.argsort(ids, kind="stable")
    return table.take(pa.array(order)), ids[order]


def planes(values: np.ndarray) -> bytes:
    """The bytes of an integer array, all first bytes, then all second bytes, and so on: high zero bytes compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def bucket_runs(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each run in a sorted array."""
    if not len(bucket):
        return []
    cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip([0, *cut], [*cut, len(bucket)], strict=True)]


def group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts, of arrays sorted together."""
    n = len(sorted_keys[0])
    if not n:
        return np.zeros(0, np.int64)
    differs = np.zeros(n, bool)
    differs[0] = True
    for k in sorted_keys:
        differs[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(differs)
