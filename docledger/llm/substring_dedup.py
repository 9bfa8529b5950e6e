"""Removal of word passages that a document with a smaller id already holds.

Method: difference-cover anchors.  Positions of a document are taken modulo 7; windows of 7 words are hashed only at
residues 0, 1 and 3.  Every difference modulo 7 is a difference of two of these residues, so for any two equal passages
of 13 words there is a shift under 7 at which both have an anchor: a long match always shares an aligned anchor.
Anchors found in two places are then extended: each 13-word window around such an anchor is compared with all others of
its kind, and the smallest doc_id that starts it is found.

Definition.  Words are runs of bytes other than space and the controls 0x09-0x0D, unchanged.  A window is ``WINDOW``
consecutive words of one document.  A word is removed if a window covers it whose word sequence also starts in a document
with a smaller doc_id; windows are judged on the input.  Null text has no words.  Rows that share a doc_id are neither
smaller nor larger than each other.  A null doc_id is smaller than every other.  Windows are equal if two independent hashes of
their words, one of 64 bits and one of 32, are.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B
from .kernel import PLAIN_WORD, Chunk, cover, segment_ids, slices, texts_of, window_hash

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
_LOW40 = np.uint64((1 << 40) - 1)

_KEYS = "bucket int, block int, n int, keys binary, more binary"
_FLAGS = "block int, stage int, bucket int, n int, flags binary"


class _Words:
    """The words of one block, in doc_id order."""

    def __init__(self, table: pa.Table):
        table, self.ids = B.by_doc_id(table)
        self.texts = texts_of(table.column("text"))
        self.doc_ids = table.column("doc_id")
        hashes, others, firsts, n = [], [], [], 0
        for a, b in slices(self.texts, B.CHUNK_BYTES):
            chunk = Chunk(self.texts[a:b])
            start, end, first = chunk.words(PLAIN_WORD)
            one, two = chunk.word_hashes(start, end, 2)
            hashes.append(one)
            others.append(two)
            firsts.append(first[:-1] + n)
            n += len(start)
        self.hash, self.other = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (hashes, others))
        self.first = np.concatenate([*firsts, [n]]).astype(np.int64)
        self.n = n
        self.doc = segment_ids(self.first, n)
        left = self.first[self.doc + 1] - np.arange(n) if n else np.zeros(0, np.int64)
        self.starts_window = left >= WINDOW
        self.starts_anchor = left >= PERIOD

    def anchors(self, n_buckets: int):
        """Positions of the anchors, their distinct keys in bucket order, and the key of each anchor."""
        at = np.arange(self.n) - self.first[self.doc]
        long = (np.diff(self.first) >= WINDOW)[self.doc] if self.n else np.zeros(0, bool)
        where = np.flatnonzero(long & self.starts_anchor & np.isin(at % PERIOD, COVER))
        h = window_hash(self.hash, PERIOD)[where]
        key = ((h >> np.uint64(40)) % np.uint64(n_buckets)) << np.uint64(40) | (h & _LOW40)
        keys, which = np.unique(key, return_inverse=True)
        return where, keys, which

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Windows that have one of these anchors among their first PERIOD words' starts."""
        reach = cover(np.maximum(shared - (PERIOD - 1), 0), PERIOD, self.n)
        return np.flatnonzero(reach & self.starts_window)

    def windows(self, where: np.ndarray, n_buckets: int):
        """Distinct windows in bucket order: their two hashes, the first document of each, and the number of each window."""
        a, b = window_hash(self.hash, WINDOW, 0)[where], window_hash(self.other, WINDOW, 1)[where] >> np.uint64(32)
        bucket = (a >> np.uint64(40)) % np.uint64(n_buckets)
        order = np.lexsort((b, a, bucket))
        heads = B.group_starts(a[order], b[order])
        which = np.empty(len(order), np.int64)
        which[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
        first = order[heads]  # the sort is stable and positions ascend with doc_id
        return bucket[first].astype(np.int64), a[first], b[first].astype(np.uint32), self.ids[self.doc[where[first]]], which


def _flags(table: pa.Table, stage: int, total: int, each: int = 1) -> np.ndarray:
    """The answers of one stage as one array, in bucket order; ``each`` bits a key."""
    rows = sorted((b, n, f) for s, b, n, f in zip(*(table.column(c).to_pylist() for c in ("stage", "bucket", "n", "flags")), strict=True) if s == stage)
    got = np.concatenate([np.zeros(0, bool), *(B.unpack_bits(f, each * n) for _, n, f in rows)])
    if len(got) != total:
        raise RuntimeError(f"a block got {len(got)} answers for {total} keys")
    return got


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [x.strip().split() for x in schema.split(",")]
    return pa.table([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def substring_dedup(docs: DataFrame, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """One row for each input row: doc_id, n_words, n_removed, kept (the words left, joined by one space; binary)."""
    total = B.text_bytes(docs)
    n_blocks, n_buckets = B.parts(docs, total, block_bytes), B.parts(docs, total, 2 * block_bytes)
    blocks = B.in_blocks(docs, n_blocks)

    def anchor_keys(table: pa.Table) -> pa.Table:
        block, w = table.column("block")[0].as_py(), _Words(table)
        _, keys, _ = w.anchors(n_buckets)
        low = (keys & _LOW40).view(np.uint8).reshape(-1, 8)[:, :5]
        return _rows(_KEYS, [(k, block, b - a, np.ascontiguousarray(low[a:b].T).tobytes(), b"") for k, a, b in B.bucket_runs((keys >> np.uint64(40)).astype(np.int64))])

    def local_shared(w: _Words, which: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
        """Keys with anchors in two documents of the block."""
        order = np.argsort(which, kind="stable")
        heads = np.searchsorted(which[order], np.arange(n + 1))
        doc = w.ids[w.doc[where[order]]]
        return doc[heads[:-1]] != doc[heads[1:] - 1] if n else np.zeros(0, bool)

    def meet_anchors(table: pa.Table) -> pa.Table:
        bucket, ns = table.column("bucket")[0].as_py(), table.column("n").to_pylist()
        parts = [np.ascontiguousarray(np.vstack([np.frombuffer(x, np.uint8).reshape(5, -1), np.zeros((3, n), np.uint8)]).T).view(np.uint64).ravel() for x, n in zip(table.column("keys").to_pylist(), ns, strict=True)]
        _, which, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = np.split((count > 1)[which], np.cumsum(ns)[:-1])
        return _rows(_FLAGS, [(b, 1, bucket, n, B.pack_bits(f)) for b, n, f in zip(table.column("block").to_pylist(), ns, shared, strict=True)])

    def candidates(w: _Words, answers: pa.Table) -> np.ndarray:
        where, keys, which = w.anchors(n_buckets)
        shared = _flags(answers, 1, len(keys)) | local_shared(w, which, where, len(keys))
        return w.candidates(where[shared[which]])

    def window_keys(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _rows(_KEYS, [])
        block, w = table.column("block")[0].as_py(), _Words(table)
        bucket, a, b, first, _ = w.windows(candidates(w, answers), n_buckets)
        return _rows(_KEYS, [(k, block, t - f, a[f:t].tobytes() + b[f:t].tobytes(), B.planes(first[f:t])) for k, f, t in B.bucket_runs(bucket)])

    def meet_windows(table: pa.Table) -> pa.Table:
        bucket, ns, keys = table.column("bucket")[0].as_py(), table.column("n").to_pylist(), table.column("keys").to_pylist()
        a = np.concatenate([np.frombuffer(x, np.uint64, n) for x, n in zip(keys, ns, strict=True)])
        b = np.concatenate([np.frombuffer(x, np.uint32, n, 8 * n) for x, n in zip(keys, ns, strict=True)])
        first = np.concatenate([B.unplanes(x, np.int64) for x in table.column("more").to_pylist()])
        order = np.lexsort((b, a))
        heads = B.group_starts(a[order], b[order])
        least = np.minimum.reduceat(first[order], heads)
        late = np.empty(len(a), bool)
        late[order] = np.repeat(least, np.diff(np.append(heads, len(a)))) < first[order]
        return _rows(_FLAGS, [(k, 2, bucket, n, B.pack_bits(f)) for k, n, f in zip(table.column("block").to_pylist(), ns, np.split(late, np.cumsum(ns)[:-1]), strict=True)])

    out = "doc_id long, n_words long, n_removed long, kept binary"

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _rows(out, [])
        w = _Words(table)
        where = candidates(w, answers)
        _, a, _, first, which = w.windows(where, n_buckets)
        late = _flags(answers, 2, len(a))
        removed = cover(where[late[which] | (w.ids[w.doc[where]] > first[which])], WINDOW, w.n)
        gone = np.concatenate([[0], np.cumsum(removed)])[w.first]
        kept = []
        for i, t in enumerate(w.texts):
            words = t.split()
            if gone[i] != gone[i + 1]:
                words = [x for x, r in zip(words, removed[w.first[i] : w.first[i + 1]].tolist(), strict=True) if not r]
            kept.append(b" ".join(words))
        return pa.table([w.doc_ids.combine_chunks(), pa.array(np.diff(w.first)), pa.array(np.diff(gone).astype(np.int64)), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    shared = blocks.groupBy("block").applyInArrow(anchor_keys, _KEYS).groupBy("bucket").applyInArrow(meet_anchors, _FLAGS).repartition(n_blocks, "block")
    late = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(window_keys, _KEYS).groupBy("bucket").applyInArrow(meet_windows, _FLAGS).repartition(n_blocks, "block")
    return blocks.groupBy("block").cogroup(shared.unionByName(late).groupBy("block")).applyInArrow(cut, out)
