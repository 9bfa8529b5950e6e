"""Removal of byte passages that occur earlier in the corpus, by suffix arrays of content shards.

Method: suffix arrays by induced sorting and permuted common prefixes (``suffix_array``).  A suffix array finds repeats
only within its own text, so shards are made of content rather than of documents: each window of ``WINDOW`` bytes belongs
to the smallest hash among the ``KMER``-byte strings inside it (its minimiser), equal windows have equal minimisers, and
the shard of a window is a function of its minimiser.  Consecutive windows with one minimiser form a segment.  Minimisers
that occur in one place only are set aside in a first exchange; the segments of the others go to their shard, which sorts
the distinct ones with one suffix array.  Neighbours in the array with a common prefix of a whole window are equal
windows, and the earliest stays.

A minimiser that stands in more than ``HOT`` distinct segments, such as a line that very many documents hold amid text of
their own, would gather a shard that grows with the corpus.  Its segments are cut into their windows, and each window, equal
ones of a block once, goes to the shard that its own hash names, where equal bytes meet.

Hashes only choose shards; bytes decide what is equal.

Definition.  Texts are UTF-8 bytes, null is empty, matches never cross documents.  A byte is removed if a string of
``WINDOW`` bytes covers it that also starts earlier: in a row with a smaller doc_id, or in one with the same doc_id at an
earlier start.  Strings are judged on the input.  A null doc_id is smaller than every other.  Rows with one doc_id and the same
string at the same start both keep it.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B
from .columns import renamed
from .kernel import Chunk, RangeHash, slices, texts_of
from .substring_dedup import _FLAGS, _flags, _rows
from .suffix_array import permuted_common_prefixes, suffix_array

WINDOW = 100
KMER = 28
_SPAN = WINDOW - KMER + 1
#: Distinct segments that one minimiser may bring to a shard: about 3 MB of text.
HOT = 20_000
_LOW40 = np.uint64((1 << 40) - 1)
_MINIMISERS = "bucket int, block int, n int, keys binary, counts binary"
#: Kind 2: segments; kind 3: single windows of segments with hot minimisers.
_PIECES = "kind int, bucket int, block int, n int, lens binary, docs binary, starts binary, keys binary, bytes binary"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def _segments(texts: list[bytes]):
    """Of some documents: the document, start, length, minimiser and content hash of each segment."""
    chunk = Chunk(texts)
    n = len(chunk.buf)
    if not (chunk.len >= WINDOW).any():
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    hashed = RangeHash(chunk.buf)
    at = np.arange(n - KMER + 1)
    bits = np.uint64(max(20, n.bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    kmers = hashed(at, at + KMER)
    least = _sliding_min((kmers & ~low) | at.astype(np.uint64), _SPAN)  # the leftmost of equals
    where = (least & low).astype(np.int32 if n < 2**31 else np.int64)
    doc = np.repeat(np.arange(chunk.n), chunk.len + 1)[: len(where)]
    first = np.empty(len(where), bool)
    first[0] = True
    first[1:] = where[1:] != where[:-1]
    first[chunk.off[:-1][chunk.off[:-1] < len(where)]] = True
    valid = np.arange(len(where)) + WINDOW <= (chunk.off[1:] - 1)[doc]
    head = np.flatnonzero(first & valid)
    # A segment ends before the next head or after the last window of its document.
    last = np.append(head[1:], len(where)) - 1
    last = np.minimum(last, chunk.off[1:][doc[head]] - 1 - WINDOW)
    return doc[head], head - chunk.off[doc[head]], last - head + WINDOW, kmers[where[head]], hashed(head, last + WINDOW)


class _Block:
    """The segments of one block. ``rep`` is the earliest segment with the same bytes; only those have minimiser keys."""

    def __init__(self, table: pa.Table, n_buckets: int):
        table, self.ids = B.by_doc_id(table)
        self.table = table
        self.texts, self.doc_ids = texts_of(table.column("text")), table.column("doc_id")
        got = []
        for a, b in slices(self.texts, B.CHUNK_BYTES):
            doc, *rest = _segments(self.texts[a:b])
            got.append([doc + a, *rest])
        self.doc, self.start, self.len, minimiser, content = (np.concatenate(x) for x in zip(*got, strict=True)) if got else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
        n = len(self.doc)
        ids = self.ids[self.doc] if n else np.zeros(0, np.int64)
        order = np.lexsort((self.start, ids, self.len, content))
        heads = B.group_starts(content[order], self.len[order])
        self.rep = np.empty(n, np.int64)
        self.rep[order] = np.repeat(order[heads], np.diff(np.append(heads, n)))
        # Of segments with one hash the bytes decide.
        texts, doc, start, length = self.texts, self.doc.tolist(), self.start.tolist(), self.len.tolist()
        others: dict[bytes, int] = {}
        for i in order[self.rep[order] != order].tolist():
            r = int(self.rep[i])
            own = texts[doc[i]][start[i] : start[i] + length[i]]
            if not texts[doc[r]].startswith(own, start[r]):
                self.rep[i] = others.setdefault(own, i)
        self.later = (ids != ids[self.rep]) | (self.start != self.start[self.rep])
        own = order[self.rep[order] == order]
        key = ((minimiser[own] >> np.uint64(40)) % np.uint64(n_buckets)) << np.uint64(40) | (minimiser[own] & _LOW40)
        by = np.argsort(key, kind="stable")
        #: Distinct segments in the order of their keys.
        self.own = own[by]
        key = key[by]
        heads = B.group_starts(key)
        self.keys = key[heads]
        size = np.diff(np.append(heads, len(key)))
        self.which = np.repeat(np.arange(len(heads)), size)
        self.count = size

    def _pick(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Which distinct segments have a minimiser that occurs elsewhere too, and which of those a hot one."""
        told = _flags(answers, 1, 2 * len(self.keys), 2).reshape(-1, 2)
        return (told[:, 0] | (self.count > 1))[self.which], told[:, 1][self.which]

    def sent(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The segments that go to shards, their buckets, and the other bits of their minimisers' keys."""
        shared, hot = self._pick(answers)
        pick = np.flatnonzero(shared & ~hot)
        keys = self.keys[self.which[pick]]
        return self.own[pick], (keys >> np.uint64(40)).astype(np.int64), keys & _LOW40

    def hot_windows(self, answers: pa.Table, n_buckets: int):
        """The windows of segments with hot minimisers.

        Of each: its segment, its place there and the number of its distinct window. Of distinct ones in bucket order: the
        bucket, the first window with these bytes, and the bytes.
        """
        shared, hot = self._pick(answers)
        own = self.own[shared & hot]
        count = self.len[own] - WINDOW + 1
        seg = np.repeat(own, count)
        inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        chunk = Chunk([self.texts[d][a : a + n] for d, a, n in zip(self.doc[own].tolist(), self.start[own].tolist(), self.len[own].tolist(), strict=True)])
        at = np.repeat(chunk.off[:-1], count) + inside
        bucket = ((RangeHash(chunk.buf)(at, at + WINDOW) if len(at) else np.zeros(0, np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((self.start[seg] + inside, self.ids[self.doc[seg]], bucket))
        number: dict[bytes, int] = {}
        which = np.empty(len(order), np.int64)
        which[order] = [number.setdefault(chunk.raw[a : a + WINDOW], len(number)) for a in at[order].tolist()]
        first = order[np.unique(which[order], return_index=True)[1]]
        return seg, inside, which, bucket[first], first, list(number)


def _five(keys: np.ndarray) -> bytes:
    """Numbers of 40 bits, byte by byte."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes()


def _from_five(data: bytes) -> np.ndarray:
    n = len(data) // 5
    return np.ascontiguousarray(np.vstack([np.frombuffer(data, np.uint8).reshape(5, n), np.zeros((3, n), np.uint8)]).T).view(np.uint64).ravel()


def _later_windows(lens: np.ndarray, docs: np.ndarray, starts: np.ndarray, keys: np.ndarray, pieces: list[bytes]) -> np.ndarray:
    """For all windows of these segments one after the other: does the window also start earlier?

    Segments with different keys have no window in common, nor has a segment two equal windows: both would have their
    minimiser at the same place. So of distinct segments only those that share a key go into the array.
    """
    n_windows = lens - WINDOW + 1
    offset = np.concatenate([[0], np.cumsum(n_windows)])
    out = np.zeros(offset[-1], bool)
    order = np.lexsort((starts, docs))
    earliest: dict[bytes, int] = {}
    rep = np.empty(len(lens), np.int64)
    for i in order.tolist():
        rep[i] = earliest.setdefault(pieces[i], i)
    if (lens == WINDOW).all():  # single windows are equal where their bytes are; there is nothing inside them to sort
        return (docs != docs[rep]) | (starts != starts[rep])
    own = np.fromiter(earliest.values(), np.int64, len(earliest))
    _, key, count = np.unique(keys[own], return_inverse=True, return_counts=True)
    own = own[(count > 1)[key]]
    text = np.frombuffer(b"".join([pieces[i] for i in own.tolist()]), np.uint8)
    array = suffix_array(text)
    same = permuted_common_prefixes(text, array, WINDOW) >= WINDOW
    seg_len = lens[own]
    begin = np.concatenate([[0], np.cumsum(seg_len)])[:-1]
    seg = np.repeat(np.arange(len(own)), seg_len)
    inside = np.arange(len(text)) - begin[seg]
    starts_window = inside <= seg_len[seg] - WINDOW
    # Only suffixes that start a window matter; a run of equal windows is a run of the array.
    run = np.cumsum(~same[array])
    keep = starts_window[array]
    at, run = array[keep], run[keep]
    doc_rank = np.unique(docs[own], return_inverse=True)[1].astype(np.int64)
    key = (doc_rank[seg[at]] << np.int64(36)) | (starts[own][seg[at]] + inside[at])
    heads = B.group_starts(run)
    later = np.repeat(np.minimum.reduceat(key, heads), np.diff(np.append(heads, len(run)))) < key if len(run) else np.zeros(0, bool)
    hit = at[later]
    flags = np.zeros(len(text), bool)
    flags[hit] = True
    place = np.repeat(offset[own] - begin, seg_len) + np.arange(len(text))
    out[place[starts_window]] = flags[starts_window]
    for i in np.flatnonzero(rep != np.arange(len(rep))).tolist():
        r = rep[i]
        out[offset[i] : offset[i + 1]] = True if docs[i] != docs[r] or starts[i] != starts[r] else out[offset[r] : offset[r + 1]]
    return out


def suffix_dedup(docs: DataFrame, block_bytes: int = B.BLOCK_BYTES, keep: tuple[str, ...] = (), as_text: bool = False, hot_segments: int = HOT) -> DataFrame:
    """One row for each input row: doc_id, the columns in ``keep``, n_bytes, n_removed, n_spans (maximal removed runs), kept.

    ``kept`` is binary. With ``as_text`` it is a string, without the rest of a character of which bytes were removed.
    """
    total = B.text_bytes(docs)
    n_blocks, n_buckets = B.parts(docs, total, block_bytes), B.parts(docs, total, block_bytes // 2)
    blocks = B.in_blocks(docs, n_blocks, keep=keep)

    def minimisers(table: pa.Table) -> pa.Table:
        block, b = table.column("block")[0].as_py(), _Block(table, n_buckets)
        low = b.keys & _LOW40
        return _rows(_MINIMISERS, [(k, block, t - f, _five(low[f:t]), B.planes(b.count[f:t].astype(np.uint32))) for k, f, t in B.bucket_runs((b.keys >> np.uint64(40)).astype(np.int64))])

    def meet_minimisers(table: pa.Table) -> pa.Table:
        bucket, ns = table.column("bucket")[0].as_py(), table.column("n").to_pylist()
        parts = [_from_five(x) for x in table.column("keys").to_pylist()]
        own = np.concatenate([B.unplanes(x, np.uint32) for x in table.column("counts").to_pylist()])
        keys, which, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        hot = np.bincount(which, own, len(keys)) > hot_segments
        told = np.split(np.stack([(count > 1)[which], hot[which]], axis=1), np.cumsum(ns)[:-1])
        return _rows(_FLAGS, [(b, 1, bucket, n, B.pack_bits(f.ravel())) for b, n, f in zip(table.column("block").to_pylist(), ns, told, strict=True)])

    def pieces(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _rows(_PIECES, [])
        block, b = table.column("block")[0].as_py(), _Block(table, n_buckets)
        own, bucket, keys = b.sent(answers)
        rows = []
        for k, f, t in B.bucket_runs(bucket):
            s = own[f:t]
            text = b"".join([b.texts[d][a : a + n] for d, a, n in zip(b.doc[s].tolist(), b.start[s].tolist(), b.len[s].tolist(), strict=True)])
            rows.append((2, k, block, t - f, b.len[s].astype(np.uint8).tobytes(), B.planes(b.ids[b.doc[s]]), B.planes(b.start[s]), _five(keys[f:t]), text))
        seg, inside, _, bucket, first, windows = b.hot_windows(answers, n_buckets)
        docs_of, starts = b.ids[b.doc[seg[first]]], b.start[seg[first]] + inside[first]
        rows += [(3, k, block, t - f, bytes([WINDOW]) * (t - f), B.planes(docs_of[f:t]), B.planes(starts[f:t]), b"", b"".join(windows[f:t])) for k, f, t in B.bucket_runs(bucket)]
        return _rows(_PIECES, rows)

    def meet_pieces(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        bucket, ns = table.column("bucket")[0].as_py(), table.column("n").to_pylist()
        col = {c: table.column(c).to_pylist() for c in ("block", "lens", "docs", "starts", "keys", "bytes")}
        lens = np.concatenate([np.frombuffer(x, np.uint8) for x in col["lens"]]).astype(np.int64)
        ids, starts = (np.concatenate([B.unplanes(x, np.int64) for x in col[c]]) for c in ("docs", "starts"))
        keys = np.concatenate([_from_five(x) for x in col["keys"]])
        text = b"".join(col.pop("bytes"))
        end = np.cumsum(lens).tolist()
        later = _later_windows(lens, ids, starts, keys, [text[a:b] for a, b in zip([0, *end], end, strict=False)])
        upto = np.concatenate([[0], np.cumsum(lens - WINDOW + 1)])[np.concatenate([[0], np.cumsum(ns)])]
        return _rows(_FLAGS, [(k, kind, bucket, int(b - a), B.pack_bits(later[a:b])) for k, a, b in zip(col["block"], upto[:-1], upto[1:], strict=True)])

    kept_type, results = ("string" if as_text else "binary"), ["n_bytes", "n_removed", "n_spans", "kept"]
    passed = [f for f in blocks.schema if f.name.startswith("__keep")]
    out = ", ".join(["doc_id long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in passed), "n_bytes long, n_removed long, n_spans long", f"kept {kept_type}"])

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        through = [n for n in table.column_names if n.startswith("__keep")]
        if not table.num_rows:
            fields = [("doc_id", pa.int64()), *((n, table.schema.field(n).type) for n in through), *((n, pa.int64()) for n in results[:3]), ("kept", pa.string() if as_text else pa.binary())]
            return pa.schema(fields).empty_table()
        b = _Block(table, n_buckets)
        own, _, _ = b.sent(answers)
        n_windows = b.len[own] - WINDOW + 1
        later = _flags(answers, 2, int(n_windows.sum()))
        size = np.fromiter(map(len, b.texts), np.int64, len(b.texts))
        off = np.concatenate([[0], np.cumsum(size)])
        place = off[b.doc] + b.start
        delta = np.zeros(int(off[-1]) + 1, np.int32)
        np.add.at(delta, place[b.later], 1)
        np.add.at(delta, (place + b.len)[b.later], -1)
        # The answers of a distinct segment hold for each segment at the very same place of the same doc_id.
        slot = np.full(len(b.doc), -1, np.int64)
        slot[own] = np.concatenate([[0], np.cumsum(n_windows)])[:-1]
        told = np.flatnonzero(~b.later & (slot[b.rep] >= 0))
        count = b.len[told] - WINDOW + 1
        inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        hit = later[np.repeat(slot[b.rep[told]], count) + inside]
        at = (np.repeat(place[told], count) + inside)[hit]
        np.add.at(delta, at, 1)
        np.add.at(delta, at + WINDOW, -1)
        seg, inside, which, _, first, windows = b.hot_windows(answers, n_buckets)
        if len(seg):
            # A window is late if its first like in the block is, or if it stands later than that one.
            start, doc = b.start[seg] + inside, b.ids[b.doc[seg]]
            late = _flags(answers, 3, len(windows))[which] | (doc != doc[first[which]]) | (start != start[first[which]])
            back = np.full(len(b.doc), -1, np.int64)
            heads = np.flatnonzero(inside == 0)
            back[seg[heads]] = heads
            told = np.flatnonzero(~b.later & (back[b.rep] >= 0))
            count = b.len[told] - WINDOW + 1
            step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            at = (np.repeat(place[told], count) + step)[late[np.repeat(back[b.rep[told]], count) + step]]
            np.add.at(delta, at, 1)
            np.add.at(delta, at + WINDOW, -1)
        gone = np.cumsum(delta[:-1]) > 0
        rises = gone.copy()
        rises[1:] &= ~gone[:-1]
        inner = off[:-1][size > 0]
        rises[inner] = gone[inner]
        n_gone, n_rises = (np.concatenate([[0], np.cumsum(x)])[off] for x in (gone, rises))
        n_gone, n_rises = np.diff(n_gone).astype(np.int64), np.diff(n_rises).astype(np.int64)
        kept = [np.frombuffer(t, np.uint8)[~gone[a : a + len(t)]].tobytes() if g else t for t, a, g in zip(b.texts, off[:-1].tolist(), n_gone.tolist(), strict=True)]
        last = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
        return pa.table([b.doc_ids, *(b.table.column(n) for n in through), pa.array(size), pa.array(n_gone), pa.array(n_rises), last], names=["doc_id", *through, *results])

    shared = blocks.groupBy("block").applyInArrow(minimisers, _MINIMISERS).groupBy("bucket").applyInArrow(meet_minimisers, _FLAGS).repartition(n_blocks, "block")
    late = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(pieces, _PIECES).groupBy("kind", "bucket").applyInArrow(meet_pieces, _FLAGS).repartition(n_blocks, "block")
    return renamed(blocks.groupBy("block").cogroup(shared.unionByName(late).groupBy("block")).applyInArrow(cut, out), keep)
