"""Finds benchmark passages in documents with suffix arrays of the documents.

Method: each shard of documents gets a suffix array over its words.  Every suffix of every benchmark item is looked up by
binary search in each shard; its neighbours in the array give the longest verbatim match.  Where that is a window or more,
the places of the window are read off the array, once for each distinct window, and cover the words that are hit.  Of each
document and item the longest match is kept with one place, so that neither memory nor output grows with the product of an
item's repeats and a document's.  Documents with a match are contaminated and can be removed.

Words are numbered by the benchmark; a word that no item has ends every match, as does the end of a document or of an item,
so the array holds the suffixes that start with a word of the benchmark.

Documents are read in the order they are stored, with no shuffle.  The benchmark is broadcast in blocks of ``BLOCK_BYTES`` at
most, one at a time; a larger one takes several passes over the documents, whose matches are joined by doc_id and text.

Definition.  Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased.  A window is ``WINDOW``
consecutive words of an item; an item of fewer words, but not none, is one window.  A document word inside any occurrence
of a window is hit.  Null and empty texts have no words; texts of any length are read whole.  An item with a null id counts under
an empty id; items with one id count as one.  Documents that are equal, or share a doc_id, are judged each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import group_starts
from .columns import numbered, renamed
from .components import saved
from .kernel import ALNUM_WORD, LOWER, Chunk, batches, segment_ids

WINDOW = 10
#: Bytes of benchmark text in one broadcast.
BLOCK_BYTES = 4 << 20
#: Bytes of text in one shard.
SHARD_BYTES = 2 << 20
MATCHES = "array<struct<item_id:string,item_word:int,doc_word:int,words:int>>"
RUNS = "array<struct<begin:int,end:int>>"
_RUN = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
_MATCH = pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("words", pa.int32())])


def _word_text(numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers with a 0 after each text, and where each word stands."""
    text = segment_ids(first, len(numbers))
    place = np.arange(len(numbers)) + text
    out = np.zeros(len(numbers) + len(first), np.int32)
    out[place] = numbers
    return out, place


def _packed(text: np.ndarray, at: np.ndarray, bits: int, width: int) -> np.ndarray:
    """The first words of each suffix as one number; words after a 0 count as 0."""
    key, alive = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for k in range(width):
        word = text[np.minimum(at + k, len(text) - 1)].astype(np.int64)
        alive &= word > 0
        key = (key << bits) | np.where(alive, word, 0)
    return key


class Benchmark:
    """A block of benchmark items, ready for lookups."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int = WINDOW):
        self.ids, self.window = ids, window
        chunk = Chunk([t.translate(LOWER) for t in texts])
        start, end, first = chunk.words(ALNUM_WORD)
        hashed, check = chunk.word_hashes(start, end, 2)
        # Words are told apart by both hashes; those that share the first stand side by side.
        order = np.lexsort((check, hashed))
        new = np.ones(len(order), bool)
        new[1:] = (hashed[order[1:]] != hashed[order[:-1]]) | (check[order[1:]] != check[order[:-1]])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        self.vocabulary, self.check = hashed[order[new]], check[order[new]]
        self.alike = int(np.diff(np.append(group_starts(self.vocabulary), len(self.vocabulary))).max(initial=1))
        #: Word 0 is any word that no item has.
        self.text, self.place = _word_text((number + 1).astype(np.int32), first)
        n = len(start)
        self.item = segment_ids(first, n)
        self.word = np.arange(n) - first[self.item] if n else np.zeros(0, np.int64)
        left = first[self.item + 1] - np.arange(n) if n else np.zeros(0, np.int64)
        #: How many words the window has that starts here; 0 where none does.
        self.window_len = np.where(left >= window, window, np.where(self.word == 0, left, 0))
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.width = max(1, 62 // self.bits)
        self.key = _packed(self.text, self.place, self.bits, self.width)

    def numbers(self, hashed: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The numbers of words by their hashes."""
        if not len(self.vocabulary):
            return np.zeros(len(hashed), np.int32)
        out, first = np.zeros(len(hashed), np.int32), np.searchsorted(self.vocabulary, hashed)
        for k in range(self.alike):
            slot = np.minimum(first + k, len(self.vocabulary) - 1)
            out = np.where((self.vocabulary[slot] == hashed) & (self.check[slot] == check), slot + 1, out)
        return out.astype(np.int32)


class Shard:
    """The suffix array of some documents over the word numbers of a benchmark."""

    def __init__(self, texts: list[bytes], bench: Benchmark):
        self.bench = bench
        chunk = Chunk([t.translate(LOWER) for t in texts])
        start, end, self.first = chunk.words(ALNUM_WORD)
        self.text, place = _word_text(bench.numbers(*chunk.word_hashes(start, end, 2)), self.first)
        self.doc = np.repeat(np.arange(chunk.n), np.diff(self.first) + 1)
        self._sort(place[self.text[place] > 0])

    def _sort(self, at: np.ndarray) -> None:
        """Orders all suffixes that start at ``at``, by doubling the length that is known to be equal where they are still tied."""
        bits, width = self.bench.bits, self.bench.width
        key = _packed(self.text, at, bits, width)
        order = np.argsort(key, kind="stable")
        self.array, self.key = at[order], key[order]
        n = len(at)
        if n < 2:
            return
        # Where a suffix ends; one that has ended is different from all others.
        zeros = np.flatnonzero(self.text == 0)
        heads = np.flatnonzero(np.concatenate([[True], self.key[1:] != self.key[:-1]]))
        size = np.diff(np.append(heads, n))
        rank = np.zeros(len(self.text), np.int64)
        rank[self.array] = np.repeat(heads, size)
        open_ = np.flatnonzero(np.repeat(size > 1, size))
        while len(open_):
            items = self.array[open_]
            stop = zeros[np.searchsorted(zeros, items)]
            second = np.where(stop <= items + width, -1 - stop, rank[np.minimum(items + width, len(self.text) - 1)])
            group = rank[items]
            by = np.lexsort((second, group))
            items, group, second = items[by], group[by], second[by]
            self.array[open_] = items
            heads = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])]))
            size = np.diff(np.append(heads, len(items)))
            rank[items] = np.repeat(open_[heads], size)
            open_ = open_[np.repeat(size > 1, size)]
            width *= 2

    def _search(self, which: np.ndarray, length: np.ndarray | None, right: bool) -> np.ndarray:
        """Where in the array the benchmark's suffixes ``which`` belong; with a length, before or behind those that start alike."""
        bench = self.bench
        begin = bench.place[which]
        if length is None:
            lo = np.searchsorted(self.key, bench.key[which])
            hi = np.searchsorted(self.key, bench.key[which], side="right")
        else:
            lo, hi = np.zeros(len(which), np.int64), np.full(len(which), len(self.array))
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            sign = self._compare(self.array[mid], begin[open_], None if length is None else length[open_])
            down = sign <= 0 if right else sign < 0
            lo[open_[down]] = mid[down] + 1
            hi[open_[~down]] = mid[~down]

    def _compare(self, doc_at: np.ndarray, item_at: np.ndarray, length: np.ndarray | None) -> np.ndarray:
        """-1, 0 or 1 as the document's suffix is smaller, equal or larger; with a length, as far as that."""
        sign, open_, k = np.zeros(len(doc_at), np.int8), np.arange(len(doc_at)), 0
        while True:
            if length is not None:
                open_ = open_[length[open_] > k]
            if not len(open_):
                return sign
            a, b = self.text[doc_at[open_] + k], self.bench.text[item_at[open_] + k]
            sign[open_] = (a > b).astype(np.int8) - (a < b).astype(np.int8)
            open_ = open_[(a == b) & (a > 0)]
            k += 1

    def _common(self, doc_at: np.ndarray, item_at: np.ndarray) -> np.ndarray:
        """How many words two suffixes have in common."""
        got, open_ = np.zeros(len(doc_at), np.int64), np.arange(len(doc_at))
        while len(open_):
            a, b = self.text[doc_at[open_] + got[open_]], self.bench.text[item_at[open_] + got[open_]]
            open_ = open_[(a == b) & (a > 0)]
            got[open_] += 1
        return got

    def longest_matches(self) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix of the benchmark: its longest match in the shard in words, and one place of it (-1 without one)."""
        n = len(self.bench.place)
        best, where = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        if len(self.array):
            spot = self._search(np.arange(n), None, False)
            for near in (spot - 1, spot):
                ok = np.flatnonzero((near >= 0) & (near < len(self.array)))
                at = self.array[near[ok]]
                got = self._common(at, self.bench.place[ok])
                better = got > best[ok]
                best[ok[better]], where[ok[better]] = got[better], at[better]
        return best, where

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct windows that occur: for each its interval in the array, its length, and the words of the benchmark where it
        starts (all in one array, and where each window's begin). Equal windows have one interval and are looked at once."""
        bench = self.bench
        best, _ = self.longest_matches()
        hit = np.flatnonzero((bench.window_len > 0) & (best >= bench.window_len))
        length = bench.window_len[hit]
        lo, hi = self._search(hit, length, False), self._search(hit, length, True)
        order = np.lexsort((hi, lo, length))
        hit, lo, hi, length = hit[order], lo[order], hi[order], length[order]
        heads = group_starts(length, lo, hi)
        return lo[heads], hi[heads], length[heads], hit, np.append(heads, len(hit))

    def by_document(self) -> dict[int, tuple[list[tuple[int, int]], list[dict]]]:
        """For each document with a hit: the runs of words that are hit, and for each item its longest match and one place of it.

        Windows of one length have intervals apart, so all places together are at most the words of the shard for each length
        there is.  A pair of a window's word in the benchmark and a document is looked at once, however often the document has
        the window: the document's places next to that suffix in the array are the ones it has most in common with.
        """
        lo, hi, length, words, begin = self.windows()
        if not len(lo):
            return {}
        count = hi - lo
        which = np.repeat(np.arange(len(lo)), count)
        rank = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        place = self.array[rank]
        doc = self.doc[place]
        change = np.zeros(len(self.text) + 1, np.int32)
        np.add.at(change, place, 1)
        np.add.at(change, place + length[which], -1)
        hit = np.cumsum(change[:-1]) > 0  # never at the zero between two documents
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
        runs: dict[int, list[tuple[int, int]]] = {}
        for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
            d = int(self.doc[a])
            runs.setdefault(d, []).append((a - int(self.first[d]) - d, b - int(self.first[d]) - d))
        # Ranks of each document's places, for the neighbours of a suffix among them.
        mine = np.unique(doc.astype(np.int64) * len(self.array) + rank)
        pairs = np.unique(doc.astype(np.int64) * len(lo) + which)
        spot = self._search(words, None, False)
        found: dict[int, list[dict]] = {d: [] for d in runs}
        at = np.searchsorted(pairs, np.array(sorted(runs), np.int64) * len(lo))
        for d, a, b in zip(sorted(runs), at.tolist(), [*at[1:].tolist(), len(pairs)], strict=True):
            found[d] = self._longest_by_item(d, pairs[a:b] - d * len(lo), words, begin, spot, mine)
        return {d: (runs[d], found[d]) for d in runs}

    def _longest_by_item(self, doc: int, windows: np.ndarray, words: np.ndarray, begin: np.ndarray, spot: np.ndarray, mine: np.ndarray) -> list[dict]:
        """Of one document; ``windows`` are those it has."""
        bench, n = self.bench, len(self.array)
        size = begin[windows + 1] - begin[windows]
        at = np.repeat(begin[windows] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        suffix = words[at]
        near = np.searchsorted(mine, doc * n + spot[at])
        best, where = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for k in (near - 1, near):
            ok = np.flatnonzero((k >= 0) & (k < len(mine)))
            ok = ok[mine[k[ok]] // n == doc]
            here = self.array[mine[k[ok]] % n]
            got = self._common(here, bench.place[suffix[ok]])
            better = got > best[ok]
            best[ok[better]], where[ok[better]] = got[better], here[better]
        item = bench.item[suffix]
        order = np.lexsort((where, suffix, -best, item))
        first = order[group_starts(item[order])]
        word = where[first] - self.first[doc] - doc
        rows = [{"item_id": bench.ids[i], "item_word": w, "doc_word": q, "words": m} for i, w, q, m in zip(item[first].tolist(), bench.word[suffix[first]].tolist(), word.tolist(), best[first].tolist(), strict=True)]
        return longest_by_id(rows)


def longest_by_id(rows: list[dict]) -> list[dict]:
    """Of the matches of each item id the longest, then the one first in the document and in the item; in order of item ids."""
    kept: dict[str, dict] = {}
    for m in sorted(rows, key=lambda m: (m["item_id"], -m["words"], m["doc_word"], m["item_word"])):
        kept.setdefault(m["item_id"], m)
    return list(kept.values())


def hit_words(runs: list[tuple[int, int]]) -> int:
    """How many words runs (from, to) cover together."""
    total, done = 0, 0
    for a, b in sorted(runs):
        total += max(0, b - max(a, done))
        done = max(done, b)
    return total


def _blocks(benchmark: DataFrame, most: int) -> Iterator[tuple[list[str], list[bytes]]]:
    """The benchmark in blocks of bounded size; an item larger than a block is a block of its own."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("binary")).toLocalIterator()
    ids, texts, size = [], [], 0
    for i, t in rows:
        t = bytes(t or b"")
        if ids and size + len(t) > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(t)
        size += len(t) + 1
    yield ids, texts


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: doc_id, the columns in ``keep``, n_words, n_hit, item_ids (sorted strings) and matches.

    ``matches`` has for each of those items the longest verbatim match and one place of it: item_id, item_word, doc_word (both from
    0) and words; the place first in the document, then in the item, of those next to the match in the array.
    A column of ``keep`` may have the name of a result; both are then in the table.
    """
    context = docs.sparkSession.sparkContext
    base = numbered(docs, keep, "doc_id", "text")
    kept = [f for f in base.schema if f.name.startswith("__keep")]
    doc_id = f"doc_id {base.schema['doc_id'].dataType.simpleString()}"

    def searched(part, every: bool):
        """Rows of all documents, or of those with a match."""

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bench = Benchmark(*part.value, window)
            for batch, texts in batches(stream, SHARD_BYTES):
                shard = Shard(texts, bench)
                found = shard.by_document()
                if every:
                    yield result(batch, np.diff(shard.first), [found.get(k, ([], [])) for k in range(batch.num_rows)])
                elif found:
                    some = batch.take(pa.array(list(found)))
                    hit = pa.array([[{"begin": a, "end": b} for a, b in runs] for runs, _ in found.values()], pa.list_(_RUN))
                    yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), hit, pa.array([m for _, m in found.values()], pa.list_(_MATCH))], names=["doc_id", "digest", "runs", "matches"])

        return run

    def result(batch: pa.RecordBatch, n_words, found: list[tuple[list, list[dict]]]) -> pa.RecordBatch:
        own = [
            pa.array(n_words, pa.int64()),
            pa.array([hit_words(runs) for runs, _ in found], pa.int64()),
            pa.array([[m["item_id"] for m in x] for _, x in found], pa.list_(pa.string())),
            pa.array([x for _, x in found], pa.list_(_MATCH)),
        ]
        passed = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
        return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), *passed, *own], names=["doc_id", *(f.name for f in kept), "n_words", "n_hit", "item_ids", "matches"])

    out = ", ".join([doc_id, *(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"n_words long, n_hit long, item_ids array<string>, matches {MATCHES}"])
    parts = _blocks(benchmark, block_bytes)
    part, after = next(parts), next(parts, None)
    if after is None:
        return renamed(base.mapInArrow(searched(context.broadcast(part), True), out), keep)

    # Several passes: each writes the matches it finds; then they meet their documents by doc_id and text.
    keyed = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "text")
    every = None
    while part is not None:
        sent = context.broadcast(part)
        found = saved(keyed.mapInArrow(searched(sent, False), f"{doc_id}, digest string, runs {RUNS}, matches {MATCHES}"), "matches")
        sent.destroy()
        every = found if every is None else every.unionByName(found)
        part, after = after, next(parts, None)
    # Rows with one doc_id and text found the same matches.
    every = every.groupBy("doc_id", "digest").agg(*(F.array_distinct(F.flatten(F.collect_set(c))).alias(c) for c in ("runs", "matches")))
    every = every.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "runs", "matches")
    rows = base.withColumn("digest", F.md5(F.col("text").cast("binary")))
    rows = rows.join(every, rows["doc_id"].eqNullSafe(every["__id"]) & (rows["digest"] == every["__digest"]), "left")

    def counted(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(stream, SHARD_BYTES):
            first = Chunk([t.translate(LOWER) for t in texts]).words(ALNUM_WORD)[2]
            runs, found = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("runs", "matches"))
            yield result(batch, np.diff(first), [([(r["begin"], r["end"]) for r in a or []], longest_by_id(m or [])) for a, m in zip(runs, found, strict=True)])

    return renamed(rows.select(*base.columns, "runs", "matches").mapInArrow(counted, out), keep)
