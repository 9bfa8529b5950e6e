"""Packing of tokenized documents into sequences of one length, as few as it can.

A document is its ids and an end id.  Only one that is longer than a sequence is cut: into whole sequences, after a first
piece with the rest.  Sequences are filled by best two fit: take the longest piece that still fits until none does; then,
if the shortest piece of the sequence can make way for two waiting pieces that together fill its room better, the best such
pair takes its place.

Which pieces go together depends only on their lengths, so the plan is made from the number of pieces of each length,
at most ``LENGTH`` numbers.  One filled sequence is a pattern, and it is repeated as long as the counts allow that the rule
would make the same choices again; a plan is some thousand patterns for any number of documents.  Every piece then finds its
place from its rank among the pieces of its length.  Ranks come from a window over pieces of one length and one share,
whose size is bounded, and from the sizes of the shares before, so no task sees all pieces of a common length.

Encoding: byte-level vocabularies whose rules are ``PRE_TOKENIZER`` split a text at changes between letters, digits,
white space and other characters, a space going to the word after it.  Those pieces are found as array operations for
ASCII and Latin-1 letters, and the library's model encodes each distinct one.  A word with any other character or an
apostrophe goes through the whole library, and so does a text with a special token or with white space beyond ASCII.  With a
vocabulary of other rules all texts do.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import saved
from .kernel import Chunk, batches, strong_hashes
from .token_files import _BYTE, PieceEncoder, _files, _id_type

LENGTH = 2048
#: Bytes of text that are encoded at once; a longer text is encoded in cuts.
CHUNK_BYTES = 1 << 20
#: Pieces in a share, about; at least so many shares.
SHARE_ROWS, SHARES = 1 << 16, 256

# The rules for which pieces can be found without the library, and the white space beyond ASCII.
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
WIDE_SPACE = [*range(0x2000, 0x200B), 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_SPACE, _LETTER, _DIGIT, _OTHER, _ODD, _END = range(6)
_CLASS = np.array(
    [
        _SPACE if b == 0x20 or 0x09 <= b <= 0x0D else _DIGIT if 0x30 <= b <= 0x39 else _LETTER if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A else _ODD if b >= 0x80 or b == 0x27 else _OTHER
        for b in range(256)
    ],
    np.uint8,
)

_WIDE = np.array([int.from_bytes(chr(c).encode(), "big") for c in WIDE_SPACE])
_SHOWN = dict(enumerate(_BYTE))


class ByteLevelEncoder(PieceEncoder):
    """Encodes texts piece by piece. Pieces follow each other without gaps."""

    def __init__(self, path: str, end_id: int | None, dtype):
        super().__init__(path, end_id, dtype)
        with _files(path)[0].open_input_stream(_files(path)[1]) as f:
            rules = json.loads(f.read())
        split = rules["pre_tokenizer"] or {}
        self.by_piece = rules["normalizer"] is None and all(split.get(k) == v for k, v in PRE_TOKENIZER.items())
        self.added = [x["content"].encode() for x in rules.get("added_tokens") or []]

    def _encode(self, piece: bytes, odd: bool) -> list[int]:
        if odd:
            return self.tokenizer.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(_SHOWN))]

    def _whole(self, chunk: Chunk) -> list[int]:
        """The texts of a chunk that hold a special token or white space beyond ASCII."""
        at = np.flatnonzero(chunk.buf >= 0xC2)
        two = chunk.buf[at].astype(np.int32) << 8 | chunk.buf[np.minimum(at + 1, len(chunk.buf) - 1)]
        three = two << 8 | chunk.buf[np.minimum(at + 2, len(chunk.buf) - 1)]
        found = set((np.searchsorted(chunk.off, at[np.isin(two, _WIDE) | np.isin(three, _WIDE)], side="right") - 1).tolist())
        for token in self.added:
            place = chunk.raw.find(token)
            while place >= 0:
                found.add(k := int(np.searchsorted(chunk.off, place, side="right")) - 1)
                place = chunk.raw.find(token, int(chunk.off[k + 1]))
        return sorted(found)

    def _by_piece(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        buf = chunk.buf
        kind = _CLASS[buf]
        lead = np.flatnonzero(buf[:-1] == 0xC3)
        second = buf[lead + 1]
        lead = lead[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        kind[chunk.off[1:] - 1] = _END
        blank = (kind == _SPACE) | (kind == _END)
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            edge = np.concatenate([np.zeros(1, edge.dtype), edge])
        w_start, w_end = edge[0::2], edge[1::2]  # the buffer ends with a separator
        odd_at = np.flatnonzero(kind == _ODD)
        odd_word = np.searchsorted(odd_at, w_start) != np.searchsorted(odd_at, w_end)
        step = np.zeros(len(buf) + 1, np.int8)
        step[w_start[odd_word]], step[w_end[odd_word]] = 1, -1
        kind[np.cumsum(step[:-1], dtype=np.int8).astype(bool)] = _ODD
        first = np.ones(len(buf), bool)
        first[1:] = kind[1:] != kind[:-1]
        # A space before a word belongs to the word; so the last of a run of white space stands apart from the run.
        before = w_start[w_start > 0] - 1
        before = before[kind[before] == _SPACE]
        first[before] = True
        first[before[buf[before] == 0x20] + 1] = False
        for k in self._whole(chunk):
            a, b = int(chunk.off[k]), int(chunk.off[k + 1]) - 1
            kind[a:b], first[a + 1 : b] = _ODD, False
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(buf))
        real = kind[start] != _END
        start, end = start[real], end[real]
        odd = kind[end - 1] == _ODD
        hashed, check = strong_hashes(chunk.raw, start, end, 2)
        # The same bytes through the whole library are another piece.
        hashed ^= np.where(odd, np.uint64(0xA5A5A5A55A5A5A5A), np.uint64(0))
        ids, upto = self.cache(hashed, check, lambda w: [self._encode(chunk.raw[a:b], o) for a, b, o in zip(start[w].tolist(), end[w].tolist(), odd[w].tolist(), strict=True)])
        return ids, upto[np.searchsorted(start, chunk.off)]

    def cuts(self, text: bytes) -> list[bytes]:
        """A long text in cuts whose ids, one after the other, are those of the text: before a space between two ASCII characters."""
        if len(text) <= CHUNK_BYTES or not self.by_piece or self._whole(Chunk([text])):
            return [text]
        out, begin = [], 0
        while len(text) - begin > CHUNK_BYTES:
            at = text.find(b" ", begin + CHUNK_BYTES // 2)
            while at > 0 and not (0x20 < text[at - 1] < 0x80 and at + 1 < len(text) and 0x20 < text[at + 1] < 0x80):
                at = text.find(b" ", at + 1)
            if at < 0:
                break
            out.append(text[begin:at])
            begin = at
        return [*out, text[begin:]]

    def documents(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text with the end id."""
        cut = [self.cuts(t) for t in texts]
        if all(len(c) == 1 for c in cut):
            ids, count = self(texts)
            yield from np.split(ids, np.cumsum(count)[:-1])
            return
        end = [] if self.end_id is None else [self.end_id]
        own, self.end_id = self.end_id, None
        try:
            for parts in cut:
                yield np.concatenate([*(self([p])[0] for p in parts), np.array(end, self.dtype)])
        finally:
            self.end_id = own


_encoders: dict[tuple, ByteLevelEncoder] = {}


def _encoder(path: str, end_id: int, dtype: str) -> ByteLevelEncoder:
    """The encoder of this worker process, which keeps what it knows from one task to the next."""
    key = (path, end_id, dtype)
    if key not in _encoders:
        _encoders[key] = ByteLevelEncoder(path, end_id, dtype)
    return _encoders[key]


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 (of the ids as little-endian uint32) of each document's pieces; with their ids if asked for."""
    from tokenizers import Tokenizer

    dtype = np.dtype(_id_type(max(end_id + 1, Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)))).name

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, end_id, dtype)
        for rows, texts in batches(stream, CHUNK_BYTES):
            at, start, length, crc, ids = [], [], [], [], []
            for k, found in enumerate(encoder.documents(texts)):
                wide = found.astype("<u4")
                head = len(wide) % size or min(size, len(wide))
                for a, b in zip([0, *range(head, len(wide), size)], [*range(head, len(wide) + 1, size)], strict=True):
                    at.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(wide[a:b].data))
                    if with_ids:
                        ids.append(wide[a:b].astype(np.int32))
            at = np.array(at, np.int64)
            number = np.arange(len(at)) - np.searchsorted(at, at)
            columns = {"doc_id": rows.column(0).take(pa.array(at)), "piece": pa.array(number, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            yield pa.record_batch(columns | ({"ids": pa.array(ids, pa.list_(pa.int32()))} if with_ids else {}))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


class Pattern:
    """Pieces that fill a sequence, as (length, how many) from the longest down, and how often the sequence is made."""

    def __init__(self, uses: dict[int, int], repeats: int):
        self.uses = sorted(((l, n) for l, n in uses.items() if n), reverse=True)
        self.repeats = repeats


def _greedy(lengths: np.ndarray, counts: np.ndarray, size: int) -> tuple[dict[int, int], int]:
    """Places in ``lengths`` (rising) and how many of each, longest first, and the room that is left."""
    taken, gap, k = {}, size, len(lengths)
    while True:
        k = min(k, int(np.searchsorted(lengths, gap, side="right"))) - 1
        if k < 0:
            return taken, gap
        n = min(int(counts[k]), gap // int(lengths[k]))
        taken[k] = n
        gap -= n * int(lengths[k])


def _best_pair(lengths: np.ndarray, left: np.ndarray, room: int, more_than: int) -> tuple[int, int] | None:
    """The places of two waiting pieces with the largest sum in (more_than, room], if there are any; of equal sums the one with the longest piece."""
    there = np.flatnonzero(left > 0)
    a = lengths[there]
    other = np.searchsorted(a, np.minimum(room - a, a), side="right") - 1
    same = (other >= 0) & (there[np.maximum(other, 0)] == there) & (left[there] < 2)
    other = np.where(same, other - 1, other)
    total = np.where(other >= 0, a + a[np.maximum(other, 0)], -1)
    best = len(total) - 1 - int(total[::-1].argmax()) if len(total) else -1
    if best < 0 or total[best] <= more_than:
        return None
    return int(there[best]), int(there[other[best]])


def best_two_fit(counts: dict[int, int], size: int = LENGTH) -> list[Pattern]:
    """Patterns that use every piece once, from the number of pieces of each length (1 to ``size``).

    A pattern is repeated while the counts are such that the rule makes the same choices: what it passed over stays passed
    over, as counts only fall, so it is enough that everything it takes or tries is still there.
    """
    lengths = np.array(sorted(l for l, n in counts.items() if n), np.int64)
    left = np.array([counts[int(l)] for l in lengths], np.int64)
    plan = []
    while len(lengths):
        taken, gap = _greedy(lengths, left, size)
        tried, uses = dict(taken), dict(taken)
        if gap and sum(taken.values()) > 1:
            last = min(taken)
            waiting = left.copy()
            for k, n in taken.items():
                waiting[k] -= n
            pair = _best_pair(lengths, waiting, gap + int(lengths[last]), int(lengths[last]))
            if pair:
                uses[last] -= 1
                for k in pair:
                    uses[k], tried[k] = uses.get(k, 0) + 1, tried.get(k, 0) + 1
        repeats = 1 + min((int(left[k]) - tried[k]) // n for k, n in uses.items() if n)
        plan.append(Pattern({int(lengths[k]): n for k, n in uses.items()}, repeats))
        for k, n in uses.items():
            left[k] -= n * repeats
        lengths, left = lengths[left > 0], left[left > 0]
    return plan


class Places:
    """Where each piece goes, from its length and its rank among the pieces of that length."""

    def __init__(self, plan: list[Pattern]):
        rows, used, base = [], {}, 0
        for p in plan:
            offset = 0
            for l, n in p.uses:
                rows.append((l, used.get(l, 0), n, base, offset))
                used[l] = used.get(l, 0) + n * p.repeats
                offset += l * n
            base += p.repeats
        self.sequences = base
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.begin, self.uses, self.base, self.offset = table.T
        self.first = np.searchsorted(self.length, np.arange(int(self.length.max(initial=0)) + 2))

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset."""
        at = np.empty(len(length), np.int64)
        for l in np.unique(length).tolist():
            mine = length == l
            a, b = self.first[l], self.first[l + 1]
            at[mine] = a + np.searchsorted(self.begin[a:b], rank[mine], side="right") - 1
        sequence, slot = np.divmod(rank - self.begin[at], self.uses[at])
        return self.base[at] + sequence, self.offset[at] + slot * length


def place(rows: DataFrame, size: int = LENGTH) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``size`` and a ``row`` number that no other row has."""
    names = rows.columns
    by_length = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``size`` rows
    counts = {r["length"]: r["n"] for r in by_length}
    places = Places(best_two_fit(counts, size))
    shares = max(SHARES, sum(counts.values()) // SHARE_ROWS)
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("row"), F.lit(shares)))
    sizes = dealt.groupBy("length", "share").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1))
    begins = sizes.select("length", "share", F.coalesce(before, F.lit(0)).alias("begin"))
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("length", "share").orderBy("row")) - 1)
    ranked = ranked.join(begins, ["length", "share"]).withColumn("rank", F.col("rank") + F.col("begin")).select(*names, "rank")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            sequence, offset = places(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            columns = {c: batch.column(c) for c in names}
            yield pa.record_batch(columns | {"sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())})

    return ranked.mapInArrow(run, rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document; ``with_ids`` adds the ids.

    A null text is empty and has its end id only; texts of any length are whole.  Null and repeated doc_ids are documents like
    others.  An empty table gives no rows.  Other columns are not read.  Pieces of one length are alike to the packing: which of
    them goes where follows the order in which they were encoded.
    """
    rows = pieces(docs, tokenizer_path, end_id, size, with_ids).withColumn("row", F.monotonically_increasing_id())
    return place(saved(rows, "pieces"), size).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids (of the document each id belongs to) of each sequence, from what ``pack`` gives with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # one sequence's pieces
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.flatten(F.transform("parts", lambda p: F.array_repeat(p["doc_id"], F.size(p["ids"])))).alias("doc_ids"))
