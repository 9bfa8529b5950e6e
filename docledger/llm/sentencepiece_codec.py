"""SentencePiece encoding and decoding by an automaton and a single Viterbi pass.

Method: an Aho-Corasick automaton over the pieces of a vocabulary runs once over the text.  At each position its output
links give every piece that ends there; each relaxes the best way to its end from the best way to its start.  A character
that no piece covers is taken as its UTF-8 bytes where the vocabulary has byte pieces, else as unknown.

* A unigram vocabulary: the way with the highest sum of scores wins.  Ties go to the longer last piece.
* A merge vocabulary: scores are ranks of merges, and only one way to each position is what merging yields.  So a piece relaxes
  its end only from a piece beside which it stays: merging the text of the two must give these two again.  The ids are those
  that merging gives.

White space is marked by U+2581: each space becomes one mark, and one more stands before the text if the vocabulary says so.
Decoding gives the text back exactly unless it holds U+2581 itself, which decodes as a space.  Nothing else is normalised.

A text falls into stretches wherever two neighbouring characters stand side by side in no piece, since no piece can span
that place.  Which neighbours do is read from the vocabulary when it is loaded.  Each task keeps the ids of stretches it has
seen, in at most ``CACHE_BYTES``; a stretch is known by 128 bits of hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import numbered, renamed
from .kernel import Chunk, IdCache, _ranges, batches, strong_hashes

MARK = "▁"
#: Bytes of stretches and ids that a worker keeps.
CACHE_BYTES = 32 << 20
#: Pairs of pieces of which a worker remembers whether they can stand together.
PAIRS = 300_000
#: Bytes of text that are encoded at once.
CHUNK_BYTES = 512 << 10
_MARK_BYTES = MARK.encode("utf-8")
#: What an unknown character costs, below the lowest score.
UNKNOWN_PENALTY = 10.0
_NOTHING = float("-inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size


class Vocabulary:
    """Pieces, scores and kinds of a model file; the automaton over the pieces that stand for text."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            parts = dict(x for x in _fields(f.read()) if x[0] in (2, 3))
        # The kind of model is field 3 of the trainer's part, 1 unigram or 2 merges; the space in front is field 3
        # of the normaliser's part.
        self.merges = dict(_fields(parts.get(2, b""))).get(3, 1) == 2
        self.prefix_space = bool(dict(_fields(parts.get(3, b""))).get(3, 1))
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.unknown = model.unk_id()
        self.byte_id: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        self.size = n
        #: Id and score of each piece that stands for text.
        self.of: dict[str, tuple[int, float]] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and piece:
                self.of[piece] = i, model.get_score(i)
                # Ranks of merges decide which pieces stay side by side; a way over such pieces is the better the fewer it has.
                self.automaton.add_word(piece, (len(piece), i, -1.0 if self.merges else model.get_score(i)))
        self.automaton.make_automaton()
        self.floor = min((s for _, s in self.of.values()), default=0.0) - UNKNOWN_PENALTY
        self.alone = self._alone(list(self.of))
        self.is_byte = {i: b for b, i in self.byte_id.items()}
        self._fits: dict[int, bool] = {}
        self._chars = frozenset(x for x in self.of if len(x) == 1)

    def _alone(self, pieces: list[str]) -> np.ndarray | None:
        """Which ASCII bytes stand beside no other character in any piece; None if pieces go on across marks."""
        if any(MARK in p.lstrip(MARK) for p in pieces):
            return None
        inside = {c for p in pieces if len(p) > 1 for c in p}
        return np.array([b < 0x80 and b != 0x20 and chr(b) not in inside for b in range(256)])

    def merged(self, text: str) -> list[str]:
        """What merging makes of a text, by definition: the pair of the best score first, of equals the leftmost."""
        parts = list(text)
        while True:
            found = [(-self.of[x + y][1], k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in self.of]
            if not found:
                return parts
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def fits(self, before: int, piece: int) -> bool:
        """Whether merging leaves these two side by side; the start of a stretch, as ``before``, has the id behind the last."""
        key = before * (self.size + 1) + piece
        if len(self._fits) >= PAIRS:
            self._fits.clear()
        both = [self.pieces[k] for k in (before, piece) if k < self.size]
        got = self._fits[key] = self.merged("".join(both)) == both
        return got

    def segment(self, text: str) -> list[int]:
        """Ids of a text in which spaces are marks already: the best way over the pieces that end at each position.

        Of a merge vocabulary a piece relaxes its end only from a piece that it fits, and a character without a piece of its own
        fits nothing: what stands on either side of it is apart.
        """
        n, m, merges = len(text), self.size + 1, self.merges
        known, fits = self._fits.get, self.fits
        best, back, last = [_NOTHING] * (n + 1), [0] * (n + 1), [self.size] * (n + 1)
        best[0] = 0.0
        gaps, done = not merges or not self._chars.issuperset(text), 0
        for at, (size, i, score) in self.automaton.iter(text):
            if gaps:
                done = self._bridge(text, best, back, done, at)
            start = at + 1 - size
            got = best[start] + score
            if got > best[at + 1]:
                if merges:
                    before = last[start]
                    fit = known(before * m + i)
                    if not (fits(before, i) if fit is None else fit):
                        continue
                best[at + 1], back[at + 1], last[at + 1] = got, start, i
        if gaps:
            self._bridge(text, best, back, done, n)
        if best[n] == _NOTHING:  # equal ranks of merges may leave a position without a way; by definition then
            return self._ids(self.merged(text))
        way, at = [], n
        while at:
            way.append(text[back[at] : at] if gaps else last[at])
            at = back[at]
        return self._ids(way[::-1]) if gaps else way[::-1]

    def _bridge(self, text: str, best: list[float], back: list[int], done: int, upto: int) -> int:
        """Makes the best scores up to there final: a character at which no piece ends is bridged by an unknown one."""
        while done < upto:
            bridged = best[done] + self.floor
            done += 1
            if bridged > best[done] and not (self.merges and text[done - 1] in self._chars):
                best[done], back[done] = bridged, done - 1
        return done

    def _ids(self, parts: list[str]) -> list[int]:
        """Pieces by their ids, other characters by their bytes or as unknown, once for a run of them."""
        out: list[int] = []
        unknown = False
        for part in parts:
            known = self.of.get(part)
            if known is not None:
                out.append(known[0])
            elif self.byte_id:
                out += [self.byte_id[b] for b in part.encode("utf-8")]
            elif not unknown:
                out.append(self.unknown)
            unknown = known is None
        return out


class Codec:
    def __init__(self, path: str):
        self.vocabulary = v = Vocabulary(path)
        self.prefix = b" " if v.prefix_space else b""
        self.dtype = np.dtype(np.uint16 if v.size <= 1 << 16 else np.uint32)
        self.cache = IdCache(self.dtype, CACHE_BYTES)
        shown = [bytes([v.is_byte[i]]) if i in v.is_byte else (" \u2047 " if i == v.unknown else p).encode("utf-8") for i, p in enumerate(v.pieces)]
        self._shown = np.frombuffer(b"".join(shown), np.uint8)
        self._size = np.fromiter(map(len, shown), np.int64, len(shown))
        self._begin = np.cumsum(self._size) - self._size

    def rest(self) -> None:
        """Frees what a waiting worker does not need. What it knows of pairs of pieces stays; stretches are learned again soon."""
        self.cache = IdCache(self.dtype, CACHE_BYTES)
        pa.default_memory_pool().release_unused()

    def _starts(self, chunk: Chunk) -> np.ndarray:
        """Where stretches begin: at each text, at runs of spaces, at and after characters that stand alone."""
        first = np.zeros(len(chunk.buf), bool)
        if self.vocabulary.alone is not None:
            space, alone = chunk.buf == 0x20, self.vocabulary.alone[chunk.buf]
            first[1:] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
            # A mark in the text itself runs on into spaces.
            mark = np.flatnonzero((chunk.buf[:-3] == 0xE2) & (chunk.buf[1:-2] == 0x96) & (chunk.buf[2:-1] == 0x81) & space[3:])
            first[mark + 3] = False
        first[chunk.off[:-1]] = True
        ends = chunk.off[1:] - 1  # the separators
        first[ends] = False
        return np.flatnonzero(first)

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (UTF-8) in one array, and where each text's begin (one more entry than texts)."""
        chunk = Chunk([self.prefix + t if t else t for t in texts])
        if not len(chunk.buf):
            return np.zeros(0, self.dtype), np.zeros(1, np.int64)
        start = self._starts(chunk)
        first = np.searchsorted(start, chunk.off)
        end = np.minimum(np.append(start[1:], len(chunk.buf)), (chunk.off[1:] - 1)[np.repeat(np.arange(chunk.n), np.diff(first))])
        segment = self.vocabulary.segment

        def encode(which: np.ndarray) -> list[list[int]]:
            return [segment(chunk.raw[a:b].decode("utf-8", "replace").replace(" ", MARK)) for a, b in zip(start[which].tolist(), end[which].tolist(), strict=True)]

        ids, upto = self.cache(*strong_hashes(chunk.raw, start, end, 2), encode)
        return ids, upto[first]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text.encode("utf-8")])[0]

    def decode_all(self, ids: np.ndarray, upto: np.ndarray) -> Iterator[bytes]:
        """The text (UTF-8) of each run of ids; ``upto`` has where each begins and one more entry."""
        ids = ids.astype(np.int64)
        raw = _ranges(self._shown, self._begin[ids], self._size[ids]).tobytes()
        cut = np.concatenate([[0], np.cumsum(self._size[ids])])[upto].tolist()
        for a, b in zip(cut, cut[1:], strict=False):
            text = raw[a:b].replace(_MARK_BYTES, b" ")
            yield text[1:] if self.prefix and text.startswith(b" ") else text

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return next(self.decode_all(ids, np.array([0, len(ids)]))).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec_of(path: str) -> Codec:
    """The codec of this worker process, which keeps what it knows from one task to the next."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_documents(docs: DataFrame, path: str, keep: tuple[str, ...] = (), with_ids: bool = True, check: bool = False) -> DataFrame:
    """Columns of ``keep``, then ids (array<int>, if asked for), n_tokens, ids_crc32 and, with ``check``, round_trip.

    ids_crc32 is the CRC-32 of the ids as little-endian unsigned 32-bit integers; round_trip tells whether decoding gives
    the text back (marks count as spaces). A null or empty text has no ids. Texts of any length are encoded whole; equal rows
    give equal rows. A column of ``keep`` may have the name of a result; both are then in the table.
    """
    base = numbered(docs, keep, "text")
    kept = base.drop("text").schema
    names = [*kept.names, *["ids"] * with_ids, "n_tokens", "ids_crc32", *["round_trip"] * check]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["ids array<int>"] * with_ids + ["n_tokens long", "ids_crc32 long"] + ["round_trip boolean"] * check)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch, texts in batches(stream, CHUNK_BYTES):
            ids, at = codec.encode_all(texts)
            columns = [batch.column(k) for k in range(len(kept))]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
            wide = ids.astype("<u4")
            columns += [pa.array(np.diff(at)), pa.array([zlib.crc32(wide[a:b].data) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.int64())]
            if check:
                columns.append(pa.array([back == t.replace(_MARK_BYTES, b" ") for back, t in zip(codec.decode_all(ids, at), texts, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=names)
        codec.rest()

    return renamed(base.mapInArrow(run, schema), keep)


def decode_documents(tokens: DataFrame, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of ``keep`` and text, from a table with ids (array<int>); null ids give an empty text, a null id none."""
    base = numbered(tokens, keep, "ids")
    kept = base.drop("ids").schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["text string"])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in stream:
            texts = [codec.decode([i for i in ids if i is not None]) if ids else "" for ids in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(kept))), pa.array(texts, pa.string())], names=[*kept.names, "text"])

    return renamed(base.mapInArrow(run, schema), keep)
