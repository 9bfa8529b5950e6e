"""Vectorised text kernels shared by the operators of this subpackage.

Documents are handled as UTF-8 bytes in chunks: one flat ``uint8`` buffer that holds every document of the chunk followed
by one separator byte.  Word boundaries, word hashes and window hashes are then array operations over the whole chunk,
so no Python statement runs per word or per byte.

Two kinds of hash serve two ends.  ``RangeHash`` is a polynomial prefix hash modulo 2**64: the hash of any byte range costs
one subtraction and one multiplication, but texts can be made that collide, so it only orders, samples and deals.
``strong_hashes`` mixes eight bytes at a time; where equality is decided, two of its lanes are compared, 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_COEF = [_rng.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1) for _ in range(2)]
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 2**64)
_MASK64 = 2**64 - 1


def _class_table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], dtype=bool)


#: Words are runs of bytes outside ASCII white space.
PLAIN_WORD = _class_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words are runs of ASCII digits, ASCII letters and non-ASCII bytes.
ALNUM_WORD = _class_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A or b >= 0x80)
#: Lower-cases A-Z only.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, key: str) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the usual chunk sizes."""
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base & _MASK64, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, dtype=np.uint64, out=have)
        if size <= 1 << 22:
            _powers[key] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every output bit depends on every input bit."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class RangeHash:
    """Hashes of arbitrary byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[buf] * _power(_R, n, "r"), dtype=np.uint64, out=self.prefix[1:])
        self.inv = _power(_RINV, n + 1, "i")

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.inv[start])


#: Seeds of the lanes of ``strong_hashes``.
_SEEDS = _rng.integers(1, 2**63, (4, 3), dtype=np.uint64)
#: Ranges of more bytes than this are hashed one by one.
_LONG = 256


def strong_hashes(raw: bytes, start: np.ndarray, end: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
    """Hashes of byte ranges, one array for each lane; every step is a non-linear mix of the next eight bytes."""
    size = end - start
    padded = raw + bytes(8)
    words = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))  # eight bytes from any place
    out = []
    for lane in range(lanes):
        a, b, c = _SEEDS[lane]
        h = mix(size.astype(np.uint64) * U64(_R) + a)
        at, left, open_ = start, size, np.arange(len(size))
        if (size > _LONG).any():
            open_ = np.flatnonzero(size <= _LONG)
            at, left = at[open_], left[open_]
        while len(open_):
            x = words[at]
            short = left < 8
            x[short] &= (U64(1) << (left[short] * 8).astype(np.uint64)) - U64(1)
            h[open_] = mix((h[open_] ^ mix(x + b)) + c)
            more = np.flatnonzero(left > 8)
            open_, at, left = open_[more], at[more] + 8, left[more] - 8
        out.append(h)
    for k in np.flatnonzero(size > _LONG).tolist():
        digest = xxhash.xxh3_128_intdigest(raw[start[k] : end[k]])
        for lane in range(lanes):
            out[lane][k] = (digest >> 64 * (lane % 2)) & _MASK64
    return out


class Chunk:
    """Some documents as one buffer. ``off[i]`` is where document i starts; one separator byte follows each document."""

    def __init__(self, texts: list[bytes], separator: bytes = b"\n"):
        self.n = len(texts)
        lens = np.fromiter(map(len, texts), np.int64, self.n)
        self.len = lens
        self.off = np.zeros(self.n + 1, np.int64)
        np.cumsum(lens + 1, out=self.off[1:])
        self.raw = separator.join(texts) + separator if texts else b""
        self.buf = np.frombuffer(self.raw, np.uint8)

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and for each document the number of its first word (one more entry than documents)."""
        inside = table[self.buf]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate([np.zeros(1, edge.dtype), edge])
        start, end = edge[0::2], edge[1::2]  # the buffer ends outside a word
        return start, end, np.searchsorted(start, self.off)

    def word_hashes(self, start: np.ndarray, end: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
        return strong_hashes(self.raw, start, end, lanes)


def window_hash(word_hash: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """The hash of each run of ``width`` consecutive words, by its first word."""
    n = len(word_hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = word_hash[:n] * _COEF[lane][0]
    for t in range(1, width):
        out += word_hash[t : t + n] * _COEF[lane][t]
    return mix(out)


def segment_ids(first: np.ndarray, total: int) -> np.ndarray:
    """For each of ``total`` items, the document that holds it; ``first`` has each document's first item and the end."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first)) if total else np.zeros(0, np.int64)


def cover(mask_starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n items are covered by a run of ``width`` items that starts at one of the given items."""
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, mask_starts, 1)
    np.add.at(delta, np.minimum(mask_starts + width, n), -1)
    return np.cumsum(delta[:n]) > 0


class _Known:
    """Pieces and their ids, sorted by the first hash of a piece: about 36 bytes a piece and its ids."""

    def __init__(self, dtype):
        self.hashes, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, dtype)

    def find(self, hashes: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The slot of each piece, -1 for one that is not there."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        slot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[slot] == hashes) & (self.check[slot] == check), slot, -1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether a piece with this first hash is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)] == hashes

    def add(self, hashes: np.ndarray, check: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        at = np.searchsorted(self.hashes, hashes)
        begin = len(self.ids) + np.cumsum(size) - size
        self.hashes, self.check = np.insert(self.hashes, at, hashes), np.insert(self.check, at, check)
        self.begin, self.size = np.insert(self.begin, at, begin), np.insert(self.size, at, size.astype(np.int32))
        self.ids = np.concatenate([self.ids, ids])

    @property
    def nbytes(self) -> int:
        return 28 * len(self.hashes) + self.ids.nbytes


class IdCache:
    """The ids of pieces of text, in at most about ``most`` bytes: two halves, the older of which goes when the newer is full.

    A piece is known by two hashes of 64 bits; one that shares the first with another piece only is encoded each time.
    """

    def __init__(self, dtype, most: int):
        self.dtype, self.most = np.dtype(dtype), most
        self.new, self.old = _Known(self.dtype), _Known(self.dtype)

    def __call__(self, hashed: np.ndarray, check: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each piece's ids begin (one more entry). ``encode`` gets the numbers of pieces to encode."""
        distinct, where, which = np.unique(hashed, return_index=True, return_inverse=True)
        odd = np.flatnonzero(check != check[where][which])
        if len(odd):  # two pieces with one first hash: the later ones stand for themselves
            which = which.copy()
            which[odd] = len(where) + np.arange(len(odd))
            where = np.concatenate([where, odd])
        single = np.arange(len(where)) >= len(distinct)
        slot = self.new.find(hashed[where], check[where])
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # pieces, sizes, ids
        have = np.flatnonzero(slot >= 0)
        got.append(self._take(self.new, slot[have], have))
        rest = np.flatnonzero(slot < 0)
        older = self.old.find(hashed[where[rest]], check[where[rest]])
        got.append(self._take(self.old, older[older >= 0], rest[older >= 0]))
        fresh = rest[older < 0]
        made = encode(where[fresh]) if len(fresh) else []
        size = np.fromiter(map(len, made), np.int64, len(made))
        got.append((fresh, size, np.fromiter((i for ids in made for i in ids), self.dtype, int(size.sum()))))
        for pieces, sizes, ids in got[1:]:
            if len(pieces):
                order = np.flatnonzero(~single[pieces] & ~self.new.holds(hashed[where[pieces]]))
                begin = np.cumsum(sizes) - sizes
                self.new.add(hashed[where[pieces[order]]], check[where[pieces[order]]], sizes[order], _ranges(ids, begin[order], sizes[order]))
        if 2 * self.new.nbytes > self.most:
            self.old, self.new = self.new, _Known(self.dtype)
        sizes, begins = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
        flat, at = np.concatenate([ids for _, _, ids in got]), 0
        for pieces, n, ids in got:
            sizes[pieces], begins[pieces] = n, at + np.cumsum(n) - n
            at += len(ids)
        size = sizes[which]
        return _ranges(flat, begins[which], size), np.concatenate([[0], np.cumsum(size)])

    @staticmethod
    def _take(known: _Known, slot: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = known.size[slot].astype(np.int64)
        return pieces, size, _ranges(known.ids, known.begin[slot], size)


def _ranges(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of an array, one after the other."""
    upto = np.cumsum(size)
    total = int(upto[-1]) if len(upto) else 0
    return values[np.repeat(begin - (upto - size), size) + np.arange(total)]


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string or binary column as bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        return [x or b"" for c in column.chunks for x in c.cast(pa.large_binary()).to_pylist()]
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Cuts a list of texts into runs of about ``most`` bytes; a longer text is a run of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield begin, i
            begin, size = i, 0
        size += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def batches(stream: Iterable[pa.RecordBatch], most: int, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Arrow batches cut so that each holds about ``most`` bytes of text, with the texts as bytes; only one cut's are made at a time."""
    for batch in stream:
        at = batch.schema.get_field_index(text)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        begin, size = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if size and size + n > most:
                yield batch.slice(begin, i - begin), texts_of(batch.column(at).slice(begin, i - begin))
                begin, size = i, 0
            size += n + 1
        if begin < batch.num_rows:
            yield batch.slice(begin), texts_of(batch.column(at).slice(begin))
