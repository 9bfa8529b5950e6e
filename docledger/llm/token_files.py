"""Token ids as Arrow files with equal-length sequences, and their reader.

One file for each range of doc_id, in the Arrow file format.  A record batch holds ``BATCH`` sequences: ``ids``, a
fixed-size list of ``LENGTH`` unsigned 16- or 32-bit ids, and ``mask``, a fixed-size list of booleans that is false only in
the padding of a file's last sequence.  Documents run through the sequences back to back.  The buffers are uncompressed,
so a reader that maps the file reaches sequence i of a batch at a fixed offset without copying.  Beside each file stands a
second one with doc_id, start (within the file) and n_tokens of each document.

A task writes files with names of its own and returns them; the table of files, which Spark commits, lists those of the
attempts that count, so a task that runs twice or dies leaves at most files that nothing names.  Files go to a folder that
all executors share, through a file system found from its URI.

Encoding: a vocabulary whose rules are ``NORMALIZER`` and ``PRE_TOKENIZER`` splits a text at white space and between letters,
single digits and other characters, and lower-cases it, so pieces of a text never change their ids with their neighbours.
Pieces of ASCII and of Latin-1 letters are found as array operations; the library's model encodes each distinct one.  A word
with any other character, with an apostrophe (contractions) or with ``<|`` (special tokens) goes through the whole library.
Each worker keeps the ids of pieces it has seen, in at most ``CACHE_BYTES``; a piece is known by 128 bits of hash.  With a
vocabulary of other rules, whole texts go through the library.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import parts, text_bytes
from .kernel import LOWER, Chunk, IdCache, batches, strong_hashes

LENGTH = 2048
BATCH = 256
#: Bytes of pieces and ids that a worker keeps.
CACHE_BYTES = 32 << 20
#: Bytes of text whose ids go to one file, about.
FILE_BYTES = 32 << 20
#: Bytes of text that are encoded at once.
CHUNK_BYTES = 1 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir.

    Where that is not set, a session on one machine gets a temporary folder; a cluster is refused, since its machines share none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        base = f"file://{tempfile.gettempdir()}/docledger-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", base)
        atexit.register(shutil.rmtree, base.removeprefix("file://"), ignore_errors=True)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


_SPACE, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
_CLASS = np.array(
    [
        _SPACE if b == 0x20 or 0x09 <= b <= 0x0D else _DIGIT if 0x30 <= b <= 0x39 else _LETTER if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A else _OTHER if 0x21 <= b <= 0x7E and b != 0x27 else _ODD
        for b in range(256)
    ],
    np.uint8,
)
_LOWER = np.frombuffer(LOWER, np.uint8)
#: How a byte-level vocabulary writes a byte: printable Latin-1 as itself, the others in order from U+0100.
_shown = {b: b for b in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]}
_BYTE = [chr(_shown.get(b, 0x100 + sum(x not in _shown for x in range(b)))) for b in range(256)]


# The rules for which pieces can be found without the library.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class PieceEncoder:
    """Encodes texts piece by piece. A piece is bytes ``start`` .. ``end`` of the lower-cased text."""

    def __init__(self, path: str, end_id: int | None, dtype):
        from tokenizers import Tokenizer

        with _files(path)[0].open_input_stream(_files(path)[1]) as f:
            text = f.read().decode("utf-8")
        rules = json.loads(text)
        added = [x["content"] for x in rules.get("added_tokens") or []]
        self.by_piece = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER and all(x.startswith("<|") and not (set(x) & set(" \t\n")) for x in added)
        self.tokenizer = Tokenizer.from_str(text)
        self.model = self.tokenizer.model
        self.dtype, self.end_id = np.dtype(dtype), end_id
        self.cache = IdCache(self.dtype, CACHE_BYTES)

    @staticmethod
    def _pieces(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The lower-cased buffer, and of each piece the start, the end and whether it needs the whole library."""
        kind = _CLASS[buf]
        lower = _LOWER[buf]
        lead = np.flatnonzero(buf[:-1] == 0xC3)
        second = buf[lead + 1]
        good = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)
        lead, second = lead[good], second[good]
        kind[lead] = kind[lead + 1] = _LETTER
        lower[lead + 1] = np.where(second <= 0x9E, second + 0x20, second)
        kind[np.flatnonzero((buf[:-1] == 0x3C) & (buf[1:] == 0x7C))] = _ODD
        inside = kind != _SPACE
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate([np.zeros(1, edge.dtype), edge])
        w_start, w_end = edge[0::2], edge[1::2]
        if not len(w_start):
            return lower, w_start, w_end, np.zeros(0, bool)
        odd_at = np.flatnonzero(kind == _ODD)
        odd_word = np.searchsorted(odd_at, w_start) != np.searchsorted(odd_at, w_end)
        for a, b in zip(w_start[odd_word].tolist(), w_end[odd_word].tolist(), strict=True):
            kind[a:b] = _ODD
            lower[a:b] = buf[a:b]
        first = np.zeros(len(buf), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        first[0] = True
        start = np.flatnonzero(first & inside)
        stop = np.flatnonzero(first)
        end = stop[np.searchsorted(stop, start, side="right")]  # the buffer ends with a separator
        return lower, start, end, kind[start] == _ODD

    def _encode(self, piece: bytes, odd: bool) -> list[int]:
        if odd:
            return self.tokenizer.encode(piece.decode("utf-8"), add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize("".join([_BYTE[b] for b in piece]))]

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each has."""
        chunk = Chunk(texts)
        if not len(chunk.buf):
            return np.zeros(0, self.dtype), np.zeros(len(texts), np.int64)
        if self.by_piece:
            ids, upto = self._by_piece(chunk)
        else:
            got = [self.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
            upto = np.concatenate([[0], np.cumsum([len(x) for x in got], dtype=np.int64)])
            ids = np.fromiter((i for x in got for i in x), self.dtype, int(upto[-1]))
        count = np.diff(upto)
        if self.end_id is not None:
            ids = np.insert(ids, upto[1:], self.end_id)
            count = count + 1
        return ids, count

    def _by_piece(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        lower, start, end, odd = self._pieces(chunk.buf)
        raw = lower.tobytes()
        hashed, check = strong_hashes(raw, start, end, 2)
        # The same bytes through the whole library are another piece.
        hashed ^= np.where(odd, np.uint64(0xA5A5A5A55A5A5A5A), np.uint64(0))
        ids, upto = self.cache(hashed, check, lambda w: [self._encode(raw[a:b], o) for a, b, o in zip(start[w].tolist(), end[w].tolist(), odd[w].tolist(), strict=True)])
        return ids, upto[np.searchsorted(start, chunk.off)]


_encoders: dict[tuple, PieceEncoder] = {}


def piece_encoder(path: str, end_id: int | None, dtype: str) -> PieceEncoder:
    """The encoder of this worker process, which keeps what it knows from one task to the next."""
    key = (path, end_id, dtype)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, end_id, dtype)
    return _encoders[key]


def _id_type(vocabulary: int):
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32


def _write_file(fs, path: str, documents: Iterator[tuple[pa.Array, np.ndarray, np.ndarray]], dtype, index_path: str) -> tuple[int, int]:
    """From batches of doc_ids, ids and counts. Returns the numbers of documents and ids."""
    kind = pa.from_numpy_dtype(dtype)
    schema = pa.schema([("ids", pa.list_(kind, LENGTH)), ("mask", pa.list_(pa.bool_(), LENGTH))])
    most = LENGTH * BATCH
    doc_ids: list[pa.Array] = []
    counts: list[np.ndarray] = [np.zeros(0, np.int64)]
    with fs.open_output_stream(path) as sink, pa.ipc.new_file(sink, schema) as writer:

        def write(ids: np.ndarray) -> None:
            pad = -len(ids) % LENGTH
            flat = np.concatenate([ids, np.zeros(pad, dtype)])
            mask = np.arange(len(flat)) < len(ids)
            arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), LENGTH) for x in (flat, mask)]
            writer.write_batch(pa.record_batch(arrays, schema=schema))

        held = np.zeros(0, dtype)
        for names, ids, count in documents:
            doc_ids.append(names)
            counts.append(count)
            held = np.concatenate([held, ids])
            whole = len(held) // most * most
            for a in range(0, whole, most):
                write(held[a : a + most])
            held = held[whole:]
        if len(held):
            write(held)
    n = np.concatenate(counts)
    index = pa.table({"doc_id": pa.chunked_array(doc_ids, pa.int64()).combine_chunks(), "start": np.cumsum(n) - n, "n_tokens": n})
    with fs.open_output_stream(index_path) as sink, pa.ipc.new_file(sink, index.schema) as writer:
        writer.write_table(index)
    return len(n), int(n.sum())


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None, n_files: int | None = None) -> DataFrame:
    """Writes the files in ascending doc_id order and returns a small table: part, file, index, n_docs, n_tokens.

    A null text is empty; texts of any length are whole. A null doc_id comes first. Rows of one doc_id follow each other by a
    hash of their text, so a doc_id that very many rows have, null too, is spread over files. Other columns are not read.
    """
    n_files = n_files or parts(docs, text_bytes(docs), FILE_BYTES)
    from tokenizers import Tokenizer

    dtype = np.dtype(_id_type(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True))).name
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    ranged = rows.repartitionByRange(n_files, "doc_id", "digest").sortWithinPartitions("doc_id", "digest", "text").select("doc_id", "text")

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, base = _files(folder)
        fs.create_dir(base, recursive=True)
        encode = piece_encoder(tokenizer_path, end_id, dtype)

        def documents():
            for rows, texts in batches(stream, CHUNK_BYTES):
                yield rows.column(0), *encode(texts)

        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        file, index = f"{name}.ids.arrow", f"{name}.index.arrow"
        n_docs, n_tokens = _write_file(fs, f"{base}/{file}", documents(), dtype, f"{base}/{index}")
        yield pa.record_batch({"part": [part], "file": [file], "index": [index], "n_docs": [n_docs], "n_tokens": [n_tokens]})

    return ranged.mapInArrow(write, "part long, file string, index string, n_docs long, n_tokens long")


class TokenFile:
    """Random access to one file: ``sequence(i)`` and ``ids(start, n)`` are views where one batch holds them."""

    def __init__(self, fs, path: str):
        self.source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)

    def _flat(self, k: int) -> np.ndarray:
        return self.reader.get_batch(k).column(0).values.to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        k, r = divmod(i, BATCH)
        batch = self.reader.get_batch(k)
        return self._flat(k)[r * LENGTH : (r + 1) * LENGTH], batch.column(1)[r].values

    def pieces(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids start .. start+n-1, as one view for each batch that holds some of them."""
        while n > 0:
            k, r = divmod(start, LENGTH * BATCH)
            part = self._flat(k)[r : r + n]
            yield part
            start, n = start + len(part), n - len(part)


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """Reads the files back: doc_id, start (over all files), n_tokens, ids_crc32 of the ids as little-endian uint32.

    ``files`` is what ``write_token_files`` returned, once it has been written: a row for each file.
    """
    # One narrow row for each file.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = files.select("file", "index", before.alias("before")).repartition(max(1, files.count()))

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for file, index, offset in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                fs, base = _files(folder)
                with fs.open_input_file(f"{base}/{index}") as f:
                    docs = pa.ipc.open_file(f).read_all()
                if not docs.num_rows:
                    continue
                tokens = TokenFile(fs, f"{base}/{file}")
                crc = []
                for start, n in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist(), strict=True):
                    c = 0
                    for piece in tokens.pieces(start, n):
                        c = zlib.crc32(piece.astype("<u4").data, c)
                    crc.append(c)
                docs = docs.combine_chunks()
                yield pa.record_batch([docs.column("doc_id").chunk(0), pa.array(docs.column("start").to_numpy() + offset), docs.column("n_tokens").chunk(0), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int | None, folder: str | None = None) -> DataFrame:
    """Writes the files, then returns the reader's table over them."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    write_token_files(docs, folder, tokenizer_path, end_id).write.mode("overwrite").parquet(f"{folder}/files.parquet")
    return read_token_files(spark.read.parquet(f"{folder}/files.parquet"), folder)
