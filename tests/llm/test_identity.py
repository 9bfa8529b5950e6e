"""Texts on which simple polynomial hashes collide: equality is decided by strong hashes or by bytes."""

from __future__ import annotations

import numpy as np
import pytest

from docledger.llm import quality_rules as Q
from docledger.llm.decontaminate import decontaminate
from docledger.llm.kernel import IdCache, RangeHash, strong_hashes
from docledger.llm.sentencepiece_codec import Codec, encode_documents
from docledger.llm.substring_dedup import substring_dedup
from docledger.llm.suffix_dedup import suffix_dedup
from docledger.llm.token_files import piece_encoder

vocabularies = pytest.importorskip("public_tokenizers")


def thue_morse(n: int) -> tuple[str, str]:
    """A word over a and b, and the word with a and b exchanged."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 4096])
def test_hashes(n):
    one, two = (x.encode() for x in thue_morse(n))
    buf = np.frombuffer(one + two, np.uint8)
    start, end = np.array([0, n]), np.array([n, 2 * n])
    weak = RangeHash(buf)(start, end)
    assert weak[0] == weak[1]
    for lane in strong_hashes(one + two, start, end, 2):
        assert lane[0] != lane[1]


def test_hash_of_every_length():
    raw = bytes(range(256)) * 4
    start = np.arange(0, 300)
    for size in (0, 1, 7, 8, 9, 255, 256, 257, 600):
        one, two = strong_hashes(raw, start, start + size, 2), strong_hashes(raw[5:], start[5:] - 5, start[5:] + size - 5, 2)
        assert all((a[5:] == b).all() for a, b in zip(one, two, strict=True))
        if size > 1:
            assert len(np.unique(one[0][:256])) == 256


def test_cache_knows_a_piece_by_both_hashes():
    cache = IdCache(np.uint16, 1 << 20)
    hashed, check = np.array([5, 5, 9, 5], np.uint64), np.array([1, 2, 3, 1], np.uint64)
    for _ in range(2):
        ids, upto = cache(hashed, check, lambda which: [[int(10 * hashed[k] + check[k])] for k in which.tolist()])
        assert ids.tolist() == [51, 52, 93, 51] and upto.tolist() == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("n", [1024, 4096])
def test_operators(spark, n):
    one, two = thue_morse(n)
    rest = " ".join(f"w{k}" for k in range(12))
    rows = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}")], "doc_id long, text string").coalesce(1)
    assert {r.doc_id: r.n_removed for r in substring_dedup(rows).collect()} == {1: 0, 2: 0, 3: 13}
    bench = spark.createDataFrame([(1, f"{one} {rest}"[: n + 25])], "item_id long, text string")
    assert {r.doc_id: r.n_hit > 0 for r in decontaminate(rows, bench).collect()} == {1: True, 2: False, 3: True}
    path = vocabularies.path("piece_bpe_32k.model")
    assert all(r.round_trip for r in encode_documents(rows, path, check=True).collect())
    codec = Codec(path)
    assert codec.encode(one).tolist() != codec.encode(two).tolist() and codec.decode(codec.encode(two)) == two
    encode = piece_encoder(vocabularies.path("word_bpe_49k.json"), None, "uint16")
    for text in (one, two):
        assert encode([text.encode()])[0].tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids
    cut = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix_dedup(rows).collect()}
    first, expected = set(), {}
    for i, t in ((1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}")):
        raw, gone, mine = t.encode(), np.zeros(len(t), bool), set()
        for k in range(len(raw) - 99):
            x = raw[k : k + 100]
            if x in first or x in mine:
                gone[k : k + 100] = True
            mine.add(x)
        first |= mine
        expected[i] = int(gone.sum()), np.frombuffer(raw, np.uint8)[~gone].tobytes()
    assert cut == expected


def test_repeated_words_of_a_long_text(spark):
    words = [f"w{k % 150_000}" for k in range(200_000)]
    rows = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (row,) = Q.quality_rules(rows, rows.select("doc_id"), buckets=1 << 10).collect()
    assert row.n_words == 200_000 and row.n_repeat_words == 100_000
