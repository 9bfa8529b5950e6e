"""Best two fit against a plain version that packs one sequence at a time, encoding against the library, and whole results."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docledger.llm import packing
from docledger.llm.queries import QUERIES, _vocabulary

SF = "/root/testdata/sf0.001"


def plain_plan(counts: dict[int, int], size: int) -> list[list[int]]:
    """One sequence at a time, piece by piece."""
    left, out = Counter({l: n for l, n in counts.items() if n}), []
    while left:
        bin_, gap = [], size
        while fitting := [l for l in left if l <= gap]:
            bin_.append(max(fitting))
            gap -= bin_[-1]
            left[bin_[-1]] -= 1
            left = +left
        last = bin_[-1]
        if gap and len(bin_) > 1:
            pairs = [(a + b, a, b) for a in left for b in left if a >= b and (a != b or left[a] > 1) and last < a + b <= gap + last]
            if pairs:
                _, a, b = max(pairs)
                left.subtract([a, b])
                left[last] += 1
                left, bin_ = +left, [*bin_[:-1], a, b]
        out.append(sorted(bin_, reverse=True))
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(5, 60).flatmap(lambda size: st.tuples(st.just(size), st.dictionaries(st.integers(1, size), st.integers(0, 40), max_size=12))))
def test_plan_is_the_plain_one(case):
    size, counts = case
    got = [l for p in packing.best_two_fit(counts, size) for _ in range(p.repeats) for l in [[l for l, n in p.uses for _ in range(n)]]]
    assert sorted(got) == sorted(plain_plan(counts, size))


def test_plan_size_does_not_grow_with_the_pieces():
    few = packing.best_two_fit({l: 50 for l in range(1, 2049)})
    many = packing.best_two_fit({l: 50 * 10**7 for l in range(1, 2049)})
    assert len(many) < 2 * len(few) < 20_000
    used: Counter = Counter()
    for p in many:
        assert sum(l * n for l, n in p.uses) <= 2048
        for l, n in p.uses:
            used[l] += n * p.repeats
    assert used == {l: 50 * 10**7 for l in range(1, 2049)}


HARD = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", " don't", "1", "23", "É", "ß", "€", "日本", " ", " ", "　", "\u0085", "x", "!", "#", "<|endoftext|>", "<|", "\r\n", "\x1c", "ª", "\x00", "foo", "THE "]


def test_ids_are_the_library_s(monkeypatch):
    from tokenizers import Tokenizer

    path = _vocabulary("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), packing.ByteLevelEncoder(path, 0, "uint16")
    assert encoder.by_piece
    rng = random.Random(3)
    texts = ["", " ", "\n \n", *("".join(rng.choice(HARD) for _ in range(rng.randint(0, 25))) for _ in range(3000))]
    expected = [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert [x.tolist() for x in encoder.documents([t.encode() for t in texts])] == expected
    # Cut into small parts.
    monkeypatch.setattr(packing, "CHUNK_BYTES", 12)
    long = [" ".join(rng.choice(["one", "two's", "drei", "vier!", "É", "\n\n6", "  7"]) for _ in range(60)) for _ in range(50)]
    assert [x.tolist() for x in encoder.documents([t.encode() for t in long])] == [library.encode(t, add_special_tokens=False).ids + [0] for t in long]


def test_other_vocabularies_go_through_the_library():
    from tokenizers import Tokenizer

    path = _vocabulary("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), packing.ByteLevelEncoder(path, 1, "uint16")
    assert not encoder.by_piece
    texts = ["Some words, it's THEM", "", "é 1 2"]
    assert [x.tolist() for x in encoder.documents([t.encode() for t in texts])] == [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def _check(rows, texts, size):
    """Everything the contract says about pieces and sequences; returns the lengths by sequence."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(_vocabulary("byte_bpe_50k.json"))
    expected: Counter = Counter()
    for doc_id, text in texts:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        head = len(ids) % size or min(size, len(ids))
        for k, (a, b) in enumerate(zip([0, *range(head, len(ids), size)], range(head, len(ids) + 1, size), strict=True)):
            expected[doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in by.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at and length > 0
            at += length
        assert at <= size
    return [sorted((l for _, l in m), reverse=True) for m in by.values()]


@pytest.mark.parametrize("size", [32, 256])
def test_awkward_rows(docs, texts, size, monkeypatch):
    monkeypatch.setattr(packing, "SHARE_ROWS", 4)
    monkeypatch.setattr(packing, "SHARES", 3)
    rows = packing.pack(docs, _vocabulary("byte_bpe_50k.json"), 0, size).collect()
    found = _check(rows, texts, size)
    counts = Counter(l for m in found for l in m)
    assert sorted(found) == sorted(plain_plan(counts, size))


def test_empty_table(no_docs):
    assert packing.pack(no_docs, _vocabulary("byte_bpe_50k.json"), 0).collect() == []


def test_sequences_hold_the_ids(docs, texts):
    packed = packing.pack(docs, _vocabulary("byte_bpe_50k.json"), 0, 128, with_ids=True)
    rows = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for p in packed.collect():
        whole = rows[p.sequence_id]
        part = slice(p.offset, p.offset + p.length)
        assert zlib.crc32(np.array(whole.ids[part], "<u4").tobytes()) == p.ids_crc32 and set(whole.doc_ids[part]) == {p.doc_id}
    assert sum(len(r.ids) for r in rows.values()) == sum(p.length for p in packed.collect())


def test_query(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = _check(QUERIES["op11_packing"](spark, SF).collect(), texts, 2048)
    total = sum(map(sum, found))
    assert len(found) <= -(-total // 2048) * 1.02 + 1
