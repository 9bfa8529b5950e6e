"""Substring, suffix-array and SimHash dedup against brute force."""

from __future__ import annotations

import os
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from docledger.llm import simhash as S
from docledger.llm.components import components
from docledger.llm.substring_dedup import COVER, PERIOD, substring_dedup
from docledger.llm.suffix_array import permuted_common_prefixes, suffix_array
from docledger.llm.suffix_dedup import suffix_dedup

from .conftest import rank

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


@pytest.mark.parametrize("block_bytes", [1 << 20, 4000])
def test_substring(docs, texts, block_bytes):
    rows = sorted(((rank(i), WORD.findall((t or "").encode())) for i, t in texts), key=lambda r: r[0])
    first: dict[tuple, int] = {}
    for i, w in rows:
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    expected = []
    for i, w in rows:
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        expected.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    got = [(rank(r.doc_id), r.n_words, r.n_removed, bytes(r.kept)) for r in substring_dedup(docs, block_bytes).collect()]
    assert sorted(got) == sorted(expected)
    assert sum(g[2] for g in got) > 500


@pytest.mark.parametrize(("block_bytes", "hot"), [(1 << 20, 20_000), (4000, 20_000), (4000, 2), (1 << 20, 0)])
def test_suffix(docs, texts, block_bytes, hot):
    rows = sorted(((rank(i), (t or "").encode()) for i, t in texts), key=lambda r: r[0])
    first: dict[bytes, tuple[int, int]] = {}
    for i, t in rows:
        for k in range(len(t) - 99):
            first[t[k : k + 100]] = min(first.get(t[k : k + 100], (i, k)), (i, k))
    expected = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 99):
            if first[t[k : k + 100]] < (i, k):
                gone[k : k + 100] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        expected.append((i, len(t), int(gone.sum()), spans, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    got = [(rank(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(docs, block_bytes, keep=("label",), hot_segments=hot).collect()]
    assert sorted(got) == sorted(expected)
    text = {(rank(r.doc_id), r.n_removed, r.kept) for r in suffix_dedup(docs, block_bytes, as_text=True, hot_segments=hot).collect()}
    assert text == {(i, n, k.decode("utf-8", "ignore")) for i, _, n, _, k in expected}


def test_empty_tables(no_docs):
    assert substring_dedup(no_docs).count() == 0
    assert suffix_dedup(no_docs).count() == 0
    assert S.near_duplicates(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 4))
def test_suffix_array(data, letters):
    data = bytes(b % letters for b in data)
    text = np.frombuffer(data, np.uint8)
    order = suffix_array(text)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    if not data:
        return
    common = permuted_common_prefixes(text, order, 20)
    for a, b in zip(order, order[1:], strict=False):
        n = 0
        while n < 20 and max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        assert common[b] == n


def test_suffix_array_of_copies_and_runs():
    rng = np.random.default_rng(4)
    for letters in (1, 2, 3, 26, 256):
        for _ in range(40):
            parts = [rng.integers(0, letters, rng.integers(1, 30)).astype(np.uint8).tobytes() for _ in range(4)]
            parts.append(bytes([int(rng.integers(letters))]) * int(rng.integers(1, 500)))
            data = b"".join(parts[k] for k in rng.integers(0, 5, rng.integers(0, 25)))
            order = suffix_array(np.frombuffer(data, np.uint8))
            assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    # Substrings of leftmost-S suffixes that are prefixes of one another, and of more letters than one number holds.
    for size in range(2, 24):
        up = bytes(range(100, 100 + size))
        data = (up + b"\x01" + up + b"\xf0\x01" + up + b"\xf0" * 400 + b"\x01" + up[:-1] + b"\x01") * 3
        assert suffix_array(np.frombuffer(data, np.uint8)).tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def _fingerprint(text: str | None) -> int:
    w = WORD.findall((text or "").encode().translate(LOWER))
    shingles = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    counts = Counter(bit for s in shingles for h in [xxhash.xxh64_intdigest(s, 42)] for bit in range(64) if h >> bit & 1)
    return sum(1 << bit for bit, n in counts.items() if 2 * n > len(shingles))


def _groups(values: list[int]) -> list[int]:
    up = list(range(len(values)))

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(values))]


@pytest.mark.parametrize("trie_rows", [1 << 15, 2])
def test_near_duplicates(docs, texts, trie_rows, monkeypatch):
    monkeypatch.setattr(S.links, "__defaults__", (S.BUDGET, trie_rows))
    values = [_fingerprint(t) for _, t in texts]
    roots = _groups(values)
    least = {}
    for (i, _), r in zip(texts, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    expected = sorted((rank(i), v, least.get(r, -1)) for (i, _), v, r in zip(texts, values, roots, strict=True))
    got = sorted((rank(r.doc_id), r.fp % 2**64, -1 if r.component_id is None else r.component_id) for r in S.near_duplicates(docs).collect())
    assert got == expected


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 120), st.integers(0, 20))
def test_trie(seed, n, root_bits):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 3, dtype=np.uint64)
    values = np.unique(np.array([int(centres[rng.integers(3)]) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 7)))) for _ in range(n)], np.uint64))
    pairs = S.trie_links(values, root_bits, most_pairs=50)
    assert len(pairs) < len(values)
    up = list(range(len(values)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs.tolist():
        assert int(values[a] ^ values[b]).bit_count() <= 4
        up[root(a)] = root(b)
    for i in range(len(values)):
        for j in range(i):
            if int(values[i] ^ values[j]).bit_count() <= 4 and (not root_bits or int(values[i]) >> (64 - root_bits) == int(values[j]) >> (64 - root_bits)):
                assert root(i) == root(j)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 150)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and got[200] == got[150] == 100 and all(got[k] == 500 for k in range(500, 560))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_large_trie_takes_little_memory():
    """32,768 random fingerprints with planted neighbours and a crowded one: every link is there, memory is bounded."""
    code = """
import resource
import numpy as np
from docledger.llm import simhash as S
rng = np.random.default_rng(4)
values = rng.integers(0, 2**64, 1 << 15, dtype=np.uint64)
def changed(v, least, most):
    v = v.copy()
    for k in range(len(v)):
        for b in rng.choice(64, rng.integers(least, most + 1), replace=False):
            v[k] ^= np.uint64(1) << np.uint64(b)
    return v
near, crowd = changed(values[:300], 1, 4), changed(np.repeat(values[:1], 2000), 0, 2)
whole = np.unique(np.concatenate([values, near, crowd]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
forest = S.Forest(len(whole))
for x, y in S.trie_links(whole, 0).tolist():
    assert bin(int(whole[x]) ^ int(whole[y])).count("1") <= 4 and forest.join(x, y)
root = lambda v: [forest.root(int(x)) for x in np.searchsorted(whole, v)]
assert root(near) == root(values[:300]) and len(set(root(crowd))) == 1
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=root)
    assert not done.returncode, done.stderr[-800:]
    assert int(done.stdout) < 400


@pytest.mark.parametrize("most_pairs", [2, 50])
def test_links_do_not_depend_on_the_frontier(most_pairs, monkeypatch):
    monkeypatch.setattr(S, "VALUE_PAIRS", 5)
    rng = np.random.default_rng(6)
    values = np.unique(np.concatenate([rng.integers(0, 2**12, 150, dtype=np.uint64), rng.integers(0, 2**64, 50, dtype=np.uint64)]))

    def groups(pairs):
        forest = S.Forest(len(values))
        for x, y in pairs:
            forest.join(x, y)
        return [forest.root(k) for k in range(len(values))]

    every = [(i, j) for i in range(len(values)) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= 4]
    assert groups(S.trie_links(values, 0, most_pairs=most_pairs).tolist()) == groups(every)
