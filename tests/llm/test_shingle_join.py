"""The pipeline's near-duplicate stage against brute-force Jaccard similarity."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as P
from docledger.llm.shingle_join import similar_documents

from .conftest import rank


def _shingles(text: str | None) -> frozenset:
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def _groups(texts: list[str | None]) -> list[int]:
    sets, up = [_shingles(t) for t in texts], list(range(len(texts)))

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b) > 0:
                up[root(i)] = root(j)
    return [root(i) for i in range(len(texts))]


def make_edited(seed: int = 3) -> list[str]:
    """Texts and copies of them with some words changed, on either side of the bound, with a passage common to most."""
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(60))
    out = []
    for _ in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(4, 200))]
        tail = " " + passage if rng.random() < 0.6 else ""
        for _ in range(rng.randint(1, 5)):
            edited = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                edited[rng.randrange(len(edited))] = f"x{rng.randrange(5000)}"
            out.append(" ".join(edited) + tail)
    return out


def _partition(labels: list) -> set[frozenset]:
    by: dict = {}
    for k, x in enumerate(labels):
        by.setdefault(x, []).append(k)
    return {frozenset(v) for v in by.values()}


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_edited_copies(spark, block):
    texts = make_edited()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    expected = _partition(_groups(texts))
    got = dict(similar_documents(docs, block=block).select("doc_id", "group").collect())
    assert _partition([got[k] for k in range(len(texts))]) == expected
    assert len(expected) < len(texts) - 20
    if block < 1000:
        return
    stay = {r.doc_id for r in P.drop_near_duplicates(spark, docs, "").collect()}
    assert stay == {min(g) for g in expected}


def test_awkward_rows(docs, texts):
    rows = sorted(((rank(i), t) for i, t in texts), key=lambda r: (r[0], r[1] or ""))
    got = sorted(((rank(r.doc_id), r.text or "", r.group) for r in similar_documents(docs.selectExpr("doc_id", "text", "text as t"), keep=("t",)).selectExpr("doc_id", "t as text", "group").collect()))
    assert _partition([g for _, _, g in got]) == _partition(_groups([t for _, t in rows]))


def test_no_rows(no_docs):
    assert similar_documents(no_docs).count() == 0
