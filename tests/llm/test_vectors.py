"""Codes against plain rounds, whitening against a plain solution, and rows of every awkward kind."""

from __future__ import annotations

import hashlib
import math
import random
from decimal import Decimal

import numpy as np
import pytest

from docledger.llm import vector_codes, whitening
from docledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def plain_codes(rows: list[tuple], parts: int = 8, k: int = 16, rounds: int = 6):
    """(vec_id, label, code, error) of each row, the errors by label, and the digest; Python integers throughout."""
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    d = width // parts
    ints = [[max(-(2**52), min(2**52, math.floor(4096 * c))) for c in v] + [0] * (width - len(v)) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1], kept[n][2] is not None, kept[n][2] or 0))[:k]
    books = [[ints[n][p * d : (p + 1) * d] for n in order] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), n) for n, e in enumerate(book))

    for r in range(rounds + 1):
        found = [[nearest(x[p * d : (p + 1) * d], books[p]) for p in range(parts)] for x in ints]
        if r < rounds:
            for p in range(parts):
                for e in range(len(order)):
                    mine = [x[p * d : (p + 1) * d] for x, f in zip(ints, found, strict=True) if f[p][1] == e]
                    if mine:
                        books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    coded = [(i, l, "".join(f"{n:02x}" for _, n in f), sum(s for s, _ in f)) for (i, _, l), f in zip(kept, found, strict=True)]
    errors: dict = {}
    for _, l, _, e in coded:
        errors[l] = errors.get(l, 0) + e
    return coded, errors, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def make_rows(seed: int = 0, n: int = 120, width: int = 16, spread: float = 0.3) -> list[tuple]:
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = [(k * 3 % 101, [float(np.float32(c + rng.gauss(0, spread))) for c in rng.choice(centres)], rng.choice([None, 1, 1, 2])) for k in range(n)]
    rows += [rows[0], rows[0], (None, rows[1][1], 7), (None, None, 1), (5, [NAN] * width, 1), (6, [INF] + [0.0] * (width - 1), 1), (7, [None] + [0.0] * (width - 1), None), (8, [0.0] * (width - 3), 9), (9, [], 9), (10, [0.5] * width, 2), (11, [0.5] * width, 2)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, kind="float"):
    full = [(i, v, l, "x", 1.0, 3, "y") for i, v, l in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding array<{kind}>, label int, code string, error double, seen long, vector string").repartition(3)


def key(row):
    return tuple((x is None, 0 if x is None else x) for x in row)


@pytest.mark.parametrize("seed", [0, 1])
def test_codes_are_the_plain_ones(spark, seed):
    rows = make_rows(seed, spread=(0.3, 0.02)[seed])
    coded, errors, digest = plain_codes(rows)
    got = vector_codes.vector_codes(frame(spark, rows)).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=key) == sorted(((i, c, e, errors[l]) for i, l, c, e in coded), key=key)
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_codes_of_ties_and_large_components(spark):
    # Entries that coincide, points half way between two entries, and components whose squares need more than 64 bits.
    rows = [(k, [float(k % 3) * (1e6 if k == 30 else 1.0)] * 8, k % 2) for k in range(40)] + [(100 + k, [k / 8192] * 8, None) for k in range(20)] + [(200, [1e11] * 8, 5), (201, [-1e11] * 8, 5)]
    coded, errors, digest = plain_codes(rows)
    got = {r.vec_id: r for r in vector_codes.vector_codes(frame(spark, rows, "double")).collect()}
    for i, l, c, e in coded:
        assert got[i].code == c and got[i].codebooks_sha256 == digest
        assert got[i].error == (e if e < 2**63 else None) and got[i].label_error == (errors[l] if errors[l] < 2**63 else None)


def test_few_vectors_and_none(spark):
    rows = [(2, [1.0, 2.0], 1), (1, [3.0], None)]
    coded, errors, digest = plain_codes(rows)
    got = vector_codes.vector_codes(frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == sorted((i, c, e, errors[l], digest) for i, l, c, e in coded)
    assert vector_codes.vector_codes(frame(spark, [(1, None, 1)])).collect() == []
    assert vector_codes.vector_codes(frame(spark, [(1, None, 1)]).limit(0)).collect() == []
    assert [(r.code, r.error) for r in vector_codes.vector_codes(frame(spark, [(1, [], 1)])).collect()] == [("00" * 8, 0)]


def test_light_and_heavy_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "HEAVY_BITS", 2)
    rows = [(k, None, 0 if k < 50 else None if k < 90 else k) for k in range(120)]
    coded = spark.createDataFrame([(i, l, "c", Decimal(i)) for i, _, l in rows], "vec_id long, label long, code string, error decimal(38,0)")
    got = {r.vec_id: int(r.label_error) for r in vector_codes.with_label_error(coded).collect()}
    assert got == {i: sum(j for j, _, m in rows if m == l) for i, _, l in rows}


def test_bounds_spare_distances(spark):
    """Later rounds compute far fewer distances than all, and the codes are still the plain ones."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (16, 64)) * 3
    rows = [(k, (centres[k % 16] + rng.normal(0, 0.2, 64)).tolist(), 1) for k in range(1500)]
    _, coded = vector_codes.fit(vector_codes.usable(frame(spark, rows, "double"), "embedding", "vec_id", "label"), 64)
    seen, n = coded.agg({"seen": "sum"}).head()[0], len(rows) * 8
    assert seen < 0.2 * 16 * n


def test_group_clustering():
    groups = vector_codes.groups_of(np.array([[0], [100], [1], [101], [2], [99], [50], [51]]))
    assert sorted(k for g in groups for k in g) == list(range(8)) and len(groups) <= vector_codes.GROUPS
    assert len(vector_codes.groups_of(np.zeros((16, 4), int))) == 1


# Whitening


def test_symmetric_qr():
    rng = np.random.default_rng(1)
    cases = [np.zeros((3, 3)), np.eye(5), np.diag([3.0, 1.0, 2.0]), np.ones((6, 6)), np.array([[4.0]]), np.array([[2.0, 1.0], [1.0, 2.0]])]
    cases += [(lambda b: b @ b.T)(rng.normal(size=(n, m))) for n, m in ((7, 20), (64, 500), (30, 5))] + [np.diag(np.arange(9.0)) + 1e-9]
    for a in cases:
        values, vectors = whitening.symmetric_qr(a)
        scale = max(1.0, np.abs(a).max()) * len(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * scale, rtol=0)
        assert np.allclose(vectors @ vectors.T, np.eye(len(a)), atol=1e-13 * len(a))
        assert np.allclose(vectors.T * values @ vectors, a, atol=1e-13 * scale)


def test_merged_moments_are_those_of_all_rows():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(300, 6)) * [1, 2, 3, 4, 5, 6] + 40
    whole = whitening.Moments(6)
    whole.add(rows)
    merged = whitening.Moments(6)
    for part in np.split(rows, [1, 1, 50, 299]):
        one = whitening.Moments(6)
        one.add(part)
        merged.merge(one)
    for m in (whole, merged):
        assert m.n == 300 and np.allclose(m.mean, rows.mean(0), rtol=1e-13) and np.allclose(m.covariance(), np.cov(rows.T, bias=True), rtol=1e-11, atol=1e-11)


def plain_whitening(rows, width):
    kept = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    with np.errstate(all="ignore"):
        whitened = centred @ vectors / np.sqrt(values)
    return kept, n, deviation, whitened, values / np.trace(covariance)


def test_whitening_is_the_plain_one(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MERGE_BYTES", 1)  # merged two by two
    rows, width = make_rows(3, 150, 12), 12
    kept, n, deviation, whitened, share = plain_whitening(rows, width)
    got = whitening.whiten(frame(spark, rows).repartition(7), most=8).collect()
    assert len(got) == len(kept) * 8 and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    by: dict = {}
    for r in got:
        by.setdefault((r.vec_id is None, r.vec_id or 0, r.deviation), {})[r.component] = r
    expected: dict = {}
    for (i, _), d, w in zip(kept, deviation, whitened, strict=True):
        expected[i is None, i or 0, d] = w
    assert set(by) == set(expected)
    signs = np.sign([by[k][c + 1].whitened * expected[k][c] for k in sorted(by) for c in range(8)]).reshape(-1, 8)
    for k in by:
        for c in range(8):
            r = by[k][c + 1]
            assert abs(abs(r.whitened) - abs(expected[k][c])) < 1e-7 and abs(r.explained / share[c] - 1) < 1e-9
    assert all(len(set(s[np.abs(s) > 0].tolist())) <= 1 for s in signs.T)


def test_components_without_variance(spark):
    rows = [(k, [float(k), 1.0, 2.0 * k], 1) for k in range(5)] + [(9, None, 1)]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame(spark, rows)).collect()}
    assert len(got) == 15 and all((r.whitened is None) == (c > 1) for (_, c), r in got.items())
    assert all(r.identity_error < 1e-9 and abs(r.explained - (r.component == 1)) < 1e-12 for r in got.values())
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)])).collect()
    assert len(same) == 4 and {(r.whitened, r.deviation, r.explained) for r in same} == {(None, 0, 0.0)}


def test_whitening_of_nothing(spark):
    for rows in ([(1, None, 1)], [(1, [], 1)], [(1, [NAN], 1)]):
        assert whitening.whiten(frame(spark, rows)).collect() == []


def test_large_deviation(spark):
    rows = [(1, [1e9, 0.0], 1), (2, [-1e9, 0.0], 1), (3, [1e300, 0.0], 1)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, rows[:2], "double")).collect()}
    assert got == {1: None, 2: None} or all(v == (2 * 64 * 10**9) ** 2 for v in got.values())
    small = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, [(1, [1e6, 0.0], 1), (2, [-1e6, 0.5], 1)], "double")).collect()}
    assert small == {1: (2 * 64 * 10**6) ** 2 + 32**2, 2: (2 * 64 * 10**6) ** 2 + 32**2}
    assert len(whitening.whiten(frame(spark, rows, "double")).collect()) == 6


def test_whitening_query(spark):
    source = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    kept, n, deviation, whitened, share = plain_whitening(source, 64)
    got = {(r.vec_id, r.component): r for r in QUERIES["op13_whitening"](spark, SF).collect()}
    assert len(got) == 32 * len(kept)
    table = np.array([[got[i, c + 1].whitened for c in range(32)] for i, _ in kept])
    flip = np.sign((table * whitened[:, :32]).sum(0))
    assert np.allclose(table * flip, whitened[:, :32], atol=1e-6)
    for (i, _), d in zip(kept, deviation, strict=True):
        assert got[i, 1].deviation == d and got[i, 1].n == n and got[i, 1].identity_error < 1e-9
    assert np.allclose([got[kept[0][0], c + 1].explained for c in range(32)], share[:32], rtol=1e-9)
