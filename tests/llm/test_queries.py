"""The registered queries over the smallest tables: each against SQL or a plain version of its contract."""

from __future__ import annotations

import glob
import hashlib
import os
import re
import zlib

import numpy as np
import pytest

from docledger.llm.license_scan import BASE_PHRASES
from docledger.llm.queries import ORACLES, QUERIES, _vocabulary

from .test_dedup import _fingerprint, _groups

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def result(spark):
    known = {}

    def of(name: str) -> dict:
        if name not in known:
            known[name] = {r[0]: r for r in QUERIES[name](spark, SF).collect()}
        return known[name]

    return of


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_simhash(documents, result):
    got = result("op1_simhash")
    ids = sorted(documents)
    values = [_fingerprint(documents[i]) for i in ids]
    least: dict = {}
    for i, g in zip(ids, _groups(values), strict=True):
        least.setdefault(g, []).append(i)
    expected = {i: min(m) for m in least.values() for i in m}
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{v:016x}", expected[i]) for i, v in zip(ids, values, strict=True)}


def test_classifier(spark, documents, result):
    got = result("op2_quality_classifier")
    assert set(got) == set(documents)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(got[i].predicted == q for i, q in labels.items()) >= 0.85 * len(labels)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    expected = con.sql(ORACLES[name])
    rows = QUERIES[name](spark, SF).select(*expected.columns).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(expected.fetchall(), key=str)


def test_url_filter(spark, result):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    got = result("op4_url_filter")
    assert set(got) == set(pages)
    for i, r in got.items():
        rest = (pages[i] or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        assert (r.host, r.path) == (host.lower(), re.match(r"[^?#]*", rest[len(host) :])[0]) and r.verdict in ("allow", "block")
        if r.rule is None and host:
            assert (r.verdict == "allow") == (r.score >= r.threshold)


def test_suffix_dedup(documents, result):
    first: dict = {}
    for i in sorted(documents):
        raw = documents[i].encode()
        for k in range(len(raw) - 99):
            first.setdefault(raw[k : k + 100], (i, k))
    for i, r in result("op5_suffix_dedup").items():
        raw = documents[i].encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 99):
            if first[raw[k : k + 100]] < (i, k):
                gone[k : k + 100] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw), int(gone.sum()), spans, _sha(np.frombuffer(raw, np.uint8)[~gone].tobytes()))


def test_sentencepiece(documents, result):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=_vocabulary("piece_bpe_32k.model"))
    for i, r in result("op7_sentencepiece").items():
        ids = library.encode(documents[i])
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.round_trip


def test_license_scan(documents, result):
    for i, r in result("op8_license_scan").items():
        words = [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", documents[i].encode().lower())]
        at = [(k, label) for p, label in BASE_PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        labels = sorted({x for _, x in at})
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(labels))
        assert set(labels) <= set(filter(None, r.labels.split(","))) and r.labels.split(",") == sorted(set(r.labels.split(","))) and 0 <= r.score <= 1


def test_quality_rules(documents, result):
    got = result("op9_quality_rules")
    assert set(got) == set(documents) and all(r.kept == (not r.base_failed and r.score >= r.threshold) for r in got.values())


def test_token_files(documents, result):
    from tokenizers import Tokenizer

    tokenizer, at = Tokenizer.from_file(_vocabulary("word_bpe_49k.json")), 0
    got = result("op10_token_files")
    for i in sorted(documents):
        ids = [*tokenizer.encode(documents[i], add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
