"""The pipeline's stages, each against a statement of what it must keep."""

from __future__ import annotations

import corpus_pipeline as P
from docledger.llm.sentencepiece_codec import Codec

from .conftest import rank
from .test_shingle_join import _groups


def test_stages(spark, docs, texts, tmp_path):
    sf = f"file://{tmp_path}"
    by_id = {i: t for i, t in texts if i is not None}
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(50, 75)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, " ".join(by_id[55].split()[5:20]))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5 and P.ORACLE_SQL is None
    now, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, now, sf)
        out.write.parquet(f"{sf}/{k}")
        now = spark.read.parquet(f"{sf}/{k}")
        seen.append(now)
        if k < 4:
            assert now.columns == docs.columns
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in seen]
    assert 46 not in ids[0] and 5 not in ids[0] and set(range(50, 75)) <= ids[0]
    # One document of each group, the one with the smallest id; no two rows of one id.
    rows = [(r.doc_id, r.text) for r in seen[0].collect()]
    least: dict = {}
    for (i, _), g in zip(rows, _groups([t for _, t in rows]), strict=True):
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    assert {i for i in ids[1] if i is not None} == {i for none, i in least.values() if not none}
    assert seen[1].where("doc_id is not null").count() == len({i for i in ids[1] if i is not None})
    # Repeats of a passage are cut after the first; the documents stay.
    assert ids[2] == ids[1] and seen[2].count() == seen[1].count()
    cut = {rank(r.doc_id): r for r in seen[2].collect()}
    assert len(cut[21].text) < len(by_id[21]) and cut[20].text == by_id[20] and cut[21].n_chars == len(cut[21].text)
    assert ids[3] == ids[2] - {55}
    codec = Codec(P._vocabulary("piece_bpe_32k.model"))
    texts_now = {rank(r.doc_id): r.text for r in seen[3].collect()}
    assert {rank(r.doc_id): codec.decode(r.ids) for r in seen[4].collect()} == texts_now
    whole = {rank(r.doc_id): (r.n_tokens, r.ids_crc32) for r in P.run(spark, sf).collect()}
    assert whole == {rank(r.doc_id): (r.n_tokens, r.ids_crc32) for r in seen[4].collect()}


def test_empty(spark, no_docs, tmp_path):
    sf = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for _, stage in P.STAGES:
        assert stage(spark, no_docs, sf).count() == 0
