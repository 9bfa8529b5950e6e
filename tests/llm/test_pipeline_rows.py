"""Rows of the pipeline's stages that the ids of documents do not tell."""

from __future__ import annotations

import corpus_pipeline as P


def test_round_trip(spark):
    docs = spark.createDataFrame([(1, "a  text é\n", "en", "s"), (None, None, None, None), (2, "", "en", "s")], "doc_id long, text string, lang string, source string")
    rows = P.encode(spark, docs, "").collect()
    assert len(rows) == 3 and all(r.round_trip is True for r in rows)


def test_rows_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (2, b), (None, a), (None, c), (None, c), (None, b + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in P.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (None, c)], key=str)


def test_columns_of_any_name(spark):
    text = " ".join(f"w{k}" for k in range(80))
    docs = spark.createDataFrame([(1, text, "x", 1, 2, 3, 4), (2, text, "y", 5, 6, 7, 8)], "doc_id long, text string, __row string, group int, digest int, kept int, n_hit int")
    labels = spark.createDataFrame([(1,)], "doc_id long")
    assert P.drop_near_duplicates(spark, docs, "").collect() == [(1, text, "x", 1, 2, 3, 4)]
    assert P.cut_repeated_passages(spark, docs, "").columns == docs.columns and labels.count() == 1
