"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, words string, score double, fp long, component_id string, label string"


def make_texts(seed: int = 0) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßxyz") for _ in range(rng.randint(1, 8))) for _ in range(300)]

    def prose(n: int) -> str:
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "."]) for _ in range(n))

    passage, long_passage = prose(60), prose(200)
    base = prose(150)
    rows: list[tuple[int | None, str | None]] = [(1, base), (2, base), (3, base + " end"), (4, "start " + base), (5, None), (6, ""), (7, "   \n\t "), (8, "one"), (9, "one"), (10, "a b c")]
    rows += [(20 + k, prose(40) + " " + passage + "\n" + prose(30)) for k in range(6)]
    rows += [(30 + k, prose(20) + "\n" + long_passage) for k in range(4)]
    rows += [(40, "The " * 300), (41, "ab" * 400), (42, "é" * 150 + "€" * 120), (43, "é" * 150), (44, prose(3000)), (45, prose(80).upper().replace(" ", "!! ")), (46, prose(120).replace(" ", "%%% "))]
    rows += [(50 + k, prose(rng.randint(50, 120))) for k in range(25)]
    rows += [(60, base), (60, base), (None, base), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('docs')}/documents.parquet"
    rows = [(i, t, None, f"s{k % 3}", len(t or ""), 1, "w", 0.5, 7, "c", "l") for k, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rank(doc_id) -> int:
    """Null is smaller than any other id."""
    return -(2**63) if doc_id is None else doc_id
