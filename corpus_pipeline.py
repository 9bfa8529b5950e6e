"""The corpus pipeline: from raw documents to token ids, one operator after another.

Each stage takes all that its predecessor kept.  ``run`` writes every stage's table to the shared folder and reads it back,
so a lost executor repeats part of one stage at most.  SQL cannot state language-model scores, fingerprints or
segmentations, so there is no SQL for the whole; the tests hold each stage against a brute-force version.

The documents' own columns travel as one struct, so their names never clash with those of an operator.
"""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docledger.llm.components import delete, recording
from docledger.llm.decontaminate import decontaminate
from docledger.llm.quality_rules import quality_rules
from docledger.llm.queries import _vocabulary, trusted_documents
from docledger.llm.sentencepiece_codec import encode_documents
from docledger.llm.shingle_join import similar_documents
from docledger.llm.suffix_dedup import suffix_dedup
from docledger.llm.token_files import shared_folder

ROW = "__row"


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all columns as one struct."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules or the likelihood ratio reject go."""
    return quality_rules(_packed(docs), trusted_documents(spark, sf_dir), keep=(ROW,)).where("kept").select(f"{ROW}.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that with the smallest doc_id, rows without a doc_id last.

    Near-duplicates have equal sets of 5-word shingles, or a Jaccard similarity of 0.8 or more.  SimHash names the close ones; a
    search by prefixes finds the pairs whose fingerprints differ in more bits than its budget.
    A row is known by its doc_id and the SHA-256 of its text, so texts that share a doc_id, or have none, are rows of their own.
    """
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    found = similar_documents(docs.select("doc_id", "text", digest.alias("digest")), keep=("digest",))
    least = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("least"))
    stay = least.select(F.col("least.doc_id").alias("stay_id"), F.col("least.digest").alias("stay_digest"))
    rows = _packed(docs).withColumn("digest", digest)
    rows = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("digest") == F.col("stay_digest")), "left_semi")
    # The same text may be there more than once under one doc_id.
    first = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy("text"))
    return rows.withColumn("nth", first).where("nth = 1").select(f"{ROW}.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every later copy of a string of 100 bytes is cut from its text; n_chars follows the text."""
    out = suffix_dedup(_packed(docs), keep=(ROW,), as_text=True)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*(new.get(c, F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(_packed(docs), benchmark, keep=(ROW,)).where("n_hit = 0").select(f"{ROW}.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text back."""
    return encode_documents(docs, _vocabulary("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"), check=True)


#: Folders that the stage before this one wrote for its own use; of each thread, as a run stays in one.
_left = threading.local()


def _stage(work):
    """A stage that first deletes what the stage before it left: by then that stage's own table has been written."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete(spark, getattr(_left, "folders", []))
        _left.folders = []
        with recording() as made:
            out = work(spark, docs, sf_dir)
        _left.folders = made
        return out

    return run_stage


STAGES = [
    ("quality rules", _stage(apply_quality_rules)),
    ("SimHash near-dedup", _stage(drop_near_duplicates)),
    ("suffix-array dedup", _stage(cut_repeated_passages)),
    ("benchmark decontamination", _stage(drop_contaminated)),
    ("SentencePiece encoding", _stage(encode)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    before: list[str] = []
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        delete(spark, before)
        before = [path]
    return docs
