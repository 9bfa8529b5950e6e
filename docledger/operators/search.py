"""Search through an inverted table of trigrams.

Every run of three characters of a searched column, in lower case, is listed with the documents that hold it and the part these
lie in.  A row lists up to a batch of documents, so a trigram that all documents hold takes few rows.  Rows are dealt into slots by a
hash of the trigram and sorted in them.  A search counts the postings of its term's trigrams, takes the rarest, and looks
only at the parts that have documents with all of those.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dashboard import search

COLUMNS = ("invoice_number", "vendor_name")
SLOTS = 64
#: How many trigrams of a term are looked up, and how many times the postings of the rarest another of them may have.
RAREST = 3
TIMES = 2
#: Low bits of a document's id; the others are one number for a whole list.
LOW = 31


def slot(trigram: Column) -> Column:
    return F.pmod(F.xxhash64(trigram), F.lit(SLOTS)).cast("int")


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a text in lower case; none of a shorter text or null."""
    low = F.lower(text)
    size = F.length(low)
    return F.when(size >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), size - 2), lambda k: F.substring(low, k, F.lit(3))))).otherwise(F.array().cast("array<string>"))


def postings(documents: DataFrame, *keep: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """trigram, high and low bits of the ids of documents that hold it (low: a list) and the columns in ``keep``. Documents of a
    task are listed by the batch, next to where they are read."""
    both = F.array_distinct(F.flatten(F.array(*(F.coalesce(trigrams(F.col(c)), F.array().cast("array<string>")) for c in columns))))
    rows = documents.select(F.shiftright("document_id", LOW).alias("high"), F.col("document_id").bitwiseAND((1 << LOW) - 1).cast("int").alias("low"), *keep, both.alias("trigrams"))

    def listed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            at = pc.list_parent_indices(batch.column("trigrams"))
            flat = {"trigram": pc.list_flatten(batch.column("trigrams"))} | {c: batch.column(c).take(at) for c in ("high", *keep, "low")}
            lists = pa.table(flat).group_by(["trigram", "high", *keep], use_threads=False).aggregate([("low", "list")])
            yield from lists.rename_columns({"low_list": "low"}).select(list(flat)).to_batches()

    schema = ", ".join(["trigram string", "high long", *(f"{c} {t}" for c, t in rows.select(*keep).dtypes), "low array<int>"])
    return rows.mapInArrow(listed, schema)


def find(documents: DataFrame, index: DataFrame, term: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Documents (with period and bucket) that hold the term in one of the columns, in any case.

    ``index`` has a posting for every trigram a document holds, and may have more.  Terms under three characters look at all.
    """
    low = term.lower()
    grams = sorted({low[k : k + 3] for k in range(len(low) - 2)})
    if not grams:
        return search(documents, term, columns)
    slots = [r[0] for r in index.sparkSession.createDataFrame([(g,) for g in grams], "g string").select(slot(F.col("g"))).distinct().collect()]
    hits = index.where(F.col("slot").isin(slots) & F.col("trigram").isin(grams))
    counts = {r["trigram"]: r["n"] for r in hits.groupBy("trigram").agg(F.sum(F.size("low")).alias("n")).collect()}
    if len(counts) < len(grams):
        return documents.limit(0)
    rare = sorted(grams, key=lambda g: (counts[g], g))[:RAREST]
    rare = [g for g in rare if counts[g] <= TIMES * counts[rare[0]]]
    found = hits.where(F.col("trigram").isin(rare))
    if len(rare) > 1:
        ids = found.select("trigram", "high", F.explode("low").alias("low"), "period", "bucket")
        found = ids.groupBy("high", "low", "period", "bucket").agg(F.count_distinct("trigram").alias("n")).where(F.col("n") == len(rare))

    def period(rows: DataFrame) -> Column:
        return F.coalesce(rows["period"], F.lit("0001-01-01").cast("date"))

    # As many parts as the table has folders at most.
    parts = found.select(period(found).alias("at"), F.col("bucket").alias("in")).distinct()
    near = documents.join(F.broadcast(parts), (period(documents) == F.col("at")) & (documents["bucket"] == F.col("in")), "left_semi")
    # Whatever holds the term has its postings, so what else is read need not be looked up by id: the term itself decides.
    return search(near, term, columns)
