"""Quality rules: counts of simple faults, and a log-likelihood ratio against a trusted part of the corpus.

Only DataFrame functions are used.

Method.  Pairs of neighbouring words and pairs of neighbouring word shapes are hashed into ``BUCKETS`` places.  Two multinomials
over the places are estimated, from all documents and from the trusted ones, and a document's score is the mean log ratio of the
two over its pairs.  A shape is a word with each run of A-Z, of digits and of other letters (a-z and all
non-ASCII characters) reduced to one character.

A trusted document must not be known by its own words.  Documents fall into two halves by a hash of doc_id and text, and each is
scored by the trusted documents of the other half only, trusted or not.  The ratio of a place is log((t + K) / (e + K)): t is its
count in the trusted half, e the count expected there from the share in all documents, and ``K`` keeps rare places near zero.

The threshold is ``DEVIATIONS`` standard deviations below the mean score of the trusted documents that pass the base rules.

Texts are read once: the counts of the rules and the places of the pairs, about as many bytes as the compressed text, are
written to the shared folder.  Counting, the threshold and scoring read that table.  The counts cover every document.  The
model is one array of fixed size, read as a scalar subquery, so scoring is one pass without a shuffle.

Definition of the rules.  Words are runs of characters other than space and 0x09-0x0D; null text has none.  ``word_chars``:
characters in words.  ``n_symbols``: characters of ``[#*$%&|<>]``.  ``n_dup_lines``: lines with a word that equal an
earlier line.  ``n_repeat_words``: words in windows of three words that stand in the text twice or more.  ``base_failed``:
under 50 words, or over half of the words repeat.  ``kept``: the base rules and the score pass.
Texts of any length are read whole; equal rows give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import numbered, renamed
from .components import saved

BUCKETS = 1 << 16
K = 2.0
DEVIATIONS = 4.0
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Trusted doc_ids that are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 400_000
_SPACE = r"[ \x09-\x0D]+"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))


def _split_words(trimmed: Column) -> Column:
    return F.when(trimmed != "", F.split(trimmed, _SPACE)).otherwise(F.array().cast("array<string>"))


def _shape(text: Column) -> Column:
    text = F.regexp_replace(text, r"[a-z\x{80}-\x{10FFFF}]+", "a")
    return F.regexp_replace(F.regexp_replace(text, "[A-Z]+", "A"), "[0-9]+", "0")


def _half() -> Column:
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)).cast("int")


def _pairs(words: Column, buckets: int, *salt: Column) -> Column:
    """The places of the pairs of neighbours."""
    before = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.transform(before, lambda w, i: F.pmod(F.xxhash64(*salt, w, F.get(words, i + 1)), F.lit(buckets)).cast("int"))


def _marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Adds trusted (boolean). A known small set of ids is broadcast; a larger one meets the documents in a shuffle."""
    ids = saved(trusted.select("doc_id").where("doc_id is not null").distinct(), "trusted").withColumn("__trusted", F.lit(True))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
    return docs.join(ids, "doc_id", "left").withColumn("trusted", F.coalesce("__trusted", F.lit(False))).drop("__trusted")


def log_ratios(marked: DataFrame, buckets: int = BUCKETS, k: float = K) -> DataFrame:
    """One row with one column, model: array<float> of 2 * buckets ratios, first those for documents of half 0.

    ``marked`` has half, trusted and places. Without trusted documents all ratios are zero.
    """
    places = marked.select("half", "trusted", F.explode("places").alias("place"))
    counts = places.groupBy("place").agg(F.count(F.lit(1)).alias("raw"), *(F.count_if(F.col("trusted") & (F.col("half") != h)).alias(f"t{h}") for h in (0, 1)))
    spark = marked.sparkSession
    # A fixed number of rows from here on.
    dense = spark.range(buckets).select(F.col("id").cast("int").alias("place")).join(counts, "place", "left").na.fill(0)
    packed = dense.agg(
        F.array_sort(F.collect_list(F.struct("place", "raw", "t0", "t1"))).alias("all"),
        *(F.sum(c).alias(f"{c}_sum") for c in ("raw", "t0", "t1")),
    )

    def ratio(h: int) -> Column:
        def of(x: Column) -> Column:
            expected = F.col(f"t{h}_sum") * x["raw"] / F.greatest(F.col("raw_sum"), F.lit(1))
            return F.log((x[f"t{h}"] + k) / (expected + k)).cast("float")

        return F.transform("all", of)

    return packed.select(F.concat(ratio(0), ratio(1)).alias("model"))


def _three_hashes(words: Column) -> Column:
    """A hash of each window of three words."""
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def _repeat_words(words: Column, hashes: Column) -> Column:
    """How many words stand in windows of three that occur twice or more; windows of one hash are compared word by word."""
    three = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.cast("long").alias("i")))

    def twice(rows: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            return F.coalesce((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

        return F.filter(rows, lambda x, j: same(x, F.get(rows, j - 1)) | same(x, F.get(rows, j + 1)))

    def covered(at: Column) -> Column:
        three_ = F.lit(3).cast("long")
        reach = F.transform(at, lambda p, i: F.least(three_, F.coalesce(F.get(at, i + 1) - p, three_)))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def bound(value: Column, use) -> Column:
        """``use`` of a value that is computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    exact = bound(F.sort_array(three), lambda rows: bound(F.sort_array(F.transform(twice(rows), lambda x: x["i"])), covered))
    # Without two equal hashes there are no two equal windows.
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(exact)


def measures(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds the rule counts and the places to rows with a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.withColumn("line", _trimmed(F.col("text")))
    rows = rows.withColumns(
        {
            "words": _split_words(F.col("line")),
            "shapes": _split_words(_shape(F.col("line"))),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]")),
        }
    )
    rows = rows.withColumn("hashes", _three_hashes(F.col("words")))
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("words"), F.col("hashes")),
            "places": F.concat(_pairs(F.col("words"), buckets), _pairs(F.col("shapes"), buckets, F.lit(0))),
        }
    ).drop("lines", "line", "hashes", "words", "shapes")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def quality_rules(docs: DataFrame, trusted: DataFrame, keep: tuple[str, ...] = ("doc_id",), buckets: int = BUCKETS, deviations: float = DEVIATIONS) -> DataFrame:
    """The columns in ``keep``, the counts, base_failed, score, threshold and kept, one row for each document.

    ``trusted`` has the doc_ids of trusted documents; null and repeated ones count for nothing. A document of fewer than two words
    has score 0 and fails the base rules. With fewer than two trusted documents the score decides nothing.
    A column of ``keep`` may have the name of a result; both are then in the table.
    """
    marked = _marked(numbered(docs, keep, "doc_id", "text"), trusted).withColumn("half", _half())
    names = [f"__keep{k}" for k in range(len(keep))]
    rows = saved(measures(marked, buckets).select(*names, *_COUNTS, "base_failed", "trusted", "half", "places"), "measures")
    model = saved(log_ratios(rows, buckets), "model")
    start = F.col("half") * buckets
    total = F.aggregate("places", F.lit(0.0), lambda a, p: a + F.get(F.col("model"), start + p).cast("double"))
    rows = rows.withColumn("model", model.scalar()).withColumn("score", F.when(F.size("places") > 0, total / F.size("places")).otherwise(F.lit(0.0)))
    known = rows.where("trusted and not base_failed").select("score")
    bound = known.agg(F.when(F.count("score") > 1, F.avg("score") - deviations * F.stddev_pop("score")).otherwise(float("-inf")).alias("threshold"))
    rows = rows.withColumn("threshold", saved(bound, "threshold").scalar())
    kept = ~F.col("base_failed") & (F.col("score") >= F.col("threshold"))
    return renamed(rows.select(*names, *_COUNTS, "base_failed", "score", "threshold", kept.alias("kept")), keep)
