"""The queries of this subpackage, one for each operator, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    out = near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import score, train

    docs = _table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    labels = _table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup

    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import url_filter

    return url_filter(_table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import suffix_dedup

    out = suffix_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontaminate

    out = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.array_max(F.transform("matches", lambda m: m["words"])).cast("long").alias("longest_match"),
    )


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of documents that are labelled as good."""
    return _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"), trusted_documents(spark, sf_dir))


#: The public vocabularies; queries use these, operators take any path.
def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece_codec import encode_documents

    return encode_documents(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"), keep=("doc_id",), check=True)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import license_scan

    out = license_scan(_table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_files

    return token_files(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), end_id=1)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), end_id=0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import vector_codes

    return vector_codes(_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_license_scan": op8_license_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_files": op10_token_files,
    "op11_packing": op11_packing,
    "op12_vector_codes": op12_vector_codes,
    "op13_whitening": op13_whitening,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(table: str, key: str) -> str:
    return rf"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM {table}"


def _lloyd_sql(rounds: int = 6) -> str:
    """Plain Lloyd's rounds, one pair of tables for each, over integers."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"""d{r} AS MATERIALIZED (SELECT x.vec_id, x.part, c.entry, list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))) AS distance FROM x JOIN c{r} c ON x.part = c.part),
a{r} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, distance * 16 + entry) AS entry, min(distance) AS distance FROM d{r} GROUP BY vec_id, part)"""
        )
        if r < rounds:
            steps.append(
                f"""s{r} AS (SELECT part, entry, i, sum(value) AS total, count(*) AS n FROM (SELECT a.part, a.entry, unnest(range(1, len(x.v) + 1)) AS i, unnest(x.v) AS value FROM a{r} a JOIN x ON a.vec_id = x.vec_id AND a.part = x.part) GROUP BY part, entry, i),
c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(u.v, c.v) AS v FROM c{r} c LEFT JOIN (SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY part, entry) u ON c.part = u.part AND c.entry = u.entry)"""
            )
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (SELECT vec_id, p AS part, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS v FROM kept, (SELECT unnest(range(8)) AS p)),
c0 AS MATERIALIZED (SELECT part, nth - 1 AS entry, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS nth FROM kept ORDER BY vec_id LIMIT 16) USING (vec_id)),
{", ".join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(CAST(value AS VARCHAR), ',' ORDER BY part, entry, i)) AS h FROM (SELECT part, entry, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS value FROM c{rounds}))
SELECT coded.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded JOIN kept ON coded.vec_id = kept.vec_id, books"""


#: SQL for the operators whose whole result SQL can state. The others hold models, fingerprints or tokenizers.
ORACLES: dict[str, str] = {
    "op3_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS d FROM g GROUP BY h),
gone AS (SELECT DISTINCT g.doc_id, g.i + t.k AS j FROM g JOIN f ON g.h = f.h AND f.d < g.doc_id, (SELECT unnest(range(13)) AS k) t),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT words.doc_id, count(gone.j) AS n_removed, string_agg(word, ' ' ORDER BY words.j) FILTER (WHERE gone.j IS NULL) AS rest
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.j = gone.j GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op6_decontaminate": f"""
WITH w AS ({_words_sql("documents", "doc_id")}), b AS ({_words_sql("benchmark", "row_number() OVER () AS nth, item_id")}),
bp AS (SELECT nth, item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM b WHERE len(ws) > 0),
win AS (SELECT nth, CAST(item_id AS VARCHAR) AS item, p, least(len(ws), 10) AS n, md5(array_to_string(ws[p:p + 9], ' ')) AS h FROM bp),
dp AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n),
dh AS (SELECT doc_id, n, i, md5(array_to_string(ws[i:i + n - 1], ' ')) AS h FROM dp),
hit AS (SELECT doc_id, nth, dh.n, i, i - p AS shift, item FROM dh JOIN win ON dh.h = win.h AND dh.n = win.n),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, i + t.k AS j FROM hit, (SELECT unnest(range(10)) AS k) t WHERE t.k < hit.n) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id),
islands AS (SELECT doc_id, nth, shift, n, i - row_number() OVER (PARTITION BY doc_id, nth, shift ORDER BY i) AS island FROM hit),
longest AS (SELECT doc_id, max(words) AS longest_match FROM (SELECT doc_id, count(*) + n - 1 AS words FROM islands GROUP BY doc_id, nth, shift, n, island) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, longest_match
FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id LEFT JOIN named ON w.doc_id = named.doc_id LEFT JOIN longest ON w.doc_id = longest.doc_id""",
    "op12_vector_codes": _lloyd_sql(),
}
