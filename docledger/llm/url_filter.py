"""URL filter: host and path rules first, then a ratio of two character language models.

Only DataFrame functions are used.

Method.  URLs that an allow rule or a block rule decides are the accepted and rejected examples.  From three quarters of them,
by a hash of host and path, a Markov model of variable order over ``SYMBOLS`` symbols (letters, one for a run of digits, ``./-_``, one for all others) is
estimated for each of the two with contexts of up to ``ORDER`` symbols: the probability after a context is the count there, smoothed by the
number of different symbols seen there (Witten-Bell) with the probability after the next shorter context; a context never
seen passes to the shorter one.  A URL's score is the mean over its symbols of the log ratio of the two.  The threshold is
calibrated on the quarter that is held out (on all examples, if it lacks one kind): the point as many standard deviations below
the accepted mean as above the rejected mean.

The model is one array with an entry for each of SYMBOLS ** (ORDER + 1) strings, a fixed size, and is read as a scalar
subquery.  Host, path, rule and n-grams of each URL are made once and written to the shared folder; counting, calibration and
scoring read them, the last two without a shuffle.

Definition.  Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.  Path: what then
follows up to ``?``, ``#`` or the end.  Null, or no ``://``: both are empty.  A rule fits its host and all its subdomains if
the path starts with the rule's; of several the longest wins, of equally long ones the first given.  A URL without a
host is blocked.  If there are no examples of one kind, the method allows.  URLs of any length are read whole; equal rows give
equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import numbered, renamed
from .components import saved

SYMBOLS = 32
ORDER = 3
# Verdict, host and path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """A struct of the rule that decides and its verdict; null where no rule fits."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        chosen = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _symbols(host: Column, path: Column) -> Column:
    """The symbols of a URL, after ORDER symbols that stand for its start."""
    text = F.regexp_replace(F.lower(F.concat(host, path)), "[0-9]+", "0")
    own = F.transform(F.array_remove(F.split(text, ""), ""), lambda c: F.position(c, F.lit(_ALPHABET)))
    return F.concat(F.array_repeat(F.lit(0), ORDER), own)


def _grams() -> Column:
    """For each symbol of ``symbols``, the number of the string of ORDER symbols before it and itself."""

    def number(i: Column) -> Column:
        code = F.lit(0)
        for k in range(ORDER + 1):
            code = code * SYMBOLS + F.get("symbols", i + k)
        return code

    return F.transform(F.sequence(F.lit(0), F.size("symbols") - ORDER - 1), number)


def _with_grams(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("symbols", _symbols(F.col("host"), F.col("path")))
    return rows.withColumn("grams", F.when(F.size("symbols") > ORDER, _grams()).otherwise(F.array().cast("array<int>"))).drop("symbols")


def held_out(host: Column, path: Column) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(4)) == 0


def log_ratios(examples: DataFrame) -> DataFrame:
    """One row with one column, model: array<float>, from rows with grams and accepted (boolean)."""
    spark = examples.sparkSession
    grams = examples.select("accepted", F.explode("grams").alias("code"))
    # Counted once; the counts of shorter strings are sums of these.
    counts = saved(grams.groupBy("code").agg(F.count_if("accepted").alias("n_a"), F.count_if(~F.col("accepted")).alias("n_r")), "counts")
    # From here on the number of rows is fixed: all strings of k symbols, for k from 1 to ORDER + 1.
    shorter = None
    for k in range(1, ORDER + 2):
        size = SYMBOLS**k
        own = counts.groupBy(F.pmod("code", F.lit(size)).cast("int").alias("code")).agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r"))
        table = spark.range(size).select(F.col("id").cast("int").alias("code")).join(own, "code", "left").na.fill(0, ["n_a", "n_r"])
        table = table.withColumn("context", F.floor(F.col("code") / SYMBOLS).cast("int"))
        context = table.groupBy("context").agg(
            *(F.sum(f"n_{x}").alias(f"all_{x}") for x in "ar"),
            *(F.count_if(F.col(f"n_{x}") > 0).alias(f"kinds_{x}") for x in "ar"),
        )
        table = table.join(context, "context")
        if shorter is None:
            table = table.withColumns({f"back_{x}": F.lit(1.0 / SYMBOLS) for x in "ar"})
        else:
            table = table.withColumn("tail", F.pmod("code", F.lit(size // SYMBOLS))).join(shorter, "tail")

        def smoothed(x: str) -> Column:
            total = F.col(f"all_{x}") + F.col(f"kinds_{x}")
            return F.when(total > 0, (F.col(f"n_{x}") + F.col(f"kinds_{x}") * F.col(f"back_{x}")) / total).otherwise(F.col(f"back_{x}"))

        shorter = table.select(F.col("code").alias("tail"), smoothed("a").alias("back_a"), smoothed("r").alias("back_r"))
    ratio = F.log(F.col("back_a") / F.col("back_r")).cast("float")
    pages = shorter.select(F.floor(F.col("tail") / 1024).alias("page"), F.struct("tail", ratio.alias("ratio")).alias("x"))
    pages = pages.groupBy("page").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["ratio"]).alias("ratios"))
    whole = pages.agg(F.array_sort(F.collect_list(F.struct("page", "ratios"))).alias("all"))
    return whole.select(F.flatten(F.transform("all", lambda x: x["ratios"])).alias("model"))


def _scored(rows: DataFrame, model: DataFrame) -> DataFrame:
    rows = rows.withColumn("model", model.scalar())
    total = F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get("model", g).cast("double"))
    return rows.withColumn("score", F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(0.0)).drop("model", "grams")


def url_filter(pages: DataFrame, rules=RULES, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The columns in ``keep``, host, path, rule, score, threshold and verdict, one row for each page.

    A column of ``keep`` may have the name of a result; both are then in the table.
    """
    names = [f"__keep{k}" for k in range(len(keep))]
    rows = numbered(pages, keep, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("chosen", rule_of(F.col("host"), F.col("path"), rules))
    rows = saved(_with_grams(rows).withColumn("held_out", held_out(F.col("host"), F.col("path"))), "urls")
    examples = rows.where("chosen is not null").select("grams", "held_out", (F.col("chosen.verdict") == "allow").alias("accepted"))
    model = saved(log_ratios(examples.where("not held_out")), "model")

    def measured(x: str, accepted: bool, only_held: bool) -> list[Column]:
        value = F.when((F.col("accepted") == accepted) & (F.col("held_out") | F.lit(not only_held)), F.col("score"))
        end = f"{x}{'_held' if only_held else ''}"
        return [F.avg(value).alias(f"mean_{end}"), F.stddev_pop(value).alias(f"dev_{end}")]

    spread = _scored(examples, model).agg(*(c for held in (True, False) for x, kind in (("a", True), ("r", False)) for c in measured(x, kind, held)))
    both = F.col("mean_a_held").isNotNull() & F.col("mean_r_held").isNotNull()
    mean_a, mean_r, dev_a, dev_r = (F.when(both, F.col(f"{m}_{x}_held")).otherwise(F.col(f"{m}_{x}")) for m in ("mean", "dev") for x in "ar")
    between = F.when(dev_a + dev_r > 0, (mean_a * dev_r + mean_r * dev_a) / (dev_a + dev_r)).otherwise((mean_a + mean_r) / 2)
    threshold = saved(spread.select(F.coalesce(between, F.lit(float("-inf"))).alias("threshold")), "threshold")
    rows = _scored(rows, model).withColumn("threshold", threshold.scalar())
    method = F.when((F.col("host") != "") & (F.col("score") >= F.col("threshold")), "allow").otherwise("block")
    return renamed(rows.select(*names, "host", "path", F.col("chosen.rule").alias("rule"), "score", "threshold", F.coalesce("chosen.verdict", method).alias("verdict")), keep)
