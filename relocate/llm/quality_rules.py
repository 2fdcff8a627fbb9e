"""Quality rules with host verdicts, in DataFrame functions only.

Each document is judged by its own numbers; failures are summed per host, host rates are shrunk
with a beta prior fitted to all hosts, and documents of hosts that mostly fail go with them. Host
sums fold in each task before the shuffle. The rates are written first, so the way back is a join
of two plain scans, which Spark can broadcast or split where a host is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.llm.common import SPACES, fresh_names, whole, words
from relocate.session import settle

#: Fixed characters of the symbol rule.
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host goes when its shrunk failure rate is above this.
HOST_LIMIT = 0.5
#: The prior weighs at least one document and at most this many.
PRIOR_MAX = 1000.0
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = [*MEASURES, "base_failed", "host_rate", "kept"]


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input columns and the five numbers of every whole text; null texts have no words.

    ``n_repeat_words`` counts words under 5-word windows that the text has twice or more. Windows
    are compared by 64-bit hashes, sorted with their places, so the work per text is that of a
    sort; texts without an equal pair skip it.
    """
    docs = fresh_names(docs, [*MEASURES, "_words", "_lines", "_grams", "_sorted"])
    body = whole(text)
    has_word = lambda line: F.btrim(line, F.lit(SPACES)) != ""
    out = docs.withColumns(
        {
            "_words": words(F.col(text)),
            "_lines": F.filter(F.split(body, "\n"), has_word),
            "word_chars": _without(body, SPACES).cast("long"),
            "n_symbols": (F.char_length(body) - _without(body, SYMBOLS)).cast("long"),
        }
    )
    gram = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW_WORDS)])
    none = F.array().cast("array<bigint>")
    count = F.size("_words")
    out = out.withColumns(
        {
            "n_words": count.cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_grams": F.when(
                count >= WINDOW_WORDS,
                F.transform(F.sequence(F.lit(0), count - WINDOW_WORDS), gram),
            ).otherwise(none),
        }
    ).drop("_words", "_lines")
    placed = F.transform("_grams", lambda g, i: F.struct(g.alias("gram"), i.alias("at")))
    some = F.size(F.array_distinct("_grams")) < F.size("_grams")
    out = out.withColumn("_sorted", F.when(some, F.sort_array(placed))).drop("_grams")

    def again(item: Column, i: Column) -> Column:
        before = F.get("_sorted", i - 1)["gram"]
        after = F.get("_sorted", i + 1)["gram"]
        return F.coalesce(item["gram"] == before, F.lit(False)) | F.coalesce(item["gram"] == after, F.lit(False))

    places = F.sort_array(F.transform(F.filter("_sorted", again), lambda x: x["at"]))
    begin = F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).alias("covered"))
    step = lambda acc, at: F.struct(
        at.alias("last"),
        (acc["covered"] + F.least(F.lit(WINDOW_WORDS), at - acc["last"])).alias("covered"),
    )
    covered = F.aggregate(places, begin, step, lambda acc: acc["covered"])
    repeats = F.when(F.col("_sorted").isNull(), 0).otherwise(covered).cast("long")
    return out.withColumn("n_repeat_words", repeats).drop("_sorted")


def base_failed() -> Column:
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeats


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """``host, host_rate``: failure rates, shrunk by a beta prior from the moments of all rates."""
    hosts = judged.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("base_failed").cast("long")).alias("_fails")
    )
    rate = F.col("_fails") / F.col("_n")
    mean, var = hosts.agg(F.avg(rate)).scalar(), hosts.agg(F.var_pop(rate)).scalar()
    spread = F.least(F.greatest(mean * (1 - mean) / var - 1, F.lit(1.0)), F.lit(PRIOR_MAX))
    weight = F.when(var > 0, spread).otherwise(PRIOR_MAX)
    shrunk = (F.col("_fails") + mean * weight) / (F.col("_n") + weight)
    return hosts.select("_host", shrunk.alias("host_rate"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Every row without its text, with the numbers, ``base_failed``, ``host_rate`` and ``kept``.

    Rows without a host share the host ''. Input columns with the names of added ones are
    replaced. Rows that repeat count each.
    """
    docs = fresh_names(docs, [*ADDED, "_host_of", "_host"])
    measured = measures(docs.withColumn("_host_of", whole(host)), text).drop(text)
    judged = settle(measured.withColumn("base_failed", base_failed()), "measures")
    rates = settle(host_rates(judged, "_host_of"), "rates")
    kept = ~F.col("base_failed") & (F.col("host_rate") <= host_limit)
    joined = judged.join(rates, F.col("_host_of") == F.col("_host"))
    return joined.withColumn("kept", kept).drop("_host", "_host_of")
