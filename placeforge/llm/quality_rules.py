"""Quality rules whose cutoffs are certified on labelled holdouts.

A rule rejects a text whose statistic is beyond a cutoff; each rule has a fixed ladder of cutoffs from loose to strict.
In a stratum (a language by default) a cutoff is certified if the exact binomial test refutes, on the good holdout texts,
that it rejects more than the rule's part of ``FALSE_REJECTION``: P(Bin(n, part) <= rejected) is at most ``RISK`` divided by
the number of ladders, rules times strata (Bonferroni). Along a ladder the tests go from loose to strict and end with the
first failure, which needs no further correction; the number rejected only grows, so the certified cutoffs are those whose
own test holds. Of these the one that rejects most bad holdout texts is taken, the loosest on ties, none if it rejects none.
So with probability 1 - RISK no stratum loses more than ``FALSE_REJECTION`` of its good texts. Nothing is fitted, so all
labelled texts are holdouts; copies of a text count once, and as good if one of them is labelled good.
All columns are built-in functions: words are an array, its 3-word windows are sorted to find repeats.

Nulls: a null text has no words and fails the base; a null stratum is one of its own; null labels are ignored. A stratum
without enough labels has no cutoffs. Very long texts are read whole, as one array. Repeated rows each get a row. An empty
table gives no rows; an empty label table gives no cutoffs. Statistics equal to a cutoff pass. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.operators.skew import with_groups
from placeforge.session import durable

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
FALSE_REJECTION = 0.05  # of a stratum's good texts, by all rules together
RISK = 0.05  # that any stratum loses more
#: (name, statistic, above or below, cutoffs from loose to strict)
RULES = (
    ("symbols", "n_symbols / greatest(n_words, 1)", True, (2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05)),
    ("copied_lines", "n_dup_lines / greatest(n_lines, 1)", True, (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    ("repeated_words", "n_repeat_words / greatest(n_words, 1)", True, (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    ("long_words", "word_chars / greatest(n_words, 1)", True, (12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5)),
    ("short_words", "word_chars / greatest(n_words, 1)", False, (2.0, 2.5, 3.0, 3.5, 4.0, 4.25, 4.5)),
)


def statistics_of(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, digest, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed) per row, written."""
    key = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("-"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), key.alias("stratum"), text.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    rows = rows.select(
        "doc_id", "stratum", F.sha2("t", 256).alias("digest"),
        F.filter(F.split("t", f"{SPACE}+"), lambda x: x != "").alias("words"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    words, starts = F.col("words"), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))
    window = lambda x, i: F.struct(F.concat_ws(" ", x, *[F.get(words, i + j) for j in range(1, WINDOW)]).alias("w"), i.alias("at"))
    rows = rows.select(
        "doc_id", "stratum", "digest", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.transform(F.slice("words", F.lit(1), starts), window)).alias("sorted"),
    )
    near = lambda s, i: (s["w"] == F.get("sorted", i - 1)["w"]) | (s["w"] == F.get("sorted", i + 1)["w"])
    repeated = F.sort_array(F.transform(F.filter("sorted", near), lambda s: s["at"]))
    rows = rows.withColumn("at", repeated)
    # words under a window that starts at one of the places: gaps of up to a window's width, and the last window
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.least(F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0), lambda a, x: a + x
    )
    rows = rows.withColumn("n_repeat_words", covered.cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    stats = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    return durable(rows.select("doc_id", "stratum", "digest", *stats, failed.alias("base_failed")), "statistics")


def binomial_tail(rejected: Column, n: Column, rate: float) -> Column:
    """P(Bin(n, rate) <= rejected), exactly summed in logarithms; 1 where as many or more are rejected than expected."""
    step = math.log(rate / (1 - rate))
    start = n * F.lit(math.log1p(-rate))
    one = lambda s, i: F.struct(
        (s["term"] + F.log((n - i + 1) / i) + step).alias("term"), (s["sum"] + F.exp(s["term"] + F.log((n - i + 1) / i) + step)).alias("sum")
    )
    counts = F.when(rejected > 0, F.sequence(F.lit(1).cast("long"), rejected)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(counts, F.struct(start.alias("term"), F.exp(start).alias("sum")), one)["sum"]
    return F.when(rejected >= n * rate, F.lit(1.0)).otherwise(tail)


def _steps(statistic: str, above: bool, cutoffs: tuple[float, ...]) -> Column:
    """How many cutoffs reject a text; they are the last of the ladder."""
    value = F.expr(statistic)
    steps = F.lit(0)
    for c in cutoffs:
        steps = steps + ((value > c) if above else (value < c)).cast("int")
    return steps


def certify(stats: DataFrame, labels: DataFrame, false_rejection: float = FALSE_REJECTION, risk: float = RISK) -> DataFrame:
    """(stratum, rule, cutoff, good, good_rejected, bad_rejected, p_value) of the cutoffs taken.

    ``labels`` has doc_id and quality (1 for good).
    """
    known = labels.filter("quality is not null").select(F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("good"))
    tried = stats.filter("not base_failed").join(known, F.col("doc_id") == F.col("_id"))
    # copies of a text are alike in all statistics
    texts = tried.groupBy("stratum", "digest").agg(
        F.max("good").alias("good"), *[F.first(c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]
    )
    per_rule = F.array(*[
        F.struct(F.lit(name).alias("rule"), _steps(statistic, above, cutoffs).alias("steps"), F.array(*map(F.lit, cutoffs)).alias("cutoffs"))
        for name, statistic, above, cutoffs in RULES
    ])
    ladders = texts.select("stratum", "good", F.explode(per_rule).alias("r")).select("stratum", "good", "r.*")
    counts = ladders.groupBy("stratum", "rule", "steps").agg(
        F.sum(F.col("good").cast("long")).alias("g"), F.sum((~F.col("good")).cast("long")).alias("b"), F.first("cutoffs").alias("cutoffs")
    )
    # one row per stratum and rule, with a ladder's few steps
    held = counts.groupBy("stratum", "rule").agg(
        F.first("cutoffs").alias("cutoffs"), F.sum("g").alias("good"), F.collect_list(F.struct("steps", "g", "b")).alias("steps")
    )
    held = durable(held.filter("good > 0"), "ladders")
    tests = max(1, held.count())
    beyond = lambda field: F.aggregate(
        F.filter("steps", lambda s: s["steps"] + F.col("at") >= F.size("cutoffs")), F.lit(0).cast("long"), lambda a, s: a + s[field]
    )
    rungs = held.select("*", F.posexplode("cutoffs").alias("at", "cutoff"))
    rungs = rungs.select("stratum", "rule", "at", "cutoff", "good", beyond("g").alias("good_rejected"), beyond("b").alias("bad_rejected"))
    rungs = rungs.withColumn("p_value", binomial_tail(F.col("good_rejected"), F.col("good"), false_rejection / len(RULES)))
    certified = rungs.filter((F.col("p_value") <= risk / tests) & (F.col("bad_rejected") > 0))
    best = F.max_by(F.struct("cutoff", "good", "good_rejected", "bad_rejected", "p_value"), F.struct("bad_rejected", -F.col("at")))
    return certified.groupBy("stratum", "rule").agg(best.alias("best")).select("stratum", "rule", "best.*")


def verdicts(stats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The rows of ``stats`` with ``kept`` and ``rejected_by``, the rules that reject a row."""
    one = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r[0], F.col("cutoff"))).alias(f"cut_{r[0]}") for r in RULES])
    sizes = stats.groupBy("stratum").agg(F.count("*").alias("n_stratum"))
    groups = durable(one.join(sizes, "stratum"), "cutoffs")
    met = with_groups(stats, groups, ["stratum"], "n_stratum", stats.count(), F.struct("doc_id", "digest"))
    broken = [F.when((F.expr(s) > F.col(f"cut_{r}")) if above else (F.expr(s) < F.col(f"cut_{r}")), F.lit(r)) for r, s, above, _ in RULES]
    met = met.withColumn("rejected_by", F.when(F.col("n_words") > 0, F.array_compact(F.array(*broken))).otherwise(F.array().cast("array<string>")))
    return met.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base verdict and verdict of every document."""
    stats = statistics_of(docs)
    found = verdicts(stats, certify(stats, labels))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"
    )
