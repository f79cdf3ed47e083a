"""Line-first quality rules: bad lines go, then documents that lost too much go.

Each line is judged by itself: navigation bars, boilerplate, shouting, symbol
noise and long unpunctuated runs fail. Phrases of page furniture, which are English, fail a
line of at most ``LONG_RUN`` words only: in a longer one they may stand within prose. A
document is kept when the words of its
failed lines are at most ``max_lost`` of all its words and enough words remain.
Independently of the lines, a document fails the base rules when it is very
short or repeats eight-word windows too much.

Everything is a Spark expression on one row: no shuffle, no Python.

Nulls: a null text has no words, fails the base rules and is not kept; null ids
pass through. Empty texts likewise. Repeated rows are judged alike. Columns of
the input other than the text are left alone by ``clean`` and ``keep`` and ignored by
``judge``; ``measure`` replaces a column ``rules``.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import SPACE_WORD, matches

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LOST_PERCENT = 30
# Phrases that mark a line as page furniture.
BOILERPLATE = (
    "lorem ipsum", "enable javascript", "accept cookies", "accept all cookies", "cookie policy",
    "privacy policy", "terms of use", "terms of service", "all rights reserved", "click here",
    "sign up for", "subscribe to our",
)
SYMBOLS = r"[#*$%&|<>]"
SHOUT = "!!"
BARS = 3  # separators that make a line a navigation bar
PUNCTUATION = "[.!?:;,…]"  # written prose of some length holds at least one
LONG_RUN = 40  # words a line may hold without any punctuation
STUTTER_WORDS = 20  # lines of so many words need more than a fourth of them distinct


def _occurrences(line: Column, mark: str) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit(mark)))) / len(mark)


def _parts(line: Column) -> Column:
    return F.struct(line.alias("line"), matches(line, SPACE_WORD).alias("words"))


def _verdict(x: Column) -> Column:
    line, words = x["line"], F.size(x["words"])
    bars = _occurrences(line, "|")
    symbols = F.size(matches(line, SYMBOLS))
    low = F.lower(line)
    fails = (bars >= BARS) | (_occurrences(line, SHOUT) * 4 > words)
    fails = fails | (symbols * 4 > words)
    fails = fails | ((words > LONG_RUN) & ~line.rlike(PUNCTUATION))
    fails = fails | (
        (words >= STUTTER_WORDS) & (F.size(F.array_distinct(x["words"])) * 4 <= words))
    furniture = functools.reduce(operator.or_, [low.contains(p) for p in BOILERPLATE])
    fails = fails | ((words <= LONG_RUN) & furniture)
    return F.struct(
        line.alias("line"), words.alias("words"),
        F.when(words > 0, fails).otherwise(False).alias("fails"))


def line_verdicts(text: Column) -> Column:
    """Array of (line, words, fails) in order; empty for a null text."""
    lines = F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))
    return F.transform(F.transform(lines, _parts), _verdict)


def _repeats(pairs: Column) -> Column:
    """Words inside windows found twice or more, from sorted (hash, position) pairs."""
    last = F.size(pairs) - 1

    def twice(pair, i):
        before = (i > 0) & (F.get(pairs, i - 1)["h"] == pair["h"])
        after = (i < last) & (F.get(pairs, i + 1)["h"] == pair["h"])
        return before | after

    at = F.array_sort(F.transform(F.filter(pairs, twice), lambda p: p["p"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("covered"))
    total = F.aggregate(
        at,
        start,
        lambda done, p: F.struct(
            (p + WINDOW).alias("end"),
            (done["covered"] + p + WINDOW - F.greatest(p, done["end"])).alias("covered"),
        ),
    )
    return total["covered"]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds a struct ``rules`` with all counts and the verdict; it replaces one so named.

    Windows are compared by a 64-bit hash inside one document, so two different
    windows of one text pass for equal with a chance below n * n / 2**65.
    """
    col = F.col(f"`{text}`")
    step = docs.withColumn("__words", matches(col, SPACE_WORD)).withColumn(
        "__lines", line_verdicts(col))
    n = F.size("__words")
    # Hashes of 1, 2, 4 and then 8 words, each from two of half its length.
    step = step.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    for width in (1, 2, 4):
        later = F.slice("__hashes", width + 1, 1 << 30)
        step = step.withColumn(
            "__hashes", F.zip_with("__hashes", later, lambda x, y: F.xxhash64(x, y)))
    step = step.withColumn(
        "__hashes", F.slice("__hashes", 1, F.greatest(n - WINDOW + 1, F.lit(0))))
    # Only texts with some repetition pay for the sort.
    pairs = F.when(
        F.size(F.array_distinct("__hashes")) < F.size("__hashes"),
        F.array_sort(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    step = step.withColumn("__pairs", pairs)
    with_word = F.filter("__lines", lambda x: x["words"] > 0)
    plain = F.transform(with_word, lambda x: x["line"])
    lost = F.aggregate(
        "__lines", F.lit(0), lambda t, x: t + F.when(x["fails"], x["words"]).otherwise(0))
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.size(matches(col, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(plain) - F.size(F.array_distinct(plain))).cast("long").alias("n_dup_lines"),
        _repeats(F.col("__pairs")).cast("long").alias("n_repeat_words"),
        lost.cast("long").alias("n_lost_words"),
    )
    step = step.withColumn("__counts", counts)
    c = F.col("__counts")
    failed = (c["n_words"] < MIN_WORDS) | (
        c["n_repeat_words"] * 100 > c["n_words"] * MAX_REPEAT_PERCENT)
    enough = (c["n_lost_words"] * 100 <= c["n_words"] * MAX_LOST_PERCENT) & (
        c["n_words"] - c["n_lost_words"] >= MIN_WORDS)
    # Not deterministic on purpose: else Spark moves a filter on the result below the
    # steps above and computes all of them once for every mention of one.
    kept = ~failed & enough & (F.spark_partition_id() >= 0)
    verdict = F.struct(
        "__counts.*", failed.alias("base_failed"), kept.alias("kept"),
        F.when(col.isNotNull(), _without_failed("__lines")).alias("cleaned"))
    return step.withColumn("rules", verdict).drop(
        "__words", "__lines", "__hashes", "__pairs", "__counts")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``kept`` and the ``cleaned`` text."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return measure(slim).select("doc_id", "rules.*")


def keep(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The rows that pass, with their own columns only and their failed lines removed.

    ``length`` names a column that holds the text's number of characters, if there is one.
    """
    packed = docs.select(F.struct("*").alias("__row"), F.col(f"`{text}`").alias("__text"))
    passed = measure(packed, "__text").filter("rules.kept")
    out = passed.select("__row.*", F.col("rules.cleaned").alias("__cleaned")).withColumn(
        text, F.col("__cleaned")).drop("__cleaned")
    if length is not None:
        out = out.withColumn(length, F.length(f"`{text}`").cast(docs.schema[length].dataType))
    return out


def _without_failed(lines: Column | str) -> Column:
    good = F.filter(lines, lambda x: ~x["fails"])
    return F.array_join(F.transform(good, lambda x: x["line"]), "\n")


def clean(text: Column) -> Column:
    """The text without its failed lines; null for a null text."""
    return F.when(text.isNotNull(), _without_failed(line_verdicts(text)))
