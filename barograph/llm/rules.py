"""Quality rules in a cascade: the rules that reject most per unit of cost come first.

Built-in functions only. A rule is a predicate on the text that is true where a document
is to be rejected. The order never changes the verdict, only the time it takes: `CASE`
stops at the first rule that holds.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"


@dataclass(frozen=True)
class Limits:
    """Bounds of the rules.

    few_words, repeated: the base rules. symbols, shouts: per 100 words. dup_lines, capitals:
    percent. short_words, long_words: mean length of a word.
    """

    few_words: int = 50
    repeated: int = 50
    symbols: int = 25
    shouts: int = 25
    dup_lines: int = 50
    capitals: int = 50
    short_words: int = 2
    long_words: int = 20
    sample: int = 1000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def count_of(text: Column, pattern: str) -> Column:
    """Characters of the text in matches of the pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def windows_of(words: Column) -> Column:
    """Every window of three words with its place, sorted by the words."""
    n = F.size(words)
    return F.when(n >= 3, F.sort_array(F.arrays_zip(
        F.slice(words, 1, n - 2).alias("a"), F.slice(words, 2, n - 2).alias("b"), F.slice(words, 3, n - 2).alias("c"),
        F.sequence(F.lit(0), n - 3).alias("at"),
    )))


def places_of(windows: Column) -> Column:
    """Places, in order, of the windows that the text has twice or more."""
    m = F.size(windows) - 1
    next_to = F.filter(
        F.arrays_zip(F.slice(windows, 1, m).alias("x"), F.slice(windows, 2, m).alias("y")),
        lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"]),
    )
    places = F.concat(F.transform(next_to, lambda p: p["x"]["at"]), F.transform(next_to, lambda p: p["y"]["at"]))
    return F.when(m >= 1, F.sort_array(F.array_distinct(places)))


def covered(places: Column) -> Column:
    """Words in windows that begin at these places."""
    k = F.size(places) - 1
    steps = F.zip_with(F.slice(places, 1, k), F.slice(places, 2, k), lambda p, q: F.least(q - p, F.lit(3)))
    total = F.aggregate(steps, F.lit(3).cast("long"), lambda s, x: s + x)
    return F.when(F.size(places) >= 2, total).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the base measures n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    The nested arrays are columns of their own, so none is built again for each of its elements.
    A null text has no words. Columns of ``docs`` with these names must not be in ``keep``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, text.alias("__text"), words_of(text).alias("__words"), lines_of(text).alias("__lines"))
    rows = rows.withColumn("__windows", windows_of(F.col("__words")))
    rows = rows.withColumn("__places", places_of(F.col("__windows")))
    return rows.select(
        *keep,
        "__text",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        count_of(F.col("__text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered(F.col("__places")), F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def rules(limits: Limits) -> dict[str, Column]:
    """Rejecting predicates over ``__text`` alone; a cascade evaluates none beyond the first that holds."""
    text = F.col("__text")
    words, n = words_of(text), F.size(words_of(text))
    lines = lines_of(text)
    letters = count_of(text, r"\p{L}+")
    return {
        "few_words": n < limits.few_words,
        "symbols": 100 * count_of(text, SYMBOLS) > limits.symbols * n,
        "shouts": 100 * count_of(text, "!+") > limits.shouts * n,
        "dup_lines": 100 * (F.size(lines) - F.size(F.array_distinct(lines))) > limits.dup_lines * F.size(lines),
        "capitals": 100 * count_of(text, r"\p{Lu}+") > limits.capitals * letters,
        "short_words": F.length(F.array_join(words, "")) < limits.short_words * n,
        "long_words": F.length(F.array_join(words, "")) > limits.long_words * n,
    }


def ordered(docs: DataFrame, limits: Limits, checks: dict[str, Column]) -> list[str]:
    """Rule names by rejections per second on a sample of at most ``limits.sample`` rows.

    The sample is the first rows a scan returns, from as few partitions as hold them; it decides the order only.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("__text")
    sample = docs.sparkSession.createDataFrame(docs.select(text).take(limits.sample), "__text string")
    rejected = sample.agg(F.count("*"), *[F.count(F.when(c, 1)) for c in checks.values()]).first()

    def seconds(column: Column) -> float:
        begin = time.perf_counter()
        sample.select(F.count_if(column)).first()
        return time.perf_counter() - begin

    empty = seconds(F.col("__text").isNull())
    cost = {name: max(seconds(c) - empty, 1e-4) for name, c in checks.items()}
    gain = dict(zip(checks, rejected[1:], strict=True))
    return sorted(checks, key=lambda name: (-gain[name] / cost[name], cost[name], name))


def verdict(order: list[str], checks: dict[str, Column]) -> Column:
    """True where no rule holds; stops at the first that does."""
    out = F.when(checks[order[0]], F.lit(False))
    for name in order[1:]:
        out = out.when(checks[name], F.lit(False))
    return out.otherwise(F.lit(True))


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: doc_id, the base measures, base_failed and kept.

    base_failed: fewer than ``few_words`` words, or more than ``repeated`` percent of the words
    in windows of three words that the text has twice or more. kept: not base_failed and no rule
    of the cascade holds. A null or empty text has no words and fails; every row gets a row, so
    repeated ids do too; columns other than doc_id and text are ignored.
    """
    checks = {k: v for k, v in rules(limits).items() if k != "few_words"}
    order = ordered(docs, limits, checks)
    rows = measures(docs, ["doc_id"])
    failed = (F.col("n_words") < limits.few_words) | (
        100 * F.col("n_repeat_words") > limits.repeated * F.col("n_words")
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.when(failed, F.lit(False)).otherwise(verdict(order, checks)).alias("kept"),
    )


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with their columns unchanged.

    The repeated-words rule costs most by far, so it stands last; the sample orders the others.
    """
    checks = rules(limits)
    order = ordered(docs, limits, checks)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("__row"), F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    rows = rows.where(verdict(order, checks))
    rows = rows.withColumn("__words", words_of(F.col("__text")))
    rows = rows.withColumn("__windows", windows_of(F.col("__words")))
    rows = rows.withColumn("__places", places_of(F.col("__windows")))
    repeated = F.coalesce(covered(F.col("__places")), F.lit(0))
    good = 100 * repeated <= limits.repeated * F.size("__words")
    # A filter here would move below the columns it needs and build the arrays anew; explode stays.
    one = F.explode(F.when(good, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    return rows.select("__row", one.alias("__one")).select("__row.*")
