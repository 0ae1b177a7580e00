"""Quality rules with adaptive thresholds per language and source.

Each document is measured; per language and source, a quantile sketch of each measure says
what is usual there, and documents far beyond the usual are rejected. Most documents have no
symbols and no repeated lines or words; of these measures the sketch tells the share of
documents that have some, and how much those have. Symbols that are glued to words and symbols
that stand alone are measures of their own.

The sketch counts values in buckets whose bounds grow by a constant factor. Its quantiles
have that relative error, two sketches merge by adding their counts, and the same values
give the same sketch in any order. So a sketch is one grouped count, pre-aggregated in each
task, with at most a few hundred buckets for each group and measure, and it has no random part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daygauge.llm.workspace import SPACES, same, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
GLUED = "n_glued"

# Relative width of a bucket; values under LEAST count as 0.
WIDTH = 1.02
LEAST = 0.001
ZERO = -100_000
LOWER, MIDDLE, UPPER = 0.25, 0.5, 0.75
# Word length is far out beyond median + REACH * (upper - median) + slack, likewise below.
REACH = 6.0
# Other measures are beyond slack + HABIT_REACH * share * share * upper, with the share of the group's
# documents that have some, and the upper quartile of what those have: what few documents do hardly
# moves the bound of their own group, what is the habit of a group does.
HABIT_REACH = 3.0
SPREAD = "word_length"
# Measures as ratios, with the slack that any group has.
RATIOS = {
    "glued_ratio": (GLUED, "n_words", 0.15),
    "loose_ratio": (f"(n_symbols - {GLUED})", "n_words", 0.15),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 0.4),
    "repeat_ratio": ("n_repeat_words", "n_words", 0.25),
    SPREAD: ("word_chars", "n_words", 2.0),
}


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, upto = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, upto)
            upto = at + 3
    return covered


def measure_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; zeros for a null text.

    Lines are those with a word; n_dup_lines of them equal an earlier line.
    """
    if not text:
        return (0, 0, 0, 0, 0, 0)
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        chars,
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated(words),
    )


def glued_symbols(text: str | None) -> int:
    """Symbols in words that have other characters too."""
    if not text or not any(symbol in text for symbol in SYMBOLS):
        return 0
    bare = ((word, word.translate(None, SYMBOLS.encode())) for word in text.encode().split())
    return sum(len(word) - len(rest) for word, rest in bare if rest)


def _measured(text: Column) -> Column:
    names = [*(m.split()[0] for m in MEASURES.split(", ")), GLUED]

    @F.pandas_udf(f"{MEASURES}, {GLUED} long")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [(*measure_text(text), glued_symbols(text)) for text in texts]
            yield pd.DataFrame(rows, columns=names, dtype="int64")

    return measured(text)


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def bucket(value: Column) -> Column:
    """The bucket of a value that isn't negative."""
    return F.when(value < LEAST, F.lit(ZERO)).otherwise(F.ceil(F.ln(value) / F.ln(F.lit(WIDTH)))).cast("int")


def bucket_value(number: Column) -> Column:
    """The value that stands for a bucket: its upper bound."""
    return F.when(number == ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(WIDTH), number))


def sketches(measured: DataFrame, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per group and measure: bucket and its count. Nulls have no bucket, but are a group of their own."""
    pairs = [F.struct(F.lit(v).alias("measure"), bucket(F.col(v)).alias("bucket")) for v in values]
    rows = measured.select(*groups, F.explode(F.array(*pairs)).alias("at")).select(*groups, "at.*")
    return rows.where("bucket IS NOT NULL").groupBy(*groups, "measure", "bucket").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, groups: Sequence[str], at: dict[str, float]) -> DataFrame:
    """Per group and measure, the sketched quantiles: the first bucket that reaches the share."""
    of = W.partitionBy(*groups, "measure")
    ranked = sketch.withColumn("upto", F.sum("n").over(of.orderBy("bucket"))).withColumn("all", F.sum("n").over(of))
    found = [
        bucket_value(F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("bucket")))).alias(name)
        for name, share in at.items()
    ]
    return ranked.groupBy(*groups, "measure").agg(*found)


def _ratio(name: str) -> Column:
    """A measure as a ratio; null without words or lines."""
    part, whole, _ = RATIOS[name]
    return F.try_divide(F.expr(part).cast("double"), F.col(whole))


def thresholds(measured: DataFrame, groups: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Per group a least and a greatest value of each ratio, from the documents that pass the base rules."""
    ratios = [_ratio(name).alias(name) for name in RATIOS]
    usual = measured.where(~base_failed()).select(*groups, *ratios)
    of = W.partitionBy(*groups, "measure")
    some = F.sum(F.when(F.col("bucket") != ZERO, F.col("n")).otherwise(0)).over(of)
    sketch = sketches(usual, groups, list(RATIOS)).withColumn("share", some / F.sum("n").over(of))
    at = {"lower": LOWER, "middle": MIDDLE, "upper": UPPER}
    found = quantiles(sketch.where(F.col("bucket") != ZERO), [*groups, "share"], at)
    slack = F.element_at(F.create_map(*[F.lit(x) for n, (*_, s) in RATIOS.items() for x in (n, s)]), F.col("measure"))
    spread = F.col("measure") == SPREAD
    habit = slack + F.lit(HABIT_REACH) * F.col("share") * F.col("share") * F.col("upper")
    bounds = found.select(
        *groups,
        "measure",
        F.when(spread, F.col("middle") - (F.col("middle") - F.col("lower")) * REACH - slack).otherwise(0.0).alias("least"),
        F.when(spread, F.col("middle") + (F.col("upper") - F.col("middle")) * REACH + slack).otherwise(habit).alias("most"),
    )
    each = [
        F.max(F.when(F.col("measure") == name, F.col(bound))).alias(f"{bound}_{name}")
        for name in RATIOS
        for bound in ("least", "most")
    ]
    return bounds.groupBy(*groups).agg(*each)


def _inside() -> Column:
    """Whether no ratio is beyond its group's bounds; a ratio or a bound that is missing rejects nothing."""
    checks = [
        F.coalesce(_ratio(name).between(F.col(f"least_{name}"), F.col(f"most_{name}")), F.lit(True)) for name in RATIOS
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result & check
    return result


def _judged(measured: DataFrame, bounds: DataFrame) -> DataFrame:
    """Join the bounds by language and source; null is a language or source like others."""
    named = bounds.withColumnsRenamed({"lang": "b_lang", "source": "b_source"})
    on = same(F.col("lang"), F.col("b_lang")) & same(F.col("source"), F.col("b_source"))
    failed = base_failed()
    return measured.join(named, on, "left").withColumn("base_failed", failed).withColumn("kept", ~failed & _inside())


def quality(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """One row per document: the key, the measures, base_failed, kept.

    A null or empty text has no words and fails the base rule. Thresholds come from all
    documents of a language and source, null being one of each; in a group without documents
    that pass the base rules nothing else is rejected. Rows are judged one by one, repeated
    ones alike. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(
        F.col(key).alias("id"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
        _measured(F.col(text)).alias("m"),
    ).select("id", "lang", "source", "m.*")
    measured = stored(rows, "quality-measures")
    bounds = stored(thresholds(measured), "quality-bounds")
    names = [m.split()[0] for m in MEASURES.split(", ")]
    judged = _judged(measured, bounds)
    return judged.select(F.col("id").alias(key), *names, "base_failed", "kept")


def good_documents(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Null and empty texts go; a null language or source is one of each; repeated rows are judged alike,
    and a value that equals a bound is inside it. A text of any length is measured whole. An empty
    table gives no rows, and columns of any name are kept as they are.

    Texts are measured twice and never shuffled: the bounds, a narrow row for each language
    and source, go to them, broadcast by Spark while their stored size is under its threshold.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(
        doc, F.col(lang).alias("lang"), F.col(source).alias("source"), _measured(F.col(text)).alias("m")
    ).select("doc", "lang", "source", "m.*")
    bounds = stored(thresholds(rows.drop("doc")), "quality-bounds")
    return _judged(rows, bounds).where("kept").select("doc.*")
