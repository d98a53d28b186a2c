"""Quality rules: thresholds from mergeable quantile sketches per language and source, then joined filtering.

Only DataFrame functions. The sketch of a measure is its histogram over buckets of relative width 1/32 (values below 64
are buckets of their own); sketches merge by adding counts, so a group with a third of all rows is pre-aggregated in the
tasks. A threshold is the upper edge of the bucket that holds a wanted quantile.

Nulls, empty texts, repeated rows: a null text counts as empty and fails the fixed rules; null language or source form a
group of their own; each row is judged by itself. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.common import kept_table
from rollcall.llm.mixing import SPACE

SYMBOLS = "#*$%&|<>"
#: A document fails when a measure exceeds high + REACH * (high - middle) + its slack, the middle and the high quantile of its group.
MIDDLE, HIGH, REACH = 0.5, 0.9, 3
#: Measures in thousandths (word length in hundredths; duplicate lines are a share of the lines that hold a word) and the slack each gets.
MEASURES = {"symbol_rate": 50, "dup_line_rate": 300, "repeat_rate": 100, "word_length": 300}


def word_list(text: Column) -> Column:
    spaced = F.translate(text, SPACE, " " * len(SPACE))
    return F.array_remove(F.split(spaced, " "), "")


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words in runs of ``width`` words found twice or more in the text, the first included.

    The runs' hashes are sorted with their positions; a run is repeated if a neighbour has its hash. Each repeated position then adds
    the words up to the next one, ``width`` at most.
    """
    runs = F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + j) for j in range(width)]).alias("h"), i.alias("i")),
    )
    return F.when(F.size(words) < width, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.sort_array(runs))


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """doc_id, lang, source, n_words, n_lines, word_chars, n_symbols, n_dup_lines, n_repeat_words per row."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    df = docs.select(F.col(id_column).alias("doc_id"), F.col(lang_column).alias("lang"), F.col(source_column).alias("source"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    df = df.select(
        "doc_id",
        "lang",
        "source",
        F.length(F.translate("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))[0].alias("l"),
        # a lambda's argument is computed once, however often it is used
        F.transform(
            F.array(word_list(F.col("text"))),
            lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("runs")),
        )[0].alias("w"),
    )
    neighbours = F.transform(
        F.array(F.col("w.runs")),
        lambda s: F.sort_array(
            F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.size(s)),
                    lambda i: (F.get(s, i)["h"] == F.get(s, i - 1)["h"]) | (F.get(s, i)["h"] == F.get(s, i + 1)["h"]),
                ),
                lambda i: F.get(s, i)["i"],
            )
        ),
    )[0]
    covered = F.transform(
        F.array(neighbours),
        lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x),
    )[0]
    counts = [F.col("w.n").alias("n_words"), F.col("l.n").alias("n_lines"), "word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines")]
    return df.select("doc_id", "lang", "source", *counts, covered.alias("n_repeat_words"))


def rates(df: DataFrame) -> DataFrame:
    """The measures that are compared within a group, as whole numbers."""
    return df.withColumns(
        {
            "symbol_rate": F.expr("1000 * n_symbols div greatest(word_chars, 1)"),
            "dup_line_rate": F.expr("1000 * n_dup_lines div greatest(n_lines, 1)"),
            "repeat_rate": F.expr("1000 * n_repeat_words div greatest(n_words, 1)"),
            "word_length": F.expr("100 * word_chars div greatest(n_words, 1)"),
        }
    )


def bucket(x: Column) -> Column:
    """The upper edge of a value's bucket: values below 64 as they are, others with six leading bits."""
    shift = F.greatest(F.length(F.bin(x)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", x, shift) + 1, shift) - 1


def sketch_thresholds(df: DataFrame, groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row per group with the limit of each measure (columns ``<measure>_limit``)."""
    measures = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("edge")) for m in MEASURES]))
    counts = df.select(*groups, measures.alias("x")).groupBy(*groups, "x.measure", "x.edge").agg(F.count("*").alias("n"))
    run = Window.partitionBy(*groups, "measure").orderBy("edge").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*groups, "measure")
    counts = counts.withColumn("upto", F.sum("n").over(run)).withColumn("all", F.sum("n").over(whole))
    # counts against whole hundredths of the group's size: no rounding
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("all") * int(q * 100), F.col("edge")))
    limits = counts.groupBy(*groups, "measure").agg(at(MIDDLE).alias("middle"), at(HIGH).alias("high"))
    limit = F.col("high") + REACH * (F.col("high") - F.col("middle"))
    return limits.groupBy(*groups).agg(*[F.max(F.when(F.col("measure") == m, limit + slack)).alias(f"{m}_limit") for m, slack in MEASURES.items()])


def quality(docs: DataFrame, **columns: str) -> DataFrame:
    """doc_id, the counts of ``measured``, base_failed and kept, per row.

    base_failed: fewer than 50 words, or more than half of the words in repeated runs of three. kept: not base_failed, and no measure above
    the limit of its language and source, which come from the rows that pass the fixed rules.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    df = rates(measured(docs, **columns)).withColumn("base_failed", failed)
    df = kept_table(df, "quality-measures")
    limits = sketch_thresholds(df.where(~F.col("base_failed"))).withColumnsRenamed({"lang": "l", "source": "s"})
    joined = df.join(limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    above = F.lit(False)
    for m in MEASURES:
        above = above | (F.col(m) > F.col(f"{m}_limit"))
    kept = ~F.col("base_failed") & ~F.coalesce(above, F.lit(False))
    return joined.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
