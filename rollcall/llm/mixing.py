"""Mixing sources to target weights: hash-threshold histograms.

Sizes are summed by source and hash bucket; the bucket in which a source's budget ends is refined by the next digits of
the hash until one row is left in it, and rows are taken by comparing hashes. Nothing is sorted.

Nulls, empty and repeated rows: a null text has size 0; a null source is a source of its own, ordered last; rows are
told apart by id and text, so rows that agree in both are taken or left together. An empty table gives an empty result.
Other columns are not read. The table of sources (one row each, two numbers) is the only thing ordered as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.common import kept_table

#: Bits of the hash that one level of the histogram adds, and the number of levels: 60 bits in all.
LEVEL_BITS, LEVELS = 12, 5
SPACE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Runs of characters other than space and 0x09 to 0x0D (null: 0), without a regular expression."""
    spaced = F.coalesce(text, F.lit(""))
    for c in SPACE[1:]:  # translate() would make a string of each character
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.size(F.array_remove(F.split(spaced, " "), "")).cast("long")


def place(doc_id: Column, text: Column, seed: str) -> Column:
    """60 bits of a digest of the row."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, weight, target: ``share`` of all sizes by weight, at most ``most`` times a source's size.

    What a source cannot take goes to the others by weight until none is above: target = min(most * size, level * weight),
    and the level follows from the sources in order of the level at which they are full.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    full = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    full = full.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    full = full.withColumn("limit", most * F.col("source_size")).withColumn("full_at", F.col("limit") / F.col("weight"))
    order = Window.orderBy("full_at", "rank")
    below, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = full.withColumn("level", (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(below), F.lit(0.0))) / F.sum("weight").over(rest))
    # the first source that is not full at its level sets the level of all that follow
    full = full.withColumn("level", F.min(F.when(F.col("full_at") > F.col("level"), F.struct("full_at", "rank", "level"))).over(whole)["level"])
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("level") * F.col("weight")))
    return full.select("source", "source_size", "weight", target.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source the place below which its rows, summed by size, come nearest to ``budget``: source, below."""
    state = budgets.select("source", "budget", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("before"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        bucket = F.shiftright("place", shift)
        if level:
            boundary = state.withColumnRenamed("source", "s")
            rows_here = rows.join(boundary, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("place", shift + LEVEL_BITS) == F.shiftright("low", shift + LEVEL_BITS)), "left_semi")
        else:
            rows_here = rows
        sums = rows_here.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        sums = sums.withColumnRenamed("source", "s").join(state, F.col("s").eqNullSafe(F.col("source"))).drop("s")
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("after", F.col("before") + F.sum("size").over(run))
        # the bucket in which the budget ends; if all fit, one past the last
        inner = sums.where(F.col("after") > F.col("budget")).groupBy("source", "budget").agg(F.min(F.struct("bucket", F.col("after") - F.col("size"), "size")).alias("hit"))
        hit = inner.select("source", "budget", F.shiftleft(F.col("hit.bucket"), shift).alias("low"), F.col("hit.col2").alias("before"), F.col("hit.size").alias("width"))
        state = kept_table(
            state.select("source", "budget").withColumnRenamed("source", "s").withColumnRenamed("budget", "b")
            .join(hit, F.col("s").eqNullSafe(F.col("source")), "left")
            .select(F.col("s").alias("source"), F.col("b").alias("budget"), F.coalesce("low", F.lit(1 << LEVEL_BITS * LEVELS)).alias("low"), F.coalesce("before", F.lit(0)).cast("long").alias("before"), F.coalesce("width", F.lit(0)).cast("long").alias("width")),
            "mixing-boundary",
        )
    # the boundary row is taken if that comes nearer
    nearer = (F.col("before") + F.col("width") - F.col("budget")) < (F.col("budget") - F.col("before"))
    return state.select("source", F.when(nearer, F.col("low") + 1).otherwise(F.col("low")).alias("below"))


def mix_plan(rows: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """s (source), source_size, target, whole (copies of every row) and below (rows whose place is below get one more), from source, size, place of all rows."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = kept_table(targets(sizes, weights, share, most), "mixing-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    limits = thresholds(rows.where("size > 0"), plan.select("source", "budget"))
    plan = plan.withColumnRenamed("source", "s").join(limits, F.col("s").eqNullSafe(F.col("source"))).select("s", "source_size", "target", "whole", "below")
    # kept, so that Spark sees how small it is: rows and their texts need not be shuffled by source to meet it
    return kept_table(plan, "mixing-plan")


def sized(docs: DataFrame, seed: str, id_column: str, text_column: str, source_column: str) -> DataFrame:
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size"), place(F.col(id_column), F.col(text_column), seed).alias("place")
    )
    return kept_table(rows, "mixing-sizes")


def copies(size: Column, at: Column, most: int) -> Column:
    """How often a row is taken, beside the columns of the plan."""
    return F.least(F.col("whole") + F.when((size > 0) & (at < F.col("below")), 1).otherwise(0), F.lit(most)).cast("long")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words that the mix takes), copies, per row of ``docs``.

    A row is taken whole: floor(target / source size) times, and once more if its place is below the source's threshold. A source without words has target 0.
    """
    rows = sized(docs, seed, id_column, text_column, source_column)
    joined = rows.join(mix_plan(rows, weights, share, most), F.col("source").eqNullSafe(F.col("s")))
    joined = joined.withColumn("copies", copies(F.col("size"), F.col("place"), most))
    return joined.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns as they are. Rows without words stay as they are: they weigh nothing."""
    rows = sized(docs, seed, id_column, text_column, source_column)
    plan = mix_plan(rows, weights, share, most)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col(f"row.`{text_column}`")
    size = word_count(text)
    joined = own.join(plan, F.col(f"row.`{source_column}`").eqNullSafe(F.col("s")))
    times = F.when(size == 0, 1).otherwise(copies(size, place(F.col(f"row.`{id_column}`"), text, seed), most))
    repeated = joined.select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("nth"))
    return repeated.select("row.*")
