"""Exact order statistics without a global sort or a one-task window.

A window over an unbounded group puts that group into one task. The functions here instead cut the value
range into slots, count rows per slot with map-side combining, find the slot that holds a wanted rank, and look
only at the rows of that slot.

Slots have levels. Split points first come from one small approximate-quantile job. Then rows are counted per
slot, and only the slots with more rows than the target are cut again, by split points drawn from their own rows,
until every slot is below the target or holds a single value. So a slot is a task's work whatever the number and
spread of the values: long common beginnings, far outliers and hot values only cost further levels. A table below
the target needs no second level.

The slot is a pure function of the value, so a recomputed partition gives the same answer, and equal values
are counted before they are ordered, so a value held by a third of all rows is one row. Answers are exact;
only the slot sizes depend on the approximation.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rollcall.session import settle

#: Slots of the first level, and pieces that one level cuts a slot into at most.
FIRST_SLOTS, MOST_PIECES = 128, 1024
#: Rows above which a slot is cut again, unless they all hold one value.
ROWS_PER_SLOT = 1_000_000

# Share of the values that the split points are estimated from, and the number of rows wanted at least. They bear
# on how equal the slots are, never on an answer: every row is counted in its slot.
SPLIT_SHARE, SPLIT_ROWS = 0.05, 10_000


def slot_count(df: DataFrame) -> int:
    """Slots of the first level: at least as many as shuffle partitions, up to the most that one level makes."""
    return max(FIRST_SLOTS, min(MOST_PIECES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def order_code(column: Column, data_type: T.DataType) -> Column:
    """A double that never decreases when the value increases; used for slots only, never for comparison."""
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.extract(F.lit("SECOND"), column).cast("double")
        return F.unix_date(column.cast("date")).cast("double") * 86400 + seconds
    return column.cast("double")


class _Numbers:
    """Split points of values with a number that keeps their order."""

    code_type = "double"

    @staticmethod
    def code(column: Column, data_type: T.DataType) -> Column:
        return order_code(column, data_type)

    @staticmethod
    def slot(df: DataFrame, code: str, points: Sequence[float], slot: str) -> DataFrame:
        edges = [float("-inf"), *points, float("inf")]
        if not points:
            return df.withColumn(slot, F.lit(0.0))
        return Bucketizer(splits=edges, inputCol=code, outputCol=slot, handleInvalid="keep").transform(df)

    @staticmethod
    def after(point: float) -> float:
        return math.nextafter(point, math.inf)

    @staticmethod
    def point(value: float) -> float:
        # the largest finite number parts infinity from all others
        return min(max(value, -sys.float_info.max), sys.float_info.max)

    @staticmethod
    def drawn(codes: DataFrame, pieces: int) -> DataFrame:
        """column, slot, points, n: approximate quantiles and number of each slot's rows."""
        shares = ", ".join(f"{i / pieces}D" for i in range(1, pieces))  # one text instead of many calls into the JVM
        cuts = F.expr(f"percentile_approx(nullif(code, 'NaN'), array({shares}), {4 * pieces})")
        return codes.groupBy("column", "slot").agg(cuts.alias("points"), F.count(F.lit(1)).alias("n"))


class _Texts:
    """Split points of texts, which have no number that keeps their order: texts drawn evenly from the distinct ones."""

    code_type = "string"

    @staticmethod
    def code(column: Column, data_type: T.DataType) -> Column:
        return column

    @staticmethod
    def slot(df: DataFrame, code: str, points: Sequence[str], slot: str) -> DataFrame:
        return df.withColumn(slot, F.expr(search_text(f"`{code}`", [f"CAST(X'{p.encode().hex()}' AS STRING)" for p in points])).cast("double"))

    @staticmethod
    def after(point: str) -> str:
        return point + "\0"

    @staticmethod
    def point(value: str) -> str:
        return value

    @staticmethod
    def drawn(codes: DataFrame, pieces: int) -> DataFrame:
        """column, slot, points, n (unknown): every 16th of the texts with the smallest hashes, an even draw of the distinct ones."""
        at = ["column", "slot"]
        # the filter by row_number becomes a group limit before the shuffle: a task sends at most that many for a slot
        by_hash = Window.partitionBy(*at).orderBy(F.xxhash64("code"), "code")
        some = codes.distinct().withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= 16 * pieces)
        by_text = Window.partitionBy(*at).orderBy("code")
        some = some.withColumns({"nth": F.row_number().over(by_text), "n": F.count(F.lit(1)).over(Window.partitionBy(*at))})
        step = F.greatest(F.lit(1), F.floor(F.col("n") / pieces))
        some = some.filter((F.col("nth") - 1) % step == 0)
        return some.groupBy(*at).agg(F.array_sort(F.collect_list("code")).alias("points"), F.lit(None).cast("long").alias("n"))  # at most 2 * pieces


def search_text(value: str, points: Sequence[str]) -> str:
    """SQL text of a binary search: how many of the points (SQL text of sorted values) are at most the value."""
    if not points:
        return "0"
    steps = ", ".join(str(1 << k) for k in reversed(range(len(points).bit_length())))
    step = f"IF(at + step <= {len(points)} AND get(array({', '.join(points)}), at + step - 1) <= {value}, at + step, at)"
    return f"CASE WHEN {value} IS NULL THEN 0 ELSE aggregate(array({steps}), 0, (at, step) -> {step}) END"


def add_slots(df: DataFrame, slots: Mapping[str, str], target: int | None = None, first: int | None = None) -> DataFrame:
    """Add a slot column per value column, ``{value column: slot column}`` (one job, and two for each further level).

    Slots have at most ``target`` rows (:data:`ROWS_PER_SLOT`) or a single value; ``first`` is the number of slots of
    the first level. NULL is in the first slot, NaN in one after the last.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = {c: s for c, s in slots.items() if isinstance(types[c], T.StringType)}
    numbers = {c: s for c, s in slots.items() if c not in texts}
    return _number_slots(_text_slots(df, texts, target, first), numbers, target, first)


def _text_slots(df: DataFrame, slots: Mapping[str, str], target: int | None = None, first: int | None = None) -> DataFrame:
    return _slots(df, slots, _Texts, target, first)


def _number_slots(df: DataFrame, slots: Mapping[str, str], target: int | None = None, first: int | None = None) -> DataFrame:
    return _slots(df, slots, _Numbers, target, first)


def _slots(df: DataFrame, slots: Mapping[str, str], kind, target: int | None, first: int | None) -> DataFrame:
    if not slots:
        return df
    names = [f"code__{i}" for i in range(len(slots))]
    coded = df.withColumns({name: kind.code(F.col(f"`{c}`"), df.schema[c].dataType) for name, c in zip(names, slots)})
    points = _split_points(coded.select(*names), kind, target or ROWS_PER_SLOT, first or slot_count(df))
    for i, slot in enumerate(slots.values()):
        coded = kind.slot(coded, names[i], points[i], slot)
    return coded.drop(*names)


def _melted_codes(coded: DataFrame, kind, points: Mapping[int, Sequence]) -> DataFrame:
    """column, slot, code: one row per row and value column."""
    codes = list(coded.columns)
    for i, code in enumerate(codes):
        coded = kind.slot(coded, code, points[i], f"slot__{i}")
    rows = [F.struct(F.lit(i).alias("column"), F.col(f"slot__{i}").alias("slot"), F.col(c).alias("code")) for i, c in enumerate(codes)]
    return coded.select(F.inline(F.array(*rows))).filter(F.col("code").isNotNull())


def _split_points(coded: DataFrame, kind, target: int, first: int) -> dict[int, list]:
    """Sorted split points per column, so that slots have at most ``target`` rows or one value."""
    points: dict[int, list] = {i: [] for i in range(len(coded.columns))}
    sample = _melted_codes(coded.filter(F.rand(7) < SPLIT_SHARE), kind, points)
    start = kind.drawn(sample, first).collect()
    for row in start:
        points[row["column"]] = sorted({kind.point(p) for p in row["points"] or ()})
    drawn = [row["n"] for row in start]
    # a small table needs no second look; its size is told from the draw where that counts rows
    few = max(drawn) / SPLIT_SHARE < 0.8 * target if drawn and None not in drawn else coded.count() <= target
    while not few:
        codes = _melted_codes(coded, kind, points)
        sizes = codes.groupBy("column", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("code").alias("lo"), F.max("code").alias("hi"))
        # the driver sees the overfull slots only, of which there are fewer than rows / target
        full = sizes.filter((F.col("n") > target) & (F.col("lo") < F.col("hi"))).collect()
        if not full:
            break
        starts = {(r["column"], r["slot"]): r["lo"] for r in full}
        pieces = min(MOST_PIECES, max(2, math.ceil(2 * max(r["n"] for r in full) / target)))
        share = min(1.0, max(SPLIT_SHARE, SPLIT_ROWS / min(r["n"] for r in full)))
        overfull = reduce(
            lambda a, b: a | b,
            [(F.col("column") == i) & F.col("slot").isin([s for c, s in starts if c == i]) for i in {c for c, _ in starts}],
        )
        found = kind.drawn(codes.filter(overfull & (F.rand(11) < share)), pieces).collect()
        before = sum(map(len, points.values()))
        for row in found:
            points[row["column"]] = _with_new_points(points[row["column"]], row["points"], starts[row["column"], row["slot"]], kind)
        missed = set(starts) - {(r["column"], r["slot"]) for r in found}
        for column, slot in missed:  # no row of the slot was drawn: its smallest value is told from the others
            points[column] = _with_new_points(points[column], [starts[column, slot]], starts[column, slot], kind)
        if sum(map(len, points.values())) == before:
            break  # values that differ although nothing lies between them
    return points


def _with_new_points(points: Sequence, drawn: Sequence, lo, kind) -> list:
    """A value that was drawn twice, or the slot's smallest one, gets a slot of its own, so each level gets on."""
    drawn = list(drawn or ())
    own = [p for i, p in enumerate(drawn) if p == lo or p in drawn[:i][-1:]]
    return sorted({*points, *map(kind.point, drawn), *(kind.point(kind.after(p)) for p in own)})


def group_join(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group columns in which NULL is a group of its own; columns appear once."""
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"right__{i}") for i, c in enumerate(columns)],
        *[F.col(f"`{c}`") for c in right.columns if c not in columns],
    )
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"right__{i}")) for i, c in enumerate(columns)]
    return left.join(renamed, on, how).drop(*[f"right__{i}" for i in range(len(columns))])


def null_safe_semi(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose values of ``columns`` occur in ``right``; NULL equals NULL."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"right__{i}") for i, c in enumerate(columns)])
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"right__{i}")) for i, c in enumerate(columns)]
    return left.join(renamed, on, "left_semi")


def _over(by: Sequence[str]) -> Window:
    # only ever used on slot tables, which have one row per slot and group
    return Window.partitionBy(*[F.col(f"`{c}`") for c in by]) if by else Window.partitionBy(F.lit(0))


def _running(table: DataFrame, window, names: Sequence[str], suffix: str = "_before") -> DataFrame:
    span = window.rowsBetween(Window.unboundedPreceding, -1)
    return table.withColumns({f"{m}{suffix}": F.coalesce(F.sum(m).over(span), F.lit(0)) for m in names})


def small_or_lazy(table: DataFrame) -> DataFrame:
    """``table`` with a broadcast hint if it is below the session's broadcast threshold (one job), else as it is.

    Without knowing the size beforehand Spark would shuffle the table on the other side and only then see that this
    one is tiny.
    """
    threshold = _bytes(table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    width = 16 + sum(64 if isinstance(f.dataType, (T.StringType, T.BinaryType)) else 16 for f in table.schema.fields)
    rows = table.limit(max(0, threshold // width) + 1).collect() if threshold > 0 else None
    if rows is None or sum(width + sum(len(v) for v in r if isinstance(v, (str, bytes))) for r in rows) > threshold:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema).coalesce(1))


def _bytes(text: str) -> int:
    """A size setting in bytes."""
    units = {"b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30}
    number = text.strip().lower().rstrip("bkmg")
    return int(number) << units[text.strip().lower()[len(number) :] or "b"]


def values_at_ranks(
    df: DataFrame,
    value: str,
    ranks: Mapping[str, Callable[[Column], Column]] | None = None,
    by: Sequence[str] = (),
    targets: DataFrame | None = None,
    slot: str | None = None,
) -> DataFrame:
    """The value at given 0-based ranks of each group, NULL values left out.

    ``ranks`` maps a name to a function from the group size to the rank. ``targets`` gives ranks per group
    instead, as rows ``(by..., rank_name, rank)``. ``slot`` names a slot column made by :func:`add_slots`.
    Returns ``(by..., rank_name, value, rank_in_value, n_equal, group_size)``, one row per rank that exists.
    Finding the slots runs jobs; the values are lazy.
    """
    by = list(by)
    known = df.filter(F.col(f"`{value}`").isNotNull())
    if slot is None:
        slot = "slot__"
        known = add_slots(known, {value: slot})
    known = known.select(*[F.col(f"`{c}`") for c in by], F.col(f"`{value}`"), F.col(slot))

    slots = known.groupBy(*by, slot).agg(F.count(F.lit(1)).alias("n"))
    over = _over(by)
    slots = _running(slots.withColumn("group_size", F.sum("n").over(over)), over.orderBy(slot), ["n"])
    if targets is not None:
        slots = group_join(slots, targets, by) if by else slots.join(targets, how="inner")
    else:
        pairs = [
            F.struct(F.lit(name).alias("rank_name"), rank(F.col("group_size")).cast("long").alias("rank"))
            for name, rank in ranks.items()
        ]
        slots = slots.select("*", F.inline(F.array(*pairs)))
    wanted = slots.filter((F.col("rank") >= F.col("n_before")) & (F.col("rank") < F.col("n_before") + F.col("n")))
    wanted = wanted.select(*by, slot, "rank_name", "group_size", (F.col("rank") - F.col("n_before")).alias("rank"))

    wanted = small_or_lazy(wanted)
    holders = wanted.select(*by, slot)
    inside = group_join(known, holders, [*by, slot], "left_semi")
    counts = inside.groupBy(*by, slot, value).agg(F.count(F.lit(1)).alias("n"))
    counts = _running(counts, Window.partitionBy(*by, slot).orderBy(value), ["n"])
    hits = group_join(counts, wanted, [*by, slot]).filter(
        (F.col("rank") >= F.col("n_before")) & (F.col("rank") < F.col("n_before") + F.col("n"))
    )
    return hits.select(
        *by,
        "rank_name",
        value,
        (F.col("rank") - F.col("n_before")).alias("rank_in_value"),
        F.col("n").alias("n_equal"),
        "group_size",
    )


def quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (), slot: str | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, one column per name in ``probs``."""
    ranks: dict[str, Callable[[Column], Column]] = {}
    for name, p in probs.items():
        ranks[f"{name}/lo"] = lambda n, p=p: F.floor((n - 1) * F.lit(float(p)))
        ranks[f"{name}/hi"] = lambda n, p=p: F.ceil((n - 1) * F.lit(float(p)))
    found = values_at_ranks(df, value, ranks, by, slot=slot)

    def picked(name: str) -> Column:
        return F.max(F.when(F.col("rank_name") == name, F.col(f"`{value}`"))).cast("double")

    columns = []
    for name, p in probs.items():
        position = (F.max("group_size") - 1) * F.lit(float(p))
        lo, hi = picked(f"{name}/lo"), picked(f"{name}/hi")
        columns.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return found.groupBy(*by).agg(*columns)


def running_totals(
    df: DataFrame, value: str, sums: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct value with its totals, the totals of all smaller values and of the whole group.

    Output columns: ``by..., value`` and for each name ``m``: ``m``, ``m_before``, ``m_total``.
    """
    by, names = list(by), list(sums)
    known = add_slots(df.filter(F.col(f"`{value}`").isNotNull()), {value: "slot__"})
    values = known.groupBy(*by, "slot__", value).agg(*[F.sum(c).alias(m) for m, c in sums.items()])
    slots = values.groupBy(*by, "slot__").agg(*[F.sum(m).alias(m) for m in names])
    over = _over(by)
    slots = slots.withColumns({f"{m}_total": F.sum(m).over(over) for m in names})
    slots = _running(slots, over.orderBy("slot__"), names, "_slots")
    within = _running(values, Window.partitionBy(*by, "slot__").orderBy(value), names, "_inside")
    joined = group_join(within, slots.drop(*names), [*by, "slot__"])
    return joined.select(
        *by,
        value,
        *names,
        *[(F.col(f"{m}_slots") + F.col(f"{m}_inside")).alias(f"{m}_before") for m in names],
        *[f"{m}_total" for m in names],
    )


def cut_rows(
    df: DataFrame,
    order: Sequence[str],
    ranks: Mapping[str, Callable[[Column], Column]],
    by: Sequence[str] = (),
) -> DataFrame:
    """``(by..., rank_name, order...)``: the rows at given 0-based ranks of the order by several columns (runs jobs).

    Ties on the first column are broken by the next one, and so on; columns not needed to tell the row from all
    others are NULL, and ``depth__`` says how many are needed. Rows stay in Spark, so ``by`` may have any number of
    values; the driver only asks whether ties are left.
    """
    by, order = list(by), list(order)
    narrow = df.select(*by, *order)
    open_rows = settle(values_at_ranks(narrow, order[0], ranks, by))
    done = []
    for depth in range(1, len(order) + 1):
        told = F.lit(depth == len(order)) | (F.col("n_equal") == 1)
        later = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order[depth:]]
        done.append(open_rows.filter(told).select(*by, "rank_name", *order[:depth], *later, F.lit(depth).alias("depth__")))
        open_rows = open_rows.filter(~told)
        if depth == len(order) or open_rows.isEmpty():
            break
        prefix = [*by, *order[:depth]]
        targets = open_rows.select(*prefix, "rank_name", F.col("rank_in_value").alias("rank"))
        ties = null_safe_semi(narrow, small_or_lazy(targets.select(*prefix).distinct()), prefix)
        open_rows = settle(values_at_ranks(ties, order[depth], by=prefix, targets=targets))
    return reduce(DataFrame.unionAll, done)


def rows_at_ranks(
    df: DataFrame,
    order: Sequence[str],
    ranks: Mapping[str, Callable[[Column], Column]],
    by: Sequence[str] = (),
) -> list[dict]:
    """The rows of :func:`cut_rows` as dicts, for ranks whose number is a parameter; columns not needed are None."""
    by, order = list(by), list(order)
    return [{c: r[c] for c in [*by, "rank_name", *order]} for r in cut_rows(df, order, ranks, by).collect()]


def at_or_after(order: Sequence[str], row: Mapping) -> Column:
    """Whether a row is the given one or comes later, for a row found by :func:`rows_at_ranks`."""
    out = F.lit(True)
    for c in reversed([c for c in order if row[c] is not None]):
        out = (F.col(c) > F.lit(row[c])) | ((F.col(c) == F.lit(row[c])) & out)
    return out


def at_or_before(order: Sequence[str], row: Mapping) -> Column:
    """Whether a row is the given one or comes earlier, for a row found by :func:`rows_at_ranks`."""
    out = F.lit(True)
    for c in reversed([c for c in order if row[c] is not None]):
        out = (F.col(c) < F.lit(row[c])) | ((F.col(c) == F.lit(row[c])) & out)
    return out


def at_or_before_cut(order: Sequence[str], prefix: str, depth: str) -> Column:
    """Whether a row is a row of :func:`cut_rows` or comes earlier, with that row's columns beside it as ``prefix`` + name."""
    out = F.lit(True)
    for k, c in reversed(list(enumerate(order))):
        mine, cut = F.col(f"`{c}`"), F.col(f"`{prefix}{c}`")
        out = (F.col(depth) <= k) | (mine < cut) | ((mine == cut) & out)
    return out
