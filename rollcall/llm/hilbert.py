"""Approximate nearest neighbours by shifted space-filling curves.

1. Equal vectors are one point that knows its smallest ids, so a vector that a third of all rows share is searched once.
2. Each of several curves projects the points on a few random directions, shifts them and numbers them along a Hilbert curve. Spark range-partitions and sorts the
   keys; positions in that order, not key values, cut a curve into windows of WINDOW points, so no window grows.
3. A query looks at its own window of each curve and at ``reach`` windows on both sides; what the curves find is merged and reranked by the exact measure.
   ``reach`` is the least number at which a sample of PROBES queries finds the wanted share of its true neighbours, which are found by reading all rows in blocks.

The directions' scales are fitted on a bounded sample (SAMPLE points); every row is indexed. Vectors that are null, zero, or that hold null or non-finite components take no part. Vectors of
different lengths have no inner product, so each length is searched by itself. Rows of one id are rows of their own: a query leaves out its own row alone. A null id counts as larger than all others.
Among equal scores the smaller ids come first, however many there are. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import NO_ID, kept_table

CURVES, DIMENSIONS, BITS = 8, 6, 10
WINDOW, SAMPLE, PROBES = 1024, 5000, 64
#: Queries of a window that a task scores at once.
ASKED = 256


def hilbert_index(x: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of points with ``bits`` bits in each coordinate (Skilling's transposition)."""
    x = x.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


class Curves:
    """Directions, scales and shifts of the curves, fitted on a sample."""

    def __init__(self, sample: np.ndarray, curves: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        width = sample.shape[1]
        self.center = sample.mean(0)
        self.directions = [np.linalg.qr(rng.normal(size=(width, min(DIMENSIONS, width))))[0] for _ in range(curves)]
        self.knots = [np.quantile((sample - self.center) @ d, np.linspace(0, 1, 257), axis=0) for d in self.directions]
        self.shifts = rng.random((curves, min(DIMENSIONS, width)))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """One column for each curve."""
        out = []
        for d, knots, shift in zip(self.directions, self.knots, self.shifts):
            y = (x - self.center) @ d
            # even shares of the sample, so cells are about as full everywhere; half of the range is left for the shift
            u = np.stack([np.interp(y[:, j], knots[:, j], np.linspace(0, 0.5, 257)) for j in range(y.shape[1])], 1)
            out.append(hilbert_index(np.minimum((u + shift / 2) * (1 << BITS), (1 << BITS) - 1), BITS))
        return np.stack(out, 1)


def vectors(column: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.float64) for v in column]) if len(column) else np.zeros((0, 1))


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Indices of the ``most`` nearest: larger scores, then smaller ids."""
    return np.lexsort((ids, -scores))[:most]


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, v (array of double) of the rows that take part."""
    v = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    good = rows.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), v.alias("v"))
    return good.where(F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def distinct_points(good: DataFrame, most: int) -> DataFrame:
    """v (doubles as bytes), ids (the smallest most + 1), n: one row per different vector."""
    schema = "v binary, ids array<long>, n long"

    def shorter(table: pd.DataFrame) -> pd.DataFrame:
        out = [(v, np.sort(np.concatenate(g.ids.to_list()))[: most + 1], g.n.sum()) for v, g in table.groupby("v", sort=False)]
        return pd.DataFrame(out, columns=["v", "ids", "n"])

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raw = [(np.asarray(x, np.float64) + 0.0).tobytes() for x in b.v]  # no negative zeros
            yield shorter(pd.DataFrame({"v": raw, "ids": [[i] for i in b.id], "n": 1}))

    parts = good.mapInPandas(start, schema)
    # each task has sent at most one row for a vector and batch
    return parts.groupBy("v").applyInPandas(shorter, schema)


def placed(points: DataFrame, curves: Curves, count: int) -> DataFrame:
    """curve, place (position along the curve), point, v, ids, asks."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = curves.keys(vectors(b.v)) if len(b) else np.zeros((0, count), np.int64)
            for c in range(count):
                yield pd.DataFrame({"curve": c, "key": keys[:, c], "point": b.point})

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, part = 0, TaskContext.get().partitionId()
        for b in batches:
            yield pd.DataFrame({"curve": b.curve, "point": b.point, "part": part, "nth": np.arange(done, done + len(b))})
            done += len(b)

    keys = points.select("point", "v").mapInPandas(keyed, "curve int, key long, point long")
    order = keys.repartitionByRange("curve", "key", "point").sortWithinPartitions("curve", "key", "point")
    order = kept_table(order.mapInPandas(numbered, "curve int, point long, part int, nth long"), "curves-order")
    # one row for each partition and curve
    sums = order.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("nth").alias("least")).collect()
    before, offsets = {}, []
    for r in sorted(sums, key=lambda r: (r["curve"], r["part"])):
        offsets.append((r["curve"], r["part"], before.get(r["curve"], 0) - r["least"]))
        before[r["curve"]] = before.get(r["curve"], 0) + r["n"]
    table = points.sparkSession.createDataFrame(offsets, "curve int, part int, offset long")
    return order.join(F.broadcast(table), ["curve", "part"]).select("curve", "point", (F.col("nth") + F.col("offset")).alias("place"))


def true_neighbours(points: DataFrame, probes: np.ndarray, most: int) -> pd.DataFrame:
    """probe, point of the nearest points of each probe, all rows read in blocks."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            scores = probes @ vectors(b.v).T if len(b) else np.zeros((len(probes), 0))
            for k, s in enumerate(scores):
                top = best(s, b.point.to_numpy(), most)
                yield pd.DataFrame({"probe": k, "point": b.point.to_numpy()[top], "score": s[top]})

    def least(table: pd.DataFrame) -> pd.DataFrame:
        return table.iloc[best(table.score.to_numpy(), table.point.to_numpy(), most)]

    found = points.select("point", "v").mapInPandas(near, "probe int, point long, score double")
    return found.groupBy("probe").applyInPandas(least, "probe int, point long, score double").select("probe", "point")


def reach_for(points: DataFrame, places: DataFrame, most: int, wanted: float, window: int, probes: int) -> int:
    """The least number of windows to both sides at which the probes find the wanted share of their true neighbours."""
    chosen = points.where("asks").orderBy(F.xxhash64("point")).limit(probes).select("point", "v").toPandas()
    if not len(chosen):
        return 0
    truth = true_neighbours(points, vectors(chosen.v), most + 1)
    own = points.sparkSession.createDataFrame([(k, int(p)) for k, p in enumerate(chosen.point)], "probe int, own long")
    at = places.select("curve", "point", F.floor(F.col("place") / window).alias("w"))
    pairs = truth.join(F.broadcast(own), "probe").where("point != own")
    mine = pairs.join(at, "point").join(at.select("curve", F.col("point").alias("own"), F.col("w").alias("own_w")), ["curve", "own"])
    apart = mine.groupBy("probe", "point").agg(F.min(F.abs(F.col("w") - F.col("own_w"))).alias("d")).groupBy("d").agg(F.count("*").alias("n")).orderBy("d").collect()
    total, found = sum(r["n"] for r in apart), 0
    for r in apart:
        found += r["n"]
        if found >= wanted * total:
            return int(r["d"])
    return 0


def search(
    rows: DataFrame, asks, most: int = 20, wanted: float = 0.97, curves: int = CURVES, window: int = WINDOW, probes: int = PROBES, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (inner product): for each row whose id fulfils ``asks`` (a condition on the column id), its nearest other rows."""
    good = usable(rows, id_column, vector_column)
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # one row for each length that occurs
    for length in sorted(r["n"] for r in good.select(F.size("v").alias("n")).distinct().collect()):
        out = out.unionAll(search_length(good.where(F.size("v") == length), asks, most, wanted, curves, window, probes))
    return out


def search_length(good: DataFrame, asks, most: int, wanted: float, curves: int, window: int, probes: int) -> DataFrame:
    """:func:`search` among vectors of one length."""
    points = distinct_points(good, most)
    # queries are told by their own rows, as a point knows its smallest ids only
    points = kept_table(points.withColumn("point", F.xxhash64("v")), "curves-points")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b.id, "v": [(np.asarray(x, np.float64) + 0.0).tobytes() for x in b.v]})

    queries = good.where(F.col("id") != NO_ID).where(asks).mapInPandas(hashed, "id long, v binary")
    queries = kept_table(queries.select("id", F.xxhash64("v").alias("point")), "curves-queries")
    asking = queries.select("point").distinct().withColumn("asks", F.lit(True))
    points = points.join(asking, "point", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    points = kept_table(points, "curves-points")
    sample = points.orderBy(F.xxhash64("point", F.lit(1))).limit(SAMPLE).select("v").toPandas()
    places = kept_table(placed(points, Curves(vectors(sample.v), curves), curves), "curves-places")
    reach = reach_for(points, places, most, wanted, window, probes)
    indexed = places.join(points.drop("n"), "point").withColumn("w", F.floor(F.col("place") / window).cast("long"))
    near = F.explode(F.sequence(F.col("w") - reach, F.col("w") + reach))
    sides = indexed.select("curve", "w", "point", "v", "ids", F.lit(False).alias("query"))
    sides = sides.unionAll(indexed.where("asks").select("curve", near, "point", "v", "ids", F.lit(True)))
    found_type = "point long, of array<long>, ids array<long>, scores array<double>"
    columns = ["point", "of", "ids", "scores"]

    def in_window(table: pd.DataFrame) -> pd.DataFrame:
        base, asked = table[~table["query"]], table[table["query"]]
        if not len(base) or not len(asked):
            return pd.DataFrame([], columns=columns)
        x, ids, names, asking = vectors(base.v), base.ids.to_numpy(), base.point.to_numpy(), asked.point.to_numpy()
        first = np.array([i[0] for i in ids])
        longest = np.sqrt((x * x).sum(1).max())
        keep = min(most + 1, len(x))
        out = []
        for start in range(0, len(asked), ASKED):
            q = vectors(asked.v.iloc[start : start + ASKED])
            rough = q @ x.T
            for k, point in enumerate(asking[start : start + ASKED]):
                # all that can be among the nearest: the rough scores differ from the exact ones by rounding alone
                least = np.partition(rough[k], len(x) - keep)[len(x) - keep]
                top = np.flatnonzero(rough[k] >= least - 1e-9 * longest * np.sqrt(q[k] @ q[k]))
                exact = (x[top] * q[k]).sum(1)  # the same sum wherever the pair meets
                top, exact = (z[best(exact, first[top], most + 1)] for z in (top, exact))
                many = [len(ids[t]) for t in top]
                own, scores, of = np.concatenate([ids[t] for t in top]), np.repeat(exact, many), np.repeat(names[top], many)
                own_best = best(scores, own, most + 1)
                out.append((point, of[own_best], own[own_best], scores[own_best]))
        return pd.DataFrame(out, columns=columns)

    def merged(table: pd.DataFrame) -> pd.DataFrame:
        ids, scores, of = (np.concatenate(table[c].to_list()) for c in ("ids", "scores", "of"))
        # what several windows found counts once: of each point the ids that one window gave. The nearest of all are in every window's
        # list that has their point, so a list that was cut lacks none of them
        window_of = np.repeat(np.arange(len(table)), [len(x) for x in table.ids])
        order = np.lexsort((window_of, of))
        new = np.concatenate([[True], of[order][1:] != of[order][:-1]])
        chosen = np.zeros(len(of), bool)
        chosen[order] = window_of[order] == window_of[order][np.maximum.accumulate(np.where(new, np.arange(len(of)), 0))]
        ids, scores, of = ids[chosen], scores[chosen], of[chosen]
        top = best(scores, ids, most + 1)
        return pd.DataFrame({"point": [table.point.iloc[0]], "of": [of[top]], "ids": [ids[top]], "scores": [scores[top]]})

    found = sides.groupBy("curve", "w").applyInPandas(in_window, found_type).groupBy("point").applyInPandas(merged, found_type)
    pairs = queries.join(found, "point").select("id", "point", F.arrays_zip("of", "ids", "scores").alias("all"))
    # the query's own row, once
    own = F.array_position(F.transform("all", lambda x: (x["ids"] == F.col("id")) & (x["of"] == F.col("point"))), True)
    others = F.filter("all", lambda x, i: i + 1 != F.col("own"))
    ranked = pairs.withColumn("own", own).select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, most)).alias("pos", "x"))
    vec_id = F.when(F.col("x.ids") != NO_ID, F.col("x.ids"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), vec_id.alias("vec_id"), F.col("x.scores").alias("score"))
