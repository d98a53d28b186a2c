"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct shingles of ``words`` words. Two documents link when den * intersection >= num * union.

1. Equal sets are one point, whatever the number of their documents.
2. Points meet in cells: a pair that links differs in at most s shingles (s follows from the sizes), so of m > s parts that shingles are hashed to, one at least is the
   same in both. A point has one cell for each part that is not empty. m leaves room for parts that are empty in both; a point with more empty parts than
   that also has cells for them. So no linked pair is missed, and points that share a passage only do not meet.
3. In a cell, group counts are points of an R-tree; larger sets have more groups, so that long texts do not pass the bound by chance. Boxes and points whose summed coordinate minima cannot reach the overlap are passed over, and so are leaves whose points are
   of one class already; what survives ties points into clusters.
4. Each point goes to its cluster once, with its shingles; a cluster of any size is dealt out in chunks. A chunk has an R-tree again, and surviving pairs are verified, but for points
   of one class. So a chunk of linked copies takes about as many checks as copies.
5. In clusters of several chunks, one point of each class meets the others, and what is then outside the largest class is compared with the chunks that hold a point of another class in one of its
   cells. Links become components in Spark.

Documents without words are linked with nothing. Null ids count as larger than all others; rows of one id are told apart by their sets. Texts of any length are read whole. An
empty table gives an empty result. Other columns are not read. Shingles are compared by 64-bit hashes, and so are sets that look for others; equal sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import NO_ID, blocks, from_planes, identified, kept_table, mix, named, to_planes, total_bytes, window_hashes, word_values
from rollcall.llm.graph import components
from rollcall.llm.rtree import GROUPS, MATRIX, Sets, Tree, count_vector, groups_of, join, packed_counts, packed_groups, unpacked_counts
from rollcall.llm.substring import at_runs, by_key, lengths

#: Bytes of text whose cells make up a share, and the bytes of a cell that are sent (chance agreement adds pairs that the bound or the check drops).
SHARE_BYTES, SENT = 24 << 20, 5
#: Shingles in a chunk of a cluster.
CHUNK = 1_000_000


def shingle_sets(texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after another, and where each begins."""
    values, starts = word_values(texts, lower=True)
    h = window_hashes(values, words)
    sets = []
    for a, b in zip(starts, starts[1:]):
        if b - a >= words:
            own = np.sort(h[a : b - words + 1])
            own = own[at_runs(own)]
        elif b > a:  # the whole sequence is the only shingle; its length tells it from others
            own = np.array([xxhash.xxh3_64_intdigest(values[a:b].tobytes(), seed=int(b - a))], np.uint64)
        else:
            own = h[:0]
        sets.append(own)
    return np.concatenate([h[:0], *sets]), np.cumsum([0, *map(len, sets)])


class Units:
    """Ranges of sizes; the two documents of any linked pair lie in one of them."""

    def __init__(self, num: int, den: int, most: int) -> None:
        self.low, self.high, self.parts, self.spare = [], [], [], []
        low = 1
        while low <= most:
            after = max(low + 1, -(-low * 4 // 3))
            high = (after - 1) * den // num
            differ = (after - 1 + high) * (den - num) // (den + num)
            spare = -(-(differ + 1) // 10) + 3
            self.low.append(low)
            self.high.append(high)
            self.parts.append(differ + 1 + spare if differ else 0)  # sets that may not differ are one point
            self.spare.append(spare)
            low = after
        self.low, self.high, self.parts, self.spare = map(np.array, (self.low, self.high, self.parts, self.spare))


def cells_of(h: np.ndarray, begin: np.ndarray, units: Units) -> list[np.ndarray]:
    """The cells of each set: hashes of (unit, part, shingles in the part)."""
    sizes = np.diff(begin)
    out: list[list[np.ndarray]] = [[] for _ in sizes]
    last = np.searchsorted(units.low, sizes, side="right") - 1
    for back in range(0, 8):  # a size lies in its own unit and in those below whose range reaches it
        unit = last - back
        sure = np.maximum(unit, 0)
        mine = np.flatnonzero((sizes > 0) & (unit >= 0) & (units.high[sure] >= sizes) & (units.parts[sure] > 0)) if len(units.low) else []
        if not len(mine):
            continue
        m = units.parts[unit[mine]]
        base = np.concatenate([[0], np.cumsum(m)])
        lengths = sizes[mine]
        which = np.repeat(np.arange(len(mine)), lengths)
        x = np.concatenate([h[begin[d] : begin[d + 1]] for d in mine])
        slot = base[which] + ((x >> np.uint64(20)) % m[which].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(base[-1], np.uint64)
        np.add.at(sums, slot, mix(x ^ np.uint64(0xA24BAED4963EE407)))
        n = np.bincount(slot, minlength=base[-1])
        part = np.arange(base[-1]) - np.repeat(base[:-1], m)
        name = np.repeat(unit[mine], m).astype(np.uint64) << np.uint64(32) | part.astype(np.uint64)
        keys = mix(sums + mix(name + np.uint64(1))).view(np.int64)
        for k, d in enumerate(mine):
            a, b = base[k], base[k + 1]
            full = n[a:b] > 0
            all_of_them = (b - a) - full.sum() > units.spare[unit[d]]
            out[d].append(keys[a:b] if all_of_them else keys[a:b][full])
    return [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]


POINT = {"id": "long", "no_id": "boolean", "tk": "long", "n": "long", "node": "binary", "counts": "binary", "x": "long"}
MESSAGE = {"share": "long", "count": "long", "cells": "binary", "points": "binary", "runs": "binary"}


def points_and_cells(rows: DataFrame, words: int, num: int, den: int, shares: int) -> DataFrame:
    """One reading of the texts gives both kinds of rows: a point for each text, and the cells of a block for each share (the columns of the other kind are null).

    Points: id, no_id, tk, n, node (digest of the set; null without words), its first half x, counts. A block sends the cells of equal sets once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, limit=2 << 20):
            h, begin = shingle_sets(block.text, words)
            sizes = np.diff(begin)
            units = Units(num, den, int(sizes.max()))
            nodes = [xxhash.xxh3_128_digest(h[a:b].tobytes()) if b > a else None for a, b in zip(begin, begin[1:])]
            cells = cells_of(h, begin, units)
            seen: set = set()
            for k, node in enumerate(nodes):
                if node in seen:
                    cells[k] = cells[k][:0]
                seen.add(node)
            halves = np.frombuffer(b"".join(x or bytes(16) for x in nodes), "<i8").reshape(-1, 2)
            own = {"id": block.id, "no_id": block.no_id, "tk": block.tk, "n": sizes, "node": nodes, "x": halves[:, 0]}
            own["counts"] = [packed_counts(count_vector(h[a:b], groups_of(b - a))) if len(c) else None for a, b, c in zip(begin, begin[1:], cells)]
            yield pd.DataFrame({c: own.get(c, [None] * len(block)) for c in [*POINT, *MESSAGE]})
            with_cells = [k for k, c in enumerate(cells) if len(c)]
            if with_cells:
                sent = sent_cells(pd.DataFrame({"cells": [cells[k] for k in with_cells], "x": halves[with_cells, 0]}), shares)
                yield pd.DataFrame({c: sent.get(c, [None] * len(sent)) for c in [*POINT, *MESSAGE]})

    return rows.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in {**POINT, **MESSAGE}.items()))


def sent_cells(points: pd.DataFrame, shares: int) -> pd.DataFrame:
    """Per share of the cells: the points' cells, SENT bytes of each, points as runs."""
    counts = points.cells.str.len().to_numpy()
    cell = np.concatenate(points.cells.to_list()).view(np.uint64)
    x = np.repeat(points.x.to_numpy(), counts)
    share = (mix(cell) % np.uint64(shares)).astype(np.int64)
    turn = by_key(share, shares)
    cell, x, share = cell[turn], x[turn], share[turn]
    begin = at_runs(share)
    rows = []
    for a, n in zip(begin, lengths(begin, len(share))):
        own = x[a : a + n]
        runs = at_runs(own)
        rows.append((int(share[a]), n, to_planes(cell[a : a + n] >> np.uint64(64 - 8 * SENT), SENT), own[runs].tobytes(), to_planes(lengths(runs, n), 4)))
    return pd.DataFrame(rows, columns=["share", "count", "cells", "points", "runs"])


def shared_cells(messages: pd.DataFrame) -> pd.DataFrame:
    """Of one share: the cells that two points or more have, with their points. A cell is named by its points: cells of the same points say the same and are kept once."""
    cell = np.concatenate([from_planes(r.cells, r.count, SENT) for r in messages.itertuples(index=False)])
    x = np.concatenate([np.repeat(np.frombuffer(r.points, np.int64), from_planes(r.runs, len(r.points) // 8, 4).astype(np.int64)) for r in messages.itertuples(index=False)])
    order = np.lexsort((x, cell))
    cell, x = cell[order], x[order]
    begin = at_runs(cell, x)  # each point once
    cell, x = cell[begin], x[begin]
    n = lengths(at_runs(cell), len(cell))
    x, n = x[np.repeat(n > 1, n)], n[n > 1]
    if not len(n):
        return pd.DataFrame({"cell": x[:0], "x": x[:0]})
    name = mix(np.add.reduceat(mix(x.view(np.uint64)), np.cumsum(n) - n) + n.astype(np.uint64))
    once = np.zeros(len(n), bool)
    once[np.unique(name, return_index=True)[1]] = True
    once = np.repeat(once, n)
    return pd.DataFrame({"cell": np.repeat(name, n)[once].view(np.int64), "x": x[once]})


def stars(x: np.ndarray, pairs: list[tuple[int, int]]) -> set[tuple[int, int]]:
    """What the pairs of places connect, as pairs with the smallest point of each group: many cells of the same points then say the same."""
    head = list(range(len(x)))

    def top(i: int) -> int:
        while head[i] != i:
            head[i] = head[head[i]]
            i = head[i]
        return i

    for i, j in pairs:
        a, b = top(i), top(j)
        if x[a] > x[b]:
            a, b = b, a
        head[b] = a
    touched = {i for pair in pairs for i in pair}
    return {(int(x[top(i)]), int(x[i])) for i in touched if top(i) != i}


def near_points(num: int, den: int):
    """Of one bucket of cells (cell, x, n, counts): pairs a-b of points that the bound allows, as a forest of each cell."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cell", kind="stable")
        cell, x, sizes, counts = rows.cell.to_numpy(), rows.x.to_numpy(), rows.n.to_numpy(), rows.counts.to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, int)
        n = np.diff([*begin, len(cell)])
        groups = np.minimum.reduceat(packed_groups(counts), begin) if len(cell) else n  # a cell's vectors are folded to the coarsest
        out: set[tuple[int, int]] = set()
        for g in np.unique(groups[n == 2]):
            two = begin[(n == 2) & (groups == g)]
            for part in np.array_split(two, max(1, len(two) * g // (20_000 * GROUPS))):  # most cells
                overlap = np.minimum(unpacked_counts(counts[part], g), unpacked_counts(counts[part + 1], g)).sum(1, dtype=np.int64)
                hit = part[overlap * (num + den) >= num * (sizes[part] + sizes[part + 1])]
                out.update(zip(np.minimum(x[hit], x[hit + 1]).tolist(), np.maximum(x[hit], x[hit + 1]).tolist()))
        for a, size, g in zip(begin[n > 2], n[n > 2], groups[n > 2]):
            while g > GROUPS and g * size > MATRIX:
                g //= 2
            data = Sets(sizes[a : a + size], unpacked_counts(counts[a : a + size], g), np.arange(size), num, den)
            tree = Tree(data, np.arange(size))
            out.update(stars(x[a : a + size], list(join(data, tree, tree))))
        return pd.DataFrame(sorted(out), columns=["a", "b"], dtype=np.int64)

    return run


def chunk_links(num: int, den: int):
    """Links within one chunk (side 0), or between a chunk and what comes to it (side 1); ``class`` numbers what is linked already."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        classes = rows["class"].map(lambda x: x if x is not None else b"").to_numpy()
        first: dict = {}
        number = np.array([first.setdefault(c, i) if c else i for i, c in enumerate(classes)])
        sets = [np.frombuffer(s, np.uint64) for s in rows.shingles]
        sizes = np.array([len(x) for x in sets])
        groups = groups_of(int(sizes.mean()))
        data = Sets(sizes, np.stack([count_vector(x, groups) for x in sets]), number, num, den, sets)
        side = rows.side.to_numpy()
        right = Tree(data, np.flatnonzero(side == 0)) if (side == 0).any() else None
        left = Tree(data, np.flatnonzero(side == 1)) if (side == 1).any() else right
        links = list(join(data, left, right)) if right is not None else []
        nodes = rows.node.to_numpy()
        return pd.DataFrame([(nodes[i], nodes[j]) for i, j in links], columns=["a", "b"])

    return run


def cluster_links(members: DataFrame, cells: DataFrame, num: int, den: int, chunk: int) -> DataFrame:
    """Links a-b that connect what is linked, for members (cluster, node, n, shingles) and their cells (cell, node)."""
    link = chunk_links(num, den)
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def by_chunk(rows: DataFrame) -> DataFrame:
        # else the partitioning of a join by cluster serves for the groups, and all chunks of a cluster are in one task
        return rows.repartition(tasks, "cluster", "chunk").groupBy("cluster", "chunk").applyInPandas(link, "a binary, b binary")

    total = members.groupBy("cluster").agg(F.sum("n").alias("total"))
    dealt = members.join(total, "cluster").withColumn("chunks", F.ceil(F.col("total") / chunk).cast("long"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    nothing = F.lit(None).cast("binary")
    parts = dealt.withColumn("side", F.lit(0)).withColumn("class", nothing)
    found = kept_table(by_chunk(parts), "join-links")
    wide = kept_table(dealt.where("chunks > 1").select("cluster", "node", "n", "chunk"), "join-wide")
    if wide.isEmpty():
        return found
    # clusters of several chunks: first one point of each class, then what is outside the largest class
    payload = members.select("cluster", "node", "shingles")
    heads = classes_of(wide, found).groupBy("cluster", "class").agg(F.min("node").alias("node"), F.min_by("n", "node").alias("n"))
    sums = heads.groupBy("cluster").agg(F.sum("n").alias("total"), F.count("*").alias("left")).where("left > 1")
    heads = heads.join(sums, "cluster").withColumn("chunks", F.ceil(F.col("total") / chunk).cast("long"))
    heads = heads.withColumn("chunk", F.pmod(F.xxhash64("node", "total"), F.col("chunks")))
    more = heads.join(payload, ["cluster", "node"]).withColumn("side", F.lit(0)).withColumn("class", nothing)
    found = kept_table(found.unionAll(by_chunk(more)), "join-links")
    classed = kept_table(classes_of(wide, found), "join-classes")
    sizes = classed.groupBy("cluster", "class").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("cluster").agg(F.max_by("class", F.struct("size", "class")).alias("largest"), F.count("*").alias("left")).where("left > 1").drop("left")
    classed = kept_table(classed.join(largest, "cluster"), "join-classed")
    # linked points share a cell, so a point goes only to chunks in which one of its cells has a point of another class
    in_cells = classed.select("cluster", "node", "chunk", "class", "largest").join(cells, "node")
    chunks = in_cells.groupBy("cluster", "cell", "chunk").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    asked = in_cells.where(F.col("class") != F.col("largest")).drop("chunk", "largest").join(chunks, ["cluster", "cell"])
    asked = asked.where("low != class or high != class").select("cluster", "node", "chunk").distinct()
    outside = classed.where(F.col("class") != F.col("largest")).drop("chunk").join(asked, ["cluster", "node"]).withColumn("side", F.lit(1))
    both = outside.unionByName(classed.withColumn("side", F.lit(0))).join(payload, ["cluster", "node"])
    return kept_table(found.unionAll(by_chunk(both)), "join-links")


def classes_of(wide: DataFrame, links: DataFrame) -> DataFrame:
    named_classes = components(links).withColumnRenamed("node", "m")
    return wide.join(named_classes, F.col("node") == F.col("m"), "left").select("cluster", "node", "n", "chunk", F.coalesce("component", "node").alias("class"))


def similar(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id", text_column: str = "text", chunk: int = CHUNK) -> DataFrame:
    """doc_id, tk, n_shingles, component_id (the smallest doc_id reachable by links, itself included) per row."""
    found = classed_rows(docs, words, num, den, id_column, text_column, chunk)
    return named(found.drop("class"), id_column)


def classed_rows(docs: DataFrame, words: int, num: int, den: int, id_column: str, text_column: str, chunk: int = CHUNK) -> DataFrame:
    """id, no_id, tk, n_shingles, component_id, class per row; ``class`` is the component itself (the smallest digest of its sets, null without words)."""
    rows = identified(docs, id_column, text_column)
    shares = max(1, total_bytes(rows, "text") // SHARE_BYTES)
    both = kept_table(points_and_cells(rows, words, num, den, shares), "join-points")
    base = both.where("share is null").select(*POINT)
    nodes = base.where("node is not null").groupBy("node").agg(F.min(F.struct("id", "tk")).alias("first"), F.min("n").alias("n"), F.min("x").alias("x"))
    meet = both.where("share is not null").select(*MESSAGE).groupBy("share").applyInPandas(shared_cells, "cell long, x long")
    vectors = base.where("counts is not null").groupBy("x").agg(F.min_by("counts", "node").alias("counts"), F.min_by("n", "node").alias("n"))
    buckets = max(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), shares)
    # shares agree on the names, so most cells of a pair fall together before the vectors come to them
    meet = kept_table(meet.repartition(F.col("x")).dropDuplicates(["cell", "x"]), "join-cells")
    known = meet.join(vectors, "x").withColumn("bucket", F.pmod(F.xxhash64("cell"), F.lit(buckets)))
    near = known.groupBy("bucket").applyInPandas(near_points(num, den), "a long, b long")
    clusters = kept_table(components(near).select(F.col("node").alias("x"), "component"), "join-clusters")

    def with_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, limit=2 << 20):
            h, begin = shingle_sets(block.text, words)
            own = [h[a:b].tobytes() for a, b in zip(begin, begin[1:])]
            yield pd.DataFrame({"cluster": block.cluster, "node": block.node, "n": np.diff(begin), "shingles": own})

    wanted = clusters.join(nodes, "x").select(F.col("component").alias("cluster"), "node", F.col("first.id").alias("id"), F.col("first.tk").alias("tk"))
    texts = rows.select("id", "tk", "text").join(wanted, ["id", "tk"]).select("cluster", "node", "text")
    members = texts.mapInPandas(with_shingles, "cluster long, node binary, n long, shingles binary").dropDuplicates(["node"])
    cells = meet.join(clusters.join(nodes.select("x", "node"), "x").select("x", "node"), "x").select("cell", "node")
    links = cluster_links(kept_table(members, "join-members"), cells, num, den, chunk)
    joined = components(links).select(F.col("node").alias("m"), "component")
    classed = nodes.join(joined, F.col("node") == F.col("m"), "left").select("node", F.coalesce("component", "node").alias("class"), F.col("first.id").alias("id"))
    least = classed.groupBy("class").agg(F.min("id").alias("least"))
    by_node = classed.join(least, "class").select(F.col("node").alias("m"), "class", "least")
    out = base.join(by_node, F.col("node") == F.col("m"), "left")
    least_id = F.coalesce("least", "id")
    return out.select("id", "no_id", "tk", F.col("n").alias("n_shingles"), F.when(least_id != NO_ID, least_id).alias("component_id"), "class")


def one_of_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies, all columns as they are: of each component the row with the smallest id stays, and all rows without words."""
    found = classed_rows(docs, words, num, den, id_column, text_column)
    # of a component one text, also where several texts have its smallest id
    first = found.where("n_shingles > 0").groupBy("class").agg(F.min(F.struct("id", "tk")).alias("first")).select("first.*", F.lit(False).alias("wordless"))
    kept = first.unionAll(found.where("n_shingles = 0").select("id", "tk", F.lit(True)).distinct())
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = own.withColumns({"id": F.coalesce(F.col(f"row.`{id_column}`").cast("long"), F.lit(NO_ID)), "tk": F.xxhash64(F.coalesce(F.col(f"row.`{text_column}`"), F.lit("")))})
    joined = own.join(kept, ["id", "tk"])
    # of repeated rows one, too, whatever the order they come in: the one with the smallest digest of its other columns
    others = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in (id_column, text_column)]
    digest = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    one = joined.where("not wordless").groupBy("id", "tk").agg(F.min_by("row", digest).alias("row"))
    return one.select("row.*").unionAll(joined.where("wordless").select("row.*"))
