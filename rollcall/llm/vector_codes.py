"""Compressed codes of vectors: each vector is cut into parts, and each part is named by the nearest entry of its position's codebook.

1. Components become integers floor(scale * x). Kept rows get a number of their own in a kept table.
2. The parts of each position are sorted along a Hilbert curve (Spark's range partitioning, the row's number last, so equal parts spread) and cut into flat blocks of at most BLOCK
   parts. A block stores its parts, the smallest and largest component of each place (its box) and the sums.
3. In each round a task bounds the distance of every entry to a block's box from below and above. Entries whose least distance exceeds the smallest of the largest distances cannot be
   nearest to any part of the block; the others are its shortlist. A shortlist of one takes the whole block by its stored sums. Else a small integer kernel compares the
   block's parts with the shortlist alone. Tasks send one sum per entry and place; the new codebooks are as large as the model, not the data.

All arithmetic is on integers, so codes, errors and codebooks are exact and do not depend on how rows are dealt out. Ties go to the lower entry.

Rules. Rows whose vector is null or holds null or non-finite components are dropped; an empty vector is kept: its parts are empty, all entries tie, and its code is all zeros. Vectors of
different lengths have codebooks of their own. Where the length is no multiple of the number of parts, earlier parts are one longer. With fewer kept rows than entries, the codebook has as many entries as rows. Null ids
come last among the smallest ids; rows of one id are told apart by their vectors. Repeated rows count each. Rows without a label share one label. An empty table gives an empty result.
Components beyond 2^62 after scaling, and errors or sums beyond 64 bits, are an
error, never a wrapped number. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import kept_table
from rollcall.llm.hilbert import hilbert_index

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Parts in a block.
BLOCK = 512
#: Places of a part that its curve follows at most, the widest first.
CURVE_PLACES = 12
#: Differences up to this size can be squared and added in 64 bits, for parts of up to 64 places.
SMALL = 1 << 28

Codebooks = list[np.ndarray]


def exact(values: np.ndarray) -> np.ndarray:
    """Whole numbers in 64 bits where squares of differences fit, as Python's integers else."""
    return values if not values.size or max(abs(int(values.min())), abs(int(values.max()))) < SMALL else values.astype(object)


def scaled(rows: DataFrame, scale: int, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """row (a number of its own), id, label, v (array of long): the kept rows."""
    x = F.transform(F.col(vector_column), lambda c: c.cast("double"))
    good = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), x.alias("x"))
    good = good.where(F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    large = F.exists("x", lambda c: F.abs(c) * scale >= 2.0**62)
    v = F.when(large, F.raise_error(F.lit("a component is too large to be coded"))).otherwise(F.transform("x", lambda c: F.floor(c * scale).cast("long")))
    return good.select(F.monotonically_increasing_id().alias("row"), "id", "label", v.alias("v"))


def edges_of(length: int, parts: int) -> list[int]:
    """Where the parts begin, and the end of the last."""
    return [0, *np.cumsum([length // parts + (p < length % parts) for p in range(parts)]).tolist()]


def stored(data: bytes, width: int) -> np.ndarray:
    """A block's parts; narrow numbers take four bytes each."""
    count, wide = int.from_bytes(data[:4], "little"), data[4]
    return np.frombuffer(data, "<i8" if wide else "<i4", offset=5).reshape(count, width).astype(np.int64)


def to_store(values: np.ndarray) -> bytes:
    wide = bool(values.size) and max(abs(int(values.min())), abs(int(values.max()))) >= 1 << 31
    return len(values).to_bytes(4, "little") + bytes([wide]) + values.astype("<i8" if wide else "<i4").tobytes()


def sorted_blocks(vectors: DataFrame, edges: list[int], block: int) -> DataFrame:
    """part, rows and data (binary), lo, hi, sums (array of long): flat blocks along the curve of each position."""
    length = edges[-1]

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                v = np.stack(b.v.to_list())
                yield pd.DataFrame({"place": np.arange(length), "lo": v.min(0), "hi": v.max(0)})

    # one row for each place
    found = vectors.select("v").mapInPandas(ranges, "place int, lo long, hi long").groupBy("place").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    ends = sorted(found.collect())
    lo, hi = (np.array([r[n] for r in ends], np.float64) for n in ("lo", "hi"))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            v = np.stack(b.v.to_list()).astype(np.int64).reshape(len(b), length)
            for p, (a, z) in enumerate(zip(edges, edges[1:])):
                wide = a + np.argsort(lo[a:z] - hi[a:z], kind="stable")[:CURVE_PLACES]
                key = np.zeros(len(b), np.int64)
                if len(wide):
                    bits = min(10, 62 // len(wide))
                    spans = np.maximum(hi[wide] - lo[wide], 1)
                    cells = np.clip((v[:, wide] - lo[wide]) / spans * ((1 << bits) - 1), 0, (1 << bits) - 1)
                    key = hilbert_index(cells, bits)
                yield pd.DataFrame({"part": p, "key": key, "row": b.row, "v": [x.tobytes() for x in np.ascontiguousarray(v[:, a:z])]})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            # a batch is sorted by part, so each part of it is one run
            for p, run in b.groupby("part"):
                width = edges[p + 1] - edges[p]
                values = np.frombuffer(b"".join(run.v), np.int64).reshape(len(run), width)
                rows, out = run.row.to_numpy(np.int64), []
                for i in range(0, len(run), block):
                    y = values[i : i + block]
                    out.append((p, rows[i : i + block].tobytes(), to_store(y), y.min(0), y.max(0), [int(s) for s in exact(y).sum(0)]))
                yield pd.DataFrame(out, columns=["part", "rows", "data", "lo", "hi", "sums"])

    keys = vectors.select("row", "v").mapInPandas(keyed, "part int, key long, row long, v binary")
    order = keys.repartitionByRange("part", "key", "row").sortWithinPartitions("part", "key", "row")
    return order.mapInPandas(cut, "part int, rows binary, data binary, lo array<long>, hi array<long>, sums array<long>")


def shortlist(lo: np.ndarray, hi: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entries, in rising order, that can be nearest to a part inside the box, equal distances included."""
    lo, hi, entries = exact(lo), exact(hi), exact(entries)
    if object in (lo.dtype, hi.dtype, entries.dtype):
        lo, hi, entries = (x.astype(object) for x in (lo, hi, entries))
    below, above = entries - lo, hi - entries
    outside = np.maximum(0, np.maximum(-below, -above))
    farthest = np.maximum(abs(below), abs(above))
    return np.flatnonzero((outside * outside).sum(1) <= (farthest * farthest).sum(1).min())


def nearest(values: np.ndarray, entries: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part, the nearest of the entries in ``among`` and the squared distance."""
    y, c = exact(values), exact(entries[among])
    if object in (y.dtype, c.dtype):
        y, c = y.astype(object), c.astype(object)
    away = np.stack([((y - e) ** 2).sum(1) for e in c], 1)
    best = away.argmin(1)
    return among[best], away[np.arange(len(y)), best]


def entry_sums(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """part, entry, place (-1: the count), total: what the parts assigned to each entry add up to."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], np.ndarray] = {}

        def add(part: int, entry: int, count: int, sums) -> None:
            row = np.array([count, *(int(s) for s in sums)], object)
            total[part, entry] = total[part, entry] + row if (part, entry) in total else row

        for b in batches:
            for part, data, lo, hi, sums in zip(b.part, b.data, b.lo, b.hi, b.sums):
                entries = books[part]
                among = shortlist(lo, hi, entries)
                if len(among) == 1:
                    add(part, int(among[0]), int.from_bytes(data[:4], "little"), sums)
                    continue
                y = stored(data, entries.shape[1])
                code, _ = nearest(y, entries, among)
                for k in np.unique(code):
                    mine = y[code == k]
                    add(part, int(k), len(mine), exact(mine).sum(0))
        rows = [(p, k, place - 1, int(x)) for (p, k), s in total.items() for place, x in enumerate(s)]
        yield pd.DataFrame(rows, columns=["part", "entry", "place", "total"])

    sums = blocks.select("part", "data", "lo", "hi", "sums").mapInPandas(summed, "part int, entry int, place int, total long")
    return sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))


def next_codebooks(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry becomes the floor of its parts' mean; unused entries stay. The driver sees one number per entry and place."""
    found = {(r["part"], r["entry"], r["place"]): r["total"] for r in entry_sums(blocks, books).collect()}
    new = [b.copy() for b in books]
    for (part, entry, place), total in found.items():
        if place >= 0:
            new[part][entry, place] = total // found[part, entry, -1]
    return new


def assigned(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """row, part, entry, error of every part."""

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, rows, data, lo, hi in zip(b.part, b.rows, b.data, b.lo, b.hi):
                entries = books[part]
                code, error = nearest(stored(data, entries.shape[1]), entries, shortlist(lo, hi, entries))
                yield pd.DataFrame({"row": np.frombuffer(rows, np.int64), "part": part, "entry": code, "error": [int(e) for e in error]})

    return blocks.select("part", "rows", "data", "lo", "hi").mapInPandas(coded, "row long, part int, entry int, error long")


def digest(books: Codebooks) -> str:
    """SHA-256 of all entries' components, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for e in b for x in e).encode()).hexdigest()


def coded(vectors: DataFrame, length: int, parts: int, entries: int, rounds: int, block: int) -> tuple[DataFrame, Codebooks]:
    """id, label, code, error and codebooks_sha256 of the vectors of one length (with row numbers, kept), and the codebooks."""
    edges = edges_of(length, parts)
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), length)
    books = [start[:, a:z] for a, z in zip(edges, edges[1:])]
    if not length:
        codes = vectors.select("row", F.repeat(F.lit("00"), parts).alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        blocks = kept_table(sorted_blocks(vectors, edges, block), "codes-blocks")
        for _ in range(rounds):
            books = next_codebooks(blocks, books)
        pieces = F.sort_array(F.collect_list(F.struct("part", "entry")))  # one for each part
        text = F.array_join(F.transform(pieces, lambda x: F.lpad(F.lower(F.hex(x["entry"])), 2, "0")), "")
        codes = assigned(blocks, books).groupBy("row").agg(text.alias("code"), F.sum("error").alias("error"))
    out = vectors.select("row", "id", "label").join(codes, "row").drop("row")
    return out.withColumn("codebooks_sha256", F.lit(digest(books))), books


def compress(
    rows: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    block: int = BLOCK,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """The id column, code (two hex digits for each part), error (squared distances over all parts), label_error (over rows of one label) and codebooks_sha256 of every kept row."""
    if entries > 256:
        raise ValueError("two hex digits name at most 256 entries")
    vectors = kept_table(scaled(rows, scale, id_column, vector_column, label_column), "codes-vectors")
    # one row for each length that occurs
    lengths = sorted(r["n"] for r in vectors.select(F.size("v").alias("n")).distinct().collect())
    schema = vectors.select("id", "label").schema.add("code", "string").add("error", "long").add("codebooks_sha256", "string")
    out = rows.sparkSession.createDataFrame([], schema)
    for n in lengths:
        out = out.unionAll(coded(vectors.where(F.size("v") == n), n, parts, entries, rounds, block)[0])
    out = kept_table(out, "codes-out")
    totals = out.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    out = out.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
    return out.select(F.col("id").alias(id_column), "code", "error", "label_error", "codebooks_sha256")
