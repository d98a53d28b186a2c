"""Helpers of the operators: words, hashes of words, blocks of rows, and tables kept in the shared folder."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.session import fresh_path

#: Blocks of texts that a task works on at once, in bytes.
BLOCK_BYTES = 4 << 20
#: Bytes, about, that each memory of a worker may take.
REMEMBERED_BYTES = 32 << 20
#: Bytes, about, of the rows that are sent to a worker at once: two blocks of the operators that work on 2 MB.
BATCH_BYTES = 4 << 20
SENT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Stands for a null id: it is smaller than no other id.
NO_ID = (1 << 63) - 1


#: Lets Spark free the shuffle files of a statement at its end.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> SparkSession:
    """Rows go to Python in batches of BATCH_BYTES, whatever the length of their texts (else 10,000 rows): executors and workers each hold copies of a batch."""
    spark.conf.set(SENT_BYTES, str(BATCH_BYTES))
    return spark


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: later steps survive lost executors and do not repeat it.

    The shuffle files behind it are freed once it is written, so the steps of an operator do not add up on the executors' disks.
    """
    return kept_at(df, fresh_path(df.sparkSession, name))


def kept_at(df: DataFrame, path: str, **options: str) -> DataFrame:
    """:func:`kept_table` at a path, with options of the Parquet writer."""
    spark = df.sparkSession
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a table that :func:`kept_at` wrote, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of all texts of a column."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def identified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id (a null id is the largest number and has no_id set), text as bytes (null: empty), and tk, a hash of the text that tells rows of one id apart."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(id_column).isNull().alias("no_id"),
        text.cast("binary").alias("text"),
        F.xxhash64(text).alias("tk"),
    )


def named(df: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``df`` with its id and no_id turned back into the column they came from, in front."""
    others = [c for c in df.columns if c not in ("id", "no_id")]
    return df.select(F.when(~F.col("no_id"), F.col("id")).alias(id_column), *others)


class Remembered(dict):
    """What was found for frequent keys; it is emptied when it has grown to about ``limit`` bytes, by ``forget``, and when another memory grows.

    So a worker that serves one operator after another holds the memory of one of them only.
    """

    held, limit = 0, REMEMBERED_BYTES
    grown: Callable[[], Remembered | None] = staticmethod(lambda: None)

    def keep(self, key, value):
        if (other := Remembered.grown()) is not self:
            if other is not None:
                other.forget()
            Remembered.grown = weakref.ref(self)  # a memory ends with its owner
        if self.held >= self.limit:
            self.forget()
        self.held += 200 + len(key)  # a key, a value and their place
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.held = 0


class WordValues(Remembered):
    """Word to a 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        return self.keep(word, xxhash.xxh3_64_intdigest(word))


_values = WordValues()


def word_values(texts: Iterable[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts one after another, and where each text begins (one more entry than texts).

    Words are runs of bytes other than space and 0x09 to 0x0D, which is what bytes.split() takes.
    """
    counts, parts = [0], []
    for text in texts:
        words = (text.lower() if lower else text).split()
        counts.append(len(words))
        parts.append(np.fromiter(map(_values.__getitem__, words), np.uint64, len(words)))
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return values, np.cumsum(counts)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd multipliers of the polynomial hashes.
BASE, BASE_2 = 0x9E3779B97F4A7C55, 0xD1342543DE82EF95


def window_hashes(values: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Rabin-Karp hash (modulo 2^64) of every run of ``width`` values, by Horner's rule over the whole array."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, b = values[:n].copy(), np.uint64(base)
    for j in range(1, width):
        h *= b
        h += values[j : j + n]
    return mix(h)


def inside(starts: np.ndarray, width: int) -> np.ndarray:
    """For each window over the joined texts: whether it lies in one text."""
    total = int(starts[-1])
    ok = np.ones(max(0, total - width + 1), bool)
    for end in starts[1:-1]:
        ok[max(0, end - width + 1) : end] = False
    return ok


def spread(starts: np.ndarray) -> np.ndarray:
    """The number of the text that each value of the joined texts belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def blocks(batches: Iterator[pd.DataFrame], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pd.DataFrame]:
    """Cuts the batches into blocks of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        sizes = batch[column].str.len().to_numpy()
        cut = np.cumsum(sizes) // limit if len(batch) else sizes
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1), len(batch)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.iloc[a:b].reset_index(drop=True)


def to_planes(values: np.ndarray, width: int) -> bytes:
    """Unsigned values, byte by byte: all lowest bytes, then the next. Sorted values leave their high planes nearly constant."""
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    return raw[:, :width].T.tobytes()


def from_planes(data: bytes, count: int, width: int) -> np.ndarray:
    raw = np.zeros((count, 8), np.uint8)
    raw[:, :width] = np.frombuffer(data, np.uint8).reshape(width, count).T
    return raw.reshape(-1).view("<u8")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
