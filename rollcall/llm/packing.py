"""Harmonic packing of token sequences.

The classes are the reciprocal capacities capacity/1, capacity/2, capacity/4, ...; a bin of class j holds exactly j pieces, so tasks fill the bins of a class
without looking at what others do. A document is cut into pieces of those very lengths, the longest first, so that full bins have no padding. The pieces
that do not fill a last bin of their class go to sequences whose lengths are powers of two.

Each row is a document of its own, also if its id is null or repeated; null and empty texts are documents of one id, the end mark; any length is
cut, none is dropped; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from rollcall.llm.common import NO_ID, Remembered, kept_table, named

CAPACITY = 4096
#: White space of the tokenizer, beside what str.split() takes: these it takes as well, but the tokenizer doesn't.
NOT_SPACE = re.compile("[\x1c-\x1f]")


#: What the tokenizer sees in the first 256 characters, which are also the bytes of a text of them alone.
SPACE, LETTER, DIGIT, SYMBOL = range(4)
KINDS = np.array([SPACE if c in " \t\n\x0b\x0c\r\x85\xa0" else LETTER if c.isalpha() else DIGIT if c.isnumeric() else SYMBOL for c in map(chr, range(256))], np.uint8)
LOWER = bytes(32 if kind == SPACE else ord(chr(b).lower()) for b, kind in enumerate(KINDS))
_of_kind = [re.escape(bytes(np.flatnonzero(KINDS == kind).tolist())) for kind in range(4)]
PARTS = re.compile(b"'s|'t|'re|'ve|'m|'ll|'d|[%b]+|[%b]|[%b]+" % tuple(_of_kind[1:]))


def little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def parts_of(raw: bytes) -> list[bytes]:
    """A text of the first 256 characters as the tokenizer takes it apart: runs of small letters and of symbols, and single digits."""
    raw = raw.translate(LOWER)
    if b"'" in raw:  # some letters belong to the mark before them
        return PARTS.findall(raw)
    codes = np.frombuffer(raw, np.uint8)
    kinds = KINDS[codes]
    return np.insert(codes, np.flatnonzero((kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)) + 1, 32).tobytes().split()


class WordIds(Remembered):
    """The ids of the parts of a text, as bytes (little-endian, 32 bits), by one tokenizer: parts as the tokenizer makes them (bytes), or what is between white space."""

    limit = 64 << 20  # finding ids costs more than the place they take

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # byte-level vocabularies show these bytes as they are
        hidden = iter(range(256, 512))
        self.letters = {b: chr(b if b in shown else next(hidden)) for b in range(256)}
        probes = ("alphabet", "fenêtre", "zwölf", "señor")
        self.direct = all(self.of_letters(w) == self.encoded(w) for w in probes)
        near = [f"a{c}B1{c}2.{c}-{c}{c} {c} we{c}re '{c} {c}'S" for c in map(chr, range(256))]
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]  # found in a text before it is taken apart
        self.apart = self.direct and not any(t.normalized for t in added) and all(b"".join(map(self.__missing__, parts_of(t.encode("latin-1")))) == self.encoded(t) for t in near)
        self.forget()

    def encoded(self, text: str) -> bytes:
        return little_endian(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of_letters(self, word: str) -> bytes:
        """A word of small letters is one piece, so the model alone gives its ids."""
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return little_endian([t.id for t in self.model.tokenize(shown)])

    def __missing__(self, word: str | bytes) -> bytes:
        if isinstance(word, bytes):
            own = word.decode("latin-1")
            ids = self.of_letters(own) if own.isalpha() else self.encoded(own)
        elif word[-1] in ".," and word[:-1].isalpha():  # letters and marks are apart for the tokenizer
            ids = self[word[:-1]] + self[word[-1]]
        elif max(word) <= "ÿ" and word != (lower := word.lower()):  # it lowers letters itself
            ids = self[lower]
        elif self.direct and max(word) <= "ÿ" and word.isalpha():
            ids = self.of_letters(word)
        else:
            ids = self.encoded(word)
        return self.keep(word, ids)

    def of(self, text: str) -> bytes:
        if self.apart and not any(t in text for t in self.added):
            try:
                return b"".join(map(self.__getitem__, parts_of(text.encode("latin-1"))))
            except UnicodeEncodeError:  # other characters, too
                pass
        if NOT_SPACE.search(text) or any(t in text.lower() for t in self.added):  # words are lowered below
            return self.encoded(text)
        return b"".join(map(self.__getitem__, text.split()))


_by_path: dict[str, WordIds] = {}


def word_ids(path: str) -> Callable[[str], bytes]:
    """A function from text to ids, made once in each worker; for tokenizers that lower letters and drop white space."""
    if path not in _by_path:
        _by_path[path] = WordIds(path)
    return _by_path[path].of


def cuts(length: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces: whole capacities, then falling powers of two (``capacity`` is one)."""
    whole, rest = divmod(length, capacity)
    return [capacity] * whole + [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, no_id, start, length, ids_crc32, doc_tokens per piece."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, end = word_ids(tokenizer_path), np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out = []
            for doc, no_id, text in zip(batch.id, batch.no_id, batch.text):
                ids = ids_of(text) + end
                total, start = len(ids) // 4, 0
                for length in cuts(total, capacity):
                    out.append((doc, no_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total))
                    start += length
            yield pd.DataFrame(out, columns=["id", "no_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), F.col(id_column).isNull().alias("no_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    return rows.mapInPandas(run, "id long, no_id boolean, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece.

    Pieces are numbered within (class, share of the table); the counts of those shares, one row each, give every share its place in the
    class, so that no class is ordered as a whole.
    """
    spark = docs.sparkSession
    parts = kept_table(pieces(docs, tokenizer_path, end_id, capacity, id_column, text_column), "packing-pieces")
    shares = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    parts = parts.withColumn("share", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(shares)))
    # one row for each class and share
    counts = parts.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = counts.withColumn("all", F.sum("n").over(Window.partitionBy("length")))
    # a class's full bins, then its rest in sequences of falling powers of two; where the classes' numbers begin follows from 13 sums
    totals = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    first, base = {}, 0
    for length in sorted(totals, reverse=True):
        first[length] = base
        bins, rest = divmod(totals[length], capacity // length)
        base += bins + bin(rest).count("1")
    within = Window.partitionBy("length", "share").orderBy("id", "no_id", "start", "ids_crc32", "doc_tokens")
    ranked = parts.withColumn("nth", F.row_number().over(within) - 1).join(counts.drop("n"), ["length", "share"])
    each = F.expr(f"{capacity} div length")
    rank = F.col("before") + F.col("nth")
    full = F.expr("all div each") * F.col("each")
    ranked = ranked.withColumns({"each": each, "rank": rank}).withColumn("full", full)
    # the place p in the rest r lies in the run of the highest bit at which p and r differ (p < r): bits of r above it are complete runs
    p, r = F.col("rank") - F.col("full"), F.col("all") - F.col("full")
    ranked = ranked.withColumns({"p": p, "r": r})
    bit = F.length(F.bin(F.col("p").bitwiseXOR(F.col("r")))) - 1
    ranked = ranked.withColumn("bit", F.when(F.col("rank") >= F.col("full"), bit).otherwise(0))
    above = F.expr("shiftleft(shiftright(r, bit + 1), bit + 1)")
    base_of = F.element_at(F.create_map(*[x for k, v in first.items() for x in (F.lit(k).cast("long"), F.lit(v).cast("long"))]), F.col("length")) if first else F.lit(0)
    in_rest = F.col("rank") >= F.col("full")
    sequence = base_of + F.when(in_rest, F.expr("all div each + bit_count(shiftright(r, bit + 1))")).otherwise(F.expr("rank div each"))
    offset = F.col("length") * F.when(in_rest, F.col("p") - above).otherwise(F.expr("rank % each"))
    out = ranked.select("id", "no_id", "start", "length", "ids_crc32", "doc_tokens", sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))
    return named(out, id_column)
