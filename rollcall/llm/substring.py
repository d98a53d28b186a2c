"""Substring dedup: Rabin-Karp hashes of every window of WIDTH words, counted in Spark; repeated windows merge into removal intervals.

A word goes if a window that covers it also starts in a document with a smaller id; windows are judged on the input.

1. Each task hashes all windows of a block of documents and sends, for each hash, the occurrences in the block's first document that has it; the
   block's other documents with that window know their answer already, so a window that a third of all documents share is sent once per block.
2. Hashes are dealt out by a second, independent hash. Each share finds the smallest id of every hash and answers the occurrences that lie in
   documents with a larger id. The number of shares follows the bytes of text, so a share stays at about SHARE_BYTES.
3. Answers are gathered by groups of documents, where windows merge into maximal intervals, and meet their document by id.

Windows are compared by 64 bits of one polynomial within shares of another, that is by more bits the more text there is: chance agreement is expected
for about 2e-7 windows per share.

Null ids count as larger than all others; rows of one id are not compared with each other, and rows of one id with different texts are told
apart by 64-bit hashes of the texts. Null, empty and
short texts (under WIDTH words) have no window and are kept. Texts of any length are read whole. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import BASE_2, blocks, from_planes, identified, inside, mix, named, spread, to_planes, total_bytes, window_hashes, word_values

WIDTH = 13
SHARE_BYTES = 16 << 20

#: Occurrences in rows: what to_message packs, for a share of the hashes (count > 0) or for a group of documents (known: no hashes).
MESSAGE = "share long, group long, count long, hashes binary, steps binary, ids binary, tks binary, runs binary"
COLUMNS = ["share", "group", "count", "hashes", "steps", "ids", "tks", "runs"]


def at_runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def lengths(begin: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(begin, n))


def to_message(share: int, group: int, ids: np.ndarray, tks: np.ndarray, positions: np.ndarray, hashes: bytes = b"") -> tuple:
    """Occurrences ordered by row and position: rows as runs, positions as steps within a run."""
    runs = at_runs(ids, tks)
    steps = np.diff(positions, prepend=0)
    steps[runs] = positions[runs]
    n = len(ids)
    steps_of_ids = np.diff(ids[runs].astype(np.uint64), prepend=np.uint64(0))
    return (share, group, n, hashes, to_planes(steps, 4), to_planes(steps_of_ids, 8), tks[runs].astype("<i8").tobytes(), to_planes(lengths(runs, n), 4))


def from_message(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, tks and positions of a message."""
    n = len(r.tks) // 8
    runs = from_planes(r.runs, n, 4).astype(np.int64)
    ids = np.cumsum(from_planes(r.ids, n, 8)).astype(np.int64)
    total = np.cumsum(from_planes(r.steps, r.count, 4).astype(np.int64))
    before = np.concatenate([[0], total[np.cumsum(runs)[:-1] - 1]]) if n else total
    return np.repeat(ids, runs), np.repeat(np.frombuffer(r.tks, "<i8"), runs), total - np.repeat(before, runs)


def by_key(keys: np.ndarray, among: int) -> np.ndarray:
    """A stable order by small keys."""
    return np.argsort(keys.astype(np.uint16) if among < 1 << 16 else keys, kind="stable")


def answers(ids: np.ndarray, tks: np.ndarray, positions: np.ndarray, groups: int) -> Iterator[tuple]:
    """Messages with the occurrences, one per group of documents; the input is ordered by row and position."""
    group = (mix(ids.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
    order = by_key(group, groups)
    begin = at_runs(group[order])
    for a, n in zip(begin, lengths(begin, len(order))):
        k = order[a : a + n]
        yield to_message(-1, int(group[k[0]]), ids[k], tks[k], positions[k])


def sent(block: pd.DataFrame, width: int, shares: int, groups: int) -> pd.DataFrame:
    """The messages of one block: per share the windows of the first document that has them, and the answers already known."""
    block = block.sort_values(["id", "tk"], kind="stable")
    values, starts = word_values(block.text)
    ids, tks = block.id.to_numpy(), block.tk.to_numpy()
    ok = inside(starts, width)
    at = np.flatnonzero(ok)
    h = window_hashes(values, width)[ok]
    share = (window_hashes(values, width, BASE_2)[ok] % np.uint64(shares)).astype(np.int64)
    doc = spread(starts)[at]
    order = np.argsort(h, kind="stable")
    begin = at_runs(h[order])
    known = np.zeros(len(h), bool)
    known[order] = ids[doc[order]] > np.repeat(ids[doc[order[begin]]], lengths(begin, len(order)))
    position = at - starts[:-1][doc]
    k = np.flatnonzero(known)  # ordered by row and position
    rows = [(m[1] % shares, *m[1:]) for m in answers(ids[doc[k]], tks[doc[k]], position[k], groups)]
    asked = np.flatnonzero(~known)
    asked = asked[by_key(share[asked], shares)]
    begin = at_runs(share[asked])
    for a, n in zip(begin, lengths(begin, len(asked))):
        k = asked[a : a + n]
        rows.append(to_message(int(share[k[0]]), -1, ids[doc[k]], tks[doc[k]], position[k], h[k].tobytes()))
    return pd.DataFrame(rows, columns=COLUMNS)


def judged(messages: pd.DataFrame, groups: int) -> pd.DataFrame:
    """Of one share: the occurrences of windows that also start in a document with a smaller id, by group of documents."""
    rows = [r for r in messages.itertuples(index=False) if r.group >= 0]
    asked = [r for r in messages.itertuples(index=False) if r.group < 0]
    if asked:
        h = np.concatenate([np.frombuffer(r.hashes, np.uint64) for r in asked])
        ids = np.concatenate([from_message(r)[0] for r in asked])
        order = np.argsort(h)
        begin = at_runs(h[order])
        del h
        late = np.zeros(len(ids), bool)
        ordered = ids[order]
        late[order] = ordered > np.repeat(np.minimum.reduceat(ordered, begin), lengths(begin, len(order)))
        del order, ordered, ids
        found, done = [], 0
        for r in asked:
            k = np.flatnonzero(late[done : done + r.count])
            done += r.count
            if len(k):
                found.append([x[k] for x in from_message(r)])
        if found:
            ids, tks, positions = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((positions, tks, ids))
            rows += answers(ids[order], tks[order], positions[order], groups)
    return pd.DataFrame(rows, columns=COLUMNS)


def gathered(messages: pd.DataFrame, width: int) -> pd.DataFrame:
    """Of one group of documents: the maximal intervals that the windows cover, one row per document."""
    ids, tks, positions = (np.concatenate(x) for x in zip(*[from_message(r) for r in messages.itertuples(index=False)]))
    order = np.lexsort((positions, tks, ids))
    ids, tks, positions = ids[order], tks[order], positions[order]
    apart = np.ones(len(ids), bool)
    apart[1:] = (ids[1:] != ids[:-1]) | (tks[1:] != tks[:-1]) | (positions[1:] > positions[:-1] + width)
    first = np.flatnonzero(apart)
    last = np.append(first[1:], len(ids)) - 1
    begin = at_runs(ids[first], tks[first])
    cut = begin[1:]
    return pd.DataFrame(
        {
            "id": ids[first[begin]],
            "tk": tks[first[begin]],
            "starts": np.split(positions[first].astype(np.int32), cut),
            "ends": np.split((positions[last] + width).astype(np.int32), cut),
        }
    )


def repeated_windows(rows: DataFrame, width: int) -> DataFrame:
    """id, tk, starts, ends: the maximal intervals of windows that also start in a document with a smaller id, per row that has any."""
    shares = max(1, total_bytes(rows, "text") // SHARE_BYTES)
    groups = max(1, shares // 2)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches):
            yield sent(block, width, shares, groups)

    messages = rows.select("id", "tk", "text").mapInPandas(send, MESSAGE)
    found = messages.groupBy("share").applyInPandas(lambda m: judged(m, groups), MESSAGE)
    return found.groupBy("group").applyInPandas(lambda m: gathered(m, width), "id long, tk long, starts array<int>, ends array<int>")


def dedup(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, intervals (removed words: start, end) and kept (the other words, joined by a space), per row."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches):
            out = []
            for r in block.itertuples(index=False):
                words = r.text.split()
                spans = [] if r.starts is None else list(zip(r.starts.tolist(), r.ends.tolist()))
                left, at = [], 0
                for a, b in spans:
                    left += words[at:a]
                    at = b
                kept = b" ".join(left + words[at:] if spans else words)
                out.append((r.id, r.no_id, len(words), [{"start": a, "end": b} for a, b in spans], kept))
            yield pd.DataFrame(out, columns=["id", "no_id", "n_words", "intervals", "kept"])

    rows = identified(docs, id_column, text_column)
    found = repeated_windows(rows, width)
    joined = rows.join(found, ["id", "tk"], "left").select("id", "no_id", "text", "starts", "ends")
    out = joined.mapInPandas(cut, "id long, no_id boolean, n_words long, intervals array<struct<start:int,end:int>>, kept binary")
    return named(out.withColumn("kept", F.col("kept").cast("string")), id_column)
