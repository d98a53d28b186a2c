"""Suffix-array dedup of byte strings, with external induced sorting in shards dealt out by content.

A byte goes if a string of WIDTH bytes that covers it also starts in a document with a smaller id; strings are judged on the input.

1. Every string of WIDTH bytes has a lead: the run of LEAD bytes in it with the smallest hash. Equal strings have equal leads, so strings whose lead is in one document only
   repeat nowhere. Each task sends the different leads of a block of documents once, and Spark finds those that are in two documents or more.
2. Neighbouring strings with one lead form a segment of at most 2 * WIDTH - LEAD bytes. Segments with a shared lead go to the shard of their lead, so all copies of a
   string meet in one shard, with little text around them.
3. A shard keeps equal segments once, with the smallest id. Those whose lead has several different segments are suffix-sorted with common prefixes; neighbours with
   a common prefix of WIDTH or more are copies, and all but those of the smallest id are answered.
4. Answers are gathered by groups of documents, merge into maximal runs, and meet their document by id.

Shards and groups follow the bytes of text, so each stays near SHARE_BYTES of text, however large the table; a shard's suffix sort spills its queues to disk. A string that a third of
all documents share is one segment in its shard, and each block of documents sends its lead once.

Null ids count as larger than all others; rows of one id are not compared with each other, and rows of one id with different texts are told apart. Null, empty and texts under WIDTH
bytes are kept. Texts of any length are read whole. An empty table gives an empty result. Other columns are not read. Leads are compared by hashes, which can only
add segments; strings are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import BASE, blocks, from_planes, identified, inside, mix, named, spread, to_planes, total_bytes
from rollcall.llm.induced import suffix_order
from rollcall.llm.substring import COLUMNS, MESSAGE, answers, at_runs, by_key, from_message, lengths, to_message

WIDTH, LEAD = 50, 26
SHARE_BYTES = 16 << 20
BLOCK = 2 << 20
#: Bytes of a lead's hash that are sent; shares add bits.
SENT = 5

_table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2^64."""
    global _powers, _inverses
    if len(_powers) < n:
        up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers, _inverses = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[:n], _inverses[:n]


def run_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of each run of ``width`` bytes, from prefix sums."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_table[data] * down[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * up[: n - width + 1])


def leads(h: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` hashes the place of the smallest (the first, if several)."""
    bits = np.uint64(max(1, len(h).bit_length()))
    low = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:]) if len(low) > width else low[:0]
        width *= 2
    rest = span - width
    if rest and len(low):
        low = np.minimum(low[:-rest], low[rest:]) if len(low) > rest else low[:0]
    return (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def segments(block: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """The bytes, where texts begin, and per segment: its text, first and last string, lead and the lead's hash."""
    starts = np.cumsum([0, *block.text.str.len()])
    data = np.frombuffer(b"".join(block.text), np.uint8)
    h = run_hashes(data, LEAD)
    lead = leads(h, WIDTH - LEAD + 1)
    at = np.flatnonzero(inside(starts, WIDTH))
    lead = lead[at]
    doc = spread(starts)[at]
    begin = at_runs(doc, lead)
    first = at[begin]
    last = at[np.append(begin[1:], len(at)) - 1] if len(at) else first
    return data, starts, doc[begin], first, last, lead[begin], h[lead[begin]]


def sent_leads(block: pd.DataFrame, shares: int, groups: int) -> pd.DataFrame:
    """Per share the leads of the block, each once; and to the documents' groups the leads that two documents of the block have."""
    block = block.sort_values(["id", "tk"], kind="stable").reset_index(drop=True)
    _, starts, doc, _, _, lead, h = segments(block)
    ids, tks = block.id.to_numpy(), block.tk.to_numpy()
    order = np.argsort(h, kind="stable")
    begin = at_runs(h[order])
    n = lengths(begin, len(order))
    own = ids[doc[order]]
    several = np.repeat(own[begin] != own[np.append(begin[1:], len(own)) - 1], n) if len(own) else np.zeros(0, bool)
    known = np.zeros(len(h), bool)
    known[order] = several
    position = lead - starts[:-1][doc]
    k = np.flatnonzero(known)
    rows = [(m[1] % shares, *m[1:]) for m in answers(ids[doc[k]], tks[doc[k]], position[k], groups)]
    once = np.zeros(len(h), bool)
    once[order[begin]] = True
    once |= ~known  # one id has it: all its places ask
    asked = np.flatnonzero(once)
    share = (mix(h[asked]) % np.uint64(shares)).astype(np.int64)
    turn = by_key(share, shares)
    asked, share = asked[turn], share[turn]
    begin = at_runs(share)
    for a, m in zip(begin, lengths(begin, len(asked))):
        k = asked[a : a + m]
        rows.append(to_message(int(share[a]), -1, ids[doc[k]], tks[doc[k]], position[k], to_planes(h[k] >> np.uint64(64 - 8 * SENT), SENT)))
    return pd.DataFrame(rows, columns=COLUMNS)


def shared_leads(messages: pd.DataFrame, groups: int) -> pd.DataFrame:
    """Of one share: the places of leads that are in two documents or more."""
    rows = [r for r in messages.itertuples(index=False) if r.group >= 0]
    asked = [r for r in messages.itertuples(index=False) if r.group < 0]
    if asked:
        h = np.concatenate([from_planes(r.hashes, r.count, SENT) for r in asked])
        ids = np.concatenate([from_message(r)[0] for r in asked])
        order = np.argsort(h)
        begin = at_runs(h[order])
        del h
        own = ids[order]
        both = np.minimum.reduceat(own, begin) != np.maximum.reduceat(own, begin)
        several = np.zeros(len(ids), bool)
        several[order] = np.repeat(both, lengths(begin, len(order)))
        del order, own, ids
        found, done = [], 0
        for r in asked:
            k = np.flatnonzero(several[done : done + r.count])
            done += r.count
            if len(k):
                found.append([x[k] for x in from_message(r)])
        if found:
            ids, tks, positions = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((positions, tks, ids))
            rows += answers(ids[order], tks[order], positions[order], groups)
    return pd.DataFrame(rows, columns=COLUMNS)


def places_of(messages: pd.DataFrame) -> pd.DataFrame:
    """Of one group of documents: the places, one row per document."""
    ids, tks, positions = (np.concatenate(x) for x in zip(*[from_message(r) for r in messages.itertuples(index=False)]))
    order = np.lexsort((positions, tks, ids))
    ids, tks, positions = ids[order], tks[order], positions[order]
    begin = at_runs(ids, tks)
    return pd.DataFrame({"id": ids[begin], "tk": tks[begin], "places": np.split(positions.astype(np.int32), begin[1:])})


def sent_segments(block: pd.DataFrame, shares: int) -> pd.DataFrame:
    """Per share the segments of the block whose lead is shared, with their bytes."""
    data, starts, doc, first, last, lead, h = segments(block)
    ids, tks = block.id.to_numpy(), block.tk.to_numpy()
    wanted = np.zeros(len(data) + 1, bool)
    for d, places in enumerate(block.places):
        wanted[starts[d] + places] = True
    asked = np.flatnonzero(wanted[lead])
    share = (mix(h[asked]) % np.uint64(shares)).astype(np.int64)
    turn = by_key(share, shares)
    asked, share = asked[turn], share[turn]
    rows = []
    begin = at_runs(share)
    raw, packer = data.tobytes(), zstandard.ZstdCompressor(level=3)
    for a, m in zip(begin, lengths(begin, len(asked))):
        k = asked[a : a + m]
        k = k[np.lexsort((first[k], tks[doc[k]], ids[doc[k]]))]
        size = last[k] - first[k] + WIDTH
        message = to_message(int(share[a]), -1, ids[doc[k]], tks[doc[k]], first[k] - starts[:-1][doc[k]], h[k].tobytes())
        rows.append((*message, to_planes(size, 4), packer.compress(b"".join([raw[i : i + n] for i, n in zip(first[k].tolist(), size.tolist())]))))
    return pd.DataFrame(rows, columns=[*COLUMNS, "sizes", "bytes"])


def copies(messages: pd.DataFrame, groups: int) -> pd.DataFrame:
    """Of one shard: the strings that also start in a document with a smaller id, as runs of string starts; messages to groups of documents."""
    index: dict[bytes, int] = {}
    kind, ids, tks, positions, hashes = [], [], [], [], []
    for r in messages.itertuples(index=False):
        size = from_planes(r.sizes, r.count, 4).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(size)]).tolist()
        own = zstandard.decompress(r.bytes)
        kind += [index.setdefault(own[a:b], len(index)) for a, b in zip(edges, edges[1:])]
        i, t, p = from_message(r)
        ids.append(i), tks.append(t), positions.append(p), hashes.append(np.frombuffer(r.hashes, np.uint64))
    kind = np.array(kind, np.int64)
    ids, tks, positions, hashes = (np.concatenate(x) for x in (ids, tks, positions, hashes))
    texts = list(index)
    size = np.array([len(t) for t in texts])
    least = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(least, kind, ids)
    # a later document's segment goes as a whole
    later = ids > least[kind]
    out_row, out_from, out_to = [np.flatnonzero(later)], [positions[later]], [positions[later] + size[kind[later]]]
    # different segments of one lead: copies may be parts of them
    lead_of = np.zeros(len(texts), np.uint64)
    lead_of[kind] = hashes
    _, inverse, many = np.unique(lead_of, return_inverse=True, return_counts=True)
    chosen = np.flatnonzero(many[inverse] > 1)
    if len(chosen):
        own = size[chosen]
        order, prefix = suffix_order(b"".join([texts[c] for c in chosen]), own)
        begin = np.concatenate([[0], np.cumsum(own)])
        string = np.repeat(np.arange(len(own)), own)[order]
        whole = order + WIDTH <= begin[string + 1]
        group = np.cumsum(prefix < WIDTH) - 1  # strings of one group share WIDTH bytes; suffixes shorter than that are left out below
        of = least[chosen[string]]
        low = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, group[whole], of[whole])
        copy = np.zeros(len(order), bool)
        copy[order[whole & (of > low[group])]] = True
        # runs of copies within each chosen segment, for its rows in the document that has it first
        edge = np.diff(np.concatenate([[0], copy.astype(np.int8), [0]]))
        up, down = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        seg = np.searchsorted(begin, up, side="right") - 1
        runs = pd.DataFrame({"kind": chosen[seg], "a": up - begin[seg], "b": down - begin[seg] + WIDTH - 1})
        rest = np.flatnonzero(~later)
        hit = pd.DataFrame({"kind": kind[rest], "row": rest}).merge(runs, on="kind")
        out_row.append(hit.row.to_numpy()), out_from.append(positions[hit.row] + hit.a), out_to.append(positions[hit.row] + hit.b)
    row, start, end = (np.concatenate(x) for x in (out_row, out_from, out_to))
    order = np.lexsort((start, tks[row], ids[row]))
    row, start, end = row[order], start[order], end[order]
    rows = []
    group = (mix(ids[row].astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
    turn = by_key(group, groups)
    begin = at_runs(group[turn])
    for a, n in zip(begin, lengths(begin, len(turn))):
        k = turn[a : a + n]
        rows.append((*to_message(-1, int(group[k[0]]), ids[row[k]], tks[row[k]], start[k]), to_planes(end[k] - start[k], 4)))
    return pd.DataFrame(rows, columns=[*COLUMNS, "sizes"])


def runs_of(messages: pd.DataFrame) -> pd.DataFrame:
    """Of one group of documents: maximal runs of bytes to remove, one row per document."""
    ids, tks, start = (np.concatenate(x) for x in zip(*[from_message(r) for r in messages.itertuples(index=False)]))
    end = start + np.concatenate([from_planes(r.sizes, r.count, 4) for r in messages.itertuples(index=False)]).astype(np.int64)
    order = np.lexsort((start, tks, ids))
    ids, tks, start, end = ids[order], tks[order], start[order], end[order]
    row = np.cumsum(np.isin(np.arange(len(ids)), at_runs(ids, tks)))
    far = int(end.max()) + 1
    reached = np.maximum.accumulate(end + row * far) - row * far  # the furthest end so far within the row
    apart = np.ones(len(ids), bool)
    apart[1:] = (row[1:] != row[:-1]) | (start[1:] > reached[:-1])
    first = np.flatnonzero(apart)
    last = np.append(first[1:], len(ids)) - 1
    begin = at_runs(row[first])
    return pd.DataFrame(
        {
            "id": ids[first[begin]],
            "tk": tks[first[begin]],
            "starts": np.split(start[first].astype(np.int32), begin[1:]),
            "ends": np.split(reached[last].astype(np.int32), begin[1:]),
        }
    )


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs of bytes: start, end) and kept (the other bytes), per row."""
    rows = identified(docs, id_column, text_column)
    shares = max(1, total_bytes(rows, "text") // SHARE_BYTES)
    groups = max(1, shares // 2)

    def send_leads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, limit=BLOCK):
            yield sent_leads(block, shares, groups)

    def send_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, limit=BLOCK):
            yield sent_segments(block, shares)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, limit=BLOCK):
            out = []
            for r in block.itertuples(index=False):
                spans = [] if r.starts is None else list(zip(r.starts.tolist(), r.ends.tolist()))
                left, at = [], 0
                for a, b in spans:
                    left.append(r.text[at:a])
                    at = b
                kept = b"".join([*left, r.text[at:]])
                out.append((r.id, r.no_id, len(r.text), [{"start": a, "end": b} for a, b in spans], kept))
            yield pd.DataFrame(out, columns=["id", "no_id", "n_bytes", "spans", "kept"])

    leads_sent = rows.select("id", "tk", "text").mapInPandas(send_leads, MESSAGE)
    shared = leads_sent.groupBy("share").applyInPandas(lambda m: shared_leads(m, groups), MESSAGE)
    places = shared.groupBy("group").applyInPandas(places_of, "id long, tk long, places array<int>")
    # the same columns as in the last join, so that both read one exchange of the texts
    chosen = rows.join(places, ["id", "tk"]).select("id", "no_id", "tk", "text", "places")
    sent = chosen.mapInPandas(send_segments, MESSAGE + ", sizes binary, bytes binary")
    found = sent.groupBy("share").applyInPandas(lambda m: copies(m, groups), MESSAGE + ", sizes binary")
    runs = found.groupBy("group").applyInPandas(runs_of, "id long, tk long, starts array<int>, ends array<int>")
    joined = rows.join(runs, ["id", "tk"], "left").select("id", "no_id", "text", "starts", "ends")
    out = joined.mapInPandas(cut, "id long, no_id boolean, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
    return named(out, id_column)
