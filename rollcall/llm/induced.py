"""Suffix order and common prefixes of many short strings, by external induced sorting.

The text is a row of strings, each followed by the separator 0; a suffix ends at its separator. Suffixes that are smaller than their successor are of type S, others of type L; an S after
an L is a seed. Seeds are sorted by their first DEPTH symbols, and the order of all suffixes follows by induction: a scan in ascending order finds
the L suffixes in order, a scan in descending order the S suffixes. What a scan finds goes to a monotone priority queue: one first-in-first-out line per first symbol, taken in
symbol order, with whole lines written to disk when the queue outgrows its memory. A queued tuple carries the suffix and its common prefix with the one before it in its line,
which is one more than the least common prefix among the suffixes scanned between the two that induced them.

Order and prefixes are right up to DEPTH symbols, which is what a caller may ask for: seeds that agree so far stay in any order, and so does what they
induce. The seeds' own order comes from a recursion of one level: their first DEPTH symbols are packed to words and sorted word by word.
"""

from __future__ import annotations

import tempfile

import numpy as np

DEPTH = 56
SYMBOLS = 257
#: Tuples that a queue holds in memory.
HELD = 4_000_000


class Lines:
    """Lines of (suffix, common prefix) by first symbol; lines beyond HELD tuples in all go to a scratch file of the task."""

    def __init__(self, held: int = HELD) -> None:
        self.memory: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(SYMBOLS)]
        self.disk: list[list[tuple[int, int]]] = [[] for _ in range(SYMBOLS)]
        self.size, self.held, self.file = 0, held, None

    def push(self, symbol: int, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        self.memory[symbol].append((suffixes, prefixes))
        self.size += len(suffixes)
        if self.size > self.held:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, line in enumerate(self.memory):
            for suffixes, prefixes in line:
                self.disk[symbol].append((self.file.tell(), len(suffixes)))
                self.file.write(suffixes.astype("<i4").tobytes() + prefixes.astype(np.uint8).tobytes())
            line.clear()
        self.size = 0

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All that is in a line now, in order."""
        parts = []
        for at, n in self.disk[symbol]:
            self.file.seek(at)
            parts.append((np.frombuffer(self.file.read(4 * n), "<i4"), np.frombuffer(self.file.read(n), np.uint8)))
        self.disk[symbol].clear()
        parts += self.memory[symbol]
        self.size -= sum(len(p[0]) for p in self.memory[symbol])
        self.memory[symbol].clear()
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.uint8)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def words_at(text: np.ndarray, at: np.ndarray, ends: np.ndarray, count: int) -> list[np.ndarray]:
    """The symbols from ``at`` on as big-endian words of 7 symbols (9 bits each), nothing after the suffix's end."""
    out = []
    for w in range(count):
        key = np.zeros(len(at), np.uint64)
        for j in range(w * 7, w * 7 + 7):
            p = at + j
            key = key << np.uint64(9) | np.where(p < ends, text[np.minimum(p, len(text) - 1)], 0).astype(np.uint64)
        out.append(key)
    return out


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, element by element, ``depth`` at most."""
    n = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for j in range(depth):
        p, q = a[live] + j, b[live] + j
        live = live[(p < ends[a[live]]) & (q < ends[b[live]])]
        p, q = a[live] + j, b[live] + j
        live = live[text[p] == text[q]]
        if not len(live):
            break
        n[live] += 1
    return n


def common_of_keys(keys: list[np.ndarray]) -> np.ndarray:
    """Equal leading symbols of neighbours, from their words; what follows a suffix's end counts as equal."""
    n = np.zeros(len(keys[0]) - 1 if len(keys[0]) else 0, np.int64)
    live = np.arange(len(n))
    for key in keys:
        a, b = key[live], key[live + 1]
        same = a == b
        n[live[same]] += 7
        other = live[~same]
        a, b = a[~same], b[~same]
        for shift in range(54, 0, -9):
            n[other] += (a >> np.uint64(shift)) == (b >> np.uint64(shift))
        live = live[same]
    return n


class Scan:
    """The least common prefix since the last push to each line."""

    def __init__(self, depth: int) -> None:
        self.run = np.full(SYMBOLS, 0, np.int64)
        self.depth = depth

    def push(self, lines: Lines, symbols: np.ndarray, pushes: np.ndarray, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        """A batch in scan order with its common prefixes; those with ``pushes`` put ``suffixes`` into the line of their symbol."""
        if not len(prefixes):
            return
        least = int(prefixes.min())
        after = np.minimum(self.run, least)
        at = np.flatnonzero(pushes)
        if len(at):
            order = at[np.argsort(symbols[at].astype(np.uint16), kind="stable")]
            own = symbols[order]
            begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            for a, b in zip(begin, [*begin[1:], len(own)]):
                d, k = int(own[a]), order[a:b]
                edges = np.concatenate([[0], k[:-1] + 1])
                low = np.minimum.reduceat(prefixes[: k[-1] + 1], edges)
                low[0] = min(low[0], self.run[d])
                lines.push(d, suffixes[k], np.minimum(low + 1, self.depth).astype(np.uint8))
                rest = prefixes[k[-1] + 1 :]
                after[d] = rest.min() if len(rest) else self.depth
        self.run = after


def suffix_order(strings: bytes, lengths: np.ndarray, depth: int = DEPTH, held: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """Of the strings one after another: places of all suffixes in order (places in ``strings``), and the common prefix of each with the one before (``depth`` at most)."""
    n = len(strings) + len(lengths)
    own_end = np.cumsum(lengths + 1) - 1  # places of the separators
    text = np.zeros(n, np.int16)
    is_text = np.ones(n, bool)
    is_text[own_end] = False
    text[is_text] = np.frombuffer(strings, np.uint8).astype(np.int16) + 1
    ends = np.repeat(own_end.astype(np.int32), lengths + 1)
    # types: smaller than the next suffix (S), which equal symbols inherit from the right
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:] - text[:-1])
    step[own_end] = 1
    following = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n - 1))
    following = np.minimum.accumulate(following[::-1])[::-1]
    small = step[following] > 0
    del following, step
    small[own_end] = True
    seed = np.zeros(n, bool)
    seed[1:] = small[1:] & ~small[:-1]
    seeds = np.flatnonzero(seed).astype(np.int32)
    del seed
    keys = words_at(text, seeds, ends[seeds], -(-depth // 7))
    order = np.lexsort(keys[::-1])
    seeds = seeds[order]
    lead = np.zeros(len(seeds), np.int64)
    lead[1:] = common_of_keys([k[order] for k in keys]) if len(seeds) > 1 else lead[1:]
    del keys, order
    left = ends[seeds] - seeds
    lead[1:] = np.minimum(np.minimum(lead[1:], depth), np.minimum(left[1:], left[:-1]))
    of_seed = text[seeds]
    bounds = np.searchsorted(of_seed, np.arange(SYMBOLS + 1))

    def first_of(last: np.ndarray, first: np.ndarray) -> int:
        """The common prefix of two neighbours in scan order that no induction has compared."""
        return int(common(text, last[-1:].astype(np.int64), first[:1].astype(np.int64), ends, depth)[0])

    def induce(lines: Lines, scan: Scan, suffixes: np.ndarray, prefixes: np.ndarray, want_small: bool) -> None:
        before = suffixes.astype(np.int64) - 1
        sure = np.maximum(before, 0)
        ok = (before >= 0) & (small[sure] == want_small) & is_text[sure]
        scan.push(lines, text[sure], ok, before.astype(np.int32), prefixes)

    # ascending: L suffixes
    lines, scan, large = Lines(held), Scan(depth), {}
    for c in range(SYMBOLS):
        parts, last = [], None
        while True:
            suffixes, prefixes = lines.take(c)
            if not len(suffixes):
                break
            prefixes = prefixes.astype(np.int64)
            if last is None:
                prefixes[0] = 0
            parts.append((suffixes, prefixes))
            last = suffixes
            induce(lines, scan, suffixes, prefixes, False)
        large[c] = tuple(np.concatenate(x) for x in zip(*parts)) if parts else None
        a, b = bounds[c], bounds[c + 1]
        if b > a:
            prefixes = lead[a:b].copy()
            prefixes[0] = first_of(last, seeds[a:b]) if last is not None else 0
            induce(lines, scan, seeds[a:b], prefixes, False)
    lines.close()
    # descending: S suffixes; a prefix is with the one scanned before, that is the next in order
    lines, scan, done = Lines(held), Scan(depth), []
    for c in range(SYMBOLS - 1, 0, -1):
        parts, last = [], None
        while True:
            suffixes, prefixes = lines.take(c)
            if not len(suffixes):
                break
            prefixes = prefixes.astype(np.int64)
            if last is None:
                prefixes[0] = 0
            parts.append((suffixes, prefixes))
            last = suffixes
            induce(lines, scan, suffixes, prefixes, True)
        if large[c] is not None:
            suffixes, prefixes = large[c][0][::-1], np.concatenate([[0], large[c][1][:0:-1]])
            prefixes[0] = first_of(last, suffixes) if last is not None else 0
            parts.append((suffixes, prefixes))
            induce(lines, scan, suffixes, prefixes, True)
        if parts:
            done.append(tuple(np.concatenate(x) for x in zip(*parts)))
    lines.close()
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    suffixes, prefixes = (np.concatenate(x)[::-1] for x in zip(*done))
    prefixes = np.concatenate([[0], prefixes[:-1]])  # with the one before
    # places without the separators
    return suffixes.astype(np.int64) - np.repeat(np.arange(len(lengths)), lengths + 1)[suffixes], prefixes
