"""Archives, whitening and vector codes on small frames, against brute force."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
import uuid
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import captures, vector_codes, warc, whitening

PAGES = "page_id long, url string, html string, type string, capture string, id string"


def page_rows():
    rows = [(i, f"http://h.example/{i}?q=a b", f"<p>page {i % 7}</p>" + "x" * (i % 5), "c", "c", "c") for i in range(40)]
    return rows + [
        (None, None, None, None, None, None),
        (None, "no id\r\nX: y", "", "c", "c", "c"),
        (2**63 - 1, "http://[bad", "ünï ☃\x00\r\n\r\nWARC/1.1\r\n", "c", "c", "c"),
        (2**63 - 2, "u", "ünï ☃\x00\r\n\r\nWARC/1.1\r\n", "c", "c", "c"),
        (5, "twice", "same", "c", "c", "c"),
        (5, "twice", "same", "c", "c", "c"),
        (5, "other url", "same", "c", "c", "c"),
        (99, "long", "long text " * 300_000, "c", "c", "c"),
    ]


def expected_pages(rows, least):
    out, seen = [], {}
    for i, _, html, *_ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True):
        data = (html or "").encode()
        twin = data in seen and len(data) >= least
        seen.setdefault(data, i)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, "revisit" if twin else "response", len(data), digest, seen[data] if twin else None))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("least", [0, 6])
def test_pages_through_archives(spark, tmp_path, least):
    pages = spark.createDataFrame(page_rows(), PAGES).repartition(3)
    got = captures.stored_pages(pages, f"file://{tmp_path}/a", least).drop("capture")
    rows = got.select("page_id", "record_type", "payload_bytes", "payload_digest", "refers_to").collect()
    assert in_order(rows) == in_order(expected_pages(page_rows(), least))


def test_nested_captures_hold_payloads(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    captures.write_pages(spark.createDataFrame(page_rows(), PAGES), path, roll=2000)
    assert len(list((tmp_path / "a").glob("*.warc.gz"))) > 3
    (tmp_path / "a" / "left-behind.warc.gz").write_bytes(b"of an attempt that was lost")
    nested = captures.assemble(captures.read_records(spark, path)).where("main.type = 'response'").collect()
    assert in_order([r["main"]["payload"].decode()] for r in nested) == in_order({(r[2] or "",) for r in page_rows()})
    assert {(r["n_requests"], r["n_metadata"], r["request"]["type"], r["metadata"]["type"]) for r in nested} == {(1, 1, "request", "metadata")}
    assert all(r["capture"] == r["main"]["record_id"] in r["request"]["concurrent_to"] for r in nested)
    with pytest.raises(Exception, match="already holds archives"):
        captures.write_pages(spark.createDataFrame(page_rows(), PAGES), path)


def test_no_pages(spark, tmp_path):
    assert captures.stored_pages(spark.createDataFrame([], PAGES), f"file://{tmp_path}/a").collect() == []


RECORDS = "record_id string, type string, date string, target_uri string, concurrent_to array<string>, refers_to string, digest string, payload binary, payload_bytes long, sha1 string"


def one(record_id, kind, *concurrent):
    return (record_id, kind, None, None, list(concurrent), None, None, b"", 0, "")


def test_concurrent_identifiers_in_chains_and_both_directions(spark):
    rows = [
        one("r1", "response"),
        one("q1", "request", "r1"),
        one("m1", "metadata", "q1"),  # a chain of two links
        one("m0", "metadata", "r1"),
        one("r2", "response", "q2"),  # the response names the request
        one("q2", "request"),
        one("r3", "revisit"),
        one("q4", "request", "m4"),  # no main record
        one("m4", "metadata", "q4"),
        one("q5", "request", "gone"),
        one("w", "warcinfo"),
        one(None, "request", "r1"),
        one(None, "response"),
        one("q6", "request", "r2", "r1"),  # two captures: the smaller
        one("r7", "response"),
        one("r7", "response"),
    ]
    got = captures.assemble(spark.createDataFrame(rows, RECORDS)).collect()
    found = in_order((r["capture"], r["main"] and r["main"]["type"], r["request"] and r["request"]["record_id"], r["metadata"] and r["metadata"]["record_id"], r["n_requests"], r["n_metadata"]) for r in got)
    assert found == in_order(
        [
            ("r1", "response", "q1", "m0", 2, 2),
            ("r2", "response", "q2", None, 1, 0),
            ("r3", "revisit", None, None, 0, 0),
            ("m4", None, "q4", "m4", 1, 1),
            ("q5", None, "q5", None, 1, 0),
            ("r7", "response", None, None, 0, 0),
            ("r7", "response", None, None, 0, 0),
        ]
    )


def test_records_of_other_writers():
    block = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody\r\n\r\n"
    text = (
        b"WARC/1.0\r\nWARC-Type: response\r\nwarc-record-id: <urn:uuid:1>\r\nWARC-Concurrent-To: <urn:uuid:2>\r\nWARC-Concurrent-To: <urn:uuid:3>\r\nWARC-Target-URI: http://a/\r\n b\r\n"
        b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block)
    ) + block + b"\r\n\r\n"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    for data in (text + info, gzip.compress(text + info), gzip.compress(text) + gzip.compress(info)):
        first, second = warc.parsed(data)
        assert (first["record_id"], first["concurrent_to"], first["target_uri"]) == ("urn:uuid:1", ["urn:uuid:2", "urn:uuid:3"], "http://a/ b")
        assert (first["payload"], first["http"], second["type"], second["record_id"]) == (b"body\r\n\r\n", "HTTP/1.1 200 OK\r\nX: y", "warcinfo", None)
    for broken in (text[:-30], gzip.compress(text)[:-20], text.replace(b"Content-Length", b"Length"), text.replace(b"WARC-Type:", b"WARC-Type")):
        with pytest.raises(ValueError):
            warc.parsed(broken)


def test_record_is_read_as_written():
    row = dict.fromkeys(c.split()[0] for c in warc.COLUMNS.split(", "))
    row |= {"type": "metadata", "record_id": f"urn:uuid:{uuid.UUID(int=7)}", "date": captures.DATE, "concurrent_to": ["urn:x", "urn:y"], "payload": b"a: b\r\n", "content_type": "application/warc-fields"}
    (back,) = warc.parsed(warc.record(row))
    assert {k: back[k] for k in warc.FIELDS} == {k: row[k] for k in warc.FIELDS} and back["payload"] == row["payload"]


VECTORS = "vec_id long, embedding array<double>, label int, id string, x string, row string, n string"


def vectors(spark, rows, labels=None):
    return spark.createDataFrame([(i, v, None if labels is None else labels[k], "c", "c", "c", "c") for k, (i, v) in enumerate(rows)], VECTORS).repartition(4)


def vector_rows(seed, count, width, offset=0.0):
    rng = random.Random(seed)
    rows = [(i, [offset + rng.gauss(0, 0.3) * (k + 1) for k in range(width)]) for i in range(count)]
    rows += [(1000 + i, rows[0][1]) for i in range(count // 2)]  # a vector that a third of all rows share
    return rows + [
        (None, [0.5 + offset] * width),
        (3, [-0.0] * width),
        (5000, None),
        (5001, [None] + [0.1] * (width - 1)),
        (5002, [math.nan] + [0.1] * (width - 1)),
        (5003, [math.inf] + [0.1] * (width - 1)),
        (5004, []),
    ]


def kept(rows):
    return [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


@pytest.mark.parametrize("width,offset", [(6, 0.0), (6, 1e6), (2, -3.0), (9, 0.0)])
def test_whitening(spark, width, offset):
    rows = vector_rows(width, 60, width, offset)
    got = whitening.whiten(vectors(spark, rows)).collect()
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in kept(rows) if v]
    fit = sorted({tuple(v) for _, v in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = [[sum((n * v[a] - sums[a]) * (n * v[b] - sums[b]) for v in fit) for b in range(width)] for a in range(width)]
    cov = np.array([[float(Fraction(c, n**3)) for c in line] for line in exact])
    values, basis = np.linalg.eigh(cov)
    want = []
    for i, v in good:
        z = [n * c - s for c, s in zip(v, sums)]
        for k in range(min(4, width)):
            e, u = values[-1 - k], basis[:, -1 - k]
            u = u * np.sign(u[np.abs(u).argmax()])
            want.append((i, k + 1, n, sum(c * c for c in z), float(np.array(z, float) / n @ u / math.sqrt(e)), e / values.sum()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    assert len(got) == len(want)
    for a, b in zip(sorted([tuple(r) for r in got], key=key), sorted(want, key=key)):
        assert (a[0], a[1], a[2], int(a[3])) == b[:4]
        assert a[4] == pytest.approx(b[4], abs=1e-7) and a[5] == pytest.approx(b[5], rel=1e-7)
        assert a[6] < 1e-5  # one row far from all others costs the other components digits


def test_whitening_beyond_64_bits(spark):
    rows = [(i, [float((-1) ** i * 2**40 + i), float(i * i)]) for i in range(9)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    x = [[int(c) * 256 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    for r in got:
        assert int(r["deviation"]) == sum((9 * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums))
    assert got[0]["identity_error"] < 1e-6 and max(int(r["deviation"]) for r in got) > 2**63


def test_whitening_without_variance(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    (row,) = whitening.whiten(vectors(spark, [(1, [0.25])])).collect()
    assert (row["n"], int(row["deviation"]), row["whitened"], row["explained"], row["identity_error"]) == (1, 0, None, None, None)
    got = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i]) for i in range(4)])).orderBy("vec_id", "component").collect()
    assert [r["whitened"] is None for r in got[:2]] == [False, True] and got[0]["identity_error"] < 1e-9


def test_whitening_of_two_lengths(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(15)] + [(100 + i, [float(i % 5), float(i % 3), float(i % 2)]) for i in range(30)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert {(r["vec_id"] >= 100, r["n"], r["component"]) for r in got} == {(False, 15, 1), (False, 15, 2), (True, 30, 1), (True, 30, 2), (True, 30, 3)}


def codes_by_brute_force(rows, labels, parts=8, entries=16, rounds=6):
    good = [(i, tuple(math.floor(4096 * c) for c in v), l) for (i, v), l in zip(rows, labels) if (i, v) in kept([(i, v)])]
    out = []
    for length in {len(v) for _, v, _ in good}:
        mine = [g for g in good if len(g[1]) == length]
        first = sorted(mine, key=lambda g: (g[0] is None, g[0] or 0, g[1]))[:entries]
        edges = vector_codes.edges_of(length, parts)
        books = [[g[1][a:z] for g in first] for a, z in zip(edges, edges[1:])]
        away = lambda y, e: sum((p - q) ** 2 for p, q in zip(y, e))
        assign = lambda v: [min((away(v[a:z], e), k) for k, e in enumerate(b)) for a, z, b in zip(edges, edges[1:], books)]
        for _ in range(rounds):
            used = [assign(v) for _, v, _ in mine]
            for p, (a, z) in enumerate(zip(edges, edges[1:])):
                for k in range(len(books[p])):
                    group = [v[a:z] for (_, v, _), u in zip(mine, used) if u[p][1] == k]
                    if group:
                        books[p][k] = tuple(sum(c) // len(group) for c in zip(*group))
        sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
        for i, v, label in mine:
            best = assign(v)
            out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label, sha))
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    return [(i, code, error, total[label], sha) for i, code, error, label, sha in out]


@pytest.mark.parametrize("width,block,count", [(16, 512, 120), (16, 7, 120), (11, 3, 90), (3, 5, 60), (8, 4, 9)])
def test_vector_codes(spark, width, block, count):
    rows = vector_rows(width, count, width)
    rng = random.Random(1)
    labels = [rng.choice([None, None, 1, 2, i]) for i in range(len(rows))]
    got = vector_codes.compress(vectors(spark, rows, labels), block=block).collect()
    assert in_order(got) == in_order(codes_by_brute_force(rows, labels))


def test_vector_codes_of_large_and_no_components(spark):
    rows = [(i, [float((-1) ** i * (2**17 + i * 2**10)), float(i % 3)]) for i in range(20)]
    got = vector_codes.compress(vectors(spark, rows), parts=2, entries=4, rounds=2, block=3).collect()
    assert in_order(got) == in_order(codes_by_brute_force(rows, [None] * 20, 2, 4, 2))
    assert vector_codes.compress(vectors(spark, [])).collect() == []
    assert vector_codes.compress(vectors(spark, [(1, None)])).collect() == []


def test_shortlists_hold_every_nearest_entry_and_leave_others_out():
    rng = np.random.default_rng(2)
    shorter = 0
    for _ in range(200):
        y = rng.integers(-9, 9, 3) + rng.integers(0, 5, (6, 3))
        entries = rng.integers(-12, 12, (8, 3))
        among = vector_codes.shortlist(y.min(0), y.max(0), entries)
        away = ((y[:, None] - entries[None]) ** 2).sum(2)
        assert {int(k) for k in np.argwhere(away == away.min(1, keepdims=True))[:, 1]} <= set(among.tolist())
        code, error = vector_codes.nearest(y, entries, among)
        assert (code == away.argmin(1)).all() and (error == away.min(1)).all()
        shorter += len(among) < 8
    assert shorter > 150


def test_repeatable_rows(spark):
    frame = vectors(spark, vector_rows(4, 30, 8))
    a, b = (in_order(vector_codes.compress(f).collect()) for f in (frame, frame.repartition(2, F.rand(1))))
    assert a == b
