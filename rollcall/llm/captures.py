"""Captures: what one fetch left in the archives, put together from request, response and metadata records.

Writing. ``write_pages`` stores one capture for each page: a response, or a revisit where a page with the same payload is already stored as a response, with a request and a metadata record that
name it in WARC-Concurrent-To. Rows get their identifier in a kept table, so a task that runs again writes the same records. Payloads are compared by SHA-256 and length; of equal payloads of at least
``least`` bytes the row with the largest id is the response (then the largest URL and identifier), found by an aggregate with map-side combining; only payloads that occur twice are joined back.

Reading. ``assemble`` joins records through the concurrent-to identifiers, in both directions, and follows chains (a metadata record may name the request that names the response), one join for each link of
the longest chain. It gives one nested row for each capture. ``resolved`` adds what a revisit refers to.

Rules. A null payload is empty. A null URL leaves the field out. A null id is the smallest; it stays null on reading. Rows with equal id, URL and payload are captures of their own. Of several requests (or
metadata records) of a capture the one with the smallest identifier is nested, and n_requests and n_metadata count all. Records that lead to no response, revisit or resource are captures without a main
record, one for each identifier at the end of their chain (of two records that name each other, the smaller). Records without an identifier, or of other types, are in no capture. Two main records of one
identifier are two rows. A record that leads to several captures belongs to the smallest identifier. An empty table gives no archive records and an empty result. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm import warc
from rollcall.llm.common import drop_folder, kept_at, kept_table
from rollcall.session import fresh_path

#: Fixed values of the format.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAIN, SIDE = ("response", "revisit", "resource"), ("request", "metadata")
DATE = "2020-01-01T00:00:00Z"


def planned(pages: DataFrame, path: str, least: int, id_column: str, url_column: str, payload_column: str) -> DataFrame:
    """id, url, payload, rid and, where another row is the response, its head_rid; the rows are kept at ``path``."""
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col(url_column).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"rid": F.expr("uuid()"), "same": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    rows = kept_at(rows, path, compression="zstd")
    largest = F.max(F.struct("id", "url", "rid")).alias("head")
    heads = rows.where(F.col("bytes") >= least).groupBy("same", "bytes").agg(largest, F.count("*").alias("n")).where("n > 1")
    heads = kept_table(heads.select(F.col("same").alias("of"), F.col("bytes").alias("of_bytes"), "head"), "warc-heads")
    twins = (F.col("same") == F.col("of")) & (F.col("bytes") == F.col("of_bytes"))
    other = F.col("head.rid") != F.col("rid")
    return rows.join(heads, twins, "left").select(
        F.col("id").cast("string"), "url", "payload", "rid", F.when(other, F.col("head.rid")).alias("head_rid")
    )


def host_and_target(url: str) -> tuple[str, str]:
    """What a request for the URL would ask for; of something that is no URL, all of it."""
    try:
        place = urlsplit(url)
    except ValueError:
        return "", url
    return place.netloc, (place.path or "/") + (f"?{place.query}" if place.query else "")


def capture_records(id: str | None, url: str | None, payload: bytes, rid: str, head_rid: str | None) -> list[dict]:
    """The main record of a page, its request and its metadata."""
    main = f"urn:uuid:{rid}"
    url = None if url is None else warc.uri_text(url)
    digest, copy = warc.sha1_base32(payload), head_rid is not None
    host, target = host_and_target(url or "")
    base = {"date": DATE, "target_uri": url, "concurrent_to": [], "refers_to": None, "profile": None, "digest": None, "http": None}
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
    head = {"refers_to": f"urn:uuid:{head_rid}", "profile": SAME_PAYLOAD} if copy else {}
    side = lambda name: f"urn:uuid:{uuid.uuid5(uuid.UUID(rid), name)}"
    about = b"" if id is None else f"pageId: {id}\r\n".encode()
    return [
        base
        | {"type": "revisit" if copy else "response", "record_id": main, "digest": f"sha1:{digest}", "content_type": "application/http;msgtype=response", "http": answer}
        | {"payload": b"" if copy else payload}
        | head,
        base
        | {"type": "request", "record_id": side("request"), "concurrent_to": [main], "content_type": "application/http;msgtype=request"}
        | {"http": f"GET {target} HTTP/1.1\r\nHost: {host}", "payload": b""},
        base | {"type": "metadata", "record_id": side("metadata"), "concurrent_to": [main], "content_type": "application/warc-fields", "payload": about},
    ]


def write_pages(
    pages: DataFrame, path: str, least: int = 0, roll: int = warc.ROLL, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html"
) -> None:
    """Archives of all pages below ``path``."""
    spark = pages.sparkSession
    warc.register(spark)
    staged = fresh_path(spark, "warc-pages")
    plan = planned(pages, staged, least, id_column, url_column, payload_column)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = warc.arrow_schema()
        for batch in batches:
            out, held = [], 0
            for row in batch.to_pylist():
                out += capture_records(**row)
                held += len(row["payload"])
                if held >= warc.BATCH:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    plan.mapInArrow(made, warc.COLUMNS).write.format("warc").option("roll", roll).mode("append").save(path)
    drop_folder(spark, staged)  # the archives hold all of it


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of the archives below ``path``."""
    warc.register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def capture_of(records: DataFrame) -> DataFrame:
    """record_id, capture for each request and metadata record, found through the concurrent-to identifiers."""
    slim = records.where(F.col("record_id").isNotNull()).select("record_id", "type", "concurrent_to")
    named = slim.select("record_id", F.explode("concurrent_to").alias("other")).where("other IS NOT NULL AND other != record_id")
    links = kept_table(named.unionAll(named.select(F.col("other"), F.col("record_id"))).distinct(), "captures-links")
    side = kept_table(slim.where(F.col("type").isin(*SIDE)).select("record_id").distinct(), "captures-side")
    mains = slim.where(F.col("type").isin(*MAIN)).select("record_id").distinct()
    known = reached = kept_table(mains.select("record_id", F.col("record_id").alias("capture")), "captures-known")
    left = side.count()
    while left:
        # only what the last round reached can reach more
        step = links.join(reached.withColumnRenamed("record_id", "other"), "other").groupBy("record_id").agg(F.min("capture").alias("capture"))
        reached = kept_table(step.join(side, "record_id", "left_semi").join(known, "record_id", "left_anti"), "captures-known")
        found = reached.count()
        if not found:
            break
        known, left = known.unionAll(reached), left - found
    if left:
        # chains without a main record: the smallest identifier that is reached stands for the capture
        lost = kept_table(side.join(known, "record_id", "left_anti").withColumn("capture", F.col("record_id")), "captures-lost")
        while True:
            low = links.join(lost.select(F.col("record_id").alias("other"), F.col("capture").alias("low")), "other").groupBy("record_id").agg(F.min("low").alias("low"))
            step = lost.join(low, "record_id", "left").select("record_id", F.least("capture", "low").alias("capture"), F.col("capture").alias("before"))
            step = kept_table(step, "captures-lost")
            lost = step.drop("before")
            if not step.where("capture != before").limit(1).count():
                break
        known = known.unionAll(lost)
    return known.join(side, "record_id", "left_semi")


def assemble(records: DataFrame) -> DataFrame:
    """capture, main, request and metadata (records as structs), n_requests, n_metadata: one row for each capture.

    ``records`` is read several times: hand over a kept table, or archives that are cheap to read again.
    """
    whole = F.struct("record_id", *[c for c in records.columns if c != "record_id"])
    at = kept_table(capture_of(records), "captures-of")
    beside = records.where(F.col("type").isin(*SIDE)).withColumn("record", whole).select("record_id", "type", "record").join(at, "record_id")

    def nested(kind: str, name: str) -> DataFrame:
        # the structs begin with the identifier
        return beside.where(F.col("type") == kind).groupBy("capture").agg(F.min("record").alias(name), F.count("*").alias(f"n_{name}"))

    mains = records.where(F.col("type").isin(*MAIN) & F.col("record_id").isNotNull()).select(F.col("record_id").alias("capture"), whole.alias("main"))
    lone = at.select("capture").distinct().join(mains, "capture", "left_anti").select("capture", F.lit(None).cast(mains.schema["main"].dataType).alias("main"))
    out = mains.unionAll(lone).join(nested("request", "request"), "capture", "left").join(nested("metadata", "metadata"), "capture", "left")
    count = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    return out.select("capture", "main", "request", "metadata", count("n_request", "n_requests"), count("n_metadata", "n_metadata"))


def field(payload, name: str):
    """The value of a field in a block of name: value lines."""
    return F.regexp_extract(payload.cast("string"), rf"(?m)^{name}:[ \t]*([^\r\n]*)", 1)


def resolved(captures: DataFrame) -> DataFrame:
    """capture, page_id, record_type, payload_bytes, payload_digest, refers_to (the page of the record that a revisit refers to) of each capture with a main record."""
    text = field(F.col("metadata.payload"), "pageId")
    flat = captures.where(F.col("main").isNotNull()).select(
        "capture",
        F.when(text != "", text).cast("long").alias("page_id"),
        F.col("main.type").alias("record_type"),
        F.col("main.refers_to").alias("target"),
        F.col("main.payload_bytes").alias("found_bytes"),
        F.col("main.sha1").alias("found_sha1"),
        F.regexp_replace("main.digest", "^sha1:", "").alias("declared"),
    )
    flat = kept_table(flat, "captures-flat")
    firsts = flat.where("record_type != 'revisit'").select(
        F.col("capture").alias("target"), F.col("page_id").alias("first_page"), F.col("found_bytes").alias("first_bytes"), F.col("found_sha1").alias("first_sha1")
    )
    own, again = flat.where("record_type != 'revisit'"), flat.where("record_type = 'revisit'")
    # a revisit whose response lies in other archives keeps its declared digest
    again = again.join(firsts, "target", "left").select(
        "capture", "page_id", "record_type", F.col("first_bytes").alias("payload_bytes"), F.coalesce("first_sha1", "declared").alias("payload_digest"), F.col("first_page").alias("refers_to")
    )
    return own.select(
        "capture", "page_id", "record_type", F.col("found_bytes").alias("payload_bytes"), F.col("found_sha1").alias("payload_digest"), F.lit(None).cast("long").alias("refers_to")
    ).unionAll(again)


def stored_pages(pages: DataFrame, path: str | None = None, least: int = 0) -> DataFrame:
    """Pages written to archives below ``path`` (a fresh one in the shared folder), read back and put together: what :func:`resolved` gives."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc-archives")
    write_pages(pages, path, least)
    found = read_records(spark, path, payload=False)
    return resolved(assemble(kept_table(found, "warc-records")))
