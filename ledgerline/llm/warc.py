"""WARC archives with revisit records, and an external merge of their capture index.

Writing: payload digests are grouped; of equal payloads of at least ``SMALLEST`` bytes
the one with the smallest id is stored as a response and the others as revisits that
point to it.  Records are WARC/1.1; Spark's text sink ends each with the two line breaks
that close a record and compresses the file, so a part file is a ``.gz`` archive.

Reading: archives are parsed by their Content-Length.  Index: the captures of an archive
form a run sorted by URL key and time, and the runs are written.  They are cut at common key
ranges, one for about ``RANGE_CAPTURES`` captures however many there are, and dealt to
merge tasks; Spark brings what a range has of each run together, in the run's order.  A task
keeps its range as Arrow columns and streams its k runs, a few rows of each at a time,
through a loser tree.  The cuts go by key, time, id, archive and offset, so a hot URL, or one
capture repeated, is cut like any other, and the output in range order, with its
positions, is the globally ordered capture history.

Defined cases: a null html is an empty payload; a null url has an empty URL key; a null
id can be no response for others and is never a revisit; repeated rows each get a
record; captures of equal key, time and id keep the order of archive and offset; payloads
may hold anything, WARC headers too; an empty table gives no rows; extra columns are
ignored.  An archive is held whole while it is parsed, so a page larger than
``ARCHIVE_BYTES`` takes its own size a few times over.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordering import in_own_order
from .shipping import map_arrow
from .tables import scratch, staged

SMALLEST = 100
#: bytes of one archive; a reader holds one archive at a time
ARCHIVE_BYTES = 8 << 20
#: captures that a merge task holds, about
RANGE_CAPTURES = 100_000
#: rows of a run that are taken up at once
TAKEN = 256
#: first capture time; pages without a time of their own follow second by second
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
CAPTURES = ("page_id long, url string, url_key string, captured string, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long, archive string, offset long")
_BREAK = "\r\n"


def url_key(url: str | None) -> str:
    """Sortable key of a URL: host labels reversed, then path and query; scheme, www, port and fragment dropped."""
    try:
        parts = urlsplit((url or "").strip())
        host = parts.hostname or ""
    except ValueError:  # no URL: its text is its key
        return (url or "").strip().lower()
    labels = host.removeprefix("www.").split(".")
    path = parts.path.rstrip("/").lower() or "/"
    return ",".join(reversed(labels)) + ")" + path + (f"?{parts.query.lower()}" if parts.query else "")


def classified(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """Each page with its payload digest, record type and the response it refers to."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("payload_bytes", F.octet_length("html").cast("long")) \
         .withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256))
    groups = p.where(F.col("payload_bytes") >= smallest).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # few digests occur twice: they are written once, so their true size decides the join
    groups = staged(groups.select(F.col("payload_digest").alias("digest"), "first"), "warc-groups")
    j = p.join(groups, (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= smallest), "left")
    revisit = F.col("page_id") != F.col("first")
    return j.select("page_id", "url", "html", "payload_bytes", "payload_digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first")).alias("refers_to"))


def _header_safe(c):
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[\r\n]", " ")


def records(pages: DataFrame) -> DataFrame:
    """One WARC record per page, without the two line breaks that end it."""
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, "").otherwise(F.col("html"))
    date = F.date_format(F.timestamp_seconds(F.lit(int(EPOCH.timestamp())) + F.coalesce("page_id", F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
             F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
             F.concat(F.lit("WARC-Date: "), date),
             F.concat(F.lit("WARC-Target-URI: "), _header_safe(F.col("url"))),
             F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
             F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
             F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return pages.select(F.concat(F.concat_ws(_BREAK, *lines), F.lit(_BREAK * 2), block).alias("record"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, smallest: int = SMALLEST) -> None:
    """Write one record per page (page_id, url, html) into archives of about ``archive_bytes``."""
    total, most = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 600), F.count(F.lit(1))).first()
    parts = max(1, -(-int(total or 0) // archive_bytes))
    dealt = records(classified(pages, smallest)).repartition(parts)
    dealt.write.option("lineSep", _BREAK * 2).option("compression", "gzip").text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """Headers, offset and block of every record of an unpacked archive."""
    at = 0
    while at < len(archive):
        body = archive.index(b"\r\n\r\n", at) + 4
        lines = archive[at:body - 4].decode("utf-8", "replace").split(_BREAK)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        end = body + int(headers["Content-Length"])
        yield headers, at, archive[body:end]
        if archive[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end at its Content-Length")
        at = end + 4


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives, each archive a run sorted by URL key and time.

    Payloads of responses are hashed again: a record whose digest does not fit its
    payload fails the read.
    """
    fields = [f.strip().split(" ")[0] for f in CAPTURES.split(",")]

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for h, offset, block in parse(gzip.decompress(content.as_py())):
                    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    if h["WARC-Type"] == "response" and (hashlib.sha256(block).hexdigest() != digest
                                                         or len(block) != int(h["WARC-Payload-Length"])):
                        raise ValueError(f"damaged payload in {name} at byte {offset}")
                    rows.append((_page(h["WARC-Record-ID"]), h["WARC-Target-URI"], url_key(h["WARC-Target-URI"]), h["WARC-Date"],
                                 int(h["WARC-Payload-Length"]), digest, h["WARC-Type"], _page(h.get("WARC-Refers-To")),
                                 name.rsplit("/", 1)[-1], offset))
                rows.sort(key=lambda r: (r[2], r[3], r[0] is not None, r[0] or 0, r[9]))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
                         pa.int64(), pa.string(), pa.int64()]
                for i in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + 4096]), kinds)], names=fields)

    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("path", "content")
    return map_arrow(files, run, CAPTURES)


class LoserTree:
    """Merge k sorted iterators: each inner node holds the loser of its match."""

    def __init__(self, runs: list, key):
        self.runs = [iter(r) for r in runs]
        self.key = key
        self.k = len(self.runs)
        self.heads = [self._pull(i) for i in range(self.k)]
        self.losers = [0] * max(self.k, 1)
        self.winner = self._build(1) if self.k else 0

    def _pull(self, i):
        for row in self.runs[i]:
            return (0, self.key(row), i), row
        return (1, None, i), None  # an exhausted run loses every match

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a][0], self.heads[b][0]
        if x[0] != y[0] or x[0] == 1:
            return (x[0], x[2]) < (y[0], y[2])
        return x < y

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self):
        while self.k:
            (done, _, _), row = self.heads[self.winner]
            if done:
                return
            yield row
            i = self.winner
            self.heads[i] = self._pull(i)
            node = (i + self.k) // 2
            while node:
                if self._beats(self.losers[node], i):
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.winner = i


#: the order of the capture history; the last two tell equal captures apart
HISTORY = ["url_key", "captured", "page_id", "archive", "offset"]


def merged_index(runs: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """The captures of all runs, ordered by URL key and time over the partitions and inside each."""
    ranges = max(1, -(-runs.count() // range_captures))
    dealt = runs.repartitionByRange(ranges, *HISTORY).sortWithinPartitions("archive", *HISTORY)
    url, time, page, name, offset = (runs.columns.index(c) for c in HISTORY)

    def rows_of(pieces):
        for piece in pieces:
            for at in range(0, piece.num_rows, TAKEN):
                yield from zip(*(c.to_pylist() for c in piece.slice(at, TAKEN).columns))

    def merge(batches):
        # a range of the key: what each archive's run has in it, in the run's order
        parts: dict[str, list] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            codes = batch.column(name).dictionary_encode()
            number = codes.indices.to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for a, b in zip(starts[:-1], starts[1:]):
                if b > a:
                    parts.setdefault(codes.dictionary[int(number[a])].as_py(), []).append(batch.slice(a, b - a))
        tree = LoserTree([rows_of(p) for p in parts.values()],
                         lambda r: (r[url], r[time], r[page] is not None, r[page] or 0, r[name], r[offset]))
        out: list = []
        for row in tree:
            out.append(row)
            if len(out) == 4096:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return map_arrow(dealt, merge, runs.schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], names=schema.names)


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages as WARC archives, read them back, and return their merged capture index.

    ``position`` is a capture's place in the history, from 0.
    """
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(p, path, archive_bytes)
    return in_own_order(merged_index(staged(captures(spark, path), "warc-runs")), "position")
