"""WARC archives of pages, and their global index by merging locally sorted runs.

Writing: equal payloads of at least ``least`` bytes are stored once, as a response of
the largest page id; the others become revisit records that refer to it.  Records are
built by string functions and written by Spark's own text writer, gzip-compressed, so
commit and retry are Spark's.

Reading: every archive is parsed by the records' declared lengths (never by looking
for separators in payloads) and gives one capture run, sorted by URL key, timestamp
and page id.  The runs are stored, dealt out by ranges of that whole key, so captures
of one hot URL spread over several ranges, and each range merges its runs with a loser
tree.  The ranges in order are the globally ordered capture histories.

Defined results: NULL html is an empty payload; a NULL URL becomes ``urn:none``; line
breaks in a URL are percent-encoded; rows with a NULL page id are responses that no
record refers to; repeated rows of the largest id are all responses; other columns are
not read; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import staged
from stratiform.operators.joins import sized_join

LEAST_BYTES = 1000
RECORDS_PER_FILE = 2000
INDEX = ("urlkey string, captured string, page_id bigint, record_type string, refers_to bigint, "
         "payload_digest string, payload_bytes bigint, archive string, offset bigint, length bigint")
_ORDER = ("urlkey", "captured", "page_id")
CRLF = "\r\n"


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, records_per_file: int = RECORDS_PER_FILE,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   first_capture: str = "2020-01-01T00:00:00Z") -> None:
    """Write one WARC record per row under ``path``; page ``i`` is captured ``i`` seconds after ``first_capture``."""
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("urn:none")), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), url.alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("bigint").alias("bytes"),
                       F.sha1(F.encode("payload", "UTF-8")).alias("digest"))
    repeated = (rows.where((F.col("bytes") >= least) & F.col("page_id").isNotNull()).groupBy("digest", "bytes")
                .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))
    rows = sized_join(rows, repeated, ["digest", "bytes"], "left")
    revisit = F.coalesce(F.col("page_id") != F.col("kept"), F.lit(False))
    seconds = F.unix_timestamp(F.lit(first_capture).cast("timestamp")) + F.coalesce("page_id", F.lit(0))
    date = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record_id = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(CRLF + "WARC-Record-ID: "), record_id(F.col("page_id")),
        F.lit(CRLF + "WARC-Date: "), date, F.lit(CRLF + "WARC-Target-URI: "), F.col("url"),
        F.lit(CRLF + "WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(CRLF + "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                                       + CRLF + "WARC-Refers-To: "), record_id(F.col("kept")))).otherwise(F.lit("")),
        F.lit(CRLF + "Content-Type: application/http; msgtype=response" + CRLF + "Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(CRLF + CRLF))
    # a record ends with two line ends; the writer adds the second
    (rows.select(F.concat(head, block, F.lit(CRLF)).alias("value")).write.option("lineSep", CRLF)
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def url_key(url: str) -> str:
    """The sortable form of a URL: host parts reversed, then path and query."""
    try:
        parts = urlsplit(url)
        host = parts.hostname
        port = parts.port
    except ValueError:
        return url
    if not host:
        return url
    key = ",".join(reversed(host.lower().split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def parse_records(data: bytes):
    """(offset, length, headers, block) of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at)
        lines = data[at:cut].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at offset {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = cut + 4
        end = begin + int(headers["content-length"])
        if end + 4 > len(data) or data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at offset {at} is cut short")
        yield at, end + 4 - at, headers, data[begin:end]
        at = end + 4


def _page(urn: str | None) -> int | None:
    name = urn.removeprefix("<urn:x-page:").removesuffix(">") if urn else "none"
    return None if name == "none" else int(name)


def _entry(archive: str, offset: int, length: int, headers: dict, block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(fields[b"content-length"])
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{archive}: the payload at offset {offset} is damaged")
    return (url_key(headers["warc-target-uri"]), headers["warc-date"], _page(headers["warc-record-id"]), kind,
            _page(headers.get("warc-refers-to")), digest, size, archive, offset, length)


def _columns(entries: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in INDEX.split(", ")]
    kinds = [pa.int64() if c.endswith("bigint") else pa.string() for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([e[i] for e in entries], k) for i, k in enumerate(kinds)], names)


def _key(entry: tuple) -> tuple:
    return entry[0], entry[1], -1 if entry[2] is None else entry[2]


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """One locally sorted run of index entries per archive below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = zlib.decompress(content.as_py(), wbits=31)
                entries = sorted((_entry(archive, *r) for r in parse_records(data)), key=_key)
                if entries:
                    yield _columns(entries)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return archives.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content").mapInArrow(run, INDEX)


class LoserTree:
    """A k-way merge: inner nodes hold the loser of each match, the overall winner leaves next."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.heads = [(0, key(r[0])) if r else (1,) for r in runs]  # (1,): exhausted, loses every match
        self.loser = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if (self.heads[b], b) < (self.heads[a], a):
            a, b = b, a
        self.loser[node] = b
        return a

    def __iter__(self):
        while self.k and self.heads[self.winner] != (1,):
            w = self.winner
            run = self.runs[w]
            yield run[self.at[w]]
            self.at[w] += 1
            self.heads[w] = (0, self.key(run[self.at[w]])) if self.at[w] < len(run) else (1,)
            node = (w + self.k) // 2
            while node:
                other = self.loser[node]
                if (self.heads[other], other) < (self.heads[w], w):
                    self.loser[node], w = w, other
                node //= 2
            self.winner = w


def merge_runs(runs: DataFrame) -> DataFrame:
    """All entries in global order: by ranges of the key, and within a range by merging its runs."""
    names = runs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[tuple]] = {}
        for batch in batches:
            for entry in zip(*(batch.column(names.index(c.split()[0])).to_pylist() for c in INDEX.split(", "))):
                by_run.setdefault(entry[7], []).append(entry)
        for entries in by_run.values():
            if any(_key(a) > _key(b) for a, b in zip(entries, entries[1:])):
                entries.sort(key=_key)  # a run whose blocks arrived out of order
        some: list[tuple] = []
        for entry in LoserTree([by_run[r] for r in sorted(by_run)], _key):
            some.append(entry)
            if len(some) >= 10_000:
                yield _columns(some)
                some = []
        if some:
            yield _columns(some)

    return runs.repartitionByRange(*_ORDER).mapInArrow(run, INDEX)


def capture_histories(spark: SparkSession, path: str) -> DataFrame:
    """The globally ordered index of all archives below ``path``."""
    return merge_runs(staged(capture_runs(spark, path), "capture-runs"))
