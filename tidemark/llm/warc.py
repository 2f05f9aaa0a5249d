"""WARC archives with revisit records, and a capture index merged from locally sorted runs."""

from __future__ import annotations

import zlib
from urllib.parse import parse_qsl, urlencode, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, text_of, written

#: Equal payloads below this many bytes are stored again rather than referred to.
REVISIT_BYTES = 100
#: Records in one archive at most, which bounds what a reader holds.
ARCHIVE_RECORDS = 20_000
#: The block head of a response, the end of a record, the profile of a revisit.
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = pa.schema([
    ("urlkey", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ("run_pos", pa.int64())])
_INDEX_DDL = ("urlkey string, ts string, page_id long, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long, archive string, offset long, length long, run_pos long")


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, seconds: Column) -> DataFrame:
    """Pages with the digest of their payload and, where an equal one has a smaller identifier, that identifier."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     text_of(html_col).alias("html"), F.coalesce(seconds, F.lit(0)).cast("long").alias("seconds"))
    p = (p.withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256))
         .withColumn("payload_bytes", F.octet_length("html").cast("long")))
    # Only digests that occur again meet the pages, so this side stays slim whatever the size of a group.
    firsts = (p.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return p.join(firsts, "payload_digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))).drop("first_id")


def _record(urn: str) -> Column:
    name = lambda c: F.concat(F.lit(f"<urn:{urn}:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    safe = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    date = F.date_format(F.to_utc_timestamp(F.timestamp_seconds("seconds"), F.current_timezone()),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("refers_to").isNotNull()
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("html")))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("page_id"))), line("WARC-Date", date),
        F.coalesce(line("WARC-Target-URI", safe), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("refers_to")))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archives(pages: DataFrame, place: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", seconds: Column | None = None, urn: str = "page") -> None:
    """Writes one record per row into gzip-compressed WARC files below `place`.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least REVISIT_BYTES bytes the smallest
    identifier is a response, all others revisit it; rows that share that identifier are all responses, and a null
    identifier comes after every other. seconds: capture times since the epoch, 0 by default. Line ends in addresses
    are percent-encoded; a null address has no header. Other columns are not read.
    """
    seconds = F.lit(0) if seconds is None else seconds
    (with_revisits(pages, id_col, url_col, html_col, seconds).select(_record(urn).alias("value"))
     .write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", ARCHIVE_RECORDS).text(place))


def url_key(url: str) -> str:
    """Host labels from the right, then path and sorted query; scheme, `www.`, usual ports and fragments don't count."""
    try:
        u = urlsplit(url.strip())
        host = (u.hostname or "").removeprefix("www.")
        port = f":{u.port}" if u.port not in (None, 80, 443) else ""
        query = urlencode(sorted(parse_qsl(u.query, keep_blank_values=True)))
    except ValueError:
        return url.strip().lower()
    return f"{','.join(reversed(host.split('.')))}{port}){u.path.rstrip('/').lower() or '/'}{'?' + query if query else ''}"


def _number(urn: bytes) -> int | None:
    tail = urn.rsplit(b":", 1)[-1].rstrip(b">")
    return None if tail == b"null" else int(tail)


def _entries(data: bytes, archive: str) -> list[tuple]:
    """The index lines of one archive, read by Content-Length, in the order (urlkey, time, identifier)."""
    from hashlib import sha256

    found, at = [], 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at) + 4
        head = dict(x.split(b": ", 1) for x in data[at:head_end - 4].split(b"\r\n")[1:])
        end = head_end + int(head[b"Content-Length"])
        kind = head[b"WARC-Type"].decode()
        if kind == "response":
            payload = data[data.index(b"\r\n\r\n", head_end) + 4:end]
            size, digest = len(payload), sha256(payload).hexdigest()
            if b"sha256:" + digest.encode() != head[b"WARC-Payload-Digest"]:
                raise ValueError(f"damaged record at {at} of {archive}")
        else:
            size, digest = int(head[b"X-Payload-Length"]), head[b"WARC-Payload-Digest"][7:].decode()
        url = head.get(b"WARC-Target-URI")
        url = None if url is None else url.decode()
        stamp = head[b"WARC-Date"].decode().translate({ord(c): None for c in "-:TZ"})
        refers = _number(head[b"WARC-Refers-To"]) if b"WARC-Refers-To" in head else None
        found.append((url_key(url or ""), stamp, _number(head[b"WARC-Record-ID"]), url, size, digest, kind, refers,
                      archive, at, end - at))
        at = end + 4
    return sorted(found, key=_order)


def _order(e: tuple) -> tuple:
    return e[0], e[1], e[2] is not None, e[2] or 0, e[8], e[9]


def _rows(entries: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*entries), _INDEX)], schema=_INDEX)


def _sorted_runs(batches):
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            data = zlib.decompress(content.as_buffer(), 47)
            if entries := _entries(data, path.as_py()):
                yield _rows([e + (i,) for i, e in enumerate(entries)])


class LoserTree:
    """Merges k sorted lists: each inner node holds the loser of its match, so a step replays one path of log2(k)."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.head = [key(r[0]) if r else None for r in runs]
        self.tree = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._replay(leaf, building=True)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _replay(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.tree[node] < 0 and building:
                self.tree[node] = winner
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while self.k and self.head[w := self.tree[0]] is not None:
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            run = self.runs[w]
            self.head[w] = self.key(run[self.at[w]]) if self.at[w] < len(run) else None
            self._replay(w)


def _merged(batches):
    """One key range: the runs' segments, each contiguous and in order, through a loser tree."""
    runs: dict[str, list] = {}
    for batch in batches:
        for e in zip(*(c.to_pylist() for c in batch.columns)):
            runs.setdefault(e[8], []).append(e)
    ready = []
    for e in LoserTree(list(runs.values()), _order):
        ready.append(e)
        if len(ready) == 10_000:
            yield _rows(ready)
            ready = []
    if ready:
        yield _rows(ready)


def capture_index(spark: SparkSession, place: str) -> DataFrame:
    """The archives' index in global order of (urlkey, ts, page_id): the history of each address, oldest first.

    Every archive gives one sorted run. Sampled splitters cut the keys into ranges (a busy address is cut within its
    history), and each range is merged from its segments of the runs. Null identifiers come first, null addresses have
    an empty key. The rows lie in order within and across partitions. An empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place).select("path", "content")
    runs = written(files.mapInArrow(_sorted_runs, _INDEX_DDL), "runs")
    return (runs.repartitionByRange("urlkey", "ts", "page_id", "archive", "offset")
            .sortWithinPartitions("archive", "run_pos").mapInArrow(_merged, _INDEX_DDL))


def archive_and_index(pages: DataFrame, seconds: Column | None = None, **columns) -> DataFrame:
    """Writes the archives into the shared folder and returns their merged index."""
    place = scratch(pages.sparkSession, "warc")
    write_archives(pages, place, seconds=seconds, **columns)
    return capture_index(pages.sparkSession, place)
