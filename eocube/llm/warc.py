"""WARC archives of pages and a global capture index.

Records are written by Spark's own text writer, with the record terminator
CR LF CR LF as the line separator, so archives can go to any store Spark can
write to; each file is one gzip stream. Records whose payload was seen before
(smallest page id first) are revisits of identical payload digest.

Reading streams each archive through Spark's text reader, cut at the record
terminator, and puts records together again by Content-Length, so that no more
than one record is held and an archive of any size is read. Payload digests are
checked; each RUN entries of a file are one locally sorted run. The index merge
is external:
splitters cut the key space (URL key, timestamp, page id) into ranges, each run
sends one packed sorted segment to each range, and a range merges its segments
with a loser tree. Ranges follow one another, so their concatenation is the
globally ordered capture history. The key ends with the page id, so a URL or
host that has a third of the captures is still cut into many ranges. ``history``
is an entry's place in the whole of it.

Defined results: a null html is an empty payload; a null url has no target and
sorts first; line breaks in a url are percent-encoded; a null page id is never
the smallest of its group unless all are; rows that repeat id and payload are
all responses if theirs is the smallest id; a very long html is one record,
which must fit a worker.
"""

from __future__ import annotations

import base64
import hashlib
import pickle
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch, careful

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
SAMPLE, RUN = 20_000, 50_000
ENTRY = "run string, seq long, url_key string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
FIELDS = [x.split()[0] for x in ENTRY.split(", ")]


def url_key(url: str | None) -> str:
    """Host labels in reverse, then path and query: captures of a domain are neighbours."""
    if not url:
        return ""
    rest = url.partition("://")[2] or url
    cut = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].partition("#")[0]
    return ",".join(reversed(host.rpartition("@")[2].split("."))) + ")" + (path or "/")


def _records(batches):
    for b in batches:
        out = []
        for page, url, when, html, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "timestamp", "html", "first")), strict=True):
            body = html.encode()
            digest = _digest(body)
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}{END}"
            again = first is not None and first != page
            head = ["WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}", f"WARC-Record-ID: <urn:x-page:{'null' if page is None else page}>", f"WARC-Date: {when}"]
            if url is not None:
                head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
            if again:
                head += [f"WARC-Refers-To: <urn:x-page:{first}>", f"WARC-Profile: {PROFILE}"]
            head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if again else len(body))}"]
            out.append("\r\n".join(head) + END + http + ("" if again else html))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str | None = None, least_bytes: int = 0) -> None:
    """Write a record for each page. Payloads under ``least_bytes`` are always stored in full."""
    when = F.coalesce(F.date_format(time_col, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(EPOCH)) if time_col else F.lit(EPOCH)
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), when.alias("timestamp"), F.coalesce(html_col, F.lit("")).alias("html"))
    src = src.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    first = src.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"))
    marked = src.join(first, "digest", "left").select("page_id", "url", "timestamp", "html", "first")
    with careful(pages.sparkSession):
        marked.mapInArrow(_records, "value string").write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 20_000).mode("overwrite").text(path)


def parse(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive that isn't compressed, from any cuts of its bytes.

    Names of headers are in lower case. The last record may lack its terminator or a
    part of it: a reader that cuts at the terminator doesn't tell whether one followed.
    """
    held, head, need = bytearray(), None, 0
    for piece in pieces:
        held += piece
        while True:
            if head is None:
                stop = held.find(b"\r\n\r\n")
                if stop < 0:
                    break
                fields = (x.partition(":") for x in held[:stop].decode(errors="replace").split("\r\n")[1:])
                head = {k.strip().lower(): v.strip() for k, _, v in fields}
                if "content-length" not in head:
                    raise ValueError(f"a record without Content-Length: {bytes(held[:80])!r}")
                need = int(head["content-length"])
                del held[: stop + 4]
            if len(held) < need + 4:
                break
            if held[need : need + 4] != b"\r\n\r\n":
                raise ValueError(f"no end of record after {head.get('warc-record-id')}")
            yield head, bytes(held[:need])
            del held[: need + 4]
            head = None
    if head is not None and len(held) >= need and b"\r\n\r\n".startswith(bytes(held[need:])):
        yield head, bytes(held[:need])
    elif head is not None or held:
        raise ValueError("the archive ends within a record")


def _digest(body: bytes) -> str:
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def _page(urn: str | None) -> int | None:
    number = (urn or "null").rstrip(">").rpartition(":")[2]
    return None if number == "null" else int(number)


def order(e: tuple) -> tuple:
    """The index's order: URL key, timestamp, page id (null last), run and place."""
    return (e[2], e[3], e[4] is None, e[4] or 0, e[0], e[1])


def _entry(path: str, seq: int, head: dict[str, str], block: bytes) -> tuple:
    http, _, body = block.partition(b"\r\n\r\n")
    kind = head["warc-type"]
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    size = int(stated[1]) if stated else len(body)
    digest = head["warc-payload-digest"].removeprefix("sha1:") if "warc-payload-digest" in head else _digest(body)
    if kind == "response" and (len(body) != size or _digest(body) != digest):
        raise ValueError(f"{path}: record {seq} does not match its payload digest")
    return url_key(head.get("warc-target-uri")), head["warc-date"], _page(head["warc-record-id"]), size, digest, kind, _page(head.get("warc-refers-to")) if kind == "revisit" else None


def _entries(batches, most: int = RUN):
    """Sorted runs of at most ``most`` entries; the pieces of a file come in its order, one file after another."""

    def pieces():
        for b in batches:
            yield from zip(b.column("path").to_pylist(), b.column("piece").to_pylist(), strict=True)

    for path, own in groupby(pieces(), lambda x: x[0]):
        name, rows, part = path.rpartition("/")[2], [], 0
        raw = (b"\r\n\r\n" * (i > 0) + x for i, (_, x) in enumerate(own))  # what the reader took out stands between pieces
        for seq, (head, block) in enumerate(parse(raw)):
            if head["warc-type"] not in ("response", "revisit"):  # warcinfo, request and other records of other writers
                continue
            rows.append((f"{name}#{part}", seq, *_entry(path, seq, head, block)))
            if len(rows) == most:
                yield _batch(sorted(rows, key=order))
                rows, part = [], part + 1
        if rows:
            yield _batch(sorted(rows, key=order))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[x.split()[1]]) for c, x in zip(zip(*rows, strict=True) if rows else [()] * len(FIELDS), ENTRY.split(", "), strict=True)], FIELDS)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives in a folder, as sorted runs."""
    pieces = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path)  # gzip can't be split: a file is one task's
    return pieces.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece")).mapInArrow(_entries, ENTRY)


class LoserTree:
    """Merges k sorted sequences; each step replays one path of the tournament."""

    def __init__(self, runs: list[list], key):
        self.runs, self.at, self.key = runs, [0] * len(runs), key
        self.k = max(1, len(runs))
        self.heads = [key(r[0]) if r else None for r in runs] or [None]
        self.loser = [-1] * self.k
        winner = [0] * (2 * self.k)
        for i in range(self.k):
            winner[self.k + i] = i
        for node in range(self.k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.loser[node] = (a, b) if self._before(a, b) else (b, a)
        self.top = winner[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def __iter__(self):
        while self.heads[self.top] is not None:
            i = self.top
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self.key(self.runs[i][self.at[i]]) if self.at[i] < len(self.runs[i]) else None
            node = (self.k + i) // 2
            while node:
                if self._before(self.loser[node], i):
                    self.loser[node], i = i, self.loser[node]
                node //= 2
            self.top = i


def _segments(splits: list[tuple], most: int = 50_000):
    def run(batches):
        def cut(name, rows):
            cuts = [bisect_right(splits, order(r)[:4]) for r in rows]
            lo = 0
            while lo < len(rows):
                hi = bisect_right(cuts, cuts[lo], lo)
                yield cuts[lo], name, hi - lo, zlib.compress(pickle.dumps(rows[lo:hi], 5), 1)
                lo = hi

        def pack(rows):
            got = list(cut(rows[0][0], rows))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int32()), pa.array([x[1] for x in got], pa.string()), pa.array([x[2] for x in got], pa.int64()), pa.array([x[3] for x in got], pa.binary())], ["range", "run", "n", "body"])

        held: list[tuple] = []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (held[-1][0] != r[0] or len(held) == most):
                    yield pack(held)
                    held = []
                held.append(r)
        if held:
            yield pack(held)

    return run


def _merge(table: pa.Table) -> pa.Table:
    runs = [pickle.loads(zlib.decompress(x)) for x in table.column("body").to_pylist()]
    rows = list(LoserTree(runs, order))
    out = pa.Table.from_batches([_batch(rows)])
    return out.add_column(0, "place", pa.array(range(len(rows)), pa.int64())).add_column(0, "range", pa.array([table.column("range")[0].as_py()] * len(rows), pa.int32()))


def merge_index(entries: DataFrame, scratch: Scratch) -> DataFrame:
    """The runs as one capture history: history is the place in it (from 0), range and place how it was merged, then the fields of an entry.

    ``entries`` must be stored: it is read for the splitters (a sample of a
    bounded number of keys) and again for the segments.
    """
    spark = entries.sparkSession
    n = entries.count()
    every = max(1, n // SAMPLE)
    keys = entries.where(F.pmod(F.xxhash64("run", "seq"), F.lit(every)) == 0).select("url_key", "timestamp", F.col("page_id").isNull(), F.coalesce("page_id", F.lit(0))).limit(2 * SAMPLE).collect()
    keys = sorted(tuple(k) for k in keys)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []
    packed = scratch.keep(entries.mapInArrow(_segments(splits), "range int, run string, n long, body binary"), "segments")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each range
    first = packed.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    merged = packed.groupBy("range").applyInArrow(_merge, f"range int, place long, {ENTRY}")
    return merged.join(first, "range").select((F.col("first") + F.col("place")).alias("history"), *merged.columns)


def archive_round_trip(pages: DataFrame, scratch: Scratch | None = None, **options) -> DataFrame:
    """Write the pages, read the archives back, and merge their index."""
    scratch = scratch or Scratch(pages.sparkSession, "warc")
    write_archives(pages, f"{scratch.path}/archives", **options)
    runs = scratch.keep(read_archives(pages.sparkSession, f"{scratch.path}/archives"), "runs")
    return merge_index(runs, scratch)
