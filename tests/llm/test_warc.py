import base64
import gzip
import hashlib
import random

import pyarrow as pa
import pytest

from eocube.llm import warc as W

ROWS = [
    (5, "http://B.example.com/x?y#z", "<p>one</p>"), (2, "http://b.example.com/x", "<p>one</p>"), (9, None, "<p>one</p>"), (3, "http://a.example.com/", None), (4, "http://a.example.com/", ""),
    (7, "http://c.org/\r\nX: 1", "body with\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (8, "", "ünï – 日本\x00"), (None, "http://n.org", "<p>null</p>"), (None, "http://n.org", "<p>one</p>"), (2, "http://b.example.com/x", "<p>one</p>"),
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'e' as digest", "'e' as first", "'e' as run").repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark):
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.archive_round_trip(pages(spark, ROWS)).collect()), key=str)
    least = {}
    for p, _, h in ROWS:
        if p is not None:
            least[digest(h)] = min(p, least.get(digest(h), p))
    want = []
    for p, _, h in ROWS:
        first = least.get(digest(h))
        again = first is not None and first != p
        want.append((p, len((h or "").encode()), digest(h), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=str)


def test_least_bytes(spark):
    out = W.archive_round_trip(pages(spark, ROWS), least_bytes=1).where("payload_bytes = 0").collect()
    assert [r.record_type for r in out] == ["response", "response"]


def test_global_order(spark):
    rnd = random.Random(3)
    rows = [(i, f"http://h{rnd.randrange(3)}.example.com/{rnd.randrange(20)}", f"<p>{rnd.randrange(40)}</p>") for i in range(400)]
    out = W.archive_round_trip(pages(spark, rows)).orderBy("range", "place").collect()
    assert [r.history for r in out] == list(range(400))
    keys = [(r.url_key, r.timestamp, r.page_id) for r in out]
    assert keys == sorted(keys) and len(keys) == 400 and len({r.range for r in out}) > 1


def test_empty_table(spark):
    assert W.archive_round_trip(pages(spark, ROWS).limit(0)).count() == 0


def test_archives_are_warc(spark, tmp_path):
    W.write_archives(pages(spark, ROWS), str(tmp_path / "a"))
    records = [r for f in (tmp_path / "a").glob("*.gz") for r in W.parse([gzip.decompress(f.read_bytes())])]
    assert len(records) == len(ROWS)
    for head, block in records:
        assert len(block) == int(head["content-length"]) and head["warc-type"] in ("response", "revisit") and head["warc-record-id"].startswith("<urn:")


def test_an_archive_in_small_runs(spark, tmp_path):
    """Runs of three entries, records over many pieces, and a very long page with record ends in it."""
    rows = [*ROWS, (50, "http://long.org", "x\r\n\r\n" * 200_000 + "\r\n"), (51, "http://long.org", "\r\n\r\n\r\n")]
    W.write_archives(pages(spark, rows), str(tmp_path / "a"))
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "a").glob("*.gz"))
    assert list(W.parse([raw])) == list(W.parse(raw[i : i + 7] for i in range(0, len(raw), 7)))
    cut = raw.split(b"\r\n\r\n")[:-1] if raw.endswith(b"\r\n\r\n") else raw.split(b"\r\n\r\n")
    batch = pa.RecordBatch.from_pydict({"path": ["p"] * len(cut), "piece": cut})
    runs = list(W._entries([batch], 3))
    assert [b.num_rows for b in runs] == [3] * (len(rows) // 3) + [len(rows) % 3] * (len(rows) % 3 > 0) and len({b.column("run")[0].as_py() for b in runs}) == len(runs)
    assert W.read_archives(spark, str(tmp_path / "a")).count() == len(rows)
    with pytest.raises(ValueError, match="ends within"):
        list(W.parse([raw[:-30]]))


TAILS = ["", "\r", "\n", "\r\n", "\n\r\n", "\r\n\r", "\r\n\r\n", "\r\r\n\r\n", "\r\n\r\n\r", "\r\n" * 3, "\r\n" * 4, "...\r\n" * 5]


def test_every_tail(spark, tmp_path):
    """Each tail is the last of a file that Spark writes and reads: a record in each file, and all in one."""
    rows = [(i, f"http://t.org/{i}", f"<p>{i}{x}") for i, x in enumerate(TAILS)] + [(99, "http://t.org/", "\r\n\r\n\r\n")]
    want = sorted((p, len(h), digest(h)) for p, _, h in rows)
    for k, parts in enumerate((len(rows) * 4, 1)):
        W.write_archives(pages(spark, rows).repartition(parts, "page_id"), str(tmp_path / f"{k}"))
        assert sorted(W.read_archives(spark, str(tmp_path / f"{k}")).select("page_id", "payload_bytes", "payload_digest").collect()) == want
    for x in TAILS:
        one = str(tmp_path / f"one{TAILS.index(x)}")
        W.write_archives(pages(spark, [(1, "http://t.org/", "<p>" + x)]), one)
        assert [r.payload_digest for r in W.read_archives(spark, one).collect()] == [digest("<p>" + x)]


def test_records_of_other_writers(spark, tmp_path):
    """Other kinds of records, names in lower case without a blank, no digest and no length of the payload."""
    info = "WARC/1.0\r\nwarc-type:warcinfo\r\nContent-Length: 6\r\n\r\na: b\r\n\r\n\r\n"
    http = "HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hi</p>\r\n"
    page = f"WARC/1.0\r\nwarc-type:response\r\nwarc-record-id:<urn:x-page:7>\r\nwarc-date:2024-01-01T00:00:00Z\r\nwarc-target-uri:http://a.org/\r\ncontent-length:{len(http)}\r\n\r\n{http}\r\n\r\n"
    (tmp_path / "x.gz").write_bytes(gzip.compress((info + page).encode()) + gzip.compress((page + info).replace("page:7", "page:8").encode()))
    got = W.read_archives(spark, str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "url_key").collect()
    assert sorted(map(tuple, got)) == [(i, 11, digest("<p>hi</p>\r\n"), "org,a)/") for i in (7, 8)]


def test_a_changed_payload_is_noticed(spark, tmp_path):
    W.write_archives(pages(spark, ROWS[:1]), str(tmp_path / "a"))
    f = next((tmp_path / "a").glob("*.gz"))
    f.write_bytes(gzip.compress(gzip.decompress(f.read_bytes()).replace(b"<p>one", b"<p>two")))
    (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="digest"):
        W.read_archives(spark, str(tmp_path / "a")).collect()


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rnd = random.Random(k)
    runs = [sorted(rnd.randrange(50) for _ in range(rnd.randrange(0, 12))) for _ in range(k)]
    assert list(W.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)
