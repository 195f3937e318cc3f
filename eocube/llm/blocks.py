"""Blocks of documents, and exchange of packed lists between blocks and hash buckets.

Operators that look at every window of every document would shuffle far more
than the text if each window were a row. Here a row is a block of one and a half
megabytes of text; for each hash bucket a block sends one sorted, compressed
list, and the bucket answers with one bit for each entry. A window that occurs
everywhere is one entry of each block's list, so no bucket is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import documents, tidy

BLOCK_BYTES = 3 << 19
BLOCK = "block_id long, ids binary, offs binary, body binary"
_U = np.uint64
_zstd = None


def _codec() -> pa.Codec:
    global _zstd
    if _zstd is None:
        _zstd = pa.Codec("zstd", compression_level=1)
    return _zstd


def squeeze(a: np.ndarray) -> bytes:
    """An array, byte planes apart, compressed; its length comes first."""
    raw = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b""
    return len(raw).to_bytes(8, "little") + (_codec().compress(raw, asbytes=True) if raw else b"")


def expand(b: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    if not n:
        return np.zeros(0, dtype)
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(_codec().decompress(b[8:], n, asbytes=True), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def _cut(batches):
    part, seq = TaskContext.get().partitionId(), 0
    for ids, buf, offs in documents(batches, most=BLOCK_BYTES):
        row = [[(part << 32) | seq], [squeeze(ids)], [squeeze(offs)], [squeeze(buf)]]
        yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), *(pa.array(x, pa.binary()) for x in row[1:])], ["block_id", "ids", "offs", "body"])
        seq += 1


def blocks_of(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` as blocks; ids are numbered by task, so the result must be stored before it is read twice."""
    return docs.select("doc_id", "text").mapInArrow(_cut, BLOCK)


def opened(batches: Iterable[pa.RecordBatch]):
    """(row, block_id, ids, bytes, offsets) of each block in ``batches``; row: the other columns."""
    for b in batches:
        for i in range(b.num_rows):
            row = {name: b.column(name)[i].as_py() for name in b.schema.names}
            yield row, row["block_id"], expand(row["ids"], np.int64), expand(row["body"], np.uint8), expand(row["offs"], np.int64)
        tidy()


BUCKET_BYTES = 8 << 20


def buckets_for(blocks: DataFrame) -> int:
    """Hash buckets: several for each shuffle partition, so that they even out, and more where lists would get too long.

    A bucket is one group; its lists take about as much as the compressed text of
    its share of ``blocks``, which must be stored.
    """
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    return max(64, 4 * int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // BUCKET_BYTES))


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Buckets are ranges of the hash, so sorted hashes are sorted by bucket too."""
    return (((h >> _U(32)) * _U(n)) >> _U(32)).astype(np.int64)


def lists(h: np.ndarray, n: int) -> list[tuple[int, slice]]:
    """The slice of each bucket that sorted hashes ``h`` have entries in."""
    b = bucket_of(h, n)
    edge = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else np.zeros(1, np.int64)
    return [(int(b[x]), slice(int(x), int(y))) for x, y in zip(edge[:-1], edge[1:], strict=True)]


def answer(rows: DataFrame, judge: Callable[[list[np.ndarray], list[np.ndarray]], list[np.ndarray]], dtypes: tuple) -> DataFrame:
    """For each bucket of ``rows(bucket, block_id, a, b)``, ``judge`` turns the lists into flags: (block_id, bucket, bits)."""

    def run(table: pa.Table) -> pa.Table:
        a, b = ([expand(x, t) if x is not None else None for x in table.column(c).to_pylist()] for c, t in zip("ab", dtypes, strict=True))
        flags = judge(a, b)
        some = [i for i, f in enumerate(flags) if f.any()]
        return pa.table({"block_id": table.column("block_id").take(pa.array(some, pa.int64())), "bucket": table.column("bucket").take(pa.array(some, pa.int64())), "bits": pa.array([np.packbits(flags[i]).tobytes() for i in some], pa.binary())})

    return rows.groupBy("bucket").applyInArrow(run, "block_id long, bucket int, bits binary")


def answer_rows(rows: DataFrame, columns: list[str], judge: Callable[[int, list[dict]], list[np.ndarray]]) -> DataFrame:
    """The same for rows with any ``columns``: ``judge(bucket, rows)`` gives each row's flags."""

    def run(table: pa.Table) -> pa.Table:
        flags = judge(table.column("bucket")[0].as_py(), table.select(columns).to_pylist())
        some = pa.array([i for i, f in enumerate(flags) if f.any()], pa.int64())
        bits = pa.array([np.packbits(flags[i]).tobytes() for i in some.to_pylist()], pa.binary())
        return pa.table({"block_id": table.column("block_id").take(some), "bucket": table.column("bucket").take(some), "bits": bits})

    return rows.groupBy("bucket").applyInArrow(run, "block_id long, bucket int, bits binary")


def with_answers(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Blocks with all that the buckets answered, in column ``name``."""
    got = answers.groupBy("block_id").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
    return blocks.join(got, "block_id", "left")


def flags(h: np.ndarray, n: int, answers: list[dict] | None) -> np.ndarray:
    """The answers as one flag for each entry of the block's sorted list."""
    out = np.zeros(len(h), bool)
    got = {x["bucket"]: x["bits"] for x in answers or ()}
    if got:
        for k, s in lists(h, n):
            if (bits := got.get(k)) is not None:
                out[s] = np.unpackbits(np.frombuffer(bits, np.uint8), count=s.stop - s.start).astype(bool)
    return out


def twice(a: list[np.ndarray], _b) -> list[np.ndarray]:
    """Entries that lists of at least two blocks have; each list is distinct."""
    every = np.concatenate(a)
    order = np.argsort(every, kind="stable")
    s = every[order]
    same = np.zeros(len(s), bool)
    if len(s) > 1:
        eq = s[1:] == s[:-1]
        same[1:] |= eq
        same[:-1] |= eq
    out = np.empty(len(s), bool)
    out[order] = same
    return np.split(out, np.cumsum([len(x) for x in a])[:-1])


PAIR = np.dtype([("h", "<u8"), ("g", "<u8")])


def elsewhere_earlier_pair(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Entries (hash of 128 bits, key) for which some block has the same hash with a smaller key."""
    both, k = np.concatenate(a), np.concatenate(b)
    order = np.lexsort((k, both["g"], both["h"]))
    h, g, k = both["h"][order], both["g"][order], k[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    least = k[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(h), bool)
    out[order] = least < k
    return np.split(out, np.cumsum([len(x) for x in a])[:-1])
