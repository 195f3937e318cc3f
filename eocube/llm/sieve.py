"""A Bloom sieve of bounded size in front of a semi join that would shuffle whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import mix

MOST_BITS = 1 << 27
SLOTS = 64
_U = np.uint64


def _places(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.astype(np.int64).view(_U) + _U(0x5A5A))
    return (h & _U(bits - 1)).astype(np.int64), ((h >> _U(32)) & _U(bits - 1)).astype(np.int64)


def _mark(bits: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        field = np.zeros(bits, bool)
        for b in batches:
            for at in _places(b.column(0).to_numpy(zero_copy_only=False), bits):
                field[at] = True
        if field.any():
            rows = np.packbits(field).reshape(SLOTS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(SLOTS), pa.int32()), pa.array([x.tobytes() for x in rows], pa.binary())], ["slot", "bits"])

    return run


def _either(table: pa.Table) -> pa.Table:
    rows = [np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()]
    return pa.table({"slot": table.column("slot").slice(0, 1), "bits": pa.array([np.bitwise_or.reduce(rows).tobytes()], pa.binary())})


def sieve(docs: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``key`` may be among ``wanted``: all that are, and a few others.

    The filter has 16 bits a key and never more than ``MOST_BITS`` (16 MB), so
    what goes to the driver and the executors is bounded; with more keys it lets
    more through, and the join that follows stays exact.
    """
    n = wanted.count()
    bits = min(MOST_BITS, max(1 << 13, 1 << (16 * max(n, 1) - 1).bit_length()))
    got = wanted.select(key).coalesce(64).mapInArrow(_mark(bits), "slot int, bits binary").groupBy("slot").applyInArrow(_either, "slot int, bits binary").collect()
    field = np.zeros((SLOTS, bits // 8 // SLOTS), np.uint8)
    for r in got:
        field[r["slot"]] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(field.reshape(-1))

    def run(batches):
        f = shared.value
        for b in batches:
            ids = b.column(key).fill_null(0).to_numpy(zero_copy_only=False)
            good = np.ones(len(ids), bool)
            for at in _places(ids, bits):
                good &= (f[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 != 0
            if good.any():
                yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
