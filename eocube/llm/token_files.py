"""Token counts of flat token files by a separator scan.

A flat file is nothing but ids, documents one after another, each ended by an
end-of-document id; there is no index. A file is stored as rows (file, block,
ids) of blocks of equal length that know nothing of documents. Each block is
searched for the separator at once; what a block has of a document that begins
or ends elsewhere is stitched with a prefix scan over the blocks' summaries
(separators seen, and where the last one was). The scan has two levels, so a
file of any number of blocks needs no window over all of them in one task.

Defined results: a document without tokens counts 0; what follows the last
separator of a file is a document of its own only if it has tokens (``closed``
is false); a file without ids has no documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import NO_ID, documents
from .tokens import tokenizer

BLOCK_IDS, GROUP_BLOCKS = 1 << 18, 1024
BLOCKS = "file long, block long, ids binary"


def _write(path: str, end_id: int, dtype: str):
    def run(batches):
        part, block, held, at = TaskContext.get().partitionId(), 0, [], 0
        seen = 0

        def row(ids):
            nonlocal block
            block += 1
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([block - 1], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([None], pa.int64()), pa.array([None], pa.int64())], ["file", "block", "ids", "doc", "doc_id"])

        for docs, buf, offs in documents(batches):
            ids, ends = tokenizer(path, True).encode(buf, offs)
            held.append(np.insert(ids, ends[1:], end_id).astype(dtype))
            at, n = at + len(held[-1]), len(docs)
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int64()), pa.array([None] * n, pa.int64()), pa.array([None] * n, pa.binary()), pa.array(range(seen, seen + n), pa.int64()), pa.array(docs, pa.int64())], ["file", "block", "ids", "doc", "doc_id"])
            seen += n
            if at >= BLOCK_IDS:
                flat = np.concatenate(held)
                whole = len(flat) // BLOCK_IDS * BLOCK_IDS
                for s in range(0, whole, BLOCK_IDS):
                    yield row(flat[s : s + BLOCK_IDS])
                held, at = [flat[whole:]], len(flat) - whole
        if at:
            yield row(np.concatenate(held))

    return run


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, dtype: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Flat files of ``docs(doc_id, text)``, one for each task, and the order of documents in them (file, doc, doc_id)."""
    both = scratch.keep(docs.select("doc_id", "text").mapInArrow(_write(tokenizer_path, end_id, dtype), BLOCKS + ", doc long, doc_id long"), "tokens")
    return both.where("ids is not null").select("file", "block", "ids"), both.where("doc is not null").select("file", "doc", F.when(F.col("doc_id") != int(NO_ID), F.col("doc_id")).alias("doc_id"))


def read_flat(spark: SparkSession, path: str, dtype: str = "<u2") -> DataFrame:
    """Raw token files of a folder as blocks."""
    size = np.dtype(dtype).itemsize * BLOCK_IDS

    def run(batches):
        for b in batches:
            for name, raw in zip(b.column("file").to_pylist(), b.column("content"), strict=True):
                body = raw.as_buffer()
                for k, at in enumerate(range(0, body.size, size)):
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([k], pa.int64()), pa.array([body.slice(at, min(size, body.size - at)).to_pybytes()], pa.binary())], ["file", "block", "ids"])

    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file"), "content")
    return files.mapInArrow(run, BLOCKS)


def _scan(end_id: int, dtype: str):
    def run(batches):
        for b in batches:
            cols: dict[str, list] = {"file": [], "block": [], "n": [], "ends": [], "at": []}
            for f, k, raw in zip(*(b.column(c).to_pylist() for c in ("file", "block", "ids")), strict=True):
                ids = np.frombuffer(raw, dtype)
                cols["file"].append(f)
                cols["block"].append(k)
                cols["n"].append(len(ids))
                ends = np.flatnonzero(ids == end_id).astype(np.int64)
                cols["ends"].append(ends.tobytes())
                cols["at"].append(int(ends[-1]) if len(ends) else None)
            yield pa.RecordBatch.from_arrays([pa.array(cols["file"], pa.int64()), pa.array(cols["block"], pa.int64()), pa.array(cols["n"], pa.int64()), pa.array(cols["ends"], pa.binary()), pa.array(cols["at"], pa.int64())], list(cols))

    return run


def _documents(batches):
    """Documents that end in a block, from its separators and what lies before it."""
    for b in batches:
        for f, ends, base, docs, last, tail in zip(*(b.column(c).to_pylist() for c in ("file", "ends", "base", "docs", "last", "tail")), strict=True):
            stop = np.frombuffer(ends, np.int64) + base
            start = np.concatenate([[last + 1], stop[:-1] + 1]) if len(stop) else np.zeros(0, np.int64)
            count, closed = stop - start, np.ones(len(stop), bool)
            if tail is not None:  # the file's last block: ids after its last separator
                begin = (int(stop[-1]) if len(stop) else last) + 1
                if tail > begin:
                    start, count, closed = np.append(start, begin), np.append(count, tail - begin), np.append(closed, False)
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(start), pa.int64()), pa.array(np.arange(docs, docs + len(start)), pa.int64()), pa.array(start, pa.int64()), pa.array(count, pa.int64()), pa.array(closed)], ["file", "doc", "start", "n_tokens", "closed"])


def scan(blocks: DataFrame, end_id: int, dtype: str = "<u2", scratch: Scratch | None = None) -> DataFrame:
    """Documents of flat files: file, doc (from 0), start, n_tokens, closed."""
    scratch = scratch or Scratch(blocks.sparkSession, "tokens")
    seen = scratch.keep(blocks.mapInArrow(_scan(end_id, dtype), "file long, block long, n long, ends binary, at long"), "separators")
    seen = seen.withColumn("m", F.octet_length("ends") / 8).withColumn("grp", F.floor(F.col("block") / GROUP_BLOCKS))
    inner = Window.partitionBy("file", "grp").orderBy("block")
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    own = seen.withColumn("base0", zero(F.sum("n").over(before))).withColumn("docs0", zero(F.sum("m").over(before)))
    own = own.withColumn("last_own", F.col("base0") + F.col("at"))
    own = own.withColumn("last0", F.last("last_own", True).over(before))
    groups = own.groupBy("file", "grp").agg(F.sum("n").alias("gn"), F.sum("m").alias("gm"), F.max("last_own").alias("glast"), F.max("block").alias("gblock"))
    outer = Window.partitionBy("file").orderBy("grp")
    ahead = outer.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("gbase", zero(F.sum("gn").over(ahead))).withColumn("gdocs", zero(F.sum("gm").over(ahead)))
    groups = groups.withColumn("gprev", F.last(F.col("glast") + F.col("gbase"), True).over(ahead)).withColumn("final", F.max("gblock").over(outer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ready = own.join(groups, ["file", "grp"]).select("file", "ends", (F.col("gbase") + F.col("base0")).alias("base"), (F.col("gdocs") + F.col("docs0")).cast("long").alias("docs"), F.coalesce(F.col("last0") + F.col("gbase"), F.col("gprev"), F.lit(-1)).cast("long").alias("last"), F.when(F.col("block") == F.col("final"), F.col("gbase") + F.col("base0") + F.col("n")).alias("tail"))
    return ready.mapInArrow(_documents, "file long, doc long, start long, n_tokens long, closed boolean")


def token_counts(docs: DataFrame, tokenizer_path: str, end_id: int = 49407, id_col: str = "doc_id", text_col: str = "text", dtype: str = "<u2", scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, file, doc, start, n_tokens; counted from the flat files alone.

    Text that spells a special token is ordinary text here, so it never makes a separator.
    """
    scratch = scratch or Scratch(docs.sparkSession, "tokens")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks, names = tokenize(src, tokenizer_path, end_id, dtype, scratch)
    return names.join(scan(blocks, end_id, dtype, scratch), ["file", "doc"]).select("doc_id", "file", "doc", "start", "n_tokens")
