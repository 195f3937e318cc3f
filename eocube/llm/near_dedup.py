"""MinHash near-dedup: a chosen-path set similarity join.

Documents are sets of word shingles. In each of several independent trees a
document follows the path of its own minwise tokens, drawn in the tree's own
order; documents that share a path prefix form a node. A small node is compared
exhaustively. In a large one every member is compared with the node's leader,
and the node branches by the next token; pairs found further down are confirmed
only where leaders don't tie their ends together. With similarity s, two documents share
a path of length d with probability s**d, so the number of trees follows from
the target recall and from the depth at which nodes are small. That depth comes
from the data: a document whose nodes are still large at EXPECTED_DEPTH (it
shares much with very many others, boilerplate for instance) gets as many more
trees as its own depth asks for.

All nodes of all trees are read off one global sort by (tree, path, salt): equal
prefixes are neighbours, a node of any size is cut evenly between partitions,
and no key decides how many rows a task gets. A piece of a cut node has its own
leader, and pieces differ from tree to tree, so a group of copies that fills a
third of the table is still tied together. A partition has PART_ROWS paths or
more, so that a cut rarely falls into a small node, on small tables too. Sketches only filter candidates; a
link counts when the full sets, built again from both texts, confirm it.

A large group of near copies has members at its fringe that are linked to few
others and to no leader. So members of large nodes that resemble a leader meet a
second time, with their full sets, in nodes of a few more trees: there all that
aren't in the node's largest component are compared with all others, and what is
linked by then is left alone. A node is cut into pieces, and all pairs of pieces
meet but those within the largest component, so a node of any size is compared
as a whole, PIECE rows or PIECE_BYTES of their sets at a time.

Memory: a worker holds a megabyte of text (a longer document: that one, about
forty bytes for each of its bytes), NODE_ROWS paths, or two pieces. A pair's
texts are shipped together; only candidates are, and they are about equally long.

Defined results: a null text is an empty one; a document without words has no
shingles and no link; a row whose id is null takes no part (component null, kept);
rows that repeat an id are one document for links and are all returned.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .scratch import Scratch
from .sieve import sieve
from .text import LOWER, NO_ID, WHITE, documents, mix, spread, tidy, window_hashes, word_hashes, words

TOKENS = 128
DEPTH = 12
SMALL = 16
PIECE, PIECE_BYTES = 1024, 4 << 20
NODE_ROWS, PART_ROWS = 1 << 17, 1 << 14
AGAIN = 10
COLUMNS = 2048
EXPECTED_DEPTH = 3
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(77))
_MULT = _rng.integers(1, 2**63, TOKENS, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _rng.integers(0, 2**63, TOKENS, dtype=np.uint64)


def trees_for(recall: float, threshold: float, depth: int = EXPECTED_DEPTH) -> int:
    """Independent trees after which a pair at the threshold is missed with probability 1 - recall at most."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth)))


def shingle_sets(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, and their offsets."""
    buf = LOWER[buf]
    starts, ends, first = words(buf, offs, WHITE)
    w = word_hashes(buf, starts, ends)
    n = np.diff(first)
    grams = window_hashes(w, size)
    count = np.where(n >= size, n - size + 1, 0)
    h = grams[spread(first[:-1], count)]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):  # the whole sequence is the only shingle
        whole = np.array([window_hashes(w[first[i] : first[i + 1]], int(n[i]))[0] for i in short], _U)
        at = np.concatenate([[0], np.cumsum(count)])[short]
        h = np.insert(h, at, whole)
        count = count.copy()
        count[short] = 1
    doc = np.repeat(np.arange(len(n)), count)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=len(n)))]).astype(np.int64)


def signatures(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The minwise tokens of each set that isn't empty: uint32 [sets, TOKENS]."""
    out = np.empty((len(offs) - 1, TOKENS), np.uint32)
    lo = 0
    while lo < len(offs) - 1:  # a few sets at a time, so that the work stays in the cache
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + 16384, "right")) - 1)
        part, at = h[offs[lo] : offs[hi]], offs[lo:hi] - offs[lo]
        for i in range(TOKENS):
            out[lo:hi, i] = np.minimum.reduceat(part * _MULT[i] + _ADD[i], at) >> _U(32)
        lo = hi
    return out


def _sign(size: int):
    def run(batches):
        for ids, buf, offs in documents(batches):
            h, at = shingle_sets(buf, offs, size)
            n = np.diff(at)
            key = [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)]
            some = np.flatnonzero(n)
            sig = [None] * len(n)
            for i, s in zip(some, signatures(h, np.append(at[some], at[-1])), strict=True):
                sig[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "set_key", "signature"])

    return run


def sketch(sig: np.ndarray) -> np.ndarray:
    """Two bits of each token: [sets, TOKENS // 4] bytes."""
    return np.concatenate([np.packbits((sig >> np.uint32(k)) & np.uint32(1) != 0, axis=1) for k in (0, 1)], axis=1)


def _paths(first: int, most: int):
    """Paths in the trees from number ``first`` on: as many trees as each row says, ``most`` of them at most."""
    orders = [np.random.Generator(np.random.PCG64(1000 + t)).permutation(TOKENS)[:DEPTH] for t in range(most)]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            every = np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint32).reshape(-1, TOKENS)
            trees = b.column("trees").to_numpy(zero_copy_only=False)
            packed = pa.array([x.tobytes() for x in sketch(every)], pa.binary())
            for t in range(first, most):
                some = np.flatnonzero(trees > t)
                n = len(some)
                if not n:
                    continue
                path = np.ascontiguousarray(every[some][:, orders[t]]).astype(">u4").view(np.uint8).reshape(n, DEPTH * 4)
                salt = mix(ids[some].astype(_U) ^ _U(t * 7919 + 1)).astype(">u8").view(np.uint8).reshape(n, 8)
                keys = np.concatenate([np.full((n, 1), t, np.uint8), path, salt], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in keys], pa.binary()), pa.array(ids[some], pa.int64()), packed.take(pa.array(some))], ["k", "doc_id", "sketch"])

    return run


def _floor(threshold: float) -> int:
    """Matching sketch positions that all but one in a million pairs at the threshold reach."""
    p = threshold + (1 - threshold) / 4
    return max(0, math.floor(TOKENS * p - 4.75 * math.sqrt(TOKENS * p * (1 - p))))


#: Matching sketch positions of sets that share half of what they have, less two deviations.
RESEMBLE = 69
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    half = TOKENS // 8
    return TOKENS - _POP[x[..., :half] | x[..., half:]].sum(axis=-1, dtype=np.int32)


def _nodes(least: int, most: int):
    def search(key, ids, sk):
        """Rows (u, v, depth) of sorted paths: candidates (depth 0, or -1 within a large node), and documents with themselves.

        A document with itself at depth 0 is in a large node and resembles its
        leader; at another depth it says how deep its node was before it was small.
        """
        n, out = len(ids), []
        rank = mix(ids.astype(_U))  # one order for all nodes, so the same documents lead again and again
        tokens = key[:, 1 : 1 + 4 * DEPTH].reshape(n, DEPTH, 4).copy().view(np.uint32)[:, :, 0]
        tree = key[:, 0]
        same = np.zeros(n, np.int32)  # tokens shared with the row before
        depths = np.zeros(n, np.int8)
        if n > 1:
            eq = tokens[1:] == tokens[:-1]
            same[1:] = np.where(tree[1:] == tree[:-1], np.where(eq.all(1), DEPTH, eq.argmin(1)), 0)

        def runs(lo, hi, depth):
            inner = np.flatnonzero(same[lo + 1 : hi] < depth) + lo + 1
            edges = np.concatenate([[lo], inner, [hi]])
            wide = np.flatnonzero(np.diff(edges) > 1)
            return [(int(edges[i]), int(edges[i + 1]), depth) for i in wide]

        def found(u, v, depth=0):
            out.append(np.stack([np.minimum(u, v), np.maximum(u, v), np.broadcast_to(depth, len(u))], 1))

        def all_pairs(lo, hi, depth):
            i, j = np.triu_indices(hi - lo, 1)
            good = _alike(sk[lo + i], sk[lo + j]) >= least
            found(ids[lo + i[good]], ids[lo + j[good]], 0 if depth == 1 else -1)

        todo = runs(0, n, 1)
        while todo:
            lo, hi, depth = todo.pop()
            if hi - lo <= SMALL:
                all_pairs(lo, hi, depth)
                continue
            depths[lo:hi] = depth + 1
            lead = lo + int(np.argmin(rank[lo:hi]))
            alike = _alike(sk[lo:hi], sk[lead])
            near = np.flatnonzero(alike >= RESEMBLE) + lo
            if len(near) > SMALL:
                found(ids[near], ids[near])
            good = np.flatnonzero(alike >= least) + lo
            good = good[good != lead]
            found(np.full(len(good), ids[lead]), ids[good])
            if depth < DEPTH:
                todo += runs(lo, hi, depth + 1)
            else:  # alike in every token of the path: blocks in the salt's order
                for a in range(lo, hi, SMALL):
                    all_pairs(a, min(hi, a + SMALL), depth)
        deep = np.flatnonzero(depths > EXPECTED_DEPTH)
        found(ids[deep], ids[deep], depths[deep])
        return np.unique(np.concatenate(out), axis=0)

    def run(batches):
        held: list[tuple] = []

        def flush(last: bool):
            """Search what is held, but for the last node, which may go on in the next batch if it isn't too large."""
            nonlocal held
            key, ids, sk = (np.concatenate(x) for x in zip(*held, strict=True))
            stop = len(ids)
            if not last:
                other = np.flatnonzero((key[:, :5] != key[-1, :5]).any(1))
                stop = int(other[-1]) + 1 if len(other) else stop
            held = [(key[stop:], ids[stop:], sk[stop:])] if stop < len(ids) else []
            got = search(key[:stop], ids[:stop], sk[:stop])
            tidy()
            return pa.RecordBatch.from_arrays([pa.array(got[:, 0], pa.int64()), pa.array(got[:, 1], pa.int64()), pa.array(got[:, 2], pa.int32())], ["u", "v", "depth"])

        for b in batches:
            if b.num_rows:
                held.append((np.frombuffer(b"".join(b.column("k").to_pylist()), np.uint8).reshape(b.num_rows, -1), b.column("doc_id").to_numpy(zero_copy_only=False), np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint8).reshape(b.num_rows, -1)))
                if sum(len(x[1]) for x in held) >= most:
                    yield flush(False)
        if held:
            yield flush(True)

    return run


def _confirm(size: int, percent: int):
    def run(batches):
        for b in batches:
            keep = []
            last, left = None, None
            for i, (u, x, y) in enumerate(zip(b.column("u").to_pylist(), b.column("tu").to_pylist(), b.column("tv").to_pylist(), strict=True)):
                if (u, x) != last:  # rows that repeat an id may have several texts
                    last, left = (u, x), _one(x, size)
                right = _one(y, size)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if both and 100 * both >= percent * (len(left) + len(right) - both):
                    keep.append(i)
            if keep:
                yield b.select(["u", "v"]).take(pa.array(keep))
            tidy()

    return run


def _sets(size: int):
    """Each text's set, and its least token in each of a few more trees."""

    def run(batches):
        for b in batches:
            comp = b.column("comp").to_numpy(zero_copy_only=False)
            lo = 0
            for ids, buf, offs in documents([b]):
                h, at = shingle_sets(buf, offs, size)
                some = np.flatnonzero(np.diff(at))
                sig = signatures(h, np.append(at[some], at[-1]))[:, :AGAIN].astype(np.int64)
                own = [h[at[i] : at[i + 1]].tobytes() for i in some]
                yield pa.RecordBatch.from_arrays([pa.array(ids[some], pa.int64()), pa.array(comp[lo + some], pa.int64()), pa.array(own, pa.binary()), pa.array(list(sig), pa.list_(pa.int64()))], ["doc_id", "comp", "shingles", "tokens"])
                lo += len(ids)

    return run


def _fringe(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, comp = (table.column(c).to_numpy() for c in ("doc_id", "comp"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        links = fringe_links(ids, comp, sets, percent)
        del sets
        tidy()
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})

    return run


def fringe_links(ids: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that tie together what isn't in the largest component yet; each such document is compared with all."""
    if len(ids) < 2 or (comp == comp[0]).all():
        return []
    total, size = len(ids), np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(total), size)
    every, back = np.unique(np.concatenate(sets), return_inverse=True)
    count = np.bincount(back, minlength=len(every))
    labels, at, n = np.unique(comp, return_inverse=True, return_counts=True)
    forest, main, links = Forest(), int(labels[n.argmax()]), []
    loose = np.argsort(n[at], kind="stable")
    loose = loose[comp[loose] != main]
    # shingles that many have are counted as products of matrices, the others by lists of who has them
    often = np.flatnonzero(16 * count > total)
    column = np.full(len(every), -1)
    column[often] = np.arange(len(often))
    column = column[back]
    shared = np.zeros((len(loose), total), np.float32)
    for c in range(0, len(often), COLUMNS):
        some = (column >= c) & (column < c + COLUMNS)
        has = np.zeros((total, min(COLUMNS, len(often) - c)), np.float32)
        has[owner[some], column[some] - c] = 1
        shared += has[loose] @ has.T
    back, owner = back[column < 0], owner[column < 0]
    count[often] = 0
    begin, own = np.cumsum(count) - count, np.bincount(owner, minlength=total)
    first = np.cumsum(own) - own
    owner = owner[np.argsort(back, kind="stable")]
    for k, i in enumerate(loose.tolist()):
        if forest.root(int(comp[i])) == forest.root(main):
            continue
        mine = back[first[i] : first[i] + own[i]]
        both = np.bincount(owner[spread(begin[mine], count[mine])], minlength=total) + shared[k].astype(np.int64)
        for j in np.flatnonzero(100 * both >= percent * (size + size[i] - both)).tolist():
            if j != i and forest.join(int(comp[i]), int(comp[j])):
                links.append((int(ids[i]), int(ids[j])))
    return links


def _meetings(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of ``nodes(tree, token, comp, shingles, ...)`` by the pieces (a, b) in which they meet.

    A node of more than PIECE rows or PIECE_BYTES is cut into pieces of half of
    that, those of its largest component apart from the others. Every piece of
    the others meets every piece of the node, so no link between two components
    falls between pieces.
    """
    sizes = nodes.groupBy("tree", "token", "comp").agg(F.count("*").alias("n"), F.sum(F.length("shingles")).alias("bytes"))
    cut = sizes.groupBy("tree", "token").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.max(F.struct("n", "comp", "bytes")).alias("most"), F.sum("n").alias("total"), F.sum("bytes").alias("bytes"))
    cut = cut.where("total > most.n").withColumns({"own": F.col("most.n"), "own_bytes": F.col("most.bytes")}).drop("most")
    whole = (F.col("total") <= PIECE) & (F.col("bytes") <= PIECE_BYTES)
    pieces = lambda n, size: F.ceil(F.greatest(n / (PIECE // 2), size / (PIECE_BYTES // 2)))
    cut = cut.withColumn("loose", F.when(whole, 1).otherwise(pieces(F.col("total") - F.col("own"), F.col("bytes") - F.col("own_bytes"))))
    cut = cut.withColumn("pieces", F.when(whole, 1).otherwise(F.col("loose") + pieces(F.col("own"), F.col("own_bytes"))))
    cut = scratch.keep(cut.drop("own", "own_bytes", "bytes"), "cut")  # stored, so that the join below can split a node that is far larger than others
    dealt = F.xxhash64("doc_id", "tree")
    settled = (F.col("comp") == F.col("main")) & (F.col("pieces") > 1)
    nodes = nodes.join(cut, ["tree", "token"]).withColumn("piece", F.when(settled, F.col("loose") + F.pmod(dealt, F.col("pieces") - F.col("loose"))).otherwise(F.pmod(dealt, F.col("loose"))))
    others = F.sequence(F.lit(0).cast("long"), F.when(settled, F.col("loose")).otherwise(F.col("pieces")) - 1)
    nodes = nodes.withColumn("other", F.explode(F.filter(others, lambda x: (F.col("pieces") == 1) | (x != F.col("piece")))))
    return nodes.withColumn("a", F.least("piece", "other")).withColumn("b", F.greatest("piece", "other"))


def _untied(pairs: DataFrame, tied: DataFrame) -> DataFrame:
    """Those of ``pairs(u, v)`` whose ends are in different components of ``tied(node, component)``.

    A document's candidates are one row, so joins have a row for each document:
    within large nodes it has SMALL - 1 for each of its trees at most.
    """
    firsts = pairs.groupBy(F.col("u").alias("node")).agg(F.collect_list("v").alias("vs")).join(tied, "node", "left")
    ahead = firsts.select(F.explode("vs").alias("v"), F.struct(F.col("node").alias("u"), F.coalesce("component", "node").alias("c")).alias("first"))
    seconds = ahead.groupBy(F.col("v").alias("node")).agg(F.collect_list("first").alias("firsts")).join(tied, "node", "left")
    other = F.filter("firsts", lambda x: x["c"] != F.coalesce("component", "node"))
    return seconds.select(F.col("node").alias("v"), F.explode(other).alias("f")).select("f.u", "v")


def _one(text: str | None, size: int) -> np.ndarray:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return shingle_sets(raw, np.array([0, len(raw)]), size)[0]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, recall: float = 0.9998, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``shingle`` words make a shingle; two documents are linked when 100 * |A and B|
    >= ``percent`` * |A or B|. ``recall`` is per link at the threshold, before
    components are formed.
    """
    scratch = scratch or Scratch(docs.sparkSession, "near")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = scratch.keep(src.mapInArrow(_sign(shingle), "doc_id long, n_shingles long, set_key binary, signature binary"), "signed")
    known = signed.where((F.col("doc_id") != int(NO_ID)) & F.col("set_key").isNotNull())
    classes = scratch.keep(known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes")
    most_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = [trees_for(recall, percent / 100, d) for d in range(EXPECTED_DEPTH, DEPTH + 1)]

    def grown(rows: DataFrame, size: int, first: int, most: int, name: str) -> DataFrame:
        parts = max(1, min(most_parts, size // PART_ROWS))
        paths = rows.mapInArrow(_paths(first, most), "k binary, doc_id long, sketch binary")
        return scratch.keep(paths.repartitionByRange(parts, "k").sortWithinPartitions("k").mapInArrow(_nodes(_floor(percent / 100), NODE_ROWS), "u long, v long, depth int"), name)

    paths = grown(classes.select(F.col("rep").alias("doc_id"), "signature", F.lit(number[0]).alias("trees")), classes.count() * number[0], 0, number[0], "found")
    # the mean depth over all trees; those that weren't deep in a tree have no row for it
    deep = paths.where("depth > 0").groupBy(F.col("u").alias("rep")).agg(F.sum(F.col("depth") - EXPECTED_DEPTH).alias("more"))
    deep = deep.withColumn("more", F.least(F.round(F.col("more") / number[0]), F.lit(DEPTH - EXPECTED_DEPTH)).cast("int")).where("more > 0")
    alike = paths.where("u = v and depth = 0").select(F.col("u").alias("rep")).distinct()  # these meet again anyway
    deep = scratch.keep(deep.join(alike, "rep", "left_anti"), "deep")
    trees = F.element_at(F.array(*map(F.lit, number)), F.col("more") + 1)
    size = deep.agg(F.sum(trees - number[0])).first()[0]
    if size is not None:
        rows = sieve(classes, deep, "rep").join(deep, "rep").select(F.col("rep").alias("doc_id"), "signature", trees.alias("trees"))
        paths = paths.unionByName(grown(rows, size, number[0], number[-1], "found_deep"))

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        ends = scratch.keep(pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct(), f"{name}_ends")
        texts = scratch.keep(sieve(src, ends, "doc_id").join(ends, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]), f"{name}_texts")
        with_u = pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu")), "u")
        full = with_u.join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv")), "v")
        return scratch.keep(full.select("u", "v", "tu", "tv").mapInArrow(_confirm(shingle, percent), "u long, v long"), name)

    pairs = scratch.keep(paths.where("u <> v").groupBy("u", "v").agg(F.max("depth").alias("depth")), "pairs")
    links = confirmed(pairs.where("depth = 0").select("u", "v"), "links")
    within = pairs.where("depth < 0")
    if within.limit(1).count():  # most members of large nodes are tied by their leaders
        loose = scratch.keep(_untied(within, components(links, scratch, "tied")), "loose")
        if loose.limit(1).count():
            links = links.unionByName(confirmed(loose, "loose_links"))
    again = scratch.keep(paths.where("u = v and depth = 0").select(F.col("u").alias("doc_id")).distinct(), "again")
    if again.limit(1).count():
        tied = components(links, scratch, "first").withColumnRenamed("node", "doc_id")
        marked = again.join(tied, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("comp"))
        texts = sieve(src, again, "doc_id").join(marked, "doc_id").dropDuplicates(["doc_id", "text"])
        sets = scratch.keep(texts.select("doc_id", "text", "comp").mapInArrow(_sets(shingle), "doc_id long, comp long, shingles binary, tokens array<long>"), "sets")
        nodes = sets.select("doc_id", "comp", "shingles", F.posexplode("tokens").alias("tree", "token"))
        # dealt by the pieces too, so that a node of any size is spread
        met = _meetings(nodes, scratch).select("tree", "token", "a", "b", "doc_id", "comp", "shingles")
        fringe = met.repartition("tree", "token", "a", "b").groupBy("tree", "token", "a", "b").applyInArrow(_fringe(percent), "u long, v long")
        links = links.unionByName(scratch.keep(fringe, "fringe"))
    copies = known.join(classes.select("set_key", "rep"), "set_key").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    found = components(links.unionByName(copies.where("u <> v")), scratch)
    out = signed.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    real = F.col("doc_id") != int(NO_ID)
    own = F.coalesce(F.col("component"), F.col("doc_id"))
    return out.select(F.when(real, F.col("doc_id")).alias("doc_id"), "n_shingles", F.when(real, own).alias("component_id"), (~real | (own == F.col("doc_id"))).alias("kept"))
