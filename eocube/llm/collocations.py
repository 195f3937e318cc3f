"""Phrases whose words keep together: counts by minimal perfect hashes, cuts read by slot.

Texts are cut into blocks. A block is a stream of words, with a break wherever a
piece ends; what it asks of each length k is the list of its distinct phrases of k
words whose first and last k - 1 words are both frequent (so no frequent phrase is
missed), each with how often the block has it. Lists are dealt to hash buckets: at
the scale of the corpus no worker could hold all candidates, but a bucket holds its
own, whatever there are. A bucket first bounds each phrase's count from above with
an array of counters that phrases share, which leaves few candidates; those get a
minimal perfect hash. The lists look up their slots, the key stored at a slot tells
phrases that are no candidates, and ``bincount`` adds each group of lists up to an
array over the slots; the arrays are summed as a tree. A bucket answers a list with
the slots of its frequent phrases, from which the block makes its next list: a
phrase of k words is the slot of its first k - 1 words and the slot of its last, so
keys are exact from two words on. Words are told apart by 128 bits.

A phrase is in one list of a block once, however common it is, so no bucket is hot;
streams are sent back and forth, never phrases in rows, but for those that are frequent.
Those are joined by their slots with their first and last k - 1 words, which gives
the counts of all parts.

Everything is per language. Defined results: a null text is an empty one; a null
language is ``und``; the ids of documents play no part, so rows that repeat one are
documents like others; an empty table has no phrases; ties in rank go by the phrase's
bytes; a text is never cut, so the longest one must fit a worker. Extra columns may
have any names. More than 2**32 frequent phrases of one length are an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import bucket_of, expand, lists, squeeze
from .perfect_hash import Slots
from .scratch import Scratch
from .text import LOWER, OTHER_BASE, chunks, lut, mix, tidy, word_hashes, words

UND = "und"
#: Words end at a blank or tab, pieces at one of these.
ENDS = [*b".,;:!?", *range(0x0A, 0x0E)]
_IN_WORD = lut([0x20, 0x09, *ENDS])
_ENDS = ~lut(ENDS)
BLOCK_BYTES, BUCKET_BYTES = 3 << 19, 2 << 20
#: Entries of lists that one array of counts is made of.
LEAF = 1 << 18
BREAK = np.uint32(2**32 - 1)
_U = np.uint64
_BLOCK = "block_id long, langs array<string>, n array<long>, count binary, lang binary, size binary, words binary, stream binary"
_COUNTED = "block_id long, bucket int, slots binary, slot long, prefix long, last long, lang string, word string, a long"


def _names(langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [x.encode() for x in langs]
    ends = np.cumsum([len(x) for x in raw])
    buf, starts = np.frombuffer(b"".join(raw), np.uint8), ends - [len(x) for x in raw]
    # mixed once more, else the word "en" of "es" would be the word "es" of "en"
    return mix(word_hashes(buf, starts, ends) + _U(1)), mix(word_hashes(buf, starts, ends, OTHER_BASE) + _U(1))


def _hashes(langs: list[str], lang: np.ndarray, size: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each word, of words that stand one after another in ``letters``."""
    lang_h, lang_g = _names(langs)
    ends = np.cumsum(size, dtype=np.int64)
    starts = ends - size
    return mix(word_hashes(letters, starts, ends) + lang_h[lang]), mix(word_hashes(letters, starts, ends, OTHER_BASE) + lang_g[lang])


def _distinct(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One of each, which of them each is, and how many: sorted by h, which g only tells apart where it must."""
    _, one, inv, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    if len(h) and (g[one][inv] != g).any():
        pair = np.empty(len(h), [("h", "<u8"), ("g", "<u8")])
        pair["h"], pair["g"] = h, g
        _, one, inv, count = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
    return one, inv, count


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows (lang, text): the words they have, and the order in which they have them."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column("lang").dictionary_encode()
        langs, of = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lang_h, lang_g = _names(langs)
        text = batch.column("text").cast(pa.large_binary())
        offs = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
        body = text.buffers()[2]
        buf = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
        for own, raw, at in chunks(of, buf[offs[0] : offs[-1]], offs - offs[0], BLOCK_BYTES):
            low = LOWER[raw]
            starts, ends, first = words(low, at, _IN_WORD)
            lang = np.repeat(own, np.diff(first))
            h = mix(word_hashes(low, starts, ends) + lang_h[lang])
            g = mix(word_hashes(low, starts, ends, OTHER_BASE) + lang_g[lang])
            one, inv, count = _distinct(h, g)
            stop = np.concatenate([[0], np.cumsum(_ENDS[low])])
            apart = np.zeros(len(starts), bool)
            apart[first[:-1][first[:-1] < len(starts)]] = True
            apart[1:] |= stop[starts[1:]] != stop[ends[:-1]]
            stream = np.insert(inv.astype(np.uint32), np.flatnonzero(apart), BREAK)
            size = ends[one] - starts[one]
            letters = low[np.repeat(starts[one] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())] if len(one) else low[:0]
            cells = [squeeze(x) for x in (count.astype(np.uint32), lang[one].astype(np.uint32), size.astype(np.uint32), letters, stream)]
            row = [[(part << 32) | seq], [langs], [np.bincount(lang, minlength=len(langs)).tolist()], *([x] for x in cells)]
            kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], [x.split()[0] for x in _BLOCK.split(", ")])
            seq += 1
        tidy()


def _word_lists(n: int):
    """What blocks ask of words."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                count, lang, size = (expand(r[c], np.uint32) for c in ("count", "lang", "size"))
                letters = expand(r["words"], np.uint8)
                h, _ = _hashes(r["langs"], lang, size, letters)
                at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
                out = [(r["block_id"], k, squeeze(count[s]), squeeze(lang[s]), squeeze(size[s]), squeeze(letters[at[s.start] : at[s.stop]]), r["langs"]) for k, s in lists(h, n)]
                kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], ["block_id", "bucket", "count", "lang", "size", "words", "langs"])
            tidy()

    return run


def _count(keys: list[np.ndarray], others: list[np.ndarray] | None, counts: list[np.ndarray], least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Counts of the frequent keys of a bucket, and for each list where its entries are among those (-1: not).

    ``others`` are the second halves of keys of 128 bits.
    """
    leaves, held = [], 0
    for i, k in enumerate(keys):
        if not held:
            leaves.append([])
        leaves[-1].append(i)
        held = (held + len(k)) if held + len(k) < LEAF else 0
    joined = [(np.concatenate([keys[i] for i in leaf]), np.concatenate([others[i] for i in leaf]) if others else None, np.concatenate([counts[i] for i in leaf]).astype(np.int64)) for leaf in leaves]
    cells = 1 << max(10, int(sum(len(x[0]) for x in joined)).bit_length())
    shared = np.zeros(cells, np.int64)
    for k, _, c in joined:
        np.add.at(shared, (k & _U(cells - 1)).astype(np.int64), c)
    may = [shared[(k & _U(cells - 1)).astype(np.int64)] >= least for k, _, _ in joined]  # at least what each key has
    if others is None:
        stored, other = np.unique(np.concatenate([k[m] for (k, _, _), m in zip(joined, may, strict=True)])), None
        seed = _U(0)
    else:
        pair = np.concatenate([np.stack([k[m], g[m]], 1) for (k, g, _), m in zip(joined, may, strict=True)])
        pair = np.unique(pair, axis=0)
        stored, other, seed = pair[:, 0].copy(), pair[:, 1].copy(), _U(0)
        while len(np.unique(stored ^ mix(other + seed))) < len(stored):
            seed += _U(1)
    code = lambda k, g: k if g is None else k ^ mix(g + seed)
    slots = Slots(code(stored, other))
    place = slots.find(code(stored, other))
    by_slot = np.empty(slots.n, _U)
    by_slot[place] = stored
    if other is not None:
        other_by_slot = np.empty(slots.n, _U)
        other_by_slot[place] = other
    found, arrays = [], []
    for (k, g, c), m in zip(joined, may, strict=True):
        at = np.full(len(k), -1, np.int64)
        if slots.n and m.any():
            got = slots.find(code(k[m], None if g is None else g[m]))
            ok = (got >= 0) & (by_slot[got] == k[m])
            if g is not None:
                ok &= other_by_slot[got] == g[m]
            at[m] = np.where(ok, got, -1)
        found.append(at)
        there = at >= 0
        arrays.append(np.bincount(at[there], weights=c[there], minlength=slots.n).astype(np.int64))  # doubles are exact up to 2**53
    while len(arrays) > 1:
        arrays = [arrays[i] + arrays[i + 1] if i + 1 < len(arrays) else arrays[i] for i in range(0, len(arrays), 2)]
    total = arrays[0] if arrays else np.zeros(0, np.int64)
    often = total >= least
    rank = np.append(np.where(often, np.cumsum(often) - 1, -1), -1)  # -1, a key that has no slot, reads the last
    out = [np.zeros(0, np.int64)] * len(keys)
    for leaf, at in zip(leaves, found, strict=True):
        for i, x in zip(leaf, np.split(rank[at], np.cumsum([len(keys[i]) for i in leaf])[:-1]), strict=True):
            out[i] = x
    return total[often], out


def _shared_bits(n: int) -> int:
    """Bits of a slot that number the phrases of one of ``n`` buckets."""
    return 32 - max(1, (n - 1).bit_length())


def _answers(bucket: int, bits: int, block_ids: list[int], ranks: list[np.ndarray], total: np.ndarray, more: dict) -> pa.Table:
    if len(total) >= (1 << bits) - 1:
        raise ValueError("too many frequent phrases of one length")
    some = [i for i, r in enumerate(ranks) if (r >= 0).any()]
    base = bucket << bits
    cells = [squeeze(np.where(ranks[i] >= 0, base + ranks[i], int(BREAK)).astype(np.uint32)) for i in some]
    n, m = len(some), len(total)
    both = {"block_id": [block_ids[i] for i in some] + [None] * m, "bucket": [bucket] * (n + m), "slots": cells + [None] * m, "slot": [None] * n + [base + i for i in range(m)], "prefix": None, "last": None, "lang": None, "word": None, "a": [None] * n + total.tolist()}
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    types = {x.split()[0]: kinds[x.split()[1]] for x in _COUNTED.split(", ")}
    return pa.table({c: pa.array([None] * n + more[c] if c in more else both[c] or [None] * (n + m), t) for c, t in types.items()})


def _frequent_words(bits: int, least: int):
    def run(t: pa.Table) -> pa.Table:
        counts, codes, sizes = ([expand(x, np.uint32) for x in t.column(c).to_pylist()] for c in ("count", "lang", "size"))
        named, texts = t.column("langs").to_pylist(), [expand(x, np.uint8) for x in t.column("words").to_pylist()]
        keys, others = map(list, zip(*(_hashes(*x) for x in zip(named, codes, sizes, texts, strict=True)), strict=True))
        total, ranks = _count(keys, others, counts, least)
        lang, word = [None] * len(total), [None] * len(total)
        new = np.ones(len(total) + 1, bool)  # the last is read for entries that are not frequent
        for i, r in enumerate(ranks):
            at = np.flatnonzero((r >= 0) & new[r])
            if len(at):
                letters, ends = texts[i].tobytes(), np.cumsum(sizes[i], dtype=np.int64)
                for j in at.tolist():
                    lang[r[j]], word[r[j]] = named[i][codes[i][j]], letters[ends[j] - sizes[i][j] : ends[j]].decode(errors="replace")
                new[r[at]] = False
        tidy()
        return _answers(t.column("bucket")[0].as_py(), bits, t.column("block_id").to_pylist(), ranks, total, {"lang": lang, "word": word})

    return run


def _windows(prefix: np.ndarray, slots: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a block has phrases of ``k`` words whose first and last k - 1 are frequent, and what those phrases are."""
    at = np.flatnonzero((prefix[:-1] != BREAK) & (prefix[1:] != BREAK))
    return at, (prefix[at].astype(_U) << _U(32)) | slots[at + k - 1]


def _phrases(r: dict, k: int):
    slots = expand(r["stream"], np.uint32)
    prefix = expand(r["prefix"], np.uint32) if k > 2 else slots
    at, key = _windows(prefix, slots, k)
    h, one, inv, count = np.unique(mix(key), return_index=True, return_inverse=True, return_counts=True)  # a bijection: as exact as the key
    return slots, at, h, key[one], inv, count


def _phrase_lists(k: int, n: int):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                _, _, h, key, _, count = _phrases(r, k)
                out = [(r["block_id"], x, squeeze(key[s]), squeeze(count[s].astype(np.uint32))) for x, s in lists(h, n)]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], ["block_id", "bucket", "key", "count"])
            tidy()

    return run


def _frequent_phrases(bits: int, least: int):
    def run(t: pa.Table) -> pa.Table:
        exact = [expand(x, _U) for x in t.column("key").to_pylist()]
        total, ranks = _count([mix(x) for x in exact], None, [expand(x, np.uint32) for x in t.column("count").to_pylist()], least)
        key = np.zeros(len(total), _U)
        for x, r in zip(exact, ranks, strict=True):
            key[r[r >= 0]] = x[r >= 0]
        tidy()
        return _answers(t.column("bucket")[0].as_py(), bits, t.column("block_id").to_pylist(), ranks, total, {"prefix": (key >> _U(32)).astype(np.int64).tolist(), "last": (key & _U(2**32 - 1)).astype(np.int64).tolist()})

    return run


def _spell(h: np.ndarray, n: int, got: list[dict] | None) -> np.ndarray:
    """The answers as one slot for each entry of the block's sorted list."""
    out, answers = np.full(len(h), BREAK, np.uint32), {x["bucket"]: x["slots"] for x in got or ()}
    if answers:
        for b, s in lists(h, n):
            if b in answers:
                out[s] = expand(answers[b], np.uint32)
    return out


def _next(k: int, n: int):
    """Blocks with the slots of their phrases of ``k`` words."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                if k == 1:
                    ranks = expand(r["stream"], np.uint32)
                    h, _ = _hashes(r["langs"], *(expand(r[c], t) for c, t in (("lang", np.uint32), ("size", np.uint32), ("words", np.uint8))))
                    spelt = np.append(_spell(h, n, r["got"]), BREAK)
                    slots = spelt[np.minimum(ranks, len(spelt) - 1)]
                    now = None
                else:
                    slots, at, h, _, inv, _ = _phrases(r, k)
                    now = np.full(len(slots), BREAK, np.uint32)
                    now[at] = _spell(h, n, r["got"])[inv]
                some = (slots if now is None else now) != BREAK
                if some.any():  # nothing longer is frequent in a block that has none
                    yield pa.RecordBatch.from_arrays([pa.array([r["block_id"]], pa.int64()), pa.array([squeeze(slots)], pa.binary()), pa.array([None if now is None else squeeze(now)], pa.binary())], ["block_id", "stream", "prefix"])
            tidy()

    return run


def frequent_phrases(docs: DataFrame, scratch: Scratch, lang_col: str = "lang", text_col: str = "text", least: int = 30, longest: int = 4) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n): all words of each language; and for each length the phrases that occur ``least`` times.

    Words are rows (slot, lang, word, a), phrases of k words (slot, prefix, last, a): the slots of
    the first k - 1 words and of the last word.
    """
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UND)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blocks = scratch.keep(src.mapInArrow(_read, _BLOCK), "blocks")
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("stream")), F.lit(0))).first()[0]
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // BUCKET_BYTES))
    bits = _shared_bits(buckets)
    counted = blocks.select(F.explode(F.arrays_zip("langs", "n")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.n").alias("n"))
    totals = scratch.keep(counted, "totals")
    found, now = [], blocks
    for k in range(1, longest + 1):
        if k == 1:
            asked = now.drop("stream", "n").mapInArrow(_word_lists(buckets), "block_id long, bucket int, count binary, lang binary, size binary, words binary, langs array<string>")
            judged = asked.groupBy("bucket").applyInArrow(_frequent_words(bits, least), _COUNTED)
        else:
            asked = now.mapInArrow(_phrase_lists(k, buckets), "block_id long, bucket int, key binary, count binary")
            judged = asked.groupBy("bucket").applyInArrow(_frequent_phrases(bits, least), _COUNTED)
        judged = scratch.keep(judged, f"counted{k}")
        often = judged.where("slot is not null")
        found.append(often.select("slot", "lang", "word", "a") if k == 1 else often.select("slot", "prefix", "last", "a"))
        if k < longest:
            got = judged.where("slots is not null").groupBy("block_id").agg(F.collect_list(F.struct("bucket", "slots")).alias("got"))
            own = now.select("block_id", "langs", "lang", "size", "words", "stream") if k == 1 else now
            after = scratch.keep(own.join(got, "block_id").mapInArrow(_next(k, buckets), "block_id long, stream binary, prefix binary"), f"blocks{k + 1}")
            scratch.drop("blocks" if k == 1 else f"blocks{k}")
            now = after
    return totals, found


def with_parts(found: list[DataFrame], scratch: Scratch) -> list[DataFrame]:
    """Phrases of each length with their text and the counts of their parts.

    ``heads`` and ``tails`` are the counts of the first and last 1, 2, ... words;
    ``inside`` are the phrases of two words and more that lie in it, as slot and length.
    """
    none = F.array().cast("array<long>")
    level = found[0].select("slot", "lang", F.col("word").alias("phrase"), F.col("word").alias("end"), "a", none.alias("heads"), none.alias("tails"), none.alias("inside"), F.lit(None).cast("long").alias("prefix"), F.lit(None).cast("long").alias("last"), F.lit(None).cast("long").alias("suffix"))
    out = [level]
    for k, phrases in enumerate(found[1:], 2):
        left, right = level.alias("p"), level.alias("q")
        both = phrases.alias("f").join(left, F.col("f.prefix") == F.col("p.slot"))
        same = (F.col("q.prefix") == F.col("p.suffix")) & (F.col("q.last") == F.col("f.last")) if k > 2 else F.col("q.slot") == F.col("f.last")
        own = lambda c: F.array(F.shiftleft(F.col(f"{c}.slot"), 3).bitwiseOR(F.lit(k - 1)))  # noqa: E731, B023
        inside = F.array_union(F.array_union("p.inside", "q.inside"), F.array_union(own("p"), own("q"))) if k > 2 else none
        level = both.join(right, same).select(
            "f.slot", "p.lang", F.concat_ws(" ", "p.phrase", "q.end").alias("phrase"), "q.end", "f.a", F.concat("p.heads", F.array("p.a")).alias("heads"), F.concat("q.tails", F.array("q.a")).alias("tails"),
            inside.alias("inside"), "f.prefix", "f.last", F.col("q.slot").alias("suffix"),
        )
        level = scratch.keep(level, f"phrases{k}")
        out.append(level)
    return out


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, longest: int = 4, share: int = 80, scale: int = 2_000_000, most: int = 2000, scratch: Scratch | None = None) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words is cut where a * ``scale`` / (l + r) is least, a being
    how often it occurs and l and r how often its two parts do. Phrases inside a longer one
    that occurs ``share`` percent as often are left out.
    """
    if not 2 <= longest <= 7:
        raise ValueError("phrases have 2 to 7 words at most")
    scratch = scratch or Scratch(docs.sparkSession, "phrases")
    totals, found = frequent_phrases(docs, scratch, lang_col, text_col, least, longest)
    levels = with_parts(found, scratch)[1:]
    whole = levels[0].withColumn("k", F.lit(2))
    for k, x in enumerate(levels[1:], 3):
        whole = whole.unionByName(x.withColumn("k", F.lit(k)))
    cut = f"""array_min(transform(sequence(1, k - 1), j -> named_struct('score',
        cast({int(scale)} as decimal(20,0)) * cast(a as decimal(18,0)) div (element_at(heads, j) + element_at(tails, k - j)),
        'j', j, 'l', element_at(heads, j), 'r', element_at(tails, k - j))))"""
    scored = whole.withColumn("cut", F.expr(cut))
    over = whole.select(F.explode("inside").alias("own"), F.col("a").alias("most_a")).groupBy("own").agg(F.max("most_a").alias("most_a"))
    key = F.shiftleft("slot", 3).bitwiseOR(F.col("k").cast("long"))
    kept = scored.withColumn("own", key).join(over, "own", "left").where(F.col("most_a").isNull() | (F.col("most_a") * 100 < F.col("a") * share))
    rows = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"), F.pmod(F.xxhash64("phrase"), F.lit(32)).alias("part"))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # a language may have a third of all phrases and more: its parts are ranked first
    near = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= most).drop("rank", "part")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
