"""URL filters: rules first, then the ratio of two character language models.

Accepted and rejected URLs are each modelled by a variable-order Markov chain
over characters: the probability of a byte after its longest known context is
smoothed with that after the next shorter one (Witten-Bell: the more different
bytes a context was followed by, the more weight the shorter one gets). A URL is
judged by the difference of its log-likelihoods, divided by its length, against
a threshold calibrated on labelled URLs kept out of the fit.

Labels come from the rules: URLs that a rule decides, each different one once. Four
fifths of them are counted, the others give the threshold; none is left out. What
tasks count is summed by Spark, and what is broadcast are the sums of contexts, of
long ones those seen at least LEAST times: it grows with the different contexts of
the decided URLs, not with their number.

Defined results: a null URL, or one without ``://``, has empty host and path; it
is judged by the models like any other (a null as an empty text). Without
accepted or rejected examples all undecided URLs are allowed. Repeated and null
page ids are rows like any other; a URL of any length is scored whole (one must
fit a worker, about a hundred bytes for each of its bytes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import columns, mix

ORDER, LEAST = 5, 2
#: Different scores that one task sorts for the threshold.
SORTED = 100_000
_U = np.uint64
#: Lower case: host and path, with the verdict of each.
Rules = dict[str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    lower = F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits; null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


class Chain:
    """Counts of a byte after each context of up to ORDER bytes, by sorted 64-bit hashes.

    The order varies: contexts of more than two bytes are kept only where they
    were seen at least LEAST times.
    """

    def __init__(self):
        self.levels: list[tuple[np.ndarray, ...]] = []

    @staticmethod
    def keys(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each byte's context of ``k`` bytes, and of context and byte; before a text stand zeros."""
        at = np.arange(len(buf)) - np.repeat(offs[:-1], np.diff(offs))
        h = np.full(len(buf), k + 1, _U)
        for j in range(k, 0, -1):
            before = np.zeros(len(buf), _U)
            before[j:] = buf[: max(0, len(buf) - j)]
            h = mix(h ^ np.where(at >= j, before + _U(1), 0).astype(_U))
        return h, mix(h ^ (buf.astype(_U) + _U(300)))

    @classmethod
    def count(cls, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
        """(length of context, context, context and byte, times) of all bytes."""
        found = []
        for k in range(ORDER + 1):
            ctx, both = cls.keys(buf, offs, k)
            pair, first, m = np.unique(both, return_index=True, return_counts=True)
            found.append((np.full(len(pair), k, np.int32), ctx[first], pair, m))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def load(self, level: np.ndarray, ctx: np.ndarray, both: np.ndarray, times: np.ndarray) -> "Chain":
        """The model of counts, each context and byte once."""
        for k in range(ORDER + 1):
            at = np.flatnonzero(level == k)
            at = at[np.argsort(both[at])]
            u, back = np.unique(ctx[at], return_inverse=True)
            n, kinds = np.bincount(back, times[at], len(u)), np.bincount(back, minlength=len(u)).astype(float)
            good = (n >= LEAST) | (k <= 2)
            self.levels.append((u[good], n[good], kinds[good], both[at][good[back]], times[at][good[back]].astype(float)))
        return self

    def fit(self, buf: np.ndarray, offs: np.ndarray) -> "Chain":
        return self.load(*self.count(buf, offs))

    def logp(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        p = np.full(len(buf), 1 / 256)
        for k, (u, n, kinds, pair, m) in enumerate(self.levels):
            ctx, both = self.keys(buf, offs, k)
            at, seen = _find(u, ctx)
            where, hit = _find(pair, both)
            if len(u):
                total, t = n[at], kinds[at]
                p = np.where(seen, ((m[where] * hit if len(pair) else 0) + t * p) / (total + t), p)
        return np.log(p)


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted array, and whether the key is there."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


class Judge:
    def __init__(self, allow: Chain, block: Chain, threshold: float):
        self.allow, self.block, self.threshold = allow, block, threshold

    def ratio(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Log-likelihood difference for each character, positive for accepted URLs."""
        n = np.diff(offs)
        d = self.allow.logp(buf, offs) - self.block.logp(buf, offs)
        total = np.concatenate([[0.0], np.cumsum(d)])
        return (total[offs[1:]] - total[offs[:-1]]) / np.maximum(n, 1)


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def calibrate(good: np.ndarray, bad: np.ndarray) -> float:
    """The threshold with the smallest sum of the two error rates; the middle one of equals."""
    cuts = np.unique(np.concatenate([good, bad, [0.0]]))
    cuts = np.concatenate([[cuts[0] - 1e-9], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1e-9]])
    error = np.searchsorted(np.sort(good), cuts) / max(len(good), 1) + 1 - np.searchsorted(np.sort(bad), cuts) / max(len(bad), 1)
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(cuts[best[len(best) // 2]])


def _count(batches):
    for b in batches:
        verdict = b.column("verdict")
        for v in ("allow", "block"):
            own = b.filter(pc.equal(verdict, v))
            if own.num_rows:
                _, buf, offs = columns(own, "id", "url")
                level, ctx, both, m = Chain.count(buf, offs)
                yield pa.RecordBatch.from_arrays([pa.array([v] * len(level), pa.string()), pa.array(level), pa.array(ctx.view(np.int64)), pa.array(both.view(np.int64)), pa.array(m.astype(np.int64))], ["verdict", "level", "ctx", "both", "m"])


def _counted(used: DataFrame) -> DataFrame:
    """(verdict, level, ctx, both, m): counts of all URLs, without the long contexts that are seen too seldom."""
    counts = used.select(F.lit(0).cast("long").alias("id"), "url", "verdict").mapInArrow(_count, "verdict string, level int, ctx long, both long, m long")
    counts = counts.groupBy("verdict", "level", "ctx", "both").agg(F.sum("m").alias("m"))
    each = counts.groupBy("verdict", "level", "ctx").agg(F.sum("m").alias("n"), F.collect_list(F.struct("both", "m")).alias("pairs"))  # a byte has 256 values
    return each.where((F.col("level") <= 2) | (F.col("n") >= LEAST)).select("verdict", "level", "ctx", F.inline("pairs"))


def threshold(scored: DataFrame, work: Scratch, rows: int = SORTED) -> float:
    """``calibrate`` of ``scored(score, good)`` of any size: scores are summed in ranges, then within each."""
    by = scored.select("score", F.col("good").cast("long").alias("g"), (~F.col("good")).cast("long").alias("b"))
    by = by.unionByName(scored.sparkSession.range(1).select(F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("g"), F.lit(0).cast("long").alias("b")))
    by = work.keep(by.groupBy("score").agg(F.sum("g").alias("g"), F.sum("b").alias("b")), "scores")
    ranges = 1 + by.count() // rows
    ends = sorted(set(by.approxQuantile("score", [k / ranges for k in range(1, ranges)], 0.1 / ranges))) if ranges > 1 else []
    by = by.withColumn("at", F.size(F.filter(F.array(*(F.lit(e) for e in ends)).cast("array<double>"), lambda e: e <= F.col("score"))))
    sums = sorted(by.groupBy("at").agg(F.sum("g"), F.sum("b"), F.min("score")).collect())  # a row for each range
    before = np.cumsum([(0, 0), *((r[1], r[2]) for r in sums)], 0)
    known = [(r[0], int(g), int(b), n) for r, (g, b), n in zip(sums, before[:-1], [*(r[3] for r in sums[1:]), None], strict=True)]
    good, bad = (max(int(x), 1) for x in before[-1])
    w = Window.partitionBy("at").orderBy("score")
    by = by.join(F.broadcast(scored.sparkSession.createDataFrame(known, "at int, g0 long, b0 long, next double")), "at")
    after = F.coalesce(F.lead("score").over(w), "next")
    error = (F.col("g0") + F.sum("g").over(w)) / good + 1 - (F.col("b0") + F.sum("b").over(w)) / bad
    cuts = by.select(F.coalesce((F.col("score") + after) / 2, F.col("score") + 1e-9).alias("cut"), error.alias("error"))
    first = scored.sparkSession.range(1).select(F.lit(float(sums[0][3]) - 1e-9).alias("cut"), F.lit(1.0).alias("error"))
    cuts = work.keep(cuts.unionByName(first), "cuts")
    best = cuts.where(F.col("error") <= cuts.agg(F.min("error")).first()[0] + 1e-12)
    return best.orderBy("cut").offset(best.count() // 2).limit(1).first()[0]


def _scores(shared):
    def run(batches):
        for b in batches:
            _, buf, offs = columns(b, "id", "url")
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.ratio(buf, offs)), b.column("good")], ["score", "good"])

    return run


def _fitted(labelled: DataFrame) -> tuple[Judge, Broadcast] | None:
    work = Scratch(labelled.sparkSession, "urls")
    all_ = work.keep(labelled.distinct(), "labelled")
    first = {r[0]: r[1] for r in all_.groupBy("verdict").agg(F.min("url")).collect()}
    if len(first) < 2:
        work.drop()
        return None
    # a fifth by a hash, and one of each verdict at least; where nothing is left for the models, they count all
    held = (F.pmod(F.xxhash64("url"), F.lit(5)) == 0) | F.col("url").isin(*first.values())
    left = {r[0] for r in all_.where(~held).select("verdict").distinct().collect()}
    counts = _counted(all_.where(~held | ~F.col("verdict").isin(*left))).toArrow()
    level, ctx, both, m = (counts.column(c).to_numpy() for c in ("level", "ctx", "both", "m"))
    own = pc.equal(counts.column("verdict"), "allow").to_numpy()
    judge = Judge(*(Chain().load(level[at], ctx[at].view(_U), both[at].view(_U), m[at]) for at in (own, ~own)), 0.0)
    shared = labelled.sparkSession.sparkContext.broadcast(judge)
    scored = all_.where(held).select(F.lit(0).cast("long").alias("id"), "url", (F.col("verdict") == "allow").alias("good")).mapInArrow(_scores(shared), "score double, good boolean")
    judge.threshold = threshold(scored, work)
    work.drop()
    return judge, shared


def fit(labelled: DataFrame) -> Judge | None:
    """``labelled(url, verdict)``: models of both verdicts from all different URLs, a fifth of which are kept for the threshold.

    A URL of very many captures is one example like any other.
    """
    found = _fitted(labelled)
    return found and found[0]


def _decide(shared, threshold):
    def run(batches):
        for b in batches:
            _, buf, offs = columns(b, "page_id", "url")
            score = shared.value.ratio(buf, offs)
            said = pa.array(np.where(score >= threshold, "allow", "block"))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("page_id", "host", "path", "rule")), said, pa.array(score)], ["page_id", "host", "path", "rule", "model", "score"])

    return run


def filter_urls(pages: DataFrame, rules: Rules, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score (allowed if the models' difference is large enough)."""
    host, path = host_and_path(F.col("url"))
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).withColumn("host", host).withColumn("path", path)
    src = src.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    said = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])[F.col("rule")]
    found = _fitted(src.where("rule is not null").select("url", said.alias("verdict")))
    if found is None:
        return src.select("page_id", "host", "path", "rule", F.coalesce(said, F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    out = src.mapInArrow(_decide(found[1], found[0].threshold), "page_id long, host string, path string, rule string, model string, score double")
    return out.select("page_id", "host", "path", "rule", F.coalesce(said, F.col("model")).alias("verdict"), "score")
