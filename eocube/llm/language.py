"""Language identification by Bayesian evidence fusion.

Evidence for a document's language is multiplied: the likelihood of its bytes
under a trigram model of each language, the language its markup declares, the
suffix of its address, and a prior of its host. Priors are expected counts of
languages from the text evidence of all documents, gathered by grouped
aggregation and smoothed hierarchically: host towards its parent domain, that
towards the whole corpus; a document's own share is taken out of its host's.

The trigram model is fitted on a bounded sample of labelled rows (``fit_rows``
expected, chosen by a hash of the id); everything else covers all rows.

A text can be in none of the languages. A background model has the letters of
the labelled rows, but in any order, or any trigram at all. A text that it
explains better than every language does, by more than labelled rows show that
the model hasn't seen (they are scored by the model of the other half of the
sample), is rejected.

Defined results: a text too short for a trigram is decided by the other evidence
and its host's prior; a text without letters, empty or null, only by what its
markup or address declare: without those the language is null and the document
is rejected. A null id is kept in the result as null. Unknown declared
languages and suffixes are no evidence.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import NO_ID, documents, mix

SLOTS = 1 << 16
FIT_ROWS = 20_000
MOST_LANGUAGES = 1000
#: So far below the contrast that all but RARE of the labelled rows have unseen, a text is in none of the languages.
MARGIN = 8.0
RARE = 0.001
#: The language that an address suffix speaks for.
SUFFIX = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en"}

# ASCII that isn't a letter becomes one blank; letters are compared in lower case
_CLASS = np.full(256, 32, np.uint8)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def trigrams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the byte trigrams that have a letter, and each document's offsets among them."""
    if len(buf) < 3:
        return np.zeros(0, np.uint16), np.zeros(len(offs), np.int64)
    c = _CLASS[buf].astype(np.uint32)
    t = c[:-2] | (c[1:-1] << np.uint32(8)) | (c[2:] << np.uint32(16))
    good = t != 0x202020
    for back in (1, 2):  # none runs into the next document
        at = offs[1:] - back
        good[at[(at >= 0) & (at < len(good))]] = False
    t = t[good]
    t *= np.uint32(0x9E3779B1)
    before = np.zeros(len(good) + 1, np.int32)
    np.cumsum(good, out=before[1:])
    return (t >> np.uint32(16)).astype(np.uint16), before[np.minimum(offs, len(good))].astype(np.int64)


def _half(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.uint64) ^ np.uint64(0x5EED)) & np.uint64(1)).astype(np.int64)


def background(letters: np.ndarray) -> np.ndarray:
    """Log-probabilities of trigrams of independent bytes with these counts, mixed with those of equal slots."""
    seen = np.flatnonzero(letters).astype(np.uint32)
    p = letters[seen] / max(letters.sum(), 1)
    out = np.zeros(SLOTS)
    for c, pc in zip(seen.tolist(), p.tolist(), strict=True):
        t = seen[:, None] | (seen[None, :] << np.uint32(8)) | np.uint32(c << 16)
        good = t != 0x202020
        out += np.bincount((t[good] * np.uint32(0x9E3779B1)) >> np.uint32(16), (p[:, None] * p[None, :] * pc)[good], minlength=SLOTS)
    out /= max(out.sum(), 1e-300)
    return np.log(0.5 * out + 0.5 / SLOTS).astype(np.float32)


def _log(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * SLOTS)).astype(np.float32)


def _count(languages: list[str]):
    def run(batches):
        total = np.zeros((len(languages), 2, SLOTS + 256), np.int64)  # trigrams, then single bytes
        number = {x: i for i, x in enumerate(languages)}
        for b in batches:
            lang = np.array([number.get(x, -1) for x in b.column("lang").to_pylist()])
            lo = 0
            for ids, buf, offs in documents([b]):
                own = lang[lo : lo + len(ids)]
                lo += len(ids)
                slot, at = trigrams(buf, offs)
                which = np.repeat(own, np.diff(at))
                half = _half(ids)
                part, byte = np.repeat(half, np.diff(at)), np.repeat(2 * own + half, np.diff(offs))
                for k in np.unique(own[own >= 0]).tolist():
                    for f in (0, 1):
                        total[k, f, :SLOTS] += np.bincount(slot[(which == k) & (part == f)], minlength=SLOTS)
                        total[k, f, SLOTS:] += np.bincount(_CLASS[buf[byte == 2 * k + f]], minlength=256)
        for i, f in np.argwhere(total.any(2)).tolist():
            some = np.flatnonzero(total[i, f])
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(some), pa.int32()), pa.array([f] * len(some), pa.int32()), pa.array(some, pa.int32()), pa.array(total[i, f, some], pa.int64())], ["language", "half", "slot", "n"])

    return run


class Model:
    """Log-probabilities of trigrams, by language and for texts in none of them."""

    def __init__(self, languages: list[str], logp: np.ndarray, back: np.ndarray, floor: float = -np.inf):
        self.languages, self.logp, self.back, self.floor = languages, logp, back, floor

    def score(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean log-likelihood by language, the number of trigrams, and the contrast to the background, of each document."""
        slot, at = trigrams(buf, offs)
        n = np.diff(at)
        out, some = np.zeros((len(offs) - 1, len(self.languages))), n > 0
        none = np.zeros(len(offs) - 1)
        if some.any():
            for k in range(len(self.languages)):
                out[some, k] = np.add.reduceat(self.logp[k][slot], at[:-1][some], dtype=np.float64)
            none[some] = np.add.reduceat(self.back[slot], at[:-1][some], dtype=np.float64)
        mean = out / np.maximum(n, 1)[:, None]
        return mean, n, (mean.max(1, initial=-np.inf) - none / np.maximum(n, 1)) * np.sqrt(n)


def _unseen(shared):
    """The contrast of each text under the model of the half that it isn't in."""

    def run(batches):
        models = shared.value
        for b in batches:
            for ids, buf, offs in documents([b]):
                both = np.stack([m.score(buf, offs)[2] for m in models])
                some = np.diff(trigrams(buf, offs)[1]) > 0
                yield pa.RecordBatch.from_arrays([pa.array(both[1 - _half(ids), np.arange(len(ids))][some], pa.float64())], ["contrast"])

    return run


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, most_languages: int = MOST_LANGUAGES) -> Model:
    """Trigram counts of a sample of ``labelled(doc_id, text, lang)`` of about ``fit_rows`` rows.

    All languages of the sample are fitted. The model takes a megabyte of the
    driver for each, so more than ``most_languages`` are an error, never left out.
    """
    labelled = labelled.where("lang is not null and text is not null")
    n = labelled.count()
    rate = min(1.0, fit_rows / max(n, 1))
    sample = labelled.where(F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5 <= rate)
    languages = sorted(r[0] for r in sample.select("lang").distinct().limit(most_languages + 1).collect())
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages in the labelled rows; raise most_languages")
    counts = np.zeros((len(languages), 2, SLOTS + 256), np.float32)
    rows = sample.select("doc_id", "text", "lang")
    if languages:
        for r in rows.mapInArrow(_count(languages), "language int, half int, slot int, n long").groupBy("language", "half", "slot").agg(F.sum("n").alias("n")).toArrow().to_batches():
            counts[r.column(0).to_numpy(), r.column(1).to_numpy(), r.column(2).to_numpy()] = r.column(3).to_numpy()
    back = background(counts[:, :, SLOTS:].sum((0, 1)))
    model = Model(languages, _log(counts[:, :, :SLOTS].sum(1)), back)
    if languages:
        halves = [Model(languages, _log(counts[:, f, :SLOTS]), back) for f in (0, 1)]
        unseen = rows.mapInArrow(_unseen(labelled.sparkSession.sparkContext.broadcast(halves)), "contrast double").toArrow().column(0).to_numpy()
        if len(unseen):
            model.floor = min(0.0, float(np.quantile(unseen, RARE))) - MARGIN
    return model


def _score(shared, extra: list[str], sharpness: float):
    def run(batches):
        model = shared.value
        for b in batches:
            ids, post, letters, fits = [], [], [], []
            for own, buf, offs in documents([b]):
                mean, n, contrast = model.score(buf, offs)
                # trigrams overlap, so the evidence of n of them is tempered: it grows with the root of n
                log = mean * (sharpness * np.sqrt(n))[:, None]
                p = np.exp(log - log.max(1, keepdims=True, initial=-np.inf))
                p[n == 0] = 1
                seen = np.concatenate([[0], np.cumsum(_CLASS[buf] != 32)])
                letters.append(seen[offs[1:]] > seen[offs[:-1]])
                fits.append((n == 0) | (contrast >= model.floor))
                ids.append(own)
                post.append(p / p.sum(1, keepdims=True))
            post = np.concatenate(post)
            ids = np.concatenate(ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=ids == NO_ID), *(b.column(c) for c in extra), pa.FixedSizeListArray.from_arrays(pa.array(post.reshape(-1)), post.shape[1]).cast(pa.list_(pa.float64())), pa.array(np.concatenate(letters)), pa.array(np.concatenate(fits))], ["doc_id", *extra, "by_text", "read", "fits"])

    return run


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "://([^/?#]*)", 1))


def declared_in(html: Column) -> Column:
    """The language that markup declares, without its region."""
    return F.nullif(F.lower(F.regexp_extract(html, "(?i)<html[^>]*\\slang\\s*=\\s*[\"']?([a-z]+)", 1)), F.lit(""))


def visible(html: Column) -> Column:
    """Markup's text: scripts, styles, comments and tags go."""
    return F.regexp_replace(F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1\\s*>|<!--.*?-->", " "), "<[^>]*>|&[a-zA-Z#0-9]+;", " ")


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", host_col: str | None = None, declared_col: str | None = None, accept: list[str] | None = None, least: float = 0.35, sharpness: float = 2.0, weight: float = 20.0, declared_trust: float = 0.9, suffix_trust: float = 0.6, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, language, confidence, accepted.

    A document is accepted if its most probable language has a posterior of
    ``least`` or more and is one of ``accept`` (null: any of the model's), and
    its text isn't one that no language of the model explains.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "language")
    langs = model.languages
    n = len(langs)
    text = F.lit(None).cast("string")
    host = F.coalesce(F.col(host_col).cast("string"), F.lit("")) if host_col else F.lit("")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), host.alias("host"), (F.col(declared_col) if declared_col else text).alias("declared"))
    if not n:
        return src.select("doc_id", text.alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted"))
    scored = scratch.keep(src.mapInArrow(_score(spark.sparkContext.broadcast(model), ["host", "declared"], sharpness), "doc_id long, host string, declared string, by_text array<double>, read boolean, fits boolean"), "scored")
    parent = F.when(F.size(F.split("host", "\\.")) > 2, F.substring_index("host", ".", -2)).otherwise(F.substring_index("host", ".", -1))
    sums = lambda c: F.array(*[F.sum(F.element_at(c, i + 1)) for i in range(n)])
    hosts = scratch.keep(scored.groupBy("host").agg(sums("by_text").alias("own")).withColumn("parent", parent), "hosts")
    parents = hosts.groupBy("parent").agg(sums("own").alias("wide"))
    world = [x or 0.0 for x in hosts.agg(sums("own").alias("all")).first()[0]]  # an empty table has no sums
    total = sum(world) + n
    ground = F.array(*[F.lit((x + 1.0) / total) for x in world])
    size = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    smooth = lambda own, up: F.zip_with(own, up, lambda x, y: (F.greatest(x, F.lit(0.0)) + weight * y))
    share = lambda c: F.transform(c, lambda x: x / size(c))
    priors = hosts.join(parents.withColumn("up", share(smooth(F.col("wide"), ground))).select("parent", "up"), "parent").select("host", "own", "up")
    suffix = F.substring_index("host", ".", -1)
    spoken = F.create_map(*[F.lit(x) for kv in SUFFIX.items() for x in kv])[F.when(F.contains("host", F.lit(".")), suffix)]

    def vote(said: Column, trust: float) -> Column:
        """Likelihood of what was declared under each language; no evidence where it is none of them."""
        known = F.coalesce(said.isin(langs), F.lit(False)) if n > 1 else F.lit(False)
        return F.array(*[F.when(~known, 1.0).when(said == x, trust).otherwise((1 - trust) / max(n - 1, 1)) for x in langs])

    both = scored.join(priors, "host")
    prior = smooth(F.zip_with("own", "by_text", lambda a, b: a - b), F.col("up"))
    fused = F.zip_with(F.zip_with(F.col("by_text"), prior, lambda a, b: a * b), F.zip_with(vote(F.col("declared"), declared_trust), vote(spoken, suffix_trust), lambda a, b: a * b), lambda a, b: a * b)
    out = both.select("doc_id", share(fused).alias("p"), "read", "fits", (F.col("declared").isin(langs) | spoken.isin(langs)).alias("told"))
    best = F.array_max("p")
    some = F.col("read") | F.coalesce(F.col("told"), F.lit(False))
    language = F.when(some, F.element_at(F.array(*map(F.lit, langs)), F.array_position("p", best).cast("int")))
    wanted = F.lit(True) if accept is None else language.isin(accept)
    return out.select("doc_id", language.alias("language"), F.when(some, best).otherwise(0.0).alias("confidence"), F.coalesce(some & F.col("fits") & (best >= least) & wanted, F.lit(False)).alias("accepted"))
