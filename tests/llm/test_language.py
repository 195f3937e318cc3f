import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.llm import language as L

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_held_out_accuracy(spark, docs):
    fold = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(5)) == 0
    model = L.fit(docs.where(~fold).select("doc_id", "text", "lang"))
    got = L.identify(docs.where(fold), model, host_col="source").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 100 and np.mean([r.language == r.lang for r in got]) >= 0.97
    assert all(r.accepted for r in got if r.language == r.lang)


def test_evidence_adds_up(spark, docs):
    """Without text, markup decides; without markup, the address suffix; then the host's prior."""
    model = L.fit(docs.select("doc_id", "text", "lang"))
    de = docs.where("lang = 'de'").limit(30).select("text")
    rows = de.select(F.monotonically_increasing_id().alias("page_id"), "text", F.lit("a.example.com").alias("host"), F.lit(None).cast("string").alias("declared"))
    extra = spark.createDataFrame([(900, "", "b.example.net", "fr"), (901, "", "www.laden.de", None), (902, "B.", "a.example.com", None), (903, "", "a.example.com", None), (904, "", "x.org", "tlh")], "page_id long, text string, host string, declared string")
    got = {r.doc_id: (r.language, r.accepted) for r in L.identify(rows.union(extra), model, id_col="page_id", host_col="host", declared_col="declared").collect()}
    assert got[900] == ("fr", True) and got[901] == ("de", True) and got[902] == ("de", True)
    assert got[903] == (None, False) and got[904] == (None, False)


def test_odd_documents(odd, empty, docs):
    model = L.fit(docs.select("doc_id", "text", "lang"))
    got = L.identify(odd, model, host_col="source").collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert not by[1].accepted and not by[4].accepted and by[10].accepted  # null, empty; "A."
    assert all(0 <= r.confidence <= 1.000001 for r in got)
    assert L.identify(empty, model, host_col="source").count() == 0
    none = L.fit(empty)
    assert none.languages == [] and {r.accepted for r in L.identify(odd, none).collect()} == {False}


def test_accept_list(docs):
    model = L.fit(docs.select("doc_id", "text", "lang"))
    got = L.identify(docs, model, accept=["en"])
    assert got.where("accepted and language <> 'en'").count() == 0 < got.where("accepted").count()


def test_texts_in_none_of_the_languages(spark, docs):
    model = L.fit(docs.select("doc_id", "text", "lang"))
    rnd = random.Random(4)
    texts = [
        "Il governo ha deciso che la nuova legge sarà discussa in parlamento la prossima settimana, mentre i cittadini aspettano una risposta",
        "Rząd zdecydował, że nowa ustawa zostanie omówiona w parlamencie w przyszłym tygodniu, a obywatele czekają na odpowiedź",
        "Правительство решило что новый закон будет обсуждаться в парламенте на следующей неделе",
        "政府决定下周在议会讨论新法律公民们正在等待答复",
        "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300)),
    ]
    none = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.accepted for r in L.identify(none, model).collect()} == {False}
    # clean texts stay, however short
    short = docs.select("doc_id", F.explode(F.array(*[F.concat_ws(" ", F.slice(F.split("text", "\\s+"), 1, k)) for k in (3, 8, 20)])).alias("text")).where("text rlike '[a-zA-Z]{3}'")
    got = L.identify(short, model, least=0.0)
    assert got.where("not accepted").count() <= 0.001 * got.count()


def test_markup(spark):
    row = spark.createDataFrame([('<HTML class=a LANG="pt-BR"><style>p{}</style><!-- x --><p>Hi&amp; there</p>', "HTTP://WWW.Example.COM:80/a")], "h string, u string")
    r = row.select(L.declared_in(F.col("h")).alias("d"), L.visible(F.col("h")).alias("t"), L.host_of(F.col("u")).alias("host")).first()
    assert r.d == "pt" and r.t.split() == ["Hi", "there"] and r.host == "www.example.com:80"


def test_scores_match_a_plain_count():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abc é1\n") for _ in range(rnd.randrange(0, 40))).encode() for _ in range(50)]
    buf, offs = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    slot, at = L.trigrams(buf, offs)
    assert len(slot) == at[-1]
    for i, t in enumerate(texts):
        c = [L._CLASS[x] for x in t]
        assert at[i + 1] - at[i] == sum(1 for k in range(len(c) - 2) if {*c[k : k + 3]} != {32})


def plain_trigrams(text):
    """Slots of a text's byte trigrams, one by one."""
    c = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode()]
    three = [(c[i] | c[i + 1] << 8 | c[i + 2] << 16) for i in range(len(c) - 2)]
    return [(t * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for t in three if t != 0x202020], any(b != 32 for b in c)


def brute(rows, model, least=0.35, sharp=2.0, weight=20.0, trust=(0.9, 0.6)):
    """(language, confidence, accepted) of each (text, host, declared): all evidence multiplied document by document."""
    langs = model.languages
    post, facts = [], []
    for text, host, declared in rows:
        slots, letters = plain_trigrams(text)
        n = len(slots)
        mean = [sum(float(model.logp[k][t]) for t in slots) / max(n, 1) for k in range(len(langs))]
        none = sum(float(model.back[t]) for t in slots) / max(n, 1)
        p = [np.exp(sharp * np.sqrt(n) * (m - max(mean))) for m in mean]
        post.append([x / sum(p) for x in p])
        facts.append((letters, not n or (max(mean) - none) * np.sqrt(n) >= model.floor))
    up_of = lambda h: ".".join(h.split(".")[-2:]) if h.count(".") > 1 else h.split(".")[-1]
    own, wide, world = {}, {}, [0.0] * len(langs)
    for (_, host, _), p in zip(rows, post, strict=True):
        for table, key in ((own, host or ""), (wide, up_of(host or ""))):
            table[key] = [a + b for a, b in zip(table.get(key, [0.0] * len(langs)), p, strict=True)]
        world = [a + b for a, b in zip(world, p, strict=True)]
    ground = [(x + 1) / (sum(world) + len(langs)) for x in world]
    out = []
    for (_, host, declared), p, (letters, fits) in zip(rows, post, facts, strict=True):
        host = host or ""
        up = [a + weight * g for a, g in zip(wide[up_of(host)], ground, strict=True)]
        prior = [max(a - b, 0.0) + weight * u / sum(up) for a, b, u in zip(own[host], p, up, strict=True)]
        said = [(declared, trust[0]), (L.SUFFIX.get(host.split(".")[-1]) if "." in host else None, trust[1])]
        fused = [a * b for a, b in zip(p, prior, strict=True)]
        for word, sure in said:
            if word in langs:
                fused = [x * (sure if k == word else (1 - sure) / (len(langs) - 1)) for x, k in zip(fused, langs, strict=True)]
        total = sum(fused)
        best = max(range(len(langs)), key=lambda k: fused[k])
        some = letters or any(word in langs for word, _ in said)
        out.append((langs[best] if some else None, fused[best] / total if some else 0.0, some and fits and fused[best] / total >= least))
    return out


@pytest.mark.parametrize("pages", [False, True])
def test_brute_force(spark, docs, odd, pages):
    """op3 (documents by source) and op3b (pages by host, markup and suffix), each document by itself."""
    model = L.fit(docs.select("doc_id", "text", "lang"))
    if pages:
        src = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", L.visible(F.col("html")).alias("text"), L.host_of(F.col("url")).alias("host"), L.declared_in(F.col("html")).alias("declared"))
        extra = [(9001, "", "www.laden.de", None), (9002, None, None, "fr"), (9003, "x", "a.b.c.es", "tlh"), (9004, "", None, None), (9005, "the house", "", "en")]
        src = src.unionByName(spark.createDataFrame(extra, "page_id long, text string, host string, declared string"))
    else:
        short = docs.where("length(text) < 400").select(F.col("doc_id").alias("page_id"), "text", F.col("source").alias("host"))
        src = short.unionByName(odd.where("length(text) < 2000 or text is null").select((F.col("doc_id") + 10**6).alias("page_id"), "text", F.col("source").alias("host"))).where("page_id is not null").dropDuplicates(["page_id"]).withColumn("declared", F.lit(None).cast("string"))
    rows = src.collect()
    want = dict(zip([r.page_id for r in rows], brute([(r.text, r.host, r.declared) for r in rows], model), strict=True))
    got = {r.doc_id: r for r in L.identify(src, model, id_col="page_id", host_col="host", declared_col="declared").collect()}
    assert len(got) == len(rows) > 50
    for k, (language, confidence, accepted) in want.items():
        assert got[k].confidence == pytest.approx(confidence, abs=1e-5)
        if abs(confidence - 0.5) > 1e-6:
            assert (got[k].language, got[k].accepted) == (language, accepted)


def test_more_languages_than_allowed_are_an_error(docs):
    with pytest.raises(ValueError, match="most_languages"):
        L.fit(docs.select("doc_id", "text", "lang"), most_languages=2)


def test_hundreds_of_languages(spark):
    """None is left out of the model."""
    rnd = random.Random(6)
    rows = []
    for k in range(260):
        letters = [chr(0x4E00 + 40 * k + i) for i in range(30)]
        rows += [(10 * k + i, "".join(rnd.choice(letters) for _ in range(60)), f"l{k:03d}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(df)
    assert len(model.languages) == 260
    raw = [t.encode() for _, t, _ in rows]
    mean, _, _ = model.score(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
    assert np.mean([model.languages[i] == k for i, (*_, k) in zip(mean.argmax(1), rows, strict=True)]) > 0.99
