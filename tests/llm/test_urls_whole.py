import numpy as np
from pyspark.sql import functions as F

from eocube.llm import urls as U
from eocube.llm.scratch import Scratch


def test_models_count_all_urls(spark):
    """Of 60,000 URLs of a verdict all but those for the threshold are counted, and a trait of the last few is known."""
    urls = spark.range(120_000).selectExpr("concat('http://h', id, if(id % 2 = 0, '.org/fr/', '.net/'), if(id >= 119900, 'zq', 'a')) as url", "if(id % 2 = 0, 'allow', 'block') as verdict")
    judge = U.fit(urls.unionByName(urls.limit(500)))
    for chain, v in ((judge.allow, "allow"), (judge.block, "block")):
        size = urls.where(F.col("verdict") == v).agg(F.sum(F.length("url"))).first()[0]
        assert 0.78 * size < chain.levels[0][1][0] < 0.82 * size
        z, hit = U._find(chain.levels[1][0], U.Chain.keys(np.frombuffer(b"zq", np.uint8), np.array([0, 2]), 1)[0][1:])
        assert hit[0] and 25 <= chain.levels[1][1][z[0]] <= 50


def test_counts_by_spark_are_the_chain(spark):
    texts = [f"http://n{i % 7}.org/fr/{i * i}" for i in range(300)] + ["", "http://ü.org/fr/"]
    rows = U._counted(spark.createDataFrame([(t, "allow") for t in texts], "url string, verdict string").repartition(3)).toArrow()
    got = U.Chain().load(rows.column("level").to_numpy(), rows.column("ctx").to_numpy().view(np.uint64), rows.column("both").to_numpy().view(np.uint64), rows.column("m").to_numpy())
    want = U.Chain().fit(*U._flat(texts))
    assert all(np.array_equal(a, b) for x, y in zip(got.levels, want.levels, strict=True) for a, b in zip(x, y, strict=True))


def test_threshold_in_ranges(spark):
    """The threshold of many scores in ranges is that of all of them at once: overlapping, apart, few and equal ones."""
    rng = np.random.default_rng(2)
    work = Scratch(spark, "urls-test")
    for good, bad in ((rng.normal(1, 1, 400).round(2), rng.normal(0, 1, 300).round(2)), (rng.uniform(2, 3, 50), rng.uniform(0, 1, 50)), (np.array([0.5]), np.array([0.5])), (np.array([-2.0]), np.array([-3.0, -2.5]))):
        scored = spark.createDataFrame([(float(x), True) for x in good] + [(float(x), False) for x in bad], "score double, good boolean")
        for rows in (20, 100_000):
            assert abs(U.threshold(scored, work, rows) - U.calibrate(good, bad)) < 1e-12
