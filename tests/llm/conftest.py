import random

import pytest

#: Clashing names of extra columns: those that operators use within.
EXTRA = ["component", "kept", "n_words", "block_id", "bucket", "u", "v", "label", "rep", "set_key", "host", "_cut", "items"]


def base_texts(seed=5):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(1, 8)))
    long = " ".join(word() for _ in range(400))
    line = "this very line is in many of the texts here and it has more than thirteen words in it"
    texts = [None, "", " \t\n", "A.", "one two", "One TWO", "a b c", "ünï cödé – 日本語 ñ", long, long, long.replace("e", "ee", 3), long[:900] + " " + line + " " + long[900:]]
    texts += [f"{' '.join(word() for _ in range(30))} {line} {' '.join(word() for _ in range(20))}" for _ in range(12)]
    texts += [" ".join(["again and again"] * 120), "x" * 5000, " ".join(word() for _ in range(60_000)), "\u00a0non\u00a0breaking " * 30]
    return texts


@pytest.fixture(scope="session")
def texts():
    return base_texts()


@pytest.fixture(scope="session")
def odd(spark, texts):
    """Documents with nulls in every column, repeated rows and ids, ties, very long and empty texts, extra columns."""
    rows = [(i * 3 + 1, t, ["en", "de", None][i % 3], f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (rows[12][0], "another text with the id of the twelfth one", "en", None, None), (None, texts[8], "en", "src0", 3), (None, None, None, None, None), (7_000_000_000, texts[13], None, "src1", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *(f"'extra' as `{c}`" for c in EXTRA)).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
