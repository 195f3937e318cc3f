"""The corpus pipeline: language ID, near-dedup, substring dedup, decontamination, packing.

Each stage works on all rows its predecessor kept and, but for the last, returns
the columns of ``documents``. A stage's result must be stored before the next
stage begins, as ``run`` does: the next one removes the intermediate tables of
the one before.

Defined results: rows without a doc_id are rejected by the first stage, since no
decision can refer to them; of rows that repeat a doc_id one stays (the first by
text, language and source); an empty table gives empty tables. Extra columns are
carried along; a column with the name of one of ours is never read for ours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eocube.llm.decontaminate import contamination
from eocube.llm.language import fit, identify
from eocube.llm.near_dedup import near_duplicates
from eocube.llm.packing import pack
from eocube.llm.scratch import Scratch, release
from eocube.llm.substring_dedup import remove_repeats

OWNER = "pipeline"
SHINGLE, PERCENT = 5, 80
#: Passages that repeat over at least so many words go.
PASSAGE, PASSAGE_FIRST = 50, 25
CAPACITY = 2048


def _scratch(spark: SparkSession, name: str) -> Scratch:
    release(OWNER)
    return Scratch(spark, name, OWNER)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name in docs.columns:
        name += "_"
    return name


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id"), "doc_id", "left_semi").select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those of the labelled rows, beyond doubt of chance."""
    scratch = _scratch(spark, "stage-language")
    found = identify(docs, fit(docs.select("doc_id", "text", "lang")), host_col="source", scratch=scratch)
    return _only(docs, found.where("accepted and doc_id is not null"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    scratch = _scratch(spark, "stage-near")
    found = near_duplicates(docs, shingle=SHINGLE, percent=PERCENT, scratch=scratch)
    own = Window.partitionBy("doc_id").orderBy("text", "lang", "source")
    left = _only(docs, found.where("kept").select("doc_id"))
    place = _free(docs, "place")
    return left.withColumn(place, F.row_number().over(own)).where(F.col(place) == 1).select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of PASSAGE words or more that an earlier document has; other texts unchanged."""
    scratch = _scratch(spark, "stage-substring")
    cut = remove_repeats(docs, window=PASSAGE, first=PASSAGE_FIRST, scratch=scratch)
    name = _free(docs, "cut")
    cut = cut.where("n_removed > 0").select("doc_id", F.struct(F.col("text").alias("left")).alias(name))
    both = docs.join(cut, "doc_id", "left")
    found, left = F.col(name).isNotNull(), F.col(name)["left"]
    text = F.when(found, left).otherwise(docs["text"])
    size = F.when(found, F.length(left).cast("long")).otherwise(docs["n_chars"])
    new = {"text": text, "n_chars": size}
    return both.select([new.get(c, docs[c]).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    scratch = _scratch(spark, "stage-benchmark")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch=scratch)
    return _only(docs, found.where("not contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as sequences of at most CAPACITY tokens: one row per piece."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=CAPACITY, scratch=_scratch(spark, "stage-packing"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier and a genetic algorithm have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = store.keep(stage(spark, docs, sf_dir), name)
        if i:
            store.drop(STAGES[i - 1][0])
    release(OWNER)
    return docs
