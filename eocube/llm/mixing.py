"""Mixing sources to target weights by systematic sampling.

Each source has a target: its share of the mixture by weight, at most a multiple
of its own size, what is over being shared again by weight among the others. All
documents of a source have the same expected number of copies e = target / size.
In a fixed order within the source the expected copies are summed up, one random
offset in [0, 1) is added, and a document is taken once for each integer that its
step crosses: floor(e) or ceil(e) times, so never more often than the multiple.
The order is by size, so the words taken differ from the target by no more than
the size of the largest document or so, whatever the offset.

All arithmetic on copies is exact: e is a fraction p / q of integers, and the
k-th sum is k * p / q. Ranks in a source come from one range partitioning by
(source, size, hash of the id), so a source with a third of all rows is many
tasks' work; what meets in one place is a row for each pair of source and
partition. Everything is DataFrame functions.

Defined results: a null text has size 0; a null source is a source of its own,
the last; a source without words has target 0 and is taken 0 times; an empty
table gives none; rows that repeat an id are documents like others, and which of
two with the same id and size is taken is of no account to the result; very long
texts are documents like others; the input's extra columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Offsets are multiples of 1 / STEPS.
STEPS = 1 << 30
#: The bits of a row's place in its task.
_PLACE = (1 << 33) - 1
_WIDE = "decimal(38,0)"


def _hash(seed: int, c: Column, digits: int) -> Column:
    """A number of so many hexadecimal digits that depends on ``seed`` and ``c`` alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def _numbered(df: DataFrame, order: list[Column], names: list) -> DataFrame:
    """Rows in the order of ``order``: ``part`` and, within it, ``place`` from 0. To be stored before it is used."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.select(*names, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("place"))


def targets(sources: DataFrame, scratch: Scratch, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2) -> DataFrame:
    """``sources(named, name, source_size)`` with weight, target, and the expected copies p / q.

    Resharing goes on until no target is above ``most`` sizes: each round is one
    aggregate that returns one row, and only adds sources to those at their limit.
    """
    order = [F.col("named").desc(), F.col("name").asc()]
    seen = scratch.keep(_numbered(sources, order, ["named", "name", "source_size"]), "sources")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each partition
    before = seen.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    weight = F.element_at(F.array(*(F.lit(int(w)).cast("long") for w in weights)), ((F.col("before") + F.col("place")) % len(weights) + 1).cast("int"))
    named = scratch.keep(seen.join(before, "part").select("named", "name", "source_size", weight.alias("weight")), "weights")

    size, w = F.col("source_size").cast(_WIDE), F.col("weight").cast(_WIDE)
    whole, weighed = named.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left, over = percent * int(whole), int(weighed)  # hundredths of words for the sources below their limit, and their weights
    number = lambda x: F.lit(str(x)).cast(_WIDE)
    while over:
        full = size * number(100 * most * over) <= w * number(left)
        taken, rest = named.agg(F.sum(F.when(full, F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if int(rest) == over:
            break
        left, over = percent * int(whole) - 100 * most * int(taken), int(rest)
    full = (size * number(100 * most * over) <= w * number(left)) if over else F.lit(True)
    share = (w * number(left)).cast("double") / F.lit(float(100 * over or 1))
    return named.select(
        "named", "name", "source_size", "weight", F.when(full, F.col("source_size").cast("double") * most).otherwise(share).alias("target"),
        F.when(full, number(most)).otherwise(w * number(left)).alias("p"), F.when(full, F.when(size > 0, number(1)).otherwise(number(0))).otherwise(size * number(100 * over)).alias("q"),
    )


def sampled(docs: DataFrame, columns: Sequence[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2, seed: int = 42, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: row (its ``columns``), size, source_size, target, copies."""
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    size = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    source = F.col(source_col).cast("string")
    sized = docs.select(F.struct(*(F.col(c) for c in columns)).alias("row"), source.isNotNull().alias("named"), F.coalesce(source, F.lit("")).alias("name"), size.alias("size"), _hash(seed, F.col(id_col), 15).alias("tie"), F.monotonically_increasing_id().alias("salt"))
    sized = scratch.keep(sized, "sizes")
    sources = targets(sized.groupBy("named", "name").agg(F.sum("size").alias("source_size")), scratch, weights, percent, most)
    order = [F.col("named").desc(), *(F.col(c).asc() for c in ("name", "size", "tie", "salt"))]
    ranked = scratch.keep(_numbered(sized, order, ["row", "named", "name", "size"]), "ranked")
    slices = ranked.groupBy("named", "name", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    ahead = Window.partitionBy("named", "name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition that has the source
    slices = slices.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("first")).drop("n", "first")
    slices = slices.join(sources, ["named", "name"]).withColumn("offset", _hash(seed, F.col("name"), 8) % STEPS)
    found = ranked.join(slices, ["named", "name", "part"])

    def crossed(rank: Column) -> Column:
        """Integers up to the sum of the first ``rank`` steps and the offset, in exact arithmetic."""
        scaled = rank.cast(_WIDE) * F.col("p") * F.lit(STEPS).cast(_WIDE) + F.col("q") * F.col("offset").cast(_WIDE)
        return F.call_function("div", scaled, F.col("q") * F.lit(STEPS).cast(_WIDE))

    rank = F.col("before") + F.col("place")
    copies = F.when(F.col("q") > 0, crossed(rank + 1) - crossed(rank)).otherwise(0).cast("long")
    return found.select("row", "size", "source_size", "target", copies.alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as it is taken."""
    taken = sampled(docs, docs.columns, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
