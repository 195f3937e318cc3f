"""Fill-in-the-middle: documents cut at units of text and put together anew, in SQL functions alone.

A delimiter is escaped in the text, then ``regexp_replace`` puts it after each unit
(a word with the white space before it, or white space at the end). Units are
counted by counting delimiters, and ``substring_index`` takes the ranked parts,
which lose their delimiters and are unescaped. Where the cuts fall and what form
a document gets is read off a hash of its id, so reruns agree and nothing is
shuffled: the whole operator is one projection.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm``
(suffix, prefix, middle), each part after its marker. The middle comes last, and
``restored`` puts the text together again from the output and the form alone.

Defined results: a null text is an empty one; empty texts and texts that hold a
marker stay plain, as they could not be told from cut ones; a null id is hashed
as an empty one; rows that repeat an id get the same fractions; very long texts
are cut like others (a unit is never split, so a text of one unit has parts that
are all of it or empty); extra columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Escaped in the text before DELIMITER is put after its units. Neither is white space, so units stay as they are.
DELIMITER, ESCAPE = "\x01", "\x02"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
MARKERS = ("<P>", "<S>", "<M>")


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escaped(text: Column) -> Column:
    return _replace(_replace(text, ESCAPE, ESCAPE + "e"), DELIMITER, ESCAPE + "d")


def unescaped(part: Column) -> Column:
    """A run of units: its delimiters go, escaped ones come back."""
    return _replace(_replace(_replace(part, DELIMITER, ""), ESCAPE + "d", DELIMITER), ESCAPE + "e", ESCAPE)


def fraction(digest: Column, k: int) -> Column:
    """The k-th group (from 0) of eight hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def restored(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The text that ``output`` was made of. Markers have no border, so each is found where it was put."""
    p, s, m = (F.lit(x) for x in markers)
    head, middle = F.substring_index(output, markers[2], 1), F.substring_index(output, markers[2], -1)
    left = F.when(form == "psm", F.substring_index(head, markers[1], 1)).otherwise(head)
    prefix = F.substring_index(left, markers[0], -1)
    right = F.when(form == "psm", head).otherwise(F.substring_index(head, markers[0], 1))
    suffix = F.substring_index(right, markers[1], -1)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80, markers: Sequence[str] = MARKERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form, prefix, middle, suffix (null if plain), output.

    ``percent`` of the documents are cut, ``spm_percent`` of those with the suffix
    first. Markers must begin with a character that is in none of them again.
    """
    if any(m[0] in x[1:] for m in markers for x in markers) or len(set(markers)) < 3:
        raise ValueError("the markers must differ, and none may hold the first character of one but as its own first")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    src = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.sha2(key, 256).alias("digest"))
    units = src.select("doc_id", "text", "digest", F.regexp_replace(escaped(F.col("text")), F.lit(UNIT), F.lit("$0" + DELIMITER)).alias("units"))
    n = (F.octet_length("units") - F.octet_length(_replace(F.col("units"), DELIMITER, ""))).cast("long")
    kept = (F.col("text") == "") | (fraction(F.col("digest"), 2) % 100 >= percent)
    for m in markers:
        kept |= F.contains("text", F.lit(m))
    form = F.when(kept, "plain").when(fraction(F.col("digest"), 3) % 100 < spm_percent, "spm").otherwise("psm")
    cuts = units.withColumn("n", n).withColumn("form", form)
    one, two = (fraction(F.col("digest"), k) % (F.col("n") + 1) for k in (0, 1))
    cuts = cuts.withColumns({"first": F.least(one, two).cast("int"), "second": F.greatest(one, two).cast("int")})
    # the units end in a delimiter, so counted from the right there is one part more
    parts = {
        "prefix": "substring_index(units, chr(1), first)",
        "middle": "substring_index(substring_index(units, chr(1), second), chr(1), first - second)",
        "suffix": "substring_index(units, chr(1), cast(second - n - 1 as int))",
    }
    split = F.col("form") != "plain"
    cut = cuts.select("doc_id", "text", "n", "form", *(F.when(split, unescaped(F.expr(x))).alias(k) for k, x in parts.items()))
    p, s, m = (F.lit(x) for x in markers)
    psm = F.concat(p, F.col("prefix"), s, F.col("suffix"), m, F.col("middle"))
    spm = F.concat(s, F.col("suffix"), p, F.col("prefix"), m, F.col("middle"))
    output = F.when(~split, F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm)
    return cut.select("doc_id", "n", "form", "prefix", "middle", "suffix", output.alias("output"))
