"""Substring dedup by hashing units of text.

A text is cut into units that tile it: lines, or the sentences within the lines.
Each unit is normalised (lower case; everything but letters and digits counts as
one space), and units of at least ``MIN_WORDS`` words are hashed (128 bits).
Equal digests are grouped over the whole corpus; the earliest occurrence in the
order of doc_id and unit stays, the others are removed. Removed units come with
their offsets (code points, end exclusive) in the original text.

Sentences are the default: a passage that is pasted into a line shares whole
sentences with its source but no whole line.

Units that tile leave out every sentence or line of fewer than ``MIN_WORDS``
words. ``kind="passage"`` hashes all text: its units are windows of consecutive
sentences, over line ends too. Each sentence opens one and closes one, and both are
grown sentence by sentence until they have ``MIN_WORDS`` words. A window depends
on its own sentences alone, so copies of a passage of whole sentences have the same
windows wherever they stand, and these cover it. Windows overlap: what goes is
their union. A window that overlaps its first occurrence (text that repeats itself)
only goes from the end of that on, and is named with the cut start.

Defined cases: null and empty texts have no units; a text is cut whole, however
long; repeated rows are later occurrences of the first one and lose all their
long units, with ``passage`` all text; a text of fewer than ``MIN_WORDS`` words has
no unit of any kind; ties in doc_id go by position in the input; rows with a null doc_id
come first in the order; an empty table gives an empty result. Only doc_id and
the text are read; other columns of ``deduplicated`` pass through, except one that
is named ``removed``: it is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.bpe import blocks
from cartwright.llm.common import replaced, staged, without

MIN_WORDS = 8
#: patterns of units; every character belongs to exactly one unit
UNITS = {"sentence": r"[^.!?\n]+[.!?\n]*|[.!?\n]+", "line": r"[^\n]+\n*|\n+"}
UNITS["passage"] = UNITS["sentence"]
_NOT_WORD = re.compile(r"[\W_]+")


def _cut(text: str, pattern: re.Pattern, min_words: int) -> Iterator[tuple]:
    """(unit number, start, end, words, digest) of the units that are long enough."""
    for i, unit in enumerate(pattern.finditer(text)):
        words = _NOT_WORD.sub(" ", unit.group().lower()).strip()
        n = words.count(" ") + 1
        if n >= min_words:
            yield i, unit.start(), unit.end(), n, hashlib.md5(words.encode()).digest()


def _windows(text: str, pattern: re.Pattern, min_words: int) -> Iterator[tuple]:
    """The same of the shortest windows of units from each and to each unit."""
    found = []  # units with words; the others go with the unit before
    for i, unit in enumerate(pattern.finditer(text)):
        words = _NOT_WORD.sub(" ", unit.group().lower()).strip()
        if words:
            found.append([i, unit.start(), unit.end(), words])
        elif found:
            found[-1][2] = unit.end()
    upto = [0, *accumulate(words.count(" ") + 1 for *_, words in found)]
    opened, first = -1, 0  # the last unit whose window is out; the last from which one fits
    for stop in range(1, len(found) + 1):
        while upto[stop] - upto[first + 1] >= min_words:
            first += 1
        if upto[stop] - upto[first] >= min_words:
            for at in range(min(opened + 1, first), first + 1):
                yield _window(found, upto, at, stop)
            opened = first


def _window(found: list[list], upto: list[int], at: int, stop: int) -> tuple:
    words = found[at][3] if stop == at + 1 else " ".join([u[3] for u in found[at:stop]])
    return (found[at][0], found[at][1], found[stop - 1][2], upto[stop] - upto[at],
            hashlib.md5(words.encode()).digest())


def units(df: DataFrame, kind: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, row, unit, start, end, n_words, digest) of all long units."""
    pattern = re.compile(UNITS[kind])
    cut = _windows if kind == "passage" else _cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts = block.column("text").to_pylist()
            found = [(at, *u) for at, text in enumerate(texts)
                     for u in cut(text or "", pattern, min_words)]
            at, unit, start, end, n, digest = zip(*found) if found else [()] * 6
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").take(rows), block.column("row").take(rows),
                 pa.array(unit, pa.int64()), pa.array(start, pa.int64()),
                 pa.array(end, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(digest, pa.binary())],
                names=["doc_id", "row", "unit", "start", "end", "n_words", "digest"])

    rows = df.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, "doc_id long, row long, unit long, start long, end long, "
                                "n_words long, digest binary")


def repeats(cut: DataFrame) -> DataFrame:
    """Of the units in ``cut`` those to remove, each with the occurrence that stays.

    The digests are counted with map-side aggregation, so a sentence that a
    third of all documents share reaches the shuffle as one row per task; only
    digests that occur again go into the join.
    """
    place = F.struct("doc_id", "row", "unit")
    again = (cut.groupBy("digest")
             .agg(F.min(F.struct("doc_id", "row", "unit", "end")).alias("first"),
                  F.count(F.lit(1)).alias("copies"))
             .filter("copies > 1"))
    first = F.struct("first.doc_id", "first.row", "first.unit")
    start = F.when(F.col("row") == F.col("first.row"), F.greatest("start", "first.end"))
    return (cut.join(again, "digest").filter(place > first)
            .select("doc_id", "row", "unit", F.coalesce(start, "start").alias("start"), "end", "n_words",
                    F.hex("digest").alias("digest"),
                    F.col("first.doc_id").alias("first_doc_id"),
                    F.col("first.unit").alias("first_unit")))


def removed_units(df: DataFrame, kind: str = "sentence",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """The units that repeat an earlier one, with their offsets."""
    return repeats(staged(units(df, kind, min_words), "units")).drop("row")


def deduplicated(df: DataFrame, kind: str = "sentence",
                 min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without repeated units; ``removed`` holds the offsets cut out."""
    df = without(df, "removed")
    rows = staged(df, "documents").withColumn("__row", F.monotonically_increasing_id())
    cut = staged(units(rows.drop("__row"), kind, min_words), "units")
    before = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, -1))
    spans = (repeats(cut).withColumn("start", F.greatest("start", before)).filter("start < end")
             .groupBy("row")
             .agg(F.sort_array(F.collect_list(F.struct("start", "end", F.lit("").alias("label"))))
                  .alias("__spans")))
    joined = rows.join(spans.withColumnRenamed("row", "__row"), "__row", "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(
        replaced(F.col("text"), F.col("__spans")))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in df.columns]
    offsets = F.transform("__spans", lambda x: F.struct(x["start"].alias("start"),
                                                        x["end"].alias("end")))
    return joined.select(*columns, F.coalesce(
        offsets, F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("removed"))


def removed_from_documents(df: DataFrame) -> DataFrame:
    return removed_units(df.select("doc_id", "text"))


def removed_passages(df: DataFrame) -> DataFrame:
    return removed_units(df.select("doc_id", "text"), "passage")
