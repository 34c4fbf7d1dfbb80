"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwright.session import checkpoint_root, delete_at_end, file_system

#: bits of a bitmap of row numbers or hashes (1 MB); with more entries it only drops less
BITMAP_BITS = 1 << 23
_CACHES: list = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session in local mode that has none (tests on one machine) gets a
    scratch folder; on a cluster a missing setting raises RuntimeError.
    """
    return checkpoint_root(spark).rstrip("/")


#: files that each open ``scratch`` will remove
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, but for what is staged with ``keep``.

    For steps whose result is itself staged, small, before the end; otherwise files
    stay until the driver ends.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            fs, target = file_system(spark, path)
            fs.delete(target, True)


def staged(df: DataFrame, label: str, keep: bool = False,
           compression: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder once and read it back.

    Unlike ``checkpoint()`` this computes the rows once and stores them
    compressed. The files outlive lost executors and go when the driver ends, or with
    the ``scratch`` around them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(path)
    df.write.parquet(path, compression=compression)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table without columns of these names (in any case), which an operator adds anew."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def packed(df: DataFrame) -> DataFrame:
    """The text beside the rest of the row as ``__doc``: no name of the row can clash then."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != "text"]
    return df.select(F.struct(F.lit(0).alias("__none"), *rest).alias("__doc"), "text")


def unpacked(df: DataFrame, columns: list[str], text: Column | None = None) -> DataFrame:
    """The rows of a packed table again, with another text if one is given."""
    own = F.col("text") if text is None else text
    return df.select(*[own.alias(c) if c == "text" else F.col("__doc").getField(c).alias(c)
                       for c in columns])


def whole_text(name: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def replaced(text: Column, spans: Column) -> Column:
    """The text with disjoint, ascending spans (start, end, label) replaced by their labels."""
    upto = lambda i: F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0)
    parts = F.transform(spans, lambda s, i: F.concat(
        F.substring(text, upto(i) + 1, s["start"] - upto(i)), s["label"]))
    rest = F.substring(text, F.element_at(spans, -1)["end"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(text)


def worker_cache(make: Callable) -> Callable:
    """Keep what ``make`` gives in the Python worker from block to block.

    Spark uses a worker for one stage after the other; ``own_cache`` lets go of what
    the stages before have left.
    """
    kept = lru_cache(maxsize=2)(make)
    _CACHES.append(kept)
    return kept


def own_cache(mine: Callable | None) -> None:
    """Empty the caches of all other operators in this worker, and give the memory back."""
    others = [c for c in _CACHES if c is not mine and c.cache_info().currsize]
    for c in others:
        c.cache_clear()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()


def bitmap_of(hashes: DataFrame, column: str) -> np.ndarray:
    """A bit for each number modulo ``BITMAP_BITS``; at most 1 MB comes to the driver."""
    bit = F.pmod(F.col(column), F.lit(BITMAP_BITS)) + 1
    parts = (hashes.groupBy(F.bitmap_bucket_number(bit).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect())
    bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in parts:
        at = (row["part"] - 1) * len(row["bits"])
        bitmap[at:at + len(row["bits"])] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bitmap


def look_up(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether numbers are marked in a bitmap."""
    bit = numbers & (BITMAP_BITS - 1)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def starts_of(sizes: DataFrame, part: str, n: str) -> Column:
    """For each number of ``part`` the sum of ``n`` over the parts before, as an array column.

    One small number for each task or file, read as a scalar subquery; numbers
    without a row count 0.
    """
    held = sizes.groupBy(F.col(part).cast("int").alias("part")).agg(F.sum(n).alias("n"))
    every = held.agg(F.max("part").alias("last")).select(
        F.explode(F.sequence(F.lit(0), "last")).alias("part"), F.lit(0).cast("long").alias("n"))
    ends = held.union(every).groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    listed = starts.agg(F.sort_array(F.collect_list(F.struct("part", "start"))).alias("s"))
    return listed.select("s.start").scalar()


def numbered(df: DataFrame) -> DataFrame:
    """The packed rows (__doc, text), written once, with their place in the input as ``row``.

    Task and place are noted where the rows are written, so every later plan sees
    the same numbers; they are dense, which suits bitmaps.
    """
    rows = staged(packed(df).withColumn("at", F.monotonically_increasing_id()), "rows",
                  compression="zstd")  # all texts again: the largest of the files
    place, task = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright("at", 33).cast("int")
    starts = starts_of(rows.select(task.alias("task"), F.lit(1).alias("one")), "task", "one")
    return rows.withColumn("__starts", starts).select(
        "__doc", "text", (F.get("__starts", task) + place).alias("row"))


def left_out(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The numbered rows without those that ``gone`` (row) names.

    A bitmap of the numbers lets all other rows pass without a shuffle.
    """
    bits = bitmap_of(gone, "row")

    @F.pandas_udf("boolean")
    def marked(row: pd.Series) -> pd.Series:
        return pd.Series(look_up(bits, row.to_numpy()))

    maybe = marked(F.col("row"))
    return rows.filter(~maybe).union(
        rows.filter(maybe).join(gone, "row", "left_anti").select(*rows.columns))
