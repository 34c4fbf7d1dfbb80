"""Sharding by jump consistent hashing (native).

Every row goes to the bucket that the jump hash of its key gives: a generator
seeded by the key yields ever larger bucket numbers and the last one below the
shard count wins. There is no ring table, the law needs only key and shard
count, and one more shard takes 1/(n+1) of the rows, all of them into itself.

Defined cases: a null key counts as key 0; a null or empty text has size 8 and
CRC 0; rows with equal keys share a shard and get slots in the order of key,
text CRC and position in the input; an empty table gives an empty result.
Columns of the input other than the key and the text are not read, so names
cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.common import staged, whole_text

# fixed values of the published algorithm: a 64-bit linear congruential step,
# of whose state the upper 31 bits make the random number
MULTIPLIER = "2862933555777941757"
TWO_64 = "18446744073709551616"
TWO_33 = "8589934592"
TWO_31 = float(1 << 31)
#: bytes that a row takes besides its text
ROW_BYTES = 8


def _decimal(text: str, digits: int) -> Column:
    return F.lit(text).cast(T.DecimalType(digits, 0))


def key_number(df: DataFrame, key: str) -> Column:
    """The key as a number from 0 to 2^64 - 1; other types are hashed first."""
    kind = df.schema[key].dataType
    value = F.col(key).cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(F.col(key))
    value = F.coalesce(value, F.lit(0)).cast(T.DecimalType(20, 0))
    return F.when(value < 0, value + _decimal(TWO_64, 20)).otherwise(value).cast(T.DecimalType(20, 0))


def jump_buckets(number: Column, shards: int) -> Column:
    """Struct (shard, grown): the bucket among ``shards`` and among one more.

    The generator's visits do not depend on the shard count, so one walk gives
    both: the last visit below ``shards`` and the last one below
    ``shards + 1``. At most ``shards + 1`` visits are possible.
    """
    def next_state(state: Column) -> Column:
        return ((state["seed"] * _decimal(MULTIPLIER, 19) + F.lit(1)) % _decimal(TWO_64, 20)).cast(
            T.DecimalType(20, 0))

    def visit(state: Column, seed: Column) -> Column:
        upper = F.floor(seed / _decimal(TWO_33, 10)).cast("double")
        at = state["next"]
        return F.struct(
            seed.alias("seed"),
            F.when(at < shards, at).otherwise(state["shard"]).alias("shard"),
            at.alias("grown"),
            F.floor((at + 1) * (F.lit(TWO_31) / (upper + 1))).cast("long").alias("next"))

    def step(state: Column, _: Column) -> Column:
        moved = F.transform(F.array(next_state(state)), lambda seed: visit(state, seed))[0]
        return F.when(state["next"] <= shards, moved).otherwise(state)

    zero = F.lit(0).cast("long")
    start = F.struct(number.alias("seed"), zero.alias("shard"), zero.alias("grown"),
                     zero.alias("next"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step,
                       lambda s: F.struct(s["shard"].cast("int").alias("shard"),
                                          s["grown"].cast("int").alias("grown")))


def assign_shards(df: DataFrame, shards: int, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard) of every row; no shuffle."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = df.select(
        F.col(key), (F.octet_length(whole_text(text)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(whole_text(text)).cast("long").alias("text_crc32"),
        key_number(df, key).alias("__number"))
    jump = rows.withColumn("__jump", jump_buckets(F.col("__number"), shards))
    return jump.select(key, "size", "text_crc32", F.col("__jump.shard").alias("shard"),
                       F.col("__jump.grown").alias("grown_shard"))


def number_slots(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add ``slot``: gapless from 0 within each shard, by key, CRC and position.

    Rows are dealt by range, so no task holds a whole shard, and the position
    splits even a key that holds a third of all rows. A row's slot is its rank
    in its range plus the rows of that shard in the ranges before, which is one
    small count per shard and range.
    """
    order = ["shard", key, "text_crc32", "__at"]
    dealt = rows.withColumn("__at", F.monotonically_increasing_id()).repartitionByRange(*order)
    dealt = staged(dealt.withColumn("__range", F.spark_partition_id()), "slots")
    counts = dealt.groupBy("shard", "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__range",
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("shard", "__range").orderBy(F.col(key).asc_nulls_first(),
                                                            "text_crc32", "__at")
    ranked = dealt.withColumn("__rank", F.row_number().over(inside) - 1)
    return (ranked.join(starts, ["shard", "__range"])
            .withColumn("slot", F.col("__start") + F.col("__rank"))
            .drop("__at", "__range", "__rank", "__start"))


def shard_documents(df: DataFrame, shards: int = 24) -> DataFrame:
    """Shard, slot and the shard after adding one more, for every document."""
    placed = number_slots(assign_shards(df.select("doc_id", "text"), shards))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         F.col("slot").cast("long"), "grown_shard")
