"""MinHash near-duplicates by an inverted join over signature coordinates.

1. Every text gets the set of its hashed 5-word shingles and a signature of
   ``COORDINATES`` minima. Texts with equal sets form one class, named after its
   smallest document.
2. Classes are posted under each (coordinate, value). Two sets with Jaccard
   similarity 0.75 agree in 48 of 64 coordinates on average (deviation 3.5); a
   pair must agree in at least ``MATCHES`` (30, more than five deviations below:
   a true link is lost with a probability below one in a million).
3. Prefix and skip merging: postings that nobody shares are dropped; a class
   orders its postings by how many classes share them, rarest first, and skips
   the ``MATCHES - 1`` most frequent ones. Two classes with enough agreements
   still share one of the others, so very frequent passages are never merged.
4. Candidates that agree often enough are confirmed on their full sets.
5. Large groups: first each posting list links its members only to its most
   central one (whose postings are shared most: in a group of near copies their
   common source), if they collide in ``LEADING`` lists or more. The links found
   make components. What is left are pairs in different components. The
   documents in lists that span components are joined by their own shingles,
   again rarest first: a similar pair must meet among the first quarter, and the
   place where it first meets bounds its similarity from above. Only pairs
   that pass that bound are made and compared, so neither near copies nor
   documents around one frequent passage make all their pairs, and no link
   between two components is lost.

Defined cases: null and empty texts and texts without words have an empty set
and are linked with nothing; shorter texts count their whole sequence as one
shingle; texts are taken whole; repeated rows are equal sets, and rows that share
a doc_id count as one document; ties go to the smallest doc_id; rows with a null doc_id come back with a null component (or
that of their equal texts); an empty table gives an empty result. Only doc_id
and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.bpe import blocks
from cartwright.llm.common import (bitmap_of, left_out, look_up, numbered, own_cache, scratch,
                                   staged, unpacked, worker_cache)
from cartwright.llm.components import components
from cartwright.llm.shingles import Shingler

COORDINATES = 64
MATCHES = 30
PERCENT = 75
#: collisions in the merged lists that a pair of the first round needs
LEADING = 8
#: shingles whose minima are taken together (fits a processor's cache)
SLICE = 1 << 15


@worker_cache
def shingler() -> Shingler:
    return Shingler()


@lru_cache(maxsize=1)
def coefficients() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(7)).integers(
        0, 1 << 63, (2, COORDINATES), np.int64).astype(np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Posting keys of non-empty sets: minimum of each coordinate with its number."""
    factor, shift = coefficients()
    ends = np.cumsum(sizes)
    out = np.empty((len(sizes), COORDINATES), np.uint64)
    row = 0
    while row < len(sizes):
        begin = int(ends[row] - sizes[row])
        stop = max(row + 1, int(np.searchsorted(ends, begin + SLICE, side="right")))
        part = hashes[begin:int(ends[stop - 1])]
        starts = ends[row:stop] - sizes[row:stop] - begin
        for k in range(COORDINATES):
            out[row:stop, k] = np.minimum.reduceat(part * factor[k] + shift[k], starts)
        row = stop
    mask = np.uint64(COORDINATES - 1)
    return ((out & ~mask) | np.arange(COORDINATES, dtype=np.uint64)).view(np.int64)


def signed(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(shingler)
        for block in blocks(batches, "text"):
            texts = [x or "" for x in block.column("text").to_pylist()]
            hashes, sizes = shingler().sets(texts)
            some = sizes > 0
            cut = np.split(hashes, np.cumsum(sizes)[:-1])
            keys = [set_key(h) for h in cut]
            ends = np.concatenate(([0], np.cumsum(some * COORDINATES))).astype(np.int32)
            flat = signatures(hashes, sizes[some]).ravel() if some.any() else []
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "signature"])

    return df.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, signature array<long>")


def set_key(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def shingle_sets(df: DataFrame, bits: np.ndarray) -> DataFrame:
    """(doc_id, set_key, shingles) of the rows whose doc_id is marked in a bitmap."""
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(shingler)
        for block in blocks(batches, "text"):
            ids = block.column("doc_id").fill_null(0).to_numpy()
            marked = look_up(shared.value, ids)
            block = block.filter(pa.array(marked))
            if not block.num_rows:
                continue
            hashes, sizes = shingler().sets([x or "" for x in block.column("text").to_pylist()])
            ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            keys = [set_key(h) for h in np.split(hashes, ends[1:-1])]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))],
                names=["doc_id", "set_key", "shingles"])

    return df.select("doc_id", "text").mapInArrow(
        run, "doc_id long, set_key binary, shingles array<long>")


def postings(classes: DataFrame) -> DataFrame:
    """(key, node, n_shingles, weight): the postings that take part in merging.

    weight: how often the class's postings are shared in all.
    """
    posted = classes.select("node", "n_shingles", F.explode("signature").alias("key"))
    shared = (posted.groupBy("key").agg(F.count(F.lit(1)).alias("shared_by"))
              .filter("shared_by > 1"))
    ordered = (posted.join(shared, "key")
               .groupBy("node").agg(F.first("n_shingles").alias("n_shingles"),
                                    F.sum("shared_by").alias("weight"),
                                    F.sort_array(F.collect_list(F.struct("shared_by", "key")))
                                    .alias("keys")))
    # the other keys of a class are unshared; they come first in its order
    kept = F.slice("keys", F.lit(1), F.greatest(F.size("keys") - (MATCHES - 1), F.lit(0)))
    return ordered.select("node", "n_shingles", "weight", F.explode(kept).alias("p")).select(
        F.col("p.key").alias("key"), "node", "n_shingles", "weight")


def _sizes_fit(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _can_link(common: Column, a: Column, b: Column) -> Column:
    """Whether sets of sizes a and b with at most ``common`` common shingles can be linked."""
    return 100 * common >= PERCENT * (a + b - common)


def _marks(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with all doc_ids; it misses none, but has some others.

    It keeps most texts out of the shuffle of the exact join that follows.
    """
    return bitmap_of(ids, "doc_id")


def _sets_of(nodes: DataFrame, df: DataFrame) -> DataFrame:
    """(node, shingles) of the classes named in ``nodes``."""
    ids = nodes.withColumnRenamed("node", "doc_id")
    sets = (shingle_sets(df, _marks(ids)).join(ids, "doc_id", "left_semi")
            .dropDuplicates(["doc_id", "set_key"]))
    return staged(sets.select(F.col("doc_id").alias("node"), "shingles"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) whose full sets are similar."""
    common = F.size(F.array_intersect("hu", "hv"))
    return (pairs.join(sets.withColumnsRenamed({"node": "u", "shingles": "hu"}), "u")
            .join(sets.withColumnsRenamed({"node": "v", "shingles": "hv"}), "v")
            .filter(_can_link(common, F.size("hu"), F.size("hv"))).select("u", "v"))


def _first_links(merged: DataFrame, classes: DataFrame, df: DataFrame) -> DataFrame:
    """Links to the most central member of the lists."""
    central = merged.groupBy("key").agg(F.max(F.struct(
        "weight", (-F.col("node")).alias("least"), "n_shingles")).alias("l"))
    pairs = (merged.join(central, "key").select(
        (-F.col("l.least")).alias("u"), F.col("l.n_shingles").alias("nu"),
        F.col("node").alias("v"), F.col("n_shingles").alias("nv"))
        .filter((F.col("u") != F.col("v")) & _sizes_fit(F.col("nu"), F.col("nv")))
        .groupBy("u", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEADING))
    sig = classes.select("node", "signature")
    agreeing = (pairs.select("u", "v")
                .join(sig.withColumnsRenamed({"node": "u", "signature": "su"}), "u")
                .join(sig.withColumnsRenamed({"node": "v", "signature": "sv"}), "v")
                .filter(F.size(F.array_intersect("su", "sv")) >= MATCHES).select("u", "v"))
    agreeing = staged(agreeing, "pairs")
    nodes = agreeing.select(F.col("u").alias("node")).union(
        agreeing.select(F.col("v").alias("node"))).distinct()
    return _confirmed(agreeing, _sets_of(nodes, df))


def _spanning(rows: DataFrame) -> DataFrame:
    """The rows of lists whose members lie in more than one component."""
    spans = (rows.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"))
             .filter("a < b").select("key"))
    return rows.join(spans, "key", "left_semi")


def _other_links(merged: DataFrame, found: DataFrame, df: DataFrame) -> DataFrame:
    """Links between components, among the documents of lists that span them."""
    grouped = merged.select("key", "node", F.col("n_shingles").alias("n")).join(
        found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    nodes = staged(_spanning(grouped).select("node", "n", "component").distinct(), "spanning")
    sets = _sets_of(nodes.select("node"), df)
    # first drop those with too many shingles of their own
    alone = (sets.select("node", F.explode("shingles").alias("shingle"))
             .groupBy("shingle").agg(F.count(F.lit(1)).alias("copies"), F.min("node").alias("node"))
             .filter("copies = 1").groupBy("node").agg(F.count(F.lit(1)).alias("alone")))
    able = nodes.join(alone, "node", "left").filter(
        100 * (F.col("n") - F.coalesce("alone", F.lit(0))) >= PERCENT * F.col("n")).drop("alone")
    each = staged(sets.join(able, "node").select(
        "node", "n", "component", F.explode("shingles").alias("shingle")), "shingles")
    # a shingle of one component alone links nobody to another one, however many share it
    shared = (each.groupBy("shingle").agg(F.count(F.lit(1)).alias("copies"),
                                          F.min("component").alias("a"),
                                          F.max("component").alias("b"))
              .filter("a < b").select("shingle", "copies"))
    ordered = (each.join(shared, "shingle").groupBy("node", "n", "component")
               .agg(F.sort_array(F.collect_list(F.struct("copies", "shingle"))).alias("s")))
    # the shingles that no other component shares come first in a document's order
    placed = ordered.select("node", "n", "component", F.size("s").alias("m"),
                            F.posexplode("s").alias("i", "c")).select(
        "node", "n", "component", F.col("c.shingle").alias("shingle"),
        (F.col("n") - F.col("m") + F.col("i") + 1).alias("place"))
    first = placed.filter(F.col("place") <= F.col("n") - F.ceil(
        F.col("n") * PERCENT / 100) + 1)
    a, b = first.alias("a"), first.alias("b")
    most = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place")) + 1
    pairs = (a.join(b, (F.col("a.shingle") == F.col("b.shingle"))
                    & (F.col("a.component") < F.col("b.component"))
                    & _sizes_fit(F.col("a.n"), F.col("b.n"))
                    & _can_link(most, F.col("a.n"), F.col("b.n")))
             .select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct())
    return _confirmed(pairs, sets)


def near_duplicates(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of documents."""
    rows = staged(signed(df), "signatures")
    classes = (rows.filter("set_key is not null and doc_id is not null").groupBy("set_key")
               .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"),
                    F.first("signature").alias("signature")))
    classes = staged(classes, "classes")
    merged = staged(postings(classes), "postings")
    found = components(_first_links(merged, classes, df))
    more = staged(_other_links(merged, found, df), "links")
    final = found
    if not more.isEmpty():
        chains = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
        final = components(chains.union(more))

    named = classes.join(final, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("class_component"))
    out = rows.join(named, "set_key", "left")
    component = F.coalesce("class_component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def one_of_each(df: DataFrame) -> DataFrame:
    """One row of each group of near duplicates; every row is judged by its text.

    Rows are told apart by a number of their own, not by doc_id: rows that share a
    doc_id, or have none, are copies only if their texts are alike, and then one of
    them stays. Of a group the first row in the order of the input stays. The rows
    to leave out are joined, not those to keep, as they are fewer.
    """
    rows = numbered(df)
    with scratch(df.sparkSession):
        found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
        gone = staged(found.filter(~F.col("kept"))
                      .select(F.col("doc_id").alias("row")), "copies", keep=True)
    return unpacked(left_out(rows, gone), df.columns)
