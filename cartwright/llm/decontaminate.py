"""Benchmark decontamination by greedy string tiling.

1. Seeds: every run of ``MIN_MATCH`` words of a benchmark item, as a
   Karp-Rabin hash. A bitmap of fixed size, made from all seeds by one
   aggregate, lets the document scan drop runs that no item can have; what
   remains is joined with the seeds exactly, so a large benchmark only makes the
   bitmap less selective.
2. Pairs of document and item whose shared seeds could cover enough of the item
   are tiled: matches are grown from their seeds by comparing Karp-Rabin hashes
   of windows, the longest one is marked first, and what it overlaps is shortened or
   dropped, until no match of ``MIN_MATCH`` words is left.
3. A document is contaminated if its tiles cover at least ``COVERAGE`` of an
   item's words. Tiles may lie anywhere, so reordered passages count in full.

Words are runs of letters and digits in lower case (all other ASCII characters
separate them).

Defined cases: null and empty texts match nothing; items of fewer than
``MIN_MATCH`` words cannot be matched; repeated items are matched each by
itself and repeated documents too; of equally long matches the first in the
document, then in the item, is marked; texts are scanned whole; empty tables
give an empty result. Only ids and texts are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.bpe import blocks
from cartwright.llm.common import (bitmap_of, left_out, look_up, own_cache, packed, scratch,
                                   staged, unpacked, worker_cache)
from cartwright.llm.licenses import words_of as plain_words
from cartwright.llm.shingles import Shingler

MIN_MATCH = 4
COVERAGE = 0.5
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return plain_words(text.lower())


@worker_cache
def shingler() -> Shingler:
    return Shingler()


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``width`` words (modulo 2^64)."""
    n = max(len(words) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * _BASE + words[j:j + n]
    return out ^ (out >> np.uint64(29))


def seeds_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of all seeds."""
    rows = [words_of(t) for t in texts]
    counts = np.array([len(r) for r in rows], np.int64)
    hashes = rolling(shingler().word_hashes(rows), MIN_MATCH)
    owner = np.repeat(np.arange(len(rows)), counts)[:len(hashes)]
    place = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))[:len(hashes)]
    inside = place <= counts[owner] - MIN_MATCH
    return owner[inside], place[inside], hashes[inside].view(np.int64)


def item_seeds(items: DataFrame) -> DataFrame:
    """(item, n_words, place, seed) of all items (item, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts = [x or "" for x in block.column("text").to_pylist()]
            owner, place, seed = seeds_of(texts)
            sizes = pa.array([len(words_of(t)) for t in texts], pa.int64())
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [block.column("item").take(at), sizes.take(at), pa.array(place), pa.array(seed)],
                names=["item", "n_words", "place", "seed"])

    return items.select("item", "text").mapInArrow(
        run, "item long, n_words long, place long, seed long")


def suspects(df: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(row, doc_id, text, seeds) of the documents with seeds in the bitmap."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(shingler)
        for block in blocks(batches, "text"):
            owner, _, seed = seeds_of([x or "" for x in block.column("text").to_pylist()])
            hit = look_up(shared.value, seed)
            owner, seed = owner[hit], seed[hit]
            rows, first = np.unique(owner, return_index=True)
            at = pa.array(rows)
            ends = np.append(first, len(owner)).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(seed))
            yield pa.RecordBatch.from_arrays(
                [block.column("row").take(at), block.column("doc_id").take(at),
                 block.column("text").take(at), found],
                names=["row", "doc_id", "text", "seeds"])

    rows = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(run, "row long, doc_id long, text string, seeds array<long>")


class _Windows:
    """Hashes of all windows of a word sequence, from its prefix hashes."""

    PRIME = (1 << 61) - 1
    BASE = 1_000_003

    def __init__(self, hashes: list[int]):
        self.prefix, self.power = [0], [1]
        for h in hashes:
            self.prefix.append((self.prefix[-1] * self.BASE + h + 1) % self.PRIME)
            self.power.append(self.power[-1] * self.BASE % self.PRIME)

    def of(self, start: int, width: int) -> int:
        return (self.prefix[start + width] - self.prefix[start] * self.power[width]) % self.PRIME


def _matches(doc: list[bytes], item: list[bytes]) -> list[tuple[int, int, int]]:
    """Maximal matches (length, place in doc, place in item) of MIN_MATCH words or more."""
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    windows = _Windows([number[w] for w in item])
    at: dict[tuple, list[int]] = {}
    for j in range(len(item) - MIN_MATCH + 1):
        at.setdefault(tuple(item[j:j + MIN_MATCH]), []).append(j)
    out = []
    i = 0
    while i <= len(doc) - MIN_MATCH:
        if doc[i] not in number or tuple(doc[i:i + MIN_MATCH]) not in at:
            i += 1
            continue
        # the part of the document around here that the item can match at all
        start = i
        stop = i + MIN_MATCH
        while stop < len(doc) and tuple(doc[stop - MIN_MATCH + 1:stop + 1]) in at:
            stop += 1
        local = _Windows([number[w] for w in doc[start:stop]])
        for p in range(start, stop - MIN_MATCH + 1):
            for j in at[tuple(doc[p:p + MIN_MATCH])]:
                if p > start and j > 0 and doc[p - 1] == item[j - 1]:
                    continue  # grown from the place before
                low, high = MIN_MATCH, min(stop - p, len(item) - j)
                while low < high:
                    middle = (low + high + 1) // 2
                    if local.of(p - start, middle) == windows.of(j, middle):
                        low = middle
                    else:
                        high = middle - 1
                if doc[p:p + low] == item[j:j + low]:
                    out.append((low, p, j))
        i = stop - MIN_MATCH + 1
    return out


def tiles(doc: list[bytes], item: list[bytes]) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in doc, place in item, length), longest first."""
    queue = [(-n, p, j) for n, p, j in _matches(doc, item)]
    heapq.heapify(queue)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    out = []
    while queue:
        n, p, j = heapq.heappop(queue)
        n = -n
        free = [p + k not in in_doc and j + k not in in_item for k in range(n)]
        if all(free):
            out.append((p, j, n))
            in_doc.update(range(p, p + n))
            in_item.update(range(j, j + n))
            continue
        k = 0
        while k < n:  # what the marks have left of it
            end = k
            while end < n and free[end]:
                end += 1
            if end - k >= MIN_MATCH:
                heapq.heappush(queue, (k - end, p + k, j + k))
            k = end + 1
    return out


def _tiled(pairs: DataFrame) -> DataFrame:
    """Tile each pair (doc_id, text, item_id, item_text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            out = []
            last, words = None, []
            for row in block.to_pylist():
                if last != row["text"]:
                    last, words = row["text"], words_of(row["text"])
                item = words_of(row["item_text"])
                found = tiles(words, item)
                covered = sum(n for _, _, n in found)
                out.append({
                    "doc_id": row["doc_id"], "item_id": row["item_id"],
                    "coverage": covered / len(item), "n_tiles": len(found),
                    "longest_tile": max((n for _, _, n in found), default=0),
                    "tiles": [{"doc_word": p, "item_word": j, "n_words": n}
                              for p, j, n in sorted(found)]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()),
                ("n_tiles", pa.int64()), ("longest_tile", pa.int64()),
                ("tiles", pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()),
                                              ("n_words", pa.int64())])))]))

    return pairs.mapInArrow(run, (
        "doc_id long, item_id long, coverage double, n_tiles long, longest_tile long, "
        "tiles array<struct<doc_word: long, item_word: long, n_words: long>>"))


def contaminated(df: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest_tile, tiles) of contaminated documents."""
    items = staged(benchmark.select("item_id", "text").withColumn(
        "item", F.monotonically_increasing_id()), "items")
    seeds = staged(item_seeds(items), "seeds")
    found = staged(suspects(df, bitmap_of(seeds, "seed")), "suspects")
    hits = found.select("row", F.explode(F.array_distinct("seeds")).alias("seed"))
    shared = (hits.join(seeds, "seed").groupBy("row", "item")
              .agg(F.countDistinct("place").alias("places"), F.first("n_words").alias("n")))
    # a seed stands for MIN_MATCH words at most
    able = shared.filter(F.col("places") * MIN_MATCH >= F.col("n") * coverage)
    pairs = (found.select("row", "doc_id", "text").join(able.select("row", "item"), "row")
             .join(items.select("item", "item_id", F.col("text").alias("item_text")), "item")
             .select("doc_id", "text", "item_id", "item_text"))
    return _tiled(pairs).filter(F.col("coverage") >= coverage)


def contaminated_documents(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(df, benchmark).select("doc_id", "item_id", "coverage", "n_tiles",
                                              "longest_tile")


def without_contaminated(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose own text covers no benchmark item.

    Rows are told apart by a 64-bit hash of their text, not by doc_id: equal texts
    are judged alike, and no copy of the rows is needed. (With 5 * 10^10 documents,
    10^8 of them contaminated, less than one clean text is expected to share its hash
    with a contaminated one.)
    """
    rows = packed(df).withColumn("row", F.xxhash64(F.coalesce("text", F.lit(""))))
    with scratch(df.sparkSession):
        found = contaminated(rows.select(F.col("row").alias("doc_id"), "text"), benchmark)
        gone = staged(found.select(F.col("doc_id").alias("row")).distinct(), "contaminated",
                      keep=True)
    return unpacked(left_out(rows, gone), df.columns)
