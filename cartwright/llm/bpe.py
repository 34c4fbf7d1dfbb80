"""Byte-level BPE encoding and decoding by merge replay.

A block of the corpus (an Arrow batch) is encoded at once. The pieces of its
texts that the worker has not met yet are laid out as one row of byte symbols,
and an inverted index maps the merge that two neighbouring symbols allow to the
positions of that pair in all words. The merges are then replayed in rank
order; each one visits the positions of its pair and re-indexes only the two
neighbours that it touches.

Why blocks and not one index for the whole corpus: the vocabulary of a corpus
grows with it, and an index over all of it would sit in one task. Words are
independent of each other, so replaying block by block gives the same ids, in
bounded memory, without a shuffle, and a lost task only repeats its block.

Defined cases: null and empty texts give no ids; decoding null or no ids gives
empty bytes; an id outside the vocabulary raises ValueError. Long texts are
encoded whole. Other columns pass through untouched, except those with a name
that the operator adds: they are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.common import own_cache, without, worker_cache
from cartwright.llm.pieces import ChunkTable

#: texts that are worked on together have up to so many bytes and rows (or are one
#: long text); bounds what a worker holds besides its tables
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 4000
#: the same for texts that are encoded together: every merge visits a block once
REPLAY_BYTES, REPLAY_ROWS = 32 << 20, 16_000
#: pieces that a worker keeps from block to block
KEPT_WORDS = 300_000
#: rows that are decoded together
DECODE_ROWS = 250


@lru_cache(maxsize=2)
def load_ranks(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """(rank of each token, token of each rank) of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


def ascending(values: np.ndarray) -> np.ndarray:
    """Sorted without repeats."""
    values.sort()
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


class MergeReplay:
    """Encodes lists of words by replaying the merges over all of them."""

    def __init__(self, ranks: dict[bytes, int], tokens: list[bytes]):
        self.ranks = ranks
        self.size = len(tokens)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {ranks[t[:i]] * self.size + ranks[t[i:]]: rank for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        # tokens that can merge again into a token of a lower rank than their own
        self.falls = np.zeros(self.size, bool)
        for side in (self.keys // self.size, self.keys % self.size):
            self.falls[side[self.merged <= side]] = True

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, -1 where it makes none."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as the bytes of 32-bit integers."""
        out = [b""] * len(words)
        owner = []
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif word:
                owner.append(i)
        if owner:
            data = np.frombuffer(b"".join([words[i] for i in owner]), np.uint8)
            ends = np.cumsum([len(words[i]) for i in owner])
            symbol = self._replay(self.byte_id[data], ends)
            alive = symbol >= 0
            upto = (np.concatenate(([0], np.cumsum(alive)))[ends] * 4).tolist()
            packed = symbol[alive].astype("<i4").tobytes()
            for i, start, end in zip(owner, [0, *upto], upto):
                out[i] = packed[start:end]
        return out

    def _replay(self, symbol: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Merge in place; a symbol that went into its left neighbour becomes -1."""
        n = len(symbol)
        symbol = np.append(symbol, -1)  # what position -1 reads: nothing there
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], after[n] = -1, -1
        before[ends[:-1]], before[n] = -1, -1
        allowed = self.merge_of(symbol, symbol[after])  # of each position with the next
        allowed[n] = -1
        places = np.flatnonzero(allowed >= 0)
        places = places[np.argsort(allowed[places], kind="stable")]
        ranks, starts = np.unique(allowed[places], return_index=True)
        queue = ranks.tolist()  # ascending, so already a heap
        index = dict(zip(queue, map(np.ndarray.tolist, np.split(places, starts[1:]))))
        while queue:
            rank = heapq.heappop(queue)
            at = ascending(np.array(index.pop(rank), np.int64))
            at = at[allowed[at] == rank]
            if not len(at):
                continue
            allowed_at, right = at, after[at]
            # of overlapping pairs (aaa) the first, third, ... are merged
            first = np.append(True, right[:-1] != at[1:])
            if not first.all():
                spot = np.arange(len(at))
                at = at[(spot - np.maximum.accumulate(np.where(first, spot, 0))) % 2 == 0]
                right = after[at]
            nxt, prv = after[right], before[at]
            later: list[int] = []
            if self.falls[rank]:
                # a merge that comes up with a lower rank goes before the rest of its word
                left = symbol[prv]
                left[np.append(False, prv[1:] == right[:-1]) & (prv >= 0)] = rank
                whole = np.full(len(at), rank)
                lower = np.maximum(self._soon(left, whole, rank),
                                   self._soon(whole, symbol[nxt], rank))
                word = np.searchsorted(ends, at, side="right")
                stopped = word[lower > 0]
                go = ~np.isin(word, stopped) | np.append(True, word[1:] != word[:-1])
                later = allowed_at[np.isin(np.searchsorted(ends, allowed_at, side="right"),
                                           stopped)].tolist()
                at, right, nxt = at[go], right[go], nxt[go]
            symbol[at], symbol[right] = rank, -1
            allowed[right] = -1
            after[at] = nxt
            before[nxt[nxt >= 0]] = at[nxt >= 0]
            beside = before[at]
            touched = ascending(np.concatenate((at, beside[beside >= 0])))
            allowed[touched] = fresh = self.merge_of(symbol[touched], symbol[after[touched]])
            for spot, new in zip(touched.tolist(), fresh.tolist()):
                if new >= 0:
                    if new in index:
                        index[new].append(spot)
                    else:
                        index[new] = [spot]
                        heapq.heappush(queue, new)
            if later:
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(queue, rank)
                index[rank].extend(later)
        return symbol[:n]

    def _soon(self, left: np.ndarray, right: np.ndarray, rank: int) -> np.ndarray:
        new = self.merge_of(left, right)
        return ((new >= 0) & (new <= rank)).astype(np.int8)


class Codec:
    """Texts to ids and back, with the chunks met so far."""

    def __init__(self, path: str, pattern: str):
        ranks, self.tokens = load_ranks(path)
        self.replay = MergeReplay(ranks, self.tokens)
        self.words: dict[str, bytes] = {}  # ids of pieces that several chunks share
        self.table = ChunkTable(pattern, self._fill)

    def _fill(self, chunks: list[list[str]]) -> list[bytes]:
        seen = Counter(chain.from_iterable(chunks))
        new = list(seen.keys() - self.words.keys())
        packed = self.words
        packed.update(zip(new, self.replay.encode_words([w.encode() for w in new])))
        filled = [packed[pieces[0]] if len(pieces) == 1 else
                  b"".join(map(packed.__getitem__, pieces)) for pieces in chunks]
        for w in new:
            if seen[w] == 1:
                del packed[w]
        if len(packed) > KEPT_WORDS:
            last = {w: packed[w] for w, n in seen.items() if n > 1}
            self.words = last if len(last) <= KEPT_WORDS else {}
        return filled

    def encode(self, texts: list[str]) -> pa.ListArray:
        rows = self.table.values(texts, b"".join)
        ends = np.cumsum([0, *map(len, rows)], dtype=np.int64) // 4
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                        pa.array(np.frombuffer(b"".join(rows), np.int32)))

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        get, size = self.tokens.__getitem__, len(self.tokens)
        out = []
        for row in ids:
            if row and not 0 <= min(row) <= max(row) < size:
                raise ValueError("an id lies outside the vocabulary")
            out.append(b"".join(map(get, row)))
        return out


@worker_cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()],
                                      names=[*batch.schema.names, *columns])


def blocks(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = BLOCK_BYTES,
           most_rows: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches cut to a number of bytes and rows."""
    for batch in batches:
        start = size = 0
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        for i, more in enumerate(sizes):
            if i > start and (size + more > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += more
        if start < batch.num_rows:
            yield batch.slice(start)


def widened(df: DataFrame, **columns: T.DataType) -> tuple[DataFrame, T.StructType]:
    """The table without columns of these names, and its schema with them added."""
    rest = without(df, *columns)
    return rest, T.StructType([*rest.schema.fields,
                               *(T.StructField(c, kind) for c, kind in columns.items())])


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """Add the token ids of each text; with ``decoded``, also their bytes again."""
    add = {ids: T.ArrayType(T.IntegerType())} | ({decoded: T.BinaryType()} if decoded else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(codec)
        own = codec(path, pattern)
        for block in blocks(batches, text, REPLAY_BYTES, REPLAY_ROWS):
            found = own.encode([x or "" for x in block.column(text).to_pylist()])
            for at in range(0, block.num_rows, DECODE_ROWS):
                part = found.slice(at, DECODE_ROWS)
                new = {ids: part}
                if decoded:
                    new[decoded] = pa.array(own.decode(part.to_pylist()), pa.binary())
                yield with_columns(block.slice(at, DECODE_ROWS), **new)

    rest, schema = widened(df, **add)
    return rest.mapInArrow(run, schema)


def token_rows(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The rows without their text, with n_tokens, ids and decoded_sha256.

    ids: in decimal, with commas; the digest is of the decoded bytes. Both are made
    in the worker from small blocks, slice by slice, so neither the texts nor the
    decoded bytes of more than a slice are held, and none of them leaves the worker.
    """
    add = {"n_tokens": T.LongType(), "ids": T.StringType(), "decoded_sha256": T.StringType()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(codec)
        own = codec(path, pattern)
        for block in blocks(batches, text):
            found = own.encode([x or "" for x in block.column(text).to_pylist()])
            rest = block.drop_columns([text])
            for at in range(0, block.num_rows, DECODE_ROWS):
                rows = found.slice(at, DECODE_ROWS).to_pylist()
                yield with_columns(
                    rest.slice(at, DECODE_ROWS), n_tokens=pa.array(map(len, rows), pa.int64()),
                    ids=pa.array([",".join(map(str, ids)) for ids in rows], pa.string()),
                    decoded_sha256=pa.array([hashlib.sha256(b).hexdigest()
                                             for b in own.decode(rows)], pa.string()))

    rest, _ = widened(df, **add)
    schema = T.StructType([*rest.drop(text).schema.fields,
                           *(T.StructField(c, kind) for c, kind in add.items())])
    return rest.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, "")
        for batch in batches:
            for at in range(0, batch.num_rows, DECODE_ROWS):
                block = batch.slice(at, DECODE_ROWS)
                rows = [x or [] for x in block.column(ids).to_pylist()]
                yield with_columns(block, **{decoded: pa.array(own.decode(rows), pa.binary())})

    rest, schema = widened(df, **{decoded: T.BinaryType()})
    return rest.mapInArrow(run, schema)


def encode_documents(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of ids and decoded bytes for every document."""
    coded = encode(df.select("doc_id", "text"), path, pattern, decoded="decoded")
    # text and ids are pruned before the digests, so only digests leave the stage
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"),
               256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
