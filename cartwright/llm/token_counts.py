"""Exact token counts at every prefix by dynamic programming.

Whether two tokens may stand side by side in a BPE encoding depends on the two
alone: they may if encoding their joined bytes gives just them again. So the
last token of the encoding of every prefix can be found from shorter prefixes:
of the tokens that end there, it is the one that may follow the last token of
the prefix before it. The count of a prefix is then one more than the count of
that shorter prefix. The table answers truncation and budget questions
(``tokens_in``, ``longest_within``) with array lookups, without encoding again.

Counts are those of the ``tokenizers`` library with its defaults: strings of
special tokens inside a text count as one token each; no tokens are added.

Defined cases: null and empty texts have 0 bytes and 0 tokens and the prefix
table [0]; texts of any length are counted whole; a prefix that ends inside a
special token, a white space run or a contraction gets the count of that prefix
as a text of its own. Other columns pass through, except those with a name that
the operator adds: they are replaced.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.bpe import REPLAY_BYTES, REPLAY_ROWS, blocks, widened, with_columns
from cartwright.llm.common import own_cache, worker_cache
from cartwright.llm.pieces import CLOSERS, ChunkTable, cut_block, places

#: pairs whose verdict a worker keeps
KEPT_PAIRS = 1_000_000
#: chunks whose table a worker keeps from block to block, and their most characters
KEPT_TABLES = 300_000
LONGEST_KEPT = 64
_TWO_SPACES = regex.compile(r"\s\s").search


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable letter of each byte in the vocabulary file.

    Bytes that Latin-1 prints stand for themselves, the others for the letters
    from U+0100 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PrefixCounter:
    """Prefix tables of pieces under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        back = {letter: b for b, letter in enumerate(letters)}
        self.letters = {b: letter for b, letter in enumerate(letters)}
        self.tokens = {i: bytes(back[c] for c in t) for t, i in model["vocab"].items()
                       if all(c in back for c in t)}
        self.base = max(self.tokens) + 1
        ids = {t: i for i, t in self.tokens.items()}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, token)
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (ids[bytes(back[c] for c in x)] for x in (left, right))
            self.merges.setdefault((a, b), (rank, ids[self.tokens[a] + self.tokens[b]]))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_cut = (regex.compile("|".join(map(regex.escape, sorted(
            self.special, key=len, reverse=True)))) if self.special else None)
        self.ending = ahocorasick.Automaton()  # all tokens that end at a place
        for i, token in self.tokens.items():
            self.ending.add_word(token.decode("latin-1"), (len(token), i))
        self.ending.make_automaton()
        self.verdicts: dict[int, bool] = {}
        self.pieces: dict[str, list[int]] = {}

    def _encode(self, data: bytes) -> list[int]:
        """Plain merging of a few bytes, for verdicts."""
        ids = [self.byte_id[b] for b in data]
        while len(ids) > 1:
            found = [(m[0], i) for i, pair in enumerate(zip(ids, ids[1:]))
                     if (m := self.merges.get(pair))]
            if not found:
                break
            _, i = min(found)
            ids[i:i + 2] = [self.merges[ids[i], ids[i + 1]][1]]
        return ids

    def _verdict(self, key: int) -> bool:
        left, right = divmod(key, self.base)
        if left:
            want = [left - 1, right]
            good = self._encode(self.tokens[left - 1] + self.tokens[right]) == want
        else:
            good = self._encode(self.tokens[right]) == [right]
        if len(self.verdicts) >= KEPT_PAIRS:
            self.verdicts.clear()
        self.verdicts[key] = good
        return good

    def table(self, data: bytes) -> list[int]:
        """Tokens of each prefix of a piece, by its length in bytes."""
        count, last = [0] * (len(data) + 1), [0] * (len(data) + 1)
        verdicts, base, done = self.verdicts, self.base, -1
        for end, (size, token) in self.ending.iter(data.decode("latin-1")):
            if end == done:
                continue
            start = end + 1 - size
            key = last[start] * base + token  # last: token + 1, 0 at the start
            good = verdicts.get(key)
            if good is None:
                good = self._verdict(key)
            if good:
                count[end + 1], last[end + 1], done = count[start] + 1, token + 1, end
        return count

    def total(self, piece: str) -> int:
        return self.table(piece.encode())[-1]


class TextCounter:
    """Totals and prefix tables of texts."""

    def __init__(self, path: str, pattern: str):
        self.counter = PrefixCounter(path)
        self.cut = regex.compile(pattern)
        self.table = ChunkTable(pattern, self._fill)
        self.known: dict[str, bytes] = {}

    def _fill(self, chunks: list[list[str]]) -> list[int]:
        known = {piece: -1 for pieces in chunks for piece in pieces}
        for piece in known:
            known[piece] = self.counter.total(piece)
        return [sum(map(known.__getitem__, pieces)) for pieces in chunks]

    def _chunk(self, key: str) -> bytes:
        """Tokens of the first 1, 2, ... characters of a chunk, as 32-bit integers."""
        text = key[1:] if key[:1] == "\n" else " " + key
        found = self.known.get(key)
        if found is not None:
            return found
        word, mark = (key, "") if key.isalpha() else (key[:-1], key[-1:])
        if word.isalpha() and (not mark or mark in CLOSERS):
            counts = self._piece(" " + word)
            if mark:  # a token of its own
                counts.append(counts[-1] + 1)
        elif "'" in text or _TWO_SPACES(text) or (
                self.counter.special_cut and self.counter.special_cut.search(text)):
            counts = self.prefixes(text)[1:]
        else:  # pieces follow each other, also in every prefix
            counts, before = [], 0
            for piece in self.cut.findall(text):
                counts += [before + c for c in self._piece(piece)]
                before = counts[-1]
        out = array("i", counts).tobytes()
        if len(key) <= LONGEST_KEPT:
            self.known[key] = out
        return out

    def _piece(self, piece: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters of a piece: where its bytes do not go on."""
        data = piece.encode()
        counts = self.counter.table(data)[1:]
        if len(data) > len(piece):
            counts = [c for c, after in zip(counts, data[1:] + b" ") if after & 0xC0 != 0x80]
        return counts

    def tables(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of the first 1, 2, ... characters of all texts, characters of each text)."""
        chunks, order, n = cut_block(texts)
        keys = chunks.to_pylist()
        packed = [*map(self._chunk, keys)]
        if len(self.known) > KEPT_TABLES:
            self.known.clear()
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        flat = np.frombuffer(b"".join(packed), np.int32)
        ends = np.cumsum(sizes)
        last = np.where(sizes > 0, flat[np.maximum(ends, 1) - 1] if len(flat) else 0, 0)
        # tokens before each chunk: of all chunks before, less those of the texts before
        upto = np.cumsum(last[order]) - last[order]
        begin = np.cumsum(n) - n
        before = upto - np.repeat(upto[begin], n) if len(order) else upto
        spread = sizes[order]
        out = flat[places((ends - sizes)[order], spread)] + np.repeat(before, spread)
        return out, np.add.reduceat(spread, begin) if len(order) else np.zeros(0, np.int64)

    def _segments(self, text: str) -> list[str]:
        return self.counter.special_cut.split(text) if self.counter.special_cut else [text]

    def totals(self, texts: list[str]) -> list[int]:
        cut = [self._segments(t) for t in texts]
        sums = iter(self.table.values([s for parts in cut for s in parts], sum))
        return [sum(next(sums) for _ in parts) + len(parts) - 1 for parts in cut]

    def _plain_prefixes(self, text: str) -> list[int]:
        """Tokens of the first 0, 1, 2, ... characters; special strings are plain text."""
        out, done, space_from, space_base = [0], 0, None, 0
        for match in self.cut.finditer(text):
            piece = match.group()
            table, at = self.counter.table(piece.encode()), 0
            run = None
            for i, letter in enumerate(piece):
                at += len(letter.encode())
                if letter.isspace():
                    if space_from is None:
                        space_from, space_base = match.start() + i, out[-1]
                        run = None
                    # as the end of a text, the whole run is one piece
                    if run is None:
                        stop = space_from
                        while stop < len(text) and text[stop].isspace():
                            stop += 1
                        run = self.counter.table(text[space_from:stop].encode())
                    size = len(text[space_from:match.start() + i + 1].encode())
                    out.append(space_base + run[size])
                else:
                    space_from = None
                    out.append(done + table[at])
            if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():
                for i in range(1, len(piece)):  # a part of a contraction is cut after the mark
                    head = self.cut.findall(piece[:i])
                    out[match.start() + i] = done + sum(map(self.counter.total, head))
            done += table[-1]
        return out

    def prefixes(self, text: str) -> list[int]:
        """Tokens of the first 0, 1, 2, ... characters of a text."""
        parts = self._segments(text)
        names = self.counter.special_cut.findall(text) if self.counter.special_cut else []
        out, before = [0], 0
        for i, part in enumerate(parts):
            out[-1:] = [before + n for n in self._plain_prefixes(part)]
            if i < len(names):
                # inside the special token the text so far is plain
                for k in range(1, len(names[i])):
                    out.append(before + self.totals([part + names[i][:k]])[0])
                before += self.totals([part])[0] + 1
                out.append(before)
        return out


@worker_cache
def text_counter(path: str, pattern: str) -> TextCounter:
    return TextCounter(path, pattern)


def token_counts(df: DataFrame, path: str, pattern: str, text: str = "text",
                 prefixes: bool = False) -> DataFrame:
    """Add n_bytes and n_tokens; with ``prefixes`` also prefix_tokens.

    prefix_tokens[i] is the token count of the first i characters.
    """
    add = {"n_bytes": T.LongType(), "n_tokens": T.LongType()}
    if prefixes:
        add["prefix_tokens"] = T.ArrayType(T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(text_counter)
        own = text_counter(path, pattern)
        for block in blocks(batches, text, *(() if prefixes else (REPLAY_BYTES, REPLAY_ROWS))):
            texts = [x or "" for x in block.column(text).to_pylist()]
            new = {"n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                   "n_tokens": pa.array(own.totals(texts), pa.int64())}
            if prefixes:
                new["prefix_tokens"] = pa.array([own.prefixes(t) for t in texts],
                                                pa.list_(pa.int32()))
            yield with_columns(block, **new)

    rest, schema = widened(df, **add)
    return rest.mapInArrow(run, schema)


def budgets(df: DataFrame, path: str, pattern: str, limit: int, text: str = "text") -> DataFrame:
    """Add n_bytes, n_tokens and n_chars_within: the characters that fit ``limit`` tokens.

    All from the prefix table of each whole text, which is built in the task, block
    by block, and not passed on.
    """
    add = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "n_chars_within": T.LongType()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(text_counter)
        own = text_counter(path, pattern)
        for block in blocks(batches, text):
            texts = [x or "" for x in block.column(text).to_pylist()]
            table, sizes = own.tables(texts)
            ends = np.cumsum(sizes)
            # counts may fall again where characters merge: the last place that fits is sought
            fits = np.where(table <= limit, np.arange(1, len(table) + 1), 0)
            some = sizes > 0
            begin = (ends - sizes)[some]
            total, within = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            if some.any():
                total[some] = table[ends[some] - 1]
                within[some] = np.maximum(np.maximum.reduceat(fits, begin) - begin, 0)
            yield with_columns(
                block, n_bytes=pa.array([len(t.encode()) for t in texts], pa.int64()),
                n_tokens=pa.array(total), n_chars_within=pa.array(within))

    rest, schema = widened(df, **add)
    return rest.mapInArrow(run, schema)


def tokens_in(prefix_tokens: Column, n_chars: Column | int) -> Column:
    """Tokens of the first ``n_chars`` characters (of the whole text beyond its end)."""
    n = F.lit(n_chars) if isinstance(n_chars, int) else n_chars
    return F.element_at(prefix_tokens, F.least(n, F.size(prefix_tokens) - 1) + 1)


def longest_within(prefix_tokens: Column, budget: Column | int) -> Column:
    """The longest prefix, in characters, that has at most ``budget`` tokens."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    fits = F.transform(prefix_tokens, lambda n, i: F.when(n <= limit, i))
    return F.array_max(fits)


def count_documents(df: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """Bytes, tokens, whether a document has more tokens than ``limit``, and how much of it fits."""
    counted = budgets(df.select("doc_id", "text"), path, pattern, limit)
    return counted.select("doc_id", "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"), "n_chars_within")
